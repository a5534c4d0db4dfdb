"""Token counts against the tokenizer library."""

import random

import pytest
from tokenizers import Tokenizer

from deltarecon.llm import token_counts as tc

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return tc.TokenCounter(open(PATH, encoding="utf-8").read())


def want(library, texts):
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_random_strings(library, counter):
    rng = random.Random(1)
    pieces = ["'", "'s", "'re", "'ve", "'ll", "'l", "'r", " ", "  ", "\n", "\t", "a", "re", "The", " the", "9", "2024", "!",
              "...", "é", "ß", "漢字", "🙂", " ", "　", "_", "$$", "\r\n", "x" * 40, "Ⅷ", "́", "<|endoftext|>", "ll"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(30))) for _ in range(4000)]
    assert counter.count(texts).tolist() == want(library, texts)


def test_words_of_many_kinds(library, counter):
    rng = random.Random(2)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x3000)])) for _ in range(60)) for _ in range(500)]
    texts += ["abcdefghijklmnop"[: rng.randrange(17)] * rng.randrange(30) for _ in range(300)]
    assert counter.count(texts).tolist() == want(library, texts)


def test_sections_chunks_and_resets_change_nothing(library, monkeypatch):
    rng = random.Random(3)
    pieces = ["'", "'re", "'r", " ", "\n", "word", " and", "77", "!", "é"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(200))) for _ in range(300)]
    expect = want(library, texts)
    spec = open(PATH, encoding="utf-8").read()
    monkeypatch.setattr(tc, "CHUNK", 3)
    assert tc.TokenCounter(spec).count(texts).tolist() == expect
    monkeypatch.setattr(tc, "SECTION", 7)
    monkeypatch.setattr(tc, "MAX_STATES", 40)
    monkeypatch.setattr(tc, "MAX_PIECES", 10)
    assert tc.TokenCounter(spec).count(texts).tolist() == expect


def test_query_on_whole_small_table_and_edges(library, make_docs, docs_small):
    rows = docs_small + [(None, None), (5, ""), (5, ""), (None, " "), (-1, "long " * 300_000), (-2, "z" * 2_000_000)]
    got = tc.token_counts(make_docs(rows), PATH).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    counts = want(library, [t for _, t in rows[:-2]]) + [
        len(library.encode("long " * 3000).ids) - 1 + (300_000 - 3000) + 1, None]
    for g, (i, t), n in zip(sorted(map(tuple, got), key=key),
                            *zip(*sorted(zip(rows, counts), key=lambda x: (x[0][0] is None, x[0][0] or 0, len((x[0][1] or "").encode()))))):
        assert g[:2] == (i, len((t or "").encode()))
        if n is not None:
            assert g[2] == n
        assert g[3] == (g[2] > 1024)


def test_empty_table(make_docs):
    assert tc.token_counts(make_docs([]), PATH).collect() == []
