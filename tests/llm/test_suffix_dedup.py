"""Repeated-string removal against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np

from deltarecon.llm import suffix_dedup as sd


def gone_bytes(rows):
    """Rows in order of id (nulls last); of equal windows all but the first are removed."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), [None] * len(rows)
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = bytearray(len(data))
        new = set()
        for s in range(len(data) - 99):
            w = data[s:s + 100]
            if w in seen or w in new:
                gone[s:s + 100] = b"\1" * 100
            new.add(w)
        seen |= new
        out[i] = data, gone
    return out


def brute_texts(rows):
    """What stays of each text, by id."""
    return {i: bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
            for (i, _), (data, gone) in zip(rows, gone_bytes(rows))}


def brute(rows):
    out = []
    for (i, _), (data, gone) in zip(rows, gone_bytes(rows)):
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for s in range(len(gone)) if gone[s] and (s == 0 or not gone[s - 1]))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted(map(tuple, sd.repeat_report(df, **kw).collect()), key=str)


def planted(rng, n=120):
    words = [bytes(rng.choices(range(97, 123), k=rng.randrange(1, 8))).decode() for _ in range(300)] + ["é", "漢字", "the", "of"]
    passages = [" ".join(rng.choices(words, k=60)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randrange(80)))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(60)
            parts += [p[a:a + rng.randrange(60, 400)], " ".join(rng.choices(words, k=rng.randrange(20)))]
        rows.append((rng.choice([i, i, i, i * 3]), " ".join(parts)))
    rows += [(1000, rows[5][1]), (-3, rows[9][1]), (2000, "in " * 150), (2001, "in " * 90 + "x"), (2002, "a" * 99),
             (2003, "a" * 100), (2004, "a" * 101), (2005, "a" * 350)]
    return rows


def test_planted_passages_in_many_blocks(make_docs):
    rows = planted(random.Random(4))
    ids = [i for i, _ in rows]
    rows = [(i * 1000 + k, t) for k, (i, t) in enumerate(rows)]  # ids differ, order doesn't follow rows
    assert len(set(ids)) < len(ids)
    want = brute(rows)
    assert sum(r[2] for r in want) > 3000
    assert got(make_docs(rows), block_bytes=4_000, part_bytes=9_000) == want
    assert got(make_docs(rows)) == want


def test_hot_anchors_are_spread(make_docs):
    rows = [(k, t) for k, (_, t) in enumerate(planted(random.Random(5), 60))]
    rows += [(500 + k, f"{k * 7919} own words {k} " + rows[3][1][:300] + f" and an end {k * 31}") for k in range(60)]
    want = brute(rows)
    for hot in (1, 5):
        assert got(make_docs(rows), block_bytes=4_000, part_bytes=9_000, hot_kinds=hot) == want


def test_whole_small_table(make_docs, docs_small):
    assert got(make_docs(docs_small), block_bytes=60_000, part_bytes=150_000) == brute(docs_small)


def test_edges(make_docs):
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, "short"), (None, "n" * 150), (9, "x" * 50 + "n" * 100), (5, long), (6, long[70_000:70_500])]
    assert got(make_docs(rows)) == brute(rows)
    assert got(make_docs([])) == []
    same = [(7, "some repeated row " * 9), (7, "some repeated row " * 9)]
    both = got(make_docs(same))
    assert sorted(r[2] for r in both) == sorted(r[2] for r in brute(same))


def test_pieces_of_long_texts(make_docs, monkeypatch):
    rows = [(1, "".join(random.Random(1).choices("abcdef", k=3000)))]
    rows += [(2, rows[0][1][500:1700]), (3, rows[0][1][40:900] + "zz" + rows[0][1][2000:])]
    monkeypatch.setattr(sd, "PIECE", 150)
    t = sd._segments([r[1].encode() for r in rows])
    assert int(t[2].sum()) == sum(len(r[1]) - 99 for r in rows)  # every window is in one segment


def test_merged_order_is_the_suffix_order():
    rng = random.Random(8)
    base = bytes(rng.choices(b"ab", k=400))
    strings = [bytes(rng.choices(b"ab", k=rng.randrange(2, 60))) + base[a:a + rng.randrange(40, 300)]
               for a in rng.choices(range(300), k=40)] + [b"ab" * 90, b"ab" * 60 + b"a"]
    shard_of = sorted(rng.randrange(5) for _ in strings)
    symbols = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.uint16) + 1, np.uint16(0)) for s in strings])
    shard = np.concatenate([np.full(len(s) + 1, k) for s, k in zip(strings, shard_of)])
    suffix, block = sd.repeated_intervals(symbols, shard, len(strings))
    starts = np.cumsum([0, *(len(s) + 1 for s in strings)])
    prefix = {starts[k] + o: s[o:o + 100] for k, s in enumerate(strings) for o in range(len(s) - 99)}
    times = Counter(prefix.values())
    assert set(suffix.tolist()) == {x for x, p in prefix.items() if times[p] > 1} != set()
    for a, b, x, y in zip(suffix, suffix[1:], block, block[1:]):
        assert prefix[a] <= prefix[b] and (x == y) == (prefix[a] == prefix[b])


def test_texts_for_the_next_stage(spark):
    passage = "A passage of some length that stands in two documents, word for word, é and all, so that one of them goes. "
    rows = [(1, "x1 " + passage + "y1", "s", 9, 7), (2, "x2 " + passage + "y2", "s", 9, 7), (3, passage, None, 9, 7), (4, None, "s", None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, row int")
    out = {r["doc_id"]: r for r in sd.without_repeats(df).collect()}
    assert sorted(out) == [1, 2, 4] and out[1]["text"] == rows[0][1] and out[1]["n_chars"] == 9
    assert out[2]["text"].startswith("x2") and out[2]["n_chars"] == len(out[2]["text"]) < 40
    assert out[4]["text"] is None and out[1]["row"] == 7
    assert sd.without_repeats(df).columns == df.columns
