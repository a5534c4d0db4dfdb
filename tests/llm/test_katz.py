"""Katz scoring against a plain dictionary version."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from deltarecon.llm import katz


def toks(text):
    return (text or "").encode().lower().split()


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Brute:
    def __init__(self, texts, order=2):
        self.order = order
        self.c = {n: Counter() for n in range(1, order + 1)}
        for t in texts:
            seq = [b"\n", *toks(t), b" "]
            self.c[1].update((w,) for w in seq[1:])
            for n in range(2, order + 1):
                self.c[n].update(zip(*(seq[i:] for i in range(n))))
        self.n, self.v = sum(self.c[1].values()), len(self.c[1])
        hist = lambda c: np.array([sum(x == r for x in c.values()) for r in range(1, 7)])
        self.d = {n: katz.discounts(hist(c)) for n, c in self.c.items()}
        self.after, self.known = {}, {}
        for n in range(2, order + 1):
            for g, k in self.c[n].items():
                self.after.setdefault(g[:-1], []).append((g[-1], k))
        self.unknown = 1 - sum(self.disc(k, 1) for k in self.c[1].values()) / self.n if self.n else 1.0
        self.of = self.n
        if self.unknown < 1e-12:
            self.of, self.unknown = self.n + 1, 1 / (self.n + 1)

    def disc(self, k, n):
        return k * (self.d[n][k] if k <= 5 else 1.0)

    def context(self, h):
        """The denominator of a history's n-grams and its back-off weight."""
        if h not in self.known:
            seen, n = self.after[h], len(h) + 1
            of, left = sum(k for _, k in seen), sum(k - self.disc(k, n) for _, k in seen)
            if left < 1e-12:
                of, left = of + 1, 1
            self.known[h] = of, left / of / (1 - sum(self.p(h[1:], w) for w, _ in seen))
        return self.known[h]

    def p(self, h, w):
        if not h:
            k = self.c[1][w,]
            return self.disc(k, 1) / self.of if k else self.unknown
        if h not in self.after:
            return self.p(h[1:], w)
        of, back = self.context(h)
        k = self.c[len(h) + 1][*h, w]
        return self.disc(k, len(h) + 1) / of if k else back * self.p(h[1:], w)

    def row(self, i, text):
        seq = (b"\n", *toks(text), b" ")
        score = sum(math.log10(self.p(seq[max(0, j - self.order + 1):j], seq[j])) for j in range(1, len(seq)))
        base = sum(math.log10((self.c[1][w,] + 1) / (self.n + self.v + 1)) for w in seq[1:])
        return (i, is_held(i), len(seq) - 1, sum(self.c[1][w,] > 0 for w in seq[1:]), self.n, base, score)


def check(df, rows, **kw):
    brute = Brute([t for i, t in rows if not is_held(i)], kw.get("order", katz.ORDER))
    want = sorted((brute.row(i, t) for i, t in rows), key=lambda r: str(r[:4]) + f"{r[5]:.6f}")
    got = katz.score_documents(df, katz.held_out(F.col("doc_id"), 7, 2), **kw).collect()
    got = sorted(map(tuple, got), key=lambda r: str(r[:4]) + f"{r[5]:.6f}")
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return got, brute


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_whole_small_table_in_many_blocks(make_docs, docs_small, order):
    got, _ = check(make_docs(docs_small), docs_small, order=order, block_bytes=40_000, part_bytes=90_000)
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than the base on unseen texts


@pytest.mark.parametrize("order", [2, 3])
def test_heavy_first_words_are_spread(make_docs, docs_small, order):
    rows = [(i, (t or "").replace(" ", " the ")) for i, t in docs_small[:60]]
    check(make_docs(rows), rows, order=order, block_bytes=15_000, part_bytes=20_000, heavy=0.05)


@pytest.mark.parametrize("order", [2, 3])
def test_nulls_empties_repeats_and_long(make_docs, order):
    rows = [(1, None), (2, ""), (None, "a b a b"), (3, "a b c"), (3, "a b c"), (4, "A\tB\x0bc é É"), (5, " \n "),
            (6, " ".join(f"w{i * i % 977}" for i in range(100_000))), (7, "zz")]
    rows += [(i, f"held text {i}") for i in range(8, 30)]
    check(make_docs(rows), rows, order=order)


def test_heavy_pairs_and_many_copies(make_docs):
    rows = [(i, "a b " * (i % 9) + f"c{i % 4} a b a") for i in range(300)]
    check(make_docs(rows), rows, order=3, block_bytes=500, part_bytes=400, heavy=0.5)


def test_empty_table_and_no_training(make_docs):
    assert katz.score_documents(make_docs([]), F.lit(False)).collect() == []
    r = katz.score_documents(make_docs([(1, "a b")]), F.lit(True)).collect()[0]
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) == (3, 0, 0, 0.0)
    assert katz.score_documents(make_docs([(1, "a b")]), F.lit(True), order=3).collect()[0]["score"] == 0.0
    with pytest.raises(ValueError, match="order"):
        katz.score_documents(make_docs([]), F.lit(False), order=0)


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one(docs_small, order):
    brute = Brute([t for _, t in docs_small[:80]], order)
    for h in [h for h in brute.after if len(h) == order - 1][:40] + [(b"never seen",)]:
        assert sum(brute.p(h, w) for w, in brute.c[1]) + brute.p(h, b"never seen") == pytest.approx(1)
