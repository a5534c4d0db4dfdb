"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

import duckdb

from deltarecon.llm import decontaminate as dec

from tests.conftest import SF_SMALL

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, bench):
    """``doc_id`` to the digest columns."""
    wins = {}
    for i, t in bench:
        ws = words(t)
        n = min(10, len(ws))
        for s in range(len(ws) - n + 1 if n else 0):
            wins.setdefault(tuple(ws[s:s + n]), set()).add(i)
    out = {}
    for i, t in rows:
        ws, hit, items = words(t), set(), set()
        for n in {len(w) for w in wins}:
            for s in range(len(ws) - n + 1):
                if tuple(ws[s:s + n]) in wins:
                    hit |= set(range(s, s + n))
                    items |= wins[tuple(ws[s:s + n])]
        names = sorted(str(x) for x in items if x is not None)
        out[i] = (len(ws), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))
    return out


def got(df, bench):
    return {r["doc_id"]: tuple(r)[1:] for r in dec.decontamination_report(df, bench).collect()}


def bench_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_whole_small_table(spark, make_docs, docs_small):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    assert got(make_docs(docs_small), bench_table(spark, items)) == brute(docs_small, items)


def test_short_items_ties_repeats_and_edges(spark, make_docs):
    rng = random.Random(1)
    vocab = ["a", "b", "the", "É", "é", "x9", "longer"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 9, 10, 11, 12, 30])))) for i in range(25)]
    items += [(3, items[5][1]), (None, "only null item words here and some more of them now"), (90, None), (91, ""), (92, "?!")]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randrange(120)))) for i in range(60)]
    docs += [(100 + i, f"start {t} End, {(t or '').upper()}!") for i, (_, t) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "... !"), (203, " ".join(rng.choices(vocab, k=60_000)))]
    for kept in (items, [x for x in items if len(words(x[1])) >= 10]):  # with short items and without
        assert got(make_docs(docs), bench_table(spark, kept)) == brute(docs, kept)


def test_shuffle_join_gives_the_same(spark, make_docs, docs_small, monkeypatch):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    monkeypatch.setattr(dec, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(dec, "MAP_BITS", 7)  # lets nearly all through
    assert got(make_docs(docs_small[:80]), bench_table(spark, items)) == brute(docs_small[:80], items)


def test_drop_keeps_rows_and_columns(spark, make_docs):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, "x " + item), (None, item), (None, None), (2, "clean"), (2, "clean"), (2, item + " y"), (3, "")]
    left = dec.drop_contaminated(make_docs(rows), bench_table(spark, [(1, item)])).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left) == [("2", "clean"), ("2", "clean"), ("3", ""), ("None", "None")]
    assert dec.drop_contaminated(make_docs([]), bench_table(spark, [(1, item)])).count() == 0
    assert dec.drop_contaminated(make_docs(rows), bench_table(spark, [])).count() == len(rows)
