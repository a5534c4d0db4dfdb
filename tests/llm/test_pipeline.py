"""The pipeline's stages against plain Python versions of them, one after another."""

import re

import duckdb
import pytest

import corpus_pipeline
from deltarecon.llm import quality as q
from deltarecon.llm.oracles import ORACLES

from tests.conftest import SF_SMALL
from tests.llm import test_decontaminate, test_quality, test_simhash, test_suffix_dedup


def by_hand(rows, bench):
    out = []
    for i, text, source in rows:  # quality rules
        if test_quality.brute(text)[5]:
            continue
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        good = [x for x in lines if re.search(q.SENTENCE_END, x)
                and len(x) - len(re.sub(q.NOISE, "", x)) <= len(x) * q.MAX_NOISE
                and not re.search(q.NAVIGATION, x) and not re.search(q.BOILERPLATE, x)]
        if 1 - len("".join(good)) / len("".join(lines)) <= q.MAX_LOST:
            out.append((i, "\n".join(good), source))
    comps = {r[0]: r[2] for r in test_simhash.brute([r[:2] for r in out])}
    out = [r for r in out if comps[r[0]] == r[0]]
    kept = test_suffix_dedup.brute_texts([r[:2] for r in out])
    out = [(i, kept[i], s) for i, _, s in out if kept[i]]
    hits = test_decontaminate.brute([r[:2] for r in out], bench)
    return [r for r in out if not hits[r[0]][-1]]


@pytest.fixture(scope="module")
def tables():
    docs = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    return docs, duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()


def test_whole_small_table(spark, tables):
    want = by_hand(*tables)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", want)
    draws = con.execute(f"SELECT doc_id, source, n_tokens, epoch, start_token FROM ({ORACLES['op1_temperature_mixing']})").fetchall()
    got = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "source", "n_tokens", "epoch", "start_token").collect()
    assert 0 < len(want) < len(tables[0])
    assert sorted(map(tuple, got)) == sorted(draws)


def test_stages_keep_columns_and_bear_odd_rows(spark):
    rows = [(None, None, None, None, None, "x"), (1, "", "en", None, 0, None), (1, "", "en", None, 0, None),
            (2, test_quality.prose(12), None, "s", None, "y"), (None, test_quality.prose(15) + " more", "en", "s", 3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality string")
    for data in (df, df.limit(0)):
        docs = data
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_SMALL)
            assert docs.columns == df.columns, name
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() == (2 if data is df else 0)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= 0


def test_clashing_columns_come_through(spark):
    """Names that the operators use themselves, with their values."""
    names = ["__row", "__ws", "__m", "__quality", "Quality", "print", "least", "root", "fingerprint", "is_first", "component_id",
             "row", "block", "row_nr", "measured", "ws", "lines", "id", "none", "first", "print_key", "span", "gram"]
    rows = [(i, test_quality.prose(12 + i), "en", "s", 7, *range(100 * i, 100 * i + len(names))) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                               + ", ".join(f"`{n}` int" for n in names))
    want = {r[0]: r[5:] for r in rows}
    docs = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == df.columns, name
        got = docs.collect()
        assert len(got) == 4 and all(tuple(r)[5:] == want[r["doc_id"]] for r in got), name
        docs = spark.createDataFrame(got, docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= 4


def test_nothing_is_left_behind(spark):
    import os
    from deltarecon.session import ensure_checkpoint_dir, scratch_scope

    base = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "deltarecon-scratch")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    with scratch_scope(spark):
        assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    assert set(os.listdir(base)) == before
