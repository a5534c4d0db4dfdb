"""The registered queries: names, SQL versions, contract columns, nothing else imports them."""

import pathlib
import re

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from deltarecon.harness.compare import compare, duck
from deltarecon.llm.oracles import ORACLES
from deltarecon.llm.queries import QUERIES

from tests.conftest import SF_SMALL

COLUMNS = {
    3: [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")],
    4: [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"),
        ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")],
    5: [("doc_id", "bigint"), ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"),
        ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("kept", "boolean")],
    6: [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    7: [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
    8: [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
    9: [("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"),
        ("items_sha256", "string"), ("contaminated", "boolean")],
    10: [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"),
         ("kept_sha256", "string")],
    11: [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"),
         ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")],
    12: [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")],
    13: [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
         ("explained", "double"), ("identity_error", "double")],
}
TABLES = {12: ("pages", "page_id"), 13: ("embeddings", "vec_id")}  # others: documents


def test_one_query_an_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    got = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert got["cols_match"] and got["values_match"] and got["types_match"], got


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_contract_columns_and_rows(spark, n):
    name = next(q for q in QUERIES if q.startswith(f"op{n}_"))
    df = QUERIES[name](spark, SF_SMALL)
    assert df.dtypes[: len(COLUMNS[n])] == COLUMNS[n]
    name, key = TABLES.get(n, ("documents", "doc_id"))
    ids = [i for i, in duckdb.sql(f"SELECT {key} FROM '{SF_SMALL}/{name}.parquet'").fetchall()]
    assert sorted(r[0] for r in df.select(key).collect()) == sorted(ids * (8 if n == 13 else 1))


def test_nothing_else_imports_the_folder():
    root = pathlib.Path(__file__).parents[2] / "deltarecon"
    rest = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]
    assert rest and not any("llm" in p.read_text() for p in rest)
