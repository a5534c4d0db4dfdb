"""Column rules on the hand-made edge rows of FIXTURES.md section 3."""

import pytest
from pyspark.sql import functions as F

from deltarecon.functions import formatting, rules


def apply(spark, rule, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(rule(F.col("v"))).collect()]


def test_suffix_key(spark):
    assert apply(spark, rules.suffix_key, ["123", " 12", "  ", None]) == ["123D", " 12D", "", None]


def test_suffix_nonzero(spark):
    assert apply(spark, rules.suffix_nonzero, ["000", "", None, "010"]) == ["", "", "", "010D"]


def test_zero_to_blank(spark):
    assert apply(spark, rules.zero_to_blank, ["0000", " 007 ", None]) == ["", "007", None]


def test_strip_letters(spark):
    assert apply(spark, rules.strip_letters, ["1A2b", " 3O", "  "]) == ["12", " 3", ""]


def test_trim_keep_ws(spark):
    assert apply(spark, rules.trim_keep_ws, [" Acme ", "  ", None]) == ["Acme", "  ", None]


@pytest.mark.parametrize(
    "field,search,expected",
    [
        ("00", "0", "0"),
        ("105", "0", "15"),
        ("12", "0", ""),
        ("", "0", ""),
        ("ab", "", "b"),
        ("SC123456", "123456", "SC23456"),
        (None, "0", None),
        ("a", None, None),
    ],
)
def test_remove_first(spark, field, search, expected):
    df = spark.createDataFrame([(field, search)], "f string, s string")
    got = df.select(rules.remove_first("f", "s")).first()[0]
    assert got == expected
    if search is not None:
        assert df.select(rules.remove_first("f", literal=search)).first()[0] == expected


def test_day_prefix_on_text_and_timestamp(spark):
    df = spark.sql("SELECT '2024-01-03 01:02:03' AS s, TIMESTAMP_NTZ'2024-01-03 23:59:59' AS t")
    r = df.select(rules.day_prefix("s"), rules.day_prefix("t")).first()
    assert tuple(r) == ("2024-01-03", "2024-01-03")


def test_trim_only_strips_spaces(spark):
    assert apply(spark, F.trim, ["\tA "]) == ["\tA"]


def test_delimited_line_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(formatting.delimited_line(["x", "y", "z"])).first()[0] == "a\u0001null\u0001c"


def test_job_time_uses_calendar_year(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-12-30 10:11:12' AS t")
    assert df.select(formatting.format_job_time("t")).first()[0] == "2024-12-30 10:11:12"


def test_na_text_and_html_row(spark):
    df = spark.createDataFrame([("E", None)], "e string, n bigint")
    r = df.select(formatting.na_text("n"), formatting.html_row(["e", formatting.na_text("n")])).first()
    assert r[0] == "NA"
    cell = formatting.HTML_CELL_OPEN
    assert r[1] == f"<tr>{cell}E</td>{cell}NA</td></tr>"
