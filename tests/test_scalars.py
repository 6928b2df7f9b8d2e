"""Edge tables of FIXTURES.md section 5 for the scalar column functions."""

import pytest
from pyspark.sql import functions as F

from kaiji.functions import codes as C
from kaiji.functions import dates as D


def one(spark, expr, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


@pytest.mark.parametrize("raw,exp", [
    ("7203", "JP:72030"), ("7203.0", "JP:72030"), ("13015", "JP:13015"), ("130A", "JP:130A0"),
    ("jp:7203", "JP:72030"), ("US:AAPL", "US:AAPL"), ("JP:", None), (" ", None), ("nan", None),
    ("None", None), (None, None)])
def test_normalize_code_jp(spark, raw, exp):
    assert one(spark, C.normalize_code("x", "JP"), [raw]) == [exp]


def test_normalize_code_without_nationality(spark):
    assert one(spark, C.normalize_code("x"), ["7203", "JP:"]) == ["7203", None]


def test_parent_code(spark):
    assert one(spark, C.parent_code("x"), ["JP:13015", "JP:72030"]) == ["JP:13010", None]


def test_bin_id(spark):
    df = spark.createDataFrame([("E12345", None, None), (None, "JP:72030", None), ("nan", "7203", None),
                                (None, None, "1234567890123"), (None, None, None)], "e string, c string, j string")
    assert [r[0] for r in df.select(C.bin_id("e", "c", "j")).collect()] == ["E45", "P03", "P20", "J23", "No"]


def test_sentinels_and_flags(spark):
    assert one(spark, C.null_sentinel("x"), ["-", "NaN", "none", "", " a "]) == [None, None, None, None, "a"]
    assert one(spark, C.yes_no_flag("x"), ["有", "無"]) == [True, False]
    assert one(spark, C.listed_flag("x"), ["上場", "非上場", "x", None]) == [True, False, False, False]


def test_safe_int_and_percent(spark):
    assert one(spark, C.safe_int_str("x"), ["123.0", "12.9", "abc ", " "]) == ["123", "12", "abc", None]
    assert one(spark, C.percent_weight("x"), ["1.5%", "%", "2"]) == [1.5, 0.0, 2.0]


def test_taxonomy_key(spark):
    assert one(spark, C.taxonomy_key("x"), ["a_b_c", "", "abc"]) == ["a_b:c", None, None]


def test_company_name_core(spark):
    assert one(spark, C.company_name_core("x"), ["株式会社トヨタ", " (株)ABC "]) == ["トヨタ", "ABC"]


def test_parse_datetime(spark):
    got = one(spark, D.parse_datetime("x"), ["2022-10-03 09:17:45", "2022-10-03 09:17", "2022-10-03", ""])
    assert [str(g) if g else None for g in got] == ["2022-10-03 09:17:45", "2022-10-03 09:17:00", None, None]


def test_num_months(spark):
    df = spark.createDataFrame([("2023-04-01", "2024-03-31"), ("2024-01-01", "2024-01-01"),
                                ("2022-01-01", "2024-03-10")], "a string, b string")
    assert [r[0] for r in df.select(D.num_months("a", "b")).collect()] == [12, None, None]


def test_is_amendment(spark):
    df = spark.createDataFrame([(None, "120", "訂正報告"), ("", "120", "x"), (None, "131", "x")],
                               "p string, t string, ti string")
    assert [r[0] for r in df.select(D.is_amendment("p", "t", "ti")).collect()] == [True, False, True]


def test_repo_path(spark):
    df = spark.createDataFrame([("S100P91R", "2022-10-03 09:17:45"), ("X", None)], "d string, s string")
    assert [r[0] for r in df.select(D.repo_path("d", "s")).collect()] == [
        "raw/edinet/year=2022/month=10/day=03/zip/S100P91R.zip", "raw/edinet/unknown/zip/X.zip"]


def test_lenient_date(spark):
    fb = F.to_date(F.lit("2000-01-01"))
    got = one(spark, D.lenient_date("x", fb), ["2024-02-03", "2024/02/03", "20240203", "bad", None])
    assert [str(g) for g in got] == ["2024-02-03", "2024-02-03", "2024-02-03", "2000-01-01", "2000-01-01"]


def test_text_steps(spark):
    from kaiji.operators import text as TX
    assert one(spark, TX.nfkc("x"), ["ｱ①ＡＢ", None]) == ["ア1AB", None]
    assert one(spark, TX.strip_html("x"), ["a<b>c", "a<b\nc>d"]) == ["ac", "a<b\nc>d"]
    assert one(spark, TX.collapse_blank_lines("x"), ["a\n \n\n\nb"]) == ["a\nb"]
    assert one(spark, TX.normalize_text("x", True, True, True), ["<p>売上は1,000円。◆増加!</p>"]) == ["売上は円\n増加"]
    objs = spark.createDataFrame([('x {"a":1} y {"b":2}',), ("{bad}",)], "x string").select(
        TX.json_objects("x").alias("o"))
    got = objs.select(F.size("o"), TX.json_objects_valid(F.col("o"))).collect()
    assert [tuple(r) for r in got] == [(2, True), (1, False)]
