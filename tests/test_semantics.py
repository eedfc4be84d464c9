"""Hand-made frames for the rules of SURVEY section 1.4."""

import datetime as dt

from pyspark.sql import functions as F

from marketlens.functions import dates as X
from marketlens.functions import numeric as N
from marketlens.functions import text as TX


def test_text_cutoff_excludes_whole_day(spark):
    rows = [(dt.datetime(2018, 8, 30, 23, 59),), (dt.datetime(2018, 8, 31, 0, 0),), (dt.datetime(2018, 8, 31, 12),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    assert df.where(X.before("ts", "2018-08-31")).count() == 1


def test_sqlite_month_overflow(spark):
    df = spark.createDataFrame([(dt.date(2018, 8, 31),), (dt.date(2016, 2, 29),), (dt.date(2018, 3, 1),)], "d date")
    out = [r[0] for r in df.select(X.add_months_overflow("d", -6)).collect()]
    assert out == [dt.date(2018, 3, 3), dt.date(2015, 8, 29), dt.date(2017, 9, 1)]


def test_elapsed_days_floor(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 23), dt.datetime(2020, 1, 2, 1)),
                                (dt.datetime(2020, 1, 2, 1), dt.datetime(2020, 1, 1, 23))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(X.elapsed_days("a", "b")).collect()] == [0, -1]


def test_cut_right_and_left_closed(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 5.0, 10.0, 25.0, 26.0]], "x double")
    right = [r[0] for r in df.select(N.cut("x", [0, 5, 10, 25], ["a", "b", "c"])).collect()]
    assert right == [None, None, "a", "b", "c", None]
    rates = spark.createDataFrame([(v,) for v in [0.0, 0.10, 0.25, 0.30]], "x double")
    left = [r[0] for r in rates.select(N.cut("x", [0, 0.1, 0.2, 0.3], ["l", "m", "h"], right=False)).collect()]
    assert left == ["l", "m", "h", None]


def test_equal_width_bin_all_equal_group(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r[0] for r in df.select(N.equal_width_bin(F.col("x"), F.lit(5.0), F.lit(5.0))).collect()] == [9, 9]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(N.round_half_even("x")).collect()] == [0.0, 2.0, 2.0]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    r = df.select(N.safe_div("a", "b"), N.div_or_zero("a", "b")).first()
    assert r[0] is None and r[1] == 0.0


def test_clean_name_accents(spark):
    df = spark.createDataFrame([("  `São Paulo ",), ("Nàtion_3",)], "s string")
    assert [r[0] for r in df.select(TX.clean_name("s")).collect()] == ["sao paulo", "nation_3"]


def test_review_regex_steps(spark):
    text = "Não gostei!!\nVeja http://x.com/a?b=1 em 12/05/2018 por R$ 45,90 e 3 vezes 😀"
    df = spark.createDataFrame([(text,)], "s string")
    out = df.select(TX.regex_steps("s")).first()[0]
    assert "link" in out and "data" in out and "dinheiro" in out and "numero" in out and "negação" in out
    assert "  " not in out and not out.endswith(" ") and "😀" not in out


def test_concat_null_rule(spark):
    df = spark.createDataFrame([("t", "m"), (None, "m"), ("t", None)], "t string, m string")
    assert [r[0] for r in df.select(TX.concat_title_message("t", "m")).collect()] == ["t m", "m", None]


def test_keyword_first_rule_wins(spark):
    df = spark.createDataFrame([("Red Widget Plate",), ("gizmo",)], "n string")
    out = [r[0] for r in df.select(TX.first_keyword_rule("n", [("plate", 1), ("widget", 2)])).collect()]
    assert out == [1, None]


def test_stopwords_keep_order(spark):
    df = spark.createDataFrame([("The cat and THE dog",)], "s string")
    assert df.select(TX.remove_stopwords("s", TX.default_stopwords("english"))).first()[0] == "cat dog"


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    km = df.select(N.haversine_km("a", "b", "c", "d")).first()[0]
    assert abs(km - 111.195) < 0.01
