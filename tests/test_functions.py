import datetime as dt

from pyspark.sql import functions as F

from trendmill import functions as fn


def _apply(spark, function, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.o for r in rows.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


def test_to_long(spark):
    values = ["12", " 12 ", "+5", "-7", "1.9", "5.", "-1.5", "x", "", None, "9223372036854775807",
              "9223372036854775808", "99999999999999999999999", "1e3", "12a", "1 2"]
    assert _apply(spark, fn.to_long, values) == [
        12, 12, 5, -7, 1, 5, -1, None, None, None, 9223372036854775807, None, None, None, None, None]


def test_to_long_or_zero(spark):
    assert _apply(spark, fn.to_long_or_zero, ["3", "1.5", "x", None, "1e3", "1e40", ""]) == [3, 1, 0, 0, 1000, 0, 0]


def test_api_int_takes_whole_numbers_only(spark):
    assert _apply(spark, fn.api_int, ["12", "1.5", "x", None, "99999999999999999999"]) == [12, 0, 0, 0, 0]


def test_digits_to_long(spark):
    assert _apply(spark, fn.digits_to_long, ["10", "x1", "1x", "-1", " 1", "1\n", "", None]) == [
        10, None, None, None, None, None, None, None]


def test_to_boolean(spark):
    assert _apply(spark, fn.to_boolean, ["True", "FALSE", "maybe", "", None, " yes "]) == [
        True, False, None, None, None, True]


def test_trending_date(spark):
    values = ["17.14.11", "17.31.02", "17.11.14", "2018-01-05", "2018-01-05T10:00:00", "junk", "", None, "17.14.11\n"]
    assert _apply(spark, fn.parse_trending_date, values) == [
        dt.date(2017, 11, 14), None, None, dt.date(2018, 1, 5), dt.date(2018, 1, 5), None, None, None, None]


def test_utc_date(spark):
    values = ["2024-05-01T23:30:00+00:00", "2024-05-01T23:30:00-02:00", "2024-05-01T10:00:00.123456Z", "bad", None]
    assert _apply(spark, fn.utc_date, values) == [
        dt.date(2024, 5, 1), dt.date(2024, 5, 2), dt.date(2024, 5, 1), None, None]


def test_has_text(spark):
    assert _apply(spark, fn.has_text, ["a", " a ", "", " ", "\t\n", " ", "　", None]) == [
        True, True, False, False, False, False, False, False]


def test_rates(spark):
    rows = spark.createDataFrame([(5, 0, 10, 1000), (7, 0, 1, 0), (1, 0, 0, 500), (45, 0, 0, 80000)],
                                 "l long, d long, c long, v long")
    out = rows.select(fn.like_ratio(F.col("l"), F.col("v")),
                      fn.engagement_rate(F.col("l"), F.col("d"), F.col("c"), F.col("v"))).collect()
    assert [tuple(r) for r in out] == [(0.5, 1.5), (0.0, 0.0), (0.2, 0.2), (0.0562, 0.0562)]


def test_average_of_rates_is_exact_in_any_order(spark):
    values = [0.1, 0.2, 0.3, 1e12 + 0.0001, 12.3456, -3.25, None]
    for order in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "x double").repartition(3)
        got = df.agg(fn.average_of_rates(F.col("x")).alias("a")).first().a
        assert got == float("1000000000009.6957") / 6
    assert spark.createDataFrame([(None,)], "x double").agg(fn.average_of_rates(F.col("x"))).first()[0] is None
