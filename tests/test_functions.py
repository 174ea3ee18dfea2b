import datetime as dt

import pytest
from pyspark.sql import functions as F

from paneloom import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "quarter, start, end",
    [
        ("2013-Q1", "2013-05-16", "2013-08-14"),
        ("2013-Q2", "2013-08-15", "2013-11-14"),
        ("2013-Q3", "2013-11-15", "2014-03-31"),
        ("2013-Q4", "2014-04-01", "2014-05-15"),
    ],
)
def test_quarter_windows(spark, quarter, start, end):
    lo, hi = fn.disclosure_window(F.lit(quarter))
    got = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (str(got.lo), str(got.hi)) == (start, end)
    assert tuple(map(str, fn.quarter_bounds(quarter))) == (start, end)


@pytest.mark.parametrize("bad", ["2013-Q5", "2013"])
def test_invalid_quarter(spark, bad):
    with pytest.raises(ValueError, match="not a quarter such as"):
        fn.quarter_bounds(bad)
    with pytest.raises(Exception, match="not a quarter such as"):
        lo, _ = fn.disclosure_window(F.lit(bad))
        spark.range(1).select(lo).collect()


@pytest.mark.parametrize(
    "date, quarter",
    [
        ("2013-05-16", "2013-Q1"),
        ("2013-08-14", "2013-Q1"),
        ("2013-08-15", "2013-Q2"),
        ("2013-11-14", "2013-Q2"),
        ("2013-11-15", "2013-Q3"),
        ("2014-03-31", "2013-Q3"),
        ("2014-04-01", "2013-Q4"),
        ("2014-05-15", "2013-Q4"),
        ("2012-02-29", "2011-Q3"),
    ],
)
def test_quarter_of_date(spark, date, quarter):
    assert one(spark, fn.disclosure_quarter(F.lit(date).cast("date"))) == quarter


def test_every_day_lies_in_its_window(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2011-01-01', DATE'2017-12-31')) AS d")
    q = days.withColumn("q", fn.disclosure_quarter("d"))
    lo, hi = fn.disclosure_window("q")
    assert q.where(~F.col("d").between(lo, hi)).count() == 0


def test_quarters_in_range(spark):
    start, end = dt.date(2017, 5, 16), dt.date(2018, 5, 15)
    expected = ["2017-Q1", "2017-Q2", "2017-Q3", "2017-Q4"]
    assert fn.quarters_in_range(start, end) == expected
    early = dt.date(2018, 2, 1)
    assert fn.quarters_in_range(early, early) == ["2017-Q3"]
    assert fn.quarters_in_range(early, early, legacy=True) == []
    got = one(spark, fn.quarters_overlapping(F.lit(start), F.lit(end)))
    assert got == expected


def test_symbols_and_labels(spark):
    assert one(spark, fn.add_suffix(F.lit("2330"))) == "2330.TW"
    assert one(spark, fn.add_suffix(F.lit("2330.TW"))) == "2330.TW"
    assert one(spark, fn.symbol_root(F.lit("2330.TW"))) == "2330"
    assert one(spark, fn.strip_caret(F.lit("^TWII"))) == "TWII"
    assert one(spark, fn.strip_type_prefix(F.lit("fundamental_features:EBITDA"))) == "EBITDA"
    assert one(spark, fn.strip_type_prefix(F.lit("EBITDA"))) == "EBITDA"
    assert one(spark, fn.sanitize_label(F.lit("a/b\\c,d"))) == "a_b_c_d"
    assert one(spark, fn.parse_list(F.lit(" 1, 5 ,,10 "))) == ["1", "5", "10"]
    assert one(spark, fn.compact_date(F.lit("2020-01-02").cast("date"))) == "20200102"
    assert one(spark, fn.iso_date(F.lit("2020-01-02").cast("date"))) == "2020-01-02"


def test_numbers(spark):
    assert one(spark, fn.to_double(F.lit("abc"))) is None
    assert one(spark, fn.to_double(F.lit("1.5"))) == 1.5
    assert one(spark, fn.missing_as_null(F.lit(float("nan")))) is None
    assert one(spark, fn.missing_as_null(F.lit(float("inf")))) == float("inf")
    assert one(spark, fn.missing_as_null(F.lit(float("-inf")), True)) is None
    assert one(spark, fn.whole_shares(450000.0, F.lit(70.0))) == 6428
    assert one(spark, fn.whole_shares(-10.0, F.lit(3.0))) == -3
    assert one(spark, fn.whole_shares(10.0, F.lit(0.0))) is None
    assert str(one(spark, fn.round_to(F.lit(-1e-12), 6))) == "0.0"
