"""NULL keys, NaN and repeated bars."""

import datetime as dt

import pytest

from paneloom.lookup import lookup_table
from paneloom.operators import calendar as cal
from paneloom.operators import evaluate as ev
from paneloom.operators import portfolio as pf
from paneloom.operators import skew
from paneloom.operators import universe as un
from paneloom.sources import writers as wr
from pyspark.sql import functions as F

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
NAN = float("nan")


def test_null_keys_form_a_group(spark):
    rows = [(None, 1.0), (None, 2.0), (D1, 3.0), (D1, 4.0), (None, None), (D1, NAN)]
    df = lookup_table(spark, rows, "date date, value double")
    placed = skew.cross_section(df, ["date"], "value").where("_n IS NOT NULL").collect()
    assert {(r["date"], r["value"]): (r["_before"], r["_ties"], r["_n"]) for r in placed} == {
        (None, 1.0): (0, 1, 2), (None, 2.0): (1, 1, 2), (D1, 3.0): (0, 1, 2), (D1, 4.0): (1, 1, 2),
    }
    means = skew.with_group_aggregates(df.where("value < 10"), ["date"], {"m": F.avg("value")})
    assert {(r["date"], r["m"]) for r in means.collect()} == {(None, 1.5), (D1, 3.5)}


def test_nan_market_value_is_last(spark):
    companies = lookup_table(
        spark, [(s, s, D1, "x", "sii") for s in "AB"],
        "stock_id string, company_name string, list_date date, industry string, market string",
    )
    values = lookup_table(spark, [(D1, "A", NAN), (D1, "B", 5.0)], "date date, stock_id string, market_value double")
    top = un.build_universe(companies, values, 1).collect()
    assert [r["stock_id"] for r in top] == ["B"]


def test_nan_is_filled_and_carried(spark):
    factors = lookup_table(
        spark, [("f", D1, "A", 1.0), ("f", D1, "B", 0.5), ("f", D2, "A", NAN), ("f", D2, "B", 0.5)],
        "factor_name string, date date, asset string, value double",
    )
    ranks = {(r["date"], r["asset"]): r["rank"] for r in pf.fill_and_rank(factors).collect()}
    assert ranks[D2, "A"] == 2
    days = lookup_table(spark, [(D1,), (D2,)], "date date")
    carried = cal.carry_forward(factors.where("asset = 'A'"), cal.Calendar.of(days), ["value"], ["asset"])
    assert {r["date"]: r["value"] for r in carried.collect()}[D2] == 1.0


def test_nan_close_gives_no_return(spark):
    prices = lookup_table(
        spark, [(D1, "A", 1.0), (D2, "A", NAN), (D1, "B", 1.0), (D2, "B", 2.0)],
        "date date, asset string, close double",
    )
    got = {(r["date"], r["asset"]): r["fwd_1"] for r in ev.forward_returns(prices, [1]).collect()}
    assert got[D1, "A"] is None and got[D1, "B"] == 1.0


def test_bars_stay_whole(spark):
    bars = [(D1, "A", 1.0, 4.0, 1.0, 2.0, 5.0), (D1, "A", 3.0, 3.0, 1.0, 1.0, 7.0)]
    prices = lookup_table(
        spark, bars, "date date, asset string, open double, high double, low double, close double, volume double"
    )
    ranks = lookup_table(spark, [(D1, "A", 1.0)], "date date, asset string, rank double")
    (row,) = pf.merge_prices_and_ranks(prices, ranks).collect()
    assert tuple(row[c] for c in ("date", "asset", "open", "high", "low", "close", "volume")) in bars


def test_no_stocks_no_rows(spark):
    reports = lookup_table(spark, [(D1, "A", "f", 1.0)], "report_date date, asset string, factor_name string, value double")
    stocks = lookup_table(spark, [], "stock_id string")
    days = cal.Calendar.of(lookup_table(spark, [(D1,), (D2,)], "date date"))
    assert cal.factor_daily(reports, ["f"], stocks, days, D1, D2).count() == 0


def test_upsert_rejects_rows_without_key(spark, tmp_path):
    batch = lookup_table(spark, [(None, "B", 1.0)], "date date, stock_id string, value double")
    with pytest.raises(ValueError, match="without a key"):
        wr.upsert_table(batch, str(tmp_path / "t"))
