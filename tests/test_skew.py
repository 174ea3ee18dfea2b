"""Cross-sections with a group that holds most rows, values that many rows share, and gaps."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paneloom.operators import evaluate, ranking, skew


@pytest.fixture(scope="module")
def skewed(spark):
    """One date holds most rows; a third of those share one value, some are missing or extreme."""
    rng = np.random.default_rng(3)
    n = 3000
    value = rng.normal(size=n) * 10.0 ** rng.integers(-8, 8, size=n)
    value[: n // 3] = 0.1234567
    value[n // 3 : n // 2] = rng.integers(-3, 4, size=n // 2 - n // 3)
    value[-40:] = np.nan
    value[-50:-45], value[-45:-40] = np.inf, -np.inf
    date = np.where(rng.random(n) < 0.8, "2024-01-02", "2024-01-03")
    pdf = pd.DataFrame({"date": pd.to_datetime(date).date, "asset": [f"A{i}" for i in range(n)], "value": value})
    df = spark.createDataFrame(pdf, "date date, asset string, value double").withColumn(
        "value", F.when(~F.isnan("value"), F.col("value"))
    )
    return df.cache(), pdf


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


@pytest.mark.parametrize("positive", [True, False])
def test_ranks_agree_with_pandas(skewed, positive):
    df, pdf = skewed
    expected = dict(
        zip(pdf.asset, pdf.groupby("date")["value"].rank(ascending=positive).fillna(0))
    )
    ranked = ranking.rank_cross_section(df, positive)
    assert as_dict(ranked, "asset", "rank") == expected
    if positive:
        several = skew.rank_columns(df.withColumn("minus", -F.col("value")), ["date"], {"r": "value", "m": "minus"})
        assert as_dict(several, "asset", "r") == expected
        down = pdf.groupby("date")["value"].rank(ascending=False).fillna(0)
        assert as_dict(several, "asset", "m") == dict(zip(pdf.asset, down))


def exchanges(df) -> list[str]:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]


def test_rows_are_dealt_once_for_a_rank(spark):
    """Before: rows, values, ranges and positions were each dealt anew, five exchanges for a rank."""
    df = spark.range(3000).selectExpr("id % 3 AS date", "id AS asset", "double(hash(id)) AS value", "sin(id) AS other")
    assert len(exchanges(ranking.rank_cross_section(df))) <= 4
    assert len(exchanges(skew.rank_columns(df, ["date"], {"r": "value", "o": "other"}))) <= 6


@pytest.mark.parametrize("descending", [True, False])
def test_long_ranges_and_short_ones_agree(skewed, monkeypatch, descending):
    df, _ = skewed
    df = df.withColumn("date", F.when(F.col("date") < "2024-01-03", F.col("date"))).withColumn(
        "value", F.when(F.col("asset") == "A5", F.lit(-0.0)).when(F.col("asset") == "A6", F.lit(0.0)).otherwise(F.col("value"))
    )

    def flag(before, ties, n):
        return (ties > 500) & (before < n)

    def found():
        out = skew.cross_section(df, ["date"], "value", descending, flag)
        ranks = skew.rank_columns(df, ["date"], {"r": "value"})
        return sorted(map(str, out.collect())), sorted(map(str, ranks.select("date", "asset", "r").collect()))

    short = found()
    monkeypatch.setattr(skew, "RANGE_ROWS", 5)
    monkeypatch.setattr(skew, "SMALL_TABLE", 0)
    assert found() == short


def test_short_groups_are_dealt_once_for_all_columns(spark, skewed, monkeypatch):
    """Before: an exchange for the rows of each column, and more for its totals."""
    df, _ = skewed
    df = df.withColumn("minus", -F.col("value"))

    def flag(before, ties, n):
        return (ties > 500) & (before < n)

    def found():
        ranks = skew.rank_columns(df, ["date"], {"r": "value", "m": "minus"})
        placed = [skew.cross_section(df, ["date"], "value", down, flag) for down in (False, True)]
        return [sorted(map(str, x.select(sorted(x.columns)).collect())) for x in (ranks, *placed)]

    ranks = skew.rank_columns(df, ["date"], {"r": "value", "m": "minus"})
    assert len(exchanges(ranks.groupBy("date").agg(F.corr("r", "m")))) == 1
    assert len(exchanges(skew.cross_section(df, ["date"], "value", False, flag))) == 1
    whole = found()
    monkeypatch.setattr(skew, "RANGE_ROWS", 1500)  # one date is longer, no range is
    assert found() == whole


def test_flat_group_has_no_bucket(spark):
    rows = [("d1", f"A{i}", 1.0 if i < 7 else float(i)) for i in range(10)]
    rows += [("d2", f"A{i}", float(i)) for i in range(10)] + [("d3", "A1", 5.0)]
    df = spark.createDataFrame(rows, "date string, asset string, value double")
    got = evaluate.quantile_buckets(df, 5, keys=["date"]).collect()
    buckets = {(r.date, r.asset): r.bucket for r in got}
    assert {buckets["d1", f"A{i}"] for i in range(10)} == {None}
    assert [buckets["d2", f"A{i}"] for i in range(10)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert buckets["d3", "A1"] is None


def test_buckets_agree_with_interpolated_edges(spark):
    rng = np.random.default_rng(5)
    rows, expected = [], {}
    for n in (2, 3, 5, 6, 11, 16, 21, 36, 100, 101):
        values = np.round(rng.normal(size=n), 3)
        edges = np.quantile(values, [0, 0.2, 0.4, 0.6, 0.8, 1])
        for i, x in enumerate(values):
            rows.append((f"n{n}", f"A{i}", float(x)))
            exact = 1 + int((edges[1:5] < x - 1e-12).sum())
            expected[f"n{n}", f"A{i}"] = exact if (np.diff(edges) > 0).all() else None
    df = spark.createDataFrame(rows, "date string, asset string, value double")
    got = evaluate.quantile_buckets(df, 5, keys=["date"]).collect()
    assert {(r.date, r.asset): r.bucket for r in got} == expected


def test_value_range_is_monotone(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=4000) * 10.0 ** rng.integers(-300, 300, size=4000)
    powers = 2.0 ** np.arange(-1070, 1020, 7)
    near = np.concatenate([powers, np.nextafter(powers, np.inf), np.nextafter(powers, 0.0)])
    x = np.sort(np.concatenate([x, near, -near, [0.0, np.inf, -np.inf, 5e-324, 1.7e308]]))
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = {r.v: r.b for r in df.select("v", skew.value_range(F.col("v")).alias("b")).collect()}
    ids = [got[float(v)] for v in x]
    assert all(a <= b for a, b in zip(ids, ids[1:]))
    assert len(set(ids)) > 2000


def test_whole_numbers_get_their_own_range(spark):
    df = spark.range(-2000, 2000).select((F.col("id") / 2).alias("v"))
    ids = df.select(skew.value_range(F.col("v")).alias("b")).distinct().count()
    assert ids == 4000


def test_group_aggregates_agree(skewed):
    df, pdf = skewed
    stats = {"top": F.max("value"), "rows": F.count(F.lit(1))}
    got = {r.asset: (r.top, r.rows) for r in skew.with_group_aggregates(df, ["date"], stats).collect()}
    by_date = pdf.groupby("date")
    tops, sizes = by_date["value"].transform("max"), by_date["asset"].transform("size")
    assert got == dict(zip(pdf.asset, zip(tops, sizes)))


def test_first_k_limits_before_the_shuffle(spark):
    df = spark.range(10000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    setting = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(setting)
    for k in (5, 1500):
        top = skew.first_k(df, ["g"], [F.col("v").desc()], k, "place")
        got = sorted((r.g, r.place, r.v) for r in top.collect())
        assert got == [(g, i + 1, 9999.0 - (9999 - g) % 3 - 3 * i) for g in range(3) for i in range(k)]
        assert top.columns == ["g", "v", "place"]
        if k == 5:
            assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(setting) == before
