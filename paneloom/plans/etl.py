"""Star-schema build: universe, prices, calendar, benchmark, factors."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.functions.defaults import EXCLUDED_INDUSTRIES, LISTED_BEFORE, TOP_N
from paneloom.operators.calendar import Calendar, factor_daily, trading_calendar
from paneloom.operators.panel import benchmark_returns, clean_ohlcv, first_per_key, ingest_fill
from paneloom.operators.universe import build_universe
from paneloom.sources.writers import tag_run, truncate_table, upsert_table


def build_star_schema(
    raw_prices: DataFrame,
    companies: DataFrame,
    market_value: DataFrame,
    out: str,
    start: str,
    end: str,
    market_value_dates: Sequence[str],
    top_n: int = TOP_N,
    excluded_industries: Sequence[str] = EXCLUDED_INDUSTRIES,
    listed_until: str | None = LISTED_BEFORE,
    benchmark: DataFrame | None = None,
    reports: DataFrame | None = None,
    factor_names: Sequence[str] = (),
    factor_set: str = "default",
) -> dict[str, str]:
    """Write all tables below ``out`` and return their paths.

    ``raw_prices`` is (datetime, asset, OHLCV), ``reports`` (report_date, asset, factor_name,
    value). Several value dates are handled together: each table carries the run's ``mv_date`` as a
    partition column, only the price fact is shared and upserted by (date, stock_id).
    """
    if not market_value_dates or not start or not end:
        raise ValueError("market_value_dates, start and end are required")
    paths = {
        name: f"{out}/{name}"
        for name in ("fact_price", "dim_universe", "dim_calendar", "fact_benchmark_daily", "fact_factor")
    }
    lo, hi = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    universe = build_universe(
        companies, market_value, top_n, market_value_dates, excluded_industries, listed_until
    )
    if len(market_value_dates) == 1:
        universe = universe.withColumn("target_date", F.lit(market_value_dates[0]).cast("date"))
    partitions = ["mv_date"]
    tagged = tag_run(universe, start, end, "", top_n).withColumn(
        "mv_date", F.col("target_date").cast("string")
    )
    truncate_table(tagged.drop("target_date"), paths["dim_universe"], partitions)
    members = universe.sparkSession.read.parquet(paths["dim_universe"]).select(
        F.col("mv_date").cast("string").alias("mv_date"), "stock_id"
    )

    chosen = (
        raw_prices.where(F.col("datetime").between(lo, hi))
        .join(
            members.select(F.col("stock_id").alias("asset")).distinct(), "asset", "left_semi"
        )
    )
    unique = first_per_key(chosen, ["datetime", "asset"])
    prices = clean_ohlcv(ingest_fill(unique), unique=True)
    upsert_table(prices, paths["fact_price"])
    stored = raw_prices.sparkSession.read.parquet(paths["fact_price"]).where(
        F.col("date").between(lo, hi)
    )
    if stored.isEmpty():
        raise ValueError("no price rows for the universe and interval")

    truncate_table(trading_calendar(stored), paths["dim_calendar"])
    if benchmark is not None:
        truncate_table(
            benchmark_returns(benchmark.where(F.col("date").between(lo, hi))),
            paths["fact_benchmark_daily"],
        )
    if reports is not None and factor_names:
        daily = factor_daily(
            reports, factor_names, members.select("stock_id").distinct(), Calendar.of(stored), lo, hi
        )
        write = daily.withColumn("factor_set", F.lit(factor_set))
        truncate_table(write, paths["fact_factor"], ["factor_set", "factor_name"])
    return paths
