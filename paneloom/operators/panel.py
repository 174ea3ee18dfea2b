"""Operators on price and factor panels: cleaning, keys, reshaping, merging."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.functions.scalars import clean_double, missing_as_null, parse_date
from paneloom.lookup import lookup_table
from paneloom.schemas import FACT_PRICE, PRICE_COLUMNS


def to_fact_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"datetime": "date", "asset": "stock_id"})


def to_panel_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"date": "datetime", "stock_id": "asset"})


def to_factor_triple(df: DataFrame, factor_name: str) -> DataFrame:
    """``datetime, asset, value`` from any of the accepted layouts.

    Accepted: the triple itself, (datetime, asset, <factor_name>), or (date, stock_id, <value>)
    where the first column that is no key holds the value.
    """
    names = df.columns
    if "datetime" in names and "asset" in names:
        value = factor_name if "value" not in names and factor_name in names else "value"
        return df.select("datetime", "asset", F.col(value).alias("value"))
    df = to_panel_names(df)
    values = [c for c in df.columns if c not in ("datetime", "asset", "factor_name")]
    if not values:
        raise ValueError("factor table has no value column")
    return df.select("datetime", "asset", F.col(values[0]).alias("value"))


def factor_series(df: DataFrame) -> DataFrame:
    """Day-cut date, text asset, no missing value."""
    return (
        df.select(
            parse_date("datetime").alias("date"),
            F.col("asset").cast("string").alias("asset"),
            missing_as_null(F.col("value").cast("double")).alias("value"),
        )
        .na.drop(subset=["date", "asset", "value"])
    )


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the least by ``order`` (default: all other columns, left to right).

    A mergeable aggregate rather than a window, so a key repeated without bound is reduced before
    the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order else rest
    payload = F.struct(*order, *[F.col(c).alias(f"_p_{c}") for c in rest])
    picked = df.groupBy(*keys).agg(F.min(payload).alias("_row"))
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"_row._p_{c}").alias(c) for c in df.columns]
    )


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def panel_summary(df: DataFrame, asset: str = "stock_id", approximate: bool = False) -> DataFrame:
    tickers = F.approx_count_distinct(asset) if approximate else F.count_distinct(asset)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), tickers.alias("n_assets"))


def _series(keys: Sequence[str] | str, date: str):
    keys = [keys] if isinstance(keys, str) else list(keys)
    return Window.partitionBy(*keys).orderBy(date)


def forward_fill(
    df: DataFrame, columns: Sequence[str], series: Sequence[str] | str = "asset", date: str = "date"
) -> DataFrame:
    """Carry the last known value of each column along the series (unique on series, date)."""
    so_far = _series(series, date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})


def fill_both_ways(
    df: DataFrame,
    columns: Sequence[str],
    series: Sequence[str] | str = "asset",
    date: str = "date",
    allow_lookahead: bool = False,
) -> DataFrame:
    """Forward fill; with ``allow_lookahead`` leading gaps then take the next known value."""
    if not allow_lookahead:
        return forward_fill(df, columns, series, date)
    order = _series(series, date)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(
                F.last(c, ignorenulls=True).over(so_far), F.first(c, ignorenulls=True).over(ahead)
            )
            for c in columns
        }
    )


def period_return(close: str, previous: Column) -> Column:
    return F.try_divide(F.col(close), previous) - F.lit(1.0)


def tradability_flags(previous: Column) -> dict[str, Column]:
    """Heuristic flags of a bar that traded at a single price with no volume."""
    still = (
        (F.col("volume") == 0)
        & (F.col("open") == F.col("close"))
        & (F.col("high") == F.col("low"))
    )
    close = F.col("close")

    def flag(moved: Column) -> Column:
        return F.when(still & moved, 1).otherwise(0)

    return {
        "is_suspended": flag(close == previous),
        "is_limit_up": flag(close > previous),
        "is_limit_down": flag(close < previous),
    }


def clean_ohlcv(raw: DataFrame, unique: bool = False) -> DataFrame:
    """Raw (datetime, asset, OHLCV) to the 11-column price fact.

    Coerces numbers, carries prices over gaps, sets missing volume to 0, drops rows before the
    first close, adds the daily return and the tradability flags. All series work shares one
    exchange and one sort on (stock_id, date). ``unique`` says that the input has no second row
    for a (date, asset); otherwise one is kept, which also bounds a series by the calendar.
    """
    df = to_fact_names(raw).select(
        parse_date("date").alias("date"),
        F.col("stock_id").cast("string").alias("stock_id"),
        *[clean_double(c).alias(c) for c in (*PRICE_COLUMNS, "volume")],
    )
    if not unique:
        df = first_per_key(df, ["date", "stock_id"])
    filled = (
        forward_fill(df, PRICE_COLUMNS, "stock_id")
        .withColumn("volume", F.coalesce("volume", F.lit(0.0)))
        .where(F.col("close").isNotNull())
    )
    previous = F.lag("close").over(_series("stock_id", "date"))
    out = filled.withColumn("_prev", previous)
    out = out.withColumns(
        {
            "daily_return": period_return("close", F.col("_prev")).cast("float"),
            **tradability_flags(F.col("_prev")),
        }
    )
    return out.select(*FACT_PRICE.fieldNames())


def ingest_fill(df: DataFrame, fill_volume: bool = True) -> DataFrame:
    """Row-wise carry at ingestion, volume included unless ``fill_volume`` is off."""
    columns = [*PRICE_COLUMNS, *(["volume"] if fill_volume else [])]
    return forward_fill(df, columns, "asset", "datetime")


def benchmark_returns(index_close: DataFrame) -> DataFrame:
    """(date, index_id, close) to close and daily return per index; missing closes are bridged."""
    from paneloom.functions.scalars import strip_caret

    df = index_close.select(
        parse_date("date").alias("date"),
        strip_caret("index_id").alias("index_id"),
        clean_double("close").alias("close"),
    )
    known = F.last("close", ignorenulls=True).over(
        _series("index_id", "date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    df = df.withColumn("_known", known)
    before = F.lag("_known").over(_series("index_id", "date"))
    return df.withColumn("daily_return", F.try_divide(F.col("_known"), before) - F.lit(1.0)).select(
        "date", "index_id", "close", "daily_return"
    )


def merge_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` replace rows of ``target`` with the same key; others are kept or added."""
    keep = target.join(batch.select(*keys), list(keys), "left_anti")
    return keep.select(*batch.columns).unionByName(batch)


def keep_listed(
    df: DataFrame, listed: DataFrame, key: str, keep_all_if_empty: bool = True
) -> DataFrame:
    """Rows whose ``key`` is listed; if none is, every row (as callers of the original expect)."""
    kept = df.join(listed.select(key).distinct(), key, "left_semi")
    if keep_all_if_empty and kept.isEmpty():
        return df
    return kept


def wide_to_long(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    name: str = "factor_name",
    value: str = "value",
) -> DataFrame:
    """Columns to rows, as doubles."""
    columns = list(columns) if columns else [c for c in df.columns if c not in keys]
    typed = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return typed.unpivot(list(keys), [f"`{c}`" for c in columns], name, value)


def factor_matrix(
    df: DataFrame,
    names: Sequence[str],
    keys: Sequence[str] = ("date", "asset"),
    complete: bool = True,
) -> DataFrame:
    """One column per factor; repeated cells are averaged, ±inf counts as missing.

    ``complete`` keeps only rows in which every factor is known.
    """
    wide = (
        df.where(F.col("factor_name").isin(*names))
        .groupBy(*keys)
        .pivot("factor_name", list(names))
        .agg(F.avg("value"))
    )
    wide = wide.select(*keys, *[missing_as_null(F.col(f"`{n}`"), True).alias(n) for n in names])
    return wide.na.drop("any", subset=[f"`{n}`" for n in names]) if complete else wide


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, failing at run time when a key occurs twice (one aggregation, no join)."""
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), F.min(F.struct(*rest)).alias("_row")
    )
    checked = grouped.where(
        F.when(F.col("_copies") > 1, F.raise_error(F.lit("duplicate key")).cast("boolean")).otherwise(
            F.lit(True)
        )
    )
    return checked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def price_matrix(prices: DataFrame, assets: Sequence[str]) -> DataFrame:
    """Wide close matrix for export; analysis stays long. A repeated cell is an error."""
    cells = require_unique(prices.select("date", "asset", "close"), ["date", "asset"])
    return cells.groupBy("date").pivot("asset", list(assets)).agg(F.first("close"))


def factor_counts(df: DataFrame, requested: Sequence[str]) -> DataFrame:
    """Non-missing rows of every requested factor, 0 for one that is absent, in request order."""
    found = (
        df.where(F.col("factor_name").isin(*requested))
        .groupBy("factor_name")
        .agg(F.count(missing_as_null(F.col("value").cast("double"))).alias("n_values"))
    )
    wanted = lookup_table(
        df.sparkSession, list(enumerate(requested)), "position int, factor_name string"
    )
    return wanted.join(found, "factor_name", "left").select(
        "position", "factor_name", F.coalesce("n_values", F.lit(0)).alias("n_values")
    )


def available_factors(df: DataFrame, requested: Sequence[str]) -> list[str]:
    """Requested names that have data, in request order; fails when none has."""
    rows = factor_counts(df, requested).where(F.col("n_values") > 0).orderBy("position").collect()
    if not rows:
        raise ValueError("none of the requested factors has data")
    return [r["factor_name"] for r in rows]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
