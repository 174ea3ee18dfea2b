"""Top-N universe by market value, for one or many value dates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.functions.defaults import LISTED_MARKET
from paneloom.functions.scalars import iso_date, no_nan
from paneloom.lookup import lookup_table
from paneloom.operators.skew import first_k
from paneloom.schemas import DIM_UNIVERSE_COLUMNS


def not_in(column: str, excluded: Sequence[str]) -> Column:
    """Exclusion that keeps rows whose value is missing."""
    if not excluded:
        return F.lit(True)
    return F.coalesce(~F.col(column).isin(*excluded), F.lit(True))


def listed_before(cutoff: str | None) -> Column:
    """With a cut-off: main-market companies listed before it. Without: everything."""
    if cutoff is None:
        return F.lit(True)
    return (F.col("market") == LISTED_MARKET) & (F.col("list_date") < F.lit(cutoff).cast("date"))


def _day(date: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(date) if isinstance(date, str) else date


def build_universe(
    companies: DataFrame,
    market_value: DataFrame,
    top_n: int | None,
    market_value_dates: Sequence[str | None] = (None,),
    excluded_industries: Sequence[str] = (),
    listed_until: str | None = None,
) -> DataFrame:
    """The ``top_n`` largest companies on each value date, in the dim_universe layout.

    Market values are taken on the latest date not after the value date (None: the latest of all).
    With several dates the rows of each carry their own ``market_value_date`` and an extra
    ``target_date`` column tells which request they answer. The market values are read once for all
    dates, and at most ``top_n`` rows per date leave a task. A date before all values is an error.
    """
    if not top_n:
        raise ValueError("top_n: say how many companies each value date keeps")
    spark = companies.sparkSession
    eligible = companies.where(
        not_in("industry", excluded_industries) & listed_before(listed_until)
    ).withColumn("_eligible", F.lit(True))
    if "delist_date" not in companies.columns:
        eligible = eligible.withColumn("delist_date", F.lit(None).cast("date"))
    # A row serves the first target that is not before it; a target without rows of its own is
    # served by an earlier one's. Both are one lookup in the sorted targets.
    targets = sorted({_day(t) for t in market_value_dates if t is not None})
    latest = None in market_value_dates
    slot = reduce(
        lambda later, i: F.when(F.col("date") <= F.lit(targets[i]), i).otherwise(later),
        reversed(range(len(targets))),
        F.lit(len(targets) if latest else None).cast("int"),
    )
    joined = (
        market_value.withColumns({"market_value": no_nan("market_value"), "_slot": slot})
        .where(F.col("_slot").isNotNull() & F.col("date").isNotNull())
        .withColumnRenamed("date", "market_value_date")
        .join(eligible, "stock_id", "left")
    )
    # the latest date leads; a row that isn't eligible still tells which date that is
    top = first_k(
        joined,
        ["_slot"],
        [
            F.col("market_value_date").desc(),
            F.col("_eligible").desc_nulls_last(),
            F.col("market_value").desc_nulls_last(),
            F.col("stock_id").asc(),
        ],
        top_n,
        "rank",
    )
    # from here on top_n rows a target
    ahead = Window.orderBy("_slot").rangeBetween(1, Window.unboundedFollowing)
    until = F.coalesce(F.min("_slot").over(ahead), F.lit(len(targets) + latest))
    served = top.withColumns(
        {
            "_until": until,
            "_as_of": F.max("market_value_date").over(Window.partitionBy("_slot")),
        }
    ).withColumn("_for", F.explode(F.sequence(F.col("_slot"), F.col("_until") - 1)))
    asked = [(d, i, str(d)) for i, d in enumerate(targets)]
    asked += [(None, len(targets), "any date")] if latest else []
    wanted = lookup_table(spark, asked, "_asked date, _for int, _called string")
    missing = F.raise_error(F.concat(F.lit("no data on or before "), F.col("_called")))
    chosen = F.col("_eligible") & (F.col("market_value_date") == F.col("_as_of"))
    answered = (
        wanted.join(served, "_for", "left")
        .where(F.when(F.col("_as_of").isNull(), missing.cast("boolean")).otherwise(chosen))
        .withColumn("target", F.coalesce("_asked", "_as_of"))
    )
    out = answered.withColumn("top_n", F.lit(top_n)).withColumns(
        {c: iso_date(c) for c in ("list_date", "market_value_date", "delist_date")}
    )
    keys = [F.col("target").alias("target_date")] if len(market_value_dates) > 1 else []
    return out.select(*keys, *DIM_UNIVERSE_COLUMNS)
