"""Long/short portfolios from ranks: signals, orders, holdings, ledger, equity, performance.

A strategy holding "today's top and bottom sets" needs no event loop: yesterday's set is a lag, a
holding is a run of consecutive bars, and cash and equity are running sums over one row per date.
Panel-sized work stays keyed by asset or date; only date-level tables are ordered as a whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.functions.defaults import (
    BUY_N,
    COMMISSION,
    INITIAL_CASH,
    INVESTED_SHARE,
    NO_SIGNAL_RANK,
    SELL_N,
)
from paneloom.functions.quarters import disclosure_quarter, quarters_in_range
from paneloom.functions.scalars import no_nan, whole_shares
from paneloom.lookup import lookup_table
from paneloom.operators.calendar import Calendar, carry_forward
from paneloom.operators.panel import forward_fill
from paneloom.operators.ranking import _sum_left_to_right, rank_cross_section
from paneloom.operators.skew import first_k
from paneloom.session import materialise

OHLCV = ("open", "high", "low", "close", "volume")


# ------------------------------------------------------------------ scheduled ranks


def quarter_schedule(
    start: dt.date,
    end: dt.date,
    factors: Sequence[str],
    weights: Sequence[float] | None = None,
    quarterly: Mapping[str, Sequence[Mapping]] | None = None,
    legacy_quarters: bool = False,
) -> list[tuple[str, int, str, float]]:
    """(quarter, position, factor, weight) for every disclosure quarter of the range.

    ``quarterly`` overrides factors and weights by quarter; others use the defaults.
    """
    if not factors:
        raise ValueError("at least one factor is required")
    weights = list(weights) if weights is not None else [1.0 / len(factors)] * len(factors)
    if len(weights) != len(factors):
        raise ValueError(f"{len(factors)} factors but {len(weights)} weights")
    rows = []
    for quarter in quarters_in_range(start, end, legacy_quarters):
        if quarterly and quarter in quarterly:
            plan = [(f["name"], float(f["weight"])) for f in quarterly[quarter]]
        else:
            plan = list(zip(factors, weights))
        rows += [(quarter, i, name, float(w)) for i, (name, w) in enumerate(plan)]
    return rows


def factors_used(schedule: Sequence[tuple[str, int, str, float]]) -> list[str]:
    """Distinct factor names of a schedule, in order of first use."""
    return list(dict.fromkeys(name for _, _, name, _ in schedule))


def fill_and_rank(factors: DataFrame, positive_corr: bool = True) -> DataFrame:
    """Carry each asset's factor forward, drop what is still missing, rank per factor and date."""
    factors = factors.withColumn("value", no_nan("value"))
    filled = forward_fill(factors, ["value"], ["factor_name", "asset"]).where(
        F.col("value").isNotNull()
    )
    return rank_cross_section(filled, positive_corr, keys=("factor_name", "date")).select(
        "date", "asset", "factor_name", "rank"
    )


def scheduled_rank(
    ranks: DataFrame,
    schedule: Sequence[tuple[str, int, str, float]],
    positive_corr: bool = True,
    final_ascending: bool = False,
) -> DataFrame:
    """Weighted rank per date under the factors and weights of the date's disclosure quarter.

    A factor without any data in a quarter is left out there, weights are not rescaled; an asset
    needs all the others. The quarter is a function of the date, so the schedule is an equi join.
    ``positive_corr`` applies to the combined rank too, as callers expect, which undoes a negative
    direction; ``final_ascending`` ranks the combination low-to-high instead.
    """
    table = lookup_table(
        ranks.sparkSession,
        list(schedule),
        "quarter string, _pos int, factor_name string, _weight double",
    )
    width = max(pos for _, pos, _, _ in schedule) + 1
    planned = ranks.withColumn("quarter", disclosure_quarter("date")).join(
        F.broadcast(table), ["quarter", "factor_name"]
    )
    # read twice below, so filling and ranking run once
    wide = materialise(
        planned.groupBy("quarter", "date", "asset").agg(
            *[
                F.max(F.when(F.col("_pos") == i, F.col("rank") * F.col("_weight"))).alias(f"_t{i}")
                for i in range(width)
            ]
        )
    )
    terms = [F.col(f"_t{i}") for i in range(width)]
    present = _sum_left_to_right([t.isNotNull().cast("int") for t in terms])
    anywhere = [F.max(t.isNotNull().cast("int")) for t in terms]
    total = _sum_left_to_right([F.coalesce(t, F.lit(0.0)) for t in terms])
    # one row per quarter of the schedule: how many of its factors have any data
    expected = wide.groupBy("quarter").agg(_sum_left_to_right(anywhere).alias("_expected"))
    summed = (
        wide.join(F.broadcast(expected), "quarter")
        .where(present == F.col("_expected"))
        .select("date", "asset", total.alias("_weighted"))
    )
    return rank_cross_section(
        summed, positive_corr or final_ascending, "_weighted", "rank"
    ).drop("_weighted")


# ------------------------------------------------------------------ price/rank panel


def merge_prices_and_ranks(prices: DataFrame, ranks: DataFrame) -> DataFrame:
    """Full outer merge of prices and ranks on (date, asset), all columns carried forward per asset.

    Both tables are stacked and grouped after one exchange on asset, which the fill reuses. Rows
    still without open or close are dropped; a missing rank stays NULL (no signal). Both inputs
    are unique on (date, asset), so a series has at most two rows per day.
    """
    stacked = prices.select("date", "asset", F.struct(*OHLCV).alias("bar")).unionByName(
        ranks.select("date", "asset", "rank"), allowMissingColumns=True
    )
    columns = [*OHLCV, "rank"]
    # a whole bar, never columns of several
    merged = (
        stacked.repartition("asset")
        .groupBy("asset", "date")
        .agg(F.max("bar").alias("bar"), F.max("rank").alias("rank"))
        .select("asset", "date", "bar.*", "rank")
    )
    filled = forward_fill(merged, columns)
    return filled.na.drop(subset=["open", "close"]).select("date", "asset", *columns)


def align_panel(
    merged: DataFrame,
    calendar: Calendar | None = None,
    base: str = "all",
    allow_lookahead: bool = False,
) -> DataFrame:
    """Every asset on every bar of one calendar, gaps carried forward.

    ``base='all'`` uses every date of the panel (``calendar`` when the caller knows them);
    ``'first_asset'`` those of the first asset, rows on other dates being dropped before the fill.
    ``allow_lookahead`` also fills backwards before an asset's first bar.
    """
    if base == "first_asset":
        first = merged.agg(F.min("asset").alias("a")).scalar()
        calendar = Calendar.of(merged.where(F.col("asset") == first))
        dates = calendar.table(merged.sparkSession).select("date")
        merged = merged.join(F.broadcast(dates), "date", "left_semi")
    elif base != "all":
        raise ValueError(f"unknown base calendar {base!r}")
    return carry_forward(
        merged,
        calendar or Calendar.of(merged),
        [*OHLCV, "rank"],
        leading="backfill" if allow_lookahead else "drop",
    )


def with_no_signal(panel: DataFrame) -> DataFrame:
    """Export form: a missing rank becomes the sentinel downstream tools treat as no signal."""
    return panel.withColumn("rank", F.coalesce("rank", F.lit(NO_SIGNAL_RANK)))


# ------------------------------------------------------------------ signals to ledger


def long_short_signals(
    panel: DataFrame, buy_n: int = BUY_N, sell_n: int = SELL_N
) -> DataFrame:
    """The ``buy_n`` highest and ``sell_n`` lowest ranks of each bar; 0 switches a side off.

    Each row also carries the prices of the two following bars, read in one pass over the aligned
    panel, so nothing later has to go back to it.
    """
    bar = Window.partitionBy("asset").orderBy("t")
    ahead = panel.withColumns(
        {
            "next_date": F.lead("date", 1).over(bar),
            "next_open": F.lead("open", 1).over(bar),
            "next_close": F.lead("close", 1).over(bar),
            "after_date": F.lead("date", 2).over(bar),
            "after_open": F.lead("open", 2).over(bar),
        }
    ).where(F.col("rank").isNotNull())
    sides = [side for side, n in (("long", buy_n), ("short", sell_n)) if n]
    if not sides:
        return ahead.where(F.lit(False)).withColumns({"side": F.lit(""), "position": F.lit(0)})
    # one pass for both sides: each side's order is spelled out and the other's parts are NULL
    tagged = ahead.withColumn("side", F.explode(F.array(*[F.lit(s) for s in sides])))
    short = F.col("side") == "short"
    order = [
        F.when(short, F.col("rank")).otherwise(-F.col("rank")).asc(),
        F.when(short, F.col("asset")).asc(),
        F.when(~short, F.col("asset")).desc(),
    ]
    picked = first_k(tagged, ["date", "side"], order, max(buy_n, sell_n), "position")
    return picked.where(F.col("position") <= F.when(short, sell_n).otherwise(buy_n))


def cash_per_name(initial_cash: float, buy_n: int, sell_n: int) -> float:
    return initial_cash * INVESTED_SHARE / (buy_n + sell_n) if buy_n + sell_n else 0.0


def holdings(
    signals: DataFrame,
    initial_cash: float = INITIAL_CASH,
    buy_n: int = BUY_N,
    sell_n: int = SELL_N,
) -> DataFrame:
    """One row per held bar, with entry and exit marks and the size fixed at entry.

    ``entered``: not held on the bar before. ``leaving``: not held on the next bar, which exists.
    """
    run = Window.partitionBy("asset", "side").orderBy("t")
    before, after = F.lag("t").over(run), F.lead("t").over(run)
    marked = signals.withColumns(
        {
            "entered": before.isNull() | (before < F.col("t") - 1),
            "leaving": F.col("next_date").isNotNull()
            & (after.isNull() | (after > F.col("t") + 1)),
        }
    )
    each = cash_per_name(initial_cash, buy_n, sell_n)
    size = F.when(F.col("entered"), F.coalesce(whole_shares(each, "close"), F.lit(0)))
    so_far = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn("size", F.last(size, ignorenulls=True).over(so_far))


def trade_orders(held: DataFrame) -> DataFrame:
    """Entry orders on the first bar of a run, exit orders on the first bar after it."""
    enter = F.struct(F.col("date").alias("date"), F.lit("enter").alias("action"))
    leave = F.struct(F.col("next_date").alias("date"), F.lit("exit").alias("action"))
    both = F.array(F.when(F.col("entered"), enter), F.when(F.col("leaving"), leave))
    return (
        held.select("asset", "side", "size", F.explode(both).alias("_o"))
        .where(F.col("_o").isNotNull())
        .select("_o.date", "asset", "side", "_o.action", "size")
    )


def trade_ledger(held: DataFrame, commission: float = COMMISSION) -> DataFrame:
    """Fills at the open of the bar after the order: signed quantity, price, commission."""
    sign = F.when(F.col("side") == "long", 1).otherwise(-1).cast("bigint")

    def fill(date: str, price: str, action: str, quantity: Column) -> Column:
        return F.struct(
            F.col(date).alias("date"),
            F.lit(action).alias("action"),
            quantity.alias("quantity"),
            F.col(price).alias("price"),
        )

    both = F.array(
        F.when(F.col("entered"), fill("next_date", "next_open", "enter", sign * F.col("size"))),
        F.when(F.col("leaving"), fill("after_date", "after_open", "exit", -sign * F.col("size"))),
    )
    fills = (
        held.select("asset", "side", F.explode(both).alias("_f"))
        .where(F.col("_f.price").isNotNull())
        .select("_f.date", "asset", "side", "_f.action", "_f.quantity", "_f.price")
    )
    notional = F.abs("quantity") * F.col("price")
    return fills.withColumn("commission", F.lit(float(commission)) * notional)


def equity_curve(
    calendar: Calendar,
    held: DataFrame,
    ledger: DataFrame,
    initial_cash: float = INITIAL_CASH,
) -> DataFrame:
    """Cash, position value, equity and daily return per bar (one row per date from here on).

    Amounts are kept in whole cents, so bars without a change have a return of exactly 0.
    """
    flows = ledger.groupBy("date").agg(
        F.sum(-F.col("quantity") * F.col("price") - F.col("commission")).alias("_flow")
    )
    sign = F.when(F.col("side") == "long", 1.0).otherwise(-1.0)
    worth = (
        held.where(F.col("next_date").isNotNull())
        .groupBy(F.col("next_date").alias("date"))
        .agg(F.sum(sign * F.col("size") * F.col("next_close")).alias("position_value"))
    )
    start = F.lit(float(initial_cash))
    by_date = Window.orderBy("date")
    so_far = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = (
        calendar.table(held.sparkSession)
        .select("date")
        .join(flows, "date", "left")
        .join(worth, "date", "left")
        .na.fill(0.0, ["_flow", "position_value"])
        .withColumn("cash", F.round(start + F.sum("_flow").over(so_far), 2))
        .withColumn("position_value", F.round("position_value", 2))
        .withColumn("equity", F.round(F.col("cash") + F.col("position_value"), 2))
    )
    previous = F.coalesce(F.lag("equity").over(by_date), start)
    return curve.withColumn(
        "daily_return", F.try_divide(F.col("equity"), previous) - F.lit(1.0)
    ).select("date", "cash", "position_value", "equity", "daily_return")


# ------------------------------------------------------------------ performance (date level)


def _growth(returns: DataFrame, column: str) -> DataFrame:
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grown = returns.select("date", F.col(column).alias("r")).where(F.col("r").isNotNull())
    grown = grown.withColumn("wealth", F.product(F.lit(1.0) + F.col("r")).over(so_far))
    peak = F.greatest(F.lit(1.0), F.max("wealth").over(so_far))
    below = F.try_divide(F.col("wealth"), F.col("peak")) - F.lit(1.0)
    # equal depths stay equal whatever order the product was taken in
    return grown.withColumn("peak", peak).withColumn("drawdown", F.round(below, 12))


def performance_summary(
    returns: DataFrame, column: str = "daily_return", periods_per_year: int = 252
) -> DataFrame:
    """Usual ratios of a daily return series; a ratio without a denominator is NULL."""
    day = F.row_number().over(Window.orderBy("date")).cast("double")
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    log_return = F.when(F.col("r") > -1, F.log1p("r"))
    df = _growth(returns, column).withColumn("day", day).withColumn("_log", log_return)
    df = df.withColumn("_loglevel", F.sum("_log").over(so_far))
    year, root = F.lit(float(periods_per_year)), F.sqrt(F.lit(float(periods_per_year)))
    gain, loss = F.greatest("r", F.lit(0.0)), F.greatest(-F.col("r"), F.lit(0.0))
    stats = df.agg(
        F.count("r").alias("n_days"),
        (F.product(F.lit(1.0) + F.col("r")) - F.lit(1.0)).alias("total_return"),
        F.avg("r").alias("_mean"),
        F.stddev_samp("r").alias("_std"),
        F.sqrt(F.avg(loss * loss)).alias("_downside"),
        F.min("drawdown").alias("max_drawdown"),
        F.sum(gain).alias("_gain"),
        F.sum(loss).alias("_loss"),
        F.percentile("r", 0.95).alias("_p95"),
        F.percentile("r", 0.05).alias("var_5pct"),
        F.skewness("r").alias("skew"),
        F.kurtosis("r").alias("kurtosis"),
        F.regr_r2("_loglevel", "day").alias("_r2"),
        F.count("_log").alias("_logs"),
    )
    growth = F.lit(1.0) + F.col("total_return")
    annual = F.when(growth > 0, F.pow(growth, year / F.col("n_days")) - F.lit(1.0))
    return stats.select(
        "n_days",
        "total_return",
        annual.alias("annual_return"),
        (F.col("_std") * root).alias("annual_volatility"),
        (F.try_divide(F.col("_mean"), F.col("_std")) * root).alias("sharpe"),
        (F.try_divide(F.col("_mean"), F.col("_downside")) * root).alias("sortino"),
        "max_drawdown",
        F.try_divide(annual, F.abs("max_drawdown")).alias("calmar"),
        F.try_divide(F.col("_gain"), F.col("_loss")).alias("omega"),
        F.try_divide(F.abs("_p95"), F.abs("var_5pct")).alias("tail_ratio"),
        "skew",
        "kurtosis",
        "var_5pct",
        (F.col("_mean") - F.lit(2.0) * F.col("_std")).alias("value_at_risk"),
        F.when(F.col("_logs") == F.col("n_days"), F.col("_r2")).alias("stability"),
    )


def periodic_returns(
    returns: DataFrame, unit: str = "month", column: str = "daily_return"
) -> DataFrame:
    """Compounded return per calendar month or year."""
    if unit not in ("month", "year"):
        raise ValueError("unit must be month or year")
    compounded = F.product(F.lit(1.0) + F.coalesce(F.col(column), F.lit(0.0))) - F.lit(1.0)
    return returns.groupBy(F.trunc("date", unit).alias("period_start")).agg(
        compounded.alias("period_return")
    )


def worst_drawdowns(
    returns: DataFrame, top: int = 5, column: str = "daily_return"
) -> DataFrame:
    """The ``top`` deepest drawdowns: peak, valley and recovery date, depth, bars under water."""
    by_date = Window.orderBy("date")
    so_far = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = _growth(returns, column)
    at_high = F.col("drawdown") >= 0
    df = df.withColumn("_episode", F.count(F.when(at_high, 1)).over(so_far))
    episodes = df.groupBy("_episode").agg(
        F.min("date").alias("peak_date"),
        F.min("drawdown").alias("depth"),
        F.min_by("date", F.struct("drawdown", "date")).alias("valley_date"),
        F.count(F.when(~at_high, 1)).alias("bars_under_water"),
    )
    recovery = F.lead("peak_date").over(Window.orderBy("_episode"))
    place = F.row_number().over(Window.orderBy(F.col("depth").asc(), F.col("peak_date").asc()))
    return (
        episodes.withColumn("recovery_date", recovery)
        .where(F.col("depth") < 0)
        .withColumn("place", place)
        .where(F.col("place") <= top)
        .select("place", "peak_date", "valley_date", "recovery_date", "depth", "bars_under_water")
    )
