"""Predictive power of factors: forward returns, buckets, quantile returns, IC, turnover.

Every operator takes ``factor_name`` as a grouping key, so one job evaluates any number of factors,
combinations or components. Forward returns stay side by side as ``fwd_<period>`` columns until
after aggregation: rows are never multiplied by the number of periods before a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.functions.defaults import MAX_LOSS, PERIODS, QUANTILES
from paneloom.functions.scalars import no_nan
from paneloom.operators.calendar import Calendar
from paneloom.operators.ranking import rank_cross_section
from paneloom.operators.skew import cross_section, rank_columns, with_group_aggregates

CELL = ["factor_name", "date"]


def fwd(period: int) -> str:
    return f"fwd_{period}"


def _per_period(df: DataFrame, keep: Sequence[str], periods: Sequence[int], fields: dict) -> DataFrame:
    """Turn per-period columns into rows (keep..., period, fields...)."""
    rows = [
        F.struct(F.lit(p).alias("period"), *[F.col(c(p)).alias(name) for name, c in fields.items()])
        for p in periods
    ]
    return df.select(*keep, F.inline(F.array(*rows)))


def forward_returns(
    prices: DataFrame, periods: Sequence[int] = PERIODS, calendar: Calendar | None = None
) -> DataFrame:
    """(date, asset, t, fwd_p...): close ``p`` trading days ahead over today's close, minus 1.

    Days are counted on the calendar of the whole price table, so an asset that skips a day gets
    NULL rather than a later price. A RANGE frame on the calendar position finds the exact day:
    all periods share one exchange and sort, and there is no self join.
    """
    spot = prices.select("date", "asset", no_nan("close").alias("close")).where("close is not null")
    calendar = calendar or Calendar.of(prices)
    placed = spot.join(F.broadcast(calendar.table(prices.sparkSession)), "date")
    by_day = Window.partitionBy("asset").orderBy("t")
    ahead = {
        fwd(p): F.try_divide(F.first("close").over(by_day.rangeBetween(p, p)), F.col("close"))
        - F.lit(1.0)
        for p in periods
    }
    return placed.withColumns(ahead).select("date", "asset", "t", *ahead)


def forward_returns_long(
    prices: DataFrame, periods: Sequence[int] = PERIODS, calendar: Calendar | None = None
) -> DataFrame:
    wide = forward_returns(prices, periods, calendar)
    return _per_period(wide, ["date", "asset"], periods, {"forward_return": fwd})


def quantile_buckets(
    df: DataFrame,
    quantiles: int = QUANTILES,
    value: str = "value",
    keys: Sequence[str] = CELL,
) -> DataFrame:
    """Bucket 1..quantiles of each value inside its group, by linearly interpolated edges.

    A value lies above the j-th edge exactly when more than floor((n-1) j / q) rows are smaller, so
    buckets follow from positions and no edge is ever computed or joined. A group with two equal
    edges gets NULL buckets.
    """

    def edge(n: Column, j: int) -> Column:
        return (n - 1) * F.lit(j) / F.lit(quantiles)

    def spans_two_edges(before: Column, ties: Column, n: Column) -> Column:
        return reduce(
            lambda a, b: a | b,
            [
                (before <= F.floor(edge(n, j))) & (before + ties - 1 >= F.ceil(edge(n, j + 1)))
                for j in range(quantiles)
            ],
        )

    placed = cross_section(df, keys, value, group_flag=spans_two_edges)
    above = [
        (F.col("_before") > F.floor(edge(F.col("_n"), j))).cast("int") for j in range(1, quantiles)
    ]
    bucket = reduce(lambda a, b: a + b, above, F.lit(1))
    return placed.withColumn(
        "bucket", F.when(F.col("_before").isNotNull() & ~F.col("_flag"), bucket)
    ).drop("_before", "_ties", "_n", "_flag")


def align_factor(
    factors: DataFrame,
    prices: DataFrame,
    periods: Sequence[int] = PERIODS,
    quantiles: int = QUANTILES,
    calendar: Calendar | None = None,
) -> DataFrame:
    """Factor rows with forward returns and bucket.

    ``complete`` marks rows whose forward returns all exist; buckets are formed among those only.
    """
    known = factors.select("factor_name", "date", "asset", no_nan("value").alias("value")).where(
        F.col("value").isNotNull()
    )
    joined = known.join(
        forward_returns(prices, periods, calendar), ["date", "asset"], "left"
    )
    complete = reduce(lambda a, b: a & b, [F.col(fwd(p)).isNotNull() for p in periods])
    joined = joined.withColumn("complete", complete).withColumn(
        "_usable", F.when(F.col("complete"), F.col("value"))
    )
    return quantile_buckets(joined, quantiles, "_usable", CELL).drop("_usable")


def loss_gate(aligned: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """Share of factor rows lost to missing returns or buckets, and whether that is acceptable."""
    counts = aligned.groupBy("factor_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("complete"), 1)).alias("n_with_returns"),
        F.count(F.when(F.col("complete"), F.col("bucket"))).alias("n_kept"),
    )
    loss = F.lit(1.0) - F.col("n_kept") / F.col("n_rows")
    return counts.withColumn("loss", loss).withColumn(
        "status", F.when(F.col("loss") > max_loss, F.lit("skipped")).otherwise(F.lit("ok"))
    )


def clean_factor(aligned: DataFrame, max_loss: float | None = MAX_LOSS) -> DataFrame:
    """Complete, bucketed rows of the factors that pass the loss gate; ``None`` skips the gate.

    The gate is one row per factor, aggregated and semi-joined inside the plan. It reads ``aligned``
    as well, so callers checkpoint that first.
    """
    kept = aligned.where(F.col("complete") & F.col("bucket").isNotNull()).drop("complete")
    if max_loss is None:
        return kept
    passed = loss_gate(aligned, max_loss).where(F.col("status") == "ok").select("factor_name")
    return kept.join(passed, "factor_name", "left_semi")


def quantile_stats(clean: DataFrame) -> DataFrame:
    stats = clean.groupBy("factor_name", "bucket").agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.count("value").alias("count"),
    )
    total = F.sum("count").over(Window.partitionBy("factor_name"))
    return stats.withColumn("share", F.col("count") / total)


def bucket_moments(clean: DataFrame, periods: Sequence[int] = PERIODS) -> DataFrame:
    """n, mean and summed squared deviation of each period's return per factor, date and bucket.

    All quantile-return tables are built from this pre-aggregate; ``day_mean`` is the mean over the
    buckets of the date.
    """
    moments = clean.groupBy(*CELL, "bucket").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(fwd(p)).alias(f"_m{p}") for p in periods],
        *[(F.var_pop(fwd(p)) * F.count(fwd(p))).alias(f"_s{p}") for p in periods],
    )
    rows = _per_period(
        moments,
        [*CELL, "bucket", "n"],
        periods,
        {"mean": lambda p: f"_m{p}", "m2": lambda p: f"_s{p}"},
    )
    day = Window.partitionBy(*CELL, "period")
    return rows.withColumn(
        "day_mean", F.sum(F.col("n") * F.col("mean")).over(day) / F.sum("n").over(day)
    )


def _std_error(n: Column, m2: Column) -> Column:
    return F.sqrt(F.try_divide(m2, n - 1)) / F.sqrt(n)


def quantile_returns_by_date(moments: DataFrame, demeaned: bool = False) -> DataFrame:
    mean = F.col("mean") - F.col("day_mean") if demeaned else F.col("mean")
    return moments.select(
        *CELL, "period", "bucket", "n", mean.alias("mean_return"),
        _std_error(F.col("n"), F.col("m2")).alias("std_error"),
    )


def quantile_returns(moments: DataFrame, demeaned: bool = False) -> DataFrame:
    """Mean forward return and standard error per factor, period and bucket over all dates."""
    centre = F.col("mean") - F.col("day_mean") if demeaned else F.col("mean")
    pooled = (
        moments.withColumn("_c", centre)
        .groupBy("factor_name", "period", "bucket")
        .agg(
            F.sum("n").alias("n"),
            (F.sum(F.col("n") * F.col("_c")) / F.sum("n")).alias("mean_return"),
            F.sum(F.col("m2") + F.col("n") * F.col("_c") * F.col("_c")).alias("_raw2"),
        )
    )
    m2 = F.col("_raw2") - F.col("n") * F.col("mean_return") * F.col("mean_return")
    return pooled.select(
        "factor_name", "period", "bucket", "n", "mean_return",
        _std_error(F.col("n"), F.greatest(m2, F.lit(0.0))).alias("std_error"),
    )


def quantile_spread(moments: DataFrame, quantiles: int = QUANTILES) -> DataFrame:
    """Top minus bottom bucket return per date, with the combined standard error."""
    error = _std_error(F.col("n"), F.col("m2"))

    def of(bucket: int, c: Column) -> Column:
        return F.max(F.when(F.col("bucket") == bucket, c))

    return (
        moments.groupBy(*CELL, "period")
        .agg(
            (of(quantiles, F.col("mean")) - of(1, F.col("mean"))).alias("spread"),
            F.sqrt(F.pow(of(quantiles, error), 2) + F.pow(of(1, error), 2)).alias("std_error"),
        )
        .where(F.col("spread").isNotNull())
    )


def factor_returns(clean: DataFrame, periods: Sequence[int] = PERIODS) -> DataFrame:
    """Per date: return of the factor-weighted portfolio and of the equal-weighted universe.

    Weights are the demeaned factor values scaled to gross exposure 1.
    """
    centred = with_group_aggregates(clean, CELL, {"_mean": F.avg("value")}).withColumn(
        "_w", F.col("value") - F.col("_mean")
    )
    gross = F.sum(F.abs("_w"))
    daily = centred.groupBy(*CELL).agg(
        *[F.try_divide(F.sum(F.col("_w") * F.col(fwd(p))), gross).alias(f"_f{p}") for p in periods],
        *[F.avg(fwd(p)).alias(f"_u{p}") for p in periods],
    )
    return _per_period(
        daily,
        CELL,
        periods,
        {"factor_return": lambda p: f"_f{p}", "universe_return": lambda p: f"_u{p}"},
    )


def cumulative_return(
    returns: DataFrame,
    column: str = "factor_return",
    series: Sequence[str] = ("factor_name", "period"),
    date: str = "date",
) -> DataFrame:
    """Running product of (1 + r), minus 1. One row per date in a series."""
    so_far = Window.partitionBy(*series).orderBy(date).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    growth = F.product(F.lit(1.0) + F.coalesce(F.col(column), F.lit(0.0))).over(so_far)
    return returns.withColumn("cumulative_return", growth - F.lit(1.0))


def factor_alpha_beta(returns: DataFrame, periods_per_year: int = 252) -> DataFrame:
    """Regression of the factor portfolio on the universe return, per factor and period.

    A loss of everything (alpha of -1 or below) has no yearly rate.
    """
    fit = returns.groupBy("factor_name", "period").agg(
        F.regr_intercept("factor_return", "universe_return").alias("alpha"),
        F.regr_slope("factor_return", "universe_return").alias("beta"),
    )
    growth = F.lit(1.0) + F.col("alpha")
    yearly = F.pow(growth, F.lit(float(periods_per_year)) / F.col("period")) - F.lit(1.0)
    return fit.withColumn("annual_alpha", F.when(growth > 0, yearly))


def ic_daily(clean: DataFrame, periods: Sequence[int] = PERIODS) -> DataFrame:
    """Spearman correlation of factor and forward return per factor, date and period."""
    ranked = rank_columns(
        clean.select(*CELL, "value", *map(fwd, periods)),
        CELL,
        {"_rv": "value", **{f"_r{p}": fwd(p) for p in periods}},
    )
    daily = ranked.groupBy(*CELL).agg(*[F.corr("_rv", f"_r{p}").alias(f"_ic{p}") for p in periods])
    return _per_period(daily, CELL, periods, {"ic": lambda p: f"_ic{p}"})


def ic_summary(ic: DataFrame) -> DataFrame:
    stats = ic.groupBy("factor_name", "period").agg(
        F.count("ic").alias("n"),
        F.avg("ic").alias("ic_mean"),
        F.stddev_samp("ic").alias("ic_std"),
        F.skewness("ic").alias("ic_skew"),
        F.kurtosis("ic").alias("ic_kurtosis"),
    )
    ratio = F.try_divide(F.col("ic_mean"), F.col("ic_std"))
    return stats.withColumn("risk_adjusted_ic", ratio).withColumn(
        "t_stat", F.col("risk_adjusted_ic") * F.sqrt("n")
    )


def ic_monthly(ic: DataFrame) -> DataFrame:
    month = F.trunc("date", "month").alias("month")
    return ic.groupBy("factor_name", "period", month).agg(F.avg("ic").alias("ic_mean"))


def _periods_earlier(column: str, period: int) -> Column:
    """The asset's value exactly ``period`` trading days before, NULL when it has none."""
    by_day = Window.partitionBy("factor_name", "asset").orderBy("t")
    return F.first(column).over(by_day.rangeBetween(-period, -period))


def bucket_turnover(clean: DataFrame, periods: Sequence[int] = PERIODS) -> DataFrame:
    """Share of a bucket's members that were not in it ``period`` trading days earlier."""
    seen = clean.select(*CELL, "asset", "t", "bucket")
    seen = seen.withColumns({f"_b{p}": _periods_earlier("bucket", p) for p in periods})
    counts = seen.groupBy(*CELL, "t", "bucket").agg(
        *[
            (F.lit(1.0) - F.count(F.when(F.col(f"_b{p}") == F.col("bucket"), 1)) / F.count(F.lit(1)))
            .alias(f"_x{p}")
            for p in periods
        ]
    )
    rows = _per_period(counts, [*CELL, "t", "bucket"], periods, {"turnover": lambda p: f"_x{p}"})
    return rows.where(F.col("t") > F.col("period")).drop("t")


def rank_autocorrelation(clean: DataFrame, periods: Sequence[int] = PERIODS) -> DataFrame:
    """Correlation of factor ranks with the ranks ``period`` trading days earlier."""
    ranked = rank_cross_section(
        clean.select(*CELL, "asset", "t", "value"), True, "value", "_rank", CELL
    )
    ranked = ranked.withColumns({f"_r{p}": _periods_earlier("_rank", p) for p in periods})
    daily = ranked.groupBy(*CELL, "t").agg(
        *[F.corr("_rank", f"_r{p}").alias(f"_a{p}") for p in periods]
    )
    rows = _per_period(daily, [*CELL, "t"], periods, {"autocorrelation": lambda p: f"_a{p}"})
    return rows.where(F.col("t") > F.col("period")).drop("t")
