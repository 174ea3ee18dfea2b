"""Trading calendar, as-of lookups and carrying sparse rows onto every trading day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneloom.functions.scalars import no_nan, parse_date
from paneloom.lookup import lookup_table
from paneloom.schemas import FACT_FACTOR_DDL


def trading_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    return (
        df.select(parse_date(date).alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
        .withColumn("is_trading_day", F.lit(1))
    )


def calendar_index(df: DataFrame, date: str = "date") -> DataFrame:
    """Distinct dates numbered 1..n as ``t``; the one-task window sees one row per calendar day."""
    days = trading_calendar(df, date).select("date")
    return days.withColumn("t", F.row_number().over(Window.orderBy("date")))


@dataclass(frozen=True)
class Calendar:
    """Distinct dates in order, held by the driver.

    A date column has at most one distinct value per calendar day, a few ten thousand for a
    century, so fetching them is bounded whatever the size of the panel. Plans then refer to a
    local relation: no panel is scanned a second time to number its days, and the broadcast is of
    known size.
    """

    dates: tuple[dt.date, ...]

    @staticmethod
    def of(df: DataFrame, date: str = "date") -> Calendar:
        rows = trading_calendar(df, date).select("date").collect()
        return Calendar(tuple(sorted(r["date"] for r in rows)))

    def between(self, start: dt.date | None, end: dt.date | None) -> Calendar:
        return Calendar(
            tuple(d for d in self.dates if (not start or d >= start) and (not end or d <= end))
        )

    def union(self, other: Calendar) -> Calendar:
        return Calendar(tuple(sorted({*self.dates, *other.dates})))

    def table(self, spark: SparkSession) -> DataFrame:
        """(date, t) with t = 1..n."""
        rows = [(d, i) for i, d in enumerate(self.dates, 1)]
        return lookup_table(spark, rows, "date date, t int")

    def first_open(self, spark: SparkSession) -> DataFrame:
        """(day, first): for every day up to the last date, the position of the first date not
        before it."""
        since = [self.dates[0], *[d + dt.timedelta(1) for d in self.dates[:-1]]]
        spans = [(a, b, i) for i, (a, b) in enumerate(zip(since, self.dates), 1)]
        table = lookup_table(spark, spans, "since date, until date, first int")
        return table.select(F.explode(F.sequence("since", "until")).alias("day"), "first")


def calendar_bounds(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def as_of_dates(table: DataFrame, targets: Sequence[str | None], date: str = "date") -> DataFrame:
    """(target, as_of): latest date of the table not after each target; None asks for the latest.

    All targets come out of one aggregate over the table. Fails when a target precedes every date.
    """
    day = F.col(date)
    found = table.agg(
        *[
            F.max(day if t is None else F.when(day <= F.lit(t).cast("date"), day)).alias(f"_d{i}")
            for i, t in enumerate(targets)
        ]
    )

    def checked(i: int, target: str | None) -> Column:
        message = F.lit(f"no data on or before {target or 'any date'}")
        return F.coalesce(F.col(f"_d{i}"), F.raise_error(message).cast("date"))

    pairs = [
        F.struct(
            (F.col(f"_d{i}") if t is None else F.lit(t)).cast("date").alias("target"),
            checked(i, t).alias("as_of"),
        )
        for i, t in enumerate(targets)
    ]
    return found.select(F.inline(F.array(*pairs)))


def carry_forward(
    df: DataFrame,
    calendar: Calendar,
    columns: Sequence[str],
    series: Sequence[str] = ("asset",),
    date: str = "date",
    leading: str = "null",
) -> DataFrame:
    """Put every series on every calendar date, each date showing the latest earlier row.

    Each sparse row owns the calendar positions up to the next row of its series, so the window
    runs on the sparse rows only and the dense panel is produced in place, without another
    exchange and without pairing dates with assets. NULL cells take the previous known value.
    Rows are unique on (series, date).

    ``leading`` tells what to do before a series' first row: ``null`` emits it with NULLs,
    ``drop`` leaves it out, ``backfill`` uses the first row (which looks ahead).
    """
    if leading not in ("null", "drop", "backfill"):
        raise ValueError(f"unknown leading mode {leading!r}")
    if not calendar.dates:
        raise ValueError("empty calendar")
    spark, series, columns = df.sparkSession, list(series), list(columns)
    beyond = F.lit(len(calendar.dates) + 1)
    late = F.col("_day") > F.lit(calendar.dates[-1])
    placed = (
        df.select(
            *series,
            F.col(date).alias("_day"),
            *(no_nan(c).alias(c) if df.schema[c].dataType.typeName() in ("double", "float") else c for c in columns),
        )
        .join(F.broadcast(calendar.first_open(spark).withColumnRenamed("day", "_day")), "_day", "left")
        .withColumn("_from", F.coalesce("first", F.when(late, beyond), F.lit(1)))
    )
    order = Window.partitionBy(*series).orderBy("_day")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = placed.select(
        *series,
        "_from",
        F.coalesce(F.lead("_from").over(order), beyond).alias("_until"),
        (F.row_number().over(order) == 1).alias("_head"),
        *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in columns],
    )
    start = F.col("_from")
    if leading != "drop":
        start = F.when(F.col("_head"), F.lit(1)).otherwise(start)
    dense = spans.where(start < F.col("_until")).select(
        *series, F.explode(F.sequence(start, F.col("_until") - 1)).alias("t"), "_from", *columns
    )
    if leading == "null":
        dense = dense.withColumns(
            {c: F.when(F.col("t") >= F.col("_from"), F.col(c)) for c in columns}
        )
    return dense.join(F.broadcast(calendar.table(spark)), "t").select(
        "date", "t", *series, *columns
    )


def extend_factor(
    reports: DataFrame, trading_days: Calendar, strict_calendar: bool = False
) -> DataFrame:
    """Sparse (report_date, asset, factor_name, value) to one row per day, asset and factor.

    Values hold until the next report; reports before the first trading day are carried in. A
    report date inside the range that is no trading day also appears, for its factor, unless
    ``strict_calendar``.
    """
    calendar, off_days = trading_days, []
    if not strict_calendar:
        inside = reports.where(
            F.col("report_date").between(trading_days.dates[0], trading_days.dates[-1])
        )
        # at most one row per calendar day, with the names reporting on it
        reporting = (
            inside.groupBy(F.col("report_date").alias("date"))
            .agg(F.collect_set("factor_name").alias("names"))
            .collect()
        )
        open_days = set(trading_days.dates)
        off_days = [(r["date"], r["names"]) for r in reporting if r["date"] not in open_days]
        calendar = trading_days.union(Calendar(tuple(d for d, _ in off_days)))
    daily = carry_forward(reports, calendar, ["value"], ["factor_name", "asset"], "report_date")
    if off_days:
        extra = lookup_table(
            reports.sparkSession, off_days, "date date, _reporting array<string>"
        )
        daily = daily.join(F.broadcast(extra), "date", "left").where(
            F.col("_reporting").isNull() | F.array_contains("_reporting", F.col("factor_name"))
        )
    return daily.select("date", "asset", "factor_name", "value")


def factor_daily(
    reports: DataFrame,
    factor_names: Sequence[str],
    stocks: DataFrame,
    trading_days: Calendar,
    start: dt.date,
    end: dt.date,
    strict_calendar: bool = False,
) -> DataFrame:
    """Daily factor fact (date, stock_id, factor_name, value) of the listed stocks.

    A factor that covers none of the listed stocks keeps all of its own; no stocks at all give no rows.
    """
    if not factor_names or stocks.isEmpty():
        return lookup_table(reports.sparkSession, [], FACT_FACTOR_DDL)
    chosen = reports.where(F.col("factor_name").isin(*factor_names))
    listed = stocks.select(F.col("stock_id").alias("asset")).distinct().withColumn("_in", F.lit(1))
    marked = chosen.join(listed, "asset", "left")
    # one row per requested name
    covered = marked.groupBy("factor_name").agg(F.max("_in").alias("_any"))
    kept = marked.join(F.broadcast(covered), "factor_name").where(
        F.col("_in").isNotNull() | F.col("_any").isNull()
    )
    daily = extend_factor(
        kept.select(*reports.columns), trading_days.between(start, end), strict_calendar
    )
    return daily.select("date", F.col("asset").alias("stock_id"), "factor_name", "value")
