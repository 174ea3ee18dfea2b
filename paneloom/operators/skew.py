"""Cross-sections of any size.

Ranks, buckets and per-date averages need all rows of one group (a date, or a factor on a date), and
one group may hold a third of all rows. Where no group has more than ``RANGE_ROWS`` rows, rows are dealt once by
group, for any number of columns (a single rank without a flag always takes ranges). Else each group is cut into value ranges that are ordered on their
own, and positions come from range totals. Rows are dealt once, by (group, range), and meet there the
totals, which are dealt alike. Only where a range has more than ``RANGE_ROWS`` rows, equal values are
counted before the shuffle and positions return to the rows by a join on (group, value). No task ever
needs a whole group; a value that so many rows share is one row until that join, where adaptive
execution splits it.

Series keyed by asset need none of this: once (series, date) is unique, a series has at most one row
per calendar day.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.functions.scalars import missing_as_null
from paneloom.session import materialise

RANGES_PER_OCTAVE = 1024
#: Rows of a group or value range up to which a window orders the rows themselves.
RANGE_ROWS = 500_000
#: Rows of a table of groups up to which it is broadcast.
SMALL_TABLE = 200_000
#: Parts that rows without a value are dealt to, and the range id these begin at.
MISSING_PARTS, MISSING_BAND = 1024, 1 << 41
#: Parts a group is dealt to before the final choice of a long top list.
TOP_PARTS = 64


def value_range(v: Column, per_octave: int = RANGES_PER_OCTAVE) -> Column:
    """Monotone integer range id of a double, fixed by the value alone.

    Every power of two is cut into ``per_octave`` ranges; a value lying exactly on a border (zero,
    small integers, ranks) has a range to itself. Being independent of the data, the id is the same
    in every attempt of a task, which a sampled split point would not be.
    """
    a = F.abs(v)
    octave = F.floor(F.log2(a))
    scaled = a / F.pow(F.lit(2.0), octave) * F.lit(float(per_octave))
    whole = F.floor(scaled)
    index = (octave + F.lit(1100)) * F.lit(per_octave) + whole - F.lit(per_octave)
    magnitude = index * F.lit(2) + F.when(scaled > whole, 1).otherwise(0) + F.lit(1)
    infinite = F.lit(float("inf"))
    beyond = F.lit(1 << 40)
    return (
        F.when(v == F.lit(0.0), F.lit(0).cast("bigint"))
        .when(v == infinite, beyond)
        .when(v == -infinite, -beyond)
        .when(v > 0, magnitude.cast("bigint"))
        .otherwise(-magnitude.cast("bigint"))
    )


def null_safe_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], value: str | None = None
) -> DataFrame:
    """Left join in which a NULL key meets a NULL key, as in grouping; a NULL ``value`` meets none."""
    on = list(on)
    names = {c: f"_of_{c}" for c in (on if value is None else [*on, value])}
    other = lookup.withColumnsRenamed(names)
    same = [F.col(c).eqNullSafe(F.col(names[c])) for c in on]
    if value is not None:
        same.append(F.col(value) == F.col(names[value]))
    return rows.join(other, reduce(and_, same), "left").drop(*names.values())


def _totals(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before each value range and rows of its group, from the rows of each range."""
    ranges = Window.partitionBy(*keys).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *keys,
        "_band",
        F.coalesce(F.sum("_band_n").over(ranges), F.lit(0)).alias("_below"),
        F.sum("_band_n").over(Window.partitionBy(*keys)).alias("_n"),
    )


def _band_of(value: str, descending: bool) -> Column:
    band = value_range(F.col(value))
    return -band if descending else band


def _band_counts(base: DataFrame, keys: Sequence[str], value: str, descending: bool) -> DataFrame:
    known = base.where(F.col(value).isNotNull()).withColumn("_band", _band_of(value, descending))
    return known.groupBy(*keys, "_band").agg(F.count(F.lit(1)).alias("_band_n"))


def _distinct(base: DataFrame, keys: Sequence[str], value: str, descending: bool) -> DataFrame:
    """Different values of each group with their rows (``_ties``) and range."""
    known = base.where(F.col(value).isNotNull()).groupBy(*keys, value)
    return known.agg(F.count(F.lit(1)).alias("_ties")).withColumn("_band", _band_of(value, descending))


def _has_long(counts: DataFrame) -> bool:
    return not counts.where(F.col("_band_n") > RANGE_ROWS).isEmpty()


def _short_groups(base: DataFrame, keys: Sequence[str]) -> bool:
    counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > RANGE_ROWS).isEmpty()


def _placed_in_groups(
    rows: DataFrame, keys: Sequence[str], value: str, descending: bool
) -> DataFrame:
    """``rows`` with ``_before``, ``_ties`` and ``_n``, where no group is long."""
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    inside = Window.partitionBy(*keys).orderBy(order)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same = inside.rangeBetween(Window.currentRow, Window.currentRow)
    known = F.col(value).isNotNull()
    return rows.withColumns(
        {
            "_before": F.when(known, (F.rank().over(inside) - 1).cast("long")),
            "_ties": F.when(known, F.count(F.lit(1)).over(same)),
            "_n": F.when(known, F.count(value).over(whole)),
        }
    )


def _placed_rows(
    rows: DataFrame, totals: DataFrame, keys: Sequence[str], value: str, descending: bool
) -> DataFrame:
    """``rows`` with ``_before``, ``_ties`` and ``_n``, where no range is long.

    The group is one struct, which is never NULL and equal where grouping is, so the window and the
    join share the exchange of the rows.
    """
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(MISSING_PARTS)) + F.lit(MISSING_BAND)
    dealt = rows.withColumns(
        {"_g": F.struct(*keys), "_band": F.coalesce(_band_of(value, descending), spread)}
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy("_g", "_band").orderBy(order)
    ties = F.count(F.lit(1)).over(inside.rangeBetween(Window.currentRow, Window.currentRow))
    ordered = dealt.withColumns({"_inside": F.rank().over(inside) - 1, "_ties": ties})
    of = totals.select(F.struct(*keys).alias("_g"), "_band", "_below", "_n")
    return ordered.join(of, ["_g", "_band"], "left").select(
        *rows.columns,
        (F.col("_below") + F.col("_inside")).alias("_before"),
        F.when(F.col(value).isNotNull(), F.col("_ties")).alias("_ties"),
        "_n",
    )


def _small(table: DataFrame) -> DataFrame:
    """A kept copy of a table with a row per group, broadcast if it is small."""
    table = materialise(table)
    return F.broadcast(table) if table.count() <= SMALL_TABLE else table


def _flags(placed: DataFrame, keys: Sequence[str], group_flag) -> DataFrame:
    holds = group_flag(F.col("_before"), F.col("_ties"), F.col("_n"))
    return placed.groupBy(*keys).agg(F.coalesce(F.max(holds), F.lit(False)).alias("_flag"))


def positions(
    base: DataFrame,
    keys: Sequence[str],
    value: str,
    descending: bool = False,
    group_flag: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """One row per group and different value: ``_before``, ``_ties``, ``_n`` (and ``_flag``).

    Totals of the value ranges give the rows before a range, a window inside the range the rest. A
    group has at most 2 x ``RANGES_PER_OCTAVE`` ranges per power of two that its values span.
    """
    keys = list(keys)
    distinct = _distinct(base, keys, value, descending)
    below = _totals(distinct.groupBy(*keys, "_band").agg(F.sum("_ties").alias("_band_n")), keys)
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy(*keys, "_band").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ordered = distinct.withColumn("_inside", F.coalesce(F.sum("_ties").over(inside), F.lit(0)))
    placed = null_safe_join(ordered, below, [*keys, "_band"]).select(
        *keys, value, (F.col("_below") + F.col("_inside")).alias("_before"), "_ties", "_n"
    )
    if group_flag is None:
        return placed
    return null_safe_join(placed, _small(_flags(placed, keys, group_flag)), keys)


def cross_section(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    descending: bool = False,
    group_flag: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """Add the position of each value inside its group.

    ``_before`` rows with a strictly smaller (descending: larger) value, ``_ties`` rows with the
    same value, ``_n`` rows with a value. With ``group_flag(before, ties, n)`` a boolean ``_flag``
    tells whether it holds for any row of the group. Rows without a value (NULL or NaN) have NULL
    in all of these. NULL keys form a group.
    """
    base = materialise(df.withColumn("_v", _number(value)))
    if group_flag is not None and _short_groups(base, keys):
        out = _placed_in_groups(base, keys, "_v", descending)
        holds = group_flag(F.col("_before"), F.col("_ties"), F.col("_n"))
        out = out.withColumn("_holds", holds & F.col("_v").isNotNull())
        of_group = F.coalesce(F.max("_holds").over(Window.partitionBy(*keys)), F.lit(False))
        out = out.withColumn("_flag", F.when(F.col("_v").isNotNull(), of_group))
        return out.drop("_holds", "_v")
    if _has_long(_band_counts(base, keys, "_v", descending)):
        placed = positions(base, keys, "_v", descending, group_flag)
        return null_safe_join(base, placed, keys, "_v").drop("_v")
    ties = _distinct(base, keys, "_v", descending)
    totals = _totals(ties.groupBy(*keys, "_band").agg(F.sum("_ties").alias("_band_n")), keys)
    out = _placed_rows(base, totals, keys, "_v", descending)
    if group_flag is not None:
        narrow = base.where(F.col("_v").isNotNull()).select(*keys, "_v")
        placed = _placed_rows(narrow, totals, keys, "_v", descending)
        # a group without any value has no flag
        out = null_safe_join(out, _small(_flags(placed, keys, group_flag)), keys).withColumn(
            "_flag", F.when(F.col("_v").isNotNull(), F.col("_flag"))
        )
    return out.drop("_v")


def _number(column: str) -> Column:
    """The value as a double, missing ones NULL, zero without a sign."""
    return missing_as_null(F.col(column).cast("double")) + F.lit(0.0)


def rank_columns(df: DataFrame, keys: Sequence[str], ranks: dict[str, str]) -> DataFrame:
    """Average ranks (smallest value first, 0 without a value) of several columns, {rank: column};
    the rows are computed and kept once for all of them."""
    values = {f"_v{i}": column for i, column in enumerate(ranks.values())}
    base = materialise(
        df.withColumns({v: _number(c) for v, c in values.items()})
    )
    out, short = base, _short_groups(base, keys)
    for rank, v in zip(ranks, values):
        if short:
            placed = _placed_in_groups(out, keys, v, False)
            out = placed.withColumn(rank, average_rank()).drop("_before", "_ties", "_n")
            continue
        counts = materialise(_band_counts(base, keys, v, False))
        if _has_long(counts):
            placed = positions(base, keys, v).select(*keys, v, average_rank().alias(rank))
            out = null_safe_join(out, placed, keys, v)
        else:
            placed = _placed_rows(out, _totals(counts, keys), keys, v, False)
            out = placed.withColumn(rank, average_rank()).drop("_before", "_ties", "_n")
    return out.drop(*values).na.fill(0.0, list(ranks))


def average_rank() -> Column:
    """Rank that equal values share."""
    return F.col("_before") + (F.col("_ties") + 1) / F.lit(2.0)


def with_group_aggregates(
    df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]
) -> DataFrame:
    """Attach per-group aggregates to every row: groups of any size are aggregated before the
    shuffle and one row per group comes back."""
    base = materialise(df)
    stats = _small(base.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()]))
    return null_safe_join(base, stats, keys)


def first_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, position: str
) -> DataFrame:
    """The first ``k`` rows of each group with their position.

    ``row_number() <= k`` is evaluated before the shuffle too, so at most ``k`` rows per group
    leave a task. The optimizer does so up to a length set in the session; a longer list is first
    chosen in ``TOP_PARTS`` parts of each group, so no task sees more than that many lists.
    """
    longest = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))

    def chosen(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return rows.withColumn(position, F.row_number().over(window)).where(F.col(position) <= k)

    if k > longest:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(TOP_PARTS))
        df = chosen(df.withColumn("_part", part), [*keys, "_part"]).drop("_part", position)
    return chosen(df, keys)
