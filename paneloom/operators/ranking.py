"""Cross-sectional ranks and their weighted combinations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneloom.operators.panel import union_all
from paneloom.operators.skew import average_rank, cross_section


def rank_cross_section(
    df: DataFrame,
    positive_corr: bool = True,
    rank_column: str = "value",
    rank_result_column: str = "rank",
    keys: Sequence[str] = ("date",),
) -> DataFrame:
    """Rank every group; equal values share their average rank, a missing value gets rank 0.

    ``positive_corr`` ranks small values low (1), otherwise large values low.
    """
    placed = cross_section(df, keys, rank_column, not positive_corr)
    rank = F.coalesce(average_rank(), F.lit(0.0))
    return placed.withColumn(rank_result_column, rank).drop("_before", "_ties", "_n")


def _sum_left_to_right(terms: Sequence[Column]) -> Column:
    """Fixed order of summation: bit-stable whatever order rows arrive in."""
    return reduce(lambda a, b: a + b, terms)


def _check_weights(n: int, weights: Sequence[float]) -> None:
    if n != len(weights):
        raise ValueError(f"{n} ranked factors but {len(weights)} weights")


def weighted_rank(
    ranked: Sequence[DataFrame],
    weights: Sequence[float],
    positive_corr: bool = True,
    rank_column: str = "rank",
    date: str = "date",
    asset: str = "asset",
) -> DataFrame:
    """Weighted sum of ranks per (date, asset), ranked again per date.

    Only assets present in every input count. One union and one aggregation instead of a chain of
    outer joins; (date, asset) must be unique in each input.
    """
    _check_weights(len(ranked), weights)
    parts = [
        df.select(date, asset, (F.col(rank_column) * F.lit(float(w))).alias("_term"), F.lit(i).alias("_pos"))
        for i, (df, w) in enumerate(zip(ranked, weights))
    ]
    tall = union_all(parts)
    return _rank_sums(tall, len(parts), [date], asset, positive_corr)


def weighted_rank_of(
    ranks: DataFrame,
    factors: Sequence[str],
    weights: Sequence[float],
    positive_corr: bool = True,
) -> DataFrame:
    """:func:`weighted_rank` over a long (date, asset, factor_name, rank) table: one scan."""
    _check_weights(len(factors), weights)
    position = F.array_position(F.lit(list(factors)), F.col("factor_name")).cast("int")
    weight = F.element_at(F.lit([float(w) for w in weights]), position)
    tall = ranks.where(F.col("factor_name").isin(*factors)).select(
        "date", "asset", (F.col("rank") * weight).alias("_term"), (position - 1).alias("_pos")
    )
    return _rank_sums(tall, len(factors), ["date"], "asset", positive_corr)


def _rank_sums(tall, k, keys, asset, positive_corr):
    wide = tall.groupBy(*keys, asset).agg(
        *[F.max(F.when(F.col("_pos") == i, F.col("_term"))).alias(f"_t{i}") for i in range(k)]
    )
    total = _sum_left_to_right([F.col(f"_t{i}") for i in range(k)])
    summed = wide.select(*keys, asset, total.alias("_weighted")).where(
        F.col("_weighted").isNotNull()
    )
    ranked = rank_cross_section(
        summed, positive_corr, "_weighted", "weighted_rank", keys
    )
    return ranked.drop("_weighted")


def _check_combinations(n: int, size: int) -> int:
    """How many combinations of at most ``size`` out of ``n`` there are; the size they have."""
    if size < 1:
        raise ValueError("combo_size must be at least 1")
    if not n:
        raise ValueError("no factors to combine")
    size = min(size, n)
    if comb(n, size) >= 2**63:
        raise ValueError(f"combinations of {size} out of {n} factors can't be numbered in 64 bits")
    return size


def _binomials(n: int, size: int) -> Column:
    """C(n - 1 - p, size) by position p, from 1 on as in ``element_at``."""
    return F.array(*[F.lit(comb(n - 1 - p, size)).cast("long") for p in range(n)])


def combo_positions(combo_id: Column, n: int, size: int) -> Column:
    """The 0-based positions of a combination, from its place in lexicographic order.

    The combinatorial number system counts from the end: what is left to the last combination is
    a sum of C(c, size) + ... + C(c', 1), and the largest c whose binomial fits gives each position.
    """
    binomials = F.array(
        *[F.array(*[F.lit(comb(c, k)).cast("long") for c in range(n)]) for k in range(size, 0, -1)]
    )
    start = F.struct(
        (F.lit(comb(n, size) - 1).cast("long") - combo_id).alias("rest"),
        F.array().cast("array<int>").alias("places"),
    )

    def step(state: Column, row: Column) -> Column:
        c = F.size(F.filter(row, lambda x: x <= state["rest"])) - 1
        return F.struct(
            (state["rest"] - F.element_at(row, c + 1)).alias("rest"),
            F.concat(state["places"], F.array(F.lit(n - 1) - c)).alias("places"),
        )

    return F.aggregate(binomials, start, step, lambda state: state["places"])


def combo_table(spark: SparkSession, factors: Sequence[str], combo_size: int) -> DataFrame:
    """(combo_id, combo, positions): all combinations in input order, numbered and unranked on the
    executors. Positions are 1-based."""
    size = _check_combinations(len(factors), combo_size)
    names = F.array(*[F.lit(f) for f in factors])
    positions = F.transform(combo_positions(F.col("id"), len(factors), size), lambda p: p + 1)
    label = F.array_join(F.transform("positions", lambda p: F.element_at(names, p)), "_")
    table = spark.range(comb(len(factors), size)).select(F.col("id").alias("combo_id"), positions.alias("positions"))
    return table.select("combo_id", label.alias("combo"), "positions")


def weighted_rank_combos(
    ranks: DataFrame,
    factors: Sequence[str],
    combo_size: int,
    weights: Sequence[float] | None = None,
    positive_corr: bool = True,
    ids: tuple[int, int] | None = None,
) -> DataFrame:
    """Weighted rank of every combination of ``combo_size`` factors, all in one job.

    Ranks become one array per (date, asset) first. Combinations then grow by one factor at a time,
    so those with equal beginnings share their partial sum, and one that misses a rank is given up
    where it does. After the first two factors (three, if two at least are still to come) the rows are
    dealt by these and the date, with the ranks of later factors only: all that a combination ranks on
    a date is together from then on, ranked by a window (one date's assets under one combination), and
    no complete combination is ever shuffled. That window sorts narrow rows: the later positions are one
    number, and the id is computed again from the positions. No list of combinations exists anywhere; a row's arrays have as many entries as there
    are factors. ``combo_id`` is the place in input order, computed from the positions.

    Weights are by position inside the combination; none or a wrong number means equal weights.
    ``ids`` = (first, stop) evaluates these combinations only, leaving out whole beginnings early.
    """
    n = len(factors)
    size = _check_combinations(n, combo_size)
    if weights is None or len(weights) != size:
        weights = [1.0 / size] * size
    rows = (
        ranks.where(F.col("factor_name").isin(*factors))
        .groupBy("date", "asset")
        .agg(
            F.array(
                *[F.max(F.when(F.col("factor_name") == f, F.col("rank"))) for f in factors]
            ).alias("_ranks")
        )
        .withColumns({"_sum": F.lit(0.0), "_last": F.lit(comb(n, size) - 1).cast("long")})
    )
    block = [f"_p{i}" for i in range(max(min(2, size - 1), min(3, size - 2)))]
    gone = 0  # ranks cut off at the front of the array
    for i in range(size):
        here, before = f"_p{i}", F.col(f"_p{i - 1}") + 1 if i else F.lit(0)
        place = F.col(here) + 1
        rows = rows.withColumn(
            here, F.explode(F.sequence(before, F.lit(n - size + i)))
        )
        term = F.element_at("_ranks", place - gone) * F.lit(float(weights[i]))
        # the last combination that begins like this; all of them are numbered in a row
        last = F.col("_last") - F.element_at(_binomials(n, size - i), place)
        rows = rows.withColumns(
            {"_sum": F.col("_sum") + term if i else term, "_last": last}
        ).where(F.col("_sum").isNotNull())
        if ids is not None:
            count = F.element_at(_binomials(n, size - i - 1), place)
            rows = rows.where(
                (F.col("_last") >= ids[0]) & (F.col("_last") - count + 1 < ids[1])
            )
        if here == (block[-1:] or [None])[0]:
            later = F.slice("_ranks", place + 1, F.lit(n) - place).alias("_ranks")
            rows = rows.select("date", "asset", *block, "_sum", "_last", later).repartition(*block, "date")
            gone = place
    rest = [F.col(f"_p{i}") for i in range(len(block), size)]
    bits = max(1, (n - 1).bit_length())
    if bits * len(rest) < 63:
        packed = reduce(lambda a, b: F.shiftleft(a, bits).bitwiseOR(b), [c.cast("long") for c in rest])
        low = F.lit((1 << bits) - 1).cast("long")
        shifts = [bits * (len(rest) - 1 - i) for i in range(len(rest))]
        unpacked = [F.shiftright("_rest", b).bitwiseAND(low).cast("int") for b in shifts]
    else:
        packed = F.array(*rest)
        unpacked = [F.element_at("_rest", i + 1) for i in range(len(rest))]
    summed = rows.select("date", "asset", *block, packed.alias("_rest"), F.col("_sum").alias("_weighted"))
    order = F.col("_weighted").asc() if positive_corr else F.col("_weighted").desc()
    group = Window.partitionBy(*block, "date", "_rest").orderBy(order)
    ties = F.count(F.lit(1)).over(group.rangeBetween(Window.currentRow, Window.currentRow))
    ranked = summed.withColumn("weighted_rank", F.rank().over(group) + (ties - 1) / F.lit(2.0))
    names = F.array(*[F.lit(f) for f in factors])
    places = [c + 1 for c in (*map(F.col, block), *unpacked)]
    label = F.concat_ws("_", *[F.element_at(names, c) for c in places])
    after = [F.element_at(_binomials(n, size - i), c) for i, c in enumerate(places)]
    combo_id = reduce(lambda a, b: a - b, after, F.lit(comb(n, size) - 1).cast("long")).alias("combo_id")
    return ranked.select(combo_id, label.alias("combo"), "date", "asset", "weighted_rank")
