"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of a source fall into blocks by a hash of their id. A source is drawn whole as often as its
target allows, and the rest as whole blocks in permuted order plus, of the last block, the documents
up to a hash. The resulting exact block quotas are halved recursively among the output shards: each
half gets a multivariate-hypergeometric draw of its parent's quotas, so every shard mixes the sources
without replacement. A shard takes its own run of each source's permuted blocks and orders its
documents by a hash.

Every draw depends on the seed and the document's id alone, so reruns and retried tasks agree.

Definitions: the size is the number of words, 0 for null and empty texts; a source of size 0 gets nothing.
Sources are ordered by code point, null last and a source of its own, and weights repeat in
that order. Rows with the same id are drawn alike. The plan has one row per source and block,
never one per document. Ids are compared as text, a null one as "".
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.common import own_names, text_of
from paneloom.session import materialise

WORD = "[^\\x20\\x09-\\x0D]+"


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``sizes`` (source, source_size) with weight and target.

    The targets share ``share`` of all sizes by weight; none is above ``most`` times its source's
    size, and what is above is shared again among the others. That is: target =
    min(most * size, level * weight) for one level, found by prefix sums over the sources in the
    order in which they reach their bound. One row per source, hence the windows without a key.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choose = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    bound = F.lit(float(most)) * F.col("source_size")
    by_bound = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_bound.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levelled = (
        sizes.withColumn("weight", choose)
        .withColumn("ratio", bound / F.col("weight"))
        .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("spent", F.coalesce(F.sum(bound).over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("spent")) / F.sum("weight").over(onward))
        .withColumn("open", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
        .withColumn("level", F.max("open").over(everything))
    )
    return levelled.select(
        "source",
        "source_size",
        "weight",
        F.least(bound, F.coalesce(F.col("level") * F.col("weight"), bound)).alias("target"),
    )


def _split(quotas: np.ndarray, shards: int, seed: int, node: int) -> Iterator[np.ndarray]:
    if shards == 1:
        yield quotas
        return
    left = shards // 2
    total = int(quotas.sum())
    drawn = np.random.default_rng((seed, node)).multivariate_hypergeometric(
        quotas, round(total * left / shards)
    )
    yield from _split(drawn, left, seed, 2 * node)
    yield from _split(quotas - drawn, shards - left, seed, 2 * node + 1)


def shard_quotas(units: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, quota) to (source, shard, first, last): each shard's run of a source's units.

    The tree works on one row per source, so it is one group by design.
    """

    def tree(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source", na_position="last", ignore_index=True)
        leaves = np.stack(list(_split(rows["quota"].to_numpy(np.int64), shards, seed, 1)))
        last = leaves.cumsum(axis=0)
        return pd.DataFrame(
            {
                "source": np.tile(rows["source"].to_numpy(object), shards),
                "shard": np.repeat(np.arange(shards, dtype=np.int32), len(rows)),
                "first": (last - leaves + 1).ravel(),
                "last": last.ravel(),
            }
        )

    return units.withColumn("root", F.lit(1)).groupBy("root").applyInPandas(
        tree, "source string, shard int, first long, last long"
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    shards: int = 16,
    blocks: int = 1024,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized documents, block plan, draws).

    * sized: id, source, size, block, spot (place within the block);
    * plan: a row per source and block: source, block, source_size, target, copies (whole draws),
      cutoff (documents up to this spot are drawn once more; null: none);
    * draws: a row per drawn block: source, block, shard, cutoff (null: the whole block).
    """
    sized = materialise(
        keyed(docs, id_col, source_col, blocks, seed).select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
            "block",
            "spot",
        )
    )
    by_block = materialise(
        sized.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    )
    targets = source_targets(
        by_block.groupBy("source").agg(F.sum("block_size").alias("source_size")),
        weights,
        share,
        most,
    )
    permuted = Window.partitionBy("source").orderBy("turn", "block")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    planned = (
        targets.withColumnRenamed("source", "of")
        .join(by_block, F.col("source").eqNullSafe(F.col("of")))
        .drop("of", "weight")
        .withColumn("whole", F.coalesce(F.floor(F.expr("target / nullif(source_size, 0)")), F.lit(0)))
        .withColumn("rest", rest)
        .withColumn("turn", F.xxhash64(F.lit(seed), "source", "block"))
        .withColumn("upto", F.sum("block_size").over(permuted))
        .withColumn("more", ((F.col("upto") <= F.col("rest")) & (F.col("rest") > 0)).cast("long"))
        .withColumn("room", F.col("rest") - (F.col("upto") - F.col("block_size")))
        .withColumn("cut", (F.col("more") == 0) & (F.col("room") > 0))
    )
    planned = materialise(planned)
    # the last block of each source: documents in hash order while at least half of them fits
    cut = planned.where("cut").select(
        F.col("source").alias("of"), F.col("block").alias("b"), "room"
    )
    spots = (
        sized.join(cut, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("b")))
        .groupBy("source", "block", "spot", "room")
        .agg(F.sum("size").alias("size"))
        .withColumn(
            "upto", F.sum("size").over(Window.partitionBy("source", "block").orderBy("spot"))
        )
        .where(F.col("upto") - F.col("size") / 2 <= F.col("room"))
        .groupBy(F.col("source").alias("of"), F.col("block").alias("b"))
        .agg(F.max("spot").alias("cutoff"))
    )
    plan = materialise(
        planned.join(
            spots,
            F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("b")),
            "left",
        ).select(
            "source",
            "block",
            "source_size",
            "target",
            (F.col("whole") + F.col("more")).alias("copies"),
            "cutoff",
            "turn",
        )
    )
    units = plan.withColumn(
        "pass",
        F.explode(
            F.concat(
                F.when(
                    F.col("copies") > 0,
                    F.transform(F.sequence(F.lit(1), F.col("copies").cast("int")), lambda _: F.lit(False)),
                ).otherwise(F.array().cast("array<boolean>")),
                F.when(F.col("cutoff").isNotNull(), F.array(F.lit(True))).otherwise(
                    F.array().cast("array<boolean>")
                ),
            )
        ),
    ).select("source", "block", "turn", "pass", F.when(F.col("pass"), F.col("cutoff")).alias("cutoff"))
    ranked = units.withColumn(
        "unit",
        F.row_number().over(Window.partitionBy("source").orderBy("pass", "turn", "block")).cast("long"),
    )
    runs = shard_quotas(units.groupBy("source").agg(F.count("*").alias("quota")), shards, seed)
    slots = (
        runs.where("first <= last")
        .select(
            F.col("source").alias("of"), "shard", F.explode(F.sequence("first", "last")).alias("n")
        )
    )
    draws = ranked.join(
        slots, F.col("source").eqNullSafe(F.col("of")) & (F.col("unit") == F.col("n"))
    ).select("source", "block", "shard", "cutoff")
    return sized, plan, draws


def keyed(docs: DataFrame, id_col: str, source_col: str, blocks: int, seed: int) -> DataFrame:
    """``docs`` with the block and the spot that the draw gives to its rows."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.withColumns(
        {
            "block": F.pmod(F.xxhash64(F.lit(seed + 1), name), F.lit(blocks)).cast("int"),
            "spot": F.xxhash64(F.lit(seed + 2), name),
        }
    )


def taken(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Per document: id, size, source, source_size, target, copies drawn and words taken."""
    part = (F.col("cutoff").isNotNull() & (F.col("spot") <= F.col("cutoff"))).cast("long")
    own = plan.select(
        F.col("source").alias("of"),
        F.col("block").alias("b"),
        "source_size",
        "target",
        F.col("copies").alias("whole"),
        "cutoff",
    )
    copies = F.col("whole") + F.coalesce(part, F.lit(0))
    return sized.join(
        own, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("b"))
    ).select(
        "id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def drawn(sized: DataFrame, plan: DataFrame, draws: DataFrame) -> DataFrame:
    """Like ``taken``, with copies counted from the units that the shards drew."""
    units = draws.groupBy("source", "block").agg(
        F.count_if(F.col("cutoff").isNull()).alias("whole"),
        F.count("cutoff").alias("parts"),
        F.max("cutoff").alias("cutoff"),
    )
    of_source = plan.groupBy(F.col("source").alias("of")).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    own = units.select(
        F.col("source").alias("unit_of"), F.col("block").alias("b"), "whole", "parts", "cutoff"
    )
    part = F.when(F.col("spot") <= F.col("cutoff"), F.col("parts"))
    copies = F.coalesce("whole", F.lit(0)) + F.coalesce(part, F.lit(0))
    return (
        sized.join(F.broadcast(of_source), F.col("source").eqNullSafe(F.col("of")))
        .join(own, F.col("source").eqNullSafe(F.col("unit_of")) & (F.col("block") == F.col("b")), "left")
        .select(
            "id",
            "source",
            "size",
            "source_size",
            "target",
            copies.alias("copies"),
            (copies * F.col("size")).alias("taken"),
        )
    )


@own_names("mix_at", "mix_of", "mix_block", "mix_cutoff")
def mixed(
    docs: DataFrame,
    shards: int = 16,
    blocks: int = 1024,
    seed: int = 7,
    id_col: str = "doc_id",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """The documents of the mix, repeated as drawn, with mix_shard and mix_order.

    Columns of ``docs`` stay as they are, but for two of the names of the results, which these replace. Write with one file group per mix_shard, sorted by mix_order.
    """
    _, _, draws = mix(
        docs, shards=shards, blocks=blocks, seed=seed, id_col=id_col, source_col=source_col, **options
    )
    own = draws.select(
        F.col("source").alias("mix_of"),
        F.col("block").alias("mix_block"),
        F.col("shard").alias("mix_shard"),
        F.col("cutoff").alias("mix_cutoff"),
    )
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    drawn = docs.drop("mix_shard", "mix_order").withColumn(
        "mix_at",
        F.struct(
            F.pmod(F.xxhash64(F.lit(seed + 1), name), F.lit(blocks)).cast("int").alias("block"),
            F.xxhash64(F.lit(seed + 2), name).alias("spot"),
        ),
    ).join(
        own,
        F.col(source_col).cast("string").eqNullSafe(F.col("mix_of"))
        & (F.col("mix_at.block") == F.col("mix_block")),
    )
    return (
        drawn.where(F.col("mix_cutoff").isNull() | (F.col("mix_at.spot") <= F.col("mix_cutoff")))
        .withColumn("mix_order", F.xxhash64(F.lit(seed + 3), name, "mix_shard"))
        .drop("mix_at", "mix_of", "mix_block", "mix_cutoff")
    )
