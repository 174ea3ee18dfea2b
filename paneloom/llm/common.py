"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, wraps
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.session import materialise

#: Rows of a narrow table that one task reads.
COMPACT_ROWS = 100_000
Batch = TypeVar("Batch")
#: What operators keep in a worker between tasks, by name; used by reference, as tasks get copies of globals.
CACHES: dict[str, dict] = {}


def text_of(column: str = "text") -> Column:
    """The whole text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def own_names(*names: str) -> Callable:
    """For operators that add columns of these names on the way: columns of the caller that are
    called the same are set aside under other names and come back with the result."""

    def around(operator: Callable) -> Callable:
        @wraps(operator)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            aside = {}
            for c in docs.columns:
                if c.lower() in names:
                    new = f"{c}_of_caller"
                    while new.lower() in {x.lower() for x in [*docs.columns, *aside.values()]}:
                        new += "_"
                    aside[c] = new

            def renamed(value):
                return aside.get(value, value) if isinstance(value, str) else value

            found = operator(
                docs.withColumnsRenamed(aside),
                *map(renamed, args),
                **{k: renamed(x) for k, x in options.items()},
            )
            return found.withColumnsRenamed({new: c for c, new in aside.items()})

        return run

    return around


def numbered(df: DataFrame, name: str = "row_key") -> DataFrame:
    """A checkpointed copy of narrow rows with a number that tells repeated rows apart.

    The checkpoint fixes the numbers, so later jobs and retried tasks agree on them.
    """
    return materialise(df.withColumn(name, F.monotonically_increasing_id()))


def compact(df: DataFrame) -> DataFrame:
    """A checkpointed copy of narrow rows, read in one task for each ``COMPACT_ROWS`` rows.

    A few rows that lie in many partitions would else write a file of each at every later exchange.
    """
    kept = materialise(df)
    least = kept.sparkSession.sparkContext.defaultParallelism
    rows = kept.coalesce(least).count()
    return kept.coalesce(max(least, -(-rows // COMPACT_ROWS)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links ``a``, ``b`` as (node, component: its smallest node).

    In the order of hashes, every node chooses the first of its neighbours and itself, then the choice of its
    choice. Links then lead from choice to choice, and those within one are gone. Chains in the order of hashes
    are short, so a share of the nodes leaves in each round; when no link is left, the choices are followed
    from the last round to the first. All steps are mergeable minima, so a node with many links needs
    no task of its own. Each round is checkpointed: lineage stays flat and a lost executor costs at
    most one round. Links with a null end or to itself are left out.
    """
    links = compact(edges.where("a is not null and b is not null and a <> b").select("a", "b"))
    parts = max(1, links.rdd.getNumPartitions())
    rounds = []
    while not rounds or not links.isEmpty():
        first = F.min(F.struct(F.xxhash64("b").alias("hash"), F.col("b").alias("node")))
        own = F.struct(F.xxhash64("node").alias("hash"), "node")
        chosen = (
            links.union(links.select("b", "a"))
            .groupBy(F.col("a").alias("node"))
            .agg(first.alias("first"))
            .select("node", F.least("first", own)["node"].alias("choice"))
            .coalesce(parts)
        )
        further = chosen.select(F.col("node").alias("choice"), F.col("choice").alias("root"))
        chosen = materialise(chosen.join(further, "choice").select("node", "root").coalesce(parts))
        rounds.append(chosen)
        for end in ("a", "b"):
            of = chosen.select(F.col("node").alias(end), F.col("root").alias(f"of_{end}"))
            links = links.join(of, end).coalesce(parts)
        links = materialise(
            links.where("of_a <> of_b")
            .select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
            .distinct()
            .coalesce(parts)
        )
    found = rounds.pop()
    while rounds:
        later = found.select(F.col("node").alias("root"), F.col("root").alias("last"))
        found = rounds.pop().join(later, "root", "left").select(
            "node", F.coalesce("last", "root").alias("root")
        )
    smallest = found.groupBy("root").agg(F.min("node").alias("component"))
    return materialise(found.join(smallest, "root").select("node", "component").coalesce(parts))


@cache
def _trim() -> Callable[[int], int] | None:
    """glibc's malloc_trim; None with another C library."""
    try:
        return getattr(ctypes.CDLL(None), "malloc_trim", None)
    except (OSError, TypeError):
        return None


def give_back() -> None:
    """Free memory that the allocators of this worker hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def forget(but: str = "") -> None:
    """Empties this worker's caches, short of one."""
    held = [c for name, c in CACHES.items() if name != but and c]
    for c in held:
        c.clear()
    if held:
        give_back()


def lean(batches: Iterator[Batch], keep: str = "") -> Iterator[Batch]:
    """The same batches, with memory given back after each; caches but ``keep`` go before the first.

    Python workers outlive tasks and stages, so what their allocators hold of batches long gone
    would stay beside the heap of the executor.
    """
    forget(keep)
    for batch in batches:
        yield batch
        del batch
        give_back()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, reachable from all executors."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")
