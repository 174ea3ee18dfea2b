"""Sinks: Parquet zones, append, truncate and keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.operators.panel import first_per_key, merge_upsert
from paneloom.session import scratch_path
from paneloom.sources.readers import _exists

UPSERT_PARTITION = "year"


def write_zone(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Snappy Parquet; rows are sorted by day and stock inside files so that statistics prune."""
    order = [c for c in ("date", "stock_id") if c in df.columns]
    if order or partition_by:
        df = df.sortWithinPartitions(*partition_by, *order)
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_clustered(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("date", "stock_id"),
    files: int | None = None,
    row_group_bytes: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Snappy Parquet whose files are ranges of ``by`` and sorted by it.

    Every file and row group then covers its own stretch of the keys, so its statistics let a scan of
    an interval leave out the others. The number of files follows the size of the data (adaptive
    execution merges small ranges) unless ``files`` is given.
    """
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    writer = ranged.sortWithinPartitions(*by).write.mode(mode).option("compression", "snappy")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def append_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), flat: bool = False
) -> None:
    """Add rows; ``flat`` writes the export form of :func:`export_scalars`."""
    write_zone(export_scalars(df) if flat else df, path, partition_by, "append")


def truncate_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), flat: bool = False
) -> None:
    """Replace all rows; ``flat`` writes the export form of :func:`export_scalars`."""
    write_zone(export_scalars(df) if flat else df, path, partition_by, "overwrite")


def dataset_name(base: str, start: str, end: str, mv_date: str, top_n: int | None = None) -> str:
    """Name of a run's dataset; ``{top_n}`` and ``{_top_n}`` in the base are filled in."""
    if top_n is not None:
        base = base.replace("{top_n}", str(top_n)).replace("{_top_n}", str(top_n))
    s, e, m = (d.replace("-", "") for d in (start, end, mv_date))
    return f"{base}_s{s}_e{e}_mv{m}"


def tag_run(
    df: DataFrame,
    start: str,
    end: str,
    mv_date: str,
    top_n: int,
    factor_set: str | None = None,
) -> DataFrame:
    """Run parameters as partition columns: one table for all runs instead of one dataset each."""
    tags = {"run_start": start, "run_end": end, "mv_date": mv_date, "top_n": top_n}
    if factor_set is not None:
        tags["factor_set"] = factor_set
    return df.withColumns({k: F.lit(v) for k, v in tags.items()})


def unique_names(names: Sequence[str]) -> list[str]:
    """Repeated names get _1, _2, ..."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        out.append(f"{name}_{seen[name]}" if name in seen else name)
        seen[name] = seen.get(name, 0) + 1
    return out


def export_scalars(df: DataFrame, upsert: bool = False) -> DataFrame:
    """Flat columns for loaders without nested types.

    Nested values become JSON text. For an upsert only a text column without any value is set to
    '' (dates stay dates); otherwise every missing text is '' and dates are ISO text.
    """
    df = df.toDF(*unique_names(df.columns))
    texts = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.ArrayType, T.MapType, T.StructType))
    ]
    if upsert and texts:
        # one pass tells which text columns have any value at all
        counts = df.agg(F.struct(*[F.count(F.col(f"`{c}`")).alias(c) for c in texts])).scalar()
    out = {}
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            out[field.name], kind = F.to_json(c), T.StringType()
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) and not upsert:
            out[field.name], kind = F.date_format(c, "yyyy-MM-dd"), T.StringType()
        else:
            out[field.name] = c
        if not isinstance(kind, T.StringType):
            continue
        if upsert:
            empty = counts[field.name] == 0
            out[field.name] = F.when(empty, F.lit("")).otherwise(out[field.name])
        else:
            out[field.name] = F.coalesce(out[field.name], F.lit(""))
    return df.select(*[v.alias(k) for k, v in out.items()])


def _staged(df: DataFrame) -> DataFrame:
    """A compressed copy of ``df`` in the shared folder."""
    path = scratch_path(df.sparkSession, "staged")
    df.write.option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert_table(batch: DataFrame, path: str, keys: Sequence[str] = ("date", "stock_id")) -> None:
    """Replace or add the rows of ``batch`` by key in a Parquet table partitioned by year.

    The batch is computed once and staged in the shared folder. Only the years it touches are read
    and rewritten. The merged rows are staged too before those partitions are replaced, so the table is
    never overwritten while being read and a failed run can be repeated with the same result. The
    table is created when absent.
    """
    spark = batch.sparkSession
    batch = _staged(first_per_key(batch, keys).withColumn(UPSERT_PARTITION, F.year("date")))
    if not batch.where(reduce(or_, [F.col(k).isNull() for k in keys])).isEmpty():
        raise ValueError(f"rows without a key ({', '.join(keys)}) can't be merged")
    if not _exists(spark, path):
        write_zone(batch, path, [UPSERT_PARTITION])
        return
    years = [r[0] for r in batch.select(UPSERT_PARTITION).distinct().collect()]
    current = spark.read.schema(batch.schema).parquet(path)
    merged = _staged(
        merge_upsert(current.where(F.col(UPSERT_PARTITION).isin(*years)), batch, keys)
    )
    (
        merged.sortWithinPartitions(UPSERT_PARTITION, "date", "stock_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(UPSERT_PARTITION)
        .parquet(path)
    )
