"""Sources. Date and factor predicates and column lists reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.functions.scalars import strip_type_prefix, symbol_root
from paneloom.lookup import lookup_table
from paneloom.operators.panel import union_all, wide_to_long
from paneloom.schemas import FACT_PRICE, RAW_PRICE

KEYS = ("date", "stock_id")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``; its files are listed, none is read."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def first_available(spark: SparkSession, candidates: Sequence[str | None]) -> str | None:
    """The first existing path, in order of preference (local snapshot before warehouse)."""
    return next((p for p in candidates if p and _exists(spark, p)), None)


def _between(df: DataFrame, start: str, end: str) -> Column:
    """A closed interval of days, comparing the stored column itself so that file statistics apply."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    kind = df.schema["date"].dataType
    if isinstance(kind, T.DateType):
        return F.col("date").between(first, last)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return (F.col("date") >= first.cast(kind)) & (F.col("date") < F.date_add(last, 1).cast(kind))
    return F.to_date("date").between(first, last)


def prices_between(df: DataFrame, start: str, end: str) -> DataFrame:
    """The 11 price columns on a closed date interval."""
    return df.where(_between(df, start, end)).select(*FACT_PRICE.fieldNames())


def read_price(spark: SparkSession, path: str, start: str, end: str, ordered: bool = False) -> DataFrame:
    df = prices_between(spark.read.schema(FACT_PRICE).parquet(path), start, end)
    return df.orderBy("date", "stock_id") if ordered else df


def factor_between(df: DataFrame, name: str, start: str, end: str) -> DataFrame:
    """(date, stock_id, <name>) of one factor from either table layout.

    Long: a ``factor_name`` column and one value column. Wide: the factor is a column of its own;
    without one of that name the first column that is no key is taken if numeric, else the first
    numeric one.
    """
    df = df.where(_between(df, start, end))
    others = [f for f in df.schema.fields if f.name not in (*KEYS, "factor_name")]
    numeric = [f.name for f in others if isinstance(f.dataType, T.NumericType)]
    if "factor_name" in df.columns:
        df = df.where(F.col("factor_name") == name)
        value = "value" if "value" in df.columns else next((f.name for f in others), None)
    else:
        value = name if name in df.columns else next(iter(numeric), None)
    if value is None:
        raise ValueError(f"no value column for factor {name}")
    return df.select(F.to_date("date").alias("date"), "stock_id", F.col(f"`{value}`").alias(name))


def read_factor(spark: SparkSession, path: str, name: str, start: str, end: str) -> DataFrame:
    return factor_between(spark.read.parquet(path), name, start, end)


def factors_between(df: DataFrame, names: Sequence[str], start: str, end: str) -> DataFrame:
    """Many factors of either table layout, as (date, asset, factor_name, value)."""
    df = df.where(_between(df, start, end))
    if "factor_name" not in df.columns:
        present = [n for n in names if n in df.columns]
        # without any of them: no rows, but the layout
        df = wide_to_long(df, KEYS, present or [df.columns[0]]).where(F.lit(bool(present)))
    return df.where(F.col("factor_name").isin(*names)).select(
        F.to_date("date").alias("date"),
        F.col("stock_id").cast("string").alias("asset"),
        "factor_name",
        F.col("value").cast("double").alias("value"),
    )


def read_factors(
    spark: SparkSession, path: str, names: Sequence[str], start: str, end: str
) -> DataFrame:
    """Many factors in one scan, as (date, asset, factor_name, value)."""
    return factors_between(spark.read.parquet(path), names, start, end)


@dataclass(frozen=True)
class ResolvedFactors:
    """``rows``: (date, asset, factor_name, value). ``report``: one row for each requested name,
    with the source it came from and its number of rows there, or status ``missing``."""

    rows: DataFrame
    report: DataFrame
    missing: tuple[str, ...]


def resolve_factors(
    spark: SparkSession,
    sources: Mapping[str, str | DataFrame],
    names: Sequence[str],
    start: str,
    end: str,
) -> ResolvedFactors:
    """Each factor from the first source that has rows of it in the interval.

    ``sources`` are paths or tables in order of preference, by name; a path without a table is
    passed over. A source is only asked for the names that no earlier one had, so its scan is pruned
    to these, and none is opened once every name is found. A name that all sources lack is reported,
    not an error. The driver receives one count for each requested name.
    """
    wanted = list(dict.fromkeys(names))
    parts: list[DataFrame] = []
    found: dict[str, tuple[str, int]] = {}
    for source, place in sources.items():
        open_names = [n for n in wanted if n not in found]
        if not open_names:
            break
        if isinstance(place, str):
            if not _exists(spark, place):
                continue
            place = spark.read.parquet(place)
        rows = factors_between(place, open_names, start, end)
        counts = rows.groupBy("factor_name").agg(F.count(F.lit(1)).alias("n")).collect()
        if not counts:
            continue
        found |= {r["factor_name"]: (source, r["n"]) for r in counts}
        parts.append(rows.where(F.col("factor_name").isin(*[r["factor_name"] for r in counts])))
    missing = tuple(n for n in wanted if n not in found)
    lines = [
        (i, n, *found.get(n, (None, 0)), "missing" if n in missing else "found")
        for i, n in enumerate(wanted)
    ]
    report = lookup_table(
        spark, lines, "position int, factor_name string, source string, n_rows long, status string"
    )
    if not parts:
        empty = "date date, asset string, factor_name string, value double"
        return ResolvedFactors(lookup_table(spark, [], empty), report, missing)
    return ResolvedFactors(union_all(parts), report, missing)


def latest_snapshot(
    spark: SparkSession, root: str, kind: str = "price", tag: str | None = None
) -> str | None:
    """The most recently written ``fact_price*`` or ``fact_factor*`` snapshot below ``root``.

    A snapshot is a file or a directory of part files; only file metadata is read. With ``tag``
    (such as ``2017-05-16_to_2021-05-15``) only snapshots having it in their name count.
    """
    prefix = "fact_price" if kind == "price" else "fact_factor"
    if not _exists(spark, root):
        return None
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "modificationTime")
    )
    snapshot = F.regexp_extract("path", rf"^(.*/{prefix}[^/]*)(/|$)", 1)
    newest = (
        files.select(snapshot.alias("snapshot"), "modificationTime")
        .where(F.col("snapshot") != "")
        .where(F.contains(F.element_at(F.split("snapshot", "/"), -1), F.lit(tag or "")))
        .orderBy(F.col("modificationTime").desc(), F.col("snapshot").desc())
        .limit(1)
        .collect()
    )
    return newest[0]["snapshot"] if newest else None


def assemble_tickers(
    wide: DataFrame, date: str = "Date", separator: str = "|", fields: Sequence[str] | None = None
) -> DataFrame:
    """Vendor layout, one column per ``Field|TICKER``, to long rows with lower-case names.

    The ticker's part before the first dot becomes the asset; absent fields are NULL. All tickers
    come out of one pass. With ``fields`` given, dates on which a ticker has none of them are left
    out (it did not trade).
    """
    columns = [c for c in wide.columns if separator in c]
    tickers = list(dict.fromkeys(c.split(separator, 1)[1] for c in columns))
    wanted = [f.name for f in RAW_PRICE.fields if f.name not in ("datetime", "asset")]
    present = {c.lower(): c for c in columns}

    def cell(field: str, ticker: str):
        name = present.get(f"{field}{separator}{ticker}".lower())
        value = F.col(f"`{name}`").cast("double") if name else F.lit(None).cast("double")
        return value.alias(field)

    rows = [
        F.struct(F.lit(t).alias("ticker"), *[cell(f, t) for f in wanted]) for t in tickers
    ]
    tall = wide.select(F.to_date(date).alias("datetime"), F.inline(F.array(*rows)))
    if fields:
        tall = tall.na.drop("all", subset=[f.lower() for f in fields])
    return tall.select("datetime", symbol_root("ticker").alias("asset"), *wanted)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Factor catalogue {type: [names]} as (factor_type, position, factor_name), prefix removed."""
    raw = spark.read.option("multiLine", "true").json(path)
    lists = F.array(
        *[
            F.struct(F.lit(c).alias("factor_type"), F.col(f"`{c}`").alias("names"))
            for c in raw.columns
            if isinstance(raw.schema[c].dataType, T.ArrayType)
        ]
    )
    tall = raw.select(F.inline(lists)).select("factor_type", F.posexplode("names"))
    prefix = F.concat("factor_type", F.lit(":"))
    bare = F.when(
        F.startswith("col", prefix), F.col("col").substr(F.length(prefix) + 1, F.length("col"))
    ).otherwise(F.col("col"))
    return tall.select("factor_type", (F.col("pos") + 1).alias("position"), bare.alias("factor_name"))


def catalogue_counts(catalogue: DataFrame) -> DataFrame:
    return catalogue.groupBy("factor_type").agg(F.count(F.lit(1)).alias("n_factors"))


def catalogue_of(facts: DataFrame, data_type: str = "fundamental_features") -> DataFrame:
    """Distinct factor names of a fact table, prefix removed, with their row counts."""
    return facts.groupBy(strip_type_prefix("factor_name", data_type).alias("factor_name")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
