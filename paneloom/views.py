"""Panels built from the sales tables, used as inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.operators.panel import wide_to_long


# layouts of the tables read here; naming them spares a schema job per read
LAYOUTS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in LAYOUTS:
        reader = reader.schema(LAYOUTS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _asset() -> "F.Column":
    return F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("asset")


def ohlcv(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """First, highest, lowest and last unit price and volume per supplier and day or month.

    First and last are mergeable aggregates, so the sales are reduced before the shuffle, whatever
    the size of a group.
    """
    line = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]
    if unit == "day":
        date = F.to_date("l_shipdate")
    else:
        date = F.trunc("l_shipdate", unit)
        keys = ["l_shipdate", *keys]
    sales = line.select(
        date.alias("date"),
        "l_suppkey",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("px"),
        F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_quantity")).alias("vol"),
        F.struct(*keys).alias("at"),
    )
    bars = sales.groupBy("date", "l_suppkey").agg(
        F.min_by("px", "at").alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", "at").alias("close"),
        F.sum("vol").alias("volume"),
    )
    return bars.select("date", _asset(), "open", "high", "low", "close", "volume")


def sale_dates(spark: SparkSession, sf_dir: str, unit: str = "day") -> DataFrame:
    """Dates of the panels above, from the date column alone."""
    line = table(spark, sf_dir, "lineitem")
    date = F.to_date("l_shipdate") if unit == "day" else F.trunc("l_shipdate", unit)
    return line.select(date.alias("date"))


def ohlcv_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlcv(spark, sf_dir, "day")


def ohlcv_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlcv(spark, sf_dir, "month")


def _sales_value() -> "F.Column":
    return F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")


def factor_report_wide(spark: SparkSession, sf_dir: str, unit: str = "quarter") -> DataFrame:
    """revenue, units (every seventh value missing) and return_rate per supplier and period."""
    units = F.sum("l_quantity")
    wide = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.trunc("l_shipdate", unit).alias("report_date"), "l_suppkey")
        .agg(
            _sales_value().alias("revenue"),
            F.when(units % 7 != 0, units).alias("units"),
            (
                F.count(F.when(F.col("l_returnflag") == "R", 1)).cast("double")
                / F.count(F.lit(1)).cast("double")
            ).alias("return_rate"),
        )
    )
    return wide.select("report_date", _asset(), "revenue", "units", "return_rate")


def factor_report(spark: SparkSession, sf_dir: str, unit: str = "quarter") -> DataFrame:
    return wide_to_long(factor_report_wide(spark, sf_dir, unit), ["report_date", "asset"])


def monthly_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same factors per month, in the (date, asset, factor_name, value) layout."""
    return factor_report(spark, sf_dir, "month").withColumnRenamed("report_date", "date")


MEASURES = (
    "revenue", "units", "return_rate", "lines", "mean_price", "mean_discount", "mean_tax",
    "largest_line", "smallest_line", "net_revenue", "open_share", "part_spread",
)


def measures(spark: SparkSession, sf_dir: str, unit: str = "year") -> DataFrame:
    """Twelve factors per supplier and period, as (date, asset, factor_name, value)."""
    count = F.count(F.lit(1)).cast("double")

    def total(c: "F.Column") -> "F.Column":
        return F.sum(c.cast("decimal(18,4)")).cast("double")

    def share(c: "F.Column") -> "F.Column":
        return F.count(F.when(c, 1)).cast("double") / count

    price, units = F.col("l_extendedprice"), F.sum("l_quantity")
    wide = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.trunc("l_shipdate", unit).alias("date"), "l_suppkey")
        .agg(
            total(price).alias("revenue"),
            F.when(units % 7 != 0, units).alias("units"),
            share(F.col("l_returnflag") == "R").alias("return_rate"),
            count.alias("lines"),
            (total(price) / count).alias("mean_price"),
            (total(F.col("l_discount")) / count).alias("mean_discount"),
            (total(F.col("l_tax")) / count).alias("mean_tax"),
            F.max(price).alias("largest_line"),
            F.min(price).alias("smallest_line"),
            total(price * (1 - F.col("l_discount"))).alias("net_revenue"),
            share(F.col("l_linestatus") == "O").alias("open_share"),
            (F.max("l_partkey") - F.min("l_partkey")).cast("double").alias("part_spread"),
        )
    )
    return wide_to_long(wide.select("date", _asset(), *MEASURES), ["date", "asset"])


def company_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("S"), key.cast("string")).alias("stock_id"),
            F.col("s_name").alias("company_name"),
            F.date_add(F.lit("1994-06-01").cast("date"), (key * 7).cast("int")).alias("list_date"),
            F.when(key % 11 != 0, F.col("n_name")).alias("industry"),
            F.when(key % 5 == 0, F.lit("otc")).otherwise(F.lit("sii")).alias("market"),
        )
    )


def market_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.trunc("l_shipdate", "month").alias("date"), "l_suppkey")
        .agg(_sales_value().alias("market_value"))
        .select("date", _asset().alias("stock_id"), "market_value")
    )


def index_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.to_date("ts").alias("date"),
            F.concat(F.lit("^"), F.col("event_type")).alias("index_id"),
        )
        .agg(F.max("value").alias("close"))
    )
