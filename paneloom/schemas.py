"""Fixed table layouts. Column order is part of the contract."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_COLUMNS = ("open", "high", "low", "close")

RAW_PRICE = T.StructType(
    [
        T.StructField("datetime", T.DateType()),
        T.StructField("asset", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in (*PRICE_COLUMNS, "volume")],
    ]
)

FACT_PRICE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("stock_id", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in (*PRICE_COLUMNS, "volume")],
        T.StructField("daily_return", T.FloatType()),
        *[
            T.StructField(c, T.IntegerType())
            for c in ("is_suspended", "is_limit_up", "is_limit_down")
        ],
    ]
)

FACT_FACTOR_DDL = "date date, stock_id string, factor_name string, value double"

DIM_UNIVERSE_COLUMNS = (
    "stock_id",
    "company_name",
    "list_date",
    "industry",
    "market",
    "market_value",
    "market_value_date",
    "rank",
    "top_n",
    "delist_date",
)

BENCHMARK_COLUMNS = ("date", "index_id", "close", "daily_return")
