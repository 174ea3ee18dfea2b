"""Queries that write several tables compute their input once."""

import pytest
from pyspark.sql import functions as F

from paneloom import queries, views
from paneloom.sources import writers as wr


def counted(spark, df, column):
    """``df`` and an accumulator that counts how often its rows are computed."""
    rows = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        rows.add(1)
        return x

    return df.withColumn(column, seen.asNondeterministic()(column)), rows


def test_upsert_computes_its_batch_once(spark, tmp_path):
    df = spark.range(200).selectExpr(
        "date_add(date'2020-11-01', cast(id as int)) AS date", "string(id % 7) AS stock_id", "double(id) AS close"
    )
    path = str(tmp_path / "fact")
    for _ in range(2):  # created, then merged
        batch, rows = counted(spark, df, "close")
        wr.upsert_table(batch, path)
        assert rows.value == 200
    missing = df.withColumn("stock_id", F.when(F.col("close") != 5, F.col("stock_id")))
    with pytest.raises(ValueError):
        wr.upsert_table(missing, path)
    assert spark.read.parquet(path).count() == 200


def test_snapshots_share_their_bars(spark, sf_dir, monkeypatch):
    daily, rows = counted(spark, views.ohlcv_daily(spark, sf_dir), "close")
    monkeypatch.setattr(views, "ohlcv_daily", lambda *_: daily)
    queries.snapshot_scan(spark, sf_dir)
    assert rows.value == views.ohlcv(spark, sf_dir, "day").count() > 0
