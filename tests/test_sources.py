import datetime as dt
import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paneloom import views
from paneloom.operators.calendar import Calendar
from paneloom.operators.panel import clean_ohlcv
from paneloom.plans import build_star_schema
from paneloom.sources import (
    append_table,
    assemble_tickers,
    catalogue_counts,
    dataset_name,
    export_scalars,
    first_available,
    latest_snapshot,
    read_catalogue,
    read_factor,
    read_factors,
    read_price,
    resolve_factors,
    tag_run,
    truncate_table,
    upsert_table,
    write_clustered,
    write_zone,
)


@pytest.fixture(scope="module")
def prices(spark, sf_dir):
    return clean_ohlcv(views.ohlcv_daily(spark, sf_dir).withColumnRenamed("date", "datetime"), True).cache()


def test_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    write_zone(df, f"{tmp_path}/t")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/t").collect())) == [(1, "x"), (2, "y")]
    assert any(".snappy.parquet" in f for f in os.listdir(f"{tmp_path}/t"))


def test_read_price_prunes_and_pushes(spark, tmp_path, prices):
    path = f"{tmp_path}/fact_price"
    write_zone(prices.withColumn("extra", F.lit("x")), path)
    df = read_price(spark, path, "1997-01-01", "1997-12-31")
    assert df.count() == prices.where("year(date) = 1997").count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,1997-01-01)" in plan and "extra" not in plan
    ordered = [(r.date, r.stock_id) for r in read_price(spark, path, "1997-01-01", "1997-02-01", True).collect()]
    assert ordered == sorted(ordered)


def test_read_factor_layouts(spark, tmp_path):
    day = dt.date(2024, 1, 2)
    long = spark.createDataFrame(
        [(day, "A", "f", 1.0), (day, "A", "g", 2.0), (dt.date(2023, 1, 1), "A", "f", 9.0)],
        "date date, stock_id string, factor_name string, value double",
    )
    write_zone(long, f"{tmp_path}/long", ["factor_name"])
    wide = spark.createDataFrame([(day, "A", "note", 3.0, 4.0)], "date date, stock_id string, remark string, f double, h double")
    write_zone(wide, f"{tmp_path}/wide")
    span = ("2024-01-01", "2024-12-31")
    assert read_factor(spark, f"{tmp_path}/long", "f", *span).collect() == [(day, "A", 1.0)]
    plan = read_factor(spark, f"{tmp_path}/long", "f", *span)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(factor_name" in plan
    assert read_factor(spark, f"{tmp_path}/wide", "h", *span).first()["h"] == 4.0
    assert read_factor(spark, f"{tmp_path}/wide", "other", *span).first()["other"] == 3.0
    with pytest.raises(ValueError):
        write_zone(wide.select("date", "stock_id", "remark"), f"{tmp_path}/none")
        read_factor(spark, f"{tmp_path}/none", "f", *span)
    many = {(r.factor_name, r.value) for r in read_factors(spark, f"{tmp_path}/long", ["f", "g"], *span).collect()}
    assert many == {("f", 1.0), ("g", 2.0)}
    many = {(r.factor_name, r.value) for r in read_factors(spark, f"{tmp_path}/wide", ["f", "h", "q"], *span).collect()}
    assert many == {("f", 3.0), ("h", 4.0)}


def test_latest_snapshot(spark, tmp_path):
    root = str(tmp_path)
    assert latest_snapshot(spark, f"{root}/absent") is None
    df = spark.range(1)
    for i, name in enumerate(("fact_price_old", "fact_price_new", "fact_factor_x")):
        df.write.parquet(f"{root}/d{i}/{name}.parquet")
        for base, _, files in os.walk(f"{root}/d{i}"):
            for f in files:
                os.utime(os.path.join(base, f), (1_700_000_000 + i, 1_700_000_000 + i))
    found = latest_snapshot(spark, root)
    assert found.endswith("d1/fact_price_new.parquet")
    assert latest_snapshot(spark, root, "factor").endswith("fact_factor_x.parquet")
    assert latest_snapshot(spark, root, tag="old").endswith("d0/fact_price_old.parquet")
    assert latest_snapshot(spark, root, tag="absent") is None
    assert spark.read.parquet(found).count() == 1
    assert first_available(spark, [None, f"{root}/absent", found]) == found
    assert first_available(spark, [f"{root}/absent"]) is None


def test_upsert_updates_inserts_and_repeats(spark, tmp_path, prices):
    path = f"{tmp_path}/fact_price"
    old = prices.where("year(date) < 1999")
    upsert_table(old, path)
    batch = prices.where("date >= '1998-07-01' and year(date) < 2000").withColumn("close", F.lit(1.0))
    for _ in range(2):
        upsert_table(batch, path)
        now = spark.read.parquet(path)
        assert now.count() == prices.where("year(date) < 2000").count()
        assert now.where("close = 1.0").count() >= batch.count()
        assert now.where("date < '1998-07-01'").select(*prices.columns).exceptAll(old).isEmpty()
    assert {r[0] for r in now.select("year").distinct().collect()} == {1995, 1996, 1997, 1998, 1999}


def test_append_and_truncate(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), None, 1.0)], "date date, note string, v double")
    path = f"{tmp_path}/t"
    truncate_table(df, path, flat=True)
    append_table(df, path, flat=True)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("2024-01-02", "", 1.0)] * 2
    truncate_table(df, path)
    assert spark.read.parquet(path).first().date == dt.date(2024, 1, 2)


def test_export_scalars(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 2), None, "a", [1, 2], {"k": 1}), (None, None, None, None, None)],
        "d date, empty string, s string, l array<int>, m map<string,int>",
    )
    rows = [tuple(r) for r in export_scalars(df).collect()]
    assert rows == [("2024-01-02", "", "a", "[1,2]", '{"k":1}'), ("", "", "", "", "")]
    rows = [tuple(r) for r in export_scalars(df, upsert=True).collect()]
    assert rows == [(dt.date(2024, 1, 2), "", "a", "[1,2]", '{"k":1}'), (None, "", None, None, None)]
    twice = spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("a"), F.lit(3).alias("a"))
    assert export_scalars(twice).columns == ["a", "a_1", "a_2"]


def test_vendor_layout(spark):
    wide = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 1.0, 2.0, 5, None), (dt.datetime(2024, 1, 2), 1.5, 2.5, 6, 9.0)],
        "Date timestamp_ntz, `Open|2330.TW` double, `Close|2330.TW` double, `Volume|2330.TW` int, `Close|2317.TW` double",
    )
    out = assemble_tickers(wide)
    assert out.columns == ["datetime", "asset", "open", "high", "low", "close", "volume"]
    assert {(r.datetime.day, r.asset, r.close) for r in out.collect()} == {
        (1, "2330", 2.0), (2, "2330", 2.5), (1, "2317", None), (2, "2317", 9.0)
    }
    assert assemble_tickers(wide, fields=["Close"]).count() == 3


def test_catalogue(spark, tmp_path):
    path = tmp_path / "factors.json"
    path.write_text(
        json.dumps({"fundamental_features": ["fundamental_features:EBITDA", "ROE稅後"], "price": ["close"]}, indent=2),
        encoding="utf-8",
    )
    names = read_catalogue(spark, str(path))
    assert {(r.factor_type, r.position, r.factor_name) for r in names.collect()} == {
        ("fundamental_features", 1, "EBITDA"), ("fundamental_features", 2, "ROE稅後"), ("price", 1, "close")
    }
    assert {(r.factor_type, r.n_factors) for r in catalogue_counts(names).collect()} == {
        ("fundamental_features", 2), ("price", 1)
    }


def test_dataset_names(spark):
    assert dataset_name("top_{_top_n}", "2020-01-01", "2021-01-01", "2020-01-02", 50) == "top_50_s20200101_e20210101_mv20200102"
    tagged = tag_run(spark.range(1), "2020-01-01", "2021-01-01", "2020-01-02", 50, "value").first()
    assert (tagged.run_start, tagged.mv_date, tagged.top_n, tagged.factor_set) == ("2020-01-01", "2020-01-02", 50, "value")


def test_star_schema(spark, sf_dir, tmp_path):
    inputs = dict(
        raw_prices=views.ohlcv_daily(spark, sf_dir).withColumnRenamed("date", "datetime"),
        companies=views.company_info(spark, sf_dir),
        market_value=views.market_value(spark, sf_dir),
        benchmark=views.index_daily(spark, sf_dir),
        reports=views.factor_report(spark, sf_dir),
    )
    options = dict(
        start="1996-01-01", end="2024-12-31", market_value_dates=["1996-03-10", "1998-03-10"], top_n=3,
        excluded_industries=["NATION_3"], listed_until="1995-10-01", factor_names=["revenue", "units"],
    )
    out = str(tmp_path / "star")
    paths = build_star_schema(out=out, **inputs, **options)
    first = {name: spark.read.parquet(p).count() for name, p in paths.items()}
    assert first["dim_universe"] == 6
    price, universe = spark.read.parquet(paths["fact_price"]), spark.read.parquet(paths["dim_universe"])
    assert price.join(universe, "stock_id", "left_anti").isEmpty()
    assert price.groupBy("date", "stock_id").count().where("count > 1").isEmpty()
    assert first["dim_calendar"] == len(Calendar.of(price).dates)
    factor = spark.read.parquet(paths["fact_factor"])
    assert {r[0] for r in factor.select("factor_name").distinct().collect()} == {"revenue", "units"}
    assert not spark.read.parquet(paths["fact_benchmark_daily"]).isEmpty()
    build_star_schema(out=out, **inputs, **options)
    assert {name: spark.read.parquet(p).count() for name, p in paths.items()} == first
    with pytest.raises(ValueError, match="required"):
        build_star_schema(out=out, **inputs, **{**options, "market_value_dates": []})


def test_checkpoints_go_to_the_configured_folder(spark):
    from paneloom.session import materialise

    folder = spark.conf.get("spark.checkpoint.dir")
    kept = materialise(spark.range(3))
    assert kept.count() == 3
    assert spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(folder)
    assert os.path.isdir(folder)


def test_catalogue_names_are_distinct():
    from paneloom.functions.defaults import FACTOR_CATALOGUE

    assert len(set(FACTOR_CATALOGUE)) == len(FACTOR_CATALOGUE) == 53


def scanned_rows(df):
    """Rows that the scan hands on after pruning by file statistics."""
    execution = df._jdf.queryExecution()
    df.collect()
    leaf = execution.executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_clustered_files_are_pruned(spark, tmp_path, prices):
    clustered, mixed = f"{tmp_path}/clustered", f"{tmp_path}/mixed"
    write_clustered(prices, clustered, files=8)
    prices.repartition(8, F.rand(1)).write.parquet(mixed)
    span = ("1996-03-01", "1996-03-31")
    df = read_price(spark, clustered, *span)
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(date,1996-03-01)" in pushed and "LessThanOrEqual(date,1996-03-31)" in pushed
    everything = prices.count()
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, read_price(spark, mixed, *span).collect()))
    ranges = [
        pq.ParquetFile(f).metadata.row_group(g).column(0).statistics
        for f in glob.glob(f"{clustered}/*.parquet")
        for g in range(pq.ParquetFile(f).metadata.num_row_groups)
    ]
    first, last = dt.date(1996, 3, 1), dt.date(1996, 3, 31)
    assert sum(s.min <= last and s.max >= first for s in ranges) <= 2 < len(ranges)
    assert 0 < scanned_rows(df) < everything / 2
    assert scanned_rows(read_price(spark, mixed, *span)) > everything * 0.9


def test_stored_timestamps_are_compared_as_stored(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame(
        [(dt.datetime(2024, 1, d, 23, 30), "A", float(d)) for d in range(1, 6)], "date timestamp_ntz, stock_id string, f double"
    ).write.parquet(path)
    df = read_factor(spark, path, "f", "2024-01-02", "2024-01-03")
    assert [r.f for r in df.orderBy("f").collect()] == [2.0, 3.0]
    assert "GreaterThanOrEqual(date" in df._jdf.queryExecution().executedPlan().toString()


def test_factors_come_from_the_first_source_that_has_them(spark, tmp_path):
    day, before = dt.date(2024, 1, 2), dt.date(2020, 1, 2)
    kind = "date date, stock_id string, factor_name string, value double"
    first = spark.createDataFrame([(day, "A", "f", 1.0), (day, "B", "f", None), (before, "A", "h", 7.0)], kind)
    second = spark.createDataFrame([(day, "A", "f", -1.0), (day, "A", "g", 2.0), (day, "A", "h", 3.0)], kind)
    write_zone(first, f"{tmp_path}/first", ["factor_name"])
    write_zone(second, f"{tmp_path}/second", ["factor_name"])
    wide = spark.createDataFrame([(day, "A", 4.0, 5.0)], "date date, stock_id string, g double, k double")
    sources = {"none": f"{tmp_path}/none", "first": f"{tmp_path}/first", "second": f"{tmp_path}/second", "wide": wide}
    span = ("2024-01-01", "2024-12-31")
    got = resolve_factors(spark, sources, ["f", "g", "h", "k", "q", "f"], *span)
    assert {(r.factor_name, r.asset, r.value) for r in got.rows.collect()} == {
        ("f", "A", 1.0), ("f", "B", None), ("g", "A", 2.0), ("h", "A", 3.0), ("k", "A", 5.0)
    }
    assert sorted(map(tuple, got.report.collect())) == [
        (0, "f", "first", 2, "found"), (1, "g", "second", 1, "found"), (2, "h", "second", 1, "found"),
        (3, "k", "wide", 1, "found"), (4, "q", None, 0, "missing"),
    ]
    assert got.missing == ("q",)
    # later sources are read for the names still open only, and the last isn't opened at all
    few = resolve_factors(spark, {**sources, "broken": "no-such-scheme://x"}, ["f", "g"], *span)
    plan = few.rows._jdf.queryExecution().executedPlan().toString()
    assert few.missing == () and plan.count("Scan parquet") == 2
    filters = [x.split("]")[0] for x in plan.split("PartitionFilters: ")[1:]]
    assert "= f)" in filters[0] and "= g)" in filters[1] and "f," not in filters[1]
    nothing = resolve_factors(spark, {"none": f"{tmp_path}/none"}, ["f"], *span)
    assert nothing.rows.isEmpty() and nothing.missing == ("f",) and nothing.rows.columns == got.rows.columns


def test_export_for_upsert_scans_once(spark, tmp_path):
    spark.createDataFrame([("a", None, None, 1), (None, None, "c", 2)], "x string, y string, z string, n int").write.parquet(f"{tmp_path}/t")
    out = export_scalars(spark.read.parquet(f"{tmp_path}/t"), upsert=True)
    assert sorted(map(tuple, out.collect()), key=str) == [("a", "", None, 1), (None, "", "c", 2)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedSubquery") == 2  # one run tells for all three text columns
