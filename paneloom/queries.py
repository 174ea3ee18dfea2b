"""Registered queries: every operator over whole tables, named as in the operator inventory."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom import functions as fn
from paneloom import views as v
from paneloom.functions import round_to
from paneloom.functions.defaults import FACTOR_CATALOGUE
from paneloom.operators import calendar as cal
from paneloom.operators import evaluate as ev
from paneloom.operators import panel as pn
from paneloom.operators import pca
from paneloom.operators import portfolio as pf
from paneloom.operators import ranking as rk
from paneloom.operators import universe as un
from paneloom.plans import backtest, etl, reports
from paneloom.session import materialise, scratch_path
from paneloom.sources import readers as rd
from paneloom.sources import writers as wr

Query = Callable[[SparkSession, str], DataFrame]

FACTORS = ["revenue", "units", "return_rate"]
PERIODS = (1, 5, 10)
BUY_N, SELL_N = 20, 20
SCHEDULE_START, SCHEDULE_END = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
OVERRIDES = {
    "1996-Q2": [{"name": "return_rate", "weight": 0.25}, {"name": "revenue", "weight": 0.75}],
    "1997-Q1": [{"name": "return_rate", "weight": 1.0}, {"name": "unknown", "weight": 0.5}],
}


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: round_to(c, digits) for c in columns})


def _significant(df: DataFrame, *columns: str) -> DataFrame:
    """Nine significant digits, for values of any size."""
    def short(c: str):
        return F.when(F.col(c).isNotNull(), F.format_string("%.8e", c)).cast("double") + F.lit(0.0)

    return df.withColumns({c: short(c) for c in columns})


def _raw(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("date", "datetime")


# ------------------------------------------------------------------ sources, cleaning, keys


def clean_ohlcv(spark, sf):
    return pn.clean_ohlcv(_raw(v.ohlcv_daily(spark, sf)), unique=True)


def _stored(spark, df: DataFrame, name: str, by=("date", "stock_id")) -> str:
    """A clustered table of this run."""
    path = scratch_path(spark, name)
    wr.write_clustered(df, path, by)
    return path


def price_scan(spark, sf):
    """The stored price fact, by an interval that its files' statistics prune."""
    path = _stored(spark, clean_ohlcv(spark, sf), "fact_price")
    return rd.read_price(spark, path, "1997-01-01", "1998-12-31")


def _factor_fact(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"report_date": "date", "asset": "stock_id"})


FACTOR_ORDER = ("factor_name", "date", "stock_id")


def factor_scan(spark, sf):
    path = _stored(spark, _factor_fact(v.factor_report(spark, sf)), "fact_factor", FACTOR_ORDER)
    return rd.read_factor(spark, path, "units", "1997-01-01", "1999-12-31")


def factor_scan_wide(spark, sf):
    path = _stored(spark, _factor_fact(v.factor_report_wide(spark, sf)), "fact_factor_wide")
    return rd.read_factor(spark, path, "return_rate", "1997-01-01", "1999-12-31")


def _resolved(spark, sf) -> rd.ResolvedFactors:
    """A local snapshot with two factors, a warehouse table whose units are ten times as large, and
    a path without a table."""
    facts = _factor_fact(v.factor_report(spark, sf))
    local = facts.where(F.col("factor_name").isin("revenue", "units"))
    warehouse = facts.where(F.col("factor_name").isin("units", "return_rate")).withColumn(
        "value", F.col("value") * 10
    )
    sources = {
        "absent": scratch_path(spark, "absent"),
        "local": _stored(spark, local, "local", FACTOR_ORDER),
        "warehouse": _stored(spark, warehouse, "warehouse", FACTOR_ORDER),
    }
    names = ["revenue", "unknown", "units", "return_rate"]
    return rd.resolve_factors(spark, sources, names, "1997-01-01", "1999-12-31")


def factor_sources(spark, sf):
    return _resolved(spark, sf).rows


def factor_sources_report(spark, sf):
    return _resolved(spark, sf).report


def snapshot_scan(spark, sf):
    """The newer of two stored price snapshots with the wanted tag."""
    root = scratch_path(spark, "snapshots")
    # the bars are computed and dealt by asset once, for all three
    daily = _raw(v.ohlcv_daily(spark, sf)).repartition("asset").persist(StorageLevel.DISK_ONLY)
    for tag, share in (("old", 0.5), ("1995_to_2001", 1.0), ("1995_to_2001_again", 2.0)):
        prices = daily.withColumns({c: F.col(c) * share for c in ("open", "high", "low", "close")})
        wr.write_zone(pn.clean_ohlcv(prices, unique=True), f"{root}/fact_price_{tag}")
    daily.unpersist()
    newest = rd.latest_snapshot(spark, root, "price", tag="1995_to_2001")
    return rd.read_price(spark, newest, "1997-01-01", "1997-12-31")


def tagged_runs(spark, sf):
    """One table for all runs: the first replaces, later ones append, run parameters and the factor
    set are partition columns."""
    path = scratch_path(spark, "fact_factor_runs")
    facts = _factor_fact(v.factor_report(spark, sf)).where("factor_name = 'units'")
    keys = ["mv_date", "factor_set"]
    for factor_set, top_n, write in (
        ("stale", 10, wr.truncate_table),
        ("value", 20, wr.truncate_table),
        ("growth", 30, wr.append_table),
    ):
        run = wr.tag_run(facts, "1995-01-01", "2001-12-31", "1998-03-10", top_n, factor_set)
        write(run, path, keys, flat=True)
    return spark.read.parquet(path).withColumn("mv_date", F.col("mv_date").cast("string"))


def export_upsert(spark, sf):
    """Flat columns for a keyed load: a text column without any value becomes empty text."""
    listed = v.company_info(spark, sf).withColumns(
        {"tags": F.array("market", "industry"), "note": F.lit(None).cast("string")}
    )
    return wr.export_scalars(listed, upsert=True)


def upsert_stored(spark, sf):
    """Two keyed upserts into a stored table, with a failed one in between."""
    path = scratch_path(spark, "fact_price_upserted")
    prices = clean_ohlcv(spark, sf).persist(StorageLevel.DISK_ONLY)
    wr.upsert_table(prices.where("year(date) < 1999"), path)
    broken = F.when(F.col("close") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("close"))
    try:
        wr.upsert_table(prices.withColumn("close", broken.cast("double")), path)
    except PySparkException:
        pass  # the table stays as it was
    else:
        raise AssertionError("the failing batch was written")
    batch = prices.where("date >= DATE'1998-06-01' AND year(date) < 2000")
    wr.upsert_table(batch.withColumn("close", F.col("close") * 2), path)
    prices.unpersist()
    return rd.read_price(spark, path, "1995-01-01", "2001-12-31")


STAR_DATES = ["1996-03-10", "1998-03-10"]


def _star(spark, sf, name: str) -> DataFrame:
    paths = etl.build_star_schema(
        _raw(v.ohlcv_daily(spark, sf)),
        v.company_info(spark, sf),
        v.market_value(spark, sf),
        scratch_path(spark, "star"),
        "1995-01-01",
        "2001-12-31",
        STAR_DATES,
        top_n=20,
        excluded_industries=["NATION_3", "NATION_7"],
        listed_until="1995-10-01",
        benchmark=v.index_daily(spark, sf),
        reports=v.factor_report(spark, sf),
        factor_names=["revenue", "units"],
    )
    return spark.read.parquet(paths[name])


def star_universe(spark, sf):
    out = _star(spark, sf, "dim_universe")
    return out.withColumn("mv_date", F.col("mv_date").cast("string"))


def star_prices(spark, sf):
    return _star(spark, sf, "fact_price").drop("year")


def star_benchmark(spark, sf):
    return _star(spark, sf, "fact_benchmark_daily")


def star_factors(spark, sf):
    return _star(spark, sf, "fact_factor").select("date", "stock_id", "factor_name", "value", "factor_set")


def no_factors(spark, sf):
    """An empty stock list and an unknown factor: no rows, but the layout."""
    stocks = universe_topn(spark, sf).select("stock_id")
    days, span = _weekdays(spark, sf), (dt.date(1997, 1, 1), dt.date(1999, 12, 31))
    reports = v.factor_report(spark, sf)
    nobody = cal.factor_daily(reports, ["revenue"], stocks.where("false"), days, *span)
    return nobody.unionByName(cal.factor_daily(reports, ["unknown"], stocks, days, *span))


def factor_wide_to_long(spark, sf):
    return pn.wide_to_long(v.factor_report_wide(spark, sf), ["report_date", "asset"])


def factor_triple(spark, sf):
    wide = v.factor_report_wide(spark, sf).select(
        F.col("report_date").alias("date"), F.col("asset").alias("stock_id"), "units"
    )
    return pn.factor_series(pn.to_factor_triple(wide, "units"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def vendor_assemble(spark, sf):
    daily = v.table(spark, sf, "events").groupBy(F.to_date("ts").alias("Date"))
    wide = daily.agg(
        *[
            agg(F.when(F.col("event_type") == e, F.col("value"))).alias(f"{field}|{e}.TW")
            for e in EVENT_TYPES
            for field, agg in (("High", F.max), ("Low", F.min), ("Volume", F.count))
        ]
    )
    return rd.assemble_tickers(wide, fields=["High", "Low"])


def ingest_fill(spark, sf):
    gappy = _raw(v.ohlcv_daily(spark, sf)).withColumns(
        {
            "close": F.when(F.col("volume") > 0, F.col("close")),
            "volume": F.when(F.col("volume") > 0, F.col("volume")),
        }
    )
    return pn.ingest_fill(gappy)


def fill_both_ways(spark, sf):
    gappy = v.ohlcv_daily(spark, sf).select(
        "date", "asset", F.when(F.col("volume") > 0, F.col("close")).alias("close")
    )
    return pn.fill_both_ways(gappy, ["close"], allow_lookahead=True)


def daily_return(spark, sf):
    return clean_ohlcv(spark, sf).select("date", "stock_id", "daily_return")


def tradability_flags(spark, sf):
    flags = ["is_suspended", "is_limit_up", "is_limit_down"]
    return clean_ohlcv(spark, sf).select("date", "stock_id", *flags)


def benchmark_return(spark, sf):
    return pn.benchmark_returns(v.index_daily(spark, sf))


def _sales(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("stock_id"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        F.col("l_extendedprice").alias("price"),
    )


def dedupe_prices(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "price", "l_quantity"]
    return pn.first_per_key(_sales(spark, sf), ["date", "stock_id"], order)


def duplicate_keys(spark, sf):
    return pn.duplicate_key_count(_sales(spark, sf), ["date", "stock_id"])


def upsert_prices(spark, sf):
    daily = v.ohlcv_daily(spark, sf)
    target = daily.where(F.col("date") < F.lit(dt.date(1999, 1, 1)))
    batch = daily.where(F.col("date") >= F.lit(dt.date(1998, 6, 1))).withColumn(
        "close", F.col("close") * 2
    )
    return pn.merge_upsert(target, batch, ["date", "asset"])


def panel_summary(spark, sf):
    return pn.panel_summary(v.ohlcv_daily(spark, sf), "asset")


def export_scalars(spark, sf):
    listed = v.company_info(spark, sf).withColumn("tags", F.array("market", "industry"))
    return wr.export_scalars(listed)


def symbol_normalize(spark, sf):
    names = v.company_info(spark, sf).select(
        "stock_id", F.concat(F.lit("^"), "company_name").alias("index_id"), "industry", "list_date"
    )
    return names.select(
        "stock_id",
        fn.add_suffix("stock_id").alias("ticker"),
        fn.add_suffix(fn.add_suffix("stock_id")).alias("ticker_again"),
        fn.symbol_root(F.concat("stock_id", F.lit(".TW"))).alias("root"),
        fn.strip_caret("index_id").alias("index_name"),
        fn.strip_type_prefix(F.concat(F.lit("fundamental_features:"), "stock_id")).alias("factor"),
        fn.sanitize_label(F.concat_ws("/", "stock_id", F.lit("a,b\\c"))).alias("label"),
        fn.compact_date("list_date").alias("list_tag"),
        F.size(fn.parse_list(F.concat("stock_id", F.lit(" , ,x,")))).alias("n_items"),
    )


def share_sizes(spark, sf):
    each = pf.cash_per_name(20_000_000.0, 20, 20)
    return v.ohlcv_monthly(spark, sf).select(
        "date", "asset", fn.whole_shares(each, "close").alias("shares")
    )


# ------------------------------------------------------------------ calendar, universe


def trading_calendar(spark, sf):
    return cal.calendar_index(v.ohlcv_daily(spark, sf)).withColumn("is_trading_day", F.lit(1))


def calendar_range(spark, sf):
    return cal.calendar_bounds(v.ohlcv_daily(spark, sf))


def asset_list(spark, sf):
    return v.ohlcv_daily(spark, sf).select("asset").distinct()


def universe_topn(spark, sf):
    return un.build_universe(
        v.company_info(spark, sf),
        v.market_value(spark, sf),
        20,
        ["1998-03-10"],
        ["NATION_3", "NATION_7"],
        "1995-10-01",
    )


ROLLING = ["1996-03-10", "1997-07-01", "1999-12-31", "2001-05-15"]


def universe_rolling(spark, sf):
    return un.build_universe(
        v.company_info(spark, sf), v.market_value(spark, sf), 10, ROLLING, ["NATION_3"]
    )


def asof_dates(spark, sf):
    return cal.as_of_dates(v.market_value(spark, sf), [*ROLLING, None])


def listed_members(spark, sf):
    listed = v.company_info(spark, sf).where(
        un.not_in("industry", ["NATION_3"]) & un.listed_before("1995-10-01")
    )
    return pn.keep_listed(
        v.ohlcv_monthly(spark, sf).withColumnRenamed("asset", "stock_id"), listed, "stock_id"
    )


def _days(spark, sf):
    return v.sale_dates(spark, sf).distinct()


def quarter_of_date(spark, sf):
    return _days(spark, sf).select("date", fn.disclosure_quarter("date").alias("quarter"))


def quarter_windows(spark, sf):
    start, end = fn.disclosure_window("quarter")
    return (
        quarter_of_date(spark, sf)
        .groupBy("quarter")
        .agg(F.count(F.lit(1)).alias("n_days"))
        .select("quarter", "n_days", start.alias("window_start"), end.alias("window_end"))
    )


def quarters_in_range(spark, sf):
    spans = v.ohlcv_daily(spark, sf).groupBy("asset", F.year("date").alias("year")).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )
    return spans.select(
        "asset", "year", F.explode(fn.quarters_overlapping("first_date", "last_date")).alias("quarter")
    )


def _weekdays(spark, sf):
    days = _days(spark, sf).where(~F.dayofweek("date").isin(1, 7))
    return cal.Calendar.of(days)


def factor_asof_daily(spark, sf):
    return cal.extend_factor(v.factor_report(spark, sf), _weekdays(spark, sf))


def factor_asof_strict(spark, sf):
    return cal.extend_factor(v.factor_report(spark, sf), _weekdays(spark, sf), True)


def factor_daily(spark, sf):
    return cal.factor_daily(
        v.factor_report(spark, sf),
        ["revenue", "units"],
        universe_topn(spark, sf).select("stock_id"),
        _weekdays(spark, sf),
        dt.date(1997, 1, 1),
        dt.date(1999, 12, 31),
    )


# ------------------------------------------------------------------ factors, ranks


def _report_factors(spark, sf):
    return v.factor_report(spark, sf).withColumnRenamed("report_date", "date")


def factor_matrix(spark, sf):
    return pn.factor_matrix(_report_factors(spark, sf), FACTORS)


def price_matrix(spark, sf):
    index = v.index_daily(spark, sf).withColumnRenamed("index_id", "asset")
    return pn.price_matrix(index, [f"^{e}" for e in EVENT_TYPES]).toDF("date", *EVENT_TYPES)


def factor_catalog(spark, sf):
    tagged = v.factor_report(spark, sf).withColumn(
        "factor_name", F.concat(F.lit("fundamental_features:"), "factor_name")
    )
    return rd.catalogue_of(tagged)


def factor_counts(spark, sf):
    return pn.factor_counts(v.factor_report(spark, sf), [*FACTORS, "unknown"])


def rank_positive(spark, sf):
    return rk.rank_cross_section(v.ohlcv_monthly(spark, sf), True, "close").select(
        "date", "asset", "close", "rank"
    )


def rank_negative(spark, sf):
    return rk.rank_cross_section(v.ohlcv_monthly(spark, sf), False, "volume").select(
        "date", "asset", "volume", "rank"
    )


def rank_hot_date(spark, sf):
    """Discounts of all order lines, a third of them on one date, some without a date or a value."""
    line = v.table(spark, sf, "lineitem")
    date = (
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("1995-01-01").cast("date"))
        .when(F.col("l_linenumber") != 4, F.trunc(F.to_date("l_shipdate"), "year"))
        .alias("date")
    )
    value = F.when(F.col("l_quantity") == 50, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    rows = line.select(
        "l_orderkey", "l_linenumber", "l_partkey", date, value.alias("value")
    )
    return rk.rank_cross_section(rows).drop("value")


def _ranks(spark, sf):
    return rk.rank_cross_section(_report_factors(spark, sf), keys=("factor_name", "date"))


def rank_missing_zero(spark, sf):
    return _ranks(spark, sf)


def weighted_rank(spark, sf):
    return rk.weighted_rank_of(_ranks(spark, sf), ["revenue", "units"], [0.5, 0.5])


def weighted_rank_lists(spark, sf):
    ranks = _ranks(spark, sf)
    frames = [ranks.where(F.col("factor_name") == f) for f in ("units", "return_rate")]
    return rk.weighted_rank(frames, [0.25, 0.75], positive_corr=False)


def weighted_rank_catalogue(spark, sf):
    """All 792 combinations of five out of twelve factors."""
    ranks = rk.rank_cross_section(v.measures(spark, sf), keys=("factor_name", "date"))
    weights = [0.5, 0.25, 0.125, 0.0625, 0.0625]
    return rk.weighted_rank_combos(ranks, v.MEASURES, 5, weights)


def weighted_rank_combos(spark, sf):
    return rk.weighted_rank_combos(_ranks(spark, sf), FACTORS, 2, [0.75, 0.25])


# ------------------------------------------------------------------ evaluation


def _months(spark, sf):
    return cal.Calendar.of(v.sale_dates(spark, sf, "month"))


def _aligned(spark, sf):
    return ev.align_factor(
        v.monthly_factors(spark, sf),
        v.ohlcv_monthly(spark, sf),
        PERIODS,
        calendar=_months(spark, sf),
    )


def _clean(spark, sf):
    return ev.clean_factor(_aligned(spark, sf), None)


def forward_returns(spark, sf):
    return _rounded(
        ev.forward_returns_long(v.ohlcv_monthly(spark, sf), PERIODS, _months(spark, sf)),
        9,
        "forward_return",
    )


def quantile_buckets(spark, sf):
    return ev.quantile_buckets(v.monthly_factors(spark, sf))


def clean_factor_rows(spark, sf):
    rows = _clean(spark, sf).select("factor_name", "date", "asset", "bucket", *[ev.fwd(p) for p in PERIODS])
    return _rounded(rows, 9, *[ev.fwd(p) for p in PERIODS])


def loss_gate(spark, sf):
    return _rounded(ev.loss_gate(_aligned(spark, sf), 0.1225), 9, "loss")


def clean_factor_gated(spark, sf):
    kept = ev.clean_factor(materialise(_aligned(spark, sf)), 0.1225)
    return _rounded(kept, 9, *[ev.fwd(p) for p in PERIODS])


def quantile_stats(spark, sf):
    return _rounded(ev.quantile_stats(_clean(spark, sf)), 6, "min", "max", "mean", "std", "share")


def quantile_returns(spark, sf, demeaned=False):
    moments = ev.bucket_moments(_clean(spark, sf), PERIODS)
    return _rounded(ev.quantile_returns(moments, demeaned), 6, "mean_return", "std_error")


def quantile_returns_by_date(spark, sf):
    moments = ev.bucket_moments(_clean(spark, sf), PERIODS)
    return _rounded(
        ev.quantile_returns_by_date(moments, demeaned=True), 6, "mean_return", "std_error"
    )


def quantile_spread(spark, sf):
    moments = ev.bucket_moments(_clean(spark, sf), PERIODS)
    return _rounded(ev.quantile_spread(moments), 6, "spread", "std_error")


def factor_portfolio_return(spark, sf):
    daily = ev.factor_returns(_clean(spark, sf), PERIODS)
    return _rounded(daily, 6, "factor_return", "universe_return")


def cumulative_return(spark, sf):
    out = ev.cumulative_return(ev.factor_returns(_clean(spark, sf), PERIODS))
    return _significant(out, "cumulative_return").select(
        "factor_name", "period", "date", "cumulative_return"
    )


def factor_alpha_beta(spark, sf):
    fit = ev.factor_alpha_beta(ev.factor_returns(_clean(spark, sf), PERIODS))
    return _significant(_rounded(fit, 6, "alpha", "beta"), "annual_alpha")


def ic_daily(spark, sf):
    return _rounded(ev.ic_daily(_clean(spark, sf), PERIODS), 8, "ic")


def ic_summary(spark, sf):
    stats = ev.ic_summary(ev.ic_daily(_clean(spark, sf), PERIODS))
    return _rounded(
        stats, 6, "ic_mean", "ic_std", "ic_skew", "ic_kurtosis", "risk_adjusted_ic", "t_stat"
    )


def ic_monthly(spark, sf):
    return _rounded(ev.ic_monthly(ev.ic_daily(_clean(spark, sf), PERIODS)), 8, "ic_mean")


def bucket_turnover(spark, sf):
    return _rounded(ev.bucket_turnover(_clean(spark, sf), PERIODS), 9, "turnover")


def rank_autocorr(spark, sf):
    return _rounded(ev.rank_autocorrelation(_clean(spark, sf), PERIODS), 8, "autocorrelation")


def _matrix(spark, sf, names):
    return pn.factor_matrix(v.monthly_factors(spark, sf), names)


def factor_zscores(spark, sf):
    return _rounded(pca.standardise(_matrix(spark, sf, FACTORS), FACTORS), 6, *FACTORS)


def factor_covariance(spark, sf):
    """Covariances of the standardised factors, that is their correlations."""
    z = pca.standardise(_matrix(spark, sf, FACTORS), FACTORS)
    return _rounded(pca.covariance_table(z, FACTORS), 8, "covariance")


def pca_scores(spark, sf):
    names = ["revenue", "return_rate"]
    matrix = _matrix(spark, sf, names)
    return _rounded(
        pca.component_scores(matrix, pca.fit_components(matrix, names, 2)), 6, "PC1", "PC2"
    )


def pca_components(spark, sf):
    """Scores of the second component of all three factors, in factor form."""
    matrix = _matrix(spark, sf, FACTORS)
    fitted = pca.fit_components(matrix, FACTORS)
    scores = pca.component_scores(matrix, fitted)
    return _rounded(pca.select_components(scores, len(fitted.columns), [2, 4]), 6, "value")


HEADLINE = ("ic_mean", "ic_std", "mean_spread", "alpha", "beta")


def factor_study(spark, sf):
    tables = reports.factor_report(
        v.monthly_factors(spark, sf), v.ohlcv_monthly(spark, sf), factor_names=FACTORS
    )
    return _rounded(reports.report_headline(tables), 6, *HEADLINE)


def factor_study_default(spark, sf):
    """Without names the study takes the factors of the catalogue and leaves others out."""
    names = dict(zip(FACTORS, ["EBITDA", FACTOR_CATALOGUE[-1]]))
    of = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("factor_name"))
    factors = v.monthly_factors(spark, sf).withColumn("factor_name", F.coalesce(of, "factor_name"))
    tables = reports.factor_report(factors, v.ohlcv_monthly(spark, sf))
    return _rounded(reports.report_headline(tables), 6, *HEADLINE)


def combo_study(spark, sf):
    tables = reports.combo_report(
        v.monthly_factors(spark, sf), v.ohlcv_monthly(spark, sf), FACTORS, 2, [0.75, 0.25]
    )
    return _rounded(reports.report_headline(tables), 6, *HEADLINE)


def component_study(spark, sf):
    tables = reports.component_report(
        v.monthly_factors(spark, sf), v.ohlcv_monthly(spark, sf), FACTORS, 3, [1, 2]
    )
    return _rounded(reports.report_headline(tables), 6, *HEADLINE)


# ------------------------------------------------------------------ portfolio


def _schedule():
    return pf.quarter_schedule(
        SCHEDULE_START, SCHEDULE_END, ["revenue", "units"], None, OVERRIDES
    )


def quarter_schedule_rank(spark, sf):
    return pf.scheduled_rank(pf.fill_and_rank(v.monthly_factors(spark, sf)), _schedule())


def price_rank_merge(spark, sf):
    return pf.merge_prices_and_ranks(
        v.ohlcv_monthly(spark, sf), quarter_schedule_rank(spark, sf)
    )


def _panel(spark, sf):
    merged = pf.merge_prices_and_ranks(
        v.ohlcv_monthly(spark, sf), quarter_schedule_rank(spark, sf)
    )
    return pf.align_panel(merged, _months(spark, sf))


def aligned_panel(spark, sf):
    return _panel(spark, sf)


def aligned_panel_lookahead(spark, sf):
    merged = pf.merge_prices_and_ranks(
        v.ohlcv_monthly(spark, sf), quarter_schedule_rank(spark, sf)
    )
    return pf.with_no_signal(pf.align_panel(merged, base="first_asset", allow_lookahead=True))


def long_short_signals(spark, sf):
    return pf.long_short_signals(_panel(spark, sf), BUY_N, SELL_N).select(
        "date", "asset", "side", "position", "rank"
    )


def _held(spark, sf):
    signals = pf.long_short_signals(_panel(spark, sf), BUY_N, SELL_N)
    return pf.holdings(signals, buy_n=BUY_N, sell_n=SELL_N)


def holdings(spark, sf):
    return _held(spark, sf).select("date", "asset", "side", "size")


def trade_orders(spark, sf):
    return pf.trade_orders(_held(spark, sf))


def trade_ledger(spark, sf):
    return pf.trade_ledger(_held(spark, sf))


def _equity(spark, sf):
    held = materialise(_held(spark, sf))
    return pf.equity_curve(_months(spark, sf), held, pf.trade_ledger(held))


def equity_curve(spark, sf):
    return _rounded(
        _rounded(_equity(spark, sf), 2, "cash", "position_value", "equity"), 6, "daily_return"
    )


def backtest_equity(spark, sf):
    """The whole portfolio pipeline on prices and factors."""
    tables = backtest.run_backtest(
        v.ohlcv_monthly(spark, sf),
        v.monthly_factors(spark, sf),
        ["revenue", "units"],
        SCHEDULE_START,
        SCHEDULE_END,
        quarterly=OVERRIDES,
        buy_n=BUY_N,
        sell_n=SELL_N,
    )
    equity = _rounded(tables["equity"], 2, "cash", "position_value", "equity")
    return _rounded(equity, 6, "daily_return")


def performance_summary(spark, sf):
    out = pf.performance_summary(_equity(spark, sf), periods_per_year=12)
    return _rounded(out, 6, *[c for c in out.columns if c != "n_days"])


def monthly_returns(spark, sf):
    return _rounded(pf.periodic_returns(_equity(spark, sf)), 6, "period_return")


def yearly_returns(spark, sf):
    return _rounded(pf.periodic_returns(_equity(spark, sf), "year"), 4, "period_return")


def drawdowns(spark, sf):
    return _rounded(pf.worst_drawdowns(_equity(spark, sf)), 6, "depth")


def _market(spark, sf):
    """Daily sales total as an index: positive, so every ratio is defined."""
    sales = v.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("date"))
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    index = sales.agg(total.alias("close")).withColumn("index_id", F.lit("^SALES"))
    return pn.benchmark_returns(index)


def benchmark_performance(spark, sf):
    out = pf.performance_summary(_market(spark, sf))
    return _rounded(out, 5, *[c for c in out.columns if c != "n_days"])


def benchmark_monthly(spark, sf):
    return _rounded(pf.periodic_returns(_market(spark, sf)), 6, "period_return")


def benchmark_drawdowns(spark, sf):
    return _rounded(pf.worst_drawdowns(_market(spark, sf)), 6, "depth")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        price_scan,
        factor_scan,
        factor_scan_wide,
        factor_sources,
        factor_sources_report,
        snapshot_scan,
        tagged_runs,
        export_upsert,
        upsert_stored,
        star_universe,
        star_prices,
        star_benchmark,
        star_factors,
        no_factors,
        factor_wide_to_long,
        factor_triple,
        vendor_assemble,
        ingest_fill,
        fill_both_ways,
        clean_ohlcv,
        daily_return,
        tradability_flags,
        benchmark_return,
        dedupe_prices,
        duplicate_keys,
        upsert_prices,
        panel_summary,
        export_scalars,
        symbol_normalize,
        share_sizes,
        trading_calendar,
        calendar_range,
        asset_list,
        universe_topn,
        universe_rolling,
        asof_dates,
        listed_members,
        quarter_of_date,
        quarter_windows,
        quarters_in_range,
        factor_asof_daily,
        factor_asof_strict,
        factor_daily,
        factor_matrix,
        price_matrix,
        factor_catalog,
        factor_counts,
        rank_positive,
        rank_negative,
        rank_missing_zero,
        rank_hot_date,
        weighted_rank,
        weighted_rank_lists,
        weighted_rank_combos,
        weighted_rank_catalogue,
        forward_returns,
        quantile_buckets,
        clean_factor_rows,
        loss_gate,
        clean_factor_gated,
        quantile_stats,
        quantile_returns,
        quantile_returns_by_date,
        quantile_spread,
        factor_portfolio_return,
        cumulative_return,
        factor_alpha_beta,
        ic_daily,
        ic_summary,
        ic_monthly,
        bucket_turnover,
        rank_autocorr,
        factor_zscores,
        factor_covariance,
        pca_scores,
        pca_components,
        factor_study,
        factor_study_default,
        combo_study,
        component_study,
        quarter_schedule_rank,
        price_rank_merge,
        aligned_panel,
        aligned_panel_lookahead,
        long_short_signals,
        holdings,
        trade_orders,
        trade_ledger,
        equity_curve,
        backtest_equity,
        performance_summary,
        monthly_returns,
        yearly_returns,
        drawdowns,
        benchmark_performance,
        benchmark_monthly,
        benchmark_drawdowns,
    )
}
QUERIES["quantile_returns_demeaned"] = partial(quantile_returns, demeaned=True)
