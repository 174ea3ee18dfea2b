import datetime as dt
import re
import random
from itertools import combinations
from math import comb

import pytest
from pyspark.sql import functions as F

from paneloom import views
from paneloom.operators import calendar as cal
from paneloom.operators import panel, ranking, universe
from paneloom.schemas import FACT_PRICE

RAW = "datetime string, asset string, open string, high string, low string, close string, volume string"


def day(n, month=1):
    return dt.date(2024, month, n)


def test_clean_ohlcv_basic(spark):
    raw = spark.createDataFrame(
        [
            ("2024-01-01", "2330", "100", "101", "99", "100", "1000"),
            ("2024-01-02", "2330", None, None, None, None, None),
            ("2024-01-01", "2317", "50", "51", "49", "bad", "500"),
            ("2024-01-02", "2317", "50", "50", "50", "50", "0"),
            ("2024-01-03", "2317", "55", "55", "55", "55", None),
            ("2024-01-04", "2317", "55", "55", "55", "55", "0"),
            ("2024-01-05", "2317", "40", "40", "40", "40", "0"),
        ],
        RAW,
    )
    out = panel.clean_ohlcv(raw)
    assert out.columns == FACT_PRICE.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in FACT_PRICE]
    rows = {(r.stock_id, r.date.day): r for r in out.collect()}
    assert len(rows) == 6 and ("2317", 1) not in rows
    carried = rows["2330", 2]
    assert (carried.close, carried.open, carried.volume, carried.daily_return) == (100, 100, 0, 0)
    # volume 0 at one price: the open/high/low carried here differ from one another
    assert carried.is_suspended == 0
    assert rows["2317", 2].daily_return is None and rows["2317", 2].is_suspended == 0
    assert rows["2317", 3].is_limit_up == 1
    assert rows["2317", 3].daily_return == pytest.approx(0.1, rel=1e-6)
    assert rows["2317", 4].is_suspended == 1
    assert rows["2317", 5].is_limit_down == 1


def test_zero_close_gives_null_return(spark):
    raw = spark.createDataFrame(
        [("2024-01-01", "A", "0", "0", "0", "0", "1"), ("2024-01-02", "A", "1", "1", "1", "1", "1")], RAW
    )
    rows = panel.clean_ohlcv(raw).orderBy("date").collect()
    assert rows[1].daily_return is None


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 3.0), (2, "c", 1.0)], "k int, s string, v double")
    kept = {r.k: (r.s, r.v) for r in panel.first_per_key(df, ["k"]).collect()}
    assert kept == {1: ("a", 3.0), 2: ("c", 1.0)}
    assert panel.first_per_key(df, ["k"], ["v"]).where("k = 1").first().s == "b"
    assert panel.duplicate_key_count(df, ["k"]).first()[0] == 1
    with pytest.raises(Exception, match="duplicate key"):
        panel.require_unique(df, ["k"]).collect()
    assert panel.require_unique(df, ["k", "s"]).count() == 3


def test_fills(spark):
    df = spark.createDataFrame(
        [("A", day(1), None, 1.0), ("A", day(2), 5.0, None), ("A", day(3), None, 3.0), ("B", day(1), None, None)],
        "asset string, date date, x double, y double",
    )
    got = {(r.asset, r.date.day): (r.x, r.y) for r in panel.forward_fill(df, ["x", "y"]).collect()}
    assert got == {("A", 1): (None, 1.0), ("A", 2): (5.0, 1.0), ("A", 3): (5.0, 3.0), ("B", 1): (None, None)}
    both = panel.fill_both_ways(df, ["x"], allow_lookahead=True)
    assert {(r.asset, r.date.day): r.x for r in both.collect()}["A", 1] == 5.0
    plain = panel.fill_both_ways(df, ["x"])
    assert {(r.asset, r.date.day): r.x for r in plain.collect()}["A", 1] is None


def test_factor_triple_layouts(spark):
    triple = spark.createDataFrame([("2024-01-01", "A", 1.0)], "datetime string, asset string, value double")
    named = triple.withColumnRenamed("value", "EBITDA")
    facts = named.withColumnsRenamed({"datetime": "date", "asset": "stock_id"})
    for df in (triple, named, facts):
        out = panel.to_factor_triple(df, "EBITDA")
        assert out.columns == ["datetime", "asset", "value"] and out.first().value == 1.0
    with pytest.raises(ValueError):
        panel.to_factor_triple(facts.drop("EBITDA"), "EBITDA")


def test_factor_series_drops_missing(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 13), 2330, 1.0), (dt.datetime(2024, 1, 2), 2330, float("nan"))],
        "datetime timestamp_ntz, asset int, value double",
    )
    rows = panel.factor_series(df).collect()
    assert [(r.date, r.asset, r.value) for r in rows] == [(day(1), "2330", 1.0)]


def test_matrix_averages_and_drops_incomplete(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [(day(1), "A", "x", 1.0), (day(1), "A", "x", 3.0), (day(1), "A", "y", 5.0), (day(1), "B", "x", 1.0),
         (day(1), "C", "x", inf), (day(1), "C", "y", 2.0)],
        "date date, asset string, factor_name string, value double",
    )
    rows = panel.factor_matrix(df, ["x", "y"]).collect()
    assert [(r.asset, r.x, r.y) for r in rows] == [("A", 2.0, 5.0)]
    assert panel.factor_matrix(df, ["x", "y"], complete=False).count() == 3


def test_factor_counts_and_gate(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", None), ("y", None)], "factor_name string, value double")
    got = {r.factor_name: r.n_values for r in panel.factor_counts(df, ["y", "x", "z"]).collect()}
    assert got == {"x": 1, "y": 0, "z": 0}
    assert panel.available_factors(df, ["y", "x", "z"]) == ["x"]
    with pytest.raises(ValueError):
        panel.available_factors(df, ["y"])


def test_keep_listed_falls_back_to_all(spark):
    df = spark.createDataFrame([("A",), ("B",)], "asset string")
    listed = lambda *names: spark.createDataFrame([(n,) for n in names], "asset string")
    assert panel.keep_listed(df, listed("A", "Z"), "asset").count() == 1
    assert panel.keep_listed(df, listed("Z"), "asset").count() == 2
    assert panel.keep_listed(df, listed("Z"), "asset", keep_all_if_empty=False).count() == 0


def test_benchmark(spark):
    df = spark.createDataFrame(
        [(day(1), "^TWII", 100.0), (day(2), "^TWII", 101.0), (day(3), "^TWII", None), (day(4), "^TWII", 202.0)],
        "date date, index_id string, close double",
    )
    rows = panel.benchmark_returns(df).orderBy("date").collect()
    assert {r.index_id for r in rows} == {"TWII"}
    assert [r.daily_return for r in rows] == [None, pytest.approx(0.01), 0.0, pytest.approx(1.0)]


# ------------------------------------------------------------------ calendar


REPORTS = "report_date date, asset string, factor_name string, value double"


def calendar(*days):
    return cal.Calendar(tuple(days))


def test_sparse_factor_is_carried(spark):
    reports = spark.createDataFrame(
        [(day(1), "2330", "f", 1.0), (day(10), "2330", "f", 2.0), (day(1), "2317", "f", None), (day(10), "2317", "f", 7.0)],
        REPORTS,
    )
    days = calendar(day(2), day(5), day(10), day(11))
    got = {(r.asset, r.date.day): r.value for r in cal.extend_factor(reports, days).collect()}
    assert got == {
        ("2330", 2): 1.0, ("2330", 5): 1.0, ("2330", 10): 2.0, ("2330", 11): 2.0,
        ("2317", 2): None, ("2317", 5): None, ("2317", 10): 7.0, ("2317", 11): 7.0,
    }


def test_report_days_off_the_calendar(spark):
    reports = spark.createDataFrame(
        [(day(6), "A", "f", 1.0), (day(20), "A", "f", 9.0), (day(2), "A", "g", 5.0), (day(7), "A", "g", None)], REPORTS
    )
    days = calendar(day(5), day(8))
    loose = cal.extend_factor(reports, days).collect()
    got = {(r.factor_name, r.date.day): r.value for r in loose}
    assert got == {("f", 5): None, ("f", 6): 1.0, ("f", 8): 1.0, ("g", 5): 5.0, ("g", 7): 5.0, ("g", 8): 5.0}
    strict = cal.extend_factor(reports, days, strict_calendar=True).collect()
    assert {(r.factor_name, r.date.day) for r in strict} == {("f", 5), ("f", 8), ("g", 5), ("g", 8)}


def test_carry_forward_modes(spark):
    df = spark.createDataFrame(
        [("A", day(3), 1.0, None), ("A", day(5), None, 4.0), ("B", day(9), 2.0, 2.0)],
        "asset string, date date, x double, y double",
    )
    days = calendar(day(2), day(3), day(4), day(6))
    run = lambda mode: {
        (r.asset, r.date.day): (r.x, r.y) for r in cal.carry_forward(df, days, ["x", "y"], leading=mode).collect()
    }
    held = {("A", 3): (1.0, None), ("A", 4): (1.0, None), ("A", 6): (1.0, 4.0)}
    assert run("drop") == held
    empty = {("B", d): (None, None) for d in (2, 3, 4, 6)}
    assert run("null") == {**held, ("A", 2): (None, None), **empty}
    assert run("backfill")["A", 2] == (1.0, None) and run("backfill")["B", 6] == (2.0, 2.0)


def test_factor_daily(spark):
    reports = spark.createDataFrame(
        [(day(1), "A", "f", 1.0), (day(1), "B", "f", 2.0), (day(1), "C", "g", 3.0), (day(1), "C", "h", 3.0)], REPORTS
    )
    stocks = spark.createDataFrame([("A",)], "stock_id string")
    days = calendar(day(1), day(2), day(3))
    out = cal.factor_daily(reports, ["f", "g"], stocks, days, day(2), day(3))
    got = {(r.date.day, r.stock_id, r.factor_name, r.value) for r in out.collect()}
    # g covers no listed stock and keeps its own
    assert got == {(d, s, n, x) for d in (2, 3) for s, n, x in (("A", "f", 1.0), ("C", "g", 3.0))}
    nothing = cal.factor_daily(reports, [], stocks, days, day(2), day(3))
    assert nothing.columns == ["date", "stock_id", "factor_name", "value"] and nothing.count() == 0


def test_as_of_dates(spark):
    df = spark.createDataFrame([(day(1),), (day(1, 2),)], "date date")
    got = cal.as_of_dates(df, ["2024-01-31", "2024-02-01", None]).collect()
    assert [r.as_of for r in got] == [day(1), day(1, 2), day(1, 2)]
    with pytest.raises(Exception, match="no data on or before 2023-01-01"):
        cal.as_of_dates(df, ["2023-01-01"]).collect()


# ------------------------------------------------------------------ universe


@pytest.fixture
def companies(spark):
    return spark.createDataFrame(
        [("2330", "A", dt.date(2000, 1, 1), "chips", "sii"), ("2317", "B", dt.date(2010, 1, 1), None, "sii"),
         ("2603", "C", dt.date(2015, 1, 1), "ships", "sii"), ("9999", "D", dt.date(2001, 1, 1), "chips", "otc")],
        "stock_id string, company_name string, list_date date, industry string, market string",
    )


@pytest.fixture
def values(spark):
    return spark.createDataFrame(
        [(day(1), "2330", 10.0), (day(1), "2317", 20.0), (day(1), "2603", 5.0),
         (day(1, 2), "2330", 30.0), (day(1, 2), "2317", 5.0), (day(1, 2), "2603", 40.0), (day(1, 2), "9999", 99.0)],
        "date date, stock_id string, market_value double",
    )


def test_universe(companies, values):
    out = universe.build_universe(companies, values, 2, ["2024-02-15"], ["ships"], "2018-01-01")
    rows = out.orderBy("rank").collect()
    assert [(r.stock_id, r["rank"], r.market_value_date) for r in rows] == [
        ("2330", 1, "2024-02-01"), ("2317", 2, "2024-02-01")
    ]
    assert rows[0].list_date == "2000-01-01" and rows[0].delist_date is None and rows[0].top_n == 2
    with pytest.raises(ValueError):
        universe.build_universe(companies, values, None)


def test_universe_without_cutoff_keeps_all_markets(companies, values):
    assert universe.build_universe(companies, values, 1).first().stock_id == "9999"


def test_rolling_universe(companies, values):
    out = universe.build_universe(companies, values, 1, ["2024-01-05", "2024-02-05"], (), "2018-01-01")
    got = {str(r.target_date): r.stock_id for r in out.collect()}
    assert got == {"2024-01-05": "2317", "2024-02-05": "2603"}


def test_universe_reads_values_once_and_carries_them_to_later_targets(companies, values):
    asked = ["2024-03-01", None, "2024-01-10", "2024-01-05"]
    out = universe.build_universe(companies, values, 1, asked, ["ships"], "2018-01-01")
    got = {(str(r.target_date), r.market_value_date, r.stock_id, r["rank"]) for r in out.collect()}
    assert got == {
        ("2024-01-05", "2024-01-01", "2317", 1), ("2024-01-10", "2024-01-01", "2317", 1),
        ("2024-03-01", "2024-02-01", "2330", 1), ("2024-02-01", "2024-02-01", "2330", 1),
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2  # companies and values


@pytest.mark.parametrize("empty", [False, True])
def test_universe_before_all_values_is_an_error(companies, values, empty):
    values = values.where("stock_id = 'none'") if empty else values
    with pytest.raises(Exception, match="no data on or before 2023-01-01"):
        universe.build_universe(companies, values, 1, ["2023-01-01"]).collect()


def test_universe_with_nobody_eligible_on_the_latest_date(companies, values):
    late = values.unionByName(values.limit(1).selectExpr("date'2024-05-01' AS date", "'nobody' AS stock_id", "1.0D AS market_value"))
    assert universe.build_universe(companies, late, 2, ["2024-06-01"]).collect() == []


# ------------------------------------------------------------------ ranks


def ranks_of(df, column="rank"):
    return {(r.date, r.asset): r[column] for r in df.collect()}


def test_rank_directions(spark):
    df = spark.createDataFrame(
        [("d", "A", 30.0), ("d", "B", 10.0), ("d", "C", 20.0), ("e", "A", 1.0), ("e", "B", 2.0)],
        "date string, asset string, value double",
    )
    up = ranks_of(ranking.rank_cross_section(df, True))
    down = ranks_of(ranking.rank_cross_section(df, False))
    assert (up["d", "B"], up["d", "C"], up["d", "A"]) == (1, 2, 3)
    assert (down["d", "A"], down["d", "C"], down["d", "B"]) == (1, 2, 3)
    assert (up["e", "A"], up["e", "B"]) == (1, 2)
    assert all(up[k] + down[k] == (4 if k[0] == "d" else 3) for k in up)


def test_missing_ranks_zero(spark):
    df = spark.createDataFrame(
        [("d", "A", float("nan")), ("d", "B", None), ("d", "C", 2.0), ("d", "D", 2.0)],
        "date string, asset string, value double",
    )
    assert ranks_of(ranking.rank_cross_section(df)) == {
        ("d", "A"): 0, ("d", "B"): 0, ("d", "C"): 1.5, ("d", "D"): 1.5
    }


def ranked(spark, *rows):
    return spark.createDataFrame([("d", a, float(x)) for a, x in rows], "date string, asset string, rank double")


def test_weighted_rank(spark):
    single = ranked(spark, ("A", 1), ("B", 2))
    out = ranking.weighted_rank([single], [1.0])
    assert out.columns == ["date", "asset", "weighted_rank"]
    assert ranks_of(out, "weighted_rank") == {("d", "A"): 1, ("d", "B"): 2}
    with pytest.raises(ValueError):
        ranking.weighted_rank([single], [0.5, 0.5])
    a = ranked(spark, ("A", 1), ("B", 2), ("C", 3))
    b = ranked(spark, ("A", 3), ("B", 2), ("C", 1))
    tied = ranking.weighted_rank([a, b], [0.5, 0.5])
    assert set(ranks_of(tied, "weighted_rank").values()) == {2.0}
    partial = ranking.weighted_rank([a, single], [0.5, 0.5])
    assert set(ranks_of(partial, "weighted_rank")) == {("d", "A"), ("d", "B")}


def test_negative_direction_is_applied_twice(spark):
    df = spark.createDataFrame(
        [("d", "A", 30.0), ("d", "B", 10.0), ("d", "C", 20.0)], "date string, asset string, value double"
    )
    first = ranking.rank_cross_section(df, False)
    final = ranks_of(ranking.weighted_rank([first], [1.0], positive_corr=False), "weighted_rank")
    assert (final["d", "A"], final["d", "B"], final["d", "C"]) == (3, 1, 2)


@pytest.mark.parametrize("n, k", [(3, 2), (2, 5), (1, 1), (7, 1), (7, 7), (9, 4), (12, 5)])
def test_combination_numbers(spark, n, k):
    """Unranked combinations are those of itertools, in its order."""
    names = [f"f{i}" for i in range(n)]
    rows = ranking.combo_table(spark, names, k).orderBy("combo_id").collect()
    want = list(combinations(range(n), min(k, n)))
    assert [(r.combo_id, [p - 1 for p in r.positions]) for r in rows] == [(i, list(c)) for i, c in enumerate(want)]
    assert [r.combo for r in rows] == ["_".join(names[p] for p in c) for c in want]


def test_combinations_far_beyond_memory(spark):
    """The last of C(53, 5) and C(60, 30) combinations, without making the others."""
    first, last = [
        spark.range(1).select(ranking.combo_positions(F.lit(i), 53, 5)).first()[0]
        for i in (0, 2_869_684)
    ]
    assert first == [0, 1, 2, 3, 4] and last == [48, 49, 50, 51, 52]
    middle = 10**17
    p = spark.range(1).select(ranking.combo_positions(F.lit(middle), 60, 30)).first()[0]
    assert p == sorted(set(p)) and sum(comb(59 - x, 30 - i) for i, x in enumerate(p)) == comb(60, 30) - 1 - middle
    with pytest.raises(ValueError, match="64 bits"):
        ranking.combo_table(spark, ["x"] * 100, 50)
    with pytest.raises(ValueError):
        ranking.combo_table(spark, [], 2)


def test_combinations_of_the_catalogue(spark):
    """Rows of a window of C(53, 5) combinations equal those computed one by one."""
    n, k, first, stop = 53, 5, 1_234_000, 1_234_060
    rng = random.Random(1)
    long = spark.createDataFrame(
        [("d", f"a{j}", f"f{i}", None if rng.random() < 0.02 else float(rng.randrange(9))) for j in range(6) for i in range(n)],
        "date string, asset string, factor_name string, rank double",
    )
    values = {(r.asset, r.factor_name): r["rank"] for r in long.collect()}
    out = ranking.weighted_rank_combos(long, [f"f{i}" for i in range(n)], k, ids=(first, stop)).collect()
    positions = spark.range(first, stop).select("id", ranking.combo_positions(F.col("id"), n, k).alias("p"))
    want = {}
    for i, p in map(tuple, positions.collect()):
        sums = {}
        for j in range(6):
            terms = [values[f"a{j}", f"f{x}"] for x in p]
            if None not in terms:
                total = 0.0
                for t in terms:
                    total = total + t * 0.2 if total else t * 0.2
                sums[f"a{j}"] = total
        for a, s in sums.items():
            lower, equal = sum(x < s for x in sums.values()), sum(x == s for x in sums.values())
            want[i, "_".join(f"f{x}" for x in p), a] = lower + (equal + 1) / 2
    assert {(r.combo_id, r.combo, r.asset): r.weighted_rank for r in out} == want


def test_combinations_are_not_shuffled_whole(spark, sf_dir):
    """The exchange before ranking carries rows of two factors' beginnings, not combinations."""
    ranks = ranking.rank_cross_section(views.measures(spark, sf_dir), keys=("factor_name", "date"))
    df = ranking.weighted_rank_combos(ranks, views.MEASURES, 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    above, _, _ = plan.partition("Exchange hashpartitioning(_p0")
    assert "Window" in above and "Exchange" not in above
    assert df.groupBy("date", "asset").count().select("count").distinct().collect() == [(792,)]


def test_combos(spark):
    with pytest.raises(ValueError):
        ranking.combo_table(spark, ["x"], 0)
    long = spark.createDataFrame(
        [("d", a, f, r) for a, rs in {"A": (1, 3, 1), "B": (2, 1, 2), "C": (3, 2, None)}.items()
         for f, r in zip("xyz", map(lambda v: v and float(v), rs))],
        "date string, asset string, factor_name string, rank double",
    )
    out = ranking.weighted_rank_combos(long, ["x", "y", "z"], 2, [0.75, 0.25]).collect()
    got = {(r.combo, r.asset): r.weighted_rank for r in out}
    # x_y sums: A 1.5, B 1.75, C 2.75; C has no z
    assert [got["x_y", a] for a in "ABC"] == [1, 2, 3]
    assert ("x_z", "C") not in got and got["x_z", "B"] == 2
    equal = ranking.weighted_rank_combos(long, ["x", "y", "z"], 2, [1.0]).collect()
    assert {(r.combo, r.asset): r.weighted_rank for r in equal}["x_y", "B"] == 1


def test_rank_deals_rows_by_group_and_value(spark, sf_dir):
    """No exchange deals rows by the group alone, and equal values are counted before theirs."""
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.to_date("l_shipdate").alias("date"), F.col("l_tax").alias("value")
    )
    plan = ranking.rank_cross_section(df)._jdf.queryExecution().executedPlan().toString()
    by_group = [line for line in plan.splitlines() if re.search(r"hashpartitioning\(date#\d+, \d+\)", line)]
    assert len(by_group) == 1  # totals of value ranges
    assert "partial_sum(_ties" in plan and "partial_count(1)" in plan


@pytest.mark.parametrize("n, size", [(3, 1), (4, 2), (5, 3), (6, 4), (7, 5), (22, 20)])
def test_combinations_agree_with_python(spark, n, size):
    """Rows are dealt by two or three beginnings; later positions are one number or, beyond 63 bits, a list."""
    rng = random.Random(size)
    names = [f"f{i}" for i in range(n)]
    rank = {(f, a): float(rng.randrange(4)) for f in names for a in "ABCD" if (f, a) != ("f1", "D")}
    rows = [("2024-01-02", a, f, r) for (f, a), r in rank.items()]
    frame = spark.createDataFrame(rows, "date string, asset string, factor_name string, rank double")
    weights = [1.0 / (i + 1) for i in range(size)]
    got = {(r.combo_id, r.combo, r.asset): r.weighted_rank for r in ranking.weighted_rank_combos(frame, names, size, weights).collect()}
    want = {}
    for i, combo in enumerate(combinations(names, size)):
        sums = {a: sum(rank[f, a] * w for f, w in zip(combo, weights)) for a in "ABCD" if all((f, a) in rank for f in combo)}
        for a, x in sums.items():
            less, same = (sum(y < x for y in sums.values()), sum(y == x for y in sums.values()))
            want[i, "_".join(combo), a] = less + (same + 1) / 2
    assert got == want


def test_window_of_combinations_sorts_narrow_rows(spark):
    """Ranks of the dealt factors and single later positions don't go through the exchange or the sort."""
    rows = [("2024-01-02", a, f"f{i}", float(i)) for a in "AB" for i in range(7)]
    frame = spark.createDataFrame(rows, "date string, asset string, factor_name string, rank double")
    plan = ranking.weighted_rank_combos(frame, [f"f{i}" for i in range(7)], 5)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_p0#\d+, _p1#\d+, _p2#\d+, date#\d+, \d+\)", plan) and "slice(" in plan
    sort = next(line for line in plan.splitlines() if "Sort [" in line)
    assert "_rest#" in sort and "combo_id" not in sort and "_p3" not in sort
