import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paneloom.operators import evaluate as ev
from paneloom.operators import panel, pca
from paneloom.plans import combo_report, component_report, factor_report

N_DAYS, N_ASSETS, PERIODS = 25, 15, (1, 5)


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(11)
    days = pd.bdate_range("2024-01-01", periods=N_DAYS)
    assets = [f"A{i:02d}" for i in range(N_ASSETS)]
    close = pd.DataFrame(
        100 * np.exp(np.cumsum(rng.normal(0, 0.02, (N_DAYS, N_ASSETS)), axis=0)), index=days, columns=assets
    )
    close.iloc[7, 3] = np.nan
    factor = pd.DataFrame(rng.normal(size=(N_DAYS, N_ASSETS)), index=days, columns=assets)
    factor.iloc[4, 5] = np.nan
    prices = spark.createDataFrame(
        [(d.date(), a, float(close.loc[d, a])) for d in days for a in assets if not math.isnan(close.loc[d, a])],
        "date date, asset string, close double",
    )
    factors = spark.createDataFrame(
        [(d.date(), a, "f", None if math.isnan(x := factor.loc[d, a]) else float(x)) for d in days for a in assets],
        "date date, asset string, factor_name string, value double",
    )
    returns = {p: close.shift(-p) / close - 1 for p in PERIODS}
    usable = factor.notna() & close.notna()
    for r in returns.values():
        usable &= r.notna()
    clean = ev.clean_factor(ev.align_factor(factors, prices, PERIODS), None).cache()
    return dict(close=close, factor=factor, returns=returns, usable=usable, clean=clean, prices=prices, factors=factors)


def rows(df, *keys, value):
    return {tuple(r[k] for k in keys): r[value] for r in df.collect()}


def test_forward_returns_skip_no_day(world):
    got = rows(ev.forward_returns_long(world["prices"], PERIODS), "date", "asset", "period", value="forward_return")
    for p, r in world["returns"].items():
        for d in r.index:
            for a in r.columns:
                if not math.isnan(world["close"].loc[d, a]):
                    x = got[d.date(), a, p]
                    assert (x is None) == math.isnan(r.loc[d, a])
                    assert x is None or x == pytest.approx(r.loc[d, a])


def buckets_of(world):
    out = {}
    for d, row in world["factor"].where(world["usable"]).iterrows():
        row = row.dropna()
        if len(row):
            cut = pd.qcut(row, 5, labels=False) + 1
            out.update({(d.date(), a): int(b) for a, b in cut.items()})
    return out


def test_clean_rows_and_buckets(world):
    assert rows(world["clean"], "date", "asset", value="bucket") == buckets_of(world)


def test_loss_gate(world):
    aligned = ev.align_factor(world["factors"], world["prices"], PERIODS)
    total, kept = int(world["factor"].notna().sum().sum()), len(buckets_of(world))
    gate = ev.loss_gate(aligned, 0.1).first()
    assert (gate.n_rows, gate.n_kept, gate.status) == (total, kept, "skipped")
    assert gate.loss == pytest.approx(1 - kept / total)
    assert ev.clean_factor(aligned, 0.1).isEmpty()
    assert ev.clean_factor(aligned, 0.9).count() == kept


def tall(world):
    b = buckets_of(world)
    return pd.DataFrame(
        [
            (d, a, q, p, world["factor"].loc[pd.Timestamp(d), a], world["returns"][p].loc[pd.Timestamp(d), a])
            for (d, a), q in b.items()
            for p in PERIODS
        ],
        columns=["date", "asset", "bucket", "period", "value", "r"],
    )


@pytest.mark.parametrize("demeaned", [False, True])
def test_quantile_returns(world, demeaned):
    t = tall(world)
    if demeaned:
        t["r"] -= t.groupby(["date", "period"])["r"].transform("mean")
    expected = t.groupby(["period", "bucket"])["r"].agg(["mean", "std", "count"])
    got = ev.quantile_returns(ev.bucket_moments(world["clean"], PERIODS), demeaned).collect()
    assert len(got) == len(expected)
    for r in got:
        e = expected.loc[r.period, r.bucket]
        assert r.n == e["count"]
        assert r.mean_return == pytest.approx(e["mean"], abs=1e-12)
        assert r.std_error == pytest.approx(e["std"] / math.sqrt(e["count"]), rel=1e-9)


def test_spread_and_stats(world):
    t = tall(world)
    mean = t.groupby(["date", "period", "bucket"])["r"].mean().unstack()
    got = rows(ev.quantile_spread(ev.bucket_moments(world["clean"], PERIODS)), "date", "period", value="spread")
    for key, row in mean.iterrows():
        assert got[key] == pytest.approx(row[5] - row[1])
    stats = ev.quantile_stats(world["clean"]).collect()
    assert sum(r["count"] for r in stats) == len(t) / len(PERIODS)
    assert sum(r["share"] for r in stats) == pytest.approx(1.0)


def test_factor_returns_alpha_beta(world):
    t = tall(world)
    t["w"] = t["value"] - t.groupby(["date", "period"])["value"].transform("mean")
    t["wr"], t["aw"] = t["w"] * t["r"], t["w"].abs()
    g = t.groupby(["period", "date"]).agg(wr=("wr", "sum"), aw=("aw", "sum"), u=("r", "mean"))
    expected = g["wr"] / g["aw"]
    daily = ev.factor_returns(world["clean"], PERIODS)
    got = rows(daily, "period", "date", value="factor_return")
    for key, x in expected.items():
        assert got[key] == pytest.approx(x, abs=1e-12)
    for r in ev.factor_alpha_beta(daily).collect():
        slope, intercept = np.polyfit(g["u"].loc[r.period], expected.loc[r.period], 1)
        assert (r.beta, r.alpha) == (pytest.approx(slope), pytest.approx(intercept))
        assert r.annual_alpha == pytest.approx((1 + intercept) ** (252 / r.period) - 1)
    cumulative = rows(ev.cumulative_return(daily), "period", "date", value="cumulative_return")
    path = (1 + expected.loc[1]).cumprod() - 1
    assert cumulative[1, path.index[-1]] == pytest.approx(path.iloc[-1])


def test_information_coefficient(world):
    t = tall(world)
    expected = {
        key: g["value"].rank().corr(g["r"].rank()) for key, g in t.groupby(["period", "date"])
    }
    ic = ev.ic_daily(world["clean"], PERIODS)
    got = rows(ic, "period", "date", value="ic")
    assert got.keys() == expected.keys()
    for key, x in expected.items():
        assert got[key] == pytest.approx(x)
    series = pd.Series({k[1]: x for k, x in expected.items() if k[0] == 1})
    summary = ev.ic_summary(ic).where("period = 1").first()
    assert summary.n == len(series)
    assert summary.ic_mean == pytest.approx(series.mean())
    assert summary.t_stat == pytest.approx(series.mean() / (series.std() / math.sqrt(len(series))))
    centred = series - series.mean()
    assert summary.ic_skew == pytest.approx((centred**3).mean() / (centred**2).mean() ** 1.5)
    monthly = rows(ev.ic_monthly(ic), "period", "month", value="ic_mean")
    january = series[[d.month == 1 for d in series.index]]
    assert monthly[1, dt.date(2024, 1, 1)] == pytest.approx(january.mean())


def test_turnover_and_autocorrelation(world):
    b = buckets_of(world)
    position = {d.date(): i + 1 for i, d in enumerate(world["close"].index)}
    day_at = {t: d for d, t in position.items()}
    members = {}
    for (d, a), q in b.items():
        members.setdefault((d, q), set()).add(a)
    got = rows(ev.bucket_turnover(world["clean"], PERIODS), "date", "bucket", "period", value="turnover")
    expected = {}
    for (d, q), names in members.items():
        for p in PERIODS:
            if position[d] > p:
                before = members.get((day_at[position[d] - p], q), set())
                expected[d, q, p] = len(names - before) / len(names)
    assert got.keys() == expected.keys()
    for k in expected:
        assert got[k] == pytest.approx(expected[k])
    ranks = world["factor"].where(world["usable"]).rank(axis=1)
    auto = rows(ev.rank_autocorrelation(world["clean"], PERIODS), "date", "period", value="autocorrelation")
    for (d, p), x in auto.items():
        now, then = ranks.loc[pd.Timestamp(d)], ranks.loc[pd.Timestamp(day_at[position[d] - p])]
        want = now.corr(then)
        assert (x is None) == math.isnan(want) and (x is None or x == pytest.approx(want))


# ------------------------------------------------------------------ components


@pytest.fixture(scope="module")
def study(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) + 5
    names = ["w", "x", "y", "z"]
    days = pd.bdate_range("2024-01-01", periods=20)
    cells = [(days[i // 20].date(), f"A{i % 20:02d}") for i in range(400)]
    long = spark.createDataFrame(
        [(*cells[i], names[j], float(x[i, j])) for i in range(400) for j in range(4)],
        "date date, asset string, factor_name string, value double",
    )
    prices = spark.createDataFrame(
        [(*c, float(100 + rng.random())) for c in cells], "date date, asset string, close double"
    )
    return names, cells, x, long, prices


def test_components_match_svd(study):
    names, cells, x, long, _ = study
    matrix = panel.factor_matrix(long, names)
    fitted = pca.fit_components(matrix, names)
    assert fitted.columns == ["PC1", "PC2", "PC3"]
    z = (x - x.mean(0)) / x.std(0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    for loading, v in zip(fitted.loadings, vt):
        sign = np.sign(v[np.argmax(np.abs(v))])
        assert loading == pytest.approx(v * sign)
    assert fitted.explained == pytest.approx((s**2 / (s**2).sum())[:3])
    got = {(r.date, r.asset): (r.PC1, r.PC3) for r in pca.component_scores(matrix, fitted).collect()}
    scores = z @ fitted.loadings.T
    for i, c in enumerate(cells):
        assert got[c] == pytest.approx((scores[i, 0], scores[i, 2]))


def test_component_numbers_are_clamped(study):
    names, _, _, long, _ = study
    matrix = panel.factor_matrix(long, names)
    assert len(pca.fit_components(matrix, names, 9).columns) == 4
    assert len(pca.fit_components(matrix, names, 0).columns) == 1
    one = pca.fit_components(panel.factor_matrix(long, ["w"]), ["w"])
    assert len(one.columns) == 1
    constant = matrix.withColumn("w", F.lit(3.0))
    assert pca.fit_components(constant, names).scales[0] == 1.0
    scores = pca.component_scores(matrix, pca.fit_components(matrix, names))
    assert {r[0] for r in pca.select_components(scores, 3, [2, 4], "f_").select("factor_name").distinct().collect()} == {"f_PC2"}
    with pytest.raises(ValueError):
        pca.select_components(scores, 3, [4])


# ------------------------------------------------------------------ reports


def test_factor_report_tables(study):
    names, _, _, long, prices = study
    tables = factor_report(long, prices, (1, 5), max_loss=0.9, factor_names=names)
    assert tables["ic_summary"].count() == len(names) * 2
    for name, df in tables.items():
        assert not df.isEmpty(), name
    lossy = factor_report(long, prices, (1, 5), max_loss=0.01, factor_names="*")
    assert factor_report(long, prices, (1, 5))["gate"].isEmpty()  # none of them is in the catalogue
    assert {r.status for r in lossy["gate"].collect()} == {"skipped"}
    assert lossy["ic"].isEmpty()


def test_combination_and_component_reports(study):
    names, _, _, long, prices = study
    combos = combo_report(long, prices, [*names, "absent"], 2, periods=(1,), max_loss=0.9)
    assert combos["ic_summary"].count() == 6
    with pytest.raises(ValueError, match="too many rows lost"):
        combo_report(long, prices, names, 2, periods=(1,), max_loss=0.01)
    parts = component_report(long, prices, names, periods=(1,), max_loss=0.9)
    assert {r.factor_name for r in parts["alpha_beta"].collect()} == {"w_x_y_z_PC2"}


def test_moments_of_many_columns(spark):
    """200 columns, far from zero, over many partitions; one row lacks a value."""
    k, n = 200, 3000
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, k)) * rng.uniform(0.1, 10, k) + 1e6
    names = [f"f{i}" for i in range(k)]
    gap = pd.DataFrame([[None] + [1.0] * (k - 1)], columns=names)
    frame = pd.concat([pd.DataFrame(x, columns=names), gap]).astype(float)
    schema = ", ".join(f"{c} double" for c in names)
    matrix = spark.createDataFrame(frame, schema).replace(float("nan"), None).repartition(17)
    moments = pca.matrix_moments(matrix, names)
    expected = np.cov(x, rowvar=False, bias=True)
    assert moments.n == n
    assert np.allclose(moments.means, x.mean(axis=0), rtol=1e-12)
    assert np.allclose(moments.covariance, expected, rtol=1e-7, atol=1e-7)
    table = {(r.factor_a, r.factor_b): r.covariance for r in pca.covariance_table(matrix, names[:9]).collect()}
    assert len(table) == 45 and table["f0", "f8"] == pytest.approx(expected[0, 8], abs=1e-7)
    with pytest.raises(ValueError):
        pca.matrix_moments(matrix.limit(0), names)
    assert [r.covariance for r in pca.covariance_table(matrix.limit(0), ["f0"]).collect()] == [None]
