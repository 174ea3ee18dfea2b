import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from paneloom.operators import portfolio as pf
from paneloom.operators.calendar import Calendar
from paneloom.plans import run_backtest

BUY, SELL, CASH, RATE = 3, 2, 100_000.0, 0.001
OHLCV = "date date, asset string, open double, high double, low double, close double, volume double"


@pytest.fixture(scope="module")
def market(spark):
    rng = np.random.default_rng(4)
    days = [d.date() for d in pd.bdate_range("2024-05-01", periods=40)]
    assets = [f"A{i:02d}" for i in range(10)]
    close = 50 * np.exp(np.cumsum(rng.normal(0, 0.02, (40, 10)), axis=0))
    open_ = close * (1 + rng.normal(0, 0.005, (40, 10)))
    rank = np.array([rng.integers(1, 8, 10) for _ in days], dtype=float)
    panel = spark.createDataFrame(
        [
            (d, t + 1, a, float(open_[t, i]), float(close[t, i]), None if t < 2 else float(rank[t, i]))
            for t, d in enumerate(days)
            for i, a in enumerate(assets)
        ],
        "date date, t int, asset string, open double, close double, rank double",
    ).cache()
    return days, assets, open_, close, rank, panel


def simulate(market):
    """Bar-by-bar bookkeeping of the same rules, as plain loops."""
    days, assets, open_, close, rank, _ = market
    each = CASH * 0.9 / (BUY + SELL)
    held = {"long": {}, "short": {}}
    cash, orders, pending, equity, fills = CASH, [], [], [], []
    position = {}
    for t, day in enumerate(days):
        for asset, side, action, quantity in pending:
            price = open_[t, assets.index(asset)]
            cash -= quantity * price + RATE * abs(quantity) * price
            position[asset] = position.get(asset, 0) + quantity
            fills.append((day, asset, side, action, quantity))
        pending = []
        equity.append(cash + sum(q * close[t, assets.index(a)] for a, q in position.items()))
        if t < 2:
            continue
        order = sorted(assets, key=lambda a: (rank[t, assets.index(a)], a))
        for side, names, sign in (("long", order[-BUY:], 1), ("short", order[:SELL], -1)):
            for a in assets:
                if a in held[side] and a not in names:
                    quantity = held[side].pop(a)
                    orders.append((day, a, side, "exit"))
                    pending.append((a, side, "exit", -quantity))
                elif a not in held[side] and a in names:
                    quantity = sign * int(each / close[t, assets.index(a)])
                    held[side][a] = quantity
                    orders.append((day, a, side, "enter"))
                    pending.append((a, side, "enter", quantity))
    return orders, fills, equity


def test_orders_ledger_and_equity_follow_the_rules(market):
    days, panel = market[0], market[-1]
    orders, fills, equity = simulate(market)
    signals = pf.long_short_signals(panel, BUY, SELL)
    held = pf.holdings(signals, CASH, BUY, SELL).cache()
    got = {(r.date, r.asset, r.side, r.action) for r in pf.trade_orders(held).collect()}
    assert got == set(orders)
    ledger = pf.trade_ledger(held, RATE)
    assert {(r.date, r.asset, r.side, r.action, r.quantity) for r in ledger.collect()} == set(fills)
    curve = pf.equity_curve(Calendar(tuple(days)), held, ledger, CASH).orderBy("date").collect()
    assert [r.equity for r in curve] == pytest.approx(equity)
    assert curve[0].daily_return == 0.0


def test_sides_can_be_switched_off(market):
    panel = market[-1]
    assert {r.side for r in pf.long_short_signals(panel, 2, 0).collect()} == {"long"}
    assert {r.side for r in pf.long_short_signals(panel, 0, 2).collect()} == {"short"}
    assert pf.long_short_signals(panel, 0, 0).isEmpty()
    assert pf.cash_per_name(100.0, 0, 0) == 0.0


def test_long_and_short_are_disjoint_when_the_universe_is_large_enough(market):
    both = pf.long_short_signals(market[-1], BUY, SELL).groupBy("date", "asset").count()
    assert both.where("count > 1").isEmpty()


# ------------------------------------------------------------------ schedule


def test_schedule_defaults_and_overrides():
    start, end = dt.date(2024, 5, 16), dt.date(2024, 11, 14)
    plan = pf.quarter_schedule(start, end, ["a", "b"], None, {"2024-Q2": [{"name": "c", "weight": 1}]})
    assert plan == [("2024-Q1", 0, "a", 0.5), ("2024-Q1", 1, "b", 0.5), ("2024-Q2", 0, "c", 1.0)]
    assert pf.factors_used(plan) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        pf.quarter_schedule(start, end, [])
    with pytest.raises(ValueError):
        pf.quarter_schedule(start, end, ["a"], [0.5, 0.5])


def test_scheduled_rank(spark):
    q1, q2 = dt.date(2024, 6, 3), dt.date(2024, 9, 2)
    ranks = spark.createDataFrame(
        [(q1, a, f, r) for a, f, r in [("A", "a", 1.0), ("B", "a", 2.0), ("A", "b", 4.0), ("B", "b", 1.0), ("C", "a", 9.0)]]
        + [(q2, "A", "a", 1.0), (q2, "B", "a", 2.0)],
        "date date, asset string, factor_name string, rank double",
    )
    plan = pf.quarter_schedule(q1, q2, ["a", "b"], [0.5, 0.5])
    got = {(r.date, r.asset): r["rank"] for r in pf.scheduled_rank(ranks, plan).collect()}
    # C lacks b in Q1; b has no data at all in Q2 and is left out there
    assert got == {(q1, "A"): 2.0, (q1, "B"): 1.0, (q2, "A"): 1.0, (q2, "B"): 2.0}
    down = {(r.date, r.asset): r["rank"] for r in pf.scheduled_rank(ranks, plan, False).collect()}
    assert down[q1, "A"] == 1.0
    kept = {(r.date, r.asset): r["rank"] for r in pf.scheduled_rank(ranks, plan, False, True).collect()}
    assert kept == got


def test_fill_and_rank(spark):
    d = [dt.date(2024, 6, i) for i in (3, 4, 5)]
    df = spark.createDataFrame(
        [(d[0], "A", "f", 2.0), (d[1], "A", "f", None), (d[0], "B", "f", None), (d[1], "B", "f", 1.0), (d[2], "B", "f", None)],
        "date date, asset string, factor_name string, value double",
    )
    got = {(r.date, r.asset): r["rank"] for r in pf.fill_and_rank(df).collect()}
    assert got == {(d[0], "A"): 1, (d[1], "A"): 2, (d[1], "B"): 1, (d[2], "B"): 1}


def test_merge_and_alignment(spark):
    d = [dt.date(2024, 6, i) for i in (3, 4, 5, 6)]
    bar = lambda day, a, x: (day, a, x, x, x, x, 1.0)
    prices = spark.createDataFrame(
        [bar(d[0], "A", 1.0), bar(d[2], "A", 3.0), bar(d[1], "B", 5.0), bar(d[3], "B", 6.0)], OHLCV
    )
    ranks = spark.createDataFrame([(d[1], "A", 2.0), (d[0], "B", 1.0)], "date date, asset string, rank double")
    merged = pf.merge_prices_and_ranks(prices, ranks)
    got = {(r.asset, r.date): (r.close, r["rank"]) for r in merged.collect()}
    assert got == {
        ("A", d[0]): (1.0, None), ("A", d[1]): (1.0, 2.0), ("A", d[2]): (3.0, 2.0),
        ("B", d[1]): (5.0, 1.0), ("B", d[3]): (6.0, 1.0),
    }
    close = lambda df: {(r.asset, r.t): r.close for r in df.collect()}
    assert close(pf.align_panel(merged)) == {
        ("A", 1): 1.0, ("A", 2): 1.0, ("A", 3): 3.0, ("A", 4): 3.0, ("B", 2): 5.0, ("B", 3): 5.0, ("B", 4): 6.0
    }
    first = pf.align_panel(merged, base="first_asset", allow_lookahead=True)
    assert close(first) == {("A", 1): 1.0, ("A", 2): 1.0, ("A", 3): 3.0, ("B", 1): 5.0, ("B", 2): 5.0, ("B", 3): 5.0}
    sentinel = {(r.asset, r.t): r["rank"] for r in pf.with_no_signal(pf.align_panel(merged)).collect()}
    assert sentinel["A", 1] == 999999.0
    plan = merged.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# ------------------------------------------------------------------ performance


@pytest.fixture(scope="module")
def returns(spark):
    rng = np.random.default_rng(8)
    days = [d.date() for d in pd.bdate_range("2023-01-02", periods=300)]
    r = rng.normal(0.0004, 0.01, 300)
    df = spark.createDataFrame([(d, float(x)) for d, x in zip(days, r)], "date date, daily_return double")
    return pd.Series(r, index=pd.to_datetime(days)), df.cache()


def test_performance_summary(returns):
    r, df = returns
    s = pf.performance_summary(df).first()
    wealth = (1 + r).cumprod()
    peak = np.maximum(wealth.cummax(), 1.0)
    total = wealth.iloc[-1] - 1
    annual = (1 + total) ** (252 / len(r)) - 1
    drawdown = (wealth / peak - 1).min()
    assert s.n_days == 300
    assert s.total_return == pytest.approx(total)
    assert s.annual_return == pytest.approx(annual)
    assert s.annual_volatility == pytest.approx(r.std() * math.sqrt(252))
    assert s.sharpe == pytest.approx(r.mean() / r.std() * math.sqrt(252))
    assert s.sortino == pytest.approx(r.mean() / math.sqrt((np.minimum(r, 0) ** 2).mean()) * math.sqrt(252))
    assert s.max_drawdown == pytest.approx(drawdown)
    assert s.calmar == pytest.approx(annual / abs(drawdown))
    assert s.omega == pytest.approx(r[r > 0].sum() / -r[r < 0].sum())
    assert s.tail_ratio == pytest.approx(abs(np.percentile(r, 95)) / abs(np.percentile(r, 5)))
    assert s.var_5pct == pytest.approx(np.percentile(r, 5))
    assert s.value_at_risk == pytest.approx(r.mean() - 2 * r.std())
    level = np.log1p(r).cumsum()
    assert s.stability == pytest.approx(np.corrcoef(np.arange(len(r)), level)[0, 1] ** 2)


def test_periodic_returns(returns):
    r, df = returns
    monthly = (1 + r).groupby(r.index.to_period("M")).prod() - 1
    got = {x.period_start: x.period_return for x in pf.periodic_returns(df).collect()}
    assert len(got) == len(monthly)
    for period, x in monthly.items():
        assert got[period.start_time.date()] == pytest.approx(x)
    assert pf.periodic_returns(df, "year").count() == 2
    with pytest.raises(ValueError):
        pf.periodic_returns(df, "week")


def test_worst_drawdowns(spark):
    days = [dt.date(2024, 1, i) for i in range(1, 9)]
    steps = [0.0, -0.1, 0.2, -0.5, 0.5, 2.0, -0.2, 0.1]
    df = spark.createDataFrame(list(zip(days, steps)), "date date, daily_return double")
    rows = pf.worst_drawdowns(df, 2).orderBy("place").collect()
    assert [r.peak_date for r in rows] == [days[2], days[5]]
    assert rows[0].valley_date == days[3] and rows[0].recovery_date == days[5]
    assert rows[0].depth == pytest.approx(-0.5) and rows[0].bars_under_water == 2
    assert rows[1].recovery_date is None and rows[1].valley_date == days[6]


def test_loss_beyond_everything_leaves_logs_null(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), -1.5), (dt.date(2024, 1, 2), 0.1)], "date date, daily_return double")
    s = pf.performance_summary(df).first()
    assert s.stability is None and s.annual_return is None
    assert s.total_return == pytest.approx(-0.5 * 1.1 - 1)


def test_whole_backtest(spark, market):
    days, assets, open_, close, rank, _ = market
    prices = spark.createDataFrame(
        [(d, a, float(open_[t, i]), float(close[t, i]), float(close[t, i]), float(close[t, i]), 1.0)
         for t, d in enumerate(days) for i, a in enumerate(assets)],
        OHLCV,
    )
    factors = spark.createDataFrame(
        [(d, a, "f", float(rank[t, i])) for t, d in enumerate(days) if t >= 2 for i, a in enumerate(assets)],
        "date date, asset string, factor_name string, value double",
    )
    out = run_backtest(
        prices, factors, ["f"], days[0], days[-1], buy_n=BUY, sell_n=SELL, initial_cash=CASH, commission=RATE
    )
    _, _, equity = simulate(market)
    assert [r.equity for r in out["equity"].orderBy("date").collect()] == pytest.approx(equity)
    assert out["performance"].first().n_days == 40
    assert {"orders", "ledger", "monthly_returns", "yearly_returns", "drawdowns"} < set(out)
