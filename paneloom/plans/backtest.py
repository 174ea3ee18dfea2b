"""Scheduled multi-factor long/short portfolio from prices and factors to performance tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.functions.defaults import BUY_N, COMMISSION, INITIAL_CASH, SELL_N
from paneloom.operators import portfolio as pf
from paneloom.operators.calendar import Calendar
from paneloom.session import materialise


def run_backtest(
    prices: DataFrame,
    factors: DataFrame,
    factor_names: Sequence[str],
    start: dt.date,
    end: dt.date,
    weights: Sequence[float] | None = None,
    quarterly: Mapping[str, Sequence[Mapping]] | None = None,
    positive_corr: bool = True,
    buy_n: int = BUY_N,
    sell_n: int = SELL_N,
    initial_cash: float = INITIAL_CASH,
    commission: float = COMMISSION,
    base_calendar: str = "all",
    allow_lookahead: bool = False,
    legacy_quarters: bool = False,
) -> dict[str, DataFrame]:
    """All portfolio tables by name.

    ``prices`` is (date, asset, OHLCV), ``factors`` (date, asset, factor_name, value). The held
    bars, at most buy_n + sell_n per date, are checkpointed; everything after them is date-level.
    """
    schedule = pf.quarter_schedule(start, end, factor_names, weights, quarterly, legacy_quarters)
    inside = F.col("date").between(start, end)
    prices = prices.where(inside)
    wanted = factors.where(inside & F.col("factor_name").isin(*pf.factors_used(schedule)))
    ranks = pf.fill_and_rank(wanted, positive_corr)
    ranks = pf.scheduled_rank(ranks, schedule, positive_corr)
    merged = pf.merge_prices_and_ranks(prices, ranks)
    calendar = Calendar.of(prices) if base_calendar == "all" else None
    panel = pf.align_panel(merged, calendar, base_calendar, allow_lookahead)
    held = materialise(
        pf.holdings(pf.long_short_signals(panel, buy_n, sell_n), initial_cash, buy_n, sell_n)
    )
    ledger = pf.trade_ledger(held, commission)
    equity = materialise(
        pf.equity_curve(calendar or Calendar.of(panel), held, ledger, initial_cash)
    )
    return {
        "holdings": held,
        "orders": pf.trade_orders(held),
        "ledger": ledger,
        "equity": equity,
        "performance": pf.performance_summary(equity),
        "monthly_returns": pf.periodic_returns(equity, "month"),
        "yearly_returns": pf.periodic_returns(equity, "year"),
        "drawdowns": pf.worst_drawdowns(equity),
    }
