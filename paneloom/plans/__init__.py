"""Composite pipelines."""

from paneloom.plans.backtest import run_backtest
from paneloom.plans.etl import build_star_schema
from paneloom.plans.reports import combo_report, component_report, factor_report

__all__ = [
    "build_star_schema",
    "combo_report",
    "component_report",
    "factor_report",
    "run_backtest",
]
