"""Evaluation reports: every table of a factor study, for any number of factors at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.functions.defaults import (
    COMBO_SIZE,
    COMPONENTS,
    FACTOR_CATALOGUE,
    MAX_LOSS,
    PERIODS,
    QUANTILES,
)
from paneloom.operators import evaluate as ev
from paneloom.operators.calendar import Calendar
from paneloom.operators.panel import available_factors, factor_matrix
from paneloom.operators.pca import component_scores, fit_components, select_components
from paneloom.operators.ranking import rank_cross_section, weighted_rank_combos
from paneloom.session import materialise

EVERY_FACTOR = "*"


def factor_report(
    factors: DataFrame,
    prices: DataFrame,
    periods: Sequence[int] = PERIODS,
    quantiles: int = QUANTILES,
    max_loss: float | None = MAX_LOSS,
    factor_names: Sequence[str] | str = FACTOR_CATALOGUE,
) -> dict[str, DataFrame]:
    """All report tables by name.

    ``factors`` is (date, asset, factor_name, value), ``prices`` (date, asset, close). Factors
    joined with returns are checkpointed once; every table reads that and is keyed by factor.
    ``factor_names`` defaults to the catalogue; ``EVERY_FACTOR`` evaluates all that the table has.
    Names without rows are absent from the tables. Factors losing more than ``max_loss`` of their rows are reported in ``gate`` and
    left out.
    """
    if factor_names != EVERY_FACTOR:
        factors = factors.where(F.col("factor_name").isin(*factor_names))
    aligned = materialise(
        ev.align_factor(factors, prices, periods, quantiles, Calendar.of(prices))
    )
    clean = ev.clean_factor(aligned, max_loss)
    moments = ev.bucket_moments(clean, periods)
    returns = ev.factor_returns(clean, periods)
    ic = ev.ic_daily(clean, periods)
    return {
        "gate": ev.loss_gate(aligned, 1.0 if max_loss is None else max_loss),
        "quantile_stats": ev.quantile_stats(clean),
        "quantile_returns": ev.quantile_returns(moments),
        "quantile_returns_demeaned": ev.quantile_returns(moments, demeaned=True),
        "quantile_returns_by_date": ev.quantile_returns_by_date(moments),
        "quantile_spread": ev.quantile_spread(moments, quantiles),
        "factor_returns": ev.cumulative_return(returns),
        "alpha_beta": ev.factor_alpha_beta(returns),
        "ic": ic,
        "ic_summary": ev.ic_summary(ic),
        "ic_monthly": ev.ic_monthly(ic),
        "turnover": ev.bucket_turnover(clean, periods),
        "rank_autocorrelation": ev.rank_autocorrelation(clean, periods),
    }


def report_headline(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per factor and period: IC, spread, alpha and beta side by side."""
    keys = ["factor_name", "period"]
    spread = tables["quantile_spread"].groupBy(*keys).agg(F.avg("spread").alias("mean_spread"))
    ic = tables["ic_summary"].select(*keys, "ic_mean", "ic_std")
    fit = tables["alpha_beta"].select(*keys, "alpha", "beta")
    return ic.join(spread, keys, "left").join(fit, keys, "left")


def combo_report(
    factors: DataFrame,
    prices: DataFrame,
    factor_names: Sequence[str],
    combo_size: int = COMBO_SIZE,
    weights: Sequence[float] | None = None,
    positive_corr: bool = True,
    **options,
) -> dict[str, DataFrame]:
    """Weighted-rank mode: every combination is evaluated as a factor named after its members.

    Requested factors without data are skipped; a combination over the loss limit is an error.
    """
    names = available_factors(factors, factor_names)
    chosen = factors.where(F.col("factor_name").isin(*names))
    # a (combination, date) group is never larger than its factors' groups
    ranks = rank_cross_section(chosen, positive_corr, keys=ev.CELL)
    combos = weighted_rank_combos(ranks, names, combo_size, weights, positive_corr).select(
        "date",
        "asset",
        F.col("combo").alias("factor_name"),
        F.col("weighted_rank").alias("value"),
    )
    return _strict(factor_report(combos, prices, factor_names=EVERY_FACTOR, **options))


def component_report(
    factors: DataFrame,
    prices: DataFrame,
    factor_names: Sequence[str],
    n_components: int | None = None,
    components: Sequence[int] = COMPONENTS,
    **options,
) -> dict[str, DataFrame]:
    """Principal-component mode: chosen components are evaluated as factors."""
    names = available_factors(factors, factor_names)
    matrix = factor_matrix(factors, names)
    fitted = fit_components(matrix, names, n_components)
    chosen = select_components(
        component_scores(matrix, fitted),
        len(fitted.columns),
        components,
        prefix="_".join(names) + "_",
    )
    return _strict(factor_report(chosen, prices, factor_names=EVERY_FACTOR, **options))


def _strict(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    lost = tables["gate"].where(F.col("status") == "skipped").select("factor_name").collect()
    if lost:
        raise ValueError(f"too many rows lost for {[r[0] for r in lost]}")
    return tables
