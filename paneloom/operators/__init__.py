"""DataFrame -> DataFrame operators on panels."""

from paneloom.operators import (
    calendar,
    evaluate,
    panel,
    pca,
    portfolio,
    ranking,
    skew,
    universe,
)

__all__ = ["calendar", "evaluate", "panel", "pca", "portfolio", "ranking", "skew", "universe"]
