"""Cross-sectional factor analytics on asset panels, expressed as Spark DataFrame plans."""

from paneloom import functions, operators, plans, sources
from paneloom.session import build_session

__all__ = ["build_session", "functions", "operators", "plans", "sources"]
