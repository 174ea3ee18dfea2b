"""Column functions: every one maps Columns to a Column and stays inside the JVM."""

from paneloom.functions.quarters import (
    disclosure_quarter,
    disclosure_window,
    quarter_bounds,
    quarters_in_range,
    quarters_overlapping,
)
from paneloom.functions.scalars import (
    add_suffix,
    clean_double,
    compact_date,
    iso_date,
    missing_as_null,
    parse_date,
    parse_list,
    round_to,
    sanitize_label,
    strip_caret,
    strip_type_prefix,
    symbol_root,
    to_double,
    whole_shares,
)

__all__ = [
    "add_suffix",
    "clean_double",
    "compact_date",
    "disclosure_quarter",
    "disclosure_window",
    "iso_date",
    "missing_as_null",
    "parse_date",
    "parse_list",
    "quarter_bounds",
    "quarters_in_range",
    "quarters_overlapping",
    "round_to",
    "sanitize_label",
    "strip_caret",
    "strip_type_prefix",
    "symbol_root",
    "to_double",
    "whole_shares",
]
