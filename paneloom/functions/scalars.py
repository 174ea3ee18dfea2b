"""Scalar helpers on symbols, labels, numbers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_as_null(c: Column | str, infinities: bool = False) -> Column:
    """NaN (and ±inf on request) become NULL, the only missing value the operators know."""
    c = _col(c)
    out = F.when(~F.isnan(c), c)
    if infinities:
        out = F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
    return out


def to_double(c: Column | str) -> Column:
    """Coercing numeric cast: text that is no number becomes NULL instead of an error."""
    return _col(c).try_cast("double")


def clean_double(c: Column | str, infinities: bool = False) -> Column:
    return missing_as_null(to_double(c), infinities)


def parse_date(c: Column | str) -> Column:
    """Dates, timestamps or ISO text, cut to the day."""
    return F.to_date(_col(c))


def add_suffix(symbol: Column | str, suffix: str = ".TW") -> Column:
    symbol = _col(symbol)
    return F.when(F.contains(symbol, F.lit(suffix)), symbol).otherwise(
        F.concat(symbol, F.lit(suffix))
    )


def symbol_root(symbol: Column | str) -> Column:
    """The part before the first dot."""
    return F.split_part(_col(symbol), F.lit("."), F.lit(1))


def strip_caret(index_id: Column | str) -> Column:
    return F.ltrim(_col(index_id), F.lit("^"))


def strip_type_prefix(name: Column | str, data_type: str = "fundamental_features") -> Column:
    name, prefix = _col(name), f"{data_type}:"
    return F.when(
        F.startswith(name, F.lit(prefix)), F.substring(name, F.lit(len(prefix) + 1), F.length(name))
    ).otherwise(name)


def sanitize_label(label: Column | str) -> Column:
    """Path-unsafe ``/``, ``\\`` and ``,`` become underscores."""
    return F.translate(_col(label), "/\\,", "___")


def compact_date(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMMdd")


def iso_date(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def parse_list(c: Column | str) -> Column:
    """Comma list to a trimmed array without empty items."""
    items = F.transform(F.split(_col(c), ","), lambda s: F.trim(s))
    return F.filter(items, lambda s: s != F.lit(""))


def whole_shares(cash: Column | float, price: Column | str) -> Column:
    """Cash over price, truncated to whole shares; NULL for a zero price."""
    cash = cash if isinstance(cash, Column) else F.lit(float(cash))
    return F.try_divide(cash, _col(price)).cast("bigint")


def round_to(c: Column | str, digits: int) -> Column:
    """Rounded value without negative zero, for stable report output."""
    return F.round(_col(c), digits) + F.lit(0.0)


def no_nan(name: str) -> Column:
    """The column with NaN as NULL."""
    return F.when(~F.isnan(name), F.col(name))
