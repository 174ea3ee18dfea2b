"""Disclosure quarters: which quarterly report is public on a given day.

Fixed values (statutory disclosure windows, month-day, inclusive):
    Q1  05-16 .. 08-14
    Q2  08-15 .. 11-14
    Q3  11-15 .. 03-31 of the next year
    Q4  04-01 .. 05-15 of the next year
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# quarter -> (start year offset, month, day, end year offset, month, day)
WINDOWS = {
    "Q1": (0, 5, 16, 0, 8, 14),
    "Q2": (0, 8, 15, 0, 11, 14),
    "Q3": (0, 11, 15, 1, 3, 31),
    "Q4": (1, 4, 1, 1, 5, 15),
}


def quarter_bounds(quarter: str) -> tuple[dt.date, dt.date]:
    """Driver-side form of :func:`disclosure_window` for a literal such as ``2013-Q1``."""
    year_text, _, name = quarter.partition("-")
    if name not in WINDOWS:
        raise ValueError(f"not a quarter such as 2013-Q1: {quarter}")
    year = int(year_text)
    y0, m0, d0, y1, m1, d1 = WINDOWS[name]
    return dt.date(year + y0, m0, d0), dt.date(year + y1, m1, d1)


def disclosure_window(quarter: Column | str) -> tuple[Column, Column]:
    """(first day, last day) of the window in which ``YYYY-Qn`` is the latest report."""
    quarter = F.col(quarter) if isinstance(quarter, str) else quarter
    year = F.split_part(quarter, F.lit("-"), F.lit(1)).cast("int")
    name = F.split_part(quarter, F.lit("-"), F.lit(2))
    start = end = F.raise_error(F.concat(F.lit("not a quarter such as 2013-Q1: "), quarter)).cast("date")
    for q, (y0, m0, d0, y1, m1, d1) in WINDOWS.items():
        start = F.when(name == q, F.make_date(year + y0, F.lit(m0), F.lit(d0))).otherwise(start)
        end = F.when(name == q, F.make_date(year + y1, F.lit(m1), F.lit(d1))).otherwise(end)
    return start, end


def disclosure_quarter(date: Column | str) -> Column:
    """``YYYY-Qn`` whose window contains the date: a pure function, so intervals need no join."""
    date = F.col(date) if isinstance(date, str) else date
    day_of_year = F.month(date) * 100 + F.dayofmonth(date)
    start = {q: w[1] * 100 + w[2] for q, w in WINDOWS.items()}
    # each window runs to the day before the next one starts, in calendar order Q4, Q1, Q2, Q3
    name = (
        F.when(day_of_year < start["Q4"], F.lit("Q3"))
        .when(day_of_year < start["Q1"], F.lit("Q4"))
        .when(day_of_year < start["Q2"], F.lit("Q1"))
        .when(day_of_year < start["Q3"], F.lit("Q2"))
        .otherwise(F.lit("Q3"))
    )
    year = F.year(date) - F.when(day_of_year < start["Q1"], 1).otherwise(0)
    return F.when(
        date.isNotNull(), F.concat(year.cast("string"), F.lit("-"), name)
    )


def quarters_overlapping(start: Column | str, end: Column | str) -> Column:
    """Array of the quarters whose window meets [start, end], per row."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    years = F.sequence(F.year(start) - 1, F.year(end) + 1)

    def of_year(year: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    F.concat(year.cast("string"), F.lit(f"-{q}")).alias("quarter"),
                    F.make_date(year + y0, F.lit(m0), F.lit(d0)).alias("lo"),
                    F.make_date(year + y1, F.lit(m1), F.lit(d1)).alias("hi"),
                )
                for q, (y0, m0, d0, y1, m1, d1) in WINDOWS.items()
            ]
        )

    windows = F.flatten(F.transform(years, of_year))
    hits = F.filter(windows, lambda w: (w["hi"] >= start) & (w["lo"] <= end))
    return F.transform(hits, lambda w: w["quarter"])


def quarters_in_range(start: dt.date, end: dt.date, legacy: bool = False) -> list[str]:
    """Quarters whose window meets [start, end], in window order.

    A range starting between January and 15 May begins inside the previous year's Q3/Q4 window;
    ``legacy`` leaves those out by starting at the quarter names of ``start``'s own year.
    """
    first = start.year if legacy else start.year - 1
    names = (f"{y}-{q}" for y in range(first, end.year + 2) for q in WINDOWS)
    hits = []
    for name in names:
        lo, hi = quarter_bounds(name)
        if hi >= start and lo <= end:
            hits.append(name)
    return hits
