"""Date helpers: report periods, run notes and text-date parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(value) -> dt.date:
    """A date from a ``date``, ISO text or US ``MM/dd/yyyy`` text (report parameters)."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value).strip()
    if "/" in text:
        return dt.datetime.strptime(text, "%m/%d/%Y").date()
    return dt.date.fromisoformat(text)


def as_of_col(as_of=None) -> Column:
    return F.current_date() if as_of is None else F.lit(parse_date(as_of))


def first_day_last_month(as_of=None) -> Column:
    """First day of the month before ``as_of``."""
    return F.add_months(F.trunc(as_of_col(as_of), "MM"), -1)


def last_day_last_month(as_of=None) -> Column:
    """Last day of the month before ``as_of`` (``as_of - DAY(as_of)`` days)."""
    d = as_of_col(as_of)
    return F.date_sub(d, F.dayofmonth(d))


def us_date_text(c: Column) -> Column:
    """``VARCHAR_FORMAT(d, 'MM/DD/YYYY')``."""
    return F.date_format(c, "MM/dd/yyyy")


def run_note(ts=None) -> Column:
    """"This report was run on MM/dd/yyyy at HH:mm:ss" for ``ts`` (default: now)."""
    t = F.current_timestamp() if ts is None else F.lit(ts)
    return F.concat(
        F.lit("This report was run on "), F.date_format(t, "MM/dd/yyyy"), F.lit(" at "), F.date_format(t, "HH:mm:ss")
    )
