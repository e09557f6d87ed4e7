"""Date arithmetic of the reports, computed on the driver from ``as_of``.

All three helpers return plain ``datetime`` values that become literals in
the plan, so the comparisons they feed are simple column-vs-literal filters
that Catalyst can push into the scan.
"""

from __future__ import annotations

import datetime as dt


def previous_month_end(as_of: dt.datetime) -> dt.datetime:
    """Last day of the month before ``as_of`` at midnight (2017-08-15 -> 2017-07-31)."""
    first = dt.datetime(as_of.year, as_of.month, 1)
    return first - dt.timedelta(days=1)


def elapsed_cutoff(as_of: dt.datetime, days: int) -> dt.datetime:
    """``as_of - d < days`` (elapsed time, 24-hour days)  <=>  ``d > elapsed_cutoff``."""
    return as_of - dt.timedelta(days=days)


def calendar_cutoff(as_of: dt.datetime, days: int) -> dt.datetime:
    """``datediff(day, d, as_of) < days`` (midnights crossed)  <=>  ``d >= calendar_cutoff``."""
    midnight = dt.datetime(as_of.year, as_of.month, as_of.day)
    return midnight - dt.timedelta(days=days - 1)
