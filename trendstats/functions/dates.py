"""Lower bound of a named publish-date range.

Ranges are inclusive at the cut-off and have no upper bound. ``as_of`` is a
fixed date (``None`` = ``current_date()``, folded once per query by the
optimizer) so the cut-off is a literal in the plan rather than a per-row
computation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendstats.schema import RANGES

_MONTHS_BACK = {"last-month": 1, "last-6-Months": 6, "last-year": 12}


def normalise_range(name: str) -> str:
    """Accept the original spellings plus a few obvious aliases."""
    aliases = {
        "lastWeek": "last-week",
        "last-week": "last-week",
        "last-month": "last-month",
        "last-6-months": "last-6-Months",
        "last-6-Months": "last-6-Months",
        "last-year": "last-year",
        "no-date-filter": "no-date-filter",
        "all": "no-date-filter",
    }
    if name not in aliases:
        raise ValueError(f"unknown range {name!r}; expected one of {RANGES}")
    return aliases[name]


def as_of_column(as_of: str | dt.date | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


def range_cutoff(name: str, as_of: str | dt.date | None = None) -> Column | None:
    """Cut-off date column for a range, or ``None`` for ``no-date-filter``.

    ``last-week`` is seven days back; month ranges use ``add_months`` (which
    clamps the day, 31 March − 1 month = 28/29 February).
    """
    name = normalise_range(name)
    if name == "no-date-filter":
        return None
    base = as_of_column(as_of)
    if name == "last-week":
        return F.date_sub(base, 7)
    return F.add_months(base, -_MONTHS_BACK[name])
