"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def months_between_years(end: Column, start: Column) -> Column:
    """Completed years from ``start`` to ``end`` as bigint; negative spans floor away from zero."""
    return F.floor(F.months_between(end, start) / 12)


def date_diff_days(end: Column, start: Column) -> Column:
    """Days from ``start`` to ``end``; null when either is null."""
    return F.datediff(end, start)
