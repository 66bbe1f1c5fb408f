"""Date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal digits of a date as one number: 2024-01-31 is 20240131; NULL stays NULL.
DATE_KEY = "year({d}) * 10000 + month({d}) * 100 + day({d})"


def date_key(column: str) -> Column:
    """The key of a date or timestamp column."""
    return F.expr(DATE_KEY.format(d=f"`{column}`"))
