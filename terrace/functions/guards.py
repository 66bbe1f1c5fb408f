"""Parameter guards and pseudonymisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_iso_date(c: Column) -> Column:
    """True when the text is a strict ``yyyy-MM-dd`` calendar date (``2024-02-30`` is not)."""
    return c.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(c, "yyyy-MM-dd").isNotNull()


def is_account_name(c: Column) -> Column:
    """Storage-account style name: 3 to 24 lower-case letters or digits."""
    return F.coalesce(c.rlike(r"^[a-z0-9]{3,24}$"), F.lit(False))


def pseudonym(c: Column, salt: str) -> Column:
    """Stable one-way pseudonym: hex SHA-256 of salt || value; NULL stays NULL."""
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)
