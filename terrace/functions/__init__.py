"""Column-expression helpers (all built-in Spark functions, codegen friendly)."""

from terrace.functions.dates import date_key
from terrace.functions.guards import is_account_name, is_iso_date, pseudonym

__all__ = ["date_key", "is_account_name", "is_iso_date", "pseudonym"]
