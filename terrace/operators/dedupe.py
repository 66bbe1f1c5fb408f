"""Latest version per business key (W1) as a skew-safe aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: str = "updated_at", tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: newest ``order_by`` (NULLs last), then newest ``_ingested_at``.

    Remaining ties are broken deterministically by the other columns (largest value first), so a
    rerun always keeps the same row. Implemented as ``max(struct(order…, row…))`` per key: the
    max is combined map-side before the shuffle, so a key holding a third of all rows costs one
    row per map task in the exchange instead of one giant window partition.
    NULL struct fields compare lowest, which gives the NULLS LAST order for free.
    """
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in (order_by, "_ingested_at") if c in rest]
    ties = list(tie_breakers) if tie_breakers is not None else [c for c in rest if c not in order]
    fields = order + [c for c in ties if c not in order] + [c for c in rest if c not in order and c not in ties]
    packed = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(fields)])
    winner = df.groupBy(*keys).agg(F.max(packed).alias("_w"))
    return winner.select(*[F.col(f"_w.f{fields.index(c)}").alias(c) if c in fields else F.col(f"`{c}`") for c in df.columns])
