"""Data checks: orphans, duplicate keys, key uniqueness, day-over-day volume, silent changes,
freshness and row counts (J7, J8, A1, A4, A8, A9, A10, A16)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.contracts import FRESHNESS_LIMIT_MINUTES


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def orphan_counts(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """For each (fact name, fact, fk column, dimension, dimension key): rows whose key has no match.

    All foreign keys of one fact are checked in a single pass: the fact is left-joined to each
    dimension's (distinct) key set with a match tag, and one aggregation counts the untagged rows
    per key (a NULL key never matches, as in an anti join).
    """
    by_fact: dict[str, list] = {}
    facts: dict[str, DataFrame] = {}
    for fact_name, fact, fk, dim, dim_key in checks:
        by_fact.setdefault(fact_name, []).append((fk, dim, dim_key))
        facts[fact_name] = fact
    parts = []
    for fact_name, fks in by_fact.items():
        tagged = facts[fact_name].select(*[fk for fk, _, _ in fks])
        for i, (fk, dim, dim_key) in enumerate(fks):
            keys = dim.select(F.col(dim_key).alias(fk)).distinct().withColumn(f"_hit{i}", F.lit(True))
            tagged = tagged.join(keys, fk, "left")
        counts = tagged.agg(*[F.count_if(F.col(f"_hit{i}").isNull()).alias(f"o{i}") for i in range(len(fks))])
        stacked = F.explode(F.array(*[F.struct(F.lit(fk).alias("fk"), F.col(f"o{i}").alias("orphans")) for i, (fk, _, _) in enumerate(fks)]))
        parts.append(counts.select(stacked.alias("s")).select(F.lit(fact_name).alias("fact"), "s.fk", "s.orphans"))
    return union_all(parts)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that tells whether two tables hold the same rows, in whatever order: rows, and the sum and
    exclusive or of their 64-bit hashes. Sums are decimals, so they don't overflow."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return df.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(20,0)")).alias("hash_sum"), F.bit_xor("h").alias("hash_xor")
    )


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies (partial counts combine map-side)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def key_uniqueness(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and distinct keys per table; equal numbers mean the key is unique."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_keys")).select(
                F.lit(name).alias("table_name"), "rows", "distinct_keys"
            )
            for name, (df, key) in frames.items()
        ]
    )


def day_over_day(df: DataFrame, day_col: str = "_run_date", by: Sequence[str] = (), drop_below: float = 0.5, spike_above: float = 2.0) -> DataFrame:
    """Rows per day and the ratio to the previous day; flags drops and spikes.

    The per-day counts are aggregated first (one row per day), so the ordered window runs over
    calendar days, never over raw rows.
    """
    daily = df.groupBy(*by, F.col(day_col).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy(*by).orderBy("day")
    prev = F.lag("rows").over(w)
    ratio = F.try_divide(F.col("rows").cast("double"), F.col("prev_rows").cast("double"))
    return daily.withColumn("prev_rows", prev).select(
        *by,
        "day",
        "rows",
        "prev_rows",
        ratio.alias("ratio"),
        F.when(F.col("prev_rows").isNull(), F.lit("first"))
        .when(ratio < drop_below, F.lit("drop"))
        .when(ratio > spike_above, F.lit("spike"))
        .otherwise(F.lit("ok"))
        .alias("flag"),
    )


def silent_changes(versions: DataFrame, current: DataFrame, key: str, payload: Sequence[str], order_by: str = "updated_at") -> DataFrame:
    """Incoming versions that carry the same ``order_by`` as the current row but different content.

    Such rows mean the source changed data without bumping its timestamp, so an upsert could keep
    either version. Equi-join on (key, timestamp), then a NULL-safe comparison of the payload.
    """
    cur = current.select(key, order_by, F.struct(*payload).alias("_cur"))
    inc = versions.select(key, order_by, *payload, F.struct(*payload).alias("_inc"))
    return (
        inc.join(cur, [key, order_by])
        .where(~F.col("_inc").eqNullSafe(F.col("_cur")))
        .select(key, order_by, *payload)
    )


def freshness(silver: Mapping[str, DataFrame], as_of: str | Column, limit_minutes: float = FRESHNESS_LIMIT_MINUTES) -> DataFrame:
    """Minutes from the newest ingest to ``as_of`` per entity and overall; satisfied when within limit.

    An entity with no rows reports NULL minutes and is not satisfied.
    """
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    per = union_all(
        [df.agg(F.max("_ingested_at").alias("newest_ingest")).select(F.lit(n).alias("entity"), "newest_ingest") for n, df in silver.items()]
    )
    overall = per.agg(F.max("newest_ingest").alias("newest_ingest")).select(F.lit("all").alias("entity"), "newest_ingest")
    minutes = (F.unix_micros(now) - F.unix_micros(F.col("newest_ingest"))) / F.lit(60_000_000.0)
    return per.unionByName(overall).select(
        "entity",
        "newest_ingest",
        minutes.alias("freshness_minutes"),
        F.coalesce(minutes <= F.lit(float(limit_minutes)), F.lit(False)).alias("satisfied"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()])
