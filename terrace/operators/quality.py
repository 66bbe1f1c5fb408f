"""Data-quality rules with reasons (Q1–Q7)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.contracts import REJECTION_RATE_LIMIT, Entity, Rule

FAILURES, OK = "_dq_failures", "_dq_ok"


def flag_rules(df: DataFrame, rules: Sequence[Rule], as_of: str | None = None) -> DataFrame:
    """``df`` with ``_dq_failures``, the names of the rules that a row breaks, in the order of the
    rules, and ``_dq_ok``, whether there are none. A rule that comes out NULL is broken.

    What is valid and what goes to quarantine are filters on ``_dq_ok``, a conjunction of the rules
    that the planner can split, push down and compile; the names are worked out for rejected rows only.
    """
    holds = [F.coalesce(F.expr(r.sql(as_of)), F.lit(False)) for r in rules]
    broken = F.array(*[F.when(~h, F.lit(r.name)) for h, r in zip(holds, rules)])
    ok = reduce(lambda a, b: a & b, holds, F.lit(True))
    return df.withColumns({FAILURES: F.array_compact(broken.cast("array<string>")), OK: ok})


def valid(flagged: DataFrame) -> DataFrame:
    """The rows that break no rule, as they came."""
    return flagged.where(OK).drop(FAILURES, OK)


def rejected(flagged: DataFrame) -> DataFrame:
    """The rows that break a rule, with the names of those rules."""
    return flagged.where(~F.col(OK)).drop(OK)


def quality_counts(flagged: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Step counters in one aggregation: processed, rejected, duplicates, rejection_rate.

    ``duplicates`` counts valid rows beyond the first per business key (valid − distinct valid
    keys), the number of rows de-duplication removes. The rate is 0 when nothing was processed.
    """
    ok = F.col(OK)
    newest = [F.max("_ingested_at").alias("newest_ingest")] if "_ingested_at" in flagged.columns else []
    agg = flagged.groupBy(*by).agg(
        *newest,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(~ok).alias("rejected"),
        F.count_if(ok).alias("_valid"),
        F.count_distinct(F.when(ok, F.col(key))).alias("_valid_keys"),
        F.count_if(ok & F.col(key).isNull()).alias("_valid_null_keys"),
    )
    return agg.select(
        *by,
        *(["newest_ingest"] if newest else []),
        "processed",
        "rejected",
        (F.col("_valid") - F.col("_valid_keys") - F.least(F.col("_valid_null_keys"), F.lit(1))).alias("duplicates"),
        F.when(F.col("processed") > 0, F.col("rejected") / F.col("processed")).otherwise(F.lit(0.0)).alias("rejection_rate"),
    )


def rule_change(conformed: DataFrame, before: Sequence[Rule], after: Sequence[Rule], as_of: str | None = None) -> DataFrame:
    """What a change of rules does to a day's rows, in one pass: the rows that change sides, with the
    names of the rules they broke before and break now and ``change``: ``released`` rows leave
    quarantine and go to silver when the day is run again, ``caught`` ones go the other way."""
    names = {k: f"_{k}" for k in ("failed_before", "ok_before", "failed_after", "ok_after")}
    both = flag_rules(conformed, before, as_of).withColumnsRenamed({FAILURES: names["failed_before"], OK: names["ok_before"]})
    both = flag_rules(both, after, as_of).withColumnsRenamed({FAILURES: names["failed_after"], OK: names["ok_after"]})
    moved = both.where(F.col(names["ok_before"]) != F.col(names["ok_after"]))
    change = F.when(F.col(names["ok_after"]), "released").otherwise("caught")
    return moved.select(*conformed.columns, F.col(names["failed_before"]).alias("failed_before"), F.col(names["failed_after"]).alias("failed_after"), change.alias("change"))


def failure_histogram(refused: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows failing each rule (a row failing two rules counts once for each)."""
    return (
        refused.select(*by, F.explode(FAILURES).alias("rule"))
        .groupBy(*by, "rule")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def breaches(counts: DataFrame, limit: float = REJECTION_RATE_LIMIT) -> DataFrame:
    """Quality counters that need attention: rate above the limit, or every row rejected."""
    return counts.where((F.col("rejection_rate") > limit) | ((F.col("processed") > 0) & (F.col("rejected") == F.col("processed")))).select(
        "*",
        (F.col("rejection_rate") > limit).alias("rate_breach"),
        ((F.col("processed") > 0) & (F.col("rejected") == F.col("processed"))).alias("all_rejected"),
    )


def contract_report(df: DataFrame, entity: Entity) -> DataFrame:
    """Compare a landed frame's columns to the entity contract (a small report, built from the schema)."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(c, t, found.get(c), "ok" if c in found else "missing") for c, t in entity.columns]
    rows += [(c, None, t, "unexpected") for c, t in found.items() if c not in entity.column_names and not c.startswith("_")]
    spark = df.sparkSession
    return spark.createDataFrame(rows, "column string, expected_type string, found_type string, status string")
