"""Step results as metric rows, and the SLO, monitor and dashboard queries over metric points (L3, K17,
A12-A15, A17).

Each step of a run becomes a ``StepRun``, whose rows are written once after it. The queries take any
frame of points (ts, metric, value, entity): the stored rows of runs, or ``event_points`` of a stream.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.contracts import FRESHNESS_LIMIT_MINUTES, REJECTION_RATE_LIMIT, SLO_DAYS, SLO_TARGETS, SLO_WARNINGS, STEP_DURATION_LIMIT_SECONDS

# counter column → metric name (the names the silver job emits)
QUALITY_METRICS = {
    "processed": "quality.records_processed",
    "rejected": "quality.records_rejected",
    "rejection_rate": "quality.rejection_rate",
    "duplicates": "quality.duplicates",
}


@dataclass(frozen=True)
class StepRun:
    """What one step of a run did: when it began, how long it took, its error, and what it reports."""

    step: str
    began: datetime
    seconds: float
    error: str | None = None
    report: object = None


def timed_step(step: str, work: Callable[[], object]) -> StepRun:
    """Run a step and say how it went; an error is part of the answer, not raised."""
    began, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()
    try:
        done, error = work(), None
    except Exception as exc:  # the caller decides what a failed step means
        done, error = exc, f"{type(exc).__name__}: {exc}"
    return StepRun(step, began, time.monotonic() - clock, error, done)


def step_rows(run: StepRun, env: str, readings: Sequence[tuple] = ()) -> list[tuple]:
    """Metric rows (METRIC_DDL) of one step: that it ran, how it ended and how long it took, and its
    readings (metric, value, source, entity, zone)."""
    outcome = "job.failed" if run.error else "pipeline.success"
    row = lambda metric, kind, value, *tags: (metric, kind, float(value), run.began, env, run.step, *(tags or (None, None, None)))
    counted = [row("pipeline.execution", "count", 1), row(outcome, "count", 1), row("pipeline.duration_seconds", "gauge", run.seconds)]
    return counted + [row(metric, "count" if metric.startswith("freshness.") and not metric.endswith("minutes") else "gauge", value, *tags) for metric, value, *tags in readings]


# What an event of the stream measures, as (metric, kind, SQL of its value).
READINGS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "view": (("records_processed", "gauge", "value"), ("quality.records_processed", "gauge", "floor(value)")),
    "click": (("quality.rejection_rate", "gauge", "value / 1997"), ("quality.records_rejected", "gauge", "floor(value / 4)")),
    "purchase": (("pipeline.duration_seconds", "gauge", "value * 20"), ("quality.duplicates", "gauge", "floor(value / 10)")),
    "signup": (("freshness.minutes", "gauge", "value"), ("freshness.check", "count", "1"), ("freshness.satisfied", "count", "if(value <= 30, 1, 0)")),
    "error": (("job.failed", "count", "1"),),
}


def event_points(events: DataFrame, tags: Mapping[str, Column] | None = None) -> DataFrame:
    """Metric points (ts, metric, kind, value, entity) of an event stream, one pass: every event is a
    run of something, which succeeded unless the event is an error, and has the readings of its type.
    The user is the entity; ``tags`` are further ones, by name."""
    runs = "struct('pipeline.execution' AS metric, 'count' AS kind, 1D AS value), struct('pipeline.success' AS metric, 'count' AS kind, if(event_type = 'error', 0D, 1D) AS value)"
    cases = " ".join(
        f"WHEN '{kind}' THEN array({', '.join(f"struct('{m}' AS metric, '{k}' AS kind, double({v}) AS value)" for m, k, v in rows)})" for kind, rows in READINGS.items()
    )
    none = "CAST(array() AS array<struct<metric:string,kind:string,value:double>>)"
    points = F.expr(f"concat(array({runs}), CASE event_type {cases} ELSE {none} END)")
    tagged = [c.alias(name) for name, c in (tags or {}).items()]
    each = events.select("ts", F.concat(F.lit("u"), F.col("user_id")).alias("entity"), *tagged, F.explode(points).alias("p"))
    return each.select("ts", "p.metric", "p.kind", "p.value", "entity", *(tags or {}))


def slo(metrics: DataFrame, until: str | None = None, by: Sequence[str] = (), days: int = SLO_DAYS) -> DataFrame:
    """Success and freshness over the ``days`` before ``until`` (without: all), per tag of ``by``:
    attained percent and whether it meets the target, is below the warning level, or breaches."""
    m = metrics
    if until:
        end = F.lit(until).cast("timestamp")
        m = m.where((F.col("ts") >= end - F.expr(f"INTERVAL {days} DAYS")) & (F.col("ts") < end))
    total = lambda name: F.coalesce(F.sum(F.when(F.col("metric") == name, F.col("value"))), F.lit(0.0))
    sums = m.groupBy(*by).agg(*[total(n).alias(f"{slo}_{k}") for slo, pair in SLO_RATIOS.items() for k, n in zip("nd", pair, strict=True)])
    rows = [F.struct(F.lit(n).alias("slo"), F.col(f"{n}_n").alias("numerator"), F.col(f"{n}_d").alias("denominator"), F.lit(SLO_TARGETS[n]).alias("target_pct"), F.lit(SLO_WARNINGS[n]).alias("warning_pct")) for n in SLO_RATIOS]
    out = sums.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")
    pct = F.round(F.try_divide(F.col("numerator") * 100.0, F.col("denominator")), 9)
    out = out.withColumn("attainment_pct", pct).withColumn("met", F.col("attainment_pct") >= F.col("target_pct"))
    state = F.when(~F.col("met"), "breached").when(F.col("attainment_pct") < F.col("warning_pct"), "warning").when(F.col("met"), "ok")
    return out.withColumn("state", state)


SLO_RATIOS = {"pipeline_success": ("pipeline.success", "pipeline.execution"), "data_freshness": ("freshness.satisfied", "freshness.check")}

# Monitors as (name, metric, aggregate, trailing minutes, limit, alert when).
MONITORS: tuple[tuple[str, str, str, int, float, str], ...] = (
    ("rejection_rate", "quality.rejection_rate", "avg", 15, REJECTION_RATE_LIMIT, "above"),
    ("freshness", "freshness.minutes", "max", 15, float(FRESHNESS_LIMIT_MINUTES), "above"),
    ("job_failed", "job.failed", "sum", 15, 0.0, "above"),
    ("step_duration", "pipeline.duration_seconds", "avg", 30, float(STEP_DURATION_LIMIT_SECONDS), "above"),
    ("pipeline_failed", "pipeline.success", "min", 15, 0.0, "at most"),
    ("no_records", "quality.records_processed", "min", 15, 0.0, "at most"),
)


def monitors(metrics: DataFrame, definitions: Sequence[tuple[str, str, str, int, float, str]] = MONITORS) -> DataFrame:
    """Every monitor at every full minute whose trailing window has points: (monitor, at, value, limit,
    alert).

    One pass: points are summed per metric and minute before any shuffle, and a minute's sums count for
    each evaluation within the window. No task holds a metric's whole series.
    """
    names = sorted({d[1] for d in definitions})
    minute = F.date_trunc("minute", "ts")
    sums = metrics.where(F.col("metric").isin(names)).groupBy("metric", minute.alias("minute"))
    sums = sums.agg(F.sum("value").alias("s"), F.count("value").alias("n"), F.max("value").alias("hi"), F.min("value").alias("lo"))
    rows = [F.struct(*[F.lit(x).alias(k) for k, x in zip(("monitor", "of", "agg", "width", "limit", "when"), d, strict=True)]) for d in definitions]
    mine = F.filter(F.array(*rows), lambda d: d["of"] == F.col("metric"))
    each = sums.select("minute", "s", "n", "hi", "lo", F.explode(mine).alias("d"))
    ahead = each.select("*", F.explode(F.sequence(F.lit(1), F.col("d.width"))).alias("k"))
    at = F.timestamp_add("MINUTE", F.col("k"), F.col("minute"))
    seen = ahead.groupBy(F.col("d.monitor").alias("monitor"), at.alias("at"), F.col("d.agg").alias("agg"), F.col("d.limit").alias("limit"), F.col("d.when").alias("when"))
    seen = seen.agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("hi").alias("hi"), F.min("lo").alias("lo"))
    value = F.when(F.col("agg") == "avg", F.col("s") / F.col("n")).when(F.col("agg") == "max", F.col("hi")).when(F.col("agg") == "min", F.col("lo")).otherwise(F.col("s"))
    # rounded, so that a reading does not depend on the order in which partial sums met
    out = seen.withColumn("value", F.round(value, 6))
    alert = F.when(F.col("when") == "above", F.col("value") > F.col("limit")).otherwise(F.col("value") <= F.col("limit"))
    return out.select("monitor", "at", "value", "limit", alert.alias("alert"))


# The top lists, the largest value of a metric per entity.
TOP_METRICS = ("quality.rejection_rate", "quality.records_processed", "quality.records_rejected", "quality.duplicates", "records_processed")


def metric_top(metrics: DataFrame, names: Sequence[str] = TOP_METRICS, n: int = 10) -> DataFrame:
    """The ``n`` entities with the largest value of each metric: (metric, place, entity, max_value)."""
    from pyspark.sql import Window

    most = metrics.where(F.col("metric").isin(*names)).groupBy("metric", "entity").agg(F.max("value").alias("max_value"))
    place = F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("max_value"), "entity"))
    return most.withColumn("place", place).where(F.col("place") <= n)


def metric_series(metrics: DataFrame, bucket: str = "day") -> DataFrame:
    """All series of the dashboards in one pass: per metric and time bucket its points, sum, largest
    value and mean."""
    sums = metrics.groupBy("metric", F.date_trunc(bucket, "ts").alias("bucket_start"))
    return sums.agg(F.count("value").alias("points"), F.round(F.sum("value"), 6).alias("total"), F.max("value").alias("largest"), F.round(F.avg("value"), 6).alias("mean"))


def series_by_tag(metrics: DataFrame, tags: Sequence[str] = ("source", "pipeline", "entity"), bucket: str = "hour") -> DataFrame:
    """The series of each metric in total and by each tag, per time bucket: (metric, series, tag,
    bucket_start, points, total, largest, mean).

    One pass and one exchange: grouping sets put a point into its series of every kind, and sums per
    task go ahead of the exchange. ``series`` names the tag, so points without one (a NULL tag) are a
    series of their own, apart from the total.
    """
    points = metrics.select("metric", F.date_trunc(bucket, "ts").alias("bucket_start"), *tags, "value")
    base = [points["metric"], points["bucket_start"]]
    grouped = points.groupingSets([base, *[[*base, points[t]] for t in tags]], *base, *[points[t] for t in tags])
    sums = grouped.agg(
        *[F.grouping(t).alias(f"_no_{t}") for t in tags],
        F.count("value").alias("points"),
        F.round(F.sum("value"), 6).alias("total"),
        F.max("value").alias("largest"),
        F.round(F.avg("value"), 6).alias("mean"),
    )
    series, tag = F.lit("total"), F.lit(None).cast("string")
    for t in tags:
        series, tag = F.when(F.col(f"_no_{t}") == 0, t).otherwise(series), F.when(F.col(f"_no_{t}") == 0, F.col(t)).otherwise(tag)
    return sums.select("metric", series.alias("series"), tag.alias("tag"), "bucket_start", "points", "total", "largest", "mean")


def metric_tiles(metrics: DataFrame) -> DataFrame:
    """The tiles: runs, successes, failures, and the largest and latest freshness reading."""
    of = lambda name: F.when(F.col("metric") == name, F.col("value"))
    latest = F.max(F.when(F.col("metric") == "freshness.minutes", F.struct("ts", "value")))
    sums = [F.coalesce(F.sum(of(m)), F.lit(0.0)).alias(a) for a, m in (("total_runs", "pipeline.execution"), ("successful_runs", "pipeline.success"), ("failed_runs", "job.failed"))]
    out = metrics.agg(*sums, F.max(of("freshness.minutes")).alias("worst_freshness_minutes"), latest.alias("l"))
    return out.select("total_runs", "successful_runs", "failed_runs", "worst_freshness_minutes", F.col("l.ts").alias("last_freshness_ts"), F.col("l.value").alias("last_freshness_minutes"))
