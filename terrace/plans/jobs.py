"""Multi-step jobs over a lake folder: bronze, silver, gold, serving load, full day, backfill and
maintenance (L1–L15).

Each job is a short driver-side loop over the five entities or seven gold tables; all row work is
Spark (scans, joins, aggregations, writes). Driver-side values are only per-table counters.
"""

from __future__ import annotations

import datetime as dt
import logging
import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from terrace.contracts import CORRUPT_COLUMN, ENTITIES, LOAD_CONFIG, METRIC_DDL, STAGING_CONTRACTS
from terrace.operators import checks
from terrace.operators.conform import contract_cast
from terrace.operators.maintain import clustered_layout, erase_subject
from terrace.operators.observe import QUALITY_METRICS, StepRun, step_rows, timed_step
from terrace.operators import star
from terrace.operators.upsert import merge_upsert
from terrace.plans.pipeline import gold_plans, silver_step
from terrace.sources import tables
from terrace.sources.landing import landing_path, read_landing
from terrace.sources.tables import SnapshotTable

log = logging.getLogger(__name__)

ZONES = ("landing", "bronze", "silver", "gold", "quarantine", "serve")

@dataclass(frozen=True)
class Lake:
    """Zone folders under one root (local path, HDFS or object-store URI)."""

    root: str

    def zone(self, zone: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}"

    def table(self, zone: str, name: str) -> str:
        return f"{self.zone(zone)}/{name}"

    def landing(self, source: str, entity: str, run_date: str) -> str:
        return landing_path(self.zone("landing"), source, entity, run_date)

    def snapshot(self, spark: SparkSession, zone: str, name: str) -> SnapshotTable:
        return SnapshotTable(spark, self.table(zone, name), name)

    def scratch(self, what: str) -> str:
        """A staging folder of one use, so that runs side by side do not meet."""
        return f"{self.root.rstrip('/')}/_staged/{what}-{uuid.uuid4().hex}"

    @property
    def metrics_path(self) -> str:
        return f"{self.root.rstrip('/')}/_metrics/run_metrics"

    @property
    def erasures(self) -> str:
        return f"{self.root.rstrip('/')}/_erasures"

    @property
    def audit_path(self) -> str:
        return self.table("serve", "_load_audit")


def _ts(value: str | None):
    return F.lit(value).cast("timestamp") if value else F.current_timestamp()


def check_run_date(run_date: str) -> str:
    """Strict ``yyyy-MM-dd`` guard for the run parameter."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", run_date or ""):
        raise ValueError(f"run_date must be YYYY-MM-DD, got {run_date!r}")
    dt.date.fromisoformat(run_date)
    return run_date


# ----------------------------------------------------------------------------------- bronze (L1)
def bronze_job(spark: SparkSession, lake: Lake, run_date: str, ingested_at: str | None = None) -> dict[str, int]:
    """Copy what landed on ``run_date`` into each entity's bronze day, which is replaced, so a rerun
    changes nothing. An entity without a delivery counts 0; any other error ends the job. Rows are
    counted by an ``Observation`` on the write."""
    check_run_date(run_date)
    stamps = {"_ingested_at": _ts(ingested_at), "_run_date": F.lit(run_date).cast("date")}

    def entity_day(name: str) -> int:
        entity = ENTITIES[name]
        landed = read_landing(spark, lake.landing(entity.source, name, run_date), entity)
        if landed is None:
            return 0
        seen = Observation(f"bronze_{name}")
        tables.write_day(landed.withColumns(stamps).observe(seen, F.count(F.lit(1)).alias("n")), lake.table("bronze", name), run_date)
        return int(seen.get["n"])

    return in_parallel({name: (lambda n=name: entity_day(n)) for name in ENTITIES})


# ----------------------------------------------------------------------------------- silver (L2)
NO_ROWS = {"processed": 0, "rejected": 0, "duplicates": 0, "rejection_rate": 0.0}


def silver_entity(spark: SparkSession, lake: Lake, name: str, run_date: str, as_of: str | None = None, processed_at: str | None = None) -> dict[str, float]:
    """One entity's day: quarantine the rejected rows, merge the newest of the others into silver.

    The day's accepted rows go into the merge as they are: it keeps the newest of a key, of the day and
    of silver, in one exchange. All counters come from what the writes themselves put out (their last
    stage, where a repeated task replaces its count) and from the row count of the bronze files.
    """
    bronze = tables.read_days(spark, lake.table("bronze", name), run_date)
    if bronze is None:
        log.warning("silver %s: no bronze table yet", name)
        return dict(NO_ROWS)
    step = silver_step(bronze, name, as_of or run_date)
    refused = Observation(f"rejected_{name}_{run_date}")
    # the day in quarantine is replaced, and emptied where nothing is rejected any more
    tables.write_day(step.rejected.observe(refused, F.count(F.lit(1)).alias("n")), lake.table("quarantine", name), run_date)
    kept = Observation(f"kept_{name}_{run_date}")
    stamped = lambda df: df.drop(CORRUPT_COLUMN).withColumn("_silver_updated_at", _ts(processed_at))
    table = lake.snapshot(spark, "silver", name)
    current = table.read_or_none()
    if current is None:
        table.commit(stamped(step.silver).observe(kept, F.count(F.lit(1)).alias("n")), "WRITE")
    else:
        table.commit(merge_upsert(current, stamped(step.valid), ENTITIES[name].key, seen=kept), "MERGE")
    processed, rejected = bronze.count(), int(refused.get["n"])
    return {
        "processed": processed,
        "rejected": rejected,
        "duplicates": processed - rejected - int(kept.get["n"]),
        "rejection_rate": rejected / processed if processed else 0.0,
    }


def in_parallel(fns: dict, workers: int | None = None) -> dict:
    """Run independent Spark actions concurrently from a few driver threads (one session; Spark
    schedules their tasks side by side). Results keep the input order; the first error is raised."""
    from concurrent.futures import ThreadPoolExecutor

    if len(fns) <= 1 or workers == 1:
        return {k: f() for k, f in fns.items()}
    with ThreadPoolExecutor(max_workers=workers or len(fns)) as pool:
        futures = {k: pool.submit(f) for k, f in fns.items()}
        return {k: fut.result() for k, fut in futures.items()}


def silver_job(spark: SparkSession, lake: Lake, run_date: str, as_of: str | None = None, processed_at: str | None = None, workers: int | None = None) -> dict[str, dict]:
    """All entities of one run date; entities are independent, so their jobs run concurrently."""
    check_run_date(run_date)
    return in_parallel(
        {name: (lambda n=name: silver_entity(spark, lake, n, run_date, as_of, processed_at)) for name in ENTITIES}, workers
    )


# ------------------------------------------------------------------------------------- gold (L4)
def read_silver(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Current silver tables; an entity never loaded yields a typed empty frame from its contract."""
    out = {}
    for name, entity in ENTITIES.items():
        df = lake.snapshot(spark, "silver", name).read_or_none()
        if df is None:
            ddl = ", ".join(f"`{c}` {t}" for c, t in entity.columns) + ", _ingested_at timestamp, _source_file string, _run_date date"
            df = spark.createDataFrame([], ddl)
        out[name] = df
    return out


def gold_job(spark: SparkSession, lake: Lake, run_date: str, as_of: str | None = None, workers: int | None = None) -> dict[str, int]:
    """Rebuild the seven gold tables as new versions and export each; rows by table.

    The plans are those of the queries (``gold_plans``). Sales are joined with their properties once:
    the joined rows are staged, and the fact and the market aggregate come from those files. The
    calendar is made from the committed facts, so no fact is computed twice for it.
    """
    check_run_date(run_date)
    silver = read_silver(spark, lake)
    located = lake.scratch("located-sales")
    star.located_sales(silver["sales_transactions"], silver["properties"]).write.option("compression", tables.CODEC).parquet(located)
    plans = gold_plans(silver, as_of or run_date, spark.read.parquet(located))

    def publish(name: str, df: DataFrame) -> int:
        table = lake.snapshot(spark, "gold", name)
        table.commit(df, "REBUILD")
        seen = Observation(f"export_{name}")
        # the export is a plain copy of the committed files
        table.read().observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", tables.CODEC).parquet(tables.export_path(lake.zone("gold"), name, run_date))
        return int(seen.get["n"])

    counts = in_parallel({n: (lambda n=n: publish(n, plans[n])) for n in star.GOLD_TABLES if n != "dim_date"}, workers)
    facts = {n: lake.snapshot(spark, "gold", n).read() for n in star.FACT_DATES}
    counts["dim_date"] = publish("dim_date", star.dim_date(facts))
    tables.remove_path(spark, located)
    return counts


def freshness_readings(spark: SparkSession, lake: Lake, now: str | None) -> list[tuple]:
    """Minutes since the newest ingest in silver, and whether that is within the limit."""
    at = now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    fresh = checks.freshness(read_silver(spark, lake), at).where("entity = 'all'").first()
    if fresh is None or fresh["freshness_minutes"] is None:
        return []
    return [("freshness.minutes", fresh["freshness_minutes"]), ("freshness.check", 1), ("freshness.satisfied", int(fresh["satisfied"]))]


# ---------------------------------------------------------------------------- serving load
def load_order(spark: SparkSession, config=LOAD_CONFIG) -> DataFrame:
    """Enabled serving tables numbered by load order (W2). The control table is tiny and fixed,
    so its single ordered window partition is bounded."""
    cfg = spark.createDataFrame(list(config), "table_name string, distribution string, load_order int, enabled boolean")
    w = Window.orderBy("load_order")
    return cfg.where("enabled").select(F.row_number().over(w).alias("seq"), "table_name", "distribution", "load_order")


def serve_job(spark: SparkSession, lake: Lake, run_date: str) -> dict[str, int]:
    """Staging reload → typed build → publish → audit, per enabled table in load order.

    Facts are written clustered on ``property_id`` through a ``rebalance`` hint: AQE sizes the
    output files and splits a partition that a hot property would make too large; the small
    dimensions are left to be broadcast at query time. Publishing commits a new serving
    version, so readers see either the previous or the new table, never a partial load.
    """
    check_run_date(run_date)
    loaded = {}
    for row in load_order(spark).collect():  # the 7-row control table
        name, dist = row["table_name"], row["distribution"]
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        # the run date's export folder is the staging area: replaced on every run (truncate-and-reload)
        built = contract_cast(spark.read.parquet(tables.export_path(lake.zone("gold"), name, run_date)), STAGING_CONTRACTS[name])
        if dist.startswith("HASH("):
            key = dist[5:-1]
            built = built.hint("rebalance", key).sortWithinPartitions(key)
        table = lake.snapshot(spark, "serve", name)
        obs = Observation(f"serve_{name}")
        table.commit(built.observe(obs, F.count(F.lit(1)).alias("n")), f"LOAD {run_date}")
        loaded[name] = int(obs.get["n"])
        tables.append_audit(spark, lake.audit_path, [(dt.date.fromisoformat(run_date), name, loaded[name], started, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))])
    return loaded


# ------------------------------------------------------------------------------ full day
def write_metrics(spark: SparkSession, lake: Lake, rows: list[tuple]) -> bool:
    """Append metric rows. Metrics never decide a step: an error is logged and the step goes on."""
    try:
        spark.createDataFrame(rows, METRIC_DDL).coalesce(1).write.mode("append").parquet(lake.metrics_path)
    except Exception:
        log.exception("metrics of %s were not written", rows[0][5] if rows else "no step")
        return False
    return True


def _readings(spark: SparkSession, lake: Lake, run: StepRun, now: str | None) -> list[tuple]:
    """What the metrics say about a step beyond its outcome: (metric, value, source, entity, zone)."""
    if run.error:
        return []
    if run.step == "bronze":
        return [("records_processed", n, ENTITIES[e].source, e, "bronze") for e, n in run.report.items()]
    if run.step == "silver":
        return [(metric, counts[c], ENTITIES[e].source, e, "silver") for e, counts in run.report.items() for c, metric in QUALITY_METRICS.items()]
    return freshness_readings(spark, lake, now) if run.step == "gold" else []


def run_day(spark: SparkSession, lake: Lake, run_date: str, env: str = "local", with_load: bool = False, ingested_at: str | None = None, now: str | None = None) -> dict[str, object]:
    """A whole day: bronze, silver, gold and, if asked for, the serving load. Each step's metrics are
    written after it; a failed step ends the day with its own error."""
    check_run_date(run_date)
    finish_erasures(spark, lake)
    steps = {
        "bronze": lambda: bronze_job(spark, lake, run_date, ingested_at),
        "silver": lambda: silver_job(spark, lake, run_date),
        "gold": lambda: gold_job(spark, lake, run_date),
        "serve": lambda: serve_job(spark, lake, run_date),
    }
    done: dict[str, object] = {}
    for name in list(steps)[: 4 if with_load else 3]:
        run = timed_step(name, steps[name])
        write_metrics(spark, lake, step_rows(run, env, _readings(spark, lake, run, now)))
        if run.error:
            raise run.report
        done[name] = run.report
    return done


def backfill(spark: SparkSession, lake: Lake, dates: list[str], **kw) -> dict[str, dict]:
    """Run whole days oldest first, so later versions win in silver."""
    return {d: run_day(spark, lake, d, **kw) for d in sorted(dates)}


# ---------------------------------------------------------------------------- maintenance
def compact(spark: SparkSession, lake: Lake, zone: str, name: str, column: str, files: int) -> int:
    """Rewrite a snapshot table into ``files`` range-clustered files (new version)."""
    table = lake.snapshot(spark, zone, name)
    return table.commit(clustered_layout(table.read(), column, files), f"OPTIMIZE {column}")


def _day_folders(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/{c}" for c in tables.list_children(spark, path) if "=" in c]


#: Raw text in which a subject may stand without being parsed, and what counts as a word of it.
RAW_TEXT = ("value", CORRUPT_COLUMN)
NAMED = r"[^\s\"'{}\[\]:,]+"


def _flagged(df: DataFrame, ids: DataFrame, key: str, gone: str) -> DataFrame | None:
    """``df`` with ``gone``: the row belongs to a subject, by its key, by the field of a JSON line, or,
    where there is neither, by a word or quoted string of its raw text. None if it cannot hold one."""
    raw = next((c for c in RAW_TEXT if c in df.columns), None)
    if key not in df.columns and raw is None:
        return None
    named = F.trim(F.col(key).cast("string")) if key in df.columns else F.trim(F.get_json_object(raw, f"$.{key}"))
    out = df.withColumn("_named", named)
    by_key = ids.select(F.col(key).alias("_id"), F.lit(True).alias("_by_key"))
    out = out.join(by_key, F.col("_named") == F.col("_id"), "left").drop("_id")
    if raw is None:
        return out.withColumn(gone, F.coalesce("_by_key", F.lit(False))).drop("_named", "_by_key")
    words = F.array_union(F.regexp_extract_all(raw, F.lit(NAMED), F.lit(0)), F.regexp_extract_all(raw, F.lit('"([^"]*)"'), F.lit(1)))
    lines = out.where(F.col("_named").isNull() & F.col(raw).isNotNull()).select(F.col(raw).alias("_line"), F.explode(words).alias("_word"))
    lines = lines.join(ids, F.trim("_word") == F.col(key), "left_semi").select("_line").distinct().withColumn("_by_text", F.lit(True))
    # only the rows that are looked through as text are matched with the lines found there
    unnamed = F.col("_named").isNull() & F.col(raw).isNotNull()
    by_text = out.where(unnamed).join(lines, F.col(raw) == F.col("_line"), "left")
    out = by_text.unionByName(out.where(~unnamed), allowMissingColumns=True)
    return out.withColumn(gone, F.coalesce("_by_key", "_by_text", F.lit(False))).drop("_named", "_by_key", "_line", "_by_text")


#: Files that are written anew keep their codec, by the end of their names; others take the session's.
REWRITTEN = {".gz": "gzip", ".zstd.parquet": "zstd", ".snappy.parquet": "snappy"}


def _stage_rewrite(spark: SparkSession, folder: str, fmt: str, ids: DataFrame, key: str, staged: str) -> list[str]:
    """Write what is to stay of the files of ``folder`` that hold a subject; the names of those files."""
    df = spark.read.format(fmt).load(folder)
    flagged = _flagged(df.withColumn("_file", F.col("_metadata.file_name")), ids, key, "_gone")
    if flagged is None:
        return []
    held = sorted(r[0] for r in flagged.where("_gone").select("_file").distinct().collect())  # files of one folder
    if held:
        codec = next((c for end, c in REWRITTEN.items() if held[0].endswith(end)), None)
        out = flagged.where(F.col("_file").isin(held) & ~F.col("_gone")).select(*df.columns).write.format(fmt)
        (out.option("compression", codec) if codec else out).save(staged)
    return held


def finish_erasures(spark: SparkSession, lake: Lake) -> None:
    """Carry out the erasures whose record stands: bring in the staged files, drop those they replace,
    drop the record. Each step may have been done before the process was cut off."""
    for name in tables.list_children(spark, lake.erasures):
        if not name.endswith(".json"):
            continue
        record = json.loads(tables.read_record(spark, f"{lake.erasures}/{name}"))
        root = lake.root.rstrip("/")
        for part in record["folders"]:
            for file in tables.list_children(spark, f"{root}/{part['staged']}"):
                if file.startswith("part-"):
                    tables.move_path(spark, f"{root}/{part['staged']}/{file}", f"{root}/{part['folder']}/{file}")
            for file in part["files"]:
                tables.remove_path(spark, f"{root}/{part['folder']}/{file}")
        tables.remove_path(spark, f"{lake.erasures}/{name}")
        tables.remove_path(spark, f"{root}/{record['work']}")


def _day_tables(spark: SparkSession, lake: Lake) -> list[tuple[str, str, str]]:
    """(name, folder under the lake, format) of every landed, bronze, quarantined and exported day."""
    found = []
    for name, entity in ENTITIES.items():
        found += [(f"landing.{name}", f, "text" if entity.file_format == "json" else entity.file_format) for f in _day_folders(spark, f"{lake.zone('landing')}/{entity.source}/{name}")]
    for zone, path in (("bronze", lake.zone("bronze")), ("quarantine", lake.zone("quarantine")), ("exports", f"{lake.zone('gold')}/_exports")):
        found += [(f"{zone}.{name}", f, "parquet") for name in tables.list_children(spark, path) for f in _day_folders(spark, f"{path}/{name}") if tables.has_data(spark, f)]
    return [(n, f[len(lake.root.rstrip("/")) + 1 :], fmt) for n, f, fmt in found]


def erase(spark: SparkSession, lake: Lake, subjects: DataFrame, key: str, grace_hours: float = tables.GRACE_HOURS) -> dict[str, object]:
    """Remove subjects from every zone. Returns what was rewritten.

    Days: only the files that hold a subject are written anew, to a staging folder; one record then
    lists all of them, and the swap follows (``finish_erasures``). A process cut off before the record
    has changed nothing, one cut off after it is finished by the next erasure or daily run. Silver,
    gold and serving tables get a new version; their earlier versions and what dead writers left (no
    write for ``grace_hours``) go, as do idle staging folders."""
    finish_erasures(spark, lake)
    # the request is stored, as its size is then known: the tables need no exchange to be matched with a few
    # subjects. A process cut off leaves it to ``sweep_staging``.
    asked, work = lake.scratch("erase-request"), lake.scratch("erase")
    subjects.select(F.trim(F.col(key).cast("string")).alias(key)).distinct().write.parquet(asked)
    ids = spark.read.parquet(asked)
    done: dict[str, object] = {}
    folders = []
    for k, (name, folder, fmt) in enumerate(_day_tables(spark, lake)):
        held = _stage_rewrite(spark, f"{lake.root.rstrip('/')}/{folder}", fmt, ids, key, f"{work}/{k}")
        if held:
            folders.append({"folder": folder, "files": held, "staged": f"{work[len(lake.root.rstrip('/')) + 1 :]}/{k}"})
            done[f"{name}.{folder.rsplit('=', 1)[1]}"] = len(held)
    if folders:
        tables.write_record(spark, f"{lake.erasures}/{uuid.uuid4().hex}.json", {"work": work[len(lake.root.rstrip("/")) + 1 :], "folders": folders})
        finish_erasures(spark, lake)
    for zone in ("silver", "gold", "serve"):
        for name in (n for n in tables.list_children(spark, lake.zone(zone)) if not n.startswith("_")):
            table = lake.snapshot(spark, zone, name)
            if table.exists() and key in table.read().columns:
                done[f"{zone}.{name}"] = table.commit(erase_subject(table.read(), ids, key), f"DELETE {key}")
                table.vacuum(-1, grace_hours=grace_hours)  # an earlier version still has the subject
    tables.remove_path(spark, asked)
    sweep_staging(spark, lake, grace_hours)
    return done


def sweep_staging(spark: SparkSession, lake: Lake, grace_hours: float = tables.GRACE_HOURS) -> list[str]:
    """Drop staging folders that no record names and in which nothing was written for ``grace_hours``."""
    root = f"{lake.root.rstrip('/')}/_staged"
    named = {json.loads(tables.read_record(spark, f"{lake.erasures}/{n}"))["work"].rsplit("/", 1)[1] for n in tables.list_children(spark, lake.erasures) if n.endswith(".json")}
    idle = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(hours=grace_hours)
    gone = [n for n in tables.list_children(spark, root) if n not in named and tables.last_change(spark, f"{root}/{n}") < idle]
    for name in gone:
        tables.remove_path(spark, f"{root}/{name}")
    return sorted(gone)


def drop_expired_days(spark: SparkSession, path: str, keep_days: int, today: str, day_col: str = "_run_date") -> list[str]:
    """Retention for day tables: delete day folders older than ``keep_days`` before ``today``."""
    cutoff = dt.date.fromisoformat(today) - dt.timedelta(days=keep_days)
    removed = []
    for child in tables.list_children(spark, path):
        if child.startswith(f"{day_col}="):
            day = dt.date.fromisoformat(child.split("=", 1)[1])
            if day < cutoff and tables.remove_path(spark, f"{path}/{child}"):
                removed.append(child.split("=", 1)[1])
    return sorted(removed)


def retention_job(spark: SparkSession, lake: Lake, today: str, policy: dict[str, int] | None = None) -> dict[str, list]:
    """Apply the retention policy: old snapshot versions (the current one always stays), landed
    day folders, quarantine days and export folders older than their limits."""
    from terrace.contracts import RETENTION_DAYS

    policy = {**RETENTION_DAYS, **(policy or {})}
    now = dt.datetime.combine(dt.date.fromisoformat(today), dt.time())
    removed: dict[str, list] = {}
    for zone in ("silver", "gold", "serve"):
        for name in tables.list_children(spark, lake.zone(zone)):
            if name.startswith("_"):
                continue
            gone = lake.snapshot(spark, zone, name).vacuum(policy["versions"], now=now)
            if gone:
                removed[f"{zone}.{name}"] = gone
    if gone := sweep_staging(spark, lake):
        removed["_staged"] = gone
    for source in tables.list_children(spark, lake.zone("landing")):
        for entity in tables.list_children(spark, f"{lake.zone('landing')}/{source}"):
            path = f"{lake.zone('landing')}/{source}/{entity}"
            gone = drop_expired_days(spark, path, policy["landing"], today, day_col="ingest_date")
            if gone:
                removed[f"landing.{source}.{entity}"] = gone
    for name in tables.list_children(spark, lake.zone("quarantine")):
        gone = drop_expired_days(spark, lake.table("quarantine", name), policy["quarantine"], today)
        if gone:
            removed[f"quarantine.{name}"] = gone
    exports = f"{lake.zone('gold')}/_exports"
    for name in tables.list_children(spark, exports):
        gone = drop_expired_days(spark, f"{exports}/{name}", policy["exports"], today, day_col="run_date")
        if gone:
            removed[f"exports.{name}"] = gone
    return removed
