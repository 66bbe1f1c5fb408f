"""Registered queries over a lake that the jobs have written.

The extracts land for two run dates: on the first only closed sales and the agents, on the second
everything, so silver goes through a first write and a merge, and a day without a delivery occurs. The
jobs run both days with the serving load into a new folder under ``spark.checkpoint.dir``, once per
session and table folder; each query reads what they stored, and its oracle is the SQL of the model.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.contracts import ENTITIES, LOAD_CONFIG
from terrace.operators import serve, star
from terrace.operators.checks import fingerprint, union_all
from terrace.operators.maintain import clustered_layout, file_spans, files_touched, interleaved_layout
from terrace.operators.quality import failure_histogram
from terrace.plans import jobs
from terrace.plans.analog import FRESHNESS_AS_OF, INGESTED_AT, RUN_DATE, Tables, land_analog
from terrace.plans.oracle import SHORT, conform_select, failures_expr, silver_from
from terrace.session import ensure_checkpoint_dir, shuffles_dropped
from terrace.sources import tables
from terrace.sources.bucketed import KeyLayout, lay_out
from terrace.streaming.incremental import MONTH, MonthStore, changed_facts

FIRST_DATE = "2024-01-31"
FIRST_PART = {"sales_transactions": "line_status = 'F'", "agents": "true"}


def stored_lake(t: Tables) -> jobs.Lake:
    return t.remember("lake", lambda: _built(t))


def _built(t: Tables, what: str = "lake") -> jobs.Lake:
    lake = jobs.Lake(_folder(t, what))
    days = {FIRST_DATE: FIRST_PART, RUN_DATE: None}
    with shuffles_dropped(t.spark):
        jobs.in_parallel({d: (lambda d=d: land_analog(t.spark, lake, t.root, d, days[d])) for d in days})
        jobs.run_day(t.spark, lake, FIRST_DATE, "check", True, f"{FIRST_DATE} 02:00:00", f"{FIRST_DATE} 02:20:00")
        jobs.run_day(t.spark, lake, RUN_DATE, "check", True, INGESTED_AT, FRESHNESS_AS_OF)
    return lake


def _silver(name: str):
    return lambda t: stored_lake(t).snapshot(t.spark, "silver", name).read().select(*ENTITIES[name].column_names)


def _gold(zone: str, name: str):
    return lambda t: stored_lake(t).snapshot(t.spark, zone, name).read().drop("property_sk", "agent_sk")


def _export(name: str):
    return lambda t: t.spark.read.parquet(tables.export_path(stored_lake(t).zone("gold"), name, RUN_DATE)).drop("property_sk", "agent_sk")


def bronze_rows(t: Tables) -> DataFrame:
    """Rows of each entity's bronze days, with their files named."""
    lake, parts = stored_lake(t), []
    for name in ENTITIES:
        days = tables.read_days(t.spark, lake.table("bronze", name))
        named = F.count_if(F.col("_source_file").contains(f"/{name}/ingest_date="))
        parts.append(days.groupBy("_run_date").agg(F.count(F.lit(1)).alias("rows"), named.alias("with_file")).select(F.lit(name).alias("entity"), "*"))
    return union_all(parts)


def quarantined(t: Tables) -> DataFrame:
    """The second day's quarantined rows by rule."""
    lake, parts = stored_lake(t), []
    for name in ENTITIES:
        day = tables.read_days(t.spark, lake.table("quarantine", name), RUN_DATE)
        if day is not None:
            parts.append(failure_histogram(day).select(F.lit(name).alias("entity"), "rule", "failures"))
    return union_all(parts)


def audit(t: Tables) -> DataFrame:
    """What the second day's serving load recorded, in its order."""
    seen = tables.read_audit(t.spark, stored_lake(t).audit_path).where(F.col("run_date") == F.lit(RUN_DATE).cast("date"))
    order = union_all([seen.where(F.col("table_name") == n).select(F.lit(k).alias("load_order"), "table_name", "row_count") for n, _, k, _ in LOAD_CONFIG])
    return order


def history(t: Tables) -> DataFrame:
    """The committed versions of all stored tables."""
    lake = stored_lake(t)
    names = [("silver", n) for n in ENTITIES] + [(z, n) for z in ("gold", "serve") for n, *_ in LOAD_CONFIG]
    return union_all([lake.snapshot(t.spark, z, n).history().select(F.lit(z).alias("zone"), "table_name", "version", "operation") for z, n in names])


def step_metrics(t: Tables) -> DataFrame:
    """The metric rows of both days' steps; durations counted only."""
    seen = t.spark.read.parquet(stored_lake(t).metrics_path)
    value = F.when(F.col("metric") != "pipeline.duration_seconds", F.round("value", 9))
    return seen.groupBy("pipeline", "metric", "entity").agg(F.count(F.lit(1)).alias("points"), F.max(value).alias("largest"))


def _rows_sql() -> str:
    parts = []
    for name, s in SHORT.items():
        source = f"l_{s}"
        parts.append(f"SELECT '{name}' AS entity, DATE '{RUN_DATE}' AS _run_date, count(*) AS rows, count(*) AS with_file FROM {source}")
        if name in FIRST_PART:
            parts.append(f"SELECT '{name}', DATE '{FIRST_DATE}', count(*), count(*) FROM {source} WHERE {FIRST_PART[name]}")
    return " UNION ALL ".join(parts)


def _quarantine_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS entity, rule, count(*) AS failures FROM (SELECT unnest(string_split(failures, ',')) AS rule FROM r_{s}) GROUP BY rule" for n, s in SHORT.items()
    )


def _history_sql() -> str:
    rows = []
    for n in ENTITIES:
        made = ["WRITE", "MERGE"] if n in FIRST_PART else ["WRITE"]
        rows += [f"('silver', '{n}', {v}, '{op}')" for v, op in enumerate(made)]
    for n, *_ in LOAD_CONFIG:
        rows += [f"('gold', '{n}', {v}, 'REBUILD')" for v in (0, 1)]
        rows += [f"('serve', '{n}', {v}, 'LOAD {d}')" for v, d in enumerate((FIRST_DATE, RUN_DATE))]
    return f"SELECT zone, table_name, CAST(version AS BIGINT) AS version, operation FROM (VALUES {', '.join(rows)}) AS v(zone, table_name, version, operation)"


def _audit_sql() -> str:
    return " UNION ALL ".join(f"SELECT {k} AS load_order, '{n}' AS table_name, count(*) AS row_count FROM {n}" for n, _, k, _ in LOAD_CONFIG)


# --- layouts and incremental work over the stored lake ---------------------------------------------
def _folder(t: Tables, what: str) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def property_layout(t: Tables) -> KeyLayout:
    """The serving facts and the property dimension by property."""

    def build() -> KeyLayout:
        lake = stored_lake(t)
        frames = {n: lake.snapshot(t.spark, "serve", n).read() for n in ("dim_property", "fact_sales", "fact_leases")}
        return lay_out(t.spark, _folder(t, "layout"), frames, "property_id", 16, ("dim_property",))

    return t.remember("property layout", build)


def property_activity(t: Tables) -> DataFrame:
    """Sales beside leases for each property, both facts grouped and joined within their buckets."""

    def work(read) -> DataFrame:
        sales = read("fact_sales").groupBy("property_id").agg(F.count(F.lit(1)).alias("sales"), F.sum("sale_price").cast("decimal(18,2)").alias("volume"))
        leases = read("fact_leases").groupBy("property_id").agg(F.count(F.lit(1)).alias("leases"), F.sum("monthly_rent").cast("decimal(18,2)").alias("rent"))
        return sales.join(leases, "property_id", "left").join(read("dim_property").select("property_id", "city"), "property_id", "left")

    return property_layout(t).per_key(work)


def located_by_bucket(t: Tables) -> DataFrame:
    """Every sale with the place of its property, joined within the buckets."""
    return property_layout(t).with_dimension("fact_sales", "dim_property").select("transaction_id", "property_id", "sale_price", "city", "state")


def _sales_store(t: Tables, fact: DataFrame) -> MonthStore:
    store = MonthStore(t.spark, _folder(t, "months"), "transaction_id", "sale_date")
    store.load(fact)
    return store


def merged_fact(t: Tables) -> DataFrame:
    """The sales fact of the first day, brought up to the second by a merge of what changed: sales of
    the day's batch, and those whose property came with it."""
    lake = stored_lake(t)
    silver = jobs.read_silver(t.spark, lake)
    first = lake.snapshot(t.spark, "silver", "sales_transactions").read(0)
    store = _sales_store(t, star.fact_sales(first, silver["properties"].limit(0)))
    of_day = {n: silver[n].where(F.col("_run_date") == F.lit(RUN_DATE).cast("date")) for n in ("sales_transactions", "properties")}
    fact = star.fact_sales(silver["sales_transactions"], silver["properties"])
    store.merge(changed_facts(fact, "transaction_id", of_day["sales_transactions"], "property_id", of_day["properties"]))
    return store.read().drop(MONTH)


MOVED_FROM, MOVED_DAYS = "1997-06-01", 31


def merged_months(t: Tables) -> DataFrame:
    """Late sales move on by a month; per month its rows, and whether its files were written anew."""
    fact = stored_lake(t).snapshot(t.spark, "gold", "fact_sales").read()
    store = _sales_store(t, fact)
    files = lambda: store.read().select(MONTH, F.col("_metadata.file_name").alias("file")).distinct()
    before = t.spark.createDataFrame(files().collect(), f"{MONTH} string, file string")  # the files of a store, not its rows
    moved = fact.where(F.col("sale_date") >= F.lit(MOVED_FROM).cast("date"))
    store.merge(moved.withColumn("sale_date", F.date_add("sale_date", MOVED_DAYS)))
    same = files().join(before, [MONTH, "file"], "left_semi").select(MONTH).distinct().withColumn("same", F.lit(True))
    rows = store.read().groupBy(MONTH).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(same, MONTH, "left").select(F.substring(MONTH, 2, 7).alias("month"), "rows", F.col("same").isNull().alias("rewritten"))


# --- maintenance, each on a lake of its own ---------------------------------------------------------
def _own_lake(t: Tables, what: str) -> jobs.Lake:
    """A lake that may be changed, its caller's to remove: a copy of the stored lake, or, where no query
    has asked for that yet, one built for this use, so that the tables are on disk once."""
    if "lake" not in t.memo:
        return _built(t, f"lake-{what}")
    lake = jobs.Lake(_folder(t, f"lake-{what}"))
    tables.copy_path(t.spark, stored_lake(t).root, lake.root)
    return lake


ERASED_OFFICE = "NATION_3"
WITH_AGENT = {"agents": "dim_agent", "sales_transactions": "fact_sales", "leases": "fact_leases", "listings": "fact_listings"}


def _zone_rows(t: Tables, lake: jobs.Lake) -> list[tuple]:
    """(zone, table, rows) wherever a row names an agent; one counter a table."""
    found = []
    for name, gold in WITH_AGENT.items():
        found.append(("bronze", name, tables.read_days(t.spark, lake.table("bronze", name))))
        found.append(("quarantine", name, tables.read_days(t.spark, lake.table("quarantine", name), RUN_DATE)))
        found.append(("silver", name, lake.snapshot(t.spark, "silver", name).read()))
        found += [(zone, gold, lake.snapshot(t.spark, zone, gold).read()) for zone in ("gold", "serve")]
        found.append(("export", gold, t.spark.read.parquet(tables.export_path(lake.zone("gold"), gold, RUN_DATE))))
    return [(zone, name, df.count()) for zone, name, df in found]


def _left(t: Tables, lake: jobs.Lake) -> list[tuple]:
    """(zone, table, versions, data folders) of the snapshot tables that name an agent."""
    rows = []
    for name, gold in WITH_AGENT.items():
        for zone, table in (("silver", name), ("gold", gold), ("serve", gold)):
            folders = [c for c in tables.list_children(t.spark, lake.table(zone, table)) if c.startswith("data-")]
            rows.append((zone, table, lake.snapshot(t.spark, zone, table).history().count(), len(folders)))
    return rows


def _erased(t: Tables) -> tuple[list[tuple], list[tuple]]:
    """The rows of every zone around the erasure, and what it left of the tables' versions."""

    def build():
        lake = _own_lake(t, "erased")
        # what a writer left that died before its record
        lake.snapshot(t.spark, "silver", "agents").read().write.parquet(f"{lake.table('silver', 'agents')}/data-9-dead")
        before = _zone_rows(t, lake)
        subjects = lake.snapshot(t.spark, "gold", "dim_agent").read().where(F.col("office") == ERASED_OFFICE)
        subjects = t.spark.createDataFrame(subjects.select("agent_id").collect(), "agent_id string")  # the request
        with shuffles_dropped(t.spark):
            jobs.erase(t.spark, lake, subjects, "agent_id", grace_hours=-1.0)
        after, left = _zone_rows(t, lake), _left(t, lake)
        tables.remove_path(t.spark, lake.root)
        return [(*b, a[2]) for b, a in zip(before, after)], left

    return t.remember("erased lake", build)


def erased(t: Tables) -> DataFrame:
    """Rows of every zone before and after the agents of an office were erased."""
    return t.spark.createDataFrame(_erased(t)[0], "zone string, table_name string, rows_before bigint, rows_after bigint")


def swept(t: Tables) -> DataFrame:
    """Versions and data folders that are left of the tables that named the erased agents."""
    return t.spark.createDataFrame(_erased(t)[1], "zone string, table_name string, versions bigint, folders bigint")


SALES_PAYLOAD = [c for c in ENTITIES["sales_transactions"].column_names if c != "transaction_id"]


def version_changes(t: Tables) -> DataFrame:
    """What the second day did to each sale."""
    return stored_lake(t).snapshot(t.spark, "silver", "sales_transactions").changes("transaction_id", 0, 1, SALES_PAYLOAD)


def restored(t: Tables) -> DataFrame:
    """Silver sales after the first version was made current again."""
    lake = jobs.Lake(_folder(t, "lake-restored"))  # a restore needs the one table alone
    tables.copy_path(t.spark, stored_lake(t).table("silver", "sales_transactions"), lake.table("silver", "sales_transactions"))
    table = lake.snapshot(t.spark, "silver", "sales_transactions")
    table.restore(0)
    return table.read().select(*ENTITIES["sales_transactions"].column_names)


def rerun(t: Tables) -> DataFrame:
    """The second day run again: rows of all tables, and whether they are the same rows."""
    lake = _own_lake(t, "rerun")
    names = [("silver", n) for n in ENTITIES] + [(z, n) for z in ("gold", "serve") for n, *_ in LOAD_CONFIG]

    def prints() -> list:
        held = [fingerprint(lake.snapshot(t.spark, z, n).read().drop("_silver_updated_at", "_source_file")).select(F.lit(z).alias("zone"), F.lit(n).alias("table_name"), "*") for z, n in names]
        return sorted(union_all(held).collect())  # a row for each table

    before = prints()
    with shuffles_dropped(t.spark):
        jobs.run_day(t.spark, lake, RUN_DATE, "check", True, INGESTED_AT, FRESHNESS_AS_OF)
    rows = [(b["zone"], b["table_name"], a["rows"], a == b) for b, a in zip(before, prints())]
    tables.remove_path(t.spark, lake.root)
    return t.spark.createDataFrame(rows, "zone string, table_name string, rows bigint, same boolean")


CLUSTER_FILES = 16


def clustering(t: Tables) -> DataFrame:
    """The sales fact in 16 files, by date and along both date and property: for one value of
    either column, the rows that a filter on it finds, and whether it has to open more than half of the
    files."""
    fact = stored_lake(t).snapshot(t.spark, "gold", "fact_sales").read().select("transaction_id", "property_id", "sale_date")
    columns, out = ("sale_date", "property_id"), []
    for name, df in (("by_date", clustered_layout(fact, "sale_date", CLUSTER_FILES, ["property_id", "transaction_id"])), ("interleaved", interleaved_layout(fact, columns, CLUSTER_FILES))):
        folder = _folder(t, f"clustered-{name}")
        df.write.parquet(folder)
        stored = t.spark.read.parquet(folder)
        spans = t.spark.createDataFrame(file_spans(stored, columns).collect(), file_spans(stored, columns).schema)  # a row for each file
        for c in columns:
            values = stored.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
            middle = values.orderBy("value").offset(CLUSTER_OFFSET[c]).limit(1)
            seen = files_touched(spans, middle.select("value"), c).join(middle, "value")
            out.append(seen.select(F.lit(name).alias("layout"), F.lit(c).alias("column"), "rows", (F.col("touched") * 2 > F.col("files")).alias("opens_most")))
    return union_all(out)


CLUSTER_OFFSET = {"sale_date": 300, "property_id": 60}


def widened(t: Tables) -> DataFrame:
    """K2: bronze days of the event feed whose user became a long and whose properties came later."""
    folder = _folder(t, "widened")
    early = t.events.where("ts < TIMESTAMP '2024-01-15'").select("event_id", F.col("user_id").cast("int").alias("user_id"), F.col("value").cast("float").alias("value"))
    late = t.events.where("ts >= TIMESTAMP '2024-01-15'").select("event_id", "user_id", F.col("value").cast("float").cast("double").alias("value"), "props")
    for day, rows in (("2024-01-14", early), ("2024-01-15", late), ("2024-01-16", late.limit(0))):
        tables.write_day(rows, folder, day)
    return tables.read_widened(t.spark, folder).select("event_id", "user_id", "value", "props", F.col("_run_date").cast("date").alias("_run_date"))


def load_plan(t: Tables) -> DataFrame:
    """The enabled tables in load order with their rows, which the commit records hold: no table is
    read for it."""
    lake = stored_lake(t)
    counts = [(n, lake.snapshot(t.spark, "gold", n).committed_rows()) for n, *_ in LOAD_CONFIG]
    rows = t.spark.createDataFrame(counts, "table_name string, row_count bigint")
    return jobs.load_order(t.spark).join(rows, "table_name").select("seq", "table_name", "distribution", "row_count")


def run_report(t: Tables) -> DataFrame:
    """What the two days left: rows of the stored tables by their commit records, the second day's
    rejections by rule, and the top markets."""
    lake = stored_lake(t)
    held = [("silver_rows", "silver", n) for n in ENTITIES] + [("gold_rows", "gold", n) for n, *_ in LOAD_CONFIG]
    counts = [(section, n, float(lake.snapshot(t.spark, zone, n).committed_rows())) for section, zone, n in held]
    parts = [t.spark.createDataFrame(counts, "section string, item string, value double")]
    bad = quarantined(t).select(F.lit("rejections").alias("section"), F.concat_ws(".", "entity", "rule").alias("item"), F.col("failures").cast("double").alias("value"))
    top = serve.top_markets(lake.snapshot(t.spark, "gold", "agg_market_monthly").read())
    return union_all([*parts, bad, top.select(F.lit("top_markets").alias("section"), F.concat_ws("/", "city", "state").alias("item"), F.col("volume").cast("double").alias("value"))])


def last_loads(t: Tables) -> DataFrame:
    """The last loads into the serving tables, as many as a day has; the first day's are all older."""
    seen = serve.last_loads(tables.read_audit(t.spark, stored_lake(t).audit_path), len(LOAD_CONFIG))
    return seen.select("run_date", "table_name", "row_count")


def _erased_sql() -> str:
    subjects = f"(SELECT agent_id FROM dim_agent WHERE office = '{ERASED_OFFICE}')"
    count = lambda source, where="true": f"(SELECT count(*) FROM {source} WHERE {where})"
    kept = f"(agent_id IS NULL OR agent_id NOT IN {subjects})"
    rows = []
    for n, gold in WITH_AGENT.items():
        s = SHORT[n]
        days = [f"l_{s}"] + ([f"(SELECT * FROM l_{s} WHERE {FIRST_PART[n]})"] if n in FIRST_PART else [])
        rows.append(("bronze", n, " + ".join(count(d) for d in days), " + ".join(count(d, kept) for d in days)))
        rows.append(("quarantine", n, count(f"r_{s}"), count(f"r_{s}", kept)))
        rows.append(("silver", n, count(f"s_{s}"), count(f"s_{s}", kept)))
        rows += [(zone, gold, count(gold), count(gold, kept)) for zone in ("gold", "serve", "export")]
    return " UNION ALL ".join(f"SELECT '{z}' AS zone, '{n}' AS table_name, {b} AS rows_before, {a} AS rows_after" for z, n, b, a in rows)


def _first_day_sql() -> str:
    return silver_from("sales_transactions", "SELECT * FROM b_sales WHERE line_status = 'F'")


def _step_metrics_sql() -> str:
    """The metric rows of two days: the steps, the counters of bronze and silver, and the freshness."""
    parts = [
        f"SELECT '{step}' AS pipeline, '{metric}' AS metric, NULL::VARCHAR AS entity, 2::BIGINT AS points, {value}::DOUBLE AS largest"
        for step in ("bronze", "silver", "gold", "serve")
        for metric, value in (("pipeline.execution", "1"), ("pipeline.success", "1"), ("pipeline.duration_seconds", "NULL"))
    ]
    for n, s in SHORT.items():
        # a day without a delivery has counters of 0
        days = [f"SELECT * FROM b_{s}"] + ([f"SELECT * FROM b_{s} WHERE {FIRST_PART[n]}"] if n in FIRST_PART else [])
        counts = [
            f"SELECT (SELECT count(*) FROM ({d}))::DOUBLE AS n, (SELECT count(*) FROM (SELECT {failures_expr(n)} AS failures FROM ({conform_select(n, f'({d})')})) WHERE failures <> '')::DOUBLE AS bad, "
            f"(SELECT count(*) FROM ({silver_from(n, d)}))::DOUBLE AS kept"
            for d in days
        ]
        both = f"FROM ({' UNION ALL '.join(counts)})"
        parts.append(f"SELECT 'bronze', 'records_processed', '{n}', 2, max(n) {both}")
        for metric, value in (("records_processed", "n"), ("records_rejected", "bad"), ("duplicates", "n - bad - kept"), ("rejection_rate", "round(bad / n, 9)")):
            parts.append(f"SELECT 'silver', 'quality.{metric}', '{n}', 2, max({value}) {both}")
    times = [f"epoch(TIMESTAMP '{b}' - TIMESTAMP '{a}') / 60" for a, b in ((f"{FIRST_DATE} 02:00:00", f"{FIRST_DATE} 02:20:00"), (INGESTED_AT, FRESHNESS_AS_OF))]
    parts.append(f"SELECT 'gold', 'freshness.minutes', NULL, 2, greatest({', '.join(times)})")
    parts.append("SELECT 'gold', 'freshness.check', NULL, 2, 1")
    parts.append(f"SELECT 'gold', 'freshness.satisfied', NULL, 2, (least({', '.join(times)}) <= 30)::INT")
    return " UNION ALL ".join(parts)


def lake_queries() -> dict[str, tuple]:
    """name: (function of the tables, SQL or None)."""
    out = {}
    for name in ENTITIES:
        out[f"lake_silver_{name}"] = (_silver(name), f"SELECT {', '.join(ENTITIES[name].column_names)} FROM s_{SHORT[name]}")
    for name, *_ in LOAD_CONFIG:
        out[f"lake_gold_{name}"] = (_gold("gold", name), f"SELECT * FROM {name}")
    for name in ("dim_agent", "fact_sales", "agg_market_monthly"):
        out[f"lake_export_{name}"] = (_export(name), f"SELECT * FROM {name}")
        out[f"lake_serve_{name}"] = (_gold("serve", name), f"SELECT * FROM {name}")
    out["lake_bronze_rows"] = (bronze_rows, _rows_sql())
    out["lake_quarantine"] = (quarantined, _quarantine_sql())
    out["lake_audit"] = (audit, _audit_sql())
    out["lake_history"] = (history, _history_sql())
    out["lake_step_metrics"] = (step_metrics, _step_metrics_sql())
    out["lake_property_activity"] = (
        property_activity,
        """SELECT s.property_id, sales, volume, leases, rent, city
FROM (SELECT property_id, count(*) AS sales, CAST(sum(sale_price) AS DECIMAL(18,2)) AS volume FROM fact_sales GROUP BY 1) s
LEFT JOIN (SELECT property_id, count(*) AS leases, CAST(sum(monthly_rent) AS DECIMAL(18,2)) AS rent FROM fact_leases GROUP BY 1) l ON l.property_id = s.property_id
LEFT JOIN dim_property p ON p.property_id = s.property_id""",
    )
    out["lake_located_sales"] = (
        located_by_bucket,
        "SELECT transaction_id, f.property_id, sale_price, city, state FROM fact_sales f LEFT JOIN dim_property p ON p.property_id = f.property_id",
    )
    values = ", ".join(f"('{n}', '{d}', {k})" for n, d, k, enabled in LOAD_CONFIG if enabled)
    sizes = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n, *_ in LOAD_CONFIG)
    out["lake_load_plan"] = (
        load_plan,
        f"""SELECT CAST(row_number() OVER (ORDER BY c.load_order) AS INTEGER) AS seq, c.table_name, c.distribution, r.row_count
FROM (VALUES {values}) AS c(table_name, distribution, load_order) JOIN ({sizes}) r ON r.table_name = c.table_name""",
    )
    report = [f"SELECT 'silver_rows' AS section, '{n}' AS item, count(*)::DOUBLE AS value FROM s_{s}" for n, s in SHORT.items()]
    report += [f"SELECT 'gold_rows', '{n}', count(*)::DOUBLE FROM {n}" for n, *_ in LOAD_CONFIG]
    report.append(f"SELECT 'rejections', entity || '.' || rule, failures::DOUBLE FROM ({_quarantine_sql()})")
    report.append("SELECT 'top_markets', city || '/' || state, volume::DOUBLE FROM (SELECT city, state, sum(total_volume) AS volume FROM agg_market_monthly GROUP BY ALL ORDER BY volume DESC, city, state LIMIT 10)")
    out["lake_run_report"] = (run_report, " UNION ALL ".join(report))
    out["lake_fact_merge"] = (merged_fact, "SELECT * FROM fact_sales")
    moved = f"SELECT transaction_id, sale_date, sale_date >= DATE '{MOVED_FROM}' AS moves, CASE WHEN sale_date >= DATE '{MOVED_FROM}' THEN sale_date + {MOVED_DAYS} ELSE sale_date END AS now FROM fact_sales"
    out["lake_fact_months"] = (
        merged_months,
        f"""SELECT strftime(now, '%Y-%m') AS month, count(*) AS rows,
  strftime(now, '%Y-%m') IN (SELECT strftime(sale_date, '%Y-%m') FROM ({moved}) WHERE moves UNION SELECT strftime(now, '%Y-%m') FROM ({moved}) WHERE moves) AS rewritten
FROM ({moved}) GROUP BY 1""",
    )
    out["lake_erase"] = (erased, _erased_sql())
    out["lake_vacuum"] = (
        swept,
        " UNION ALL ".join(
            f"SELECT '{z}' AS zone, '{n}' AS table_name, 1::BIGINT AS versions, 1::BIGINT AS folders" for e, g in WITH_AGENT.items() for z, n in (("silver", e), ("gold", g), ("serve", g))
        ),
    )
    differs = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in SALES_PAYLOAD)
    out["lake_version_changes"] = (
        version_changes,
        f"""SELECT coalesce(a.transaction_id, b.transaction_id) AS transaction_id,
  CASE WHEN b.transaction_id IS NULL THEN 'inserted' WHEN a.transaction_id IS NULL THEN 'deleted' ELSE 'changed' END AS change
FROM s_sales a FULL JOIN ({_first_day_sql()}) b ON a.transaction_id = b.transaction_id
WHERE a.transaction_id IS NULL OR b.transaction_id IS NULL OR {differs}""",
    )
    out["lake_restored"] = (restored, f"SELECT {', '.join(ENTITIES['sales_transactions'].column_names)} FROM ({_first_day_sql()})")
    counted = [("silver", n, f"s_{s}") for n, s in SHORT.items()] + [(z, n, n) for z in ("gold", "serve") for n, *_ in LOAD_CONFIG]
    out["lake_rerun"] = (rerun, " UNION ALL ".join(f"SELECT '{z}' AS zone, '{n}' AS table_name, count(*) AS rows, true AS same FROM {source}" for z, n, source in counted))
    rows = lambda c: f"(SELECT count(*) FROM fact_sales WHERE {c} = (SELECT DISTINCT {c} FROM fact_sales ORDER BY {c} LIMIT 1 OFFSET {CLUSTER_OFFSET[c]}))"
    out["lake_clustering"] = (
        clustering,
        " UNION ALL ".join(
            f"SELECT '{layout}' AS layout, '{c}' AS \"column\", {rows(c)} AS rows, {opens} AS opens_most"
            for layout, c, opens in (("by_date", "sale_date", False), ("by_date", "property_id", True), ("interleaved", "sale_date", False), ("interleaved", "property_id", False))
        ),
    )
    out["bronze_widened"] = (
        widened,
        "SELECT event_id, user_id, value::FLOAT::DOUBLE AS value, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN props END AS props, "
        "CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN DATE '2024-01-15' ELSE DATE '2024-01-14' END AS _run_date FROM events",
    )
    loads = [f"SELECT DATE '{RUN_DATE}' AS run_date, '{n}' AS table_name, count(*) AS row_count FROM {n}" for n, *_ in LOAD_CONFIG]
    out["lake_last_loads"] = (last_loads, " UNION ALL ".join(loads))
    return out
