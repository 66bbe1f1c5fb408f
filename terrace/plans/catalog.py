"""Registered queries: one Spark plan per operator of the inventory, each paired with its oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the driver tables under ``sf_dir`` (through the analog
extracts of ``terrace.plans.analog``) and returns a lazy DataFrame. ``ORACLE`` holds the DuckDB
text for the same result; queries without an entry get a rows-only check (they expose file paths
or 64-bit hashes DuckDB cannot reproduce).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.contracts import ENTITIES, LOAD_CONFIG, RULES, STAGING_CONTRACTS, Rule
from terrace.operators import checks, observe, serve
from terrace.operators.conform import conform, contract_cast
from terrace.operators.maintain import erase_subject, pseudonymise
from terrace.operators.quality import FAILURES, OK, breaches, failure_histogram, flag_rules, quality_counts, rejected, rule_change, valid
from terrace.operators.upsert import merge_delete_missing, merge_upsert
from terrace.plans import analog, pipeline
from terrace.plans.analog import FRESHNESS_AS_OF, Tables
from terrace.plans.oracle import SHORT, conform_select, silver_from, with_base
from terrace.sources.landing import flatten_envelopes, parse_json_column, to_envelopes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


_TABLES: dict[tuple[int, str], Tables] = {}


def tables_for(spark: SparkSession, sf_dir: str) -> Tables:
    """One ``Tables`` per (session, folder): the base plans (bronze → silver → gold) are built once
    per session and shared by every query, like session temp views. Query-specific parts are
    planned per call."""
    key = (id(spark), sf_dir.rstrip("/"))
    t = _TABLES.get(key)
    if t is None or t.spark is not spark:
        t = _TABLES[key] = Tables(spark, key[1])
    return t


def _run(fn, spark: SparkSession, sf_dir: str) -> DataFrame:
    # The model's times are UTC (as the platform's sessions are); pin it so results do not depend
    # on the caller's session zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return fn(tables_for(spark, sf_dir))


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: _run(fn, spark, sf_dir)
        if sql is not None:
            ORACLE[name] = with_base(sql)
        return fn

    return deco


def _cols(name: str) -> str:
    return ", ".join(ENTITIES[name].column_names)


def _entity(df: DataFrame, name: str) -> DataFrame:
    return df.select(*ENTITIES[name].column_names)


# ----------------------------------------------------------------------------------- scans (S)
@register("scan_parquet", "SELECT * FROM l_prop")
def scan_parquet(t: Tables) -> DataFrame:
    """Landed parquet extract (projection pushed into the scan)."""
    return analog.landed_properties(t)


@register("scan_json_props", "SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def scan_json_props(t: Tables) -> DataFrame:
    """JSON text with an explicit schema (malformed text → NULL fields, never a failed job)."""
    return parse_json_column(t.events, "props", "k bigint").select("event_id", "k")


DAY = "2024-01-15"


@register(
    "scan_day_partition",
    f"SELECT {_cols('listings')}, _run_date FROM b_list WHERE _run_date = DATE '{DAY}'",
)
def scan_day_partition(t: Tables) -> DataFrame:
    """One run date of the daily feed; the day bound becomes a pushed parquet filter on ``ts``."""
    lo = F.lit(DAY).cast("timestamp")
    events = t.events.where((F.col("ts") >= lo) & (F.col("ts") < lo + F.expr("INTERVAL 1 DAY")))
    df = analog.with_bronze_metadata(analog.landed_listings(t, events), "listings")
    return df.select(*ENTITIES["listings"].column_names, "_run_date")


_LANDED_LISTING_COLS = "listing_id, property_id, agent_id, list_price, status, listed_at, updated_at"


@register("flatten_envelope", f"SELECT {_LANDED_LISTING_COLS} FROM l_list")
def flatten_envelope(t: Tables) -> DataFrame:
    """The feed as paged API envelopes (500 rows per page), flattened back to rows."""
    rows = analog.landed_listings(t).drop("props")
    pages = to_envelopes(rows, page_of=F.floor(F.col("listing_id").substr(F.lit(3), F.lit(20)).cast("bigint") / 500))
    return flatten_envelopes(pages, rows.schema).select(*rows.columns)


@register(
    "view_scan",
    "SELECT status, count(*) AS listings, CAST(sum(list_price) AS DECIMAL(38,2)) AS list_value FROM fact_listings GROUP BY status",
)
def view_scan(t: Tables) -> DataFrame:
    """Named views over gold tables, queried with SQL."""
    gold = pipeline.gold_frames(t)
    serve.register_views(t.spark, {"fact_listings": gold["fact_listings"]})
    return t.spark.sql(
        "SELECT status, count(*) AS listings, CAST(sum(list_price) AS DECIMAL(38,2)) AS list_value FROM gold_fact_listings GROUP BY status"
    )


@register("source_file_counts", "SELECT 'events.parquet' AS source_file, count(*) AS rows FROM events")
def source_file_counts(t: Tables) -> DataFrame:
    """Rows per source file through the ``_metadata.file_path`` pseudo-column (file name part,
    since the folder differs between machines)."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)
    return t.events.select(name.alias("source_file")).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


_LOAD_VALUES = ", ".join(f"('{n}', '{d}', {o}, {str(e).upper()})" for n, d, o, e in LOAD_CONFIG)
_ROW_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n, *_ in LOAD_CONFIG)


@register(
    "load_plan",
    f"""SELECT CAST(row_number() OVER (ORDER BY c.load_order) AS INTEGER) AS seq, c.table_name, c.distribution, r.row_count
FROM (VALUES {_LOAD_VALUES}) AS c(table_name, distribution, load_order, enabled)
JOIN ({_ROW_COUNTS_SQL}) r ON r.table_name = c.table_name WHERE c.enabled""",
)
def load_plan(t: Tables) -> DataFrame:
    """Enabled gold tables in load order with their current row counts."""
    from terrace.plans.jobs import load_order

    gold = pipeline.gold_frames(t)
    counts = checks.row_counts(gold)
    return load_order(t.spark).join(counts, "table_name").select("seq", "table_name", "distribution", "row_count")


# ------------------------------------------------------------------------------ conformance (P)
@register("conform_part", "SELECT * FROM c_prop")
def conform_part(t: Tables) -> DataFrame:
    """Landed properties onto the contract (unknown ``list_value`` dropped)."""
    return pipeline.conformed(t, "properties").drop("_source_file")


@register(
    "conform_missing_col",
    conform_select("agents", "(SELECT * EXCLUDE (license_number, hired_date) FROM b_agent)", ("license_number", "hired_date")),
)
def conform_missing_col(t: Tables) -> DataFrame:
    """Columns absent from the extract come back as typed NULLs."""
    df = analog.bronze(t, "agents").drop("license_number", "hired_date")
    return conform(df, ENTITIES["agents"]).drop("_source_file")


@register("conform_strings", "SELECT * FROM c_agent")
def conform_strings(t: Tables) -> DataFrame:
    """Trim, case rules (email lower), blank → NULL."""
    return pipeline.conformed(t, "agents").drop("_source_file")


_TEXT_SALES_SQL = """SELECT transaction_id, property_id, agent_id,
  CASE WHEN line_status = 'F' THEN 'USD ' || CAST(sale_price AS VARCHAR) ELSE CAST(sale_price AS VARCHAR) END AS sale_price,
  strftime(sale_date, '%Y-%m-%d') AS sale_date,
  CASE WHEN line_status = 'F' THEN 'n/a' ELSE strftime(closing_date, '%Y-%m-%d') END AS closing_date,
  financing_type, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at, _ingested_at, _run_date FROM b_sales"""


@register("conform_try_cast", conform_select("sales_transactions", f"({_TEXT_SALES_SQL})"))
def conform_try_cast(t: Tables) -> DataFrame:
    """An all-text extract; unparseable values become NULL instead of failing the job."""
    b = analog.bronze(t, "sales_transactions")
    closed = F.col("line_status") == "F"
    text = b.select(
        "transaction_id", "property_id", "agent_id",
        F.when(closed, F.concat(F.lit("USD "), F.col("sale_price").cast("string"))).otherwise(F.col("sale_price").cast("string")).alias("sale_price"),
        F.date_format("sale_date", "yyyy-MM-dd").alias("sale_date"),
        F.when(closed, F.lit("n/a")).otherwise(F.date_format("closing_date", "yyyy-MM-dd")).alias("closing_date"),
        "financing_type",
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
        "_ingested_at", "_run_date",
    )
    return conform(text, ENTITIES["sales_transactions"])


# ------------------------------------------------------------------------------- quality (Q)
@register("dq_valid_sales", f"SELECT {_cols('sales_transactions')} FROM v_sales")
def dq_valid_sales(t: Tables) -> DataFrame:
    return _entity(pipeline.silver_steps(t)["sales_transactions"].valid, "sales_transactions")


@register("dq_rejected_sales", f"SELECT {_cols('sales_transactions')}, failures AS dq_failures FROM r_sales")
def dq_rejected_sales(t: Tables) -> DataFrame:
    rej = pipeline.silver_steps(t)["sales_transactions"].rejected
    return rej.select(*ENTITIES["sales_transactions"].column_names, F.array_join(FAILURES, ",").alias("dq_failures"))


_FIN_RULE = Rule("financing_type_known", "financing_type IN ('URGENT','HIGH','MEDIUM','LOW')")


@register(
    "dq_null_is_failure",
    "SELECT transaction_id, financing_type, 'financing_type_known' AS dq_failures FROM c_sales "
    "WHERE NOT coalesce(financing_type IN ('URGENT','HIGH','MEDIUM','LOW'), false)",
)
def dq_null_is_failure(t: Tables) -> DataFrame:
    """Q2: a NULL verdict (blank financing type → NULL) is a failure, not a pass."""
    refused = rejected(flag_rules(pipeline.conformed(t, "sales_transactions"), [_FIN_RULE]))
    return refused.select("transaction_id", "financing_type", F.array_join(FAILURES, ",").alias("dq_failures"))


def _per_entity_sql(template: str) -> str:
    return " UNION ALL ".join(template.format(entity=n, s=s, key=ENTITIES[n].key, rules=len(RULES[n])) for n, s in SHORT.items())


@register(
    "dq_rules_all",
    _per_entity_sql(
        "SELECT '{entity}' AS entity, {rules} AS rules, count(*) AS processed, count(*) FILTER (WHERE failures = '') AS valid, "
        "count(*) FILTER (WHERE failures <> '') AS rejected FROM f_{s}"
    ),
)
def dq_rules_all(t: Tables) -> DataFrame:
    """Q3: every entity against its full rule set."""
    parts = []
    for name, st in pipeline.silver_steps(t).items():
        ok = F.col(OK)
        parts.append(
            st.flagged.agg(F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("valid"), F.count_if(~ok).alias("rejected")).select(
                F.lit(name).alias("entity"), F.lit(len(RULES[name])).alias("rules"), "processed", "valid", "rejected"
            )
        )
    return checks.union_all(parts)


_DQ_METRICS_SQL = _per_entity_sql(
    "SELECT '{entity}' AS entity, _run_date, max(_ingested_at) AS newest_ingest, count(*) AS processed, "
    "count(*) FILTER (WHERE failures <> '') AS rejected, "
    "count(*) FILTER (WHERE failures = '') - count(DISTINCT CASE WHEN failures = '' THEN {key} END) "
    "- CASE WHEN count(*) FILTER (WHERE failures = '' AND {key} IS NULL) > 0 THEN 1 ELSE 0 END AS duplicates, "
    "CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE failures <> '') AS DOUBLE) / count(*) ELSE 0.0 END AS rejection_rate "
    "FROM f_{s} GROUP BY _run_date"
)


def _dq_metrics(t: Tables) -> DataFrame:
    parts = []
    for name, st in pipeline.silver_steps(t).items():
        c = quality_counts(st.flagged, ENTITIES[name].key, by=["_run_date"])
        parts.append(c.select(F.lit(name).alias("entity"), *c.columns))
    return checks.union_all(parts)


@register("dq_metrics", _DQ_METRICS_SQL)
def dq_metrics(t: Tables) -> DataFrame:
    """Q4: processed / rejected / duplicates / rate per entity and run date, one aggregation each."""
    return _dq_metrics(t)


@register("dq_breaches", f"SELECT *, rejection_rate > 0.01 AS rate_breach, (processed > 0 AND rejected = processed) AS all_rejected FROM ({_DQ_METRICS_SQL}) WHERE rejection_rate > 0.01 OR (processed > 0 AND rejected = processed)")
def dq_breaches(t: Tables) -> DataFrame:
    """Q6: counters over the rejection-rate limit or fully rejected."""
    return breaches(_dq_metrics(t))


@register(
    "dq_failure_histogram",
    _per_entity_sql(
        "SELECT '{entity}' AS entity, rule, count(*) AS failures FROM (SELECT unnest(string_split(failures, ',')) AS rule FROM r_{s}) GROUP BY rule"
    ),
)
def dq_failure_histogram(t: Tables) -> DataFrame:
    """Rejected rows per failed rule."""
    parts = []
    for name, st in pipeline.silver_steps(t).items():
        h = failure_histogram(st.rejected)
        parts.append(h.select(F.lit(name).alias("entity"), "rule", "failures"))
    return checks.union_all(parts)


@register(
    "dq_regex",
    r"SELECT agent_id, email, coalesce(regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$'), false) AS email_valid FROM c_agent",
)
def dq_regex(t: Tables) -> DataFrame:
    """the e-mail pattern verdict per conformed agent."""
    rule = next(r for r in RULES["agents"] if r.name == "email_valid")
    return pipeline.conformed(t, "agents").select("agent_id", "email", F.coalesce(F.expr(rule.sql()), F.lit(False)).alias("email_valid"))


# ------------------------------------------------------------------------- windows / dedupe (W)
@register("latest_per_key", f"SELECT {_cols('sales_transactions')} FROM s_sales")
def latest_per_key_q(t: Tables) -> DataFrame:
    """Newest version per transaction (NULLs last, deterministic ties)."""
    return pipeline.silver_entity(t, "sales_transactions")


PROCESSED_AT = "2024-02-01 02:10:00"


@register(
    "silver_sales",
    f"SELECT {_cols('sales_transactions')}, _ingested_at, _run_date, TIMESTAMP '{PROCESSED_AT}' AS _silver_updated_at FROM s_sales",
)
def silver_sales(t: Tables) -> DataFrame:
    """L2 (pure part): conform → rules → latest per key → processing stamp, with bookkeeping columns."""
    silver = pipeline.silver_entity(t, "sales_transactions", payload_only=False).drop("_source_file")
    return silver.withColumn("_silver_updated_at", F.lit(PROCESSED_AT).cast("timestamp"))


# ------------------------------------------------------------------------------ gold (P8, J, A2, G1)
_DIM_PROPERTY_COLS = "property_id, address_line, city, state, postal_code, property_type, bedrooms, bathrooms, square_feet, year_built, updated_at"


@register("dim_property", "SELECT * FROM dim_property")
def dim_property_q(t: Tables) -> DataFrame:
    """Natural columns of the property dimension (the 64-bit surrogate is checked in ``surrogate_keys``)."""
    return pipeline.gold_frames(t)["dim_property"].drop("property_sk")


@register("dim_agent", "SELECT * FROM dim_agent")
def dim_agent_q(t: Tables) -> DataFrame:
    return pipeline.gold_frames(t)["dim_agent"].drop("agent_sk")


@register(
    "surrogate_keys",
    " UNION ALL ".join(
        f"SELECT '{d}' AS table_name, count(*) AS row_count, count(DISTINCT {k}) AS surrogates, count(DISTINCT {k}) AS natural_keys, true AS stable FROM {d}"
        for d, k in (("dim_property", "property_id"), ("dim_agent", "agent_id"))
    ),
)
def surrogate_keys(t: Tables) -> DataFrame:
    """the surrogates of both dimensions are one to one with the natural keys, and the same again
    from the landed keys (DuckDB has no xxhash64 to compare the numbers with)."""
    g, parts = pipeline.gold_frames(t), []
    for name, sk, key, entity in (("dim_property", "property_sk", "property_id", "properties"), ("dim_agent", "agent_sk", "agent_id", "agents")):
        again = pipeline.silver_frames(t)[entity].select(F.col(key).alias("k"), F.xxhash64(key).alias("again")).distinct()
        both = g[name].join(again, F.col(key) == F.col("k"), "left")
        parts.append(
            both.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(sk).alias("surrogates"), F.count_distinct(key).alias("natural_keys"), F.bool_and(F.col(sk) == F.col("again")).alias("stable"))
            .select(F.lit(name).alias("table_name"), "*")
        )
    return checks.union_all(parts)


# XXH64 with seed 42 of some natural keys, from the hash's own library.
_KNOWN_SURROGATES = (
    ("PR1", 5119350379854320408),
    ("PR2", 7625297833211744740),
    ("PR3", -6753089641974552254),
    ("PR16", -7483623543445421059),
    ("PR100", 6530706637109041059),
    ("AG1", 5900553138051499411),
    ("AG2", -5455794776747118265),
    ("AG5", 7433559038554671899),
)


@register(
    "surrogate_key_values",
    f"SELECT * FROM (VALUES {', '.join(f"('{k}', {v}::BIGINT)" for k, v in _KNOWN_SURROGATES)}) AS v(natural_key, surrogate) "
    "WHERE natural_key IN (SELECT property_id FROM dim_property UNION ALL SELECT agent_id FROM dim_agent)",
)
def surrogate_key_values(t: Tables) -> DataFrame:
    """the 64-bit surrogates of some keys, against values known beforehand."""
    g = pipeline.gold_frames(t)
    both = g["dim_property"].select(F.col("property_id").alias("natural_key"), F.col("property_sk").alias("surrogate"))
    both = both.unionByName(g["dim_agent"].select(F.col("agent_id").alias("natural_key"), F.col("agent_sk").alias("surrogate")))
    return both.where(F.col("natural_key").isin([k for k, _ in _KNOWN_SURROGATES]))


for _name in ("fact_sales", "fact_leases", "fact_listings", "dim_date", "agg_market_monthly"):
    register(_name, f"SELECT * FROM {_name}")((lambda n: lambda t: pipeline.gold_frames(t)[n])(_name))


@register("date_bounds", "SELECT min(d) AS lo, max(d) AS hi FROM fact_dates")
def date_bounds_q(t: Tables) -> DataFrame:
    from terrace.operators.star import date_bounds

    return date_bounds(pipeline.gold_frames(t))


@register("fn_date_key", "SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key FROM events")
def fn_date_key(t: Tables) -> DataFrame:
    from terrace.functions.dates import date_key

    return t.events.select("event_id", date_key("ts").alias("date_key"))


@register(
    "fn_param_guards",
    """SELECT o_orderkey, d AS run_date_text, regexp_full_match(d, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_strptime(d, '%Y-%m-%d') IS NOT NULL AS run_date_ok,
  a AS account_text, length(a) BETWEEN 3 AND 24 AND NOT regexp_matches(a, '[^a-z0-9]') AS account_ok
FROM (SELECT o_orderkey,
    strftime(o_orderdate, '%Y-%m-') || CASE WHEN o_orderkey % 5 = 0 THEN CAST(day(o_orderdate) AS VARCHAR)
      ELSE lpad(CAST(day(o_orderdate) + o_orderkey % 4 AS VARCHAR), 2, '0') END AS d,
    CASE CAST(o_orderkey % 3 AS INTEGER) WHEN 0 THEN lower(o_orderpriority) WHEN 1 THEN 'acct' || CAST(o_orderkey AS VARCHAR)
      ELSE substr('xyzabcdefghijklmnopqrstuvwxyz0123', 1, CAST(o_custkey % 33 AS INTEGER)) END AS a
  FROM orders)""",
)
def fn_param_guards(t: Tables) -> DataFrame:
    """run-date and account-name guards over texts of every kind: days past the month's end or
    without their zero, names with blanks and signs, too short and too long ones."""
    from terrace.functions.guards import is_account_name, is_iso_date

    day = "if(o_orderkey % 5 = 0, string(day(o_orderdate)), lpad(string(day(o_orderdate) + o_orderkey % 4), 2, '0'))"
    name = "CASE o_orderkey % 3 WHEN 0 THEN lower(o_orderpriority) WHEN 1 THEN concat('acct', o_orderkey) ELSE substr('xyzabcdefghijklmnopqrstuvwxyz0123', 1, int(o_custkey % 33)) END"
    texts = t.orders.selectExpr("o_orderkey", f"concat(date_format(o_orderdate, 'yyyy-MM-'), {day}) AS run_date_text", f"{name} AS account_text")
    return texts.select("*", is_iso_date(F.col("run_date_text")).alias("run_date_ok"), is_account_name(F.col("account_text")).alias("account_ok"))


# ---------------------------------------------------------------------------- serving
@register(
    "top_markets",
    """SELECT city, state, sales, volume, CAST(((2 * ppc * 10000 + n) // (2 * n)) * 0.000001 AS DECIMAL(22,6)) AS avg_price_per_sqft
FROM (SELECT city, state, CAST(sum(sales_count) AS BIGINT) AS sales, CAST(sum(total_volume) AS DECIMAL(38,2)) AS volume,
        sum(CAST(avg_price_per_sqft * 100 AS BIGINT)) AS ppc, count(avg_price_per_sqft) AS n
      FROM agg_market_monthly GROUP BY city, state)
ORDER BY volume DESC, city, state LIMIT 10""",
)
def top_markets_q(t: Tables) -> DataFrame:
    return serve.top_markets(pipeline.gold_frames(t)["agg_market_monthly"])


@register(
    "top_agents",
    """SELECT a.full_name, a.office, count(*) AS deals, CAST(sum(f.sale_price) AS DECIMAL(38,2)) AS volume
FROM fact_sales f JOIN dim_agent a ON f.agent_id = a.agent_id GROUP BY a.full_name, a.office
ORDER BY volume DESC, full_name, office LIMIT 10""",
)
def top_agents_q(t: Tables) -> DataFrame:
    g = pipeline.gold_frames(t)
    return serve.top_agents(g["fact_sales"], g["dim_agent"])


@register(
    "star_join_sales",
    """SELECT d.year, a.office, p.property_type, count(*) AS sales, CAST(sum(f.sale_price) AS DECIMAL(38,2)) AS volume
FROM fact_sales f JOIN dim_property p ON f.property_id = p.property_id JOIN dim_agent a ON f.agent_id = a.agent_id
JOIN dim_date d ON f.sale_date_key = d.date_key GROUP BY d.year, a.office, p.property_type""",
)
def star_join_sales(t: Tables) -> DataFrame:
    g = pipeline.gold_frames(t)
    return serve.star_sales(g["fact_sales"], g["dim_property"], g["dim_agent"], g["dim_date"])


@register(
    "measures",
    """SELECT 'sales_volume' AS measure, CAST(sum(sale_price) AS DECIMAL(38,6)) AS value FROM fact_sales
UNION ALL SELECT 'median_sale_price', CAST(median(CAST(sale_price AS DOUBLE)) AS DECIMAL(38,6)) FROM fact_sales
UNION ALL SELECT 'avg_price_per_sqft', CAST((2 * sum(CAST(price_per_sqft * 100 AS BIGINT)) * 10000 + count(price_per_sqft)) // (2 * count(price_per_sqft)) * 0.000001 AS DECIMAL(38,6)) FROM fact_sales
UNION ALL SELECT 'avg_days_to_close', CAST(avg(days_to_close) AS DECIMAL(38,6)) FROM fact_sales
UNION ALL SELECT 'active_listings', CAST(count(*) FILTER (WHERE status = 'ACTIVE') AS DECIMAL(38,6)) FROM fact_listings
UNION ALL SELECT 'annualized_rent_roll', CAST(sum(annualized_rent) AS DECIMAL(38,6)) FROM fact_leases""",
)
def measures_q(t: Tables) -> DataFrame:
    g = pipeline.gold_frames(t)
    return serve.measures(g["fact_sales"], g["fact_listings"], g["fact_leases"])


RLS_OFFICE = "NATION_7"


@register(
    "rls_office_sales",
    f"SELECT * FROM fact_sales f WHERE EXISTS (SELECT 1 FROM dim_agent a WHERE a.agent_id = f.agent_id AND a.office = '{RLS_OFFICE}')",
)
def rls_office_sales(t: Tables) -> DataFrame:
    g = pipeline.gold_frames(t)
    return serve.office_rows(g["fact_sales"], g["dim_agent"], RLS_OFFICE)


# ------------------------------------------------------------------------------- checks
_ORPHANS = [
    ("fact_sales", "property_id", "dim_property", "property_id"),
    ("fact_sales", "agent_id", "dim_agent", "agent_id"),
    ("fact_leases", "property_id", "dim_property", "property_id"),
    ("fact_leases", "agent_id", "dim_agent", "agent_id"),
    ("fact_listings", "property_id", "dim_property", "property_id"),
    ("fact_listings", "agent_id", "dim_agent", "agent_id"),
]


@register(
    "orphan_fk",
    " UNION ALL ".join(
        f"SELECT '{f}' AS fact, '{k}' AS fk, count(*) AS orphans FROM {f} x WHERE NOT EXISTS (SELECT 1 FROM {d} y WHERE y.{dk} = x.{k})"
        for f, k, d, dk in _ORPHANS
    ),
)
def orphan_fk(t: Tables) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (left-anti joins)."""
    g = pipeline.gold_frames(t)
    return checks.orphan_counts([(f, g[f], k, g[d], dk) for f, k, d, dk in _ORPHANS])


@register("duplicate_keys", "SELECT transaction_id, count(*) AS copies FROM c_sales GROUP BY transaction_id HAVING count(*) > 1")
def duplicate_keys_q(t: Tables) -> DataFrame:
    """Business keys delivered more than once."""
    return checks.duplicate_keys(pipeline.conformed(t, "sales_transactions"), "transaction_id")


@register(
    "distinct_keys",
    _per_entity_sql("SELECT '{entity}' AS table_name, count(*) AS rows, count(DISTINCT {key}) AS distinct_keys FROM s_{s}"),
)
def distinct_keys(t: Tables) -> DataFrame:
    """Silver keys are unique after de-duplication (rows = distinct keys)."""
    silver = pipeline.silver_frames(t)
    return checks.key_uniqueness({n: (df, ENTITIES[n].key) for n, df in silver.items()})


@register(
    "volume_day_over_day",
    """SELECT day, rows, prev_rows, CAST(rows AS DOUBLE) / prev_rows AS ratio,
  CASE WHEN prev_rows IS NULL THEN 'first' WHEN CAST(rows AS DOUBLE) / prev_rows < 0.5 THEN 'drop'
       WHEN CAST(rows AS DOUBLE) / prev_rows > 2.0 THEN 'spike' ELSE 'ok' END AS flag
FROM (SELECT day, rows, lag(rows) OVER (ORDER BY day) AS prev_rows
      FROM (SELECT _run_date AS day, count(*) AS rows FROM b_list GROUP BY _run_date))""",
)
def volume_day_over_day(t: Tables) -> DataFrame:
    """A10: listing volume per landed day against the previous day."""
    return checks.day_over_day(analog.bronze(t, "listings"))


@register(
    "volume_sales_day_over_day",
    """SELECT day, rows, prev_rows, CAST(rows AS DOUBLE) / prev_rows AS ratio,
  CASE WHEN prev_rows IS NULL THEN 'first' WHEN CAST(rows AS DOUBLE) / prev_rows < 0.5 THEN 'drop'
       WHEN CAST(rows AS DOUBLE) / prev_rows > 2.0 THEN 'spike' ELSE 'ok' END AS flag
FROM (SELECT day, rows, lag(rows) OVER (ORDER BY day) AS prev_rows
      FROM (SELECT closing_date AS day, count(*) AS rows FROM c_sales GROUP BY closing_date))""",
)
def volume_sales_day_over_day(t: Tables) -> DataFrame:
    """A10: sales by closing day, whose volumes drop and spike."""
    return checks.day_over_day(pipeline.conformed(t, "sales_transactions"), "closing_date")


#: Closings up to a month before the sale are let through, prices below 2000 no longer are.
_NEW_SALES_RULES = tuple(
    Rule("closing_after_sale", "closing_date IS NULL OR closing_date >= date_sub(sale_date, 30)") if r.name == "closing_after_sale" else r for r in RULES["sales_transactions"]
) + (Rule("sale_price_plausible", "sale_price >= 2000"),)
_CHANGED_SALES_SQL = """SELECT *, concat_ws(',', CASE WHEN failures LIKE '%transaction_id_present%' THEN 'transaction_id_present' END,
    CASE WHEN failures LIKE '%property_id_present%' THEN 'property_id_present' END, CASE WHEN failures LIKE '%sale_price_positive%' THEN 'sale_price_positive' END,
    CASE WHEN closing_date IS NULL OR closing_date >= sale_date - 30 THEN NULL ELSE 'closing_after_sale' END,
    CASE WHEN sale_price >= 2000 THEN NULL ELSE 'sale_price_plausible' END) AS now FROM f_sales"""


@register(
    "dq_rule_change",
    f"""SELECT {_cols('sales_transactions')}, failures AS failed_before, now AS failed_after, CASE WHEN now = '' THEN 'released' ELSE 'caught' END AS change
FROM ({_CHANGED_SALES_SQL}) WHERE (failures = '') <> (now = '')""",
)
def dq_rule_change(t: Tables) -> DataFrame:
    """The sales that change sides when the rules change, seen before the day is run again."""
    moved = rule_change(_entity(pipeline.conformed(t, "sales_transactions"), "sales_transactions"), RULES["sales_transactions"], _NEW_SALES_RULES)
    return moved.withColumns({c: F.concat_ws(",", c) for c in ("failed_before", "failed_after")})


@register(
    "dq_replay",
    "SELECT " + _cols("sales_transactions") + " FROM ("
    + "SELECT * FROM (" + _CHANGED_SALES_SQL + ") WHERE now = '') QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY updated_at DESC NULLS LAST, _ingested_at DESC NULLS LAST, "
    + ", ".join(f"{c} DESC NULLS LAST" for c in ENTITIES["sales_transactions"].column_names if c not in ("transaction_id", "updated_at")) + ") = 1",
)
def dq_replay(t: Tables) -> DataFrame:
    """Silver sales of the day run again under the changed rules; released rows are among them."""
    from terrace.operators.dedupe import latest_per_key

    flagged = flag_rules(pipeline.conformed(t, "sales_transactions"), _NEW_SALES_RULES)
    return _entity(latest_per_key(valid(flagged), "transaction_id"), "sales_transactions")


_SALES_PAYLOAD = [c for c in ENTITIES["sales_transactions"].column_names if c not in ("transaction_id", "updated_at")]


@register(
    "silent_change_check",
    f"""SELECT DISTINCT b.transaction_id, b.updated_at, {', '.join('b.' + c for c in _SALES_PAYLOAD)}
FROM v_sales b JOIN s_sales s ON b.transaction_id = s.transaction_id AND b.updated_at = s.updated_at
WHERE {' OR '.join(f'b.{c} IS DISTINCT FROM s.{c}' for c in _SALES_PAYLOAD)}""",
)
def silent_change_check(t: Tables) -> DataFrame:
    """Incoming versions with the winner's timestamp but different content."""
    st = pipeline.silver_steps(t)["sales_transactions"]
    return checks.silent_changes(st.valid, st.silver, "transaction_id", _SALES_PAYLOAD).distinct()


_NEWEST_SQL = " UNION ALL ".join(
    [f"SELECT '{n}' AS entity, max(_ingested_at) AS newest_ingest FROM s_{s}" for n, s in SHORT.items()]
    + ["SELECT 'all', max(m) FROM (" + " UNION ALL ".join(f"SELECT max(_ingested_at) AS m FROM s_{s}" for s in SHORT.values()) + ")"]
)
_MINUTES_SQL = f"(epoch_us(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch_us(newest_ingest)) / 60000000.0"


@register(
    "freshness",
    f"SELECT entity, newest_ingest, {_MINUTES_SQL} AS freshness_minutes, coalesce({_MINUTES_SQL} <= 30.0, false) AS satisfied FROM ({_NEWEST_SQL})",
)
def freshness_q(t: Tables) -> DataFrame:
    """A4: minutes since the newest ingest per entity and overall, against the 30-minute limit."""
    return checks.freshness(pipeline.silver_frames(t), FRESHNESS_AS_OF)


@register("row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n, *_ in LOAD_CONFIG))
def row_counts_q(t: Tables) -> DataFrame:
    """Rows per gold table."""
    return checks.row_counts(pipeline.gold_frames(t))


# ------------------------------------------------------------------------------ sinks / merge
_DAY1 = "SELECT * FROM b_sales WHERE line_status = 'F'"
_DAY2 = "SELECT * FROM b_sales WHERE line_status <> 'F'"


def _sales_days(t: Tables) -> tuple[DataFrame, DataFrame]:
    b = analog.bronze(t, "sales_transactions")
    day1 = pipeline.silver_step(b.where(F.col("line_status") == "F"), "sales_transactions").silver
    day2 = pipeline.silver_step(b.where(F.col("line_status") != "F"), "sales_transactions").silver
    return _entity(day1, "sales_transactions"), _entity(day2, "sales_transactions")


def _merge_sql(delete_missing: bool) -> str:
    cols = ENTITIES["sales_transactions"].column_names
    take = "(s.transaction_id IS NOT NULL AND (t.transaction_id IS NULL OR s.updated_at >= t.updated_at OR t.updated_at IS NULL))"
    sel = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    where = " WHERE s.transaction_id IS NOT NULL" if delete_missing else ""
    return (
        f"SELECT {sel} FROM ({silver_from('sales_transactions', _DAY1)}) t "
        f"FULL OUTER JOIN ({silver_from('sales_transactions', _DAY2)}) s ON t.transaction_id = s.transaction_id{where}"
    )


@register("upsert_merge", _merge_sql(False))
def upsert_merge(t: Tables) -> DataFrame:
    """yesterday's silver merged with today's batch (closed lines first, then open lines)."""
    day1, day2 = _sales_days(t)
    return merge_upsert(day1, day2, "transaction_id")


@register("upsert_merge_touched", _merge_sql(False))
def upsert_merge_touched(t: Tables) -> DataFrame:
    """K7 for a small day: only target rows whose key the batch touches are shuffled and merged."""
    from terrace.operators.upsert import merge_upsert_touched

    day1, day2 = _sales_days(t)
    return merge_upsert_touched(day1, day2, "transaction_id")


@register("upsert_delete_missing", _merge_sql(True))
def upsert_delete_missing(t: Tables) -> DataFrame:
    """Merge of a full extract, deleting target keys the extract no longer has."""
    day1, day2 = _sales_days(t)
    return merge_delete_missing(day1, day2, "transaction_id")


_LOADED_UNTIL = "1999-01-01"


@register(
    "incremental_extract",
    f"""SELECT {_cols('sales_transactions')} FROM c_sales
WHERE updated_at > (SELECT max(updated_at) FROM ({silver_from('sales_transactions', "SELECT * FROM b_sales WHERE closing_date < DATE '" + _LOADED_UNTIL + "'")}))""",
)
def incremental_extract(t: Tables) -> DataFrame:
    """Rows of a full extract newer than the target's high-watermark (target = history loaded
    before 1999); the watermark is a literal when the filter is planned, so it reaches the scan."""
    from terrace.streaming.incremental import high_watermark, newer_than

    b = analog.bronze(t, "sales_transactions")
    loaded = pipeline.silver_step(b.where(F.col("closing_date") < F.lit(_LOADED_UNTIL).cast("date")), "sales_transactions").silver
    extract = conform(b, ENTITIES["sales_transactions"])
    return _entity(newer_than(extract, "updated_at", high_watermark(loaded, "updated_at")), "sales_transactions")


@register("contract_cast", "SELECT * FROM fact_sales")
def contract_cast_q(t: Tables) -> DataFrame:
    """fact_sales forced onto the positional staging contract."""
    return contract_cast(pipeline.gold_frames(t)["fact_sales"], STAGING_CONTRACTS["fact_sales"])


# --------------------------------------------------------------------------- maintenance
ERASE_OFFICE = "NATION_3"


@register(
    "erase_subject",
    f"SELECT * FROM fact_sales f WHERE NOT EXISTS (SELECT 1 FROM dim_agent a WHERE a.office = '{ERASE_OFFICE}' AND a.agent_id = f.agent_id)",
)
def erase_subject_q(t: Tables) -> DataFrame:
    """Remove every row of the subjects named in an erasure request (agents of one office)."""
    g = pipeline.gold_frames(t)
    subjects = g["dim_agent"].where(F.col("office") == ERASE_OFFICE).select("agent_id")
    return erase_subject(g["fact_sales"], subjects, "agent_id")


SALT = "terrace-salt"


@register(
    "pseudonymise",
    f"SELECT agent_id, office, sha256('{SALT}' || email) AS email, sha256('{SALT}' || full_name) AS full_name FROM dim_agent",
)
def pseudonymise_q(t: Tables) -> DataFrame:
    """Personal columns replaced by salted SHA-256 pseudonyms."""
    agents = pipeline.gold_frames(t)["dim_agent"].select("agent_id", "office", "email", "full_name")
    return pseudonymise(agents, ["email", "full_name"], SALT)


# ------------------------------------------------------------------------- metrics
# The points again in DuckDB's SQL: one SELECT per reading, not the list of the operator.
_POINTS_SQL = """
SELECT ts, 'pipeline.execution' AS metric, 'count' AS kind, 1.0::DOUBLE AS value, 'u' || user_id AS entity FROM events
UNION ALL SELECT ts, 'pipeline.success', 'count', (event_type <> 'error')::INT::DOUBLE, 'u' || user_id FROM events
UNION ALL SELECT ts, 'records_processed', 'gauge', value, 'u' || user_id FROM events WHERE event_type = 'view'
UNION ALL SELECT ts, 'quality.records_processed', 'gauge', floor(value), 'u' || user_id FROM events WHERE event_type = 'view'
UNION ALL SELECT ts, 'quality.rejection_rate', 'gauge', value / 1997, 'u' || user_id FROM events WHERE event_type = 'click'
UNION ALL SELECT ts, 'quality.records_rejected', 'gauge', floor(value / 4), 'u' || user_id FROM events WHERE event_type = 'click'
UNION ALL SELECT ts, 'pipeline.duration_seconds', 'gauge', value * 20, 'u' || user_id FROM events WHERE event_type = 'purchase'
UNION ALL SELECT ts, 'quality.duplicates', 'gauge', floor(value / 10), 'u' || user_id FROM events WHERE event_type = 'purchase'
UNION ALL SELECT ts, 'freshness.minutes', 'gauge', value, 'u' || user_id FROM events WHERE event_type = 'signup'
UNION ALL SELECT ts, 'freshness.check', 'count', 1.0, 'u' || user_id FROM events WHERE event_type = 'signup'
UNION ALL SELECT ts, 'freshness.satisfied', 'count', (value <= 30)::INT::DOUBLE, 'u' || user_id FROM events WHERE event_type = 'signup'
UNION ALL SELECT ts, 'job.failed', 'count', 1.0, 'u' || user_id FROM events WHERE event_type = 'error'"""


def _points(t: Tables) -> DataFrame:
    return observe.event_points(t.events)


@register("run_metrics", f"SELECT ts, metric, kind, value, entity FROM ({_POINTS_SQL})")
def run_metrics(t: Tables) -> DataFrame:
    """The metric points of the event stream."""
    return _points(t)


_SLO_UNTIL = "2024-01-31"


def _slo_part(name: str, good: str, all_: str, target: float, warning: float) -> str:
    return (
        f"SELECT entity, '{name}' AS slo, coalesce(sum(value) FILTER (WHERE metric = '{good}'), 0) AS numerator, "
        f"coalesce(sum(value) FILTER (WHERE metric = '{all_}'), 0) AS denominator, {target}::DOUBLE AS target_pct, {warning}::DOUBLE AS warning_pct FROM p GROUP BY entity"
    )


@register(
    "slo",
    f"""SELECT *, round(100.0::DOUBLE * numerator / nullif(denominator, 0), 9) AS attainment_pct,
  round(100.0::DOUBLE * numerator / nullif(denominator, 0), 9) >= target_pct AS met,
  CASE WHEN denominator = 0 THEN NULL WHEN round(100.0::DOUBLE * numerator / denominator, 9) < target_pct THEN 'breached'
    WHEN round(100.0::DOUBLE * numerator / denominator, 9) < warning_pct THEN 'warning' ELSE 'ok' END AS state
FROM (WITH p AS (SELECT * FROM ({_POINTS_SQL}) WHERE ts >= TIMESTAMP '{_SLO_UNTIL}' - INTERVAL 30 DAY AND ts < TIMESTAMP '{_SLO_UNTIL}')
  {_slo_part('pipeline_success', 'pipeline.success', 'pipeline.execution', 99.5, 99.9)}
  UNION ALL {_slo_part('data_freshness', 'freshness.satisfied', 'freshness.check', 99.0, 99.5)})""",
)
def slo_q(t: Tables) -> DataFrame:
    """Both objectives over 30 days for each entity, against target and warning level."""
    return observe.slo(_points(t), _SLO_UNTIL, by=("entity",))


def _monitor_sql(name: str, metric: str, agg: str, minutes: int, limit: float, test: str) -> str:
    return (
        f"SELECT '{name}' AS monitor, \"at\", round({agg}(value), 6) AS value, {limit}::DOUBLE AS \"limit\", round({agg}(value), 6) {test} {limit} AS alert "
        f"FROM (SELECT value, unnest(generate_series(date_trunc('minute', ts) + INTERVAL 1 MINUTE, date_trunc('minute', ts) + INTERVAL {minutes} MINUTE, INTERVAL 1 MINUTE)) AS \"at\" "
        f"FROM ({_POINTS_SQL}) WHERE metric = '{metric}') GROUP BY \"at\""
    )


@register(
    "monitors",
    " UNION ALL ".join(
        (
            _monitor_sql("rejection_rate", "quality.rejection_rate", "avg", 15, 0.01, ">"),
            _monitor_sql("freshness", "freshness.minutes", "max", 15, 30.0, ">"),
            _monitor_sql("job_failed", "job.failed", "sum", 15, 0.0, ">"),
            _monitor_sql("step_duration", "pipeline.duration_seconds", "avg", 30, 1200.0, ">"),
            _monitor_sql("pipeline_failed", "pipeline.success", "min", 15, 0.0, "<="),
            _monitor_sql("no_records", "quality.records_processed", "min", 15, 0.0, "<="),
        )
    ),
)
def monitors_q(t: Tables) -> DataFrame:
    """All monitors over trailing windows, evaluated every minute."""
    return observe.monitors(_points(t))


_TOP_SQL = ", ".join(f"'{m}'" for m in ("quality.rejection_rate", "quality.records_processed", "quality.records_rejected", "quality.duplicates", "records_processed"))


@register(
    "metric_top",
    f"""SELECT metric, CAST(row_number() OVER (PARTITION BY metric ORDER BY max_value DESC, entity) AS INTEGER) AS place, entity, max_value
FROM (SELECT metric, entity, max(value) AS max_value FROM ({_POINTS_SQL}) WHERE metric IN ({_TOP_SQL}) GROUP BY 1, 2) QUALIFY place <= 10""",
)
def metric_top_q(t: Tables) -> DataFrame:
    """The five top lists by entity."""
    return observe.metric_top(_points(t))


@register(
    "metric_series",
    f"""SELECT metric, date_trunc('day', ts)::TIMESTAMP AS bucket_start, count(*) AS points, round(sum(value), 6) AS total, max(value) AS largest, round(avg(value), 6) AS mean
FROM ({_POINTS_SQL}) GROUP BY 1, 2""",
)
def metric_series_q(t: Tables) -> DataFrame:
    """All series per day."""
    return observe.metric_series(_points(t))


_TAGS_SQL = """CASE WHEN (props->>'$.k')::INT % 10 = 0 THEN NULL WHEN (props->>'$.k')::INT % 2 = 0 THEN 'crm' ELSE 'listings_api' END AS source,
  ['bronze', 'silver', 'gold'][1 + user_id % 3] AS pipeline"""
_TAGGED_SQL = _POINTS_SQL.replace("AS entity", f"AS entity, {_TAGS_SQL}").replace("'u' || user_id FROM", f"'u' || user_id, {_TAGS_SQL} FROM")
_SERIES_SQL = "date_trunc('hour', ts)::TIMESTAMP AS bucket_start, count(*) AS points, round(sum(value), 6) AS total, max(value) AS largest, round(avg(value), 6) AS mean"


@register(
    "metric_series_by_tag",
    " UNION ALL ".join(
        f"SELECT metric, '{name}' AS series, {tag} AS tag, {_SERIES_SQL} FROM ({_TAGGED_SQL}) GROUP BY ALL"
        for name, tag in (("total", "NULL"), ("source", "source"), ("pipeline", "pipeline"), ("entity", "entity"))
    ),
)
def metric_series_by_tag_q(t: Tables) -> DataFrame:
    """Hourly series by source, by pipeline, by entity and in total, in one pass."""
    k = F.get_json_object("props", "$.k").cast("int")
    source = F.when(k % 10 == 0, None).when(k % 2 == 0, "crm").otherwise("listings_api")
    pipeline_ = F.array(*map(F.lit, ("bronze", "silver", "gold")))[(F.col("user_id") % 3).cast("int")]
    return observe.series_by_tag(observe.event_points(t.events, {"source": source, "pipeline": pipeline_}))


@register(
    "metric_tiles",
    f"""SELECT sum(value) FILTER (WHERE metric = 'pipeline.execution') AS total_runs, sum(value) FILTER (WHERE metric = 'pipeline.success') AS successful_runs,
  sum(value) FILTER (WHERE metric = 'job.failed') AS failed_runs, max(value) FILTER (WHERE metric = 'freshness.minutes') AS worst_freshness_minutes,
  max(ts) FILTER (WHERE metric = 'freshness.minutes') AS last_freshness_ts,
  (max((ts, value)) FILTER (WHERE metric = 'freshness.minutes'))[2] AS last_freshness_minutes
FROM ({_POINTS_SQL})""",
)
def metric_tiles_q(t: Tables) -> DataFrame:
    """Run totals and the worst and latest freshness reading."""
    return observe.metric_tiles(_points(t))


# ----------------------------------------------------------------------------- lineage / report (rows-only)
@register("bronze_metadata", "SELECT listing_id, _ingested_at, 'events.parquet' AS source_file_name, _run_date FROM b_list")
def bronze_metadata(t: Tables) -> DataFrame:
    """Bookkeeping of the landed feed, the file from the scan's own metadata column."""
    landed = analog.landed_listings(t, t.events.withColumn("file", F.col("_metadata.file_path")), "file")
    b = analog.with_bronze_metadata(landed, "listings", F.col("file"))
    return b.select("listing_id", "_ingested_at", F.regexp_extract("_source_file", r"([^/]+\.parquet)(/[^/]*)?$", 1).alias("source_file_name"), "_run_date")


_RUN_REPORT_SQL = " UNION ALL ".join(
    [f"SELECT 'bronze_rows' AS section, '{n}' AS item, CAST(count(*) AS DOUBLE) AS value FROM f_{s}" for n, s in SHORT.items()]
    + [f"SELECT 'silver_rows', '{n}', CAST(count(*) AS DOUBLE) FROM s_{s}" for n, s in SHORT.items()]
    + [f"SELECT 'rejections', '{n}.' || rule, CAST(count(*) AS DOUBLE) FROM (SELECT unnest(string_split(failures, ',')) AS rule FROM r_{s}) GROUP BY rule" for n, s in SHORT.items()]
    + [f"SELECT 'gold_rows', '{n}', CAST(count(*) AS DOUBLE) FROM {n}" for n, *_ in LOAD_CONFIG]
    + ["""SELECT 'top_markets', city || '/' || state, CAST(volume AS DOUBLE) FROM (SELECT city, state, sum(total_volume) AS volume
        FROM agg_market_monthly GROUP BY city, state ORDER BY volume DESC, city, state LIMIT 10)"""]
)


@register("run_report", _RUN_REPORT_SQL)
def run_report(t: Tables) -> DataFrame:
    """One summary frame — rows per zone, rejections per rule, top markets."""
    steps = pipeline.silver_steps(t)
    gold = pipeline.gold_frames(t)
    parts = []
    for name, st in steps.items():
        parts.append(st.flagged.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("bronze_rows").alias("section"), F.lit(name).alias("item"), "value"))
        parts.append(st.silver.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("silver_rows").alias("section"), F.lit(name).alias("item"), "value"))
        parts.append(
            failure_histogram(st.rejected).select(F.lit("rejections").alias("section"), F.concat_ws(".", F.lit(name), "rule").alias("item"), F.col("failures").cast("double").alias("value"))
        )
    parts.append(checks.row_counts(gold).select(F.lit("gold_rows").alias("section"), F.col("table_name").alias("item"), F.col("row_count").cast("double").alias("value")))
    parts.append(serve.top_markets(gold["agg_market_monthly"]).select(F.lit("top_markets").alias("section"), F.concat_ws("/", "city", "state").alias("item"), F.col("volume").cast("double").alias("value")))
    return checks.union_all(parts)


# ------------------------------------------------------------------------------- the stored lake
def _register_lake() -> None:
    from terrace.plans.lakecheck import lake_queries

    for name, (fn, sql) in lake_queries().items():
        register(name, sql)(fn)


_register_lake()
