"""Landed entity extracts derived from the benchmark tables.

The driver data is a TPC-H-like star; these functions present it as the five landed extracts the
medallion model consumes, so every query does real work that grows with the tables:

* properties ← part, agents ← supplier ⋈ nation, sales_transactions ← lineitem ⋈ orders,
  leases ← orders, listings ← events (a daily JSON-like feed: timestamps arrive as text).

The oracle SQL in ``terrace.plans.oracle`` spells out the same mapping for DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.contracts import ENTITIES

# Fixed run parameters of the analog pipeline: the run date (also the as-of day for rules and
# market age) and the time the run ingested the CRM extracts.
RUN_DATE = "2024-02-01"
INGESTED_AT = "2024-02-01 02:00:00"
FRESHNESS_AS_OF = "2024-02-01 02:20:00"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: Records of the listings feed in one landed file.
FEED_ROWS = 200_000


@dataclass
class Tables:
    """Lazy reader of the driver parquet tables under one scale-factor folder."""

    spark: SparkSession
    root: str
    _cache: dict[str, DataFrame] = field(default_factory=dict)
    # lazily built plans over these tables (silver/gold mappings), shared by the queries of a session
    memo: dict = field(default_factory=dict)

    def remember(self, key, build):
        if key not in self.memo:
            self.memo[key] = build()
        return self.memo[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name == "memo" or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]


def _id(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


# 2024-01-01 00:00:00 UTC as epoch seconds: CRM rows were last updated that many seconds later.
_EPOCH_2024 = 1704067200


def _ts_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(F.lit(_EPOCH_2024) + seconds)


def landed_properties(t: Tables) -> DataFrame:
    p = t.part
    type_code = F.upper(F.substring("p_type", 1, 2))
    return p.select(
        _id("PR", p.p_partkey).alias("property_id"),
        p.p_name.alias("address_line"),
        p.p_brand.alias("city"),
        # every 17th property arrives with a lower-case state, as some CRM rows do
        F.when(p.p_partkey % 17 == 0, F.lower(type_code)).otherwise(type_code).alias("state"),
        F.lpad((p.p_partkey % 100000).cast("string"), 5, "0").alias("postal_code"),
        F.when(p.p_type == "ECONOMY", "condo")
        .when(p.p_type == "SMALL", "TOWNHOUSE")
        .when(p.p_type == "MEDIUM", "single_family")
        .when(p.p_type == "LARGE", "MULTI_FAMILY")
        .when(p.p_type == "STANDARD", "COMMERCIAL")
        .otherwise(p.p_type)
        .alias("property_type"),
        (p.p_size % 7).cast("int").alias("bedrooms"),
        ((p.p_size % 4) + F.lit(0.5)).cast("double").alias("bathrooms"),
        (p.p_size * 100).cast("int").alias("square_feet"),
        (F.lit(1900) + p.p_partkey % 130).cast("int").alias("year_built"),
        _ts_seconds(p.p_partkey).alias("updated_at"),
        p.p_retailprice.alias("list_value"),
    )


def landed_agents(t: Tables) -> DataFrame:
    s, n = t.supplier, t.nation
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        _id("AG", s.s_suppkey).alias("agent_id"),
        F.split_part(s.s_name, F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(s.s_name, F.lit("#"), F.lit(2)).alias("last_name"),
        F.when(s.s_acctbal < 0, F.lit("not-an-email"))
        .otherwise(F.concat(F.lit(" Agent."), s.s_suppkey.cast("string"), F.lit("@Terrace.Example ")))
        .alias("email"),
        n.n_name.alias("office"),
        F.concat(F.lit("LIC-"), F.lpad(s.s_suppkey.cast("string"), 6, "0")).alias("license_number"),
        F.date_add(F.lit("2010-01-01").cast("date"), (s.s_suppkey % 3650).cast("int")).alias("hired_date"),
        _ts_seconds(s.s_suppkey).alias("updated_at"),
    )


def landed_sales(t: Tables) -> DataFrame:
    li, o = t.lineitem, t.orders
    prio = F.lower(F.substring(o.o_orderpriority, 3, 100))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat(li.l_orderkey.cast("string"), F.lit("-"), li.l_linenumber.cast("string")).alias("transaction_id"),
        _id("PR", li.l_partkey).alias("property_id"),
        _id("AG", li.l_suppkey).alias("agent_id"),
        li.l_extendedprice.alias("sale_price"),
        F.to_date(o.o_orderdate).alias("sale_date"),
        F.to_date(li.l_shipdate).alias("closing_date"),
        # "not specified" arrives blank and becomes NULL on conformance
        F.when(prio == "not specified", F.lit(" ")).otherwise(prio).alias("financing_type"),
        li.l_shipdate.alias("updated_at"),
        li.l_linestatus.alias("line_status"),
    )


def landed_leases(t: Tables) -> DataFrame:
    o = t.orders
    start = F.to_date(o.o_orderdate)
    end = F.date_add(F.add_months(start, (o.o_orderkey % 24 + 1).cast("int")), (o.o_orderkey % 3).cast("int"))
    return o.select(
        _id("LS", o.o_orderkey).alias("lease_id"),
        _id("PR", o.o_custkey).alias("property_id"),
        _id("AG", o.o_custkey % 10).alias("agent_id"),
        (F.floor(o.o_totalprice) / F.lit(100.0)).alias("monthly_rent"),
        start.alias("lease_start"),
        # pending orders arrive with an end equal to the start (a data-entry defect)
        F.when(o.o_orderstatus == "P", start).otherwise(end).alias("lease_end"),
        o.o_orderdate.alias("updated_at"),
    )


_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def landed_listings(t: Tables, events: DataFrame | None = None, *also: str) -> DataFrame:
    e = t.events if events is None else events
    text_ts = F.date_format(e.ts, _ISO)
    return e.select(
        _id("LI", e.event_id).alias("listing_id"),
        _id("PR", e.user_id).alias("property_id"),
        _id("AG", e.user_id % 10).alias("agent_id"),
        e.value.alias("list_price"),
        F.when(e.event_type.isin("view", "click"), F.lit("active"))
        .when(e.event_type == "purchase", F.lit("sold"))
        .when(e.event_type == "signup", F.lit("pending"))
        .otherwise(e.event_type)
        .alias("status"),
        text_ts.alias("listed_at"),
        text_ts.alias("updated_at"),
        e.props.alias("props"),
        *also,
    )


LANDED = {
    "properties": landed_properties,
    "agents": landed_agents,
    "sales_transactions": landed_sales,
    "leases": landed_leases,
    "listings": landed_listings,
}


SOURCE_TABLE = {
    "properties": "part",
    "agents": "supplier",
    "sales_transactions": "lineitem",
    "leases": "orders",
    "listings": "events",
}


def with_bronze_metadata(df: DataFrame, entity: str, source_file: str | Column | None = None) -> DataFrame:
    """Bronze bookkeeping for the analog extracts.

    CRM extracts are one daily snapshot ingested at ``INGESTED_AT``; the listings feed lands per
    day, so its run date is the day of the record and it was ingested at 02:00 the next day.
    """
    if entity == "listings":
        day = F.to_date(F.col("listed_at").try_cast("timestamp"))
        ingested = F.to_timestamp(F.date_add(day, 1)) + F.expr("INTERVAL 2 HOURS")
        run_date = day
    else:
        ingested = F.lit(INGESTED_AT).cast("timestamp")
        run_date = F.lit(RUN_DATE).cast("date")
    return df.withColumns({"_ingested_at": ingested, "_source_file": (source_file if isinstance(source_file, Column) else F.lit(source_file)).cast("string"), "_run_date": run_date})


def bronze(t: Tables, entity: str) -> DataFrame:
    return t.remember(("bronze", entity), lambda: _bronze(t, entity))


def _bronze(t: Tables, entity: str) -> DataFrame:
    return with_bronze_metadata(LANDED[entity](t), entity, f"{t.root}/{SOURCE_TABLE[entity]}.parquet")


def land_analog(spark: SparkSession, lake, sf_dir: str, run_date: str, only: dict[str, str] | None = None) -> None:
    """Land the analog extracts for one day: Parquet for the relational entities, JSON Lines for the
    listings feed. ``only``: the entities that the day brings, with a condition on their rows."""
    t = Tables(spark, sf_dir.rstrip("/"))
    for name, entity in ENTITIES.items():
        if only is None or name in only:
            rows = LANDED[name](t).where((only or {}).get(name, "true"))
            out = rows.write.mode("overwrite").format(entity.file_format)
            if entity.file_format == "json":  # text is packed in files of a bounded size, as such files can't be divided
                out = out.option("compression", "gzip").option("maxRecordsPerFile", FEED_ROWS)
            out.save(lake.landing(entity.source, name, run_date))
