"""Serving-side queries over the gold star: reports, measures, star joins, row-level security."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_markets(agg_market: DataFrame, n: int = 10) -> DataFrame:
    """Markets by sales volume: re-aggregates the monthly table (the average is of monthly averages)."""
    return (
        agg_market.groupBy("city", "state")
        .agg(
            F.sum("sales_count").alias("sales"),
            F.sum("total_volume").cast("decimal(38,2)").alias("volume"),
            F.avg("avg_price_per_sqft").alias("avg_price_per_sqft"),
        )
        .orderBy(F.desc("volume"), "city", "state")
        .limit(n)
    )


def top_agents(fact_sales: DataFrame, dim_agent: DataFrame, n: int = 10) -> DataFrame:
    """Deals and volume per agent and office, top ``n`` by volume (ties by name)."""
    return (
        fact_sales.join(dim_agent, "agent_id")
        .groupBy("full_name", "office")
        .agg(F.count(F.lit(1)).alias("deals"), F.sum("sale_price").cast("decimal(38,2)").alias("volume"))
        .orderBy(F.desc("volume"), "full_name", "office")
        .limit(n)
    )


def star_sales(fact_sales: DataFrame, dim_property: DataFrame, dim_agent: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact → property, agent and calendar dimensions, summarised per year, office and property type.

    The dimensions are joined on their keys after pruning to the columns used; AQE turns each of
    these joins into a broadcast when the dimension's measured size is under the threshold and keeps
    a shuffle join otherwise.
    """
    return (
        fact_sales.select("property_id", "agent_id", "sale_date_key", "sale_price")
        .join(dim_property.select("property_id", "property_type"), "property_id")
        .join(dim_agent.select("agent_id", "office"), "agent_id")
        .join(dim_date.select(F.col("date_key").alias("sale_date_key"), "year"), "sale_date_key")
        .groupBy("year", "office", "property_type")
        .agg(F.count(F.lit(1)).alias("sales"), F.sum("sale_price").cast("decimal(38,2)").alias("volume"))
    )


def measures(fact_sales: DataFrame, fact_listings: DataFrame, fact_leases: DataFrame) -> DataFrame:
    """The BI measures as (measure, value) rows, exact median included; a plan only, no job runs here.

    Sales are read twice: for the sums and averages, and grouped by their price for the exact median
    (``quantiles.middle_values``: no task ever holds all prices).
    """
    from terrace.operators.quantiles import middle_values

    v = "decimal(38,6)"
    sums = fact_sales.agg(
        F.sum("sale_price").cast(v).alias("sales_volume"),
        F.avg("price_per_sqft").cast(v).alias("avg_price_per_sqft"),
        F.avg("days_to_close").cast(v).alias("avg_days_to_close"),
    )
    rows = [F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in sums.columns]
    sales = sums.select(F.explode(F.array(*rows)).alias("m")).select("m.*")
    prices = fact_sales.groupBy("sale_price").agg(F.count("sale_price").alias("c"))  # NULL has none
    cents = prices.select(F.coalesce((F.col("sale_price") * 100).cast("long"), F.lit(0)).alias("u"), "c")
    both = (F.col("lower").cast("decimal(20,0)") + F.col("upper")) / F.lit(200)
    sales = sales.unionByName(middle_values(cents).select(F.lit("median_sale_price").alias("measure"), both.cast(v).alias("value")))
    listings = fact_listings.agg(F.count_if(F.col("status") == "ACTIVE").cast(v).alias("value")).select(
        F.lit("active_listings").alias("measure"), "value"
    )
    leases = fact_leases.agg(F.sum("annualized_rent").cast(v).alias("value")).select(
        F.lit("annualized_rent_roll").alias("measure"), "value"
    )
    return sales.unionByName(listings).unionByName(leases)


def office_rows(fact: DataFrame, dim_agent: DataFrame, office: str) -> DataFrame:
    """Row-level security: fact rows whose agent belongs to ``office`` (left-semi join, fact columns only)."""
    allowed = dim_agent.where(F.col("office") == office).select("agent_id")
    return fact.join(allowed, "agent_id", "left_semi")


def register_views(spark, tables: Mapping[str, DataFrame], prefix: str = "gold_") -> list[str]:
    """Named read-only views over gold tables (``gold_fact_sales`` …), for SQL users and BI."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def last_loads(audit: DataFrame, n: int = 20) -> DataFrame:
    """The most recent ``n`` serving loads (newest first), from the audit rows."""
    return audit.orderBy(F.desc("finished_at"), "table_name").limit(n)
