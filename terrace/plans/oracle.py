"""Independent DuckDB SQL for every registered query (the correctness oracle).

The text re-states the analog mapping and the medallion semantics in plain SQL (windows with
QUALIFY, full outer joins, exact integer rounding) instead of reusing the Spark formulation, so
that an error in one side shows up as a mismatch. Run against views named like the driver tables.
"""

from __future__ import annotations

from terrace.contracts import ENTITIES
from terrace.plans.analog import INGESTED_AT, RUN_DATE

_DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP", "bigint": "BIGINT"}


def duck_type(t: str) -> str:
    return _DUCK_TYPES.get(t, t.upper())


LANDED = {
    "properties": f"""
SELECT 'PR' || CAST(p_partkey AS VARCHAR) AS property_id, p_name AS address_line, p_brand AS city,
  CASE WHEN p_partkey % 17 = 0 THEN lower(upper(substr(p_type, 1, 2))) ELSE upper(substr(p_type, 1, 2)) END AS state,
  lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
  CASE p_type WHEN 'ECONOMY' THEN 'condo' WHEN 'SMALL' THEN 'TOWNHOUSE' WHEN 'MEDIUM' THEN 'single_family'
    WHEN 'LARGE' THEN 'MULTI_FAMILY' WHEN 'STANDARD' THEN 'COMMERCIAL' ELSE p_type END AS property_type,
  CAST(p_size % 7 AS INTEGER) AS bedrooms, CAST(p_size % 4 + 0.5 AS DOUBLE) AS bathrooms,
  CAST(p_size * 100 AS INTEGER) AS square_feet, CAST(1900 + p_partkey % 130 AS INTEGER) AS year_built,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(p_partkey AS BIGINT)) AS updated_at, p_retailprice AS list_value
FROM part""",
    "agents": """
SELECT 'AG' || CAST(s_suppkey AS VARCHAR) AS agent_id, split_part(s_name, '#', 1) AS first_name,
  split_part(s_name, '#', 2) AS last_name,
  CASE WHEN s_acctbal < 0 THEN 'not-an-email' ELSE ' Agent.' || CAST(s_suppkey AS VARCHAR) || '@Terrace.Example ' END AS email,
  n_name AS office, 'LIC-' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS license_number,
  DATE '2010-01-01' + CAST(s_suppkey % 3650 AS INTEGER) AS hired_date,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(s_suppkey AS BIGINT)) AS updated_at
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "sales_transactions": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
  'PR' || CAST(l_partkey AS VARCHAR) AS property_id, 'AG' || CAST(l_suppkey AS VARCHAR) AS agent_id,
  l_extendedprice AS sale_price, CAST(o_orderdate AS DATE) AS sale_date, CAST(l_shipdate AS DATE) AS closing_date,
  CASE WHEN lower(substr(o_orderpriority, 3, 100)) = 'not specified' THEN ' ' ELSE lower(substr(o_orderpriority, 3, 100)) END AS financing_type,
  l_shipdate AS updated_at, l_linestatus AS line_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "leases": """
SELECT 'LS' || CAST(o_orderkey AS VARCHAR) AS lease_id, 'PR' || CAST(o_custkey AS VARCHAR) AS property_id,
  'AG' || CAST(o_custkey % 10 AS VARCHAR) AS agent_id, floor(o_totalprice) / 100.0 AS monthly_rent,
  CAST(o_orderdate AS DATE) AS lease_start,
  CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE)
       ELSE CAST(CAST(o_orderdate AS DATE) + to_months(CAST(o_orderkey % 24 + 1 AS INTEGER)) AS DATE) + CAST(o_orderkey % 3 AS INTEGER) END AS lease_end,
  o_orderdate AS updated_at
FROM orders""",
    "listings": """
SELECT 'LI' || CAST(event_id AS VARCHAR) AS listing_id, 'PR' || CAST(user_id AS VARCHAR) AS property_id,
  'AG' || CAST(user_id % 10 AS VARCHAR) AS agent_id, value AS list_price,
  CASE WHEN event_type IN ('view', 'click') THEN 'active' WHEN event_type = 'purchase' THEN 'sold'
       WHEN event_type = 'signup' THEN 'pending' ELSE event_type END AS status,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS listed_at, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS updated_at, props
FROM events""",
}

SHORT = {"properties": "prop", "agents": "agent", "sales_transactions": "sales", "leases": "lease", "listings": "list"}


def _bronze(name: str) -> str:
    if name == "listings":
        day = "CAST(TRY_CAST(listed_at AS TIMESTAMP) AS DATE)"
        meta = f"CAST({day} + 1 AS TIMESTAMP) + INTERVAL 2 HOUR AS _ingested_at, {day} AS _run_date"
    else:
        meta = f"TIMESTAMP '{INGESTED_AT}' AS _ingested_at, DATE '{RUN_DATE}' AS _run_date"
    return f"SELECT *, {meta} FROM l_{SHORT[name]}"


def _conform_expr(entity, name: str, dtype: str) -> str:
    e = f"TRY_CAST({name} AS {duck_type(dtype)})"
    if dtype == "string":
        e = f"trim({e})"
        e = f"lower({e})" if name == "email" else f"upper({e})" if name in ("state", "property_type", "status", "financing_type") else e
        e = f"NULLIF({e}, '')"
    return f"{e} AS {name}"


def conform_select(name: str, source: str, drop: tuple[str, ...] = ()) -> str:
    entity = ENTITIES[name]
    cols = [
        (f"CAST(NULL AS {duck_type(t)}) AS {c}" if c in drop else _conform_expr(entity, c, t)) for c, t in entity.columns
    ]
    return f"SELECT {', '.join(cols)}, _ingested_at, _run_date FROM {source}"


# The rules again, in DuckDB's SQL and not taken from the contracts: (name, what a good row fulfils).
CHECKS = {
    "properties": (
        ("property_id_present", "length(property_id) >= 1"),
        ("square_feet_positive", "square_feet >= 1"),
        ("bedrooms_in_range", "bedrooms >= 0 AND bedrooms <= 50"),
        ("state_is_iso_code", "regexp_full_match(state, '[A-Z][A-Z]')"),
        ("property_type_known", "list_contains(['LAND', 'COMMERCIAL', 'MULTI_FAMILY', 'TOWNHOUSE', 'CONDO', 'SINGLE_FAMILY'], property_type)"),
        ("year_built_plausible", f"year_built IS NULL OR (year_built >= 1700 AND year_built <= {int(RUN_DATE[:4]) + 2})"),
    ),
    "agents": (
        ("agent_id_present", "length(agent_id) >= 1"),
        ("email_valid", "regexp_full_match(email, '[^@[:space:]]+@[^@[:space:]]+[.][^@[:space:]]+')"),
        ("license_present", "NOT (license_number IS NULL)"),
    ),
    "sales_transactions": (
        ("transaction_id_present", "NOT (transaction_id IS NULL)"),
        ("property_id_present", "NOT (property_id IS NULL)"),
        ("sale_price_positive", "sign(sale_price) = 1"),
        ("closing_after_sale", "coalesce(date_diff('day', sale_date, closing_date) >= 0, closing_date IS NULL)"),
    ),
    "leases": (
        ("lease_id_present", "NOT (lease_id IS NULL)"),
        ("property_id_present", "NOT (property_id IS NULL)"),
        ("rent_positive", "sign(monthly_rent) = 1"),
        ("lease_end_after_start", "date_diff('day', lease_start, lease_end) >= 1"),
    ),
    "listings": (
        ("listing_id_present", "NOT (listing_id IS NULL)"),
        ("list_price_positive", "sign(list_price) = 1"),
        ("status_known", "list_contains(['EXPIRED', 'WITHDRAWN', 'SOLD', 'PENDING', 'ACTIVE'], status)"),
    ),
}


def failures_expr(name: str) -> str:
    parts = [f"CASE WHEN ({good}) IS TRUE THEN NULL ELSE '{rule}' END" for rule, good in CHECKS[name]]
    return f"concat_ws(',', {', '.join(parts)})"


def _silver(name: str, valid_source: str | None = None) -> str:
    entity = ENTITIES[name]
    ties = [c for c in entity.column_names if c not in (entity.key, "updated_at")] + ["_run_date"]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["updated_at", "_ingested_at", *ties])
    cols = ", ".join(entity.column_names)
    return (
        f"SELECT {cols}, _ingested_at, _run_date FROM {valid_source or 'v_' + SHORT[name]} "
        f"QUALIFY row_number() OVER (PARTITION BY {entity.key} ORDER BY {order}) = 1"
    )


def silver_from(name: str, bronze_source: str) -> str:
    """Silver rows (conform → rules → latest per key) of an arbitrary bronze subquery."""
    conf = conform_select(name, f"({bronze_source})")
    valid = f"(SELECT * FROM (SELECT *, {failures_expr(name)} AS failures FROM ({conf})) WHERE failures = '')"
    return _silver(name, valid)


def _ctes() -> list[tuple[str, str]]:
    out = []
    for name, short in SHORT.items():
        out.append((f"l_{short}", LANDED[name]))
        out.append((f"b_{short}", _bronze(name)))
        out.append((f"c_{short}", conform_select(name, f"b_{short}")))
        out.append((f"f_{short}", f"SELECT *, {failures_expr(name)} AS failures FROM c_{short}"))
        out.append((f"v_{short}", f"SELECT * EXCLUDE (failures) FROM f_{short} WHERE failures = ''"))
        out.append((f"r_{short}", f"SELECT * FROM f_{short} WHERE failures <> ''"))
        out.append((f"s_{short}", _silver(name)))
    out += [
        ("dim_property", "SELECT property_id, address_line, city, state, postal_code, property_type, bedrooms, "
         "bathrooms, square_feet, year_built, updated_at FROM s_prop"),
        ("dim_agent", "SELECT agent_id, concat_ws(' ', first_name, last_name) AS full_name, email, office, "
         "license_number, hired_date, updated_at FROM s_agent"),
        ("fact_sales", """
SELECT s.transaction_id, s.property_id, s.agent_id, CAST(strftime(s.sale_date, '%Y%m%d') AS INTEGER) AS sale_date_key,
  s.sale_date, s.closing_date, s.financing_type, s.sale_price,
  CAST(((2 * CAST(s.sale_price * 100 AS BIGINT) + p.square_feet) // (2 * p.square_feet)) * 0.01 AS DECIMAL(18,2)) AS price_per_sqft,
  CAST(date_diff('day', s.sale_date, s.closing_date) AS INTEGER) AS days_to_close
FROM s_sales s LEFT JOIN s_prop p ON s.property_id = p.property_id"""),
        ("fact_leases", """
SELECT lease_id, property_id, agent_id, CAST(strftime(lease_start, '%Y%m%d') AS INTEGER) AS lease_start_date_key,
  lease_start, lease_end, monthly_rent,
  CAST(round(CASE WHEN day(lease_end) = day(lease_start) OR (lease_end = last_day(lease_end) AND lease_start = last_day(lease_start))
    THEN (year(lease_end) - year(lease_start)) * 12 + month(lease_end) - month(lease_start)
    ELSE (year(lease_end) - year(lease_start)) * 12 + month(lease_end) - month(lease_start) + (day(lease_end) - day(lease_start)) / 31.0 END) AS INTEGER) AS lease_term_months,
  CAST(monthly_rent * 12 AS DECIMAL(18,2)) AS annualized_rent
FROM s_lease"""),
        ("fact_listings", f"""
SELECT listing_id, property_id, agent_id, CAST(strftime(listed_at, '%Y%m%d') AS INTEGER) AS listed_date_key,
  listed_at, status, list_price, CAST(date_diff('day', CAST(listed_at AS DATE), DATE '{RUN_DATE}') AS INTEGER) AS days_on_market
FROM s_list"""),
        ("fact_dates", "SELECT sale_date AS d FROM fact_sales UNION ALL SELECT lease_start FROM fact_leases "
         "UNION ALL SELECT CAST(listed_at AS DATE) FROM fact_listings"),
        ("dim_date", """
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date, CAST(year(date) AS INTEGER) AS year,
  CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month, strftime(date, '%B') AS month_name,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, dayofweek(date) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('year', lo) AS TIMESTAMP),
        CAST(date_trunc('year', hi) AS TIMESTAMP) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT min(d) AS lo, max(d) AS hi FROM fact_dates) WHERE lo IS NOT NULL)"""),
        ("agg_market_monthly", """
SELECT city, state, month, sales_count, total_volume, median_sale_price,
  CAST((((2 * ppc_sum * 10000 + ppc_n) // (2 * ppc_n)) + 5000) // 10000 * 0.01 AS DECIMAL(18,2)) AS avg_price_per_sqft,
  CAST(((20 * dtc_sum + dtc_n) // (2 * dtc_n)) * 0.1 AS DECIMAL(9,1)) AS avg_days_to_close
FROM (
  SELECT p.city, p.state, CAST(date_trunc('month', f.sale_date) AS DATE) AS month, count(*) AS sales_count,
    CAST(sum(f.sale_price) AS DECIMAL(18,2)) AS total_volume, quantile_disc(f.sale_price, 0.5) AS median_sale_price,
    sum(CAST(f.price_per_sqft * 100 AS BIGINT)) AS ppc_sum, count(f.price_per_sqft) AS ppc_n,
    sum(f.days_to_close) AS dtc_sum, count(f.days_to_close) AS dtc_n
  FROM fact_sales f JOIN dim_property p ON f.property_id = p.property_id
  GROUP BY ALL)"""),
    ]
    return out


_CTES = _ctes()


def with_base(body: str) -> str:
    """Prefix a query body with every analog/silver/gold CTE (DuckDB drops the unused ones)."""
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in _CTES) + "\n" + body

