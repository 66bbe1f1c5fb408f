"""Rules, conformance, newest versions and serving casts on frames whose answers are worked out here."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from terrace.contracts import ENTITIES, RULES, TEXT_CASE, Rule
from terrace.operators.conform import conform, contract_cast
from terrace.operators.dedupe import latest_per_key
from terrace.operators.quality import failure_histogram, flag_rules, quality_counts, rejected, valid

RULE_PAIR = (Rule("even, or so", "n % 2 = 0"), Rule("", "n < 10"))

# Rows that break exactly the named rule, as changes to a good row of each entity.
GOOD = {
    "properties": {"property_id": "p", "state": "TX", "property_type": "LAND", "bedrooms": 0, "square_feet": 1, "year_built": None},
    "agents": {"agent_id": "a", "email": "x@y.z", "license_number": "l"},
    "sales_transactions": {"transaction_id": "t", "property_id": "p", "sale_price": Decimal("0.01"), "sale_date": dt.date(2020, 5, 1), "closing_date": dt.date(2020, 5, 1)},
    "leases": {"lease_id": "l", "property_id": "p", "monthly_rent": Decimal("0.01"), "lease_start": dt.date(2020, 5, 1), "lease_end": dt.date(2020, 5, 2)},
    "listings": {"listing_id": "i", "list_price": Decimal("0.01"), "status": "SOLD"},
}
BROKEN = {
    "property_id_present": [{"property_id": None}],
    "square_feet_positive": [{"square_feet": 0}, {"square_feet": None}],
    "bedrooms_in_range": [{"bedrooms": 51}, {"bedrooms": -1}, {"bedrooms": None}],
    "state_is_iso_code": [{"state": "T1"}, {"state": "TEX"}, {"state": None}],
    "property_type_known": [{"property_type": "land"}, {"property_type": None}],
    "year_built_plausible": [{"year_built": 1699}, {"year_built": 2027}],
    "agent_id_present": [{"agent_id": ""}],
    "email_valid": [{"email": "x@y"}, {"email": "x y@z.w"}, {"email": "x@@y.z"}, {"email": None}],
    "license_present": [{"license_number": None}],
    "transaction_id_present": [{"transaction_id": None}],
    "sale_price_positive": [{"sale_price": Decimal("0.00")}, {"sale_price": None}],
    "closing_after_sale": [{"closing_date": dt.date(2020, 4, 30)}, {"sale_date": None}],
    "lease_id_present": [{"lease_id": None}],
    "rent_positive": [{"monthly_rent": Decimal("-1.00")}],
    "lease_end_after_start": [{"lease_end": dt.date(2020, 5, 1)}, {"lease_end": None}],
    "listing_id_present": [{"listing_id": None}],
    "list_price_positive": [{"list_price": None}],
    "status_known": [{"status": "GONE"}, {"status": None}],
}


@pytest.mark.parametrize("name", list(ENTITIES))
def test_each_rule_fails_alone_and_only_where_it_should(spark, name):
    entity = ENTITIES[name]
    cases = [({}, [])] + [(c, [r.name]) for r in RULES[name] for c in BROKEN[r.name] if set(c) <= set(entity.column_names)]
    rows = [tuple((GOOD[name] | change).get(c) for c in entity.column_names) + (str(k),) for k, (change, _) in enumerate(cases)]
    frame = spark.createDataFrame(rows, entity.schema().add("case", "string"))
    got = {int(r.case): r._dq_failures for r in flag_rules(frame, RULES[name], "2024-06-30").collect()}
    assert got == {k: want for k, (_, want) in enumerate(cases)}
    assert {r.name for r in RULES[name]} == {w for _, want in cases for w in want}


def test_names_may_hold_any_text_and_order_is_that_of_the_rules(spark):
    got = {r.n: list(r._dq_failures) for r in flag_rules(spark.createDataFrame([(4,), (7,), (12,), (13,), (None,)], "n int"), RULE_PAIR).collect()}
    assert got == {4: [], 7: ["even, or so"], 12: [""], 13: ["even, or so", ""], None: ["even, or so", ""]}


def test_every_row_is_valid_or_rejected_but_not_both(spark):
    flagged = flag_rules(spark.range(40).withColumn("n", F.col("id").cast("int")), RULE_PAIR)
    good, bad = {r.id for r in valid(flagged).collect()}, {r.id for r in rejected(flagged).collect()}
    assert good == {0, 2, 4, 6, 8} and bad == set(range(40)) - good
    assert valid(flagged).columns == ["id", "n"] and rejected(flagged).columns == ["id", "n", "_dq_failures"]
    assert valid(flag_rules(spark.range(3), [])).count() == 3


def test_the_year_limit_moves_with_the_run(spark):
    rule = [r for r in RULES["properties"] if r.name == "year_built_plausible"]
    years = spark.createDataFrame([(y,) for y in (1700, 2021, 2022, 2023)], "year_built int")
    kept = lambda day: {r.year_built for r in valid(flag_rules(years, rule, day)).collect()}
    assert kept("2019-12-31") == {1700, 2021} and kept("2021-01-01") == {1700, 2021, 2022, 2023}


def test_counters_and_histogram(spark):
    rows = [("k1", 2), ("k1", 4), ("k2", 3), ("k3", 20), ("k3", 21), (None, 6), (None, 8)]
    flagged = flag_rules(spark.createDataFrame(rows, "k string, n int"), RULE_PAIR)
    c = quality_counts(flagged, "k").first()
    assert (c.processed, c.rejected, c.duplicates, round(c.rejection_rate, 6)) == (7, 3, 2, round(3 / 7, 6))
    assert {r.rule: r.failures for r in failure_histogram(rejected(flagged)).collect()} == {"even, or so": 2, "": 2}


@pytest.mark.parametrize("name", list(ENTITIES))
def test_conformance_of_text_extracts(spark, name):
    entity = ENTITIES[name]
    sample = {"string": "  Mixed Case ", "int": " 7 ", "double": "1.5", "date": "2021-02-03", "timestamp": "2021-02-03 04:05:06"}
    text = {c: sample.get(t, "12.345") for c, t in entity.columns}
    frame = spark.createDataFrame([tuple(text.values()) + ("x", "f"), ("nonsense",) * len(text) + ("y", "g"), ("  ",) * len(text) + ("z", "h")], [*text, "unknown", "_source_file"])
    out = conform(frame, entity)
    assert out.columns == [*entity.column_names, "_source_file"]
    assert [f.dataType for f in out.schema.fields][:-1] == [f.dataType for f in entity.schema().fields]
    first, second, third = out.orderBy("_source_file").collect()
    for c, t in entity.columns:
        if t == "string":
            assert first[c] == {"upper": "MIXED CASE", "lower": "mixed case"}.get(TEXT_CASE.get(c), "Mixed Case") and third[c] is None
        else:
            assert first[c] is not None and second[c] is None and third[c] is None
    none = conform(frame.select("unknown"), entity)
    assert none.columns == entity.column_names and all(v is None for r in none.collect() for v in r)


def test_newest_version_with_ties_and_nulls(spark):
    day = lambda d: None if d is None else dt.datetime(2022, 3, d)
    rows = [("a", day(1), day(9), "x"), ("a", day(2), day(1), "y"), ("b", None, day(5), "p"), ("b", day(1), day(1), "q"), ("c", day(4), day(2), "m"), ("c", day(4), day(3), "l"), ("d", day(4), day(3), "l"), ("d", day(4), day(3), "m")]
    frame = spark.createDataFrame(rows, "k string, updated_at timestamp, _ingested_at timestamp, v string")
    for n in (1, 4):
        assert {r.k: r.v for r in latest_per_key(frame.repartition(n), "k").collect()} == {"a": "y", "b": "q", "c": "l", "d": "m"}


def test_newest_version_of_a_hot_key(spark):
    rows = spark.range(30_000).selectExpr("if(id < 20000, -1, id) AS k", "timestamp_seconds(id) AS updated_at", "id AS v")
    out = latest_per_key(rows, "k")
    assert out.count() == 10_001 and out.where("k = -1").first().v == 19_999


def test_serving_cast(spark):
    frame = spark.createDataFrame([("7", 1.25)], "n string, price double")
    out = contract_cast(frame, "price decimal(5,1), n int")
    assert [tuple(r) for r in out.collect()] == [(Decimal("1.3"), 7)]
    for wrong in ("n int", "n int, price double, more int"):
        with pytest.raises(ValueError, match="more|price"):
            contract_cast(frame, wrong)
