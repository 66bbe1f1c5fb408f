"""Edge readers/writers: schema evolution across days, contract report, envelope files, JSON landing."""

import datetime as dt
import json

from pyspark.sql import functions as F

from terrace.contracts import ENTITIES
from terrace.operators.conform import conform
from terrace.operators.quality import contract_report
from terrace.sources import tables
from terrace.sources.landing import read_envelope_files, read_landing

AGENTS, LISTINGS = ENTITIES["agents"], ENTITIES["listings"]


def test_additive_schema_evolution_across_days(spark, tmp_path):
    path = str(tmp_path / "bronze" / "agents")
    d1 = spark.createDataFrame([("AG1", "a@x.io")], "agent_id string, email string")
    d2 = spark.createDataFrame([("AG2", "b@x.io", "North")], "agent_id string, email string, office string")
    tables.write_day(d1, path, "2026-09-24")
    tables.write_day(d2, path, "2026-09-25")
    both = tables.read_days(spark, path)
    assert set(both.columns) == {"agent_id", "email", "office", "_run_date"}
    got = {r.agent_id: r.office for r in conform(both, AGENTS).collect()}
    assert got == {"AG1": None, "AG2": "North"}
    one = tables.read_days(spark, path, "2026-09-24").collect()
    assert [r.agent_id for r in one] == ["AG1"]


def test_empty_day_write_clears_the_day(spark, tmp_path):
    path = str(tmp_path / "q")
    tables.write_day(spark.createDataFrame([("x",)], "k string"), path, "2026-09-25")
    tables.write_day(spark.createDataFrame([], "k string"), path, "2026-09-25")
    df = tables.read_days(spark, path)
    assert df is None or df.count() == 0


def test_contract_report(spark):
    df = spark.createDataFrame([("AG1", "x", 1)], "agent_id string, email string, surprise int")
    rep = {r.column: r.status for r in contract_report(df, AGENTS).collect()}
    assert rep["agent_id"] == "ok" and rep["office"] == "missing" and rep["surprise"] == "unexpected"


def test_landed_envelope_files(spark, tmp_path):
    folder = tmp_path / "api"
    folder.mkdir()
    for page in range(3):
        doc = {"data": [{"listing_id": f"LI{page}{i}", "status": "ACTIVE"} for i in range(4)], "paging": {"next": f"p{page + 1}"}}
        (folder / f"page{page}.json").write_text(json.dumps(doc, indent=2))
    schema = LISTINGS.schema()
    rows = read_envelope_files(spark, str(folder), schema)
    assert rows.count() == 12 and rows.columns == LISTINGS.column_names


def test_json_landing_written_by_spark(spark, tmp_path):
    path = str(tmp_path / "landing" / "listings")
    src = spark.createDataFrame([("LI1", 10.5, "ACTIVE", dt.datetime(2026, 9, 1, 10))], "listing_id string, list_price double, status string, listed_at timestamp")
    src.write.mode("overwrite").json(path)
    df = read_landing(spark, path, LISTINGS)
    row = conform(df, LISTINGS).first()
    assert row.listing_id == "LI1" and str(row.list_price) == "10.50" and row.listed_at == dt.datetime(2026, 9, 1, 10)
    assert "_source_file" in df.columns and df.where(F.col("_source_file").contains("part-")).count() == 1
    assert read_landing(spark, str(tmp_path / "nothing"), LISTINGS) is None
