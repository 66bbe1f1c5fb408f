"""The lake's jobs over several days, held against the query plans and against counts worked out here."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from terrace.contracts import ENTITIES
from terrace.plans import jobs, pipeline
from terrace.plans.analog import RUN_DATE, Tables, land_analog
from terrace.sources import tables
from terrace.sources.tables import SnapshotTable

SF = "/root/testdata/sf0.001"
NEXT = "2024-02-02"
INGESTED, CHECKED = f"{RUN_DATE} 02:00:00", f"{RUN_DATE} 02:25:00"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lk = jobs.Lake(str(tmp_path_factory.mktemp("zones")))
    land_analog(spark, lk, SF, RUN_DATE)
    jobs.run_day(spark, lk, RUN_DATE, "test", True, INGESTED, CHECKED)
    return lk


def rows(df, *drop):
    keep = sorted(c for c in df.columns if c not in drop)
    return sorted(map(str, df.select(*keep).collect()))


@pytest.mark.parametrize("zone", ["gold", "serve"])
def test_stored_tables_equal_the_plans(spark, lake, zone):
    # the feed of the lake is one day, the analog's many: the same rows with other run dates
    plans = pipeline.gold_frames(Tables(spark, SF), RUN_DATE)
    for name, plan in plans.items():
        assert rows(lake.snapshot(spark, zone, name).read()) == rows(plan), name


def test_silver_and_quarantine_share_out_bronze(spark, lake):
    for name, entity in ENTITIES.items():
        day = tables.read_days(spark, lake.table("bronze", name), RUN_DATE)
        bad = tables.read_days(spark, lake.table("quarantine", name), RUN_DATE)
        n_bad = bad.count() if bad is not None else 0
        keys = lake.snapshot(spark, "silver", name).read().select(entity.key)
        assert keys.distinct().count() == keys.count() <= day.count() - n_bad
        assert n_bad == 0 or bad.where("size(_dq_failures) = 0").count() == 0


def test_metrics_audit_and_exports(spark, lake):
    seen = spark.read.parquet(lake.metrics_path)
    by = {r.metric: r.n for r in seen.groupBy("metric").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert by["pipeline.execution"] == by["pipeline.success"] == by["pipeline.duration_seconds"] == 4 and "job.failed" not in by
    assert by["records_processed"] == by["quality.rejection_rate"] == len(ENTITIES)
    assert [r.value for r in seen.where("metric = 'freshness.minutes'").collect()] == [25.0]
    audit = tables.read_audit(spark, lake.audit_path).orderBy("started_at").collect()
    assert [(r.table_name, r.row_count) for r in audit] == [(r.table_name, lake.snapshot(spark, "serve", r.table_name).read().count()) for r in jobs.load_order(spark).collect()]
    for name in ("fact_sales", "dim_date"):
        assert rows(spark.read.parquet(tables.export_path(lake.zone("gold"), name, RUN_DATE))) == rows(lake.snapshot(spark, "gold", name).read())


def test_a_rerun_changes_nothing(spark, lake):
    before = {n: rows(lake.snapshot(spark, "gold", n).read()) for n in ("fact_leases", "agg_market_monthly")}
    jobs.run_day(spark, lake, RUN_DATE, "test", False, INGESTED, CHECKED)
    assert before == {n: rows(lake.snapshot(spark, "gold", n).read()) for n in before}
    table = lake.snapshot(spark, "silver", "agents")
    assert [r.operation for r in table.history().collect()] == ["MERGE", "WRITE"]


# --- a small lake of its own ------------------------------------------------------------------------

FEED = [
    {"listing_id": "L-1", "property_id": "H7", "agent_id": "W2", "list_price": 1, "status": "sold", "listed_at": "2024-01-03T08:00:00", "updated_at": "2024-01-03T08:00:00"},
    {"listing_id": "L-2", "agent_id": "W3", "list_price": "2.50", "status": " active ", "updated_at": "2024-01-03T08:00:00", "virtual_tour": {"url": "u", "rooms": [1, 2]}},
    {"listing_id": "L-3", "agent_id": "W2", "list_price": 0, "status": "ACTIVE"},
]


def land_feed(lake, day, records, *lines):
    folder = lake.landing("listings_api", "listings", day)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/feed.json", "w") as out:
        out.write("\n".join([*map(json.dumps, records), *lines]) + "\n")


def land_agents(spark, lake, day, names, at):
    made = [(n, "F", "L", f"{n}@mail.test", "O", "lic", dt.date(2000, 1, 1), at) for n in names]
    spark.createDataFrame(made, ENTITIES["agents"].schema()).write.mode("overwrite").parquet(lake.landing("crm", "agents", day))


@pytest.fixture
def small(spark, tmp_path):
    lk = jobs.Lake(str(tmp_path / "small"))
    land_feed(lk, RUN_DATE, FEED, "{cut off", "", "[1]")
    land_agents(spark, lk, RUN_DATE, ["W1", "W2", "W3"], dt.datetime(2024, 1, 1))
    jobs.run_day(spark, lk, RUN_DATE, "test", True, INGESTED, CHECKED)
    return lk


def test_new_fields_reach_bronze_and_not_silver(spark, small):
    bronze = {r.listing_id: r for r in tables.read_days(spark, small.table("bronze", "listings"), RUN_DATE).collect()}
    assert json.loads(bronze["L-2"]._extra_fields["virtual_tour"]) == {"url": "u", "rooms": [1, 2]}
    assert bronze["L-1"]._extra_fields is None and bronze["L-1"]._source_file.endswith("feed.json")
    silver = small.snapshot(spark, "silver", "listings").read()
    assert "_extra_fields" not in silver.columns and {r.listing_id: r.status for r in silver.collect()} == {"L-1": "SOLD", "L-2": "ACTIVE"}


def test_lines_that_are_no_records_go_to_quarantine_whole(spark, small):
    bad = tables.read_days(spark, small.table("quarantine", "listings"), RUN_DATE).collect()
    assert sorted(r._corrupt_record or r.listing_id for r in bad) == ["L-3", "[1]", "{cut off"]


def test_days_replace_and_add(spark, small):
    land_feed(small, NEXT, [FEED[0] | {"status": "pending", "updated_at": "2024-01-09T00:00:00"}, FEED[2] | {"list_price": 9}])
    got = jobs.run_day(spark, small, NEXT, "test")
    assert got["bronze"] == dict.fromkeys(ENTITIES, 0) | {"listings": 2}
    assert {r.listing_id: r.status for r in small.snapshot(spark, "silver", "listings").read().collect()} == {"L-1": "PENDING", "L-2": "ACTIVE", "L-3": "ACTIVE"}
    both = tables.read_days(spark, small.table("bronze", "listings"))
    assert both.groupBy("_run_date").count().count() == 2 and both.count() == 7
    assert got["silver"]["agents"]["processed"] == 0 and small.snapshot(spark, "silver", "agents").read().count() == 3


def test_erased_subjects_are_in_no_file(spark, small):
    land_agents(spark, small, NEXT, ["W2"], dt.datetime(2024, 1, 5))
    jobs.run_day(spark, small, NEXT, "test", True)
    jobs.erase(spark, small, spark.createDataFrame([("W2",)], "agent_id string"), "agent_id")
    for folder, _, names in os.walk(small.root):
        for n in names:
            if n.endswith(".parquet"):
                found = spark.read.parquet(f"{folder}/{n}")
                assert "agent_id" not in found.columns or found.where("agent_id = 'W2'").count() == 0, (folder, n)
            elif n.endswith((".json", ".txt")):
                assert '"W2"' not in open(f"{folder}/{n}").read(), (folder, n)
    assert small.snapshot(spark, "gold", "dim_agent").read().count() == 2
    jobs.run_day(spark, small, RUN_DATE, "test")  # an old day again does not bring the subject back
    assert small.snapshot(spark, "gold", "dim_agent").read().where("agent_id = 'W2'").count() == 0


def test_failed_metrics_do_not_fail_a_step_and_errors_come_through(spark, small, monkeypatch):
    blocked = os.path.dirname(small.metrics_path) + "/run_metrics"
    monkeypatch.setattr(jobs.Lake, "metrics_path", property(lambda self: f"{self.root}/_metrics/run_metrics/no\0file"))
    assert jobs.run_day(spark, small, RUN_DATE, "test")["bronze"]["agents"] == 3
    monkeypatch.undo()
    monkeypatch.setattr(jobs, "silver_job", lambda *a, **k: (_ for _ in ()).throw(KeyError("lost")))
    with pytest.raises(KeyError, match="lost"):
        jobs.run_day(spark, small, RUN_DATE, "test")
    assert spark.read.parquet(blocked).where("metric = 'job.failed' AND pipeline = 'silver'").count() == 1
    with pytest.raises(ValueError):
        jobs.run_day(spark, small, "2024-2-1")


def test_two_writers_of_one_version(spark, tmp_path):
    first, second = (SnapshotTable(spark, str(tmp_path / "t")) for _ in range(2))
    assert first.current_version() is second.current_version() is None
    first.commit(spark.range(3), "A")
    with pytest.raises(Exception, match="exists|Exist"):
        second.commit(spark.range(5), "B")
    again = SnapshotTable(spark, str(tmp_path / "t"))
    assert again.read().count() == 3 and [r.operation for r in again.history().collect()] == ["A"]
    assert second.commit(spark.range(5), "B") == 1
    assert len([n for n in os.listdir(tmp_path / "t") if n.startswith("data-")]) == 2


def test_versions_are_kept_from_when_they_were_superseded(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    for n in (1, 2, 3):
        table.commit(spark.range(n), f"W{n}")
    day = lambda d: dt.datetime(2024, 5, d).isoformat()
    for v, d in ((0, 1), (1, 2), (2, 30)):
        path = f"{table.history_path}/v{v:020d}.json"
        record = json.load(open(path)) | {"committed_at": day(d)}
        os.remove(path)
        crc = f"{table.history_path}/.v{v:020d}.json.crc"
        os.path.exists(crc) and os.remove(crc)
        json.dump(record, open(path, "w"))
    now = dt.datetime(2024, 5, 31)
    # version 1 is a month old but was current until yesterday; version 0 went four weeks ago
    assert table.vacuum(7, now) == [0]
    assert table.read(1).count() == 2 and [r.version for r in table.history().collect()] == [2, 1]
    with pytest.raises(ValueError):
        table.restore(0)
    assert table.restore(1) == 3 and table.read().count() == 2
    assert table.vacuum(0, dt.datetime(2100, 1, 1)) == [1, 2] and table.read().count() == 2  # the restored folder stays


def test_backfill_and_day_retention(spark, tmp_path):
    lk = jobs.Lake(str(tmp_path / "b"))
    for day, status in ((NEXT, "sold"), (RUN_DATE, "active")):
        land_feed(lk, day, [FEED[0] | {"status": status, "updated_at": f"{day}T00:00:00"}])
    assert list(jobs.backfill(spark, lk, [NEXT, RUN_DATE])) == [RUN_DATE, NEXT]
    assert lk.snapshot(spark, "silver", "listings").read().first().status == "SOLD"
    gone = jobs.retention_job(spark, lk, "2024-02-20", {"landing": 18, "quarantine": 18, "exports": 17})
    assert gone["landing.listings_api.listings"] == gone["quarantine.listings"] == [RUN_DATE]
    assert gone["exports.dim_date"] == [RUN_DATE, NEXT]


def test_compaction_cuts_by_range(spark, lake):
    jobs.compact(spark, lake, "gold", "fact_leases", "property_id", 3)
    spans = lake.snapshot(spark, "gold", "fact_leases").read().groupBy(F.input_file_name()).agg(F.min("property_id").alias("lo"), F.max("property_id").alias("hi")).orderBy("lo").collect()
    assert len(spans) == 3 and all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))


def test_a_named_master_is_the_only_one_set(spark, monkeypatch):
    from pyspark.sql import SparkSession

    from terrace import session

    said = {}
    monkeypatch.setenv("SPARK_MASTER", "local[3]")
    monkeypatch.setattr(SparkSession.Builder, "master", lambda self, m: said.setdefault("master", m) and self or self)
    assert session.build_session("x") is not None and said == {}


def test_watermark_extract(spark):
    from terrace.streaming.incremental import high_watermark, newer_than

    times = lambda *hours: spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in hours], "updated_at timestamp")
    mark = high_watermark(times(3, 11, 7))
    assert {r.updated_at.hour for r in newer_than(times(*range(8, 15)), "updated_at", mark).collect()} == {12, 13, 14}
    assert newer_than(times(1, 2), "updated_at", high_watermark(times(1).limit(0))).count() == 2
