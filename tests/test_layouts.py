"""Bucketed layouts, the month-wise merge, erasure and sweeping, version changes, and plans of filters and
series."""

import datetime as dt
import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from terrace.contracts import ENTITIES, RULES
from terrace.operators import observe
from terrace.operators.checks import fingerprint
from terrace.operators.conform import conform
from terrace.operators.quality import flag_rules, rejected, valid
from terrace.plans import jobs
from terrace.plans.analog import RUN_DATE
from terrace.sources import tables
from terrace.sources.bucketed import lay_out, reopen
from terrace.sources.tables import SnapshotTable
from terrace.streaming.incremental import MONTH, MonthStore, changed_facts
from tests.test_lake import FEED, land_agents, land_feed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- bucketed layout --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    # property P0 has a third of all sales and most leases; some keys are NULL or in one table only
    sales = [(f"t{k}", f"P{0 if k % 3 == 0 else k % 97}" if k % 50 else None, k) for k in range(3000)]
    leases = [(f"l{k}", f"P{0 if k % 2 else k % 120}", k) for k in range(1000)]
    homes = [(f"P{k}", f"city{k % 7}") for k in range(110)]
    frames = {
        "sales": spark.createDataFrame(sales, "id string, property_id string, price long"),
        "leases": spark.createDataFrame(leases, "lease string, property_id string, rent long"),
        "homes": spark.createDataFrame(homes, "property_id string, city string"),
    }
    return frames, lay_out(spark, str(tmp_path_factory.mktemp("layout")), frames, "property_id", 4, ("homes",))


def test_hot_keys_are_kept_apart(layout):
    frames, laid = layout
    assert [r[0] for r in laid.hot_keys().collect()] == ["P0"]
    for name, df in frames.items():
        assert sorted(map(str, laid.whole(name).collect())) == sorted(map(str, df.collect())), name
        assert laid.cold(name).where("property_id = 'P0'").isEmpty()


def test_joins_and_groups_by_the_key_have_no_exchange(spark, layout):
    frames, laid = layout
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cold = laid.cold("sales").groupBy("property_id").agg(F.sum("price").alias("s")).join(laid.cold("leases").groupBy("property_id").agg(F.sum("rent").alias("r")), "property_id")
        cold = cold.join(laid.cold("homes"), "property_id", "left")
        assert "Exchange" not in plan(cold), plan(cold)
        located = laid.with_dimension("sales", "homes")
        # the only exchange is the broadcast of the hot keys' homes
        assert re.findall(r"\w*Exchange", plan(located)) == ["BroadcastExchange"], plan(located)
        want = frames["sales"].join(frames["homes"], "property_id", "left")
        assert fingerprint(located.select(*sorted(want.columns))).collect() == fingerprint(want.select(*sorted(want.columns))).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_per_key_work_and_reopened_tables(spark, layout):
    frames, laid = layout

    def work(read):
        return read("sales").groupBy("property_id").agg(F.count(F.lit(1)).alias("n")).join(read("leases").groupBy("property_id").agg(F.max("rent").alias("r")), "property_id", "left")

    want = sorted(map(str, work(frames.get).collect()))
    assert sorted(map(str, laid.per_key(work).collect())) == want
    ddl = {n: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) for n, df in frames.items()}
    for n in frames:
        spark.sql(f"DROP TABLE {laid.prefix}_{n}")  # as another session, which does not know them
    again = reopen(spark, laid, ddl)
    assert sorted(map(str, again.per_key(work).collect())) == want


# --- the month-wise merge ---------------------------------------------------------------------------

FACT = "id string, d date, v long"


def day(text):
    return dt.date.fromisoformat(text)


def files(store):
    return {m: sorted(n for n in tables.list_children(store.spark, f"{store.path}/{m}") if n.startswith("part-")) for m in tables.list_children(store.spark, store.path) if m.startswith(f"{MONTH}=")}


def stored(store):
    return sorted(map(tuple, store.read().select("id", "d", "v").collect()), key=str)


@pytest.fixture
def store(spark, tmp_path):
    rows = [("a", day("2024-01-05"), 1), ("b", day("2024-01-07"), 2), ("c", day("2024-02-01"), 3), ("e", day("2024-03-01"), 5), ("n", None, 6)]
    made = MonthStore(spark, str(tmp_path / "fact"), "id", "d")
    made.load(spark.createDataFrame(rows, FACT))
    return made


CHANGED = [("c", day("2024-01-31"), 30), ("f", day("2024-05-05"), 7), ("a", day("2024-01-05"), 10)]
MERGED = [("a", day("2024-01-05"), 10), ("b", day("2024-01-07"), 2), ("c", day("2024-01-31"), 30), ("e", day("2024-03-01"), 5), ("f", day("2024-05-05"), 7), ("n", None, 6)]


def test_only_touched_months_are_written(spark, store):
    before = files(store)
    assert store.merge(spark.createDataFrame(CHANGED, FACT)) == ["m2024-01", "m2024-02", "m2024-05"]
    after = files(store)
    assert stored(store) == sorted(MERGED, key=str)
    assert f"{MONTH}=m2024-02" not in after  # its only row moved away
    for same in (f"{MONTH}=m2024-03", f"{MONTH}=none"):
        assert after[same] == before[same]
    assert not set(after[f"{MONTH}=m2024-01"]) & set(before[f"{MONTH}=m2024-01"])
    assert store.merge(spark.createDataFrame([], FACT)) == [] and files(store) == after
    assert [n for n in os.listdir(store.path) if n.startswith("_staged")] == []


@pytest.mark.parametrize("steps", range(5))
def test_a_cut_off_merge_is_finished_by_the_next_use(spark, store, monkeypatch, steps):
    class Killed(BaseException):
        pass

    left, real = [steps], (tables.move_path, tables.remove_path)

    def counted(of):
        def step(*args):
            if left[0] == 0:
                raise Killed
            left[0] -= 1
            return of(*args)

        return step

    monkeypatch.setattr(tables, "move_path", counted(real[0]))
    monkeypatch.setattr(tables, "remove_path", counted(real[1]))
    with pytest.raises(Killed):
        store.merge(spark.createDataFrame(CHANGED, FACT))
    monkeypatch.undo()
    again = MonthStore(spark, store.path, "id", "d")
    assert stored(again) == sorted(MERGED, key=str) and not tables.path_exists(spark, f"{store.path}/_merge.json")


def test_a_merge_without_its_record_changes_nothing(spark, store, monkeypatch):
    before = stored(store)

    def lost(*args):
        raise OSError("lost")

    monkeypatch.setattr(tables, "write_record", lost)
    with pytest.raises(OSError, match="lost"):
        store.merge(spark.createDataFrame(CHANGED, FACT))
    monkeypatch.undo()
    assert stored(MonthStore(spark, store.path, "id", "d")) == before


def test_changed_facts_follow_key_and_dimension(spark):
    fact = spark.createDataFrame([("a", "P1"), ("b", "P2"), ("c", "P3"), ("d", None)], "id string, home string")
    own, via = spark.createDataFrame([("a",), ("x",), ("d",)], "id string"), spark.createDataFrame([("P3",), ("P3",)], "home string")
    assert sorted(r.id for r in changed_facts(fact, "id", own, "home", via).collect()) == ["a", "c", "d"]


# --- erasure ----------------------------------------------------------------------------------------


@pytest.fixture
def lake(spark, tmp_path):
    lk = jobs.Lake(str(tmp_path / "lake"))
    broken = '{"listing_id": "L-9", "agent_id": "W2", "list_price"'  # cut off, and it names the subject
    land_feed(lk, RUN_DATE, FEED, broken, '{"agent_id": "W22"', "plain W2 words")
    land_agents(spark, lk, RUN_DATE, ["W1", "W2", "W3"], dt.datetime(2024, 1, 1))
    land_agents(spark, lk, "2024-02-02", ["W1"], dt.datetime(2024, 1, 2))
    for d in (RUN_DATE, "2024-02-02"):
        jobs.run_day(spark, lk, d, "test", True)
    return lk


def named(spark, lake):
    """Files that name the subject, in a column or in raw text."""
    found = []
    for folder, _, names in os.walk(lake.root):
        for n in names:
            path = f"{folder}/{n}"
            if n.endswith(".parquet"):
                rows = spark.read.parquet(path).select(F.to_json(F.struct("*")).alias("j"))
                held = not rows.where(F.col("j").rlike(r"\bW2\b")).isEmpty()
            else:
                held = n.endswith((".json", ".txt")) and re.search(r"\bW2\b", open(path).read()) is not None
            if held:
                found.append(path)
    return found


SUBJECT = [("W2",)]


def test_erasure_rewrites_only_files_that_hold_the_subject(spark, lake):
    untouched = f"{lake.landing('crm', 'agents', '2024-02-02')}"
    before, dead = sorted(os.listdir(untouched)), f"{lake.table('silver', 'agents')}/data-7-dead"
    lake.snapshot(spark, "silver", "agents").read(0).write.parquet(dead)
    assert named(spark, lake)
    done = jobs.erase(spark, lake, spark.createDataFrame(SUBJECT, "agent_id string"), "agent_id", grace_hours=-1)
    assert named(spark, lake) == []
    assert sorted(os.listdir(untouched)) == before and "landing.agents.2024-02-02" not in done
    assert done[f"landing.agents.{RUN_DATE}"] >= 1 and done[f"quarantine.listings.{RUN_DATE}"] >= 1
    lines = spark.read.text(lake.landing("listings_api", "listings", RUN_DATE)).collect()
    assert any("W22" in r.value for r in lines)  # another agent's broken line stays
    assert lake.snapshot(spark, "gold", "dim_agent").read().count() == 2
    assert jobs.erase(spark, lake, spark.createDataFrame(SUBJECT, "agent_id string").limit(0), "agent_id").keys() <= {f"{z}.{n}" for z in ("silver", "gold", "serve") for n in os.listdir(lake.zone(z))}


@pytest.mark.parametrize("steps", [0, 2])
def test_a_cut_off_erasure_loses_nothing_and_is_finished(spark, lake, monkeypatch, steps):
    class Killed(BaseException):
        pass

    rows = lambda: tables.read_days(spark, lake.table("bronze", "agents")).where("agent_id <> 'W2'").count()
    kept, left, real = rows(), [steps], (tables.move_path, tables.remove_path)

    def counted(of):
        def step(*args):
            if left[0] == 0:
                raise Killed
            left[0] -= 1
            return of(*args)

        return step

    monkeypatch.setattr(tables, "move_path", counted(real[0]))
    monkeypatch.setattr(tables, "remove_path", counted(real[1]))
    with pytest.raises(Killed):
        jobs.erase(spark, lake, spark.createDataFrame(SUBJECT, "agent_id string"), "agent_id")
    monkeypatch.undo()
    jobs.finish_erasures(spark, lake)
    assert rows() == kept and tables.read_days(spark, lake.table("bronze", "agents")).where("agent_id = 'W2'").count() == 0
    assert tables.list_children(spark, lake.erasures) == [] or not any(n.endswith(".json") for n in tables.list_children(spark, lake.erasures))


def test_a_running_writers_folder_stays(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.commit(spark.range(3), "A")
    for name, age in (("data-1-dead", 50 * 3600), ("data-1-running", 3600)):
        spark.range(2).write.parquet(f"{table.path}/{name}")
        for folder, _, names in os.walk(f"{table.path}/{name}"):
            for n in [*names, "."]:
                os.utime(f"{folder}/{n}", (time.time() - age,) * 2)
    table.vacuum(7)
    left = {n for n in os.listdir(table.path) if n.startswith("data-")}
    assert "data-1-running" in left and "data-1-dead" not in left and table.read().count() == 3
    lake = jobs.Lake(str(tmp_path / "l"))
    for name, age in (("old", 50 * 3600), ("new", 0)):
        os.makedirs(f"{lake.root}/_staged/{name}")
        os.utime(f"{lake.root}/_staged/{name}", (time.time() - age,) * 2)
    assert jobs.sweep_staging(spark, lake) == ["old"]


# --- versions ---------------------------------------------------------------------------------------


def test_changes_between_versions_and_as_of(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    ddl = "k string, v int, w string"
    table.commit(spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("c", None, "y"), ("d", 4, "z")], ddl), "A")
    between = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    time.sleep(0.05)
    table.commit(spark.createDataFrame([("a", 1, None), ("b", 3, "x"), ("c", 3, "y"), ("e", 5, None)], ddl), "B")
    assert {tuple(r) for r in table.changes("k", 0, 1).collect()} == {("b", "changed"), ("c", "changed"), ("d", "deleted"), ("e", "inserted")}
    assert {tuple(r) for r in table.changes("k", 0, 1, ["w"]).collect()} == {("d", "deleted"), ("e", "inserted")}
    assert table.as_of(between).count() == 4 and table.as_of(between).where("k = 'd'").count() == 1
    with pytest.raises(FileNotFoundError):
        table.as_of(dt.datetime(2000, 1, 1))


def test_fingerprints_ignore_order_and_see_repeats(spark):
    a = spark.range(1000).selectExpr("id", "cast(id % 7 as string) AS s")
    assert fingerprint(a).collect() == fingerprint(a.orderBy(F.desc("id")).repartition(5).select("s", "id")).collect()
    assert fingerprint(a).collect() != fingerprint(a.unionByName(a.limit(2))).collect()
    assert fingerprint(a.limit(0)).first().rows == 0


# --- plans ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", list(ENTITIES))
def test_the_rule_filter_is_a_conjunction(spark, tmp_path, name):
    entity = ENTITIES[name]
    spark.createDataFrame([], entity.schema()).write.parquet(str(tmp_path / "rows"))
    flagged = flag_rules(conform(spark.read.parquet(str(tmp_path / "rows")), entity), RULES[name], "2024-01-01")
    text = valid(flagged)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in text and " AND " in text and "lambda" not in text and "array" not in text, text
    assert "array" in rejected(flagged)._jdf.queryExecution().optimizedPlan().toString()
    assert valid(flag_rules(spark.range(3), [])).count() == 3


def test_all_series_take_one_scan_and_one_exchange(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    points = observe.event_points(events, {"source": F.lit(None).cast("string"), "pipeline": F.col("event_type")})
    series = observe.series_by_tag(points)
    text = plan(series)
    assert len(re.findall(r"\bFileScan\b", text)) == 1 and len(re.findall(r"\bExchange hashpartitioning", text)) == 1, text
    total = series.where("series = 'total'").agg(F.sum("points")).first()[0]
    by_source = series.where("series = 'source'")
    assert by_source.where("tag IS NOT NULL").isEmpty() and by_source.agg(F.sum("points")).first()[0] == total == points.count()


def test_records_are_read_without_a_job(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.commit(spark.range(3), "A")
    name = json.load(open(f"{table.history_path}/v{0:020d}.json"))["folder"]
    seen = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert table.folder(0) == f"{table.path}/{name}"
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == seen


def jobs_seen(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


@pytest.mark.parametrize("prices", [[], [None], [3], [5, 1], [7, 7, 7, None, 1], list(range(-50, 51)), [2**40, -(2**40), 0, 1], [k * k % 1009 for k in range(2000)]])
def test_middle_values_are_exact_and_lazy(spark, prices):
    import statistics

    from terrace.operators.quantiles import middle_values

    values = spark.createDataFrame([(p,) for p in prices], "u long").where("u IS NOT NULL").groupBy("u").agg(F.count(F.lit(1)).alias("c"))
    before = jobs_seen(spark)
    plan_only = middle_values(values)
    assert jobs_seen(spark) == before
    known = sorted(p for p in prices if p is not None)
    want = (statistics.median_low(known), statistics.median_high(known)) if known else (None, None)
    assert tuple(plan_only.first()) == want


def test_measures_run_nothing_while_planned(spark):
    from terrace.plans import catalog

    for name in ("fact_sales", "fact_listings", "fact_leases"):
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001")  # the tables' schemas are read once a session
    before = jobs_seen(spark)
    measures = catalog.QUERIES["measures"](spark, "/root/testdata/sf0.001")
    assert jobs_seen(spark) == before and measures.count() == 6


# --- work that stays spread out as tables grow ------------------------------------------------------


def test_a_layout_counts_its_keys_in_many_tasks(spark, tmp_path, monkeypatch):
    frames = {"sales": spark.createDataFrame([(f"t{k}", f"P{k % 97}") for k in range(3000)], "id string, property_id string")}
    seen = []
    for name in ("coalesce", "repartition"):
        real = getattr(type(frames["sales"]), name)
        monkeypatch.setattr(type(frames["sales"]), name, lambda self, n, *by, name=name, real=real: seen.append((name, n)) or real(self, n, *by))
    monkeypatch.setattr("terrace.sources.bucketed.BUCKET_ROWS", 300, raising=False)
    laid = lay_out(spark, str(tmp_path / "wide"), frames, "property_id", 4)
    assert ("coalesce", 1) not in seen and laid.buckets == 10  # no bucket has more than 300 rows on average
    assert sorted(map(str, laid.whole("sales").collect())) == sorted(map(str, frames["sales"].collect()))
    ends = {r[0] for r in laid.cold("sales").select(F.col("_metadata.file_name")).distinct().collect()}
    assert len(ends) == 10


def test_an_erasure_moves_no_table(spark, lake, monkeypatch):
    seen = []
    real = jobs._flagged
    monkeypatch.setattr(jobs, "_flagged", lambda *a: (lambda out: seen.append(out) or out)(real(*a)))
    erased, anti = jobs.erase_subject, []
    monkeypatch.setattr(jobs, "erase_subject", lambda *a: (lambda out: anti.append(plan(out)) or out)(erased(*a)))
    planned = []
    stage = jobs._stage_rewrite

    def staged(*args):
        held = stage(*args)
        planned.extend(plan(x) for x in seen if x is not None)
        seen.clear()
        return held

    monkeypatch.setattr(jobs, "_stage_rewrite", staged)
    # a request whose size no plan knows
    jobs.erase(spark, lake, spark.createDataFrame(spark.sparkContext.parallelize([("W2",)]), "agent_id string"), "agent_id", grace_hours=-1)
    assert named(spark, lake) == []
    assert planned and anti and not [p for p in anti if "SortMergeJoin" in p]
    assert not [p for p in planned if "_word" not in p and "SortMergeJoin" in p]


def test_rewritten_files_keep_their_codec(spark, lake):
    folder = lake.landing("listings_api", "listings", RUN_DATE)
    lines = spark.read.text(folder)
    lines.write.mode("overwrite").option("compression", "gzip").text(f"{folder}-packed")
    ids = spark.createDataFrame(SUBJECT, "agent_id string")
    assert jobs._stage_rewrite(spark, f"{folder}-packed", "text", ids, "agent_id", f"{folder}-kept")
    assert {n[-3:] for n in os.listdir(f"{folder}-kept") if n.startswith("part-")} == {".gz"}
    left = [r.value for r in spark.read.text(f"{folder}-kept").collect()]
    assert left and not [x for x in left if re.search(r"\bW2\b", x)] and any("W22" in x for x in left)


def test_a_merge_takes_the_rows_of_a_day_as_they_are(spark):
    from pyspark.sql import Observation

    from terrace.operators.dedupe import latest_per_key
    from terrace.operators.upsert import merge_upsert

    ddl = "k string, a string, updated_at int, _ingested_at int, b string"
    target = spark.createDataFrame([("x", "t", 5, 1, "t"), ("y", "t", 9, 1, "t"), ("z", "t", None, 1, "t"), ("o", "t", 1, 1, None)], ddl)
    source = [("x", "z", 5, 1, "s"), ("x", "a", 5, 2, "s"), ("y", "s", 8, 9, "s"), ("y", "s", 7, 1, "s"), ("z", "b", None, 1, None), ("z", "b", None, 1, "q"), ("n", None, 3, None, "s"), ("n", "a", 3, None, "s")]
    source = spark.createDataFrame(source, ddl)
    seen = Observation("seen")
    got = merge_upsert(target, source, "k", seen=seen)
    assert len(re.findall(r"Exchange hashpartitioning", plan(got))) == 1
    rows = sorted(map(str, got.collect()))
    assert rows == sorted(map(str, merge_upsert(target, latest_per_key(source, "k"), "k").collect()))
    assert seen.get["n"] == 4


def test_a_days_merge_stages_no_rows(spark, lake, monkeypatch):
    monkeypatch.setattr(jobs.Lake, "scratch", lambda *a: pytest.fail("a copy of the day was staged"))
    counts = jobs.silver_entity(spark, lake, "agents", "2024-02-02")
    assert counts == {"processed": 1, "rejected": 0, "duplicates": 0, "rejection_rate": 0.0}
    assert lake.snapshot(spark, "silver", "agents").read().count() == 3
