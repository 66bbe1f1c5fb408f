"""Lakes that a query changes are on disk once, and go when their figures are taken."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from terrace.plans import lakecheck
from terrace.plans.analog import Tables
from terrace.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir, shuffles_dropped
from terrace.sources import tables

DAY = dt.datetime(1997, 3, 1)
ROWS = {
    "nation": ("n_nationkey int, n_name string", [(k, f"NATION_{k}") for k in range(5)]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(k, f"Supplier#{k}", k % 5, 1.0) for k in range(10)]),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(k, "n", "B", "SMALL", 5, 1.0) for k in range(20)]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        [(k, k % 20, "O", 900.0, DAY + dt.timedelta(days=40 * k), "3-MEDIUM") for k in range(30)],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_shipdate timestamp, l_linestatus string",
        [(k, k % 20, k % 10, n, 5.0, DAY + dt.timedelta(days=40 * k + 9), "OF"[n % 2]) for k in range(30) for n in (1, 2)],
    ),
    "events": ("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string", [(k, dt.datetime(2024, 1, 3), k % 20, "view", 2.0, "{}") for k in range(40)]),
}


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name, (ddl, rows) in ROWS.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def lakes(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(folder) if n.startswith("lake")}


def files(root):
    return {(f"{folder}/{n}", os.path.getsize(f"{folder}/{n}")) for folder, _, names in os.walk(root) for n in names}


@pytest.fixture
def no_copy(monkeypatch):
    def copied(*args):
        raise AssertionError("the lake is copied")

    monkeypatch.setattr(tables, "copy_path", copied)


def test_an_erased_lake_is_on_disk_once_and_goes(spark, data, no_copy):
    before, t = lakes(spark), Tables(spark, data)
    got = {(r.zone, r.table_name): (r.rows_before, r.rows_after) for r in lakecheck.erased(t).collect()}
    # agents 3 and 8: a fifth of all; 30 of the 60 sales came on the first day too
    assert got["bronze", "sales_transactions"] == (90, 72) and got["gold", "fact_sales"] == got["serve", "fact_sales"] == got["export", "fact_sales"] == (60, 48)
    assert got["bronze", "agents"] == (20, 16) and got["silver", "agents"] == (10, 8) and got["bronze", "listings"] == (40, 32)
    left = lakecheck.swept(t).collect()
    assert len(left) == 12 and all((r.versions, r.folders) == (1, 1) for r in left)
    assert lakes(spark) == before


def test_a_rerun_lake_is_on_disk_once_and_goes(spark, data, no_copy):
    before = lakes(spark)
    got = lakecheck.rerun(Tables(spark, data)).collect()
    assert len(got) == 19 and all(r.same for r in got) and {(r.zone, r.table_name): r.rows for r in got}["serve", "fact_sales"] == 60
    assert lakes(spark) == before


def test_the_stored_lake_stays_as_it_is(spark, data):
    t = Tables(spark, data)
    stored = lakecheck.stored_lake(t)
    held, folders = files(stored.root), lakes(spark)
    got = {(r.zone, r.table_name): (r.rows_before, r.rows_after) for r in lakecheck.erased(t).collect()}
    assert got["silver", "sales_transactions"] == (60, 48) and all(r.same for r in lakecheck.rerun(t).collect())
    assert files(stored.root) == held and lakes(spark) == folders


@pytest.mark.parametrize("before", [None, "false", "true"])
def test_a_finished_statement_leaves_no_shuffle_files(spark, tmp_path, before):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv
    held = lambda: {f for f in env.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    spark.conf.set(SHUFFLE_CLEANUP, before) if before else spark.conf.unset(SHUFFLE_CLEANUP)
    try:
        start = held()
        with shuffles_dropped(spark):
            for k in range(3):
                spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).count().write.parquet(f"{tmp_path}/{k}")
        assert not held() - start
        assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)
