"""Property tests against brute force on small generated inputs: de-duplication, merge, guards."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.functions.dates import date_key
from terrace.functions.guards import is_account_name, is_iso_date
from terrace.operators.dedupe import latest_per_key
from terrace.operators.upsert import merge_upsert

TS = st.one_of(st.none(), st.sampled_from([dt.datetime(2026, 1, d) for d in (1, 2, 3)]))
ROW = st.tuples(st.sampled_from(["a", "b", "c", "d"]), TS, TS, st.one_of(st.none(), st.integers(0, 3)))
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
DDL = "k string, updated_at timestamp, _ingested_at timestamp, v int"


def _brute_latest(rows):
    """Newest updated_at (NULL last), then newest ingest (NULL last), then largest v (NULL last)."""
    def key(r):
        return tuple((x is not None, x or 0) for x in (r[1], r[2], r[3]))

    best = {}
    for r in rows:
        if r[0] not in best or key(r) > key(best[r[0]]):
            best[r[0]] = r
    return best


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=25))
def test_latest_per_key_matches_brute_force(spark, rows):
    got = {r.k: (r.updated_at, r._ingested_at, r.v) for r in latest_per_key(spark.createDataFrame(rows, DDL), "k").collect()}
    assert got == {k: r[1:] for k, r in _brute_latest(rows).items()}


@SETTINGS
@given(st.lists(ROW, max_size=15), st.lists(ROW, max_size=15))
def test_merge_matches_merge_rule(spark, t_rows, s_rows):
    t = {r[0]: r for r in t_rows}  # unique keys per side, as silver guarantees
    s = {r[0]: r for r in s_rows}
    expect = dict(t)
    for k, r in s.items():
        cur = expect.get(k)
        if cur is None or cur[1] is None or (r[1] is not None and r[1] >= cur[1]):
            expect[k] = r
    target = spark.createDataFrame(list(t.values()), DDL)
    source = spark.createDataFrame(list(s.values()), DDL)
    got = {r.k: tuple(r) for r in merge_upsert(target, source, "k").collect()}
    assert got == expect


def test_guards_and_date_key(spark):
    df = spark.createDataFrame(
        [("2024-02-29", "abc1"), ("2024-02-30", "ab"), ("2024-2-01", "UPPER"), (None, None), ("2023-12-31", "a" * 24)],
        "d string, acct string",
    )
    got = [(r.ok, r.acct_ok) for r in df.select(is_iso_date(F.col("d")).alias("ok"), is_account_name(F.col("acct")).alias("acct_ok")).collect()]
    assert got == [(True, True), (False, False), (False, False), (False, False), (True, True)]
    keys = spark.createDataFrame([(dt.date(2024, 1, 31),), (None,)], "d date").select(date_key("d").alias("k")).collect()
    assert [r.k for r in keys] == [20240131, None]
