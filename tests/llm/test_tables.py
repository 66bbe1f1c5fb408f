"""Mixing, exact dedup, sharding and quality rules against plain Python on small tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import exact_dedup, mixing, quality_rules, sharding
from terrace.llm.common import running_offsets

BLANKS = str.maketrans("", "", " \t\n\x0b\x0c\r")
WORDS = " ".join(f"w{k}" for k in range(60))
TEXTS = [
    (1, "a b", "s"),
    (2, "a  b", "s"),
    (3, "ab", None),
    (3, "ab", None),
    (4, None, "t"),
    (5, "", "t"),
    (None, " \n", "t"),
    (2**60 + 1, "é😀 é", "s"),
    (7, WORDS, "s"),
    (8, WORDS + " " + WORDS, "u"),
    (9, "line one\nline one\n \nline two #\n" + WORDS, "u"),
    (10, "x " * 50_000, "u"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*t, "clash", 1) for t in TEXTS], "doc_id long, text string, source string, kept string, bucket int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


# --- exact dedup ------------------------------------------------------------------------------------


def test_exact_dedup(docs, none):
    groups = defaultdict(list)
    for k, (d, t, _) in enumerate(TEXTS):
        groups[(t or "").translate(BLANKS)].append((-len(t or ""), d is None, d or 0, k))
    got = exact_dedup.dedup(docs).collect()
    assert len(got) == len(TEXTS)
    want = Counter()
    for text, rows in groups.items():
        best = TEXTS[min(rows)[3]][0]
        sha = hashlib.sha256(text.encode()).hexdigest()
        want.update((TEXTS[k][0], best, len(rows), (n, null, d, k) == min(rows), sha) for n, null, d, k in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want
    assert exact_dedup.dedup(none).count() == 0


def test_minimal_perfect_hash():
    digests = [hashlib.sha256(str(k).encode()).digest() for k in range(5000)]
    keys = exact_dedup._words(digests)
    levels = exact_dedup.build_levels(keys)
    assert sorted(exact_dedup.slots(levels, keys).tolist()) == list(range(5000))
    others = exact_dedup._words([hashlib.sha256(f"x{k}".encode()).digest() for k in range(5000)])
    found = exact_dedup.slots(levels, others)
    assert ((found >= -1) & (found < 5000)).all()  # a slot that the byte check refuses, or none


def test_history_of_an_earlier_day(spark):
    day = lambda rows: exact_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"))
    history = exact_dedup.build_history(day([(1, "old"), (2, "o l d"), (3, "other")]), 3)
    got = {r.keep_id: (r.group_size, r.known) for r in exact_dedup.verdicts(day([(10, "ol  d"), (11, "new"), (12, "n ew"), (9, "longer than   other"), (13, "other  ")]), history, 3).collect()}
    assert got == {2: (3, True), 13: (2, True), 12: (2, False), 9: (1, False)}
    assert history.agg({"n": "sum"}).first()[0] == 2


# --- sharding ---------------------------------------------------------------------------------------


def test_sharding_law(docs, none, spark):
    got = sharding.shard(docs, 8).collect()
    assert len(got) == len(TEXTS)
    texts = defaultdict(list)
    for d, t, _ in TEXTS:
        texts[d].append(t or "")
    by = defaultdict(list)
    for r in got:
        data = texts[r.doc_id][0].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        by[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    # another table, other texts: the same doc_ids go to the same shards
    again = sharding.shard(spark.createDataFrame([(d, "zzz" * 99, "q") for d in texts], "doc_id long, text string, source string"), 8).collect()
    assert {r.doc_id: (r.shard, r.grown_shard) for r in again} == {r.doc_id: (r.shard, r.grown_shard) for r in got}
    nine = {r.doc_id: r.shard for r in sharding.shard(docs, 9).collect()}
    assert nine == {r.doc_id: r.grown_shard for r in got}
    assert sharding.shard(none, 8).count() == 0


def test_a_doc_id_with_many_rows_is_numbered_without_gaps(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id) AS doc_id", "'t' AS text")
    by = defaultdict(list)
    for r in sharding.shard(rows, 4).collect():
        by[r.shard].append(r.slot)
    assert sum(map(len, by.values())) == 3000 and all(sorted(x) == list(range(len(x))) for x in by.values())


def test_map_versions():
    for n in (1, 7, 8):
        m = sharding.initial(n)
        more = sharding.grown(m)
        assert all(a == b or b == n for a, b in zip(m, more, strict=True))
        sizes = Counter(more).values()
        assert max(sizes) - min(sizes) <= n + 1
    heavy = {s: 1000 if s % 8 == 0 else 10 for s in range(sharding.SLOTS)}
    m = [s % 8 for s in range(sharding.SLOTS)]
    moved = sharding.rebalanced(m, heavy)
    load = Counter()
    for s, k in enumerate(moved):
        load[k] += heavy[s]
    assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 8 + 1000


# --- mixing -----------------------------------------------------------------------------------------


def tokens(text):
    return len((text or "").split())


def test_mixing_covers_all_and_keeps_to_the_limit(docs, none):
    got = mixing.mix(docs, max_passes=3.0).collect()
    rows = Counter((d, s) for d, _, s in TEXTS)
    seen = Counter((r.doc_id, r.source) for r in got)
    assert set(seen) == set(rows) and all(rows[k] <= seen[k] <= 4 * rows[k] for k in rows)
    size = Counter()
    for d, t, s in TEXTS:
        size[s] += tokens(t)
    out = Counter()
    for r in got:
        out[r.source] += r.n_tokens
    longest = max(tokens(t) for _, t, _ in TEXTS)
    assert all(out[s] <= 3.001 * size[s] + longest for s in size) and out["u"] == size["u"]
    assert max(out[s] / size[s] for s in size if size[s]) > 2
    assert mixing.mix(none).count() == 0 and mixing.mix_documents(none).count() == 0


@pytest.mark.parametrize("share", [0.5, 0.9])
def test_bisection_meets_an_entropy(spark, share):
    rows = [(k, "w " * n, f"s{k}") for k, n in enumerate((1000, 300, 100, 20))]
    df = spark.createDataFrame([(k, s, t.count("w")) for k, t, s in rows], "id long, source string, tokens long")
    low = -sum(p * math.log(p) for p in (n / 1420 for n in (1000, 300, 100, 20)))
    target = low + share * (math.log(4) - low)
    table, _ = mixing.budgets(df, budget=100_000, target_entropy=target)
    weights = [r.weight for r in table.collect()]
    assert abs(sum(weights) - 1) < 1e-9 and 0 <= -sum(w * math.log(w) for w in weights) - target < 1e-4


def test_budgets_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(mixing, "CELL_TOKENS", 64)
    rows = [(k, "w " * (k % 7 + 1), "big" if k % 4 else "small") for k in range(800)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), budget=2500, max_passes=2.0).collect()
    per = defaultdict(Counter)
    for r in got:
        per[r.block][r.source] += r.n_tokens
    assert set(per) == set(range(5)) and abs(sum(sum(c.values()) for c in per.values()) - 2500) < 16
    shares = [c["big"] / sum(c.values()) for c in per.values()]
    assert max(shares) - min(shares) < 0.05


def test_running_offsets(spark):
    r = np.random.default_rng(4)
    cells = [(k, None if g == 2 else g, int(v)) for g in range(3) for k, v in enumerate(r.integers(0, 9, 50))]
    got = running_offsets(spark.createDataFrame(cells, "cell long, g int, n long"), ["g"], "cell", "n", "start", fan=8).collect()
    for g in (0, 1, None):
        mine = sorted((x.cell, x.n, x.start) for x in got if x.g == g)
        assert len(mine) == 50 and [s for *_, s in mine] == [0, *np.cumsum([n for _, n, _ in mine])[:-1].tolist()]


# --- quality rules ----------------------------------------------------------------------------------


def test_quality_measures(docs, none):
    got = {}
    for r in quality_rules.judge(docs).collect():
        got.setdefault(r.doc_id, r)
    for d, t, _ in TEXTS:
        w, r = (t or "").split(), got[d]
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        often = Counter(windows)
        covered = len({i + o for i, x in enumerate(windows) if often[x] > 1 for o in range(3)})
        lines = [x for x in (t or "").split("\n") if x.strip()]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), covered)
        assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 50 or 100 * covered > 50 * len(w)) and r.kept == (not r.base_failed and not r.host_refused)
    assert quality_rules.judge(none).count() == 0


def test_a_host_that_fails_throughout_is_refused(spark):
    rows = [(k, "too short", f"bad{k % 3}") for k in range(900)] + [(1000 + k, f"{WORDS} {k}", f"good{k % 9}") for k in range(2700)]
    rows += [(5000, WORDS + " alone", "bad1"), (5001, WORDS + " alone too", None)]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[5000].host_refused and not got[5000].kept and got[5001].kept
    assert all(got[1000 + k].kept for k in range(2700))


def test_windows_are_compared_on_whole_hashes(spark, monkeypatch):
    # hashes that differ in their low bits only: the lengths of the words
    monkeypatch.setattr(quality_rules, "_windows", lambda w: F.transform(F.slice(w, 1, F.size(w) - 2), lambda x: F.length(x).cast("long")))
    words = ["x" * n for n in [*range(1, 19), 1, *range(30, 40)]]
    got = spark.createDataFrame([(words,)], "w array<string>").select(quality_rules.repeat_words(F.col("w")).alias("n")).first()
    assert got.n == 6


def test_a_failing_host_takes_its_good_documents_along(spark):
    good, bad = " ".join(f"word{k}" for k in range(60)), "too few"
    rows = [(100 * h + k, f"{good} {h} {k}" if k % 20 or h == 0 else bad, f"h{h}") for h in range(1, 30) for k in range(40)]
    rows += [(k, bad if k % 10 else good + f" {k}", "h0") for k in range(40)] + [(5000, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    for d, t, h in rows:
        assert got[d].base_failed == (t == bad) and got[d].host_refused == (h == "h0"), (d, h)
        assert got[d].kept == (t != bad and h != "h0")
    assert {r.doc_id for r in quality_rules.keep_documents(docs).collect()} == {d for d, t, h in rows if t != bad and h != "h0"}
    alike = docs.where("source <> 'h0'")
    assert quality_rules.judge(alike).where("host_refused").count() == 0


def test_rebalancing_adds_a_stored_version(spark):
    # the records of a few slots are much longer than the others
    rows = [(k, "x" * (4000 if k % 97 == 0 else 20)) for k in range(4000)]
    docs = sharding.records(spark.createDataFrame(rows, "doc_id long, text string"))
    before = sharding.map_table(spark, [sharding.initial(4), sharding.initial(5)])
    after = sharding.rebalance(docs, before, 0)
    versions = {v: sharding.stored_version(after, v) for v in (0, 1, 2)}
    assert versions[0] == sharding.initial(4) and versions[1] == sharding.initial(5) and len(versions[2]) == sharding.SLOTS

    def loads(version):
        placed = sharding.place(docs, after, version)
        return [r.b for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).orderBy("shard").collect()], {r.doc_id: r.shard for r in placed.collect()}

    (old, was), (new, now) = loads(0), loads(2)
    assert sum(old) == sum(new) and max(new) - min(new) <= sharding.TOLERANCE * sum(new) / 4 < max(old) - min(old)
    moved = {s for s in range(sharding.SLOTS) if versions[0][s] != versions[2][s]}
    slots = {r.doc_id: r.vslot for r in docs.collect()}
    assert 0 < len(moved) < sharding.SLOTS / 8 and all((was[d] != now[d]) == (slots[d] in moved) for d in was)
    assert sharding.stored_version(sharding.rebalance(docs.limit(0), before, 1), 2) == sharding.initial(5)
