"""Nearest neighbours, periodic runs and the Merkle manifest against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from terrace.llm import merkle, periodic, probe_ann, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- nearest neighbours -----------------------------------------------------------------------------


def nearest(rows, every=20, top=20):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for i, v in rows:
        if i % every == 0:
            found = [(-float((np.array(v) * np.array(x)).sum()), j) for j, x in rows if j != i and len(x) == len(v)]
            out[i, v] = [(j, -s) for s, j in sorted(found)[:top]]
    return out


def test_ann_finds_most_true_neighbours(spark):
    for sf in (SF, "/root/testdata/sf0.1"):
        rows = [(r.vec_id, tuple(r.embedding)) for r in queries.table(spark, sf, "embeddings").collect()]
        x = np.array([v for _, v in rows], dtype=np.float32).astype(float)
        at = {i: k for k, (i, _) in enumerate(rows)}
        got = defaultdict(list)
        for r in queries.op11_multiprobe(spark, sf).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.rank, r.vec_id, r.score))
        assert set(got) == {i for i in at if i % 20 == 0}
        shared = 0
        for i, found in got.items():
            scores = x @ x[at[i]]
            assert [k for k, _, _ in found] == list(range(1, 21)) and len({j for _, j, _ in found}) == 20
            assert all(abs(scores[at[j]] - s) < 1e-12 for _, j, s in found) and i not in {j for _, j, _ in found}
            assert [(-s, j) for _, j, s in found] == sorted((-s, j) for _, j, s in found)
            scores[at[i]] = -9
            shared += len({j for _, j, _ in found} & {rows[k][0] for k in np.argsort(-scores, kind="stable")[:20]})
        assert shared >= 0.9 * 20 * len(got)


def test_ann_edges(spark):
    rng = random.Random(5)
    vectors = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(40)]
    rows = [(k, v) for k, v in enumerate(vectors)]
    rows += [(100 + k, [1.0, 2.0, 3.0]) for k in range(60)]  # copies, more than any result holds
    rows += [(200, None), (220, []), (240, [0.0, 0.0, 0.0]), (260, [1.0, None, 2.0]), (280, [1.0, float("nan"), 2.0]), (300, [float("inf"), 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (20, vectors[20]), (-20, [9.0, 0.0, -0.0]), (320, [1.0, 2.0]), (2**60 * 20 // 20 + 4, [2.0, 1.0]), (340, [5.0])]
    vecs = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, ids string, v int").repartition(3)
    got = defaultdict(list)
    for r in probe_ann.search(vecs).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = {i: found for (i, _), found in nearest(rows).items() if found}
    assert got.keys() == want.keys()
    for i, found in want.items():
        assert [j for j, _ in got[i]] == [j for j, _ in found]
        assert np.allclose([s for _, s in got[i]], [s for _, s in found], rtol=0, atol=1e-12)
    assert probe_ann.search(vecs.limit(0)).count() == 0


def test_ann_splits_hot_cells_and_widens(spark, monkeypatch):
    monkeypatch.setattr(probe_ann, "CELL", 64)
    monkeypatch.setattr(probe_ann, "BUCKET", 8)
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(8)
    x = np.vstack([rng.standard_normal((400, 8)), centre + 0.01 * rng.standard_normal((400, 8)), 5 * rng.standard_normal((5, 8))])
    vecs = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in probe_ann.search(vecs, every=5, top=10).collect():
        got[r.query_id].append(r.vec_id)
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    want = {q: set(np.argsort(-scores[q])[:10].tolist()) for q in range(0, len(x), 5)}
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert sum(len(want[q] & set(got[q])) for q in want) >= 0.9 * 10 * len(want)
    monkeypatch.setattr(probe_ann.Index, "_fitted", lambda self: (probe_ann.Hashing(8, 6, self.scale, 0.5), 1))
    few = defaultdict(list)
    for r in probe_ann.search(vecs, every=5, top=200).collect():
        few[r.query_id].append(r.vec_id)
    assert all(len(v) == 200 for v in few.values())


def test_probes_come_in_order_of_success():
    h = probe_ann.Hashing(4, 3, 1.0, 0.8)
    at = np.random.default_rng(2).uniform(-3, 3, (5, 3))
    keys, costs = h.probes(at, 40)
    assert (np.diff(costs, axis=1) >= 0).all()
    for row in range(5):
        every = sorted(
            (sum(h.costs(at[row : row + 1, j], s)[0] for j, s in enumerate((a, b, c))), int(h.keys((np.floor(at[row]) + (a, b, c))[None])[0]))
            for a in range(-2, 3) for b in range(-2, 3) for c in range(-2, 3)
        )
        assert np.allclose(costs[row], [c for c, _ in every[:40]])
        assert keys[row][0] == every[0][1] and len(set(keys[row].tolist())) == 40


# --- periodic runs ----------------------------------------------------------------------------------


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            k = i
            while k + q < len(words) and words[k] == words[k + q]:
                k += 1
            found.setdefault((i, k + q), q)  # the smallest period of this stretch
            i = k
    return sorted((a, b - a, q) for (a, b), q in found.items() if b - a >= max(6, 4 * q))


def plain_digest(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    best = (None,) * 4 if top is None else (*top, 1000 * top[1] // top[2])
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(rest))


def test_find_against_plain():
    rng = random.Random(3)
    for _ in range(1500):
        words = [rng.choice("ab"[: rng.choice((1, 2, 2))] + "cdefgh"[: rng.randrange(7)]) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(len(words) + 1)
            words[a:a] = [rng.choice("abcx") for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 9)
        assert periodic.find(words) == plain_runs(words), words
    fibonacci, other = ["a"], ["a", "b"]
    while len(other) < 1500:
        fibonacci, other = other, other + fibonacci
    assert periodic.find(other) == plain_runs(other)


def test_long_texts_take_time_in_proportion():
    import time

    rng = random.Random(4)
    took = []
    for n in (50_000, 400_000):
        for words in (["x"] * n, [rng.choice("ab") for _ in range(n)], [f"w{k % 9973}" for k in range(n)]):
            start = time.process_time()
            runs = periodic.find(words)
            took.append(time.process_time() - start)
            assert runs or n
    assert max(took) < 30


def test_periodic_edges(spark):
    loop = "one two three four five " * 9
    rows = [(1, "x " * 9), (1, "x " * 9), (2, None), (3, ""), (4, " \t\n"), (5, "a b " * 4 + "c"), (6, "é\x1cé ü z " * 5), (None, loop), (2**60 + 7, loop)]
    rows += [(k, loop + f" {k} " + loop * (k % 3)) for k in range(40, 140)] + [(7, "word " * 200_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, strongest int")
    edited = docs.select("doc_id", periodic.looped(docs["doc_id"], queries.whole_text()).alias("text"), "runs")
    got = Counter(tuple(r) for r in periodic.digests(periodic.detect(edited)).collect())
    small = [r for r in rows if r[0] != 7]
    assert got - Counter(plain_digest(*r) for r in small) == Counter([(7, 1, 0, 200_000, 1, 200_000_000, sha("0,200000,1\n"), sha("word"))])
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in small) > 3
    assert periodic.digests(periodic.detect(edited.limit(0))).count() == 0


def test_periodic_whole_table(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents").collect()
    short = {d.doc_id: d.text for d in docs if len(d.text or "") < 20_000}
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    assert {i: got[i] for i in short} == {i: plain_digest(i, t) for i, t in short.items()}


# --- Merkle manifest --------------------------------------------------------------------------------


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(nodes):
    """The levels over the nodes."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 2])) for k in range(0, len(out[-1]), 2)])
    return out


def plain_manifest(rows):
    leaf = lambda r, more=0: sha("".join(map(field, (*r[:3], None if r[3] is None else r[3] + more, r[4]))))
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf(r) for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for g in order}
    over = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for at, r in enumerate(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node, proof = leaf(r, 1) if hit and r[3] is not None else leaf(r), []
            for levels, i in ((trees[g], at), (over, k)):
                for level in levels[:-1]:
                    pair = level[i // 2 * 2 : i // 2 * 2 + 2]
                    pair[i % 2] = node
                    proof += [x for j, x in enumerate(level[i // 2 * 2 : i // 2 * 2 + 2]) if j != i % 2]
                    node, i = sha("".join(pair)), i // 2
            out.append((r[0], leaf(r), trees[g][-1][0], over[-1][0], sha("".join(proof)), node, node == over[-1][0]))
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = [(k, rng.choice(("s", "tü", None, "")), rng.choice(("en", "de", "é", "日本", None, "")), rng.choice((None, 0, 5, 2**62)), rng.choice(("", None, "text %d" % k, "é" * 3000))) for k in range(300)]
    out += [(None, "s", "en", 3, "null id"), (5, "s", "en", 3, "again"), (5, "s", "en", 3, "again"), (2**60 + 3, "s", "only", 3, "alone"), (-7, None, None, None, None)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos int").repartition(5)


def test_merkle_against_plain(spark, rows, monkeypatch):
    for bits in (10, 2):
        monkeypatch.setattr(merkle, "BITS", bits)
        monkeypatch.setattr(merkle, "FAN", 1 << bits)
        got = Counter(tuple(r) for r in merkle.prove(frame(spark, rows)).collect())
        assert got == plain_manifest(rows)
    for few in ([], rows[:1], rows[:3], [(k, "s", "en", 1, "t") for k in range(9)]):
        assert Counter(tuple(r) for r in merkle.prove(frame(spark, few)).collect()) == (plain_manifest(few) if few else Counter())


def test_merkle_whole_table(spark):
    docs = queries.table(spark, SF, "documents").collect()
    got = Counter(tuple(r) for r in queries.op13_merkle_manifest(spark, SF).collect())
    assert got == plain_manifest([(d.doc_id, d.source, d.lang, d.n_chars, d.text) for d in docs])
    assert 0 < sum(not r[-1] for r in got) < len(docs) / 3
