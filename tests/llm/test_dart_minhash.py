"""Near-duplicate classes against brute force over all pairs, and the signatures' statistics."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from terrace.llm import dart_minhash as dm

BLANK = {ord(c): " " for c in "\t\n\x0b\x0c\r"}


def shingles(text):
    w = [x for x in (text or "").translate(BLANK).split(" ") if x]
    n = min(len(w), dm.WORDS)
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def similarity(a, b):
    low = sum((a & b).values())
    return low / (sum(a.values()) + sum(b.values()) - low) if low else 0.0


def brute_classes(texts):
    sets = {k: shingles(t) for k, t in texts.items()}
    by = defaultdict(set)
    for k, s in sets.items():
        for x in s:
            by[x].add(k)
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k, s in sets.items():
        for j in set().union(*(by[x] for x in s)) if s else ():
            if j < k and root(j) != root(k) and similarity(s, sets[j]) >= dm.SIMILARITY:
                parent[max(root(j), root(k))] = min(root(j), root(k))
    return {k: root(k) for k in texts}


def agree(rows, texts):
    want = brute_classes(texts)
    size = Counter(want.values())
    got = {r.doc_id: r for r in rows}
    assert {k: r.class_id for k, r in got.items()} == want
    assert all(r.class_size == size[want[k]] and r.kept == (want[k] == k) for k, r in got.items())


def test_corpus_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    agree(dm.near_duplicates(docs).collect(), dict(docs.select("doc_id", "text").collect()))


def test_star_of_copies_and_common_passages(spark):
    """Copies near a base but not near each other, chains, and passages that many texts share."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(60)]
    texts = {0: " ".join(base)}
    for k in range(1, 60):
        w = list(base)
        for at in r.sample(range(120), 2):
            w[at] = word()
        texts[k] = " ".join(w)
    for k in range(100, 160):
        own = [word() for _ in range(150)]
        texts[k] = " ".join(own[:70] + passage + own[70:])
    for k in range(200, 230):  # each a little away from the one before
        w = texts[k - 1].split() if k > 200 else [word() for _ in range(200)]
        w[(7 * k) % len(w)] = word()
        texts[k] = " ".join(w)
    agree(dm.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect(), texts)


def test_edge_cases(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "one  two"), (6, "two one"), (2**60, "a b c d e f"), (2**60 + 1, "a b c d e f"), (None, "a b c d e f"), (7, "x " * 30_000)]
    df = spark.createDataFrame([(k, t, 0, "z") for k, t in texts] + [(4, "one two", 1, "y")], "doc_id long, text string, row int, kept string")
    got = [(r.doc_id, r.class_id, r.class_size, r.kept) for r in dm.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 1, 1, True), (2, 2, 1, True), (3, 3, 1, True), (4, 4, 3, True), (4, 4, 3, False), (5, 4, 3, False), (6, 6, 1, True), (7, 7, 1, True)]
        + [(2**60, 2**60, 3, True), (2**60 + 1, 2**60, 3, False), (None, 2**60, 3, False)],
        key=str,
    )
    kept = dm.keep_documents(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 2**60]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert dm.near_duplicates(none).count() == 0 and dm.keep_documents(none).count() == 0


def test_components(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(5, 100)] + [(300, 301)]
    got = dict(dm.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert all(got[k] == 0 for k in [*range(41), *range(100, 140)]) and got[301] == got[300] == 300


@pytest.mark.parametrize(("shared", "own", "repeat"), [(80, 20, 1), (50, 50, 1), (30, 10, 4)])
def test_agreement_estimates_weighted_similarity(shared, own, repeat):
    r = np.random.default_rng(0)
    a = np.repeat(r.integers(0, 2**62, shared), repeat), r.integers(0, 2**62, own)
    weigh = lambda h: np.unique(np.concatenate([dm.mixed(h[h == x].astype(np.uint64) + np.arange((h == x).sum(), dtype=np.uint64)) for x in np.unique(h)]))
    one, two = weigh(np.concatenate(a)), weigh(np.concatenate([a[0], r.integers(0, 2**62, own)]))
    true = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
    got = dm.signatures([one, two], k=2000)
    assert abs((got[0] == got[1]).mean() - true) < 0.05


def test_units_count_occurrences():
    words = np.array([1, 2, 3, 4, 5] * 3 + [9], dtype=np.int64)
    assert len(np.unique(dm.units(words))) == len(dm.units(words)) == len(words) - dm.WORDS + 1


def test_common_units_in_tiles(monkeypatch):
    monkeypatch.setattr(dm, "TILE", 7)
    r = np.random.default_rng(1)
    lists = [np.unique(r.integers(0, 60, n)) for n in (1, 5, 20, 30, 40, 3)]
    want = [[len(np.intersect1d(a, b)) for b in lists[1:]] for a in lists[:4]]
    assert dm.common_units(lists[:4], lists[1:]).tolist() == want
    assert dm.common_units([np.array([1])], [np.array([2])]).tolist() == [[0]]


def test_small_blocks_find_the_same_classes(spark, monkeypatch):
    monkeypatch.setattr(dm, "BLOCK", 400)
    test_star_of_copies_and_common_passages(spark)
