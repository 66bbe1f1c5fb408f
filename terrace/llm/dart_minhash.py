"""Near-duplicate documents by DartMinHash.

A document is the weighted set of its five-word shingles, the weight being how often one occurs; the
similarity is the weighted Jaccard similarity, and documents at SIMILARITY or more are linked.

Signatures: every unit of weight of a shingle is a region of its own in which darts arrive at hashed
times, each dart on a hashed coordinate of the signature. A document keeps the earliest dart of each
coordinate. Only as many darts are thrown as fill all coordinates (times up to about k log k over the
document's weight), so the work is the document's length plus k log k rather than their product. Two
documents agree at a coordinate with the probability of their similarity. BANDS bands of ROWS
coordinates give the buckets; a pair at the threshold shares one with probability 0.99997.

Classes: documents of equal weighted sets are collapsed first. In every bucket the document that
meets the most others in its buckets is the hub and is compared exactly with each member. What is then
in one class needs no further pair. Buckets that still hold several classes go on: the members outside
the bucket's largest class are compared exactly with all its members, block by block (a block is
bounded by its weight), and only true links leave a block. So every pair of a bucket is either in one
class or compared, nothing is capped, a group of copies costs one comparison a copy, and no pairs are
emitted that are no links.

Scale: every step is a join or an aggregation on buckets, documents or classes, whose inputs are pairs
of numbers; hot buckets and classes are aggregated before they are shuffled, or joined where Spark can
split them. Exact comparison fetches the shingles of documents that have a candidate only. Classes are
labelled by repeated minimum and pointer jumping over written tables. Nothing is collected.

Edge cases: a null or empty text has no shingles and is a class of its own; a text of one to four words
is one shingle; equal rows are copies; the smallest doc_id (null last, then the row read first) names
the class and stays; an empty table gives an empty result; other columns are carried or ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import fresh, if_small, placed, settle, whole_text
from terrace.llm.quality_rules import words_of

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
#: Weight units and documents whose darts are thrown together.
UNITS, DOCS = 200_000, 1_000
#: Weight units of a block of a bucket's members, and shingles compared at a time within it.
BLOCK, TILE = 500_000, 4_096


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64 hashed bits of each number."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def units(words: np.ndarray) -> np.ndarray:
    """The weight units of a document, sorted within a shingle: one number for each (shingle, nth
    occurrence). ``words``: hashes of its words."""
    w = words.astype(np.uint64)
    n = len(w)
    if not n:
        return w
    span = min(n, WORDS)
    h = mixed(w[: n - span + 1], span)
    for k in range(1, span):
        h = mixed(h ^ w[k : n - span + 1 + k], k)
    h.sort()
    at = np.arange(len(h))
    new = np.concatenate([[True], h[1:] != h[:-1]])
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.where(nth > 0, mixed(h ^ mixed(nth.astype(np.uint64), 7), 8), h)


def signatures(docs: list[np.ndarray], k: int = BANDS * ROWS) -> np.ndarray:
    """Signatures (documents x k) of non-empty lists of units."""
    out = np.zeros((len(docs), k), dtype=np.uint64)
    open_, reach = np.arange(len(docs)), k * (math.log(k) + 6)
    while len(open_):
        sizes = np.array([len(docs[d]) for d in open_])
        cell = np.concatenate([docs[d] for d in open_])
        owner = np.repeat(np.arange(len(open_)), sizes)
        until = (reach / sizes)[owner]
        time, nth = np.zeros(len(cell)), 0
        slots, times, darts = [], [], []
        while len(cell):
            dart = mixed(cell, 16 + nth)
            time = time - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            hit = time < until
            cell, owner, until, time, dart = cell[hit], owner[hit], until[hit], time[hit], dart[hit]
            name = mixed(dart, 3)
            slots.append(owner * k + (name % np.uint64(k)).astype(np.int64))
            times.append(time)
            darts.append(name)
            nth += 1
        slot, time, dart = np.concatenate(slots), np.concatenate(times), np.concatenate(darts)
        order = np.lexsort((time, slot))
        slot, dart = slot[order], dart[order]
        first = np.concatenate([[True], slot[1:] != slot[:-1]])
        got = np.zeros(len(open_) * k, dtype=np.uint64)
        filled = np.zeros(len(open_) * k, dtype=bool)
        got[slot[first]], filled[slot[first]] = dart[first], True
        full = filled.reshape(-1, k).all(axis=1)
        out[open_[full]] = got.reshape(-1, k)[full]
        open_, reach = open_[~full], reach * 2  # a document that missed a coordinate throws for longer
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """Bucket keys (documents x BANDS), which also tell the band."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(mixed(np.arange(BANDS, dtype=np.uint64), 5), (len(signature), BANDS)).copy()
    for r in range(ROWS):
        key = mixed(key ^ parts[:, :, r], 6)
    return key


def _word_hashes(text: str):
    return F.transform(words_of(F.col(text)), lambda x: F.xxhash64(x))


SIGNED = "row long, file long, at long, doc_id string, weight long, c1 long, c2 long, bands array<long>"


def _signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sets, start, n = [], 0, 0
        for k, words in enumerate(frame["words"]):
            sets.append(units(np.asarray(words, dtype=np.int64)))
            n += len(sets[-1])
            if k + 1 < len(frame) and len(sets) < DOCS and n < UNITS:
                continue
            keys = iter(band_keys(signatures([x for x in sets if len(x)])).astype(np.int64).tolist() if n else [])
            with np.errstate(over="ignore"):
                sums = [[int(mixed(x, salt).sum(dtype=np.uint64).astype(np.int64)) for x in sets] for salt in (11, 12)]
            part = frame.iloc[start : k + 1]
            yield pd.DataFrame({"row": part["row"], "file": part["file"], "at": part["at"], "doc_id": part["doc_id"], "weight": [len(x) for x in sets], "c1": sums[0], "c2": sums[1], "bands": [next(keys) if len(x) else [] for x in sets]})
            sets, start, n = [], k + 1, 0


def _unit_lists(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"node": frame["row"], "units": [units(np.asarray(w, dtype=np.int64)).astype(np.int64) for w in frame["words"]]})


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b): the smallest node that it is connected with."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both = settle(both.where("node <> other").distinct(), "links")
    labels = settle(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "other", "label": "l"}), "other").groupBy("node").agg(F.min("l").alias("l"))
        lower = labels.join(near, "node").select("node", F.least("label", "l").alias("low"), F.col("label").alias("was"))
        lower = settle(lower, "labels")
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("lowest"))
        # a label is itself a node, whose own label is at most as large
        new = settle(lower.join(jump, "low").select("node", F.least("low", "lowest").alias("label"), (F.col("was") != F.least("low", "lowest")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels


def _linked(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """The pairs (a, b) at SIMILARITY or more, exactly, from the unit lists of the documents."""
    left = pairs.join(lists.withColumnsRenamed({"node": "a", "units": "ua"}), "a")
    whole = left.join(lists.withColumnsRenamed({"node": "b", "units": "ub"}), "b")
    common = F.size(F.array_intersect("ua", "ub"))
    return settle(whole.where(common >= (F.size("ua") + F.size("ub") - common) * SIMILARITY - 1e-9).select("a", "b"), "links")


def _near_weight(x: str, y: str):
    return F.least(x, y) >= F.greatest(x, y) * SIMILARITY - 1e-9


def _hub_pairs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """Distinct pairs of members and the hub of their bucket whose weights allow the similarity."""
    h = hubs.withColumnsRenamed({"node": "hub", "weight": "hub_weight"})
    joined = members.join(h, "key").where((F.col("node") != F.col("hub")) & _near_weight("weight", "hub_weight"))
    return joined.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def common_units(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common units of every left with every right list: products of 0/1 matrices over the
    units that occur on both sides, TILE of them at a time."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    flat = [np.concatenate(x) for x in (left, right)]
    owner = [np.repeat(np.arange(len(x)), [len(u) for u in x]) for x in (left, right)]
    shared = np.intersect1d(flat[0], flat[1])
    at = [np.searchsorted(shared, f) for f in flat]
    found = [(a < len(shared)) & (shared[np.minimum(a, len(shared) - 1)] == f) if len(shared) else np.zeros(len(f), bool) for a, f in zip(at, flat, strict=True)]
    # a unit of a single right document adds to one pair only: those pairs are counted one by one
    alone = np.bincount(at[1][found[1]], minlength=len(shared)) == 1
    holder = np.zeros(len(shared), dtype=np.int64)
    holder[at[1][found[1]]] = owner[1][found[1]]
    some = found[0].copy()
    some[found[0]] = alone[at[0][found[0]]]
    np.add.at(out, (owner[0][some], holder[at[0][some]]), 1)
    many = np.flatnonzero(~alone)
    for k in range(0, len(many), TILE):
        place = np.full(len(shared), -1)
        place[many[k : k + TILE]] = np.arange(len(many[k : k + TILE]))
        tiles = []
        for side, n in ((0, len(left)), (1, len(right))):
            tile = np.zeros((n, len(many[k : k + TILE])), dtype=np.float32)
            column = place[at[side][found[side]]]
            tile[owner[side][found[side]][column >= 0], column[column >= 0]] = 1
            tiles.append(tile)
        out += tiles[0] @ tiles[1].T
    return out


def _block_links(minor: pd.DataFrame, all_: pd.DataFrame) -> pd.DataFrame:
    """Links between members of the same bucket, of the two sides of a block."""
    found: list[tuple[int, int]] = []
    sides = [{k: g for k, g in side.groupby("key")} for side in (minor, all_)]
    for key, one in sides[0].items():
        two = sides[1].get(key)
        if two is None:
            continue
        lists = [[np.asarray(u, dtype=np.int64) for u in g["units"]] for g in (one, two)]
        common = common_units(*lists)
        size = [np.array([len(u) for u in x], dtype=np.float32) for x in lists]
        near = common >= (size[0][:, None] + size[1][None, :] - common) * SIMILARITY - 1e-3
        for i, j in zip(*np.nonzero(near), strict=True):
            a, b = int(one["node"].iloc[i]), int(two["node"].iloc[j])
            n = int(common[i, j])
            if a != b and n >= (len(lists[0][i]) + len(lists[1][j]) - n) * SIMILARITY - 1e-9:
                found.append((min(a, b), max(a, b)))
    return pd.DataFrame(sorted(set(found)), columns=["a", "b"], dtype="int64")


def _remaining_links(members: DataFrame, lists: DataFrame) -> DataFrame:
    """Links of the buckets that hold several classes: of every member outside the bucket's largest class
    with all members. ``members`` has (key, node, weight, label)."""
    per = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).groupBy("key")
    per = per.agg(F.max_by(F.struct("label", "w"), F.struct("n", "label")).alias("main"), F.sum("w").alias("all"))
    per = settle(per.where(F.col("all") > F.col("main.w")), "open-buckets")
    n_groups = max(1, (per.agg(F.sum("all")).first()[0] or 0) // BLOCK)
    blocks = lambda w: F.ceil(w / F.lit(float(BLOCK))).cast("long")
    per = per.select(F.col("key"), F.col("main.label").alias("main"), blocks(F.col("all") - F.col("main.w")).alias("rows_"), blocks(F.col("all")).alias("cols_"))
    whole = (F.col("rows_") == 1) & (F.col("cols_") == 1)
    group = F.when(whole, F.pmod(F.xxhash64("key"), F.lit(n_groups))).otherwise(F.col("key"))
    held = members.join(per, "key").withColumn("g", F.struct(whole.alias("small"), group.alias("id")))
    held = settle(held.join(lists.withColumnRenamed("node", "n"), F.col("node") == F.col("n")).drop("n"), "open-members")
    block = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    of = ["g", "r", "c", "key", "node", "units"]
    minor = held.where(F.col("label") != F.col("main")).withColumn("r", block("rows_", 1)).withColumn("c", every("cols_")).select(*of)
    all_ = held.withColumn("c", block("cols_", 2)).withColumn("r", every("rows_")).select(*of)
    by = ["g", "r", "c"]
    return settle(minor.groupBy(*by).cogroup(all_.groupBy(*by)).applyInPandas(_block_links, "a long, b long").distinct(), "links")


def _labelled(entries: DataFrame, links: DataFrame) -> DataFrame:
    of = components(links).withColumnRenamed("node", "n")
    return entries.join(of, F.col("node") == F.col("n"), "left").withColumn("label", F.coalesce("label", "node")).drop("n")


def _unit_lists_of(texts: DataFrame, signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, units) of some of the documents."""
    wanted = settle(signed.join(nodes.withColumnRenamed("node", "row"), "row").select("row", F.struct("file", "at").alias("place")), "wanted")
    words = texts.join(if_small(wanted), "place").select("row", _word_hashes("text").alias("words"))
    return words.mapInPandas(_unit_lists, "node long, units array<long>")


def _classes(signed: DataFrame, texts: DataFrame) -> DataFrame:
    """(row, place, doc_id, label): of each row its copies' node and its class's label."""
    copies = signed.where("weight > 0").groupBy("c1", "c2").agg(F.min("row").alias("node"), F.first("weight").alias("w"))
    copies = settle(copies.withColumnsRenamed({"c1": "k1", "c2": "k2"}), "copies")
    member = signed.join(copies, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")), "left")
    member = settle(member.select("row", F.struct("file", "at").alias("place"), "doc_id", F.coalesce("node", "row").alias("node")), "members")
    nodes = signed.join(copies, (F.col("row") == F.col("node")), "left_semi")
    entries = settle(nodes.select(F.explode("bands").alias("key"), F.col("row").alias("node"), "weight"), "entries")
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    entries = settle(entries.join(shared, "key"), "shared-entries")

    met = settle(entries.groupBy("node").agg(F.sum("size").alias("met")), "meetings")
    ranked = entries.join(met, "node")
    first = ranked.groupBy("key").agg(F.max_by(F.struct("node", "weight"), F.struct("met", -F.col("node"))).alias("h"))
    first = settle(first.select("key", "h.node", "h.weight"), "hubs")
    lists = settle(_unit_lists_of(texts, signed, met.select("node")), "unit-lists")
    links = _linked(_hub_pairs(entries, first), lists)

    others = entries.join(first.select("key", F.col("node").alias("hub")), "key").where("node <> hub").select("key", "node", "weight")
    others = settle(_labelled(others, links), "bucket-members")
    links = settle(links.unionByName(_remaining_links(others, lists)), "links")
    of = components(links).withColumnRenamed("node", "of_node")
    return member.join(of, F.col("node") == F.col("of_node"), "left").select("row", "place", "doc_id", F.coalesce("label", "node").alias("label"))


def _verdicts(texts: DataFrame) -> DataFrame:
    """(place, doc_id, class_id, class_size, kept) of documents (place, doc_id, text)."""
    # a doc_id goes through pandas as text, which keeps nulls and large numbers whole
    words = texts.select(F.monotonically_increasing_id().alias("row"), "place.file", "place.at", F.col("doc_id").cast("string"), _word_hashes("text").alias("words"))
    signed = words.mapInPandas(_signed, SIGNED).withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = settle(signed, "signatures")
    classes = settle(_classes(signed, texts), "classes")
    by = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))
    best = classes.groupBy("label").agg(F.min(by).alias("w"), F.count(F.lit(1)).alias("class_size"))
    best = settle(best.select(F.col("label").alias("of_label"), F.col("w.doc_id").alias("class_id"), F.col("w.row").alias("keep_row"), "class_size"), "class-heads")
    return classes.join(best, F.col("label") == F.col("of_label")).select("place", "doc_id", "class_id", "class_size", (F.col("row") == F.col("keep_row")).alias("kept"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), class_size, kept."""
    place = fresh(docs, "__place")
    return _verdicts(_texts(placed(docs, place), place, doc_id, text)).drop("place")


def _texts(whole: DataFrame, place: str, doc_id: str, text: str) -> DataFrame:
    return whole.select(F.col(place).alias("place"), F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))


def keep_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with the columns of ``docs``."""
    place = fresh(docs, "__place")
    whole = placed(docs, place)
    dropped = settle(_verdicts(_texts(whole, place, doc_id, text)).where("NOT kept").select(F.col("place").alias(place)), "dropped-rows")
    return whole.join(if_small(dropped), place, "left_anti").select(*docs.columns)
