"""Exact dedup against a history of digests behind a minimal perfect hash.

The history is a table with one row per bucket of digests. A bucket holds a minimal perfect hash over
its distinct digests (bit levels: at each level a digest that meets no other takes its bit, the others
go on to the next level; the slot is the rank of the bit among all levels), and per slot the full
digest and the locator of the winning row. A new digest is hashed to a slot and compared with the
slot's digest byte by byte: members take the slot's group, nonmembers form groups of their own.

Texts are equal when they are identical after deleting the white space characters. Of equal texts the
row with the most code points stays, then the smallest doc_id (null last), then the row read first.

Scale: digests are aggregated before any shuffle, so a text with a third of all copies costs one row
per task. Buckets follow the digest's leading bits and hold about BUCKET_KEYS distinct digests at any
size of the history. The verdicts, one row per distinct digest, come back to the rows by a join that
nothing above regroups, so Spark can split the side with a hot digest. Texts are never shuffled.

Edge cases: a null text counts as empty; all blank texts are equal. Repeated rows (same doc_id, same
text) are copies: one of them stays. An empty table gives an empty result. Columns other than doc_id
and text are carried by ``keep_documents`` and ignored elsewhere.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import BLANKS, fresh, if_small, placed, settle, whole_text, without

#: Distinct digests in a bucket, about.
BUCKET_KEYS = 2048
#: Bits of a level for each digest that reaches it.
GAMMA = 2.0

# A doc_id goes through pandas as text, which keeps nulls and large numbers whole.
HISTORY = "bucket long, n long, sizes array<int>, bits binary, digests binary, ids array<string>, rows array<long>, lengths array<long>, copies array<long>"
VERDICT = "digest binary, keep_row long, keep_id string, group_size long, slot long, known boolean"


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(without(text, BLANKS), 256))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, length, digest) of every row, written once so that ``row`` stays what it is."""
    t = whole_text(text)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.length(t).cast("long").alias("length"), digest_of(t).alias("digest"))
    return settle(rows, "digests")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: its winner and how many rows have it."""
    by = F.struct((-F.col("length")).alias("short"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))
    return rows.groupBy("digest").agg(F.min(by).alias("w"), F.count(F.lit(1)).alias("copies")).select("digest", F.col("w.doc_id").cast("string").alias("id"), F.col("w.row").alias("row"), (-F.col("w.short")).alias("length"), "copies")


def _bucketed(groups: DataFrame, n: int) -> DataFrame:
    return groups.withColumn("bucket", F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % n)


# --- the minimal perfect hash of one bucket ---------------------------------------------------------


def _hashed(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Positions of digests (rows of four 64-bit words) at a level; words 1 to 3 take turns, word 0
    has chosen the bucket."""
    with np.errstate(over="ignore"):
        x = keys[:, 1 + level % 3] + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit levels of a minimal perfect hash over distinct digests."""
    levels, left = [], keys
    while len(left):
        size = max(64, int(GAMMA * len(left)))
        at = _hashed(left, len(levels), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, dtype=bool)
        bits[at[alone]] = True
        levels.append(bits)
        left = left[~alone]
    return levels


def slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot of each digest: its own for members, any slot or -1 for others."""
    out, open_, base = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys)), 0
    for k, bits in enumerate(levels):
        rank = np.cumsum(bits)
        at = _hashed(keys[open_], k, len(bits))
        hit = bits[at]
        out[open_[hit]] = base + rank[at[hit]] - 1
        open_, base = open_[~hit], base + int(rank[-1])
    return out


def _words(digests: list[bytes] | bytes) -> np.ndarray:
    data = digests if isinstance(digests, bytes) else b"".join(digests)
    return np.frombuffer(data, dtype=">u8").astype(np.uint64).reshape(-1, 4)


def _built(group: pd.DataFrame) -> pd.DataFrame:
    keys = _words([bytes(x) for x in group["digest"]])
    levels = build_levels(keys)
    order = np.argsort(slots(levels, keys))
    column = lambda c: [group[c].iloc[order].tolist()]
    return pd.DataFrame(
        {
            "bucket": [int(group["bucket"].iloc[0])],
            "n": [len(group)],
            "sizes": [[len(x) for x in levels]],
            "bits": [np.packbits(np.concatenate(levels)).tobytes()],
            "digests": [b"".join(bytes(x) for x in group["digest"].iloc[order])],
            "ids": [[None if pd.isna(x) else x for x in group["id"].iloc[order]]],
            "rows": column("row"),
            "lengths": column("length"),
            "copies": column("copies"),
        }
    )


def build_history(rows: DataFrame, n_buckets: int) -> DataFrame:
    """The stored history over rows of ``digests``."""
    built = _bucketed(_groups(rows), n_buckets).groupBy("bucket").applyInPandas(_built, HISTORY)
    return settle(built, "digest-history")


def _looked_up(new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    """Verdicts of a bucket: its stored slots, joined by the new digests that are members, and the
    groups of the nonmembers."""
    stored: list[tuple] = []
    if len(old):
        h = old.iloc[0]
        data = bytes(h["digests"])
        stored = [[data[32 * i : 32 * i + 32], h["ids"][i], h["rows"][i], h["lengths"][i], h["copies"][i]] for i in range(h["n"])]
        flat, levels, at = np.unpackbits(np.frombuffer(bytes(h["bits"]), dtype=np.uint8)).astype(bool), [], 0
        for size in h["sizes"]:
            levels.append(flat[at : at + size])
            at += size
    found = slots(levels, _words([bytes(x) for x in new["digest"]])) if stored and len(new) else np.full(len(new), -1)
    own = []
    for slot, row in zip(found, new[["digest", "id", "row", "length", "copies"]].itertuples(index=False, name=None), strict=True):
        row = [bytes(row[0]), *row[1:]]
        if slot >= 0 and stored[slot][0] == row[0]:  # the byte check
            mine = stored[slot]
            total = mine[4] + row[4]
            if _rank(row) < _rank(mine):
                stored[slot] = row
            stored[slot] = [*stored[slot][:4], total]
        else:
            own.append(row)
    out = [(d, r, i, c, k, True) for k, (d, i, r, _, c) in enumerate(stored)]
    out += [(d, r, None if pd.isna(i) else i, c, None, False) for d, i, r, _, c in own]
    frame = pd.DataFrame(out, columns=["digest", "keep_row", "keep_id", "group_size", "slot", "known"])
    return frame.astype({"keep_row": "int64", "keep_id": object, "group_size": "int64", "slot": "Int64"})


def _rank(row: list) -> tuple:
    return -row[3], bool(pd.isna(row[1])), 0 if pd.isna(row[1]) else int(row[1]), row[2]


def verdicts(rows: DataFrame, history: DataFrame, n_buckets: int) -> DataFrame:
    """One row per digest of the history or of ``rows``: the row that stays, the size of the group, and
    its slot in the history (null for nonmembers). Where a new row beats the stored winner, it stays."""
    new = _bucketed(_groups(rows), n_buckets)
    found = new.groupBy("bucket").cogroup(history.groupBy("bucket")).applyInPandas(_looked_up, VERDICT)
    return settle(found.withColumn("keep_id", F.col("keep_id").cast("long")), "digest-verdicts")


def _two_arrivals(rows: DataFrame) -> DataFrame:
    """Verdicts over all rows of one table: the rows whose document hashes to an even number count as
    the earlier arrival and make the history; the others are looked up in it."""
    odd = F.coalesce(F.xxhash64("doc_id").bitwiseAND(1), F.lit(0)) == 1
    n = max(1, -(-rows.select(F.approx_count_distinct("digest")).first()[0] // BUCKET_KEYS))
    return verdicts(rows.where(odd), build_history(rows.where(~odd), n), n)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = digests(docs, doc_id, text)
    found = _two_arrivals(rows).withColumnRenamed("digest", "found")
    return rows.join(found, F.col("digest") == F.col("found")).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with the columns of ``docs``. Dropped rows are named by their place, so
    that the list means the same rows whatever is lost meanwhile, and no text is copied."""
    place = fresh(docs, "__place")
    whole = placed(docs, place)
    t = whole_text(text)
    rows = whole.select(F.monotonically_increasing_id().alias("row"), F.col(place).alias("place"), F.col(doc_id).cast("long").alias("doc_id"), F.length(t).cast("long").alias("length"), digest_of(t).alias("digest"))
    rows = settle(rows, "digests")
    found = _two_arrivals(rows).withColumnRenamed("digest", "found")
    dropped = settle(rows.join(found, (F.col("digest") == F.col("found")) & (F.col("row") != F.col("keep_row"))).select(F.col("place").alias(place)), "dropped-rows")
    return whole.join(if_small(dropped), place, "left_anti").select(*docs.columns)
