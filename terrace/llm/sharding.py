"""Sharding over fixed virtual slots.

Records hash by their key into a fixed number of virtual slots; bytes and rows are added up per slot;
a stored, versioned table maps each slot to a shard and is only ever edited by adding a version:
``grown`` gives a new shard its share of slots taken from all others, ``rebalanced`` moves slots from
full shards to empty ones by their bytes. Records never move unless their slot does.

The law of the registered query is ``key``: a record's shard follows from its doc_id and the number of
shards alone, and one more shard takes records only into itself.

Scale: the map has SLOTS rows, a fixed bound, so it is broadcast. Positions within a shard come from
counts per cell (a slot and one of SPREAD parts of its rows), two-level running sums over the cells,
and a row number within each cell, so no task holds a shard, or a doc_id shared by a third of the rows.

Edge cases: a null or empty text has no bytes, its record counts 1; a very long text is a record like
any other, whose bytes no edit can divide; null doc_ids share a slot; records of one slot take their
positions by doc_id, then text; repeated rows share a slot and take positions of their own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.common import running_offsets, settle

SLOTS = 4096
#: Parts that the rows of a slot are dealt to for numbering.
SPREAD = 16
#: Rebalancing stops when the largest and smallest shard differ by this share of the mean.
TOLERANCE = 0.02


def slot_of(key: Column, n_slots: int = SLOTS) -> Column:
    """The virtual slot of a key: leading 32 bits of the MD5 of its decimal form."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long") % n_slots).cast("int")


# --- the map ---------------------------------------------------------------------------------------


def grown(shard_of: list[int]) -> list[int]:
    """The map with one more shard, which takes its share of slots from every other shard."""
    n = max(shard_of, default=-1) + 1
    out, owned = list(shard_of), [[] for _ in range(n)]
    for s in sorted(range(len(out)), key=lambda s: hashlib.md5(f"{s}:{n}".encode()).digest()):
        owned[out[s]].append(s)
    for _ in range(len(out) // (n + 1)):
        giver = max(owned, key=len)
        out[giver.pop()] = n
    return out


def initial(n_shards: int, n_slots: int = SLOTS) -> list[int]:
    """The map of ``n_shards`` shards, grown from a single one."""
    out = [0] * n_slots
    for _ in range(n_shards - 1):
        out = grown(out)
    return out


def rebalanced(shard_of: list[int], slot_bytes: dict[int, int], tolerance: float = TOLERANCE) -> list[int]:
    """The map after moving slots from the fullest to the emptiest shard, the largest slot that narrows
    their difference first, until no move does or all lie within the tolerance."""
    out, n = list(shard_of), max(shard_of) + 1
    load = [0] * n
    for s, k in enumerate(out):
        load[k] += slot_bytes.get(s, 0)
    mean = sum(load) / n
    while True:
        full, empty = max(range(n), key=lambda k: load[k]), min(range(n), key=lambda k: load[k])
        gap = load[full] - load[empty]
        fits = [s for s, k in enumerate(out) if k == full and 0 < slot_bytes.get(s, 0) < gap]
        if gap <= tolerance * mean or not fits:
            return out
        moved = min(fits, key=lambda s: abs(gap - 2 * slot_bytes[s]))
        out[moved] = empty
        load[full] -= slot_bytes[moved]
        load[empty] += slot_bytes[moved]


def map_table(spark: SparkSession, versions: list[list[int]]) -> DataFrame:
    """The stored map: (version, n_shards, slot, shard)."""
    rows = [(v, max(m) + 1, s, k) for v, m in enumerate(versions) for s, k in enumerate(m)]
    return settle(spark.createDataFrame(rows, "version int, n_shards int, vslot int, shard int").coalesce(1), "slot-map")


def stored_version(slot_map: DataFrame, version: int) -> list[int]:
    """The shard of each virtual slot under a version: as many numbers as there are slots."""
    return [r.shard for r in slot_map.where(F.col("version") == version).orderBy("vslot").collect()]


def rebalance(rows: DataFrame, slot_map: DataFrame, version: int, tolerance: float = TOLERANCE) -> DataFrame:
    """The stored map with a further version: that of ``version`` after slots were moved so that the
    bytes of ``rows`` (see ``records``) are spread evenly. Only the totals per slot reach the driver.
    Without records, or with all bytes in one slot, the new version is a copy."""
    totals = {r.vslot: r.bytes for r in slot_totals(rows).collect()}  # a number for each slot at most
    now = rebalanced(stored_version(slot_map, version), totals, tolerance)
    last = slot_map.agg(F.max("version")).first()[0]
    edited = [(last + 1, max(now) + 1, s, k) for s, k in enumerate(now)]
    added = slot_map.sparkSession.createDataFrame(edited, slot_map.schema)
    return settle(slot_map.unionByName(added).coalesce(1), "slot-map")


# --- records ---------------------------------------------------------------------------------------


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, vslot, part), written once so that ``part`` stays what it is."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return settle(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(data) + 1).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
            slot_of(F.col(doc_id)).alias("vslot"),
            F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int").alias("part"),
        ),
        "shard-records",
    )


def slot_totals(rows: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot: at most SLOTS rows."""
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def place(rows: DataFrame, slot_map: DataFrame, version: int) -> DataFrame:
    """``rows`` with their shard under a version of the map and their position in it, gapless from 0."""
    now = F.broadcast(slot_map.where(F.col("version") == version).select("vslot", "shard"))
    cell = F.col("vslot").cast("long") * SPREAD + F.col("part")
    placed = rows.join(now, "vslot").withColumn("cell", cell)
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    starts = running_offsets(counts, ["shard"], "cell", "n", "start").select(F.col("cell").alias("of_cell"), "start")
    nth = F.row_number().over(Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size")) - 1
    numbered = placed.withColumn("nth", nth)
    return numbered.join(starts, F.col("cell") == F.col("of_cell")).withColumn("slot", F.col("start") + F.col("nth")).drop("cell", "of_cell", "start", "nth")


def shard(docs: DataFrame, n_shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every record with its shard of ``n_shards``, its position there, and the shard with one more."""
    first = initial(n_shards)
    slot_map = map_table(docs.sparkSession, [first, grown(first)])
    placed = place(records(docs, doc_id, text), slot_map, 0)
    after = F.broadcast(slot_map.where(F.col("version") == 1).select(F.col("vslot").alias("v"), F.col("shard").alias("grown_shard")))
    return placed.join(after, F.col("vslot") == F.col("v")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long"), "grown_shard"
    )
