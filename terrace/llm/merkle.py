"""A Merkle manifest of a table, held as concatenated level strings.

A leaf is the SHA-256 of a row's fields, each with its length before it. The leaves of a group stand in
key order; every two neighbours (the last one alone, where their number is odd) become the SHA-256 of
their hex digests until one is left, the group's subroot; the subroots, in the order of their groups,
become the root in the same way.

Leaves are taken in aligned blocks of FAN. A block keeps each of its levels as one string of hex digests
of 64 characters, so the parents are hashes of fixed-width substrings of 128, and the sibling of node k
is the substring beside it, number k xor 1. Blocks are aligned to a power of two, so a block's top is a
node of the whole tree: the tops of a group's blocks are the leaves of the next round, and so on until
a group has one block. The siblings of a row, from leaf to root, are its segment in its block, its
block's segment in the block above and at last its group's segment, each cell 64 wide, where a node
without a sibling has dashes.

Scale: texts are hashed where they are read and never shuffled. The slim leaves are put in order by one
range partitioning (with the digest and a row number last, so equal keys of a third of all rows are
still divided); positions come from the place within a partition and running sums over partitions; a
group of any size is divided into blocks of FAN rows. Later rounds have one row for each FAN of the
round before. Everything is SQL functions.

Edge cases: a null field is ``-``; null groups come first; a null key comes first in its group and is
not tampered with; rows with equal keys are ordered by their digest, and repeated rows are leaves of
their own; a lone leaf is its group's subroot and a lone subroot the root, unhashed; empty and very long
texts are fields like any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import running_offsets, settle

#: Leaves of a block: a power of two.
BITS = 10
FAN = 1 << BITS
#: Characters of a digest.
WIDE = 64


def field(value: Column) -> Column:
    """A field within a leaf: its length in bytes and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """The leaf of the fields."""
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def _positions(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, key, leaf, ...) with ``pos``, the place within the group, and ``n``, its size."""
    order = [F.col("grp"), F.col("key").asc_nulls_first(), F.col("leaf"), F.col("row")]
    placed = leaves.withColumn("row", F.monotonically_increasing_id())
    ordered = settle(placed, "merkle-leaves").repartitionByRange(*order).sortWithinPartitions(*order)
    # the number goes up by one from row to row of a partition, whose number stands in the upper bits
    numbered = settle(ordered.drop("row").withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "merkle-ordered")
    cells = numbered.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    cells = running_offsets(cells, ["grp"], "part", "rows", "before")
    sizes = cells.groupBy("grp").agg(F.sum("rows").alias("n"))
    cells = settle(cells.join(sizes, "grp").select("grp", "part", (F.col("before") - F.col("first")).alias("shift"), "n"), "merkle-cells")
    return numbered.join(cells, ["grp", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """(grp, block, n, items, levels, top) for nodes (grp, pos, n, leaf, ...): the levels of a block as
    strings of bytes, from the nodes themselves up to its top."""
    grouped = nodes.groupBy("grp", F.expr(f"pos div {FAN}").alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "leaf", *carried))).alias("items")
    )
    # levels that the block goes up: all of them, or as many as its group needs
    up = f"CASE WHEN n > {FAN} THEN {BITS} WHEN n = 1 THEN 0 ELSE length(bin(n - 1)) END"
    parents = (
        f"cast(array_join(transform(sequence(0, (length(element_at(held, -1)) - 1) div {2 * WIDE}), "
        f"k -> sha2(substring(element_at(held, -1), k * {2 * WIDE} + 1, {2 * WIDE}), 256)), '') AS binary)"
    )
    first = "array(cast(array_join(transform(items, x -> x.leaf), '') AS binary))"
    levels = f"aggregate(array_repeat(0, {up}), {first}, (held, _) -> concat(held, array({parents})))"
    return grouped.withColumn("levels", F.expr(levels)).withColumn("top", F.expr("cast(element_at(levels, -1) AS string)"))


#: The siblings of item number ``i`` of a block, level by level.
SEGMENT = (
    "array_join(transform(slice(levels, 1, size(levels) - 1), "
    f"(level, l) -> rpad(cast(substring(level, (shiftright(i, l) ^ 1) * {WIDE} + 1, {WIDE}) AS string), {WIDE}, '-')), '')"
)


def _folded(node: str, siblings: str, pos: str) -> str:
    """SQL of the digest that ``node`` at place ``pos`` gives with its siblings."""
    sibling = f"substring({siblings}, l * {WIDE} + 1, {WIDE})"
    return (
        f"aggregate(transform(array_repeat(0, int(length({siblings}) div {WIDE})), (_, k) -> k), {node}, (node, l) -> sha2(CASE "
        f"WHEN {sibling} LIKE '-%' THEN node WHEN shiftright({pos}, l) & 1 = 1 THEN concat({sibling}, node) ELSE concat(node, {sibling}) END, 256))"
    )


def _trees(nodes: DataFrame, most: int) -> DataFrame:
    """(grp, pos, segment, root) for nodes (grp, pos, n, leaf), a tree for each group; ``most`` is the
    largest ``n``."""
    blocks = _blocks(nodes)
    items = "inline(transform(items, (x, i) -> struct(x.pos AS pos, " + SEGMENT + " AS segment)))"
    if most <= FAN:
        return blocks.select("grp", F.expr(items), F.col("top").alias("root"))
    blocks = settle(blocks, "merkle-blocks")
    above = _above(blocks, most)
    return blocks.join(above, ["grp", "block"]).select("grp", F.expr(items), "above", "root").select("grp", "pos", F.concat("segment", "above").alias("segment"), "root")


def _above(blocks: DataFrame, most: int) -> DataFrame:
    """(grp, block, above, root): the siblings of each block's top up to its group's root."""
    tops = blocks.select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / FAN).alias("n"), F.col("top").alias("leaf"))
    return _trees(tops, -(-most // FAN)).select("grp", F.col("pos").alias("block"), F.col("segment").alias("above"), "root")


def manifest(leaves: DataFrame) -> DataFrame:
    """For leaves (grp, key, leaf, changed): key, leaf, subroot, root, siblings (their digests one after
    the other, from the leaf's to the root's) and folded_root, which ``changed``, or ``leaf`` where that
    is null, gives with the siblings. ``grp`` is a string without nulls."""
    placed = _positions(leaves)
    blocks = settle(_blocks(placed, "key", "changed"), "merkle-blocks")
    most = blocks.agg(F.max("n")).first()[0] or 0
    within = settle(_above(blocks, most), "merkle-within") if most > FAN else blocks.select("grp", "block", F.lit("").alias("above"), F.col("top").alias("root"))
    subroots = within.where("block = 0").select("grp", F.col("root").alias("subroot"))
    ordered = _positions(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("subroot").alias("leaf")))
    ordered = settle(ordered, "merkle-subroots")
    over = _trees(ordered, ordered.count())
    top = over.join(ordered.select("pos", F.col("key")), "pos").select(
        F.col("key").alias("grp"), F.col("pos").alias("place"), F.col("segment").alias("outer"), F.col("root").alias("whole")
    )
    joined = blocks.join(within, ["grp", "block"]).join(settle(top, "merkle-top"), "grp")
    row = "inline(transform(items, (x, i) -> struct(x.key AS key, x.pos AS pos, x.leaf AS leaf, x.changed AS changed, " + f"concat({SEGMENT}, above) AS siblings)))"
    rows = joined.select(F.expr(row), "place", "outer", "root", "whole")
    folded = _folded(_folded("coalesce(changed, leaf)", "siblings", "pos"), "outer", "place")
    return rows.select(
        "key",
        "leaf",
        F.col("root").alias("subroot"),
        F.col("whole").alias("root"),
        F.replace(F.concat("siblings", "outer"), F.lit("-"), F.lit("")).alias("siblings"),
        F.expr(folded).alias("folded_root"),
    )


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents by language; ``changed`` is the leaf with 1 added to n_chars, where 7 divides
    the CRC-32 of doc_id."""
    longer = F.col("n_chars").cast("decimal(20,0)") + 1
    fields = [F.col("doc_id"), F.col("source"), F.col("lang")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("v"), F.col("lang")), F.lit("")).alias("grp"),  # null first, then by bytes
        F.col("doc_id").alias("key"),
        digest(*fields, F.col("n_chars"), F.col("text")).alias("leaf"),
        F.when(hit & F.col("n_chars").isNotNull(), digest(*fields, longer, F.col("text"))).alias("changed"),
    )


def prove(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every row."""
    return manifest(document_leaves(docs)).select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
