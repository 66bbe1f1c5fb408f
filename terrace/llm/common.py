"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.session import ensure_checkpoint_dir

#: The white space of all contracts: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
#: A word: a maximal run without white space.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Rows of a list that is broadcast (some 60 MB); a longer one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_watching: list[list[str]] = []


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which the driver and all executors share."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{what}-{uuid.uuid4().hex}"
    for made in _watching:
        made.append(path)
    return path


@contextmanager
def working_folders() -> Iterator[list[str]]:
    """The folders that operators make meanwhile, in order. Their results read from them, so they can go
    (``tables.remove_path``) when the results have been written elsewhere."""
    made: list[str] = []
    _watching.append(made)
    try:
        yield made
    finally:
        _watching[:] = [x for x in _watching if x is not made]


def settle(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: its rows are computed once, an
    executor may be lost later, and what a plan above does cannot change them."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def placed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``name``, which tells its rows apart and stays the same however often they are read:
    the file (as a 64-bit hash of its path) and the number of the row in it. Where ``docs`` is more than
    a read of Parquet files its rows are written first, each with a number."""
    stored = docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
    if stored and "_metadata" not in map(str.lower, docs.columns):
        try:
            return docs.withColumn(name, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")))
        except AnalysisException:
            pass  # another format, without row numbers
    return settle(docs.withColumn(name, F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("at"))), "numbered-docs")


def if_small(rows: DataFrame) -> DataFrame:
    """``rows``, a written table, for a join: broadcast if there are at most BROADCAST_ROWS."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` uses it, also inside
    lambdas (which would otherwise recompute it for each array element)."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (column names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_text(column: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without(text: Column, characters: str, instead: str = "") -> Column:
    """``text`` with each of the characters replaced; a byte search each, faster than ``translate``."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(instead)) if instead else F.replace(text, F.lit(c))
    return text


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def batches(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` characters, or one text."""
    start = total = 0
    for k, t in enumerate(texts):
        if k > start and total + len(t) > limit:
            yield start, k
            start, total = k, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def running_offsets(cells: DataFrame, keys: list[str], cell: str, value: str, out: str, fan: int = 1024) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier cells of the same keys.

    ``cells`` has one row for each (keys, cell) with cells numbered from 0. Two levels: sums of
    ``fan`` neighbouring cells first, so that no window holds more than ``fan`` cells of a group or
    one row for each ``fan`` of its cells. Null keys form a group of their own.
    """
    up, total, base = "__up", "__total", "__base"
    cells = cells.withColumn(up, F.expr(f"`{cell}` div {fan}"))
    tops = cells.groupBy(*keys, up).agg(F.sum(value).alias(total))
    w_top = Window.partitionBy(*keys).orderBy(up).rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn(base, F.coalesce(F.sum(total).over(w_top), F.lit(0))).drop(total)
    same = None
    renamed = tops
    for k in [*keys, up]:
        renamed = renamed.withColumnRenamed(k, f"{k}__t")
        test = F.col(k).eqNullSafe(F.col(f"{k}__t"))
        same = test if same is None else same & test
    w_in = Window.partitionBy(*keys, up).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    inner = cells.withColumn(out, F.coalesce(F.sum(value).over(w_in), F.lit(0)))
    joined = inner.join(renamed, same)
    return joined.withColumn(out, F.col(out) + F.col(base)).drop(base, up, f"{up}__t", *[f"{k}__t" for k in keys])
