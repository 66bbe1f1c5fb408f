"""Maintenance operators: erasure, pseudonymisation, compaction layout, retention selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.guards import pseudonym


def erase_subject(df: DataFrame, subjects: DataFrame, key: str) -> DataFrame:
    """Every row whose ``key`` is not named in the erasure request (left-anti join, any request size)."""
    return df.join(subjects.select(key).distinct(), key, "left_anti")


def pseudonymise(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Replace personal columns by salted SHA-256 pseudonyms, keeping column order."""
    return df.select(*[pseudonym(F.col(c), salt).alias(c) if c in columns else F.col(c) for c in df.columns])


def clustered_layout(df: DataFrame, column: str, files: int, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Compaction layout: ``files`` range partitions on ``column``, sorted inside each.

    Range partitioning samples the keys to pick boundaries, so files get similar sizes and each
    file covers a narrow range of ``column`` (tight min/max statistics for pruning). The range key
    is ``(column, *tiebreak)``: a single hot value of ``column`` can then still be split over
    several files instead of producing one giant file. Defaults to all other columns.
    """
    extra = [c for c in df.columns if c != column] if tiebreak is None else list(tiebreak)
    return df.repartitionByRange(files, column, *extra).sortWithinPartitions(column, *extra)


def _cut_points(df: DataFrame, column: str, ranges: int) -> list:
    """Where the column's values part into ranges of like size: the least value of each range partition,
    as many as ``ranges``. Any type with an order will do; a value of many rows takes several ranges."""
    parts = df.where(F.col(column).isNotNull()).select(F.col(column).alias("v")).repartitionByRange(ranges, "v")
    least = parts.groupBy(F.spark_partition_id()).agg(F.min("v").alias("v")).collect()
    return sorted({r.v for r in least})[1:]


def _range_number(column: str, cuts: list) -> Column:
    """How many cut points a value reaches, by halving; NULL counts 0."""
    if not cuts:
        return F.lit(0)
    mid = len(cuts) // 2
    return F.when(F.col(column) >= F.lit(cuts[mid]), F.lit(mid + 1) + _range_number(column, cuts[mid + 1 :])).otherwise(_range_number(column, cuts[:mid]))


def interleaved_layout(df: DataFrame, columns: Sequence[str], files: int, ranges: int = 32) -> DataFrame:
    """Compaction along a space-filling order of several columns: each column's range number, their bits
    interleaved. A file then covers a narrow range of every one of the columns, so that a filter on any
    of them passes over most files by their statistics. The columns themselves and a hash of the row come
    after the order, so a hot value is still divided."""
    bits = (ranges - 1).bit_length()
    order = F.lit(0)
    for k, c in enumerate(columns):
        number = _range_number(c, _cut_points(df, c, ranges))
        for b in range(bits):
            order = order + F.shiftleft(F.shiftright(number, b).bitwiseAND(1), b * len(columns) + k)
    row = F.xxhash64(*df.columns)
    return df.withColumn("_order", order).repartitionByRange(files, "_order", *columns, row).sortWithinPartitions("_order", *columns).drop("_order")


def file_spans(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per file of a stored table its rows and the least and largest value of each column."""
    spans = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *spans)


def files_touched(spans: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """For each of a few values (column ``value``): the files whose span holds it, and all files."""
    inside = (F.col("value") >= F.col(f"{column}_min")) & (F.col("value") <= F.col(f"{column}_max"))
    return values.join(F.broadcast(spans), F.lit(True)).groupBy("value").agg(F.count_if(inside).alias("touched"), F.count(F.lit(1)).alias("files"))
