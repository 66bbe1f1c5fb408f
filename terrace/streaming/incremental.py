"""Incremental extract by ``updated_at`` watermark, and incremental merge of a fact by month.

Only rows newer than the target's high watermark are read; the watermark is a literal by the time the
filter is planned, so Catalyst pushes it into the Parquet scan. The changed rows of a fact are merged
into a store that has a folder for each month: only the months that a changed key leaves or enters are
read in full and written anew; the files of all others stay as they are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources import tables

MONTH = "_month"


def high_watermark(target: DataFrame, column: str = "updated_at"):
    """Newest ``column`` value in the target (one scalar, computed with a distributed max)."""
    return target.agg(F.max(column).alias("w")).first()["w"]


def newer_than(source: DataFrame, column: str, watermark) -> DataFrame:
    """Rows strictly newer than the watermark; everything when the target is empty."""
    if watermark is None:
        return source
    return source.where(F.col(column) > F.lit(watermark))


class MonthStore:
    """A fact with unique keys in one folder for each month of its date (``none`` for a NULL date).

    A merge stages the months it changes, then writes a record that lists them, swaps their folders
    one by one and drops the record. A merge that was cut off after its record is finished by the next
    use of the store; one cut off before it has changed nothing.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, date: str):
        self.spark, self.path, self.key, self.date = spark, path.rstrip("/"), key, date
        self._pending = f"{self.path}/_merge.json"

    def _month(self) -> Column:
        return F.coalesce(F.date_format(self.date, "'m'yyyy-MM"), F.lit("none"))

    def load(self, fact: DataFrame) -> None:
        """The whole fact, replacing what is stored. A month is written by as many tasks as it has rows
        for, whatever its share of them."""
        fact.withColumn(MONTH, self._month()).hint("rebalance", MONTH).write.mode("overwrite").option("compression", tables.CODEC).partitionBy(MONTH).parquet(self.path)

    def read(self) -> DataFrame:
        """The fact with its month."""
        self.finish()
        return self.spark.read.parquet(self.path)

    def merge(self, changed: DataFrame) -> list[str]:
        """Put in ``changed``, rows of the fact as they now are, for their keys. Returns the months that
        were written anew (as many as the calendar has, at most)."""
        stored = self.read()
        work = f"{self.path}/_staged-{uuid.uuid4().hex}"
        changed.withColumn(MONTH, self._month()).write.option("compression", tables.CODEC).parquet(f"{work}/changed")
        new = self.spark.read.parquet(f"{work}/changed")
        keys = new.select(self.key).distinct()
        left = stored.select(self.key, MONTH).join(keys, self.key, "left_semi").select(MONTH)
        months = sorted(r[0] for r in left.unionByName(new.select(MONTH)).distinct().collect())
        kept = stored.where(F.col(MONTH).isin(months)).join(keys, self.key, "left_anti")
        merged = kept.unionByName(new.select(*stored.columns))
        merged.hint("rebalance", MONTH).write.option("compression", tables.CODEC).partitionBy(MONTH).parquet(f"{work}/months")
        written = {c.split("=", 1)[1] for c in tables.list_children(self.spark, f"{work}/months") if "=" in c}
        tables.write_record(self.spark, self._pending, {"work": work, "swap": sorted(written), "drop": sorted(set(months) - written)})
        self.finish()
        return months

    def finish(self) -> None:
        """Carry out a merge whose record stands; each step may have been done before."""
        if not tables.path_exists(self.spark, self._pending):
            return
        todo = json.loads(tables.read_record(self.spark, self._pending))
        for month in todo["swap"]:
            staged, target = f"{todo['work']}/months/{MONTH}={month}", f"{self.path}/{MONTH}={month}"
            if tables.path_exists(self.spark, staged):
                tables.remove_path(self.spark, target)
                tables.move_path(self.spark, staged, target)
        for month in todo["drop"]:
            tables.remove_path(self.spark, f"{self.path}/{MONTH}={month}")
        tables.remove_path(self.spark, self._pending)
        tables.remove_path(self.spark, todo["work"])


def changed_facts(fact: DataFrame, key: str, changed_keys: DataFrame, via: str, changed_via: DataFrame) -> DataFrame:
    """The rows of a fact plan whose own record (``key``) or whose dimension record (``via``) changed."""
    by_key = changed_keys.select(F.col(key).alias("_k")).distinct().withColumn("_own", F.lit(True))
    by_via = changed_via.select(F.col(via).alias("_v")).distinct().withColumn("_other", F.lit(True))
    flagged = fact.join(by_key, F.col(key) == F.col("_k"), "left").join(by_via, F.col(via) == F.col("_v"), "left")
    return flagged.where("_own OR _other").select(*fact.columns)
