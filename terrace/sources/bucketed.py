"""Facts and dimensions laid out by a key, so that joins and aggregations on it move no row.

Every table is written in the same number of buckets by a hash of the key and sorted by it within a
bucket. A key with more rows in some table than a bucket has on average is hot: its rows, of all tables,
are kept apart in plain files of even size. There are at most ``buckets`` such keys a table, so what a
join needs of a dimension for them is a broadcast of a known size, and a hot key never makes one task
long. The cold rest is joined bucket by bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that a bucket has at most, on average: a task sorts and joins one bucket.
BUCKET_ROWS = 1_000_000


@dataclass(frozen=True)
class KeyLayout:
    """Tables under ``root`` laid out by ``key``; names in the session's catalog start with ``prefix``."""

    spark: SparkSession
    root: str
    key: str
    buckets: int
    prefix: str

    def _path(self, kind: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}/{name}"

    def cold(self, name: str) -> DataFrame:
        """The rows of a table without those of hot keys, in buckets."""
        return self.spark.table(f"{self.prefix}_{name}")

    def hot(self, name: str) -> DataFrame:
        """The rows of the hot keys."""
        return self.spark.read.parquet(self._path("hot", name))

    def hot_keys(self) -> DataFrame:
        return self.spark.read.parquet(self._path("keys", "hot"))

    def whole(self, name: str) -> DataFrame:
        return self.cold(name).unionByName(self.hot(name))

    def with_dimension(self, fact: str, dimension: str, how: str = "left") -> DataFrame:
        """A fact with the columns of a dimension (one row a key) by the key: the cold rows without an
        exchange on either side, the hot ones against at most ``buckets`` rows for each table."""
        cold = self.cold(fact).join(self.cold(dimension), self.key, how)
        return cold.unionByName(self.hot(fact).join(F.broadcast(self.hot(dimension)), self.key, how))

    def per_key(self, work: Callable[[Callable[[str], DataFrame]], DataFrame]) -> DataFrame:
        """``work``, which is given a reader of tables and only groups and joins by the key, over the
        cold and the hot rows: keys are either cold or hot in all tables."""
        return work(self.cold).unionByName(work(self.hot))


def lay_out(spark: SparkSession, root: str, frames: Mapping[str, DataFrame], key: str, buckets: int, dimensions: tuple[str, ...] = ()) -> KeyLayout:
    """Write ``frames`` by ``key``. ``dimensions``: those with one row a key. A NULL key is never hot: it
    joins with nothing, and its bucket takes part in no join. ``buckets`` is the least number: a table of
    more than ``BUCKET_ROWS`` rows a bucket gets more, so that a task's share does not grow with it."""
    rows = {name: df.count() for name, df in frames.items()}
    buckets = max(buckets, *(-(-n // BUCKET_ROWS) for n in rows.values()))
    layout = KeyLayout(spark, f"{root.rstrip('/')}/{uuid.uuid4().hex[:12]}", key, buckets, f"by_{key}_{uuid.uuid4().hex[:12]}")
    found = []
    for name, df in frames.items():
        if name not in dimensions:
            sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            found.append(sizes.where(F.col(key).isNotNull() & (F.col("n") > F.lit(rows[name] / buckets))).select(key))
    keys = found[0]
    for more in found[1:]:
        keys = keys.unionByName(more)
    # an exchange to one file, of the few hot keys alone: coalesce(1) would count all keys in one task
    keys.distinct().repartition(1).write.parquet(layout._path("keys", "hot"))
    hot = F.broadcast(layout.hot_keys())  # at most ``buckets`` rows for each fact
    for name, df in frames.items():
        df.join(hot, key, "left_semi").select(*df.columns).write.parquet(layout._path("hot", name))
        cold = df.join(hot, key, "left_anti").select(*df.columns)
        # the exchange deals rows as the buckets do, so a task writes one file
        cold.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", layout._path("cold", name)).saveAsTable(f"{layout.prefix}_{name}")
    return layout


def reopen(spark: SparkSession, layout: KeyLayout, schemas: Mapping[str, str]) -> KeyLayout:
    """Name the stored tables of a layout in another session's catalog: the files carry their buckets."""
    for name, ddl in schemas.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {layout.prefix}_{name} ({ddl}) USING parquet CLUSTERED BY ({layout.key}) "
            f"SORTED BY ({layout.key}) INTO {layout.buckets} BUCKETS LOCATION '{layout._path('cold', name)}'"
        )
    return KeyLayout(spark, layout.root, layout.key, layout.buckets, layout.prefix)
