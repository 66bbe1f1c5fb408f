"""Lake tables on plain Parquet: day-partitioned zones, versioned snapshots, exports, audit rows.

* Day tables (bronze, quarantine): one folder per ``_run_date``. Rewriting a day replaces exactly
  that folder, also when the new frame is empty (so a rerun after a rule fix clears quarantine).
* Snapshot tables (silver, gold): every write goes to a folder of its own and is committed by creating
  the record file ``_history/v<n>.json``, which names the folder. The record is never overwritten: of
  two writers of one version the second fails and takes its folder away. Readers take the newest
  committed version, so they never see half a table.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

#: A folder without a record in which nothing was written for so long belongs to no running writer.
GRACE_HOURS = 24.0
#: Codec of what the lake stores beyond the landing zone.
CODEC = "zstd"
HISTORY_DDL = "table_name string, version bigint, committed_at timestamp, operation string, rows bigint"
AUDIT_DDL = "run_date date, table_name string, row_count bigint, started_at timestamp, finished_at timestamp"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever filesystem the path names (local, HDFS, object store)."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def write_record(spark: SparkSession, path: str, record: dict) -> None:
    """Write one small JSON-lines file (a commit or audit record) with the file-system API.

    A single create-and-close is atomic on HDFS and object stores, so a reader sees the whole
    record or none of it; no Spark job is needed for one row.
    """
    fs, p = _fs(spark, path)
    out = fs.create(p, False)  # fails if the record is there
    try:
        out.write(bytearray((json.dumps(record, default=str) + "\n").encode("utf-8")))
    finally:
        out.close()


def read_record(spark: SparkSession, path: str) -> str:
    """The text of one small record file, without a Spark job."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder on its file system."""
    fs, p = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def copy_path(spark: SparkSession, source: str, target: str) -> None:
    """Copy a folder with all below it, several files at a time."""
    from concurrent.futures import ThreadPoolExecutor

    fs, p = _fs(spark, source)
    to, q = _fs(spark, target)
    path, copy = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy
    found, todo = [], [(p, q)]
    while todo:
        at, goal = todo.pop()
        to.mkdirs(goal)
        for status in fs.listStatus(at):
            pair = (status.getPath(), path(goal, status.getPath().getName()))
            (todo if status.isDirectory() else found).append(pair)
    with ThreadPoolExecutor(max_workers=16) as pool:
        list(pool.map(lambda pair: copy(fs, pair[0], to, pair[1], False, spark.sparkContext._jsc.hadoopConfiguration()), found))


def last_change(spark: SparkSession, path: str) -> dt.datetime:
    """The newest modification time of anything below ``path`` (UTC): a writer at work keeps adding."""
    fs, p = _fs(spark, path)
    status = fs.getFileStatus(p)
    newest, todo = status.getModificationTime(), [status]
    while todo:
        at = todo.pop()
        newest = max(newest, at.getModificationTime())
        if at.isDirectory():
            todo += list(fs.listStatus(at.getPath()))
    return dt.datetime.fromtimestamp(newest / 1000, dt.timezone.utc).replace(tzinfo=None)


def list_children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def has_data(spark: SparkSession, folder: str) -> bool:
    return any(n.startswith("part-") for n in list_children(spark, folder))


# ------------------------------------------------------------------------------- day tables
def write_day(df: DataFrame, path: str, run_date: str, day_col: str = "_run_date") -> None:
    """Replace one day of a day-partitioned table (idempotent; an empty frame clears the day).

    The frame is written straight into ``<path>/<day_col>=<run_date>`` in overwrite mode, so only
    that folder changes; other days are untouched whatever their schema. Columns added by the
    source show up on read with ``mergeSchema``.
    """
    target = f"{path}/{day_col}={run_date}"
    out = df.drop(day_col) if day_col in df.columns else df
    out.write.mode("overwrite").option("compression", CODEC).parquet(target)


def read_days(spark: SparkSession, path: str, run_date: str | None = None, day_col: str = "_run_date") -> DataFrame | None:
    """A day table (all days, schemas merged), or one day.

    For one day only that day's folder is listed and its footers read (``basePath`` keeps the
    partition column), so the cost does not grow with the table's history.
    """
    try:
        if run_date is not None:
            df = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(f"{path}/{day_col}={run_date}")
        else:
            df = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if run_date is not None:
        df = df.where(F.col(day_col) == F.lit(run_date).cast("date"))
    return df


#: Types that a later day may widen, narrower first.
WIDER = ("tinyint", "smallint", "int", "bigint")


def read_widened(spark: SparkSession, path: str, day_col: str = "_run_date") -> DataFrame:
    """All days of a day table whose columns were added or widened (an integer to a larger one, a float
    to a double) over time, as the widest schema; columns that a day lacks are NULL.

    The days are read by schema, one scan for each different one, so their number does not matter; only
    footers are looked at before. Types that are no widening of each other are an error."""
    days: dict[str, list[str]] = {}
    for child in list_children(spark, path):
        if child.startswith(f"{day_col}=") and has_data(spark, f"{path}/{child}"):
            days.setdefault(spark.read.parquet(f"{path}/{child}").schema.json(), []).append(f"{path}/{child}")
    parts = [spark.read.option("basePath", path).parquet(*folders) for folders in days.values()]
    if not parts:
        raise FileNotFoundError(f"{path} has no day")
    wide: dict[str, str] = {}
    for part in parts:
        for name, kind in part.dtypes:
            held = wide.setdefault(name, kind)
            if held != kind:
                ladder = next((x for x in (WIDER, ("float", "double")) if held in x and kind in x), None)
                if ladder is None:
                    raise ValueError(f"column {name} is {held} on some days and {kind} on others")
                wide[name] = max(held, kind, key=ladder.index)
    out = None
    for part in parts:
        same = part.select(*[F.col(f"`{n}`").cast(wide[n]).alias(n) for n in part.columns])
        out = same if out is None else out.unionByName(same, allowMissingColumns=True)
    return out


# --------------------------------------------------------------------------- snapshot tables
class SnapshotTable:
    """Versioned Parquet table committed through an append-only history."""

    def __init__(self, spark: SparkSession, path: str, name: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.name = name or self.path.rsplit("/", 1)[-1]
        self._version: int | None = None
        self._known = False  # single writer per table: the version seen last stays valid

    @property
    def history_path(self) -> str:
        return f"{self.path}/_history"

    def history(self) -> DataFrame:
        """Committed versions, newest first (version, committed_at, operation, rows)."""
        if not list_children(self.spark, self.history_path):
            return self.spark.createDataFrame([], HISTORY_DDL)
        return self.spark.read.schema(HISTORY_DDL).json(self.history_path).orderBy(F.desc("version"))

    def current_version(self, refresh: bool = False) -> int | None:
        """Newest committed version, from the names of the commit records (a listing, no job)."""
        if self._known and not refresh:
            return self._version
        versions = [int(n[1:-5]) for n in list_children(self.spark, self.history_path) if n.startswith("v") and n.endswith(".json")]
        v = max(versions) if versions else None
        self._version, self._known = v, True
        return v

    def exists(self) -> bool:
        return self.current_version() is not None

    def record(self, version: int) -> dict:
        """The commit record of a version."""
        return json.loads(read_record(self.spark, f"{self.history_path}/v{version:020d}.json"))

    def folder(self, version: int) -> str:
        """The data folder that a committed version names."""
        return f"{self.path}/{self.record(version)['folder']}"

    def committed_rows(self) -> int:
        """The rows of the current version, as its commit counted them; 0 for a table without one."""
        v = self.current_version()
        return 0 if v is None else int(self.record(v)["rows"])

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"table {self.name} has no committed version")
        return self.spark.read.parquet(self.folder(v))

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.exists() else None

    def commit(self, df: DataFrame, operation: str, rows: int | None = None) -> int:
        """Write ``df`` as the next version, then write the commit record that makes it visible.

        Row counts come from an ``Observation`` on the write itself (no second pass over the data).
        """
        from pyspark.sql import Observation

        cur = self.current_version()
        version = 0 if cur is None else cur + 1
        folder = f"data-{version}-{uuid.uuid4().hex[:12]}"
        obs = Observation(f"rows_{self.name}_{version}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", CODEC).parquet(f"{self.path}/{folder}")
        written = int(obs.get["rows"]) if rows is None else rows
        try:
            self._record(version, operation, written, folder)
        except Exception:
            remove_path(self.spark, f"{self.path}/{folder}")
            self._known = False  # another writer was first
            raise
        return version

    def _record(self, version: int, operation: str, rows: int, folder: str) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        record = {"table_name": self.name, "version": version, "committed_at": now.isoformat(), "operation": operation, "rows": rows, "folder": folder}
        write_record(self.spark, f"{self.history_path}/v{version:020d}.json", record)  # the commit point
        self._version, self._known = version, True
        log.info("%s: version %d, %s, %d rows", self.name, version, operation, rows)

    def restore(self, version: int) -> int:
        """Make an earlier version current again: a new version that names the same folder."""
        old = self.history().where(F.col("version") == version).first()
        if old is None:
            raise ValueError(f"{self.name} has no version {version}")
        now = self.current_version() + 1
        self._record(now, f"RESTORE {version}", old["rows"], self.folder(version).rsplit("/", 1)[-1])
        return now

    def as_of(self, when: dt.datetime) -> DataFrame:
        """The table as it stood at a time (UTC): the newest version committed by then."""
        found = self.history().where(F.col("committed_at") <= F.lit(when)).agg(F.max("version")).first()[0]
        if found is None:
            raise FileNotFoundError(f"table {self.name} had no committed version at {when}")
        return self.read(found)

    def changes(self, key: str, before: int, after: int, columns: list[str] | None = None) -> DataFrame:
        """What became of each row between two versions: (key, change), ``inserted``, ``deleted`` or
        ``changed`` in one of ``columns`` (without: in any that both have); NULLs equal each other, unchanged
        rows are left out. Keys are unique in a version.

        One exchange, on the key."""
        columns = columns or sorted(set(self.read(before).columns) & set(self.read(after).columns) - {key})
        sides = [self.read(v).select(key, F.struct(*columns).alias("row"), F.lit(v == after).alias("new")) for v in (before, after)]
        of = lambda new: F.max(F.when(F.col("new") == new, F.struct("row")))
        both = sides[0].unionByName(sides[1]).groupBy(key).agg(of(False).alias("b"), of(True).alias("a"))
        change = F.when(F.col("b").isNull(), "inserted").when(F.col("a").isNull(), "deleted").when(~F.col("a.row").eqNullSafe(F.col("b.row")), "changed")
        return both.select(key, change.alias("change")).where(F.col("change").isNotNull())

    def vacuum(self, keep_days: float, now: dt.datetime | None = None, grace_hours: float = GRACE_HOURS) -> list[int]:
        """Remove the versions that were superseded more than ``keep_days`` ago, with their records, and
        every folder that no remaining version names and in which nothing was written for
        ``grace_hours``: what writers left that died before their record. A version counts from when the
        next one was committed, so what was current within the time can be restored. Returns the removed
        versions."""
        hist = [(r["version"], r["committed_at"]) for r in self.history().orderBy("version").collect()]
        cutoff = (now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) - dt.timedelta(days=keep_days)
        gone = [v for (v, _), (_, until) in zip(hist, hist[1:]) if until < cutoff]
        named = {v: self.folder(v).rsplit("/", 1)[-1] for v, _ in hist}
        kept = {named[v] for v, _ in hist if v not in gone}
        for v in gone:
            if named[v] not in kept:
                remove_path(self.spark, f"{self.path}/{named[v]}")
            remove_path(self.spark, f"{self.history_path}/v{v:020d}.json")
        idle = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(hours=grace_hours)
        for name in list_children(self.spark, self.path):
            if name.startswith("data-") and name not in kept and last_change(self.spark, f"{self.path}/{name}") < idle:
                remove_path(self.spark, f"{self.path}/{name}")
        return gone


# ------------------------------------------------------------------------------- exports, audit
def export_path(root: str, table: str, run_date: str) -> str:
    return f"{root}/_exports/{table}/run_date={run_date}"


def append_audit(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Append audit rows (run_date, table_name, row_count, started_at, finished_at), one record file each."""
    names = [f.split()[0] for f in AUDIT_DDL.split(", ")]
    for row in rows:
        rec = {k: (v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v) for k, v in zip(names, row)}
        write_record(spark, f"{path}/{rec['run_date']}-{rec['table_name']}-{uuid.uuid4().hex[:12]}.json", rec)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_DDL).json(path)
