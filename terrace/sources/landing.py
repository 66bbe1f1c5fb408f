"""Landed extracts: Parquet / JSON Lines per entity and day, API envelopes, relational tables."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from terrace.contracts import Entity

log = logging.getLogger(__name__)


def landing_path(root: str, source: str, entity: str, run_date: str) -> str:
    return f"{root}/{source}/{entity}/ingest_date={run_date}"


def _missing_path(exc: AnalysisException) -> bool:
    return exc.getCondition() == "PATH_NOT_FOUND"


EXTRA_FIELDS = "_extra_fields"


def json_records(lines: DataFrame, entity: Entity) -> DataFrame:
    """Landed JSON lines (column ``value``) as the contract's columns in text form.

    Fields outside the contract stay with the row in the map ``_extra_fields``, nested ones as JSON, so
    a field that the source adds is in bronze from its first day. A line that is no JSON object is kept
    whole in ``_corrupt_record`` with all else NULL. One pass, no schema inference.
    """
    known = F.array(*[F.lit(c) for c in entity.column_names])
    fields = lines.where(F.trim("value") != "").withColumn("f", F.from_json("value", "map<string,string>"))
    extra = F.map_filter("f", lambda k, _: ~F.array_contains(known, k))
    return fields.select(
        *[F.col("f").getItem(c).alias(c) for c in entity.column_names],
        F.when(F.size(extra) > 0, extra).alias(EXTRA_FIELDS),
        F.when(F.col("f").isNull(), F.col("value")).alias("_corrupt_record"),
        "_source_file",
    )


def read_landing(spark: SparkSession, path: str, entity: Entity) -> DataFrame | None:
    """One landed extract, or ``None`` where the day brought none. Every column that the source sent is
    kept (JSON: see ``json_records``); ``_source_file`` is the file a row came from."""
    reader = spark.read.format("text" if entity.file_format == "json" else entity.file_format)
    try:
        landed = reader.load(path).withColumn("_source_file", F.col("_metadata.file_path"))
    except AnalysisException as exc:
        if not _missing_path(exc):
            raise
        log.warning("%s: nothing landed under %s", entity.name, path)
        return None
    return json_records(landed, entity) if entity.file_format == "json" else landed


def parse_json_column(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Parse a JSON text column with a fixed schema; fields of malformed text come back NULL."""
    parsed = F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"})
    names = [f.split()[0].strip("`") for f in schema.split(",")]
    return df.withColumn("_json", parsed).select("*", *[F.col(f"_json.`{n}`").alias(n) for n in names]).drop("_json")


def to_envelopes(rows: DataFrame, page_of: Column, next_url: str = "page") -> DataFrame:
    """Group rows into API-style pages ``{"data": [...], "paging": {"next": ...}}`` as JSON text.

    ``page_of`` must bound the page size (the feed pages 500 rows), so each group stays small.
    """
    pages = rows.groupBy(page_of.alias("page")).agg(F.collect_list(F.struct(*rows.columns)).alias("data"))
    nxt = F.concat(F.lit(f"{next_url}="), (F.col("page") + 1).cast("string"))
    return pages.select("page", F.to_json(F.struct("data", F.struct(nxt.alias("next")).alias("paging"))).alias("body"))


def _envelope(row_schema: StructType) -> StructType:
    return StructType().add("data", ArrayType(row_schema)).add("paging", StructType().add("next", StringType()))


def flatten_envelopes(pages: DataFrame, row_schema: StructType, body: str = "body") -> DataFrame:
    """Rows from the collection at ``$.data`` of each envelope (``inline`` of the parsed array)."""
    return pages.select(F.from_json(F.col(body), _envelope(row_schema)).alias("_e")).select(F.inline("_e.data"))


def read_envelope_files(spark: SparkSession, path: str, row_schema: StructType) -> DataFrame:
    """Landed envelope files (one JSON document per file) flattened to rows."""
    return spark.read.option("multiLine", True).schema(_envelope(row_schema)).json(path).select(F.inline("data"))


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 4,
    properties: dict | None = None,
) -> DataFrame:
    """Full extract of a relational table, split into ``partitions`` range reads when a numeric
    column and its bounds are given (parallel reads instead of one connection for the whole table)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
        )
    return reader.load()
