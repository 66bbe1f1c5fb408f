"""Conformance: project any landed frame onto an entity contract (P1–P5) and staging casts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.contracts import CORRUPT_COLUMN, METADATA_COLUMNS, TEXT_CASE, Entity


#: SQL of a landed column ``c`` by target type; other types only go through ``try_cast``.
TYPED = {"string": "nullif({case}(trim(try_cast({c} AS string))), '')"}


def conform(df: DataFrame, entity: Entity) -> DataFrame:
    """The frame under the entity's contract: its columns, order and types, then the bookkeeping
    columns that the frame has.

    Text is trimmed and cased as ``TEXT_CASE`` says, and blank text is NULL; what does not parse is
    NULL and left to the rules; a contract column that was not delivered is NULL; others are dropped.
    """
    delivered = {f.name for f in df.schema.fields}
    absent = [f for f in entity.schema().fields if f.name not in delivered]
    whole = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    kept = [f"`{c}`" for c in (*METADATA_COLUMNS, CORRUPT_COLUMN) if c in delivered]
    typed = [
        TYPED.get(kind, f"try_cast({{c}} AS {kind})").format(c=f"`{c}`", case=TEXT_CASE.get(c, "")) + f" AS `{c}`"
        for c, kind in entity.columns
    ]
    return whole.selectExpr(*typed, *kept)


def contract_cast(df: DataFrame, contract: str | StructType) -> DataFrame:
    """Enforce a serving contract: exact column set, contract order, contract types.

    Raises ``ValueError`` naming the missing/unexpected columns instead of loading a table whose
    columns would be matched by position to the wrong targets.
    """
    schema = StructType.fromDDL(contract) if isinstance(contract, str) else contract
    want = [f.name for f in schema.fields]
    missing = [c for c in want if c not in df.columns]
    extra = [c for c in df.columns if c not in want]
    if missing or extra:
        raise ValueError(f"contract mismatch: missing={missing} unexpected={extra}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
