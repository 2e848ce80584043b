"""Declarative description of a warehouse entity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the technical columns.
BATCH_ID = "etl_batch_id"
CREATED_AT = "bi_created_at"
UPDATED_AT = "bi_updated_at"
SOURCE_UPDATED_AT = "source_updated_at"
EXTRACTED_AT = "airbyte_extracted_at"
LANDING_EXTRACTED_AT = "_airbyte_extracted_at"

# Stand-ins for null when two versions of a row are compared.
TEXT_SENTINEL = ""
NUMBER_SENTINEL = -999
FLAG_SENTINEL = False
TIME_SENTINEL = datetime(1900, 1, 1)

# Contents of the unknown-member row.
UNKNOWN_KEY = -1
UNDEFINED = "UNDEFINED"

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def data_type(name: str) -> T.DataType:
    """A declared type; unlike the DDL parser this needs no running session."""
    if name.startswith("decimal("):
        precision, scale = name[len("decimal(") : -1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _TYPES[name]


def struct_type(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, data_type(t), True) for n, t in columns.items()])


TECHNICAL_TYPES = {
    BATCH_ID: "string",
    CREATED_AT: "timestamp_ntz",
    UPDATED_AT: "timestamp_ntz",
    SOURCE_UPDATED_AT: "timestamp_ntz",
    EXTRACTED_AT: "timestamp_ntz",
}


@dataclass(frozen=True)
class Column:
    """One business column.

    ``source`` is its name in the landing data when that differs, ``length`` cuts
    text, ``upper`` applies on the way into the dimension, ``unknown`` fills the
    unknown-member row, and a ``silent`` column is compared but leaves the update
    time alone.
    """

    name: str
    type: str = "string"
    source: str | None = None
    length: int | None = None
    upper: bool = False
    unknown: Any = None
    silent: bool = False


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: tuple[str, ...]
    columns: tuple[Column, ...]
    surrogate_key: str | None = None
    pipeline: str = ""
    # Also compare source and extract time, so a re-extracted row counts as changed.
    compare_technical: bool = True
    # Null and its stand-in count as equal unless this is set.
    null_safe: bool = False
    # The dimension keeps the earliest created time it has seen.
    keep_first_created: bool = True
    # The source has no update time, so every extract reads all of it.
    full_extract: bool = False
    # Rows whose key has a null part are stored like any other, as new ones every time;
    # unless this is set they go to the quarantine.
    keep_null_keys: bool = False
    # A row that is older than the stored one of its key, by source and extract time, is late and
    # changes nothing, so the order in which batches arrive does not matter. Unless this is set
    # the row that arrives last stays, as in the source system.
    keep_newest: bool = False
    # Keys that must not be in the dimension.
    dropped_keys: tuple[Any, ...] = ()
    # Least number of files of a full write of the stored tables.
    parts: int | None = None

    def __post_init__(self) -> None:
        names = {c.name for c in self.columns}
        missing = [k for k in self.key if k not in names]
        if missing:
            raise ValueError(f"{self.name}: key columns {missing} are not declared")

    @property
    def pipeline_name(self) -> str:
        return self.pipeline or f"dim_{self.name}"

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def attributes(self) -> list[Column]:
        return [c for c in self.columns if c.name not in self.key]

    @property
    def dimension_columns(self) -> list[str]:
        lead = [self.surrogate_key] if self.surrogate_key else []
        return lead + self.names + [BATCH_ID, CREATED_AT, UPDATED_AT]

    def schema(self, names: list[str]) -> T.StructType:
        types = {c.name: c.type for c in self.columns} | TECHNICAL_TYPES
        if self.surrogate_key:
            types[self.surrogate_key] = "bigint"
        return struct_type({n: types[n] for n in names})

    @property
    def dimension_schema(self) -> T.StructType:
        return self.schema(self.dimension_columns)


def sentinel_for(type_name: str) -> SparkColumn:
    """The value that stands for null in comparisons of this type."""
    kind = type_name.lower().split("(")[0].strip()
    if kind in ("string", "varchar", "char"):
        return F.lit(TEXT_SENTINEL)
    if kind == "boolean":
        return F.lit(FLAG_SENTINEL)
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.lit(TIME_SENTINEL).cast(type_name)
    return F.lit(NUMBER_SENTINEL).cast(type_name)


def typed(column: Column, source: SparkColumn) -> SparkColumn:
    value = source.cast(column.type)
    # A cast to varchar(n) does not cut text in Spark.
    return F.substring(value, 1, column.length) if column.length else value


def conform_landing(df: DataFrame, spec: EntitySpec, more: Sequence[str] = ()) -> DataFrame:
    """Select, rename and strictly cast landing data to the entity's contract, and ``more`` as it is."""
    return df.select(
        *[typed(c, F.col(c.source or c.name)).alias(c.name) for c in spec.columns],
        F.col(SOURCE_UPDATED_AT).cast("timestamp_ntz").alias(SOURCE_UPDATED_AT),
        F.col(LANDING_EXTRACTED_AT).cast("timestamp_ntz").alias(EXTRACTED_AT),
        *more,
    )


def conform_current_state(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Re-apply the contract to stored current-state rows."""
    return df.select(
        *[typed(c, F.col(c.name)).alias(c.name) for c in spec.columns],
        *[F.col(n).cast(t).alias(n) for n, t in TECHNICAL_TYPES.items()],
    )
