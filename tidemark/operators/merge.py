"""Merge by key and schema alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give ``df`` exactly these columns: missing ones become null, others are dropped."""
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (
                F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None)
            ).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``changes`` replace or extend ``target``; nothing is deleted.

    The result has the columns of ``changes``.
    """
    untouched = target.join(changes.select(*keys), list(keys), "left_anti")
    return align(untouched, changes.schema).unionByName(changes)


def merge_into(table: str, changes: DataFrame, keys: Sequence[str]) -> None:
    """The same merge for a catalog table whose format supports row-level updates."""
    on = [F.col(f"{table}.{k}") == F.col(f"changes.{k}") for k in keys]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    (
        changes.alias("changes")
        .mergeInto(table, condition)
        .withSchemaEvolution()
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
