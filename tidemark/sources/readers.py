"""Reading tables, seeds and catalog relations."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.relations import union_unlike


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_table(spark: SparkSession, name: str, options: dict[str, Any]) -> DataFrame:
    """An operational table; ``partitionColumn`` and its bounds spread the read."""
    return spark.read.format("jdbc").options(dbtable=name, **options).load()


def pruned(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def changed_since(df: DataFrame, cursor: str, last: datetime | None) -> DataFrame:
    """Rows past the last extracted cursor; without a cursor value the whole source."""
    if last is None:
        return df
    return df.filter(F.col(cursor) > F.lit(last).cast("timestamp_ntz"))


def read_seed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A CSV with a header and a declared schema; an empty field is null."""
    reader = spark.read.option("timestampNTZFormat", "yyyy-MM-dd[ HH:mm[:ss[.SSSSSS]]]")
    return reader.csv(
        path,
        schema=schema,
        header=True,
        enforceSchema=True,
        nullValue="",
        encoding="UTF-8",
        mode="FAILFAST",
    )


def _like(pattern: str) -> re.Pattern[str]:
    parts = [{"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in pattern]
    return re.compile("".join(parts), re.IGNORECASE | re.DOTALL)


def matching_tables(
    spark: SparkSession,
    table_pattern: str,
    exclude: str = "",
    database_pattern: str | None = None,
) -> list[str]:
    """Names of catalog tables and views that match a SQL ``like`` pattern."""
    wanted, unwanted = _like(table_pattern), _like(exclude)
    if database_pattern is None:
        databases = [spark.catalog.currentDatabase()]
    else:
        found = [d.name for d in spark.catalog.listDatabases()]
        databases = [d for d in found if _like(database_pattern).fullmatch(d)]
    names: list[str] = []
    for database in databases:
        for entry in spark.catalog.listTables(database):
            if wanted.fullmatch(entry.name) and not unwanted.fullmatch(entry.name):
                name = entry.name if not entry.namespace else f"{entry.namespace[-1]}.{entry.name}"
                names.append(name)
    return sorted(set(names))


def tables_with_prefix(
    spark: SparkSession, prefix: str, exclude: str = "", database_pattern: str | None = None
) -> list[str]:
    return matching_tables(spark, f"{prefix}%", exclude, database_pattern)


def union_matching(
    spark: SparkSession,
    table_pattern: str,
    exclude: str = "",
    database_pattern: str | None = None,
    **options: Any,
) -> DataFrame | None:
    """Union of every matching relation, or None when nothing matches."""
    names = matching_tables(spark, table_pattern, exclude, database_pattern)
    if not names:
        return None
    return union_unlike({n: spark.table(n) for n in names}, **options)
