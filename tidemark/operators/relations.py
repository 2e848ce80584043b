"""Transforms of whole relations: union, unpivot, pivot, star, calendars, frequent values."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fold(names: Sequence[str] | None) -> set[str]:
    return {n.lower() for n in names or ()}


def union_unlike(
    relations: Mapping[str, DataFrame],
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    types: Mapping[str, str] | None = None,
    label: str | None = "source_relation",
    where: str | None = None,
) -> DataFrame:
    """Stack relations with different columns; a column a relation lacks is null there.

    Columns come in order of first appearance and take the type of the first relation
    that has them, unless ``types`` names another.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    wanted, unwanted = _fold(include), _fold(exclude)
    target: dict[str, str] = {}
    for df in relations.values():
        for f in df.schema.fields:
            name = f.name.lower()
            if (unwanted and name in unwanted) or (wanted and name not in wanted):
                continue
            target.setdefault(f.name, (types or {}).get(f.name, f.dataType.simpleString()))
    if not target:
        raise ValueError("no columns left to union")
    result: DataFrame | None = None
    for name, df in relations.items():
        rows = df.filter(where) if where else df
        columns = [
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
            for c, t in target.items()
        ]
        if label is not None:
            columns.insert(0, F.lit(name).alias(label))
        part = rows.select(*columns)
        result = part if result is None else result.unionByName(part)
    assert result is not None
    return result


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per input row and melted column; null values are kept."""
    kept, gone = _fold(exclude), _fold(remove)
    ids = [c for c in df.columns if c.lower() in kept]
    melted = [c for c in df.columns if c.lower() not in kept | gone]
    if not melted:
        raise ValueError("no columns left to unpivot")
    flags = {f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)}

    def value(c: str) -> Column:
        # A boolean goes through its text form before the cast.
        source = F.col(c).cast("string") if c in flags else F.col(c)
        return source.cast(cast_to)

    return df.select(*ids, *[value(c).alias(c) for c in melted]).unpivot(
        ids, melted, field_name, value_name
    )


def slug(text: str) -> str:
    """A plain column name: lower case, underscores, no leading digit."""
    if not text:
        return ""
    name = re.sub(r"[ -]+", "_", text.lower())
    name = re.sub(r"[^a-z0-9_]+", "", name)
    return f"_{name}" if name[:1].isdigit() else name


_COMPARISONS = {
    "=": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}
_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}


def pivot_columns(
    column: str,
    values: Sequence[Any],
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Any = 1,
    else_value: Any = 0,
    distinct: bool = False,
    plain_names: bool = False,
) -> list[Column]:
    """One conditional aggregate per value; a missing combination gives ``else_value``."""
    result = []
    for value in values:
        name = f"{prefix}{value}{suffix}"
        chosen = then_value if isinstance(then_value, Column) else F.lit(then_value)
        other = else_value if isinstance(else_value, Column) else F.lit(else_value)
        picked = F.when(_COMPARISONS[cmp](F.col(column), F.lit(value)), chosen).otherwise(other)
        if distinct:
            aggregate = F.sum_distinct(picked) if agg == "sum" else F.count_distinct(picked)
            if agg not in ("sum", "count"):
                aggregate = _AGGREGATES[agg](picked)
        else:
            aggregate = _AGGREGATES[agg](picked)
        result.append(aggregate.alias(slug(name) if plain_names else name))
    return result


def pivot(df: DataFrame, group: Sequence[str], column: str, values: Sequence[Any], **options: Any):
    return df.groupBy(*group).agg(*pivot_columns(column, values, **options))


def value_counts(
    df: DataFrame,
    column: str,
    where: str | None = None,
    max_records: int | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Values of a column with their counts, most frequent first; null is a value."""
    rows = df.filter(where) if where else df
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))
    ranked = counted.orderBy(*(order or (F.col("n_rows").desc(), F.col("value").asc())))
    return ranked.limit(max_records) if max_records is not None else ranked


def column_values(
    spark: SparkSession,
    relation: str | DataFrame,
    column: str,
    max_records: int | None = None,
    where: str | None = None,
    default: list[Any] | None = None,
    order: Sequence[Column] | None = None,
) -> list[Any] | None:
    """Values of a column as a list, for use as pivot columns.

    A missing relation gives ``default``, or an error without one. A list longer than
    ``spark.sql.pivotMaxValues`` is refused rather than collected.
    """
    if isinstance(relation, str):
        if not spark.catalog.tableExists(relation):
            if default is None:
                raise ValueError(f"{relation} does not exist and no default was given")
            return default
        relation = spark.table(relation)
    bound = int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))
    wanted = min(max_records, bound + 1) if max_records is not None else bound + 1
    rows = value_counts(relation, column, where, wanted, order).collect()
    if len(rows) > bound:
        raise ValueError(f"{column} has more than {bound} values")
    return [r["value"] for r in rows] or default


def star(
    df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = ""
) -> list[Column]:
    """The columns of ``df`` without the excluded ones, renamed with prefix and suffix."""
    gone = _fold(exclude)
    columns = [F.col(c).alias(f"{prefix}{c}{suffix}") for c in df.columns if c.lower() not in gone]
    if not columns:
        raise ValueError("every column is excluded")
    return columns


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become null in every text column; others stay."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    if upper_bound <= 0:
        raise ValueError("the upper bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def boundaries_between(part: str, start: Column, end: Column) -> Column:
    """How many boundaries of ``part`` lie between two times (23:59 to 00:01 is one day)."""
    return F.timestamp_diff(
        part.upper(), F.date_trunc(part, start), F.date_trunc(part, end)
    )


def date_spine(
    spark: SparkSession, part: str, start: date | datetime, end: date | datetime
) -> DataFrame:
    """One row per ``part`` from ``start`` up to, and without, ``end``; at most 2^31 - 1 parts."""
    kind = "timestamp_ntz" if isinstance(start, datetime) else "date"
    first, last = (F.lit(v).cast("timestamp_ntz") for v in (start, end))
    span = spark.range(1).select(boundaries_between(part, first, last)).first()[0]
    if span <= 0:
        raise ValueError("the end must lie after the start")
    name = f"date_{part.lower()}"
    moments = F.timestamp_add(part.upper(), F.col("id").cast("int"), first).cast(kind)
    return spark.range(span).select(moments.alias(name)).filter(F.col(name) <= F.lit(end))
