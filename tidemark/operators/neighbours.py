"""Previous and next row in an order, by many tasks whatever the groups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows drawn for each stretch to tell where it begins.
DRAWN = 40


def _literal(value: Any, kind: T.DataType) -> Column:
    """A value that was collected, as a column of its type."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.array(*[_literal(v, kind.elementType) for v in value]).cast(kind)
    if isinstance(value, datetime) and isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(" ")).cast(kind)
    return F.lit(bytes(value) if isinstance(value, bytearray) else value).cast(kind)


def _place(columns: Sequence[str], group: Sequence[str]) -> Column:
    """The place of a row in the order of all: groups first, then values with null last."""
    parts = [F.col(g).alias(f"g{n}") for n, g in enumerate(group)]
    for n, c in enumerate(columns):
        parts += [F.col(c).isNull().alias(f"n{n}"), F.col(c).alias(f"v{n}")]
    return F.struct(*parts)


def _stretch(place: Column, bounds: list[Column]) -> Column:
    """How many of the rising bounds a place has reached, by halving."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(place >= bounds[middle], within(middle + 1, high)).otherwise(within(low, middle))

    return within(0, len(bounds))


def beside(
    df: DataFrame, group: Sequence[str], order: Sequence[str], drawn_from: DataFrame | None = None
) -> DataFrame:
    """Add ``before`` and ``after``: the order columns of the rows next to each within its group.

    ``df`` holds each (group, order) once; nulls come last. Rows are dealt to stretches of one
    order over all groups, whose bounds come from a sample of the places themselves, so neither the
    type nor the spread of the values nor the size of a group matters. A stretch is sorted by one
    task and gets one row from each of its neighbours, the last and the first of theirs. Bounds are
    fixed before the rows are dealt, so a task that runs again finds the same stretches. ``drawn_from``
    may hold the same rows before they were made distinct, so that the sample needs no shuffle.
    """
    stretches = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = _place(order, group)
    source = df if drawn_from is None else drawn_from
    sample = source.select(place.alias("p")).orderBy(F.rand(7)).limit(DRAWN * stretches)
    drawn = sample.groupBy("p").count().orderBy("p").collect()
    kind = sample.schema["p"].dataType
    step = max(len(drawn) // stretches, 1)
    bounds = [_literal(r["p"], kind) for r in drawn[step::step]]
    rows = df.withColumn("__place", place)
    rows = rows.withColumn("__stretch", _stretch(F.col("__place"), bounds))
    # It asks for all columns, so that both uses of the rows read one shuffle.
    every = F.max(F.xxhash64(*df.columns)).alias("every")
    edges = rows.groupBy("__stretch").agg(F.min("__place").alias("low"), F.max("__place").alias("high"), every)
    # One row for each stretch.
    along = Window.orderBy("__stretch")
    last_before = F.when(F.col("every").isNotNull(), F.lag("high").over(along))
    edges = edges.select("__stretch", last_before.alias("__before"), F.lead("low").over(along).alias("__after"))
    # The order of the places, by plain columns: these sort faster than a struct.
    rising = [F.col(g).asc_nulls_first() for g in group] + [F.col(c).asc_nulls_last() for c in order]
    within = Window.partitionBy("__stretch").orderBy(*rising)
    rows = rows.join(F.broadcast(edges), "__stretch")
    near = {
        "__before": F.coalesce(F.lag("__place").over(within), F.col("__before")),
        "__after": F.coalesce(F.lead("__place").over(within), F.col("__after")),
    }
    rows = rows.withColumns(near)

    def in_group(side: str) -> Column:
        same = F.lit(True)
        for n, g in enumerate(group):
            same = same & F.col(f"{side}.g{n}").eqNullSafe(F.col(g))
        values = F.struct(*[F.col(f"{side}.v{n}").alias(c) for n, c in enumerate(order)])
        return F.when(F.col(side).isNotNull() & same, values)

    return rows.select(*df.columns, in_group("__before").alias("before"), in_group("__after").alias("after"))


def with_neighbours(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Add ``previous_value``, ``next_value`` and ``has_next``; ``df`` holds each value once per group."""
    return beside(df, group, [value]).select(
        *df.columns,
        F.col("before")[value].alias("previous_value"),
        F.col("after")[value].alias("next_value"),
        F.col("after").isNotNull().alias("has_next"),
    )


def repeat_rows(df: DataFrame, copies: str, chunk: int = 10_000) -> DataFrame:
    """Each row as often as ``copies`` says.

    Copies are made in chunks, and the chunks are spread over all tasks first, so one
    row with very many copies neither needs a long array nor keeps one task busy.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = F.col(copies).cast("bigint")
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / chunk).cast("bigint"))
    per_chunk = F.least(F.lit(chunk).cast("bigint"), n - F.col("__chunk") * chunk)
    return (
        df.filter(n > 0)
        .withColumn("__chunk", F.explode(chunks))
        .repartition(tasks, *df.columns, "__chunk")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), per_chunk)))
        .drop("__chunk", "__copy", copies)
    )
