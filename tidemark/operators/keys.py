"""Allocation of surrogate keys across tasks."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shuffles_freed

KEY_LANES = 4096


def lane(keys: Sequence[str], lanes: int = KEY_LANES) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(lanes))


def allocate_missing_keys(
    df: DataFrame,
    key_column: str,
    natural_key: Sequence[str],
    highest: int,
    lanes: int = KEY_LANES,
) -> DataFrame:
    """Fill null surrogate keys with the values that follow ``highest``, without gaps.

    Rows that have a key pass untouched. New ones are dealt to a fixed number of lanes by a hash
    of their natural key; the rows of each lane are counted, and the running sum of the counts is
    where a lane begins, so each lane numbers its own rows in natural-key order. No task sees
    more than its lanes. The values depend on the new natural keys alone, so a task that is run
    again hands out the same ones.
    """
    counts = _new_rows(df, key_column, natural_key, lanes).groupBy("__lane").agg(F.count("*").alias("__n"))
    # One row for each lane.
    before = Window.orderBy("__lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__lane", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return _numbered(df, key_column, natural_key, highest, starts, lanes)


def allocate_in_slices(
    df: DataFrame,
    key_column: str,
    natural_key: Sequence[str],
    highest: int,
    cuts: Sequence[Column],
    lanes: int = KEY_LANES,
) -> list[DataFrame]:
    """The rows of each slice, with the surrogate keys that ``allocate_missing_keys`` gives to all of them.

    ``cuts`` are conditions on the natural key that part the rows, in its order. The new rows
    are counted by lane and slice in one pass over the natural keys, so that each slice can be made
    by itself: a lane goes on where the slices before have left it.
    """
    spark = df.sparkSession
    with shuffles_freed(spark):
        new = _new_rows(df, key_column, natural_key, lanes)
        in_slice = [F.count_if(cut).alias(f"__{i}") for i, cut in enumerate(cuts)]
        # At most one row for each lane.
        counts = sorted(new.groupBy("__lane").agg(*in_slice).collect())
    start, starts = 0, [[] for _ in cuts]
    for _, *found in counts:
        for of_slice, n in zip(starts, found):
            of_slice.append(start)
            start += n
    columns = pa.schema([("__lane", pa.int64()), ("__start", pa.int64())])
    each = [pa.table([[c[0] for c in counts], of_slice], schema=columns) for of_slice in starts]
    return [
        _numbered(df.filter(cut), key_column, natural_key, highest, spark.createDataFrame(t), lanes)
        for cut, t in zip(cuts, each)
    ]


def _new_rows(df: DataFrame, key_column: str, natural_key: Sequence[str], lanes: int) -> DataFrame:
    return df.filter(F.col(key_column).isNull()).withColumn("__lane", lane(natural_key, lanes))


def _numbered(
    df: DataFrame, key_column: str, natural_key: Sequence[str], highest: int, starts: DataFrame, lanes: int
) -> DataFrame:
    """Number the new rows of each lane on from where it starts."""
    new = _new_rows(df, key_column, natural_key, lanes)
    position = F.row_number().over(Window.partitionBy("__lane").orderBy(*natural_key))
    numbered = new.withColumn("__position", position).join(F.broadcast(starts), "__lane")
    fresh = (F.lit(highest) + F.col("__start") + F.col("__position")).cast("bigint")
    key = F.col(key_column).cast("bigint").alias(key_column)
    return (
        df.filter(F.col(key_column).isNotNull())
        .withColumn(key_column, key)
        .unionByName(numbered.withColumn(key_column, fresh).select(*df.columns))
    )


def highest_key(df: DataFrame, key_column: str) -> int:
    """The largest key in use, never below zero."""
    value = df.agg(F.max(key_column)).first()[0]
    return max(int(value), 0) if value is not None else 0
