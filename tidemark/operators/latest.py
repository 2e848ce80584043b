"""One row per key: the latest by an ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.spec import BATCH_ID, EXTRACTED_AT, SOURCE_UPDATED_AT, UPDATED_AT

_RANK = "__rank"
_BEST = "__best"


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    tie_break: bool = True,
) -> DataFrame:
    """Keep the first row per key under any ``order``.

    The remaining columns break ties, so the answer does not depend on how rows are
    laid out. Spark ranks inside each input task first and ships at most one row per
    key and task, which also keeps a hot key from piling up in one task.
    """
    rest = [c for c in df.columns if c not in set(keys)] if tie_break else []
    window = Window.partitionBy(*keys).orderBy(
        *order, *[F.col(c).desc_nulls_last() for c in rest]
    )
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def _largest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the largest order, then the largest other columns, per key.

    One grouped maximum over a row struct: rows combine in each input task, and it
    needs no ranking. Nulls compare as smallest inside a struct.
    """
    rest = [c for c in df.columns if c not in set(keys)]
    ranked = F.struct(F.struct(*order).alias("by"), F.struct(*rest).alias("row"))
    best = df.groupBy(*keys).agg(F.max(ranked).alias(_BEST))
    return best.select(*keys, f"{_BEST}.row.*").select(*df.columns)


def latest_in_landing(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest landing row per key; a missing time counts as oldest."""
    return _largest(df, keys, [F.col(SOURCE_UPDATED_AT), F.col(EXTRACTED_AT)])


def latest_in_staging(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest current-state row per key; a missing time counts as newest."""
    ranks = [(F.col(c).isNull(), F.col(c)) for c in (UPDATED_AT, BATCH_ID)]
    return _largest(df, keys, [part for rank in ranks for part in rank])


def latest_source_row(df: DataFrame, keys: Sequence[str], *times: str) -> DataFrame:
    """Latest operational row per key by one or more update times, nulls oldest."""
    return _largest(df, keys, [F.col(t) for t in times])


def any_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key from a source without an update time, always the same one."""
    return _largest(df, keys, [F.lit(0)])
