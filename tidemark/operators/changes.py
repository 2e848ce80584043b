"""Changed-or-new detection between a source slice and the current state."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import (
    BATCH_ID,
    CREATED_AT,
    EXTRACTED_AT,
    SOURCE_UPDATED_AT,
    TECHNICAL_TYPES,
    UPDATED_AT,
    EntitySpec,
    sentinel_for,
)

_OLD = "__old_"


def split_null_keys(df: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and rows to set aside because a key part is null."""
    incomplete = reduce(or_, [F.col(k).isNull() for k in keys])
    return df.filter(~incomplete), df.filter(incomplete)


def differs(name: str, type_name: str, null_safe: bool) -> Column:
    new, old = F.col(name), F.col(_OLD + name)
    if null_safe:
        return ~new.eqNullSafe(old)
    stand_in = sentinel_for(type_name)
    return F.coalesce(old, stand_in) != F.coalesce(new, stand_in)


def changed_or_new(
    latest: DataFrame,
    target: DataFrame | None,
    spec: EntitySpec,
    run_ts: datetime,
    batch_id: str,
) -> DataFrame:
    """Rows of ``latest`` that are new or differ from ``target``, stamped for the run.

    ``latest`` and ``target`` hold one row per key; rows with an incomplete key are
    expected to have been set aside before.
    """
    now = F.lit(run_ts).cast("timestamp_ntz")
    stamped = F.lit(batch_id).alias(BATCH_ID)
    if target is None:
        return latest.select(
            *spec.names,
            stamped,
            now.alias(CREATED_AT),
            now.alias(UPDATED_AT),
            SOURCE_UPDATED_AT,
            EXTRACTED_AT,
        )

    compared = [(c.name, c.type, c.silent) for c in spec.attributes]
    if spec.compare_technical:
        compared += [(n, TECHNICAL_TYPES[n], False) for n in (SOURCE_UPDATED_AT, EXTRACTED_AT)]
    kept = [n for n, _, _ in compared] + [CREATED_AT, UPDATED_AT]
    # As the latest landing row is chosen: times first, then the other columns.
    newest = [SOURCE_UPDATED_AT, EXTRACTED_AT, *[c.name for c in spec.attributes]]
    if spec.keep_newest:
        kept += [n for n in newest if n not in kept]
    old = target.select(
        *spec.key, *[F.col(n).alias(_OLD + n) for n in kept], F.lit(True).alias(_OLD)
    )

    is_new = F.col(_OLD).isNull()
    tests = [(differs(n, t, spec.null_safe), silent) for n, t, silent in compared]
    moved = reduce(or_, [test for test, silent in tests if not silent], is_new)
    selected = reduce(or_, [test for test, _ in tests], is_new)
    if spec.keep_newest:
        new_row, old_row = F.struct(*newest), F.struct(*[F.col(_OLD + n).alias(n) for n in newest])
        selected = selected & (is_new | (new_row > old_row))

    return (
        latest.join(old, list(spec.key), "left")
        .filter(selected)
        .select(
            *spec.names,
            stamped,
            F.coalesce(F.col(_OLD + CREATED_AT), now).alias(CREATED_AT),
            F.when(moved, now).otherwise(F.col(_OLD + UPDATED_AT)).alias(UPDATED_AT),
            SOURCE_UPDATED_AT,
            EXTRACTED_AT,
        )
    )
