"""Current state to dimension: watermark slice, stable surrogate keys, unknown member."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import allocate_in_slices, allocate_missing_keys, highest_key
from tidemark.operators.merge import upsert
from tidemark.plans.current_state import newer_rows, staging_slice, staging_view
from tidemark.sources.tables import KeyedTable, Slices
from tidemark.spec import (
    BATCH_ID,
    CREATED_AT,
    TIME_SENTINEL,
    UNKNOWN_KEY,
    UPDATED_AT,
    EntitySpec,
    conform_current_state,
)


def watermark_slice(staged: DataFrame, watermark: datetime | None) -> DataFrame:
    """Rows updated strictly after the watermark; the bound is a literal the scan can use."""
    return staged.filter(F.col(UPDATED_AT) > F.lit(watermark or TIME_SENTINEL).cast("timestamp_ntz"))


def unknown_member(
    spark: SparkSession, spec: EntitySpec, run_ts: datetime, batch_id: str
) -> DataFrame:
    """The row facts point at when a dimension row is missing."""
    values = {c.name: c.unknown for c in spec.columns}
    values |= {BATCH_ID: batch_id, CREATED_AT: run_ts, UPDATED_AT: run_ts}
    values[spec.surrogate_key] = UNKNOWN_KEY
    return spark.range(1).select(
        *[
            F.lit(values[f.name]).cast(f.dataType).alias(f.name)
            for f in spec.dimension_schema.fields
        ]
    )


def _stored(spec: EntitySpec, name: str) -> Column:
    """A business column as the dimension stores it."""
    upper = any(c.upper for c in spec.columns if c.name == name)
    return (F.upper(name) if upper else F.col(name)).alias(name)


def dimension_rows(
    spec: EntitySpec,
    slice_: DataFrame,
    dimension: DataFrame | None,
    highest: int = 0,
) -> DataFrame:
    """The slice in dimension form; known natural keys keep their surrogate key."""
    rows = _with_known_keys(spec, slice_, dimension)
    if spec.surrogate_key:
        rows = allocate_missing_keys(rows, spec.surrogate_key, spec.key, highest)
    return rows.select(*spec.dimension_columns)


def _with_known_keys(spec: EntitySpec, slice_: DataFrame, dimension: DataFrame | None) -> DataFrame:
    """The slice in dimension form; the surrogate key of a new natural key is null."""
    rows = slice_.select(
        *[_stored(spec, c.name) for c in spec.columns],
        BATCH_ID,
        CREATED_AT,
        UPDATED_AT,
    )
    sk = spec.surrogate_key
    if dimension is not None and (sk or spec.keep_first_created):
        known = dimension.select(
            *([sk] if sk else []), *spec.key, F.col(CREATED_AT).alias("__first_created")
        )
        rows = rows.join(known, list(spec.key), "left")
        if spec.keep_first_created:
            rows = rows.withColumn(CREATED_AT, F.least(CREATED_AT, "__first_created"))
    elif sk:
        rows = rows.withColumn(sk, F.lit(None).cast("bigint"))
    return rows.select(*spec.dimension_columns)


WATERMARK = "watermark"
SURROGATE = "surrogate_key"


def _business_update_time(spec: EntitySpec) -> Column:
    """The update time of business rows; null for the unknown member."""
    updated = F.col(UPDATED_AT)
    if spec.surrogate_key:
        return F.when(F.col(spec.surrogate_key) != UNKNOWN_KEY, updated)
    return updated


def dimension_watermark(spec: EntitySpec, table: KeyedTable) -> datetime | None:
    """Largest update time over the whole dimension, leaving out the unknown member.

    Loads record it with the table, since a dimension only gains newer rows; a table
    that was filled in another way is read.
    """
    recorded = table.highest(WATERMARK)
    if recorded is not None:
        return recorded
    return table.read().agg(F.max(_business_update_time(spec))).first()[0]


def load_dimension(
    spec: EntitySpec,
    current_state: DataFrame,
    table: KeyedTable,
    watermark: datetime | None,
    run_ts: datetime,
    batch_id: str,
) -> int:
    """Merge the rows past the watermark into the stored dimension; returns how many.

    The unknown member counts on the first load, as it is a row that the load has written.
    """
    sk = spec.surrogate_key
    used, known = 0, None
    if table.exists():
        slice_ = staging_slice(spec, current_state, watermark)
        used = table.highest(SURROGATE) if sk else 0
        if used is None:
            used = highest_key(table.read(), sk)
        arriving = conform_current_state(newer_rows(current_state, watermark), spec)
        known = table.matching(arriving.select(*[_stored(spec, k) for k in spec.key]))
    else:
        slice_ = staging_view(spec, current_state)
    highest = max(used, 0)
    rows = dimension_rows(spec, slice_, known, highest)
    unnumbered = _with_known_keys(spec, slice_, known)
    if known is None and sk:
        unknown = unknown_member(current_state.sparkSession, spec, run_ts, batch_id)
        rows, unnumbered = unknown.unionByName(rows), unknown.unionByName(unnumbered)

    def kept(part: DataFrame) -> DataFrame:
        # Taken out before they are stored, so the dimension need not be searched for them.
        gone = spec.dropped_keys
        return part.filter(~F.col(spec.key[0]).isin(list(gone))) if gone else part

    def numbered(cuts: Sequence[Column]) -> list[DataFrame]:
        if not sk:
            return [kept(unnumbered.filter(cut)) for cut in cuts]
        return [kept(p) for p in allocate_in_slices(unnumbered, sk, spec.key, highest, cuts)]

    record = {WATERMARK: F.max(_business_update_time(spec))}
    if sk:
        record[SURROGATE] = F.max(sk)
    return table.merge(kept(rows), highest=record, slices=Slices(unnumbered, numbered))


def next_dimension(
    spec: EntitySpec,
    staged: DataFrame,
    dimension: DataFrame,
    watermark: datetime | None,
    highest: int,
) -> DataFrame:
    """The whole dimension after an incremental load, as one lazy query."""
    rows = dimension_rows(spec, watermark_slice(staged, watermark), dimension, highest)
    return upsert(dimension, rows, spec.key)


def resolve_keys(
    facts: DataFrame,
    dimension: DataFrame,
    natural_key: dict[str, str],
    surrogate_key: str,
) -> DataFrame:
    """Add a dimension's surrogate key to facts; a missing member gives -1.

    ``natural_key`` maps fact columns to dimension columns. The dimension is unique on
    its key, so facts never multiply, and a hot key is split by adaptive execution.
    """
    lookup = dimension.select(
        *[F.col(d).alias(f"__{d}") for d in natural_key.values()], F.col(surrogate_key)
    )
    on = [F.col(f) == F.col(f"__{d}") for f, d in natural_key.items()]
    return (
        facts.join(lookup, on, "left")
        .drop(*[f"__{d}" for d in natural_key.values()])
        .withColumn(surrogate_key, F.coalesce(surrogate_key, F.lit(UNKNOWN_KEY).cast("bigint")))
    )
