"""Landing to current state: type, take the latest per key, compare, merge what moved."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import changed_or_new, split_null_keys
from tidemark.operators.latest import latest_in_landing, latest_in_staging
from tidemark.operators.merge import upsert
from tidemark.sources.readers import changed_since
from tidemark.sources.quarantine import DELIVERY, Quarantine
from tidemark.sources.tables import KeyedTable, Slices
from tidemark.spec import (
    LANDING_EXTRACTED_AT,
    SOURCE_UPDATED_AT,
    TIME_SENTINEL,
    UPDATED_AT,
    EntitySpec,
    conform_current_state,
    conform_landing,
)


CURSOR = "cursor"


@dataclass
class MergeOutcome:
    rows: int
    rejected: DataFrame
    # How many rows the quarantine took; None without one.
    quarantined: int | None = None


def _usable(spec: EntitySpec, landing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conformed rows that can be merged, and those to set aside."""
    rows = conform_landing(landing, spec)
    if spec.keep_null_keys:
        return rows, rows.limit(0)
    return split_null_keys(rows, spec.key)


def landing_changes(
    spec: EntitySpec,
    landing: DataFrame,
    target: DataFrame | None,
    run_ts: datetime,
    batch_id: str,
) -> DataFrame:
    """New and changed rows of a landing slice, stamped for this run."""
    complete, _ = _usable(spec, landing)
    return changed_or_new(latest_in_landing(complete, spec.key), target, spec, run_ts, batch_id)


def apply_landing(
    spec: EntitySpec,
    landing: DataFrame,
    target: DataFrame | None,
    run_ts: datetime,
    batch_id: str,
) -> DataFrame:
    """The whole current state after a landing slice, as one lazy query."""
    changes = landing_changes(spec, landing, target, run_ts, batch_id)
    return changes if target is None else upsert(target, changes, spec.key)


def merge_current_state(
    spec: EntitySpec,
    landing: DataFrame,
    table: KeyedTable,
    run_ts: datetime,
    batch_id: str,
    writer: str | None = None,
    quarantine: Quarantine | None = None,
) -> MergeOutcome:
    """Merge a landing slice into the stored current state.

    Rows with an incomplete key are stored in the quarantine before the merge is published,
    under the delivery that landed them (a column of that name) or else under the batch. A
    run that repeats them replaces them.
    """
    complete, rejected = _usable(spec, landing)
    quarantined = None
    if quarantine is not None and not spec.keep_null_keys:
        aside, own = rejected, F.lit(batch_id)
        if DELIVERY in landing.columns:
            aside, own = split_null_keys(conform_landing(landing, spec, (DELIVERY,)), spec.key)[1], None
        quarantined = quarantine.put(aside, batch_id, own)
        if quarantined:
            rejected = quarantine.of_batch(batch_id)
    target = table.matching(complete) if table.exists() else None
    latest = latest_in_landing(complete, spec.key)
    changes = changed_or_new(latest, target, spec, run_ts, batch_id)
    record = {CURSOR: F.max(SOURCE_UPDATED_AT)}
    slices = Slices(changes, lambda cuts: [changes.filter(cut) for cut in cuts])
    return MergeOutcome(table.merge(changes, writer, batch_id, record, slices), rejected, quarantined)


def extract(
    spec: EntitySpec, source: DataFrame, table: KeyedTable, extracted_at: datetime
) -> DataFrame:
    """Landing rows of a source view: those past the last source time that was merged.

    A source without an update time is read whole.
    """
    last = None if spec.full_extract else table.highest(CURSOR)
    at = F.lit(extracted_at).cast("timestamp_ntz")
    return changed_since(source, SOURCE_UPDATED_AT, last).withColumn(LANDING_EXTRACTED_AT, at)


def _newer(watermark: datetime | None) -> Column:
    return F.col(UPDATED_AT) > F.lit(watermark or TIME_SENTINEL).cast("timestamp_ntz")


def newer_rows(current_state: DataFrame, watermark: datetime | None) -> DataFrame:
    """Stored rows past the watermark, and those without a time."""
    return current_state.filter(_newer(watermark) | F.col(UPDATED_AT).isNull())


def staging_slice(
    spec: EntitySpec, current_state: DataFrame, watermark: datetime | None
) -> DataFrame:
    """The rows of the staging view that are newer than the watermark.

    Filtering the stored rows first gives the same rows as filtering the view: a row
    without a time outranks all others of its key, so it has to stay until the ranking.
    The scan can then skip everything older.
    """
    return staging_view(spec, newer_rows(current_state, watermark)).filter(_newer(watermark))


def staging_view(spec: EntitySpec, current_state: DataFrame) -> DataFrame:
    """Typed current state with one row per key; never stored."""
    return latest_in_staging(conform_current_state(current_state, spec), spec.key)
