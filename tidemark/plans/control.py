"""Run control: audit events, batch and watermark state, status report, row totals."""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import number_after
from tidemark.operators.latest import deduplicate
from tidemark.operators.text import ordered_text
from tidemark.sources.tables import AppendTable
from tidemark.spec import TIME_SENTINEL, struct_type

# States, step names and detail labels of the control tables.
RUNNING, SUCCESS, FAILED, STARTED = "RUNNING", "SUCCESS", "FAILED", "STARTED"
EXTRACT_STEP, LOAD_STEP = "AIRBYTE_SYNC", "DBT_RUN"
AFFECTED_LABELS = ("rows_affected_final", "rows_affected")
LOAD_MODE = "INCREMENTAL_WATERMARK"

_TIME, _TEXT, _COUNT = "timestamp_ntz", "string", "bigint"
BATCH_SCHEMA = struct_type(
    {
        "batch_id": _TEXT,
        "pipeline_name": _TEXT,
        "source_name": _TEXT,
        "target_name": _TEXT,
        "status": _TEXT,
        "started_at": _TIME,
        "ended_at": _TIME,
        "rows_extracted": _COUNT,
        "rows_loaded": _COUNT,
        "rows_affected": _COUNT,
        "error_message": _TEXT,
        "duration_seconds": _COUNT,
        "orchestration_type": _TEXT,
        "created_at": _TIME,
        "updated_at": _TIME,
    }
)
AUDIT_SCHEMA = struct_type(
    {
        "audit_event_id": _COUNT,
        "batch_id": _TEXT,
        "step_name": _TEXT,
        "source_name": _TEXT,
        "target_name": _TEXT,
        "status": _TEXT,
        "rows_processed": _COUNT,
        "event_time": _TIME,
        "details": _TEXT,
        "execution_order": _COUNT,
        "duration_seconds": _COUNT,
        "started_at": _TIME,
        "ended_at": _TIME,
        "created_at": _TIME,
    }
)
WATERMARK_SCHEMA = struct_type(
    {
        "pipeline_name": _TEXT,
        "last_bi_updated_at": _TIME,
        "last_success_batch_id": _TEXT,
        "last_load_mode": _TEXT,
        "last_run_batch_id": _TEXT,
        "last_run_status": _TEXT,
        "last_error_message": _TEXT,
        "last_run_started_at": _TIME,
        "last_run_committed_at": _TIME,
        "updated_at": _TIME,
    }
)

# Kind of a record that carries the whole state of a key.
STATE = "STATE"

# Columns an event overwrites on an existing row; every other column keeps its value.
BATCH_UPDATES = {
    "START": ["status", "started_at", "error_message", "orchestration_type", "updated_at"],
    "END": [
        "status",
        "ended_at",
        "rows_extracted",
        "rows_loaded",
        "rows_affected",
        "error_message",
        "duration_seconds",
        "updated_at",
    ],
}
WATERMARK_UPDATES = {
    RUNNING: [
        "last_run_batch_id",
        "last_run_status",
        "last_error_message",
        "last_run_started_at",
        "updated_at",
    ],
    FAILED: ["last_run_batch_id", "last_run_status", "last_error_message", "updated_at"],
    SUCCESS: [f.name for f in WATERMARK_SCHEMA.fields if f.name != "pipeline_name"],
}


def fold_events(
    events: DataFrame,
    key: str,
    order: Sequence[str],
    updates: Mapping[str, Sequence[str]],
    schema: T.StructType,
    state: DataFrame | None = None,
    kind: str = "kind",
) -> DataFrame:
    """State after a set of upsert events, in one grouped pass over all keys.

    Per column the last event that may write it wins, null included; a column no later
    event may write keeps the value of the row's first event (or of ``state``).
    """
    columns = [f.name for f in schema.fields if f.name != key]
    source = events.select(key, kind, F.struct(F.lit(1), *order).alias("__at"), *columns)
    if state is not None:
        nothing = events.select(F.struct(F.lit(0), *order).alias("__at")).schema["__at"].dataType
        empty = F.struct(
            F.lit(0), *[F.lit(None).cast(f.dataType) for f in nothing.fields[1:]]
        ).cast(nothing)
        source = source.unionByName(
            state.select(key, F.lit(STATE).alias(kind), empty.alias("__at"), *columns)
        )
    at = F.col("__at")
    aggregates = []
    for c in columns:
        writers = [k for k, names in updates.items() if c in names]
        boxed = F.struct(F.col(c).alias("v"))
        written = F.col(kind).isin(writers) if writers else F.lit(False)
        last = F.max_by(F.when(written, boxed), F.when(written, at))
        aggregates.append(F.coalesce(last, F.min_by(boxed, at))["v"].alias(c))
    return source.groupBy(key).agg(*aggregates).select(*[f.name for f in schema.fields])


def _log_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("event_no", T.LongType()),
            T.StructField("kind", T.StringType()),
            *schema.fields,
        ]
    )


class Control:
    """The control tables below one folder.

    Batch and watermark records are appended as events, which is one small write, and
    the two state tables are the fold of all events of their log.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        # Entities may load side by side; a log takes one writer at a time.
        self._writing = threading.Lock()
        self.audit_log = AppendTable(spark, f"{root}/load_audit", "event_time")
        self.batch_log = AppendTable(spark, f"{root}/batch_execution", "updated_at")
        self.watermark_log = AppendTable(spark, f"{root}/pipeline_watermark", "updated_at")

    def audit(self) -> DataFrame:
        return self._read(self.audit_log, AUDIT_SCHEMA)

    def batches(self) -> DataFrame:
        events = self._read(self.batch_log, _log_schema(BATCH_SCHEMA))
        return fold_events(events, "batch_id", ["event_no"], BATCH_UPDATES, BATCH_SCHEMA)

    def watermarks(self) -> DataFrame:
        events = self._read(self.watermark_log, _log_schema(WATERMARK_SCHEMA))
        return fold_events(
            events, "pipeline_name", ["event_no"], WATERMARK_UPDATES, WATERMARK_SCHEMA
        )

    def _read(self, table: AppendTable, schema: T.StructType) -> DataFrame:
        return table.read() if table.exists() else self.spark.createDataFrame([], schema)

    def log(self, rows: Sequence[Mapping[str, Any]], run_ts: datetime) -> None:
        """Append audit events; one that has only started has no end time."""
        defaults = {"event_time": run_ts, "started_at": run_ts, "created_at": run_ts}
        filled = [
            {**defaults, **({} if r["status"] == STARTED else {"ended_at": run_ts}), **r}
            for r in rows
        ]
        with self._writing:
            self.audit_log.append_rows(filled, AUDIT_SCHEMA, "audit_event_id")

    def batch_events(self, rows: Sequence[Mapping[str, Any]], run_ts: datetime) -> None:
        filled = [{"created_at": run_ts, "updated_at": run_ts, **r} for r in rows]
        with self._writing:
            self.batch_log.append_rows(filled, _log_schema(BATCH_SCHEMA), "event_no")

    def batch_start(self, run_ts: datetime, **row: Any) -> None:
        self.batch_events([{"kind": "START", "status": RUNNING, "started_at": run_ts, **row}], run_ts)

    def batch_end(self, run_ts: datetime, **row: Any) -> None:
        self.batch_events([{"kind": "END", "ended_at": run_ts, **row}], run_ts)

    def delete_batches(self, expired: Column) -> int:
        """Remove batches and shorten their log to one state record per kept batch."""
        state = self.batches()
        removed = state.filter(expired).count()
        if removed:
            self._shorten(self.batch_log, state.filter(~expired | expired.isNull()))
        return removed

    def shorten_watermarks(self) -> None:
        """Replace the watermark events by one state record per pipeline."""
        if self.watermark_log.exists():
            self._shorten(self.watermark_log, self.watermarks())

    def _shorten(self, log: AppendTable, state: DataFrame) -> None:
        with self._writing:
            number, kind = F.lit(0).cast("bigint"), F.lit(STATE)
            log.overwrite(state.select(number.alias("event_no"), kind.alias("kind"), "*"))

    def watermark_events(self, rows: Sequence[Mapping[str, Any]], run_ts: datetime) -> None:
        filled = [{"updated_at": run_ts, **r} for r in rows]
        with self._writing:
            self.watermark_log.append_rows(filled, _log_schema(WATERMARK_SCHEMA), "event_no")

    def mark_running(self, pipelines: Sequence[str], batch_id: str, run_ts: datetime) -> None:
        base = {"kind": RUNNING, "last_run_status": RUNNING, "last_run_batch_id": batch_id}
        self.watermark_events(
            [{**base, "pipeline_name": p, "last_run_started_at": run_ts} for p in pipelines], run_ts
        )

    def mark_failed(
        self, pipelines: Sequence[str], batch_id: str, error: str, run_ts: datetime
    ) -> None:
        base = {"kind": FAILED, "last_run_status": FAILED, "last_run_batch_id": batch_id}
        self.watermark_events(
            [{**base, "pipeline_name": p, "last_error_message": error} for p in pipelines], run_ts
        )

    def commit(
        self, watermarks: Mapping[str, datetime | None], batch_id: str, run_ts: datetime
    ) -> None:
        """Record new watermarks; call it after the data has been published."""
        self.watermark_events(
            [
                {
                    "kind": SUCCESS,
                    "pipeline_name": p,
                    "last_bi_updated_at": value,
                    "last_success_batch_id": batch_id,
                    "last_load_mode": LOAD_MODE,
                    "last_run_batch_id": batch_id,
                    "last_run_status": SUCCESS,
                    "last_run_started_at": run_ts,
                    "last_run_committed_at": run_ts,
                }
                for p, value in watermarks.items()
            ],
            run_ts,
        )

    def watermark(self, pipeline: str) -> datetime:
        """The committed watermark; before the first commit a time before all data."""
        if not self.watermark_log.exists():
            return TIME_SENTINEL
        # Only the last success carries a watermark, so the fold of one column is enough.
        events = self.watermark_log.read().filter(
            (F.col("pipeline_name") == pipeline) & F.col("kind").isin(SUCCESS, STATE)
        )
        return events.agg(F.max_by("last_bi_updated_at", "event_no")).first()[0] or TIME_SENTINEL

    def status(self) -> DataFrame:
        return run_status(self.batches(), self.watermarks(), self.audit())


def audit_summary(audit: DataFrame) -> DataFrame:
    """Per batch: event counts by status, first start, last end, failed steps in order."""
    counts = audit.groupBy("batch_id").agg(
        F.count("*").alias("audit_events"),
        F.count_if(F.col("status") == STARTED).alias("started_events"),
        F.count_if(F.col("status") == SUCCESS).alias("success_events"),
        F.count_if(F.col("status") == FAILED).alias("failed_events"),
        F.min("started_at").alias("first_step_started_at"),
        F.max("ended_at").alias("last_step_ended_at"),
    )
    failed = ordered_text(
        audit.filter(F.col("status") == FAILED),
        ["batch_id"],
        "step_name",
        ["execution_order"],
        "audit_event_id",
        "failed_steps",
    )
    # A batch without a failed step has an empty list rather than none.
    return counts.join(failed, "batch_id", "left").withColumn(
        "failed_steps", F.coalesce("failed_steps", F.lit(""))
    )


def run_status(batches: DataFrame, watermarks: DataFrame, audit: DataFrame) -> DataFrame:
    """One row per pipeline: latest batch, committed watermark and audit summary."""
    latest = deduplicate(
        batches,
        ["pipeline_name"],
        [F.coalesce("started_at", "updated_at").desc_nulls_first()],
    ).alias("b")
    w = watermarks.alias("w")
    # Summing up first and joining after keeps the events of a large batch apart.
    summary = audit_summary(audit).alias("a")
    floor = F.lit(TIME_SENTINEL).cast("timestamp_ntz")
    return (
        w.join(latest, F.col("w.pipeline_name") == F.col("b.pipeline_name"), "full_outer")
        .join(summary, F.col("b.batch_id") == F.col("a.batch_id"), "left")
        .select(
            F.coalesce("w.pipeline_name", "b.pipeline_name").alias("pipeline_name"),
            "b.batch_id",
            "b.source_name",
            "b.target_name",
            F.col("b.status").alias("batch_status"),
            F.col("w.last_run_status").alias("watermark_status"),
            F.col("b.started_at").alias("batch_started_at"),
            F.col("b.ended_at").alias("batch_ended_at"),
            F.col("b.duration_seconds").alias("batch_duration_seconds"),
            "b.orchestration_type",
            "b.rows_extracted",
            "b.rows_loaded",
            "b.rows_affected",
            "w.last_bi_updated_at",
            "w.last_success_batch_id",
            "w.last_run_batch_id",
            "w.last_run_started_at",
            "w.last_run_committed_at",
            F.coalesce("b.error_message", "w.last_error_message").alias("last_error_message"),
            "a.audit_events",
            "a.started_events",
            "a.success_events",
            "a.failed_events",
            "a.failed_steps",
            "a.first_step_started_at",
            "a.last_step_ended_at",
            F.greatest(
                F.coalesce("b.updated_at", floor), F.coalesce("w.updated_at", floor)
            ).alias("updated_at"),
        )
    )


def _succeeded(step: str) -> Column:
    return (F.col("step_name") == step) & (F.col("status") == SUCCESS)


def batch_row_totals(
    audit: DataFrame, extract_step: str = EXTRACT_STEP, load_step: str = LOAD_STEP
) -> DataFrame:
    """Rows extracted, loaded and affected per batch, from the audit log."""
    rows = F.coalesce("rows_processed", F.lit(0))
    affected = number_after(F.col("details"), *AFFECTED_LABELS)

    def total(step: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(_succeeded(step), value).otherwise(F.lit(0))), F.lit(0))

    return audit.groupBy("batch_id").agg(
        F.count("*").alias("audit_events"),
        total(extract_step, rows).cast("bigint").alias("rows_extracted"),
        total(load_step, rows).cast("bigint").alias("rows_loaded"),
        total(load_step, affected).cast("bigint").alias("rows_affected"),
    )
