"""Retention: deletes of old rows with counts for the control tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.control import FAILED, STARTED, SUCCESS, Control
from tidemark.sources.tables import KeyedTable
from tidemark.spec import UPDATED_AT


def before_day(column: str, day: date) -> Column:
    """True for times on an earlier day; a null time is never old.

    Compared with the start of the day, so the scan can use the bound.
    """
    return F.col(column) < F.lit(day).cast("timestamp_ntz")


def retained(df: DataFrame, column: str, day: date) -> DataFrame:
    """Rows that a cut at ``day`` keeps, those without a time among them."""
    return df.filter(F.col(column).isNull() | ~before_day(column, day))


def retention_counts(df: DataFrame, column: str, day: date) -> DataFrame:
    """Rows per day with what a cut at ``day`` deletes and keeps."""
    old = F.coalesce(before_day(column, day), F.lit(False))
    return df.groupBy(F.col(column).cast("date").alias("day")).agg(
        F.count("*").alias("rows_before"),
        F.count_if(old).alias("rows_deleted"),
        F.count_if(~old).alias("rows_kept"),
    )


def purge_current_state(
    tables: Mapping[str, KeyedTable], run_ts: datetime, batch_id: str, control: Control
) -> dict[str, int]:
    """Keep only rows updated on the run's day in every current-state table."""
    deleted: dict[str, int] = {}
    failures: list[str] = []
    events = []
    for order, (name, table) in enumerate(tables.items(), start=1):
        step = {
            "batch_id": batch_id,
            "step_name": f"CLEANUP_DS_{name.upper()}",
            "source_name": "RETENTION",
            "target_name": name,
            "execution_order": order,
        }
        events.append({**step, "status": STARTED})
        try:
            if table.day_column == UPDATED_AT:
                deleted[name] = table.drop_days_before(run_ts.date())
            else:
                deleted[name] = table.delete(before_day(UPDATED_AT, run_ts.date()))
            events.append({**step, "status": SUCCESS, "rows_processed": deleted[name]})
        except Exception as exc:
            failures.append(name)
            events.append({**step, "status": FAILED, "details": str(exc)})
    control.log(events, run_ts)
    control.batch_end(
        run_ts,
        batch_id=batch_id,
        pipeline_name="cleanup_retention",
        source_name="RETENTION",
        target_name="DS",
        status=FAILED if failures else SUCCESS,
        error_message=f"tasks failed: {', '.join(failures)}" if failures else None,
    )
    return deleted


def purge_control(control: Control, run_ts: datetime) -> dict[str, int]:
    """Keep today and yesterday in the audit log and the batch table.

    Watermarks stay; their log is shortened to the current state.
    """
    first_kept = run_ts.date() - timedelta(days=1)
    control.shorten_watermarks()
    return {
        "load_audit": control.audit_log.drop_days_before(first_kept),
        "batch_execution": control.delete_batches(before_day("started_at", first_kept)),
    }
