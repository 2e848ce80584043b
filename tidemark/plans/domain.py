"""A whole domain run: landing, current state, dimensions, control records, purge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.control import (
    AFFECTED_LABELS,
    EXTRACT_STEP,
    FAILED,
    LOAD_STEP,
    STARTED,
    SUCCESS,
    Control,
    batch_row_totals,
)
from tidemark.plans.current_state import merge_current_state, staging_view
from tidemark.plans.dimension import dimension_watermark, load_dimension
from tidemark.sources.quarantine import Quarantine, with_delivery
from tidemark.sources.tables import AppendTable, KeyedTable
from tidemark.spec import LANDING_EXTRACTED_AT, UPDATED_AT, EntitySpec

QUARANTINE_STEP = "QUARANTINE_"


class Warehouse:
    """Layers of tables below one folder: raw, ds, dw and control."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.control = Control(spark, self.path("control", "ctl"))

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def landing(self, spec: EntitySpec) -> AppendTable:
        return AppendTable(self.spark, self.path("raw", spec.name), LANDING_EXTRACTED_AT)

    def current_state(self, spec: EntitySpec) -> KeyedTable:
        """One row per key, by the day it was last updated, as retention drops whole days."""
        root = self.path("ds", spec.name)
        return KeyedTable(self.spark, root, spec.key, spec.parts, day_column=UPDATED_AT)

    def quarantine(self, spec: EntitySpec) -> Quarantine:
        """Rows whose key is incomplete, by the delivery that brought them."""
        return Quarantine(self.spark, self.path("quarantine", spec.name))

    def dimension(self, spec: EntitySpec) -> KeyedTable:
        return KeyedTable(self.spark, self.path("dw", spec.name), spec.key, spec.parts)

    def create_views(self, specs: Sequence[EntitySpec]) -> None:
        """Temporary views for SQL: ds_, stg_ds__ and dim_ tables and the control tables."""
        for spec in specs:
            state, dimension = self.current_state(spec), self.dimension(spec)
            if state.exists():
                state.read().createOrReplaceTempView(f"ds_{spec.name}")
                staging_view(spec, state.read()).createOrReplaceTempView(f"stg_ds__{spec.name}")
            if dimension.exists():
                dimension.read().createOrReplaceTempView(f"dim_{spec.name}")
        self.control.audit().createOrReplaceTempView("ctl_load_audit")
        self.control.batches().createOrReplaceTempView("ctl_batch_execution")
        self.control.watermarks().createOrReplaceTempView("ctl_pipeline_watermark")
        self.control.status().createOrReplaceTempView("vw_pipeline_run_status")


def load_entity(wh: Warehouse, spec: EntitySpec, run_ts: datetime, batch_id: str) -> dict[str, Any]:
    """Landing to current state to dimension for one entity."""
    state, dimension = wh.current_state(spec), wh.dimension(spec)
    landing, quarantine = with_delivery(wh.landing(spec)), wh.quarantine(spec)
    merged = merge_current_state(spec, landing, state, run_ts, batch_id, quarantine=quarantine)
    watermark = wh.control.watermark(spec.pipeline_name)
    loaded = load_dimension(spec, state.read(), dimension, watermark, run_ts, batch_id)
    # Data first, watermark second: a stop in between repeats rows, which changes nothing.
    committed = dimension_watermark(spec, dimension)
    wh.control.commit({spec.pipeline_name: committed}, batch_id, run_ts)
    return {
        "merged": merged.rows,
        "loaded": loaded,
        "rejected": merged.rejected,
        "quarantined": merged.quarantined or 0,
    }


def run_domain(
    wh: Warehouse,
    specs: Sequence[EntitySpec],
    arrivals: Mapping[str, DataFrame],
    run_ts: datetime,
    batch_id: str,
    domain: str = "dimensions_domain",
    side_by_side: int = 4,
) -> dict[str, Any]:
    """Land the arrivals, load every entity, record the run, empty the landing layer.

    Entities do not depend on each other, so a few of them load side by side. The
    landing layer is emptied only when every entity has succeeded, so a failed run can
    be repeated from what has landed.
    """
    control = wh.control
    names = {"pipeline_name": domain, "source_name": "RAW", "target_name": "DW"}
    control.batch_start(run_ts, batch_id=batch_id, orchestration_type="SCHEDULER", **names)
    control.mark_running([s.pipeline_name for s in specs], batch_id, run_ts)
    landed = [s for s in specs if s.name in arrivals]
    extracted = sum(wh.landing(s).append(arrivals[s.name]) for s in landed)
    step = {"batch_id": batch_id, "source_name": "RAW"}
    events: list[dict[str, Any]] = [
        {
            **step,
            "step_name": EXTRACT_STEP,
            "target_name": "RAW",
            "status": SUCCESS,
            "rows_processed": extracted,
            "execution_order": 0,
        }
    ]

    def load(spec: EntitySpec) -> dict[str, Any]:
        if not wh.landing(spec).exists():
            return {"merged": 0, "loaded": 0}
        try:
            return load_entity(wh, spec, run_ts, batch_id)
        except Exception as exc:
            control.mark_failed([spec.pipeline_name], batch_id, str(exc), run_ts)
            return {"error": str(exc)}

    with ThreadPoolExecutor(side_by_side) as pool:
        loads = list(pool.map(inheritable_thread_target(wh.spark)(load), specs))
    results = {spec.name: found for spec, found in zip(specs, loads)}
    errors = {name: found["error"] for name, found in results.items() if "error" in found}
    for order, spec in enumerate(specs, start=1):
        found = results[spec.name]
        record = {
            **step,
            "step_name": LOAD_STEP,
            "target_name": spec.name,
            "execution_order": order,
        }
        events.append({**record, "status": STARTED})
        if "error" in found:
            events.append({**record, "status": FAILED, "details": found["error"]})
        else:
            detail = f"{AFFECTED_LABELS[0]}={found['loaded']}"
            events.append(
                {
                    **record,
                    "status": SUCCESS,
                    "rows_processed": found["merged"],
                    "details": detail,
                }
            )
            if found.get("quarantined"):
                events.append(
                    {
                        **record,
                        "step_name": f"{QUARANTINE_STEP}{spec.name.upper()}",
                        "status": SUCCESS,
                        "rows_processed": found["quarantined"],
                    }
                )

    purged = 0
    if not errors:
        for order, spec in enumerate(specs, start=len(specs) + 1):
            removed = wh.landing(spec).clear()
            purged += removed
            events.append(
                {
                    **step,
                    "step_name": f"CLEANUP_RAW_{spec.name.upper()}",
                    "target_name": spec.name,
                    "status": SUCCESS,
                    "rows_processed": removed,
                    "execution_order": order,
                }
            )
    control.log(events, run_ts)
    totals = batch_row_totals(control.audit().filter(F.col("batch_id") == batch_id)).first()
    status = FAILED if errors else SUCCESS
    control.batch_end(
        run_ts,
        batch_id=batch_id,
        status=status,
        error_message="; ".join(f"{n}: {e}" for n, e in errors.items()) or None,
        rows_extracted=totals["rows_extracted"],
        rows_loaded=totals["rows_loaded"],
        rows_affected=totals["rows_affected"],
        **names,
    )
    return {"status": status, "entities": results, "purged": purged, "errors": errors}
