"""Monitoring over the control tables and source freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.relations import boundaries_between
from tidemark.plans.control import RUNNING, SUCCESS
from tidemark.spec import EntitySpec

# Monitoring windows.
DEFAULT_STALL_MINUTES = 90
DOMAIN_SUCCESS_MINUTES = 14 * 60
CLEANUP_SUCCESS_MINUTES = 26 * 60
FRESHNESS_WARN_HOURS = 18
FRESHNESS_ERROR_HOURS = 30


def expectations(spark, specs: Sequence[Mapping[str, Any]], minutes: str) -> DataFrame:
    """Monitoring specs as a table of pipeline, description and minutes."""
    rows = [
        (s["pipeline_name"], s.get("description"), int(s.get(minutes, DEFAULT_STALL_MINUTES)))
        for s in specs
    ]
    return spark.createDataFrame(rows, f"pipeline_name string, description string, {minutes} int")


def default_expectations(spark) -> DataFrame:
    """The two jobs that are expected to succeed within a time."""
    return expectations(
        spark,
        [
            {
                "pipeline_name": "dimensions_domain",
                "description": "dimension loads, twice a day",
                "expected_success_within_minutes": DOMAIN_SUCCESS_MINUTES,
            },
            {
                "pipeline_name": "cleanup_retention",
                "description": "daily retention",
                "expected_success_within_minutes": CLEANUP_SUCCESS_MINUTES,
            },
        ],
        "expected_success_within_minutes",
    )


def default_thresholds(spark, specs: Sequence[EntitySpec]) -> DataFrame:
    """A stall threshold for every entity's dimension load."""
    return expectations(
        spark, [{"pipeline_name": s.pipeline_name} for s in specs], "stall_threshold_minutes"
    )


def missing_success(expected: DataFrame, batches: DataFrame, run_ts: datetime) -> DataFrame:
    """Pipelines without a successful end inside their window.

    ``expected`` holds pipeline_name and expected_success_within_minutes.
    """
    now = F.lit(run_ts).cast("timestamp_ntz")
    last = (
        batches.filter(F.col("status") == SUCCESS)
        .groupBy("pipeline_name")
        .agg(F.max("ended_at").alias("last_success_at"))
    )
    earliest = F.timestamp_add(
        "MINUTE", -F.col("expected_success_within_minutes").cast("int"), now
    )
    # The latest success decides: if it lies outside the window, so do all others.
    return expected.join(last, "pipeline_name", "left").filter(
        F.col("last_success_at").isNull() | (F.col("last_success_at") < earliest)
    )


def stalled(thresholds: DataFrame, watermarks: DataFrame, run_ts: datetime) -> DataFrame:
    """Pipelines RUNNING for longer than their stall_threshold_minutes."""
    now = F.lit(run_ts).cast("timestamp_ntz")
    minutes = F.col("stall_threshold_minutes").cast("int")
    return (
        watermarks.filter(F.col("last_run_status") == RUNNING)
        .join(thresholds, "pipeline_name")
        .filter(F.col("last_run_started_at") < F.timestamp_add("MINUTE", -minutes, now))
        .withColumn("minutes_running", boundaries_between("MINUTE", F.col("last_run_started_at"), now))
    )


def freshness(
    df: DataFrame,
    loaded_at: str,
    run_ts: datetime,
    warn_hours: int = FRESHNESS_WARN_HOURS,
    error_hours: int = FRESHNESS_ERROR_HOURS,
    group: Sequence[str] = (),
) -> DataFrame:
    """Latest load time and its state: pass, warn or error; no rows at all is an error."""
    now = F.lit(run_ts).cast("timestamp_ntz")

    def older(hours: int):
        return F.col("max_loaded_at") < F.timestamp_add("HOUR", F.lit(-hours), now)

    state = (
        F.when(F.col("max_loaded_at").isNull() | older(error_hours), "error")
        .when(older(warn_hours), "warn")
        .otherwise("pass")
    )
    return df.groupBy(*group).agg(F.max(loaded_at).alias("max_loaded_at")).withColumn("status", state)


def active_keys(df: DataFrame, key: str, active: str | None = None) -> DataFrame:
    """Distinct keys of active rows, in order; without an active column all keys."""
    # Texts that mean active.
    truthy = ["1", "TRUE", "T", "ATIVO", "A"]
    rows = df if active is None else df.filter(F.upper(F.col(active).cast("string")).isin(truthy))
    return rows.select(key).distinct().orderBy(key)
