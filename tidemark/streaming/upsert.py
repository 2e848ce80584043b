"""Continuous landing to current state."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.current_state import merge_current_state
from tidemark.sources.quarantine import Quarantine
from tidemark.sources.tables import KeyedTable
from tidemark.spec import EntitySpec


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New parquet files of a landing folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in the checkpoint of a stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def stream_upsert(
    spec: EntitySpec,
    landing: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    run_ts: datetime,
    quarantine: Quarantine | None = None,
) -> StreamingQuery:
    """Merge each micro-batch into the current state until the landing is drained.

    The table remembers the last batch that each stream has published, so a micro-batch
    that is replayed after a failure is not merged twice. A stream is known by the id in
    its checkpoint: another stream into the table, or one that starts anew with a fresh
    checkpoint, has batches of its own.
    """
    spark = landing.sparkSession

    def merge(rows: DataFrame, epoch: int) -> None:
        name = f"stream-{stream_id(spark, checkpoint)}"
        merge_current_state(
            spec, rows, table, run_ts, f"{name}-{epoch}", writer=name, quarantine=quarantine
        )

    return (
        landing.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
