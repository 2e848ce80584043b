"""Rows set aside: plain Parquet, partitioned by the delivery that brought them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import AppendTable
from tidemark.spec import BATCH_ID

DELIVERY = "_delivery"


def with_delivery(landing: AppendTable) -> DataFrame:
    """Landing rows with the name of the delivery that appended them.

    A delivery is the folder of one append. It keeps its name for as long as its rows
    wait in the landing, whatever run or batch meets them.
    """
    empty = not landing.listing().folders
    folder = F.lit("") if empty else F.regexp_extract("_metadata.file_path", r"/data/([^/]+)/", 1)
    return landing.read().withColumn(DELIVERY, folder)


class Quarantine:
    """Rejected rows of an entity.

    Writing a delivery replaces what was stored of it, by dynamic partition overwrite. So a
    run that repeats a failed one, under the same batch or a new one, leaves each rejected
    row once. No commit list is kept: a reader sees whole partitions, since Spark moves them
    into place when the job ends.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def put(self, rows: DataFrame, batch_id: str, delivery: Column | None = None) -> int:
        """Store rows under their deliveries; returns how many there were.

        ``delivery`` names it for rows that carry none. Without rows nothing is written.
        """
        if delivery is not None:
            rows = rows.withColumn(DELIVERY, delivery)
        # Reads the key columns alone.
        found = rows.count()
        if found:
            stamped = rows.withColumn(BATCH_ID, F.lit(batch_id))
            # Rejects are few in a sound source; should they not be, a delivery gets several files.
            writer = stamped.hint("rebalance", F.col(DELIVERY)).write.partitionBy(DELIVERY)
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.root)
        return found

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """All rows, without the delivery; an empty table of ``schema`` before the first."""
        if self.exists():
            merged = self.spark.read.option("mergeSchema", True).parquet(self.root)
            return merged.drop(DELIVERY)
        if schema is None:
            raise FileNotFoundError(f"{self.root} has not been written yet")
        return self.spark.createDataFrame([], schema)

    def of_batch(self, batch_id: str) -> DataFrame:
        return self.read().filter(F.col(BATCH_ID) == batch_id)

    def rows(self) -> int:
        return self.read().count() if self.exists() else 0
