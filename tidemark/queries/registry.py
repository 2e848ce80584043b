"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import tune
from tidemark.sources.readers import table

RUN_1 = datetime(2024, 1, 15)
RUN_2 = datetime(2024, 2, 1)
RUN_3 = datetime(2024, 2, 2, 12, 30)


class Tables:
    """The benchmark tables as attributes, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(tune(spark), folder))

        REGISTRY[name] = Query(run, sql)
        return function

    return register
