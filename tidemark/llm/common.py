"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands in for a null id where ids are ordered: null comes last.
LAST_ID = (1 << 63) - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _ship(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package from wherever it was started.

    On a cluster the package is installed or sent with the job, as for any PySpark program.
    """
    context = spark.sparkContext
    local = context.master == "local" or context.master.startswith("local[")
    if local and not getattr(context, "_tidemark_shipped", False):
        context.addFile(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), recursive=True)
        context._tidemark_shipped = True


def mapped(rows: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """The rows after ``run`` over the Arrow batches of each task."""
    _ship(rows.sparkSession)
    return rows.mapInPandas(run, schema)


def whole_groups(frames: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """The rows of sorted frames, dealt anew so that rows of one value are never in two frames.

    Frames within one value are only kept until it ends, so a value over many frames is put together once.
    """
    kept: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        first, last = frame[column].iloc[0], frame[column].iloc[-1]
        if kept and first == last == kept[-1][column].iloc[-1]:
            kept.append(frame)
            continue
        rows = pd.concat([*kept, frame], ignore_index=True) if kept else frame
        open_ = rows[column] == last
        if not open_.all():
            yield rows[~open_]
        kept = [rows[open_]]
    if kept:
        yield pd.concat(kept, ignore_index=True)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder, so that nothing before runs again."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_key(text: Column) -> Column:
    """Tells rows apart that share an id but not a text."""
    return F.xxhash64(text)


def unused(df: DataFrame, name: str) -> str:
    """A column name the table doesn't have, for a working column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with their columns under names of no meaning, and these names by the columns' own.

    So no column of a table meets a working column, however it is called.
    """
    names = {c: f"own_{n}_" for n, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def own_name(names: dict[str, str], column: str) -> str:
    """The inner name of a column, known as Spark knows it: in any case."""
    return names.get(column) or {c.lower(): n for c, n in names.items()}[column.lower()]
