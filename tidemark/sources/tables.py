"""Stored tables: parquet files plus a small list of the files or folders in force.

A writer puts new files in a folder of its own and then publishes a list that names
it. Readers take the newest list once, so they never see half a write, and a lost
executor only repeats tasks. One writer per table at a time; a second one is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce
from operator import and_
from typing import Any
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.merge import align
from tidemark.session import shuffles_freed

# Lists of earlier versions that stay readable on disk.
KEPT_LISTINGS = 100


@dataclass
class Listing:
    version: int = 0
    schema: str | None = None
    # Files or folders in force, below the table root, with their size in bytes.
    folders: dict[str, int] = field(default_factory=dict)
    # Writer name -> last batch it has published.
    applied: dict[str, str] = field(default_factory=dict)
    # Last id handed out to appended rows.
    serial: int = 0
    # Least number of files of a full write of a keyed table.
    parts: int = 0
    # Bytes that a full file of a keyed table takes on disk; 0 until rows were sized.
    file_bytes: int = 0
    # Largest values seen by the writers, under the names they chose.
    highest: dict[str, Any] = field(default_factory=dict)


class _StoredTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _hadoop_path(self, relative: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def listing(self) -> Listing:
        path, fs = self._hadoop_path("_published")
        if not fs.exists(path):
            return Listing()
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        names = [n for n in names if n.endswith(".json") and not n.startswith(".")]
        if not names:
            return Listing()
        newest, fs = self._hadoop_path(f"_published/{max(names)}")
        stream = fs.open(newest)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Listing(**json.loads(text))

    def _publish(self, listing: Listing) -> None:
        listing.version += 1
        final, fs = self._hadoop_path(f"_published/{listing.version:010d}.json")
        draft, _ = self._hadoop_path(f"_published/.{uuid.uuid4().hex}.draft")
        stream = fs.create(draft, False)
        try:
            stream.write(json.dumps(listing.__dict__).encode())
        finally:
            stream.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"{self.root}: another writer has published {listing.version}")
        expired, _ = self._hadoop_path(f"_published/{listing.version - KEPT_LISTINGS:010d}.json")
        fs.delete(expired, False)

    def exists(self) -> bool:
        return self.listing().schema is not None

    def schema(self) -> T.StructType:
        text = self.listing().schema
        if text is None:
            raise FileNotFoundError(f"{self.root} has not been written yet")
        return T.StructType.fromJson(json.loads(text))

    def _read_folders(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        # Columns added since a folder was written read as null, removed ones are skipped.
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self) -> DataFrame:
        listing = self.listing()
        if listing.schema is None:
            raise FileNotFoundError(f"{self.root} has not been written yet")
        schema = T.StructType.fromJson(json.loads(listing.schema))
        return self._read_folders(sorted(listing.folders), schema)

    def rows(self) -> int:
        """Row count, from the file footers."""
        return self.read().count()

    def vacuum(self, before: datetime) -> int:
        """Delete data files that are out of force and were written before a time.

        The time has to lie before the start of every reader and writer still at work.
        """
        used = self.listing().folders
        path, fs = self._hadoop_path("data")
        if not fs.exists(path):
            return 0
        gone = []
        files = fs.listFiles(path, True)
        while files.hasNext():
            file = files.next()
            name = file.getPath().toString()
            name = name[name.rindex("/data/") + 1 :]
            in_force = name in used or name.rsplit("/", 1)[0] in used
            if not in_force and file.getModificationTime() < before.timestamp() * 1000:
                gone.append(file.getPath())
        for file in gone:
            fs.delete(file, False)
        return len(gone)

    def clear(self) -> int:
        """Publish an empty table and return how many rows it held."""
        listing = self.listing()
        if not listing.folders:
            return 0
        removed = self.rows()
        listing.folders = {}
        self._publish(listing)
        return removed

    def _write_split(self, df: DataFrame, by: Column, name: str) -> dict[str, int]:
        """Write ``df`` in one folder per value of ``by``; returns the folders and sizes."""
        run = f"data/{uuid.uuid4().hex[:16]}"
        # Adaptive rebalancing sizes the files and splits a value that holds many rows.
        split = df.withColumn(name, by).hint("rebalance", F.col(name))
        split.write.partitionBy(name).parquet(f"{self.root}/{run}")
        # One listing for all parts, in place of a call for each of them.
        path, fs = self._hadoop_path(run)
        sizes: dict[str, int] = {}
        files = fs.listFiles(path, True)
        while files.hasNext():
            file = files.next()
            part = file.getPath().getParent().getName()
            if part.startswith(f"{name}="):
                sizes[f"{run}/{part}"] = sizes.get(f"{run}/{part}", 0) + file.getLen()
        return sizes


# A file of a keyed table aims at this size,
FILE_BYTES = 256 * 1024 * 1024

# (written with the codec that takes a third less than the usual one)
COMPRESSION = "zstd"

# or at rows of this size in the memory of the task that sorts them, whichever is less.
SORT_BYTES = 512 * 1024 * 1024

# Files below a quarter of a full one are put together once a day or table has more of them.
MANY_SMALL = 16

# A table up to this size is read whole.
SMALL_TABLE_BYTES = 64 * 1024 * 1024

# Keys up to this size in memory are sent to every task.
KEY_BYTES = 16 * 1024 * 1024

# Rows that are made of more files than this are made and stored in slices of their keys, one for each such
# size, so that shuffles hold one slice at a time.
SLICE_BYTES = 128 * 1024 * 1024

# There are no more slices, as each may read everything again.
MOST_SLICES = 8

# Slices are cut at this many sampled keys, drawn by a hash from one in so many.
SAMPLED_KEYS = 4096
SAMPLED_OF = 64

_FILE = "__file"
# Types whose bounds Parquet keeps in an order that Spark shares.
_RANGED = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Slices:
    """A way to make the changes of a merge slice by slice.

    ``rows`` hold the keys of all of them. ``make`` is given a condition on the keys for each slice, in the order
    of the keys, and returns the changes of each. It is worth it where the conditions reach what is
    read before it is shuffled.
    """

    rows: DataFrame
    make: Callable[[Sequence[Column]], Sequence[DataFrame]]


class KeyedTable(_StoredTable):
    """One row per key, in files that each hold a range of keys.

    A merge adds its rows in files of their own and writes again only the files that hold a
    key it replaces, without that key. These are found by reading the keys alone, and of
    those only the row groups whose bounds meet the arriving keys. With a ``day_column``
    every file holds one day, so days can be dropped whole. ``parts`` is the least number
    of files that a full write makes.
    """

    DAY = "_day"

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        parts: int | None = None,
        small_bytes: int | None = None,
        day_column: str | None = None,
    ):
        super().__init__(spark, root)
        self.keys = list(keys)
        self.day_column = day_column
        self._small_bytes = small_bytes
        self._wanted_parts = parts

    def _day(self) -> list[Column]:
        if not self.day_column:
            return []
        return [F.col(self.day_column).cast("date").cast("string").alias(self.DAY)]

    def _write(self, rows: DataFrame) -> dict[str, int]:
        run = f"data/{uuid.uuid4().hex[:16]}"
        with shuffles_freed(self.spark):
            writer = rows.write.option("compression", COMPRESSION)
            writer = writer.partitionBy(self.DAY) if self.day_column else writer
            writer.parquet(f"{self.root}/{run}")
        return self._files(run)

    def _write_left(self, rows: DataFrame) -> dict[str, int]:
        """Write what is left of some files as it stands: their order is kept and nothing is shuffled."""
        return self._write(rows.select("*", *self._day()))

    def _write_files(
        self, df: DataFrame, listing: Listing, least: int = 1, many: bool = False
    ) -> dict[str, int]:
        """Write ``df`` in files of sorted key ranges; returns the files and sizes.

        The listing gets to know the size of a full file, if the rows are ``many`` or read from
        enough to be sized.
        """
        day = self._day()
        by = [*([self.DAY] if day else []), *self.keys]

        def write(rows: DataFrame) -> dict[str, int]:
            return self._write(rows.sortWithinPartitions(*by))

        if not many and least <= 1 and input_bytes(df) <= FILE_BYTES:
            # By the day, or every task would write a file for each.
            return write(df.select("*", *day).hint("rebalance", *by[: len(day)]))
        # Ranges need a first look at the keys; they are taken from a copy, so that what is
        # behind the rows runs once.
        copy = f"data/{uuid.uuid4().hex[:16]}"
        with shuffles_freed(self.spark):
            df.write.parquet(f"{self.root}/{copy}")
        size = sum(self._files(copy).values())
        rows = self._read_folders([copy], df.schema)
        # Equal values take next to nothing in a file, but not in a sort.
        sorted_bytes = memory_bytes(rows)
        listing.file_bytes = min(FILE_BYTES, size * SORT_BYTES // max(sorted_bytes, 1))
        files = max(size // FILE_BYTES, sorted_bytes // SORT_BYTES) + 1
        written = write(rows.select("*", *day).repartitionByRange(max(files, least), *by))
        path, fs = self._hadoop_path(copy)
        fs.delete(path, True)
        return written

    def _cuts(self, rows: DataFrame) -> list[Column]:
        """Conditions that cut the rows into slices of about the same number, in the order of the keys.

        Nulls are smallest in it, as in a struct, so each row meets one condition.
        """
        size, schema = input_bytes(rows), rows.schema
        if size <= SLICE_BYTES or not all(isinstance(schema[k].dataType, _RANGED) for k in self.keys):
            return []
        wanted = min(size // SLICE_BYTES + 1, MOST_SLICES)
        drawn = F.xxhash64(*self.keys)
        with shuffles_freed(self.spark):
            sample = rows.select(*self.keys).filter(F.pmod(drawn, F.lit(SAMPLED_OF)) == 0)
            sample = sample.orderBy(drawn, *self.keys).limit(SAMPLED_KEYS).orderBy(*self.keys).collect()
        at = [sample[i * len(sample) // wanted] for i in range(1, wanted) if sample]
        at = list(dict.fromkeys(at))
        first = F.col(self.keys[0])

        def key_of(bound: Row) -> list[Column]:
            return [F.lit(v).cast(schema[k].dataType).alias(k) for k, v in zip(self.keys, bound)]

        def cut(low: Row | None, high: Row | None) -> Column:
            # The bounds of the first part come first: a scan can use them, and they spare most rows the others.
            has_floor = low is not None and low[0] is not None
            tests = [first >= key_of(low)[0]] if has_floor else []
            if high is not None:
                below = first <= key_of(high)[0]
                tests.append(below if has_floor else first.isNull() | below)
                tests.append(F.struct(*self.keys) < F.struct(*key_of(high)))
            if low is not None:
                tests.append(F.struct(*self.keys) >= F.struct(*key_of(low)))
            return reduce(and_, tests)

        return [cut(low, high) for low, high in zip([None, *at], [*at, None])] if at else []

    def _write_changes(
        self, changes: DataFrame, slices: Slices | None, listing: Listing, least: int
    ) -> dict[str, int]:
        """Write the changes of a merge in files, by slices if they are made of much; returns the files and sizes."""
        cuts = self._cuts(slices.rows) if slices else []
        if not cuts:
            return self._write_files(changes, listing, least)
        written: dict[str, int] = {}
        for part in slices.make(cuts):
            written |= self._write_files(part, listing, -(-least // len(cuts)), True)
        return written

    def _files(self, run: str) -> dict[str, int]:
        """Data files below a folder, with their sizes."""
        path, fs = self._hadoop_path(run)
        found: dict[str, int] = {}
        files = fs.listFiles(path, True)
        while files.hasNext():
            file = files.next()
            if file.getPath().getName().endswith(".parquet"):
                name = file.getPath().toString()
                found[name[name.rindex(f"/{run}/") + 1 :]] = file.getLen()
        return found

    def _key_facts(self, rows: DataFrame, more: Sequence[Column] = ()) -> Row:
        """Count, size and range of the keys, in one pass."""
        size = sum(
            (F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) + 16 for k in self.keys), F.lit(0)
        )
        first = F.col(self.keys[0])
        return rows.agg(
            F.count("*").alias("__rows"),
            F.coalesce(F.sum(size), F.lit(0)).alias("__bytes"),
            F.min(first).alias("__low"),
            F.max(first).alias("__high"),
            *more,
        ).first()

    def _in_range(self, rows: DataFrame, facts: Row) -> DataFrame:
        """Rows whose first key part lies between the arriving ones; the scan uses the bounds."""
        kind = rows.schema[self.keys[0]].dataType
        if facts["__low"] is None or not isinstance(kind, _RANGED):
            return rows
        low, high = (F.lit(facts[n]).cast(kind) for n in ("__low", "__high"))
        return rows.filter(F.col(self.keys[0]).between(low, high))

    def _sent(self, keys: DataFrame, facts: Row) -> DataFrame:
        return F.broadcast(keys) if facts["__bytes"] <= KEY_BYTES else keys

    def matching(self, arriving: DataFrame) -> DataFrame:
        """Stored rows that can share a key with ``arriving``.

        ``arriving`` holds the keys as the table stores them. Row groups out of their range
        are not read. If they are small enough they are sent to every task, so the stored
        rows are reduced before any shuffle.
        """
        small = SMALL_TABLE_BYTES if self._small_bytes is None else self._small_bytes
        if sum(self.listing().folders.values()) <= small:
            return self.read()
        facts = self._key_facts(arriving)
        if not facts["__rows"]:
            return self.spark.createDataFrame([], self.schema())
        rows = self._in_range(self.read(), facts)
        if facts["__bytes"] > KEY_BYTES:
            return rows
        return rows.join(F.broadcast(arriving.select(*self.keys)), self.keys, "left_semi")

    def _holding(self, files: Sequence[str], schema: T.StructType, keys: DataFrame, facts: Row) -> list[str]:
        """The files that hold any of the keys."""
        if len(files) < 2 or not facts["__rows"]:
            return list(files) if facts["__rows"] else []
        rows = self._read_folders(files, T.StructType([schema[k] for k in self.keys]))
        # The name of a file stands behind the root in every file system.
        name = F.regexp_extract("_metadata.file_path", r"/(data/.*)$", 1)
        rows = self._in_range(rows.select(*self.keys, name.alias(_FILE)), facts)
        with shuffles_freed(self.spark):
            met = rows.join(self._sent(keys, facts), self.keys, "left_semi").select(_FILE).distinct().collect()
        plain = {unquote(f): f for f in files}
        return sorted(plain[unquote(r[0])] for r in met)

    def highest(self, name: str) -> Any:
        """The largest value a writer has recorded under this name, or None."""
        value = self.listing().highest.get(name)
        return datetime.fromisoformat(value) if isinstance(value, str) else value

    def merge(
        self,
        changes: DataFrame,
        writer: str | None = None,
        batch: str = "",
        highest: Mapping[str, Column] | None = None,
        slices: Slices | None = None,
    ) -> int:
        """Replace or add the rows of ``changes``; returns how many there were.

        The columns of ``changes`` become the columns of the table. A batch that its
        writer has already published is skipped. ``highest`` names aggregates (numbers
        or times) over the changes whose maximum is kept with the table, so that it can
        be known without reading the table. With ``slices`` many changes are made and stored
        one slice of their keys after the other.
        """
        listing = self.listing()
        if writer is not None and listing.applied.get(writer) == batch:
            return 0
        schema = changes.schema
        first = not listing.folders
        listing.parts = listing.parts or self._wanted_parts or 1
        # Written once, so that the files they touch are known before any is rewritten and a
        # lost executor does not repeat the work behind them.
        written = self._write_changes(changes, slices, listing, listing.parts if first else 1)
        fresh = self._read_folders(list(written), schema)
        facts = self._key_facts(fresh, [c.alias(n) for n, c in (highest or {}).items()])
        for name in highest or {}:
            known = [v for v in (_storable(facts[name]), listing.highest.get(name)) if v is not None]
            if known:
                listing.highest[name] = max(known)
        if first:
            listing.folders = written
        else:
            previous = T.StructType.fromJson(json.loads(listing.schema))
            keys = fresh.select(*self.keys)
            # A column that changed its type forces all files to be written again.
            if any(_types(schema).get(n, t) != t for n, t in _types(previous).items()):
                stale = sorted(listing.folders)
            else:
                stale = self._holding(sorted(listing.folders), previous, keys, facts)
            rewritten: dict[str, int] = {}
            if stale:
                old = align(self._read_folders(stale, previous), schema)
                left = old.join(self._sent(keys, facts), self.keys, "left_anti")
                in_place = facts["__bytes"] <= KEY_BYTES
                rewritten = self._write_left(left) if in_place else self._write_files(left, listing)
            listing.folders = _without(listing.folders, stale) | rewritten | written
            self._gather_small(listing, schema)
        listing.schema = schema.json()
        if writer is not None:
            listing.applied[writer] = batch
        self._publish(listing)
        return facts["__rows"]

    def _gather_small(self, listing: Listing, schema: T.StructType) -> None:
        """Put the small files of a day, or of a table without days, together when they are many."""
        small: dict[str, list[str]] = {}
        full = listing.file_bytes or FILE_BYTES
        for file, size in listing.folders.items():
            if size < full // 4:
                small.setdefault(self._day_of(file), []).append(file)
        many = [f for files in small.values() if len(files) > MANY_SMALL + listing.parts for f in files]
        if many:
            least = 1 if self.day_column else listing.parts
            gathered = self._write_files(self._read_folders(sorted(many), schema), listing, least)
            listing.folders = _without(listing.folders, many) | gathered

    def overwrite(self, df: DataFrame) -> None:
        """Publish exactly these rows."""
        listing = self.listing()
        listing.parts = listing.parts or self._wanted_parts or 1
        listing.folders = self._write_files(df, listing, listing.parts)
        listing.schema = df.schema.json()
        self._publish(listing)

    def delete(self, condition: Column) -> int:
        """Remove the rows where ``condition`` is true; returns how many went.

        Only files with such rows are written again.
        """
        listing = self.listing()
        if not listing.folders:
            return 0
        plain = {unquote(f): f for f in listing.folders}
        name = F.regexp_extract("_metadata.file_path", r"/(data/.*)$", 1)
        counts = self.read().filter(condition).groupBy(name.alias(_FILE)).count()
        removed = {plain[unquote(r[0])]: r[1] for r in counts.collect()}
        if not removed:
            return 0
        rows = self._read_folders(sorted(removed), self.schema())
        rewritten = self._write_left(rows.filter(~condition | condition.isNull()))
        listing.folders = _without(listing.folders, list(removed)) | rewritten
        self._publish(listing)
        return sum(removed.values())

    def _day_of(self, file: str) -> str:
        return _day_of(file.rsplit("/", 1)[0]) if self.day_column else ""

    def drop_days_before(self, first_kept: date) -> int:
        """Remove whole days; rows without a day stay. No file is rewritten, and none of a kept day is read."""
        listing = self.listing()
        old = [f for f in listing.folders if self._day_of(f) < first_kept.isoformat()]
        if not old or not self.day_column:
            return 0
        removed = self._read_folders(sorted(old), self.schema()).count()
        listing.folders = _without(listing.folders, old)
        self._publish(listing)
        return removed


class AppendTable(_StoredTable):
    """Append-only rows in one folder per day of ``day_column``, so days drop whole."""

    DAY = "_day"

    def __init__(self, spark: SparkSession, root: str, day_column: str):
        super().__init__(spark, root)
        self.day_column = day_column

    def _publish_more(
        self, listing: Listing, folders: dict[str, int], schema: T.StructType
    ) -> None:
        listing.folders |= folders
        listing.schema = schema.json()
        self._publish(listing)

    def append(self, df: DataFrame) -> int:
        """Add rows; returns how many."""
        day = F.col(self.day_column).cast("date").cast("string")
        fresh = self._write_split(df, day, self.DAY)
        self._publish_more(self.listing(), fresh, df.schema)
        return self._read_folders(list(fresh), df.schema).count()

    def append_rows(
        self,
        rows: Sequence[Mapping[str, Any]],
        schema: T.StructType,
        id_column: str,
    ) -> None:
        """Append a few rows made by the driver, numbered on from the last id.

        All rows of one call belong to the day of the first one.
        """
        listing = self.listing()
        first = listing.serial + 1
        data = [
            {f.name: first + i if f.name == id_column else r.get(f.name) for f in schema.fields}
            for i, r in enumerate(rows)
        ]
        folder = f"data/{uuid.uuid4().hex[:16]}/{self.DAY}={rows[0][self.day_column]:%Y-%m-%d}"
        # An Arrow table becomes a local relation, so no Python worker is started.
        table = pa.Table.from_pylist(data, schema=to_arrow_schema(schema))
        self.spark.createDataFrame(table, schema).coalesce(1).write.parquet(f"{self.root}/{folder}")
        listing.serial += len(rows)
        self._publish_more(listing, {folder: 0}, schema)

    def overwrite(self, df: DataFrame) -> None:
        """Publish exactly these rows; ids go on from where they were."""
        listing = self.listing()
        listing.folders = {}
        day = F.col(self.day_column).cast("date").cast("string")
        self._publish_more(listing, self._write_split(df, day, self.DAY), df.schema)

    def drop_days_before(self, first_kept: date) -> int:
        """Remove whole days; rows without a day stay. No file is rewritten."""
        listing = self.listing()
        old = [f for f in listing.folders if _day_of(f) < first_kept.isoformat()]
        if not old:
            return 0
        removed = self._read_folders(sorted(old), self.schema()).count()
        listing.folders = _without(listing.folders, old)
        self._publish(listing)
        return removed


def _day_of(folder: str) -> str:
    day = folder.rsplit("=", 1)[1]
    # The folder of rows without a day sorts after every date.
    return "~" if day.startswith("__") else day


def _without(folders: dict[str, int], gone: Sequence[str]) -> dict[str, int]:
    return {f: size for f, size in folders.items() if f not in set(gone)}


def input_bytes(df: DataFrame) -> int:
    """Size of the files and tables a query reads, as far as Spark knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    # Data without a known size reports an enormous one.
    return sum(s for s in sizes if s < 1 << 60)


def memory_bytes(rows: DataFrame) -> int:
    """Size of the rows in a sort: a word for each column, what texts and the like hold, and the pointers."""
    fixed, held = 48, []
    for f in rows.schema.fields:
        kind, value = f.dataType, F.col(f"`{f.name.replace('`', '``')}`")
        fixed += 8
        if isinstance(kind, T.DecimalType):
            fixed += 16
        elif isinstance(kind, (T.StringType, T.BinaryType)):
            held.append(F.octet_length(value) + 8)
        elif not isinstance(kind, (T.NumericType, T.BooleanType, T.DatetimeType)):
            held.append(F.octet_length(value.cast("string")) + 8)
    each = sum((F.coalesce(h, F.lit(0)) for h in held), F.lit(fixed))
    return rows.agg(F.coalesce(F.sum(each.cast("bigint")), F.lit(0))).first()[0]


def _storable(value: Any) -> Any:
    return value.isoformat(timespec="microseconds") if isinstance(value, datetime) else value


def _types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}
