"""Product codes of vectors: a codebook per part position, trained under adaptive distance bounds.

Components become integers, so sums, distances and ties are exact on any machine. A vector is cut
into parts; a part is coded by the nearest entry of its position's codebook.

The first assignment measures all entries and stores with each part its b closest ones, each with a
lower bound of its distance, and one outer bound for all others. After the entries have moved, a
bound shrinks by the move of its entry, the outer one by the largest move. An entry whose bound is
above the exact distance to the part's own entry can't be nearer; the others, few as bounds are
ordered, are measured in integers, and only where the outer bound fails as well all entries are.
Bounds are whole numbers rounded so that they never claim too much, so codes are those of a full
comparison. Each batch sets b anew from the entries it had to measure.

Vectors with their bounds are written to the shared folder after each assignment, so a lost executor
repeats one assignment at most; the state before is then removed. Only codebooks, whose size is
fixed by their entries and the width of a vector, pass through the driver.

Defined results: a vector that is null, or holds null or non-finite components, is dropped, and so is
one whose length differs from that of the smallest id (such parts can't be compared). Components
beyond 65,536 in size count as that much. Repeated ids are coded each; of equal ids the smallest
vector starts an entry. Ids that are null come last. Fewer ids than entries make a smaller codebook;
without a vector there are no rows. Widths that can't be cut evenly give parts that differ by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import _ship, cut
from tidemark.session import work_folder

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Largest size of an integer component; keeps squared distances exact in 64 bits.
MOST = 1 << 24
#: Steps of a bound within one unit of distance.
FINE = 4
FAR = np.int32(2**31 - 1)
#: Values that a batch measures at once.
AT_ONCE = 1 << 21
#: Entries that a part keeps at least.
LEAST_NEAR = 2
#: A label with this share of all rows at least is joined by broadcast: there are few of them.
HOT_SHARE = 1000


def whole(values: np.ndarray) -> np.ndarray:
    """Components as integers, rounded down."""
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int64)


def cuts(width: int, parts: int) -> list[tuple[int, int]]:
    edges = [width * n // parts for n in range(parts + 1)]
    return list(zip(edges[:-1], edges[1:]))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of a to every row of b."""
    found = np.zeros((len(a), len(b)), dtype=np.int64)
    for n in range(a.shape[1]):
        apart = a[:, n, None] - b[None, :, n]
        found += apart * apart
    return found


def _below(squared: np.ndarray) -> np.ndarray:
    """Bounds that are never above the distance."""
    return np.clip(np.floor(np.sqrt(squared.astype(np.float64)) * FINE) - 1, 0, FAR).astype(np.int64)


def _above(squared: np.ndarray) -> np.ndarray:
    """Bounds that are never below the distance."""
    return np.where(squared == 0, 0, np.ceil(np.sqrt(squared.astype(np.float64)) * FINE) + 1).astype(np.int64)


def nearest(values: np.ndarray, book: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By full comparison: the closest entries, their bounds, the outer bound, the least squared distance."""
    keep, size = min(keep, len(book)), len(book)
    near = np.empty((len(values), keep), dtype=np.int64)
    low = np.empty((len(values), keep), dtype=np.int64)
    outer = np.full(len(values), FAR, dtype=np.int64)
    least = np.empty(len(values), dtype=np.int64)
    step = max(1, AT_ONCE // max(size, 1))
    for at in range(0, len(values), step):
        some = slice(at, at + step)
        # Ties go to the lower index.
        ranked = _exact(values[some], book) * size + np.arange(size)
        if keep < size:
            ranked = np.partition(ranked, keep, axis=1)[:, : keep + 1]
        ranked.sort(axis=1)
        near[some] = ranked[:, :keep] % size
        squared = ranked // size
        low[some] = _below(squared[:, :keep])
        least[some] = squared[:, 0]
        if keep < size:
            outer[some] = _below(squared[:, keep])
    return near, low, outer, least


def renew(values: np.ndarray, book: np.ndarray, moves: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """The same after the entries have moved, and how many entries each part had to measure."""
    keep = min(keep, len(book))
    low = np.where(low == FAR, FAR, low - moves[near])
    outer = np.where(outer == FAR, FAR, outer - moves.max())
    own = near[:, 0]
    apart = values - book[own]
    least = (apart * apart).sum(axis=1)
    reach = _above(least)
    maybe = low <= reach[:, None]
    maybe[:, 0] = False
    rows, slots = np.nonzero(maybe)
    apart = values[rows] - book[near[rows, slots]]
    squared = (apart * apart).sum(axis=1)
    low[:, 0] = _below(least)
    low[rows, slots] = _below(squared)
    # The least squared distance, then the lowest index.
    best = least * len(book) + own
    np.minimum.at(best, rows, squared * len(book) + near[rows, slots])
    own, least = best % len(book), best // len(book)
    first = near == own[:, None]
    first &= np.cumsum(first, axis=1) == 1
    order = np.argsort(np.where(first, -1, low), axis=1, kind="stable")
    near, low = np.take_along_axis(near, order, axis=1), np.take_along_axis(low, order, axis=1)
    used = 1 + maybe.sum(axis=1)
    if keep < near.shape[1]:
        outer = np.minimum(outer, low[:, keep])
        near, low = near[:, :keep], low[:, :keep]
    elif keep > near.shape[1]:
        more = ((0, 0), (0, keep - near.shape[1]))
        near, low = np.pad(near, more, mode="edge"), np.pad(low, more, constant_values=FAR)
    open_ = np.flatnonzero(outer <= reach)
    if len(open_):
        near[open_], low[open_], outer[open_], least[open_] = nearest(values[open_], book, keep)
        used[open_] = len(book)
    return near, low, outer, least, used


def adapted(used: np.ndarray, keep: int, size: int) -> int:
    """How many entries to keep next: enough for nearly all parts of the batch, more if many needed all."""
    if len(used) == 0:
        return keep
    if (used >= size).mean() > 0.05:
        return min(2 * keep, size)
    return int(np.clip(np.quantile(used[used < size], 0.99) + 1, LEAST_NEAR, max(size // 2, 1)))


def _matrix(column: pa.Array, kind: type = np.int64) -> np.ndarray:
    """A list column whose lists are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind) if len(column) else np.zeros((0, 0), dtype=kind)


def _padded(column: pa.Array, parts: int, fill: int) -> np.ndarray:
    """Lists of all parts of a row; rows of other batches may keep fewer entries."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False) // parts
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    found = np.full((len(column), parts, int(sizes.max(initial=0))), fill, dtype=np.int64)
    at = np.arange(found.shape[2])[None, None, :] < sizes[:, None, None]
    found[np.broadcast_to(at, found.shape)] = flat
    return found


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    rows = values.reshape(len(values), -1)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def _state(batch: pa.RecordBatch, numbers: pa.Array, near: list[np.ndarray], low: list[np.ndarray], outer: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id"),
            batch.column("label"),
            numbers,
            _lists(np.stack([n[:, 0] for n in near], axis=1), pa.int16()),
            _lists(np.stack(near, axis=1), pa.int16()),
            _lists(np.stack(low, axis=1), pa.int32()),
            _lists(np.stack(outer, axis=1), pa.int32()),
        ],
        names=["id", "label", "numbers", "code", "near", "low", "outer"],
    )


class Coder:
    """Codebooks, how far their entries moved, and the assignments under them."""

    def __init__(self, books: list[np.ndarray], moves: list[np.ndarray] | None = None):
        self.books, self.moves = books, moves
        self.at = np.cumsum([0, *[b.shape[1] for b in books]])

    def _part(self, values: np.ndarray, n: int) -> np.ndarray:
        return values[:, self.at[n] : self.at[n + 1]]

    def begin(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = max(len(self.books[0]) // 8, LEAST_NEAR)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = whole(_matrix(batch.column("vector"), np.float64)).reshape(batch.num_rows, self.at[-1])
            found = [nearest(self._part(values, n), book, keep) for n, book in enumerate(self.books)]
            yield _state(batch, _lists(values, pa.int32()), *[[f[k] for f in found] for k in range(3)])

    def _renewed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        keep = max(len(self.books[0]) // 8, LEAST_NEAR)
        parts = len(self.books)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = _matrix(batch.column("numbers")).reshape(batch.num_rows, self.at[-1])
            near, low = _padded(batch.column("near"), parts, 0), _padded(batch.column("low"), parts, FAR)
            outer = _matrix(batch.column("outer"))
            found = [
                renew(self._part(values, n), book, self.moves[n], near[:, n], low[:, n], outer[:, n], keep)
                for n, book in enumerate(self.books)
            ]
            keep = adapted(np.concatenate([f[4] for f in found]), keep, len(self.books[0]))
            yield batch, found

    def go_on(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in self._renewed(batches):
            yield _state(batch, batch.column("numbers"), *[[f[k] for f in found] for k in range(3)])

    def finish(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in self._renewed(batches):
            code = np.stack([f[0][:, 0] for f in found], axis=1).astype(np.uint8)
            error = sum(f[3] for f in found)
            names = pa.array([row.tobytes().hex() for row in code])
            columns = [batch.column("id"), batch.column("label"), names, pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(part, entry, place, total, n) over all rows of the task; place -1 stands for the count alone."""
        totals = [np.zeros(book.shape, dtype=np.int64) for book in self.books]
        counts = np.zeros((len(self.books), len(self.books[0])), dtype=np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = _matrix(batch.column("numbers")).reshape(batch.num_rows, self.at[-1])
            code = _matrix(batch.column("code"))
            for n, total in enumerate(totals):
                np.add.at(total, code[:, n], self._part(values, n))
                counts[n] += np.bincount(code[:, n], minlength=counts.shape[1])
        rows = [
            (n, entry, place, int(total[entry, place]) if place >= 0 else 0, int(counts[n, entry]))
            for n, total in enumerate(totals)
            for entry in np.flatnonzero(counts[n]).tolist()
            for place in range(-1, total.shape[1])
        ]
        if rows:
            fields = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(fields, names=["part", "entry", "place", "total", "n"])

    def moved(self, sums: DataFrame) -> Coder:
        """The coder after every used entry went to the mean of its parts, rounded down."""
        books = [b.copy() for b in self.books]
        for row in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            if row["place"] >= 0:
                books[row["part"]][row["entry"], row["place"]] = row["total"] // row["n"]
        moves = [_above(((new - old) ** 2).sum(axis=1)) for new, old in zip(books, self.books)]
        return Coder(books, moves)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for b in self.books for v in b.ravel().tolist()).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """True for vectors whose components are all finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _first(rows: DataFrame, entries: int) -> list[list[float]]:
    """Vectors of the smallest ids, in order."""
    in_order = F.col("id").asc_nulls_last()
    ids = rows.select("id").distinct().orderBy(in_order).limit(entries)
    ids = ids.withColumnRenamed("id", "first_id")
    met = rows.join(F.broadcast(ids), F.col("id").eqNullSafe(F.col("first_id")), "left_semi")
    least = met.groupBy("id").agg(F.min("vector").alias("vector")).orderBy(in_order)
    return [r["vector"] for r in least.collect()]


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def code_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Coder | None]:
    """(id, label, code, error) of every usable vector, and the final codebooks."""
    spark = vectors.sparkSession
    _ship(spark)
    rows = vectors.select(vectors[id_col].alias("id"), vectors[label].alias("label"), vectors[vector].alias("vector")).filter(usable(F.col("vector")))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    smallest = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select(F.size("vector").alias("width")).limit(1).collect()
    own = T.StructType([T.StructField("id", kinds["id"]), T.StructField("label", kinds["label"])])
    final = T.StructType([*own, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not smallest:
        return spark.createDataFrame([], final), None
    width = smallest[0]["width"]
    rows = rows.filter(F.size("vector") == width)
    begun = _first(rows, entries)
    begun = whole(np.array(begun, dtype=np.float64).reshape(len(begun), width))
    coder = Coder([begun[:, a:b] for a, b in cuts(width, parts)])
    numbers = T.ArrayType(T.IntegerType())
    shorts = T.ArrayType(T.ShortType())
    state = T.StructType([*own, T.StructField("numbers", numbers), T.StructField("code", shorts), T.StructField("near", shorts), T.StructField("low", numbers), T.StructField("outer", numbers)])
    assigned, before = rows.mapInArrow(coder.begin, state), None
    for n in range(rounds):
        folder = work_folder(spark, f"vector-codes-{n}")
        assigned.write.option("compression", "zstd").parquet(folder)
        if before:
            _remove(spark, before)
        before = folder
        kept = spark.read.parquet(folder)
        sums = kept.select("numbers", "code").mapInArrow(coder.sums, "part int, entry int, place int, total long, n long")
        coder = coder.moved(sums)
        assigned = kept.mapInArrow(coder.go_on if n + 1 < rounds else coder.finish, state if n + 1 < rounds else final)
    return assigned, coder


def with_label_error(rows: DataFrame) -> DataFrame:
    """Rows of (id, label, code, error) and the errors summed over equal labels.

    A label with a thousandth of all rows is joined by broadcast, there being a thousand such labels at
    most; the rest is joined by shuffle, where no label is hot any more.
    """
    rows = cut(rows)
    sums = cut(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    total = sums.agg(F.sum("n")).first()[0] or 0
    sums = sums.select(F.col("label").alias("its_label"), "label_error", (F.col("n") * HOT_SHARE >= total).alias("hot"))
    same = F.col("label").eqNullSafe(F.col("its_label"))
    hot, rest = F.broadcast(sums.filter("hot")), sums.filter("not hot")
    few = rows.join(hot, same)
    many = rows.join(hot, same, "left_anti").join(rest, same)
    return few.select(*rows.columns, "label_error").union(many.select(*rows.columns, "label_error"))
