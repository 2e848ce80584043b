"""SimHash near-duplicates: fingerprints, exact links within a radius, connected components.

Two fingerprints that differ in at most r bits agree in two of r + 2 blocks of bits at least. Each
distinct fingerprint therefore goes to one cell for every pair of blocks, and only fingerprints in
one cell are compared. A cell is cut into tiles of one population count; tiles whose counts differ
by more than r never meet. Within a pair of tiles the comparison is exact: numpy exclusive-or and
bit counts, searched outwards from one fingerprint after another. It passes on a star for each
group it finds, not all pairs, which keeps every connection.

Copies share a fingerprint and are compared once. Components come from alternating star steps over
distinct fingerprints; each step is written to the checkpoint folder.

Defined results: a text without words, or null, has fingerprint zero and is linked like any other;
rows that share a fingerprint are linked; a null id is never the smallest unless it is alone, then
the component id is null; repeated rows each get their component. Of rows that share id and text with
the keeper the least by all other columns stays (columns that hold maps can't be ordered and don't count).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, mapped, text_key, unused, whole_groups

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints in one tile at most, on average; a task compares two tiles at a time.
TILE = 4096
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash over word shingles, A-Z lowered, as an unsigned number."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    begins, ends = starts[: len(words) - shingle + 1].tolist(), (starts[shingle:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends)], dtype="<u8")
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        part = hashes[at : at + AT_ONCE]
        spread = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += spread.sum(axis=0, dtype=np.uint32)
    on = np.packbits(bits * 2 > len(hashes), bitorder="little")
    return int(on.view("<u8")[0])


def with_fingerprint(docs: DataFrame, ids: list[str], text: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """Columns ``ids`` of each row and its fingerprint as a signed long."""
    inner = unused(docs, "__text")
    rows = docs.select(*[docs[c] for c in ids], docs[text].alias(inner))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = np.array([fingerprint(t, shingle) for t in frame.pop(inner)], dtype=np.uint64)
            frame[name] = made.view(np.int64)
            yield frame

    return mapped(rows, run, f"{kinds}, `{name}` long")


def _cells(fp: Column, radius: int) -> Column:
    """One (number of the pair of blocks, their bits) for every pair of blocks."""
    blocks, edges = radius + 2, [64 * n // (radius + 2) for n in range(radius + 3)]
    bits = [
        F.shiftrightunsigned(fp, edges[n]).bitwiseAND(F.lit((1 << (edges[n + 1] - edges[n])) - 1))
        for n in range(blocks)
    ]
    pairs = list(combinations(range(blocks), 2))
    return F.array(
        *[
            F.struct(F.lit(n).alias("blocks"), bits[a].alias("first"), bits[b].alias("second"))
            for n, (a, b) in enumerate(pairs)
        ]
    )


def group_within(found: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the smallest one that links within the radius lead to.

    Sorted by population count, a step compares the newest members with those not yet reached
    whose count is near enough.
    """
    counts = np.bitwise_count(found)
    order = np.lexsort((found, counts))
    values, counts = found[order], counts[order].astype(np.int64)
    group = np.arange(len(values))
    left = np.arange(len(values))  # not reached yet, in order of the count
    while len(left):
        front, left = left[:1], left[1:]
        seed = front[0]
        while len(front) and len(left):
            near = np.zeros(len(left), dtype=bool)
            for at in range(0, len(front), 256):
                some = front[at : at + 256]
                low = np.searchsorted(counts[left], counts[some].min() - radius, "left")
                high = np.searchsorted(counts[left], counts[some].max() + radius, "right")
                for b in range(low, high, TILE):
                    e = min(b + TILE, high)
                    apart = np.bitwise_count(values[some][:, None] ^ values[left[b:e]][None, :])
                    near[b:e] |= (apart <= radius).any(axis=0)
            front, left = np.sort(left[near]), left[~near]
            group[front] = seed
    lowest = np.full(len(values), np.iinfo(np.int64).max)
    np.minimum.at(lowest, group, values.view(np.int64))
    smallest = np.empty(len(values), dtype=np.int64)
    smallest[order] = lowest[group]
    return smallest


def links(prints: DataFrame, name: str, radius: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all within the radius."""
    cells = prints.select(
        F.col(name).alias("fp"),
        F.bit_count(name).alias("ones"),
        F.explode(_cells(F.col(name), radius)).alias("cell"),
    )
    sizes = cells.groupBy("cell", "ones").agg(F.count("*").alias("n"))
    shared = sizes.groupBy("cell").agg(
        F.sum("n").alias("total"),
        F.map_from_entries(
            F.collect_list(F.struct("ones", F.ceil(F.col("n") / F.lit(TILE)).cast("int").alias("tiles")))
        ).alias("tiles"),
    )
    shared = shared.filter("total > 1")
    rows = cells.join(shared, "cell")
    # A cell of one tile is one group; in a larger one a row goes to each pair its tile is part of.
    own = F.struct(F.col("ones"), F.pmod(F.xxhash64("fp"), F.col("tiles")[F.col("ones")]).cast("int").alias("tile"))
    others = F.flatten(
        F.transform(
            F.filter(F.map_keys("tiles"), lambda p: F.abs(p - F.col("ones")) <= radius),
            lambda p: F.transform(
                F.sequence(F.lit(0), F.col("tiles")[p] - 1), lambda t: F.struct(p.alias("ones"), t.alias("tile"))
            ),
        )
    )
    whole = F.struct(F.lit(-1).alias("ones"), F.lit(0).alias("tile"))
    pairs = F.when(
        F.col("total") <= TILE, F.array(F.struct(whole.alias("low"), whole.alias("high")))
    ).otherwise(
        F.transform(
            F.col("others"),
            lambda o: F.struct(F.least(F.col("own"), o).alias("low"), F.greatest(F.col("own"), o).alias("high")),
        )
    )
    rows = rows.withColumn("own", own).withColumn("others", others)
    met = rows.select("fp", F.explode(pairs).alias("pair"), "cell")
    met = met.select("fp", F.xxhash64("cell", "pair").alias("meeting"))
    # Two meetings with one hash only compare more; the comparison itself is exact.
    met = met.repartition("meeting").sortWithinPartitions("meeting")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, "meeting"):
            yield _linked(frame, radius)

    return mapped(met, run, "a long, b long").distinct()


def _linked(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    meeting, fp = frame["meeting"].to_numpy(), frame["fp"].to_numpy()
    edges = np.flatnonzero(np.diff(meeting)) + 1
    froms, tos = [], []
    for a, b in zip([0, *edges], [*edges, len(fp)]):
        if b - a > 1:
            smallest = group_within(fp[a:b].view(np.uint64), radius)
            apart = smallest != fp[a:b]
            froms.append(fp[a:b][apart])
            tos.append(smallest[apart])
    none = np.zeros(0, dtype=np.int64)
    return pd.DataFrame({"a": np.concatenate([none, *froms]), "b": np.concatenate([none, *tos])})


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); the root is the smallest node reachable.

    Large-star and small-star steps in turn. A step takes the smallest neighbour by grouped
    minimum and joins it back, so a node with very many neighbours is never gathered.
    """
    edges = cut(edges.filter("a <> b"))
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        edges = cut(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = MAX_BITS) -> DataFrame:
    """(id, text_key, fp, component_id, keeper) for each row.

    ``keeper`` is the (id, text_key) of the one row of the component that would stay.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text].alias("text"), text_key(docs[text]).alias("text_key"))
    prints = cut(with_fingerprint(rows, ["id", "text_key"], "text", "fp", shingle))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key"))
    by_print = prints.groupBy("fp").agg(first.alias("first"))
    by_print = cut(by_print)
    roots = components(links(by_print, "fp", radius))
    member = by_print.join(roots, by_print["fp"] == roots["node"], "left")
    member = member.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first").alias("first"))
    found = member.select("fp", "root").join(least, "root").select(
        "fp",
        F.col("first.id").alias("component_id"),
        F.struct(F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key")).alias("keeper"),
    )
    return prints.join(found, "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = MAX_BITS) -> DataFrame:
    """One row of each component, with the columns of ``docs``."""
    found = near_duplicates(docs, id_col, text, shingle, radius)
    kept = F.col("id").eqNullSafe(F.col("keeper.id")) & (F.col("text_key") == F.col("keeper.text_key"))
    stay = found.filter(kept).groupBy("id", "text_key").agg((F.count("*") > 1).alias("__many"))
    stay = cut(stay.select(F.col("id").alias("__id"), F.col("text_key").alias("__key"), "__many"))
    own, own_id = unused(docs, "__own"), unused(docs, "__own_id")
    keyed = docs.withColumns({own: text_key(docs[text]), own_id: docs[id_col]})

    def those(many: bool) -> DataFrame:
        of = stay.filter(F.col("__many") == many)
        return keyed.join(of, keyed[own_id].eqNullSafe(of["__id"]) & (keyed[own] == of["__key"]), "left_semi")

    # Only rows that share id and text are compared: the least by all other columns that can be ordered.
    rows = those(True)
    others = [f.name for f in rows.schema.fields if f.name not in (own_id, own, id_col, text)]
    ordered = [f.name for f in rows.schema.fields if f.name in others and "map<" not in f.dataType.simpleString()]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rank = F.struct(F.lit(0).alias("r"), *[F.col(f"`{c}`") for c in ordered])
    least = rows.groupBy(own_id, own).agg(F.min_by(whole, rank).alias("row")).select("row.*")
    return those(False).select(*[keyed[c] for c in docs.columns]).union(least)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
