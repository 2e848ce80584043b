"""How filters of a corpus overlap, under every order in which they could be applied.

Each document gets a mask of the filters it fails, from built-in functions alone. Masks are counted
per part, so a part of any size comes to at most 2^n cells before its diagram is built in one task.

A diagram has one level per filter and from each node a pass and a fail edge. A node carries the
weight of all documents below it: how many, how many good, how many toxic. Equal nodes are shared, a
node without documents is left out. Swapping two adjacent levels touches these two levels only; the
plain changes of n filters are n! - 1 such swaps, and after each one the all-pass path from the root
holds the steps of that order: the weight behind the fail edge goes, that behind the pass edge stays.

A copy is known by the SHA-256 of its text. The first id of each text is a grouped minimum, met again
by (digest, id), so that a text that a third of all documents share is never in one task.

Defined results: a null text is an empty one, a null part an empty string. A row without an id has no
smaller one and is none to others; it has no labels. Repeated rows count each, equal ids aren't smaller
than one another. A document with several label rows is good or toxic if any of them says so. An
empty table has no parts and no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, mapped

APART = r"[\x20\x09-\x0D]+"
ZERO = 0
NOTHING = (0, 0, 0)
SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


class Diagram:
    """Weights of failure masks, a level per filter; node 0 stands for no documents at any level."""

    def __init__(self, names: str, cells: Mapping[int, tuple[int, ...]]):
        """``cells`` holds the weight of each mask; bit n is set where filter n of ``names`` fails."""
        self.order = list(names)
        self.weights: list[tuple[int, ...]] = [NOTHING]
        self.levels: list[dict[int, tuple[int, int]]] = [{} for _ in names]
        ends: dict[tuple[int, ...], int] = {}
        below: dict[int, int] = {}
        for mask, weight in cells.items():
            if weight != NOTHING:
                if weight not in ends:
                    ends[weight] = self._add(weight)
                below[mask] = ends[weight]
        # From the last level up: two masks that differ in one bit become the edges of one node.
        for level in range(len(names) - 1, -1, -1):
            made: dict[tuple[int, int], int] = {}
            bit, above = 1 << level, {}
            for rest in sorted({m & ~bit for m in below}):
                edges = below.get(rest, ZERO), below.get(rest | bit, ZERO)
                above[rest] = self._node(made, edges)
            self.levels[level] = {node: edges for edges, node in made.items()}
            below = above
        self.root = below.get(0, ZERO)

    def _add(self, weight: tuple[int, ...]) -> int:
        self.weights.append(weight)
        return len(self.weights) - 1

    def _node(self, made: dict[tuple[int, int], int], edges: tuple[int, int]) -> int:
        """The one node of a level with these edges."""
        if edges == (ZERO, ZERO):
            return ZERO
        if edges not in made:
            low, high = self.weights[edges[0]], self.weights[edges[1]]
            made[edges] = self._add(tuple(a + b for a, b in zip(low, high)))
        return made[edges]

    def _edges(self, level: int, node: int) -> tuple[int, int]:
        return self.levels[level].get(node, (ZERO, ZERO))

    def swap(self, level: int) -> None:
        """Exchange a level with the next; its nodes stay for the same documents, so none above changes."""
        made: dict[tuple[int, int], int] = {}
        upper = self.levels[level]
        for node, (low, high) in upper.items():
            (pp, pf), (fp, ff) = self._edges(level + 1, low), self._edges(level + 1, high)
            upper[node] = self._node(made, (pp, fp)), self._node(made, (pf, ff))
        self.levels[level + 1] = {node: edges for edges, node in made.items()}
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
        """(kept, removed) weights after each filter, along the path that passes all."""
        node, found = self.root, []
        for level in range(len(self.order)):
            node, failed = self._edges(level, node)
            found.append((self.weights[node], self.weights[failed]))
        return found


def plain_changes(n: int) -> Iterator[int]:
    """Places of the adjacent exchanges that lead through all orders of n things, each once."""
    if n < 2:
        return
    inner = plain_changes(n - 1)
    while True:
        for places, shift in ((range(n - 2, -1, -1), 1), (range(n - 1), 0)):
            yield from places
            place = next(inner, None)
            if place is None:
                return
            yield place + shift


def audit_part(names: str, cells: Mapping[int, tuple[int, ...]]) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part."""
    diagram = Diagram(names, cells)
    orders = {"".join(diagram.order): diagram.steps()}
    for place in plain_changes(len(names)):
        diagram.swap(place)
        orders["".join(diagram.order)] = diagram.steps()
    fails, alone, total = dict.fromkeys(names, 0), dict.fromkeys(names, 0), dict.fromkeys(names, 0)
    for order, steps in orders.items():
        # First, a filter removes all that fail it; last, those that fail nothing else.
        fails[order[0]] = steps[0][1][0]
        alone[order[-1]] = steps[-1][1][0]
        for name, (_, removed) in zip(order, steps):
            total[name] += removed[0]
    return [
        (order, n, kept[0], gone[0], fails[name] - gone[0], alone[name], gone[1], gone[2], total[name])
        for order, steps in orders.items()
        for n, (name, (kept, gone)) in enumerate(zip(order, steps), 1)
    ]


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of a text: A short, B repetitive, C many capitals, D signs of markup."""
    words = F.array_remove(F.split(text, APART, -1), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_cells(docs: DataFrame, labels: DataFrame, copies: str = "E", id_col: str = "doc_id", text: str = "text", part: str = "source") -> tuple[str, DataFrame]:
    """The letters of the filters in order of their bits, and (part, mask, n, good, toxic)."""
    rows = docs.select(
        docs[id_col].alias("id"),
        F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )
    filters = text_filters(F.col("text"))
    names = "".join(filters)
    rows = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(f"fails_{n}") for n, c in filters.items()])
    mask = sum((F.col(f"fails_{n}").cast("int") * (1 << at) for at, n in enumerate(names)), F.lit(0))
    rows = cut(rows.select("id", "part", "digest", mask.alias("mask")).groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")))
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(True))
    rows = rows.join(first, ["digest", "id"], "left")
    copy = F.col("id").isNotNull() & F.col("is_first").isNull()
    mask = F.col("mask") + copy.cast("int") * (1 << len(names))
    rows = rows.groupBy("id", "part", mask.alias("mask")).agg(F.sum("n").alias("n"))
    known = labels.select(labels[id_col].alias("id"), labels["quality"].alias("quality"), labels["toxic"].alias("toxic"))
    known = known.filter("id is not null").groupBy("id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    rows = rows.join(known, "id", "left")
    cells = rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    return names + copies, cells


def audit(cells: DataFrame, names: str) -> DataFrame:
    """Every order and step of every part, from (part, mask, n, good, toxic)."""
    # At most one cell for each mask of a part.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    parts = parts.select("part", *[F.col(f"cells.{c}").alias(c) for c in ("mask", "n", "good", "toxic")])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, masks, *weights in frame.itertuples(index=False):
                rows = {int(m): tuple(map(int, w)) for m, *w in zip(masks, *weights)}
                found = pd.DataFrame(audit_part(names, rows))
                found.insert(0, "part", part)
                found.columns = ["part", *(c.split()[0] for c in SCHEMA.split(", ")[1:])]
                yield found

    return mapped(parts, run, SCHEMA)


def audit_documents(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The audit of the five filters over a whole table of documents."""
    names, cells = failure_cells(docs, labels, **columns)
    return audit(cells, names)
