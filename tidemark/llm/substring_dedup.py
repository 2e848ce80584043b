"""Removal of long word spans that occur earlier in the corpus, by suffix automata of shards.

A window is ``LENGTH`` consecutive words of one document. A word goes if a window that covers it
also starts earlier: in a document of smaller id, or further left in its own.

Every document is reference and query alike, so one automaton of all of them would have no size
bound and could not be broadcast. The corpus is cut into shards by content, and documents are
streamed to the shards that can match:

1. The seed of a window is the smallest hash among its ``SEED_WORDS``-word shingles. Equal windows
   have equal seeds. Windows in a row with one seed form a stretch. Seeds at one place in the
   whole corpus are counted out; only the others are looked at again.
2. A stretch goes to the shard of its seed, in order of document and place. The shard reads the
   stretches one after another into one suffix automaton. Its suffix link tells for each word how
   long a span ending there has been read before: the matching statistics. From ``LENGTH`` words
   on, the span goes. A stretch that repeats an earlier one as a whole goes without another look.
3. Stretches of a seed with more than ``HOT`` occurrences are first grouped by content, combined in
   each task, so a passage that a third of all documents share reaches its shard once.
4. Ranges go back to their documents. Texts are dealt once, by a hash of id and text, so null and
   repeated ids spread; both joins read that one deal. Equal rows are dealt once, combined in each
   task; their number is counted apart and repeats the result.

Defined results: a null text has no words; null ids come last in order; rows with equal id and text
count as one document, so repeated rows get the same result; rows with equal id and different texts
are ordered by place, then by a hash of the text. Ids may be whole numbers, texts, dates or times;
ids of another type raise a TypeError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LAST_ID, mapped, text_key, whole_groups

LENGTH = 20
SEED_WORDS = 8
#: Occurrences of a seed beyond which its stretches are grouped by content before the shard.
HOT = 500
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: str | None) -> list[bytes]:
    """Words apart by ASCII white space, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def shingle_hashes(words: list[bytes], seed_words: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in words], dtype=np.uint64)
    size = max(len(words) - seed_words + 1, 0)
    seeds = np.zeros(size, dtype=np.uint64)
    for n in range(seed_words):
        seeds = seeds * _ODD + hashes[n : n + size]
    seeds ^= seeds >> np.uint64(32)
    seeds *= _MIX
    return seeds ^ (seeds >> np.uint64(29))


def stretches(seeds: np.ndarray, windows: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds, first windows and numbers of windows of all stretches of a document.

    A window has ``width`` shingles.
    """
    if windows <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    have = 1
    while have < width:  # the smallest of 1, 2, 4 ... and in the end ``width`` seeds in a row
        step = min(have, width - have)
        seeds = np.minimum(seeds[:-step], seeds[step:])
        have += step
    first = np.flatnonzero(np.concatenate([[True], seeds[1:] != seeds[:-1]]))
    return seeds[first], first, np.diff(np.append(first, windows))


class Automaton:
    """Suffix automaton over word numbers that grows word by word."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]
        self.last = 0
        self.breaks = 0

    def read(self, word: int) -> int:
        """Append a word; the length of the longest span ending in it that has been read before."""
        nexts, link, size = self.next, self.link, self.size
        new, p = len(size), self.last
        nexts.append({})
        link.append(0)
        size.append(size[p] + 1)
        while p >= 0 and word not in nexts[p]:
            nexts[p][word] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][word]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                clone = len(size)
                nexts.append(nexts[q].copy())
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and nexts[p].get(word) == q:
                    nexts[p][word] = clone
                    p = link[p]
                link[q] = link[new] = clone
        self.last = new
        return size[link[new]]

    def part(self) -> None:
        """Keep spans from running on into the next stretch."""
        self.breaks -= 1
        self.read(self.breaks)


def repeated(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each stretch, in order, the word ranges of windows that were read before."""
    if len(texts) == 1:
        # A span that repeats within the stretch brings as many words a second time.
        words = texts[0].split(b" ")
        if len(words) - len(set(words)) < length:
            return [[]]
    automaton, numbers, seen, found = Automaton(), {}, set(), []
    for text in texts:
        words = text.split(b" ")
        if text in seen:
            found.append([(0, len(words))])
            continue
        seen.add(text)
        ranges: list[tuple[int, int]] = []
        for at, word in enumerate(words):
            known = automaton.read(numbers.setdefault(word, len(numbers)))
            if known >= length:
                if ranges and at - length < ranges[-1][1]:
                    ranges[-1] = (ranges[-1][0], at + 1)
                else:
                    ranges.append((at - length + 1, at + 1))
        automaton.part()
        found.append(ranges)
    return found


def _seeds(rows: DataFrame, length: int, seed_words: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            none = np.zeros(0, dtype=np.int64)
            ids, seeds, times = [none], [none], [none]
            frame = frame.drop_duplicates(["doc", "text"])
            for row, text in zip(frame["row"], frame["text"]):
                words = words_of(text)
                hashes = shingle_hashes(words, seed_words)
                picked = stretches(hashes, len(words) - length + 1, length - seed_words + 1)[0]
                found, count = np.unique(hashes[np.isin(hashes, picked)], return_counts=True)
                ids.append(np.full(len(found), row, dtype=np.int64))
                seeds.append(found.view(np.int64))
                times.append(count)
            yield pd.DataFrame(
                {"row": np.concatenate(ids), "seed": np.concatenate(seeds), "times": np.concatenate(times)}
            )

    return mapped(rows.select("row", "doc", "text"), run, "row long, seed long, times long")


def _stretch_rows(rows: DataFrame, length: int, seed_words: int) -> DataFrame:
    """The stretches of each row whose seed is among its ``picks``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, key, text, picks in frame.itertuples(index=False, name=None):
                words = words_of(text)
                hashes = shingle_hashes(words, seed_words)
                seed, first, windows = stretches(hashes, len(words) - length + 1, length - seed_words + 1)
                signed = seed.view(np.int64)
                for n in np.flatnonzero(np.isin(signed, np.asarray(picks, dtype=np.int64))):
                    a = int(first[n])
                    b = a + int(windows[n]) + length - 1
                    out.append((int(signed[n]), doc, key, a, b - a, b" ".join(words[a:b])))
            yield pd.DataFrame(out, columns=["seed", "doc", "key", "start", "size", "part"])

    found = mapped(
        rows.select("doc", "key", "text", "picks"),
        run,
        f"seed long, doc {rows.schema['doc'].dataType.simpleString()}, key long, start int, size int, part binary",
    )
    return found.withColumn("part_key", F.xxhash64("part"))


def _shards(rows: DataFrame, length: int) -> DataFrame:
    """Ranges to remove, counted from the start of the stretch: one row for each range."""
    dealt = rows.repartition("seed").sortWithinPartitions("seed", "doc", "start", "key")

    def found(frame: pd.DataFrame) -> pd.DataFrame:
        # A repeated row brings each of its stretches twice; neither copy is the earlier one.
        frame = frame.drop_duplicates(["seed", "doc", "start", "key"])
        seeds, parts = frame["seed"].to_numpy(), frame["part"].tolist()
        edges = np.flatnonzero(np.diff(seeds)) + 1
        at, low, high = [], [], []
        for a, b in zip([0, *edges], [*edges, len(seeds)]):
            for n, ranges in enumerate(repeated(parts[a:b], length)) if b > a else ():
                for x, y in ranges:
                    at.append(a + n)
                    low.append(x)
                    high.append(y)
        out = frame[["seed", "doc", "key", "start", "part_key"]].iloc[at].reset_index(drop=True)
        out["low"], out["high"] = np.array(low, dtype=np.int32), np.array(high, dtype=np.int32)
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, "seed"):
            yield found(frame)

    kind = rows.schema["doc"].dataType.simpleString()
    return mapped(dealt, run, f"seed long, doc {kind}, key long, start int, part_key long, low int, high int")


def removed_ranges(rows: DataFrame, dealt: DataFrame, length: int = LENGTH, seed_words: int = SEED_WORDS) -> DataFrame:
    """(doc, key, low, high): word ranges to remove, which may overlap.

    ``rows`` has row, doc, key and text; ``dealt`` the same rows dealt by row, a hash of doc and key.
    Two documents with one hash only look at each other's seeds as well.
    """
    seeds = _seeds(rows, length, seed_words)
    counted = seeds.groupBy("seed").agg(F.sum("times").alias("total")).filter("total > 1")
    counted = counted.select("seed", (F.col("total") > HOT).alias("hot"))
    by_row = (
        seeds.join(counted, "seed")
        .groupBy("row")
        .agg(
            F.collect_set(F.when(~F.col("hot"), F.col("seed"))).alias("cold"),
            F.collect_set(F.when(F.col("hot"), F.col("seed"))).alias("hot"),
        )
    )
    joined = dealt.join(by_row, "row").filter(F.size("cold") + F.size("hot") > 0)
    cold = _stretch_rows(joined.withColumn("picks", F.col("cold")).filter(F.size("picks") > 0), length, seed_words)
    cold = _shards(cold, length)
    cold = cold.select("doc", "key", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))

    hot = _stretch_rows(joined.withColumn("picks", F.col("hot")).filter(F.size("picks") > 0), length, seed_words)
    hot = hot.repartition("seed", "part_key")  # both uses below read this one deal
    place = F.struct("doc", "start", "key")
    firsts = hot.groupBy("seed", "part_key", "part").agg(F.min(place).alias("place"))
    variants = firsts.select("seed", "part_key", "part", "place.doc", "place.start", "place.key")
    own = _shards(variants, length).groupBy("seed", "part_key").agg(F.collect_list(F.struct("low", "high")).alias("own"))
    heads = firsts.select("seed", "part_key", "place").join(own, ["seed", "part_key"], "left")
    again = hot.select("seed", "part_key", "part", place.alias("here"), "size").join(heads, ["seed", "part_key"])
    whole = F.array(F.struct(F.lit(0).alias("low"), F.col("size").alias("high")))
    again = again.select(
        "here", F.explode(F.when(F.col("here") == F.col("place"), F.col("own")).otherwise(whole)).alias("range")
    )
    again = again.select(
        "here.doc",
        "here.key",
        (F.col("here.start") + F.col("range.low")).alias("low"),
        (F.col("here.start") + F.col("range.high")).alias("high"),
    )
    return cold.union(again)


def _ordered(id_: Column, kind: T.DataType) -> Column:
    """A value that is ordered as the ids are, null last, and never null itself."""
    if isinstance(kind, T.StringType):
        return F.coalesce(F.concat(F.lit("0"), id_), F.lit("1"))
    if isinstance(kind, T.DateType):
        id_ = F.unix_date(id_)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        id_ = F.unix_micros(id_.cast("timestamp"))
    elif not isinstance(kind, T.IntegralType):
        raise TypeError(f"ids of type {kind.simpleString()} are not supported: whole numbers, texts, dates or times are")
    return F.coalesce(id_.cast("long"), F.lit(LAST_ID))


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, seed_words: int = SEED_WORDS, digest: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept): the kept words joined by one space, or their SHA-256."""
    rows = docs.select(
        docs[id_col].alias("id"),
        _ordered(docs[id_col], docs.schema[id_col].dataType).alias("doc"),
        text_key(docs[text]).alias("key"),
        docs[text].alias("text"),
    )
    rows = rows.withColumn("row", F.xxhash64("doc", "key"))
    # By row alone, so that the deal serves the joins; two documents with one hash stay apart in the set.
    dealt = rows.groupBy("row").agg(F.collect_set(F.struct("doc", "key", "text")).alias("all"))
    dealt = dealt.select("row", F.explode("all").alias("one")).select("row", "one.*")
    copies = rows.groupBy("row", "doc", "key", "id").agg(F.count("*").alias("copies"))
    copies = copies.groupBy("row").agg(F.collect_list(F.struct("doc", "key", "id", "copies")).alias("ids"))
    ranges = removed_ranges(rows, dealt, length, seed_words).withColumn("row", F.xxhash64("doc", "key"))
    by_row = ranges.groupBy("row").agg(F.collect_set(F.struct("doc", "key", "low", "high")).alias("ranges"))
    own = lambda r: (r["doc"] == F.col("doc")) & (r["key"] == F.col("key"))
    joined = dealt.join(by_row, "row", "left").join(copies, "row").select(
        F.explode(F.filter("ids", own)).alias("one"),
        "text",
        F.transform(F.filter("ranges", own), lambda r: F.array(r["low"], r["high"])).alias("ranges"),
    )
    joined = joined.select("one.id", "text", "one.copies", "ranges")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            total, gone, kept = [], [], []
            for text, ranges in zip(frame["text"], frame["ranges"]):
                words = words_of(text)
                stays = np.ones(len(words), dtype=bool)
                for low, high in ranges if ranges is not None else ():
                    stays[low:high] = False
                left = words if stays.all() else [words[n] for n in np.flatnonzero(stays)]
                total.append(len(words))
                gone.append(len(words) - len(left))
                joined = b" ".join(left)
                kept.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"id": frame["id"], "n_words": total, "n_removed": gone, "kept": kept, "copies": frame["copies"]})

    kind = joined.schema["id"].dataType.simpleString()
    found = mapped(joined, run, f"id {kind}, n_words long, n_removed long, kept string, copies long")
    return found.select("id", "n_words", "n_removed", "kept", F.explode(F.expr("sequence(1L, copies)"))).drop("col")
