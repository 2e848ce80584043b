"""Language of texts by n-gram filters with one bit for each language.

Every learned language has a Bloom filter of its character n-grams. The filters are kept bit-sliced: a
slot holds one bit per language, so the bitwise and of the slots of an n-gram is the set of all
languages that contain it. Over a text these sets are counted per language (a popcount of its bit). Of
N n-grams, a filter that says yes to a share f of unknown ones answers to f * (N - n) more than the n
it holds; this is taken off, and the language with the most n-grams left is the answer.

N-grams are pieces of words in lower case, words being runs of letters and marks with a blank on both
sides. A language's own n-grams are those found in LEAST_SHARE of its sampled documents and not far
rarer there than in another language, so a quoted foreign passage leaves no trace. The sample holds
about ``bound`` documents of each language, drawn by a hash of all columns, equal rows once. Counts,
the choice and the slots are made by Spark; the driver gets one mask for each slot in use, so the model
has a fixed size: SLOTS masks of one bit per language.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every text if
nothing can be learned. A text whose n-grams no language has gets the language with the most documents,
score 0; ties go to the language with more documents, then by name. Rows without a language or an id
are predicted, and those without a language not learned from (a null id is never held out). Long texts
are read whole, in stretches.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, mapped, unused

#: Documents of each language that are learned from, about.
SAMPLE = 4000
SIZES = (2, 3, 4)
SLOTS = 1 << 20
HASHES = 3
#: Share of a language's documents that hold an n-gram, at least.
LEAST_SHARE = 0.005
#: The same against the language where the n-gram is most frequent.
LEAST_RATIO = 0.1
UNKNOWN = "und"
#: Characters looked at in one step.
AT_ONCE = 1 << 18
#: (language, n-gram) counts that a task holds before it passes them on.
COUNTED = 1 << 20


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


@cache
def _kinds() -> np.ndarray:
    """2 for letters, 1 for marks, else 0, of every code point."""
    first = (unicodedata.category(chr(n))[0] for n in range(0x110000))
    return np.fromiter((2 if c == "L" else 1 if c == "M" else 0 for c in first), dtype=np.uint8, count=0x110000)


def _stretches(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(codes, kinds, owner of each character, characters to look at), with what follows so that no n-gram is cut."""
    ahead = max(SIZES) - 1
    lowered = [(t or "").lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered)) + 1
    # A blank before every text and one after the last.
    ends = np.cumsum(sizes)
    at = 0
    while at < len(lowered):
        stop = max(int(np.searchsorted(ends, ends[at] - sizes[at] + AT_ONCE, "right")), at + 1)
        codes = np.frombuffer((" " + " ".join(lowered[at:stop]) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds = _kinds()[codes]
        owner = np.repeat(np.arange(at, stop), sizes[at:stop])
        owner = np.append(owner, stop - 1)
        for start in range(0, len(codes), AT_ONCE):
            upto = start + AT_ONCE + ahead
            yield codes[start:upto], kinds[start:upto], owner[start:upto], min(AT_ONCE, len(codes) - start)
        at = stop


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _grams(codes: np.ndarray, kinds: np.ndarray, upto: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of the n-grams that begin within a stretch, for each size.

    An n-gram lies within one word and the blanks on its sides.
    """
    word = kinds > 0
    values = np.where(word, codes, 0).astype(np.uint64)
    for size in SIZES:
        count = min(upto, len(codes) - size + 1)
        if count <= 0:
            continue
        good = word[:count] | word[size - 1 : size - 1 + count]
        for n in range(1, size - 1):
            good &= word[n : n + count]
        places = np.flatnonzero(good)
        h = np.full(len(places), size, dtype=np.uint64)
        for n in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + values[places + n]
        yield places, _mixed(h)


def slots(h: np.ndarray) -> Iterator[np.ndarray]:
    """The slots of every n-gram, one array for each hash."""
    base, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for n in range(HASHES):
        yield ((base + np.uint64(n) * step) & np.uint64(SLOTS - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    #: Languages in the order in which they win ties.
    languages: tuple[str, ...]
    #: A row for every 64 languages (fewer bits where these do), one mask for each slot.
    masks: np.ndarray
    #: Share of unknown n-grams that a language's filter says yes to.
    false_share: np.ndarray

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(texts x languages) n-grams that are in each filter, n-grams of each text, texts with a letter."""
        found = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        total, letters = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=bool)
        width = 8 * self.masks.dtype.itemsize
        for codes, kinds, owner, upto in _stretches(texts):
            letters[owner[:upto][kinds[:upto] == 2]] = True
            for places, h in _grams(codes, kinds, upto):
                if not len(places):
                    continue
                whose = owner[places]
                # Places are in order, so a text's n-grams stand together.
                starts = np.flatnonzero(np.diff(whose, prepend=-1))
                texts_here = whose[starts]
                total[texts_here] += np.diff(np.append(starts, len(places)))
                at = list(slots(h))
                for row in range(len(self.masks)):
                    hit = self.masks[row][at[0]]
                    for other in at[1:]:
                        hit = hit & self.masks[row][other]
                    for bit in range(min(width, len(self.languages) - row * width)):
                        has = (hit >> hit.dtype.type(bit)) & hit.dtype.type(1)
                        found[texts_here, row * width + bit] += np.add.reduceat(has, starts, dtype=np.int64)
        return found, total, letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of every text and the share of its corrected n-grams among those of all languages."""
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        found, total, letters = self.counts(texts)
        # A filter that is all but full tells nothing.
        sure = np.maximum(1.0 - self.false_share, 1e-9)
        held = np.maximum((found - self.false_share * total[:, None]) / sure, 0.0)
        best = held.argmax(axis=1)
        most, every = held.max(axis=1), held.sum(axis=1)
        score = np.where(letters & (every > 0), most / np.where(every > 0, every, 1.0), 0.0)
        return [self.languages[b] if has else UNKNOWN for b, has in zip(best, letters)], np.clip(score, 0.0, 1.0)


def _count(rows: DataFrame) -> DataFrame:
    """(code, gram, docs): in how many sampled documents of a language an n-gram is."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def counts() -> Iterator[pd.DataFrame]:
            for code, parts in held.items():
                grams, docs = np.unique(np.concatenate(parts), return_counts=True)
                yield pd.DataFrame({"code": code, "gram": grams.view(np.int64), "docs": docs})
            held.clear()

        for frame in frames:
            for code, text in zip(frame["code"], frame["text"]):
                parts = [h for codes, kinds, _, upto in _stretches([text]) for _, h in _grams(codes, kinds, upto)]
                if parts:
                    grams = np.unique(np.concatenate(parts))
                    held.setdefault(int(code), []).append(grams)
                    size += len(grams)
                if size > COUNTED:
                    yield from counts()
                    size = 0
        yield from counts()

    counted = mapped(rows.select("code", "text"), run, "code int, gram long, docs long")
    return counted.groupBy("code", "gram").agg(F.sum("docs").alias("docs"))


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = SAMPLE, least_share: float = LEAST_SHARE, least_ratio: float = LEAST_RATIO) -> Model:
    """Learn the filters from rows that have a language and aren't held out."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("id"), docs[text].alias("text"), docs[lang].cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes, key=lambda name: (-sizes[name], name)))
    if not languages:
        return Model((), np.zeros((0, SLOTS), dtype=np.uint8), np.zeros(0))
    names = spark.createDataFrame([(n, name, sizes[name]) for n, name in enumerate(languages)], "code int, lang string, n long")
    rows = rows.join(F.broadcast(names), "lang")
    drawn = F.pmod(F.xxhash64("id", "text", "lang"), F.lit(1 << 30)) * F.col("n") < F.lit(bound << 30)
    # Written once: it is asked for its size and for its n-grams, and holds few rows.
    sample = cut(rows.filter(drawn).select("code", "id", "text").dropDuplicates())
    docs_of = Window.partitionBy("gram")
    sampled = sample.groupBy("code").agg(F.count("*").alias("sampled"))
    counted = _count(sample).join(F.broadcast(sampled), "code")
    share = F.col("docs") / F.col("sampled")
    # One document says nothing unless there are no more.
    often = (share >= least_share) & (F.col("docs") >= F.least(F.lit(2), "sampled"))
    own = counted.withColumn("most", F.max(share).over(docs_of)).filter(often & (share >= least_ratio * F.col("most")))
    base = F.col("gram").bitwiseAND(F.lit(0xFFFFFFFF))
    step = F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1))
    slot = [(base + F.lit(n) * step).bitwiseAND(F.lit(SLOTS - 1)).cast("int") for n in range(HASHES)]
    width = next((w for w in (8, 16, 32) if len(languages) <= w), 64)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("code") % width)
    used = own.select(F.explode(F.array(*slot)).alias("slot"), F.floor(F.col("code") / width).cast("int").alias("row"), bit.alias("bit"))
    found = used.groupBy("row", "slot").agg(F.bit_or("bit").alias("mask")).toArrow()
    masks = np.zeros((-(-len(languages) // width), SLOTS), dtype=f"u{width // 8}")
    at = [found.column(c).to_numpy() for c in ("row", "slot", "mask")]
    masks[at[0], at[1]] = at[2].astype(np.int64).view(np.uint64).astype(masks.dtype)
    bits = [(masks[n // width] >> masks.dtype.type(n % width)) & masks.dtype.type(1) for n in range(len(languages))]
    return Model(languages, masks, np.array([b.mean() for b in bits]) ** HASHES)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of each row, ``lang_pred`` and ``score``; columns of these names give way."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    inner = unused(docs, "__text")
    rows = docs.select(*[docs[c] for c in keep], docs[text].alias(inner))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["lang_pred"], frame["score"] = sent.value.predict(frame.pop(inner).tolist())
            yield frame

    return mapped(rows, run, ", ".join([*kinds, "lang_pred string", "score double"]))
