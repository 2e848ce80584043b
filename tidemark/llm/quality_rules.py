"""Learned decision lists over document statistics.

Sequential covering finds rules for the class to reject, one after another. A rule grows by the
threshold test with the best information gain on one part of the labelled rows, then loses tests
from its end as long as that helps on the other part. It is taken if it is precise there; the rows
it covers go and the next rule is sought. The list becomes one ordered Spark conditional expression,
so the verdict on all documents stays in the plan and can be read.

Statistics are counted over whole texts in each task. The rules are learned from ``SAMPLE`` labelled
documents at most: those with the smallest hash of the id.

Defined results: a null text has no words and fails the base; no labels, or labels of one class,
give an empty list, which keeps everything; a null label counts as none; the rate of something in
nothing is zero.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, unused

#: Labelled documents the rules are learned from, at most.
SAMPLE = 20_000
LEAST_PRECISION = 0.97
LEAST_COVERED = 3
MOST_TESTS = 4
MOST_RULES = 12
MOST_TRIES = 24
#: Thresholds tried for each statistic.
STEPS = 64
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50


def _features() -> dict[str, Column]:
    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return {
        "mean_word": rate("word_chars", "n_words"),
        "symbol_rate": rate("n_symbols", "n_words"),
        "dup_line_rate": rate("n_dup_lines", "n_lines"),
        "repeat_rate": rate("n_repeat_words", "n_words"),
    }


def text_statistics(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, words in repeated 3-word windows, lines."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(" \t\v\f\r")]
    windows = list(zip(words, words[1:], words[2:]))
    repeats = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = np.zeros(len(words), dtype=bool)
        for n, window in enumerate(windows):
            if times[window] > 1:
                covered[n : n + 3] = True
        repeats = int(covered.sum())
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeats, len(lines)


def with_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of each row, all by default, and the statistics of its text."""
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c.lower() not in STATISTICS]
    inner = unused(docs, "__text")
    rows = docs.select(*[docs[c] for c in keep], docs[text].alias(inner))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counted = [text_statistics(t) for t in frame.pop(inner)]
            for n, name in enumerate(STATISTICS):
                frame[name] = np.array([c[n] for c in counted], dtype=np.int64)
            yield frame

    return mapped(rows, run, ", ".join([*kinds, *[f"{s} long" for s in STATISTICS]]))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        values = rows[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self, features: dict[str, Column]) -> Column:
        value = features[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


def _thresholds(values: np.ndarray) -> np.ndarray:
    """Midpoints between neighbouring values, at most ``STEPS`` evenly by rank."""
    distinct = np.unique(values)
    if len(distinct) < 2:
        return distinct[:0]
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) <= STEPS:
        return middle
    return np.unique(middle[np.linspace(0, len(middle) - 1, STEPS).astype(int)])


def _grow(rows: dict[str, np.ndarray], target: np.ndarray) -> list[Test]:
    inside, tests = np.ones(len(target), dtype=bool), []
    while len(tests) < MOST_TESTS and (inside & ~target).any():
        p0, n0 = (inside & target).sum(), (inside & ~target).sum()
        best, chosen = 0.0, None
        base = math.log2(p0 / (p0 + n0)) if p0 else 0.0
        for feature in rows:
            # Thresholds between the rows still inside, by their ranks among the target class too.
            tries = np.unique(
                np.concatenate([_thresholds(rows[feature][inside]), _thresholds(rows[feature][inside & target])])
            )
            for threshold in tries:
                for above in (True, False):
                    test = Test(feature, above, float(threshold))
                    now = inside & test.holds(rows)
                    p, n = (now & target).sum(), (now & ~target).sum()
                    if p:
                        gain = p * (math.log2(p / (p + n)) - base)
                        if gain > best + 1e-9:
                            best, chosen = gain, test
        if chosen is None:
            break
        tests.append(chosen)
        inside &= chosen.holds(rows)
    return tests


def _covered(tests: list[Test], rows: dict[str, np.ndarray], size: int) -> np.ndarray:
    inside = np.ones(size, dtype=bool)
    for test in tests:
        inside &= test.holds(rows)
    return inside


def _prune(tests: list[Test], rows: dict[str, np.ndarray], target: np.ndarray) -> list[Test]:
    def worth(some: list[Test]) -> float:
        inside = _covered(some, rows, len(target))
        p, n = (inside & target).sum(), (inside & ~target).sum()
        return (p - n) / (p + n) if p + n else -1.0

    while len(tests) > 1 and worth(tests[:-1]) >= worth(tests):
        tests = tests[:-1]
    return tests


def learn_rules(frame: pd.DataFrame, label: str, features: list[str]) -> list[list[Test]]:
    """Rules for label 0, in order; ``frame`` is in a fixed order, a drawn third of it prunes."""
    rows = {f: frame[f].to_numpy(dtype=float) for f in features}
    target = frame[label].to_numpy() == 0
    prunes = np.random.default_rng(0).permutation(len(frame)) % 3 == 2
    left = np.ones(len(frame), dtype=bool)
    rules: list[list[Test]] = []
    for _ in range(MOST_TRIES):
        grow, prune = left & ~prunes, left & prunes
        if len(rules) == MOST_RULES or not (grow & target).any():
            break
        grown = _grow({f: v[grow] for f, v in rows.items()}, target[grow])
        if not grown:
            break
        pruned = _prune(grown, {f: v[prune] for f, v in rows.items()}, target[prune])
        for tests in (pruned, grown):
            inside = _covered(tests, rows, len(frame)) & left
            if _precise(inside & prune, target) and _precise(inside, target):
                rules.append(tests)
                left &= ~inside
                break
        else:
            # What it found can't be told apart; the rest may still have a rule.
            left &= ~(_covered(grown, rows, len(frame)) & target)
    return rules


def _precise(inside: np.ndarray, target: np.ndarray) -> bool:
    return inside.sum() >= LEAST_COVERED and (inside & target).sum() >= LEAST_PRECISION * inside.sum()


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", bound: int = SAMPLE, label_id: str | None = None) -> DataFrame:
    """Rows of ``docs`` with a label, for at most ``bound`` labels of the smallest id hash."""
    label_id = label_id or id_col
    picked = (
        labels.filter(labels[label].isNotNull() & labels[label_id].isNotNull())
        .select(labels[label_id].alias("__label_id"), labels[label].alias("__label"))
        .orderBy(F.xxhash64("__label_id"), "__label_id", "__label")
        .limit(bound)
    )
    return docs.join(F.broadcast(picked), docs[id_col] == picked["__label_id"])


def bounded(rows: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` rows of numbers, drawn by a hash of all: an id may have any number of rows."""
    return rows.orderBy(F.xxhash64(*rows.columns), *rows.columns).limit(bound)


def decision_list(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", bound: int = SAMPLE, label_id: str | None = None) -> list[list[Test]]:
    """Learn the rules from labelled documents."""
    rows = with_statistics(sample_labelled(docs, labels, label, id_col, bound, label_id), text, ["__label_id", "__label"])
    features = _features()
    rows = rows.select("__label_id", "__label", *STATISTICS, *[c.alias(n) for n, c in features.items()])
    frame = bounded(rows, bound).toPandas()
    names = ["n_words", *features]
    # A fixed order that has nothing to do with the values.
    frame = frame.sort_values(["__label_id", *names]).reset_index(drop=True)
    return learn_rules(frame, "__label", names)


def verdict(rules: list[list[Test]]) -> Column:
    """False for rows that a rule covers, tried in order, else true."""
    features = {**_features(), "n_words": F.col("n_words")}
    found = None
    for tests in rules:
        held = tests[0].column(features)
        for test in tests[1:]:
            held = held & test.column(features)
        found = F.when(held, False) if found is None else found.when(held, False)
    return F.lit(True) if found is None else found.otherwise(True)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None, bound: int = SAMPLE, label_id: str | None = None) -> DataFrame:
    """Columns ``keep`` with statistics, ``base_failed`` and ``kept``."""
    rules = decision_list(docs, labels, label, id_col, text, bound, label_id)
    rows = with_statistics(docs, text, keep).withColumn("base_failed", base_failed())
    return rows.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(verdict(rules)))
