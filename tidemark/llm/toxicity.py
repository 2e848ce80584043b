"""Toxicity by a weighted finite-state grammar of clauses.

A lexicon turns words into symbols: insult, threat, target, negation, reported speech, end of
clause, other. Small weighted transducers read these symbols: one each for insults, threats, targets
nearby, negation before, and speech that is only reported. Composed into one machine they weigh each
insult or threat by the clause around it; a clause scores what its matches weigh together, and a
document what its clauses do. A logistic curve over clause scores and length gives the final score.

Insults are learned: words and beginnings of words that are far more frequent in toxic documents.
The lexicon comes from two thirds of at most ``SAMPLE`` labelled training rows, the curve from the
rest. Function words are fixed values. Only the text goes into a score.

Defined results: null and empty texts have no clause and the score of a document without matches;
without labels of both kinds every score is zero; repeated labels of a document all count.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, unused
from tidemark.llm.quality_rules import bounded, sample_labelled

SAMPLE = 20_000
LEAST_DOCS = 6
LEAST_Z = 4.0
LEAST_ODDS = 1.5
STEMS = (4, 5, 6, 7, 8)
THRESHOLD = 0.7
KEPT_WORDS = 300_000
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, STOP = range(7)
# Function words of the four languages.
TARGETS = frozenset("you your you're u ya du dich dir ihr euch dein tu te toi vous ton ta tes tú ti usted ustedes vosotros".split())
NEGATIONS = frozenset("not no never isn't aren't wasn't don't doesn't didn't nobody nicht kein keine nie niemals ne pas jamais non nunca ningún jamás".split())
REPORTS = frozenset("said says say called calls quoted quote wrote claimed alleged reported sagte nannte zitierte schrieb dit disait appelé écrit dijo llamó escribió citó".split())
THREATS = frozenset("kill killed hurt destroy beat burn shoot stab hang töten umbringen schlagen tuer frapper détruire matar golpear destruir".split())
_MARKS = ".,;:!?()[]{}\"'«»“”„*#%&$|<>…"
_ENDS = frozenset(".;:!?")


@dataclass(frozen=True)
class Machine:
    """A deterministic weighted transducer over the symbols: state 0 begins, weights multiply."""

    arcs: dict[tuple[int, int], tuple[int, float]] = field(hash=False)

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        return self.arcs[state, symbol]

    @property
    def states(self) -> int:
        return 1 + max(s for s, _ in self.arcs)


def _match(symbol: int) -> Machine:
    """Weight one for the symbol; others pass without."""
    return Machine({(0, s): (0, 1.0 if s == symbol else 0.0) for s in range(7)})


def either(a: Machine, b: Machine) -> Machine:
    """Weights of two single-state machines added."""
    return Machine({(0, s): (0, a.arcs[0, s][1] + b.arcs[0, s][1]) for s in range(7)})


def _after(symbol: int, reach: int, factor: float) -> Machine:
    """Weighs matches by ``factor`` up to ``reach`` words behind the symbol within its clause."""
    arcs = {}
    for state in range(reach + 1):
        for s in range(7):
            onward = reach if s == symbol else 0 if s == STOP else max(state - 1, 0)
            arcs[state, s] = (onward, factor if state and s in (INSULT, THREAT) else 1.0)
    return Machine(arcs)


def compose(a: Machine, b: Machine) -> Machine:
    """Both machines side by side on one input, reachable states only, weights multiplied."""
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        here = todo.pop()
        for s in range(7):
            (x, u), (y, v) = a.step(here[0], s), b.step(here[1], s)
            if (x, y) not in number:
                number[x, y] = len(number)
                todo.append((x, y))
            arcs[number[here], s] = (number[x, y], u * v)
    return Machine(arcs)


def grammar() -> Machine:
    machine = either(_match(INSULT), _match(THREAT))
    for other in (_after(TARGET, 4, 1.5), _after(NEGATION, 3, 0.4), _after(REPORT, 6, 0.6)):
        machine = compose(machine, other)
    return machine


class Scorer:
    """Clause scores of texts under a lexicon of weighted words and beginnings."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {w[1:]: v for w, v in lexicon.items() if w[0] == "="}
        self.stems = {w[1:]: v for w, v in lexicon.items() if w[0] == "^"}
        self.machine = grammar()
        # Words that are neither symbol nor end of a clause only let time pass.
        self.idle = [self._wait(s) for s in range(self.machine.states)]
        self.known: dict[str, tuple[int, float, bool] | None] = {}

    def _wait(self, state: int) -> list[int]:
        steps = [state]
        while (after := self.machine.step(steps[-1], OTHER)[0]) != steps[-1]:
            steps.append(after)
        return steps

    def _symbol(self, token: str) -> tuple[int, float, bool] | None:
        word = token.strip(_MARKS)
        ends = token[-1] in _ENDS
        weight = self.words.get(word, 0.0)
        for size in STEMS:
            if len(word) >= size:
                weight = max(weight, self.stems.get(word[:size], 0.0))
        kind = OTHER
        if weight:
            kind = INSULT
        elif word in THREATS:
            kind, weight = THREAT, 1.0
        elif word in TARGETS:
            kind = TARGET
        elif word in NEGATIONS:
            kind = NEGATION
        elif word in REPORTS:
            kind = REPORT
        return (kind, weight, ends) if kind or ends else None

    def clauses(self, text: str | None) -> tuple[int, list[float]]:
        """Number of words, and scores of the clauses with a match."""
        if not text:
            return 0, []
        tokens, known = text.lower().split(), self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for token in set(tokens).difference(known):
            known[token] = self._symbol(token)
        found: list[float] = []
        state, at, now = 0, 0, 0.0
        for n, symbol in enumerate(map(known.__getitem__, tokens)):
            if symbol is None:
                continue
            kind, weight, ends = symbol
            idle = self.idle[state]
            state = idle[min(n - at, len(idle) - 1)]
            if kind != OTHER:
                state, factor = self.machine.step(state, kind)
                now += factor * weight
            elif not ends:
                state = self.machine.step(state, OTHER)[0]
            if ends:
                if now:
                    found.append(now)
                state, now = self.machine.step(state, STOP)[0], 0.0
            at = n + 1
        if now:
            found.append(now)
        return len(tokens), found

    def features(self, text: str | None) -> tuple[float, ...]:
        size, found = self.clauses(text)
        total = sum(found)
        return (
            math.log1p(total),
            math.log1p(len(found)),
            max(found, default=0.0),
            math.log1p(100.0 * total / size) if size else 0.0,
            math.log1p(size),
        )


FEATURES = 5


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: tuple[float, ...]  # one for each feature, the constant last
    middle: tuple[float, ...]
    spread: tuple[float, ...]

    def score(self, features: tuple[float, ...]) -> float:
        if not self.weights:
            return 0.0
        z = self.weights[-1]
        for value, weight, middle, spread in zip(features, self.weights, self.middle, self.spread):
            z += weight * (value - middle) / spread
        return 1.0 / (1.0 + math.exp(-max(min(z, 35.0), -35.0)))


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


#: Forms a task counts before it passes the counts on.
COUNTED = 200_000


def _forms(text: str | None) -> set[str]:
    """Words of a text and their beginnings, each once."""
    words = {token.strip(_MARKS) for token in set(text.lower().split())} if text else set()
    words.discard("")
    forms = {f"={w}" for w in words}
    for size in STEMS:
        forms.update(f"^{w[:size]}" for w in words if len(w) >= size)
    return forms


def _lexicon(rows: DataFrame) -> dict[str, float]:
    """Log odds of words and beginnings that mark toxic documents; counts are of documents."""
    totals = rows.groupBy("label").count().collect()
    size = {r["label"]: r["count"] for r in totals}
    if not size.get(1) or not size.get(0):
        return {}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, other = Counter(), Counter()

        def counts() -> pd.DataFrame:
            forms = list(toxic.keys() | other.keys())
            frame = pd.DataFrame(
                {"form": forms, "p": [toxic[f] for f in forms], "n": [other[f] for f in forms]}
            )
            toxic.clear()
            other.clear()
            return frame

        for frame in frames:
            for label, text in zip(frame["label"], frame["text"]):
                (toxic if label == 1 else other).update(_forms(text))
                if len(toxic) + len(other) > COUNTED:
                    yield counts()
        if toxic or other:
            yield counts()

    counted = mapped(rows.select("label", "text"), run, "form string, p long, n long")
    counted = counted.groupBy("form").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    p, n = F.col("p") + 0.5, F.col("n") + 0.5
    p_rest, n_rest = size[1] - F.col("p") + 0.5, size[0] - F.col("n") + 0.5
    odds = F.log(p * n_rest / (n * p_rest))
    z = odds / F.sqrt(1 / p + 1 / n + 1 / p_rest + 1 / n_rest)
    kept = counted.filter((F.col("p") >= LEAST_DOCS) & (odds >= LEAST_ODDS) & (z >= LEAST_Z))
    return {r["form"]: round(r["odds"], 6) for r in kept.select("form", odds.alias("odds")).collect()}


def _fit(rows: np.ndarray, labels: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...], tuple[float, ...]]:
    """Logistic regression by Newton steps with a small ridge."""
    middle, spread = rows.mean(axis=0), rows.std(axis=0)
    spread[spread == 0] = 1.0
    x = np.hstack([(rows - middle) / spread, np.ones((len(rows), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.05] * rows.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge
        w = w + np.linalg.solve(h, x.T @ (labels - p) - ridge @ w)
    return tuple(w.tolist()), tuple(middle.tolist()), tuple(spread.tolist())


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text", bound: int = SAMPLE) -> Model:
    """Learn lexicon and curve from labelled rows that aren't held out."""
    known = labels.filter(~held_out(labels[id_col]))
    rows = sample_labelled(docs, known, label, id_col, bound).select(
        F.col("__label_id").alias("id"), F.col("__label").cast("int").alias("label"), docs[text].alias("text")
    )
    part = F.pmod(F.xxhash64("id"), F.lit(3))
    lexicon = _lexicon(rows.filter(part < 2))
    if not lexicon:
        return Model({}, (), (), ())
    rest = bounded(with_features(rows.filter(part == 2), lexicon, ["id", "label"], "text"), bound).toPandas()
    rest = rest.sort_values(["id", "label", *[f"f{n}" for n in range(FEATURES)]])
    found = rest["label"].to_numpy(dtype=float)
    if not (0 < found.sum() < len(found)):
        return Model({}, (), (), ())
    return Model(lexicon, *_fit(rest[[f"f{n}" for n in range(FEATURES)]].to_numpy(dtype=float), found))


def with_features(docs: DataFrame, lexicon: dict[str, float], keep: list[str], text: str) -> DataFrame:
    inner = unused(docs, "__text")
    rows = docs.select(*[docs[c] for c in keep], docs[text].alias(inner))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value)
        for frame in frames:
            made = [scorer.features(t) for t in frame.pop(inner)]
            for n in range(FEATURES):
                frame[f"f{n}"] = [m[n] for m in made]
            yield frame

    return mapped(rows, run, ", ".join([*kinds, *[f"f{n} double" for n in range(FEATURES)]]))


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of each row and its ``score``."""
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c.lower() != "score"]
    inner = unused(docs, "__text")
    rows = docs.select(*[docs[c] for c in keep], docs[text].alias(inner))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        scorer = Scorer(model.lexicon)
        for frame in frames:
            frame["score"] = [model.score(scorer.features(t)) for t in frame.pop(inner)]
            yield frame

    return mapped(rows, run, ", ".join([*kinds, "score double"]))
