"""Secrets in texts: assigned values, access keys, long hex runs, and candidates of high entropy.

Only built-in column functions. The first three kinds are patterns. The fourth slides a window over
each candidate run: the counts of its characters change by one in and one out at a step, and with
them the sum of c * log2(c), so entropy = log2(w) - sum / w needs no second look at the window. A
candidate belongs to a character class with a threshold of its own. Windows that overlap a piece on the
allow-list are let off, and so is a run that is one identifier; the first three kinds are never touched.

Defined results: a null text is an empty one and has no secret; a run of letters or of digits alone
is no candidate; spans of different kinds may overlap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import apart, own_name
from tidemark.llm.spans import by_start, kinds, with_places

_ASSIGN_NAME = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
ASSIGN_HEAD = rf"(?:{_ASSIGN_NAME})[\"']?\x20*[:=]\x20*[\"']?"
ASSIGN = ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+"
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Character classes in order of trial: name, pattern of the whole run, least entropy of a window.
CLASSES = [
    ("hex", r"^[0-9a-fA-F]+$", 3.0),
    ("alphanumeric", r"^[A-Za-z0-9]+$", 3.6),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.8),
]
#: Runs that look random and are not secret (fixed values).
ALLOWED_RUN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
ALLOWED = [
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]",
    r"(?i)0123456789|abcdefghij|1234567890",
    r"(?i)x{6,}|0{8,}|[*]{3,}",
]


def _entropies(run: Column) -> Column:
    """(lowest start, highest end) of windows above the limit, from the state of one pass.

    ``run`` is a struct of the characters' codes and the limit.
    """
    codes, limit = run["codes"], run["limit"]
    weight = lambda c: F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))
    base = 43  # '+' has the lowest code of the candidates' characters, 'z' the highest
    zero = F.array_repeat(F.lit(0), 123 - base)

    def step(acc: Column, i: Column) -> Column:
        new = F.get(codes, i) - base
        old = F.when(i >= WINDOW, F.get(codes, i - WINDOW) - base).otherwise(F.lit(-1))
        counts = acc["counts"]
        # First one in, then one out; the same character changes nothing.
        c_new = F.get(counts, new)
        c_old = F.when(old >= 0, F.get(counts, old))
        moved = (old != new) & (old >= 0)
        total = (
            F.when(old == new, acc["total"])
            .otherwise(
                acc["total"]
                + weight(c_new + 1)
                - weight(c_new)
                + F.when(moved, weight(c_old - 1) - weight(c_old)).otherwise(F.lit(0.0))
            )
        )
        entropy = F.round(F.lit(math.log2(WINDOW)) - total / WINDOW, 9)
        above = (i >= WINDOW - 1) & (entropy >= limit)
        return F.struct(
            F.transform(
                counts,
                lambda c, k: c + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0),
            ).alias("counts"),
            total.alias("total"),
            F.when(above & (acc["low"] < 0), i - (WINDOW - 1)).otherwise(acc["low"]).alias("low"),
            F.when(above, i + 1).otherwise(acc["high"]).alias("high"),
        )

    start = F.struct(
        zero.alias("counts"), F.lit(0.0).alias("total"), F.lit(-1).alias("low"), F.lit(-1).alias("high")
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.size(codes) - 1),
        start,
        step,
        lambda acc: F.struct(acc["low"].alias("low"), acc["high"].alias("high")),
    )


def _parts(run: Column) -> Column:
    """(start, run) of the parts of a cut run that are long enough for a window."""
    lengths = F.zip_with(run["pieces"], run["parts"], lambda p, q: F.struct(F.char_length(p).alias("before"), q.alias("part")))
    placed = F.aggregate(
        lengths,
        F.struct(run["start"].alias("at"), F.array().cast("array<struct<start:bigint,part:string>>").alias("all")),
        lambda acc, z: F.struct(
            (acc["at"] + z["before"] + F.char_length(z["part"])).alias("at"),
            F.concat(acc["all"], F.array(F.struct((acc["at"] + z["before"]).alias("start"), z["part"].alias("part")))).alias("all"),
        ),
        lambda acc: acc["all"],
    )
    return F.transform(
        F.filter(placed, lambda z: F.char_length(z["part"]) >= WINDOW),
        lambda z: F.struct(
            z["start"].alias("start"),
            F.struct(F.transform(F.split(z["part"], ""), lambda c: F.ascii(c)).alias("codes"), run["limit"].alias("limit")).alias("run"),
        ),
    )


def find_secrets(docs: DataFrame, text: str = "text", base: str = "base_spans", spans: str = "spans") -> DataFrame:
    """Add two arrays of (kind, start, end): those of the patterns, and all; by start, then kind."""
    rows, names = apart(docs)
    df = rows.withColumn("__scan", F.col(own_name(names, text)))
    for name, pattern in (("__assign", ASSIGN), ("__access", ACCESS), ("__hex", HEX), ("__run", CANDIDATE)):
        df = with_places(df, "__scan", name, pattern)
    value = lambda m: F.regexp_replace(m["match"], f"^{ASSIGN_HEAD}", "")
    patterns = F.concat(
        kinds(F.filter("__assign", lambda m: F.char_length(value(m)) >= ASSIGN_LEAST), 0, "assign"),
        kinds(F.col("__access"), 1, "access"),
        kinds(F.col("__hex"), 2, "hex"),
    )
    mixed = F.filter(
        "__run",
        lambda m: m["match"].rlike("[0-9]")
        & m["match"].rlike("[A-Za-z]")
        & ~m["match"].rlike(ALLOWED_RUN),
    )
    limit = lambda m: F.coalesce(*[F.when(m["match"].rlike(p), F.lit(t)) for _, p, t in CLASSES])
    # A run is cut at its allowed pieces; windows that overlap none are those of the parts between.
    pieces = "|".join(f"(?:{a})" for a in ALLOWED)
    cut_up = F.transform(
        mixed,
        lambda m: F.struct(
            m["start"].alias("start"),
            limit(m).alias("limit"),
            F.split(m["match"], pieces, -1).alias("parts"),
            F.concat(F.array(F.lit("")), F.regexp_extract_all(m["match"], F.lit(pieces), F.lit(0))).alias("pieces"),
        ),
    )
    coded = F.flatten(F.transform("__cut", _parts))
    df = df.withColumn("__patterns", patterns).withColumn("__cut", cut_up).withColumn("__coded", coded)
    judged = F.transform(
        "__coded", lambda r: F.struct(r["start"].alias("start"), _entropies(r["run"]).alias("found"))
    )
    df = df.withColumn("__judged", judged)
    random = F.transform(
        F.filter("__judged", lambda r: r["found"]["low"] >= 0),
        lambda r: F.struct(
            F.lit(3).alias("number"),
            F.lit("entropy").alias("kind"),
            (r["start"] + r["found"]["low"]).alias("start"),
            (r["start"] + r["found"]["high"]).alias("end"),
        ),
    )
    given = {base.lower(), spans.lower()}
    kept = [F.col(inner).alias(c) for c, inner in names.items() if c.lower() not in given]
    return df.select(*kept, by_start(F.col("__patterns")).alias(base), by_start(F.concat("__patterns", random)).alias(spans))


def mask(text: Column, spans: Column, sign: str = "*") -> Column:
    """The text with every character of the spans as ``sign``; spans may overlap."""
    state = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(
                acc["parts"],
                F.array(
                    F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")),
                    F.repeat(F.lit(sign), F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0)).cast("int")),
                ),
            ).alias("parts"),
        ),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2147483647))),
    )
    return F.when(F.size(spans) > 0, state).otherwise(text)
