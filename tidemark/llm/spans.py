"""Places of pattern matches in texts, with built-in column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import unused

#: Matches whose places are summed up together, so that many matches cost no square of copies.
BLOCK = 256
NEAR = 40
FOUND = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"


def with_places(df: DataFrame, text: str, name: str, pattern: str) -> DataFrame:
    """Add ``name``: an array of (start, end, match, before, after) of all leftmost matches.

    Places are code points, the end is exclusive. ``before`` and ``after`` are up to ``NEAR``
    characters around the match, as far as the neighbouring matches. A null text has no match.
    The texts between the matches give the places: matches and gaps alternate.
    """
    hit, gap, size, block = (unused(df, f"__{name}_{part}") for part in ("hit", "gap", "size", "block"))
    df = df.withColumn(hit, F.coalesce(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)), F.array().cast("array<string>")))
    df = df.withColumn(gap, F.when(F.size(hit) > 0, F.split(F.col(text), pattern, -1)))
    df = df.withColumn(
        size,
        F.when(
            F.size(hit) > 0,
            F.zip_with(
                F.slice(gap, 1, F.size(hit)),
                F.col(hit),
                lambda g, m: F.struct(
                    F.char_length(g).cast("long").alias("gap"), F.char_length(m).cast("long").alias("own")
                ),
            ),
        ),
    )
    empty = F.array().cast("array<bigint>")
    length = lambda s: s["gap"] + s["own"]
    sums = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(size) - 1) / F.lit(BLOCK)).cast("int")),
        lambda b: F.slice(F.col(size), b * BLOCK + 1, F.lit(BLOCK)),
    )

    def running(first: Column, parts: Column, step) -> Column:
        """First values of each part when the steps add up."""
        return F.aggregate(
            parts,
            F.struct(first.alias("at"), empty.alias("all")),
            lambda acc, p: F.struct((acc["at"] + step(p)).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
            lambda acc: acc["all"],
        )

    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, s: a + length(s))
    df = df.withColumn(block, F.when(F.size(hit) > 0, sums))
    first = running(F.lit(0).cast("long"), F.col(block), total)
    begins = F.flatten(F.zip_with(first, F.col(block), lambda f, part: running(f, part, length)))
    whole = F.transform(
        F.arrays_zip(
            begins.alias("begin"),
            F.col(size).alias("size"),
            F.col(hit).alias("match"),
            F.slice(gap, 1, F.size(hit)).alias("left"),
            F.slice(gap, 2, F.size(hit)).alias("right"),
        ),
        lambda z: F.struct(
            (z["begin"] + z["size"]["gap"]).alias("start"),
            (z["begin"] + z["size"]["gap"] + z["size"]["own"]).alias("end"),
            z["match"].alias("match"),
            F.right(z["left"], F.lit(NEAR)).alias("before"),
            F.left(z["right"], F.lit(NEAR)).alias("after"),
        ),
    )
    df = df.withColumn(name, F.when(F.size(hit) > 0, whole).otherwise(F.array()).cast(FOUND))
    return df.drop(hit, gap, size, block)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of an array of (kind, start, end), comma-joined, in its order."""
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
    )


def kinds(found: Column, number: int, kind: str) -> Column:
    """An array of (number, kind, start, end) from places; the number orders the kinds."""
    return F.transform(
        found,
        lambda f: F.struct(
            F.lit(number).alias("number"), F.lit(kind).alias("kind"), f["start"].alias("start"), f["end"].alias("end")
        ),
    )


def by_start(spans: Column) -> Column:
    """Spans by start, then kind."""
    keyed = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["number"].alias("number"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def by_kind(spans: Column) -> Column:
    """Spans by kind, then start."""
    keyed = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["number"].alias("number"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
