"""Joins of a base table to de-duplicated lookups, and the per-client product of two lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_source_row
from tidemark.spec import TIME_SENTINEL


def enrich(
    base: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    time: str = "dt_updated",
) -> DataFrame:
    """Left join the latest row of a lookup; rows of ``base`` never multiply.

    ``on`` maps base columns to lookup columns and ``take`` names the output columns for
    lookup columns. Spark broadcasts the lookup if its size allows.
    """
    keys = list(on.values())
    needed = list(dict.fromkeys(keys + list(take.values()) + [time]))
    latest = latest_source_row(lookup.select(*needed), keys, time)
    side = latest.select(
        *[F.col(v).alias(f"__{v}") for v in keys],
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    condition = [F.col(b) == F.col(f"__{v}") for b, v in on.items()]
    return base.join(side, condition, "left").drop(*[f"__{v}" for v in keys])


def latest_time(*columns: str) -> Column:
    """The greatest of several times, each with a floor for null."""
    floor = F.lit(TIME_SENTINEL).cast("timestamp_ntz")
    filled = [F.coalesce(F.col(c).cast("timestamp_ntz"), floor) for c in columns]
    return filled[0] if len(filled) == 1 else F.greatest(*filled)


def product_within(
    left: DataFrame,
    right: DataFrame,
    group: Sequence[str],
    spread_by: Sequence[str],
    heavy: int = 50_000_000,
) -> DataFrame:
    """Every left row with every right row of the same group.

    The product is the wanted result, so its size is given. A group with more than
    ``heavy`` pairs is cut into tiles of about that many: its left rows into bands by
    ``spread_by``, and if single left rows already meet too many, its right rows too.
    A row is repeated once per band of the other side.
    """
    keys = list(group)
    pairs = left.groupBy(*keys).agg(F.count("*").alias("__left")).join(
        right.groupBy(*keys).agg(F.count("*").alias("__right")), keys
    )
    # A product of counts may pass the range of a bigint.
    tiles = F.ceil(F.col("__left").cast("double") * F.col("__right") / heavy)
    hot = pairs.withColumn("__tiles", tiles).filter("__tiles > 1")
    bands = F.least(F.col("__tiles"), F.col("__left"))
    across = F.least(F.ceil(F.col("__tiles") / bands), F.col("__right"))
    hot = hot.select(*keys, bands.cast("int").alias("__bands"), across.cast("int").alias("__across"))
    if hot.isEmpty():
        return left.join(right, keys)

    def cut(side: DataFrame, by: Sequence[str], own: str, others: str) -> DataFrame:
        """Each row with the number of its own band, once for each band of the other side."""
        rows = side.join(hot, keys, "left")
        own_bands, other_bands = (F.coalesce(F.col(f"__{n}"), F.lit(1)) for n in (own, others))
        rows = rows.withColumn(f"__{own}_at", F.pmod(F.xxhash64(*by), own_bands).cast("int"))
        rows = rows.withColumn(f"__{others}_at", F.explode(F.sequence(F.lit(0), other_bands - 1)))
        return rows.drop("__bands", "__across")

    bound = [*keys, "__bands_at", "__across_at"]
    tiled = cut(left, spread_by, "bands", "across").join(cut(right, right.columns, "across", "bands"), bound)
    return tiled.drop("__bands_at", "__across_at")
