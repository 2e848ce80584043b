"""Text aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096


def ordered_text(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    order: Sequence[str],
    number: str,
    name: str,
    separator: str = ", ",
    block: int = BLOCK,
) -> DataFrame:
    """Values of a group joined into one text, in order, with nulls in the order last.

    ``number`` is a numeric column that settles the order. Values are first joined per
    short stretch of that order, so a group with very many rows is sorted and joined by
    many tasks and only its stretches meet in the last step.
    """
    sorting = [f"{c} asc nulls last" for c in order]
    separator = separator.replace("'", "''")

    def joined(column: str, keys: list[str]) -> str:
        return f"listagg({column}, '{separator}') within group (order by {', '.join(keys)})"

    stretches = (
        df.withColumn("__block", F.floor(F.col(number) / block))
        .groupBy(*group, *order, "__block")
        .agg(F.expr(joined(value, [f"{number} asc nulls last"])).alias("__text"))
    )
    whole = joined("__text", [*sorting, "__block asc nulls last"])
    return stretches.groupBy(*group).agg(F.expr(whole).alias(name))
