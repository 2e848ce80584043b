"""Data-quality checks. Each returns the failing rows; no rows means the check passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import rounded
from tidemark.operators.neighbours import beside, repeat_rows
from tidemark.operators.relations import slug

# Conditions on a single row ---------------------------------------------------------


def out_of_range(
    column: str, min_value: Any = None, max_value: Any = None, inclusive: bool = True
) -> Column:
    """True for a value outside the bounds; null and missing bounds pass."""
    c = F.col(column)
    tests = []
    if min_value is not None:
        tests.append(~(c >= min_value) if inclusive else ~(c > min_value))
    if max_value is not None:
        tests.append(~(c <= max_value) if inclusive else ~(c < max_value))
    return reduce(or_, tests, F.lit(False))


def is_false(expression: str, column: str | None = None) -> Column:
    """True where a SQL condition is false; an undecided condition passes."""
    text = expression if column is None else f"{column} {expression}"
    return ~F.expr(text)


def is_blank(column: str, trim_whitespace: bool = True) -> Column:
    return (F.trim(column) if trim_whitespace else F.col(column)) == ""


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive=True):
    return df.filter(out_of_range(column, min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None):
    return df.filter(is_false(expression, column))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True):
    shown = F.trim(column) if trim_whitespace else F.col(column)
    return df.filter(is_blank(column, trim_whitespace)).select(shown.alias(column))


def not_null(df: DataFrame, column: str):
    return df.filter(is_missing(column))


# Conditions on groups ---------------------------------------------------------------


def at_least_one(df: DataFrame, column: str, group: Sequence[str] = ()):
    """Groups (or the whole table) without a single non-null value."""
    rows = df if group else df.select(column).filter(F.col(column).isNotNull()).limit(1)
    return rows.groupBy(*group).agg(F.count(column).alias("filler_column")).filter("filler_column = 0")


def not_constant(df: DataFrame, column: str, group: Sequence[str] = ()):
    """Groups with exactly one distinct value.

    Smallest and largest value decide, which needs one combinable pass where a distinct
    count needs two.
    """
    return (
        df.groupBy(*group)
        .agg(F.min(column).alias("__low"), F.max(column).alias("__high"))
        .filter(F.col("__low") == F.col("__high"))
        .select(*group, F.lit(1).cast("bigint").alias("filler_column"))
    )


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group: Sequence[str] = ()
):
    proportion = F.try_divide(F.count(column), F.count("*"))
    return (
        df.groupBy(*group)
        .agg(proportion.alias("not_null_proportion"))
        .filter(
            (F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most)
        )
    )


def not_accepted_values(df: DataFrame, column: str, values: Sequence[Any]):
    return df.select(F.col(column).alias("value_field")).filter(F.col("value_field").isin(list(values))).distinct()


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]):
    return (
        df.groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
        .filter(~F.col("value_field").isin(list(values)))
    )


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]):
    """Combinations that occur more than once; nulls count as equal."""
    return df.groupBy(*columns).agg(F.count("*").alias("__n")).filter("__n > 1").drop("__n")


def unique(df: DataFrame, column: str):
    """Values that occur more than once; null is left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def recency(
    df: DataFrame,
    field: str,
    part: str,
    interval: int,
    run_ts: datetime,
    ignore_time: bool = False,
    group: Sequence[str] = (),
):
    """Groups whose latest time is older than ``interval`` parts before the run."""
    kind = "date" if ignore_time else "timestamp_ntz"
    bound = F.timestamp_add(part.upper(), F.lit(-interval), F.lit(run_ts).cast("timestamp_ntz"))
    return (
        df.groupBy(*group)
        .agg(F.max(field).cast(kind).alias("most_recent"))
        .withColumn("threshold", bound.cast(kind))
        .filter("most_recent < threshold")
    )


# Two relations ----------------------------------------------------------------------


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both with 1/0 flags for where they come from."""
    return a.withColumn("__a", F.lit(1)).withColumn("__b", F.lit(0)).unionByName(
        b.withColumn("__a", F.lit(0)).withColumn("__b", F.lit(1))
    )


def cardinality_equality(a: DataFrame, column: str, b: DataFrame, field: str):
    """Values whose row counts differ: each side's count, where it has the value.

    One grouped pass over both sides; counts combine before the shuffle.
    """
    rows = _sides(a.select(F.col(column).alias(column)), b.select(F.col(field).alias(column)))
    counts = rows.groupBy(column).agg(
        F.sum("__a").cast("bigint").alias("__n_a"), F.sum("__b").cast("bigint").alias("__n_b")
    )
    both = F.array(F.col("__n_a"), F.col("__n_b"))
    return (
        counts.filter("__n_a <> __n_b")
        .select(column, F.explode(both).alias("num_rows"))
        .filter("num_rows > 0")
    )


def _count_pairs(a: DataFrame, b: DataFrame, group: Sequence[str]) -> DataFrame:
    """Row counts of both sides per group; a side without the group has null.

    A null group key equals nothing, so such groups stay apart per side.
    """
    rows = _sides(a.select(*group), b.select(*group))
    if not group:
        return rows.agg(F.sum("__a").alias("n_a"), F.sum("__b").alias("n_b")).select(
            F.coalesce("n_a", F.lit(0)).cast("bigint").alias("n_a"),
            F.coalesce("n_b", F.lit(0)).cast("bigint").alias("n_b"),
        )
    incomplete = reduce(or_, [F.col(g).isNull() for g in group])
    apart = F.when(incomplete, F.col("__a"))
    return (
        rows.groupBy(*group, apart.alias("__apart"))
        .agg(F.sum("__a").alias("n_a"), F.sum("__b").alias("n_b"))
        .select(*group, *[F.when(F.col(n) > 0, F.col(n)).cast("bigint").alias(n) for n in ("n_a", "n_b")])
    )


def equal_rowcount(a: DataFrame, b: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Row counts per group with their absolute difference.

    The number of failures is the sum of ``diff_count``; a group on one side only has
    no difference and passes.
    """
    pairs = _count_pairs(a, b, group)
    return pairs.select(
        *group,
        F.col("n_a").alias("count_a"),
        F.col("n_b").alias("count_b"),
        F.abs(F.col("n_a") - F.col("n_b")).alias("diff_count"),
    )


def fewer_rows_than(a: DataFrame, b: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Row counts per group; ``row_count_delta`` is zero where ``a`` has fewer rows."""
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, F.lit(1)).otherwise(F.lit(0))
    return (
        _count_pairs(a, b, group)
        .withColumnsRenamed({"n_a": "count_our_model", "n_b": "count_comparison_model"})
        .withColumn("row_count_delta", delta.cast("bigint"))
    )


def equality(
    a: DataFrame,
    b: DataFrame,
    compare: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows that only one side has, labelled a_minus_b or b_minus_a.

    One grouped pass over both sides replaces two set differences.
    """
    if compare and exclude:
        raise ValueError("give either compare or exclude, not both")
    if compare:
        columns = list(compare)
    else:
        gone = {c.lower() for c in exclude or ()}
        columns = [c for c in a.columns if c.lower() not in gone]
        other = {c.lower() for c in b.columns if c.lower() not in gone}
        if {c.lower() for c in columns} != other:
            raise ValueError("the relations have different columns")

    def shown(df: DataFrame) -> DataFrame:
        numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
        return df.select(
            *[
                rounded(F.col(c), precision).alias(c)
                if precision is not None and c in numeric
                else F.col(c)
                for c in columns
            ]
        )

    return (
        _sides(shown(a), shown(b))
        .groupBy(*columns)
        .agg(F.max("__a").alias("__a"), F.max("__b").alias("__b"))
        .filter("__a <> __b")
        .select(
            F.when(F.col("__a") == 1, "a_minus_b").otherwise("b_minus_a").alias("which_diff"),
            *columns,
        )
    )


def equality_failures(failing: DataFrame) -> int:
    """Failing rows plus the imbalance between the two sides."""
    row = failing.agg(
        F.count("*").alias("n"), F.count_if(F.col("which_diff") == "a_minus_b").alias("a")
    ).first()
    return row["n"] + abs(2 * row["a"] - row["n"])


def relationships_where(
    a: DataFrame,
    column: str,
    b: DataFrame,
    field: str,
    from_condition: str = "true",
    to_condition: str = "true",
) -> DataFrame:
    """Non-null values of ``column`` without a counterpart, one row per occurrence.

    Occurrences are counted before the join, so a value that fills a third of the table
    crosses the network as one row per task.
    """
    ids = a.filter(from_condition).select(F.col(column).alias("id")).filter("id is not null")
    known = b.filter(to_condition).select(F.col(field).alias("id")).filter("id is not null")
    counted = ids.groupBy("id").agg(F.count("*").alias("__n"))
    return repeat_rows(counted.join(known, "id", "left_anti"), "__n")


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows where two columns differ; a null on one side passes."""
    return df.filter(F.col(actual) != F.col(expected))


def columns_differ(df: DataFrame, expected: Sequence[str]) -> tuple[set[str], set[str]]:
    """Column names that are missing and unexpected, ignoring case."""
    have, want = {c.upper() for c in df.columns}, {c.upper() for c in expected}
    return want - have, have - want


# Order within a group ---------------------------------------------------------------


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    part: str | None = None,
    group: Sequence[str] = (),
) -> DataFrame:
    """Rows that do not follow the previous value by exactly ``interval``.

    Equal values are counted first, so their copies are never sorted, and the distinct
    values are put in order by many tasks.
    """
    previous = f"previous_{slug(column)}"
    if part:
        before = F.col(previous).cast("timestamp_ntz")
        expected = F.timestamp_add(part.upper(), F.lit(interval), before)
        follows = F.col(column).cast("timestamp_ntz") == expected
    else:
        follows = F.col(column) == F.col(previous) + interval
    counted = df.groupBy(*group, column).agg(F.count("*").alias("__n"))
    ordered = beside(counted, group, [column], df)
    # The first copy follows the value before, the others one another.
    copies = F.array(
        F.struct(F.col("before")[column].alias("p"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.col(column).alias("p"), (F.col("__n") - 1).alias("n")),
    )
    found = ordered.withColumn("__c", F.explode(copies)).select(
        *group, column, F.col("__c.p").alias(previous), F.col("__c.n").alias("__n")
    )
    return repeat_rows(found.filter(~follows), "__n")


GAPS = ("not_allowed", "allowed", "required")


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str | Column,
    upper: str | Column,
    partition_by: str | Column | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that are inverted, overlap the next one, or break the gap rule.

    Equal ranges are counted first and follow one another; the last copy meets the range
    that comes next. So distinct ranges alone are put in order, by many tasks.
    """
    if gaps not in GAPS:
        raise ValueError(f"gaps must be one of {GAPS}")

    def column(c: str | Column) -> Column:
        return F.col(c) if isinstance(c, str) else c

    group = ["partition_by_col"] if partition_by is not None else []
    rows = df.select(
        *([column(partition_by).alias("partition_by_col")] if group else []),
        column(lower).alias("lower_bound"),
        column(upper).alias("upper_bound"),
    )
    lo, up, nxt = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    ordered = lo <= up if zero_length_range_allowed else lo < up
    fits = {"not_allowed": up == nxt, "allowed": up <= nxt, "required": up < nxt}[gaps]

    def fails(is_last: Column) -> Column:
        return ~(F.coalesce(ordered, F.lit(False)) & F.coalesce(fits, is_last, F.lit(False)))

    columns = [*group, "lower_bound", "upper_bound", "next_lower_bound", "is_last_record"]

    counted = rows.groupBy(*group, "lower_bound", "upper_bound").agg(F.count("*").alias("__n"))
    placed = beside(counted, group, ["lower_bound", "upper_bound"], rows)
    copies = F.array(
        F.struct(
            F.col("after")["lower_bound"].alias("lo"),
            F.col("after").isNull().alias("last"),
            F.lit(1).cast("bigint").alias("n"),
        ),
        F.struct(lo.alias("lo"), F.lit(False).alias("last"), (F.col("__n") - 1).alias("n")),
    )
    found = placed.withColumn("__c", F.explode(copies)).select(
        *group,
        "lower_bound",
        "upper_bound",
        F.col("__c.lo").alias("next_lower_bound"),
        F.col("__c.last").alias("is_last_record"),
        F.col("__c.n").alias("__n"),
    )
    return repeat_rows(found.filter(fails(F.col("is_last_record"))).select(*columns, "__n"), "__n")


# Running checks ---------------------------------------------------------------------


@dataclass(frozen=True)
class RowCheck:
    """A check that one condition on a row decides."""

    name: str
    failing: Column
    where: str | None = None


@dataclass(frozen=True)
class Thresholds:
    """How many failures are an error or a warning; by default the first one is an error."""

    error_above: int = 0
    warn_above: int = 0

    def status(self, failures: int) -> str:
        if failures > self.error_above:
            return "error"
        return "warn" if failures > self.warn_above else "pass"


def run_row_checks(
    df: DataFrame, table: str, checks: Sequence[RowCheck], thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """Failures of many row checks from one scan of the table."""
    counts = df.agg(
        *[
            F.count_if(c.failing & F.expr(c.where) if c.where else c.failing).alias(c.name)
            for c in checks
        ]
    )
    melted = counts.unpivot([], [c.name for c in checks], "check", "failures")
    status = (
        F.when(F.col("failures") > thresholds.error_above, "error")
        .when(F.col("failures") > thresholds.warn_above, "warn")
        .otherwise("pass")
    )
    return melted.select(F.lit(table).alias("table"), "check", "failures", status.alias("status"))


def run_checks(
    failing: Mapping[str, DataFrame],
    table: str,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """Failure counts of checks given as failing rows, in one job."""
    result: DataFrame | None = None
    for name, rows in failing.items():
        counted = rows.agg(F.count("*").alias("failures")).select(
            F.lit(table).alias("table"), F.lit(name).alias("check"), "failures"
        )
        result = counted if result is None else result.unionByName(counted)
    assert result is not None
    status = (
        F.when(F.col("failures") > thresholds.error_above, "error")
        .when(F.col("failures") > thresholds.warn_above, "warn")
        .otherwise("pass")
    )
    return result.withColumn("status", status)


def entity_checks(
    df: DataFrame, spec: Any, surrogate: bool, table: str, thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """The standard matrix: unique keys, complete key and technical columns.

    All columns are searched for nulls in one scan; each key takes one more.
    """
    unique_keys = {"unique_key": unique_combination_of_columns(df, spec.key)}
    required = [*spec.key, "etl_batch_id", "bi_created_at", "bi_updated_at"]
    if surrogate and spec.surrogate_key:
        unique_keys["unique_surrogate_key"] = unique(df, spec.surrogate_key)
        required.insert(0, spec.surrogate_key)
    complete = [RowCheck(f"not_null_{c}", F.col(c).isNull()) for c in required]
    return run_checks(unique_keys, table, thresholds).unionByName(
        run_row_checks(df, table, complete, thresholds)
    )
