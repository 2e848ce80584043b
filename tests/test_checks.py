import random
from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import checks as C
from tidemark.operators.neighbours import beside, repeat_rows, with_neighbours


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_accepted_range(spark):
    df = frame(spark, "id int", (-1,), (11,), (None,))
    assert C.accepted_range(df, "id", -1, 11).count() == 0
    assert C.accepted_range(df, "id", -2, 11.1, inclusive=False).count() == 0
    assert C.accepted_range(df.filter("id <> -1"), "id", 0).count() == 0
    assert C.accepted_range(df, "id", -1, 11, inclusive=False).count() == 2
    assert C.accepted_range(df, "id").count() == 0


def test_at_least_one(spark):
    df = frame(spark, "field string, value int", ("a", 1), ("b", None))
    assert C.at_least_one(df, "field").count() == 0
    assert [r["field"] for r in C.at_least_one(df, "value", ["field"]).collect()] == ["b"]
    assert C.at_least_one(df.filter("false"), "value").count() == 1
    assert C.at_least_one(df.filter("field = 'b'"), "value").count() == 1


def test_cardinality_equality(spark):
    a = frame(spark, "same_name int", (1,), (2,), (3,))
    b = frame(spark, "same_name int, different_name int", (1, 2), (2, 3), (3, 1))
    assert C.cardinality_equality(a, "same_name", b, "same_name").count() == 0
    assert C.cardinality_equality(a, "same_name", b, "different_name").count() == 0
    c = frame(spark, "x int", (1,), (1,), (None,))
    found = C.cardinality_equality(a, "same_name", c, "x").collect()
    assert sorted([tuple(r) for r in found], key=repr) == sorted(
        [(1, 1), (1, 2), (2, 1), (3, 1), (None, 1)], key=repr
    )


def test_row_counts(spark):
    a = frame(spark, "field int", (1,), (1,), (2,), (None,))
    b = frame(spark, "field int", (1,), (2,), (3,), (None,))
    assert C.equal_rowcount(a, a).agg(F.sum("diff_count")).first()[0] == 0
    grouped = C.equal_rowcount(a, b, ["field"])
    # One-sided groups, the null ones included, have no difference.
    assert sorted(((r["field"], r["diff_count"]) for r in grouped.collect()), key=repr) == sorted(
        [(1, 1), (2, 0), (3, None), (None, None), (None, None)], key=repr
    )
    empty = a.filter("false")
    assert C.equal_rowcount(a, empty).first()["diff_count"] == 4


def test_fewer_rows_than(spark):
    a = frame(spark, "col_a int, field int", (1, 1), (1, 2), (1, 3))
    b = frame(spark, "col_a int, field int", (1, 1), (1, 2), (1, 3), (1, 4))
    assert C.fewer_rows_than(a, b).first()["row_count_delta"] == 0
    assert C.fewer_rows_than(a, b, ["col_a"]).first()["row_count_delta"] == 0
    assert C.fewer_rows_than(a, a).first()["row_count_delta"] == 1
    assert C.fewer_rows_than(b, a).first()["row_count_delta"] == 1


def test_equality(spark):
    a = frame(spark, "col_a int, col_b int, col_c int", (1, 1, 3), (1, 2, 1), (2, 3, 3))
    b = frame(spark, "col_a int, col_b int, col_c int", (1, 1, 2), (1, 2, 2), (2, 3, 2))
    assert C.equality(a, a).count() == 0
    assert C.equality_failures(C.equality(a, b)) == 6
    assert C.equality(a, b, compare=["col_a", "col_b"]).count() == 0
    assert C.equality(a, b, exclude=["COL_C"]).count() == 0
    with pytest.raises(ValueError):
        C.equality(a, b.drop("col_c"))
    with pytest.raises(ValueError):
        C.equality(a, b, ["col_a"], ["col_b"])
    assert C.equality_failures(C.equality(a, a.limit(0))) == 6
    assert C.equality(a.unionByName(a), a).count() == 0


def test_equality_with_precision(spark):
    a = frame(spark, "id string, n double", ("x", 62.3888186), ("y", 81.2511656))
    b = frame(spark, "id string, n double", ("x", 62.3888187), ("y", 81.2511657))
    assert C.equality(a, b, precision=4).count() == 0
    assert C.equality(a, b, precision=8).count() == 4


def test_expression_is_true(spark):
    df = frame(spark, "col_a double, col_b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert C.expression_is_true(df, "col_a + col_b = 1").count() == 0
    assert C.expression_is_true(df, "+ col_b = 1", "col_a").count() == 0
    assert C.expression_is_true(df, "col_a = 0.5").count() == 2


def test_ranges(spark):
    plain = frame(spark, "lo int, hi int", (0, 1), (1, 2), (2, 4))
    assert C.mutually_exclusive_ranges(plain, "lo", "hi", gaps="not_allowed").count() == 0
    assert C.mutually_exclusive_ranges(plain, "lo", "hi", gaps="required").count() == 2
    with pytest.raises(ValueError):
        C.mutually_exclusive_ranges(plain, "lo", "hi", gaps="some")
    d = date
    subs = frame(
        spark, "id int, a date, b date",
        (1, d(2019, 1, 1), d(2019, 2, 1)), (1, d(2019, 3, 3), d(2019, 4, 1)),
        (2, d(2019, 5, 6), d(2019, 7, 2)), (2, d(2019, 7, 3), None),
    )
    end = F.coalesce("b", F.lit(d(2099, 1, 1)))
    for gaps in ("allowed", "required"):
        assert C.mutually_exclusive_ranges(subs, "a", end, "id", gaps).count() == 0
    assert C.mutually_exclusive_ranges(subs, "a", "b", "id").count() == 1
    zero = frame(
        spark, "id int, a date, b date",
        (3, d(2020, 5, 6), d(2020, 5, 7)), (3, d(2020, 5, 8), d(2020, 5, 10)),
        (3, d(2020, 5, 8), d(2020, 5, 8)), (3, d(2020, 5, 12), d(2020, 5, 15)),
        (4, d(2020, 6, 6), d(2020, 6, 7)), (4, d(2020, 6, 8), d(2020, 6, 8)),
        (4, d(2020, 6, 9), d(2020, 6, 10)),
    )
    assert C.mutually_exclusive_ranges(zero, "a", "b", "id", zero_length_range_allowed=True).count() == 0
    assert C.mutually_exclusive_ranges(zero, "a", "b", "id").count() == 2


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("gaps", C.GAPS)
def test_ranges_of_a_hot_group_match_the_plain_way(spark, seed, gaps):
    """The same rows as one sorted window per group finds."""
    rng = random.Random(seed)

    def value(top):
        return None if rng.random() < 0.03 else rng.randrange(top)

    rows = [
        (rng.choice([1, 1, 1, 2, 3, None]), value(60), value(70)) for _ in range(400)
    ]
    df = frame(spark, "g int, lo int, hi int", *rows)
    failing = C.mutually_exclusive_ranges(df, "lo", "hi", "g", gaps, True)
    rising = Window.partitionBy("g").orderBy(F.col("lo").asc_nulls_last(), F.col("hi").asc_nulls_last())
    fits = {"not_allowed": "hi = nxt", "allowed": "hi <= nxt", "required": "hi < nxt"}[gaps]
    plain = df.withColumns({"nxt": F.lead("lo").over(rising), "last": F.lead(F.lit(1)).over(rising).isNull()})
    plain = plain.filter(f"NOT (coalesce(lo <= hi, false) AND coalesce({fits}, last, false))")
    found = [sorted((tuple(r) for r in d.collect()), key=repr) for d in (failing, plain)]
    assert found[0] == found[1] and found[0]


def test_one_outlier_leaves_the_rows_spread(spark):
    """Texts with a long common beginning and a single other one, in one group."""
    urls = spark.range(20_000).selectExpr("1 AS g", "concat('https://www.example.org/shop/item/', lpad(id, 9, '0')) AS v")
    df = urls.union(frame(spark, "g int, v string", (1, "a")))
    near = beside(df, ["g"], ["v"])
    tasks = near.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) > 3 and max(r["count"] for r in tasks) < 12_000
    assert near.filter("after IS NULL").count() == 1 and near.filter("before IS NULL").count() == 1
    assert near.filter("before.v >= v OR after.v <= v").count() == 0


def test_no_plan_sorts_a_table_in_one_task(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id AS v", "id + 1 AS w")
    for failing in (C.sequential_values(df, "v"), C.mutually_exclusive_ranges(df, "v", "w")):
        plan = failing._jdf.queryExecution().executedPlan().toString()
        # The one row of each stretch is all that a single task sees.
        single = [x for x in plan.split("\n") if "SinglePartition" in x]
        assert len(single) <= 2 and plan.count("Window [") == 2


KINDS = ["int", "double", "date", "timestamp_ntz", "timestamp", "string", "decimal(12,2)", "boolean", "binary", "struct", "array"]


@pytest.mark.parametrize("kind", KINDS)
def test_neighbours_of_large_groups(spark, kind):
    rng = random.Random(7)
    pairs = {(rng.choice("aab"), rng.randrange(5000)) for _ in range(600)} | {("a", None), (None, 3)}
    value = {
        "date": "date_add(date'2000-01-01', n)",
        "timestamp_ntz": "timestampadd(SECOND, n * 1000, timestamp_ntz'2000-01-01 00:00:00')",
        "timestamp": "timestampadd(SECOND, n * 1000, timestamp'2000-01-01 00:00:00')",
        "binary": "cast(cast(n as string) as binary)",
        "boolean": "n > 2500",
        "struct": "if(n is null, null, struct(n % 7 as a, cast(n as string) as b))",
        "array": "if(n is null, null, array(n % 7, n))",
    }.get(kind, f"cast(n as {kind})")
    df = frame(spark, "g string, n int", *pairs).selectExpr("g", f"{value} as v").distinct()
    window = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last())
    expected = df.select(
        "g", "v", F.lag("v").over(window), F.lead("v").over(window),
        F.lead(F.lit(1)).over(window).isNotNull(),
    )
    found = [sorted((tuple(r) for r in d.collect()), key=repr) for d in (with_neighbours(df, ["g"], "v"), expected)]
    assert found[0] == found[1] and (len(found[0]) == len(pairs) or kind == "boolean")


def test_repeat_rows(spark):
    df = frame(spark, "k string, n bigint", ("a", 25), ("b", 1), ("c", 0), ("d", 10))
    counts = {r["k"]: r["count"] for r in repeat_rows(df, "n", chunk=10).groupBy("k").count().collect()}
    assert counts == {"a": 25, "b": 1, "d": 10}


def test_value_lists(spark):
    df = frame(spark, "id int, city string", (1, "Barcelona"), (2, "London"), (3, "Paris"), (4, None))
    assert C.not_accepted_values(df, "city", ["Madrid", "Berlin"]).count() == 0
    assert C.not_accepted_values(df, "city", ["Paris"]).count() == 1
    assert C.accepted_values(df, "city", ["Barcelona", "London"]).collect()[0]["value_field"] == "Paris"


def test_not_constant(spark):
    df = frame(spark, "col_a int, field int", (1, 1), (1, 1), (1, 2))
    assert C.not_constant(df, "field").count() == 0
    assert C.not_constant(df, "field", ["col_a"]).count() == 0
    assert C.not_constant(df, "col_a").count() == 1
    assert C.not_constant(frame(spark, "x int", (None,), (None,)), "x").count() == 0


def test_not_empty_string(spark):
    df = frame(spark, "s string", ("a",), (" ",), (None,))
    assert C.not_empty_string(df, "s").count() == 1
    assert C.not_empty_string(df, "s", trim_whitespace=False).count() == 0


def test_not_null_proportion(spark):
    half = [1, None, None, 4, 5, 6, None, None, None, 10]
    most = [1, 2, 3, 4, 5, 6, 7, 8, None, 10]
    df = frame(spark, "point_5 int, point_9 int", *zip(half, most))
    assert C.not_null_proportion(df, "point_5", 0.5, 0.5).count() == 0
    assert C.not_null_proportion(df, "point_5", 0, group=["point_9"]).count() == 0
    assert C.not_null_proportion(df, "point_9", 0.9).count() == 0
    assert C.not_null_proportion(df, "point_5", 0.6).count() == 1
    assert C.not_null_proportion(df.filter("false"), "point_5", 0.6).count() == 0


def test_recency(spark):
    now = datetime(2024, 5, 2, 12)
    df = frame(spark, "col1 int, t timestamp_ntz", (1, datetime(2024, 5, 1, 13)))
    for group in ([], ["col1"]):
        assert C.recency(df, "t", "day", 1, now, group=group).count() == 0
    midnight = frame(spark, "t timestamp_ntz", (datetime(2024, 5, 1),))
    assert C.recency(midnight, "t", "day", 1, now, ignore_time=True).count() == 0
    assert C.recency(midnight, "t", "day", 1, now).count() == 1
    assert C.recency(midnight.filter("false"), "t", "day", 1, now).count() == 0


def test_relationships_where(spark):
    a = frame(spark, "id int", (1,), (2,), (4,), (4,), (5,), (5,), (None,))
    b = frame(spark, "id int", (1,), (2,), (3,), (None,))
    left = C.relationships_where(a, "id", b, "id", "id <> 4")
    assert [r["id"] for r in left.collect()] == [5, 5]


def test_sequential_values(spark):
    df = frame(spark, "col_a int, v int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10))
    assert C.sequential_values(df, "v", 2).count() == 0
    assert C.sequential_values(df, "v", 2, group=["col_a"]).count() == 0
    assert C.sequential_values(df.filter("false"), "v", 2).count() == 0
    assert C.sequential_values(df, "v", 1).count() == 4
    twice = df.unionByName(df)
    assert C.sequential_values(twice, "v", 2).count() == 5
    hours = frame(spark, "t timestamp_ntz", *[(datetime(2021, 1, 1, h),) for h in range(4)])
    assert C.sequential_values(hours, "t", 1, "hour").count() == 0


def test_unique_combination(spark):
    df = frame(spark, "m string, p string", ("1", "a"), ("1", "b"), ("2", "a"))
    assert C.unique_combination_of_columns(df, ["m", "p"]).count() == 0
    nulls = frame(spark, "m string, p string", ("1", None), ("1", None))
    assert C.unique_combination_of_columns(nulls, ["m", "p"]).count() == 1
    assert C.unique(nulls, "p").count() == 0
    assert C.not_null(nulls, "p").count() == 2


def test_assert_equal_and_columns(spark):
    df = frame(spark, "a int, b int", (1, 1), (1, 2), (None, 2))
    assert C.assert_equal(df, "a", "b").count() == 1
    assert C.columns_differ(df, ["A", "B"]) == (set(), set())
    assert C.columns_differ(df, ["a", "c"]) == ({"C"}, {"B"})


def test_runners(spark):
    df = frame(spark, "a int, s string", (1, "x"), (5, ""), (None, "y"))
    report = C.run_row_checks(
        df, "t",
        [
            C.RowCheck("range", C.out_of_range("a", 0, 3)),
            C.RowCheck("blank", C.is_blank("s"), "a = 1"),
            C.RowCheck("null", C.is_missing("a")),
        ],
        C.Thresholds(error_above=1),
    )
    assert {r["check"]: (r["failures"], r["status"]) for r in report.collect()} == {
        "range": (1, "warn"), "blank": (0, "pass"), "null": (1, "warn"),
    }
    assert C.Thresholds(1, 0).status(2) == "error"
    report = C.run_checks({"n": C.not_null(df, "a"), "u": C.unique(df, "a")}, "t").collect()
    assert {r["check"]: r["status"] for r in report} == {"n": "error", "u": "pass"}
