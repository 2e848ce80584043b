from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import relations as R
from tidemark.operators.latest import deduplicate
from tidemark.operators.merge import align, upsert
from tidemark.operators.text import ordered_text
from tidemark.sources import readers
from tidemark.spec import struct_type


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    kept = deduplicate(df.filter("user_id = 1"), ["user_id"], [F.col("version").desc()])
    assert rows(kept) == [(1, "play", 2)]


def test_union_of_unlike(spark):
    a = spark.createDataFrame([(1, "ann", "pi"), (2, "bob", "e")], "id int, name string, favorite_number string")
    b = spark.createDataFrame([(1, "green", 7)], "id int, favorite_color string, favorite_number int")
    both = R.union_unlike({"a": a, "b": b})
    assert both.columns == ["source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert dict(both.dtypes)["favorite_number"] == "string"
    assert rows(both.drop("source_relation")) == [
        (1, "ann", "pi", None), (1, None, "7", "green"), (2, "bob", "e", None),
    ]
    slim = R.union_unlike({"a": a, "b": b}, exclude=["NAME"], label=None, where="id = 1")
    assert slim.columns == ["id", "favorite_number", "favorite_color"] and slim.count() == 2
    assert R.union_unlike({"a": a, "b": b}, include=["ID"], label=None).columns == ["id"]
    assert dict(R.union_unlike({"a": a}, types={"id": "bigint"}).dtypes)["id"] == "bigint"
    with pytest.raises(ValueError):
        R.union_unlike({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        R.union_unlike({"a": a}, include=["nothing"])


def test_union_by_pattern(spark):
    spark.range(2).createOrReplaceTempView("seed_20180101")
    spark.range(3).createOrReplaceTempView("seed_20180102")
    spark.range(4).createOrReplaceTempView("seed_exclude")
    assert readers.matching_tables(spark, "SEED_%", "%exclude") == ["seed_20180101", "seed_20180102"]
    assert readers.tables_with_prefix(spark, "seed_2018") == ["seed_20180101", "seed_20180102"]
    assert readers.matching_tables(spark, "nothing%") == []
    assert readers.union_matching(spark, "nothing%") is None
    assert readers.union_matching(spark, "seed_2018%").count() == 5


def test_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    assert rows(R.pivot(df, ["size"], "color", ["red", "blue"])) == [("M", 1, 0), ("S", 1, 1)]
    plain = R.pivot(df, ["size"], "color", ["red", "blue", "blue's"], plain_names=True)
    assert plain.columns == ["size", "red", "blue", "blues"]
    assert rows(plain) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    other = R.pivot(df, ["size"], "color", ["red"], cmp="<>", agg="max", prefix="not_")
    assert rows(other) == [("M", 0), ("S", 1)]


@pytest.mark.parametrize(
    "text, name", [("A b-c", "a_b_c"), ("1st", "_1st"), ("blue's", "blues"), ("", "")]
)
def test_slug(text, name):
    assert R.slug(text) == name


def test_unpivot(spark):
    df = spark.createDataFrame(
        [(123, "active", "tier 1", True), (567, "churned", "tier 2", None)],
        "customer_id int, sTaTuS string, segment string, is_updated boolean",
    )
    melted = R.unpivot(df, exclude=["CUSTOMER_ID"], remove=["Segment"], field_name="prop", value_name="val")
    assert rows(melted) == sorted(
        [(123, "sTaTuS", "active"), (123, "is_updated", "true"), (567, "sTaTuS", "churned"), (567, "is_updated", None)],
        key=repr,
    )
    with pytest.raises(ValueError):
        R.unpivot(df, exclude=df.columns)


def test_value_counts_and_column_values(spark):
    df = spark.createDataFrame([(v,) for v in "abcdefggggg"], "field string")
    counted = R.value_counts(df, "field")
    assert [tuple(r) for r in counted.take(2)] == [("g", 5), ("a", 1)]
    assert R.column_values(spark, df, "field", max_records=2) == ["g", "a"]
    assert sorted(R.column_values(spark, df, "field", where="field < 'c'")) == ["a", "b"]
    assert R.column_values(spark, "no_table", "x", default=["y"]) == ["y"]
    assert R.column_values(spark, df.filter("false"), "field", default=[]) == []
    with pytest.raises(ValueError):
        R.column_values(spark, "no_table", "x")


def test_column_values_refuses_a_long_list(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "5")
    try:
        with pytest.raises(ValueError):
            R.column_values(spark, spark.range(6), "id")
        assert len(R.column_values(spark, spark.range(6), "id", max_records=3)) == 3
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_star(spark):
    df = spark.range(1).selectExpr("id as field_1", "id as field_2", "id as field_3")
    assert df.select(*R.star(df, ["FIELD_3"], "p_", "_s")).columns == ["p_field_1_s", "p_field_2_s"]
    with pytest.raises(ValueError):
        R.star(df, df.columns)


def test_blanks_to_null(spark):
    df = spark.createDataFrame([("", " ", 0), ("a", "", 1)], "a string, b string, c int")
    assert rows(R.blanks_to_null(df)) == [("a", None, 1), (None, " ", 0)]


def test_series_and_spine(spark):
    assert [r[0] for r in R.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        R.generate_series(spark, 0)
    days = R.date_spine(spark, "day", date(2018, 1, 1), date(2018, 1, 10))
    assert [r[0] for r in days.orderBy("date_day").collect()] == [date(2018, 1, d) for d in range(1, 10)]
    months = R.date_spine(spark, "month", date(2018, 1, 31), date(2018, 4, 1))
    assert [r[0] for r in months.orderBy("date_month").collect()] == [
        date(2018, 1, 31), date(2018, 2, 28), date(2018, 3, 31),
    ]
    hours = R.date_spine(spark, "hour", datetime(2018, 1, 1), datetime(2018, 1, 1, 3))
    assert hours.count() == 3
    with pytest.raises(ValueError):
        R.date_spine(spark, "day", date(2018, 1, 2), date(2018, 1, 2))


def test_boundaries_between(spark):
    def between(a, b):
        times = [F.lit(v).cast("timestamp_ntz") for v in (a, b)]
        return spark.range(1).select(R.boundaries_between("MINUTE", *times)).first()[0]

    assert between("2024-01-01 00:00:30", "2024-01-01 00:01:29") == 1
    assert between("2024-01-01 00:00:30", "2024-01-01 00:00:59") == 0


def test_read_seed_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("﻿date_value,float_value,note\n2017-01-01 00:00:00,3.3,\n", encoding="utf-8")
    df = readers.read_seed(spark, str(path), "date_value timestamp_ntz, float_value double, note string")
    assert rows(df) == [(datetime(2017, 1, 1), 3.3, None)]


def test_align_and_upsert(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, gone string")
    changes = spark.createDataFrame([(2, "B", 5), (3, "c", 6)], "k int, v string, extra int")
    assert rows(upsert(target, changes, ["k"])) == [(1, "a", None), (2, "B", 5), (3, "c", 6)]
    shaped = align(target, struct_type({"V": "string", "n": "bigint"}))
    assert shaped.columns == ["V", "n"]


def test_upsert_never_matches_null_keys(spark):
    target = spark.createDataFrame([(None, "a")], "k int, v string")
    assert upsert(target, target, ["k"]).count() == 2


def test_ordered_text_over_several_stretches(spark):
    df = spark.range(1000).select(
        (F.col("id") % 2).alias("g"),
        F.col("id").cast("string").alias("v"),
        F.when(F.col("id") > 3, F.floor(F.col("id") / 300)).alias("o"),
        "id",
    )
    joined = {r["g"]: r["t"] for r in ordered_text(df, ["g"], "v", ["o"], "id", "t", block=64).collect()}
    for g in (0, 1):
        expected = sorted(
            (i for i in range(1000) if i % 2 == g), key=lambda i: (i <= 3, i // 300 if i > 3 else 0, i)
        )
        assert joined[g] == ", ".join(str(i) for i in expected)


def test_cursor_extract(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "k int, t timestamp_ntz")
    assert rows(readers.changed_since(df, "t", datetime(2024, 1, 1)).select("k")) == [(2,)]
    assert readers.changed_since(df, "t", None).count() == 2
