import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "values, digest",
    [
        (("a", "b", "c"), "7b193b3d33184464106f41ddf733783b"),
        (("a", None, "c"), "4f32a73dc87b7bbb7a654d8898d58c7e"),
        ((None, None, "c"), "d9c538b129f1a3ad6ecfe55345c32a05"),
        ((None, None, None), "2fa5491950d66d153d23cfbcfea4e164"),
        ((None,), "f14cc5cdce0420f4a5a6b6d9d7b85f39"),
        (("a",), "0cc175b9c0f1b6a831c399e269772661"),
    ],
)
def test_hash_key(spark, values, digest):
    columns = [F.lit(v).cast("string") for v in values]
    assert one(spark, S.hash_key(*columns)) == digest


def test_hash_key_with_empty_nulls(spark):
    blank = S.hash_key(F.lit(None).cast("string"), F.lit("c"), nulls_as_empty=True)
    assert one(spark, blank) == one(spark, F.md5(F.lit("-c")))


@pytest.mark.parametrize(
    "amount, bucket",
    [
        (190000.00, 0),
        (290000.00, 1),
        (320000.00, 2),
        (399999.99, 2),
        (400000.00, 3),
        (470000.00, 3),
        (510000.00, 4),
        (610000.00, 5),
    ],
)
def test_width_bucket(spark, amount, bucket):
    found = S.width_bucket(F.lit(amount), F.lit(200000.0), F.lit(600000.0), 4)
    assert one(spark, found) == bucket


@pytest.mark.parametrize("unit, distance", [("km", 430), ("mi", 267)])
def test_great_circle(spark, unit, distance):
    places = [F.lit(v) for v in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert one(spark, F.round(S.great_circle(*places, unit), 0)) == distance


def test_great_circle_other_unit():
    with pytest.raises(ValueError):
        S.great_circle(1, 2, 3, 4, "m")


@pytest.mark.parametrize(
    "url, host",
    [
        ("www.example.co.uk?utm_source=search&utm_medium=cpc&utm_campaign=spring-summer", "www.example.co.uk"),
        ("http://blog.example.com/2018/01/a-long-title/", "blog.example.com"),
        ("https://www.example.org/2018/01/01/blog", "www.example.org"),
        ("android-app://m.example.net/", "m.example.net"),
        ("docs.example.org/2021/01/01/index.js?utm_source=search", "docs.example.org"),
        ("https://m.example.net/", "m.example.net"),
    ],
)
def test_url_host(spark, url, host):
    assert one(spark, S.url_host(F.lit(url))) == host


@pytest.mark.parametrize(
    "url, path",
    [
        ("www.example.co.uk?utm_source=search&utm_medium=cpc", ""),
        ("http://blog.example.com/2018/01/tips/", "2018/01/tips/"),
        ("https://www.example.org/2018/01/01/blog", "2018/01/01/blog"),
        ("http://blog.example.com/2018/01/tips/?utm_source=search&utm_medium=cpc", "2018/01/tips/"),
        ("plain", "plain"),
    ],
)
def test_url_path(spark, url, path):
    assert one(spark, S.url_path(F.lit(url))) == path


def test_url_parameter(spark):
    url = F.lit("http://example.com/way?utm_medium=organic&utm_source=code")
    assert one(spark, S.url_parameter(url, "utm_medium")) == "organic"
    assert one(spark, S.url_parameter(url, "utm_source")) == "code"
    assert one(spark, S.url_parameter(url, "source")) == "code"
    assert one(spark, S.url_parameter(url, "utm_term")) is None


@pytest.mark.parametrize(
    "numerator, denominator, output",
    [(6, 0, None), (10, 5, 2), (None, None, None), (None, 0, None), (17, None, None),
     (0, None, None), (None, 9, None), (0, 5, 0)],
)
def test_safe_divide(spark, numerator, denominator, output):
    a, b = F.lit(numerator).cast("int"), F.lit(denominator).cast("int")
    assert one(spark, S.safe_divide(a, b)) == output


def test_safe_add_and_subtract(spark):
    a, b, c = F.lit(1), F.lit(None).cast("int"), F.lit(3)
    assert one(spark, S.safe_add(a, b, c)) == 4
    assert one(spark, S.safe_subtract(a, b, c)) == -2


def test_three_state(spark):
    states = [one(spark, S.three_state(F.lit(v).cast("boolean"))) for v in (False, True, None)]
    assert states == ["I", "A", "UNDEFINED"]


def test_number_after(spark):
    def found(text):
        return one(spark, S.number_after(F.lit(text).cast("string"), "final", "rows"))

    assert found("rows=5 final=7") == 7
    assert found("rows=5 final=x") == 5
    assert found("none") == 0
    assert found(None) == 0
