"""Column expressions: hash keys, null-tolerant arithmetic, distances, URL parts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NULL_MARK = "_dbt_utils_surrogate_key_null_"
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934
URL_SCHEMES = ("http://", "https://")
APP_SCHEME = "android-app://"


def _cols(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def hash_key(*columns: str | Column, nulls_as_empty: bool = False) -> Column:
    """MD5 of the columns' text forms joined by a dash."""
    mark = F.lit("" if nulls_as_empty else NULL_MARK)
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), mark) for c in _cols(columns)]))


def _zeroed(columns: Sequence[str | Column]) -> list[Column]:
    return [F.coalesce(c, F.lit(0)) for c in _cols(columns)]


def safe_add(*columns: str | Column) -> Column:
    return reduce(add, _zeroed(columns))


def safe_subtract(*columns: str | Column) -> Column:
    return reduce(sub, _zeroed(columns))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    return numerator / F.nullif(denominator, F.lit(0))


def width_bucket(value: Column, low: Column, high: Column, buckets: Column | int) -> Column:
    return F.width_bucket(value.cast("double"), low.cast("double"), high.cast("double"), buckets)


def great_circle(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi"):
    """Haversine distance in miles or kilometres; inputs in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be mi or km, not {unit}")
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (
        half_lon * half_lon
    )
    miles = F.lit(2.0 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord))
    return miles * F.lit(KM_PER_MILE) if unit == "km" else miles


def _without(url: Column, *schemes: str) -> Column:
    return reduce(lambda text, s: F.replace(text, F.lit(s), F.lit("")), schemes, url)


def _piece(text: Column, separator: str, index: int) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(index))


def url_host(url: Column) -> Column:
    """Host of a URL, app link or scheme-less address."""
    return _piece(_piece(_without(url, APP_SCHEME, *URL_SCHEMES), "/", 1), "?", 1)


def url_path(url: Column) -> Column:
    """What follows the first slash, up to the query.

    Without a slash the query mark ends the host, so the path is empty; with neither
    the whole text comes back.
    """
    text = _without(url, *URL_SCHEMES)
    slash = F.instr(text, "/")
    cut = F.when(slash > 0, slash).otherwise(F.instr(text, "?") - 1)
    return _piece(F.substring(text, cut + 1, F.length(text)), "?", 1)


def url_parameter(url: Column, name: str) -> Column:
    """Value after ``name=``; any parameter that ends in the name matches as well."""
    return F.nullif(_piece(_piece(url, f"{name}=", 2), "&", 1), F.lit(""))


def three_state(flag: Column) -> Column:
    """I for false, A for true, UNDEFINED for null."""
    return F.when(~flag, "I").when(flag, "A").otherwise("UNDEFINED")


def number_after(text: Column, *labels: str) -> Column:
    """The whole number after the first label that is found in the text, else zero."""
    found = [
        F.regexp_extract(text, f"{label}=([0-9]+)", 1).try_cast("bigint") for label in labels
    ]
    return F.coalesce(*found, F.lit(0).cast("bigint"))


def rounded(column: Column, digits: int) -> Column:
    """Rounded decimal form used when numbers are compared; ten decimals of a number count."""
    return F.round(column.cast("decimal(28,10)"), digits)
