"""Relation transforms and column expressions inside jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import relations as R
from tidemark.operators.latest import deduplicate
from tidemark.queries.registry import Tables, query
from tidemark.sources.readers import matching_tables, union_matching


@query(
    "union_unlike",
    """
SELECT 'customer' AS source_relation, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name, NULL::INTEGER AS s_nationkey, NULL::DOUBLE AS s_acctbal
FROM customer
UNION ALL
SELECT 'supplier', NULL, NULL, NULL, NULL, NULL, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
)
def union_unlike(t: Tables) -> DataFrame:
    return R.union_unlike({"customer": t.customer, "supplier": t.supplier})


@query(
    "union_shared_columns",
    """
SELECT 'party' AS kind, 'customer' AS source_relation, c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS region_note FROM customer WHERE c_acctbal > 0
UNION ALL
SELECT 'party', 'supplier', s_suppkey, s_name, s_acctbal, 'supplies' FROM supplier WHERE s_acctbal > 0""",
)
def union_shared_columns(t: Tables) -> DataFrame:
    """Different column sets, an excluded column, a filter per relation and a type override."""
    a = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("skipped"),
    )
    b = t.supplier.select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"), F.lit("supplies").alias("region_note"),
    )
    both = R.union_unlike({"customer": a, "supplier": b}, exclude=["SKIPPED"], where="balance > 0")
    return both.withColumn("kind", F.lit("party"))


@query(
    "union_by_pattern",
    """
SELECT 'tide_events_' || event_type AS source_relation, event_id, user_id FROM events WHERE event_type <> 'purchase'""",
)
def union_by_pattern(t: Tables) -> DataFrame:
    """Union of every view whose name fits a pattern, less an excluded one."""
    for kind in ("click", "error", "view", "purchase", "signup"):
        rows = t.events.filter(F.col("event_type") == kind).select("event_id", "user_id")
        rows.createOrReplaceTempView(f"tide_events_{kind}")
    result = union_matching(t.spark, "TIDE_EVENTS%", exclude="%purchase")
    assert result is not None and len(matching_tables(t.spark, "no_such%")) == 0
    return result


@query(
    "unpivot_measures",
    """
WITH picked AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
    CASE WHEN l_discount < 0.05 THEN NULL ELSE l_discount END AS l_discount FROM lineitem)
SELECT l_orderkey, l_linenumber, field_name, value
FROM picked UNPIVOT INCLUDE NULLS (value FOR field_name IN (l_quantity, l_extendedprice, l_discount))""",
)
def unpivot_measures(t: Tables) -> DataFrame:
    """Nulls stay; two columns are kept, the rest but three are removed."""
    rows = t.lineitem.withColumn("l_discount", F.when(F.col("l_discount") >= 0.05, F.col("l_discount")))
    return R.unpivot(
        rows,
        cast_to="double",
        exclude=["L_ORDERKEY", "l_linenumber"],
        remove=["l_partkey", "l_suppkey", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    )


@query(
    "unpivot_flags_as_text",
    """
SELECT doc_id, 'has_quality' AS prop, CASE WHEN quality = 1 THEN 'true' ELSE 'false' END AS val FROM labels
UNION ALL SELECT doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM labels""",
)
def unpivot_flags_as_text(t: Tables) -> DataFrame:
    rows = t.labels.select("doc_id", (F.col("quality") == 1).alias("has_quality"), "toxic")
    return R.unpivot(rows, exclude=["doc_id"], field_name="prop", value_name="val")


@query(
    "pivot_zero_fill",
    """
SELECT o_orderpriority,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS "F",
  CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS "O",
  CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS "P",
  CAST(sum(CASE WHEN o_orderstatus = 'absent''s' THEN 1 ELSE 0 END) AS BIGINT) AS "absent's"
FROM orders GROUP BY o_orderpriority""",
)
def pivot_zero_fill(t: Tables) -> DataFrame:
    return R.pivot(t.orders, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P", "absent's"])


@query(
    "pivot_measures_by_found_values",
    """
SELECT l_shipyear,
  max(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END) AS top_a_price,
  max(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END) AS top_n_price,
  max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS top_r_price
FROM (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS l_shipyear FROM lineitem) GROUP BY l_shipyear""",
)
def pivot_measures_by_found_values(t: Tables) -> DataFrame:
    """Pivot columns come from the data; names are made plain."""
    found = R.column_values(t.spark, t.lineitem, "l_returnflag")
    rows = t.lineitem.withColumn("l_shipyear", F.year("l_shipdate"))
    return R.pivot(
        rows, ["l_shipyear"], "l_returnflag", sorted(found), agg="max", prefix="Top ",
        suffix=" price", then_value=F.col("l_extendedprice"), else_value=0.0, plain_names=True,
    )


@query(
    "top_values",
    """
SELECT l_partkey AS value, count(*) AS n_rows FROM lineitem WHERE l_returnflag <> 'A'
GROUP BY 1 ORDER BY n_rows DESC, value LIMIT 20""",
)
def top_values(t: Tables) -> DataFrame:
    return R.value_counts(t.lineitem, "l_partkey", where="l_returnflag <> 'A'", max_records=20)


@query(
    "value_counts_with_null",
    """
SELECT nullif(event_type, 'click') AS value, count(*) AS n_rows FROM events GROUP BY 1""",
)
def value_counts_with_null(t: Tables) -> DataFrame:
    rows = t.events.withColumn("kind", F.nullif("event_type", F.lit("click")))
    return R.value_counts(rows, "kind")


@query(
    "star_prefixed",
    """
SELECT o_orderkey AS src_o_orderkey_v1, o_custkey AS src_o_custkey_v1, o_totalprice AS src_o_totalprice_v1,
  o_orderdate AS src_o_orderdate_v1 FROM orders""",
)
def star_prefixed(t: Tables) -> DataFrame:
    columns = R.star(t.orders, ["O_ORDERSTATUS", "o_orderpriority"], prefix="src_", suffix="_v1")
    return t.orders.select(*columns)


@query(
    "null_blank",
    """
SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang, nullif(source, '') AS source, n_chars
FROM (SELECT doc_id, text, CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang, source, n_chars FROM documents)""",
)
def null_blank(t: Tables) -> DataFrame:
    blanked = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    return R.blanks_to_null(t.documents.withColumn("lang", blanked))


@query(
    "calendar_gaps",
    """
WITH bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) + 1 AS b FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, b - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_day FROM bounds),
counted AS (SELECT CAST(o_orderdate AS DATE) AS date_day, count(*) AS n FROM orders GROUP BY 1)
SELECT date_day, coalesce(n, 0) AS n_orders, n IS NULL AS is_gap FROM days LEFT JOIN counted USING (date_day)""",
)
def calendar_gaps(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    first, last = t.orders.agg(F.min(day), F.date_add(F.max(day), 1)).first()
    spine = R.date_spine(t.spark, "day", first, last)
    counted = t.orders.groupBy(day.alias("date_day")).agg(F.count("*").alias("n"))
    return spine.join(counted, "date_day", "left").select(
        "date_day",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_orders"),
        F.col("n").isNull().alias("is_gap"),
    )


@query(
    "calendar_hours",
    """
WITH bounds AS (SELECT date_trunc('month', min(ts)) AS a, date_trunc('hour', max(ts)) AS b FROM events)
SELECT unnest(generate_series(a, b - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS date_hour FROM bounds""",
)
def calendar_hours(t: Tables) -> DataFrame:
    """Hours between two moments of the data; the end is left out."""
    first, last = t.events.agg(
        F.date_trunc("month", F.min("ts")).cast("timestamp_ntz"),
        F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz"),
    ).first()
    return R.date_spine(t.spark, "hour", first, last).filter(F.col("date_hour") < F.lit(last))


@query(
    "missing_line_numbers",
    """
WITH top AS (SELECT max(l_linenumber) AS n FROM lineitem),
numbers AS (SELECT unnest(generate_series(1, n)) AS generated_number FROM top),
used AS (SELECT l_linenumber AS generated_number, count(*) AS c FROM lineitem GROUP BY 1)
SELECT CAST(generated_number AS BIGINT) AS generated_number, coalesce(c, 0) AS n_lines FROM numbers LEFT JOIN used USING (generated_number)""",
)
def missing_line_numbers(t: Tables) -> DataFrame:
    top = t.lineitem.agg(F.max("l_linenumber")).first()[0]
    used = t.lineitem.groupBy(F.col("l_linenumber").cast("bigint").alias("generated_number")).agg(
        F.count("*").alias("c")
    )
    series = R.generate_series(t.spark, top)
    return series.join(used, "generated_number", "left").select(
        "generated_number", F.coalesce("c", F.lit(0)).cast("bigint").alias("n_lines")
    )


@query(
    "parts_between_dates",
    """
SELECT l_orderkey, l_linenumber, date_diff('month', o_orderdate, l_shipdate) AS months,
  date_diff('day', o_orderdate, l_shipdate) AS days, date_diff('minute', TIMESTAMP '2024-01-01', l_shipdate) AS minutes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def parts_between_dates(t: Tables) -> DataFrame:
    """Boundaries crossed between order and shipment."""
    joined = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    ordered, shipped = F.col("o_orderdate"), F.col("l_shipdate")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        R.boundaries_between("MONTH", ordered, shipped).alias("months"),
        R.boundaries_between("DAY", ordered, shipped).alias("days"),
        R.boundaries_between("MINUTE", start, shipped).alias("minutes"),
    )


@query(
    "hash_keys",
    """
SELECT md5(coalesce(CAST(o_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
    coalesce(nullif(o_orderstatus, 'F'), '_dbt_utils_surrogate_key_null_') || '-' || o_orderpriority) AS order_hash,
  md5(CAST(o_custkey AS VARCHAR)) AS customer_hash,
  md5(coalesce(nullif(o_orderstatus, 'F'), '') || '-' || CAST(o_custkey AS VARCHAR)) AS blank_hash
FROM orders""",
)
def hash_keys(t: Tables) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("F"))
    return t.orders.select(
        S.hash_key("o_orderkey", status, "o_orderpriority").alias("order_hash"),
        S.hash_key("o_custkey").alias("customer_hash"),
        S.hash_key(status, "o_custkey", nulls_as_empty=True).alias("blank_hash"),
    )


@query(
    "bucket_histogram",
    """
SELECT CASE WHEN p_retailprice < 950 THEN 0 WHEN p_retailprice >= 1050 THEN 9
    ELSE CAST(floor((p_retailprice - 950) / 100 * 8) AS BIGINT) + 1 END AS bucket,
  count(*) AS n_parts, min(p_retailprice) AS lowest, max(p_retailprice) AS highest
FROM part GROUP BY 1""",
)
def bucket_histogram(t: Tables) -> DataFrame:
    bucket = S.width_bucket(F.col("p_retailprice"), F.lit(950), F.lit(1050), 8)
    return t.part.groupBy(bucket.cast("bigint").alias("bucket")).agg(
        F.count("*").alias("n_parts"),
        F.min("p_retailprice").alias("lowest"),
        F.max("p_retailprice").alias("highest"),
    )


@query(
    "nearest_supplier_per_order",
    """
WITH placed AS (
  SELECT o_orderkey, s_suppkey, c_nationkey * 7 - 84 + c_acctbal / 20000 AS lat1, c_nationkey * 14 - 168 AS lon1,
    s_nationkey * 7 - 84 + s_acctbal / 20000 AS lat2, s_nationkey * 14 - 168 AS lon2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey),
measured AS (SELECT o_orderkey, s_suppkey, round(2 * 3961 * asin(sqrt(
  pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))) * 1.60934, 3) AS km
  FROM placed)
SELECT o_orderkey, s_suppkey, km FROM measured
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY km, s_suppkey DESC) = 1""",
)
def nearest_supplier_per_order(t: Tables) -> DataFrame:
    """Closest supplier of each order by great-circle distance from its customer."""
    joined = (
        t.lineitem.select("l_orderkey", "l_suppkey")
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )

    def latitude(nation: str, balance: str):
        return F.col(nation) * 7 - 84 + F.col(balance) / 20000

    km = S.great_circle(
        latitude("c_nationkey", "c_acctbal"),
        F.col("c_nationkey") * 14 - 168,
        latitude("s_nationkey", "s_acctbal"),
        F.col("s_nationkey") * 14 - 168,
        "km",
    )
    measured = joined.select("o_orderkey", "s_suppkey", F.round(km, 3).alias("km"))
    return deduplicate(measured, ["o_orderkey"], [F.col("km").asc()])


_STRIPPED = "replace(replace(url, 'http://', ''), 'https://', '')"


@query(
    "url_rollup",
    f"""
WITH parsed AS (
  SELECT split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host,
    split_part(right({_STRIPPED}, CAST(length({_STRIPPED}) AS BIGINT) - coalesce(nullif(position('/' IN {_STRIPPED}), 0), position('?' IN {_STRIPPED}) - 1)), '?', 1) AS path,
    nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref,
    nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page
  FROM pages)
SELECT host, split_part(path, '/', 1) AS section, ref, count(*) AS n_pages, count(page) AS n_numbered,
  max(path) AS last_path FROM parsed GROUP BY 1, 2, 3""",
)
def url_rollup(t: Tables) -> DataFrame:
    url = F.col("url")
    parsed = t.pages.select(
        S.url_host(url).alias("host"),
        S.url_path(url).alias("path"),
        S.url_parameter(url, "ref").alias("ref"),
        S.url_parameter(url, "page").alias("page"),
    )
    section = F.split_part("path", F.lit("/"), F.lit(1)).alias("section")
    return parsed.groupBy("host", section, "ref").agg(
        F.count("*").alias("n_pages"),
        F.count("page").alias("n_numbered"),
        F.max("path").alias("last_path"),
    )


@query(
    "safe_math",
    """
WITH v AS (SELECT l_orderkey, l_linenumber, nullif(l_linenumber, 3) AS a, nullif(l_discount, 0.0) AS b, nullif(l_tax, 0.0) AS c, l_tax AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS added,
  coalesce(a, 0) - coalesce(b, 0) - coalesce(c, 0) AS subtracted,
  (a + b) / nullif(d, 0) AS divided FROM v""",
)
def safe_math(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_linenumber", F.lit(3)).alias("a"),
        F.nullif("l_discount", F.lit(0.0)).alias("b"),
        F.nullif("l_tax", F.lit(0.0)).alias("c"),
        F.col("l_tax").alias("d"),
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        S.safe_add("a", "b", "c").alias("added"),
        S.safe_subtract("a", "b", "c").alias("subtracted"),
        S.safe_divide(F.col("a") + F.col("b"), F.col("d")).alias("divided"),
    )


@query(
    "json_translation",
    """
SELECT event_id, props->>'k' AS k, props->>'missing-key' AS missing, upper(doc->>'en-us') AS en_us, upper(doc->>'pt-br') AS pt_br
FROM (SELECT event_id, props, '{"en-us": "' || event_type || '"}' AS doc FROM events)""",
)
def json_translation(t: Tables) -> DataFrame:
    doc = F.concat(F.lit('{"en-us": "'), "event_type", F.lit('"}'))
    return t.events.withColumn("doc", doc).select(
        "event_id",
        F.get_json_object("props", "$['k']").alias("k"),
        F.get_json_object("props", "$['missing-key']").alias("missing"),
        F.upper(F.get_json_object("doc", "$['en-us']")).alias("en_us"),
        F.upper(F.get_json_object("doc", "$['pt-br']")).alias("pt_br"),
    )
