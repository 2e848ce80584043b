"""One query per data-quality check; each returns the failing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import checks as C
from tidemark.plans.monitor import freshness
from tidemark.queries.registry import RUN_2, Tables, query


@query(
    "q_accepted_range",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT o_totalprice >= 1000 OR NOT o_totalprice <= 400000",
)
def q_accepted_range(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return C.accepted_range(rows, "o_totalprice", 1000, 400000)


@query(
    "q_accepted_range_exclusive",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT l_quantity > 1 OR NOT l_quantity < 50""",
)
def q_accepted_range_exclusive(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return C.accepted_range(rows, "l_quantity", 1, 50, inclusive=False)


@query(
    "q_at_least_one",
    """SELECT user_id, count(big) AS filler_column FROM (
  SELECT user_id, CASE WHEN value > 180 THEN value END AS big FROM events) GROUP BY user_id HAVING count(big) = 0""",
)
def q_at_least_one(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.when(F.col("value") > 180, F.col("value")).alias("big"))
    return C.at_least_one(rows, "big", ["user_id"])


@query(
    "q_at_least_one_whole_table",
    """SELECT count(v) AS filler_column FROM (SELECT CASE WHEN n_chars < 0 THEN 1 END AS v FROM documents) HAVING count(v) = 0""",
)
def q_at_least_one_whole_table(t: Tables) -> DataFrame:
    rows = t.documents.select(F.when(F.col("n_chars") < 0, 1).alias("v"))
    return C.at_least_one(rows, "v")


@query(
    "q_cardinality_equality",
    """
WITH a AS (SELECT c_custkey AS c_custkey, count(*) AS num_rows FROM customer GROUP BY 1),
b AS (SELECT o_custkey AS c_custkey, count(*) AS num_rows FROM orders GROUP BY 1)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def q_cardinality_equality(t: Tables) -> DataFrame:
    return C.cardinality_equality(t.customer, "c_custkey", t.orders, "o_custkey")


@query(
    "q_equal_rowcount",
    """
WITH a AS (SELECT k, count(*) AS count_a FROM (SELECT nullif(c_nationkey, 3) AS k FROM customer WHERE c_nationkey <> 5) GROUP BY 1),
b AS (SELECT k, count(*) AS count_b FROM (SELECT nullif(s_nationkey, 3) AS k FROM supplier) GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, count_a, count_b, abs(count_a - count_b) AS diff_count FROM a FULL JOIN b ON a.k = b.k""",
)
def q_equal_rowcount(t: Tables) -> DataFrame:
    a = t.customer.filter("c_nationkey <> 5").select(F.nullif("c_nationkey", F.lit(3)).alias("k"))
    b = t.supplier.select(F.nullif("s_nationkey", F.lit(3)).alias("k"))
    return C.equal_rowcount(a, b, ["k"])


@query(
    "q_equal_rowcount_whole_table",
    """SELECT (SELECT count(*) FROM documents) AS count_a, (SELECT count(*) FROM labels) AS count_b,
  abs((SELECT count(*) FROM documents) - (SELECT count(*) FROM labels)) AS diff_count""",
)
def q_equal_rowcount_whole_table(t: Tables) -> DataFrame:
    return C.equal_rowcount(t.documents, t.labels)


@query(
    "q_fewer_rows_than",
    """
WITH a AS (SELECT l_returnflag AS f, count(*) AS count_our_model FROM lineitem GROUP BY 1),
b AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' ELSE o_orderstatus END AS f, count(*) AS count_comparison_model FROM orders GROUP BY 1)
SELECT coalesce(a.f, b.f) AS f, count_our_model, count_comparison_model,
  CASE WHEN count_our_model > count_comparison_model THEN count_our_model - count_comparison_model
    WHEN count_our_model = count_comparison_model THEN 1 ELSE 0 END AS row_count_delta
FROM a FULL JOIN b ON a.f = b.f""",
)
def q_fewer_rows_than(t: Tables) -> DataFrame:
    a = t.lineitem.select(F.col("l_returnflag").alias("f"))
    status = F.col("o_orderstatus")
    b = t.orders.select(F.when(status == "F", "A").when(status == "O", "N").otherwise(status).alias("f"))
    return C.fewer_rows_than(a, b, ["f"])


_PRICES_A = "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem"
_PRICES_B = """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN l_extendedprice + 0.001
  WHEN l_returnflag = 'A' AND l_quantity > 40 THEN l_extendedprice + 1 ELSE l_extendedprice END AS l_extendedprice FROM lineitem"""


def _changed_prices(lines: DataFrame) -> DataFrame:
    price, flag = F.col("l_extendedprice"), F.col("l_returnflag")
    changed = (
        F.when(flag == "R", price + 0.001)
        .when((flag == "A") & (F.col("l_quantity") > 40), price + 1)
        .otherwise(price)
    )
    return lines.select("l_orderkey", "l_linenumber", changed.alias("l_extendedprice"))


@query(
    "q_equality",
    f"""
WITH a AS ({_PRICES_A}), b AS ({_PRICES_B})
SELECT 'a_minus_b' AS which_diff, x.* FROM (SELECT * FROM a EXCEPT SELECT * FROM b) x
UNION ALL SELECT 'b_minus_a', y.* FROM (SELECT * FROM b EXCEPT SELECT * FROM a) y""",
)
def q_equality(t: Tables) -> DataFrame:
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return C.equality(a, _changed_prices(t.lineitem))


@query(
    "q_equality_with_precision",
    f"""
WITH a AS ({_PRICES_A.replace('l_extendedprice', 'CAST(round(CAST(l_extendedprice AS DECIMAL(28,10)), 1) AS DOUBLE) AS price')}),
b AS (SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(28,10)), 1) AS DOUBLE) AS price FROM ({_PRICES_B}))
SELECT 'a_minus_b' AS which_diff, x.* FROM (SELECT * FROM a EXCEPT SELECT * FROM b) x
UNION ALL SELECT 'b_minus_a', y.* FROM (SELECT * FROM b EXCEPT SELECT * FROM a) y""",
)
def q_equality_with_precision(t: Tables) -> DataFrame:
    """Small differences vanish when numbers are compared to one digit."""
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")
    b = _changed_prices(t.lineitem).withColumn("l_tax", F.lit(9.0))
    failing = C.equality(a, b, exclude=["L_TAX"], precision=1)
    return failing.select(
        "which_diff",
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        F.col("l_extendedprice").cast("double").alias("price"),
    )


@query(
    "q_expression_is_true",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem WHERE NOT (nullif(l_tax, 0.04) * l_quantity < 3)",
)
def q_expression_is_true(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return C.expression_is_true(rows, "< 3", "nullif(l_tax, 0.04D) * l_quantity")


_RANGES = """
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS valid_from, CAST(l_shipdate AS DATE) + CAST(l_linenumber - 2 AS INTEGER) AS valid_to,
    row_number() OVER () AS copy
  FROM lineitem"""


def _ranges(t: Tables) -> DataFrame:
    start = F.col("l_shipdate").cast("date")
    return t.lineitem.select(
        "l_suppkey", start.alias("valid_from"), F.date_add(start, F.col("l_linenumber") - 2).alias("valid_to")
    )


def _range_sql(partition: str, gaps: str, zero: str) -> str:
    # Equal ranges need one order for both windows, or the last record is arbitrary.
    over = f"PARTITION BY {partition} " if partition else ""
    shown = f"{partition} AS partition_by_col, " if partition else ""
    keep = "partition_by_col, " if partition else ""
    return f"""
WITH w AS (SELECT {shown}valid_from AS lower_bound, valid_to AS upper_bound,
    lead(valid_from) OVER ({over}ORDER BY valid_from, valid_to, copy) AS next_lower_bound,
    row_number() OVER ({over}ORDER BY valid_from DESC, valid_to DESC, copy DESC) = 1 AS is_last_record
  FROM ({_RANGES}))
SELECT {keep}lower_bound, upper_bound, next_lower_bound, is_last_record FROM w
WHERE NOT (coalesce(lower_bound {zero} upper_bound, false)
  AND coalesce(upper_bound {gaps} next_lower_bound, is_last_record, false))"""


@query("q_mutually_exclusive_ranges", _range_sql("l_suppkey", "<=", "<"))
def q_mutually_exclusive_ranges(t: Tables) -> DataFrame:
    return C.mutually_exclusive_ranges(_ranges(t), "valid_from", "valid_to", "l_suppkey")


@query("q_exclusive_ranges_gaps_required", _range_sql("l_suppkey", "<", "<="))
def q_exclusive_ranges_gaps_required(t: Tables) -> DataFrame:
    return C.mutually_exclusive_ranges(
        _ranges(t), "valid_from", "valid_to", "l_suppkey", "required", zero_length_range_allowed=True
    )


@query("q_exclusive_ranges_whole_table", _range_sql("", "=", "<="))
def q_exclusive_ranges_whole_table(t: Tables) -> DataFrame:
    """Without a partition the whole table is one group, cut into stretches."""
    return C.mutually_exclusive_ranges(
        _ranges(t), "valid_from", "valid_to", None, "not_allowed", True
    )


@query(
    "q_not_accepted_values",
    "SELECT DISTINCT o_orderpriority AS value_field FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW', 'none')",
)
def q_not_accepted_values(t: Tables) -> DataFrame:
    return C.not_accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "5-LOW", "none"])


@query(
    "q_not_constant",
    """SELECT o_custkey, count(DISTINCT s) AS filler_column FROM (
  SELECT o_custkey, nullif(o_orderstatus, 'P') AS s FROM orders) GROUP BY o_custkey HAVING count(DISTINCT s) = 1""",
)
def q_not_constant(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    return C.not_constant(rows, "s", ["o_custkey"])


@query(
    "q_not_empty_string",
    """SELECT trim(x) AS x FROM (SELECT CASE WHEN lang = 'en' THEN '  ' WHEN lang = 'de' THEN NULL ELSE lang END AS x FROM documents)
WHERE trim(x) = ''""",
)
def q_not_empty_string(t: Tables) -> DataFrame:
    lang = F.col("lang")
    x = F.when(lang == "en", "  ").when(lang == "de", None).otherwise(lang)
    return C.not_empty_string(t.documents.select(x.alias("x")), "x")


@query(
    "q_not_null_proportion",
    """SELECT event_type, not_null_proportion FROM (
  SELECT event_type, CAST(sum(CASE WHEN v IS NULL THEN 0 ELSE 1 END) AS DOUBLE) / count(*) AS not_null_proportion
  FROM (SELECT event_type, CASE WHEN value > 10 THEN value END AS v FROM events) GROUP BY event_type)
WHERE not_null_proportion < 0.8195 OR not_null_proportion > 1""",
)
def q_not_null_proportion(t: Tables) -> DataFrame:
    rows = t.events.select("event_type", F.when(F.col("value") > 10, F.col("value")).alias("v"))
    return C.not_null_proportion(rows, "v", 0.8195, group=["event_type"])


@query(
    "q_recency",
    """SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-30' AS threshold FROM events GROUP BY user_id
HAVING max(ts) < TIMESTAMP '2024-01-30'""",
)
def q_recency(t: Tables) -> DataFrame:
    return C.recency(t.events, "ts", "day", 2, RUN_2, group=["user_id"])


@query(
    "q_recency_without_time",
    """SELECT user_id, CAST(max(ts) AS DATE) AS most_recent, DATE '2024-01-30' AS threshold FROM events GROUP BY user_id
HAVING CAST(max(ts) AS DATE) < DATE '2024-01-30'""",
)
def q_recency_without_time(t: Tables) -> DataFrame:
    return C.recency(t.events, "ts", "day", 2, RUN_2, ignore_time=True, group=["user_id"])


@query(
    "q_relationships_where",
    """SELECT o_custkey AS id FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus <> 'P'
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL AND c_acctbal > 0)""",
)
def q_relationships_where(t: Tables) -> DataFrame:
    return C.relationships_where(
        t.orders, "o_custkey", t.customer, "c_custkey", "o_orderstatus <> 'P'", "c_acctbal > 0"
    )


@query(
    "q_sequential_values",
    """SELECT l_orderkey, l_linenumber, previous_l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous_l_linenumber FROM lineitem)
WHERE NOT (l_linenumber = previous_l_linenumber + 1)""",
)
def q_sequential_values(t: Tables) -> DataFrame:
    return C.sequential_values(t.lineitem, "l_linenumber", group=["l_orderkey"])


@query(
    "q_sequential_days",
    """SELECT d, previous_d FROM (SELECT d, lag(d) OVER (ORDER BY d) AS previous_d FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders))
WHERE NOT (d = previous_d + INTERVAL 1 DAY)""",
)
def q_sequential_days(t: Tables) -> DataFrame:
    """Without a group the whole table is ordered; days repeat, so most rows fail."""
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("d"))
    return C.sequential_values(days, "d", 1, "day")


@query(
    "q_unique_combination",
    """SELECT user_id, d, event_type FROM (SELECT user_id, CAST(ts AS DATE) AS d, nullif(event_type, 'view') AS event_type FROM events)
GROUP BY ALL HAVING count(*) > 1""",
)
def q_unique_combination(t: Tables) -> DataFrame:
    rows = t.events.select(
        "user_id", F.col("ts").cast("date").alias("d"), F.nullif("event_type", F.lit("view")).alias("event_type")
    )
    return C.unique_combination_of_columns(rows, ["user_id", "d", "event_type"])


@query(
    "q_not_null",
    "SELECT doc_id, lang FROM (SELECT doc_id, nullif(lang, 'en') AS lang FROM documents) WHERE lang IS NULL",
)
def q_not_null(t: Tables) -> DataFrame:
    return C.not_null(t.documents.select("doc_id", F.nullif("lang", F.lit("en")).alias("lang")), "lang")


@query(
    "q_unique",
    """SELECT k AS unique_field, count(*) AS n_records FROM (SELECT nullif(o_custkey, 1) AS k FROM orders)
WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1""",
)
def q_unique(t: Tables) -> DataFrame:
    return C.unique(t.orders.select(F.nullif("o_custkey", F.lit(1)).alias("k")), "k")


@query(
    "q_accepted_values",
    """SELECT l_returnflag AS value_field, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING l_returnflag NOT IN ('A', 'N')""",
)
def q_accepted_values(t: Tables) -> DataFrame:
    return C.accepted_values(t.lineitem, "l_returnflag", ["A", "N"])


@query(
    "q_assert_equal",
    """SELECT l_orderkey, l_linenumber, a, b FROM (SELECT l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS a, l_tax AS b FROM lineitem) WHERE a <> b""",
)
def q_assert_equal(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("a"), F.col("l_tax").alias("b")
    )
    return C.assert_equal(rows, "a", "b")


@query(
    "q_freshness",
    """SELECT user_id, max(ts) AS max_loaded_at, CASE WHEN max(ts) < TIMESTAMP '2024-01-30 18:00:00' THEN 'error'
  WHEN max(ts) < TIMESTAMP '2024-01-31 06:00:00' THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT user_id, ts + INTERVAL 8 HOUR AS ts FROM events) GROUP BY user_id""",
)
def q_freshness(t: Tables) -> DataFrame:
    later = t.events.select("user_id", F.timestamp_add("HOUR", F.lit(8), "ts").alias("ts"))
    return freshness(later, "ts", RUN_2, group=["user_id"])


@query(
    "q_column_set",
    """SELECT 'EVENT_TYPE' AS column_name, 'unexpected' AS problem, count(*) AS n_rows FROM events
UNION ALL SELECT 'KIND', 'missing', count(*) FROM events""",
)
def q_column_set(t: Tables) -> DataFrame:
    """Columns that differ from the expected set, with the rows of the table they concern."""
    expected = ["event_id", "TS", "user_id", "kind", "value", "Props"]
    missing, extra = C.columns_differ(t.events, expected)
    found = [(c, "missing") for c in sorted(missing)] + [(c, "unexpected") for c in sorted(extra)]
    problems = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(p).alias("p")) for c, p in found]))
    counted = t.events.agg(F.count("*").alias("n_rows")).withColumn("x", problems)
    return counted.select(F.col("x.c").alias("column_name"), F.col("x.p").alias("problem"), "n_rows")


@query(
    "row_checks_one_scan",
    """
WITH f AS (SELECT
  count(*) FILTER (WHERE NOT o_totalprice >= 1000 OR NOT o_totalprice <= 400000) AS price_range,
  count(*) FILTER (WHERE NOT (o_orderstatus <> 'P')) AS not_pending,
  count(*) FILTER (WHERE o_custkey IS NULL) AS has_customer,
  count(*) FILTER (WHERE trim(o_orderpriority) = '') AS has_priority,
  count(*) FILTER (WHERE NOT o_totalprice <= 300000 AND o_orderstatus = 'F') AS finished_below FROM orders)
SELECT 'orders' AS "table", "check", failures, CASE WHEN failures > 100 THEN 'error' WHEN failures > 0 THEN 'warn' ELSE 'pass' END AS status
FROM (UNPIVOT f ON price_range, not_pending, has_customer, has_priority, finished_below INTO NAME "check" VALUE failures)""",
)
def row_checks_one_scan(t: Tables) -> DataFrame:
    """Five checks on one table share one scan; thresholds decide the outcome."""
    checks = [
        C.RowCheck("price_range", C.out_of_range("o_totalprice", 1000, 400000)),
        C.RowCheck("not_pending", C.is_false("o_orderstatus <> 'P'")),
        C.RowCheck("has_customer", C.is_missing("o_custkey")),
        C.RowCheck("has_priority", C.is_blank("o_orderpriority")),
        C.RowCheck(
            "finished_below", C.out_of_range("o_totalprice", max_value=300000), "o_orderstatus = 'F'"
        ),
    ]
    return C.run_row_checks(t.orders, "orders", checks, C.Thresholds(error_above=100))


@query(
    "group_checks_report",
    """
SELECT 'events' AS "table", 'unique_event' AS "check", count(*) AS failures, 'pass' AS status FROM (SELECT event_id FROM events GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'events', 'unique_user', count(*), 'error' FROM (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'events', 'known_user', count(*), CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)""",
)
def group_checks_report(t: Tables) -> DataFrame:
    failing = {
        "unique_event": C.unique_combination_of_columns(t.events, ["event_id"]),
        "unique_user": C.unique(t.events, "user_id"),
        "known_user": C.relationships_where(t.events, "user_id", t.customer, "c_custkey"),
    }
    return C.run_checks(failing, "events")
