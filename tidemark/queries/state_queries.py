"""Current state, dimensions, retention and streaming."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.entities import CLIENT
from tidemark.operators.keys import highest_key
from tidemark.operators.latest import deduplicate, latest_source_row
from tidemark.operators.merge import upsert
from tidemark.plans.current_state import (
    apply_landing,
    extract,
    landing_changes,
    merge_current_state,
    staging_slice,
    staging_view,
)
from tidemark.plans.dimension import (
    dimension_rows,
    load_dimension,
    next_dimension,
    resolve_keys,
    unknown_member,
    watermark_slice,
)
from tidemark.plans.domain import Warehouse, run_domain
from tidemark.plans.retention import retained, retention_counts
from tidemark.queries.registry import RUN_1, RUN_2, Tables, query
from tidemark.session import work_folder
from tidemark.sources.tables import AppendTable, KeyedTable
from tidemark.sources.views import client_view
from tidemark.spec import LANDING_EXTRACTED_AT, SOURCE_UPDATED_AT, UPDATED_AT, Column, EntitySpec
from tidemark.streaming.upsert import landing_stream, stream_upsert

EVENT_STATE = EntitySpec(
    name="event_state",
    key=("user_id", "event_type"),
    columns=(
        Column("user_id", "bigint"),
        Column("event_type"),
        Column("value", "double"),
        Column("props"),
    ),
)
STATE_OUTPUT = [
    "user_id", "event_type", "value", "props", "etl_batch_id", "bi_created_at",
    "bi_updated_at", "source_updated_at",
]


def ntz(value) -> F.Column:
    return F.lit(value).cast("timestamp_ntz")


def event_landing(events: DataFrame, extracted) -> DataFrame:
    return events.select(
        "user_id",
        "event_type",
        "value",
        "props",
        F.col("ts").alias(SOURCE_UPDATED_AT),
        ntz(extracted).alias(LANDING_EXTRACTED_AT),
    )


_LATEST_EVENTS = """
WITH landed AS (
  SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS batch FROM events),
last AS (
  SELECT * FROM landed
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type
    ORDER BY batch DESC, ts DESC, value DESC NULLS LAST, props DESC NULLS LAST) = 1),
seen AS (
  SELECT user_id, event_type, min(batch) AS first_batch, max(batch) AS last_batch
  FROM landed GROUP BY user_id, event_type)
"""


@query(
    "current_state_two_batches",
    _LATEST_EVENTS
    + """
SELECT l.user_id, l.event_type, l.value, l.props,
  'batch-' || last_batch AS etl_batch_id,
  CASE WHEN first_batch = 1 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01' END AS bi_created_at,
  CASE WHEN last_batch = 1 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01' END AS bi_updated_at,
  l.ts AS source_updated_at
FROM last l JOIN seen s USING (user_id, event_type)""",
)
def current_state_two_batches(t: Tables) -> DataFrame:
    state = KeyedTable(t.spark, work_folder(t.spark, "state"), EVENT_STATE.key)
    first = event_landing(t.events.filter(F.col("ts") < ntz(RUN_1)), RUN_1)
    second = event_landing(t.events.filter(F.col("ts") >= ntz(RUN_1)), RUN_2)
    merge_current_state(EVENT_STATE, first, state, RUN_1, "batch-1")
    merge_current_state(EVENT_STATE, second, state, RUN_2, "batch-2")
    return state.read().select(*STATE_OUTPUT)


@query(
    "current_state_as_one_query",
    _LATEST_EVENTS
    + """
SELECT l.user_id, l.event_type, l.value, l.props,
  'batch-' || last_batch AS etl_batch_id,
  CASE WHEN first_batch = 1 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01' END AS bi_created_at,
  CASE WHEN last_batch = 1 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01' END AS bi_updated_at,
  l.ts AS source_updated_at
FROM last l JOIN seen s USING (user_id, event_type)""",
)
def current_state_as_one_query(t: Tables) -> DataFrame:
    """The same two batches without stored tables."""
    first = event_landing(t.events.filter(F.col("ts") < ntz(RUN_1)), RUN_1)
    second = event_landing(t.events.filter(F.col("ts") >= ntz(RUN_1)), RUN_2)
    state = apply_landing(EVENT_STATE, first, None, RUN_1, "batch-1")
    return apply_landing(EVENT_STATE, second, state, RUN_2, "batch-2").select(*STATE_OUTPUT)


@query(
    "stream_upsert",
    _LATEST_EVENTS
    + """
SELECT user_id, event_type, value, props, TIMESTAMP '2024-02-01' AS bi_created_at,
  ts AS source_updated_at FROM last""",
)
def stream_upsert_events(t: Tables) -> DataFrame:
    """Events arrive as files of a landing folder and are merged by a stream."""
    root = work_folder(t.spark, "stream")
    landing = event_landing(t.events, RUN_1)
    for part, rows in (
        ("a", landing.filter(F.col(SOURCE_UPDATED_AT) < ntz(RUN_1))),
        ("b", landing.filter(F.col(SOURCE_UPDATED_AT) >= ntz(RUN_1))),
    ):
        rows.write.mode("append").parquet(f"{root}/landing")
        state = KeyedTable(t.spark, f"{root}/state", EVENT_STATE.key)
        stream = landing_stream(t.spark, f"{root}/landing", landing.schema)
        stream_upsert(EVENT_STATE, stream, state, f"{root}/checkpoint", RUN_2).awaitTermination()
    return state.read().select(
        "user_id", "event_type", "value", "props", "bi_created_at", "source_updated_at"
    )


@query(
    "stream_late_rows",
    _LATEST_EVENTS
    + """
SELECT user_id, event_type, value, props, ts AS source_updated_at FROM last""",
)
def stream_late_rows(t: Tables) -> DataFrame:
    """Files come in no order of time; a late row does not replace a newer one."""
    spec = replace(EVENT_STATE, keep_newest=True)
    root = work_folder(t.spark, "late")
    landing = event_landing(t.events, RUN_1)
    state = KeyedTable(t.spark, f"{root}/state", spec.key)
    for part in range(3):
        rows = landing.filter(F.pmod(F.xxhash64(*landing.columns), F.lit(3)) == part)
        rows.write.mode("append").parquet(f"{root}/landing")
        stream = landing_stream(t.spark, f"{root}/landing", landing.schema)
        stream_upsert(spec, stream, state, f"{root}/checkpoint", RUN_2).awaitTermination()
    return state.read().select("user_id", "event_type", "value", "props", "source_updated_at")


@query(
    "two_streams_one_table",
    _LATEST_EVENTS
    + """
SELECT user_id, event_type, value, props, ts AS source_updated_at FROM last""",
)
def two_streams_one_table(t: Tables) -> DataFrame:
    """Two landing folders, each with a stream and a checkpoint of its own, into one table."""
    root = work_folder(t.spark, "streams")
    landing = event_landing(t.events, RUN_1)
    state = KeyedTable(t.spark, f"{root}/state", EVENT_STATE.key)
    for part, rows in (
        ("a", landing.filter(F.col(SOURCE_UPDATED_AT) < ntz(RUN_1))),
        ("b", landing.filter(F.col(SOURCE_UPDATED_AT) >= ntz(RUN_1))),
    ):
        rows.write.parquet(f"{root}/landing-{part}")
        stream = landing_stream(t.spark, f"{root}/landing-{part}", landing.schema)
        stream_upsert(
            EVENT_STATE, stream, state, f"{root}/checkpoint-{part}", RUN_2
        ).awaitTermination()
    return state.read().select("user_id", "event_type", "value", "props", "source_updated_at")


SENTINEL_SPEC = EntitySpec(
    name="event_notes",
    key=("user_id", "event_type"),
    columns=(
        Column("user_id", "bigint"),
        Column("event_type"),
        Column("amount", "bigint"),
        Column("note"),
        Column("flag", "boolean", silent=True),
    ),
    compare_technical=False,
)

_NOTES = """
  SELECT user_id, event_type, ts,
    CASE WHEN value < 20 THEN NULL WHEN value < 40 THEN -999 ELSE CAST(floor(value / 20) AS BIGINT) END AS amount,
    CASE WHEN value < 30 THEN NULL WHEN value < 60 THEN '' ELSE 'high' END AS note,
    CASE WHEN value < 25 THEN NULL WHEN value < 50 THEN false ELSE true END AS flag
  FROM events"""


def _notes(events: DataFrame, extracted) -> DataFrame:
    v = F.col("value")
    return events.select(
        "user_id",
        "event_type",
        F.when(v < 40, F.when(v < 20, None).otherwise(-999)).otherwise(F.floor(v / 20)).cast("bigint").alias("amount"),
        F.when(v < 60, F.when(v < 30, None).otherwise("")).otherwise("high").alias("note"),
        F.when(v < 50, F.when(v < 25, None).otherwise(False)).otherwise(True).alias("flag"),
        F.col("ts").alias(SOURCE_UPDATED_AT),
        ntz(extracted).alias(LANDING_EXTRACTED_AT),
    )


@query(
    "changed_or_new_sentinels",
    f"""
WITH notes AS ({_NOTES}),
old AS (SELECT * FROM notes WHERE ts < TIMESTAMP '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, amount DESC NULLS LAST, note DESC NULLS LAST, flag DESC NULLS LAST) = 1),
new AS (SELECT * FROM notes WHERE ts >= TIMESTAMP '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, amount DESC NULLS LAST, note DESC NULLS LAST, flag DESC NULLS LAST) = 1),
both_sides AS (
  SELECT new.*, old.user_id IS NULL AS is_new,
    coalesce(old.amount, -999) <> coalesce(new.amount, -999)
      OR coalesce(old.note, '') <> coalesce(new.note, '') AS moved,
    coalesce(old.flag, false) <> coalesce(new.flag, false) AS flag_moved
  FROM new LEFT JOIN old USING (user_id, event_type))
SELECT user_id, event_type, amount, note, flag,
  CASE WHEN is_new THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-15' END AS bi_created_at,
  CASE WHEN is_new OR moved THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-15' END AS bi_updated_at
FROM both_sides WHERE is_new OR moved OR flag_moved""",
)
def changed_or_new_sentinels(t: Tables) -> DataFrame:
    first = _notes(t.events.filter(F.col("ts") < ntz(RUN_1)), RUN_1)
    second = _notes(t.events.filter(F.col("ts") >= ntz(RUN_1)), RUN_2)
    target = landing_changes(SENTINEL_SPEC, first, None, RUN_1, "batch-1")
    return landing_changes(SENTINEL_SPEC, second, target, RUN_2, "batch-2").select(
        "user_id", "event_type", "amount", "note", "flag", "bi_created_at", "bi_updated_at"
    )


@query(
    "current_state_null_safe_changes",
    f"""
WITH notes AS ({_NOTES}),
old AS (SELECT * FROM notes WHERE ts < TIMESTAMP '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, amount DESC NULLS LAST, note DESC NULLS LAST, flag DESC NULLS LAST) = 1),
new AS (SELECT * FROM notes WHERE ts >= TIMESTAMP '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, amount DESC NULLS LAST, note DESC NULLS LAST, flag DESC NULLS LAST) = 1)
SELECT user_id, event_type, new.amount, new.note, new.flag
FROM new LEFT JOIN old USING (user_id, event_type)
WHERE old.ts IS NULL OR old.amount IS DISTINCT FROM new.amount
  OR old.note IS DISTINCT FROM new.note OR old.flag IS DISTINCT FROM new.flag""",
)
def current_state_null_safe_changes(t: Tables) -> DataFrame:
    spec = replace(SENTINEL_SPEC, null_safe=True)
    first = _notes(t.events.filter(F.col("ts") < ntz(RUN_1)), RUN_1)
    second = _notes(t.events.filter(F.col("ts") >= ntz(RUN_1)), RUN_2)
    target = landing_changes(spec, first, None, RUN_1, "batch-1")
    changes = landing_changes(spec, second, target, RUN_2, "batch-2")
    return changes.select("user_id", "event_type", "amount", "note", "flag")


@query(
    "staging_nulls_first",
    """
SELECT user_id, event_type, value, bi_updated_at FROM (
  SELECT user_id, event_type, value, CASE WHEN value < 2 THEN NULL ELSE ts END AS bi_updated_at
  FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY bi_updated_at DESC NULLS FIRST,
  event_type DESC NULLS FIRST, value DESC NULLS LAST) = 1""",
)
def staging_nulls_first(t: Tables) -> DataFrame:
    return staging_view(USER_STATE, _user_state(t.events)).select(
        "user_id", F.col("etl_batch_id").alias("event_type"), "value", "bi_updated_at"
    )


USER_STATE = EntitySpec(
    "user_state", ("user_id",), (Column("user_id", "bigint"), Column("value", "double"))
)


def _user_state(events: DataFrame) -> DataFrame:
    """Events as current-state rows, some without an update time."""
    return events.select(
        "user_id",
        "value",
        F.col("event_type").alias("etl_batch_id"),
        F.lit(None).cast("timestamp_ntz").alias("bi_created_at"),
        F.when(F.col("value") >= 2, F.col("ts")).alias("bi_updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("source_updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("airbyte_extracted_at"),
    )


@query(
    "staging_slice_after_watermark",
    """
SELECT user_id, event_type, bi_updated_at FROM (
  SELECT user_id, event_type, value, CASE WHEN value < 2 THEN NULL ELSE ts END AS bi_updated_at
  FROM events QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY bi_updated_at DESC NULLS FIRST, event_type DESC NULLS FIRST, value DESC NULLS LAST) = 1)
WHERE bi_updated_at > TIMESTAMP '2024-01-28'""",
)
def staging_slice_after_watermark(t: Tables) -> DataFrame:
    """The watermark filter in front of the ranking; rows without a time still win."""
    newer = staging_slice(USER_STATE, _user_state(t.events), datetime(2024, 1, 28))
    return newer.select("user_id", F.col("etl_batch_id").alias("event_type"), "bi_updated_at")


_LATEST_LINE = """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
  l_suppkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
  l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1"""


@query("latest_per_key", _LATEST_LINE)
def latest_per_key(t: Tables) -> DataFrame:
    return latest_source_row(t.lineitem, ["l_partkey"], "l_shipdate")


@query("latest_per_key_by_rank", _LATEST_LINE)
def latest_per_key_by_rank(t: Tables) -> DataFrame:
    return deduplicate(t.lineitem, ["l_partkey"], [F.col("l_shipdate").desc_nulls_last()])


@query(
    "deduplicate_by_order",
    """
SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
  ORDER BY o_totalprice ASC, o_orderkey DESC) = 1""",
)
def deduplicate_by_order(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")
    return deduplicate(rows, ["o_custkey", "o_orderpriority"], [F.col("o_totalprice").asc()])


@query(
    "upsert_with_schema_sync",
    """
SELECT c.p_partkey, c.p_name, c.p_retailprice FROM part c WHERE p_size > 25
UNION ALL
SELECT p_partkey, p_name, NULL FROM part WHERE p_size <= 25""",
)
def upsert_with_schema_sync(t: Tables) -> DataFrame:
    """The incoming rows drop p_type and bring p_retailprice."""
    target = t.part.select("p_partkey", "p_name", "p_type")
    changes = t.part.filter("p_size > 25").select("p_partkey", "p_name", "p_retailprice")
    return upsert(target, changes, ["p_partkey"])


CUSTOMER = EntitySpec(
    name="customer",
    key=("c_custkey",),
    surrogate_key="sk_customer",
    columns=(
        Column("c_custkey", "bigint", unknown=-1),
        Column("c_name", upper=True, unknown="UNDEFINED"),
        Column("c_mktsegment", upper=True, unknown="UNDEFINED"),
        Column("c_acctbal", "double", unknown=-1.0),
    ),
)


def _customer_landing(rows: DataFrame) -> DataFrame:
    return rows.select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        "c_acctbal",
        ntz(RUN_1).alias(SOURCE_UPDATED_AT),
        ntz(RUN_1).alias(LANDING_EXTRACTED_AT),
    )


def _two_customer_loads(t: Tables) -> tuple[Warehouse, DataFrame]:
    """Customers with orders first; then all, those in debt in another segment."""
    wh = Warehouse(t.spark, work_folder(t.spark, "warehouse"))
    state, dimension = wh.current_state(CUSTOMER), wh.dimension(CUSTOMER)
    buyers = t.customer.join(
        t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi"
    )
    moved = t.customer.withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") < 0, "lapsed").otherwise(F.col("c_mktsegment"))
    )
    merge_current_state(CUSTOMER, _customer_landing(buyers), state, RUN_1, "run-1")
    load_dimension(CUSTOMER, state.read(), dimension, None, RUN_1, "run-1")
    before = dimension.read()
    merge_current_state(CUSTOMER, _customer_landing(moved), state, RUN_2, "run-2")
    load_dimension(CUSTOMER, state.read(), dimension, RUN_1, RUN_2, "run-2")
    return wh, before


@query(
    "dimension_two_runs",
    """
WITH base AS (
  SELECT *, c_custkey IN (SELECT o_custkey FROM orders) AS early, c_acctbal < 0 AS lapsed FROM customer)
SELECT c_custkey, upper(c_name) AS c_name,
  CASE WHEN lapsed THEN 'LAPSED' ELSE upper(c_mktsegment) END AS c_mktsegment, c_acctbal,
  CASE WHEN early AND NOT lapsed THEN 'run-1' ELSE 'run-2' END AS etl_batch_id,
  CASE WHEN early THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01' END AS bi_created_at,
  CASE WHEN early AND NOT lapsed THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01' END AS bi_updated_at,
  true AS key_kept, true AS key_unique
FROM base
UNION ALL
SELECT -1, 'UNDEFINED', 'UNDEFINED', -1.0, 'run-1', TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-15', true, true""",
)
def dimension_two_runs(t: Tables) -> DataFrame:
    wh, before = _two_customer_loads(t)
    after = wh.dimension(CUSTOMER).read()
    uses = after.groupBy("sk_customer").agg(F.count("*").alias("uses"))
    old = before.select("c_custkey", F.col("sk_customer").alias("old_key"))
    joined = after.join(old, "c_custkey", "left").join(uses, "sk_customer")
    return joined.select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal", "etl_batch_id", "bi_created_at",
        "bi_updated_at",
        F.coalesce(F.col("old_key") == F.col("sk_customer"), F.lit(True)).alias("key_kept"),
        (F.col("uses") == 1).alias("key_unique"),
    )


PART = EntitySpec(
    name="part",
    key=("p_partkey",),
    surrogate_key="sk_part",
    columns=(Column("p_partkey", "bigint", unknown=-1), Column("p_brand", unknown="UNDEFINED")),
)


def _staged_parts(rows: DataFrame, run, batch: str) -> DataFrame:
    return rows.select(
        "p_partkey",
        "p_brand",
        F.lit(batch).alias("etl_batch_id"),
        ntz(run).alias("bi_created_at"),
        ntz(run).alias("bi_updated_at"),
    )


@query(
    "surrogate_key_stability",
    """
SELECT p_brand, count(*) FILTER (WHERE p_size <= 25) AS kept, count(*) FILTER (WHERE p_size > 25) AS added,
  CAST(0 AS BIGINT) AS changed_keys, CAST(0 AS BIGINT) AS shared_keys
FROM part GROUP BY p_brand""",
)
def surrogate_key_stability(t: Tables) -> DataFrame:
    first = dimension_rows(PART, _staged_parts(t.part.filter("p_size <= 25"), RUN_1, "1"), None)
    highest = highest_key(first, "sk_part")
    second = dimension_rows(PART, _staged_parts(t.part, RUN_2, "2"), first, highest)
    old = first.select("p_partkey", F.col("sk_part").alias("old_key"))
    uses = second.groupBy("sk_part").agg(F.count("*").alias("uses"))
    joined = second.join(old, "p_partkey", "left").join(uses, "sk_part")
    known = F.col("old_key").isNotNull()
    return joined.groupBy("p_brand").agg(
        F.count_if(known).alias("kept"),
        F.count_if(~known & (F.col("sk_part") > highest)).alias("added"),
        F.count_if(known & (F.col("old_key") != F.col("sk_part"))).alias("changed_keys"),
        F.count_if(F.col("uses") > 1).alias("shared_keys"),
    )


@query(
    "dimension_as_one_query",
    """
SELECT p_partkey, p_brand, CASE WHEN p_size <= 25 THEN '1' ELSE '2' END AS etl_batch_id, TIMESTAMP '2024-01-15' AS bi_created_at,
  CASE WHEN p_size <= 25 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01' END AS bi_updated_at, p_size > 40 AS has_new_key
FROM part WHERE p_size <= 40
UNION ALL
SELECT p_partkey, p_brand, '2', TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01', true FROM part WHERE p_size > 40""",
)
def dimension_as_one_query(t: Tables) -> DataFrame:
    """An incremental load on top of a first one, as a query; small parts are not newer."""
    first = dimension_rows(PART, _staged_parts(t.part.filter("p_size <= 40"), RUN_1, "1"), None)
    highest = highest_key(first, "sk_part")
    old = _staged_parts(t.part.filter("p_size <= 25"), RUN_1, "1")
    new = _staged_parts(t.part.filter("p_size > 25"), RUN_2, "2")
    loaded = next_dimension(PART, old.unionByName(new), first, RUN_1, highest)
    return loaded.select(
        "p_partkey", "p_brand", "etl_batch_id", "bi_created_at", "bi_updated_at",
        (F.col("sk_part") > highest).alias("has_new_key"),
    )


@query(
    "unknown_member",
    """
SELECT o_orderpriority, coalesce(c.c_mktsegment, 'UNDEFINED') AS c_mktsegment,
  c.c_custkey IS NULL AS is_unknown, count(*) AS n_orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders o LEFT JOIN (SELECT c_custkey, upper(c_mktsegment) AS c_mktsegment FROM customer WHERE c_acctbal >= 0) c
  ON o.o_custkey = c.c_custkey
GROUP BY ALL""",
)
def unknown_member_fallback(t: Tables) -> DataFrame:
    """Orders whose customer is not in the dimension point at the unknown member."""
    staged = _customer_landing(t.customer.filter("c_acctbal >= 0")).select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal",
        F.lit("run-1").alias("etl_batch_id"),
        ntz(RUN_1).alias("bi_created_at"), ntz(RUN_1).alias("bi_updated_at"),
    )
    dimension = unknown_member(t.spark, CUSTOMER, RUN_1, "run-1").unionByName(
        dimension_rows(CUSTOMER, staged, None)
    )
    facts = resolve_keys(t.orders, dimension, {"o_custkey": "c_custkey"}, "sk_customer")
    priced = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
    described = facts.join(dimension.select("sk_customer", "c_mktsegment"), "sk_customer")
    return described.groupBy(
        "o_orderpriority", "c_mktsegment", (F.col("sk_customer") == -1).alias("is_unknown")
    ).agg(F.count("*").alias("n_orders"), priced.cast("double").alias("total_price"))


@query(
    "watermark_slice",
    """
SELECT event_id, user_id, ts FROM events
WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-15')""",
)
def watermark_slice_events(t: Tables) -> DataFrame:
    """The watermark is read first and reaches the scan as a literal bound."""
    done = t.events.filter((F.col("event_type") == "signup") & (F.col("ts") < ntz(RUN_1)))
    watermark = done.agg(F.max("ts")).first()[0]
    staged = t.events.select("event_id", "user_id", F.col("ts").alias(UPDATED_AT))
    return watermark_slice(staged, watermark).withColumnRenamed(UPDATED_AT, "ts")


@query(
    "retention_split",
    """
SELECT CAST(ts AS DATE) AS day, count(*) AS rows_before,
  count(*) FILTER (WHERE CAST(ts AS DATE) < DATE '2024-01-15') AS rows_deleted,
  count(*) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-15') AS rows_kept
FROM events GROUP BY 1""",
)
def retention_split(t: Tables) -> DataFrame:
    return retention_counts(t.events, "ts", date(2024, 1, 15))


@query(
    "retention_delete_current_state",
    """
SELECT event_id, user_id, bi_updated_at FROM (
  SELECT event_id, user_id, CASE WHEN value < 5 THEN NULL ELSE ts END AS bi_updated_at FROM events)
WHERE NOT (bi_updated_at IS NOT NULL AND CAST(bi_updated_at AS DATE) < DATE '2024-01-15')""",
)
def retention_delete_current_state(t: Tables) -> DataFrame:
    """Drop the old days of a stored table; rows without a time stay."""
    root = work_folder(t.spark, "retention")
    stored = KeyedTable(t.spark, root, ["event_id"], day_column="bi_updated_at")
    rows = t.events.select(
        "event_id", "user_id", F.when(F.col("value") >= 5, F.col("ts")).alias("bi_updated_at")
    )
    stored.merge(rows)
    stored.drop_days_before(RUN_1.date())
    return stored.read()


@query(
    "retention_drop_audit_days",
    """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-14' GROUP BY 1""",
)
def retention_drop_audit_days(t: Tables) -> DataFrame:
    """The audit log keeps the run's day and the day before; old days go whole."""
    log = AppendTable(t.spark, work_folder(t.spark, "audit"), "ts")
    log.append(t.events.select("event_id", "event_type", "ts"))
    log.drop_days_before(RUN_1.date() - timedelta(days=1))
    return log.read().groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n_events"))


@query(
    "retained_rows",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE NOT CAST(o_orderdate AS DATE) < DATE '1998-01-01'",
)
def retained_rows(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return retained(rows, "o_orderdate", date(1998, 1, 1))


@query(
    "purge_landing_after_load",
    """
SELECT count(*) AS landed, count(*) AS purged, CAST(0 AS BIGINT) AS left_over FROM events""",
)
def purge_landing_after_load(t: Tables) -> DataFrame:
    landing = AppendTable(t.spark, work_folder(t.spark, "landing"), LANDING_EXTRACTED_AT)
    landed = landing.append(event_landing(t.events, RUN_1))
    purged = landing.clear()
    return landing.read().agg(
        F.lit(landed).cast("bigint").alias("landed"),
        F.lit(purged).cast("bigint").alias("purged"),
        F.count("*").alias("left_over"),
    )


_CLIENTS = """
  SELECT c_custkey AS id, c_name, c_mktsegment, c_nationkey, c_acctbal,
    c_custkey IN (SELECT o_custkey FROM orders) AS early FROM customer"""


@query(
    "domain_two_runs",
    f"""
WITH clients AS ({_CLIENTS})
SELECT id AS id_cliente, upper(c_name) AS nome_cliente, upper(c_mktsegment) AS owner_cliente,
  'N' || c_nationkey AS server_cliente, c_acctbal >= 0 AS fg_ativo, 'run-2' AS etl_batch_id,
  CASE WHEN early THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01' END AS bi_created_at,
  TIMESTAMP '2024-02-01' AS bi_updated_at
FROM clients""",
)
def domain_two_runs(t: Tables) -> DataFrame:
    """Two whole domain runs of the client entity, control records included.

    The second run extracts everything again; a newer extract time makes every row
    changed.
    """
    found = _client_domain(t).dimension(CLIENT).read()
    return found.withColumn("id_cliente", F.col("id_cliente").cast("bigint"))


def _client_domain(t: Tables) -> Warehouse:
    wh = Warehouse(t.spark, work_folder(t.spark, "domain"))
    clients = t.customer.select(
        F.col("c_custkey").alias("cd_id"),
        F.col("c_name").alias("nome"),
        F.col("c_mktsegment").alias("owner"),
        F.concat(F.lit("n"), "c_nationkey").alias("server"),
        (F.col("c_acctbal") >= 0).alias("fg_ativo"),
    )
    buyers = t.orders.select(F.col("o_custkey").alias("cd_id"))
    for run_ts, batch, rows in (
        (RUN_1, "run-1", clients.join(buyers, "cd_id", "left_semi")),
        (RUN_2, "run-2", clients),
    ):
        landing = extract(CLIENT, client_view(rows), wh.current_state(CLIENT), run_ts)
        run_domain(wh, [CLIENT], {CLIENT.name: landing}, run_ts, batch)
    return wh


@query(
    "domain_control_state",
    """
WITH n AS (SELECT count(*) AS n FROM customer)
SELECT 'dimensions_domain' AS pipeline_name, 'run-2' AS batch_id, 'SUCCESS' AS batch_status, NULL AS watermark_status,
  n AS rows_extracted, n AS rows_loaded, n AS rows_affected, CAST(NULL AS TIMESTAMP) AS last_bi_updated_at,
  CAST(NULL AS VARCHAR) AS last_success_batch_id, CAST(4 AS BIGINT) AS audit_events, CAST(1 AS BIGINT) AS started_events, '' AS failed_steps FROM n
UNION ALL
SELECT 'dim_sx_cliente_d', NULL, NULL, 'SUCCESS', NULL, NULL, NULL, TIMESTAMP '2024-02-01', 'run-2', NULL, NULL, NULL""",
)
def domain_control_state(t: Tables) -> DataFrame:
    """What the control tables say after the two domain runs."""
    return _client_domain(t).control.status().select(
        "pipeline_name", "batch_id", "batch_status", "watermark_status", "rows_extracted",
        "rows_loaded", "rows_affected", "last_bi_updated_at", "last_success_batch_id",
        "audit_events", "started_events", "failed_steps",
    )


@query(
    "extract_after_merge",
    """
SELECT event_id, user_id, ts AS source_updated_at FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')""",
)
def extract_after_merge(t: Tables) -> DataFrame:
    """The stored table knows the last source time it has merged."""
    spec = EntitySpec(
        "event", ("event_id",), (Column("event_id", "bigint"), Column("user_id", "bigint"))
    )
    state = KeyedTable(t.spark, work_folder(t.spark, "event"), spec.key)
    source = t.events.select("event_id", "user_id", F.col("ts").alias(SOURCE_UPDATED_AT))
    early = extract(spec, source.filter(F.col(SOURCE_UPDATED_AT) < ntz(RUN_1)), state, RUN_1)
    merge_current_state(spec, early, state, RUN_1, "run-1")
    return extract(spec, source, state, RUN_2).drop(LANDING_EXTRACTED_AT)


NAMED = EntitySpec(
    name="named",
    key=("name",),
    columns=(Column("name", upper=True), Column("nation", "bigint"), Column("balance", "double")),
    surrogate_key="sk_named",
)


@query(
    "surrogate_key_upper_key",
    """
SELECT CAST(c_nationkey AS BIGINT) AS nation, count(*) AS kept, CAST(0 AS BIGINT) AS changed_keys FROM customer GROUP BY 1""",
)
def surrogate_key_upper_key(t: Tables) -> DataFrame:
    """Lower-case source keys, upper-case dimension keys, and a lookup that never reads all."""
    root = work_folder(t.spark, "named")
    state = KeyedTable(t.spark, f"{root}/state", NAMED.key, 8)
    dimension = KeyedTable(t.spark, f"{root}/dimension", NAMED.key, 8, small_bytes=0)
    seen = []
    for n, at in enumerate((RUN_1, RUN_2)):
        landing = t.customer.select(
            F.lower("c_name").alias("name"),
            F.col("c_nationkey").cast("bigint").alias("nation"),
            (F.col("c_acctbal") + n).alias("balance"),
            ntz(at).alias(SOURCE_UPDATED_AT),
            ntz(at).alias(LANDING_EXTRACTED_AT),
        )
        merge_current_state(NAMED, landing, state, at, f"run-{n}")
        watermark = RUN_1 if n else None
        load_dimension(NAMED, state.read(), dimension, watermark, at, f"run-{n}")
        seen.append(dimension.read().filter("sk_named <> -1"))
    first = seen[0].select("name", F.col("sk_named").alias("old_key"))
    return seen[1].join(first, "name", "left").groupBy("nation").agg(
        F.count("old_key").alias("kept"),
        F.count_if(~F.col("old_key").eqNullSafe(F.col("sk_named"))).alias("changed_keys"),
    )


@query(
    "dropped_client_key",
    "SELECT c_custkey AS id_cliente, upper(c_name) AS nome_cliente FROM customer WHERE c_custkey <> 1",
)
def dropped_client_key(t: Tables) -> DataFrame:
    """A client with the key of the unknown member never reaches the dimension."""
    root = work_folder(t.spark, "dropped")
    landing = t.customer.select(
        F.when(F.col("c_custkey") == 1, -1).otherwise(F.col("c_custkey")).alias("id_cliente"),
        F.col("c_name").alias("nome_cliente"),
        F.col("c_mktsegment").alias("owner_cliente"),
        F.lit("srv").alias("server_cliente"),
        F.lit(True).alias("fg_ativo"),
        ntz(RUN_1).alias(SOURCE_UPDATED_AT),
        ntz(RUN_1).alias(LANDING_EXTRACTED_AT),
    )
    state = KeyedTable(t.spark, f"{root}/state", CLIENT.key)
    dimension = KeyedTable(t.spark, f"{root}/dimension", CLIENT.key)
    merge_current_state(CLIENT, landing, state, RUN_1, "run-1")
    load_dimension(CLIENT, state.read(), dimension, None, RUN_1, "run-1")
    return dimension.read().select(F.col("id_cliente").cast("bigint").alias("id_cliente"), "nome_cliente")
