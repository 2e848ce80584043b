"""Control tables, monitoring and log statistics over records derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import control as C
from tidemark.plans import monitor as M
from tidemark.plans import run_logs as L
from tidemark.queries.registry import RUN_2, RUN_3, Tables, query


def _ntz(value) -> F.Column:
    return F.lit(value).cast("timestamp_ntz")


def audit_events(events: DataFrame) -> DataFrame:
    """Events as an audit log: a user is a batch and an event type a step."""
    kind = F.col("event_type")
    status = F.when(kind == "error", "FAILED").when(kind == "signup", "STARTED").otherwise("SUCCESS")
    return events.select(
        F.col("event_id").alias("audit_event_id"),
        F.concat(F.lit("b"), "user_id").alias("batch_id"),
        F.concat("event_type", F.lit("-"), F.day("ts")).alias("step_name"),
        status.alias("status"),
        F.when(F.col("value") >= 3, F.hour("ts")).cast("bigint").alias("execution_order"),
        F.col("ts").alias("started_at"),
        F.when(kind != "signup", F.timestamp_add("MINUTE", F.lit(5), "ts")).alias("ended_at"),
    )


_AUDIT = """
  SELECT event_id AS audit_event_id, 'b' || user_id AS batch_id, event_type || '-' || day(ts) AS step_name,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'STARTED' ELSE 'SUCCESS' END AS status,
    CASE WHEN value >= 3 THEN hour(ts) END AS execution_order, ts AS started_at,
    CASE WHEN event_type <> 'signup' THEN ts + INTERVAL 5 MINUTE END AS ended_at FROM events"""
_SUMMARY = """
  SELECT batch_id, count(*) AS audit_events, count(*) FILTER (WHERE status = 'STARTED') AS started_events,
    count(*) FILTER (WHERE status = 'SUCCESS') AS success_events, count(*) FILTER (WHERE status = 'FAILED') AS failed_events,
    min(started_at) AS first_step_started_at, max(ended_at) AS last_step_ended_at,
    coalesce(string_agg(step_name, ', ' ORDER BY execution_order NULLS LAST, audit_event_id) FILTER (WHERE status = 'FAILED'), '') AS failed_steps
  FROM audit GROUP BY batch_id"""


@query("audit_summary", f"WITH audit AS ({_AUDIT}) {_SUMMARY}")
def audit_summary(t: Tables) -> DataFrame:
    return C.audit_summary(audit_events(t.events))


@query(
    "run_status_report",
    f"""
WITH audit AS ({_AUDIT}), summary AS ({_SUMMARY}),
batches AS (SELECT 'b' || c_custkey AS batch_id, c_mktsegment || '-' || c_nationkey AS pipeline_name, 'RAW' AS source_name, 'DW' AS target_name,
    CASE WHEN c_acctbal < 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN c_acctbal < 9000 THEN TIMESTAMP '2024-01-01' + to_minutes(CAST(c_custkey AS INTEGER)) END AS started_at,
    TIMESTAMP '2024-01-02' + to_minutes(CAST(c_custkey AS INTEGER)) AS updated_at,
    CASE WHEN c_acctbal < 0 THEN 'balance ' || c_nationkey END AS error_message, c_custkey AS rows_loaded FROM customer),
latest AS (SELECT * FROM batches QUALIFY row_number() OVER (PARTITION BY pipeline_name ORDER BY coalesce(started_at, updated_at) DESC, batch_id DESC) = 1),
marks AS (SELECT CASE WHEN s_acctbal < 0 THEN 'SUPPLY-' ELSE 'BUILDING-' END || s_nationkey AS pipeline_name, max(s_name) AS last_error_message,
    TIMESTAMP '2024-01-01' + to_days(CAST(max(s_suppkey) AS INTEGER)) AS updated_at FROM supplier GROUP BY 1)
SELECT coalesce(w.pipeline_name, b.pipeline_name) AS pipeline_name, b.batch_id, b.status AS batch_status, b.started_at AS batch_started_at, b.rows_loaded,
  coalesce(b.error_message, w.last_error_message) AS last_error_message, audit_events, started_events, success_events, failed_events, failed_steps,
  first_step_started_at, last_step_ended_at,
  greatest(coalesce(b.updated_at, TIMESTAMP '1900-01-01'), coalesce(w.updated_at, TIMESTAMP '1900-01-01')) AS updated_at
FROM marks w FULL JOIN latest b ON w.pipeline_name = b.pipeline_name LEFT JOIN summary a ON b.batch_id = a.batch_id""",
)
def run_status_report(t: Tables) -> DataFrame:
    minutes = F.col("c_custkey").cast("int")
    in_debt = F.col("c_acctbal") < 0
    nothing = F.lit(None)
    batches = t.customer.select(
        F.concat(F.lit("b"), "c_custkey").alias("batch_id"),
        F.concat("c_mktsegment", F.lit("-"), "c_nationkey").alias("pipeline_name"),
        F.lit("RAW").alias("source_name"),
        F.lit("DW").alias("target_name"),
        F.when(in_debt, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(F.col("c_acctbal") < 9000, F.timestamp_add("MINUTE", minutes, _ntz("2024-01-01"))).alias("started_at"),
        nothing.cast("timestamp_ntz").alias("ended_at"),
        nothing.cast("bigint").alias("rows_extracted"),
        F.col("c_custkey").alias("rows_loaded"),
        nothing.cast("bigint").alias("rows_affected"),
        F.when(in_debt, F.concat(F.lit("balance "), "c_nationkey")).alias("error_message"),
        nothing.cast("bigint").alias("duration_seconds"),
        nothing.cast("string").alias("orchestration_type"),
        F.timestamp_add("MINUTE", minutes, _ntz("2024-01-02")).alias("updated_at"),
    )
    prefix = F.when(F.col("s_acctbal") < 0, "SUPPLY-").otherwise("BUILDING-")
    marks = (
        t.supplier.groupBy(F.concat(prefix, "s_nationkey").alias("pipeline_name"))
        .agg(
            F.max("s_name").alias("last_error_message"),
            F.timestamp_add("DAY", F.max("s_suppkey").cast("int"), _ntz("2024-01-01")).alias("updated_at"),
        )
        .withColumns(
            {
                "last_run_status": nothing.cast("string"),
                "last_bi_updated_at": nothing.cast("timestamp_ntz"),
                "last_success_batch_id": nothing.cast("string"),
                "last_run_batch_id": nothing.cast("string"),
                "last_run_started_at": nothing.cast("timestamp_ntz"),
                "last_run_committed_at": nothing.cast("timestamp_ntz"),
            }
        )
    )
    return C.run_status(batches, marks, audit_events(t.events)).select(
        "pipeline_name", "batch_id", "batch_status", "batch_started_at", "rows_loaded",
        "last_error_message", "audit_events", "started_events", "success_events", "failed_events",
        "failed_steps", "first_step_started_at", "last_step_ended_at", "updated_at",
    )


@query(
    "batch_row_totals",
    """
WITH audit AS (SELECT 'b' || user_id AS batch_id, CASE event_type WHEN 'purchase' THEN 'DBT_RUN' WHEN 'view' THEN 'AIRBYTE_SYNC' ELSE 'CLEANUP' END AS step_name,
    CASE WHEN value < 10 THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN value < 40 THEN event_id END AS rows_processed,
    CASE WHEN hour(ts) < 8 THEN 'rows_affected=' || event_id || ' rows_affected_final=' || user_id WHEN hour(ts) < 16 THEN 'done rows_affected=' || event_id WHEN hour(ts) < 20 THEN 'none' END AS details FROM events)
SELECT batch_id, count(*) AS audit_events,
  CAST(sum(CASE WHEN step_name = 'AIRBYTE_SYNC' AND status = 'SUCCESS' THEN coalesce(rows_processed, 0) ELSE 0 END) AS BIGINT) AS rows_extracted,
  CAST(sum(CASE WHEN step_name = 'DBT_RUN' AND status = 'SUCCESS' THEN coalesce(rows_processed, 0) ELSE 0 END) AS BIGINT) AS rows_loaded,
  CAST(sum(CASE WHEN step_name = 'DBT_RUN' AND status = 'SUCCESS' THEN coalesce(try_cast(nullif(regexp_extract(details, 'rows_affected_final=([0-9]+)', 1), '') AS BIGINT),
    try_cast(nullif(regexp_extract(details, 'rows_affected=([0-9]+)', 1), '') AS BIGINT), 0) ELSE 0 END) AS BIGINT) AS rows_affected
FROM audit GROUP BY batch_id""",
)
def batch_row_totals(t: Tables) -> DataFrame:
    kind, hour = F.col("event_type"), F.hour("ts")
    only = F.concat(F.lit("rows_affected="), "event_id")
    audit = t.events.select(
        F.concat(F.lit("b"), "user_id").alias("batch_id"),
        F.when(kind == "purchase", C.LOAD_STEP).when(kind == "view", C.EXTRACT_STEP).otherwise("CLEANUP").alias("step_name"),
        F.when(F.col("value") < 10, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(F.col("value") < 40, F.col("event_id")).alias("rows_processed"),
        F.when(hour < 8, F.concat(only, F.lit(" rows_affected_final="), "user_id"))
        .when(hour < 16, F.concat(F.lit("done "), only))
        .when(hour < 20, "none")
        .alias("details"),
    )
    return C.batch_row_totals(audit)


def _batch_events(events: DataFrame) -> DataFrame:
    """Events as start and end records of batches, with nulls that must overwrite."""
    kind = F.col("event_type")
    nothing = F.lit(None)
    return events.select(
        F.concat(F.lit("b"), "user_id").alias("batch_id"),
        F.when(kind.isin("signup", "view"), "START").otherwise("END").alias("kind"),
        "event_id",
        F.concat(F.lit("p-"), kind).alias("pipeline_name"),
        F.lit("RAW").alias("source_name"),
        F.lit("DW").alias("target_name"),
        F.upper(kind).alias("status"),
        F.when(kind.isin("signup", "view"), F.col("ts")).alias("started_at"),
        F.when(~kind.isin("signup", "view"), F.col("ts")).alias("ended_at"),
        F.when(F.col("value") > 20, F.col("event_id")).alias("rows_extracted"),
        nothing.cast("bigint").alias("rows_loaded"),
        nothing.cast("bigint").alias("rows_affected"),
        F.when(F.col("value") < 10, kind).alias("error_message"),
        nothing.cast("bigint").alias("duration_seconds"),
        F.when(F.col("value") < 30, "SCHEDULER").alias("orchestration_type"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )


@query(
    "batch_state_fold",
    """
WITH e AS (SELECT 'b' || user_id AS batch_id, CASE WHEN event_type IN ('signup', 'view') THEN 'START' ELSE 'END' END AS kind, event_id, event_type, value, ts,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
SELECT batch_id, min_by('p-' || event_type, rn) AS pipeline_name, max_by(upper(event_type), rn) AS status,
  coalesce(max(CASE WHEN kind = 'START' THEN ts END), NULL) AS started_at,
  max_by(struct_pack(v := CASE WHEN kind = 'END' THEN ts END), rn) FILTER (WHERE kind = 'END' OR rn = 1).v AS ended_at,
  max_by(struct_pack(v := CASE WHEN value > 20 THEN event_id END), rn) FILTER (WHERE kind = 'END' OR rn = 1).v AS rows_extracted,
  max_by(struct_pack(v := CASE WHEN value < 10 THEN event_type END), rn).v AS error_message,
  max_by(struct_pack(v := CASE WHEN value < 30 THEN 'SCHEDULER' END), rn) FILTER (WHERE kind = 'START' OR rn = 1).v AS orchestration_type,
  min(ts) AS created_at, max(ts) AS updated_at
FROM e GROUP BY batch_id""",
)
def batch_state_fold(t: Tables) -> DataFrame:
    """Batch table after all start and end events, in two folds: first half, then the rest."""
    events = _batch_events(t.events)
    cut = _ntz("2024-01-12")
    first = C.fold_events(
        events.filter(F.col("updated_at") < cut), "batch_id", ["event_id"], C.BATCH_UPDATES, C.BATCH_SCHEMA
    )
    return C.fold_events(
        events.filter(F.col("updated_at") >= cut), "batch_id", ["event_id"], C.BATCH_UPDATES, C.BATCH_SCHEMA, first
    ).select(
        "batch_id", "pipeline_name", "status", "started_at", "ended_at", "rows_extracted",
        "error_message", "orchestration_type", "created_at", "updated_at",
    )


@query(
    "watermark_state_fold",
    """
WITH e AS (SELECT 'dim_' || user_id AS pipeline_name, CASE WHEN event_type = 'purchase' THEN 'SUCCESS' WHEN event_type = 'error' THEN 'FAILED' ELSE 'RUNNING' END AS kind,
  'r' || event_id AS run, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
SELECT pipeline_name, max(CASE WHEN kind = 'SUCCESS' THEN ts END) AS last_bi_updated_at,
  max_by(run, rn) FILTER (WHERE kind = 'SUCCESS') AS last_success_batch_id, max_by(run, rn) AS last_run_batch_id, max_by(kind, rn) AS last_run_status,
  max_by(struct_pack(v := CASE WHEN kind = 'FAILED' THEN event_type END), rn).v AS last_error_message,
  max(CASE WHEN kind <> 'FAILED' THEN ts END) AS last_run_started_at, max(CASE WHEN kind = 'SUCCESS' THEN ts END) AS last_run_committed_at, max(ts) AS updated_at
FROM e GROUP BY pipeline_name""",
)
def watermark_state_fold(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    state = F.when(kind == "purchase", "SUCCESS").when(kind == "error", "FAILED").otherwise("RUNNING")
    done, failed = kind == "purchase", kind == "error"
    run = F.concat(F.lit("r"), "event_id")
    events = t.events.select(
        F.concat(F.lit("dim_"), "user_id").alias("pipeline_name"),
        state.alias("kind"),
        "event_id",
        F.when(done, F.col("ts")).alias("last_bi_updated_at"),
        F.when(done, run).alias("last_success_batch_id"),
        F.when(done, C.LOAD_MODE).alias("last_load_mode"),
        run.alias("last_run_batch_id"),
        state.alias("last_run_status"),
        F.when(failed, kind).alias("last_error_message"),
        F.when(~failed, F.col("ts")).alias("last_run_started_at"),
        F.when(done, F.col("ts")).alias("last_run_committed_at"),
        F.col("ts").alias("updated_at"),
    )
    folded = C.fold_events(events, "pipeline_name", ["event_id"], C.WATERMARK_UPDATES, C.WATERMARK_SCHEMA)
    return folded.drop("last_load_mode")


@query(
    "missing_success",
    """
WITH last AS (SELECT CAST(user_id AS VARCHAR) AS pipeline_name, max(ts) AS last_success_at FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS pipeline_name, CAST((c_nationkey + 1) * 720 AS INTEGER) AS expected_success_within_minutes,
  CASE WHEN last_success_at >= TIMESTAMP '2024-02-01' - to_minutes(CAST((c_nationkey + 1) * 720 AS INTEGER)) THEN NULL ELSE last_success_at END AS last_success_at
FROM customer LEFT JOIN last ON CAST(c_custkey AS VARCHAR) = pipeline_name
WHERE last_success_at IS NULL OR last_success_at < TIMESTAMP '2024-02-01' - to_minutes(CAST((c_nationkey + 1) * 720 AS INTEGER))""",
)
def missing_success(t: Tables) -> DataFrame:
    expected = t.customer.select(
        F.col("c_custkey").cast("string").alias("pipeline_name"),
        ((F.col("c_nationkey") + 1) * 720).alias("expected_success_within_minutes"),
    )
    batches = t.events.select(
        F.col("user_id").cast("string").alias("pipeline_name"),
        F.when(F.col("event_type") == "purchase", "SUCCESS").otherwise("FAILED").alias("status"),
        F.col("ts").alias("ended_at"),
    )
    return M.missing_success(expected, batches, RUN_2)


@query(
    "stalled",
    """
WITH w AS (SELECT CAST(user_id AS VARCHAR) AS pipeline_name, max(ts) AS last_run_started_at, max_by(event_type, ts) AS k FROM events GROUP BY 1)
SELECT pipeline_name, last_run_started_at, CAST((c_nationkey + 1) * 60 AS INTEGER) AS stall_threshold_minutes,
  date_diff('minute', last_run_started_at, TIMESTAMP '2024-02-02 12:30:00') AS minutes_running
FROM w JOIN customer ON CAST(c_custkey AS VARCHAR) = pipeline_name
WHERE k IN ('click', 'view') AND last_run_started_at < TIMESTAMP '2024-02-02 12:30:00' - to_minutes(CAST((c_nationkey + 1) * 60 AS INTEGER))""",
)
def stalled(t: Tables) -> DataFrame:
    marks = t.events.groupBy(F.col("user_id").cast("string").alias("pipeline_name")).agg(
        F.max("ts").alias("last_run_started_at"), F.max_by("event_type", "ts").alias("k")
    )
    running = F.when(F.col("k").isin("click", "view"), "RUNNING").otherwise("SUCCESS")
    thresholds = t.customer.select(
        F.col("c_custkey").cast("string").alias("pipeline_name"),
        ((F.col("c_nationkey") + 1) * 60).alias("stall_threshold_minutes"),
    )
    found = M.stalled(thresholds, marks.withColumn("last_run_status", running), RUN_3)
    return found.select(
        "pipeline_name", "last_run_started_at", "stall_threshold_minutes", "minutes_running"
    )


def run_documents(lines: DataFrame) -> DataFrame:
    """One run-result document per line item: a model and a test result each."""
    model = F.when(F.col("l_linestatus") == "F", "model.shop.dim_part").otherwise("model.shop.ds_line")
    state = F.when(F.col("l_returnflag") == "R", "error").otherwise("success")
    check_state = F.when(F.col("l_quantity") > 45, "fail").otherwise("pass")
    key = F.col("l_partkey")
    results = F.array(
        F.struct(
            model.alias("unique_id"),
            state.alias("status"),
            F.struct(
                key.alias("rows_affected"), F.col("l_linenumber").alias("rows_inserted")
            ).alias("adapter_response"),
        ),
        F.struct(
            F.concat(F.lit("test.shop.unique_stg_ds__"), F.lower("l_returnflag")).alias("unique_id"),
            check_state.alias("status"),
            F.struct(
                F.lit(1).cast("bigint").alias("rows_affected"), F.lit(1).alias("rows_inserted")
            ).alias("adapter_response"),
        ),
    )
    return lines.select(
        F.col("l_orderkey").alias("run"), F.to_json(F.struct(results.alias("results"))).alias("payload")
    )


@query(
    "run_result_totals",
    """
SELECT l_orderkey AS run, count(*) AS model_count, count(*) AS test_count,
  CAST(sum(l_linenumber) AS BIGINT) AS rows_inserted_total, CAST(0 AS BIGINT) AS rows_updated_total, CAST(0 AS BIGINT) AS rows_deleted_total, CAST(sum(l_partkey) AS BIGINT) AS rows_affected_total,
  CAST(coalesce(sum(l_linenumber) FILTER (WHERE l_linestatus = 'F'), 0) AS BIGINT) AS rows_inserted_final_total, CAST(0 AS BIGINT) AS rows_updated_final_total, CAST(0 AS BIGINT) AS rows_deleted_final_total,
  CAST(coalesce(sum(l_partkey) FILTER (WHERE l_linestatus = 'F'), 0) AS BIGINT) AS rows_affected_final_total
FROM lineitem GROUP BY 1""",
)
def run_result_totals(t: Tables) -> DataFrame:
    results = L.run_results(run_documents(t.lineitem), "run", "payload")
    return L.run_totals(results, "run")


@query(
    "failed_attribution",
    """
WITH failed AS (
  SELECT l_orderkey AS run, CASE WHEN l_linestatus = 'F' THEN 'dim_part' ELSE 'dim_line' END AS p FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'DIM_A' WHEN 'N' THEN NULL ELSE 'dim_r' END FROM lineitem WHERE l_quantity > 45),
named AS (SELECT DISTINCT run, p FROM failed WHERE p IS NOT NULL),
none AS (SELECT run FROM failed GROUP BY run HAVING count(p) = 0)
SELECT run, p AS pipeline_name FROM named
UNION ALL SELECT run, unnest(['dim_part', 'dim_line', 'DIM_A', 'dim_r']) FROM none""",
)
def failed_attribution(t: Tables) -> DataFrame:
    results = L.run_results(run_documents(t.lineitem), "run", "payload", counters=())
    return L.failed_pipelines(results, "run", ["dim_part", "dim_line", "DIM_A", "dim_r"])


@query(
    "models_to_dimensions",
    """
SELECT p_partkey, CASE WHEN p_size < 15 THEN 'dim_' || p_brand WHEN p_size < 30 THEN 'dim_' || p_type WHEN p_size < 40 THEN 'dim_' || p_brand END AS pipeline_name FROM part""",
)
def models_to_dimensions(t: Tables) -> DataFrame:
    size = F.col("p_size")
    model = (
        F.when(size < 15, F.concat(F.lit(" dim_"), "p_brand"))
        .when(size < 30, F.concat(F.lit("stg_ds__"), "p_type"))
        .when(size < 40, F.concat(F.lit("ds_"), "p_brand", F.lit(" ")))
        .otherwise(F.col("p_name"))
    )
    return t.part.select("p_partkey", L.pipeline_of_model(model).alias("pipeline_name"))


def _sync_texts(events: DataFrame) -> DataFrame:
    n = F.floor("value").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "purchase", F.concat(F.lit("Finished insert of "), n, F.lit(" row(s)\nnext")))
        .when(kind == "view", F.concat(F.lit("Read "), n, F.lit(" records from s-"), F.day("ts"), F.lit(" stream")))
        .when(kind == "click", F.concat(F.lit("sum recordsEmitted="), n, F.lit(" recordsEmitted: "), F.day("ts")))
        .otherwise("idle")
    )
    return events.select(F.col("user_id").alias("batch"), text.alias("text"))


_SYNC_LOGS = """
  SELECT user_id AS batch, event_type AS k, CAST(floor(value) AS BIGINT) AS n, CAST(day(ts) AS BIGINT) AS d FROM events"""


@query(
    "sync_stream_counts",
    f"WITH x AS ({_SYNC_LOGS}) SELECT batch, 's-' || d AS stream_name, max(n) AS row_count FROM x WHERE k = 'view' GROUP BY 1, 2",
)
def sync_stream_counts(t: Tables) -> DataFrame:
    return L.stream_counts(_sync_texts(t.events), "batch", "text")


@query(
    "sync_log_stats",
    f"""
WITH x AS ({_SYNC_LOGS}),
texts AS (SELECT batch, max(n) FILTER (WHERE k = 'purchase') AS ins, max(greatest(n, d)) FILTER (WHERE k = 'click') AS em FROM x GROUP BY 1),
streams AS (SELECT batch, CAST(sum(m) AS BIGINT) AS total FROM (SELECT batch, d, max(n) AS m FROM x WHERE k = 'view' GROUP BY 1, 2) GROUP BY 1),
pay AS (SELECT c_custkey AS batch, CAST(floor(c_acctbal) AS BIGINT) AS b, c_nationkey AS k FROM customer),
j AS (SELECT coalesce(pay.batch, texts.batch) AS batch, b, k, total, ins, em,
    CASE WHEN b >= 0 AND b < 3000 THEN b END AS rows_emitted, CASE WHEN b >= 3000 AND b < 6000 THEN 0 END AS rows_synced,
    CASE WHEN b >= 6000 THEN b + k ELSE total END AS stream_total,
    CASE WHEN ins > 0 THEN 'rows_inserted' WHEN em > 0 THEN 'records_emitted' WHEN ins IS NOT NULL THEN 'rows_inserted' WHEN em IS NOT NULL THEN 'records_emitted' END AS tm
  FROM pay FULL JOIN texts ON pay.batch = texts.batch LEFT JOIN streams ON streams.batch = coalesce(pay.batch, texts.batch)),
c AS (SELECT *, CASE tm WHEN 'rows_inserted' THEN ins WHEN 'records_emitted' THEN em END AS tv,
  coalesce(b >= 0 AND b < 6000, false) AS has_totals FROM j),
f AS (SELECT *, CASE WHEN stream_total IS NOT NULL AND NOT has_totals THEN stream_total WHEN rows_synced IS NOT NULL THEN rows_synced WHEN rows_emitted IS NOT NULL THEN rows_emitted
    WHEN stream_total IS NOT NULL THEN stream_total ELSE tv END AS v,
  CASE WHEN stream_total IS NOT NULL AND NOT has_totals THEN 'stream_stats_total' WHEN rows_synced IS NOT NULL THEN 'records_synced' WHEN rows_emitted IS NOT NULL THEN 'records_emitted'
    WHEN stream_total IS NOT NULL THEN 'stream_stats_total' ELSE tm END AS s FROM c)
SELECT batch, CAST(CASE WHEN v = 0 AND tv > 0 THEN tv ELSE v END AS BIGINT) AS rows_processed, CASE WHEN v = 0 AND tv > 0 THEN tm ELSE s END AS rows_metric_source FROM f""",
)
def sync_log_stats(t: Tables) -> DataFrame:
    """Payloads without totals, with totals, with zero totals, and with stream stats only."""
    b, k = F.floor("c_acctbal").cast("string"), F.col("c_nationkey").cast("string")

    def attempt(body) -> F.Column:
        running = F.lit(', {"status": "running", "totalStats": {"recordsSynced": 99}}')
        return F.concat(F.lit('{"attempts": [{"status": "Succeeded", '), body, F.lit("}"), running, F.lit("]}"))

    emitted = F.concat(F.lit('"totalStats": {"recordsEmitted": '), b, F.lit("}"))
    zero = F.lit('"totalStats": {"recordsSynced": 0}')
    streams = F.concat(
        F.lit('"streamStats": [{"streamName": "a", "stats": {"recordsCommitted": '), b,
        F.lit('}}, {"streamName": "b", "stats": {"recordsSynced": 77, "records_emitted": '), k, F.lit("}}]"),
    )
    balance = F.floor("c_acctbal")
    payload = (
        F.when(balance < 0, '{"attempts": []}')
        .when(balance < 3000, attempt(emitted))
        .when(balance < 6000, attempt(zero))
        .otherwise(attempt(streams))
    )
    payloads = t.customer.select(F.col("c_custkey").alias("batch"), payload.alias("payload"))
    found = L.sync_log_stats(payloads, _sync_texts(t.events), "batch", "payload", "text")
    return found.select("batch", "rows_processed", "rows_metric_source")


_SHAPES = [
    # payload around the number, metric that counts, what it adds to the number
    ('{"job":{"attempts":[{"status":"succeeded","recordsSynced":#}]}}', "records_synced", 0),
    ('{"job":{"attempts":{"status":"failed","totalStats":{"recordsEmitted":#}}}}', "records_emitted", 0),
    ('{"attempt":{"status":"running","total_stats":{"records_committed":#}}}', "records_committed", 0),
    ('{"totalStats":{"recordsExtracted":#}}', "records_extracted", 0),
    ('{"attempts":[{"streamStatuses":[{"streamName":"a","recordsLoaded":#},{"name":"b","stats":{"recordsSynced":1}}]}]}', "stream_stats_total", 1),
    ('{"attempts":[{"stream_stats":{"a":{"recordsCommitted":#},"b":{"records_emitted":2}}}]}', "stream_stats_total", 2),
    ('{"job":{"recordsCommitted":#}}', "records_committed", 0),
    ('{"attempts":[{"attempt":{"status":"completed","recordsEmitted":#}},{"status":"running","recordsEmitted":1}]}', "records_emitted", 0),
    ('{"streamStatus":{"stream_descriptor":{"name":"x"},"stats":{"recordsSynced":#}}}', "stream_stats_total", 0),
]


@query(
    "sync_payload_shapes",
    "WITH c AS (SELECT c_custkey AS batch, CAST(floor(abs(c_acctbal)) AS BIGINT) + 1 AS n, c_custkey % 9 AS k FROM customer)"
    + "\nSELECT batch, n + CASE k "
    + " ".join(f"WHEN {i} THEN {more}" for i, (_, _, more) in enumerate(_SHAPES))
    + " END AS rows_processed, CASE k "
    + " ".join(f"WHEN {i} THEN '{metric}'" for i, (_, metric, _) in enumerate(_SHAPES))
    + " END AS rows_metric_source FROM c",
)
def sync_payload_shapes(t: Tables) -> DataFrame:
    """The shapes in which sync payloads come, each with its own place for the metrics."""
    number = (F.floor(F.abs("c_acctbal")) + 1).cast("string")
    payload = F.lit(None).cast("string")
    for i, (shape, _, _) in enumerate(_SHAPES):
        before, after = shape.split("#")
        made = F.concat(F.lit(before), number, F.lit(after))
        payload = F.when(F.col("c_custkey") % 9 == i, made).otherwise(payload)
    payloads = t.customer.select(F.col("c_custkey").alias("batch"), payload.alias("payload"))
    stats = L.payload_stats(payloads, "batch", "payload")
    texts = {"text_metric": F.lit(None).cast("string"), "rows_from_text": F.lit(None).cast("bigint")}
    return L.chosen_metric(stats.withColumns(texts)).select("batch", "rows_processed", "rows_metric_source")


@query(
    "sync_text_objects",
    """
WITH x AS (SELECT user_id AS batch, event_id, event_type AS k, CAST(floor(value) AS BIGINT) AS n, CAST(day(ts) AS BIGINT) AS d FROM events),
objects AS (SELECT batch, k, n, d FROM x WHERE k IN ('purchase', 'view') QUALIFY row_number() OVER (PARTITION BY batch ORDER BY event_id) = 1),
words AS (SELECT batch, CAST(sum(m) AS BIGINT) AS total FROM (SELECT batch, d, max(n) AS m FROM x WHERE k = 'click' GROUP BY 1, 2) GROUP BY 1)
SELECT b.batch, CASE WHEN o.k = 'purchase' THEN o.n + o.d WHEN o.k = 'view' THEN o.n ELSE w.total END AS rows_text_streams,
  CASE WHEN o.k = 'purchase' THEN 'a=' || o.n || ', b=' || o.d WHEN o.k = 'view' THEN 'x=' || o.n END AS text_stream_summary
FROM (SELECT DISTINCT batch FROM x) b LEFT JOIN objects o USING (batch) LEFT JOIN words w USING (batch)""",
)
def sync_text_objects(t: Tables) -> DataFrame:
    """Statistics in JSON objects within log texts, whatever stands around them, before reports in words."""
    n, day = F.floor("value").cast("string"), F.day("ts").cast("string")
    purchase = F.concat(
        F.lit('10:02 "state {"ok": true, "s": "}{"} then {"job": {"stream_stats": [{"stream_name": "a", "records_emitted": '),
        n, F.lit('}, {"name": "b", "stats": {"recordsSynced": "'), day, F.lit('"}}]}} and {open'),
    )
    view = F.concat(F.lit('it"s {broken {"streamStats": {}, "y": [{"streamStatus": {"x": {"recordsCommitted": '), n, F.lit("}}}]}"))
    click = F.concat(F.lit("Read "), n, F.lit(" records from s-"), day, F.lit(' stream {"streamStats": []}'))
    kind = F.col("event_type")
    text = F.when(kind == "purchase", purchase).when(kind == "view", view).when(kind == "click", click).otherwise("{}")
    logs = t.events.select(F.col("user_id").alias("batch"), "event_id", text.alias("text"))
    return L.log_facts(logs, "batch", "text", ["event_id"]).select("batch", "rows_text_streams", "text_stream_summary")
