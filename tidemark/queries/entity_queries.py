"""Every entity from its source view through the current state to its dimension.

Business columns are compared with SQL; surrogate keys are compared as properties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import entities as E
from tidemark.operators.checks import entity_checks
from tidemark.plans.current_state import merge_current_state
from tidemark.plans.dimension import load_dimension
from tidemark.plans.facts import resolve_star
from tidemark.plans.retention import purge_current_state
from tidemark.plans.domain import Warehouse, run_domain
from tidemark.queries import source_queries as Q
from tidemark.queries.registry import REGISTRY, RUN_1, RUN_2, Tables, query
from tidemark.session import work_folder
from tidemark.sources.quarantine import with_delivery
from tidemark.spec import LANDING_EXTRACTED_AT, EntitySpec


def load_entity_once(t: Tables, spec: EntitySpec, view: str) -> Warehouse:
    wh = Warehouse(t.spark, work_folder(t.spark, spec.name))
    at = F.lit(RUN_1).cast("timestamp_ntz").alias(LANDING_EXTRACTED_AT)
    landing = REGISTRY[view].run(t.spark, t.folder).select("*", at)
    state = wh.current_state(spec)
    merge_current_state(spec, landing, state, RUN_1, "run-1", quarantine=wh.quarantine(spec))
    load_dimension(spec, state.read(), wh.dimension(spec), None, RUN_1, "run-1")
    return wh


def business_columns(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Dimension rows without the key values, which no SQL can predict."""
    columns = []
    for c in spec.columns:
        value = F.col(c.name)
        if c.type.startswith("decimal"):
            value = value.cast("double" if c.type == E.AREA else "bigint").alias(c.name)
        columns.append(value)
    return df.select(*columns, "etl_batch_id", "bi_created_at", "bi_updated_at")


_STAMPS = "'run-1' AS etl_batch_id, TIMESTAMP '2024-01-15' AS bi_created_at, TIMESTAMP '2024-01-15' AS bi_updated_at"


def dimension_sql(spec: EntitySpec, view_sql: str) -> str:
    """Upper-cased business rows with a complete key, and the unknown member."""

    def shown(c) -> str:
        source = c.source or c.name
        return f"upper({source}) AS {c.name}" if c.upper else f"{source} AS {c.name}"

    def unknown(c) -> str:
        if isinstance(c.unknown, bool):
            return "false"
        return f"'{c.unknown}'" if isinstance(c.unknown, str) else str(c.unknown)

    complete = " AND ".join(f"{k} IS NOT NULL" for k in spec.key)
    return (
        f"SELECT {', '.join(shown(c) for c in spec.columns)}, {_STAMPS} FROM ({view_sql}) WHERE {complete}"
        f" UNION ALL SELECT {', '.join(unknown(c) for c in spec.columns)}, {_STAMPS}"
    )


def _register(name: str, spec: EntitySpec, view: str, view_sql: str) -> None:
    @query(name, dimension_sql(spec, view_sql))
    def run(t: Tables) -> DataFrame:
        return business_columns(load_entity_once(t, spec, view).dimension(spec).read(), spec)


_register("dimension_state", E.STATE, "source_state_view", Q.STATE_VIEW_SQL)
_register("dimension_equipment", E.EQUIPMENT, "source_equipment_view", Q.EQUIPMENT_VIEW_SQL)
_register("dimension_operation", E.OPERATION, "source_operation_view", Q.OPERATION_VIEW_SQL)
_register("dimension_farm", E.FARM, "source_farm_view", Q.FARM_VIEW_SQL)
_register("dimension_front", E.FRONT, "source_front_view", Q.FRONT_VIEW_SQL)


def _front_sql() -> str:
    keys = " AND ".join(f"{k} IS NOT NULL" for k in E.FRONT.key)
    shown = ", ".join(f"upper({c.name}) AS {c.name}" if c.upper else c.name for c in E.FRONT.columns)
    return f"SELECT {shown}, NOT ({keys}) AS quarantined FROM ({Q.FRONT_VIEW_SQL})"


def _front_columns() -> list[Column]:
    columns = []
    for c in E.FRONT.columns:
        value = F.upper(c.name) if c.upper else F.col(c.name)
        columns.append((value.cast("bigint") if c.type.startswith("decimal") else value).alias(c.name))
    return columns


@query("quarantine_front", _front_sql())
def quarantine_front(t: Tables) -> DataFrame:
    """Every row of the view is in the dimension or, for want of a key part, in quarantine."""
    wh = load_entity_once(t, E.FRONT, "source_front_view")
    stored = wh.dimension(E.FRONT).read().filter(F.col(E.FRONT.surrogate_key) != -1)

    def shown(df: DataFrame, quarantined: bool) -> DataFrame:
        return df.select(*_front_columns(), F.lit(quarantined).alias("quarantined"))

    return shown(stored, False).unionByName(shown(wh.quarantine(E.FRONT).read(), True))


@query(
    "domain_rejects_audited",
    f"""
SELECT 'QUARANTINE_SX_FRENTE_D' AS step_name, 'SUCCESS' AS status, count(*) FILTER (WHERE quarantined) AS rows_processed
FROM ({_front_sql()})""",
)
def domain_rejects_audited(t: Tables) -> DataFrame:
    """The audit log counts what a domain run has set aside."""
    wh = Warehouse(t.spark, work_folder(t.spark, "rejects"))
    at = F.lit(RUN_1).cast("timestamp_ntz").alias(LANDING_EXTRACTED_AT)
    landing = REGISTRY["source_front_view"].run(t.spark, t.folder).select("*", at)
    run_domain(wh, [E.FRONT], {E.FRONT.name: landing}, RUN_1, "run-1")
    events = wh.control.audit().filter(F.col("step_name").startswith("QUARANTINE"))
    return events.select("step_name", "status", "rows_processed")


@query(
    "quarantine_repeated_run",
    f"""
SELECT {", ".join(c.name for c in E.FRONT.columns)}, 'run-2' AS etl_batch_id, count(*) OVER () AS audited
FROM ({_front_sql()}) WHERE quarantined""",
)
def quarantine_repeated_run(t: Tables) -> DataFrame:
    """A run that ended behind the quarantine, then one that meets the same landing: each rejected row once."""
    spec = E.FRONT
    wh = Warehouse(t.spark, work_folder(t.spark, "repeated"))
    at = F.lit(RUN_1).cast("timestamp_ntz").alias(LANDING_EXTRACTED_AT)
    wh.landing(spec).append(REGISTRY["source_front_view"].run(t.spark, t.folder).select("*", at))
    waiting, quarantine = with_delivery(wh.landing(spec)), wh.quarantine(spec)
    merge_current_state(spec, waiting, wh.current_state(spec), RUN_1, "run-1", quarantine=quarantine)
    run_domain(wh, [spec], {}, RUN_2, "run-2")
    audit = wh.control.audit().filter(F.col("step_name").startswith("QUARANTINE"))
    audited = audit.agg(F.sum("rows_processed")).first()[0]
    rows = quarantine.read().select(*_front_columns(), "etl_batch_id")
    return rows.withColumn("audited", F.lit(audited).cast("bigint"))


@query(
    "views_for_sql",
    """
SELECT o_custkey AS id_cliente, count(*) AS n_operations, count(*) AS n_staged FROM orders GROUP BY 1""",
)
def views_for_sql(t: Tables) -> DataFrame:
    """SQL over the views of a loaded entity: dimension joined with its staging view."""
    wh = load_entity_once(t, E.OPERATION, "source_operation_view")
    wh.create_views([E.OPERATION])
    return t.spark.sql(
        """
SELECT CAST(d.id_cliente AS bigint) AS id_cliente, count(*) AS n_operations, count(s.cd_operacao) AS n_staged
FROM dim_sx_operacao_d d LEFT JOIN stg_ds__sx_operacao_d s ON d.id_cliente = s.id_cliente AND d.cd_operacao = s.cd_operacao
WHERE d.sk_operacao <> -1 GROUP BY d.id_cliente"""
    )


@query(
    "entity_check_matrix",
    """
SELECT 'sx_operacao_d' AS "table", unnest(['unique_key', 'unique_surrogate_key', 'not_null_sk_operacao', 'not_null_id_cliente',
  'not_null_cd_operacao', 'not_null_etl_batch_id', 'not_null_bi_created_at', 'not_null_bi_updated_at']) AS "check",
  (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) AS failures, 'pass' AS status""",
)
def entity_check_matrix(t: Tables) -> DataFrame:
    """Unique and complete keys of a loaded dimension."""
    wh = load_entity_once(t, E.OPERATION, "source_operation_view")
    dimension = wh.dimension(E.OPERATION).read()
    return entity_checks(dimension, E.OPERATION, True, E.OPERATION.name)


@query(
    "fact_star_keys",
    """
WITH facts AS (SELECT o_custkey AS id_cliente, CASE WHEN o_orderstatus = 'P' THEN -5 ELSE o_orderkey END AS cd_operacao,
    CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_custkey END AS client FROM orders)
SELECT id_cliente, count(*) AS n_facts, count(*) FILTER (WHERE cd_operacao = -5) AS unknown_operations,
  count(*) FILTER (WHERE client IS NULL OR client NOT IN (SELECT c_custkey FROM customer)) AS unknown_clients
FROM facts GROUP BY 1""",
)
def fact_star_keys(t: Tables) -> DataFrame:
    """Facts get the keys of two dimensions; missing members and null keys become -1."""
    operations = load_entity_once(t, E.OPERATION, "source_operation_view").dimension(E.OPERATION)
    clients = t.customer.select(F.col("c_custkey").cast(E.NUMBER).alias("id"))
    clients = clients.withColumn("sk_client", F.col("id").cast("bigint"))
    pending = F.col("o_orderstatus") == "P"
    facts = t.orders.select(
        F.col("o_custkey").cast(E.NUMBER).alias("id_cliente"),
        F.when(pending, -5).otherwise(F.col("o_orderkey")).cast(E.NUMBER).alias("cd_operacao"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_custkey")).cast(E.NUMBER).alias("client"),
    )
    resolved = resolve_star(
        facts,
        {
            "sk_operacao": (
                operations.read(), {"id_cliente": "id_cliente", "cd_operacao": "cd_operacao"}
            ),
            "sk_client": (clients, {"client": "id"}),
        },
    )
    return resolved.groupBy(F.col("id_cliente").cast("bigint").alias("id_cliente")).agg(
        F.count("*").alias("n_facts"),
        F.count_if(F.col("sk_operacao") == -1).alias("unknown_operations"),
        F.count_if(F.col("sk_client") == -1).alias("unknown_clients"),
    )


@query(
    "retention_many_tables",
    """
SELECT 'CLEANUP_DS_' || upper(event_type) AS step_name, 'SUCCESS' AS status,
  count(*) FILTER (WHERE CAST(ts AS DATE) < DATE '2024-01-15') AS rows_processed FROM events GROUP BY event_type""",
)
def retention_many_tables(t: Tables) -> DataFrame:
    """A table for each event type cut at the run's day; the audit log tells what each lost."""
    wh = Warehouse(t.spark, work_folder(t.spark, "retention"))
    tables = {}
    kinds = [r[0] for r in t.events.select("event_type").distinct().sort("event_type").collect()]
    for kind in kinds:
        spec = EntitySpec(kind, ("event_id",), (E.Column("event_id", "bigint"),))
        rows = t.events.filter(F.col("event_type") == kind)
        tables[kind] = wh.current_state(spec)
        tables[kind].merge(rows.select("event_id", F.col("ts").alias("bi_updated_at")))
    purge_current_state(tables, RUN_1, "cleanup-1", wh.control)
    audit = wh.control.audit().filter("status <> 'STARTED'")
    return audit.select("step_name", "status", "rows_processed")
