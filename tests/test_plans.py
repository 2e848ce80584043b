"""Properties of the physical plans that matter when the tables are large."""

import pytest

from pyspark.sql import functions as F

from tidemark import entities as E
from tidemark.operators.keys import allocate_missing_keys
from tidemark.plans.current_state import landing_changes
from tidemark.queries import REGISTRY
from tidemark.queries.registry import RUN_1
from tidemark.session import tune, work_folder
from tidemark.sources import tables

STORED = {
    # These write tables while they are built; their plan is only the final read.
    "current_state_two_batches", "dimension_two_runs", "domain_two_runs", "stream_upsert",
    "retention_delete_current_state", "retention_drop_audit_days", "purge_landing_after_load",
    "retention_many_tables", "domain_control_state", "extract_after_merge", "entity_check_matrix", "fact_star_keys", "dimension_state",
    "dimension_equipment", "dimension_operation", "dimension_farm", "dimension_front",
    "two_streams_one_table", "surrogate_key_upper_key", "dropped_client_key", "quarantine_front",
    "domain_rejects_audited", "views_for_sql", "quarantine_repeated_run", "stream_late_rows",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - STORED))
def test_no_python_and_no_cross_join(spark, folder, name):
    text = plan(REGISTRY[name].run(spark, folder))
    for operator in ("EvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text, f"{operator} in {name}"


@pytest.mark.parametrize("name, column", [
    ("watermark_slice", "IsNotNull(ts), GreaterThan(ts,"), ("extract_by_cursor", "IsNotNull(ts), GreaterThan(ts,"),
    ("retained_rows", "Or(IsNull(o_orderdate),GreaterThanOrEqual(o_orderdate,"),
])
def test_bounds_reach_the_scan(spark, folder, name, column):
    text = plan(REGISTRY[name].run(spark, folder))
    assert f"PushedFilters: [{column}" in text


def test_latest_row_is_ranked_before_the_shuffle(spark, folder):
    text = plan(REGISTRY["latest_per_key_by_rank"].run(spark, folder))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1
    text = plan(REGISTRY["latest_per_key"].run(spark, folder))
    assert "Window" not in text and text.count("Exchange hashpartitioning") == 1
    assert "partial_max" in text


@pytest.mark.parametrize("name", ["q_equality", "q_cardinality_equality", "q_equal_rowcount", "q_fewer_rows_than"])
def test_two_relations_are_compared_in_one_shuffle(spark, folder, name):
    text = plan(REGISTRY[name].run(spark, folder))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_scan_reads_only_what_is_used(spark, folder):
    text = REGISTRY["q_relationships_where"].run(spark, folder)._jdf.queryExecution().toString()
    assert "o_totalprice" not in text.split("== Optimized Logical Plan ==")[1].split("ReadSchema")[-1]


def test_check_matrix_scans_once_for_nulls_and_once_for_each_key(spark, folder):
    text = plan(REGISTRY["entity_check_matrix"].run(spark, folder))
    assert text.count("FileScan parquet") <= 3


def test_row_checks_share_one_scan(spark, folder):
    text = plan(REGISTRY["row_checks_one_scan"].run(spark, folder))
    assert text.count("FileScan parquet") == 1


def test_known_rows_stay_out_of_the_window_for_new_keys(spark):
    root = work_folder(spark, "keys")
    rows = spark.range(100).selectExpr("id AS k", "if(id < 90, id, null) AS sk")
    rows.write.parquet(root)
    keyed = allocate_missing_keys(spark.read.parquet(root), "sk", ["k"], 1000)
    text = plan(keyed)
    scans = [x for x in text.split("\n") if "FileScan parquet" in x]
    assert len(scans) == 3 and sum("PushedFilters: [IsNull(sk)]" in x for x in scans) == 2
    # The branch of the known rows has no exchange: it stands first in the union.
    known = text.split("Union")[1].split("Window")[0].split("Exchange")[0]
    assert "IsNotNull(sk)" in known
    assert {r["sk"] for r in keyed.collect()} == {*range(90), *range(1001, 1011)}


def test_a_scan_is_cut_unless_the_cluster_cuts_it_finer(spark):
    name = "spark.sql.files.maxPartitionBytes"
    kept = spark.conf.get(name)
    try:
        for given, wanted in (("128m", str(32 << 20)), ("16m", "16m")):
            spark.conf.set(name, given)
            assert tune(spark).conf.get(name) == wanted
    finally:
        spark.conf.set(name, kept)


def test_a_slice_of_farms_is_cut_before_it_is_shuffled(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "SLICE_BYTES", 50_000)
    monkeypatch.setattr(tables, "SAMPLED_OF", 4)
    landing = REGISTRY["source_farm_view"].run(spark, folder).withColumn("_airbyte_extracted_at", F.lit(RUN_1))
    changes = landing_changes(E.FARM, landing, None, RUN_1, "run-1")
    cuts = tables.KeyedTable(spark, work_folder(spark, "farms"), E.FARM.key)._cuts(changes)
    parts = [changes.filter(c) for c in cuts]
    assert len(cuts) > 2 and sum(p.count() for p in parts) == changes.count()
    above = plan(parts[1]).split("FileScan parquet [l_")[0].split("Exchange")[-1]
    assert "Filter" in above and "struct(" in above
