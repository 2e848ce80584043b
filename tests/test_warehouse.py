from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import entities as E
from tidemark.operators.checks import entity_checks
from tidemark.operators.keys import allocate_in_slices, allocate_missing_keys, highest_key
from tidemark.plans.control import Control
from tidemark.plans.current_state import extract, merge_current_state
from tidemark.plans.dimension import dimension_watermark, load_dimension, unknown_member
from tidemark.plans.domain import Warehouse, run_domain
from tidemark.plans.facts import fact_table, repeated_grain, resolve_operation_details
from tidemark.plans.monitor import (
    active_keys,
    default_expectations,
    default_thresholds,
    expectations,
    freshness,
    missing_success,
    stalled,
)
from tidemark.plans.retention import purge_control, purge_current_state
from tidemark.session import work_folder
from tidemark.sources import tables
from tidemark.sources.quarantine import Quarantine
from tidemark.sources.tables import AppendTable, KeyedTable
from tidemark.spec import EXTRACTED_AT, TIME_SENTINEL, EntitySpec, struct_type
from tidemark.streaming.upsert import landing_stream, stream_id, stream_upsert

T0 = datetime(2024, 3, 1, 6)
STATE_LANDING = struct_type(
    {
        "cd_estado": "string", "desc_estado": "string", "desc_estado_en_us": "string",
        "desc_estado_pt_br": "string", "desc_estado_es_es": "string",
        "source_updated_at": "timestamp_ntz", "_airbyte_extracted_at": "timestamp_ntz",
    }
)


def states(spark, *rows, extracted=T0):
    """Rows of (code, text, source time)."""
    data = [(c, t, t, None, None, at, extracted) for c, t, at in rows]
    return spark.createDataFrame(data, STATE_LANDING)


def state_table(spark, spec=E.STATE):
    return KeyedTable(spark, work_folder(spark, "ds"), spec.key, 4)


def as_map(df, key, *values):
    return {r[key]: tuple(r[v] for v in values) for r in df.collect()}


def test_latest_source_time_wins_then_extract_time(spark):
    table = state_table(spark)
    landing = states(spark, ("A", "old", T0), ("A", "none", None)).unionByName(
        states(spark, ("A", "new", T0), extracted=T0 + timedelta(hours=1))
    )
    merge_current_state(E.STATE, landing, table, T0, "b1")
    assert as_map(table.read(), "cd_estado", "desc_estado") == {"A": ("new",)}


def test_created_and_updated_times(spark):
    table = state_table(spark)
    t1, t2 = T0 + timedelta(days=1), T0 + timedelta(days=2)
    merge_current_state(E.STATE, states(spark, ("A", "x", T0), ("B", "y", T0)), table, T0, "b1")
    again = merge_current_state(E.STATE, states(spark, ("A", "x", T0)), table, t1, "b2")
    assert again.rows == 0
    merge_current_state(E.STATE, states(spark, ("A", "z", T0), ("C", "w", T0)), table, t2, "b3")
    found = as_map(table.read(), "cd_estado", "etl_batch_id", "bi_created_at", "bi_updated_at")
    assert found == {"A": ("b3", T0, t2), "B": ("b1", T0, T0), "C": ("b3", t2, t2)}


def test_reextract_counts_as_change_unless_switched_off(spark):
    later = states(spark, ("A", "x", T0), extracted=T0 + timedelta(hours=3))
    for compare, rows in ((True, 1), (False, 0)):
        spec = replace(E.STATE, compare_technical=compare)
        table = state_table(spark)
        merge_current_state(spec, states(spark, ("A", "x", T0)), table, T0, "b1")
        assert merge_current_state(spec, later, table, T0 + timedelta(days=1), "b2").rows == rows


def test_null_and_its_stand_in_are_equal(spark):
    for null_safe, rows in ((False, 0), (True, 1)):
        spec = replace(E.STATE, null_safe=null_safe)
        table = state_table(spark)
        merge_current_state(spec, states(spark, ("A", None, T0)), table, T0, "b1")
        assert merge_current_state(spec, states(spark, ("A", "", T0)), table, T0, "b2").rows == rows


def test_silent_flag_keeps_the_update_time(spark):
    spec = replace(
        E.with_silent_flag(E.CLIENT), compare_technical=False
    )
    schema = struct_type(
        {
            "id_cliente": "bigint", "nome_cliente": "string", "owner_cliente": "string",
            "server_cliente": "string", "fg_ativo": "boolean",
            "source_updated_at": "timestamp_ntz", "_airbyte_extracted_at": "timestamp_ntz",
        }
    )
    later = T0 + timedelta(days=1)
    for chosen, expected in ((spec, T0), (replace(E.CLIENT, compare_technical=False), later)):
        table = state_table(spark, chosen)
        for flag, at in ((True, T0), (False, later)):
            landing = spark.createDataFrame([(1, "n", "o", "s", flag, T0, T0)], schema)
            merge_current_state(chosen, landing, table, at, "b")
        row = table.read().first()
        assert (row["fg_ativo"], row["bi_updated_at"]) == (False, expected)


def test_incomplete_keys_are_set_aside(spark):
    table = state_table(spark)
    outcome = merge_current_state(
        E.STATE, states(spark, (None, "x", T0), ("A", "y", T0)), table, T0, "b1"
    )
    assert outcome.rows == 1 and outcome.rejected.count() == 1 and table.rows() == 1


def test_bad_values_fail_the_cast(spark):
    landing = states(spark, ("A", "x", T0)).withColumn("id", F.lit("text"))
    spec = replace(
        E.STATE, columns=(*E.STATE.columns, E.Column("id", "decimal(38,0)")), name="strict"
    )
    with pytest.raises(Exception):
        merge_current_state(spec, landing, state_table(spark), T0, "b1")


def test_text_is_cut_to_its_length(spark):
    table = state_table(spark)
    merge_current_state(E.STATE, states(spark, ("x" * 80, "t", T0)), table, T0, "b1")
    assert len(table.read().first()["cd_estado"]) == 50


def load(spark, table, dimension, landing, at, batch, watermark=None):
    merge_current_state(E.STATE, landing, table, at, batch)
    return load_dimension(E.STATE, table.read(), dimension, watermark, at, batch)


def test_dimension_keys_survive_and_unknown_member_comes_once(spark):
    table, dimension = state_table(spark), state_table(spark)
    load(spark, table, dimension, states(spark, ("a1", "alpha", T0), ("b1", "beta", T0)), T0, "b1")
    first = as_map(dimension.read(), "cd_estado", "sk_estado", "desc_estado")
    assert first["-1"] == (-1, "UNDEFINED") and first["a1"][1] == "ALPHA"
    t1 = T0 + timedelta(days=1)
    mark = dimension_watermark(E.STATE, dimension)
    assert mark == T0
    loaded = load(
        spark, table, dimension, states(spark, ("a1", "alpha2", T0), ("c1", "gamma", T0)), t1, "b2", mark
    )
    second = as_map(dimension.read(), "cd_estado", "sk_estado", "desc_estado")
    assert loaded == 2 and len(second) == 4
    assert second["a1"] == (first["a1"][0], "ALPHA2") and second["b1"] == first["b1"]
    assert second["c1"][0] not in {k for k, _ in first.values()}
    assert dimension_watermark(E.STATE, dimension) == t1


def test_dimension_keeps_the_first_created_time(spark):
    table, dimension = state_table(spark), state_table(spark)
    load(spark, table, dimension, states(spark, ("A", "x", T0)), T0, "b1")
    t1 = T0 + timedelta(days=1)
    # Retention removed the row, so the current state sees it as new.
    table.delete(F.col("cd_estado") == "A")
    load(spark, table, dimension, states(spark, ("A", "x", T0), extracted=t1), t1, "b2", T0)
    assert table.read().first()["bi_created_at"] == t1
    assert as_map(dimension.read(), "cd_estado", "bi_created_at")["A"] == (T0,)


def test_empty_slice_changes_nothing(spark):
    table, dimension = state_table(spark), state_table(spark)
    load(spark, table, dimension, states(spark, ("A", "x", T0)), T0, "b1")
    before = sorted(map(tuple, dimension.read().collect()))
    assert load_dimension(E.STATE, table.read(), dimension, T0, T0, "b2") == 0
    assert sorted(map(tuple, dimension.read().collect())) == before


def test_empty_dimension_has_no_watermark(spark):
    dimension = state_table(spark)
    dimension.merge(unknown_member(spark, E.STATE, T0, "b1"))
    assert dimension_watermark(E.STATE, dimension) is None


@pytest.mark.parametrize("spec", [s for s in E.DIMENSIONS if s.surrogate_key], ids=lambda s: s.name)
def test_unknown_member_of_each_entity(spark, spec):
    row = unknown_member(spark, spec, T0, "b1").first().asDict()
    assert row[spec.surrogate_key] == -1
    assert all(row[c] is not None for c in spec.names)
    assert [str(row[k]) for k in spec.key] == ["-1"] * len(spec.key)
    if spec is E.FARM:
        assert row["area_metro"] == Decimal("-999") and row["cd_produtor"] == Decimal("-999")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(st.integers(0, 300), max_size=40), min_size=1, max_size=4), lanes=st.sampled_from([1, 7, 4096]))
def test_allocated_keys_are_unique_and_stable(spark, batches, lanes):
    known: dict[int, int] = {}
    schema = struct_type({"k": "bigint", "sk": "bigint"})
    for batch in batches:
        data = [(k, known.get(k)) for k in sorted(set(batch))]
        highest = max(known.values(), default=0)
        df = spark.createDataFrame(data, schema)
        out = allocate_missing_keys(df, "sk", ["k"], highest, lanes)
        shuffled = allocate_missing_keys(df.repartition(3, "sk"), "sk", ["k"], highest, lanes)
        got = {r["k"]: r["sk"] for r in out.collect()}
        assert got == {r["k"]: r["sk"] for r in shuffled.collect()}
        assert all(got[k] == sk for k, sk in known.items() if k in got)
        fresh = sorted(sk for k, sk in got.items() if k not in known)
        assert fresh == list(range(highest + 1, highest + 1 + len(fresh)))
        known.update(got)
        assert len(set(known.values())) == len(known) and min(known.values(), default=1) > 0


@pytest.mark.parametrize("lanes", [1, 7, 4096])
def test_slices_get_the_keys_that_all_rows_get_at_once(spark, lanes):
    data = [(k, "x", 900 + k if k % 5 == 0 else None) for k in range(60)] + [(None, None, None), (None, "y", None)]
    df = spark.createDataFrame(data, struct_type({"k": "bigint", "t": "string", "sk": "bigint"}))
    cuts = [F.col("k").isNull() | (F.col("k") < 13), F.col("k").between(13, 14), F.col("k") > 14, F.col("k") > 99]
    parts = allocate_in_slices(df, "sk", ["k", "t"], 1000, cuts, lanes)
    whole = allocate_missing_keys(df, "sk", ["k", "t"], 1000, lanes)
    assert [p.count() for p in parts] == [15, 2, 45, 0]
    assert sorted(map(repr, whole.collect())) == sorted(repr(r) for p in parts for r in p.collect())
    assert [p.count() for p in allocate_in_slices(df.filter("false"), "sk", ["k"], 0, cuts, lanes)] == [0] * 4


def test_two_loads_by_slices_store_the_same_rows(spark, monkeypatch):
    """State, dimension and surrogate keys do not depend on whether a load is cut."""
    root, stored, cut = work_folder(spark, "cut"), [], []
    write = KeyedTable._write_files
    monkeypatch.setattr(tables, "SAMPLED_OF", 2)
    for i, n in enumerate((2000, 2500)):
        at = T0 + timedelta(days=i)
        texts = [f"'{i}' || id % 13 AS desc_estado", *[f"'t' AS desc_estado_{x}" for x in ("en_us", "pt_br", "es_es")]]
        times = [f"timestamp_ntz '{at}' AS {x}" for x in ("source_updated_at", "_airbyte_extracted_at")]
        spark.range(i * 1500, n).selectExpr("'c' || id AS cd_estado", *texts, *times).write.parquet(f"{root}/{i}")

    def counted(self, *args):
        cut[-1] += 1
        return write(self, *args)

    monkeypatch.setattr(KeyedTable, "_write_files", counted)
    for small in (1 << 30, 4000):
        monkeypatch.setattr(tables, "FILE_BYTES", small)
        monkeypatch.setattr(tables, "SLICE_BYTES", small)
        state, dimension = state_table(spark), state_table(spark)
        cut.append(0)
        for i in range(2):
            at = T0 + timedelta(days=i)
            merge_current_state(E.STATE, spark.read.parquet(f"{root}/{i}"), state, at, f"b{i}")
            load_dimension(E.STATE, state.read(), dimension, T0 if i else None, at, f"b{i}")
        stored.append([sorted(map(repr, t.read().collect())) for t in (state, dimension)])
        assert [len(x) for x in stored[-1]] == [2500, 2501] and dimension.highest("surrogate_key") == 2500
    assert stored[0] == stored[1] and cut[1] > cut[0] + 8


def test_highest_key_ignores_the_unknown_member(spark):
    df = spark.createDataFrame([(-1,)], "sk bigint")
    assert highest_key(df, "sk") == 0 and highest_key(df.filter("false"), "sk") == 0


def test_domain_run_records_and_purges(spark):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    result = run_domain(
        wh, [E.STATE], {E.STATE.name: states(spark, ("A", "x", T0), ("B", "y", T0))}, T0, "b1"
    )
    assert result["status"] == "SUCCESS" and result["purged"] == 2
    assert wh.landing(E.STATE).rows() == 0
    assert wh.control.watermark("dim_sx_estado_d") == T0
    batch = wh.control.batches().first()
    assert (batch["status"], batch["rows_extracted"], batch["rows_loaded"], batch["rows_affected"]) == ("SUCCESS", 2, 2, 3)
    assert batch["started_at"] == T0 and batch["orchestration_type"] == "SCHEDULER"
    mark = wh.control.watermarks().first()
    assert (mark["last_run_status"], mark["last_success_batch_id"]) == ("SUCCESS", "b1")
    audit = wh.control.audit()
    assert audit.filter("status = 'STARTED' and ended_at is null").count() == 1
    assert audit.select("audit_event_id").distinct().count() == audit.count()
    report = entity_checks(wh.dimension(E.STATE).read(), E.STATE, True, "dim")
    assert {r["status"] for r in report.collect()} == {"pass"}


def test_failed_run_keeps_landing_and_watermark(spark):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    run_domain(wh, [E.STATE], {E.STATE.name: states(spark, ("A", "x", T0))}, T0, "b1")
    t1 = T0 + timedelta(days=1)
    bad = states(spark, ("A", "z", T0)).withColumn("source_updated_at", F.lit("no time"))
    result = run_domain(wh, [E.STATE], {E.STATE.name: bad}, t1, "b2")
    assert result["status"] == "FAILED" and wh.landing(E.STATE).rows() == 1
    mark = wh.control.watermarks().first()
    assert (mark["last_run_status"], mark["last_bi_updated_at"], mark["last_success_batch_id"]) == ("FAILED", T0, "b1")
    assert mark["last_error_message"]
    status = wh.control.status().collect()
    assert {r["pipeline_name"] for r in status} == {"dimensions_domain", "dim_sx_estado_d"}
    failed = [r for r in status if r["pipeline_name"] == "dimensions_domain"][0]
    assert failed["failed_steps"] == "DBT_RUN" and failed["batch_status"] == "FAILED"


def test_retention(spark):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    run_domain(wh, [E.STATE], {E.STATE.name: states(spark, ("A", "x", T0))}, T0, "b1")
    t3 = T0 + timedelta(days=3)
    run_domain(wh, [E.STATE], {E.STATE.name: states(spark, ("B", "y", t3), extracted=t3)}, t3, "b2")
    deleted = purge_current_state({"sx_estado_d": wh.current_state(E.STATE)}, t3, "b3", wh.control)
    assert deleted == {"sx_estado_d": 1}
    gone = purge_control(wh.control, t3)
    assert gone["load_audit"] > 0 and gone["batch_execution"] == 1
    # A batch without a start time is kept, and later events still find their batch.
    assert {r["batch_id"] for r in wh.control.batches().collect()} == {"b2", "b3"}
    wh.control.batch_end(t3 + timedelta(hours=1), batch_id="b2", status="FAILED")
    row = [r for r in wh.control.batches().collect() if r["batch_id"] == "b2"][0]
    assert (row["status"], row["started_at"], row["pipeline_name"]) == ("FAILED", t3, "dimensions_domain")


def test_fold_lets_null_overwrite(spark):
    control = Control(spark, work_folder(spark, "ctl"))
    control.batch_start(T0, batch_id="b", pipeline_name="p", source_name="s", target_name="t")
    control.batch_end(T0, batch_id="b", status="FAILED", error_message="boom", rows_loaded=5)
    control.batch_start(T0, batch_id="b", pipeline_name="other", source_name="s", target_name="t")
    row = control.batches().first()
    assert (row["status"], row["error_message"], row["rows_loaded"], row["pipeline_name"]) == ("RUNNING", None, 5, "p")
    control.commit({"dim": T0}, "b", T0)
    control.commit({"dim": None}, "b2", T0)
    assert control.watermarks().first()["last_bi_updated_at"] is None
    assert control.watermark("dim") == TIME_SENTINEL and control.watermark("none") == TIME_SENTINEL


def test_run_status_pairs_both_sides(spark):
    control = Control(spark, work_folder(spark, "ctl"))
    control.batch_start(T0, batch_id="b", pipeline_name="only_batch", source_name="s", target_name="t")
    control.mark_running(["only_mark"], "b9", T0)
    rows = {r["pipeline_name"]: r for r in control.status().collect()}
    assert rows["only_batch"]["watermark_status"] is None and rows["only_batch"]["audit_events"] is None
    assert rows["only_mark"]["batch_id"] is None and rows["only_mark"]["updated_at"] == T0


def test_monitors(spark):
    now = T0 + timedelta(hours=20)
    control = Control(spark, work_folder(spark, "ctl"))
    control.batch_end(T0, batch_id="b", pipeline_name="a", source_name="s", target_name="t", status="SUCCESS")
    expected = expectations(
        spark,
        [
            {"pipeline_name": "a", "expected_success_within_minutes": 14 * 60},
            {"pipeline_name": "c", "expected_success_within_minutes": 26 * 60},
        ],
        "expected_success_within_minutes",
    )
    assert {r["pipeline_name"] for r in missing_success(expected, control.batches(), now).collect()} == {"a", "c"}
    soon = T0 + timedelta(hours=1)
    assert {r["pipeline_name"] for r in missing_success(expected, control.batches(), soon).collect()} == {"c"}
    control.mark_running(["x", "y"], "b", T0)
    control.commit({"y": T0}, "b", T0)
    limits = expectations(spark, [{"pipeline_name": "x"}, {"pipeline_name": "y"}], "stall_threshold_minutes")
    found = stalled(limits, control.watermarks(), T0 + timedelta(minutes=91)).collect()
    assert [(r["pipeline_name"], r["minutes_running"]) for r in found] == [("x", 91)]
    assert stalled(limits, control.watermarks(), T0 + timedelta(minutes=90)).count() == 0


@pytest.mark.parametrize("hours, state", [(17, "pass"), (19, "warn"), (31, "error")])
def test_freshness(spark, hours, state):
    df = spark.createDataFrame([(T0,)], struct_type({"t": "timestamp_ntz"}))
    assert freshness(df, "t", T0 + timedelta(hours=hours)).first()["status"] == state
    assert freshness(df.filter("false"), "t", T0).first()["status"] == "error"


def test_active_keys(spark):
    df = spark.createDataFrame([(2, "true"), (1, "a"), (1, "A"), (3, "no"), (4, None)], "k int, f string")
    assert [r["k"] for r in active_keys(df, "k", "f").collect()] == [1, 2]
    assert [r["k"] for r in active_keys(df, "k").collect()] == [1, 2, 3, 4]


def test_stream_merges_each_file_and_skips_replays(spark):
    root = work_folder(spark, "stream")
    table = KeyedTable(spark, f"{root}/state", E.STATE.key, 4)
    for i, text in enumerate(["one", "two", "three"]):
        rows = states(spark, ("A", text, T0 + timedelta(hours=i)), (f"K{i}", text, T0))
        rows.coalesce(1).write.mode("append").parquet(f"{root}/landing")
        stream = landing_stream(spark, f"{root}/landing", STATE_LANDING, files_per_batch=1)
        stream_upsert(E.STATE, stream, table, f"{root}/checkpoint", T0).awaitTermination()
    assert as_map(table.read(), "cd_estado", "desc_estado") == {
        "A": ("three",), "K0": ("one",), "K1": ("two",), "K2": ("three",),
    }
    # A true replay: the same stream and batch once more.
    ((writer, last),) = table.listing().applied.items()
    assert writer == f"stream-{stream_id(spark, f'{root}/checkpoint')}"
    assert merge_current_state(
        E.STATE, states(spark, ("Z", "z", T0)), table, T0, last, writer=writer
    ).rows == 0
    # A fresh checkpoint reads all files again, and a new file is not taken for an old batch.
    states(spark, ("N", "new", T0)).write.mode("append").parquet(f"{root}/landing")
    stream = landing_stream(spark, f"{root}/landing", STATE_LANDING)
    stream_upsert(E.STATE, stream, table, f"{root}/fresh", T0).awaitTermination()
    assert as_map(table.read(), "cd_estado", "desc_estado")["N"] == ("new",)


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1), (1, 3, 0, 2)])
def test_late_rows_change_nothing_in_any_order_of_arrival(spark, order):
    day = [T0 + timedelta(days=n) for n in range(4)]
    batches = [
        states(spark, ("A", "jan 5", day[0]), ("B", "none", None)),
        states(spark, ("A", "jan 10", day[2]), ("B", "b", day[1])),
        # Equal times: the larger content stays, whichever comes first.
        states(spark, ("A", "jan 10 again", day[2]), ("B", "a", day[1])),
        states(spark, ("A", "jan 7", day[1])),
    ]
    spec = replace(E.STATE, keep_newest=True)
    table = state_table(spark, spec)
    for n in order:
        merge_current_state(spec, batches[n], table, T0, f"b{n}")
    assert as_map(table.read(), "cd_estado", "desc_estado") == {"A": ("jan 10 again",), "B": ("b",)}


def test_without_the_switch_the_last_arrival_stays(spark):
    table = state_table(spark)
    for text, at in (("new", T0 + timedelta(days=5)), ("old", T0)):
        merge_current_state(E.STATE, states(spark, ("A", text, at)), table, T0, text)
    assert as_map(table.read(), "cd_estado", "desc_estado") == {"A": ("old",)}


def test_stream_keeps_rows_without_a_key(spark):
    root = work_folder(spark, "stream")
    table = KeyedTable(spark, f"{root}/state", E.STATE.key, 4)
    quarantine = Quarantine(spark, f"{root}/quarantine")
    states(spark, (None, "lost", T0), ("A", "kept", T0)).write.parquet(f"{root}/landing")
    stream = landing_stream(spark, f"{root}/landing", STATE_LANDING)
    stream_upsert(E.STATE, stream, table, f"{root}/checkpoint", T0, quarantine).awaitTermination()
    assert [r["desc_estado"] for r in quarantine.read().collect()] == ["lost"]
    assert table.rows() == 1


def test_quarantine_takes_a_batch_once_and_null_keys_can_be_kept(spark):
    root = work_folder(spark, "quarantine")
    quarantine = Quarantine(spark, f"{root}/quarantine")
    landing = states(spark, (None, "x", T0), (None, "y", T0 + timedelta(hours=1)), ("A", "z", T0))
    table = state_table(spark)
    for _ in range(2):
        outcome = merge_current_state(
            E.STATE, landing, table, T0, "b1", writer="w", quarantine=quarantine
        )
    assert quarantine.rows() == 2 and outcome.rejected.count() == 2 and table.rows() == 1
    kept = replace(E.STATE, keep_null_keys=True)
    table = state_table(spark, kept)
    for batch in ("b1", "b2"):
        merge_current_state(kept, landing, table, T0, batch, quarantine=quarantine)
    # A null key matches nothing, so it is new every time, as in the source system.
    assert table.read().filter("cd_estado IS NULL").count() == 2 and quarantine.rows() == 2


def test_domain_keeps_and_counts_rejected_rows(spark):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    arrivals = {E.STATE.name: states(spark, (None, "x", T0), ("A", "y", T0))}
    found = run_domain(wh, [E.STATE], arrivals, T0, "b1")
    assert found["status"] == "SUCCESS" and found["purged"] == 2
    event = wh.control.audit().filter("step_name LIKE 'QUARANTINE%'").first()
    assert (event["target_name"], event["rows_processed"]) == (E.STATE.name, 1)
    wh.landing(E.STATE).vacuum(T0 + timedelta(days=3650))
    assert [r["desc_estado"] for r in wh.quarantine(E.STATE).read().collect()] == ["x"]
    assert found["entities"][E.STATE.name]["rejected"].count() == 1


@pytest.mark.parametrize("second", ["b1", "b2"])
def test_a_repeated_run_leaves_each_rejected_row_once(spark, monkeypatch, second):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    arrivals = {E.STATE.name: states(spark, (None, "x", T0), (None, "x", T0), (None, "y", T0), ("A", "z", T0))}

    def broken(*_):
        raise RuntimeError("behind the quarantine")

    with monkeypatch.context() as m:
        m.setattr("tidemark.plans.domain.load_dimension", broken)
        assert run_domain(wh, [E.STATE], arrivals, T0, "b1")["status"] == "FAILED"
    assert wh.quarantine(E.STATE).rows() == 3
    # More rows land before the next run, which meets those that wait and the new ones.
    later = T0 + timedelta(hours=1)
    more = {E.STATE.name: states(spark, (None, "w", later), ("B", "b", later))}
    assert run_domain(wh, [E.STATE], more, later, second)["status"] == "SUCCESS"
    stored = wh.quarantine(E.STATE).read()
    assert sorted(r["desc_estado"] for r in stored.collect()) == ["w", "x", "x", "y"]
    assert {r["etl_batch_id"] for r in stored.collect()} == {second}
    events = wh.control.audit().filter("step_name LIKE 'QUARANTINE%'").collect()
    assert [(e["batch_id"], e["rows_processed"]) for e in events] == [(second, 4)]
    # Nothing waits any more: a further run changes nothing.
    assert run_domain(wh, [E.STATE], {}, later, "b3")["status"] == "SUCCESS"
    assert wh.quarantine(E.STATE).rows() == 4


def test_nothing_is_written_when_nothing_is_rejected(spark):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    run_domain(wh, [E.STATE], {E.STATE.name: states(spark, ("A", "y", T0))}, T0, "b1")
    assert not wh.quarantine(E.STATE).exists() and wh.quarantine(E.STATE).rows() == 0
    with pytest.raises(FileNotFoundError):
        wh.quarantine(E.STATE).read()
    assert wh.quarantine(E.STATE).read(wh.current_state(E.STATE).schema()).count() == 0


def test_retention_drops_days_of_the_current_state(spark):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    state = wh.current_state(E.STATE)
    for n, key in enumerate("ABC"):
        at = T0 + timedelta(days=n)
        merge_current_state(E.STATE, states(spark, (key, "x", at), ("Z", key, at)), state, at, f"b{n}")
    kept = {f for f in state.listing().folders if f"_day={(T0 + timedelta(days=2)).date()}" in f}
    assert purge_current_state({"s": state}, T0 + timedelta(days=2), "c", wh.control) == {"s": 2}
    assert set(state.listing().folders) == kept and len(kept) == 1
    assert as_map(state.read(), "cd_estado", "desc_estado") == {"C": ("x",), "Z": ("C",)}


@pytest.mark.parametrize("small_bytes", [0, None])
@pytest.mark.parametrize("column", [{"upper": True}, {"length": 3}, {"upper": True, "length": 3}])
def test_surrogate_keys_stay_on_both_sides_of_the_size_switch(spark, small_bytes, column):
    spec = EntitySpec(
        "coded", ("code",), (E.Column("code", **column), E.Column("value", "int")), "sk_coded"
    )
    root = work_folder(spark, "coded")
    state = KeyedTable(spark, f"{root}/state", spec.key, 4, small_bytes)
    dimension = KeyedTable(spark, f"{root}/dimension", spec.key, 4, small_bytes)
    keys = []
    for n in range(2):
        at = T0 + timedelta(days=n)
        rows = [(f"k{i}xyz", n, at, at) for i in range(9)]
        landing = spark.createDataFrame(
            rows, "code string, value int, source_updated_at timestamp_ntz, _airbyte_extracted_at timestamp_ntz"
        )
        merge_current_state(spec, landing, state, at, f"b{n}")
        load_dimension(spec, state.read(), dimension, T0 if n else None, at, f"b{n}")
        keys.append(as_map(dimension.read().filter("sk_coded <> -1"), "code", "sk_coded"))
    assert keys[0] == keys[1] and len(keys[0]) == 9


def client_landing(spark, *ids):
    schema = struct_type(
        {
            "id_cliente": "bigint", "nome_cliente": "string", "owner_cliente": "string",
            "server_cliente": "string", "fg_ativo": "boolean",
            "source_updated_at": "timestamp_ntz", "_airbyte_extracted_at": "timestamp_ntz",
        }
    )
    return spark.createDataFrame([(i, f"n{i}", "o", "s", True, T0, T0) for i in ids], schema)


def test_client_dimension_drops_key_minus_one(spark):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    run_domain(wh, [E.CLIENT], {E.CLIENT.name: client_landing(spark, -1, 1, 2)}, T0, "b1")
    rows = as_map(wh.dimension(E.CLIENT).read(), "id_cliente", "nome_cliente")
    assert rows == {1: ("N1",), 2: ("N2",)}


def test_entities_load_side_by_side_and_serve_sql(spark):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    arrivals = {
        E.CLIENT.name: client_landing(spark, 1, 2, 3),
        E.STATE.name: states(spark, ("A", "x", T0)),
    }
    specs = [E.CLIENT, E.STATE, E.FARM]
    result = run_domain(wh, specs, arrivals, T0, "b1")
    assert result["status"] == "SUCCESS" and result["entities"][E.FARM.name]["merged"] == 0
    assert wh.control.watermarks().filter("last_run_status = 'SUCCESS'").count() == 2
    wh.create_views(specs)
    joined = spark.sql(
        "select count(*) from dim_sx_cliente_d cross join stg_ds__sx_estado_d"
        " cross join (select * from vw_pipeline_run_status where batch_id is not null)"
    )
    assert joined.first()[0] == 3


def test_one_failing_entity_leaves_the_others_committed(spark):
    wh = Warehouse(spark, work_folder(spark, "wh"))
    bad = states(spark, ("A", "x", T0)).withColumn("source_updated_at", F.lit("no time"))
    arrivals = {E.CLIENT.name: client_landing(spark, 1), E.STATE.name: bad}
    result = run_domain(wh, [E.CLIENT, E.STATE], arrivals, T0, "b1")
    assert set(result["errors"]) == {E.STATE.name}
    states_found = as_map(wh.control.watermarks(), "pipeline_name", "last_run_status")
    assert states_found == {"dim_sx_cliente_d": ("SUCCESS",), "dim_sx_estado_d": ("FAILED",)}
    assert wh.landing(E.CLIENT).rows() == 1 and wh.landing(E.STATE).rows() == 1


def test_merge_into_needs_a_table_with_row_level_updates(spark):
    from tidemark.operators.merge import merge_into

    spark.range(3).selectExpr("id as k", "id as v").createOrReplaceTempView("plain_target")
    with pytest.raises(Exception, match="(?i)merge|unsupported|not supported"):
        merge_into("plain_target", spark.range(2).selectExpr("id as k", "id as v"), ["k"])


def test_extract_reads_past_the_last_merged_time(spark):
    source = states(
        spark, ("A", "x", T0), ("B", "y", T0 + timedelta(hours=1)), ("C", "z", T0 + timedelta(hours=2))
    ).drop("_airbyte_extracted_at")
    table = state_table(spark)
    first = extract(E.STATE, source.filter("cd_estado <> 'C'"), table, T0)
    assert first.count() == 2
    merge_current_state(E.STATE, first, table, T0, "b1")
    second = extract(E.STATE, source, table, T0 + timedelta(days=1))
    assert [r["cd_estado"] for r in second.collect()] == ["C"]
    assert extract(replace(E.STATE, full_extract=True), source, table, T0).count() == 3


def test_shortened_logs_keep_the_state(spark):
    control = Control(spark, work_folder(spark, "ctl"))
    for i in range(3):
        control.commit({"a": T0 + timedelta(hours=i), "b": None}, f"b{i}", T0)
    before = sorted(map(tuple, control.watermarks().collect()), key=repr)
    control.shorten_watermarks()
    assert len(control.watermark_log.listing().folders) == 1
    assert sorted(map(tuple, control.watermarks().collect()), key=repr) == before
    assert control.watermark("a") == T0 + timedelta(hours=2)
    control.mark_failed(["a"], "b9", "boom", T0 + timedelta(days=1))
    assert control.watermark("a") == T0 + timedelta(hours=2)
    row = [r for r in control.watermarks().collect() if r["pipeline_name"] == "a"][0]
    assert (row["last_run_status"], row["last_success_batch_id"]) == ("FAILED", "b2")
    assert control.watermark("b") == TIME_SENTINEL


def test_default_monitor_specs(spark):
    control = Control(spark, work_folder(spark, "ctl"))
    missing = missing_success(default_expectations(spark), control.batches(), T0)
    assert missing.count() == 2
    control.mark_running([s.pipeline_name for s in E.DIMENSIONS], "b", T0)
    limits = default_thresholds(spark, E.DIMENSIONS)
    assert stalled(limits, control.watermarks(), T0 + timedelta(hours=2)).count() == 6


def test_facts_by_closing_day(spark):
    codes = {c: Decimal(1) for c in E.OPERATION_DETAILS_GRAIN}
    base = {**codes, "cd_estado": "SP", "data": date(2024, 1, 1)}
    rows = [
        {**base, "dt_dia_fechamento": date(2024, 1, 1)},
        {**base, "dt_dia_fechamento": date(2024, 1, 2), "cd_equipamento": Decimal(2)},
        {**base, "dt_dia_fechamento": date(2024, 1, 2), "cd_equipamento": Decimal(2)},
        {**base, "dt_dia_fechamento": date(2024, 1, 3), "cd_ordem_servico": None},
    ]
    schema = E.OPERATION_DETAILS_SCHEMA
    facts = spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)
    stored = fact_table(spark, work_folder(spark, "facts"))
    assert stored.append(facts) == 4 and len(stored.listing().folders) == 3
    assert repeated_grain(stored.read()).count() == 1
    equipment = unknown_member(spark, E.EQUIPMENT, T0, "b").unionByName(
        unknown_member(spark, E.EQUIPMENT, T0, "b").withColumns(
            {
                "sk_equipamento": F.lit(7).cast("bigint"),
                "id_cliente": F.lit(1).cast(E.NUMBER),
                "cd_equipamento": F.lit("1"),
            }
        )
    )
    state = unknown_member(spark, E.STATE, T0, "b")
    found = resolve_operation_details(stored.read(), {"sk_equipamento": equipment, "sk_estado": state})
    keys = sorted((r["sk_equipamento"], r["sk_estado"]) for r in found.collect())
    assert keys == [(-1, -1), (-1, -1), (7, -1), (7, -1)]


def test_work_orders_are_kept_by_key(spark):
    orders = KeyedTable(spark, work_folder(spark, "orders"), E.WORK_ORDER_KEY)
    row = {"id_cliente": Decimal(1), "cd_ordem_servico": Decimal(5), "fg_ativo": Decimal(1)}
    for text in ("open", "closed"):
        values = {**row, "desc_ord_status": text, "vl_latitude": Decimal("-23.550520000000000")}
        schema = E.WORK_ORDER_SCHEMA
        orders.merge(spark.createDataFrame([tuple(values.get(n) for n in schema.names)], schema))
    assert [r["desc_ord_status"] for r in orders.read().collect()] == ["closed"]
