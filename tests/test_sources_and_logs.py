import json
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.lookups import product_within
from tidemark.plans import run_logs as L
from tidemark.session import work_folder
from tidemark.sources import views

T0 = datetime(2024, 1, 1)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_equipment_without_lookups(spark):
    equipment = frame(
        spark,
        "cd_cliente int, cd_equipamento int, desc_equipamento string, cd_modelo_equipamento int,"
        " cd_tp_equipamento string, tp_uso_equipamento int, fg_ativo boolean, dt_updated timestamp_ntz",
        (1, 10, "x" * 1200, 7, "101", None, True, T0),
        (1, 10, "old", 7, "101", 1, True, None),
        (1, 11, "other type", 7, "999", 1, True, T0),
    )
    models = frame(spark, "cd_cliente int, cd_modelo_equipamento int, desc_modelo_equipamento string, dt_updated timestamp_ntz", (2, 7, "m", T0))
    types = frame(
        spark, "cd_cliente int, cd_tp_equipamento string, desc_tp_equipamento string, dt_updated timestamp_ntz",
        (1, "101", "t-new", datetime(2024, 2, 1)), (1, "101", "t-old", T0),
    )
    moves = frame(
        spark, "cd_cliente int, cd_equipamento int, fg_ativo boolean, dt_hr_utc_movimento timestamp_ntz, dt_updated timestamp_ntz",
        (1, 10, False, T0, None),
    )
    (row,) = views.equipment_view(equipment, models, types, moves).collect()
    assert len(row["desc_equipamento"]) == 1000
    assert (row["cd_modelo_equipamento"], row["desc_modelo_equipamento"]) == (-1, "UNDEFINED")
    assert (row["cd_tipo_equipamento"], row["desc_tipo_equipamento"]) == (101, "t-new")
    assert (row["desc_status"], row["tp_uso_equipamento"]) == ("I", -1)
    assert row["source_updated_at"] == datetime(2024, 2, 1)


def test_operation_keeps_its_own_code(spark):
    operations = frame(
        spark,
        "cd_cliente int, cd_operacao int, desc_operac string, cd_grupo_operac int, cd_grupo_parada int,"
        " fg_tipo_operac string, cd_processo int, fg_ativo boolean, dt_updated timestamp_ntz",
        (1, 5, "op", 9, None, "P", None, True, None),
    )
    groups = frame(spark, "cd_cliente int, cd_grupo_operac int, desc_grupo_operac string, dt_updated timestamp_ntz", (2, 9, "g", T0))
    processes = frame(spark, "cd_cliente int, cd_processo int, desc_processo string, dt_updated timestamp_ntz", (1, 1, "p", T0))
    row = views.operation_view(operations, groups, processes).first()
    assert (row["cd_grupo_operacao"], row["desc_grupo_operacao"]) == (9, "UNDEFINED")
    assert (row["cd_processo"], row["cd_grupo_parada"]) == (-1, -1)
    assert row["source_updated_at"] == datetime(1900, 1, 1)


def test_state_translations(spark):
    states = frame(
        spark, "cd_estado string, desc_estado string, estado_json string, dt_updated timestamp_ntz",
        ("SP", "Sao Paulo", '{"en-us": "sp", "pt-br": "são"}', T0), ("RJ", "Rio", None, None),
    )
    rows = {r["cd_estado"]: r for r in views.state_view(states).collect()}
    assert rows["SP"]["desc_estado_en_us"] == "SP" and rows["SP"]["desc_estado_pt_br"] == "SÃO"
    assert rows["SP"]["desc_estado_es_es"] is None and rows["RJ"]["desc_estado_en_us"] is None


def test_farm_has_no_default_producer(spark):
    plots = frame(
        spark,
        "cd_cliente int, cd_fazenda string, desc_fazenda string, cd_talhao string, desc_talhao string,"
        " cd_zona string, area_metro double, cd_produtor int, active boolean, dt_updated timestamp_ntz",
        (1, "f", "F", "t", "T", "z", 2.5, 4, True, T0),
    )
    producers = frame(spark, "cd_cliente int, cd_produtor int, desc_nome string, dt_updated timestamp_ntz", (1, 5, "n", T0))
    row = views.farm_view(plots, producers).first()
    assert (row["cd_produtor"], row["desc_produtor"]) == (4, None)


@pytest.mark.parametrize("same_client, count", [(True, 3), (False, 6)])
def test_front_meets_groups(spark, same_client, count):
    units = frame(
        spark, "cd_cliente int, cd_unidade int, cd_regional int, desc_unidade string, fg_ativo boolean, dt_updated timestamp_ntz",
        (1, 1, 1, "u1", True, T0), (2, 2, 1, "u2", True, T0),
    )
    groups = frame(
        spark, "cd_cliente int, cd_grupo_equipamento int, desc_grupo_equipamento string, dt_updated timestamp_ntz",
        (1, 1, "g1", T0), (1, 2, "g2", T0), (2, 3, "g3", datetime(2024, 6, 1)),
    )
    regions = frame(
        spark, "cd_cliente int, cd_regional int, cd_corporativo int, desc_regional string, dt_updated timestamp_ntz",
        (1, 1, 8, "r", T0),
    )
    corporates = frame(spark, "cd_cliente int, cd_corporativo int, desc_corporativo string, dt_updated timestamp_ntz", (1, 8, "c", T0))
    rows = views.front_view(units, groups, regions, corporates, same_client).collect()
    assert len(rows) == count
    alone = [r for r in rows if r["cd_unidade"] == 2]
    assert all(r["cd_regional"] is None and r["cd_corporativo"] is None for r in alone)
    assert max(r["source_updated_at"] for r in alone) == datetime(2024, 6, 1)


def test_product_of_a_large_group_is_whole(spark):
    left = spark.range(500).select(F.when(F.col("id") < 450, 1).otherwise(2).alias("g"), F.col("id").alias("a"))
    right = spark.range(6).select(F.when(F.col("id") < 4, 1).otherwise(2).alias("g"), F.col("id").alias("b"))
    plain = product_within(left, right, ["g"], ["a"])
    spread = product_within(left, right, ["g"], ["a"], heavy=60)
    assert spread.count() == 450 * 4 + 50 * 2
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, spread.select(*plain.columns).collect()))


def results(*rows):
    return json.dumps(
        {"results": [{"unique_id": u, "status": s, "adapter_response": {"rows_affected": n}} for u, s, n in rows]}
    )


def test_run_totals_and_attribution(spark):
    docs = frame(
        spark, "run string, doc string",
        ("r1", results(("model.p.dim_a", "success", 5), ("model.p.ds_a", "error", 2), ("test.p.x", "pass", 1))),
        ("r2", results(("model.p.dim_b", "success", 7), ("test.p.other", "fail", 1))),
        ("r3", results(("model.p.fct_c", "skipped", 3),)),
    )
    parsed = L.run_results(docs, "run", "doc")
    totals = {r["run"]: r for r in L.run_totals(parsed, "run").collect()}
    assert (totals["r1"]["model_count"], totals["r1"]["test_count"]) == (2, 1)
    assert (totals["r1"]["rows_affected_total"], totals["r1"]["rows_affected_final_total"]) == (7, 5)
    assert totals["r3"]["rows_affected_final_total"] == 3
    failed = L.failed_pipelines(parsed, "run", ["dim_a", "dim_b"])
    assert sorted(map(tuple, failed.collect())) == [("r1", "dim_a"), ("r2", "dim_a"), ("r2", "dim_b")]


def test_models_to_pipelines(spark):
    df = frame(spark, "m string", (" ds_x ",), ("stg_ds__y",), ("dim_z",), ("other",), ("",))
    names = [r[0] for r in df.select(L.pipeline_of_model(F.col("m"))).collect()]
    assert names == ["dim_x", "dim_y", "dim_z", None, None]


def test_sync_logs(spark):
    def payload(**attempt):
        return json.dumps({"attempts": [{"status": "failed"}, {"status": "succeeded", **attempt}]})

    streams = [{"streamName": "a", "stats": {"recordsCommitted": 3}}, {"streamName": "b", "stats": {"records_emitted": 4}}]
    payloads = frame(
        spark, "batch string, payload string",
        ("totals", payload(totalStats={"recordsEmitted": 9, "recordsCommitted": 8}, streamStats=streams)),
        ("streams", payload(streamStats=streams)),
        ("zero", payload(totalStats={"records_synced": 0})),
        ("broken", "not json"),
    )
    logs = frame(
        spark, "batch string, text string",
        ("zero", "x\nFinished insert of 12 row(s)\nFinished insert of 4 row(s)"),
        ("broken", 'Read 5 records from s.a stream; Emitted 7 records for stream s.a, committed 2 records for stream t'),
        ("text", "recordsExtracted: 6, recordsSynced=0"),
        ("silent", "nothing"),
    )
    found = {
        r["batch"]: (r["rows_processed"], r["rows_metric_source"])
        for r in L.sync_log_stats(payloads, logs, "batch", "payload", "text").collect()
    }
    assert found == {
        "totals": (8, "records_committed"),
        "streams": (7, "stream_stats_total"),
        "zero": (12, "rows_inserted"),
        "broken": (9, "stream_stats_total"),
        "text": (6, "records_extracted"),
        "silent": (None, None),
    }


def test_sync_payload_spellings(spark):
    wrapped = {
        "job": {
            "attempts": [
                {
                    "attempt": {
                        "status": "Succeeded",
                        "stream_stats": [
                            {"streamDescriptor": {"name": "a"}, "stats": {"records_synced": 2, "recordsEmitted": 9}},
                            {"stream_name": "b", "stats": {}},
                            {"streamName": "c", "stats": {"recordsLoaded": 5}},
                        ],
                    }
                },
                {"status": "running"},
            ]
        }
    }
    loose = "\n\t " + json.dumps({"job": {"recordsSynced": "12", "attempts": [7, None, {"status": " Failed "}]}}, indent=2)
    payloads = frame(
        spark, "batch string, payload string", ("w", json.dumps(wrapped)), ("e", "{}"), ("l", loose), ("n", None), ("b", "[1]"),
    )
    rows = {r["batch"]: r for r in L.payload_stats(payloads, "batch", "payload").collect()}
    assert rows["l"]["rows_synced"] == 12 and len(rows) == 5
    assert rows["n"]["rows_synced"] is None and rows["b"]["has_totals"] is False
    assert rows["w"]["stream_stats_summary"] == "a=2, c=5"
    assert rows["w"]["rows_stream_stats_total"] == 14 and not rows["w"]["has_totals"]
    assert rows["e"]["stream_stats_summary"] is None and rows["e"]["rows_stream_stats_total"] is None


def plain_objects(text):
    """Objects that a JSON decoder finds when it is tried at each brace, and all within them, outside in."""
    found, at = [], 0
    while (at := text.find("{", at)) >= 0:
        try:
            found.append(json.JSONDecoder().raw_decode(text, at)[0])
        except ValueError:
            pass
        at += 1
    return found


LOG_PIECES = [
    '{"streamStats":[{"name":"a","recordsSynced":1}]}', '{"x":{"stream_stats":{"b":{"records_emitted":2}}}}', '{"streamStatus":{}}',
    '{"k":"}{"}', '{"k":"\\\\"}', "{", "}", '"', "it's", " ", "\n", '{"l":[{"stream_statuses":[{"stream_name":"c"}]}]}', "\\", '\\"', "é🙂",
]


@pytest.mark.parametrize("seed", range(3))
def test_objects_within_text_are_those_that_a_decoder_finds(spark, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(LOG_PIECES, k=rng.randrange(12))) for _ in range(300)]
    df = frame(spark, "text string", *[(t,) for t in texts])
    rows = df.select("text", L.json_spans(F.col("text")).alias("spans"), L.text_streams(F.col("text")).alias("streams")).collect()
    keys = ("streamStats", "stream_stats", "streamStatuses", "stream_statuses", "streamStatus", "stream_status")
    hits = 0
    for row in rows:
        spans = [row.text[s.start : s.end] for s in row.spans]
        for start in (m.start() for m in re.finditer("{", row.text)):
            try:
                end = json.JSONDecoder().raw_decode(row.text, start)[1]
            except ValueError:
                continue
            assert (start, end) in {(s.start, s.end) for s in row.spans}, (row.text, spans)
        first = next((o[k] for o in plain_objects(row.text) for k in keys if o.get(k)), None)
        assert (json.loads(row.streams) if row.streams else None) == first, row.text
        hits += first is not None
    assert hits > 30


def test_log_facts_of_odd_texts(spark):
    stats = '{"streamStats":[{"name":"%s","stats":{"recordsLoaded":"%d"}}]}'
    logs = frame(
        spark, "batch string, n int, text string, kind string, name string",
        ("null", 1, None, "k", "x"), ("empty", 1, "", "k", "x"), ("order", 2, stats % ("late", 5), "k", "x"),
        ("order", 1, "x" + stats % ("early", 7) + "y", "k", "x"), ("order", 1, "x" + stats % ("early", 7) + "y", "k", "x"),
        ("words", 1, "Read 5 records from s stream", "k", "x"), ("both", 1, "Read 5 records from s stream", "k", "x"),
        ("both", None, stats % ("o", 1), "k", "x"), ("long", 1, "{ " * 500 + stats % ("deep", 3) + " }" * 400, "k", "x"),
        (None, 1, stats % ("z", 4), "k", "x"),
    )
    found = {r["batch"]: (r["rows_text_streams"], r["text_stream_summary"]) for r in L.log_facts(logs, "batch", "text", ["n"]).collect()}
    assert found == {
        "null": (None, None), "empty": (None, None), "order": (7, "early=7"), "words": (5, None), "both": (1, "o=1"),
        "long": (3, "deep=3"), None: (4, "z=4"),
    }
    assert L.log_facts(logs.limit(0), "batch", "text").count() == 0


def test_sync_logs_are_read_once(spark):
    root = work_folder(spark, "logs")
    frame(spark, "batch string, text string", ("a", "Finished insert of 3 row(s)")).write.parquet(root)
    payloads = frame(spark, "batch string, payload string", ("a", "{}"))
    plan = L.sync_log_stats(payloads, spark.read.parquet(root), "batch", "payload", "text")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan parquet") == 1
    assert [(r["rows_processed"], r["rows_metric_source"]) for r in plan.collect()] == [(3, "rows_inserted")]


def test_product_of_one_row_with_many_takes_several_tasks(spark):
    left = spark.createDataFrame([(1, 7)], "g int, a int")
    right = spark.range(5000).selectExpr("1 AS g", "id AS b")
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        spread = product_within(left, right, ["g"], ["a"], heavy=100)
        assert spread.count() == 5000 and spread.distinct().count() == 5000
        tasks = spread.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_both_sides_of_a_heavy_group_are_cut(spark):
    left = spark.createDataFrame([(1, i) for i in range(3)] + [(2, 9)], "g int, a int")
    right = spark.createDataFrame([(1, i) for i in range(400)] + [(2, 1)], "g int, b int")
    spread = product_within(left, right, ["g"], ["a"], heavy=10)
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, left.join(right, "g").collect()))
