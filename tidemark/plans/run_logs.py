"""Statistics from transform run results and from sync logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Result states that are not failures, and names of final models.
FINE_STATES = ["success", "pass", "skipped"]
FINAL_PREFIXES = ("dim_", "fct_")
COUNTERS = ("rows_inserted", "rows_updated", "rows_deleted", "rows_affected")

def run_results(
    documents: DataFrame, run: str, payload: str, counters: Sequence[str] = COUNTERS
) -> DataFrame:
    """One row per result of each run document, parsing only the fields that are used."""
    response = "".join(f"{c}:bigint," for c in counters).rstrip(",")
    fields = "unique_id:string, status:string"
    fields += f", adapter_response:struct<{response}>" if counters else ""
    parsed = F.from_json(payload, f"results array<struct<{fields}>>")["results"]
    exploded = documents.select(run, F.explode(parsed).alias("r"))
    return exploded.select(
        run,
        F.col("r.unique_id").alias("unique_id"),
        F.split_part("r.unique_id", F.lit("."), F.lit(1)).alias("resource_type"),
        F.lower("r.status").alias("status"),
        *[F.coalesce(f"r.adapter_response.{c}", F.lit(0)).alias(c) for c in counters],
    )


def run_totals(results: DataFrame, run: str) -> DataFrame:
    """Model and test counts per run, with row totals of all and of final models."""
    is_model = F.col("resource_type") == "model"
    name = F.element_at(F.split("unique_id", r"\."), -1)
    is_final = is_model & (
        name.startswith(FINAL_PREFIXES[0]) | name.startswith(FINAL_PREFIXES[1])
    )

    def total(counter: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(counter))), F.lit(0)).cast("bigint")

    return results.groupBy(run).agg(
        F.count_if(is_model).alias("model_count"),
        F.count_if(F.col("resource_type") == "test").alias("test_count"),
        *[total(c, is_model).alias(f"{c}_total") for c in COUNTERS],
        *[total(c, is_final).alias(f"{c}_final_total") for c in COUNTERS],
    )


def pipeline_of_model(model: Column) -> Column:
    """Dimension pipeline a model belongs to, or null."""
    text = F.trim(model)
    return (
        F.when(text.startswith("dim_"), text)
        .when(text.startswith("stg_ds__"), F.concat(F.lit("dim_"), F.substr(text, F.lit(9))))
        .when(text.startswith("ds_"), F.concat(F.lit("dim_"), F.substr(text, F.lit(4))))
    )


def matching_pipeline(unique_id: Column, pipelines: Sequence[str]) -> Column:
    """The first requested pipeline whose model names occur in the result id, or null.

    The requested pipelines are a short list from the run's settings, so the match is a
    column expression and needs no join.
    """
    text = F.lower(unique_id)
    chosen: Column | None = None
    for pipeline in pipelines:
        lowered = pipeline.lower()
        entity = lowered.removeprefix("dim_")
        names = (lowered, f"ds_{entity}", f"stg_ds__{entity}")
        hit = text.contains(names[0]) | text.contains(names[1]) | text.contains(names[2])
        chosen = F.when(hit, pipeline) if chosen is None else chosen.when(hit, pipeline)
    return chosen if chosen is not None else F.lit(None).cast("string")


def failed_pipelines(results: DataFrame, run: str, pipelines: Sequence[str]) -> DataFrame:
    """Requested pipelines that failed, per run that has a failed result.

    When no failed result of a run names a pipeline, all requested ones count as failed.
    """
    state = F.lower(F.coalesce("status", F.lit("")))
    failed = results.filter(~state.isin(FINE_STATES)).select(
        run, matching_pipeline(F.col("unique_id"), pipelines).alias("pipeline_name")
    )
    # collect_set keeps at most one entry per requested pipeline.
    named = failed.groupBy(run).agg(F.collect_set("pipeline_name").alias("__named"))
    every = F.array(*[F.lit(p) for p in pipelines])
    return named.select(
        run,
        F.explode(F.when(F.size("__named") > 0, F.col("__named")).otherwise(every)).alias(
            "pipeline_name"
        ),
    )


# Metric names in sync payloads and the texts that report them.
_SYNCED = ("recordsSynced", "records_synced")
_LOADED = ("recordsLoaded", "records_loaded")
_COMMITTED = ("recordsCommitted", "records_committed")
_EMITTED = ("recordsEmitted", "records_emitted")
_EXTRACTED = ("recordsExtracted", "records_extracted")
STREAM_METRIC_ORDER = (*_LOADED, *_COMMITTED, *_EMITTED, *_EXTRACTED, *_SYNCED)
STREAM_SUMMARY_ORDER = (*_SYNCED, *_LOADED, *_COMMITTED, *_EMITTED, *_EXTRACTED)
TERMINAL_STATES = ["succeeded", "completed", "failed", "cancelled", "canceled"]
STREAM_TEXTS = (
    # pattern, group with the stream, group with the count
    (r"(?i)Read\s+(\d+)\s+records?\s+from\s+([A-Za-z0-9_.-]+)\s+stream", 2, 1),
    (r"(?i)Emitted\s+(\d+)\s+records?\s+for\s+stream\s+([A-Za-z0-9_.-]+)", 2, 1),
    (r"(?i)Committed\s+(\d+)\s+records?\s+for\s+stream\s+([A-Za-z0-9_.-]+)", 2, 1),
    (
        r"(?i)streamName[\"'\s:=]+([A-Za-z0-9_.-]+).*?"
        r"records(?:Synced|Committed|Emitted|Extracted|Loaded)[\"'\s:=]+(\d+)",
        1,
        2,
    ),
    (
        r"(?i)([A-Za-z0-9_.-]+)\s+stream.*?"
        r"records(?:Synced|Committed|Emitted|Extracted|Loaded)[\"'\s:=]+(\d+)",
        1,
        2,
    ),
)
TEXT_METRICS = {
    "rows_inserted": r"(?i)Finished insert of (\d+) row\(s\)",
    "records_committed": r"(?i)recordsCommitted[\"'\s:=]+(\d+)",
    "records_synced": r"(?i)recordsSynced[\"'\s:=]+(\d+)",
    "records_emitted": r"(?i)recordsEmitted[\"'\s:=]+(\d+)",
    "records_extracted": r"(?i)recordsExtracted[\"'\s:=]+(\d+)",
}


def _hits(text: Column, pattern: str, stream: int, count: int) -> Column:
    """(stream_name, row_count) of all matches; the text is searched once."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: F.struct(
            F.regexp_extract(m, pattern, stream).alias("stream_name"),
            F.regexp_extract(m, pattern, count).alias("row_count"),
        ),
    )


def _reported(text: Column) -> Column:
    """(stream_name, row_count) of every report in a text."""
    return F.concat(*[_hits(text, pattern, stream, count) for pattern, stream, count in STREAM_TEXTS])


def stream_counts(logs: DataFrame, batch: str, text: str) -> DataFrame:
    """Largest row count each stream reports in the log texts of a batch."""
    hits = logs.select(batch, F.explode(_reported(F.col(text))).alias("hit"))
    return (
        hits.select(batch, "hit.stream_name", F.col("hit.row_count").cast("bigint").alias("n"))
        .groupBy(batch, "stream_name")
        .agg(F.max("n").alias("row_count"))
    )


def _largest(text: Column, pattern: str) -> Column:
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_max(F.transform(hits, lambda h: h.cast("bigint")))


def _chosen_text_metric(found: DataFrame) -> DataFrame:
    """Add text_metric and rows_from_text.

    The first metric above zero in order of priority counts, else the first present.
    """
    names = list(TEXT_METRICS)

    def first_where(test) -> Column:
        return F.coalesce(*[F.when(test(F.col(n)), F.lit(n)) for n in names])

    metric = F.coalesce(first_where(lambda c: c > 0), first_where(lambda c: c.isNotNull()))
    value = F.coalesce(*[F.when(F.col("text_metric") == n, F.col(n)) for n in names])
    return found.withColumn("text_metric", metric).withColumn("rows_from_text", value)


def text_metrics(logs: DataFrame, batch: str, text: str) -> DataFrame:
    """Largest value of each text metric per batch, and the metric that counts."""
    found = logs.groupBy(batch).agg(
        *[F.max(_largest(F.col(text), p)).alias(name) for name, p in TEXT_METRICS.items()]
    )
    return _chosen_text_metric(found)


# An escaped quote or backslash, or what opens or closes a string or an object.
_TOKEN = r'\\[\\"]|["{}]'
_SPANS = "array<struct<start:int,end:int>>"


def json_spans(text: Column) -> Column:
    """(start, end) of every pair of braces that can be a JSON object, by their start.

    Where a text may hold anything around its objects, a quote tells nothing by itself: seen
    from a brace, a later one is within a string if the number of quotes between both is odd.
    So braces fall into two kinds, behind an even and behind an odd number of quotes, and
    pairs are braces of one kind. One pass over the tokens keeps the open braces of both.
    """
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    gaps = F.split(text, _TOKEN, -1)
    seen = F.arrays_zip(tokens.alias("token"), F.transform(gaps, F.char_length).alias("gap"))
    # There is one gap more than tokens; it stands behind the last.
    seen = F.slice(seen, 1, F.size(tokens))
    none = F.array().cast("array<int>")
    begin = F.struct(
        F.lit(0).alias("at"), F.lit(False).alias("odd"), none.alias("even_open"), none.alias("odd_open"),
        F.array().cast(_SPANS).alias("spans"),
    )

    def step(state: Column, t: Column) -> Column:
        here, odd = state["at"] + t["gap"], state["odd"]
        token, own = t["token"], F.when(odd, state["odd_open"]).otherwise(state["even_open"])
        pushed = F.when(token == "{", F.concat(F.array(here), own))
        popped = F.when((token == "}") & (F.size(own) > 0), F.slice(own, 2, F.size(own)))
        after = F.coalesce(pushed, popped, own)
        span = F.struct(F.get(own, F.lit(0)).alias("start"), (here + 1).alias("end"))
        return F.struct(
            (here + F.char_length(token)).alias("at"),
            (odd != (token == F.lit('"'))).alias("odd"),
            F.when(odd, state["even_open"]).otherwise(after).alias("even_open"),
            F.when(odd, after).otherwise(state["odd_open"]).alias("odd_open"),
            F.when(popped.isNotNull(), F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return F.array_sort(F.aggregate(seen, begin, step, lambda s: s["spans"]))


def text_streams(text: Column) -> Column:
    """The first non-empty stream statistics, as JSON, among the objects within a text, or null.

    An object that encloses another begins before it, so the order of the starts is that of
    a search from the outside in. Texts that don't name such statistics are not taken apart.
    """
    named = "|".join(_STREAM_KEYS)
    objects = F.transform(json_spans(text), lambda s: F.substring(text, s["start"] + 1, s["end"] - s["start"]))
    objects = F.filter(objects, lambda o: o.rlike(f'"(?:{named})"'))
    strict = {"allowSingleQuotes": "false"}
    parsed = F.transform(objects, lambda o: F.from_json(o, _struct(", ".join(f"{k}:string" for k in _STREAM_KEYS)), strict))
    found = F.filter(F.transform(parsed, _stream_text), lambda t: _streams(t).isNotNull())
    return F.when(text.rlike(named), F.get(found, F.lit(0)))


def log_facts(logs: DataFrame, batch: str, text: str, order: Sequence[str] = ()) -> DataFrame:
    """Per batch: each text metric, the one that counts, rows and summary of the streams.

    One scan: every text yields its metrics, reported streams and JSON statistics as rows that are
    combined before the shuffle. Statistics in JSON come before reports in words; of several
    texts the first by ``order``, then by content, has the say. An object that is spread over
    several rows of the logs is not put together.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.lit(None).cast("bigint")

    def fact(kind: str, name: Column, n: Column = none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"), n.cast("bigint").alias("n"))

    # What a pattern needs in any case spares most texts the search.
    low = F.lower(body)
    needs = {name: low.contains("finished insert of" if name == "rows_inserted" else "record") for name in TEXT_METRICS}
    metrics = [fact("metric", F.lit(name), F.when(needs[name], _largest(body, p))) for name, p in TEXT_METRICS.items()]
    reported = F.when(low.contains("record"), F.transform(_reported(body), lambda h: fact("stream", h["stream_name"], h["row_count"])))
    place = [F.coalesce(F.lpad(F.col(c).cast("string"), 40, " "), F.lit("~")) for c in order]
    streams = text_streams(body)
    held = F.when(streams.isNotNull(), F.concat(*place, F.lit("\n"), streams))
    facts = F.concat(
        F.filter(F.array(*metrics), lambda f: f["n"].isNotNull()),
        F.coalesce(reported, F.array().cast("array<struct<kind:string,name:string,n:bigint>>")),
        F.array(fact("object", held)),
    )
    rows = logs.select(batch, F.explode(facts).alias("fact")).select(batch, "fact.*")
    # Few rows are left for each batch: a metric or stream each, and texts with an object.
    rows = rows.groupBy(batch, "kind", "name").agg(F.max("n").alias("n"))

    def metric(name: str) -> Column:
        return F.max(F.when((F.col("kind") == "metric") & (F.col("name") == name), F.col("n"))).alias(name)

    found = rows.groupBy(batch).agg(
        *[metric(name) for name in TEXT_METRICS],
        F.sum(F.when(F.col("kind") == "stream", F.col("n"))).alias("__reported"),
        F.min(F.when(F.col("kind") == "object", F.col("name"))).alias("__object"),
    )
    streams = _streams(F.expr("substring(__object, instr(__object, '\\n') + 1)"))
    found = _chosen_text_metric(found.withColumn("__streams", streams))
    total = F.when(F.col("__object").isNull(), F.col("__reported")).otherwise(_stream_total(F.col("__streams")))
    columns = [batch, *TEXT_METRICS, "text_metric", "rows_from_text"]
    return found.select(*columns, total.alias("rows_text_streams"), _stream_summary(F.col("__streams")).alias("text_stream_summary"))


def _stats(*names: str) -> str:
    # As text: a count may be quoted.
    return ", ".join(f"{n}:string" for n in names)


_ALL_METRICS = f"struct<{_stats(*STREAM_METRIC_ORDER)}>"
# Metrics that make an object the statistics of a sync.
_SYNC_METRICS = (*_SYNCED, *_COMMITTED, *_EMITTED, *_EXTRACTED)
_STREAM_KEYS = (
    "streamStats", "stream_stats", "streamStatuses", "stream_statuses", "streamStatus",
    "stream_status",
)
# An object of a payload; nested text stays JSON until its shape is known.
_LEVEL = (
    f"{_stats(*STREAM_METRIC_ORDER)}, totalStats:{_ALL_METRICS}, total_stats:{_ALL_METRICS}, "
    + ", ".join(f"{k}:string" for k in (*_STREAM_KEYS, "status", "job", "attempts", "attempt"))
)
_DESCRIPTOR = "struct<name:string, streamName:string, stream_name:string>"
_STREAM = (
    f"{_stats(*STREAM_METRIC_ORDER)}, streamName:string, stream_name:string, name:string, "
    f"streamDescriptor:{_DESCRIPTOR}, stream_descriptor:{_DESCRIPTOR}, stats:{_ALL_METRICS}"
)


def _struct(fields: str) -> str:
    return f"struct<{fields}>"


def _is_object(json: Column) -> Column:
    return F.coalesce(json.startswith("{"), F.lit(False))


def _objects(json: Column) -> Column:
    """The objects of a JSON list, or the one object in place of a list."""
    none = F.array().cast("array<string>")
    listed = F.filter(F.from_json(json, "array<string>"), _is_object)
    return F.when(json.startswith("["), listed).when(_is_object(json), F.array(json)).otherwise(none)


def _parsed(json: Column) -> Column:
    """An object of a payload, or null."""
    return F.when(_is_object(json), F.from_json(json, _struct(_LEVEL)))


def _ended(attempt: Column) -> Column:
    status = F.coalesce(attempt["status"], F.get_json_object(attempt["attempt"], "$.status"))
    return F.coalesce(F.lower(F.trim(status)).isin(TERMINAL_STATES), F.lit(False))


def _stream_text(level: Column) -> Column:
    """Text that can hold a stream; it is taken apart once, when the first is known."""
    return F.coalesce(*[F.when(level[k].rlike(r"^\[.*\{|^\{.+:"), level[k]) for k in _STREAM_KEYS])


def _streams(json: Column) -> Column:
    """(name, stream) for each stream of a list, of one stream, or of a map by name."""
    one = F.lit(None).cast("string")
    nothing = F.lit(None).cast(f"array<struct<name:string, stream:{_struct(_STREAM)}>>")

    def parsed(name: Column, text: Column) -> Column:
        return F.struct(name.alias("name"), F.from_json(text, _struct(_STREAM)).alias("stream"))

    single = F.lit(False)
    for key in ("streamName", "stream_name", "streamDescriptor", "stats"):
        single = single | F.get_json_object(json, f"$.{key}").isNotNull()
    by_name = F.filter(
        F.map_entries(F.from_json(json, "map<string,string>")), lambda e: _is_object(e["value"])
    )
    found = (
        F.when(json.startswith("["), F.transform(_objects(json), lambda t: parsed(one, t)))
        .when(_is_object(json) & single, F.array(parsed(one, json)))
        .when(_is_object(json), F.transform(by_name, lambda e: parsed(e["key"], e["value"])))
    )
    return F.when(F.size(found) > 0, found).otherwise(nothing)


def _metric(item: Column, names: Sequence[str]) -> Column:
    stream = item["stream"]
    return F.coalesce(*[F.coalesce(stream["stats"][n], stream[n]).try_cast("bigint") for n in names])


def _stream_total(streams: Column) -> Column:
    known = F.filter(F.transform(streams, lambda s: _metric(s, STREAM_METRIC_ORDER)), lambda v: v.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast("bigint"), lambda a, b: a + b))


def _stream_summary(streams: Column) -> Column:
    def described(item: Column) -> Column:
        stream = item["stream"]
        label = F.coalesce(stream["streamDescriptor"], stream["stream_descriptor"])
        name = F.when(
            label.isNotNull(), F.coalesce(label["name"], label["streamName"], label["stream_name"])
        ).otherwise(F.coalesce(stream["streamName"], stream["stream_name"], stream["name"], item["name"]))
        return F.concat(name, F.lit("="), _metric(item, STREAM_SUMMARY_ORDER).cast("string"))

    return F.nullif(F.array_join(F.transform(streams, described), ", "), F.lit(""))


def payload_stats(payloads: DataFrame, batch: str, payload: str) -> DataFrame:
    """Metrics, totals and stream sums of the last finished attempt in each sync payload.

    Attempts may lie below a job, be one object or wrap their content. What an attempt lacks
    is taken from the job, or from the payload if there is no job. Metrics may stand on the
    object itself or in its totals; streams may be a list, one stream or a map by name, with
    the metrics in their stats or beside them; names come in two spellings.
    """
    text = F.regexp_replace(payload, r"^\s+", "")
    rows = payloads.select(F.col(batch), _parsed(text).alias("__top"))
    rows = rows.withColumn("__job", F.coalesce(_parsed(F.col("__top.job")), F.col("__top")))
    rows = rows.withColumn("__attempts", F.transform(_objects(F.col("__job.attempts")), _parsed))
    attempts = F.col("__attempts")
    last = F.coalesce(
        F.try_element_at(F.filter(attempts, _ended), F.lit(-1)),
        F.try_element_at(attempts, F.lit(-1)),
        _parsed(F.col("__job.attempt")),
    )
    rows = rows.withColumn("__last", last)
    levels = F.array(F.col("__last"), _parsed(F.col("__last.attempt")), F.col("__job"), _parsed(F.col("__job.attempt")))
    rows = rows.withColumn("__levels", F.filter(levels, lambda v: v.isNotNull()))

    def first(make) -> Column:
        found = F.transform("__levels", make)
        return F.get(F.filter(found, lambda v: v.isNotNull()), F.lit(0))

    def sync(level: Column) -> Column:
        held = F.coalesce(*[level[m] for m in _SYNC_METRICS]).isNotNull()
        return F.when(held, F.struct(*[level[m].alias(m) for m in STREAM_METRIC_ORDER]))

    rows = rows.withColumns(
        {
            "__sync": first(sync),
            "__totals": first(lambda v: F.coalesce(v["totalStats"], v["total_stats"])),
            "__stream_text": first(_stream_text),
        }
    )
    rows = rows.withColumn("__streams", _streams(F.col("__stream_text")))

    def total(own: Sequence[str], *more: str) -> Column:
        names = [F.col(f"__sync.{n}") for n in own] + [F.col(f"__totals.{n}") for n in (*own, *more)]
        return F.coalesce(*names).try_cast("bigint")

    return rows.select(
        batch,
        F.col("__totals").isNotNull().alias("has_totals"),
        total(_SYNCED, *_LOADED).alias("rows_synced"),
        total(_COMMITTED).alias("rows_committed"),
        total(_EMITTED).alias("rows_emitted"),
        total(_EXTRACTED).alias("rows_extracted"),
        _stream_total(F.col("__streams")).alias("rows_stream_stats_total"),
        _stream_summary(F.col("__streams")).alias("stream_stats_summary"),
    )


def chosen_metric(stats: DataFrame) -> DataFrame:
    """Add rows_processed and the metric it came from, by fixed priority.

    Expects the columns of ``payload_stats`` plus text_metric and rows_from_text. A text
    metric above zero replaces a zero.
    """
    candidates = [
        ("records_synced", F.col("rows_synced")),
        ("records_committed", F.col("rows_committed")),
        ("records_emitted", F.col("rows_emitted")),
        ("records_extracted", F.col("rows_extracted")),
        ("stream_stats_total", F.col("rows_stream_stats_total")),
    ]
    streams_only = F.col("rows_stream_stats_total").isNotNull() & ~F.coalesce(
        "has_totals", F.lit(False)
    )
    value = F.when(streams_only, F.col("rows_stream_stats_total"))
    source = F.when(streams_only, F.lit("stream_stats_total"))
    for name, column in candidates:
        value = value.when(column.isNotNull(), column)
        source = source.when(column.isNotNull(), F.lit(name))
    value = value.otherwise(F.col("rows_from_text"))
    source = source.otherwise(F.col("text_metric"))
    by_text = F.coalesce((F.col("__rows") == 0) & (F.col("rows_from_text") > 0), F.lit(False))
    return (
        stats.withColumn("__rows", value)
        .withColumn("__source", source)
        .withColumn("rows_processed", F.when(by_text, F.col("rows_from_text")).otherwise(F.col("__rows")))
        .withColumn(
            "rows_metric_source", F.when(by_text, F.col("text_metric")).otherwise(F.col("__source"))
        )
        .drop("__rows", "__source")
    )


def sync_log_stats(payloads: DataFrame, logs: DataFrame, batch: str, payload: str, text: str, order: Sequence[str] = ()) -> DataFrame:
    """Row counts per sync batch from its payload, its log texts, or both."""
    joined = payload_stats(payloads, batch, payload).join(log_facts(logs, batch, text, order), batch, "full_outer")
    own = F.col("rows_stream_stats_total")
    # The texts are asked where the payload holds no streams at all.
    silent = own.isNull() & F.col("stream_stats_summary").isNull()
    total = F.when(silent, F.col("rows_text_streams")).otherwise(own)
    summary = F.when(silent, F.col("text_stream_summary")).otherwise(F.col("stream_stats_summary"))
    joined = joined.withColumns({"rows_stream_stats_total": total, "stream_stats_summary": summary})
    return chosen_metric(joined).drop("rows_text_streams", "text_stream_summary")
