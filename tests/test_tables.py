import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.session import work_folder
from tidemark.sources import tables
from tidemark.sources.tables import AppendTable, KeyedTable
from tidemark.spec import struct_type


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark):
    return KeyedTable(spark, work_folder(spark, "keyed"), ["k"], 4)


def numbers(spark, start, end, **extra):
    df = spark.range(start, end).select(F.col("id").alias("k"))
    return df.withColumns({n: F.lit(v) for n, v in extra.items()})


def test_merge_replaces_and_adds(spark, table):
    assert not table.exists()
    assert table.merge(numbers(spark, 0, 100, v="a")) == 100
    assert table.merge(numbers(spark, 95, 110, v="b")) == 15
    assert rows(table.read().groupBy("v").count()) == [("a", 95), ("b", 15)]
    assert table.rows() == 110


def test_merge_leaves_untouched_files_alone(spark, table):
    table.merge(numbers(spark, 0, 100, v="a"))
    before = set(table.listing().folders)
    table.merge(numbers(spark, 7, 8, v="b"))
    after = set(table.listing().folders)
    assert len(before) == 4 and len(before & after) == 3 and len(after) == 5
    assert table.rows() == 100


def test_clustered_keys_leave_most_files_in_place(spark):
    table = KeyedTable(spark, work_folder(spark, "clustered"), ["a", "k"], 100)
    rows = numbers(spark, 0, 10_000, v="a").withColumn("a", F.format_string("g%05d", F.floor(F.col("k") / 7)))
    table.merge(rows)
    before = set(table.listing().folders)
    assert len(before) == 100
    changed = rows.filter("k BETWEEN 5000 AND 5099").withColumn("v", F.lit("b"))
    assert table.merge(changed) == 100
    kept = before & set(table.listing().folders)
    assert len(kept) >= 97
    assert rows_of(table) == [("a", 9900), ("b", 100)]
    # New keys touch no file at all.
    before = set(table.listing().folders)
    table.merge(changed.withColumn("k", F.col("k") + 20_000))
    assert before < set(table.listing().folders) and table.rows() == 10_100


def rows_of(table):
    return rows(table.read().groupBy("v").count())


@pytest.mark.parametrize("key_bytes", [0, 1 << 20])
@pytest.mark.parametrize("kind", ["bigint", "string", "decimal(38,0)", "double", "binary", "date"])
def test_files_are_found_for_keys_of_any_type(spark, kind, key_bytes, monkeypatch):
    monkeypatch.setattr(tables, "KEY_BYTES", key_bytes)
    table = KeyedTable(spark, work_folder(spark, "typed"), ["k"], 5)

    def typed(start, end, v):
        ids = spark.range(start, end)
        key = {"binary": F.col("id").cast("string").cast("binary"), "date": F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int"))}
        return ids.select(key.get(kind, F.col("id").cast(kind)).alias("k"), F.lit(v).alias("v"))

    table.merge(typed(0, 60, "a"))
    assert len(table.listing().folders) == 5
    table.merge(typed(58, 63, "b").union(typed(1, 2, "b")))
    assert rows_of(table) == [("a", 57), ("b", 6)]
    wanted = typed(3, 5, "c")
    assert table.matching(wanted.select("k")).join(wanted, "k").count() == 2


def test_rewritten_files_keep_their_ranges(spark, monkeypatch):
    """What is left of a file is written without a shuffle, still in order."""
    monkeypatch.setattr(tables, "MANY_SMALL", 1000)
    table = KeyedTable(spark, work_folder(spark, "ranges"), ["k"], 10)
    table.merge(numbers(spark, 0, 10_000, v="a"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(256 << 20))  # a task for each file
    try:
        table.merge(numbers(spark, 0, 10_000, v="b").filter("k % 500 = 7"))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows_of(table) == [("a", 9980), ("b", 20)]
    bounds = table.read().filter("v = 'a'").groupBy(F.col("_metadata.file_name")).agg(F.min("k"), F.max("k"))
    spans = sorted((r[1], r[2]) for r in bounds.collect())
    assert len(spans) == 10 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_small_files_are_put_together(spark, monkeypatch):
    monkeypatch.setattr(tables, "MANY_SMALL", 4)
    table = KeyedTable(spark, work_folder(spark, "small"), ["k"])
    for n in range(12):
        table.merge(numbers(spark, 10 * n, 10 * n + 11, v=str(n)))
        assert len(table.listing().folders) <= 6
    assert table.rows() == 121 and len(rows_of(table)) == 12


def test_days_drop_without_a_rewrite(spark):
    table = KeyedTable(spark, work_folder(spark, "days"), ["k"], day_column="t")
    day = F.when(F.col("k") < 90, F.expr("timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, k % 3)"))
    table.merge(numbers(spark, 0, 100, v="a").withColumn("t", day))
    # A changed row moves to the file of its new day.
    table.merge(numbers(spark, 0, 10, v="b").withColumn("t", F.lit(datetime(2024, 1, 9)).cast("timestamp_ntz")))
    by_day = {f.split("_day=")[1].split("/")[0] for f in table.listing().folders}
    assert by_day == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-09", "__HIVE_DEFAULT_PARTITION__"}
    before = set(table.listing().folders)
    assert table.drop_days_before(date(2024, 1, 3)) == 53
    left = set(table.listing().folders)
    assert left == {f for f in before if "=2024-01-01" not in f and "=2024-01-02" not in f}
    assert rows_of(table) == [("a", 37), ("b", 10)] and table.drop_days_before(date(2024, 1, 3)) == 0
    assert table.read().columns == ["k", "v", "t"]


def test_a_reader_keeps_its_version(spark, table):
    table.merge(numbers(spark, 0, 10, v="a"))
    old = table.read()
    table.merge(numbers(spark, 0, 10, v="b"))
    assert rows(old.select("v").distinct()) == [("a",)]


def test_schema_follows_the_changes(spark, table):
    table.merge(numbers(spark, 0, 20, gone="x", v="a"))
    table.merge(numbers(spark, 19, 21, v="b", extra=5))
    assert table.read().columns == ["k", "v", "extra"]
    assert rows(table.read().groupBy("v", "extra").count()) == [("a", None, 19), ("b", 5, 2)]


def test_a_changed_type_rewrites_all_files(spark, table):
    table.merge(numbers(spark, 0, 20, v=1))
    table.merge(numbers(spark, 0, 1, v="x"))
    assert rows(table.read().groupBy("v").count()) == [("1", 19), ("x", 1)]


def test_empty_merge(spark, table):
    assert table.merge(numbers(spark, 0, 0, v="a")) == 0
    assert table.read().count() == 0
    table.merge(numbers(spark, 0, 5, v="a"))
    assert table.merge(numbers(spark, 0, 0, v="a")) == 0
    assert table.rows() == 5


def test_replayed_batch_is_skipped(spark, table):
    table.merge(numbers(spark, 0, 5, v="a"), "stream", "1")
    assert table.merge(numbers(spark, 0, 5, v="b"), "stream", "1") == 0
    assert table.merge(numbers(spark, 0, 5, v="c"), "stream", "2") == 5


def test_delete_keeps_undecided_rows(spark, table):
    df = numbers(spark, 0, 10).withColumn("n", F.when(F.col("k") > 2, F.col("k")))
    table.merge(df)
    assert table.delete(F.col("n") < 6) == 3
    assert table.delete(F.col("n") < 6) == 0
    assert sorted(r["k"] for r in table.read().collect()) == [0, 1, 2, 6, 7, 8, 9]


def test_overwrite_and_clear(spark, table):
    table.merge(numbers(spark, 0, 10, v="a"))
    table.overwrite(numbers(spark, 0, 3, v="b"))
    assert table.rows() == 3
    assert table.clear() == 3 and table.rows() == 0 and table.clear() == 0


def test_a_second_writer_is_refused(spark, table):
    table.merge(numbers(spark, 0, 5, v="a"))
    stale = table.listing()
    table.merge(numbers(spark, 0, 5, v="b"))
    with pytest.raises(RuntimeError):
        table._publish(stale)
    assert rows(table.read().select("v").distinct()) == [("b",)]


@pytest.mark.parametrize("few", [0, 1000])
def test_matching_holds_all_rows_with_arriving_keys(spark, table, few, monkeypatch):
    monkeypatch.setattr(tables, "KEY_BYTES", few)
    monkeypatch.setattr(tables, "SMALL_TABLE_BYTES", 0)
    table.merge(numbers(spark, 0, 100, v="a"))
    wanted = numbers(spark, 40, 42)
    found = table.matching(wanted)
    assert found.join(wanted, "k").count() == 2 and found.count() < 100
    assert table.matching(numbers(spark, 0, 0)).count() == 0


def test_highest_values_are_kept_with_the_table(spark, table):
    assert table.highest("k") is None
    record = {"k": F.max("k"), "t": F.max("t")}
    for top, day in ((10, 5), (8, 7)):
        df = numbers(spark, 0, top).withColumn("t", F.lit(datetime(2024, 1, day)).cast("timestamp_ntz"))
        table.merge(df, highest=record)
    assert table.highest("k") == 9 and table.highest("t") == datetime(2024, 1, 7)


def test_the_least_number_of_files_is_fixed_by_the_first_write(spark, table):
    table.merge(numbers(spark, 0, 50, v="a"))
    other = KeyedTable(spark, table.root, ["k"], 16)
    other.overwrite(numbers(spark, 0, 50, v="b"))
    assert other.rows() == 50 and len(other.listing().folders) == 4


def test_missing_table(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()


SCHEMA = struct_type({"id": "bigint", "t": "timestamp_ntz", "v": "string"})


def test_append_and_drop_days(spark):
    log = AppendTable(spark, work_folder(spark, "log"), "t")
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 5), "a"), (2, datetime(2024, 1, 2), "b"), (3, None, "c")], SCHEMA
    )
    assert log.append(df) == 3
    assert log.drop_days_before(date(2024, 1, 2)) == 1
    assert sorted(r["v"] for r in log.read().collect()) == ["b", "c"]
    assert log.drop_days_before(date(2024, 1, 2)) == 0


def test_append_rows_numbers_on(spark):
    log = AppendTable(spark, work_folder(spark, "log"), "t")
    for day in (1, 2):
        at = datetime(2024, 1, day)
        log.append_rows([{"t": at, "v": "x"}, {"t": at, "v": "y"}], SCHEMA, "id")
    assert rows(log.read().select("id", "v")) == [(1, "x"), (2, "y"), (3, "x"), (4, "y")]
    log.drop_days_before(date(2024, 1, 3))
    log.append_rows([{"t": datetime(2024, 1, 3), "v": "z"}], SCHEMA, "id")
    assert rows(log.read().select("id")) == [(5,)]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from tidemark import session

    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError):
        session.shared_folder(Fake())


def test_files_follow_the_size_of_the_rows(spark, folder, monkeypatch):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    assert tables.input_bytes(lines) > 0
    assert tables.input_bytes(spark.createDataFrame([(1,)], "k int").repartition(2)) < 1 << 60
    monkeypatch.setattr(tables, "FILE_BYTES", tables.input_bytes(lines) // 20)
    sized = KeyedTable(spark, work_folder(spark, "sized"), ["l_orderkey", "l_linenumber"])
    sized.merge(lines.dropDuplicates(["l_orderkey", "l_linenumber"]))
    assert 15 <= len(sized.listing().folders) <= 40
    bounds = sized.read().groupBy(F.col("_metadata.file_name")).agg(F.min("l_orderkey"), F.max("l_orderkey"))
    spans = sorted((r[1], r[2]) for r in bounds.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_files_of_rows_that_compress_well_fit_a_sort(spark, monkeypatch):
    """Equal texts take next to nothing on disk; the rows of a file still have to be sorted in one task."""
    monkeypatch.setattr(tables, "SORT_BYTES", 4 << 20, raising=False)
    table = KeyedTable(spark, work_folder(spark, "dense"), ["k"], 2)
    table.merge(numbers(spark, 0, 50_000, v="x" * 1000))
    before = table.listing().folders
    assert 12 <= len(before) <= 16 and sum(before.values()) < 4 << 20
    most = table.read().groupBy(F.col("_metadata.file_name")).count().agg(F.max("count")).first()[0]
    assert most < 8_000
    # They are full, so later merges leave them alone.
    monkeypatch.setattr(tables, "MANY_SMALL", 4)
    table.merge(numbers(spark, 50_000, 50_001, v="y"))
    assert set(before) < set(table.listing().folders) and table.rows() == 50_001


def shuffles_on_disk(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def test_a_stored_write_leaves_no_shuffle_on_disk(spark, table):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept, before = spark.conf.get(setting), shuffles_on_disk(spark)
    table.merge(spark.range(1000).groupBy((F.col("id") % 500).alias("k")).agg(F.max("id").alias("v")))
    assert table.rows() == 500 and spark.conf.get(setting) == kept
    # Those of three counts may stay, with a row for each task; those of the rows are removed in the background.
    most, end = 3, time.time() + 10
    while len(left := shuffles_on_disk(spark) - before) > most and time.time() < end:
        time.sleep(0.2)
    assert len(left) <= most


def test_stored_files_are_compact(spark, table):
    table.merge(numbers(spark, 0, 20_000).withColumn("v", F.concat(F.lit("farm "), "k")))
    plain = f"{table.root}-plain"
    table.read().repartitionByRange(4, "k").sortWithinPartitions("k").write.option("compression", "snappy").parquet(plain)
    usual = spark.read.format("binaryFile").load(f"{plain}/*.parquet").agg(F.sum("length")).first()[0]
    assert len(table.listing().folders) == 4 and sum(table.listing().folders.values()) < 0.85 * usual


def test_many_changes_are_stored_slice_by_slice(spark, monkeypatch):
    """Each row is in one slice, those with nulls in the key and repeated keys too."""
    root = work_folder(spark, "sliced")
    keys = "if(id % 7 = 0, null, id % 40) AS a", "if(id % 11 = 0, null, 'k' || id % 300) AS b"
    spark.range(3000).selectExpr(*keys, "id AS v").write.parquet(f"{root}/source")
    changes = spark.read.parquet(f"{root}/source")
    made = []

    def make(cuts):
        made.append([rows(changes.filter(c)) for c in cuts])
        return [changes.filter(c) for c in cuts]

    for small, n in ((1 << 30, 0), (4000, 1)):
        monkeypatch.setattr(tables, "FILE_BYTES", small)
        monkeypatch.setattr(tables, "SLICE_BYTES", small)
        monkeypatch.setattr(tables, "SAMPLED_OF", 2)
        table = KeyedTable(spark, f"{root}/{n}", ["a", "b"])
        assert table.merge(changes, slices=tables.Slices(changes, make)) == 3000
        assert rows(table.read()) == rows(changes) and len(made) == n
    parts = made[0]
    assert 3 <= len(parts) <= tables.MOST_SLICES and sum(map(len, parts)) == 3000
    assert max(map(len, parts)) < 1500
    order = [sorted((r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "") for r in p) for p in parts]
    assert all(a[-1] < b[0] for a, b in zip(order, order[1:]))


def test_memory_of_rows_counts_their_values(spark):
    rows = numbers(spark, 0, 1000, v="x" * 1000, d=True).withColumn("a", F.array(F.lit("y" * 500)))
    rows = rows.withColumn("a.b`c", F.lit(None).cast("string"))
    assert 1_500_000 <= tables.memory_bytes(rows) <= 1_700_000
    assert tables.memory_bytes(rows.limit(0)) == 0


def test_a_local_session_without_the_setting_gets_a_folder(spark):
    from tidemark import session

    class Conf:
        def get(self, *_):
            return None

    class Local:
        conf = Conf()
        sparkContext = spark.sparkContext

    assert session.shared_folder(Local()) == session.shared_folder(Local())


def test_vacuum_keeps_what_is_in_force(spark, table):
    for text in "abc":
        table.merge(numbers(spark, 0, 20, v=text))
    assert table.vacuum(datetime(2000, 1, 1)) == 0
    assert table.vacuum(datetime(2100, 1, 1)) > 0
    assert rows(table.read().groupBy("v").count()) == [("c", 20)]
    assert table.vacuum(datetime(2100, 1, 1)) == 0


def test_old_listings_are_dropped(spark, table, monkeypatch):
    import os

    monkeypatch.setattr(tables, "KEPT_LISTINGS", 2)
    for text in "abcd":
        table.merge(numbers(spark, 0, 2, v=text))
    names = [n for n in os.listdir(f"{table.root}/_published") if n.endswith(".json") and n[0] != "."]
    assert sorted(names) == ["0000000003.json", "0000000004.json"]
    assert rows(table.read().select("v").distinct()) == [("d",)]
