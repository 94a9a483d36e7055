from datetime import timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import keytide.operators.table as table_module
from keytide import KeyedTable, TableError
from keytide.sources import storage

F1 = "range int, hash int, value int"


@pytest.fixture
def base(spark, frame, root):
    rows = [(20201101, 1, 1), (20201101, 2, 2), (20201101, 3, 3), (20201102, 4, 4)]
    return KeyedTable.create(spark, root, frame(rows, F1), ["range"], ["hash"], 2, unique_keys=True)


def test_upsert_same_columns(base, frame, rows):
    base.upsert(frame([(20201101, 1, 11), (20201101, 3, 33), (20201101, 4, 44)], F1))
    assert rows(base.read(), "range", "hash", "value") == [
        (20201101, 1, 11), (20201101, 2, 2), (20201101, 3, 33), (20201101, 4, 44), (20201102, 4, 4),
    ]


def test_upsert_partial_columns_needs_schema_merge(base, frame, rows):
    delta = frame([(20201101, 1, 11), (20201101, 3, 33), (20201101, 4, 44)], "range int, hash int, name int")
    with pytest.raises(TableError, match="not in the table"):
        base.upsert(delta)
    base.upsert(delta, merge_schema=True)
    assert rows(base.read(), "range", "hash", "value", "name") == [
        (20201101, 1, 1, 11), (20201101, 2, 2, None), (20201101, 3, 3, 33), (20201101, 4, None, 44),
        (20201102, 4, 4, None),
    ]
    base.compact()
    assert rows(base.read(), "range", "hash", "value", "name")[3] == (20201101, 4, None, 44)


@pytest.mark.parametrize("way", ["full", "hash", "broadcast", "fold"])
def test_value_filters_see_merged_rows_under_every_plan(base, frame, rows, monkeypatch, way):
    monkeypatch.setattr(KeyedTable, "_way", lambda *a: (way, way == "hash"))
    base.upsert(frame([(20201102, 1, 1)], F1))
    base.upsert(frame([(20201102, 4, 5), (20201101, 9, None)], F1))
    want = [(20201101, 1, 1), (20201101, 2, 2), (20201102, 1, 1)]
    assert rows(base.read().filter("value < 3"), "range", "hash", "value") == want
    assert rows(base.read(where=["value < 3", "hash < 2"]), "range", "hash", "value") == [want[0], want[2]]
    assert rows(base.read(where="hash = 9"), "range", "hash", "value") == [(20201101, 9, None)]
    assert base.read().count() == 6


def test_plans_are_chosen_by_logged_sizes(base, frame, monkeypatch):
    base.upsert(frame([(20201101, 1, 11)], F1))
    part = base.state().partitions["range=20201101"]
    spec = base.spec()
    assert [c.rows for c in part.commits] == [3, 1]
    assert base._way(spec, [part], {}) == ("full", True)
    monkeypatch.setattr(table_module, "OVERLAY_MIN_BASE", 0)
    assert base._way(spec, [part], {}) == ("broadcast", True)
    monkeypatch.setattr(table_module, "OVERLAY_ROWS", 0)
    assert base._way(spec, [part], {}) == ("hash", True)
    monkeypatch.setattr(table_module, "MAX_BASES", 0)
    assert base._way(spec, [part], {}) == ("hash", False)
    monkeypatch.setattr(table_module, "HASH_ROWS", 0)
    assert base._way(spec, [part], {}) == ("fold", False)


def test_key_filter_reaches_the_scan_and_compacted_reads_do_not_shuffle(base, frame, monkeypatch):
    base.upsert(frame([(20201101, 1, 11), (20201102, 4, 9)], F1))
    for way in ("hash", "fold", "broadcast"):
        monkeypatch.setattr(KeyedTable, "_way", lambda *a, w=way: (w, w != "fold"))
        plan = base.read().filter("hash = 1")._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert plan.count("EqualTo(hash,1)") >= (1 if way == "fold" else 2), way
    pruned = base.read(where="range = 20201102")._jdf.queryExecution().toString()
    assert "20201101" not in pruned.split("== Physical Plan ==")[1]
    base.compact()
    assert "Exchange" not in base.read()._jdf.queryExecution().toString()


def test_key_alone_moves_a_row_between_values(spark, frame, root, rows):
    t = KeyedTable.create(spark, root, frame([(20201101, 1, 1), (20201102, 4, 4)], F1), keys=["hash"], buckets=1)
    t.upsert(frame([(20201101, 4, 44)], F1))
    assert rows(t.read(), "range", "hash", "value") == [(20201101, 1, 1), (20201101, 4, 44)]


def test_upsert_checks(base, spark, frame, tmp_path):
    with pytest.raises(TableError, match="missing"):
        base.upsert(frame([(1, 1)], "hash int, value int"))
    with pytest.raises(TableError, match="constraint violated: hash"):
        base.upsert(frame([(1, None, 1)], F1))
    plain = KeyedTable.create(spark, str(tmp_path / "plain"), frame([(1, 1, 1)], F1))
    with pytest.raises(TableError, match="hash keys"):
        plain.upsert(frame([(1, 1, 1)], F1))
    with pytest.raises(TableError, match="cannot merge value"):
        base.upsert(frame([(1, 1, 2**40)], "range int, hash int, value bigint"))
    assert base.state().log_version == 0


def test_rewriting_upsert(base, frame, rows):
    delta = frame([(20201101, 1, 11), (20201101, 3, None), (20201102, 7, 7)], F1)
    with pytest.raises(TableError, match="condition over the range columns"):
        base.upsert(delta, mode="rewrite")
    base.upsert(delta, where="range = 20201101", mode="rewrite")
    assert rows(base.read(), "range", "hash", "value") == [
        (20201101, 1, 11), (20201101, 2, 2), (20201101, 3, 3), (20201102, 4, 4),
    ]
    assert [p.version for p in base.state().live()] in ([1, 0], [0, 1])


def test_bulk_upsert_commits_in_list_order_as_one_version(base, frame, rows):
    base.bulk_upsert([
        frame([(20201101, 1, 5), (20201101, 2, 6)], F1),
        frame([(20201101, 1)], "range int, hash int"),
        frame([(20201101, 1, 7)], F1),
    ])
    assert rows(base.read(where="range = 20201101"), "hash", "value") == [(1, 7), (2, 6), (3, 3)]
    assert base.state().log_version == 1
    assert len(base.state().partitions["range=20201101"].commits) == 4


def test_sum_and_concat_through_compaction(spark, frame, root, rows):
    ddl = "range int, hash int, v1 int, v2 string"
    data = frame([(1, 1, 1, "1"), (2, 1, 1, "1"), (3, 1, 1, "1"), (1, 2, 2, "2"), (1, 3, 3, "3")], ddl)
    t = KeyedTable.create(spark, root, data, ["range"], ["hash"], 2, unique_keys=True)
    t.upsert(data)
    ops = {"v1": "sum", "v2": "concat"}
    want = [(1, 1, 2, "1,1"), (1, 2, 4, "2,2"), (1, 3, 6, "3,3"), (2, 1, 2, "1,1"), (3, 1, 2, "1,1")]
    assert rows(t.read(ops=ops), "range", "hash", "v1", "v2") == want
    t.compact(ops=ops)
    assert rows(t.read(), "range", "hash", "v1", "v2") == want
    t.upsert(data.filter("range = 1 and hash = 1"))
    assert rows(t.read(ops=ops).filter("range = 1 and hash = 1"), "v1", "v2") == [(3, "1,1,1")]


def test_compaction_of_one_partition(base, frame, rows):
    base.upsert(frame([(20201101, 1, 11), (20201102, 4, 44)], F1))
    before = rows(base.read(), "range", "hash", "value")
    with pytest.raises(TableError, match="one partition, not 2"):
        base.compact("range = 20201101 or range = 20201102")
    with pytest.raises(TableError, match="not 0"):
        base.compact("range = 1")
    assert base.compact("range = 20201101") == ["range=20201101"]
    depth = {r["partition"]: r["depth"] for r in base.layout_report().groupBy("partition").agg(F.max("depth").alias("depth")).collect()}
    assert depth == {"range=20201101": 1, "range=20201102": 2}
    assert rows(base.read(), "range", "hash", "value") == before
    base.upsert(frame([(20201101, 1, 12)], F1))
    assert rows(base.read(where=["range = 20201101", "hash = 1"]), "value") == [(12,)]


def test_unforced_compaction_and_folding_of_the_oldest(base, frame, rows):
    for i in range(4):
        base.upsert(frame([(20201101, 1, 100 + i)], F1))
    assert base.compact(force=False) == []
    assert base.compact_oldest(3) == ["range=20201101"]
    assert len(base.state().partitions["range=20201101"].commits) == 3
    assert rows(base.read(where="hash = 1"), "value") == [(103,)]
    assert base.compact(force=False, min_deltas=1) == ["range=20201101"]
    assert rows(base.read(), "range", "hash", "value")[0] == (20201101, 1, 103)


def test_folding_the_oldest_of_interleaved_partitions(base, frame, rows):
    base.upsert(frame([(20201102, 4, 40)], F1))
    base.upsert(frame([(20201101, 1, 10)], F1))
    base.upsert(frame([(20201102, 4, 41)], F1))
    base.upsert(frame([(20201101, 1, 11)], F1))
    assert sorted(base.compact_oldest(2)) == ["range=20201101", "range=20201102"]
    assert rows(base.read(), "hash", "value") == [(1, 11), (2, 2), (3, 3), (4, 41)]


def test_time_travel_rollback_and_history(base, frame, rows):
    base.upsert(frame([(20201101, 1, 11)], F1))
    base.compact("range = 20201101")
    base.upsert(frame([(20201101, 1, 12)], F1))
    assert rows(base.read_as_of("range=20201101", 0), "hash", "value")[0] == (1, 1)
    assert rows(base.read_as_of("range=20201101", 1), "hash", "value")[0] == (1, 11)
    base.rollback("range=20201101", 0)
    assert rows(base.read(where="range = 20201101"), "hash", "value") == [(1, 1), (2, 2), (3, 3)]
    assert [r["op"] for r in base.history("range=20201101").collect()] == [
        "append", "merge", "compaction", "merge", "rollback",
    ]
    with pytest.raises(TableError, match="no version 9"):
        base.read_as_of("range=20201101", 9)
    base.upsert(frame([(20201101, 1, 13)], F1))
    assert rows(base.read(where="hash = 1"), "value") == [(13,)]


def _snapshot_paths(t):
    return {r["path"] for r in t.live_files().select("path").collect()}


def test_file_log_follows_the_snapshot(base, spark, frame):
    base.upsert(frame([(20201101, 1, 11)], F1))
    deep = _snapshot_paths(base)
    base.compact()
    flat = _snapshot_paths(base)
    assert not any(p in flat for p in deep if "range=20201101" in p)
    base.rollback("range=20201101", 1)
    assert _snapshot_paths(base) == deep
    base.delete("range = 20201102")
    assert all("range=20201101" in p for p in _snapshot_paths(base))
    assert {r["partition"] for r in base.size_report().collect()} == {"range=20201101"}


def test_orphans_are_files_nobody_logged(base, spark, frame):
    frame([(5, 5)], "a int, b int").coalesce(1).write.parquet(f"{base.root}/data/__write=x/__commit=000000000009-x")
    assert base.find_orphans(timedelta(days=1)).count() == 0
    found = [r["path"] for r in base.find_orphans(timedelta(0)).collect()]
    assert len(found) == 1 and found[0].startswith("__write=x/__commit=000000000009-x/")


def test_orphans_are_removed_by_tasks_and_live_files_stay(base, spark, frame, rows):
    before, live = rows(base.read(), "hash"), _snapshot_paths(base)
    lost = f"{base.root}/data/__write=x/__commit=000000000009-x"
    frame([(i, i) for i in range(8)], "a int, b int").repartition(3, "a").write.partitionBy("a").parquet(lost)
    n = base.find_orphans(timedelta(0)).count()
    assert n >= 8 and base.remove_orphans(timedelta(days=1), dry_run=False).count() == 0
    dry = base.remove_orphans(timedelta(0)).collect()
    assert len(dry) == n and not any(r["removed"] for r in dry) and base.find_orphans(timedelta(0)).count() == n
    done = base.remove_orphans(timedelta(0), dry_run=False)
    assert done.count() == n and all(r["removed"] and r["problem"] is None and r["size"] > 0 for r in done.collect())
    assert base.find_orphans(timedelta(0)).count() == 0
    assert _snapshot_paths(base) == live and rows(base.read(), "hash") == before


def test_a_file_that_cannot_be_removed_is_reported(tmp_path):
    (tmp_path / "folder").mkdir()
    (tmp_path / "file").write_text("x")
    batch = pa.RecordBatch.from_pydict({"path": ["folder", "file", "gone"], "size": [1, 1, 1]})
    (out,) = storage.remover(str(tmp_path))([batch])
    assert out["removed"].to_pylist() == [False, True, True]
    assert out["problem"][0].as_py() and not (tmp_path / "file").exists() and (tmp_path / "folder").exists()


def test_drop_partition(base, rows):
    with pytest.raises(TableError, match="not 2"):
        base.drop_partition("range > 0")
    with pytest.raises(TableError, match="not 0"):
        base.drop_partition("range = 5")
    with pytest.raises(TableError, match="range columns"):
        base.drop_partition("value = 1")
    base.drop_partition("range = 20201102")
    assert rows(base.read(), "hash") == [(1,), (2,), (3,)]


def test_append_overwrite_and_replace(spark, frame, root, rows, base):
    t = KeyedTable.create(spark, f"{root}-plain", frame([(1, "a"), (2, "b")], "id bigint, data string"), ["id"])
    t.append(frame([(1, "c")], "id bigint, data string"))
    assert rows(t.read(), "id", "data") == [(1, "a"), (1, "c"), (2, "b")]
    with pytest.raises(TableError, match="outside"):
        t.replace_where(frame([(1, "x"), (4, "y")], "id bigint, data string"), "id = 1")
    assert t.read().count() == 3
    with pytest.raises(TableError, match="range columns"):
        t.replace_where(frame([(1, "x")], "id bigint, data string"), "data = 'a'")
    t.replace_where(frame([(1, "x")], "id bigint, data string"), "id = 1")
    assert rows(t.read(), "id", "data") == [(1, "x"), (2, "b")]
    t.overwrite(frame([(9, "z")], "id bigint, data string"))
    assert rows(t.read(), "id", "data") == [(9, "z")]
    with pytest.raises(TableError, match="use upsert"):
        base.append(frame([(1, 1, 1)], F1))


def test_save_modes_and_append_only(spark, frame, root):
    df = frame([(1, "a")], "id bigint, data string")
    t = KeyedTable.create(spark, root, df, append_only=True)
    with pytest.raises(TableError, match="exists"):
        KeyedTable.create(spark, root, df)
    KeyedTable.create(spark, root, df.union(df), mode="ignore")
    assert t.read().count() == 1
    for forbidden in (lambda: t.overwrite(df), lambda: t.delete("id = 1"), lambda: t.update({"data": "'x'"})):
        with pytest.raises(TableError, match="append-only"):
            forbidden()


def test_insert_by_position(spark, frame, root, rows):
    t = KeyedTable.define(spark, root, frame([], "id bigint, data string").schema)
    t.insert_by_position(frame([("1", 7)], "data string, id int"))
    assert rows(t.read()) == [(1, "7")]
    with pytest.raises(TableError, match="1 columns for 2"):
        t.insert_by_position(frame([(1,)], "id bigint"))
    extra = frame([(2, "b", "mango")], "id bigint, data string, fruit string")
    with pytest.raises(TableError, match="too many"):
        t.insert_by_position(extra)
    t.insert_by_position(extra, merge_schema=True)
    assert rows(t.read()) == [(1, "7", None), (2, "b", "mango")]


def test_insert_overwrite_static_partition(spark, frame, root, rows):
    ddl = "id bigint, data string, p1 int"
    t = KeyedTable.create(spark, root, frame([(1, "a", 5), (2, "b", 23)], ddl), ["p1"])
    t.insert_overwrite_partition(frame([(3, "c")], "id bigint, data string"), {"p1": 23})
    assert rows(t.read(), "id", "data", "p1") == [(1, "a", 5), (3, "c", 23)]


def test_paths_below_the_root_filter(base, spark, rows):
    assert rows(KeyedTable.read_path(spark, f"{base.root}/range=20201102"), "hash") == [(4,)]
    assert KeyedTable.read_path(spark, base.root).count() == 4
    with pytest.raises(TableError, match="not a table"):
        KeyedTable.for_path(spark, f"{base.root}/nothing")


def test_publish_partition_keeps_other_partitions(spark, frame, root, rows):
    ddl = "date string, id int, name string"
    data = frame([("2021-01-01", 1, "rice"), ("2021-01-01", 2, "bread"), ("2021-01-02", 3, "milk")], ddl)
    t = KeyedTable.create(spark, root, data, ["date"], ["id"], 2, unique_keys=True)
    t.publish_partition("date = '2021-01-02'", f"{root}-out")
    t.publish_partition("date = '2021-01-01'", f"{root}-out")
    t.upsert(frame([("2021-01-01", 1, "corn")], ddl))
    t.publish_partition("date = '2021-01-01'", f"{root}-out")
    out = spark.read.parquet(f"{root}-out").select(F.col("date").cast("string"), "id", "name")
    assert rows(out) == [("2021-01-01", 1, "corn"), ("2021-01-01", 2, "bread"), ("2021-01-02", 3, "milk")]


def test_odd_partition_values(spark, frame, root, rows):
    ddl = "p string, q string, v int"
    data = [("a/b=c%+ d", "01", 1), ("é:*", "x", 2), ("", "y", 3)]
    t = KeyedTable.create(spark, root, frame(data[:2], ddl), ["p", "q"])
    assert rows(t.read(), "p", "q", "v") == sorted(data[:2])
    assert rows(t.read(where="p = 'a/b=c%+ d'"), "v") == [(1,)]
    assert rows(t.read(where="q = '01'"), "v") == [(1,)]
    t.delete(["p = 'a/b=c%+ d'", "v = 1"])
    assert rows(t.read(), "p", "q", "v") == [data[1]]
    assert {r["partition"] for r in t.live_files().collect()} == {"p=é:*,q=x"}
    with pytest.raises(TableError, match="constraint violated: p"):
        t.append(frame([(None, "z", 4)], ddl))


def test_a_taken_version_fails(base, frame):
    stale = base.state()
    base.upsert(frame([(20201101, 1, 11)], F1))
    with pytest.raises(TableError, match="another writer"):
        base.upsert(frame([(20201101, 1, 99)], F1), state=stale)


def test_spec_rules(spark, frame, root):
    df = frame([(1, 2)], "a int, b int")
    for bad in ({"range_cols": ["a"], "keys": ["b"], "buckets": 1}, {"keys": ["a"]}, {"range_cols": ["c"]},
                {"range_cols": ["a"], "keys": ["a"], "buckets": 1}):
        with pytest.raises(TableError):
            KeyedTable.create(spark, root, df, **bad)
    with pytest.raises(TableError, match="more than case"):
        KeyedTable.define(spark, root, df.selectExpr("a", "b as A").schema)


def test_empty_sources(spark, frame, root, rows):
    t = KeyedTable.create(spark, root, frame([], F1), ["range"], ["hash"], 2)
    assert rows(t.read()) == [] and t.read().columns == ["hash", "value", "range"]
    t.upsert(frame([], F1))
    t.delete("value = 1")
    assert t.compact() == [] and t.state().live() == []
    t.upsert(frame([(1, 1, 1)], F1))
    assert rows(t.read()) == [(1, 1, 1)]


def test_a_hot_bucket_is_written_as_several_files(spark, root):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        n = 60_000
        hot = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        t = KeyedTable.create(spark, root, hot, keys=["k"], buckets=4)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = {r["bucket"]: r["files"] for r in t.layout_report().collect()}
    assert len(files) == 4 and max(files.values()) > 1
    assert t.read().count() == n - n // 3 + 1
    assert t.size_report().first()["rows"] == n
