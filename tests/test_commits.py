import pytest
from pyspark.sql import functions as F

from keytide import KeyedTable, TableError
from keytide.functions.columns import parse_partition_desc, partition_desc
from keytide.functions.decode import hex_digits, unscaled_integer
from keytide.sources import log as L


def ranged(spark, frame, root):
    df = spark.range(100).select((F.col("id") % 5).cast("int").alias("p"), F.col("id").cast("int").alias("k"),
                                 F.col("id").cast("int").alias("v"))
    return KeyedTable.create(spark, root, df, range_cols=["p"], keys=["k"], buckets=2, unique_keys=True)


def versions(t):
    return {p.desc: p.version for p in t.state().partitions.values()}


def test_a_losing_writer_leaves_the_log_alone(spark, frame, root, rows):
    t = KeyedTable.create(spark, root, frame([(1, 1)], "k int, v int"), keys=["k"], buckets=1)
    stale = t.state()
    t.upsert(frame([(2, 2)], "k int, v int"))
    before = rows(t.live_files().select("path"))
    with pytest.raises(TableError, match="taken by another writer"):
        t.upsert(frame([(3, 3)], "k int, v int"), state=stale)
    assert rows(t.live_files().select("path")) == before
    assert rows(t.read(), "k") == [(1,), (2,)]
    read = {r["f"].rsplit("/", 1)[1] for r in t.read().select(F.input_file_name().alias("f")).collect() if r["f"]}
    assert read <= {r["path"].rsplit("/", 1)[1] for r in t.live_files().collect()}
    t.upsert(frame([(4, 4)], "k int, v int"))
    assert rows(t.read(), "k") == [(1,), (2,), (4,)]


def test_a_dead_writer_blocks_nobody(spark, frame, root, rows):
    t = KeyedTable.create(spark, root, frame([(1, 1)], "k int, v int"), keys=["k"], buckets=1)
    # what a crash inside a write leaves: an attempt that was never renamed
    spark.range(1).write.parquet(f"{root}/log/attempts/{L.new_attempt()}/_temporary/0")
    t.upsert(frame([(2, 2)], "k int, v int"))
    assert rows(t.read(), "k") == [(1,), (2,)]


def test_one_text_of_and_prunes_like_a_list(spark, frame, root):
    t = ranged(spark, frame, root)
    t.delete("p = 1 and v > 50")
    assert versions(t) == {"p=0": 0, "p=1": 1, "p=2": 0, "p=3": 0, "p=4": 0}
    assert t.read().count() == 90
    t.update({"v": F.lit(0)}, "(p = 2 and (v < 10 or v > 90)) and k >= 0")
    assert versions(t)["p=2"] == 1 and versions(t)["p=3"] == 0
    assert t.read("p = 2 and v = 0").count() == 4


@pytest.mark.parametrize("where", ["random() < 0.5", "rand (7) < 0.5", "k in (select 1)", "uuid() = 'a'", "p = 1 and rand() < 2",
                                   "sum(v) > 1", "exists (select 1)"])
def test_odd_conditions_are_refused_before_anything_is_pruned(spark, frame, root, where):
    t = ranged(spark, frame, root)
    for act in (lambda: t.delete(where), lambda: t.update({"v": F.lit(1)}, where)):
        with pytest.raises(TableError):
            act()
    assert set(versions(t).values()) == {0}


def test_rows_given_the_key_of_another_are_merged(spark, frame, root):
    t = KeyedTable.create(spark, root, frame([(i, i) for i in range(20)], "k int, v int"), keys=["k"], buckets=2, unique_keys=True)
    t.update({"k": F.lit(1)}, "k < 10")
    assert sorted(r["k"] for r in t.read().collect()) == [1, *range(10, 20)]


def test_promises_and_empty_range_values(spark, frame, root):
    with pytest.raises(TableError, match="repeat"):
        KeyedTable.create(spark, root, frame([(1, 1), (1, 2)], "k int, v int"), keys=["k"], buckets=1, unique_keys=True)
    with pytest.raises(TableError, match="empty text"):
        KeyedTable.create(spark, root, frame([("", 1, 1)], "p string, k int, v int"), range_cols=["p"], keys=["k"], buckets=1)
    assert not KeyedTable.exists(spark, root)


def test_descriptors_tell_all_values_apart(spark, frame, root, rows):
    data = [("1,b=2", "3", 1), ("1", "2,b=3", 2), ("x,y", "%2C", 3), ("50%", "a=b", 4)]
    df = frame(data, "a string, b string, v int")
    desc = df.select(partition_desc(["a", "b"]).alias("d"), "a", "b")
    assert desc.select("d").distinct().count() == 4
    back = desc.select(parse_partition_desc(F.col("d")).alias("m"), "a", "b").filter("m['a'] = a and m['b'] = b")
    assert back.count() == 4
    t = KeyedTable.create(spark, root, df, range_cols=["a", "b"])
    assert rows(t.read(), "a", "b", "v") == rows(df, "a", "b", "v")
    assert t.size_report("a = 'x,y'").count() == 1
    t.overwrite(df.filter("v < 3"))
    assert rows(t.read(), "v") == [(1,), (2,)]


def test_decimals_wider_than_declared_fail(spark):
    def value(n, size, precision):
        data = n.to_bytes(size, "big", signed=True)
        return spark.range(1).select(unscaled_integer(hex_digits(F.lit(data), precision), precision).alias("x")).first()["x"]

    assert value(5, 20, 18) == 5 and value(-5, 20, 18) == -5 and value(-(10**30), 20, 38) == -(10**30)
    for n, size, precision in ((2**64 + 5, 9, 18), (-(2**64) - 5, 9, 18), (2**130, 20, 38)):
        with pytest.raises(Exception, match="wider than its precision"):
            value(n, size, precision)


@pytest.mark.parametrize("way", ["fold", "full", "hash", "broadcast"])
def test_every_way_to_merge_gives_the_same_rows(spark, frame, root, rows, monkeypatch, way):
    base = frame([(p, k, k * 10, "x") for p in ("a", "b,=%") for k in range(30)], "p string, k int, v int, w string")
    t = KeyedTable.create(spark, root, base, range_cols=["p"], keys=["k"], buckets=2, unique_keys=True)
    t.upsert(frame([("a", 1, None), ("a", 99, 5), ("b,=%", 2, 7)], "p string, k int, v int"))
    t.upsert(frame([("a", 1, "y"), ("c", 1, "z")], "p string, k int, w string"))
    monkeypatch.setattr(KeyedTable, "_way", lambda *a: (way, way == "hash"))
    got = rows(t.read(), "p", "k", "v", "w")
    assert len(got) == 62
    assert {r for r in got if r[1] in (99, 2) or r[:2] in (("a", 1), ("c", 1))} == {
        ("a", 1, None, "y"), ("a", 99, 5, None), ("a", 2, 20, "x"), ("b,=%", 2, 7, "x"), ("c", 1, None, "z")}
