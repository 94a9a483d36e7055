"""Buckets: merges, joins, compactions and rewrites that leave the base where it lies."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from keytide import KeyedTable
from keytide.operators import table as table_module
from keytide.operators.bucketed import join_tables
from keytide.sources import storage


@pytest.fixture(autouse=True)
def whole_paths_in_plans(spark):
    name = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "4000")
    yield
    spark.conf.set(name, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan()


def lines(df):
    return plan_of(df).toString().splitlines()


def exchanges(df):
    return [x for x in lines(df) if "Exchange " in x]


def exchanged_scans(df, write):
    """Scans of a write that have an exchange above them."""
    found, above = [], []
    for line in lines(df):
        depth = len(line) - len(line.lstrip(" :+-|"))
        above = [a for a in above if a[0] < depth]
        if f"{storage.WRITE}={write}" in line:
            found.append(any("Exchange" in text for _, text in above))
        above.append((depth, line))
    assert found, "the write is not read"
    return sum(found)


def write_of(commit):
    return commit.dir.split("/")[0].removeprefix("__write=")


def filled(spark, root, range_cols=(), n=2000, buckets=5):
    df = spark.range(n).selectExpr("cast(id as int) k", "cast(id % 3 as int) p", "cast(0 as int) v", "nullif(cast(id as string), '') w")
    t = KeyedTable.create(spark, root, df, range_cols=list(range_cols), keys=["k"], buckets=buckets, unique_keys=True)
    return t, {k: (0, str(k)) for k in range(n)}


def changed(t, want, seed=1, rounds=3):
    rnd = random.Random(seed)
    for i in range(1, rounds + 1):
        keys = rnd.sample(range(0, 2600), 300)
        rows = [(k, k % 3, i) for k in keys]
        t.upsert(t.spark.createDataFrame(rows, "k int, p int, v int"))
        for k in keys:
            want[k] = (i, want.get(k, (0, None))[1])


def found(t):
    return {r["k"]: (r["v"], r["w"]) for r in t.read().collect()}


@pytest.mark.parametrize("range_cols", [[], ["p"]])
@pytest.mark.parametrize("smallest", [0, 2**40])
def test_a_merge_moves_the_changes_and_not_the_base(spark, root, monkeypatch, range_cols, smallest):
    monkeypatch.setattr(table_module, "OVERLAY_MIN_BASE", smallest)
    monkeypatch.setattr(table_module, "OVERLAY_ROWS", 0)  # too much to broadcast
    t, want = filled(spark, root, range_cols)
    changed(t, want)
    base = {write_of(p.commits[0]) for p in t.state().live()}
    df = t.read()
    assert not any(exchanged_scans(df, w) for w in base)
    assert found(t) == want and df.count() == len(want)
    t.compact()
    assert exchanges(t.read()) == [] and found(t) == want
    assert {c.clean for p in t.state().live() for c in p.commits} == {True}


@pytest.mark.parametrize("aqe", ["true", "false"])
@pytest.mark.parametrize("vectorized", ["true", "false"])
def test_buckets_agree_in_every_mode(spark, root, aqe, vectorized):
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.parquet.enableVectorizedReader")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectorized)
        t, want = filled(spark, root, ["p"])
        changed(t, want, seed=2)
        assert found(t) == want and t.read().count() == len(want)
        assert t.read().groupBy("p").agg(F.count_distinct("k").alias("n")).agg(F.sum("n")).first()[0] == len(want)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_compaction_in_place_keeps_a_file_per_bucket(spark, root):
    t, want = filled(spark, root)
    before = t.live_files().groupBy("bucket").count().count()
    changed(t, want)
    state = t.state()
    assert t._placed(state.spec, state.live())
    t.compact()
    after = {r["bucket"]: r["count"] for r in t.live_files().groupBy("bucket").count().collect()}
    assert len(after) == before == 5 and set(after.values()) == {1}
    misplaced = t.read().withColumn("b", F.pmod(F.hash("k"), F.lit(5))).withColumn("f", F.col("_metadata.file_name"))
    assert misplaced.filter(F.col("b") != F.regexp_extract("f", r"_([0-9]{5})\.c", 1).cast("int")).count() == 0


@pytest.mark.parametrize("range_cols", [[], ["p"]])
def test_a_rewrite_replaces_buckets_with_matches_only(spark, root, range_cols):
    t, want = filled(spark, root, range_cols, buckets=8)
    changed(t, want)
    t.delete("k = 5")
    want.pop(5)
    assert found(t) == want
    newest = {r["partition"]: r["version"] for r in t.versions().groupBy("partition").agg(F.max("version").alias("version")).collect()}
    touched = [p for p in t.state().live() if any(c.dead for c in p.commits)]
    assert len(touched) == 1 and all(len(c.dead) == 1 for c in touched[0].commits if c.dead)
    new = touched[0].commits[1]
    assert new.clean and new.dead == () and 0 < new.rows < len(want) / (4 if not range_cols else 12)
    t.update({"v": "v + 100"}, "k in (7, 8, 9)")
    for k in (7, 8, 9):
        want[k] = (want[k][0] + 100, want[k][1])
    assert found(t) == want
    changed(t, want, seed=5, rounds=1)  # deltas above layers of clean commits
    assert found(t) == want
    t.delete("w = 'none of them'")
    t.update({"v": "1"}, "k = -4")
    last = t.versions().groupBy("partition").agg(F.max("version").alias("version"))
    again = {r["partition"]: r["version"] for r in last.collect()}
    assert all(again[d] >= v for d, v in newest.items())
    live = t.live_files().agg(F.sum("rows")).first()[0]
    t.compact()
    assert found(t) == want and t.live_files().agg(F.sum("rows")).first()[0] == len(want) <= live
    state = t.state().log_version
    t.delete("k = -1")
    assert t.state().log_version == state  # no match, no version


def test_versions_before_a_rewrite_of_buckets_come_back(spark, root):
    t, want = filled(spark, root, buckets=4)
    first = dict(want)
    t.delete("k % 2 = 0 and k < 10")
    second = {k: v for k, v in want.items() if not (k % 2 == 0 and k < 10)}
    t.update({"w": "'x'"}, "k = 11")
    third = {**second, 11: (0, "x")}
    as_of = lambda v: {r["k"]: (r["v"], r["w"]) for r in t.read_as_of("-5", v).collect()}
    assert (as_of(0), as_of(1), as_of(2)) == (first, second, third)
    t.rollback("-5", 1)
    assert found(t) == second
    assert t.live_files().agg(F.sum("rows")).first()[0] == len(second)
    t.update({"w": "'y'"}, "k = 13")
    assert found(t) == {**second, 13: (0, "y")} and as_of(2) == third
    t.rollback("-5", 0)
    assert found(t) == first and t.live_files().agg(F.sum("rows")).first()[0] == len(first)


def test_an_update_of_the_key_from_a_bucket_is_merged(spark, root):
    t, want = filled(spark, root, n=50, buckets=4)
    t.update({"k": "k + 1000"}, "k in (3, 4)")
    want = {**{k: v for k, v in want.items() if k not in (3, 4)}, 1003: (0, "3"), 1004: (0, "4")}
    assert found(t) == want
    t.update({"k": "7"}, "k = 6")
    want.pop(6)
    want[7] = (0, "6")
    assert found(t) == want
    t.compact()
    assert found(t) == want


def test_replaced_files_have_no_limit_and_follow_versions(spark, root):
    df = spark.range(400).selectExpr("cast(id % 2 as int) p", "cast(id as int) a", "id % 40 as g").repartition(20, "a")
    t = KeyedTable.create(spark, root, df, range_cols=["p"])
    rows = lambda d: sorted((r["p"], r["a"]) for r in d.collect())
    whole = rows(t.read())
    t.delete("a < 100")
    left = [x for x in whole if x[1] >= 100]
    assert rows(t.read()) == left
    t.update({"g": "-1"}, "a = 200")
    assert rows(t.read()) == left and t.read().filter("g = -1").count() == 1
    assert any(c.holes for p in t.state().live() for c in p.commits)
    assert rows(t.read_as_of("p=0", 0)) == [x for x in whole if x[0] == 0]
    t.rollback("p=0", 0)
    assert rows(t.read()) == sorted([x for x in whole if x[0] == 0] + [x for x in left if x[0] == 1])
    t.delete("a = 300 or a = 2")
    assert rows(t.read()) == sorted([x for x in whole if x[0] == 0 and x[1] not in (2, 300)] + [x for x in left if x[0] == 1])
    assert t.live_files().agg(F.sum("rows")).first()[0] == t.read().count()
    t.delete("a = 100000")
    assert not hasattr(table_module, "MAX_SKIPPED_FILES")


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_tables_join_on_their_buckets_without_an_exchange(spark, root, how):
    orders = spark.range(300).selectExpr("cast(id as int) o", "id * 2 as total")
    items = spark.range(900).selectExpr("cast(id % 350 as int) l", "cast(id as int) line", "id as q")
    a = KeyedTable.create(spark, f"{root}/a", orders, keys=["o"], buckets=6, unique_keys=True)
    b = KeyedTable.create(spark, f"{root}/b", items, keys=["l", "line"], buckets=6, bucket_by=["l"], unique_keys=True)
    joined = join_tables(a, b, [("o", "l")], how)
    assert exchanges(joined) == []
    want = orders.join(items, orders["o"] == items["l"], how)
    key = lambda d: sorted(map(str, d.select("o", "total", "l", "line", "q").collect()))
    assert key(joined) == key(want)
    a.upsert(spark.createDataFrame([(5, -1), (1000, -2)], "o int, total long"))
    again = join_tables(a, b, [("o", "l")], how)
    assert again.filter("total = -1").count() == orders.join(items, orders["o"] == items["l"], how).filter("o = 5").count()


def test_unequal_buckets_exchange_one_side(spark, root):
    df = spark.range(500).selectExpr("cast(id as int) k", "id v")
    a = KeyedTable.create(spark, f"{root}/a", df, keys=["k"], buckets=8, unique_keys=True)
    b = KeyedTable.create(spark, f"{root}/b", df.toDF("k2", "v2"), keys=["k2"], buckets=4, unique_keys=True)
    joined = join_tables(a, b, [("k", "k2")])
    assert len(exchanges(joined)) == 1 and joined.count() == 500
    with pytest.raises(ValueError):
        join_tables(a, b, [("v", "v2")])


def test_buckets_are_made_of_keys(spark, root, frame):
    with pytest.raises(table_module.TableError):
        KeyedTable.create(spark, root, frame([(1, 2)], "k int, v int"), keys=["k"], buckets=2, bucket_by=["v"])


def test_large_buckets_are_not_folded_by_one_task_each(spark, root, monkeypatch):
    deltas = [spark.range(n).selectExpr("cast(id as int) k", f"cast(id + {n} as int) v", f"concat('w', {n}) w") for n in (300, 200)]
    t = KeyedTable.define(spark, root, deltas[0].schema, keys=["k"], buckets=2)
    t.bulk_upsert(deltas)
    want = sorted((k, k + (200 if k < 200 else 300), "w200" if k < 200 else "w300") for k in range(300))
    summed = sorted((k, 2 * k + 500 if k < 200 else k + 300) for k in range(300))
    assert not exchanges(t.read())
    monkeypatch.setattr(table_module, "FOLD_BYTES", 0, raising=False)
    assert exchanges(t.read())
    assert sorted(tuple(r) for r in t.read().select("k", "v", "w").collect()) == want
    assert sorted(tuple(r) for r in t.read(ops={"v": "sum"}).select("k", "v").collect()) == summed
