"""Conditions that have no meaning for one row, and merges that would break the key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keytide import KeyedTable
from keytide.spec import TableError


@pytest.fixture
def t(spark, root):
    df = spark.range(60).selectExpr("cast(id % 5 as int) p", "cast(id as int) k", "cast(id as int) v")
    return KeyedTable.create(spark, root, df, range_cols=["p"], keys=["k"], buckets=2, unique_keys=True)


RANDOM = ["rand(7) < 0.5", "p = 1 and rand(3) < 2", "rand(7) < 2 and p < 5"]


@pytest.mark.parametrize("where", [*RANDOM, "p in (select 1)", "sum(p) > 0"])
def test_odd_conditions_are_refused_and_change_nothing(t, spark, where):
    row = spark.createDataFrame([(1, 1, -1)], "p int, k int, v int")
    before = t.state().log_version
    tries = [
        lambda: t.delete(where), lambda: t.update({"v": "0"}, where), lambda: t.replace_where(row, where),
        lambda: t.upsert(row, where, mode="rewrite"), lambda: t.merge_into(row, [("true", {"v": "s.v"})], where=where),
        lambda: t.drop_partition(where), lambda: t.touched_files(where), lambda: t.compact(where),
        lambda: t.compact_oldest(2, where), lambda: t.publish_partition(where, t.root + "-out"),
    ]
    for i, attempt in enumerate(tries):
        with pytest.raises(TableError):
            attempt()
            pytest.fail(f"try {i} was taken")
    assert t.state().log_version == before


def test_a_random_condition_filters_rows_and_not_partitions(t, spark):
    t.upsert(spark.createDataFrame([(1, 1, -1), (2, 62, -2)], "p int, k int, v int"))
    kept = t.read("rand(7) < 0.5").collect()
    assert 5 < len(kept) < 56 and {r["p"] for r in kept} == set(range(5))
    assert {r["p"] for r in t.read(["p > 2", "rand(7) < 2", F.rand() < 2]).collect()} == {3, 4}


def test_a_merge_keeps_the_key(t, spark, rows):
    source = spark.createDataFrame([(1, 1, 5), (1, 6, 5)], "p int, k int, v int")
    for name in ("k", "K", "`k`", "p"):
        with pytest.raises(TableError, match="key"):
            t.merge_into(source, [("true", {name: "s.v"})])
    t.merge_into(source, [("true", {"v": "s.v"})])
    assert t.read().filter("v = 5").count() == 3 and t.read().select("p", "k").distinct().count() == 60


def test_repeated_new_keys_give_the_same_row_however_they_come(spark, root, frame):
    new = [(1, 100, i) for i in range(20)]
    found = set()
    for i, order in enumerate((new, new[::-1], new[7:] + new[:7])):
        one = KeyedTable.create(spark, f"{root}-{i}", frame([(1, 1, 1)], "p int, k int, v int"), keys=["k"], buckets=1, unique_keys=True)
        one.merge_into(frame(order, "p int, k int, v int").repartition(i + 1), [])
        found.add(tuple(one.read().filter("k = 100").first()))
    assert len(found) == 1
