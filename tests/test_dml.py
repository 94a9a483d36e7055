import pytest

from keytide import KeyedTable, TableError
from keytide.plans.dml import conditional_merge, keep_undeleted, updated

KV = "key string, value string"


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_three_valued_delete_and_update(spark, frame, root, rows, keys):
    data = frame([("a", None), ("b", None), ("c", "v"), ("d", "vv")], KV)
    t = KeyedTable.create(spark, root, data, keys=keys, buckets=2 if keys else None, unique_keys=True)
    t.delete("value = null")
    assert t.read().count() == 4
    t.update({"value": "'z'"}, where="value <> 'v'")
    assert rows(t.read(), "key", "value") == [("a", None), ("b", None), ("c", "v"), ("d", "z")]
    t.delete("value <=> null")
    assert rows(t.read(), "key") == [("c",), ("d",)]
    t.delete("key = 'nobody'")
    t.delete()
    assert t.read().count() == 0
    assert t.read().columns == ["key", "value"]


def test_unkeyed_delete_rewrites_only_files_with_matches(spark, frame, root, rows):
    t = KeyedTable.create(spark, root, frame([(1, 1), (1, 2)], "p int, v int"), ["p"])
    t.append(frame([(1, 3), (2, 4)], "p int, v int"))
    before = {r["path"] for r in t.live_files().collect()}
    hits = {(r["path"], r["matches"]) for r in t.touched_files("v = 3").collect()}
    assert len(hits) == 1
    t.delete("v = 3")
    after = {r["path"] for r in t.live_files().collect()}
    assert before - after == {p for p, _ in hits}
    assert rows(t.read(), "p", "v") == [(1, 1), (1, 2), (2, 4)]
    t.update({"v": "v + 10"}, where=["p = 1", "v = 1"])
    assert rows(t.read(), "p", "v") == [(1, 11), (1, 2), (2, 4)]
    assert t.find_orphans().count() == 0


def test_update_may_move_rows_to_another_partition(spark, frame, root, rows):
    t = KeyedTable.create(spark, root, frame([(1, 1, 1), (2, 2, 2)], "p int, k int, v int"), ["p"], ["k"], 1,
                          unique_keys=True)
    t.update({"p": "2"}, where=["p = 1", "k = 1"])
    assert rows(t.read(), "p", "k", "v") == [(2, 1, 1), (2, 2, 2)]


def test_update_is_out_of_order_case_insensitive_and_cast(frame, rows):
    df = frame([(1, 10), (2, 20), (None, 30)], "key int, value int")
    assert rows(updated(df, {"VALUE": "-1", "key": "'100'"})) == [(100, -1)] * 3
    assert rows(updated(df, {"value": "7"}, "key >= 2")) == [(1, 10), (2, 7), (None, 30)]
    with pytest.raises(TableError, match="no column"):
        updated(df, {"nothing": "1"})


NESTED = "a struct<c: struct<d: int, e: string>, g: int>, z int"


def test_nested_update(frame, rows):
    df = frame([({"c": {"d": 1, "e": "x"}, "g": 2}, 3), (None, 4)], NESTED)
    out = updated(df, {"a.c.d": "z", "A.G": "9"}).select("a.c.d", "a.c.e", "a.g", "z")
    assert rows(out) == [(3, "x", 9, 3), (4, None, 9, 4)]
    assert updated(df, {"a.c": "null"}).filter("a.c is null").count() == 2
    for bad in ({"a.c": "null", "a.c.d": "1"}, {"a.c.x": "1"}, {"z.q": "1"}):
        with pytest.raises(TableError):
            updated(df, bad)


def test_delete_keeps_null_conditions(frame, rows):
    df = frame([(1, None), (2, 5), (3, 9)], "k int, v int")
    assert rows(keep_undeleted(df, "v > 6"), "k") == [(1,), (2,)]


def test_conditional_merge_takes_the_first_true_clause(frame, rows):
    t = frame([(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], "k int, n int, s string")
    s = frame([(1, 10, "x"), (2, 20, "null"), (4, 40, "y"), (4, 41, "y")], "k int, n int, s string").filter("n <> 41")
    both = {"n": "t.n + s.n"}
    out = conditional_merge(t, s, ["k"], [("s.s <> 'null'", {**both, "s": "s.s"}), ("s.s = 'null'", both)])
    assert rows(out) == [(1, 11, "x"), (2, 22, "b"), (3, 3, "c"), (4, 40, "y")]
    assert rows(conditional_merge(t, s, ["k"], [("s.n = 10", both)], insert=False)) == [
        (1, 11, "a"), (2, 2, "b"), (3, 3, "c"),
    ]
    twice = s.union(s.filter("k = 1"))
    with pytest.raises(Exception, match="more than one source row"):
        conditional_merge(t, twice, ["k"], [("true", both)]).collect()


def test_conditions_without_row_meaning_are_refused(spark, frame, root):
    t = KeyedTable.create(spark, root, frame([(1, 1)], "k int, v int"), keys=["k"], buckets=1)
    for cond in ("rand() > 0.5 and v = 1", "sum(v) > 1", "nothing = 1"):
        with pytest.raises(TableError):
            t.delete(cond)
    assert t.state().log_version == 0
