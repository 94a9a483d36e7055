import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keytide import KeyedTable, Running, TableError, register_merge_op
from keytide.plans import merge as M
from keytide.plans.merge import merge_deltas, premerge, stack


def test_partial_columns_resolve_one_by_one(frame, rows):
    base = frame([(1, 1), (2, 2), (3, 3)], "k int, v int")
    names = frame([(1, "a"), (4, "d")], "k int, n string")
    late = frame([("b", 1)], "n string, k int")
    got = rows(merge_deltas([base, names, late], ["k"]), "k", "v", "n")
    assert got == [(1, 1, "b"), (2, 2, None), (3, 3, None), (4, None, "d")]


def test_explicit_null_overwrites_and_absent_column_does_not(frame, rows):
    base = frame([(1, 1, "x"), (2, 2, "y")], "k int, v int, n string")
    nulls = frame([(1, None)], "k int, n string")
    assert rows(merge_deltas([base, nulls], ["k"]), "k", "v", "n") == [(1, 1, None), (2, 2, "y")]


def test_sum_concat_and_non_null(frame, rows):
    a = frame([(1, 1, "a", "x"), (2, 2, "b", "null"), (3, None, None, None)], "k int, s int, c string, n string")
    b = frame([(1, 10, "c", "null"), (2, None, None, None)], "k int, s int, c string, n string")
    ops = {"s": "sum", "c": "concat", "n": "non_null"}
    assert rows(merge_deltas([a, b], ["k"], ops), "k", "s", "c", "n") == [
        (1, 11, "a,c", "x"), (2, 2, "b", "null"), (3, None, None, None),
    ]
    semi = merge_deltas([a, b], ["k"], {"c": "concat_semicolon"})
    assert rows(semi.filter("k = 1"), "c") == [("a;c",)]


def test_python_fold(frame, rows):
    register_merge_op("joined_up", lambda values: "/".join(v or "-" for v in values))
    a = frame([(1, "a"), (2, None)], "k int, c string")
    b = frame([(1, "b")], "k int, c string")
    c = frame([(1, "c")], "k int, c string")
    assert rows(merge_deltas([a, b, c], ["k"], {"c": "joined_up"})) == [(1, "a/b/c"), (2, "-")]


def spaced_out():
    """Digits of all versions with the number of the step in between: no two pieces can be put together."""
    return Running(lambda: ("", 0), lambda s, v: (f"{s[0]}{s[1]}{v or '-'}", s[1] + 1), lambda s: s[0])


def test_running_folds_see_every_version_in_turn(frame, rows):
    a = frame([(1, "a", "p", 1), (2, None, "q", 2), (None, "n", "r", 3)], "k int, c string, d string, s int")
    b = frame([(1, "b"), (3, "x")], "k int, c string")
    c = frame([(1, 10), (4, 4)], "k int, s int")  # no step for c and d
    e = frame([(1, "z", "w"), (None, "m", None)], "k int, c string, d string")
    got = rows(merge_deltas([a, b, c, e], ["k"], {"c": spaced_out(), "d": spaced_out(), "s": "sum"}), "k", "c", "d", "s")
    assert got == [
        (1, "0a1b2z", "0p1w", 11), (2, "0-", "0q", 2), (3, "0x", None, None), (4, None, None, 4), (None, "0n1m", "0r1-", 3),
    ]
    only = rows(merge_deltas([a.select("k", "c"), b], ["k"], {"c": spaced_out()}))
    assert only == [(1, "0a1b"), (2, "0-"), (3, "0x"), (None, "0n")]
    assert rows(merge_deltas([a.limit(0), b.limit(0)], ["k"], {"c": spaced_out()})) == []


def test_running_fold_of_a_long_key(spark):
    """More versions of one key than an Arrow batch holds, beside many short ones."""
    n = 25_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"), F.col("id").alias("at"))
    mixed = Running(lambda: 7, lambda s, v: (s * 31 + v) % 1_000_003, lambda s: s)
    got = {r["k"]: r["v"] for r in merge_deltas([df.repartition(5)], ["k"], {"v": mixed}, ["at"]).collect()}
    want = {}
    for i in range(n):
        k = 0 if i % 3 == 0 else i
        want[k] = (want.get(k, 7) * 31 + i) % 1_000_003
    assert got == want


def test_running_folds_are_read_and_not_stored(spark, frame, root, rows):
    t = KeyedTable.create(spark, root, frame([(1, "a"), (2, "b")], "k int, c string"), keys=["k"], buckets=2, unique_keys=True)
    assert rows(t.read(ops={"c": spaced_out()})) == [(1, "0a"), (2, "0b")]
    t.upsert(frame([(1, "x")], "k int, c string"))
    assert rows(t.read(ops={"c": spaced_out()})) == [(1, "0a1x"), (2, "0b")]
    for compact in (lambda: t.compact(ops={"c": spaced_out()}), lambda: t.compact_oldest(2, ops={"c": spaced_out()})):
        with pytest.raises(TableError, match="running fold"):
            compact()


def test_operator_map_is_checked(frame):
    a = frame([(1, "a")], "k int, c string")
    with pytest.raises(ValueError, match="unknown column"):
        merge_deltas([a], ["k"], {"x": "sum"})
    with pytest.raises(ValueError, match="more than one"):
        merge_deltas([a], ["k"], [("c", "concat"), ("C", "non_null")])
    with pytest.raises(TypeError, match="numeric"):
        merge_deltas([a], ["k"], {"c": "sum"})
    with pytest.raises(ValueError, match="registered"):
        merge_deltas([a], ["k"], {"c": "nothing"})


def test_premerge_matches_a_chain_of_full_joins(frame, rows):
    d = "k int, ip string, n int, name string"
    batches = [
        frame([(1, "a", 1, "null"), (2, "b", 2, "x")], d),
        frame([(1, None, 5, "null"), (3, "c", None, "null")], d),
        frame([(2, "d", 7, "null"), (3, None, 4, None), (1, "z", None, "y")], d),
    ]

    def pair(x, y):
        x, y = x.alias("x"), y.alias("y")
        return x.join(y, "k", "full").select(
            "k",
            F.coalesce("y.ip", "x.ip").alias("ip"),
            F.when(F.col("x.n").isNotNull() & F.col("y.n").isNotNull(), F.col("x.n") + F.col("y.n"))
            .otherwise(F.coalesce("x.n", "y.n")).alias("n"),
            F.when(F.col("y.name").isNotNull() & (F.col("y.name") != "null"), F.col("y.name"))
            .otherwise(F.col("x.name")).alias("name"),
        )

    want = pair(pair(batches[0], batches[1]), batches[2])
    got = premerge(batches, ["k"], sums=["n"], skip_null_text=["name"])
    assert rows(got, "k", "ip", "n", "name") == rows(want, "k", "ip", "n", "name")


def test_hot_key_concat_keeps_order_over_many_chunks(spark, rows):
    n = 20_000
    hot = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.col("id").cast("string").alias("c"))
    rest = spark.range(1000).select(
        (F.col("id") + 2).cast("int").alias("k"), F.col("id").alias("t"), F.lit("z").alias("c")
    )
    got = merge_deltas([hot.union(rest)], ["k"], {"c": "concat"}, order_cols=["t"])
    text = got.filter("k = 1").first()["c"]
    assert text.split(",") == [str(i) for i in range(n)]
    assert got.count() == 1001


def test_merge_plan_has_one_shuffle_and_pushes_key_filters(spark, root):
    spark.range(100).selectExpr("id k", "id * 2 v", "id w").write.parquet(root)
    base = spark.read.parquet(root)
    merged = merge_deltas([base, base.select("k", "v"), base], ["k"]).filter("k = 5 and v < 3").select("v")
    plan = merged._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange") == 1
    assert plan.count("EqualTo(k,5)") == 3
    assert "LessThan(v" not in plan
    assert "w" not in [c.split(":")[0] for s in plan.split("ReadSchema: struct<")[1:] for c in s.split(">")[0].split(",")]


values = st.one_of(st.none(), st.integers(0, 5))
texts = st.one_of(st.none(), st.sampled_from(["null", "a", "b"]))
delta = st.dictionaries(st.integers(0, 6), st.tuples(values, texts, texts, values), min_size=1, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(base=delta, deltas=st.lists(st.tuples(delta, st.booleans()), min_size=1, max_size=3))
def test_overlay_and_fold_agree_with_a_row_by_row_model(frame, rows, base, deltas):
    ddl, names = "k int, s int, c string, n string, v int", ["s", "c", "n", "v"]

    def as_frame(d, partial):
        full = frame([(k, *v) for k, v in d.items()], ddl)
        return full.drop("v") if partial else full

    ops = {"s": "sum", "c": "concat", "n": "non_null"}
    model = {}
    for d, partial in [(base, False), *deltas]:
        for k, (s, c, n, v) in d.items():
            model.setdefault(k, []).append((s, c, n, None if partial else ("set", v)))
    want = []
    for k, versions in model.items():
        sums = [s for s, *_ in versions if s is not None]
        parts = [c for _, c, _, _ in versions if c is not None]
        real = [n for _, _, n, _ in versions if n not in (None, "null")]
        seen = any(n == "null" for _, _, n, _ in versions)
        sets = [x[1] for *_, x in versions if x]
        want.append((k, sum(sums) if sums else None, ",".join(parts) if parts else None,
                     real[-1] if real else ("null" if seen else None), sets[-1] if sets else None))
    want.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    frames = [as_frame(d, p) for d, p in [(base, False), *deltas]]
    assert rows(merge_deltas(frames, ["k"], ops), "k", *names) == want
    from keytide.functions.merge_ops import resolve_ops

    found = resolve_ops(ops, frames[0].schema, ["k"])
    versions = stack(frames[1:])
    if "v" not in versions.rows.columns:
        versions = M.Versions(versions.rows.withColumn("v", F.lit(None).cast("int")), versions.carried)
    for how, null_keys in (("full", True), ("hash", False), ("broadcast", True)):
        over = M.overlay(frames[0], versions, ["k"], ["k", *names], found, how, null_keys)
        assert rows(over, "k", *names) == want
