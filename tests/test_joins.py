import pytest
from pyspark.sql import functions as F

from keytide.operators.bucketed import cobucketed_join
from keytide.plans.compare import fingerprint, same_rows
from keytide.plans.joins import _ADVISORY, HOW, PART, equi_join


@pytest.mark.parametrize("residual", [False, True])
@pytest.mark.parametrize("how", [h for h in HOW if h != "existence"])
def test_join_types_match_sparks_own(frame, rows, how, residual):
    a = frame([(1, 1), (1, 2), (2, 3), (None, 4), (5, 9)], "a int, x int")
    b = frame([(1, 2), (1, 5), (3, 1), (None, 1), (5, 1)], "b int, y int")
    cond = F.col("y") > F.col("x") if residual else None
    on = (F.col("a") == F.col("b")) & cond if residual else F.col("a") == F.col("b")
    cols = ["a", "x"] if how in ("left_semi", "left_anti") else ["a", "x", "b", "y"]
    assert rows(equi_join(a, b, [("a", "b")], how, cond), *cols) == rows(a.join(b, on, how), *cols)


def test_existence_keeps_every_left_row(frame, rows):
    a = frame([(1, 1), (1, 2), (2, 3), (None, 4)], "a int, x int")
    b = frame([(1, 2), (1, 5), (None, 1)], "b int, y int")
    assert rows(equi_join(a, b, [("a", "b")], "existence")) == [(1, 1, True), (1, 2, True), (2, 3, False), (None, 4, False)]
    residual = equi_join(a, b, [("a", "b")], "existence", F.col("y") < 2 * F.col("x"))
    assert rows(residual) == [(1, 1, False), (1, 2, True), (2, 3, False), (None, 4, False)]


def test_cobucketed_join_has_no_exchange(spark):
    a = spark.range(100).selectExpr("id a", "id * 2 x")
    b = spark.range(50).selectExpr("id b", "id * 3 y")
    out = cobucketed_join(a, b, [("a", "b")], 4)
    assert "Exchange" not in out._jdf.queryExecution().toString()
    assert out.count() == 50


def test_same_rows_counts_copies(frame, rows):
    a = frame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = frame([("x", 1), (None, 2), (None, 3)], "v string, k int")
    assert rows(same_rows(a, b)) == [(1, 1, False)]
    assert rows(same_rows(a, a.repartition(3))) == [(0, 0, True)]
    with pytest.raises(ValueError):
        same_rows(a, a.select("k"))


def test_fingerprint_ignores_order_only(frame):
    a = frame([(1, "x"), (2, None), (None, "y")], "k int, v string")
    assert fingerprint(a).first() == fingerprint(a.orderBy(F.desc("v")).select("v", "k")).first()
    assert fingerprint(a).first() != fingerprint(frame([(1, "x"), (2, "y"), (None, None)], "k int, v string")).first()
    assert fingerprint(a).first() != fingerprint(a.union(a)).first()


def test_joins_lower_the_size_of_partitions_unless_it_was_set(spark):
    for size, want in ((None, PART), ("40MB", "40MB")):
        s = spark.newSession()
        s.conf.unset(_ADVISORY) if size is None else s.conf.set(_ADVISORY, size)
        joined = equi_join(s.range(3).toDF("a"), s.range(1, 4).toDF("b"), [("a", "b")], "full")
        assert s.conf.get(_ADVISORY) == want and joined.count() == 4
