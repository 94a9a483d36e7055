"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= c lie within eps = sqrt(2 - 2c). Projected on the leading
principal dimensions they are no farther apart, so their grid cells of width eps
differ by at most one in each dimension. Vectors are sorted by label and cells
(the epsilon grid order) and cut into intervals; two intervals are joined unless
their extents are farther apart than eps in some leading dimension, and inside a
join the intervals are halved again and again under the same test until they are
small enough to multiply. Cosines are computed in double precision.

Interval pairs come from an equi-join on label and leading cell, so each interval
meets its neighbours only. Equal vectors are joined once, with their number; a
label that holds most rows is as many intervals as it needs.

Edge cases: vectors that are NULL, empty, zero, or hold NULL or non-finite
components, and rows with a NULL label, link with nothing; vectors of different
lengths link with nothing; repeated vec_ids are rows of their own with the same
component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.llm.components import components, roots
from keytide.llm.text import cut

COSINE = 0.98
LEADING = 6
INTERVAL = 512
LEAF = 64


def _unit(values: pa.Array, size: int) -> np.ndarray:
    x = np.asarray(values.flatten(), dtype=np.float64).reshape(-1, size)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _second_moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        size = batch.column(1).to_numpy()
        for d in np.unique(size).tolist():
            x = _unit(batch.column(0).filter(pa.array(size == d)), d)
            x = np.column_stack([x, np.ones(len(x))])
            sums[d] = sums.get(d, 0) + x.T @ x
    for d, m in sums.items():
        i, j = np.indices(m.shape)
        yield pa.RecordBatch.from_arrays([pa.array([d] * m.size, pa.int32()), pa.array(i.ravel().astype(np.int32)),
                                          pa.array(j.ravel().astype(np.int32)), pa.array(m.ravel())], names=["d", "i", "j", "m"])


def principal(vectors: DataFrame, leading: int) -> dict[int, np.ndarray]:
    """Leading principal directions by vector length. The driver sees one square matrix per length."""
    cells = vectors.select("embedding", "d").mapInArrow(_second_moments, "d int, i int, j int, m double")
    out = {}
    for rows in [cells.groupBy("d", "i", "j").agg(F.sum("m").alias("m")).toPandas()]:
        for d, part in rows.groupby("d"):
            m = np.zeros((d + 1, d + 1))
            m[part["i"], part["j"]] = part["m"]
            mean = m[d, :d] / m[d, d]
            values, axes = np.linalg.eigh(m[:d, :d] / m[d, d] - np.outer(mean, mean))
            out[int(d)] = axes[:, ::-1][:, :leading]
    return out


def _projected(axes: dict[int, np.ndarray], leading: int):
    names = ["id", "copies", "label", "d", "embedding", "place"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(3).to_numpy()
            for d in np.unique(size).tolist():
                part = batch.filter(pa.array(size == d))
                place = np.zeros((part.num_rows, leading))
                place[:, : axes[d].shape[1]] = _unit(part.column(4), d) @ axes[d]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(place), pa.list_(pa.float64()))], names=names)

    return run


_INTERVAL_ROW = "label long, d int, block long, lo array<double>, hi array<double>, ids array<bigint>, copies array<bigint>, data binary"


def _intervals(size: int):
    """Sorted rows to intervals of one label and length."""
    from pyspark import TaskContext

    def flush(rows: list[tuple], block: int) -> pa.RecordBatch:
        place = np.array([r[5] for r in rows])
        data = np.array([r[4] for r in rows], np.float64).tobytes()
        return pa.RecordBatch.from_arrays([
            pa.array([rows[0][2]], pa.int64()), pa.array([rows[0][3]], pa.int32()), pa.array([block], pa.int64()),
            pa.array([place.min(axis=0)], pa.list_(pa.float64())), pa.array([place.max(axis=0)], pa.list_(pa.float64())),
            pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[r[1] for r in rows]], pa.list_(pa.int64())),
            pa.array([data], pa.binary()),
        ], names=["label", "d", "block", "lo", "hi", "ids", "copies", "data"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and (len(held) >= size or row[2:4] != held[-1][2:4]):
                    yield flush(held, block)
                    held, block = [], block + 1
                held.append(row)
        if held:
            yield flush(held, block)

    return run


def _within(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, eps: float, cosine: float, same: bool):
    """Linked pairs of two intervals, halved while their extents allow a link."""
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if same and m <= i:  # the other half of a self join
            continue
        gap = np.maximum(pb[k:m].min(axis=0) - pa_[i:j].max(axis=0), pa_[i:j].min(axis=0) - pb[k:m].max(axis=0))
        if gap.max() > eps:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            x, y = np.nonzero(a[i:j] @ b[k:m].T >= cosine)
            x, y = x + i, y + k
            if same:
                x, y = x[x < y], y[x < y]
            yield x, y
        elif j - i >= m - k:
            h = (i + j) // 2
            todo += [(i, h, k, m), (h, j, k, m)]
        else:
            h = (k + m) // 2
            todo += [(i, j, k, h), (i, j, h, m)]


def _linked(axes: dict[int, np.ndarray], eps: float, cosine: float):
    """Per interval pair: links of every vector (weighted by copies) and a forest of links."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, same, ia, ca, da, ib, cb, db in zip(*(batch.column(i).to_pylist() for i in range(8))):
                ia, ca, ib, cb = (np.array(v, np.int64) for v in (ia, ca, ib, cb))
                a, b = (np.frombuffer(v, np.float64).reshape(-1, d) for v in (da, db))
                a, b = (v / np.sqrt((v * v).sum(axis=1))[:, None] for v in (a, b))
                na, nb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
                us, vs = [], []
                for x, y in _within(a, b, a @ axes[d], b @ axes[d], eps, cosine, same):
                    np.add.at(na, x, cb[y])
                    np.add.at(nb, y, ca[x])
                    us.append(ia[x])
                    vs.append(ib[y])
                n = np.concatenate([na, nb])
                ids = np.concatenate([ia, ib])
                low = ids.copy()  # the root of a vector's links within this pair
                if us and len(u := np.concatenate(us)):
                    nodes, root = roots(u, np.concatenate(vs))
                    at = np.searchsorted(nodes, ids).clip(0, len(nodes) - 1)
                    low = np.where(nodes[at] == ids, root[at], ids)
                some = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(n[some]), pa.array(low[some])], names=["id", "n", "low"])

    return run


def near_duplicates(df: DataFrame, cosine: float = COSINE, leading: int = LEADING, interval: int = INTERVAL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vec_id, embedding, label."""
    eps = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    useful = F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    valid = df.filter(useful & F.col("vec_id").isNotNull())
    same = valid.groupBy(F.col("label").cast("long").alias("label"), "embedding").agg(
        F.min("vec_id").cast("long").alias("id"), F.count(F.lit(1)).alias("copies")
    )
    distinct = cut(same.select("id", "copies", "label", F.size("embedding").alias("d"), "embedding"), "vectors")
    axes = principal(distinct, leading)
    width = max((v.shape[1] for v in axes.values()), default=1)
    axes = {d: np.pad(v, ((0, 0), (0, width - v.shape[1]))) for d, v in axes.items()}
    placed = distinct.mapInArrow(
        _projected(axes, width), "id long, copies long, label long, d int, embedding array<float>, place array<double>"
    )
    cells = [F.floor(F.col("place")[k] / eps) for k in range(width)]
    ordered = placed.repartitionByRange("label", "d", *cells).sortWithinPartitions("label", "d", *cells)
    blocks = cut(ordered.mapInArrow(_intervals(interval), _INTERVAL_ROW), "intervals")
    # intervals meet on the leading cells that they reach, one further for the second
    first = F.floor(F.col("lo")[0] / eps)
    last = F.floor(F.col("hi")[0] / eps)
    extent = blocks.select("label", "d", "block", "lo", "hi", first.alias("c0"), last.alias("c1"))
    left = extent.select("*", F.explode(F.sequence("c0", "c1")).alias("cell"))
    right = extent.select(
        F.col("label"), F.col("d"), F.col("block").alias("block2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
        F.explode(F.sequence(F.col("c0") - 1, F.col("c1") + 1)).alias("cell"),
    )
    near = F.forall(
        F.arrays_zip("lo", "hi", "lo2", "hi2"), lambda x: (x["lo2"] - x["hi"] <= eps) & (x["lo"] - x["hi2"] <= eps)
    )
    pairs = left.join(right, ["label", "d", "cell"]).filter((F.col("block") <= F.col("block2")) & near)
    pairs = pairs.select("block", "block2").distinct()
    a = blocks.select("block", "d", F.col("ids").alias("ia"), F.col("copies").alias("ca"), F.col("data").alias("da"))
    b = blocks.select(F.col("block").alias("block2"), F.col("ids").alias("ib"), F.col("copies").alias("cb"), F.col("data").alias("db"))
    work = pairs.join(a, "block").join(b, "block2").select(
        "d", (F.col("block") == F.col("block2")).alias("same"), "ia", "ca", "da", "ib", "cb", "db"
    )
    found = cut(work.mapInArrow(_linked(axes, eps, cosine), "id long, n long, low long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(found.select("id", "low"))
    # every row with its class of equal vectors, links to equal ones counted
    member = valid.select(F.col("label").cast("long").alias("label"), "embedding", F.col("vec_id").cast("long").alias("vec_id"))
    kinds = same.join(links, "id", "left").join(groups, same["id"] == groups["node"], "left").select(
        "label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    linked = member.join(kinds, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = df.filter(~useful | F.col("vec_id").isNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").cast("long").alias("component_id"),
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
