"""Connected components of a link table.

Every node ends with the smallest node it can reach. Rounds alternate two joins
per node with its smallest neighbour until no link changes; a first pass inside
each partition already replaces links by stars, so few rounds remain. Each round
is written to the shared folder. The driver sees one number per round.

Edge cases: no links give no rows; self links and repeated links are dropped;
links with a NULL end are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.llm.text import cut


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a few links and the smallest node of each one's component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a):]
    low = np.arange(len(nodes))
    while True:
        before = low.copy()
        least = np.minimum(low[u], low[v])
        np.minimum.at(low, u, least)
        np.minimum.at(low, v, least)
        np.minimum.at(low, before, low)
        low = low[low]
        if np.array_equal(low, before):
            return nodes, nodes[low]


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            nodes, low = roots(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            keep = nodes != low
            yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(low[keep])], names=["a", "b"])


def _mark(links: DataFrame) -> tuple:
    """Count and order-free hash of distinct links."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*links.columns))).first())


def components(links: DataFrame) -> DataFrame:
    """``links``: two bigint columns. Returns node, component for all linked nodes."""
    a, b = links.columns
    pairs = links.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b"))
    pairs = cut(pairs.filter("a <> b").mapInArrow(_stars, "a long, b long").distinct(), "links")
    while True:
        # large star: larger neighbours of a node link to the smallest one around it
        both = pairs.union(pairs.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = cut(large.filter("a <> b").distinct(), "large-stars")
        # small star: a node and its smaller neighbours link to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = cut(small.union(least.toDF("a", "b")).distinct(), "small-stars")
        if _mark(pairs) == _mark(small):
            return small.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                small.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        pairs = small
