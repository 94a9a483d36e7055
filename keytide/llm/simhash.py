"""SimHash near-duplicates with pigeonring filtering.

Fingerprints are cut into a ring of five segments. If two of them differ in at
most four bits, then from some segment on every chain of l segments differs in at
most l * 4/5 bits: the first not at all, the first two in one bit, and so on. The
first two chain budgets make the join keys: segment i whole, and one half of
segment i+1 whole (one differing bit leaves a half untouched). Pairs that meet
under a key must pass the rest of the chain before their distance is counted.

Only distinct fingerprints are joined, never documents. Keys are compared inside a
task, which returns links as a forest and not as pairs; a key with more than
``block`` fingerprints is split into blocks whose pairings go to different tasks.

Edge cases: NULL and empty texts have fingerprint 0 and are linked like any other
text; texts with fewer words than a shingle are hashed whole. Repeated rows share
a fingerprint. NULL ids take no part in the minimum of a component; a component
of NULL ids only has a NULL id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.llm.components import components, roots
from keytide.llm.text import cut

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 4096
# The ring: (shift, width) of the segments, 64 bits in all.
RING = ((51, 13), (38, 13), (25, 13), (12, 13), (0, 12))
_ONES = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit set where more than half of the shingles' hashes have it, repeats counted."""
    if not text:
        return 0
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``df`` without the text, with ``fp``: the 64 bits as a signed long."""
    rest = [c for c in df.columns if c != text]
    schema = df.select(*rest).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(0)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fp, pa.int64())], names=[*rest, "fp"])

    return df.select(text, *rest).mapInArrow(run, schema)


def _pairs(a: np.ndarray, b: np.ndarray, ring: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs under one key: chain budgets of the ring first, the whole distance last."""
    n, rows = len(RING), max(1, (1 << 22) // max(1, len(b)))
    for at in range(0, len(a), rows):
        left = a[at:at + rows]
        i, j = np.nonzero(np.ones((len(left), len(b)), bool)) if not same else np.nonzero(
            np.arange(at, at + len(left))[:, None] < np.arange(len(b))[None, :])
        x = left[i] ^ b[j]
        spent = np.zeros(len(x), np.int64)
        for length in range(1, n + 1):  # the last chain is the whole ring, so it ends with the full distance
            shift, width = RING[(ring + length - 1) % n]
            spent += _ONES[((x >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)]
            ok = spent <= length * MAX_BITS // n
            i, j, x, spent = i[ok], j[ok], x[ok], spent[ok]
        if len(x):
            yield left[i], b[j]


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among fingerprints of equal (key, i, j); rows come sorted by these. Small
    keys are taken together, no more than one key's fingerprints are held."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush(rows: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        key, bi, bj, side, fp = (np.concatenate(c) for c in zip(*rows))
        change = (key[1:] != key[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])
        edges = np.concatenate([[0], np.flatnonzero(change) + 1, [len(key)]])
        us, vs = [], []
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi - lo > 1:
                f, ring = fp[lo:hi].view(np.uint64), int(key[lo] >> 20) // 2
                if bi[lo] == bj[lo]:
                    found = _pairs(f, f, ring, True)
                else:
                    found = _pairs(f[side[lo:hi] == 0], f[side[lo:hi] == 1], ring, False)
                for u, v in found:
                    nodes, low = roots(u.view(np.int64), v.view(np.int64))
                    us.append(nodes[nodes != low])
                    vs.append(low[nodes != low])
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["a", "b"])

    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(5)]
        if not len(cols[0]):
            continue
        # hold back the batch's last key, which may go on in the next batch
        last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
        cut_at = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut_at:
            held.append(tuple(c[:cut_at] for c in cols))
            yield from flush(held)
            held = []
        held.append(tuple(c[cut_at:] for c in cols))
    if held:
        yield from flush(held)


def fingerprint_links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """A forest of links (a, b) among distinct fingerprints ``fp`` at most MAX_BITS apart."""
    keys = []
    for i, (shift, width) in enumerate(RING):
        nshift, nwidth = RING[(i + 1) % len(RING)]
        first = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        second = F.shiftrightunsigned("fp", nshift).bitwiseAND(F.lit((1 << nwidth) - 1))
        halves = (F.shiftright(second, nwidth // 2), second.bitwiseAND(F.lit((1 << (nwidth // 2)) - 1)))
        for h, half in enumerate(halves):
            keys.append(F.shiftleft(F.lit(2 * i + h).cast("long"), 20) + F.shiftleft(first, 7) + half)
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = keyed.groupBy("key").count().filter(F.col("count") > block).select(
        "key", F.ceil(F.col("count") / block).cast("int").alias("n")
    )
    split = keyed.join(hot, "key", "left")
    n = F.coalesce("n", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), n).cast("int")
    # one copy for each block pairing (i <= j) that has the fingerprint's own block
    paired = split.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    dealt = paired.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp",
    )
    parts = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return parts.mapInArrow(_joined, "a long, b long")


def _groups(rows: DataFrame, id_col: str) -> DataFrame:
    """fp, component (of fingerprints) and the smallest id with this fingerprint."""
    fps = rows.groupBy("fp").agg(F.min(id_col).alias("first"))
    linked = components(fingerprint_links(fps.select("fp")))
    return fps.join(linked, fps["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """id, fp and component_id of every row."""
    rows = cut(fingerprints(df.select(id_col, text), text, shingle), "fingerprints")
    groups = _groups(rows, id_col)
    least = groups.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows.join(groups.join(least, "component").select("fp", "component_id"), "fp").select(
        id_col, "fp", "component_id"
    )


def deduplicated(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per component: the smallest doc_id, those without one last, then the smallest
    hash of the text. Of rows with this doc_id and text the one with the smallest hash of its columns
    stays, so reruns agree."""
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = cut(fingerprints(df.select("doc_id", "text", body.alias("body")), "text", shingle), "fingerprints")
    groups = _groups(rows, "doc_id").select("fp", "component")
    of_print = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body")).alias("one"))
    kept = of_print.join(groups, "fp").groupBy("component").agg(F.min("one").alias("one")).select(
        F.col("one.doc_id").alias("__doc"), F.col("one.body").alias("__body")
    )
    found = df.join(kept, df["doc_id"].eqNullSafe(F.col("__doc")) & (body == F.col("__body")), "left_semi")
    cells = F.struct(*df.columns)
    same = F.struct(F.col("doc_id").alias("__doc"), body.alias("__body"))
    return found.groupBy(same).agg(F.min_by(cells, F.xxhash64(F.to_json(cells))).alias("__row")).select("__row.*")
