"""Removal of benchmark passages by a broadcast hash set of their windows.

Benchmark items are normalised to their words, and every window of ``width`` words
(the whole item, if it has fewer) goes into a hash set. The set is broadcast: sorted
64-bit hashes with a bit table before them, and the normalised items themselves, since
every hit is verified by comparing its words with the item's. Training texts are
normalised in the same way and scanned once, whole, in pieces that overlap by a
window; all windows of a piece are hashed at once from sums of powers.

A set is built of at most ``block`` bytes of items. A larger benchmark makes several sets,
each small enough to broadcast, and the texts are scanned once for each of them.

Windows that stand in the same items form a class, so a text carries few numbers however
many windows of an item it holds. Which items these are is found once for each different
set of classes, not for each text.

Edge cases: NULL and empty texts have no words and no hits; items without words
match nothing; equal items match together; an item_id on several rows is one item; items with NULL id
mark words but are not counted as items; repeated rows and NULL doc_ids are treated row by
row; an empty benchmark leaves every text clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide.llm.text import cut

WIDTH = 10
BLOCK = 8 << 20  # bytes of normalised items in one hash set
PART = 512  # windows of an item that stay together
PIECE = 1 << 19  # bytes of a text scanned at once

# bytes outside words become spaces; A-Z become a-z
_WORD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse among 64-bit numbers
_MIX = np.uint64(0xD6E8FEB86659FD93)

FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))),
    T.StructField("hits", T.ArrayType(T.LongType())),
]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    if len(_TABLES.get(name, ())) < n:
        _TABLES[name] = _powers(base, max(n, 1 << 16))
    return _TABLES[name]


def normal(text: bytes) -> bytes:
    return b" ".join(text.translate(_WORD).split())


class Words:
    """Normalised bytes with the places of their words; hashes of windows."""

    def __init__(self, body: bytes) -> None:
        self.body = body
        self.padded = np.frombuffer(body + bytes(8), np.uint8)
        gaps = np.flatnonzero(self.padded[: len(body)] == 0x20)
        self.begin = np.concatenate([[0], gaps + 1]) if body else np.zeros(0, np.int64)
        self.end = np.concatenate([gaps, [len(body)]]) if body else np.zeros(0, np.int64)
        n = len(body)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum((self.padded[:n].astype(np.uint64) + np.uint64(1)) * _table("up", _BASE, n + 1)[:n], out=self.sums[1:])

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, begin and end of every run of ``width`` words."""
        n = len(self.begin) - width + 1
        if n <= 0:
            return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
        begin, end = self.begin[:n], self.end[width - 1 :]
        with np.errstate(over="ignore"):
            down = _table("down", pow(_BASE, -1, 1 << 64), len(self.body) + 1)
            h = (self.sums[end] - self.sums[begin]) * down[begin] * _MIX
        return h ^ (h >> np.uint64(32)), begin, end


def _equal(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes are the same; both buffers have 8 bytes behind their last."""
    wide = [np.ndarray(len(x) - 7, "<u8", x.data, strides=(1,)) for x in (a, b)]
    same, open_ = np.ones(len(at), bool), np.arange(len(at))
    off = 0
    while len(open_):
        left = size[open_] - off
        shift = np.clip(8 - left, 0, 7).astype(np.uint64) * np.uint64(8)
        differ = (wide[0][at[open_] + off] ^ wide[1][bt[open_] + off]) << shift != 0
        same[open_[differ]] = False
        open_ = open_[~differ & (left > 8)]
        off += 8
    return same


@dataclass
class Table:
    """A hash set of windows: sorted hashes, place and size of the window in ``body``, class."""

    body: bytes
    keys: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    group: np.ndarray
    widths: list[int]

    def __post_init__(self) -> None:
        self.shift = np.uint64(64 - max(16, int(len(self.keys)).bit_length() + 4))
        self.bits = np.zeros(1 << int(64 - self.shift), bool)
        self.bits[self.keys >> self.shift] = True
        self.padded = np.frombuffer(self.body + bytes(8), np.uint8)

    def found(self, words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows of the text that are in the set, and their classes."""
        h, begin, end = words.windows(width)
        at = np.flatnonzero(self.bits[h >> self.shift])
        place = np.searchsorted(self.keys, h[at])
        out_at, out_group = [], []
        while len(at):
            known = place < len(self.keys)
            known[known] = self.keys[place[known]] == h[at[known]]
            at, place = at[known], place[known]
            size = end[at] - begin[at]
            same = self.size[place] == size
            same[same] = _equal(words.padded, begin[at[same]], self.padded, self.begin[place[same]], size[same])
            out_at.append(at[same])
            out_group.append(self.group[place[same]])
            at, place = at[~same], place[~same] + 1  # another window with this hash
        return np.concatenate([*out_at, np.zeros(0, np.int64)]), np.concatenate([*out_group, np.zeros(0, np.int64)])


def table_of(bodies: list[bytes], width: int = WIDTH) -> tuple[Table, np.ndarray, np.ndarray]:
    """The hash set of some items, and its classes as pairs (class, item)."""
    parts: list[tuple] = []
    widths, base = set(), 0
    for i, body in enumerate(bodies):
        words = Words(body)
        if n := min(width, len(words.begin)):
            widths.add(n)
            h, begin, end = words.windows(n)
            parts.append((h, begin + base, end - begin, np.full(len(h), i)))
        base += len(body) + 1
    whole = b" ".join(bodies)
    kinds = (np.uint64, np.int64, np.int64, np.int64)
    h, begin, size, item = (np.concatenate([np.zeros(0, k), *x]).astype(k) for k, x in zip(kinds, list(zip(*parts)) or [()] * 4))
    padded = np.frombuffer(whole + bytes(8), np.uint8)
    window, leads = np.zeros(len(h), np.int64), []
    rest, n = np.argsort(h, kind="stable"), 0
    while len(rest):  # again only for different windows with one hash
        new = np.append(True, h[rest[1:]] != h[rest[:-1]])
        lead = rest[new][np.cumsum(new) - 1]
        same = size[rest] == size[lead]
        same[same] = _equal(padded, begin[rest[same]], padded, begin[lead[same]], size[rest[same]])
        window[rest[same]] = n + (np.cumsum(new) - 1)[same]
        leads.append(rest[new])
        n += int(new.sum())
        rest = rest[~same]
    lead = np.concatenate([*leads, np.zeros(0, np.int64)]).astype(np.int64)
    pairs = np.unique(np.stack([window, item], axis=1), axis=0)
    mixed = np.random.default_rng(7).integers(0, 1 << 64, (len(bodies), 2), np.uint64)  # windows of the same items have the same sums
    at = np.flatnonzero(np.append(True, pairs[1:, 0] != pairs[:-1, 0])) if len(pairs) else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(mixed[pairs[:, 1]], at, axis=0) if len(pairs) else np.zeros((0, 2), np.uint64)
    first, group = np.unique(sums, axis=0, return_index=True, return_inverse=True)[1:] if len(sums) else (at, at)
    group = group.reshape(-1).astype(np.int64)
    shown = np.isin(pairs[:, 0], first)
    order = np.argsort(h[lead], kind="stable")
    lead = lead[order]
    return Table(whole, h[lead], begin[lead], size[lead], group[order], sorted(widths)), group[pairs[shown, 0]], pairs[shown, 1]


def _pieces(clean: bytes, piece: int) -> Iterator[tuple[int, bytes]]:
    """Stretches of a translated text that end between words."""
    at = 0
    while at < len(clean):
        end = at + piece
        if end < len(clean):
            end = clean.find(b" ", end) + 1 or len(clean)
        yield at, clean[at:end]
        at = end


def scan(text: bytes, table: Table, width: int = WIDTH, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Which words of a text are hit, and the classes of the windows it has."""
    hit, groups = [np.zeros(0, bool)], [np.zeros(0, np.int64)]
    tail = b""
    for _, part in _pieces(text.translate(_WORD), piece):
        fresh = b" ".join(part.split())
        if not fresh:
            continue
        words = Words(tail + b" " + fresh if tail else fresh)
        n, old = len(words.begin), tail.count(b" ") + 1 if tail else 0
        edges = np.zeros(n + 1, np.int32)
        for k in table.widths:
            at, group = table.found(words, k)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + k, -1)
            groups.append(np.unique(group))
        marked = np.cumsum(edges[:-1]) > 0
        back, left = len(hit) - 1, old  # windows may begin in the pieces before
        while left:
            take = min(left, len(hit[back]))
            hit[back][len(hit[back]) - take :] |= marked[left - take : left]
            back, left = back - 1, left - take
        hit.append(marked[old:])
        keep = min(n, width - 1)
        tail = words.body[words.begin[n - keep] :] if keep else b""
    return np.concatenate(hit), np.unique(np.concatenate(groups))


def _edges(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of true values."""
    turns = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    return turns[::2], turns[1::2]


def without(text: bytes, runs: list[dict]) -> bytes:
    """A text without these runs of words: from the first letter of a run to its last."""
    letter = np.frombuffer(text.translate(_WORD), np.uint8) != 0x20
    begin, end = _edges(letter)
    out, at = [], 0
    for run in runs:
        out.append(text[at : begin[run["a"]]])
        at = int(end[run["b"] - 1])
    return b"".join([*out, text[at:]])


def _hit_runs(marked: np.ndarray) -> list[dict]:
    return [{"a": a, "b": b} for a, b in zip(*(x.tolist() for x in _edges(marked)))]


def _scanned(shared, block: int, text: int, keep: list[int], again: bool, width: int):
    """Rows with FOUND; with ``again`` the last columns are FOUND of the sets before."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            n_words, runs, hits = [], [], []
            for i, value in enumerate(batch.column(text).cast(pa.binary())):
                marked, groups = scan(value.as_py() or b"", table, width)
                groups = (groups + (block << 32)).tolist()
                if again:
                    for r in batch.column(batch.num_columns - 2)[i].as_py():
                        marked[r["a"] : r["b"]] = True
                    groups = batch.column(batch.num_columns - 1)[i].as_py() + groups
                n_words.append(len(marked))
                runs.append(_hit_runs(marked))
                hits.append(groups)
            pair = pa.struct([("a", pa.int64()), ("b", pa.int64())])
            new = [pa.array(n_words, pa.int64()), pa.array(runs, pa.list_(pair)), pa.array(hits, pa.list_(pa.int64()))]
            columns = [*(batch.column(i) for i in keep), *new]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def _parted(width: int, part: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies = [], []
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = normal(value.as_py() or b"").split()
                for at in range(0, max(1, len(words) - width + 1) if words else 0, part):
                    ids.append(item)
                    bodies.append(b" ".join(words[at : at + part + width - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(bodies, pa.binary()).cast(pa.string())],
                                             names=["item_id", "body"])

    return run


class Benchmark:
    """The hash sets of a benchmark (item_id, text), each broadcast when it is used."""

    def __init__(self, items: DataFrame, width: int = WIDTH, block: int = BLOCK, part: int = PART) -> None:
        self.spark, self.width = items.sparkSession, width
        parts = items.select(F.col("item_id").cast("string"), "text").mapInArrow(_parted(width, part), "item_id string, body string")
        self.parts = cut(parts.distinct(), "benchmark-parts")
        bodies = self.parts.groupBy("body").agg(F.octet_length("body").alias("size"))
        whole, longest = bodies.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
        self.blocks = -(-whole // block)
        while self.blocks:  # a bound of the size of every set, not only of their mean
            dealt = bodies.withColumn("block", F.pmod(F.xxhash64("body"), F.lit(self.blocks)))
            largest = dealt.groupBy("block").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0]
            if largest <= max(block, longest):
                break
            self.blocks += max(1, self.blocks // 4)
        if self.blocks:
            numbered = dealt.withColumn("body_no", F.monotonically_increasing_id())
            self.bodies = cut(numbered, "benchmark-bodies")
        self.classes: list[DataFrame] = []

    def table(self, block: int) -> Table:
        """One set; its classes join the others' as (hit, body_no)."""
        rows = self.bodies.filter(F.col("block") == block).orderBy("body_no").select("body_no", "body").toArrow()  # at most a block of bytes
        table, group, item = table_of([x.encode() for x in rows["body"].to_pylist()], self.width)
        pairs = pa.table([pa.array(group + (block << 32)), rows["body_no"].take(pa.array(item))], names=["hit", "body_no"])
        self.classes.append(cut(self.spark.createDataFrame(pairs), "benchmark-classes"))
        return table

    def items(self) -> DataFrame:
        """Which items a class stands for: hit, item_id."""
        classes = self.classes[0]
        for more in self.classes[1:]:
            classes = classes.union(more)
        return classes.join(self.bodies.select("body_no", "body"), "body_no").join(self.parts, "body").select("hit", "item_id").distinct()


def found(docs: DataFrame, benchmark: Benchmark, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (all) of every row with n_words, runs of hit words as [a, b) and the classes it hits."""
    names = docs.columns if keep is None else keep
    if clash := {f.name for f in FOUND} & {x.lower() for x in names}:
        raise ValueError(f"columns are there already: {sorted(clash)}")
    rows = docs.select(*dict.fromkeys([*names, text]))
    fields = rows.schema.fields
    for block in range(max(1, benchmark.blocks)):
        table = benchmark.table(block) if benchmark.blocks else table_of([], benchmark.width)[0]
        last = block >= benchmark.blocks - 1
        places = [rows.columns.index(x) for x in (names if last else [f.name for f in fields])]
        shared = docs.sparkSession.sparkContext.broadcast(table)
        run = _scanned(shared, block, rows.columns.index(text), places, block > 0, benchmark.width)
        rows = rows.mapInArrow(run, T.StructType([*(fields[i] for i in places), *FOUND]))
        if not last:
            rows = cut(rows, "scanned")
    return rows


def n_hit() -> Column:
    return F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and SHA-256 of the sorted items of every set, read as a stream."""
    key, n, sha = None, 0, hashlib.sha256()
    for batch in batches:
        out = []
        for k, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    out.append((key, n, sha.hexdigest()))
                key, n, sha = k, 0, hashlib.sha256()
            sha.update((b"," if n else b"") + item.encode())
            n += 1
        if out:
            yield _digest_rows(out)
    if key is not None:
        yield _digest_rows([(key, n, sha.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["key", "n_items", "items_sha256"])


def report(docs: DataFrame, items: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 of every row, and the runs of hit words."""
    benchmark = Benchmark(items, width, block)
    rows = cut(found(docs, benchmark, ["doc_id"]), "hits").withColumn("n_hit", n_hit())
    clean = rows.filter("n_hit = 0").select(
        "doc_id", "n_words", "n_hit", F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256"), "runs"
    )
    if not benchmark.blocks:
        return clean
    # rows with the same hits share one digest
    dirty = rows.filter("n_hit > 0").withColumn("key", F.sha2(F.array_join("hits", ","), 256))
    sets = dirty.groupBy("key").agg(F.first("hits").alias("hits"))
    pairs = sets.select("key", F.explode("hits").alias("hit")).join(benchmark.items(), "hit").filter("item_id IS NOT NULL")
    ordered = pairs.select("key", "item_id").distinct().repartition("key").sortWithinPartitions("key", "item_id")
    digests = ordered.mapInArrow(_digests, "key string, n_items long, items_sha256 string")
    dirty = dirty.join(digests, "key", "left").select(
        "doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), "runs",
    )
    return clean.union(dirty)


def cleaned(docs: DataFrame, items: DataFrame, mode: str = "spans", window: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """``docs`` without benchmark passages; columns as they came, ``n_chars`` counted anew where spans go.

    ``spans``: runs of hit words go, from the first letter to the last, and what stands around
    them stays; ``documents``: a document with a hit goes whole.
    """
    if mode not in ("spans", "documents"):
        raise ValueError(f"spans or documents, not {mode}")
    rows = found(docs, Benchmark(items, window, block))
    if mode == "documents":
        return rows.filter(F.size("runs") == 0).select(*docs.columns)
    place, width = docs.columns.index("text"), len(docs.columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                without(t.as_py(), r) if r else t.as_py()
                for t, r in zip(batch.column(place).cast(pa.binary()), batch.column(batch.num_columns - 2).to_pylist())
            ]
            columns = list(batch.columns[:width])
            columns[place] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    out = rows.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")) if "n_chars" in docs.columns else out
