"""Removal of long repeated passages by column-wise suffix orders.

Equal strings of ``length`` bytes must be found anywhere in the corpus. Every window
of that length names an anchor: the place with the smallest hash among its grams of
``gram`` bytes, leftmost first. The choice depends on the window's bytes alone, so
equal windows name equal grams at equal offsets. The windows of one anchor are
neighbours and form a piece of text; pieces with equal grams make up a bucket, aligned
at their anchors.

The pieces of a bucket are a collection of short documents. Their suffix order is
built column by column from the right: each round inserts one symbol per
document, sorts the last round's order stably by it (the symbols in that order are
the column of the collection's Burrows-Wheeler transform) and updates the common
prefixes of neighbours. A window is repeated where a neighbour shares ``length``
bytes. Equal windows stand in equal columns of their bucket, so columns are not
merged with each other and a round costs as much as there are documents, not as
much as all symbols before it. Buckets come and go as sorted shuffle files that
tasks read once, in order.

What is equal is counted before it is moved: copies of a text within a batch, equal
pieces within a bucket. A bucket with more than ``max_pieces`` different pieces is
not gathered: its windows are counted by their 128-bit hashes instead.

Edge cases: NULL is the empty text; texts shorter than ``length`` keep all; an
empty table gives an empty result; repeated rows are copies like any other (each
of them loses what it shares); spans may cut characters in :func:`removed`, while
:func:`deduplicated` only drops whole characters. A text is known by its 64-bit
hash, length and id where texts are joined to their pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.llm.text import cut

LENGTH = 400
GRAM = 100
PASSAGE, PASSAGE_GRAM = 256, 64  # the same for the removal from a corpus
MAX_PIECES = 50_000
_CHUNK = 1 << 20  # bytes hashed at once
_FLUSH = 4096  # pieces ordered at once
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class _Powers:
    """Powers of the hash base and of its inverse, grown when needed."""

    up = down = np.ones(1, np.uint64)
    table = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, _CHUNK * 2)
            base = np.full(n, _ODD, np.uint64)
            base[0] = 1
            cls.up = np.multiply.accumulate(base)
            base[1:] = np.uint64(_inverse(int(_ODD)))
            cls.down = np.multiply.accumulate(base)
        return cls.up, cls.down


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    up, down = _Powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_Powers.table[data] * down[: len(data)], out=total[1:])
    h = (total[gram:] - total[:-gram]) * up[: len(data) - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1:n])


def pieces_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Anchors of the texts data[starts:ends], laid end to end: gram hash, anchor, first and last window."""
    hashes = _gram_hashes(data, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least((hashes & ~np.uint64((1 << 24) - 1)) | place, length - gram + 1)
    anchor = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    # windows must not cross the end of a text
    mark = np.zeros(len(anchor) + 1, np.int64)
    long = ends - starts >= length
    np.add.at(mark, starts[long], 1)
    np.add.at(mark, ends[long] - length + 1, -1)
    valid = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
    if not len(valid):
        empty = np.zeros(0, np.int64)
        return hashes[:0], empty, empty, empty
    a = anchor[valid]
    new = np.flatnonzero((a[1:] != a[:-1]) | (valid[1:] != valid[:-1] + 1)) + 1
    first = valid[np.concatenate([[0], new])]
    last = valid[np.concatenate([new, [len(valid)]]) - 1]
    at = anchor[first]
    return hashes[at], at, first, last


def _anchors(length: int, gram: int):
    names = ["key", "piece", "text_hash", "n", "doc", "copies", "first", "last", "anchor", "reach"]

    def emit(texts: list[tuple[int, int, int, bytes, int, int]]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(t[3] for t in texts), np.uint8)
        ends = np.cumsum([len(t[3]) for t in texts])
        starts = ends - [len(t[3]) for t in texts]
        key, at, first, last = pieces_of(data, starts, ends, length, gram)
        of = np.searchsorted(ends, first, side="right")
        whole = data.tobytes()
        piece = np.array([xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())],
                         dtype=np.uint64)
        # a text that repeats itself names one piece again and again: a run of them is one row,
        # ``reach`` bytes from its first piece to its last
        same = (key[1:] == key[:-1]) & (piece[1:] == piece[:-1]) & (of[1:] == of[:-1]) & (first[1:] == last[:-1] + 1)
        begin = np.flatnonzero(np.concatenate([[True], ~same]))[: len(key)]
        end = np.concatenate([begin[1:], [len(key)]]) - 1
        reach, times = first[end] - first[begin], end - begin + 1
        key, piece, of, at, first, last = (v[begin] for v in (key, piece, of, at, first, last))
        shift = np.array([t[4] for t in texts], np.int64)[of] - starts[of]
        col = lambda i: np.array([t[i] for t in texts], dtype=object)[of]
        return pa.RecordBatch.from_arrays([
            pa.array(key.view(np.int64)), pa.array(piece.view(np.int64)), pa.array(col(0), pa.int64()),
            pa.array(col(1), pa.int64()), pa.array(col(2), pa.int64()), pa.array(np.array([t[5] for t in texts], np.int64)[of] * times),
            pa.array(first + shift, pa.int64()), pa.array(last + shift, pa.int64()), pa.array(at + shift, pa.int64()),
            pa.array(reach, pa.int64()),
        ], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text_hash = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            _, one, copies = np.unique(text_hash, return_index=True, return_counts=True)
            held, size = [], 0
            for i, m in zip(one.tolist(), copies.tolist()):
                value = batch.column(1)[i].as_py() or ""
                text = value.encode()
                for at in range(0, len(text) - length + 1, _CHUNK):  # windows of a very long text in turns
                    part = text[at:at + _CHUNK + length - 1]
                    held.append((int(text_hash[i]), len(text), doc[i], part, at, m))
                    size += len(part)
                    if size >= _CHUNK:
                        yield emit(held)
                        held, size = [], 0
            if held:
                yield emit(held)

    return run


_ANCHOR_ROW = "key long, piece long, text_hash long, n long, doc long, copies long, first long, last long, anchor long, reach long"


def repeated_windows(pieces: list[bytes], before: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Windows that two pieces share: (piece, first, last) offsets. ``before`` has the
    bytes of a piece left of its anchor; all pieces must differ."""
    n = len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, n)
    left = int(before.max())
    columns = left + int((sizes - before).max())
    # symbols by column, so that a round reads one row; 0: no symbol here
    symbols = np.zeros((columns, n), np.uint16)
    flat = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 1
    who = np.repeat(np.arange(n), sizes)
    within = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[within + left - before[who], who] = flat
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)  # of a suffix and the one before it in order
    found_piece, found_at = [], []
    for c in range(columns - 1, -1, -1):
        row = symbols[c][order]
        rank = np.argsort(row, kind="stable")
        row = row[rank]
        spans = np.empty(2 * n, np.int64)
        spans[1::2] = rank + 1
        spans[2::2] = rank[:-1] + 1
        spans[0] = 0
        least = np.minimum.reduceat(common, spans)[::2]
        same = np.zeros(n, bool)
        same[1:] = (row[1:] == row[:-1]) & (row[1:] > 0)
        order = order[rank]
        common = np.zeros(n + 1, np.int32)
        common[:n][same] = least[same] + 1
        hit = np.flatnonzero(common >= length)
        if len(hit):
            both = np.unique(np.concatenate([order[hit], order[hit - 1]]))
            found_piece.append(both)
            found_at.append(np.full(len(both), c, np.int64))
    if not found_piece:
        return []
    p, at = np.concatenate(found_piece), np.concatenate(found_at)
    by = np.lexsort((at, p))
    p, at = p[by], at[by] - left + before[p[by]]
    new = np.flatnonzero((p[1:] != p[:-1]) | (at[1:] != at[:-1] + 1)) + 1
    lo, hi = np.concatenate([[0], new]), np.concatenate([new, [len(p)]]) - 1
    return list(zip(p[lo].tolist(), at[lo].tolist(), at[hi].tolist()))


def _ordered(length: int):
    def flush(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        found = repeated_windows([r[3] for r in rows], np.array([r[2] for r in rows], np.int64), length)
        return pa.RecordBatch.from_arrays([
            pa.array([rows[p][0] for p, _, _ in found], pa.int64()), pa.array([rows[p][1] for p, _, _ in found], pa.int64()),
            pa.array([a for _, a, _ in found], pa.int64()), pa.array([b for _, _, b in found], pa.int64()),
        ], names=["key", "piece", "lo", "hi"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if len(held) >= _FLUSH and row[0] != held[-1][0]:  # whole buckets
                    yield flush(held)
                    held = []
                held.append(row)
        if held:
            yield flush(held)

    return run


def _windows(length: int):
    """Hashes of all windows of pieces: key, piece, offset, window hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, piece, _, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                n = len(data) - length + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * n, pa.int64()), pa.array([piece] * n, pa.int64()), pa.array(range(n), pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(data[i:i + length]) for i in range(n)], pa.binary()),
                ], names=["key", "piece", "lo", "window"])

    return run


def text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def spans(df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
          max_pieces: int = MAX_PIECES) -> DataFrame:
    """Repeated byte ranges: text_hash, n (bytes), ranges (array of from, to)."""
    rows = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text"), text_key(text).alias("text_hash"))
    anchors = rows.mapInArrow(_anchors(length, gram), _ANCHOR_ROW)
    # pieces of one gram; a join instead of a window, so that a gram in a third of all texts can be split
    grams = anchors.groupBy("key").agg(F.sum("copies").alias("all")).filter(F.col("all") > 1).select("key")
    found = cut(anchors.join(grams, "key", "left_semi"), "anchors")
    kinds = found.groupBy("key", "piece").agg(
        F.sum("copies").alias("copies"),
        F.min(F.struct("text_hash", "n", "doc", "first", "last", "anchor")).alias("at"),
    )
    kinds = cut(kinds, "pieces")
    buckets = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    several = kinds.join(buckets.filter("kinds > 1"), "key").select("key", "piece", "at.*", "kinds")
    picked = several.groupBy("text_hash", "n", "doc").agg(
        F.collect_list(F.struct("key", "piece", "first", "last", "anchor", "kinds")).alias("parts")
    )
    full = rows.withColumn("n", F.octet_length("text").cast("long"))
    match = (full["text_hash"] == picked["text_hash"]) & (full["n"] == picked["n"]) & full["doc"].eqNullSafe(picked["doc"])
    cuts = full.join(picked.hint("shuffle_hash"), match).select(
        F.encode("text", "utf-8").alias("bytes"), F.explode("parts").alias("p")
    ).select(
        "p.key", "p.piece", (F.col("p.anchor") - F.col("p.first")).alias("before"),
        F.substring("bytes", (F.col("p.first") + 1).cast("int"), (F.col("p.last") - F.col("p.first") + length).cast("int")).alias("data"),
        "p.kinds",
    )
    small = cuts.filter(F.col("kinds") <= max_pieces).drop("kinds").repartition("key").sortWithinPartitions("key", "piece")
    shared = small.mapInArrow(_ordered(length), "key long, piece long, lo long, hi long")
    large = cuts.filter(F.col("kinds") > max_pieces).drop("kinds").mapInArrow(
        _windows(length), "key long, piece long, lo long, window binary"
    )
    twice = large.groupBy("window").count().filter("count > 1").select("window")
    shared = shared.unionByName(
        large.join(twice, "window", "left_semi").select("key", "piece", "lo", F.col("lo").alias("hi"))
    ) if not buckets.filter(F.col("kinds") > max_pieces).isEmpty() else shared
    copied = kinds.filter("copies > 1").select(
        "key", "piece", F.lit(0).cast("long").alias("lo"), (F.col("at.last") - F.col("at.first")).alias("hi")
    )
    where = found.select("key", "piece", "text_hash", "n", "first", "reach")
    marked = where.join(shared.unionByName(copied), ["key", "piece"]).select(
        "text_hash", "n", (F.col("first") + F.col("lo")).alias("from"), (F.col("first") + F.col("hi") + length).alias("to"),
        "reach",
    )
    # the pieces of a run equal each other, so all their windows are marked: the run is one range
    marked = marked.withColumn("to", F.col("to") + F.col("reach")).drop("reach")
    return marked.groupBy("text_hash", "n").agg(F.collect_set(F.struct("from", "to")).alias("ranges"))


def merged(ranges: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for r in sorted((r["from"], r["to"]) for r in ranges or ()):
        if out and r[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r[1])
        else:
            out.append(list(r))
    return [tuple(r) for r in out]


def _with_spans(df: DataFrame, text: str, **options) -> DataFrame:
    found = spans(df, text=text, **options).withColumnsRenamed({"text_hash": "__hash", "n": "__n"})
    keyed = df.withColumn("__h", text_key(text)).withColumn("__b", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    match = (F.col("__h") == F.col("__hash")) & (F.col("__b") == F.col("__n"))
    return keyed.join(found.hint("shuffle_hash"), match, "left").drop("__h", "__b", "__hash", "__n")


def removed(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept text of every row; bytes of
    characters that a span cuts count as kept, but the text is without them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, ranges in zip(batch.column(1), batch.column(2)):
                data = (value.as_py() or "").encode()
                runs, kept, at = merged(ranges.as_py()), [], 0
                for a, b in runs:
                    kept.append(data[at:a])
                    at = b
                left = b"".join([*kept, data[at:]])
                out.append((len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(left).hexdigest(), left.decode(errors="ignore")))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"],
            )

    joined = _with_spans(df.select("doc_id", text), text, **options)
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def without(text: str | None, ranges: list[dict] | None) -> str | None:
    """A text without the characters that lie wholly inside the ranges."""
    if text is None or not ranges:
        return text
    data, out, at = text.encode(), [], 0
    for a, b in merged(ranges):
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]]).decode()


def deduplicated(df: DataFrame, length: int = PASSAGE, gram: int = PASSAGE_GRAM, **options) -> DataFrame:
    """``df`` with repeated passages taken out of ``text`` (``n_chars`` follows).

    The window is shorter than that of :func:`removed`, so that passages of fifty
    words fill it unless their words have four letters or fewer on the mean.
    """
    joined = _with_spans(df, "text", length=length, gram=gram, **options)
    kept = df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            text = [without(t.as_py(), r.as_py()) for t, r in zip(batch.column("text"), batch.column("ranges"))]
            cols = {c: batch.column(c) for c in names if c != "ranges"}
            cols["text"] = pa.array(text, pa.string())
            yield pa.RecordBatch.from_arrays([cols[c] for c in kept], names=kept)

    out = joined.mapInArrow(run, df.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in df.columns else out
