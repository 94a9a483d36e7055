"""Divergence of sources: how far the term shares of a source lie from the others'.

Indexing is single-pass and in memory: a task adds the terms of its documents to a
dictionary per (lang, source), and when the dictionary holds ``block`` entries it is
put out as a run sorted by term. Runs are dealt to shards by the hash of (lang, term);
in a shard Spark's sort merges them through its heap of sorted, spilled files, and a task
folds the merged stream, a term at a time, into frequencies and document counts. No
pass over the texts is repeated.

All shares are integers: ``share(c) = 1 + floor(SCALE * (c + PRIOR) / (n + PRIOR * v))``.
The distance of two sources over all kept terms is not added up term by term and
pair. A term that neither has adds the same amount, so a pair starts with the number of
terms times that amount; then the merged terms are streamed once more and every term
corrects the pairs of the sources that have it. Corrections gather in a matrix of
``cells`` cells at most: with more sources than fit, the pairs are done in stripes.

The driver and the tasks hold one row per (lang, source), which is the square root of
the result, and nothing else.

Edge cases: NULL texts, langs and sources are ''; groups without terms have pairs
too, of distance 0 if their lang keeps no term; repeated rows are documents of
their own; ties rank by the UTF-8 bytes of the item; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keytide.llm.text import cut

SCALE = 1_000_000_000
PRIOR = 5
MIN_DOCS = 30
TOP = 50

BLOCK = 300_000  # entries of a task's dictionary
PIECE = 1 << 20  # bytes of a text split at once
CELLS = 1 << 21  # of a task's matrix of corrections

# bytes outside terms become spaces; A-Z become a-z
_TERM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Terms of a text, some at a time."""
    at = 0
    while at < len(text):
        end = at + piece
        if end < len(text):  # on to the end of a term
            clean = text[at:end].translate(_TERM)
            while end < len(text) and clean[-1:] != b" ":
                more = text[end : end + 4096].translate(_TERM)
                stop = more.find(b" ") + 1 or len(more)
                clean, end = clean + more[:stop], end + stop
        else:
            clean = text[at:].translate(_TERM)
        yield clean.split()
        at = end


def _runs(block: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def spill() -> Iterator[pa.RecordBatch]:
            columns: tuple[list, ...] = ([], [], [], [], [])
            for (lang, source), (n, docs) in index.items():
                columns[0].extend([lang] * len(n))
                columns[1].extend(n.keys())
                columns[2].extend([source] * len(n))
                columns[3].extend(n.values())
                columns[4].extend(docs[t] for t in n)
            index.clear()
            kinds = (pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64())
            table = pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "term", "source", "n", "docs"])
            table = table.set_column(1, "term", table["term"].cast(pa.string()))
            yield from table.sort_by([(c, "ascending") for c in ("lang", "term", "source")]).to_batches(max_chunksize=10_000)

        for batch in batches:
            for lang, source, value in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2).cast(pa.binary())):
                seen: set[bytes] = set()
                for found in terms(value.as_py() or b""):
                    n, docs = index.setdefault((lang, source), (Counter(), Counter()))
                    held -= len(n)
                    n.update(found)
                    held += len(n)
                    new = set(found) - seen if seen else set(found)
                    docs.update(new)
                    seen |= new
                    if held >= block:
                        yield from spill()
                        held = 0
        yield from spill()

    return run


def _starts(table: pa.Table, names: list[str]) -> np.ndarray:
    """Rows that differ from the one before them."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for name in names:
        column = table[name]
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _folded(table: pa.Table) -> pa.Table:
    """One row per (lang, term, source) of sorted rows."""
    if not len(table):
        return table
    at = _starts(table, ["lang", "term", "source"])
    out = table.take(pa.array(at))
    for i, name in ((3, "n"), (4, "docs")):
        out = out.set_column(i, name, pa.array(np.add.reduceat(table[name].to_numpy(), at)))
    return out.combine_chunks()


def _merged(least: int):
    def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if len(table):
            at = _starts(table, ["lang", "term"])
            ends = pa.array(np.append(at, len(table)), pa.int32())
            docs = np.add.reduceat(table["docs"].to_numpy(), at)
            out = pa.table([
                table["lang"].take(pa.array(at)), table["term"].take(pa.array(at)), pa.array(docs),
                pa.array(np.add.reduceat(table["n"].to_numpy(), at)),
                pa.ListArray.from_arrays(ends, table["source"].combine_chunks()),
                pa.ListArray.from_arrays(ends, table["n"].combine_chunks()),
            ], names=["lang", "term", "docs", "total", "sources", "counts"])
            yield from out.filter(pa.array(docs >= least)).combine_chunks().to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = _folded(table if rest is None else pa.concat_tables([rest, table]))
            last = _starts(table, ["lang", "term"])[-1]  # the term whose rows may go on
            yield from rows(table[:last])
            rest = table[last:]
        if rest is not None:
            yield from rows(rest)

    return run


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK) -> DataFrame:
    """lang, term, docs, total, sources, counts of every term in at least ``min_docs`` documents of its lang.

    ``docs`` has lang, source and text.
    """
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), "text")
    runs = texts.mapInArrow(_runs(block), "lang string, term string, source string, n long, docs long")
    shards = runs.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return shards.mapInArrow(
        _merged(min_docs), "lang string, term string, docs long, total long, sources array<string>, counts array<long>"
    )


def share(count: Column, n: Column, v: Column) -> Column:
    """In units of 1 / SCALE, floored, plus one; NULL without kept terms."""
    whole = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(v > 0, F.call_function("div", whole, (n + v * PRIOR).cast("decimal(20,0)")) + 1)


def shares(count: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """The same in 64 bits: SCALE is divided in two steps."""
    whole = n + v * PRIOR
    first, rest = np.divmod((count + PRIOR) % whole * 100_000, whole)
    return 1 + (count + PRIOR) // whole * SCALE + first * (SCALE // 100_000) + rest * (SCALE // 100_000) // whole


def _corrected(groups: dict[str, tuple[pa.Array, np.ndarray, int]], heights: dict[str, int], cells: int):
    """Corrections of a stripe's sources against all others of the lang. A term that both
    sources have is met from either side, so it counts once there and others twice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[str, int] | None = None
        total = np.zeros((0, 0), np.int64)

        def put() -> Iterator[pa.RecordBatch]:
            if at is not None and total.any():
                names, first = groups[at[0]][0], at[1] * heights[at[0]]
                for i in np.flatnonzero(total.any(axis=1)).tolist():
                    yield pa.RecordBatch.from_arrays([
                        pa.array([at[0]] * len(names), pa.string()), pa.array([names[first + i].as_py()] * len(names), pa.string()),
                        names, pa.array(total[i]),
                    ], names=["lang", "source", "item", "twice"])

        for batch in batches:
            langs, stripes = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            cuts = [i for i in range(1, batch.num_rows) if stripes[i] != stripes[i - 1] or langs[i] != langs[i - 1]]
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if begin == end:
                    continue
                lang, stripe = langs[begin], int(stripes[begin])
                names, n, v = groups[lang]
                width = len(names)
                first = stripe * heights[lang]
                if at != (lang, stripe):
                    yield from put()
                    at, total = (lang, stripe), np.zeros((min(heights[lang], width - first), width), np.int64)
                none = shares(np.zeros(width, np.int64), n, v)
                for low in range(begin, end, step := max(1, cells // width)):
                    some = batch.slice(low, min(step, end - low))
                    lists = some.column(2)
                    row = np.repeat(np.arange(some.num_rows), lists.value_lengths().to_numpy())
                    place = pc.index_in(lists.flatten(), value_set=names).to_numpy()
                    p = np.tile(none, (some.num_rows, 1))
                    p[row, place] = shares(some.column(3).flatten().to_numpy(), n[place], v)
                    has = np.zeros(p.shape, bool)
                    has[row, place] = True
                    for i in range(len(total)):
                        mine = has[:, first + i]
                        if mine.any():
                            own = p[mine]
                            more = np.abs(own[:, first + i : first + i + 1] - own) - np.abs(none[first + i] - none)
                            total[i] += (more * (2 - has[mine])).sum(axis=0)
        yield from put()

    return run


def corrections(kept: DataFrame, groups: DataFrame, cells: int = CELLS) -> DataFrame:
    """lang, source, item, twice: parts of twice the correction of a pair, seen from its source."""
    known: dict[str, tuple[list[str], list[int], int]] = {}
    for r in groups.filter("v > 0").orderBy("lang", "source").toLocalIterator():  # one row per (lang, source)
        names, n, _ = known.setdefault(r["lang"], ([], [], r["v"]))
        names.append(r["source"])
        n.append(r["n"])
    arrays = {x: (pa.array(names, pa.string()), np.array(n, np.int64), v) for x, (names, n, v) in known.items()}
    heights = {x: max(1, min(len(names), cells // len(names))) for x, (names, _, _) in known.items()}
    stripes = F.lit(0)
    for lang, (names, _, _) in known.items():
        if heights[lang] < len(names):
            stripes = F.when(F.col("lang") == lang, (len(names) - 1) // heights[lang]).otherwise(stripes)
    rows = kept.select("lang", F.explode(F.sequence(F.lit(0), stripes)).alias("stripe"), "sources", "counts")
    return rows.sortWithinPartitions("lang", "stripe").mapInArrow(
        _corrected(arrays, heights, cells), "lang string, source string, item string, twice long"
    )


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value, rank.

    ``pair``: the distance to each other source of the lang; ``term``: the ``top`` terms
    with the largest surplus over their share in the lang.
    """
    kept = cut(frequencies(docs, min_docs, block), "kept-terms")
    flat = kept.select("lang", "term", "total", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("count"))))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = groups.join(flat.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n", "v", "n_lang")}
    groups = cut(groups.join(langs, "lang", "left").withColumns(zero), "source-groups")

    lacking = groups.withColumn("none", F.coalesce(share(F.lit(0), F.col("n"), F.col("v")), F.lit(0)))
    other = lacking.select("lang", F.col("source").alias("item"), F.col("none").alias("other"))
    twice = corrections(kept, groups, cells)
    twice = twice.union(twice.select("lang", "item", "source", "twice"))
    pairs = lacking.join(other, "lang").filter("source <> item").join(
        twice.groupBy("lang", "source", "item").agg(F.sum("twice").alias("twice")), ["lang", "source", "item"], "left"
    )
    same = F.col("v") * F.abs(F.col("none") - F.col("other"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item",
                         (same + F.call_function("div", F.coalesce("twice", F.lit(0).cast("long")), F.lit(2))).alias("value"))

    rated = flat.join(groups, ["lang", "source"])
    surplus = share(F.col("count"), F.col("n"), F.col("v")) - share(F.col("total"), F.col("n_lang"), F.col("v"))
    found = rated.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), surplus.alias("value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    found = found.filter("value > 0").withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ranked)).union(found)
