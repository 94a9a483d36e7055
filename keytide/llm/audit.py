"""Interaction of filters: what each removes, alone and after the others.

Texts pass once through a finite-state transducer over their UTF-8 bytes. It has two
states, between words and inside one, and one table: the state before a byte and the
byte give the marks of that byte (a word begins, a word ends, a capital, a
symbol, a code point) and the next state. The next state hangs on the byte alone, so a
block of bytes is looked up at once; the state, and the word it cuts, pass to the next
block. The spans of words that come out go into a hash table whose hits are verified
by comparing their bytes, and its size is the number of distinct words.

Which filters a text fails is one bit mask. Documents are counted by part and mask, and
every order and step of the filters is read off these counts, so the number of
orders never meets the number of documents.

Edge cases: NULL texts are empty (they have no word and are equal to each other and to
''); a row with NULL doc_id neither has nor is a smaller one; repeated rows count one by
one, and rows of one doc_id with equal texts are no copies of each other; several
labels of one document hold if any does; NULL parts are ''; no documents, no rows.
Texts are taken for equal by their SHA-256.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.llm.text import cut

# The character classes and limits of the five filters.
SYMBOLS = b"#$%&*|"
GAPS = b"\x20\x09\x0a\x0b\x0c\x0d"
MIN_WORDS = 50
MIN_DISTINCT = 65  # percent of the words
MAX_CAPITALS = 5  # percent of the code points

BLOCK = 1 << 20  # bytes looked up at once
WORD, BEGIN, END, CAPITAL, SYMBOL, POINT = (1 << i for i in range(6))


def _transducer() -> np.ndarray:
    """Marks for (state, byte); the mark WORD is the next state."""
    table = np.zeros((2, 256), np.uint8)
    for byte in range(256):
        marks = CAPITAL * (65 <= byte <= 90) + SYMBOL * (byte in SYMBOLS) + POINT * (byte & 0xC0 != 0x80)
        table[:, byte] = marks + WORD * (byte not in GAPS)
        table[0, byte] |= BEGIN * (byte not in GAPS)
        table[1, byte] |= END * (byte in GAPS)
    return table


TABLE = _transducer()
_FLAT = TABLE.ravel()
_NEXT = (TABLE[0] & WORD).astype(np.uint16) << 8  # state after a byte, as an offset into the flat table


def counted(text: bytes, block: int = BLOCK) -> tuple[int, int, int, int, int]:
    """Words, distinct words, capitals, code points and symbols of a text."""
    marks, table, state, open_word = np.zeros(64, np.int64), set(), 0, b""
    for at in range(0, len(text), block):
        piece = text[at : at + block]
        values = np.frombuffer(piece, np.uint8)
        before = np.empty(len(values), np.uint16)
        before[0], before[1:] = state << 8, _NEXT[values[:-1]]
        out = _FLAT[before + values]
        marks += np.bincount(out, minlength=64)
        begins, ends = np.flatnonzero(out & BEGIN).tolist(), np.flatnonzero(out & END).tolist()
        if state:  # the word that the last block cut
            if not ends:
                open_word += piece
                continue
            table.add(open_word + piece[: ends[0]])
            del ends[0]
        state = int(out[-1] & WORD)
        table.update(map(piece.__getitem__, map(slice, begins, ends)))
        open_word = piece[begins[-1] :] if state else b""
    if state:
        table.add(open_word)
    of = lambda mark: int(marks[np.arange(64) & mark > 0].sum())
    return of(BEGIN), len(table), of(CAPITAL), of(POINT), of(SYMBOL)


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch.column(2).cast(pa.binary()):
            text = value.as_py() or b""
            rows.append((hashlib.sha256(text).digest(), *counted(text)))
        columns = list(zip(*rows)) or [[]] * 6
        kinds = [pa.binary(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            names=["doc_id", "part", "sha", "n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"],
        )


def measures(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part, sha of the text, n_words, n_distinct, n_capitals, n_points, n_symbols."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(part).cast("string"), F.lit("")), "text").mapInArrow(
        _measured, "doc_id long, part string, sha binary, n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long"
    )


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """``measures`` of every row with the columns A to E: true where it fails that filter."""
    rows = cut(measures(docs, part), "audit-measures")
    copies = rows.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    rows = rows.join(copies.filter("last > first").select("sha", "first"), "sha", "left")
    return rows.select("*", *(c.alias(name) for name, c in {
        "A": F.col("n_words") < MIN_WORDS,
        "B": F.col("n_distinct") * 100 < F.col("n_words") * MIN_DISTINCT,
        "C": F.col("n_capitals") * 100 > F.col("n_points") * MAX_CAPITALS,
        "D": F.col("n_symbols") > 0,
        "E": F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)),
    }.items())).drop("first")


def labelled(rows: DataFrame, labels: DataFrame, marks: dict[str, Column]) -> DataFrame:
    """Boolean columns that hold where any label of the row's doc_id meets the condition."""
    found = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *(F.max(F.coalesce(c, F.lit(False))).alias(name) for name, c in marks.items())
    )
    return rows.join(found, "doc_id", "left").withColumns({m: F.coalesce(m, F.lit(False)) for m in marks})


def _steps(filters: Sequence[str]) -> list[dict]:
    """Every order and step: the bits of the filters before it, and its own."""
    bit = {name: 1 << i for i, name in enumerate(filters)}
    return [
        {"filter_order": "".join(order), "step": i + 1, "before": sum(bit[x] for x in order[:i]), "bit": bit[order[i]]}
        for order in itertools.permutations(filters) for i in range(len(order))
    ]


def interactions(rows: DataFrame, filters: Sequence[str], lost: dict[str, str]) -> DataFrame:
    """Counts per part, order of the filters and step.

    ``filters`` are boolean columns (true: fails), ``lost`` names a count of removed rows
    for a boolean column. Columns: part, filter_order, step, kept, removed, redundant,
    unique_fails, shapley and those of ``lost``. The number of orders is the factorial
    of the number of filters, whose bits must fit an int.
    """
    mask = sum((F.col(f).cast("int") * (1 << i) for i, f in enumerate(filters)), F.lit(0))
    groups = rows.groupBy("part", mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(c)).alias(name) for name, c in lost.items())
    )
    # at most one entry per mask
    parts = groups.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *lost)).alias("__g"))
    plan = F.from_json(F.lit(json.dumps(_steps(filters))), "array<struct<filter_order:string,step:int,before:int,bit:int>>")
    steps = parts.select("part", "__g", F.inline(plan))
    before, bit, orders = F.col("before"), F.col("bit"), math.factorial(len(filters))

    def total(test, value=lambda g: g["n"]) -> Column:
        return F.aggregate("__g", F.lit(0).cast("long"), lambda s, g: s + F.when(test(g["mask"]), value(g)).otherwise(F.lit(0)))

    def fails(m: Column) -> Column:
        return m.bitwiseAND(bit) != 0

    def fresh(m: Column) -> Column:
        return m.bitwiseAND(before) == 0

    return steps.select(
        "part", "filter_order", "step",
        total(lambda m: fresh(m) & ~fails(m)).alias("kept"),
        total(lambda m: fresh(m) & fails(m)).alias("removed"),
        total(lambda m: ~fresh(m) & fails(m)).alias("redundant"),
        total(lambda m: m == bit).alias("unique_fails"),
        *(total(lambda m: fresh(m) & fails(m), lambda g, c=name: g[c]).alias(name) for name in lost),
        # of the filters that a row fails, each comes first in as many orders
        total(fails, lambda g: g["n"] * (F.lit(orders) / F.bit_count(g["mask"])).cast("long")).alias("shapley"),
    )
