"""Toxicity by class-conditional Kneser-Ney models.

Two character models, one of toxic and one of ordinary labelled texts, give every
character its probability after the characters before it. A class discounts its own
counts and gives the freed mass to one lower model that both classes share, built from
continuation counts of all labelled texts, so that a rare expression differs between
the classes only by what its class has seen. Words as wholes have a model of the same kind
above their characters. The evidence of a word is the sum of the log ratios of its
characters and of the word, and the score follows from the length-normalised evidence
of the text and of its strongest words, which a long harmless text must not dilute.

Characters are code points in lower case, of any script, and all grams and words of all
labelled texts are counted: the model is a Spark table that grows with the texts and is never
gathered. Texts are packed into blocks of two megabytes. Only labelled texts are counted. The units of
most blocks, up to a fixed number, are broadcast, with a bit table of fixed size of all others; a block asks the
model for those of its distinct grams and words that may be there, and what is found goes back to it. A gram that no labelled text has is answered by its
context, so it needs no row of the model. The driver sees these, totals and the grid of the fit. The two weights and the offset of the score are fitted on the
labelled texts themselves: the models for that are built without the half of the texts
that they rate, and texts enter as counts per cell of a fixed grid of the two features.
If a half lacks a class, the whole model rates the texts that it learned from.

Edge cases: NULL and empty texts have no evidence and get the score of no evidence;
labels other than 0 and 1, NULL labels and labels without a text are left out; of
repeated labels of one id the largest counts; without both classes to learn from,
every score is the toxic share (0.5 if nothing is labelled).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keytide.llm.text import cut, cut_in_buckets, few_rows

ORDER = 4
DISCOUNT = 0.75
TOP_WORDS = 3
# The grid of the fit: steps of the two features and how many lie on either side of zero.
STEPS, REACH = (0.01, 0.05), (200, 200)
# What is learned from: all labelled texts, or those of one half.
MODELS = ("whole", "first", "second")
_KINDS = ("n0", "n1", "n2", "n3")  # counts by 2 * half + toxic
_INSIDE = np.array([not chr(i).isspace() for i in range(0x3002)], np.int8)  # all later points are inside of words as the last one
_MARKS = "".join(c for c in map(chr, range(128)) if unicodedata.category(c)[0] in "PSC")
_TABLE = 1 << 23  # codes that are numbered by a table of all; more are sorted
_PART = 1 << 21  # bytes of a block; numbering its grams takes about sixty times as much memory
HEAD = 1 << 18  # most frequent units that are broadcast
_BITS, _PROBES = 1 << 25, (0, 25)  # of the bit table of the others: its size, where its hashes begin


class Head(NamedTuple):
    """What is broadcast: places of the most frequent grams (contexts among them) and words, their ratios by
    model, and two bits for each other unit of the model, by the XXH64 of its letters."""

    grams: dict[str, int]
    words: dict[str, int]
    values: list[np.ndarray]
    bits: np.ndarray


def _fit(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of a logistic model (two features, offset) of counted rows; classes count alike."""
    a = np.column_stack([x, np.ones(len(x))])
    n = n / np.where(y == 1, n[y == 1].sum(), n[y == 0].sum())
    w = np.zeros(3)
    for _ in range(60):  # Newton steps with a little shrinkage
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (n * (p - y)) + 1e-4 * w * [1, 1, 0]
        curve = (a * (n * p * (1 - p))[:, None]).T @ a + np.diag([1e-4, 1e-4, 1e-9])
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def laid(texts: list[str | None]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case texts end to end with gaps around each, their code points, where each begins and ends."""
    pad = " " * (ORDER - 1)
    low = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) for t in low], np.int64)
    ends = np.cumsum(sizes + len(pad))
    joined = "".join(pad + t for t in low) + pad
    return joined, np.frombuffer(joined.encode("utf-32-le"), np.uint32), ends - sizes, ends


def distinct(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of every distinct gram of ORDER code points, and the number of the gram that ends at each place.
    Shorter grams are numbered first and prolonged by a point each, so that the codes stay small."""
    of, size = _numbered(points.astype(np.int64), 0x110000)
    code, total = of, size
    for k in range(1, ORDER):
        code, total = _numbered(code[:-1] * size + of[k:], total * size)
    number = np.zeros(len(points), np.int64)
    number[ORDER - 1 :] = code
    at = np.zeros(total, np.int64)
    at[code] = np.arange(ORDER - 1, len(points))
    return at, number


def _numbered(code: np.ndarray, limit: int) -> tuple[np.ndarray, int]:
    """Numbers of codes below ``limit`` in their order, and how many codes differ."""
    if limit <= _TABLE:
        present = np.zeros(limit, bool)
        present[code] = True
        ids = np.cumsum(present, dtype=np.int32)
        return (ids[code] - 1).astype(np.int64), int(ids[-1])
    known, number = np.unique(code, return_inverse=True)
    return number, len(known)


def _bare(word: str) -> str:
    """A word without the marks around it; a word of marks only stays."""
    if word.isascii():
        return word.strip(_MARKS) or word
    a, b = 0, len(word)
    while a < b and unicodedata.category(word[a])[0] in "PSC":
        a += 1
    while b > a and unicodedata.category(word[b - 1])[0] in "PSC":
        b -= 1
    return word[a:b] or word


def _words(joined: str, points: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct bare words; number, first and last place of every word in order."""
    raw = pa.array(joined.split(), pa.string()).dictionary_encode()
    bare: dict[str, int] = {}
    words = raw.dictionary.to_numpy(zero_copy_only=False)
    number = np.fromiter((bare.setdefault(_bare(w), len(bare)) for w in words), np.int64, len(words))
    inside = np.zeros(len(points) + 2, np.int8)
    inside[1:-1] = _INSIDE[np.minimum(points, len(_INSIDE) - 1)]
    edge = np.diff(inside)
    return list(bare), number[raw.indices.to_numpy()], np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _features(ratio: np.ndarray, whole: np.ndarray, starts, ends, first, last) -> np.ndarray:
    """Two features per text: log ratio per character of the text, and of its strongest words.
    ``ratio``: of the gram that ends at each place, ``whole``: of every word as a whole."""
    out = np.zeros((len(starts), 2))
    running = np.concatenate([[0.0], np.cumsum(ratio)])
    length = np.maximum(ends - starts, 1)
    of = np.searchsorted(ends, first, side="right")
    out[:, 0] = (running[ends] - running[starts] + np.bincount(of, whole, len(starts))) / length
    # words with the gap after them; words never cross texts, for gaps stand between
    value = (running[last + 2] - running[first] + whole) / np.sqrt(last - first + 2)
    begin = np.flatnonzero(np.diff(of, prepend=-1))
    for _ in range(TOP_WORDS):  # the strongest word of each text, then it makes room for the next
        if not len(value):
            break
        rows, top = of[begin], np.maximum.reduceat(value, begin)
        out[rows, 1] += top / TOP_WORDS
        strongest = np.flatnonzero(value == np.repeat(top, np.diff(begin, append=len(value))))
        left = np.ones(len(value), bool)
        left[strongest[np.diff(of[strongest], prepend=-1) > 0]] = False
        value, of = value[left], of[left]
        begin = np.flatnonzero(np.diff(of, prepend=-1))
    return out


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as blocks of about _PART bytes, so that what a block asks of the model is bounded by its size."""
    number, held, size = TaskContext.get().partitionId() << 40, [], 0

    def packed() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].select([1]).schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for part in held:
                out.write_batch(part.select([1]))
        ids = pa.concat_arrays([part.column(0) for part in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
             pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "ids", "rows"])

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        begin = 0
        for i, n in enumerate(sizes):
            size += n + ORDER
            if size >= _PART:
                held.append(batch.slice(begin, i + 1 - begin))
                yield packed()
                number, held, size, begin = number + 1, [], 0, i + 1
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield packed()


def _unpacked(blob: bytes, kinds: list[dict] | None) -> tuple[list[str | None], np.ndarray]:
    """Texts of a block and their kinds: 2 * half + toxic, or -1 without a label or a text."""
    texts = pa.ipc.open_stream(blob).read_all().column(0).to_pylist()
    kind = np.full(len(texts), -1)
    for x in kinds or []:
        if texts[x["pos"]] is not None:
            kind[x["pos"]] = x["kind"]
    return texts, kind


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams and words of the labelled texts of every block with their counts by 2 * half + toxic."""
    for batch in batches:
        for blob, kinds in zip(batch.column(0), batch.column(1).to_pylist()):
            texts, kind = _unpacked(blob.as_py(), kinds)
            texts, kind = [t for t, k in zip(texts, kind) if k >= 0], kind[kind >= 0]
            if not texts:
                continue
            joined, points, starts, ends = laid(texts)
            at, number = distinct(points)
            names, word, first, _ = _words(joined, points)
            places = np.full(len(points), -1)
            sizes = ends - starts
            places[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())] = np.repeat(kind, sizes)
            of = kind[np.searchsorted(ends, first, side="right")]
            for is_word, n, number, of in ((False, len(at), number, places), (True, len(names), word, of)):
                counts = np.array([np.bincount(number[of == k], minlength=n) for k in range(4)], np.int64)
                seen = np.flatnonzero(counts.any(axis=0))  # grams of the gaps between texts were not
                units = [names[i] for i in seen] if is_word else [joined[i - ORDER + 1 : i + 1] for i in at[seen].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(units), is_word)), pa.array(units, pa.string()), *(pa.array(c) for c in counts[:, seen])],
                    names=["word", "unit", *_KINDS])


def _asked(joined: str, at: np.ndarray, names: list[str], head: Head) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Grams, words and contexts of grams, in the order in which a block numbers them; their places
    in the head, -1 for those not there; the number of every gram's context."""
    grams = [joined[j - ORDER + 1 : j + 1] for j in at.tolist()]
    contexts: dict[str, int] = {}
    after = np.fromiter((contexts.setdefault(g[:-1], len(contexts)) for g in grams), np.int64, len(grams))
    units = [*grams, *names, *contexts]
    short, words = head.grams.get, head.words.get
    place = np.fromiter((
        *(short(u, -1) for u in grams), *(words(u, -1) for u in names), *(short(u, -1) for u in contexts)), np.int64, len(units))
    return units, place, after + len(grams) + len(names)


def _asks(common):
    """What a block must look up in the model: units outside of the head, contexts of such grams among
    them, but for those that the bit table knows not to be there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest = common.value, xxhash.xxh64_intdigest
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                joined, points, _, _ = laid(_unpacked(blob.as_py(), None)[0])
                at, _ = distinct(points)
                names = _words(joined, points)[0]
                units, place, after = _asked(joined, at, names, head)
                lacking = place < 0
                needed = np.zeros(len(units), bool)
                needed[after[lacking[: len(at)]]] = True
                needed[: len(at) + len(names)] = True
                rows = np.flatnonzero(lacking & needed)
                hashes = np.fromiter((digest(units[i], 42) for i in rows.tolist()), np.uint64, len(rows))
                for shift in _PROBES:
                    bit = (hashes >> np.uint64(shift)) & np.uint64(_BITS - 1)
                    may = (head.bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    rows, hashes = rows[may], hashes[may]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), block)), pa.array((rows >= len(at)) & (rows < len(at) + len(names))),
                     pa.array([units[i] for i in rows.tolist()], pa.string()), pa.array(rows.astype(np.int32))],
                    names=["block", "word", "unit", "at"])

    return run


def _rated(common, halves: bool):
    """Features of every row of a block by the whole model, and the cell of those by the model
    of the other half, or by the whole one unless both ``halves`` have both classes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = common.value
        values = head.values
        for batch in batches:
            for i in range(batch.num_rows):
                texts, kind = _unpacked(batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                joined, points, starts, ends = laid(texts)
                at, number = distinct(points)
                names, word, first, last = _words(joined, points)
                # units of the head, then the others by their place in the block; words never heard are in neither
                _, place, after = _asked(joined, at, names, head)
                known = batch.column(3)[i].values
                asked = known.field("at").to_numpy() if known is not None else np.zeros(0, np.int64)
                found = place >= 0
                found[asked] = True
                unseen = np.flatnonzero(~found[: len(at)])
                x = []
                for k, model in enumerate(MODELS):
                    value = np.where(place >= 0, values[k][place], 0.0)
                    if len(asked):
                        value[asked] = known.field(model).to_numpy()
                    value[unseen] = value[after[unseen]]
                    x.append(_features(value[: len(at)][number], value[len(at) :][word], starts, ends, first, last))
                other = np.where((kind >= 2)[:, None], x[1], x[2]) if halves else x[0]
                cell = np.clip(np.rint(other / STEPS), [-r for r in REACH], REACH).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, pa.array(kind.astype(np.int32)), pa.array(x[0][:, 0]), pa.array(x[0][:, 1]),
                     pa.array(cell[:, 0]), pa.array(cell[:, 1])], names=["id", "kind", "x", "y", "a", "b"])

    return run


def _head(ratios: DataFrame, most: int) -> tuple[int, Head]:
    """In how many blocks a unit must be (a power of two) so that such units are at most ``most``; these with their
    ratios, and the bit table of the others."""
    steps = ratios.groupBy(F.length(F.bin("blocks")).alias("bits")).count().collect()  # 64 rows at most
    total, least = 0, 65
    for bits, n in sorted(((r["bits"], r["count"]) for r in steps), reverse=True):
        if total + n > most:
            break
        total, least = total + n, bits
    table = ratios.filter(F.length(F.bin("blocks")) >= least).select("word", "unit", *MODELS).toArrow()
    grams, words = {}, {}
    for i, (word, unit) in enumerate(zip(table["word"].to_pylist(), table["unit"].to_pylist())):
        (words if word else grams)[unit] = i
    hashed = F.xxhash64("unit")
    bit = F.explode(F.array(*(F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(_BITS - 1)) + 1 for shift in _PROBES)))
    parts = (
        ratios.filter(F.length(F.bin("blocks")) < least).select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()  # of 4 kB, _BITS bits at most
    )
    bits = np.zeros(_BITS // 8, np.uint8)
    for r in parts:
        piece = np.frombuffer(r["bits"], np.uint8)
        bits[(r["part"] - 1) * len(piece) : r["part"] * len(piece)] = piece
    return least, Head(grams, words, [np.append(table[m].to_numpy(), 0.0) for m in MODELS], bits)


def _sides(model: str) -> tuple[Column, Column]:
    """Counts of a unit in ordinary and toxic texts that a model learns from."""
    n = {k: F.col(k) for k in _KINDS}
    return {"whole": (n["n0"] + n["n2"], n["n1"] + n["n3"]), "first": (n["n0"], n["n1"]), "second": (n["n2"], n["n3"])}[model]


def _share(cont: Column, total: Column, kinds: Column, back: Column) -> Column:
    """Discounted share of a count and, from what is left, of the lower model; the lower model alone if nothing was counted."""
    part = F.greatest(cont - DISCOUNT, F.lit(0.0)) / total + DISCOUNT * kinds / total * back
    return F.when(total > 0, part).otherwise(back)


def lower_model(seen: DataFrame, size: int = 0x110000) -> DataFrame:
    """Shared probabilities of the last of ORDER - 1 symbols after the others, from grams seen by
    each model (unit and a flag per model): the continuation counts of all orders below."""
    levels = []
    for k in range(ORDER - 1, 0, -1):
        seen = seen.groupBy(F.substring("unit", 2, k).alias("unit")).agg(*(F.sum(F.col(m).cast("long")).alias(m) for m in MODELS))
        levels.append(seen)
        seen = seen.select("unit", *((F.col(m) > 0).alias(m) for m in MODELS))
    total = levels[-1].agg(*(f(m).alias(f"{n}_{m}") for m in MODELS for n, f in (("t", F.sum), ("k", lambda m: F.sum((F.col(m) > 0).cast("long")))))).first()
    p = None
    for k, level in enumerate(reversed(levels), 1):
        if p is None:
            parts = {m: (F.lit(total[f"t_{m}"] or 0), F.lit(total[f"k_{m}"] or 0), F.lit(1.0 / size)) for m in MODELS}
        else:
            same = Window.partitionBy(F.substring("unit", 1, k - 1))
            level = level.select("*", *(F.sum(m).over(same).alias(f"t_{m}") for m in MODELS),
                                 *(F.sum((F.col(m) > 0).cast("long")).over(same).alias(f"k_{m}") for m in MODELS))
            level = level.withColumn("back", F.substring("unit", 2, k - 1)).join(p, "back")
            parts = {m: (F.col(f"t_{m}"), F.col(f"k_{m}"), F.col(f"p_{m}")) for m in MODELS}
        p = level.select(F.col("unit").alias("back"), *(_share(F.col(m), *parts[m]).alias(f"p_{m}") for m in MODELS))
    return p


def log_ratios(units: DataFrame, size: int = 0x110000) -> DataFrame:
    """``units``: distinct (word, unit, n0..n3), seen in labelled texts or not. Adds the log ratio of
    every unit under every model; the table has as many rows as there are units."""
    passed = [c for c in units.columns if c not in _KINDS]
    grams_of, words_of = units.filter(~F.col("word")), units.filter("word")
    seen = grams_of.filter("n0 + n1 + n2 + n3 > 0").select("unit", *((_sides(m)[0] + _sides(m)[1] > 0).alias(m) for m in MODELS))
    after = Window.partitionBy(F.substring("unit", 1, ORDER - 1))

    def ratio(sides, totals, kinds, low) -> Column:
        shares = []
        for n, total, kind in zip(sides, totals, kinds):
            left = F.when(total > 0, DISCOUNT * kind / total).otherwise(F.lit(1.0))
            shares.append(F.greatest(n - DISCOUNT, F.lit(0.0)) / F.greatest(total, F.lit(1)) + left * low)
        return F.log(shares[1]) - F.log(shares[0])

    held = grams_of.select("*", *(F.sum(n).over(after).alias(f"t{c}_{m}") for m in MODELS for c, n in enumerate(_sides(m))),
                           *(F.sum((n > 0).cast("long")).over(after).alias(f"k{c}_{m}") for m in MODELS for c, n in enumerate(_sides(m))))
    held = held.withColumn("back", F.substring("unit", 2, ORDER - 1)).join(lower_model(seen, size), "back", "left")
    # a unit that a model has not seen has the ratio of what is left in its context, whatever the lower model says
    rated = held.select(*passed, *(
        ratio(_sides(m), [F.col(f"t{c}_{m}") for c in (0, 1)], [F.col(f"k{c}_{m}") for c in (0, 1)],
              F.when(_sides(m)[0] + _sides(m)[1] > 0, F.col(f"p_{m}")).otherwise(F.lit(1.0))).cast("float").alias(m) for m in MODELS))
    all_words = words_of.agg(*(f(n).alias(f"{x}{c}_{m}") for m in MODELS for c, n in enumerate(_sides(m))
                               for x, f in (("t", F.sum), ("k", lambda n: F.sum((n > 0).cast("long")))))).first()
    number = {k: F.lit(v or 0) for k, v in all_words.asDict().items()}
    heard = []
    for m in MODELS:  # a word never heard is left to its characters
        n = _sides(m)
        share = (n[0] + n[1]) / F.greatest(number[f"t0_{m}"] + number[f"t1_{m}"], F.lit(1))
        value = ratio(n, [number[f"t{c}_{m}"] for c in (0, 1)], [number[f"k{c}_{m}"] for c in (0, 1)], share)
        heard.append(F.when(n[0] + n[1] > 0, value).otherwise(F.lit(0.0)).cast("float").alias(m))
    return rated.unionAll(words_of.select(*passed, *heard))


def context_ratios(units: DataFrame) -> DataFrame:
    """Contexts of the grams in ``units`` (word, unit, n0..n3, blocks) with the ratio that a gram has after them which no
    text of any model holds: that of what the classes leave."""
    sides = {f"{m}{c}": n for m in MODELS for c, n in enumerate(_sides(m))}
    held = units.filter("NOT word").groupBy(F.substring("unit", 1, ORDER - 1).alias("unit")).agg(
        F.max("blocks").alias("blocks"), *(F.sum(n).alias(f"t{x}") for x, n in sides.items()),
        *(F.sum((n > 0).cast("long")).alias(f"k{x}") for x, n in sides.items()))
    left = {x: F.when(F.col(f"t{x}") > 0, DISCOUNT * F.col(f"k{x}") / F.col(f"t{x}")).otherwise(F.lit(1.0)) for x in sides}
    return held.select(F.lit(False).alias("word"), "unit", "blocks",
                       *((F.log(left[f"{m}1"]) - F.log(left[f"{m}0"])).cast("float").alias(m) for m in MODELS))


def scores(df: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and score of every row of ``df``. ``labels``: id, toxic. ``learn`` is a condition
    on the id that says whose labels may be used."""
    known = (
        labels.filter("toxic IN (0, 1)").filter(learn).groupBy(id_col).agg(F.max("toxic").cast("int").alias("__toxic"))
        .select(F.col(id_col).alias("id"), (F.crc32(F.col(id_col).cast("string")) % 5 % 2 * 2 + F.col("__toxic")).cast("int").alias("kind"))
    )
    few_rows(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), text)
    blocks = cut_in_buckets(rows.mapInArrow(_blocks, "block long, ids array<long>, rows binary"), "text-blocks", "block", "zstd")
    # ids alone meet the labels; one way at every size: labels grow with the documents
    kinds = blocks.select("block", F.posexplode("ids").alias("pos", "id")).join(known.hint("shuffle_hash"), "id")
    kinds = cut(kinds.groupBy("block").agg(F.collect_list(F.struct("pos", "kind")).alias("kinds")), "block-labels")
    counted = blocks.join(kinds, "block").select("rows", "kinds").mapInArrow(
        _counts, f"word boolean, unit string, {', '.join(f'{k} long' for k in _KINDS)}"
    )
    units = counted.groupBy("word", "unit").agg(*(F.sum(k).alias(k) for k in _KINDS), F.count("*").alias("blocks"))
    units = cut(units, "units", "zstd")
    sums = units.filter("NOT word").agg(*(F.sum(k).alias(k) for k in _KINDS)).first()
    sums = np.array([x or 0 for x in sums]).reshape(2, 2)
    share = float(sums[:, 1].sum() / sums.sum()) if sums.sum() else 0.5
    if not sums.sum(axis=0).all():
        return df.select(F.col(id_col).cast("long").alias(id_col), F.lit(share).alias("score"))
    ratios = cut(log_ratios(units).unionByName(context_ratios(units)), "log-ratios", "zstd")
    least, head = _head(ratios, HEAD)
    common = df.sparkSession.sparkContext.broadcast(head)
    tail = ratios.filter(F.length(F.bin("blocks")) < least).drop("blocks")
    asked = blocks.select("block", "rows").mapInArrow(_asks(common), "block long, word boolean, unit string, at int")
    asked = asked.join(tail, ["word", "unit"]).groupBy("block").agg(F.collect_list(F.struct("at", *MODELS)).alias("known"))
    rated = blocks.join(kinds, "block", "left").join(asked, "block", "left").select("ids", "rows", "kinds", "known")
    rated = cut(rated.mapInArrow(_rated(common, bool(sums.all())), "id long, kind int, x double, y double, a int, b int"), "features", "zstd")
    cells = rated.filter("kind >= 0").groupBy("a", "b", (F.col("kind") % 2).alias("toxic")).count().toArrow()
    x = np.column_stack([cells["a"].to_numpy(), cells["b"].to_numpy()]) * STEPS
    w = [float(v) for v in _fit(x, cells["toxic"].to_numpy(), cells["count"].to_numpy().astype(np.float64))]
    # within what a double can raise
    value = F.least(F.greatest(F.col("x") * w[0] + F.col("y") * w[1] + w[2], F.lit(-700.0)), F.lit(700.0))
    return rated.select(F.col("id").alias(id_col), (1 / (1 + F.exp(-value))).alias("score"))
