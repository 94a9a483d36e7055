"""Token counts by distinct pre-token.

A SentencePiece BPE model merges inside stretches that no piece crosses: spaces with
the letters after them, spaces with the other characters after them, and a line feed,
which only exists as a byte piece (:func:`processor` makes sure that no piece of
the model mixes them). These pre-tokens are counted in the whole corpus, each distinct one is
encoded once, and a document's count is the sum of its frequencies times their
piece counts. Ids are never kept.

The most frequent pre-tokens, at most ``head`` of them, are broadcast and summed
where the document is read; all others meet their counts in a join. The result
does not depend on ``head``.

Edge cases: NULL and empty texts have no tokens; texts of white space only have;
repeated rows and NULL ids are counted row by row; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.llm.text import cut

MODEL = "piece_bpe_32k.model"
HEAD = 1 << 18
_DIGITS = r"\d_\u00b2\u00b3\u00b9\u00bc-\u00be"  # with raised ones and fractions, which \w takes for letters
_PRETOKEN = re.compile(rf"\n| *[^\W{_DIGITS}]+| *(?:[^\w \n]|[{_DIGITS}])+| +")
_FLUSH = 200_000  # distinct pre-tokens held while counting


@functools.lru_cache(maxsize=2)
def processor(model: str = MODEL) -> sentencepiece.SentencePieceProcessor:
    p = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
    usual = (p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i)))
    if crossing := [x for x in usual if len(_PRETOKEN.findall(x.replace("▁", " "))) > 1]:
        raise ValueError(f"{model} has pieces across pre-tokens: {crossing[:5]}")
    return p


def pretokens(text: str | None) -> list[str]:
    """The model writes a space before the text and takes U+2581 for a space."""
    if not text:
        return []
    return _PRETOKEN.findall(" " + (text.replace("▁", " ") if "▁" in text else text))


def count_pieces(tokens: list[str], model: str = MODEL) -> list[int]:
    """Pieces of single pre-tokens. Each is encoded in a text that has it as a
    pre-token: its first space is the one the model adds, or a line feed stands before it."""
    asked = [t[1:] if t[0] == " " and t != " " else "\n" if t == "\n" else "\n" + t for t in tokens]
    extra = [0 if t[0] == " " and t != " " else 1 if t == "\n" else 2 for t in tokens]
    return [len(ids) - e for ids, e in zip(processor(model).encode(asked, num_threads=1), extra)]


def _corpus(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                          names=["token", "freq"])

    for batch in batches:
        for text in batch.column(0):
            seen.update(pretokens(text.as_py()))
            if len(seen) >= _FLUSH:
                yield flush()
                seen.clear()
    if seen:
        yield flush()


def _counted(model: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = count_pieces(batch.column(0).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())], names=["token", "freq", "pieces"])

    return run


def vocabulary(df: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """Distinct pre-tokens of the corpus: token, freq, pieces."""
    seen = df.select(text).mapInArrow(_corpus, "token string, freq long")
    distinct = seen.groupBy("token").agg(F.sum("freq").alias("freq"))
    return cut(distinct.mapInArrow(_counted(model), "token string, freq long, pieces long"), "pretokens")


def _head(vocab: DataFrame, most: int) -> dict[str, int]:
    """Pre-tokens above a power of two of their frequency, so chosen that they are at most ``most``."""
    steps = vocab.groupBy(F.length(F.bin("freq")).alias("bits")).count().collect()  # 64 rows at most
    total, least = 0, 65
    for bits, n in sorted(((r["bits"], r["count"]) for r in steps), reverse=True):
        if total + n > most:
            break
        total, least = total + n, bits
    table = vocab.filter(F.length(F.bin("freq")) >= least).select("token", "pieces").toArrow()
    return dict(zip(table["token"].to_pylist(), table["pieces"].to_pylist()))


def counts(df: DataFrame, id_col: str = "doc_id", text: str = "text", model: str = MODEL, head: int = HEAD) -> DataFrame:
    """id, n_bytes and n_tokens of every row."""
    vocab = vocabulary(df, text, model)
    common = df.sparkSession.sparkContext.broadcast(_head(vocab, head))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = common.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = value.as_py()
                summed = 0
                for token, freq in Counter(pretokens(body)).items():
                    pieces = known.get(token)
                    if pieces is None:
                        for column, v in zip(out, (row, None, None, freq, token)):
                            column.append(v)
                    else:
                        summed += pieces * freq
                # the row itself, under a key of its own that is no pre-token
                for column, v in zip(out, (row, doc, len(body.encode()) if body else 0, summed, f"\n{row}")):
                    column.append(v)
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             names=["row", "doc_id", "n_bytes", "n", "token"])

    parts = df.select(F.col(id_col).cast("long"), text).mapInArrow(
        rows, "row long, doc_id long, n_bytes long, n long, token string"
    )
    known = parts.join(vocab.select("token", "pieces"), "token", "left")
    return known.groupBy("row").agg(
        F.max("doc_id").alias(id_col), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"),
    ).drop("row")
