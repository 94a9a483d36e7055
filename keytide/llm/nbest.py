"""SentencePiece encoding by N-best segmentation, and decoding.

Pieces of the model that match at a place of the text are the edges of a lattice. A
forward Viterbi pass gives every node the best score of a path from the start. The
backward search begins at the end and always extends the hypothesis with the best
sum of its own score and the forward score of its node; as forward scores are exact,
hypotheses reach the start in order of their whole scores, and the first N to do so
are the N best.

No piece crosses a pre-token, so the lattice of a text is a chain of the lattices of
its pre-tokens. A worker keeps the best segmentation of those it met last, in two
generations of bounded size, and searches others again, thousands side by side: one search
costs less than sending a rare pre-token through a join. Only the cost of a pre-token's second choice is
kept beside its best: the least that an edge beside the best path loses against it, for that
is the first hypothesis that the backward search would leave the path by. The N best
segmentations of a text come from the N - 1 places whose second choice costs least; all choices
there are searched then. Every one of the N is written out with all its ids and decoded as a whole.

Scores are the model's own piece scores (whole numbers for this model, so sums are
exact). Characters without a piece become their bytes at ``UNKNOWN`` below the lowest
score. Ties go to the segmentation whose last pieces are longer.

Edge cases: NULL stays NULL with no pieces; empty texts have one segmentation, the
empty one; very long words are searched like any other; decoding gives the text
back, except that U+2581 comes back as the space that it means.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import operator
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers  # noqa: F401  (its files are read through the processor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide.llm.tokens import MODEL, pretokens, processor

N_BEST = 3
UNKNOWN = 10
BARRED = -1_000_000_000  # fixed value: the model's score of pieces that merges never make
_KEPT = 200_000  # pre-tokens in each of a worker's two generations
_ROUND = 50_000  # pre-tokens looked up between two looks at the size of a generation
_GROUP = 1 << 18  # characters of texts that are looked up together
_LONG, _ABREAST = 100, 5_000  # pre-tokens searched side by side: how long and how many at most
_NO_GAP, _LOWEST = 1 << 62, -(1 << 62)
_EDGE = 0  # key of a trie node's piece; all other keys are characters

Best = list[tuple[int, tuple[int, ...]]]  # score, ids
Kept = tuple[int, bytes, int]  # of a pre-token: best score, its packed ids, cost of the second choice


class Lattice:
    """Pieces of a model with their ids and scores."""

    def __init__(self, model: str = MODEL):
        p = processor(model)
        usual = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        self.pieces = {p.id_to_piece(i): (i, int(p.get_score(i)), (i,)) for i in usual}
        self.root: dict = {_EDGE: None}
        for piece, edge in self.pieces.items():
            node = self.root
            for character in piece:
                node = node.setdefault(character, {_EDGE: None})
            node[_EDGE] = edge
        self.bytes = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_ids = np.array(self.bytes, np.int32)
        # the trie once more as arrays: children of the root by point, all others by node and point
        nodes, below = [self.root], []
        for at, node in enumerate(nodes):  # grows as it goes
            for key, child in node.items():
                if key != _EDGE:
                    below.append((at << 21 | ord(key), len(nodes)))
                    nodes.append(child)
        self.steps, self.children = np.array([(-1, 0), *sorted(below)], np.int64).T.copy()
        self.heads = np.zeros(0x110000, np.int32)  # node 0, the root, is no child: it stands for none
        of_root = self.steps[1:] < 1 << 21
        self.heads[self.steps[1:][of_root]] = self.children[1:][of_root]
        self.node_piece = np.array([-1 if n[_EDGE] is None else n[_EDGE][0] for n in nodes], np.int32)
        self.node_score = np.array([0 if n[_EDGE] is None else n[_EDGE][1] for n in nodes], np.int64)
        self.unknown = min(s for _, s, _ in self.pieces.values() if s > BARRED) - UNKNOWN
        self.model = model
        self.forget(0)

    def forget(self, n: int) -> None:
        """Keep nothing, and from now on keep searches for the n best."""
        self.held: int = n
        self.young: dict[str, Kept] = {}
        self.old: dict[str, Kept] = {}
        self.choices = functools.lru_cache(_ROUND // 10)(self.choices_of)

    def search(self, word: str, n: int) -> Best:
        """N best segmentations of a pre-token, best first."""
        size, root, pieces, unknown = len(word), self.root, self.pieces, self.unknown
        best = [_LOWEST] * (size + 1)
        best[0] = 0
        into: list[list] = [[] for _ in range(size + 1)]  # best score through a piece that ends here, its start, the piece
        for at in range(size):
            here, end, node = best[at], at, root
            while end < size:
                node = node.get(word[end])
                if node is None:
                    break
                end += 1
                edge = node[_EDGE]
                if edge is not None:
                    through = here + edge[1]
                    into[end].append((through, at, edge))
                    if through > best[end]:
                        best[end] = through
            if word[at] not in pieces:
                through = here + unknown
                into[at + 1].append((through, at, (0, unknown, tuple(self.bytes[b] for b in word[at].encode()))))
                if through > best[at + 1]:
                    best[at + 1] = through
        # hypotheses in the order of their whole scores. No two of them share a whole path, so
        # only as many as answers are still missing can matter: the rest is never kept.
        out: Best = []
        order = 0
        open_: list = [(-best[size], 0, size, 0, ())]  # whole score, order, node, own score, (ids, rest)
        while open_:
            whole, _, end, own, tail = open_.pop(0)
            room = n - len(out)
            if end == 0:
                ids: list[int] = []
                while tail:
                    ids.extend(tail[0])
                    tail = tail[1]
                out.append((-whole, tuple(ids)))
                if room == 1:
                    break
                continue
            for through, start, edge in into[end]:
                whole = -own - through
                if len(open_) < room or whole < open_[-1][0]:
                    order += 1
                    bisect.insort(open_, (whole, order, start, own + edge[1], (edge[2], tail)))
                    if len(open_) > room:
                        open_.pop()
        return out

    def first(self, word: str) -> tuple[int, tuple[int, ...], int]:
        """Score and ids of the best segmentation of a pre-token, and what the second best costs more."""
        size, root, pieces, unknown = len(word), self.root, self.pieces, self.unknown
        best = [_LOWEST] * (size + 1)
        best[0] = 0
        second = [_LOWEST] * (size + 1)  # best score through any other piece that ends here
        into: list = [None] * (size + 1)  # start and piece of the best path; of equal ones the longest
        for at in range(size):
            here, end, node = best[at], at, root
            while end < size:
                node = node.get(word[end])
                if node is None:
                    break
                end += 1
                edge = node[_EDGE]
                if edge is not None:
                    through = here + edge[1]
                    if through > best[end]:
                        second[end], best[end], into[end] = best[end], through, (at, edge[2])
                    elif through > second[end]:
                        second[end] = through
            if word[at] not in pieces:
                through = here + unknown
                if through > best[at + 1]:
                    second[at + 1], best[at + 1] = best[at + 1], through
                    into[at + 1] = (at, tuple(self.bytes[b] for b in word[at].encode()))
                elif through > second[at + 1]:
                    second[at + 1] = through
        parts, gap, end = [], _NO_GAP, size
        while end:
            if second[end] > _LOWEST and best[end] - second[end] < gap:
                gap = best[end] - second[end]
            end, ids = into[end]
            parts.append(ids)
        if len(parts) == 1:
            return best[size], parts[0], gap
        return best[size], tuple(i for ids in reversed(parts) for i in ids), gap

    def choices_of(self, word: str) -> list[tuple[int, bytes]]:
        """Scores and packed ids of the n best segmentations of a pre-token."""
        return [(score, _packed(ids)) for score, ids in self.search(word.replace(" ", "▁"), self.held)]

    def firsts(self, words: list[str]) -> list[Kept]:
        """What `first` finds for each of many pre-tokens, side by side: edges of all their lattices
        by the place that they start from, as far as the longest of them goes."""
        sizes = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).replace(" ", "▁").encode("utf-32-le"), np.uint32).astype(np.int64)
        of = np.repeat(np.arange(len(words)), sizes)  # the pre-token of a character
        ends = np.cumsum(sizes)
        begins, limit = (ends - sizes)[of], ends[of]
        # edges: the character that each starts at, its length and the trie's node of its piece, 0 for bytes
        at, node, found = np.arange(len(points)), self.heads[points].astype(np.int64), []
        lacks = self.node_piece[node] < 0
        found.append((at[lacks], np.ones(lacks.sum(), np.int64), np.zeros(lacks.sum(), np.int64)))
        at, node, depth = at[node > 0], node[node > 0], 0
        while len(at):
            depth += 1
            ended = self.node_piece[node] >= 0
            found.append((at[ended], np.full(ended.sum(), depth), node[ended]))
            on = at + depth < limit[at]
            at, node = at[on], node[on]
            step = node << 21 | points[at + depth]
            place = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            on = self.steps[place] == step
            at, node = at[on], self.children[place[on]]
        at, length, node = map(np.concatenate, zip(*found))
        place = at - begins[at]
        by = np.argsort(place, kind="stable")
        at, length, node = at[by], length[by], node[by]
        start = at + of[at]  # places between characters: one more than characters in every pre-token
        end = start + length
        score = np.where(node > 0, self.node_score[node], self.unknown)
        best = np.full(len(points) + len(words), _LOWEST)
        first = ends - sizes + np.arange(len(words))
        best[first] = 0
        second, into = np.full(len(best), _LOWEST), np.zeros(len(best), np.int64)
        cuts = np.cumsum(np.bincount(place)).tolist()
        for lo, hi in zip([0, *cuts], cuts):  # edges from one place of a pre-token all end at different ones
            to = end[lo:hi]
            through, had = best[start[lo:hi]] + score[lo:hi], best[to]
            better = through > had
            second[to] = np.maximum(second[to], np.where(better, had, through))
            best[to] = np.maximum(through, had)
            into[to[better]] = np.flatnonzero(better) + lo
        # back along the best paths of all
        last = first + sizes
        gap, now, who, path = np.full(len(words), _NO_GAP), last, np.arange(len(words)), []
        while len(now):
            other = second[now] > _LOWEST
            gap[who[other]] = np.minimum(gap[who[other]], (best[now] - second[now])[other])
            edge = into[now]
            path.append(edge)
            now = start[edge]
            on = now > first[who]
            now, who = now[on], who[on]
        edges = np.concatenate(path)
        edges = edges[np.argsort(start[edges])]
        plain = node[edges] > 0
        counts = np.ones(len(edges), np.int64)
        strange = points[at[edges[~plain]]]
        counts[~plain] = 1 + (strange >= 0x80) + (strange >= 0x800) + (strange >= 0x10000)
        ids, is_plain = np.empty(counts.sum(), "<i4"), np.repeat(plain, counts)
        ids[is_plain] = self.node_piece[node[edges[plain]]]
        ids[~is_plain] = self.byte_ids[np.frombuffer(strange.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)]
        upto = (4 * np.cumsum(np.bincount(of[at[edges]], counts, len(words)).astype(np.int64))).tolist()
        packed = ids.tobytes()
        return list(zip(best[last].tolist(), (packed[lo:hi] for lo, hi in zip([0, *upto], upto)), gap.tolist()))

    def learn(self, tokens: list[str]) -> None:
        """Have every pre-token among the young ones: from the old ones or searched."""
        young, old = self.young, self.old
        unknown: list[str] = []
        for word in dict.fromkeys(tokens):
            if word not in young:
                found = old.get(word)
                if found is not None:
                    young[word] = found
                elif len(word) <= _LONG:
                    unknown.append(word)
                else:
                    score, ids, gap = self.first(word.replace(" ", "▁"))
                    young[word] = score, _packed(ids), gap
        unknown.sort(key=len)
        for lo in range(0, len(unknown), _ABREAST):
            words = unknown[lo:lo + _ABREAST]
            young.update(zip(words, self.firsts(words)))

    def kept(self, tokens: list[str]) -> list[Kept]:
        """Of every pre-token its best segmentation and the gap to the second."""
        words: list[Kept] = []
        for lo in range(0, len(tokens), _ROUND):
            if len(self.young) >= _KEPT:
                self.young, self.old = {}, self.young
            some = tokens[lo:lo + _ROUND]
            self.learn(some)
            words.extend(map(self.young.__getitem__, some))
        return words

    def ways(self, texts: list[str], n: int) -> Iterator[list[tuple[int, bytes]]]:
        """Scores and packed ids of the n best segmentations of each text."""
        if n != self.held:
            self.forget(n)
        tokens = [pretokens(t) for t in texts]
        words = self.kept([w for some in tokens for w in some])
        at = 0
        for some in tokens:
            yield self.ways_of(some, words[at : at + len(some)], n)
            at += len(some)

    def ways_of(self, tokens: list[str], words: list[Kept], n: int) -> list[tuple[int, bytes]]:
        """The n best segmentations of a text by those of its pre-tokens. Only the n - 1 places
        with the cheapest second choice can matter."""
        total = sum(map(_SCORE, words))
        places: list[int] = []
        if n > 1 and words:
            gaps = np.fromiter(map(_GAP, words), np.int64, len(words))
            places = np.argpartition(gaps, n - 2)[: n - 1].tolist() if len(words) >= n else list(range(len(words)))
        choices = {i: self.choices(tokens[i]) for i in places}
        found: list[tuple[int, tuple[tuple[int, int], ...]]] = [(0, ())]
        for i in sorted(places):
            found = heapq.nsmallest(n, (
                (cost + choices[i][0][0] - score, (*made, (i, k)) if k else made)
                for cost, made in found for k, (score, _) in enumerate(choices[i])
            ))
        parts, out = list(map(_IDS, words)), []
        for cost, made in found:
            for i, k in made:
                parts[i] = choices[i][k][1]
            out.append((total - cost, b"".join(parts)))
            for i, _ in made:
                parts[i] = words[i][1]
        return out

    def text(self, text: str, n: int = N_BEST) -> Best:
        """N best segmentations of a text with all their ids."""
        return [(score, tuple(np.frombuffer(ids, "<i4").tolist())) for score, ids in next(self.ways([text], n))]


_SCORE, _IDS, _GAP = map(operator.itemgetter, range(3))


def _packed(ids: tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


@functools.lru_cache(maxsize=2)
def lattice(model: str = MODEL) -> Lattice:
    return Lattice(model)


@functools.lru_cache(maxsize=2)
def _piece_bytes(model: str = MODEL) -> list[bytes]:
    p = processor(model)
    return [
        bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i)
        else b"" if p.is_control(i) or p.is_unknown(i) else p.id_to_piece(i).replace("▁", " ").encode()
        for i in range(p.get_piece_size())
    ]


def decode(ids: Iterable[int], model: str = MODEL) -> str:
    """The text of ids, without the space that encoding puts before it."""
    return b"".join(map(_piece_bytes(model).__getitem__, ids))[1:].decode()


def _looked_up(search: Lattice, values: list[str | None], n: int) -> Iterator[tuple[str | None, list[tuple[int, bytes]] | None]]:
    """Texts with their segmentations, looked up in groups of about _GROUP characters."""
    lo = size = 0
    for hi, value in enumerate(values, 1):
        size += len(value or "")
        if size >= _GROUP or hi == len(values):
            some = values[lo:hi]
            ways = search.ways([v for v in some if v is not None], n)
            for v in some:
                yield v, None if v is None else next(ways)
            lo, size = hi, 0


def _encoded(batches: Iterable[pa.RecordBatch], at: int, n: int, model: str, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches with the ids of the n best segmentations of column ``at``, their scores, the text that each decodes to
    and whether all of these are the text. A worker may ``keep`` its pre-tokens for its next task."""
    search = lattice(model)
    added = [("nbest", pa.list_(pa.list_(pa.int32()))), ("scores", pa.list_(pa.int64())), ("decoded", pa.list_(pa.string())), ("back", pa.bool_())]
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):  # id lists of a few texts at a time
            part = batch.slice(lo, 256)
            out: list[list] = [[], [], [], []]
            for value, ways in _looked_up(search, part.column(at).to_pylist(), n):
                row = None, None, None, None
                if ways is not None:
                    ids = [np.frombuffer(packed, "<i4") for _, packed in ways]
                    decoded = [decode(x.tolist(), model) for x in ids]
                    plain = value.replace("▁", " ")
                    row = ids, [score for score, _ in ways], decoded, all(d == plain for d in decoded)
                for column, v in zip(out, row):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(column, kind) for column, (_, kind) in zip(out, added))],
                names=[*part.schema.names, *(name for name, _ in added)],
            )
    if not keep:
        search.forget(0)  # an idle worker keeps nothing


def encode(df: DataFrame, text: str = "text", n: int = N_BEST, model: str = MODEL, every: bool = False) -> DataFrame:
    """``df`` with ids (best segmentation), scores (of the n best) and back (whether
    decoding every one of them gives the text). With ``every``, nbest (ids of all n) and
    decoded (the text that each of them gives) follow."""
    names = ["ids", "scores", "back", *(["nbest", "decoded"] if every else [])]
    if clash := set(names) & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} exist already")
    added = T.StructType.fromDDL("ids array<int>, scores array<bigint>, back boolean, nbest array<array<int>>, decoded array<string>")
    schema = T.StructType(df.schema.fields + [added[c] for c in names])
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _encoded(batches, at, n, model):
            columns = {c: part.column(c) for c in part.schema.names}
            columns["ids"] = pc.list_element(part.column("nbest"), 0)
            yield pa.RecordBatch.from_arrays([columns[c] for c in schema.names], names=schema.names)

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N_BEST, model: str = MODEL) -> DataFrame:
    """id, n_pieces and ids_crc32 (of 32-bit little-endian ids) of the best segmentation, scores, round_trip, and of each of the n
    best nbest_crc32 (of its ids) and decoded_crc32 (of the text it decodes to), without ids and texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        for part in _encoded(batches, 1, n, model, keep=True):
            out = []
            for ways, scores, decoded, back in zip(*(part.column(i) for i in range(2, 6))):
                if not ways.is_valid:
                    out.append((0, 0, None, True, None, None))
                    continue
                ids = [np.ascontiguousarray(w.values.to_numpy(), "<i4") for w in ways]
                crcs = [zlib.crc32(x) for x in ids]
                out.append((len(ids[0]), crcs[0], scores.as_py(), back.as_py(), crcs, [zlib.crc32(d.as_buffer()) for d in decoded]))
            cols = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["doc_id", "n_pieces", "ids_crc32", "scores", "round_trip", "nbest_crc32", "decoded_crc32"])

    return df.select(F.col(id_col).cast("long"), text).mapInArrow(
        run, "doc_id long, n_pieces long, ids_crc32 long, scores array<bigint>, round_trip boolean, "
        "nbest_crc32 array<bigint>, decoded_crc32 array<bigint>"
    )
