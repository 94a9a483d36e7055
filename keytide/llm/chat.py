"""Chat formatting: transcripts parsed by a hidden Markov model.

A transcript is lines of text in which speaker markers ("User:", "<assistant>", "Q:" ...)
are irregular and often missing. Hidden states are the first line and the later lines of
a turn of each role; a line shows a marker class, whether a blank line stands before
it, its length class, how it ends and whether it opens the conversation. Viterbi finds
the best states, and turns are rendered in one canonical form.

Long conversations come in parts. A part is first reduced to the best score between
any state before it and any state at its end; chaining these small matrices gives the
states at the borders, and each part is then decoded between its two border states. The
result is the best path of the whole conversation, and no task holds more than a part.

Probabilities are smoothed counts over all labelled lines that may be learned from.

Edge cases: NULL and empty transcripts have no lines and no turns; blank lines are only a
feature of the next line; NULL roles teach nothing; without anything learned all
states are alike and ties go to the first role; repeated rows of a turn are one turn; an
empty table gives an empty result. A NULL conv_id is a conversation of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLES = ("system", "user", "assistant")
N = 2 * len(ROLES)  # state 2r: first line of role r, 2r + 1: later line
# Sizes of the features of a line.
SIZES = (4, 2, 3, 3, 2)
TURNS_PER_PART = 256
# What str.strip() leaves, as a Java pattern: a line with such a character has text.
_TEXT = r"[^\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
_MARKER = re.compile(r"^\W{0,4}(?:(system|instruction)|(user|human|question|q)|(assistant|ai|bot|answer|a))\s?[\]>:\-]+\s*", re.I)


def lines_of(transcript: str | None, opens: bool) -> list[tuple[str, tuple[int, ...]]]:
    """Lines with text, without their markers, and their features."""
    out, blank = [], 0
    for line in (transcript or "").split("\n"):
        if not line.strip():
            blank = 1
            continue
        found = _MARKER.match(line)
        marker = next((i + 1 for i, g in enumerate(found.groups()) if g), 0) if found else 0
        body = line[found.end():] if found else line
        size = 0 if len(body) < 40 else 1 if len(body) < 160 else 2
        end = {"?": 1, ".": 2}.get(body.rstrip()[-1:], 0)
        out.append((body, (marker, blank, size, end, int(opens and not out))))
        blank = 0
    return out


class Hmm:
    """Smoothed log probabilities from counts of starts, moves and features by state."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, shown: list[np.ndarray]):
        self.start = np.log((start + 1) / (start + 1).sum())
        allowed = np.zeros((N, N), bool)
        for s in range(N):
            allowed[s, 0::2] = True  # any turn may begin, of the same role too
            allowed[s, s | 1] = True
        with np.errstate(divide="ignore"):
            self.moves = np.log(np.where(allowed, moves + 1, 0) / np.where(allowed, moves + 1, 0).sum(axis=1, keepdims=True))
        self.shown = [np.log((c + 1) / (c + 1).sum(axis=1, keepdims=True)) for c in shown]

    def seen(self, features: list[tuple[int, ...]]) -> np.ndarray:
        f = np.array(features, np.int64).reshape(-1, len(SIZES))
        return sum(table[:, f[:, k]].T for k, table in enumerate(self.shown)) if len(f) else np.zeros((0, N))

    def reduced(self, features: list[tuple[int, ...]]) -> np.ndarray:
        """Best score from each state before a part (last row: nothing before) to each at its end."""
        best = None
        for e in self.seen(features):
            into = np.vstack([self.moves, self.start]) if best is None else (best[:, :, None] + self.moves[None]).max(axis=1)
            best = into + e
        return best

    def decode(self, features: list[tuple[int, ...]], before: int, last: int) -> list[int]:
        """Best states of a part between the state before it (N: none) and its last state."""
        seen, back, best = self.seen(features), [], None
        for e in seen:
            if best is None:
                best = (self.start if before == N else self.moves[before]) + e
            else:
                ways = best[:, None] + self.moves
                back.append(ways.argmax(axis=0))
                best = ways.max(axis=0) + e
        path = [last]
        for pointers in reversed(back):
            path.append(int(pointers[path[-1]]))
        return path[::-1]


def borders(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """States before and at the end of every part, from the parts' matrices in order."""
    best, back = None, []
    for m in matrices:
        if best is None:
            best = m[N]
        else:
            ways = best[:, None] + m[:N]
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0)
    ends = [int(best.argmax())]
    for pointers in reversed(back):
        ends.append(int(pointers[ends[-1]]))
    ends.reverse()
    return list(zip([N, *ends[:-1]], ends))


def rendered(lines: list[str], states: list[int]) -> list[tuple[str, str]]:
    """Turns (role, text) of decoded lines. A part that begins inside a turn begins with its rest."""
    turns: list[tuple[str, list[str]]] = []
    for line, s in zip(lines, states):
        if s % 2 == 0 or not turns:
            turns.append((ROLES[s // 2], []))
        turns[-1][1].append(line)
    return [(role, "\n".join(body)) for role, body in turns]


def canonical(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def parts(df: DataFrame, marked: Column) -> DataFrame:
    """Turns (conv_id, turn, role, text) as parts of transcripts: conv_id, part,
    transcript, roles (per line with text). ``marked`` is a turn as its transcript shows it."""
    line_count = F.size(F.filter(F.split(F.col("marked"), "\n"), lambda x: x.rlike(_TEXT)))
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-1))
    rows = df.select("conv_id", turn.alias("turn"), "role", marked.alias("marked")).distinct()
    rows = rows.withColumn("part", F.floor(F.col("turn") / TURNS_PER_PART)).withColumn("n", line_count)
    held = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "marked", "n"))).alias("turns"))
    return held.select(
        "conv_id", "part",
        F.array_join(F.transform("turns", lambda t: F.coalesce(t["marked"], F.lit(""))), "\n").alias("transcript"),
        F.flatten(F.transform("turns", lambda t: F.array_repeat(F.coalesce(t["role"], F.lit("")), F.coalesce(t["n"], F.lit(0))))).alias("roles"),
    )


def _states(roles: list[str], bodies: list[tuple[str, tuple[int, ...]]], starts: list[bool]) -> list[int]:
    return [2 * ROLES.index(r) + (not s) if r in ROLES else -1 for r, s in zip(roles, starts)]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int, int], int] = {}
    for batch in batches:
        for part, transcript, roles in zip(*(batch.column(i).to_pylist() for i in range(3))):
            lines = lines_of(transcript, part <= 0)
            # a turn begins where the role changes
            starts = [i == 0 or roles[i] != roles[i - 1] for i in range(len(roles))]
            states = _states(roles, lines, starts)
            for i, (s, (_, shown)) in enumerate(zip(states, lines)):
                if s < 0:
                    continue
                if i and states[i - 1] >= 0:
                    keys = [(1, states[i - 1], s)]
                else:
                    keys = [(0, 0, s)]
                keys += [(2 + k, s, v) for k, v in enumerate(shown)]
                for key in keys:
                    sums[key] = sums.get(key, 0) + 1
    table = list(zip(*sums)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in table), pa.array(list(sums.values()), pa.int64())],
                                     names=["kind", "a", "b", "n"])


def learned(labelled: DataFrame) -> Hmm:
    """A model from parts with known roles. The driver sees one small table of counts."""
    counts = labelled.select("part", "transcript", "roles").mapInArrow(_counted, "kind int, a int, b int, n long")
    start, moves, shown = np.zeros(N), np.zeros((N, N)), [np.zeros((N, k)) for k in SIZES]
    for kind, a, b, n in counts.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():
        if kind == 0:
            start[b] = n
        else:
            (moves if kind == 1 else shown[kind - 2])[a, b] = n
    return Hmm(start, moves, shown)


def parsed(df: DataFrame, model: Hmm) -> DataFrame:
    """``df``: conv_id, part, transcript (other columns pass). Adds states (one per line
    with text), turns (role, text) and chat, the canonical form."""
    if clash := {"states", "turns", "chat", "before", "last"} & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} exist already")

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part, transcript in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines = lines_of(transcript, part <= 0)
                out.append(model.reduced([f for _, f in lines]).ravel() if lines else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))],
                                             names=["conv_id", "part", "best"])

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = [x for x in held if x["best"]]
                if held:
                    ends = borders([np.array(x["best"]).reshape(N + 1, N) for x in held])
                    rows += [(conv, x["part"], a, b) for x, (a, b) in zip(held, ends)]
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                                             names=["c", "p", "before", "last"])

    best = df.select(F.col("conv_id").cast("long"), F.col("part").cast("long"), "transcript").mapInArrow(
        reduce, "conv_id long, part long, best array<double>"
    )
    chained = best.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "best"))).alias("held")).mapInArrow(
        chain, "c long, p long, before int, last int"
    )
    joined = df.join(chained, df["conv_id"].eqNullSafe(chained["c"]) & (df["part"] == chained["p"]), "left").drop("c", "p")
    at = {c: joined.columns.index(c) for c in ("part", "transcript", "before", "last")}
    names = joined.columns
    kept = [c for c in names if c not in ("before", "last")]
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states, turns, chats = [], [], []
            for part, transcript, before, last in zip(*(batch.column(at[c]).to_pylist() for c in at)):
                lines = lines_of(transcript, part <= 0)
                path = model.decode([f for _, f in lines], before, last) if lines else []
                said = rendered([body for body, _ in lines], path)
                states.append(path)
                turns.append([{"role": r, "text": t} for r, t in said])
                chats.append(canonical(said))
            columns = [batch.column(i) for i, c in enumerate(names) if c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(states, pa.list_(pa.int32())), pa.array(turns, pa.list_(turn)), pa.array(chats, pa.string())],
                names=[*kept, "states", "turns", "chat"],
            )

    added = T.StructType.fromDDL("states array<int>, turns array<struct<role:string,text:string>>, chat string")
    return joined.mapInArrow(decode, T.StructType(joined.select(kept).schema.fields + added.fields))
