"""Merge-on-read: fold ordered versions of keyed rows into one row per key.

Plans give the same rows and differ in what they move:

* `fold_versions` - one shuffle on the key, partial aggregates before it;
* `fold_in_chunks` - for operators whose state grows with the versions of a key:
  versions are range-split by (key, order) first, so a hot key spans many tasks;
* `fold_in_order` - for folds that must see every version in turn: sorted versions pass a Python
  state one by one;
* `overlay` - changes are folded alone and joined onto a base that is unique on
  the key; when they are few, by a checked size, the base is not even shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide.functions.columns import all_of, content_hash, quoted
from keytide.functions.merge_ops import NULL_TEXT, Custom, Latest, MergeOp, Running, resolve_ops
from keytide.spec import COMMIT

SEQ = "__seq"
_CHUNK = "__chunk"
_HIT = "__hit"
_TIE = "__tie"
# Fixed value: digits of the merge position that leads a commit id.
ORDER_DIGITS = 18


@dataclass(frozen=True)
class Versions:
    """Rows of several commits with a commit sequence and their column sets.

    Stored rows have the id of their commit, whose first digits are the sequence: a
    column of its own would hide from Spark that a union of buckets is placed by key.
    ``carried`` maps a column set to the sequence numbers of the commits that
    wrote exactly those columns.
    """

    rows: DataFrame
    carried: dict[frozenset[str], tuple[int, ...]]
    order_cols: tuple[str, ...] = ()

    def carriers(self, column: str) -> tuple[int, ...]:
        return tuple(sorted(s for cols, seqs in self.carried.items() if column in cols for s in seqs))

    def all_seqs(self) -> tuple[int, ...]:
        return tuple(sorted(s for seqs in self.carried.values() for s in seqs))

    def seq(self) -> Column:
        return F.col(SEQ) if SEQ in self.rows.columns else F.substring(COMMIT, 1, ORDER_DIGITS).cast("bigint")

    def has(self, carriers: tuple[int, ...]) -> Column:
        if len(carriers) == len(self.all_seqs()):
            return F.lit(True)
        return self.seq().isin(list(carriers)) if carriers else F.lit(False)

    def order_parts(self) -> list[Column]:
        return [self.seq(), *[F.col(quoted(c)) for c in self.order_cols]]

    def order(self) -> Column:
        parts = self.order_parts()
        return parts[0] if len(parts) == 1 else F.struct(*parts)


def stack(deltas: Sequence[DataFrame], order_cols: Sequence[str] = ()) -> Versions:
    """Union of in-memory deltas, oldest first; columns absent from a delta stay unset."""
    if not deltas:
        raise ValueError("at least one delta is needed")
    carried: dict[frozenset[str], tuple[int, ...]] = {}
    rows: DataFrame | None = None
    for i, delta in enumerate(deltas):
        cols = frozenset(delta.columns)
        carried[cols] = (*carried.get(cols, ()), i)
        tagged = delta.withColumn(SEQ, F.lit(i))
        rows = tagged if rows is None else rows.unionByName(tagged, allowMissingColumns=True)
    return Versions(rows, carried, tuple(order_cols))


@dataclass(frozen=True)
class _Unit:
    """Columns that share one aggregate: alike latest-wins columns travel as one struct."""

    op: MergeOp
    cols: tuple[str, ...]
    carriers: tuple[int, ...]
    state: str

    def value(self) -> Column:
        if isinstance(self.op, Latest):
            return F.struct(*[F.col(quoted(c)) for c in self.cols])
        return F.col(quoted(self.cols[0]))


def _units(versions: Versions, columns: Sequence[str], ops: dict[str, MergeOp]) -> list[_Unit]:
    latest: dict[tuple[int, ...], list[str]] = {}
    units: list[_Unit] = []
    for c in columns:
        op = ops.get(c)
        carriers = versions.carriers(c)
        if op is None or isinstance(op, Latest):
            latest.setdefault(carriers, []).append(c)
        else:
            units.append(_Unit(op, (c,), carriers, f"__s{len(units)}"))
    shared = Latest()
    for carriers, cols in latest.items():
        units.append(_Unit(shared, tuple(cols), carriers, f"__s{len(units)}"))
    return units


def _key_cols(keys: Sequence[str]) -> list[Column]:
    return [F.col(quoted(k)) for k in keys]


def _apply_custom(df: DataFrame, units: Iterable[_Unit]) -> DataFrame:
    custom = {u.state: u.op.fold_array(F.col(u.state)) for u in units if isinstance(u.op, Custom)}
    return df.withColumns(custom) if custom else df


def _states(versions: Versions, keys: Sequence[str], units: Sequence[_Unit]) -> DataFrame:
    running = [u for u in units if isinstance(u.op, Running)]
    if running:
        states = fold_in_order(versions, keys, running)
        rest = [u for u in units if not isinstance(u.op, Running)]
        if not rest:
            return states
        others = _states(versions, keys, rest).withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
        same = [F.col(quoted(k)).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        return states.join(others, all_of(same)).drop(*[f"__k{i}" for i in range(len(keys))])
    if any(u.op.grows for u in units):
        return fold_in_chunks(versions, keys, units)
    return versions.rows.groupBy(*_key_cols(keys)).agg(
        *[u.op.fold(u.value(), versions.has(u.carriers), versions.order()).alias(u.state) for u in units]
    )


def fold_in_order(versions: Versions, keys: Sequence[str], units: Sequence[_Unit]) -> DataFrame:
    """Values per key, each version passed to the folds in its turn.

    A window sorts the versions of a key, spilling what memory does not hold, and marks the
    first and the last; Python holds one state per fold, whatever the number of versions.
    A version whose commit lacks the column is no step; a key without steps gets NULL.
    """
    rows = versions.rows.withColumn(_TIE, content_hash(versions.rows))
    turn = Window.partitionBy(*_key_cols(keys)).orderBy(*versions.order_parts(), F.col(_TIE))
    marked = rows.select(
        *_key_cols(keys), *[u.value().alias(u.state) for u in units],
        *[versions.has(u.carriers).alias(f"__has{i}") for i, u in enumerate(units)],
        (F.row_number().over(turn) == 1).alias("__first"), F.lead(_TIE).over(turn).isNull().alias("__last"),
    )
    n, folds = len(keys), [(u.op.start, u.op.step, u.op.value) for u in units]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, seen = [None] * len(folds), [False] * len(folds)
        for batch in batches:
            values = [batch.column(n + i).to_pylist() for i in range(len(folds))]
            has = [batch.column(n + len(folds) + i).to_pylist() for i in range(len(folds))]
            first, last = batch.column(n + 2 * len(folds)).to_pylist(), batch.column(n + 2 * len(folds) + 1).to_pylist()
            ends, out = [], [[] for _ in folds]
            for at in range(batch.num_rows):
                if first[at]:
                    states, seen = [start() for start, _, _ in folds], [False] * len(folds)
                for i, (_, step, value) in enumerate(folds):
                    if has[i][at]:
                        states[i], seen[i] = step(states[i], values[i][at]), True
                    if last[at]:
                        out[i].append(value(states[i]) if seen[i] else None)
                if last[at]:
                    ends.append(at)
            picked = pa.array(ends, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(picked) for k in range(n)],
                 *[pa.array(out[i], batch.column(n + i).type) for i in range(len(folds))]],
                names=batch.schema.names[: n + len(folds)],
            )

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in marked.schema.fields[: n + len(units)]])
    return marked.mapInArrow(run, schema)


def fold_in_chunks(versions: Versions, keys: Sequence[str], units: Sequence[_Unit]) -> DataFrame:
    """States per key, built from states per (key, range chunk).

    Rows are range-partitioned by (key, order, content hash), so the chunks of a
    key are consecutive and its versions spread over many tasks, however many it
    has. The hash also orders versions that tie; it depends on values alone, so a
    task that runs again places its rows as before.
    """
    ordered = (
        versions.rows.withColumn(_TIE, content_hash(versions.rows))
        .repartitionByRange(*_key_cols(keys), *versions.order_parts(), F.col(_TIE))
        .withColumn(_CHUNK, F.spark_partition_id())
    )
    order = F.struct(*versions.order_parts(), F.col(_TIE))
    chunks = ordered.groupBy(*_key_cols(keys), F.col(_CHUNK)).agg(
        *[u.op.fold(u.value(), versions.has(u.carriers), order).alias(u.state) for u in units]
    )
    chunks = _apply_custom(chunks, units)
    whole = chunks.groupBy(*_key_cols(keys)).agg(
        *[u.op.refold(F.col(u.state), F.col(_CHUNK)).alias(u.state) for u in units]
    )
    return _apply_custom(whole, units)


def _finish(units: Sequence[_Unit], types: dict[str, T.DataType], base: bool = False) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for u in units:
        state = F.col(u.state)
        if isinstance(u.op, Latest):
            for c in u.cols:
                newest = state["v"][c]
                out[c] = F.when(state.isNotNull(), newest).otherwise(F.col(quoted(c))) if base else newest
        else:
            c = u.cols[0]
            over = u.op.over(state, F.col(quoted(c))) if base else state
            merged = u.op.finish(over, types[c])
            out[c] = F.when(F.col(_HIT).isNotNull(), merged).otherwise(F.col(quoted(c))) if base else merged
    return out


def _types(rows: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in rows.schema.fields}


def fold_versions(
    versions: Versions,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    ops: dict[str, MergeOp] | None = None,
) -> DataFrame:
    """One row per key; every column folded by its operator."""
    names = [c for c in versions.rows.columns if c not in (SEQ, COMMIT, *keys)]
    columns = [c for c in (columns or names) if c not in keys]
    units = _units(versions, columns, ops or {})
    if not units:
        return versions.rows.select(*_key_cols(keys)).distinct()
    finished = _finish(units, _types(versions.rows))
    return _states(versions, keys, units).select(
        *_key_cols(keys), *[finished[c].alias(c) for c in columns]
    )


def overlay(
    bases: DataFrame | Sequence[DataFrame],
    versions: Versions,
    keys: Sequence[str],
    columns: Sequence[str],
    ops: dict[str, MergeOp] | None = None,
    how: str = "full",
    null_keys: bool = True,
    buckets: tuple[int, Sequence[str]] | None = None,
) -> DataFrame:
    """Fold changes and put them on bases that are unique on the key, together too.

    ``full`` is one full join with one base. ``hash`` and ``broadcast`` join the changes to the
    left of nothing but the bases and add the keys that they lack: a base is
    read once for its rows and once for its keys, and filters on key columns
    reach all scans, which a full join would stop. ``broadcast`` leaves the bases
    where they are, and so do ``buckets``, their number and columns, when the bases are
    bucketed relations: the folded changes are dealt to the same buckets, and keys outside of
    the buckets are compared beside the hash. All build hash tables from the changes, so a base is
    never sorted; the caller must have checked how many changes there are. Without
    ``null_keys`` the folded changes keep their place for the join.
    """
    if how not in ("full", "hash", "broadcast"):
        raise ValueError(f"no way to join changes called {how}")
    bases = [bases] if isinstance(bases, DataFrame) else list(bases)
    columns = [c for c in columns if c not in keys]
    units = _units(versions, columns, ops or {})
    types = _types(versions.rows)
    states = _states(versions, keys, units).withColumn(_HIT, F.lit(True))
    if buckets is not None and how != "broadcast":
        states = states.repartition(buckets[0], *_key_cols(buckets[1]))

    def built(df: DataFrame) -> DataFrame:
        return df.hint("broadcast" if how == "broadcast" else "shuffle_hash")

    def renamed(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})

    match = None
    for i, k in enumerate(keys):
        old, new = F.col(quoted(k)), F.col(f"__k{i}")
        if buckets is not None and k not in buckets[1]:
            term = F.array_contains(F.array(old), new)  # an equality would make Spark deal both sides anew by all keys
        else:
            term = old.eqNullSafe(new) if null_keys else old == new
        match = term if match is None else match & term
    merged = _finish(units, types, base=True)
    values = [merged[c].alias(c) for c in columns]
    if how == "full" and len(bases) == 1:
        key = [
            F.when(F.col(_HIT), F.col(f"__k{i}")).otherwise(F.col(quoted(k))).alias(k) for i, k in enumerate(keys)
        ]
        return bases[0].join(built(renamed(states)), match, "full").select(*key, *values)
    fresh, out = states, None
    for base in bases:
        changed = base.join(built(renamed(states)), match, "left").select(*_key_cols(keys), *values)
        out = changed if out is None else out.unionByName(changed)
        changed_keys = renamed(states.select(*_key_cols(keys)))
        known = base.select(*_key_cols(keys)).join(built(changed_keys), match, "left_semi")
        fresh = fresh.join(built(renamed(known)), match, "left_anti")
    alone = _finish(units, types)
    return out.unionByName(fresh.select(*_key_cols(keys), *[alone[c].alias(c) for c in columns]))


def merge_deltas(
    deltas: Sequence[DataFrame],
    keys: Sequence[str],
    ops: dict[str, MergeOp | str] | None = None,
    order_cols: Sequence[str] = (),
) -> DataFrame:
    """Merge in-memory deltas, oldest first."""
    versions = stack(deltas, order_cols)
    schema = T.StructType([f for f in versions.rows.schema.fields if f.name != SEQ])
    return fold_versions(versions, keys, schema.fieldNames(), resolve_ops(ops, schema, keys))


def premerge(
    batches: Sequence[DataFrame],
    keys: Sequence[str],
    sums: Iterable[str] = (),
    skip_null_text: Iterable[str] = (),
) -> DataFrame:
    """Collapse ordered batches by key before they are written.

    Columns take their newest non-NULL value; ``sums`` are added up with NULLs
    skipped; ``skip_null_text`` columns also pass over the text 'null' and keep
    what the oldest batch holds when nothing better follows. One shuffle for any
    number of batches.
    """
    rows = stack(batches).rows
    sums, texts = set(sums), set(skip_null_text)
    seq = F.col(SEQ)
    aggs = []
    for c in rows.columns:
        value = F.col(quoted(c))
        if c == SEQ or c in keys:
            continue
        if c in sums:
            agg = F.sum(value).cast(rows.schema[c].dataType)
        elif c in texts:
            real = value.isNotNull() & (value != NULL_TEXT)
            agg = F.coalesce(F.max_by(value, F.when(real, seq)), F.max(F.when(seq == 0, value)))
        else:
            agg = F.max_by(value, F.when(value.isNotNull(), seq))
        aggs.append(agg.alias(c))
    return rows.groupBy(*_key_cols(keys)).agg(*aggs)
