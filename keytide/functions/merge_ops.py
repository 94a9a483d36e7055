"""Merge operators: how the versions of one value fold into one (M1-M8).

Every operator is written as a two-step aggregate, so that Spark can fold
versions on the map side, per chunk of a hot key, or onto a base row that was
never shuffled:

* ``fold(value, has, order)`` aggregates raw versions into a state column,
* ``refold(state, order)`` aggregates states that cover consecutive versions,
* ``over(state, base, has_base)`` puts a state on top of an older single value,
* ``finish(state)`` turns a state into the value.

``has`` says whether the commit of a row carries the column at all: a commit
without it leaves the column alone, an explicit NULL counts as a version.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text that the non-null operator treats as missing.
NULL_TEXT = "null"


class MergeOp:
    """Base of all operators."""

    #: the state of one version is the version itself, so a single version needs no fold
    single_is_identity = True
    #: the state grows with the number of versions of the key
    grows = False

    def check(self, name: str, data_type: T.DataType) -> None:
        """Raise TypeError when the operator cannot work on this column type."""

    def fold(self, value: Column, has: Column, order: Column) -> Column:
        raise NotImplementedError

    def refold(self, state: Column, order: Column) -> Column:
        raise NotImplementedError

    def over(self, state: Column, base: Column) -> Column:
        raise NotImplementedError

    def finish(self, state: Column, data_type: T.DataType) -> Column:
        return state


class Latest(MergeOp):
    """Newest version wins, NULL included (the default)."""

    def fold(self, value, has, order):
        return F.max_by(F.struct(value.alias("v")), F.when(has, order))

    def refold(self, state, order):
        return F.max_by(state, F.when(state.isNotNull(), order))

    def over(self, state, base):
        return F.coalesce(state, F.struct(base.alias("v")))

    def finish(self, state, data_type):
        return state["v"]


class Sum(MergeOp):
    """Sum over all versions; NULL operands are skipped."""

    def check(self, name, data_type):
        if not isinstance(data_type, T.NumericType):
            raise TypeError(f"sum needs a numeric column, {name} is {data_type.simpleString()}")

    def fold(self, value, has, order):
        return F.sum(value)

    def refold(self, state, order):
        return F.sum(state)

    def over(self, state, base):
        return F.when(state.isNull(), base).when(base.isNull(), state).otherwise(state + base)

    def finish(self, state, data_type):
        return state.cast(data_type)


class NonNull(MergeOp):
    """Newest version that is neither NULL nor the text 'null'.

    Falls back to 'null' when that is all that was seen, else to NULL.
    """

    def check(self, name, data_type):
        if not isinstance(data_type, T.StringType):
            raise TypeError(f"non-null needs a string column, {name} is {data_type.simpleString()}")

    def _state(self, real: Column, text: Column) -> Column:
        return F.struct(real.alias("real"), text.alias("text"))

    def fold(self, value, has, order):
        return self._state(
            F.max_by(value, F.when(value.isNotNull() & (value != NULL_TEXT), order)),
            F.max(F.when(value == NULL_TEXT, value)),
        )

    def refold(self, state, order):
        real = state["real"]
        return self._state(
            F.max_by(real, F.when(real.isNotNull(), order)), F.max(state["text"])
        )

    def over(self, state, base):
        return self._state(
            F.coalesce(state["real"], F.when(base != NULL_TEXT, base)),
            F.coalesce(state["text"], F.when(base == NULL_TEXT, base)),
        )

    def finish(self, state, data_type):
        return F.coalesce(state["real"], state["text"])


class Concat(MergeOp):
    """Texts of all versions joined oldest first; NULLs are skipped."""

    grows = True

    def __init__(self, separator: str = ","):
        self.separator = separator

    def check(self, name, data_type):
        if not isinstance(data_type, T.StringType):
            raise TypeError(f"concat needs a string column, {name} is {data_type.simpleString()}")

    def _join(self, value: Column, order: Column) -> Column:
        rows = F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))
        texts = F.transform(F.array_sort(rows), lambda x: x["v"])
        return F.when(F.size(texts) > 0, F.array_join(texts, self.separator))

    def fold(self, value, has, order):
        return self._join(value, order)

    def refold(self, state, order):
        return self._join(state, order)

    def over(self, state, base):
        return (
            F.when(state.isNull(), base)
            .when(base.isNull(), state)
            .otherwise(F.concat(base, F.lit(self.separator), state))
        )


class Custom(MergeOp):
    """A user's own fold ``merge(values_oldest_first) -> value`` in Python.

    ``merge`` must give the same answer when it is applied to consecutive pieces
    and then to the pieces' results. That lets one hot key be folded in chunks,
    and lets a compacted value be merged again with later versions. Values reach
    Python in Arrow batches, one ordered array per chunk of a key.
    """

    grows = True
    single_is_identity = False

    def __init__(self, merge: Callable[[list], object], data_type: T.DataType | str | None = None):
        self.merge = merge
        self.data_type = data_type

    def bind(self, data_type: T.DataType) -> Custom:
        return self if self.data_type is not None else Custom(self.merge, data_type)

    def _apply(self, values: Column) -> Column:
        merge = self.merge

        def run(batch: pd.Series) -> pd.Series:
            return pd.Series([None if v is None or len(v) == 0 else merge(list(v)) for v in batch],
                             dtype=object)

        return F.pandas_udf(run, self.data_type)(values)

    def _ordered(self, value: Column, order: Column, keep: Column) -> Column:
        rows = F.collect_list(F.when(keep, F.struct(order.alias("o"), value.alias("v"))))
        return F.transform(F.array_sort(rows), lambda x: x["v"])

    # The arrays are folded by `fold_array` in a projection above the aggregate,
    # because Spark evaluates Python functions outside of aggregates.
    def fold(self, value, has, order):
        return self._ordered(value, order, has)

    def refold(self, state, order):
        return self._ordered(state, order, state.isNotNull())

    def fold_array(self, values: Column) -> Column:
        return self._apply(values)

    def over(self, state, base):
        return self._apply(F.filter(F.array(base, state), lambda x: x.isNotNull()))


class Running(MergeOp):
    """A user's own fold that takes the versions of a key one by one, oldest first.

    ``start()`` gives the state before the first version, ``step(state, value)`` the one after
    the next, ``value(state)`` what the key gets, of the column's type. The fold need not be
    associative, so its result is no version that later ones could be added to: it is for reads
    and in-memory merges, and compactions refuse it. The versions of one key pass through one
    task as a sorted stream of which a single state is kept; a fold whose pieces can be put together
    is better written as `Custom`, which deals a hot key to many tasks.
    """

    single_is_identity = False

    def __init__(self, start: Callable[[], object], step: Callable[[object, object], object], value: Callable[[object], object]):
        self.start, self.step, self.value = start, step, value


_REGISTRY: dict[str, MergeOp] = {
    "latest": Latest(),
    "sum": Sum(),
    "concat": Concat(","),
    "concat_semicolon": Concat(";"),
    "non_null": NonNull(),
}


def register_merge_op(name: str, op: MergeOp | Callable[[list], object]) -> MergeOp:
    """Make an operator, or a Python fold, available under a name (M8)."""
    made = op if isinstance(op, MergeOp) else Custom(op)
    _REGISTRY[name] = made
    return made


def resolve_ops(
    ops: dict[str, MergeOp | str] | Iterable[tuple[str, MergeOp | str]] | None,
    schema: T.StructType,
    keys: Iterable[str],
) -> dict[str, MergeOp]:
    """Check an operator map against the table and look names up (M6)."""
    pairs = list(ops.items()) if isinstance(ops, dict) else list(ops or ())
    by_lower = {n.lower(): n for n in schema.fieldNames()}
    key_names = {k.lower() for k in keys}
    found: dict[str, MergeOp] = {}
    for name, op in pairs:
        real = by_lower.get(name.lower())
        if real is None:
            raise ValueError(f"merge operator on unknown column {name}")
        if real in found:
            raise ValueError(f"more than one merge operator on column {real}")
        if real.lower() in key_names:
            raise ValueError(f"merge operator on key column {real}")
        if isinstance(op, str):
            if op not in _REGISTRY:
                raise ValueError(f"no merge operator is registered as {op}")
            op = _REGISTRY[op]
        if not isinstance(op, MergeOp):
            raise TypeError(f"not a merge operator: {op!r}")
        op.check(real, schema[real].dataType)
        if isinstance(op, Custom):
            op = op.bind(schema[real].dataType)
        found[real] = op
    return found
