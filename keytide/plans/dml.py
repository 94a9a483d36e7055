"""Row-level changes as plans over a merged table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide.functions.columns import as_column, quoted
from keytide.spec import TableError


def keep_undeleted(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows that survive a delete: a NULL condition keeps the row (U8)."""
    return df.filter(~as_column(condition).eqNullSafe(F.lit(True)))


def _split(path: str) -> list[str]:
    """Name parts of ``a.b`` or ``a.`b.c```."""
    parts, part, quoting = [], "", False
    for ch in path:
        if ch == "`":
            quoting = not quoting
        elif ch == "." and not quoting:
            parts.append(part)
            part = ""
        else:
            part += ch
    return [*parts, part]


def first_name(path: str) -> str:
    """The column of an assigned path."""
    return _split(path)[0]


def _assigned(
    current: Column,
    data_type: T.DataType,
    changes: list[tuple[list[str], Column]],
    path: str,
) -> Column:
    whole = [expr for parts, expr in changes if not parts]
    if whole:
        if len(changes) > 1:
            raise TableError(f"conflicting assignments to {path}")
        return whole[0].cast(data_type)
    if not isinstance(data_type, T.StructType):
        raise TableError(f"{path} is {data_type.simpleString()}; only struct fields can be updated")
    rest = list(changes)
    fields = []
    for f in data_type.fields:
        mine = [(p[1:], e) for p, e in rest if p[0].lower() == f.name.lower()]
        rest = [(p, e) for p, e in rest if p[0].lower() != f.name.lower()]
        value = current.getField(f.name)
        if mine:
            value = _assigned(value, f.dataType, mine, f"{path}.{f.name}")
        fields.append(value.alias(f.name))
    if rest:
        raise TableError(f"no field {path}.{'.'.join(rest[0][0])}")
    return F.struct(*fields)


def assignments(schema: T.StructType, changes: Mapping[str, Column | str]) -> dict[str, Column]:
    """Top-level columns with their new values; nested paths rebuild the struct."""
    if not changes:
        raise TableError("an update needs at least one assignment")
    by_name: dict[str, list[tuple[list[str], Column]]] = {}
    real = {f.name.lower(): f for f in schema.fields}
    for path, expr in changes.items():
        parts = _split(path)
        field = real.get(parts[0].lower())
        if field is None:
            raise TableError(f"no column {path} in {schema.fieldNames()}")
        by_name.setdefault(field.name, []).append((parts[1:], as_column(expr)))
    return {
        name: _assigned(F.col(quoted(name)), schema[name].dataType, parts, name)
        for name, parts in by_name.items()
    }


def updated(
    df: DataFrame, changes: Mapping[str, Column | str], condition: Column | str | None = None
) -> DataFrame:
    """Assign where the condition is true; a NULL condition keeps the old row."""
    new = assignments(df.schema, changes)
    if condition is not None:
        cond = as_column(condition)
        new = {c: F.when(cond, e).otherwise(F.col(quoted(c))) for c, e in new.items()}
    return df.select(
        *[new[c].alias(c) if c in new else F.col(quoted(c)) for c in df.columns]
    )


def rewrite_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on the key; a source NULL keeps the target value."""
    new_cols = [c for c in source.columns if c not in target.columns]
    t, s = target.alias("t"), source.alias("s")
    out = []
    for c in [*target.columns, *new_cols]:
        q = quoted(c)
        if c in keys:
            out.append(F.coalesce(F.col(f"s.{q}"), F.col(f"t.{q}")).alias(c))
        elif c in new_cols:
            out.append(F.col(f"s.{q}").alias(c))
        elif c in source.columns:
            out.append(F.coalesce(F.col(f"s.{q}"), F.col(f"t.{q}")).alias(c))
        else:
            out.append(F.col(f"t.{q}").alias(c))
    return t.join(s, _on(keys), "full").select(*out)


def _on(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        term = F.col(f"t.{quoted(k)}").eqNullSafe(F.col(f"s.{quoted(k)}"))
        cond = term if cond is None else cond & term
    return cond


def conditional_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    matched: Sequence[tuple[Column | str, Mapping[str, Column | str]]],
    insert: bool = True,
) -> DataFrame:
    """Merge with clauses (U14): the first clause whose condition is true assigns.

    Conditions and expressions see the sides as ``t`` and ``s``. Matched rows
    without a true clause stay; unmatched source rows are inserted whole. Source
    keys must be unique: a repeated key that meets a target row fails the job, and of
    rows with a new key the one with the largest hash of its values is inserted.
    """
    whole = F.struct(*[F.col(quoted(c)) for c in source.columns])
    counted = source.groupBy(*[F.col(quoted(k)) for k in keys]).agg(
        F.max_by(whole, F.xxhash64(F.to_json(whole))).alias("__row"), F.count(F.lit(1)).alias("__copies"),
    )
    s = counted.select("__row.*", "__copies", F.lit(True).alias("__s")).alias("s")
    t = target.withColumn("__t", F.lit(True)).alias("t")
    in_t, in_s = F.col("t.__t").isNotNull(), F.col("s.__s").isNotNull()
    joined = t.join(s, _on(keys), "full" if insert else "left")
    clause = F.lit(-1)
    for i in reversed(range(len(matched))):
        clause = F.when(as_column(matched[i][0]), F.lit(i)).otherwise(clause)
    joined = joined.withColumn(
        "__clause",
        F.when(
            in_t & (F.col("s.__copies") > 1),
            F.raise_error(F.lit("a target row matches more than one source row")).cast("int"),
        )
        .when(in_t & in_s, clause)
        .when(in_t, F.lit(-1))
        .otherwise(F.lit(-2)),
    )
    out = []
    for c in target.columns:
        q = quoted(c)
        inserted = F.col(f"s.{q}") if c in source.columns else F.lit(None)
        value = F.when(F.col("__clause") == -2, inserted.cast(target.schema[c].dataType))
        for i, (_, sets) in enumerate(matched):
            by_name = {k.lower(): e for k, e in sets.items()}
            if c.lower() in by_name:
                new = as_column(by_name[c.lower()]).cast(target.schema[c].dataType)
                value = value.when(F.col("__clause") == i, new)
        out.append(value.otherwise(F.col(f"t.{q}")).alias(c))
    return joined.select(*out)
