"""Schema evolution, drift and row constraints."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide.functions.columns import NULL_PARTITION, as_column, quoted, unescape_path
from keytide.sources.local import local_rows
from keytide.spec import TableError

# Integer types that may widen into each other, narrow to wide.
_INT_RANK = {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2}


# -- E1 -------------------------------------------------------------------------


class _Node(NamedTuple):
    """One place of a schema: a field, an element, a key or a value."""

    name: str
    shape: str  # struct, array, map or leaf
    leaf: T.DataType | None
    nullable: bool
    metadata: dict


_Path = tuple[str, ...]


def _flat(schema: T.StructType) -> dict[_Path, _Node]:
    """All places of a schema in order, by their path in lower case. Schemas are compared
    as such tables: what one side has and the other lacks is a difference of keys."""
    out: dict[_Path, _Node] = {}
    todo: list[tuple[_Path, T.StructField]] = [((f.name,), f) for f in reversed(schema.fields)]
    while todo:
        path, f = todo.pop()
        t = f.dataType
        shape = {T.StructType: "struct", T.ArrayType: "array", T.MapType: "map"}.get(type(t), "leaf")
        key = tuple(p.lower() for p in path)
        if key in out:
            raise TableError(f"duplicate columns: {'.'.join(path)}")
        out[key] = _Node(f.name, shape, t if shape == "leaf" else None, f.nullable, f.metadata)
        inner: list[T.StructField] = []
        if shape == "struct":
            inner = list(t.fields)
        elif shape == "array":
            inner = [T.StructField("[]", t.elementType, t.containsNull)]
        elif shape == "map":
            inner = [T.StructField("[key]", t.keyType, False), T.StructField("[value]", t.valueType, t.valueContainsNull)]
        todo += [((*path, g.name), g) for g in reversed(inner)]
    return out


def _built(places: Mapping[_Path, _Node]) -> T.StructType:
    """The schema that a table of places describes."""
    below: dict[_Path, list[_Path]] = {}
    for path in places:
        below.setdefault(path[:-1], []).append(path)

    def field(path: _Path) -> T.StructField:
        node, inner = places[path], [field(p) for p in below.get(path, ())]
        if node.shape == "struct":
            data_type: T.DataType = T.StructType(inner)
        elif node.shape == "array":
            data_type = T.ArrayType(inner[0].dataType, inner[0].nullable)
        elif node.shape == "map":
            data_type = T.MapType(inner[0].dataType, inner[1].dataType, inner[1].nullable)
        else:
            data_type = node.leaf
        return T.StructField(node.name, data_type, node.nullable, node.metadata)

    return T.StructType([field(p) for p in below.get((), ())])


def _void(node: _Node) -> bool:
    return isinstance(node.leaf, T.NullType)


def _described(node: _Node) -> str:
    return node.leaf.simpleString() if node.leaf is not None else node.shape


def _widened(path: _Path, mine: _Node, theirs: _Node) -> _Node:
    """The place that holds the values of both sides, named as on the first."""
    if _void(theirs) or (mine.shape, mine.leaf) == (theirs.shape, theirs.leaf):
        return mine
    if _void(mine):
        return mine._replace(shape=theirs.shape, leaf=theirs.leaf)
    ranks = [_INT_RANK.get(type(n.leaf)) for n in (mine, theirs)]
    if None in ranks:
        raise TableError(f"cannot merge {'.'.join(path)}: {_described(mine)} and {_described(theirs)}")
    return mine if ranks[0] >= ranks[1] else mine._replace(leaf=theirs.leaf)


def merge_schemas(current: T.StructType, new: T.StructType) -> T.StructType:
    """Additive merge: places of both sides, those of the current one first."""
    mine, theirs = _flat(current), _flat(new)
    both = {p: _widened(p, mine[p], theirs[p]) for p in mine.keys() & theirs.keys()}
    return _built({**mine, **both, **{p: node for p, node in theirs.items() if p not in mine}})


def conformed(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """Reshape a value to a merged type: add nested fields as NULL, widen, reorder."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        old = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            mine = old.get(f.name.lower())
            inner = (
                conformed(value.getField(mine.name), mine.dataType, f.dataType)
                if mine
                else F.lit(None).cast(f.dataType)
            )
            fields.append(inner.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: conformed(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        out = value
        if have.keyType != want.keyType:
            out = F.transform_keys(out, lambda k, v: conformed(k, have.keyType, want.keyType))
        if have.valueType != want.valueType:
            out = F.transform_values(out, lambda k, v: conformed(v, have.valueType, want.valueType))
        return out
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType, only_present: bool = False) -> DataFrame:
    """Rows of a frame in the shape of a schema it was merged into."""
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in schema.fields:
        mine = have.get(f.name.lower())
        if mine is not None:
            out.append(conformed(F.col(quoted(mine.name)), mine.dataType, f.dataType).alias(f.name))
        elif not only_present:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def union_evolve(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union under the additively merged schema."""
    target = functools.reduce(merge_schemas, [d.schema for d in dfs])
    return functools.reduce(DataFrame.unionAll, [conform(d, target) for d in dfs])


# -- P4, P5 ---------------------------------------------------------------------


def normalize_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns under the table's spelling (P4). Only whole columns are renamed: nested
    fields spelled differently, at any depth of structs, are refused together."""
    table = _flat(schema)
    places = {p: n for p, n in _flat(df.schema).items() if not any(part.startswith("[") for part in p)}
    if unknown := [n.name for p, n in places.items() if len(p) == 1 and p not in table]:
        raise TableError(f"columns {unknown} are not in the table {schema.fieldNames()}")
    other = [".".join(p) for p, n in places.items() if len(p) > 1 and p in table and n.name != table[p].name]
    if other:
        raise TableError(f"nested fields would need renaming: {other}")
    return df.select(*[F.col(quoted(c)).alias(table[(c.lower(),)].name) for c in df.columns])


def has_null_type(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return any(has_null_type(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return has_null_type(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return has_null_type(data_type.keyType) or has_null_type(data_type.valueType)
    return isinstance(data_type, T.NullType)


def _without_null(value: Column, data_type: T.DataType, path: str) -> Column | None:
    if isinstance(data_type, T.NullType):
        return None
    if not has_null_type(data_type):
        return value
    if not isinstance(data_type, T.StructType):
        raise TableError(f"untyped NULL inside {path}: {data_type.simpleString()}")
    kept = []
    for f in data_type.fields:
        inner = _without_null(value.getField(f.name), f.dataType, f"{path}.{f.name}")
        if inner is not None:
            kept.append(inner.alias(f.name))
    return F.when(value.isNotNull(), F.struct(*kept))


def drop_null_type(df: DataFrame) -> DataFrame:
    """Drop columns and struct fields of the untyped NULL type (P5)."""
    out = []
    for f in df.schema.fields:
        kept = _without_null(F.col(quoted(f.name)), f.dataType, f.name)
        if kept is not None:
            out.append(kept.alias(f.name))
    return df.select(*out)


# -- E2 -------------------------------------------------------------------------


def add_column(name: str, data_type: T.DataType | str, *, first: bool = False, after: str | None = None,
               nullable: bool = True, comment: str | None = None) -> dict:
    """Change: add a column; ``a.b`` is nested, ``a.element``/``a.key``/``a.value`` go through collections."""
    return {"do": "add", "path": name, "type": data_type, "first": first, "after": after,
            "nullable": nullable, "comment": comment}


def move_column(name: str, *, first: bool = False, after: str | None = None) -> dict:
    """Change: reorder a column among its siblings."""
    return {"do": "move", "path": name, "first": first, "after": after}


def comment_column(name: str, comment: str) -> dict:
    """Change: set a column comment."""
    return {"do": "comment", "path": name, "comment": comment}


def relax_column(name: str) -> dict:
    """Change: drop NOT NULL."""
    return {"do": "relax", "path": name}


def retype_column(name: str, data_type: T.DataType | str) -> dict:
    """Change: allowed only when the type stays the same apart from added nested fields."""
    return {"do": "retype", "path": name, "type": data_type}


def _as_type(data_type: T.DataType | str) -> T.DataType:
    if isinstance(data_type, T.DataType):
        return data_type
    return T.StructType.fromDDL(f"c {data_type}")["c"].dataType


def _find(fields: list[T.StructField], name: str) -> int:
    for i, f in enumerate(fields):
        if f.name.lower() == name.lower():
            return i
    raise TableError(f"no column {name} in {[f.name for f in fields]}")


def _place(fields: list[T.StructField], new: T.StructField, change: dict) -> list[T.StructField]:
    if change.get("first"):
        return [new, *fields]
    if change.get("after"):
        i = _find(fields, change["after"])
        return [*fields[: i + 1], new, *fields[i + 1 :]]
    return [*fields, new]


def _changed_fields(fields: list[T.StructField], name: str, change: dict) -> list[T.StructField]:
    if change["do"] == "add":
        if any(f.name.lower() == name.lower() for f in fields):
            raise TableError(f"column {name} exists")
        if not change["nullable"]:
            raise TableError("a NOT NULL column cannot be added to rows that lack it")
        meta = {"comment": change["comment"]} if change["comment"] else {}
        return _place(fields, T.StructField(name, _as_type(change["type"]), True, meta), change)
    i = _find(fields, name)
    f = fields[i]
    if change["do"] == "move":
        return _place([*fields[:i], *fields[i + 1 :]], f, change)
    if change["do"] == "comment":
        f = T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, "comment": change["comment"]})
    elif change["do"] == "relax":
        f = T.StructField(f.name, f.dataType, True, f.metadata)
    elif change["do"] == "retype":
        want = _as_type(change["type"])
        _check_retype(f.dataType, want, f.name)
        f = T.StructField(f.name, want, f.nullable, f.metadata)
    else:
        raise TableError(f"change {change['do']} is not supported")
    return [*fields[:i], f, *fields[i + 1 :]]


def _check_retype(have: T.DataType, want: T.DataType, path: str) -> None:
    """A new type must hold all old values: places may be added if they can be NULL,
    and nothing may go, change its kind or stop being nullable."""
    old, new = (_flat(T.StructType([T.StructField(path, t)])) for t in (have, want))
    faults = [f"{'.'.join(p)} is lost" for p in old.keys() - new.keys()]
    faults += [f"{'.'.join(p)} is new and NOT NULL" for p in new.keys() - old.keys() if not new[p].nullable and p[-1] != "[key]"]
    for p in old.keys() & new.keys():
        if (old[p].shape, old[p].leaf) != (new[p].shape, new[p].leaf):
            faults.append(f"{'.'.join(p)} turns from {_described(old[p])} to {_described(new[p])}")
        elif old[p].nullable and not new[p].nullable:
            faults.append(f"{'.'.join(p)} becomes NOT NULL")
    if faults:
        raise TableError(f"type of {path}: {'; '.join(sorted(faults))}")


def _change_at(data_type: T.DataType, path: list[str], change: dict) -> T.DataType:
    if isinstance(data_type, T.StructType):
        if len(path) == 1:
            return T.StructType(_changed_fields(list(data_type.fields), path[0], change))
        i = _find(list(data_type.fields), path[0])
        f = data_type.fields[i]
        inner = T.StructField(f.name, _change_at(f.dataType, path[1:], change), f.nullable, f.metadata)
        return T.StructType([*data_type.fields[:i], inner, *data_type.fields[i + 1 :]])
    if isinstance(data_type, T.ArrayType) and path[0] == "element" and len(path) > 1:
        return T.ArrayType(_change_at(data_type.elementType, path[1:], change), data_type.containsNull)
    if isinstance(data_type, T.MapType) and path[0] in ("key", "value") and len(path) > 1:
        key, value = data_type.keyType, data_type.valueType
        if path[0] == "key":
            key = _change_at(key, path[1:], change)
        else:
            value = _change_at(value, path[1:], change)
        return T.MapType(key, value, data_type.valueContainsNull)
    raise TableError(f"cannot step into {path[0]} of {data_type.simpleString()}")


def migrated_schema(schema: T.StructType, changes: Sequence[dict]) -> T.StructType:
    return functools.reduce(lambda s, c: _change_at(s, c["path"].split("."), c), changes, schema)


def migrate(df: DataFrame, changes: Sequence[dict]) -> DataFrame:
    """Rows under the changed schema; added fields read NULL.

    Renames, type changes, drops and new NOT NULL columns are refused.
    """
    target = migrated_schema(df.schema, changes)
    shaped = conform(df, target)
    return shaped.select(
        *[F.col(quoted(f.name)).alias(f.name, metadata=f.metadata) if f.metadata else F.col(quoted(f.name))
          for f in target.fields]
    )


def without_column(df: DataFrame, path: str) -> DataFrame:
    """Drop a column or a struct field."""
    head, _, rest = path.partition(".")
    i = _find(list(df.schema.fields), head)
    f = df.schema.fields[i]
    if not rest:
        return df.drop(f.name)
    if not isinstance(f.dataType, T.StructType):
        raise TableError(f"can only drop nested fields of a struct, {head} is {f.dataType.simpleString()}")
    return df.withColumn(f.name, F.col(quoted(f.name)).dropFields(rest))


# -- E3 -------------------------------------------------------------------------


def schema_rows(schema: T.StructType) -> list[dict]:
    """Path, name key, type, nullability and metadata of every field, collections included."""
    rows: list[dict] = []

    def add(p: str, data_type: T.DataType, nullable: bool, meta: str) -> None:
        rows.append({"path": p, "k": p.lower(), "type": _kind(data_type), "nullable": nullable, "meta": meta})

    def visit(data_type: T.DataType, path: str) -> None:
        if isinstance(data_type, T.StructType):
            for f in data_type.fields:
                p = f"{path}.{f.name}" if path else f.name
                add(p, f.dataType, f.nullable, _meta(f.metadata))
                visit(f.dataType, p)
        elif isinstance(data_type, T.ArrayType):
            p = f"{path}[]"
            add(p, data_type.elementType, data_type.containsNull, "{}")
            visit(data_type.elementType, p)
        elif isinstance(data_type, T.MapType):
            for tag, inner, null in (
                ("[key]", data_type.keyType, False),
                ("[value]", data_type.valueType, data_type.valueContainsNull),
            ):
                p = f"{path}{tag}"
                add(p, inner, null, "{}")
                visit(inner, p)

    visit(schema, "")
    return rows


def _kind(data_type: T.DataType) -> str:
    nested = (T.StructType, T.ArrayType, T.MapType)
    return data_type.typeName() if isinstance(data_type, nested) else data_type.simpleString()


def _meta(metadata: dict) -> str:
    return "{" + ", ".join(f"{k}: {metadata[k]}" for k in sorted(metadata)) + "}"


def drift_report(spark: SparkSession, expected: T.StructType, actual: T.StructType | DataFrame) -> DataFrame:
    """Differences per field path, and whether the actual schema is still readable as expected.

    Unreadable are: a missing field, a nullability that loosened, another type,
    or a name that changed its case.
    """
    if isinstance(actual, DataFrame):
        actual = actual.schema
    fields = "path string, k string, type string, nullable boolean, meta string"
    e = local_rows(spark, schema_rows(expected), fields).alias("e")
    a = local_rows(spark, schema_rows(actual), fields).alias("a")
    missing, extra = F.col("a.k").isNull(), F.col("e.k").isNull()
    both = ~missing & ~extra
    flag = {
        "missing": missing,
        "extra": extra,
        "case": both & (F.col("e.path") != F.col("a.path")),
        "nullability": both & (F.col("e.nullable") != F.col("a.nullable")),
        "type": both & (F.col("e.type") != F.col("a.type")),
        "metadata": both & (F.col("e.meta") != F.col("a.meta")),
    }
    differences = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in flag.items()])
    loosened = both & ~F.col("e.nullable") & F.col("a.nullable")
    return e.join(a, F.col("e.k") == F.col("a.k"), "full").select(
        F.coalesce("e.path", "a.path").alias("path"),
        differences.alias("differences"),
        F.col("e.type").alias("expected_type"),
        F.col("a.type").alias("actual_type"),
        (~(missing | flag["case"] | flag["type"] | loosened)).alias("read_compatible"),
    ).filter(F.col("differences") != "")


# -- E4, E5 ---------------------------------------------------------------------


def _null_violations(value: Column, data_type: T.DataType, path: str) -> list[tuple[str, Column]]:
    """NULLs in NOT NULL struct fields below a value."""
    out: list[tuple[str, Column]] = []
    if isinstance(data_type, T.StructType):
        for f in data_type.fields:
            inner = value.getField(f.name)
            p = f"{path}.{f.name}"
            if not f.nullable:
                out.append((p, value.isNotNull() & inner.isNull()))
            out.extend(_null_violations(inner, f.dataType, p))
    return out


def not_null_rules(schema: T.StructType) -> dict[str, Column]:
    """Violation condition of every NOT NULL column of a schema, nested ones included."""
    rules: dict[str, Column] = {}
    for f in schema.fields:
        value = F.col(quoted(f.name))
        if not f.nullable:
            rules[f.name] = value.isNull()
        rules.update(_null_violations(value, f.dataType, f.name))
    return rules


def expr_rules(checks: Mapping[str, str | Column]) -> dict[str, Column]:
    """A check is violated when it is false or NULL."""
    return {name: ~F.coalesce(as_column(c), F.lit(False)) for name, c in checks.items()}


def stored_checks(schema: T.StructType) -> dict[str, str]:
    """Checks kept in column metadata under ``check``."""
    return {f"{f.name}: {f.metadata['check']}": f.metadata["check"]
            for f in schema.fields if "check" in f.metadata}


def enforce(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Fail the job on the first row that breaks a rule; otherwise pass rows through."""
    if not rules:
        return df
    broken = F.lit(None).cast("string")
    for name, bad in reversed(list(rules.items())):
        broken = F.when(bad, F.lit(f"constraint violated: {name}")).otherwise(broken)
    guard = F.when(broken.isNotNull(), F.raise_error(broken).cast("boolean")).otherwise(F.lit(True))
    return df.filter(guard)


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pass rows through, failing on a NULL in one of the (possibly nested) columns."""
    return enforce(df, {c: F.col(c).isNull() for c in cols})


def check_expr(df: DataFrame, checks: Mapping[str, str | Column]) -> DataFrame:
    """Pass rows through, failing where a check is false or NULL (E5)."""
    return enforce(df, expr_rules(checks))


def audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violation count of every rule in one pass over the rows."""
    counts = df.agg(*[F.count(F.when(bad, True)).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations"))
             for i, n in enumerate(rules)]
    return counts.select(F.explode(F.array(*pairs)).alias("x")).select("x.*")


# -- E7 -------------------------------------------------------------------------

# Partition value types, narrow to wide, as inference tries them.
_LADDER = ("int", "bigint", "decimal", "double", "timestamp", "date", "string")


def partition_values(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """(path, column, raw value) of every ``name=value`` directory of a path."""
    parts = F.filter(F.split(F.col(path_col), "/"), lambda x: x.contains("="))
    return paths.select(F.col(path_col).alias("path"), F.explode(parts).alias("p")).select(
        "path",
        unescape_path(F.substring_index("p", "=", 1)).alias("column"),
        F.regexp_replace("p", "^[^=]*=", "").alias("raw"),
    )


def value_type(raw: Column) -> Column:
    """Narrowest type of one partition value; NULL for the NULL partition."""
    text = unescape_path(raw)
    whole = raw.rlike(r"^[+-]?[0-9]+$")
    scaled = raw.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    big = F.length(F.regexp_replace(raw, r"^[+-]?0*", "")) <= 38
    return (
        F.when(raw == NULL_PARTITION, F.lit(None).cast("string"))
        .when(whole & raw.try_cast("int").isNotNull(), "int")
        .when(whole & raw.try_cast("bigint").isNotNull(), "bigint")
        .when(whole & big, "decimal")
        .when(scaled, "double")
        .when(raw.rlike(r"^(NaN|[+-]?Infinity)$"), "double")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?$")
              & text.try_cast("timestamp_ntz").isNotNull(), "timestamp")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull(), "date")
        .otherwise("string")
    )


def infer_partition_types(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """One type per partition column of a set of paths.

    Values widen along int, bigint, decimal and date, timestamp; bigint or
    decimal together with double, and any other mix, becomes string.
    """
    typed = partition_values(paths, path_col).groupBy("column", value_type(F.col("raw")).alias("t")).agg(
        F.count(F.lit(1)).alias("n")
    )
    seen = F.array_compact(F.collect_set("t"))
    def only(*names: str) -> Column:
        return F.size(F.array_except("seen", F.array(*[F.lit(n) for n in names]))) == 0
    merged = (
        F.when(F.size("seen") == 0, F.lit("void"))
        .when(F.size("seen") == 1, F.element_at("seen", 1))
        .when(only("int", "bigint"), "bigint")
        .when(only("int", "bigint", "decimal"), "decimal")
        .when(only("int", "double"), "double")
        .when(only("date", "timestamp"), "timestamp")
        .otherwise("string")
    )
    return (
        typed.groupBy("column")
        .agg(seen.alias("seen"), F.sum("n").alias("values"))
        .select("column", merged.alias("type"), "values")
    )
