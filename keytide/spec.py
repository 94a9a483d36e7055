"""Table description kept in the commit log."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

WRITE = "__write"
COMMIT = "__commit"
BUCKET = "__bucket"
RESERVED = (WRITE, COMMIT, BUCKET)


class TableError(Exception):
    """A table rule was violated; nothing has been committed."""


@dataclass(frozen=True)
class TableSpec:
    """Schema, partitioning and write rules of one table.

    ``range_cols`` are directory partitions, ``keys`` the hash-bucketed columns.
    The primary key of a row is both together. ``bucket_by`` names the keys whose hash
    places a row, all of them by default; tables with the same buckets over the columns
    of a join are joined in place. ``order_cols`` rank rows of one key inside
    one commit; without them such rows collapse in arbitrary order.
    """

    schema: T.StructType
    range_cols: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    buckets: int | None = None
    cdc_col: str | None = None
    append_only: bool = False
    order_cols: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    write_options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        names = self.schema.fieldNames()
        lowered = [n.lower() for n in names]
        if len(set(lowered)) != len(lowered):
            raise TableError(f"column names must differ by more than case: {names}")
        for c in RESERVED:
            if c in lowered:
                raise TableError(f"column name {c} is reserved")
        for c in (*self.range_cols, *self.keys, *self.order_cols):
            if c not in names:
                raise TableError(f"column {c} is not in the schema {names}")
        if set(self.range_cols) & set(self.keys):
            raise TableError("a column cannot be both range and hash partition")
        if self.keys and (self.buckets is None or self.buckets < 1):
            raise TableError("a table with hash keys needs a positive bucket count")
        if set(self.bucket_by) - set(self.keys):
            raise TableError(f"buckets may be made of the keys {list(self.keys)} only")
        if names and len(set(self.range_cols) | set(self.keys)) == len(names):
            raise TableError("not all columns may be partition columns")
        if self.cdc_col is not None and self.cdc_col not in names:
            raise TableError(f"change column {self.cdc_col} is not in the schema")

    @property
    def primary_key(self) -> list[str]:
        return [*self.range_cols, *self.keys] if self.keys else []

    @property
    def bucket_cols(self) -> list[str]:
        return list(self.bucket_by or self.keys)

    @property
    def columns(self) -> list[str]:
        """Data columns first, range columns last."""
        names = self.schema.fieldNames()
        return [c for c in names if c not in self.range_cols] + list(self.range_cols)

    @property
    def value_cols(self) -> list[str]:
        return [c for c in self.columns if c not in self.primary_key]

    def field(self, name: str) -> T.StructField:
        return self.schema[name]

    def with_schema(self, schema: T.StructType) -> TableSpec:
        return replace(self, schema=schema)

    def to_json(self) -> str:
        return json.dumps(
            {
                "schema": self.schema.jsonValue(),
                "range_cols": list(self.range_cols),
                "keys": list(self.keys),
                "buckets": self.buckets,
                "cdc_col": self.cdc_col,
                "append_only": self.append_only,
                "order_cols": list(self.order_cols),
                "bucket_by": list(self.bucket_by),
                "write_options": self.write_options,
            }
        )

    @staticmethod
    def from_json(text: str) -> TableSpec:
        d = json.loads(text)
        return TableSpec(
            schema=T.StructType.fromJson(d["schema"]),
            range_cols=tuple(d["range_cols"]),
            keys=tuple(d["keys"]),
            buckets=d["buckets"],
            cdc_col=d["cdc_col"],
            append_only=d["append_only"],
            order_cols=tuple(d["order_cols"]),
            bucket_by=tuple(d["bucket_by"]),
            write_options=d["write_options"],
        )
