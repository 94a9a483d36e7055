"""Keyed, versioned Parquet tables expressed as Spark jobs."""

from keytide.functions.merge_ops import (
    Concat,
    Custom,
    Latest,
    MergeOp,
    NonNull,
    Running,
    Sum,
    register_merge_op,
)
from keytide.operators.table import KeyedTable
from keytide.spec import TableError, TableSpec

__all__ = [
    "Concat",
    "Custom",
    "KeyedTable",
    "Latest",
    "MergeOp",
    "NonNull",
    "Running",
    "Sum",
    "TableError",
    "TableSpec",
    "register_merge_op",
]
