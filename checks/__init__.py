"""Registered queries with their SQL twins, one module per operator family."""

from __future__ import annotations

from checks import cdc, guards, joins, logs, merge, schemas, streams, tables

_MODULES = (merge, tables, logs, schemas, joins, cdc, streams, guards)


def all_queries():
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def all_sql():
    return {name: s for m in _MODULES for name, s in m.SQL.items()}
