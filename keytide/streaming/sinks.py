"""Structured Streaming sinks onto tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from keytide.functions.columns import quoted
from keytide.operators.table import KeyedTable, State, described
from keytide.plans import schema as S
from keytide.spec import TableError, TableSpec
from keytide.streaming import cdc

MODES = ("append", "complete", "update")
# Operations of change events that carry a row.
ROW_OPS = ("c", "r", "u", "d")


def check_stream(spec: TableSpec, schema: T.StructType, mode: str, range_cols: Sequence[str] | None = None,
                 merge_schema: bool = False) -> None:
    """Refuse a stream that does not fit its table."""
    if mode not in MODES:
        raise TableError(f"mode must be one of {MODES}, not {mode}")
    if mode == "update" and not spec.keys:
        raise TableError("update mode needs a table with hash keys")
    if S.has_null_type(schema):
        raise TableError("a stream may not carry untyped NULL columns")
    if range_cols is not None and tuple(range_cols) != spec.range_cols:
        raise TableError(f"the table is partitioned by {spec.range_cols}, not {tuple(range_cols)}")
    if set(schema.fieldNames()) <= set(spec.range_cols) | set(spec.keys):
        raise TableError("not all columns may be partition columns")
    if S.merge_schemas(spec.schema, schema) != spec.schema and not merge_schema:
        raise TableError("the stream needs another schema than the table has")


def batch_writer(
    root: str, query_id: str, mode: str = "append", merge_schema: bool = False, create: TableSpec | None = None
) -> Callable[[DataFrame, int], None]:
    """Function for `foreachBatch`: one commit per batch, replays skipped.

    With ``create`` the first batch that finds no table makes it: description, data and
    the mark of the batch become visible together, as version 0 (T1). Of two streams that
    both find no table one fails, and goes on into the other's table when it is restarted.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, tag = batch.sparkSession, (query_id, batch_id)
        table = KeyedTable(spark, root)
        missing = create is not None and not KeyedTable.exists(spark, root)
        state = State(create, -1, new=True) if missing else table.state_before(tag)
        if state is None:
            return
        check_stream(state.spec, batch.schema, mode, merge_schema=merge_schema)
        if mode == "complete":
            table.overwrite(batch, merge_schema, batch=tag, state=state)
        elif state.spec.keys:
            table.upsert(batch, merge_schema=merge_schema, batch=tag, state=state)
        else:
            table.append(batch, merge_schema, batch=tag, state=state)

    return write


def write_stream(
    df: DataFrame, root: str, query_id: str, checkpoint: str, mode: str = "append", merge_schema: bool = False,
    create: Mapping[str, object] | None = None,
) -> DataStreamWriter:
    """Writer of a stream into a table (S15); call ``start`` on it.

    A missing table is an error unless ``create`` gives its ``range_cols``, ``keys``,
    ``buckets`` and properties, as for `KeyedTable.define`; an existing table must
    then have the same range columns and keys.
    """
    wanted = None if create is None else described(df.schema, **create)
    exists = wanted is None or KeyedTable.exists(df.sparkSession, root)
    spec = KeyedTable(df.sparkSession, root).spec() if exists else wanted
    check_stream(spec, df.schema, mode, None if wanted is None else wanted.range_cols, merge_schema)
    if wanted is not None and spec.keys != wanted.keys:
        raise TableError(f"the table has the keys {spec.keys}, not {wanted.keys}")
    return (
        df.writeStream.foreachBatch(batch_writer(root, query_id, mode, merge_schema, wanted))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )


def windowed_counts(df: DataFrame, time_col: str, width: str = "5 seconds", delay: str = "10 seconds") -> DataFrame:
    """Tumbling event-time counts; a window closes once the watermark passes its end (T4)."""
    return (
        df.withWatermark(time_col, delay)
        .groupBy(F.window(time_col, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "count")
    )


def change_applier(
    root: str, query_id: str, row: T.StructType, order: Sequence[Column], merge_schema: bool = False
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function that upserts change events.

    Batches hold raw JSON records. Per key only the newest change by ``order``
    (over source, ts_ms and the row's columns) is written. Events whose operation is
    none of ``ROW_OPS`` change no row and are passed over.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, root)
        _apply_events(table, cdc.parse_events(batch, row), order, merge_schema, (query_id, batch_id))

    return write


def _apply_events(
    table: KeyedTable, events: DataFrame, order: Sequence[Column], merge_schema: bool, tag: tuple[str, int]
) -> None:
    state = table.state_before(tag)
    if state is None:
        return
    spec = state.spec
    # truncate, heartbeat and other events have no row image
    events = events.filter(F.col("op").isin(list(ROW_OPS)))
    rows = cdc.flatten_envelope(events, spec.cdc_col or "op", keep=("source", "ts_ms"))
    newest = cdc.latest_changes(rows, spec.primary_key, order).drop("source", "ts_ms")
    if spec.cdc_col is None:
        newest = newest.drop("op")
    table.upsert(newest, merge_schema=merge_schema, batch=tag, state=state)


def table_router(
    tables: Mapping[str, tuple[str, T.StructType]],
    query_id: str,
    order: Sequence[Column],
    unknown: str = "error",
    merge_schema: bool = True,
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function that sends each event to its own table.

    ``tables`` maps ``db.table`` to (root, row type). Each table commits by its
    own (query, batch), so a replay after a partial failure only writes the
    tables that are still missing. ``unknown`` is error or ignore.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        text = F.col("value").cast("string")
        named = batch.filter(text.isNotNull() & ~cdc.is_ddl(text)).select(
            text.alias("value"),
            F.concat_ws(".", F.get_json_object(text, "$.source.db"), F.get_json_object(text, "$.source.table"))
            .alias("__table"),
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = {r["__table"] for r in named.select("__table").distinct().collect()}
            if seen - set(tables) and unknown == "error":
                raise TableError(f"events of unknown tables: {sorted(seen - set(tables))}")
            for name in sorted(seen & set(tables)):
                root, row = tables[name]
                table = KeyedTable(spark, root)
                mine = named.filter(F.col("__table") == name)
                _apply_events(table, cdc.parse_events(mine, row), order, merge_schema, (query_id, batch_id))
        finally:
            named.unpersist()

    return write


def sync_schema(table: KeyedTable, after: T.StructType) -> bool:
    """Grow a table to the row type seen after a schema change."""
    spec = table.spec()
    merged = S.merge_schemas(spec.schema, after)
    if merged == spec.schema:
        return False
    known = {n.lower() for n in spec.schema.fieldNames()}
    table.alter([S.add_column(quoted_path(f.name), f.dataType) for f in merged.fields if f.name.lower() not in known])
    return True


def quoted_path(name: str) -> str:
    if "." in name:
        raise TableError(f"column {quoted(name)} has a dot in its name")
    return name
