"""A keyed, versioned table in a folder."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide.functions.columns import NULL_PARTITION, all_of, as_column, bucket_id, parse_partition_desc, partition_desc, quoted
from keytide.functions.merge_ops import Custom, MergeOp, Running, resolve_ops
from keytide.plans import dml
from keytide.plans import schema as S
from keytide.plans.merge import SEQ, Versions, fold_versions, overlay
from keytide.sources import log as L
from keytide.sources import storage
from keytide.sources.scratch import scratch_dir
from keytide.spec import COMMIT, WRITE, TableError, TableSpec

Where = Column | str | Sequence[Column | str] | None
Ops = Mapping[str, MergeOp | str] | None

#: changes up to this many rows may be broadcast onto a base of at least this many bytes
OVERLAY_ROWS = 500_000
OVERLAY_MIN_BASE = 256 * 2**20
#: writes, or partitions with changes, up to which bases are merged in place
MAX_BASES = 16
#: how many times its compressed size a Parquet file may take in memory
INFLATED = 10
#: changed rows per bucket that a hash table may hold
HASH_ROWS = 200_000
#: bytes of a bucket up to which one task folds it where it lies
FOLD_BYTES = 16 * 2**20
#: merge positions of one log version; ids have digits for as many versions again
_ORDERS = 10**9
#: deltas a partition must exceed before an unforced compaction touches it
MIN_DELTAS = 5


@dataclass(frozen=True)
class Commit:
    """One commit as a partition version lists it."""

    id: str
    dir: str
    cols: tuple[str, ...]
    clean: bool
    parts: int
    files: int
    bytes: int
    rows: int
    dead: tuple[int, ...] = ()
    holes: tuple[str, ...] = ()

    def row(self) -> dict:
        return {**vars(self), **{n: list(getattr(self, n)) for n in ("cols", "dead", "holes")}}


@dataclass(frozen=True)
class Partition:
    """Newest (or a chosen) version of one partition."""

    desc: str
    values: dict[str, str]
    version: int
    op: str
    commits: tuple[Commit, ...]

    def base(self) -> tuple[Commit, ...]:
        """Commits that share no key: the clean ones at the start."""
        n = next((i for i, c in enumerate(self.commits) if not c.clean), len(self.commits))
        return self.commits[:n]

    def deltas(self) -> tuple[Commit, ...]:
        return self.commits[len(self.base()):]


@dataclass(frozen=True)
class State:
    """What the log says now; a pure function of the log."""

    spec: TableSpec
    log_version: int
    partitions: dict[str, Partition] = field(default_factory=dict)
    new: bool = False
    attempt: str = field(default_factory=L.new_attempt)

    def live(self) -> list[Partition]:
        return [p for p in self.partitions.values() if p.commits]


def _commits(rows) -> tuple[Commit, ...]:
    return tuple(
        Commit(c["id"], c["dir"], tuple(c["cols"]), c["clean"], c["parts"], c["files"], c["bytes"],
               c["rows"], tuple(c["dead"] or ()), tuple(c["holes"] or ()))
        for c in rows or ()
    )


def _as_list(where: Where) -> list[Column | str]:
    if where is None:
        return []
    return [where] if isinstance(where, (Column, str)) else list(where)


def described(
    schema: T.StructType, range_cols: Sequence[str] = (), keys: Sequence[str] = (), buckets: int | None = None, **props
) -> TableSpec:
    """Table description; primary key columns become NOT NULL."""
    fields = [
        T.StructField(f.name, f.dataType, f.nullable and f.name not in (*range_cols, *keys), f.metadata)
        for f in schema.fields
    ]
    return TableSpec(T.StructType(fields), tuple(range_cols), tuple(keys), buckets, **props)


class KeyedTable:
    """Handle on one table. Every call reads the log anew; nothing is cached.

    ``where`` arguments take one condition or a list of conjuncts. Conjuncts over
    range columns alone choose partitions before any data is listed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- opening and creating -----------------------------------------------------

    @staticmethod
    def exists(spark: SparkSession, root: str) -> bool:
        return L.exists(spark, root.rstrip("/"))

    @classmethod
    def for_path(cls, spark: SparkSession, root: str) -> KeyedTable:
        table = cls(spark, root)
        L.read_versions(spark, table.root)
        return table

    @classmethod
    def define(
        cls,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        range_cols: Sequence[str] = (),
        keys: Sequence[str] = (),
        buckets: int | None = None,
        **props,
    ) -> KeyedTable:
        """Create an empty table from a schema; primary key columns become NOT NULL."""
        table = cls(spark, root)
        spec = described(schema, range_cols, keys, buckets, **props)
        L.publish(spark, table.root, 0, [{"kind": "spec", "spec": spec.to_json()}], L.new_attempt())
        return table

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        df: DataFrame,
        range_cols: Sequence[str] = (),
        keys: Sequence[str] = (),
        buckets: int | None = None,
        unique_keys: bool = False,
        mode: str = "error",
        **props,
    ) -> KeyedTable:
        """Create a table from a query (S12); ``mode`` error or ignore when it exists.

        ``unique_keys`` promises that no key repeats in the data, which is
        checked; reads then need no merge until the first upsert. Description
        and data become visible together, as version 0.
        """
        if mode not in ("error", "ignore"):
            raise TableError(f"mode must be error or ignore, not {mode}")
        if cls.exists(spark, root):
            if mode == "ignore":
                return cls(spark, root)
            raise TableError(f"{root} exists")
        df = S.drop_null_type(df)
        table = cls(spark, root)
        spec = described(df.schema, range_cols, keys, buckets, **props)
        if unique_keys:
            table._assert_unique(spec, df)
        table._write(State(spec, -1, new=True), [df], L.APPEND, clean=unique_keys)
        return table

    def _assert_unique(self, spec: TableSpec, df: DataFrame) -> None:
        """A promise of unique keys decides how reads merge, so it is not taken on trust."""
        keys = spec.primary_key
        if keys and not df.groupBy(*[F.col(quoted(k)) for k in keys]).count().filter("count > 1").isEmpty():
            raise TableError(f"keys {keys} repeat in the data")

    # -- log ----------------------------------------------------------------------

    def state(self) -> State:
        log = L.read_versions(self.spark, self.root)
        newest = log.groupBy("kind", "partition").agg(
            F.max_by(F.struct("log_version", "values", "version", "op", "commits", "spec"),
                     F.col("log_version")).alias("n")
        )
        spec, last, parts = None, -1, {}
        for r in newest.collect():
            n = r["n"]
            last = max(last, n["log_version"])
            if r["kind"] == "spec":
                spec = TableSpec.from_json(n["spec"])
            elif r["kind"] == "partition":
                parts[r["partition"]] = Partition(
                    r["partition"], dict(n["values"] or {}), n["version"], n["op"], _commits(n["commits"])
                )
        if spec is None:
            raise TableError(f"{self.root} has no table description")
        return State(spec, last, parts)

    def spec(self) -> TableSpec:
        return self.state().spec

    def versions(self) -> DataFrame:
        """Partition version rows of the whole log."""
        return L.read_versions(self.spark, self.root).filter(F.col("kind") == "partition")

    def history(self, partition: str | None = None) -> DataFrame:
        """Versions of a partition, oldest first (V3)."""
        return L.history(self.versions(), partition).select(
            "partition", "version", "op", F.size("commits").alias("commits"), "committed_at"
        )

    def live_files(self) -> DataFrame:
        """Files the current snapshot reads (V1)."""
        return L.live_files(L.read_files(self.spark, self.root).withColumn("seq", F.col("log_version")))

    def size_report(self, where: Where = None) -> DataFrame:
        """Bytes of live files per partition (V6)."""
        return L.size_report(self._in_partitions(self.live_files(), where))

    def layout_report(self, where: Where = None) -> DataFrame:
        """Files and delta depth per partition and bucket (V7)."""
        return L.layout_report(self._in_partitions(self.live_files(), where))

    def _in_partitions(self, rows: DataFrame, where: Where) -> DataFrame:
        """Rows of matching partitions, judged on their descriptors inside Spark."""
        conjuncts = self._conjuncts(where)
        if not conjuncts:
            return rows
        spec = self.spec()
        named = rows.withColumn("__v", parse_partition_desc(F.col("partition")))
        for c in spec.range_cols:
            raw = F.col("__v")[c]
            value = F.when(raw != NULL_PARTITION, raw).cast(spec.field(c).dataType)
            named = named.withColumn(c, value)
        return named.filter(all_of(conjuncts)).select(*rows.columns)

    def state_before(self, batch: tuple[str, int]) -> State | None:
        """The state a streaming batch starts from; None when the batch is committed already (T5)."""
        log = L.read_versions(self.spark, self.root)
        done = (F.col("kind") == "batch") & (F.col("query_id") == batch[0]) & (F.col("batch_id") == batch[1])
        return None if not log.filter(done).isEmpty() else self.state()

    # -- pruning ------------------------------------------------------------------

    def _partition_frame(self, state: State, parts: Iterable[Partition]) -> DataFrame:
        spec = state.spec
        raw = T.StructType([T.StructField("__partition", T.StringType())])
        for c in spec.range_cols:
            raw = raw.add(c, T.StringType())
        rows = [
            {"__partition": p.desc, **{c: v for c, v in p.values.items() if v != NULL_PARTITION}} for p in parts
        ]
        frame = L.local_rows(self.spark, rows, raw)
        return frame.select(
            "__partition",
            *[F.col(quoted(c)).cast(spec.field(c).dataType).alias(c) for c in spec.range_cols],
        )

    def _conjuncts(self, where: Where) -> list[Column]:
        """Conditions taken apart at their outer ANDs, which Spark's own parser finds in texts."""
        parser = self.spark._jsparkSession.sessionState().sqlParser()
        out: list[Column] = []
        for c in _as_list(where):
            if not isinstance(c, str):
                out.append(c)
                continue
            todo = [parser.parseExpression(c)]
            if todo[0].getClass().getSimpleName() != "And":
                out.append(as_column(c))
                continue
            while todo:
                tree = todo.pop()
                if tree.getClass().getSimpleName() == "And":
                    todo += [tree.right(), tree.left()]
                else:
                    out.append(as_column(tree.sql()))
        return out

    def _prune(self, state: State, where: Where) -> tuple[list[Partition], list[Column], list[Column]]:
        """Live partitions that match, the conjuncts that chose them, and the rest."""
        live = state.live()
        conjuncts = self._conjuncts(where)
        if not conjuncts:
            return live, [], []
        if not state.spec.range_cols:
            return live, [], conjuncts
        frame = self._partition_frame(state, live)
        chosen, rest = [], []
        for c in conjuncts:
            try:
                kept = frame.filter(c)
            except AnalysisException:
                rest.append(c)
                continue
            if self._odd(kept):  # one draw for a partition is not one for each of its rows
                rest.append(c)
            else:
                frame = kept
                chosen.append(c)
        if chosen:
            kept = {r["__partition"] for r in frame.select("__partition").collect()}
            live = [p for p in live if p.desc in kept]
        return live, chosen, rest

    def _over_keys(self, spec: TableSpec, cond: Column) -> bool:
        """Whether a condition uses primary key columns alone."""
        keys = T.StructType([spec.field(c) for c in spec.primary_key])
        try:
            return bool(spec.keys) and not self._odd(L.local_rows(self.spark, [], keys).filter(cond))
        except AnalysisException:
            return False

    def _odd(self, filtered: DataFrame) -> str | None:
        """What keeps a filter from being a condition on one row; the analysed plan tells,
        so the spelling of a function does not matter."""
        plan = filtered._jdf.queryExecution().analyzed()
        if plan.getClass().getSimpleName() != "Filter":
            return "the condition is not a condition on one row"
        condition = plan.condition()
        if self.spark._jvm.org.apache.spark.sql.catalyst.expressions.SubqueryExpression.hasSubquery(condition):
            return "the condition may not use a subquery"
        return None if condition.deterministic() else "the condition must be deterministic"

    def _only_range(self, state: State, where: Where, what: str) -> list[Partition]:
        self._refuse_odd(state, where)
        parts, chosen, rest = self._prune(state, where)
        if rest or not chosen:
            raise TableError(f"{what} needs a condition over the range columns {list(state.spec.range_cols)}")
        return parts

    def _one_partition(self, state: State, where: Where, what: str) -> Partition:
        parts = self._only_range(state, where, what)
        if len(parts) != 1:
            raise TableError(f"{what} must match one partition, not {len(parts)}: {[p.desc for p in parts][:10]}")
        return parts[0]

    # -- reading ------------------------------------------------------------------

    def _empty(self, spec: TableSpec) -> DataFrame:
        fields = [T.StructField(c, spec.field(c).dataType, True, spec.field(c).metadata) for c in spec.columns]
        return L.local_rows(self.spark, [], T.StructType(fields))

    def _scan(
        self, spec: TableSpec, picked: Sequence[tuple[Partition, Sequence[Commit]]], paths: bool = False, bucketed: bool = True
    ) -> Versions | None:
        """Rows of chosen commits of chosen partitions."""
        pairs = [(p, c) for p, commits in picked for c in commits]
        seen: dict[str, int] = {}
        for _, c in pairs:
            seen[c.id] = seen.get(c.id, 0) + 1
        whole = frozenset(c.id for _, c in pairs if seen[c.id] == c.parts)
        return storage.scan(self.spark, self.root, spec, pairs, whole, paths, bucketed)

    def _complete_columns(self, df: DataFrame, spec: TableSpec) -> list[Column]:
        return [
            F.col(quoted(c)) if c in df.columns else F.lit(None).cast(spec.field(c).dataType).alias(c) for c in spec.columns
        ]

    def _complete(self, df: DataFrame, spec: TableSpec) -> DataFrame:
        return df.select(*self._complete_columns(df, spec))

    def _way(self, spec: TableSpec, parts: Sequence[Partition], ops: Mapping[str, MergeOp]) -> tuple[str, bool]:
        """How to merge changes into the bases of partitions, and whether buckets keep the bases in place.

        Numbers of rows and bytes are in the log. A base stays in place as long as it comes from few
        writes, and keys beside the buckets are compared with few partitions' changes.
        """
        if any(not op.single_is_identity for op in ops.values()) or not all(p.base() for p in parts):
            return "fold", False
        changes = [c for p in parts for c in p.deltas()]
        rows = sum(c.rows for c in changes)
        if rows > HASH_ROWS * spec.buckets:
            return "fold", False
        bases = storage.by_writes([(p, c) for p in parts for c in p.base()])
        in_place = len(bases) <= MAX_BASES and spec.bucket_cols == list(spec.keys) and (
            not spec.range_cols or len(parts) <= MAX_BASES)
        if sum(c.bytes for p in parts for c in p.base()) < OVERLAY_MIN_BASE:
            return "full" if not in_place or len(bases) == 1 else "hash", in_place
        raw = str(self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).lower().rstrip("b")
        units = {"k": 2**10, "m": 2**20, "g": 2**30}
        limit = int(raw[:-1]) * units[raw[-1]] if raw[-1:] in units else int(raw)
        small = rows <= OVERLAY_ROWS and sum(c.bytes for c in changes) * INFLATED <= limit
        return "broadcast" if small else "hash", in_place

    def _merged(
        self, spec: TableSpec, parts: Sequence[Partition], ops: dict[str, MergeOp], on_keys: Sequence[Column] = ()
    ) -> DataFrame:
        """Rows of partitions, merged; ``on_keys`` conditions filter versions before the merge."""
        parts = [p for p in parts if p.commits]
        if not parts:
            return self._empty(spec)
        if not spec.keys:
            return self._complete(self._scan(spec, [(p, p.commits) for p in parts]).rows, spec)
        fold_always = any(not op.single_is_identity for op in ops.values())
        plain = [p for p in parts if not p.deltas() and not fold_always]
        mixed = [p for p in parts if p not in plain]
        out: list[DataFrame] = []
        if plain:
            out.append(self._complete(self._scan(spec, [(p, p.commits) for p in plain]).rows, spec))
        if mixed:
            out.append(self._merge_deltas(spec, mixed, ops, on_keys))
        return out[0] if len(out) == 1 else out[0].unionByName(out[1])

    def _merge_deltas(
        self, spec: TableSpec, parts: Sequence[Partition], ops: dict[str, MergeOp], on_keys: Sequence[Column]
    ) -> DataFrame:
        keys = spec.primary_key
        way, in_place = self._way(spec, parts, ops)
        if way == "fold":
            # large buckets are dealt anew: partial aggregates and shuffles cut their work into tasks of bounded size
            in_buckets = sum(c.bytes for p in parts for c in p.commits) <= FOLD_BYTES * spec.buckets
            versions = self._scan(spec, [(p, p.commits) for p in parts], bucketed=in_buckets)
            for c in on_keys:
                versions = replace(versions, rows=versions.rows.filter(c))
            present = [c for c in spec.columns if c in versions.rows.columns]
            known = {c: op for c, op in ops.items() if c in present}
            return self._complete(fold_versions(versions, keys, present, known), spec)
        groups = [[(p, p.base()) for p in parts]]
        if in_place:
            by_write = storage.by_writes([(p, c) for p in parts for c in p.base()])
            groups = [[(p, [c]) for p, c in pairs] for pairs in by_write.values()]
        bases = [self._complete(self._scan(spec, g).rows, spec) for g in groups]
        changes = self._scan(spec, [(p, p.deltas()) for p in parts])
        for c in on_keys:
            bases, changes = [b.filter(c) for b in bases], replace(changes, rows=changes.rows.filter(c))
        buckets = (spec.buckets, spec.bucket_cols) if in_place else None
        rows = overlay(bases, _filled(changes, spec), keys, spec.columns, ops, way, False, buckets)
        return self._complete(rows, spec)

    def _placed(self, spec: TableSpec, parts: Sequence[Partition], ops: Mapping[str, MergeOp] | None = None) -> bool:
        """Whether merged rows come bucket by bucket, so that a write need not place them again."""
        if not spec.keys or any(not op.single_is_identity for op in (ops or {}).values()):
            return False
        mixed = [p for p in parts if p.deltas()]
        return not mixed or self._way(spec, mixed, ops or {})[1]

    def read(self, where: Where = None, ops: Ops = None) -> DataFrame:
        """Current rows, merged per key.

        Conjuncts over range columns prune partitions, those over the primary key
        also filter versions before the merge, the others filter merged rows.
        """
        state = self.state()
        parts, chosen, rest = self._prune(state, where)
        on_keys = [*chosen, *[c for c in rest if self._over_keys(state.spec, c)]]  # never a random one: it filters merged rows
        found = resolve_ops(ops, state.spec.schema, state.spec.primary_key)
        df = self._merged(state.spec, parts, found, on_keys)
        for c in [*chosen, *rest]:
            df = df.filter(c)
        return df

    to_df = read

    def read_as_of(self, partition: str, version: int, ops: Ops = None) -> DataFrame:
        """One partition as it was at a version."""
        state = self.state()
        row = L.as_of(self.versions(), partition, version).select("values", "op", "commits").first()
        if row is None:
            raise TableError(f"partition {partition} has no version {version}")
        part = Partition(partition, dict(row["values"] or {}), version, row["op"], _commits(row["commits"]))
        return self._merged(state.spec, [part], resolve_ops(ops, state.spec.schema, state.spec.primary_key))

    def read_commits(self, ids: Sequence[str], ops: Ops = None) -> DataFrame:
        """Rows of chosen commits of the current snapshot, merged among themselves."""
        state = self.state()
        wanted = set(ids)
        found = {c.id for p in state.live() for c in p.commits}
        if wanted - found:
            raise TableError(f"not in the snapshot: {sorted(wanted - found)}")
        parts = [replace(p, commits=tuple(c for c in p.commits if c.id in wanted)) for p in state.live()]
        return self._merged(state.spec, parts, resolve_ops(ops, state.spec.schema, state.spec.primary_key))

    def read_cdc(self, where: Where = None, ops: Ops = None) -> DataFrame:
        """Merged rows without those whose change column says delete."""
        col = self.spec().cdc_col
        if col is None:
            raise TableError("the table has no change column")
        return self.read(where, ops).filter(~(F.col(quoted(col)) == "delete"))

    @classmethod
    def read_path(cls, spark: SparkSession, path: str) -> DataFrame:
        """``root`` or ``root/a=1/b=2``: directories below the root filter (S3)."""
        root, conds = path.rstrip("/"), []
        while "=" in root.rsplit("/", 1)[-1]:
            root, last = root.rsplit("/", 1)
            name, value = last.split("=", 1)
            conds.append((name, value))
        table = cls.for_path(spark, root)
        spec = table.spec()
        where = []
        for name, value in conds:
            if name not in spec.range_cols:
                raise TableError(f"{name} is not a range column of {root}")
            where.append(F.col(quoted(name)) == F.lit(value).cast(spec.field(name).dataType))
        return table.read(where or None)

    # -- writing ------------------------------------------------------------------

    def _prepared(self, spec: TableSpec, df: DataFrame, merge_schema: bool, partial: bool) -> tuple[DataFrame, TableSpec]:
        """A source in the table's names and types, with its constraints attached."""
        df = S.drop_null_type(df)
        canonical = {n.lower(): n for n in spec.schema.fieldNames()}
        extra = [c for c in df.columns if c.lower() not in canonical]
        if extra and not merge_schema:
            raise TableError(f"columns {extra} are not in the table {spec.schema.fieldNames()}")
        if not extra:
            df = S.normalize_columns(df, spec.schema)
        have = {c.lower() for c in df.columns}
        for c in spec.range_cols if not spec.keys else spec.primary_key:
            if c.lower() not in have:
                raise TableError(f"partition column {c} is missing from {df.columns}")
        if not partial:
            lacking = [f.name for f in spec.schema.fields if not f.nullable and f.name.lower() not in have]
            if lacking:
                raise TableError(f"NOT NULL columns {lacking} are missing")
        merged = S.merge_schemas(spec.schema, df.schema)
        if merged != spec.schema:
            if not merge_schema:
                raise TableError("the data needs another schema; allow schema merge to evolve the table")
            known = {f.name for f in spec.schema.fields}
            merged = T.StructType(
                [f if f.name in known else T.StructField(f.name, f.dataType, True, f.metadata) for f in merged.fields]
            )
            spec = spec.with_schema(merged)
        df = S.conform(df, spec.schema, only_present=True)
        present = set(df.columns)
        rules = {
            n: c for n, c in S.not_null_rules(spec.schema).items() if n.split(".")[0] in present
        }
        # an empty text cannot be told from NULL in a folder name
        rules |= {
            f"{c} is an empty text": F.coalesce(F.col(quoted(c)) == "", F.lit(False))
            for c in spec.range_cols if isinstance(spec.field(c).dataType, T.StringType)
        }
        if present == set(spec.schema.fieldNames()):
            rules |= S.expr_rules(S.stored_checks(spec.schema))
        return S.enforce(df, rules), spec

    def _store(
        self,
        state: State,
        spec: TableSpec,
        sources: Sequence[DataFrame],
        clean: bool,
        dropped: DataFrame | None = None,
        order: int | None = None,
        placed: bool = False,
    ) -> tuple[list[dict[str, Commit]], dict[str, dict[str, str]]]:
        """Write each source as a commit; sources with equal columns share one job.

        File operations go to the log as they are listed, together with the
        ``dropped`` ones. Returns, in source order, the commit of every touched
        partition, and the partition values.
        """
        if len(sources) > _ORDERS:
            raise TableError(f"at most {_ORDERS} sources in one write")
        first = (state.log_version + 1) * _ORDERS
        ids = [storage.commit_id(first + i if order is None else order) for i in range(len(sources))]
        groups: dict[frozenset[str], list[int]] = {}
        for i, s in enumerate(sources):
            groups.setdefault(frozenset(s.columns), []).append(i)
        writes = []
        for members in groups.values():
            tagged = None
            for i in members:
                one = sources[i].withColumn(COMMIT, F.lit(ids[i]))
                tagged = one if tagged is None else tagged.unionByName(one)
            writes.append(_guarded(lambda t=tagged: storage.write_commits(t, self.root, spec, placed)))
        added = storage.commit_files(self.spark, self.root, spec, writes)
        if added is not None:
            cols = F.create_map(*[
                x for i, s in zip(ids, sources) for x in (F.lit(i), F.array(*[F.lit(c) for c in s.columns]))
            ])
            added = added.select(
                "*", F.lit(1).alias("pos"), F.lit("add").alias("file_op"), cols[F.col("commit_id")].alias("cols")
            )
        parts = self._log_files(state, added, dropped)
        per_commit: dict[str, int] = {}
        for p in parts:
            per_commit[p.commit] = per_commit.get(p.commit, 0) + 1
        out: list[dict[str, Commit]] = [{} for _ in sources]
        for p in parts:
            i = ids.index(p.commit)
            out[i][p.partition] = Commit(
                p.commit, p.dir, tuple(sources[i].columns), clean, per_commit[p.commit], p.files, p.bytes, p.rows
            )
        return out, {p.partition: p.values for p in parts}

    def _log_files(self, state: State, added: DataFrame | None, dropped: DataFrame | None) -> list[storage.Part]:
        """Log file operations of the coming version; totals of the added files."""
        names = [f.name for f in L.FILE_SCHEMA.fields if f.name not in ("log_version", "attempt")]
        ops = None if added is None else added.select(*names)
        if dropped is not None:
            dels = dropped.withColumns({"pos": F.lit(0), "file_op": F.lit("del")}).select(*names)
            ops = dels if ops is None else ops.unionByName(dels)
        if ops is None:
            return []
        stored = L.write_files(self.spark, self.root, state.log_version + 1, ops, state.attempt)
        return [] if added is None else storage.commit_parts(stored.filter(F.col("file_op") == "add"))

    def _publish(
        self,
        state: State,
        spec: TableSpec,
        op: str,
        new: dict[str, tuple[Commit, ...]],
        values: dict[str, dict[str, str]],
        batch: tuple[str, int] | None = None,
    ) -> None:
        """Publish partition versions; from here on readers see the write."""
        rows = []
        for desc, commits in new.items():
            old = state.partitions.get(desc)
            rows.append({
                "kind": "partition", "partition": desc,
                "values": values.get(desc, old.values if old else {}),
                "version": old.version + 1 if old else 0, "op": op, "commits": [c.row() for c in commits],
            })
        if state.new or spec != state.spec:
            rows.append({"kind": "spec", "spec": spec.to_json()})
        if batch is not None:
            rows.append({"kind": "batch", "query_id": batch[0], "batch_id": batch[1]})
        if rows:
            L.publish(self.spark, self.root, state.log_version + 1, rows, state.attempt)

    def _files_of(
        self, parts: Iterable[Partition], buckets: Mapping[str, Iterable[int]] | None = None
    ) -> DataFrame | None:
        """Live file rows of the commits that partitions list now, or of some of their buckets."""
        pairs = [{"partition": p.desc, "commit_id": c.id} for p in parts for c in p.commits]
        if not pairs:
            return None
        frame = L.local_rows(self.spark, pairs, "partition string, commit_id string")
        ops = L.read_files(self.spark, self.root).join(frame, ["partition", "commit_id"], "left_semi")
        if buckets is not None:
            some = [{"partition": d, "bucket": b} for d, found in buckets.items() for b in found]
            ops = ops.join(L.local_rows(self.spark, some, "partition string, bucket int"), ["partition", "bucket"], "left_semi")
        return L.live_files(ops.withColumn("seq", F.col("log_version")))

    def _write(
        self,
        state: State,
        sources: Sequence[DataFrame],
        op: str,
        merge_schema: bool = False,
        clean: bool = False,
        partial: bool = False,
        replaced: Sequence[Partition] = (),
        batch: tuple[str, int] | None = None,
        order: int | None = None,
        kept_tail: Mapping[str, tuple[Commit, ...]] | None = None,
        placed: bool = False,
        buckets: Mapping[str, Iterable[int]] | None = None,
    ) -> None:
        """Store sources and publish: ``replaced`` partitions start over, others grow.

        With ``buckets`` only those of the replaced partitions start over: the old commits
        stay without them, and a clean new commit stands beside the old clean ones.
        """
        spec, ready = state.spec, []
        for df in sources:
            one, spec = self._prepared(spec, df, merge_schema, partial)
            ready.append(one)
        tails = kept_tail or {}
        gone = [replace(p, commits=tuple(c for c in p.commits if c not in tails.get(p.desc, ()))) for p in replaced]
        stored, values = self._store(state, spec, ready, clean, self._files_of(gone, buckets), order, placed)
        if buckets is not None:
            self._publish(state, spec, op, _beside(replaced, buckets, stored[0], spec.buckets, state), values, batch)
            return
        fresh = {p.desc for p in replaced}
        new: dict[str, tuple[Commit, ...]] = {p.desc: () for p in replaced}
        for commits in stored:
            for desc, c in commits.items():
                if desc not in new:
                    old = state.partitions.get(desc)
                    new[desc] = old.commits if old and desc not in fresh else ()
                new[desc] = (*new[desc], c)
        for desc, tail in tails.items():
            new[desc] = (*new.get(desc, ()), *tail)
        self._publish(state, spec, op, new, values, batch)

    def _assert_removable(self, state: State) -> None:
        if state.spec.append_only:
            raise TableError("the table is append-only")

    # ``batch`` tags a streaming batch; ``state`` saves reading the log twice in one step.

    def append(
        self, df: DataFrame, merge_schema: bool = False, batch: tuple[str, int] | None = None,
        state: State | None = None,
    ) -> None:
        """Add rows (S6); a keyed table takes an append only as its first commit."""
        state = state or self.state()
        if state.spec.keys and state.partitions:
            raise TableError("append to a keyed table with data; use upsert")
        self._write(state, [df], L.APPEND, merge_schema, batch=batch)

    def overwrite(
        self, df: DataFrame, merge_schema: bool = False, unique_keys: bool = False,
        batch: tuple[str, int] | None = None, state: State | None = None,
    ) -> None:
        """Replace all rows."""
        state = state or self.state()
        self._assert_removable(state)
        if unique_keys:
            self._assert_unique(state.spec, df)
        self._write(state, [df], L.UPDATE, merge_schema, clean=unique_keys, replaced=state.live(), batch=batch)

    def replace_where(self, df: DataFrame, where: Where, merge_schema: bool = False) -> None:
        """Replace the partitions that match; a row outside the condition fails the write."""
        state = self.state()
        self._assert_removable(state)
        inside = self._only_range_condition(state, where)
        parts, _, _ = self._prune(state, where)
        guarded = S.enforce(df, {"row outside of the replaced partitions": ~F.coalesce(inside, F.lit(False))})
        self._write(state, [guarded], L.UPDATE, merge_schema, replaced=parts)

    def _only_range_condition(self, state: State, where: Where) -> Column:
        cond = all_of(_as_list(where))
        self._refuse_odd(state, where)
        try:
            self._partition_frame(state, []).filter(cond)
        except AnalysisException as e:
            raise TableError(f"the condition may use range columns {list(state.spec.range_cols)} only") from e
        return cond

    def insert_by_position(self, df: DataFrame, merge_schema: bool = False, overwrite: bool = False) -> None:
        """Columns land by position and are cast to the table's types."""
        spec = self.spec()
        df = positional(df, spec, merge_schema)
        if overwrite:
            self.overwrite(df, merge_schema)
        elif spec.keys and self.state().partitions:
            self.upsert(df, merge_schema=merge_schema)
        else:
            self.append(df, merge_schema)

    def insert_overwrite_partition(self, df: DataFrame, static: Mapping[str, object], by_position: bool = True) -> None:
        """Overwrite a fixed slice (S11); range columns without a value come from the data."""
        spec = self.spec()
        for c in static:
            if c not in spec.range_cols:
                raise TableError(f"{c} is not a range column")
        if by_position:
            free = [c for c in spec.columns if c not in static]
            part = TableSpec(T.StructType([spec.field(c) for c in free]))
            df = positional(df, part, False)
        df = df.withColumns({c: F.lit(v).cast(spec.field(c).dataType) for c, v in static.items()})
        where = [F.col(quoted(c)) == F.lit(v).cast(spec.field(c).dataType) for c, v in static.items()]
        self.replace_where(df, where)

    # -- upserts ------------------------------------------------------------------

    def _require_keys(self, state: State) -> None:
        if not state.spec.keys:
            raise TableError("upsert needs a table with hash keys")

    def upsert(
        self,
        source: DataFrame,
        where: Where = None,
        mode: str = "delta",
        merge_schema: bool = False,
        full_scan: bool = False,
        batch: tuple[str, int] | None = None,
        state: State | None = None,
    ) -> None:
        """Insert or change rows by key.

        ``delta`` appends the source as a commit that readers merge; an explicit
        NULL overwrites. ``rewrite`` joins and replaces partitions now; a NULL
        keeps the old value, and ``where`` limits both sides.
        """
        state = state or self.state()
        self._require_keys(state)
        if mode == "delta":
            self._write(state, [source], L.MERGE, merge_schema, partial=True, batch=batch)
            return
        if mode != "rewrite":
            raise TableError(f"mode must be delta or rewrite, not {mode}")
        self._assert_removable(state)
        self._refuse_odd(state, where)
        parts, chosen, _ = self._prune(state, where)
        if state.spec.range_cols and not chosen and not full_scan:
            raise TableError("a rewriting upsert needs a condition over the range columns")
        for c in chosen:
            source = source.filter(c)
        source, spec = self._prepared(state.spec, source, merge_schema, partial=True)
        source = source.groupBy(*[F.col(quoted(k)) for k in spec.primary_key]).agg(
            F.max_by(
                F.struct(*[F.col(quoted(c)) for c in source.columns]),
                F.struct(*[F.col(quoted(c)) for c in spec.order_cols if c in source.columns], F.lit(0)),
            ).alias("r")
        ).select("r.*")
        target = self._merged(spec, parts, {})
        joined = dml.rewrite_upsert(target, source, spec.primary_key)
        self._write(state, [joined], L.UPDATE, merge_schema, clean=True, replaced=parts, batch=batch)

    def bulk_upsert(self, sources: Sequence[DataFrame], merge_schema: bool = False) -> None:
        """Several sources, one write job, committed in list order as one version."""
        state = self.state()
        self._require_keys(state)
        if sources:
            self._write(state, list(sources), L.MERGE, merge_schema, partial=True)

    def merge_into(
        self,
        source: DataFrame,
        matched: Sequence[tuple[Column | str, Mapping[str, Column | str]]],
        insert: bool = True,
        where: Where = None,
    ) -> None:
        """Conditional merge on the key (U14); sides are named ``t`` and ``s``."""
        state = self.state()
        self._require_keys(state)
        self._assert_removable(state)
        self._refuse_odd(state, where)
        assigned = {dml.first_name(c).lower() for _, sets in matched for c in sets}
        if moved := [k for k in state.spec.primary_key if k.lower() in assigned]:
            raise TableError(f"a merge may not assign the key columns {moved}")
        parts, chosen, rest = self._prune(state, where)
        if rest:
            raise TableError("a merge may be limited by range columns only")
        for c in chosen:
            source = source.filter(c)
        target = self._merged(state.spec, parts, {})
        rows = dml.conditional_merge(target, source, state.spec.primary_key, matched, insert)
        self._write(state, [rows], L.UPDATE, clean=True, replaced=parts)

    # -- delete and update --------------------------------------------------------

    def delete(self, where: Where = None) -> None:
        """Delete rows (U8), whole partitions (U9) or everything.

        Conditions over range columns alone, or none, touch only the log.
        """
        state = self.state()
        self._assert_removable(state)
        self._refuse_odd(state, where)
        parts, chosen, rest = self._prune(state, where)
        if not parts:
            return
        if not rest:
            self._log_files(state, None, self._files_of(parts))
            self._publish(state, state.spec, L.DELETE, {p.desc: () for p in parts}, {})
            return
        cond = all_of([*chosen, *rest])
        self._rewrite(state, parts, cond, L.DELETE, lambda df: dml.keep_undeleted(df, cond))

    def update(self, changes: Mapping[str, Column | str], where: Where = None) -> None:
        """Assign columns or nested fields where the condition is true."""
        state = self.state()
        self._assert_removable(state)
        self._refuse_odd(state, where)
        parts, chosen, rest = self._prune(state, where)
        dml.assignments(self._empty(state.spec).schema, changes)
        if not parts:
            return
        cond = all_of([*chosen, *rest])
        # rows that are given the key of another one are merged with it by readers
        moved = {c.split(".")[0].strip("`").lower() for c in changes} & {k.lower() for k in state.spec.primary_key}
        self._rewrite(state, parts, cond, L.UPDATE, lambda df: dml.updated(df, changes, cond), not moved)

    def _refuse_odd(self, state: State, where: Where) -> None:
        """Aggregates, subqueries and non-deterministic conditions have no row-wise meaning."""
        for c in _as_list(where):
            try:
                odd = self._odd(self._empty(state.spec).filter(as_column(c)))
            except AnalysisException as e:
                raise TableError(f"the condition cannot be used: {e}") from e
            if odd:
                raise TableError(odd)

    def _rewrite(
        self, state: State, parts: Sequence[Partition], cond: Column | None, op: str, change, keys_stay: bool = True
    ) -> None:
        """Replace what holds matches by its changed rows: buckets of a keyed table, files of another."""
        if cond is None:
            merged = self._merged(state.spec, parts, {})
            self._write(state, [change(merged)], op, clean=bool(state.spec.keys) and keys_stay, replaced=parts,
                        placed=keys_stay and self._placed(state.spec, parts))
        elif state.spec.keys:
            self._rewrite_buckets(state, parts, cond, op, change, keys_stay)
        else:
            self._rewrite_files(state, parts, cond, op, change)

    def _rewrite_buckets(
        self, state: State, parts: Sequence[Partition], cond: Column, op: str, change, keys_stay: bool
    ) -> None:
        """Only buckets with matching rows are read again and replaced; their numbers are all the driver sees."""
        spec = state.spec
        bucket = bucket_id(spec.bucket_cols, spec.buckets)
        merged = self._merged(spec, parts, {}, [c for c in [cond] if self._over_keys(spec, c)])
        desc = partition_desc(spec.range_cols)
        found = merged.filter(cond).select(desc.alias("partition"), bucket.alias("bucket")).groupBy("partition").agg(
            F.collect_set("bucket").alias("buckets")
        )
        touched = {r["partition"]: sorted(r["buckets"]) for r in found.collect()}
        if not touched:
            return
        by_desc = {p.desc: p for p in parts}
        if set(touched) - set(by_desc):  # a value that a folder name spells in another way
            touched = {p.desc: list(range(spec.buckets)) for p in parts}
        chosen = [by_desc[d] for d in touched]
        inside = self._in_touched(spec, touched)
        rows = self._merged(spec, chosen, {}, [inside]).filter(inside)
        self._write(state, [change(rows)], op, clean=keys_stay, replaced=chosen, buckets=touched,
                    placed=keys_stay and self._placed(spec, chosen))

    def _in_touched(self, spec: TableSpec, touched: Mapping[str, Sequence[int]]) -> Column:
        """Whether a row lies in one of the buckets; partitions with the same buckets share a test."""
        bucket, same = bucket_id(spec.bucket_cols, spec.buckets), {}
        for desc, buckets in touched.items():
            same.setdefault(tuple(buckets), []).append(desc)
        cond = F.lit(False)
        for buckets, descs in same.items():
            inside = F.lit(True) if len(buckets) == spec.buckets else bucket.isin(list(buckets))
            cond = cond | (inside & partition_desc(spec.range_cols).isin(descs) if spec.range_cols else inside)
        return cond

    def _rewrite_files(self, state: State, parts: Sequence[Partition], cond: Column, op: str, change) -> None:
        """Files with matching rows are replaced; their paths pass from the scan to the log inside Spark."""
        spec = state.spec
        target = scratch_dir(self.spark, "touched-files")
        self._touched(state, parts, cond).write.parquet(target)
        touched = self.spark.read.parquet(target).select("path")
        gone = self.live_files().join(touched, "path", "left_semi")
        hit = {(r["partition"], r["commit_id"]) for r in gone.select("partition", "commit_id").distinct().collect()}
        if not hit:
            return
        holding = [(p, [c for c in p.commits if (p.desc, c.id) in hit]) for p in parts]
        rows = self._scan(spec, holding, paths=True).rows.join(touched.toDF("__file"), "__file", "left_semi")
        one, spec = self._prepared(spec, change(self._complete(rows, spec)), False, False)
        stored, values = self._store(state, spec, [one], False, gone)
        new: dict[str, tuple[Commit, ...]] = {}
        for p, commits in holding:
            if commits:
                new[p.desc] = tuple(replace(c, holes=(*c.holes, state.attempt)) if c in commits else c for c in p.commits)
        for desc, c in stored[0].items():
            old = state.partitions.get(desc)
            new[desc] = (*new.get(desc, old.commits if old else ()), c)
        self._publish(state, spec, op, new, values)

    def _touched(self, state: State, parts: Sequence[Partition], cond: Column) -> DataFrame:
        found = self._scan(state.spec, [(p, p.commits) for p in parts], paths=True)
        rows = found.rows.select(F.col("__file").alias("__file"), *self._complete_columns(found.rows, state.spec))
        return rows.filter(cond).groupBy(F.col("__file").alias("path")).agg(F.count(F.lit(1)).alias("matches"))

    def touched_files(self, where: Where) -> DataFrame:
        """Files that hold rows matching a condition, before any merge (U16)."""
        state = self.state()
        self._refuse_odd(state, where)
        parts, chosen, rest = self._prune(state, where)
        if not parts:
            return L.local_rows(self.spark, [], "path string, matches bigint")
        return self._touched(state, parts, all_of([*chosen, *rest]))

    # -- partitions and versions --------------------------------------------------

    def drop_partition(self, where: Where) -> None:
        """Drop exactly one partition by a tombstone version."""
        state = self.state()
        if not state.spec.range_cols:
            raise TableError("the table has no range partitions")
        part = self._one_partition(state, where, "drop partition")
        self._log_files(state, None, self._files_of([part]))
        self._publish(state, state.spec, L.DROP, {part.desc: ()}, {})

    def rollback(self, partition: str, version: int) -> None:
        """Publish an old version of a partition as its newest (V4)."""
        state = self.state()
        row = L.as_of(self.versions(), partition, version).select("values", "commits").first()
        if row is None:
            raise TableError(f"partition {partition} has no version {version}")
        commits = _commits(row["commits"])
        current = state.partitions[partition]
        old = Partition(partition, current.values, version, L.ROLLBACK, commits)
        back = None
        if commits:
            pairs = L.local_rows(self.spark, [{"commit_id": c.id} for c in commits], "commit_id string")
            dead = [{"commit_id": c.id, "bucket": b} for c in commits for b in c.dead]
            holes = [{"partition": partition, "commit_id": c.id, "attempt": a} for c in commits for a in c.holes]
            back = (
                L.read_files(self.spark, self.root)
                .filter((F.col("partition") == old.desc) & (F.col("file_op") == "add"))
                .join(pairs, "commit_id", "left_semi")
                .dropDuplicates(["path"])
                .withColumn("pos", F.lit(1))
            )
            if dead:
                back = back.join(L.local_rows(self.spark, dead, "commit_id string, bucket int"), ["commit_id", "bucket"], "left_anti")
            if holes:
                back = back.join(L.replaced_files(self.spark, self.root, holes), "path", "left_anti")
        self._log_files(state, back, self._files_of([current]))
        self._publish(state, state.spec, L.ROLLBACK, {partition: commits}, {partition: current.values})

    # -- compaction ---------------------------------------------------------------

    def compact(
        self, where: Where = None, ops: Ops = None, force: bool = True, min_deltas: int = MIN_DELTAS
    ) -> list[str]:
        """Merge partitions into one clean commit each and replace them.

        With ``where`` exactly one partition must match. Without ``force`` only
        partitions with more than ``min_deltas`` deltas are touched. Returns the
        compacted partitions.
        """
        state = self.state()
        parts = [self._one_partition(state, where, "compaction")] if _as_list(where) else state.live()
        found = resolve_ops(ops, state.spec.schema, state.spec.primary_key)
        self._refuse_running(found)
        fold_always = any(not op.single_is_identity for op in found.values())
        todo = [
            p for p in parts
            if len(p.commits) > 1 or fold_always or not (p.commits[0].clean or not state.spec.keys)
        ]
        if not force:
            todo = [p for p in todo if len(p.commits) - 1 > min_deltas]
        if todo:
            merged = self._merged(state.spec, todo, found)
            self._write(state, [merged], L.COMPACTION, clean=bool(state.spec.keys), replaced=todo,
                        placed=self._placed(state.spec, todo, found))
        return sorted(p.desc for p in todo)

    def compact_oldest(self, k: int, where: Where = None, ops: Ops = None) -> list[str]:
        """Fold only the k oldest commits of each partition (C4).

        Nothing older exists below them, so a column that none of them carries
        for a key is NULL either way. Needs operators that may be applied twice.
        """
        if k < 2:
            raise TableError("folding needs at least two commits")
        state = self.state()
        self._require_keys(state)
        self._refuse_odd(state, where)
        parts, _, rest = self._prune(state, where)
        if rest:
            raise TableError("a compaction may be limited by range columns only")
        found = resolve_ops(ops, state.spec.schema, state.spec.primary_key)
        self._refuse_running(found)
        if any(isinstance(op, Custom) for op in found.values()):
            raise TableError("a user's own operator may not fold only a part of the commits")
        todo = [p for p in parts if len(p.commits) > 1]
        if not todo:
            return []
        heads = [replace(p, commits=p.commits[:k]) for p in todo]
        newest = max(storage.commit_order(p.commits[-1].id) for p in heads)
        tails = {p.desc: p.commits[k:] for p in todo}
        order = newest
        if any(storage.commit_order(c.id) <= order for t in tails.values() for c in t):
            return [d for p in todo for d in self._fold_one(state, p.desc, k, found)]
        merged = self._merged(state.spec, heads, found)
        self._write(state, [merged], L.COMPACTION, clean=True, replaced=todo, order=order, kept_tail=tails)
        return sorted(p.desc for p in todo)

    @staticmethod
    def _refuse_running(found: Mapping[str, MergeOp]) -> None:
        if any(isinstance(op, Running) for op in found.values()):
            raise TableError("what a running fold gives is no version that a compaction could store")

    def _fold_one(self, state: State, desc: str, k: int, found: dict[str, MergeOp]) -> list[str]:
        """Partitions whose commits interleave in merge order are folded one by one."""
        state = self.state()
        part = state.partitions[desc]
        head = replace(part, commits=part.commits[:k])
        order = storage.commit_order(head.commits[-1].id)
        merged = self._merged(state.spec, [head], found)
        self._write(state, [merged], L.COMPACTION, clean=True, replaced=[part], order=order,
                    kept_tail={desc: part.commits[k:]})
        return [desc]

    def publish_partition(self, where: Where, target: str, ops: Ops = None) -> None:
        """Compact one partition and expose it in an external Parquet table."""
        state = self.state()
        part = self._one_partition(state, where, "publish")
        self.compact(where, ops)
        now = self.state()
        rows = self._merged(now.spec, [now.partitions[part.desc]], {})
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*now.spec.range_cols)
            .parquet(target)
        )

    def find_orphans(self, retention: timedelta = timedelta(days=7)) -> DataFrame:
        """Data files older than the retention that no log entry mentions.

        The retention must exceed the longest write: files of a write that has not
        published yet are orphans too.
        """
        cutoff = datetime.now(UTC) - retention
        base = L.data_path(self.root)
        try:
            listed = (
                self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
                .select("path", "length", "modificationTime")
            )
        except AnalysisException:
            return L.local_rows(self.spark, [], "path string, size bigint, modified timestamp")
        path = F.concat(F.lit(f"{WRITE}="), F.substring_index("path", f"/{WRITE}=", -1))
        known = L.read_files(self.spark, self.root).select("path").distinct()
        return (
            listed.filter(F.col("modificationTime") < F.lit(cutoff))
            .select(path.alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
            .join(known, "path", "left_anti")
        )

    def remove_orphans(self, retention: timedelta = timedelta(days=7), dry_run: bool = True) -> DataFrame:
        """Delete orphans in executor tasks and report them: path, size, removed, problem.

        ``dry_run`` only reports. The report is a written table, so nothing is deleted again
        when it is read. A file that is gone already, as after a lost executor, counts as
        removed; one that cannot be deleted keeps its reason in ``problem``.
        """
        found = self.find_orphans(retention).select("path", "size")
        if dry_run:
            return found.select("*", F.lit(False).alias("removed"), F.lit(None).cast("string").alias("problem"))
        report = found.mapInArrow(storage.remover(L.data_path(self.root)), storage.REMOVED)
        target = scratch_dir(self.spark, "removed")
        report.write.parquet(target)
        return self.spark.read.schema(storage.REMOVED).parquet(target)

    # -- schema -------------------------------------------------------------------

    def alter(self, changes: Sequence[dict]) -> None:
        """Change the schema without touching data; new columns read NULL."""
        state = self.state()
        schema = S.migrated_schema(state.spec.schema, changes)
        self._publish(state, state.spec.with_schema(schema), L.APPEND, {}, {})


def _beside(
    parts: Sequence[Partition], buckets: Mapping[str, Iterable[int]], stored: Mapping[str, Commit], n: int, state: State
) -> dict[str, tuple[Commit, ...]]:
    """Commits of partitions some of whose buckets were written anew."""
    new: dict[str, tuple[Commit, ...]] = {}
    for p in parts:
        gone = set(buckets[p.desc])
        old = [replace(c, dead=tuple(sorted(gone | set(c.dead)))) for c in p.commits]
        new[p.desc] = tuple(c for c in old if len(c.dead) < n)
    for desc, c in stored.items():
        was = new.get(desc)
        if was is None:  # rows that moved to another partition
            was = state.partitions[desc].commits if desc in state.partitions else ()
        first = len(Partition(desc, {}, 0, "", was).base()) if c.clean else len(was)
        new[desc] = (*was[:first], c, *was[first:])
    return new


def _filled(versions: Versions, spec: TableSpec) -> Versions:
    """Add table columns that no scanned commit carries, so that plans can name them."""
    missing = {
        c: F.lit(None).cast(spec.field(c).dataType) for c in spec.columns if c not in versions.rows.columns
    }
    return replace(versions, rows=versions.rows.withColumns(missing)) if missing else versions


def _guarded(write):
    """A constraint that failed inside the job surfaces as a table error."""
    try:
        return write()
    except PySparkException as e:
        if "constraint violated" in str(e):
            message = str(e)[str(e).index("constraint violated"):].splitlines()[0]
            raise TableError(message) from e
        raise


def positional(df: DataFrame, spec: TableSpec, merge_schema: bool) -> DataFrame:
    """Columns renamed by position and cast; extras only with schema merge."""
    names = spec.columns
    if len(df.columns) < len(names):
        raise TableError(f"{len(df.columns)} columns for {len(names)}: {names}")
    if len(df.columns) > len(names) and not merge_schema:
        raise TableError(f"too many columns for {names}: {df.columns[len(names):]}")
    renamed = df.toDF(*names, *df.columns[len(names):])
    out = [
        _positional(F.col(quoted(n)), renamed.schema[n].dataType, spec.field(n).dataType, merge_schema).alias(n)
        for n in names
    ]
    return renamed.select(*out, *[F.col(quoted(c)) for c in df.columns[len(names):]])


def _positional(value: Column, have: T.DataType, want: T.DataType, merge_schema: bool) -> Column:
    """Struct fields go by position too."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        if len(have) < len(want) or (len(have) > len(want) and not merge_schema):
            raise TableError(f"struct of {len(have)} fields for {want.simpleString()}")
        fields = [
            _positional(value.getField(h.name), h.dataType, w.dataType, merge_schema).alias(w.name)
            for h, w in zip(have.fields, want.fields)
        ]
        fields += [value.getField(h.name).alias(h.name) for h in have.fields[len(want):]]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _positional(x, have.elementType, want.elementType, merge_schema))
    return value.cast(want)


__all__ = ["SEQ", "Commit", "KeyedTable", "Partition", "State", "positional"]
