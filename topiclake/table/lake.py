"""Parquet tables with a commits table: appends, upserts, change data, evolution, history.

Layout: ``<path>/data/spec=<s>/commit=<n>/...`` and ``<path>/commits/block=<b>/commit_id=<n>``.
A commit is visible once its row exists in ``commits``; readers take the newest
row and prune ``commit`` directories with it, so half-written data is never
seen and a retried batch overwrites the directory it left behind. A table has
one writer at a time (its ingestion job).

Keyed tables store change rows with ``_op`` and ``_ord`` and are merged on
read. Fresh changes lie together under ``kb=-1``. ``compact`` folds them into
hash buckets of the key (``kb=0`` and up), rewriting only buckets that received
changes, and a read leaves folded rows unshuffled while the changed keys are few.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclake.functions.scalars import PartitionField, epoch_us, parse_partition_by
from topiclake.operators.keyed import latest_by_key
from topiclake.session import child_names, path_exists, use_utc

COMMIT_SCHEMA = (
    "parent_id bigint, committed_at timestamp, operation string, topic string, stream_id string, batch_id bigint, "
    "spec_id int, partition_by array<string>, id_columns array<string>, key_buckets int, schema_json string, "
    "record_count bigint, max_message_ts timestamp, options map<string,string>, live_from bigint, "
    "folded_to bigint, base_default bigint, bucket_base map<string,bigint>, compacted array<bigint>, specs map<string,string>, streams map<string,bigint>, "
    "decoded_count bigint, undecoded_count bigint"
)
ORDER_TYPE = "struct<ts:timestamp,partition:int,offset:bigint>"
DEFAULT_KEY_BUCKETS = 64
FRESH = -1  # bucket of changes that are not folded yet
COMMITS_PER_BLOCK = 1000
RESERVED = {"commit", "spec", "kb", "_op", "_ord"}


def _numbers(names: list[str], key: str) -> list[int]:
    """Values of ``key=<n>`` folders, largest first."""
    return sorted((int(n.partition("=")[2]) for n in names if n.startswith(f"{key}=")), reverse=True)


def _ddl(text: str) -> T.DataType:
    return T._parse_datatype_string(text)


def widen(old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds both; ints and floats may widen, nothing may narrow into loss."""
    if old == new:
        return old
    ints = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    floats = [T.FloatType(), T.DoubleType()]
    for ladder in (ints, floats):
        if old in ladder and new in ladder:
            return max(old, new, key=ladder.index)
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge_schema(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widen(old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, widen(old.valueType, new.valueType))
    if isinstance(old, T.NullType):
        return new
    if isinstance(new, T.NullType):
        return old
    raise ValueError(f"cannot change a column from {old.simpleString()} to {new.simpleString()}")


def as_nullable(t: T.DataType) -> T.DataType:
    """The type with every nested field optional."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, as_nullable(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(as_nullable(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(as_nullable(t.keyType), as_nullable(t.valueType))
    return t


def merge_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns stay in place and become optional; new ones are appended."""
    incoming = {f.name: f for f in new.fields}
    fields = [
        T.StructField(f.name, widen(f.dataType, incoming[f.name].dataType) if f.name in incoming else f.dataType, True)
        for f in old.fields
    ]
    have = set(old.names)
    fields += [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in have]
    return T.StructType(fields)


class LakeTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = use_utc(spark)
        self.path = path.rstrip("/")
        self._head: Row | None = None

    # ---- commits

    def commits(self) -> DataFrame:
        schema = T.StructType([*_ddl(COMMIT_SCHEMA).fields, T.StructField("commit_id", T.LongType())])
        root = f"{self.path}/commits"
        if path_exists(self.spark, root):
            df = self.spark.read.schema(schema).parquet(root)
        else:
            df = self.spark.createDataFrame([], schema)
        return df.select("commit_id", *[c for c in schema.names if c != "commit_id"])

    def refresh(self) -> LakeTable:
        """Forget the cached newest commit; a reader sees later commits."""
        self._head = None
        return self

    def head(self) -> Row | None:
        """The newest commit row: it carries the table's whole current state."""
        if self._head is None:
            for commit_id in self._newest_ids():
                row = self.spark.read.schema(COMMIT_SCHEMA).parquet(self._commit_dir(commit_id)).first()
                if row is not None:  # None: the writer stopped before the row was in place
                    self._head = Row(commit_id=commit_id, **row.asDict())
                    break
        return self._head

    def _commit_dir(self, commit_id: int) -> str:
        return f"{self.path}/commits/block={commit_id // COMMITS_PER_BLOCK}/commit_id={commit_id}"

    def _newest_ids(self) -> Iterator[int]:
        """Commit numbers from the newest down; blocks keep each listing short."""
        root = f"{self.path}/commits"
        for block in _numbers(child_names(self.spark, root), "block"):
            yield from _numbers(child_names(self.spark, f"{root}/block={block}"), "commit_id")

    def _state(self) -> dict:
        head = self.head()
        if head is None:
            return {
                "commit_id": -1, "spec_id": 0, "partition_by": [], "id_columns": [], "schema_json": None,
                "key_buckets": DEFAULT_KEY_BUCKETS, "options": {}, "live_from": 0, "folded_to": -1, "base_default": -1,
                "bucket_base": {}, "compacted": [], "specs": {}, "streams": {},
            }
        return head.asDict()

    def _commit(self, state: dict, operation: str, rows: int = 0, **extra) -> int:
        commit_id = state["commit_id"] + 1
        record = {
            **{k: v for k, v in state.items() if k != "commit_id"},
            "topic": None, "stream_id": None, "batch_id": None, "max_message_ts": None, "decoded_count": None, "undecoded_count": None,
            "parent_id": state["commit_id"] if state["commit_id"] >= 0 else None,
            "committed_at": datetime.now(timezone.utc).isoformat(timespec="milliseconds"),
            "operation": operation, "record_count": rows, **extra,
        }
        text = json.dumps(record, default=str)
        (
            self.spark.range(1, numPartitions=1)
            .select(F.from_json(F.lit(text), COMMIT_SCHEMA).alias("c"))
            .select("c.*")
            .write.mode("overwrite")
            .parquet(self._commit_dir(commit_id))
        )
        self._head = None
        return commit_id

    # ---- schema and options

    @property
    def exists(self) -> bool:
        return self.head() is not None

    @property
    def schema(self) -> T.StructType:
        text = self._state()["schema_json"]
        return T.StructType.fromJson(json.loads(text)) if text else T.StructType([])

    @property
    def id_columns(self) -> list[str]:
        return list(self._state()["id_columns"])

    @property
    def partition_by(self) -> list[str]:
        return list(self._state()["partition_by"])

    def create(
        self,
        schema: T.StructType | str | None = None,
        partition_by: str | list[str] | None = None,
        id_columns: list[str] | None = None,
        key_buckets: int = DEFAULT_KEY_BUCKETS,
        options: dict[str, str] | None = None,
    ) -> LakeTable:
        """Declare the table if it is missing; without a schema the first batch sets it."""
        if self.exists:
            return self
        schema = _ddl(schema) if isinstance(schema, str) else schema
        state = self._state()
        state.update(
            partition_by=[p.text for p in parse_partition_by(partition_by)],
            id_columns=list(id_columns or []),
            key_buckets=key_buckets,
            options=dict(options or {}),
            schema_json=schema.json() if schema else None,
        )
        self._commit(state, "create")
        return self

    def evolve(self, schema: T.StructType) -> LakeTable:
        """Add columns and widen types; dropped columns stay and read null for new rows."""
        state = self._state()
        merged = merge_schema(self.schema, schema)
        if merged != self.schema:
            state["schema_json"] = merged.json()
            self._commit(state, "evolve")
        return self

    def set_partition_by(self, spec: str | list[str] | None) -> LakeTable:
        """New data uses the new spec; files under older specs stay where they are."""
        state = self._state()
        fields = [p.text for p in parse_partition_by(spec)]
        if fields != list(state["partition_by"]):
            used = [int(k) for k in state["specs"]]
            state.update(partition_by=fields, spec_id=max([state["spec_id"], *used]) + 1)
            self._commit(state, "set partition.by")
        return self

    def set_id_columns(self, columns: list[str]) -> LakeTable:
        """Change the key of a live table.

        Rows that the old key already replaced must not come back, so they are
        folded away first; this rewrites the table once.
        """
        state = self._state()
        if list(columns) == list(state["id_columns"]):
            return self
        if state["specs"]:
            self._rewrite(list(columns))
            return self
        state["id_columns"] = list(columns)
        self._commit(state, "set id.columns")
        return self

    # ---- writing

    def _data_dir(self, spec_id: int, commit_id: int) -> str:
        return f"{self.path}/data/spec={spec_id}/commit={commit_id}"

    def _write_files(self, df: DataFrame, state: dict, observe: list[Column], bucket: Column | None = None) -> dict:
        """Write one commit directory; returns the observed metrics."""
        fields = parse_partition_by(list(state["partition_by"]))
        parts = [p.name for p in fields]
        df = df.withColumns({p.name: p.value() for p in fields}) if fields else df
        spread = ["kb", *parts] if bucket is not None else parts
        if "_op" in df.columns:
            df, parts = df.withColumn("kb", F.lit(FRESH) if bucket is None else bucket), ["kb", *parts]
        if spread:
            # few files per partition; adaptive execution splits a partition that dominates
            df = df.hint("rebalance", *spread)
        # observed in the writing stage, so that recomputed shuffle tasks do not count twice
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *observe)
        writer = df.drop("_message_ts").write.mode("overwrite")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(self._data_dir(state["spec_id"], state["commit_id"] + 1))
        return seen.get

    def _write(self, df: DataFrame, operation: str, stream: tuple[str, int] | None, topic: str | None, message_ts: str | None, counts: dict | None = None) -> int:
        state = self._state()
        if stream is not None and stream[1] <= state["streams"].get(stream[0], -1):
            return state["commit_id"]  # this micro-batch was committed before a restart
        data = T.StructType([f for f in df.schema.fields if f.name not in (*RESERVED, "_message_ts")])
        merged = merge_schema(self.schema, data)
        state["schema_json"] = merged.json()
        have = set(df.columns)
        df = df.select(
            *[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in merged.fields],
            *[c for c in ("_op", "_ord", "_message_ts") if c in have],
        )
        observe = []
        if message_ts:
            observe = [F.max(F.unix_millis(F.col(message_ts).cast("timestamp"))).alias("max_ms")]
        seen = self._write_files(df, state, observe)
        rows = seen.get("rows") or 0
        extra = {"topic": topic, **(counts or {})}
        if seen.get("max_ms") is not None:
            extra["max_message_ts"] = datetime.fromtimestamp(seen["max_ms"] / 1000, timezone.utc).isoformat(timespec="milliseconds")
        if stream is not None:
            extra.update(stream_id=stream[0], batch_id=stream[1])
            state["streams"] = {**state["streams"], stream[0]: stream[1]}
        if rows:
            self._mark_spec(state)
        return self._commit(state, operation, rows, **extra)

    @staticmethod
    def _mark_spec(state: dict) -> None:
        state["specs"] = {**state["specs"], str(state["spec_id"]): "\n".join(state["partition_by"])}

    def append(self, df: DataFrame, stream: tuple[str, int] | None = None, topic: str | None = None, message_ts: str | None = None, counts: dict | None = None) -> int:
        """Add rows. ``stream`` is ``(stream id, batch id)``: a batch commits only once."""
        if RESERVED & set(df.columns):
            raise ValueError(f"reserved column names: {sorted(RESERVED & set(df.columns))}")
        if self._state()["id_columns"]:
            return self.upsert(df, stream=stream, topic=topic, message_ts=message_ts, counts=counts)
        return self._write(df, "append", stream, topic, message_ts, counts)

    def upsert(
        self,
        df: DataFrame,
        id_columns: list[str] | None = None,
        order: list[str | Column] | None = None,
        op: str | Column | None = None,
        stream: tuple[str, int] | None = None,
        topic: str | None = None,
        message_ts: str | None = None,
        operation: str = "upsert",
        counts: dict | None = None,
    ) -> int:
        """Write change rows; ``order`` is up to (timestamp, partition, offset) columns.

        Rows of one batch are reduced to the newest per key before they are
        written. Without an order, later commits win.
        """
        if id_columns:
            self.create(id_columns=id_columns)
            if self.id_columns != list(id_columns):
                self.set_id_columns(id_columns)
        keys = self.id_columns
        if not keys:
            raise ValueError("an upsert needs id columns")
        order = list(order or [])
        cols = [F.col(o) if isinstance(o, str) else o for o in order] + [F.lit(None)] * (3 - len(order))
        ordering = F.struct(
            cols[0].cast("timestamp").alias("ts"), cols[1].cast("int").alias("partition"), cols[2].cast("bigint").alias("offset")
        )
        operation_col = F.lit("u") if op is None else F.col(op) if isinstance(op, str) else op
        hidden = {c for c in order if isinstance(c, str) and c.startswith("_")}
        changes = df.withColumns({"_op": operation_col, "_ord": ordering})
        changes = changes.drop(*(hidden - {"_op", "_ord", "_message_ts"}))
        changes = latest_by_key(changes, keys, ["_ord"])
        return self._write(changes, operation, stream, topic, message_ts, counts)

    def apply_changes(self, df: DataFrame, id_columns: list[str] | None = None, order: list[str | Column] | None = None, op_col: str = "_cdc.op", **kw) -> int:
        """Apply a change feed: ``c``, ``r`` and ``u`` set the row, ``d`` removes it."""
        return self.upsert(df, id_columns, order, op=op_col, operation="cdc", **kw)

    def undecoded(self) -> LakeTable:
        """The side table of messages whose value could not be decoded: key, value, timestamp, partition, offset."""
        return LakeTable(self.spark, f"{self.path}/undecoded")

    def _bucket(self, keys: list[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self._state()["key_buckets"])).cast("int")

    def truncate(self) -> int:
        """Empty the table; its schema, options and history stay."""
        state = self._state()
        new = state["commit_id"] + 1
        state.update(live_from=new, folded_to=new, base_default=-1, bucket_base={}, compacted=[], specs={}, spec_id=state["spec_id"] + 1)
        return self._commit(state, "truncate")

    # ---- reading

    def _raw(self, file_info: bool = False, commits: list[int] | None = None) -> DataFrame | None:
        """Stored rows of live commits, with ``commit`` and, for keyed tables, ``_op``, ``_ord``, ``kb``."""
        state = self._state()
        keyed = bool(state["id_columns"])
        fields = list(self.schema.fields)
        hidden = []
        if keyed:
            hidden = [T.StructField("_op", T.StringType()), T.StructField("_ord", _ddl(ORDER_TYPE))]
        out = None
        for spec_id, text in sorted((int(k), v) for k, v in state["specs"].items()):
            parts = [PartitionField(p) for p in text.split("\n") if p]
            part_fields = [T.StructField("commit", T.LongType())]
            part_fields += [T.StructField("kb", T.IntegerType())] if keyed else []
            part_fields += [T.StructField(p.name, _ddl(p.sql_type)) for p in parts]
            root = f"{self.path}/data/spec={spec_id}"
            df = self.spark.read.schema(T.StructType(fields + hidden + part_fields)).option("basePath", root).parquet(root)
            df = df.where(F.col("commit").between(state["live_from"], state["commit_id"]))
            if commits is not None:
                df = df.where(F.col("commit").isin(commits))
            elif not keyed and state["compacted"]:
                df = df.where((F.col("commit") > state["folded_to"]) | F.col("commit").isin(list(state["compacted"])))
            partition = F.struct(*[F.col(p.name).cast("string").alias(p.name) for p in parts]) if parts else F.struct()
            if file_info:
                if keyed:
                    # of each bucket what its last fold wrote, and changes not folded yet; markers of deleted keys are no rows
                    folded = (F.col("kb") >= 0) & (F.col("commit") == self._base_commit())
                    fresh = (F.col("kb") == FRESH) & (F.col("commit") > state["folded_to"])
                    df = df.where((folded | fresh) & ~F.col("_op").eqNullSafe("d"))
                df = df.select(
                    F.col("commit"),
                    F.lit(spec_id).alias("spec_id"),
                    F.to_json(partition).alias("partition") if parts else F.lit("{}").alias("partition"),
                    F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_size").alias("file_size_in_bytes"),
                )
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out

    def _folded(self, raw: DataFrame) -> DataFrame:
        """Folded rows: of each key bucket those of the commit that folded it last."""
        return raw.where((F.col("kb") >= 0) & (F.col("commit") == self._base_commit()))

    def _fresh(self, raw: DataFrame) -> DataFrame:
        """Changes since the last fold."""
        return raw.where((F.col("kb") == FRESH) & (F.col("commit") > self._state()["folded_to"]))

    def _base_commit(self) -> Column:
        state = self._state()
        default = F.lit(state["base_default"]).cast("bigint")
        if not state["bucket_base"]:
            return default
        pairs = [F.lit(int(x)) for kv in sorted(state["bucket_base"].items()) for x in kv]
        return F.coalesce(F.try_element_at(F.create_map(*pairs).cast("map<int,bigint>"), F.col("kb")), default)

    def _merged(self, raw: DataFrame, buckets: list[int] | None = None) -> DataFrame:
        """Newest row per key (with ``_op``, ``_ord``), deleted keys included: folded rows plus newer changes."""
        keys = self.id_columns
        rank = F.struct("_ord.ts", "_ord.partition", "_ord.offset", "commit")
        changes = self._fresh(raw).withColumn("_rank", rank)
        delta = latest_by_key(changes, keys, ["_rank"])
        if self._state()["base_default"] < 0 and not self._state()["bucket_base"]:
            return delta.drop("_rank")
        base = self._folded(raw)
        if buckets is not None:
            base = base.where(F.col("kb").isin(buckets))
        base = base.withColumn("_rank", rank)
        b = base.alias("b")

        def on(left: str, right: str) -> Column:
            cond = F.lit(True)
            for k in keys:
                cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
            return cond

        # key columns only; small change sets are broadcast by their measured size
        d = changes.groupBy(*keys).agg(F.max("_rank").alias("_rank")).alias("d")
        kept_base = b.join(d, on("b", "d") & (F.col("d._rank") >= F.col("b._rank")), "left_anti")
        # late changes lose against folded rows: only keys that changed are looked up
        touched = base.select(*keys, "_rank").alias("t").join(d, on("t", "d"), "left_semi").alias("t")
        kept_delta = delta.alias("x").join(touched, on("x", "t") & (F.col("t._rank") > F.col("x._rank")), "left_anti")
        return kept_base.unionByName(kept_delta).drop("_rank")

    def read(self, columns: list[str] | None = None, time_range: tuple | None = None) -> DataFrame:
        """Current rows. ``time_range`` is ``(column, from, to)``, half open.

        A range on a column that a spec partitions by month or hour also becomes
        a predicate on the partition value, which prunes directories.
        """
        raw = self._raw()
        names = self.schema.names
        if raw is None:
            out = self.spark.createDataFrame([], self.schema)
        elif self.id_columns:
            # a range must not hide the newest version of a key, so it applies after the merge
            out = self._merged(raw).where(F.col("_op") != "d")
        else:
            out = self._prune(raw, time_range)
        if time_range is not None:
            col, lo, hi = time_range
            dtype = self.schema[col].dataType
            out = out.where(F.col(col) >= F.lit(lo).cast(dtype)) if lo is not None else out
            out = out.where(F.col(col) < F.lit(hi).cast(dtype)) if hi is not None else out
        return out.select(*[f"`{c}`" for c in (columns or names)])

    def _prune(self, raw: DataFrame, time_range: tuple | None) -> DataFrame:
        if time_range is None:
            return raw
        col, lo, hi = time_range
        dtype = self.schema[col].dataType
        for text in {p for spec in self._state()["specs"].values() for p in spec.split("\n") if p}:
            field = PartitionField(text)
            if field.column != col or field.kind not in ("month", "hour"):
                continue
            part = F.col(field.name)
            # rows under a spec without this field have no value here and stay
            if lo is not None:
                raw = raw.where(part.isNull() | (part >= field.value(F.lit(lo).cast(dtype))))
            if hi is not None:
                raw = raw.where(part.isNull() | (part <= field.value(F.lit(hi).cast(dtype))))
        return raw

    def read_commits(self, commit_ids: list[int]) -> DataFrame:
        """Rows added by the given commits, as stored; of a keyed table its changes, with ``_op`` (``d`` for a removed key)."""
        raw = self._raw(commits=commit_ids)
        if raw is None:
            return self.spark.createDataFrame([], self.schema)
        if self.id_columns:
            return raw.where(F.col("kb") == FRESH).select(*self.schema.names, "_op")
        return raw.select(*self.schema.names)

    # ---- maintenance

    def compact(self) -> int:
        """Fold changes into one row per key, only in key buckets that have changes.

        A table without a key has its small files merged instead. Deleted keys stay as markers, so an older change that arrives late does not
        bring a row back.
        """
        state = self._state()
        if not state["specs"]:
            return state["commit_id"]
        if not state["id_columns"]:
            return self._merge_small()
        raw, bucket = self._raw(), self._bucket(state["id_columns"])
        changed = self._fresh(raw).select(bucket.alias("kb")).distinct()
        buckets = sorted(r.kb for r in changed.collect())  # at most key_buckets numbers
        if not buckets:
            return state["commit_id"]
        rows = self._merged(raw, buckets)
        new = state["commit_id"] + 1
        seen = self._write_files(self._stored(rows), state, [], bucket)
        state["bucket_base"] = {**state["bucket_base"], **{str(b): new for b in buckets}}
        state["folded_to"] = new
        self._mark_spec(state)
        return self._commit(state, "compact", seen.get("rows") or 0)

    def _merge_small(self) -> int:
        """Rewrite the rows appended since the last compaction as one commit."""
        state = self._state()
        raw, new = self._raw(), state["commit_id"] + 1
        fresh = raw.where((F.col("commit") > state["folded_to"]) & ~F.col("commit").isin(list(state["compacted"])))
        rows = fresh.select(*[f"`{c}`" for c in self.schema.names])
        if not parse_partition_by(list(state["partition_by"])):
            rows = rows.hint("rebalance")
        seen = self._write_files(rows, state, [])
        state.update(folded_to=new, compacted=[*state["compacted"], new])
        self._mark_spec(state)
        return self._commit(state, "compact", seen.get("rows") or 0)

    def _stored(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[f"`{c}`" for c in self.schema.names], "_op", "_ord")

    def _rewrite(self, keys: list[str]) -> int:
        state = self._state()
        raw = self._raw()
        if state["id_columns"]:
            rows = self._merged(raw).where(F.col("_op") != "d")
        else:
            rows = raw.withColumns({"_op": F.lit("u"), "_ord": F.lit(None).cast(ORDER_TYPE)})
        new = state["commit_id"] + 1
        state.update(id_columns=keys, spec_id=state["spec_id"] + 1)
        seen = self._write_files(self._stored(rows), state, [], self._bucket(keys))
        state.update(live_from=new, folded_to=new, compacted=[], base_default=new, bucket_base={}, specs={})
        self._mark_spec(state)
        return self._commit(state, "set id.columns", seen.get("rows") or 0)

    # ---- metadata

    def snapshots(self, n: int | None = 20) -> DataFrame:
        out = self.commits().select("commit_id", "parent_id", "committed_at", "operation", "topic", "record_count")
        out = out.orderBy(F.desc("commit_id"))
        return out if n is None else out.limit(n)

    def history(self) -> DataFrame:
        """When each commit became current, and whether its data is still live."""
        live = self._state()["live_from"]
        return self.commits().select(
            F.col("committed_at").alias("made_current_at"),
            F.col("commit_id").alias("snapshot_id"),
            "parent_id",
            (F.col("commit_id") >= live).alias("is_current_ancestor"),
        )

    def _files(self) -> DataFrame:
        raw = self._raw(file_info=True)
        if raw is None:
            schema = "commit bigint, spec_id int, partition string, file_path string, file_size_in_bytes bigint, record_count bigint"
            return self.spark.createDataFrame([], schema)
        return raw.groupBy("commit", "spec_id", "partition", "file_path", "file_size_in_bytes").agg(
            F.count(F.lit(1)).alias("record_count")
        )

    def files(self) -> DataFrame:
        return self._files().select(
            F.lit("DATA").alias("content"), F.lit("PARQUET").alias("file_format"), "spec_id", "partition",
            "record_count", "file_size_in_bytes", "file_path",
        )

    def manifests(self) -> DataFrame:
        """Files and rows that each live commit added."""
        added = self._files().groupBy("commit", "spec_id").agg(
            F.count(F.lit(1)).alias("added_files"),
            F.sum("record_count").alias("added_rows"),
            F.sum("file_size_in_bytes").alias("added_bytes"),
        )
        log = self.commits().select(F.col("commit_id").alias("commit"), "committed_at", "operation")
        return log.join(added, "commit")

    def partitions(self) -> DataFrame:
        """Rows, files and bytes per spec and partition value.

        Of a keyed table, rows of folded buckets and changes not folded yet: after ``compact`` exactly the live rows.
        """
        return self._files().groupBy("spec_id", "partition").agg(
            F.sum("record_count").alias("record_count"),
            F.count(F.lit(1)).alias("file_count"),
            F.sum("file_size_in_bytes").alias("total_size"),
        )

    def describe(self) -> DataFrame:
        """Column rows followed by table properties."""
        state = self._state()
        rows = [(f.name, f.dataType.simpleString(), "column") for f in self.schema.fields]
        rows += [
            ("location", self.path, "property"),
            ("partition.by", ", ".join(state["partition_by"]), "property"),
            ("id.columns", ", ".join(state["id_columns"]), "property"),
            ("current snapshot", str(state["commit_id"]), "property"),
        ]
        return self.spark.createDataFrame(rows, "name string, value string, kind string")

    def show_create(self) -> str:
        cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        return f"CREATE TABLE `{self.path.rsplit('/', 1)[-1]}` (\n  {cols})\nUSING parquet\nLOCATION '{self.path}'"

    def table_options(self) -> DataFrame:
        """Topic options over time, one row per commit that changed them."""
        return (
            self.commits()
            .where(F.col("operation").isin("create", "set partition.by", "set id.columns") | F.col("parent_id").isNull())
            .select(
                "commit_id",
                "committed_at",
                F.concat_ws(", ", "partition_by").alias("partition_by"),
                F.concat_ws(", ", "id_columns").alias("id_columns"),
                "options",
            )
        )

    # ---- ingestion metrics

    def ingest_delay(self) -> DataFrame:
        """Time from the newest message of a commit to the commit, per topic."""
        return self.commits().where(F.col("max_message_ts").isNotNull()).select(
            "commit_id",
            "topic",
            "committed_at",
            (F.unix_millis("committed_at") - F.unix_millis("max_message_ts")).alias("delay_ms"),
        )

    def fields_per_second(self, interval_ms: int) -> DataFrame:
        """Written fields (rows x columns) per second of the commit interval, per topic."""
        width = F.size(F.from_json("schema_json", "fields array<struct<name string>>").getField("fields"))
        return self.commits().where(F.col("batch_id").isNotNull()).select(
            "commit_id",
            "topic",
            "committed_at",
            (F.col("record_count") * width * F.lit(1000.0) / F.lit(float(interval_ms))).alias("fields_per_second"),
        )


def ensure_table(spark: SparkSession, table: str, schema: T.StructType | str, partition_by: str | list[str] | None = None) -> LakeTable | None:
    """Create a table if it is missing.

    A path gives a ``LakeTable``; a catalog name runs ``CREATE TABLE IF NOT EXISTS``.
    """
    if "/" in table:
        return LakeTable(spark, table).create(schema, partition_by)
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet")
    return None


def list_tables(spark: SparkSession) -> DataFrame:
    """Every table of every schema of the current catalog."""
    rows = [
        (db.catalog, db.name, t.name, t.tableType)
        for db in spark.catalog.listDatabases()
        for t in spark.catalog.listTables(db.name)
    ]
    return spark.createDataFrame(rows, "catalog string, namespace string, name string, table_type string")
