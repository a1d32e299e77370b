"""Avro payloads as Arrow-batch jobs.

A schema becomes a chain of functions once per task, and each function reads or
writes one field of all rows of an Arrow batch at a time with numpy. Spark
partitions the work; everything before and after is built-in expressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from topiclake.formats.registry import registry_rows
from topiclake.formats.wire import join_wire_format, split_wire_format
from topiclake.table.lake import as_nullable, merge_schema

_PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
_LOGICAL = {
    "uuid": T.StringType(),
    "date": T.DateType(),
    "time-millis": T.TimeType(6),
    "time-micros": T.TimeType(6),
    "timestamp-millis": T.TimestampType(),
    "timestamp-micros": T.TimestampType(),
}
# stored unit to the unit of the Arrow column: microseconds, for times of day nanoseconds
_TO_ARROW = {"timestamp-millis": 1000, "time-millis": 1_000_000, "time-micros": 1000}
_ARROW_TIMES = {
    "date": pa.date32(),
    "time-millis": pa.time64("ns"),
    "time-micros": pa.time64("ns"),
    "timestamp-millis": pa.timestamp("us", tz="UTC"),
    "timestamp-micros": pa.timestamp("us", tz="UTC"),
}


class _Names:
    """Named types of one schema, by full name."""

    def __init__(self):
        self.types: dict[str, dict] = {}

    def resolve(self, schema, namespace: str = ""):
        """``(definition, namespace)`` of a schema node; names become their definitions."""
        if isinstance(schema, str) and schema not in _PRIMITIVES and schema != "null":
            full = schema if "." in schema else f"{namespace}.{schema}" if namespace else schema
            if full not in self.types:
                full = schema
            if full not in self.types:
                raise ValueError(f"unknown Avro type {schema}")
            return self.types[full]
        if isinstance(schema, dict) and schema["type"] in ("record", "enum", "fixed"):
            name = schema["name"]
            space = schema.get("namespace", namespace)
            full = name if "." in name else f"{space}.{name}" if space else name
            self.types[full] = (schema, full.rpartition(".")[0])
            return self.types[full]
        return schema, namespace


def _node(schema) -> tuple[str, dict]:
    """Type name and attributes of a node (``{"type": {"type": ...}}`` is unwrapped)."""
    if isinstance(schema, list):
        return "union", {}
    if isinstance(schema, str):
        return schema, {}
    if isinstance(schema["type"], (dict, list)):
        return _node(schema["type"])
    return schema["type"], schema


def _load(schema) -> dict:
    return json.loads(schema) if isinstance(schema, str) and schema.lstrip()[:1] in "{[\"" else schema


def _optional(schema: list):
    """The value type of ``[null, T]``; any other union is refused."""
    rest = [s for s in schema if s != "null"]
    if len(rest) != 1:
        raise ValueError("a union of several types has no column type")
    return rest[0], len(rest) < len(schema)


def _is_map_array(items, names: _Names, ns: str) -> bool:
    """An array of key/value records marked as a map, which allows keys that are not text."""
    schema, _ = names.resolve(items, ns)
    return isinstance(schema, dict) and [f["name"] for f in schema.get("fields", [])] == ["key", "value"]


# ---- schema -> column types


def avro_to_struct(schema) -> T.StructType:
    """Table schema of an Avro record schema."""
    out = _spark_type(_load(schema), _Names(), "", ())
    if not isinstance(out, T.StructType):
        raise ValueError("the top level has to be a record")
    return out


def _spark_type(schema, names: _Names, ns: str, path: tuple) -> T.DataType:
    if isinstance(schema, list):
        return _spark_type(_optional(schema)[0], names, ns, path)
    schema, ns = names.resolve(schema, ns)
    kind, attrs = _node(schema)
    logical = attrs.get("logicalType")
    if kind == "union":
        return _spark_type(_optional(schema["type"])[0], names, ns, path)
    if logical == "decimal":
        return T.DecimalType(attrs["precision"], attrs.get("scale", 0))
    if logical in _LOGICAL:
        return _LOGICAL[logical]
    if kind in _PRIMITIVES:
        return _PRIMITIVES[kind]
    if kind == "enum":
        return T.StringType()
    if kind == "fixed":
        return T.BinaryType()
    if kind == "array":
        if logical == "map" and _is_map_array(attrs["items"], names, ns):
            item = _spark_type(attrs["items"], names, ns, path)
            return T.MapType(item["key"].dataType, item["value"].dataType)
        return T.ArrayType(_spark_type(attrs["items"], names, ns, path))
    if kind == "map":
        return T.MapType(T.StringType(), _spark_type(attrs["values"], names, ns, path))
    if kind == "record":
        name = f"{ns}.{attrs['name']}"
        if name in path:
            raise ValueError(f"recursive record {attrs['name']} has no column type")
        return T.StructType(
            [
                T.StructField(
                    f["name"],
                    _spark_type(f["type"], names, ns, (*path, name)),
                    isinstance(f["type"], list) and "null" in f["type"],
                )
                for f in attrs["fields"]
            ]
        )
    raise ValueError(f"Avro type {kind} has no column type")


# ---- decoding: a reader takes the batch bytes and each row's position and end,
# and gives the values, the new positions and which rows do not fit the schema

Reader = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[pa.Array, np.ndarray, np.ndarray]]


def _at(src: np.ndarray, i: np.ndarray) -> np.ndarray:
    return src[np.minimum(i, len(src) - 1)]


def _read_longs(src: np.ndarray, pos: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zigzag numbers of variable length, one per row."""
    byte = _at(src, pos)
    z = (byte & 0x7F).astype(np.uint64)
    size = np.ones(len(pos), dtype=np.int64)
    more = np.flatnonzero(byte >= 0x80)
    for k in range(1, 10):
        if not len(more):
            break
        byte = _at(src, pos[more] + k)
        z[more] |= (byte & 0x7F).astype(np.uint64) << np.uint64(7 * k)
        size[more] += 1
        more = more[byte >= 0x80]
    bad = pos + size > end
    bad[more] = True
    value = (z >> np.uint64(1)).astype(np.int64) ^ -((z & np.uint64(1)).astype(np.int64))
    return value, np.where(bad, end, pos + size), bad


def _gather(src: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes ``[start, start + size)`` of all rows, back to back."""
    before = np.cumsum(size) - size
    return src[np.arange(size.sum()) + np.repeat(start - before, size)]


def _binary(data: np.ndarray, size: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _text(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Bytes as text; rows that are not UTF-8 are marked."""
    try:
        return values.cast(pa.string()), np.zeros(len(values), dtype=bool)
    except pa.ArrowInvalid:
        decoded = [v.decode("utf-8", "replace") for v in values.to_pylist()]
        bad = [t.encode("utf-8") != v for t, v in zip(decoded, values.to_pylist())]
        return pa.array(decoded, pa.string()), np.array(bad, dtype=bool)


def _fixed_width(src, pos, end, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bad = pos + width > end
    raw = _at(src, pos[:, None] + np.arange(width))
    return np.ascontiguousarray(raw), np.where(bad, end, pos + width), bad


def _bytes_reader(attrs: dict, kind: str) -> Reader:
    def read(src, pos, end):
        if kind == "fixed":
            raw, pos, bad = _fixed_width(src, pos, end, attrs["size"])
            return _binary(raw.reshape(-1), np.full(len(pos), attrs["size"])), pos, bad
        size, pos, bad = _read_longs(src, pos, end)
        bad = bad | (size < 0) | (size > end - pos)
        size = np.where(bad, 0, size)
        return _binary(_gather(src, pos, size), size), np.where(bad, end, pos + size), bad

    return read


def _many_reader(item: Reader, is_map: bool) -> Reader:
    """Blocks of items; in each round one item of every unfinished row is read."""

    def read(src, pos, end):
        n = len(pos)
        pos, bad, counts = pos.copy(), np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
        left, done = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
        chunks, owners = [item(src, pos[:0], end[:0])[0]], [np.zeros(0, dtype=np.int64)]
        while True:
            new_block = np.flatnonzero(~done & (left == 0))
            if len(new_block):
                size, p, wrong = _read_longs(src, pos[new_block], end[new_block])
                sized = np.flatnonzero(size < 0)  # a negative count is followed by the block's length in bytes
                if len(sized):
                    _, p[sized], w = _read_longs(src, p[sized], end[new_block[sized]])
                    wrong[sized] |= w
                # an item takes a byte at least, unless all are null
                size = np.abs(size)
                bad[new_block] |= wrong
                done[new_block] = wrong | (size == 0)
                left[new_block] = np.where(wrong, 0, size)
                pos[new_block] = p
                continue
            active = np.flatnonzero(~done)
            if not len(active):
                break
            values, p, wrong = item(src, pos[active], end[active])
            pos[active], left[active] = p, left[active] - 1
            counts[active] += 1
            chunks.append(values)
            owners.append(active)
            stuck = wrong | ((p >= end[active]) & (left[active] > 0))
            bad[active[stuck]] = True
            done[active[stuck]] = True
        order = np.argsort(np.concatenate(owners), kind="stable")
        values = pa.concat_arrays(chunks).take(pa.array(order))
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        if is_map:
            keys, items = values.flatten()
            return pa.MapArray.from_arrays(offsets, keys, items), np.where(bad, end, pos), bad
        return pa.ListArray.from_arrays(offsets, values), np.where(bad, end, pos), bad

    return read


def _record_reader(fields: list[tuple[str, Reader]]) -> Reader:
    def read(src, pos, end):
        bad = np.zeros(len(pos), dtype=bool)
        columns = []
        for _, field in fields:
            values, pos, wrong = field(src, pos, end)
            bad |= wrong
            columns.append(values)
        if not columns:
            return pa.array([{}] * len(pos), pa.struct([])), pos, bad
        return pa.StructArray.from_arrays(columns, [name for name, _ in fields]), pos, bad

    return read


def _union_reader(branches: list[Reader]) -> Reader:
    """At most one branch has values; rows of other branches are null."""

    def read(src, pos, end):
        branch, pos, bad = _read_longs(src, pos, end)
        bad = bad | (branch < 0) | (branch >= len(branches))
        index, out = np.full(len(pos), -1, dtype=np.int64), None
        for k, reader in enumerate(branches):
            rows = np.flatnonzero((branch == k) & ~bad)
            values, p, wrong = reader(src, pos[rows], end[rows])
            pos[rows], bad[rows] = p, bad[rows] | wrong
            if not pa.types.is_null(values.type):
                out = values
                index[rows] = np.arange(len(rows))
        if out is None:
            return pa.nulls(len(pos)), pos, bad
        return out.take(pa.array(index, mask=index < 0)), pos, bad

    return read


def _reader(schema, names: _Names, ns: str) -> Reader:
    if isinstance(schema, list):
        return _union_reader([_reader(s, names, ns) for s in schema])
    schema, ns = names.resolve(schema, ns)
    kind, attrs = _node(schema)
    logical = attrs.get("logicalType")
    if kind == "union":
        return _reader(schema["type"], names, ns)
    if kind == "null":
        return lambda src, pos, end: (pa.nulls(len(pos)), pos, np.zeros(len(pos), dtype=bool))
    if kind == "boolean":

        def boolean(src, pos, end):
            raw, pos, bad = _fixed_width(src, pos, end, 1)
            return pa.array(raw[:, 0] == 1), pos, bad

        return boolean
    if kind in ("int", "long"):

        def number(src, pos, end):
            v, pos, bad = _read_longs(src, pos, end)
            if logical in _ARROW_TIMES and logical != "date":
                return pa.array(v * _TO_ARROW.get(logical, 1)).cast(_ARROW_TIMES[logical]), pos, bad
            out = pa.array(v.astype(np.int32) if kind == "int" else v)
            return out.cast(_ARROW_TIMES[logical]) if logical == "date" else out, pos, bad

        return number
    if kind in ("float", "double"):
        width = 4 if kind == "float" else 8

        def real(src, pos, end):
            raw, pos, bad = _fixed_width(src, pos, end, width)
            return pa.array(raw.view(f"<f{width}")[:, 0] if len(raw) else np.zeros(0, f"f{width}")), pos, bad

        return real
    if kind in ("string", "bytes", "fixed"):
        raw_reader = _bytes_reader(attrs, kind)
        if kind == "string":

            def text(src, pos, end):
                raw, pos, bad = raw_reader(src, pos, end)
                values, wrong = _text(raw)
                return values, pos, bad | wrong

            return text
        if logical != "decimal":
            return raw_reader
        scale, digits = attrs.get("scale", 0), pa.decimal128(attrs["precision"], attrs.get("scale", 0))

        def decimal(src, pos, end):
            raw, pos, bad = raw_reader(src, pos, end)
            numbers = [Decimal(int.from_bytes(v, "big", signed=True)).scaleb(-scale) for v in raw.to_pylist()]
            return pa.array([None if b else d for d, b in zip(numbers, bad)], digits), pos, bad

        return decimal
    if kind == "enum":
        symbols = pa.array(attrs["symbols"], pa.string())

        def enum(src, pos, end):
            k, pos, bad = _read_longs(src, pos, end)
            bad = bad | (k < 0) | (k >= len(symbols))
            return symbols.take(pa.array(np.where(bad, 0, k))), pos, bad

        return enum
    if kind == "array":
        as_pairs = logical == "map" and _is_map_array(attrs["items"], names, ns)
        return _many_reader(_reader(attrs["items"], names, ns), as_pairs)
    if kind == "map":
        pair = [("key", _reader("string", names, ns)), ("value", _reader(attrs["values"], names, ns))]
        return _many_reader(_record_reader(pair), True)
    if kind == "record":
        return _record_reader([(f["name"], _reader(f["type"], names, ns)) for f in attrs["fields"]])
    raise ValueError(f"cannot read Avro type {kind}")


def _conform(values: pa.Array, t: pa.DataType) -> pa.Array:
    """Values of one schema version in the column type of all versions."""
    if values.type == t:
        return values
    if pa.types.is_struct(t):
        have = dict(zip([f.name for f in values.type], values.flatten()))
        columns = [_conform(have[f.name], f.type) if f.name in have else pa.nulls(len(values), f.type) for f in t]
        return pa.StructArray.from_arrays(columns, fields=list(t), mask=values.is_null())
    if pa.types.is_list(t):
        return pa.ListArray.from_arrays(values.offsets, _conform(values.values, t.value_type), type=t, mask=_no_offset(values))
    if pa.types.is_map(t):
        keys, items = _conform(values.keys, t.key_type), _conform(values.items, t.item_type)
        return pa.MapArray.from_arrays(values.offsets, keys, items, type=t, mask=_no_offset(values))
    return values.cast(t)


def _no_offset(values: pa.Array) -> pa.Array | None:
    return values.is_null() if values.null_count else None


def decode_batch(payloads: pa.Array, ids: np.ndarray, readers: dict[int, Reader], target: pa.StructType) -> pa.Array:
    """Payloads of one batch as structs of ``target``; those that do not fit their schema are null."""
    if not len(payloads):
        return pa.nulls(0, target)
    valid = payloads.is_valid().to_numpy(zero_copy_only=False)
    offsets = np.frombuffer(payloads.buffers()[1], np.int32, len(payloads) + 1, payloads.offset * 4).astype(np.int64)
    body = payloads.buffers()[2]
    src = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(1, np.uint8)
    index, chunks, done = np.full(len(payloads), -1, dtype=np.int64), [pa.nulls(0, target)], 0
    for schema_id, reader in readers.items():
        rows = np.flatnonzero(valid & (ids == schema_id))
        if not len(rows):
            continue
        start, end = offsets[rows], offsets[rows + 1]
        values, pos, bad = reader(src, start, end)
        chunks.append(_conform(values, target))
        index[rows] = np.where(bad | (pos != end), -1, np.arange(len(rows)) + done)
        done += len(rows)
    return pa.concat_arrays(chunks).take(pa.array(index, mask=index < 0))


def decode_avro(df: DataFrame, registry: DataFrame, col: str = "value", subject: str | None = None) -> DataFrame:
    """Decode wire-format values with the schema each one names.

    ``col`` becomes a struct with the columns of all versions; columns a version
    lacks are null. Values without a known schema id become null structs.
    """
    reg = registry.where(F.col("type") == "AVRO")
    if subject is not None:
        reg = reg.where(F.col("subject") == subject)
    schemas = {r.id: r.schema for r in sorted(registry_rows(reg), key=lambda r: (r.version, r.id))}
    if not schemas:
        raise ValueError("the registry has no Avro schema for this topic")
    target = as_nullable(reduce(merge_schema, [avro_to_struct(s) for s in schemas.values()]))
    keep = [c for c in df.columns if c != col]
    source = split_wire_format(df.withColumnRenamed(col, "_wire"), "_wire").select(*keep, "schema_id", "payload")
    out_schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(col, target, True)])
    arrow = to_arrow_schema(out_schema, prefers_large_types=False)

    def batches(it):
        readers = {i: _reader(_load(s), _Names(), "") for i, s in schemas.items()}
        for batch in it:
            ids = batch.column(len(keep)).fill_null(-1).to_numpy(zero_copy_only=False)
            value = decode_batch(batch.column(len(keep) + 1).cast(pa.binary()), ids, readers, arrow.field(col).type)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(keep))], value], names=[*keep, col])

    return source.mapInArrow(batches, out_schema).select(*df.columns)


# ---- encoding: a writer turns a column into the byte count of each row and the bytes back to back

Pieces = tuple[np.ndarray, np.ndarray]


def _long_pieces(v: np.ndarray) -> Pieces:
    z = ((v << 1) ^ (v >> 63)).view(np.uint64)
    size = np.ones(len(v), dtype=np.int64)
    for k in range(1, 10):
        size += z >= np.uint64(1 << (7 * k))
    width = int(size.max()) if len(v) else 1
    out = np.empty((len(v), width), dtype=np.uint8)
    for k in range(width):
        part = ((z >> np.uint64(7 * k)) & np.uint64(0x7F)).astype(np.uint8)
        out[:, k] = np.where(k < size - 1, part | 0x80, part)
    return size, out[np.arange(width) < size[:, None]]


def _interleave(parts: list[Pieces], n: int) -> Pieces:
    """Row by row, the bytes of all parts one after another."""
    total = np.zeros(n, dtype=np.int64)
    for size, _ in parts:
        total += size
    at = np.cumsum(total) - total
    out = np.empty(int(total.sum()), dtype=np.uint8)
    for size, data in parts:
        before = np.cumsum(size) - size
        out[np.arange(len(data)) + np.repeat(at - before, size)] = data
        at = at + size
    return total, out


def _binary_pieces(a: pa.Array) -> Pieces:
    a = a.cast(pa.binary())
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(a.buffers()[1], np.int32, len(a) + 1, a.offset * 4).astype(np.int64)
    body = a.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return np.diff(offsets), data


def _counts(a: pa.Array, logical: str | None) -> np.ndarray:
    """Numbers, dates and times in the unit of the logical type."""
    t = a.type
    if pa.types.is_timestamp(t):
        a = a.cast(pa.timestamp("us", tz=t.tz)).cast(pa.int64())
        unit = 1000 if logical == "timestamp-millis" else 1
    elif pa.types.is_time(t):
        a = a.cast(pa.time64("ns")).cast(pa.int64())
        unit = 1_000_000 if logical == "time-millis" else 1000
    else:
        a = a.cast(pa.int32()).cast(pa.int64()) if pa.types.is_date(t) else a.cast(pa.int64())
        unit = 1
    v = a.to_numpy(zero_copy_only=False)
    return v if unit == 1 else np.floor_divide(v, unit)


def _many_pieces(offsets: pa.Array, item: Pieces) -> Pieces:
    """One block with all items of a row, then the closing zero."""
    off = offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    off = off - off[0]
    counts = np.diff(off)
    ends = np.concatenate([[0], np.cumsum(item[0])])
    head_size, head = _long_pieces(counts[counts > 0])
    sizes = np.zeros(len(counts), dtype=np.int64)
    sizes[counts > 0] = head_size
    close = (np.ones(len(counts), dtype=np.int64), np.zeros(len(counts), dtype=np.uint8))
    return _interleave([(sizes, head), (ends[off[1:]] - ends[off[:-1]], item[1]), close], len(counts))


def _slice_values(a: pa.Array, child: pa.Array) -> pa.Array:
    off = a.offsets.to_numpy(zero_copy_only=False)
    return child.slice(int(off[0]), int(off[-1] - off[0]))


def _writer(schema, names: _Names, ns: str) -> Callable[[pa.Array], Pieces]:
    """Pieces of a column; a null in a required column is an error."""
    if isinstance(schema, list):
        value, optional = _optional(schema)
        write = _writer(value, names, ns)
        some = next(k for k, s in enumerate(schema) if s != "null")
        null = schema.index("null") if optional else some

        def union(a):
            valid = a.is_valid().to_numpy(zero_copy_only=False)
            if not optional and not valid.all():
                raise ValueError("null in a required Avro field")
            size, data = write(a.drop_null())
            sizes = np.zeros(len(a), dtype=np.int64)
            sizes[valid] = size
            return _interleave([_long_pieces(np.where(valid, some, null).astype(np.int64)), (sizes, data)], len(a))

        return union
    schema, ns = names.resolve(schema, ns)
    kind, attrs = _node(schema)
    if kind == "union":
        return _writer(schema["type"], names, ns)
    if kind == "null":
        return lambda a: (np.zeros(len(a), dtype=np.int64), np.zeros(0, np.uint8))
    write = _value_writer(kind, attrs, names, ns)

    def required(a):
        if a.null_count:
            raise ValueError(f"null in a required Avro field of type {kind}")
        return write(a)

    return required


def _value_writer(kind: str, attrs: dict, names: _Names, ns: str) -> Callable[[pa.Array], Pieces]:
    logical = attrs.get("logicalType")
    if kind == "boolean":
        return lambda a: (np.ones(len(a), dtype=np.int64), a.to_numpy(zero_copy_only=False).astype(np.uint8))
    if kind in ("int", "long"):
        return lambda a: _long_pieces(_counts(a, logical))
    if kind in ("float", "double"):
        width = 4 if kind == "float" else 8
        return lambda a: (
            np.full(len(a), width, dtype=np.int64),
            np.ascontiguousarray(a.to_numpy(zero_copy_only=False), dtype=f"<f{width}").view(np.uint8),
        )
    if kind in ("string", "bytes", "fixed"):
        width, scale = attrs.get("size"), attrs.get("scale", 0)

        def raw(a):
            if logical == "decimal":
                numbers = [int(v.scaleb(scale)) for v in a.to_pylist()]
                a = pa.array([n.to_bytes(width or (n.bit_length() + 8) // 8, "big", signed=True) for n in numbers], pa.binary())
            size, data = _binary_pieces(a)
            if kind != "fixed":
                return _interleave([_long_pieces(size), (size, data)], len(a))
            if (size != width).any():
                raise ValueError(f"fixed value needs {width} bytes")
            return size, data

        return raw
    if kind == "enum":
        symbols = pa.array(attrs["symbols"], pa.string())

        def enum(a):
            k = pc.index_in(a, value_set=symbols)
            if k.null_count:
                raise ValueError("value is no symbol of the enum")
            return _long_pieces(k.to_numpy(zero_copy_only=False).astype(np.int64))

        return enum
    if kind == "map" or (kind == "array" and logical == "map" and _is_map_array(attrs["items"], names, ns)):
        if kind == "map":
            key, value = _writer("string", names, ns), _writer(attrs["values"], names, ns)
        else:
            entry, space = names.resolve(attrs["items"], ns)
            key, value = (_writer(f["type"], names, space) for f in entry["fields"])

        def pairs(a):
            keys, items = _slice_values(a, a.keys), _slice_values(a, a.items)
            return _many_pieces(a.offsets, _interleave([key(keys), value(items)], len(keys)))

        return pairs
    if kind == "array":
        item = _writer(attrs["items"], names, ns)
        return lambda a: _many_pieces(a.offsets, item(_slice_values(a, a.values)))
    if kind == "record":
        fields = [(f["name"], _writer(f["type"], names, ns)) for f in attrs["fields"]]

        def record(a):
            columns = dict(zip([f.name for f in a.type], a.flatten()))
            return _interleave([write(columns[name]) for name, write in fields], len(a))

        return record
    raise ValueError(f"cannot write Avro type {kind}")


def encode_avro(df: DataFrame, schema_id: int, schema, keep: list[str] | None = None, col: str = "value") -> DataFrame:
    """Rows to wire-format Avro values; ``keep`` columns pass through."""
    keep = keep or []
    text = json.dumps(_load(schema))
    fields = avro_to_struct(text).names
    out_schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(col, T.BinaryType(), False)])

    def batches(it):
        write = _writer(json.loads(text), _Names(), "")
        for batch in it:
            size, data = write(batch.column(len(keep)))
            kept = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, _binary(data, size)], names=[*keep, col])

    rows = df.select(*keep, F.struct(*fields).alias("_row")).mapInArrow(batches, out_schema)
    return rows.withColumn(col, join_wire_format(F.col(col), schema_id))
