import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.fixtures import KINDS, LINE_V1, LINE_V2, registry_df, supplier_files, supplier_registry
from topiclake.formats import avro, protobuf, registry, wire
from topiclake.session import shared_dir
from topiclake.table import LakeTable

UTC = dt.timezone.utc


def line_row(i):
    return (
        i, dt.datetime(1995, 3, 14, 22, 13, 20 + i), "N", i, i % 2 == 0, dt.datetime(1998, 1, 1, 0, 0, 0, i), {f"k{i}": "v"}, 900 + i / 100,
        {"p_name": f"s{i}", "p_brand": "Brand#1"}, b"", [f"t{i}", "x"], f"mode {i}",
    )


def line_df(spark, n=10):
    return spark.createDataFrame([line_row(i) for i in range(n)], avro.avro_to_struct(LINE_V1))


def test_avro_types():
    s = avro.avro_to_struct(LINE_V1)
    assert s["part"].dataType.names == ["p_name", "p_brand"]
    assert s["l_shipdate"].dataType == T.TimestampType()
    assert not s["l_orderkey"].nullable
    k = avro.avro_to_struct(KINDS)
    assert k["by_id"].dataType == T.MapType(T.IntegerType(), T.StringType(), k["by_id"].dataType.valueContainsNull)
    assert k["amount"].dataType == T.DecimalType(10, 2)
    assert k["opt"].nullable
    for bad in (["int", "string"], ["null", "int", "string"]):
        with pytest.raises(ValueError):
            avro.avro_to_struct({"type": "record", "name": "R", "fields": [{"name": "x", "type": bad}]})
    with pytest.raises(ValueError):
        avro.avro_to_struct({"type": "record", "name": "R", "fields": [{"name": "next", "type": ["null", "R"]}]})


def test_avro_round_trip_and_versions(spark):
    reg = registry_df(spark, [("l-value", 1, 7, "AVRO", LINE_V1, []), ("l-value", 2, 9, "AVRO", LINE_V2, [])])
    v1 = avro.encode_avro(line_df(spark), 7, LINE_V1, keep=["l_orderkey"])
    v2_rows = line_df(spark, 3).withColumns(
        {
            "substitute": F.col("part"),
            "l_tax": F.lit(0.5),
            "sibling_lines": F.array(F.lit(1), F.lit(300)).cast("array<bigint>"),
            "l_comment": F.lit(None).cast("string"),
        }
    )
    v2 = avro.encode_avro(v2_rows, 9, LINE_V2, keep=["l_orderkey"])
    bad = spark.createDataFrame([(99, bytearray(b"\x00\x00\x00\x00\x07\xff")), (98, bytearray(b"xx"))], "l_orderkey bigint, value binary")
    got = avro.decode_avro(v1.unionByName(v2).unionByName(bad), reg)
    out = {(r.l_orderkey, r.value is not None and r.value.l_tax): r.value for r in got.collect()}
    assert len(out) == 15
    assert out[(99, False)] is None and out[(98, False)] is None
    first = out[(4, None)]
    assert first.l_shipmode == "mode 4" and first.remarks == ["t4", "x"] and first.mode_share == {"k4": "v"}
    assert first.l_shipdate == dt.datetime(1995, 3, 14, 22, 13, 24) and first.seen_at.microsecond == 4
    assert first.l_tax is None  # defaults are not filled in
    second = out[(2, 0.5)]
    assert second.sibling_lines == [1, 300] and second.substitute.p_name == "s2" and second.l_comment is None


def test_avro_all_kinds(spark):
    row = ("a", 1.5, b"abcd", Decimal("-12.34"), "0-0", dt.date(1969, 12, 31), dt.time(1, 2, 3, 4000), dt.time(1, 2, 3, 4), None, {1: "x", -70: "y"})
    df = spark.createDataFrame([row], avro.avro_to_struct(KINDS))
    reg = registry_df(spark, [("k", 1, 1, "AVRO", KINDS, [])])
    decoded = avro.decode_avro(avro.encode_avro(df, 1, KINDS), reg).select("value.*")
    assert tuple(decoded.first()) == row
    table = LakeTable(spark, shared_dir(spark, "kinds"))
    table.append(decoded)
    assert tuple(table.read().first()) == row


def test_wire_format(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x01\x02hi"),), (bytearray(b"\x01\x00\x00\x01\x02hi"),), (None,), (bytearray(b"\x00\x00"),)], "value binary")
    got = [(r.schema_id, r.payload) for r in wire.split_wire_format(df).collect()]
    assert got == [(258, bytearray(b"hi")), (None, None), (None, None), (None, None)]


def test_registry_versions_and_references(spark):
    reg = registry_df(spark, [("a", 1, 1, "AVRO", '"int"', [])])
    same = registry.register_schema(reg, "a", '"int"')
    assert same.count() == 1
    reg = registry.register_schema(reg, "b", '"int"')  # equal content keeps its id
    reg = registry.register_schema(reg, "a", '"long"')
    reg = registry.register_schema(reg, "c", "x", "PROTOBUF", [("a.proto", "a", -1)])
    reg = registry.register_schema(reg, "d", "y", "PROTOBUF", [("c.proto", "c", 1), ("b.proto", "b", 1)])
    got = {(r.subject, r.version, r.id) for r in reg.collect()}
    assert got == {("a", 1, 1), ("b", 1, 1), ("a", 2, 2), ("c", 1, 3), ("d", 1, 4)}
    assert {(r.subject, r.version) for r in registry.latest_schemas(reg).collect()} == {("a", 2), ("b", 1), ("c", 1), ("d", 1)}
    refs = registry.resolve_references(reg, "d").collect()
    assert {(r.name, r.subject, r.version, r.schema) for r in refs} == {
        ("c.proto", "c", 1, "x"),
        ("b.proto", "b", 1, '"int"'),
        ("a.proto", "a", 2, '"long"'),
    }


def test_protobuf_round_trip(spark):
    reg = supplier_registry(spark)
    d = protobuf.message_descriptor([protobuf.file_text(f) for f in supplier_files()], "tests.supply.Supplier")
    s = protobuf.proto_to_struct(d)
    assert "contact_choice" in s.names and "_s_comment_choice" not in s.names
    assert sorted(s["measures"].dataType.valueType.names) == ["as_count", "as_flag", "as_text", "measured_choice"]
    assert s["s_comment"].nullable and not s["s_suppkey"].nullable
    rows = [
        {
            "rating": "PREFERRED", "s_acctbal": i / 2, "s_suppkey": f"s{i}", "nation": {"n_nationkey": 1, "n_comment": None, "n_name": "PERU"},
            "by_phone": "1-2" if i == 0 else None, "by_desk": 4 if i == 1 else None, "part_names": [], "row_mark": -2 if i == 1 else i,
            "stock": {"x": 2**40}, "s_comment": None if i else "m", "deliveries": -1 if i == 1 else i,
            "branches": [{"n_nationkey": 2, "n_comment": "DE", "n_name": "o"}], "stamp": b"\x00",
            "measures": {"a": {"as_count": 3}, "b": {"as_flag": False}}, "joined_at": dt.datetime(1996, 1, 1, 0, 0, i, 5),
        }
        for i in range(3)
    ]
    df = spark.createDataFrame(rows, protobuf.as_nullable(s))
    wire_df = protobuf.encode_protobuf(df, reg, "tests.supply.Supplier", keep=["s_suppkey"])
    bad = spark.createDataFrame([("bad", bytearray(b"\xff\xff"))], "s_suppkey string, value binary")
    got = {r.s_suppkey: r.value for r in protobuf.decode_protobuf(wire_df.unionByName(bad), reg, "tests.supply.Supplier").collect()}
    assert got["bad"] is None
    assert got["s1"].deliveries == -1 and got["s1"].row_mark == -2  # bits kept
    assert [got[f"s{i}"].contact_choice for i in range(3)] == ["by_phone", "by_desk", None]
    assert got["s0"].s_comment == "m" and got["s1"].s_comment is None
    assert got["s2"].joined_at == dt.datetime(1996, 1, 1, 0, 0, 2, 5)
    assert got["s2"].rating == "PREFERRED" and got["s2"].part_names == [] and got["s2"].stock == {"x": 2**40}
    assert got["s2"].branches[0].n_comment == "DE" and got["s2"].nation.n_comment is None
    assert got["s2"].measures["a"].measured_choice == "as_count" and got["s2"].measures["b"].as_flag is False


def test_protobuf_recursion_is_refused():
    places, supply = supplier_files()
    m = supply.message_type.add(name="Chain")
    f = m.field.add(name="next", number=1, label=1)
    f.type, f.type_name = 11, ".tests.supply.Chain"
    d = protobuf.message_descriptor([protobuf.file_text(places), protobuf.file_text(supply)], "tests.supply.Chain")
    with pytest.raises(ValueError):
        protobuf.proto_to_struct(d)


def long_bytes(n):
    z, out = (n << 1) ^ (n >> 63), bytearray()
    while z > 0x7F:
        out.append((z & 0x7F) | 0x80)
        z >>= 7
    return bytes(out) + bytes([z])


def test_sized_blocks_and_broken_rows():
    """Arrays in several blocks, also with a byte size; damaged payloads leave other rows alone."""
    import numpy as np
    import pyarrow as pa

    schema = {"type": "record", "name": "R", "fields": [{"name": "a", "type": {"type": "array", "items": "long"}}, {"name": "s", "type": "string"}]}
    body = lambda xs: b"".join(map(long_bytes, xs))
    text = long_bytes(2) + b"hi"
    several = long_bytes(2) + body([1, -2]) + long_bytes(-3) + long_bytes(len(body([5, 300, 7]))) + body([5, 300, 7]) + b"\x00" + text
    rows = [
        several,
        b"\x00" + text,
        several + b"!",  # bytes left over
        several[:-1],  # text too short
        long_bytes(2**40) + b"\x02",  # more items than bytes
        b"\x00" + long_bytes(-4),
        b"\x00" + long_bytes(2) + b"\xff\xfe",  # not UTF-8
        b"",
        b"\xff" * 12,
        None,
        b"\x00" + text,
    ]
    t = pa.struct([("a", pa.list_(pa.int64())), ("s", pa.string())])
    reader = avro._reader(schema, avro._Names(), "")
    got = avro.decode_batch(pa.array(rows, pa.binary()), np.full(len(rows), 1), {1: reader}, t).to_pylist()
    assert got[0] == {"a": [1, -2, 5, 300, 7], "s": "hi"}
    assert got[1] == got[10] == {"a": [], "s": "hi"}
    assert got[2:10] == [None] * 8


def test_numbers_of_every_length():
    import numpy as np
    import pyarrow as pa

    values = [s * (2**k + d) for k in range(63) for d in (-1, 0, 1) for s in (1, -1)] + [2**63 - 1, -(2**63), 0]
    schema = {"type": "record", "name": "R", "fields": [{"name": "x", "type": ["null", "long"]}, {"name": "m", "type": {"type": "map", "values": ["null", "double"]}}]}
    t = pa.struct([("x", pa.int64()), ("m", pa.map_(pa.string(), pa.float64()))])
    rows = [{"x": None if i % 7 == 3 else v, "m": [(f"k{j}", None if j == 1 else v / 3) for j in range(i % 4)]} for i, v in enumerate(values)]
    column = pa.array(rows, t)
    size, data = avro._writer(schema, avro._Names(), "")(column)
    wire_values = avro._binary(data, size)
    plain = [b for b, r in zip(wire_values.to_pylist(), rows) if r["x"] is not None and not r["m"]]
    assert plain == [long_bytes(1) + long_bytes(r["x"]) + b"\x00" for r in rows if r["x"] is not None and not r["m"]]
    reader = avro._reader(schema, avro._Names(), "")
    for part in (slice(0, None), slice(5, 40)):
        cut = wire_values[part]
        assert avro.decode_batch(cut, np.full(len(cut), 1), {1: reader}, t).equals(column[part])


def test_required_null_is_refused(spark):
    import pyarrow as pa

    schema = {"type": "record", "name": "R", "fields": [{"name": "x", "type": "long"}]}
    with pytest.raises(ValueError):
        avro._writer(schema, avro._Names(), "")(pa.array([{"x": None}], pa.struct([("x", pa.int64())])))


def test_nested_versions(spark):
    """Records inside arrays and maps gain fields and widen between versions."""

    def schema(fields):
        item = {"type": "record", "name": "Item", "fields": fields}
        return {
            "type": "record",
            "name": "Box",
            "fields": [{"name": "items", "type": {"type": "array", "items": item}}, {"name": "by_key", "type": {"type": "map", "values": ["null", "Item"]}}],
        }

    old = schema([{"name": "n", "type": "int"}])
    new = schema([{"name": "n", "type": "long"}, {"name": "s", "type": ["null", "string"]}])
    reg = registry_df(spark, [("b", 1, 1, "AVRO", old, []), ("b", 2, 2, "AVRO", new, [])])
    a = spark.createDataFrame([([(1,), (2,)], {"k": (3,), "z": None})], avro.avro_to_struct(old))
    b = spark.createDataFrame([([], {"k": (2**40, "x")})], avro.avro_to_struct(new))
    got = avro.decode_avro(avro.encode_avro(a, 1, old).unionByName(avro.encode_avro(b, 2, new)), reg).select("value.*").collect()
    first, second = sorted(got, key=lambda r: -len(r["items"]))
    assert [tuple(x) for x in first["items"]] == [(1, None), (2, None)]
    assert tuple(first.by_key["k"]) == (3, None) and first.by_key["z"] is None
    assert second["items"] == [] and tuple(second.by_key["k"]) == (2**40, "x")


def test_reference_cycles_and_long_chains(spark):
    entries = [(f"s{i}", 1, i, "PROTOBUF", f"x{i}", [(f"n{i + 1}", f"s{i + 1}", 1)]) for i in range(12)]
    entries += [("s12", 1, 12, "PROTOBUF", "x12", [("n3", "s3", 1), ("again", "s5", -1)])]
    found = registry.resolve_references(registry_df(spark, entries), "s0")
    assert {(r.name, r.subject) for r in found.collect()} == {(f"n{i}", f"s{i}") for i in range(1, 13)} | {("again", "s5")}
