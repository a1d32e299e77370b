import datetime as dt

import pytest
from pyspark.sql import functions as F

from topiclake.operators.keyed import apply_changes, latest_by_key, union_versions
from topiclake.operators.projection import flatten_debezium
from topiclake.session import shared_dir
from topiclake.table import LakeTable, ensure_table, list_tables
from topiclake.table.lake import merge_schema

USER = "id string, name string, email string"


@pytest.fixture
def table(spark):
    return LakeTable(spark, shared_dir(spark, "t"))


def users(spark, rows):
    return spark.createDataFrame(rows, USER)


def ten(spark):
    return users(spark, [(f"u-{i}", f"user_{i}", f"user_{i}@example.com") for i in range(1, 11)])


def test_upsert_keeps_one_row_per_id(spark, table):
    table.upsert(ten(spark), ["id"])
    table.upsert(users(spark, [("u-1", "user_updated", "updated@example.com")]), ["id"])
    got = {r.id: r.name for r in table.read().collect()}
    assert len(got) == 10 and got["u-1"] == "user_updated" and got["u-2"] == "user_2"
    before = sorted(table.read().collect())
    table.upsert(table.read(), ["id"])  # writing the same rows again changes nothing
    assert sorted(table.read().collect()) == before
    table.compact()
    assert sorted(table.read().collect()) == before


def test_upsert_orders_by_message_not_by_arrival(spark, table):
    schema = "id int, v string, t timestamp, p int, o bigint"
    day = dt.datetime(2024, 1, 1)
    late = spark.createDataFrame([(1, "new", day + dt.timedelta(hours=2), 3, 0), (2, "a", day, 0, 1)], schema)
    early = spark.createDataFrame([(1, "old", day, 9, 99), (2, "b", day, 0, 2)], schema)
    order = ["t", "p", "o"]
    for compacted in (False, True):
        t = LakeTable(spark, shared_dir(spark, "late"))
        t.upsert(late, ["id"], order)
        if compacted:
            t.compact()
        t.upsert(early, ["id"], order)
        assert {r.id: r.v for r in t.read().collect()} == {1: "new", 2: "b"}


def test_deleted_key_stays_deleted_for_late_changes(spark, table):
    schema = "id int, v string, t timestamp, op string"
    day = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(1, "a", day, "c"), (2, "b", day, "c")], schema)
    gone = spark.createDataFrame([(1, "a", day + dt.timedelta(days=2), "d")], schema)
    late = spark.createDataFrame([(1, "x", day + dt.timedelta(days=1), "u")], schema)
    table.apply_changes(rows, ["id"], ["t"], op_col="op")
    table.apply_changes(gone, ["id"], ["t"], op_col="op")
    table.compact()
    table.apply_changes(late, ["id"], ["t"], op_col="op")
    assert [r.id for r in table.read().collect()] == [2]


def test_compaction_touches_changed_buckets_only(spark):
    t = LakeTable(spark, shared_dir(spark, "buckets")).create(id_columns=["id"], key_buckets=8)
    t.upsert(ten(spark))
    t.compact()
    first = t.head()
    t.upsert(users(spark, [("u-3", "x", "y")]))
    t.compact()
    second = t.head()
    changed = {b for b in second.bucket_base if second.bucket_base[b] != first.bucket_base.get(b)}
    assert len(changed) == 1
    assert t.read().count() == 10 and t.read().where("id = 'u-3'").first().name == "x"


def test_change_of_id_columns(spark, table):
    table.upsert(ten(spark), ["id"])
    table.upsert(users(spark, [("u-1", "other", "o@example.com")]))
    table.set_id_columns(["id", "name"])
    assert table.read().count() == 10  # the replaced row does not come back
    table.upsert(users(spark, [("u-1", "user_1", "again@example.com"), ("u-1", "other", "new@example.com")]))
    got = {(r.id, r.name): r.email for r in table.read().collect()}
    assert len(got) == 11 and got[("u-1", "other")] == "new@example.com"
    assert [o.id_columns for o in table.table_options().orderBy("commit_id").collect()] == ["id", "id, name"]


def test_schema_evolution(spark, table):
    table.append(spark.createDataFrame([(1, 1.5)], "id int, x float"))
    table.append(spark.createDataFrame([(2**40, 2.5, "n", {"a": 1})], "id bigint, x double, notes string, s struct<a:int>"))
    table.append(spark.createDataFrame([(3, {"a": 2, "b": "z"})], "id int, s struct<a:int,b:string>"))  # x and notes left out
    assert table.schema.simpleString() == "struct<id:bigint,x:double,notes:string,s:struct<a:int,b:string>>"
    got = {r.id: r for r in table.read().collect()}
    assert got[1].notes is None and got[1].s is None and got[1].x == 1.5
    assert got[2**40].s.b is None and got[2**40].x == 2.5
    assert got[3].x is None and got[3].notes is None and got[3].s.b == "z"
    with pytest.raises(ValueError):
        table.append(spark.createDataFrame([("t",)], "id string"))
    table.evolve(merge_schema(table.schema, spark.createDataFrame([], "added date").schema))
    assert table.read().columns[-1] == "added" and table.read().count() == 3


def orders(spark, first, n):
    return spark.range(first, first + n).select(
        F.concat(F.lit("o-"), "id").alias("id"),
        F.lit("name").alias("name"),
        F.timestamp_millis(F.lit(1700000000000) + F.col("id") * 86_400_000).alias("ts"),
    )


def test_partition_spec_evolution(spark, table):
    table.create(partition_by="[month(ts)]")
    table.append(orders(spark, 0, 10))
    table.set_partition_by("[month(ts), bucket(16, id)]")
    table.append(orders(spark, 10, 10))
    assert table.read().count() == 20
    parts = table.partitions().collect()
    assert {p.spec_id for p in parts} == {0, 1}
    assert all("id_bucket" not in p.partition for p in parts if p.spec_id == 0)
    assert all("id_bucket" in p.partition for p in parts if p.spec_id == 1)
    assert sum(p.record_count for p in parts) == 20
    # 2023-11 is month 646 since 1970-01
    assert '{"ts_month":"646"}' in {p.partition for p in parts}
    got = table.read(["id"], ("ts", "2023-11-20", "2023-11-26"))
    assert sorted(r.id for r in got.collect()) == ["o-10", "o-11", "o-6", "o-7", "o-8", "o-9"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ts_month" in plan.split("PartitionFilters")[1]


def test_metadata_queries(spark, table):
    table.append(orders(spark, 0, 4))
    table.append(orders(spark, 4, 3))
    snaps = table.snapshots().collect()
    assert [s.operation for s in snaps] == ["append", "append"] and [s.record_count for s in snaps] == [3, 4]
    assert {h.parent_id for h in table.history().collect()} == {None, 0}
    files = table.files().collect()
    assert sum(f.record_count for f in files) == 7 and all(f.file_format == "PARQUET" and f.file_size_in_bytes > 0 for f in files)
    assert {(m.commit, m.added_rows) for m in table.manifests().collect()} == {(0, 4), (1, 3)}
    assert ("ts", "timestamp", "column") in [tuple(r) for r in table.describe().collect()]
    assert table.show_create().startswith("CREATE TABLE")
    table.truncate()
    assert table.read().count() == 0 and table.files().count() == 0
    table.append(orders(spark, 9, 1))
    assert table.read().count() == 1 and [h.is_current_ancestor for h in table.history().orderBy("snapshot_id").collect()] == [False, False, True, True]


def test_unfinished_write_is_not_read_and_is_replaced(spark, table):
    table.append(orders(spark, 0, 4))
    orders(spark, 100, 5).write.parquet(f"{table.path}/data/spec=0/commit=1")  # stopped before its commit row
    assert table.read().count() == 4
    table.append(orders(spark, 4, 1))
    assert table.read().count() == 5


def test_compaction_of_an_append_table(spark, table):
    def stored():
        return table.files().count()

    for i in range(3):
        table.append(orders(spark, 4 * i, 4))
    before = sorted(table.read().collect())
    many = stored()
    table.compact()
    assert sorted(table.read().collect()) == before and stored() < many
    table.append(orders(spark, 12, 4))
    table.compact()
    assert table.read().count() == 16 and table.read().distinct().count() == 16
    assert table.read_commits([1]).count() == 4  # a follower still finds what a commit added


def test_same_stream_batch_commits_once(spark, table):
    table.append(orders(spark, 0, 4), stream=("s", 0))
    table.append(orders(spark, 0, 4), stream=("s", 0))
    table.append(orders(spark, 4, 4), stream=("s", 1))
    assert table.read().count() == 8


ROW = "struct<id:int,first_name:string,email:string,phone:string,status:string>"


def change_feed(spark, snapshot=False):
    def row(i, first, email, phone=None, status="active" if snapshot else None):
        return (i, first, email, phone, status)

    names = ["John", "Jane", "Peter", "Alice", "Bob", "CDC1", "CDC2"]
    r = {i + 1: row(i + 1, n, f"{n.lower()}@example.com") for i, n in enumerate(names)}
    events = [(None, r[i], "r" if snapshot else "c") for i in r]
    john, jane = row(1, "John", "john.doe.updated@example.com"), row(2, "Jane Updated", "jane@example.com")
    events += [(r[1], john, "u"), (r[2], jane, "u"), (r[7], None, "d")]
    events += [(None, row(8, "Schema", "s@example.com", "123-456-7890", "active"), "c")]
    events += [(r[3], row(3, "Peter", "peter@example.com", "555-0001", "active"), "u")]
    last = row(9, "Final", "f@example.com", "+1-555-123-4567", "inactive")
    events += [(None, last, "c"), (last, (*last[:4], "active"), "u"), (None, None, None)]
    schema = f"before {ROW}, after {ROW}, op string, ts_ms bigint"
    return spark.createDataFrame([(b, a, op, i) for i, (b, a, op) in enumerate(events)], schema)


@pytest.mark.parametrize("snapshot", [False, True])
def test_change_feed_final_state(spark, table, snapshot):
    flat = flatten_debezium(change_feed(spark, snapshot))
    assert flat.columns[-1] == "_cdc" and flat.count() == 14
    half = flat.where("_cdc.ts_ms < 8"), flat.where("_cdc.ts_ms >= 8")
    for part in half:
        table.apply_changes(part, ["id"], [F.timestamp_millis("_cdc.ts_ms")])
    got = {r.id: r for r in table.read().collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 8, 9]
    assert got[1].email == "john.doe.updated@example.com" and got[2].first_name == "Jane Updated"
    assert got[3].phone == "555-0001" and got[9].status == "active"
    assert {got[i].status for i in (1, 2, 4, 5, 6)} == {"active" if snapshot else None}
    direct = apply_changes(flat, ["id"], ["_cdc.ts_ms"])
    assert sorted(r.id for r in direct.collect()) == sorted(got)


def test_latest_and_union(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, "c")], "k int, o int, v string")
    assert sorted(map(tuple, latest_by_key(df, ["k"], ["o"]).collect())) == [(1, 2, None), (2, 1, "c")]
    both = union_versions(df, df.withColumn("extra", F.lit(1)))
    assert both.where("extra is null").count() == 3 and both.columns[-1] == "extra"


def test_catalog_tables(spark):
    ensure_table(spark, "vehicle", "vin string, speed float")
    ensure_table(spark, "vehicle", "vin string, speed float")
    assert ("default", "vehicle") in [(r.namespace, r.name) for r in list_tables(spark).collect()]
