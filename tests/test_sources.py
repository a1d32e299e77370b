import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from topiclake.operators import projection as P
from topiclake.operators.messaging import batch_stats, consume_rate, delivery_metrics, reconcile
from topiclake.sources import archives, exposition, topics


def test_hourly_archives(spark, tmp_path):
    def put(name, lines):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write("\n".join(lines))

    def event(i, **kw):
        return json.dumps({"id": str(i), "type": "WatchEvent", "created_at": "2024-01-01T09:00:00Z", "actor": {"login": "a"}, "repo": {"name": "r"}, **kw})

    put("2024-01-01-9.json.gz", [event(1), "", "not json", event(2)])
    put("2024-01-01-11.json.gz", [event(3)])
    put("2024-01-01-12.json.gz", [event(4)])
    lines = archives.read_hourly_json(spark, str(tmp_path), dt.datetime(2024, 1, 1, 9, 30), dt.datetime(2024, 1, 1, 12))
    assert sorted(r.id for r in P.map_event(lines).collect()) == ["1", "2", "3"]
    counts = P.count_lines(lines).first()
    assert (counts.good, counts.bad) == (3, 1)
    assert archives.hour_names(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1)) == ["2024-01-01-23.json.gz", "2024-01-02-0.json.gz"]
    assert archives.read_hourly_json(spark, str(tmp_path), dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 9)).count() == 0


def test_event_mapping_rules(spark):
    base = {"id": "1", "type": "T", "created_at": "2024-01-01T00:00:00Z", "actor": {"login": "a"}, "repo": {"name": "r"}}
    cases = {
        "full": (json.dumps(base), True),
        "no actor": (json.dumps({k: v for k, v in base.items() if k != "actor"}), True),
        "null actor": (json.dumps({**base, "actor": None}), False),
        "null repo": (json.dumps({**base, "repo": None}), False),
        "text actor": (json.dumps({**base, "actor": "x"}), False),
        "no time": (json.dumps({k: v for k, v in base.items() if k != "created_at"}), False),
        "bad time": (json.dumps({**base, "created_at": "soon"}), False),
        "offset": (json.dumps({**base, "created_at": "2024-01-01T02:00:00+02:00"}), True),
        "cut": (json.dumps(base)[:-5], False),
        "array": (f"[{json.dumps(base)}]", False),
        "blank": ("   ", False),
        "payload": (json.dumps({**base, "payload": {"x": [1, None, {"actor": None}]}}), True),
    }
    df = spark.createDataFrame([(text,) for text, _ in cases.values()], "value string")
    out = P.map_event(df)
    assert out.count() == sum(ok for _, ok in cases.values())
    assert out.where("org_login is null").count() == out.count()
    assert out.where("actor_login is null").count() == 1
    assert {r.created_at for r in out.collect()} == {dt.datetime(2024, 1, 1)}
    good, bad = P.drop_malformed(df)
    assert (good.count(), bad.count()) == (10, 1)


def test_backfill_plan(spark):
    now = dt.datetime(2024, 1, 10, 14, 20)
    first = dt.datetime(2024, 1, 7, 14)

    def plan(last_done, missing=(), empty=()):
        hours = [first + dt.timedelta(hours=i) for i in range(-5, 80) if i not in missing]
        rows = [(h, 0 if (h - first).total_seconds() / 3600 in empty else 7) for h in hours]
        df = spark.createDataFrame(rows, "hour timestamp, events bigint")
        return [r.hour for r in archives.plan_hours(spark, now, last_done, df).collect()]

    assert plan(None) == [first + dt.timedelta(hours=i) for i in range(69)]
    assert plan(None, missing=(4,)) == [first + dt.timedelta(hours=i) for i in range(4)]
    assert plan(None, empty=(0,)) == []
    assert plan(first + dt.timedelta(hours=66)) == [first + dt.timedelta(hours=i) for i in (67, 68)]
    assert plan(first + dt.timedelta(hours=68)) == []


def test_exposition(spark):
    text = [
        "# HELP demo_x Something.", "# TYPE demo_x counter", 'demo_x{region="eu",kind="a\\"b\\\\n,}"} 12.500000',
        "demo_plain 3", 'demo_h_bucket{le="+Inf"} 7', "demo_inf +Inf", "", "broken{", 'demo_ts{a="b"} 4 1700000000000',
    ]
    got = {r.metric: (r.labels, r.value) for r in exposition.parse_exposition(spark.createDataFrame([(t,) for t in text], "value string")).collect()}
    assert got == {
        "demo_x": ({"region": "eu", "kind": 'a"b\\n,}'}, 12.5),
        "demo_plain": ({}, 3.0),
        "demo_h_bucket": ({"le": "+Inf"}, 7.0),
        "demo_inf": ({}, float("inf")),
        "demo_ts": ({"a": "b"}, 4.0),
    }


def test_browse_and_mask(spark):
    df = spark.range(40).select(
        F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), F.col("id").alias("offset"),
        F.timestamp_seconds("id").alias("timestamp"), F.concat(F.lit("Mail a1@x.org "), "id").alias("value"),
    )
    assert P.browse(df, "t", 1, (3, 9), None, None, 2).count() == 2
    got = P.browse(df, "t", 1, (3, 9), None, "offset != 5", None)
    assert sorted(r.offset for r in got.collect()) == [3, 7]
    masked = P.mask_fields(df.limit(1), {"value": ("replace", r"\S+@\S+", "***"), "topic": ("mask",), "timestamp": ("drop",)}).first()
    assert masked.value.startswith("Mail *** ") and masked.topic == "x" and "timestamp" not in masked.asDict()
    with pytest.raises(ValueError):
        P.mask_fields(df, {"value": ("unknown",)})


def test_commit_log(spark):
    lines = ["x COMMIT_RESPONSE code=0, topic='a', dataFiles=2", "COMMIT_RESPONSE code=1, topic='a', dataFiles=0", "COMMIT_RESPONSE code=0 topic='b' dataFiles=0", "other"]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    assert [tuple(r) for r in P.scan_commit_log(df, "a").collect()] == [(0, "a", 2), (1, "a", 0)]
    assert P.commit_seen(df, "a").first().seen and not P.commit_seen(df, "b").first().seen


def test_delivery(spark):
    t0 = dt.datetime(2024, 1, 1)
    ms = lambda x: t0 + dt.timedelta(milliseconds=x)
    log = spark.createDataFrame(
        [(ms(0), ms(4), ms(10), True), (ms(10), ms(12), ms(40), True), (ms(20), ms(26), None, False)],
        "sent_at timestamp, acked_at timestamp, received_at timestamp, ok boolean",
    )
    m = delivery_metrics(log).first()
    assert (m.messages_sent, m.messages_received, m.total_ms, m.consume_ms, m.avg_produce_ms, m.avg_end_to_end_ms) == (3, 2, 40.0, 30.0, 4.0, 20.0)
    assert abs(consume_rate(log).first()[0] - 2000 / 30) < 1e-9
    b = batch_stats(log.withColumn("b", F.lit(1)), ["b"]).first()
    assert (b.delivered, b.failed, b.messages_per_second) == (2, 1, 150.0)
    sent = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    received = spark.createDataFrame([(2,), (3,), (4,), (4,)], "k int")
    assert {(r.k, r.status, r.messages) for r in reconcile(sent, received, ["k"]).collect()} == {(1, "missing", 1), (4, "extra", 2)}


def test_servers_are_recognised():
    assert topics.is_servers("broker-1:9092,broker-2:9092") and topics.is_servers("localhost:9092")
    assert not topics.is_servers("/data/topics") and not topics.is_servers("s3a://bucket/topics")


def test_bad_exposition_lines(spark):
    lines = ["foo{x=1} 5", 'bar{a="1"junk} 2', 'dup{a="1",a="2"} 3', 'ok{a="1",b="x}y,\\"z"} 4', "plain 5", 'trail{a="1",} 6', "\tpad{} 7 \r", "# c", "", "nan{a=\"1\"}", "x{a=\"1\"}8"]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    got = {r.metric: (r.labels, r.value) for r in exposition.parse_exposition(df).collect()}
    assert got == {"ok": ({"a": "1", "b": 'x}y,"z'}, 4.0), "plain": ({}, 5.0), "trail": ({"a": "1"}, 6.0), "pad": ({}, 7.0), "x": ({"a": "1"}, 8.0)}


def test_archives_of_absent_hours(spark, tmp_path):
    day = dt.datetime(2024, 5, 1)
    assert archives.read_hourly_json(spark, str(tmp_path), day, day + dt.timedelta(hours=3)).count() == 0
    lines = spark.createDataFrame([("\t",), ("\r ",), ("{}",), ("x",), ("",)], "value string")
    assert tuple(P.count_lines(lines).first()) == (1, 1, 3)
