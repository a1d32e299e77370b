import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from topiclake.functions.scalars import as_unsigned, clamp, classify, parse_partition_by
from topiclake.operators import metrics as M
from topiclake.plans.panels import PANELS, panel

START = dt.datetime(2024, 1, 1)
SCHEMA = "metric string, labels map<string,string>, ts timestamp, value double"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def samples(spark, rows):
    return spark.createDataFrame([(m, l, at(s), float(v)) for m, l, s, v in rows], SCHEMA)


def reference_rate(points, w, s):
    """Plain rate of one series: {end: value}."""
    points = sorted(dict(sorted(points)).items())
    deltas = {}
    for (t, v), prev in zip(points, [None, *points]):
        deltas[t] = 0.0 if prev is None else v - prev[1] if v >= prev[1] else v
    epoch = START.replace(tzinfo=dt.timezone.utc).timestamp()
    out = {}
    for k in range(math.floor((epoch - w) / s), math.floor((epoch + points[-1][0] + w) / s) + 1):
        lo, hi = k * s - w - epoch, k * s - epoch
        inside = [t for t, _ in points if lo <= t < hi]
        if len(inside) >= 2:
            out[hi] = sum(deltas[t] for t in inside[1:]) / (inside[-1] - inside[0])
    return out


@pytest.mark.parametrize("window,step,chunk", [("60s", "20s", None), ("45s", "30s", None), ("20s", "60s", "5s"), ("5m", "1m", "10s")])
def test_rate_matches_brute_force(spark, window, step, chunk):
    rng = random.Random(3)
    series = {}
    for name in "abc":
        t, v, pts = 0.0, 0.0, []
        for _ in range(200):
            t += rng.choice([0.5, 3, 10, 70])
            v = 0.5 if rng.random() < 0.1 else v + rng.choice([0, 1.25, 7])
            pts.append((t, v))
        series[name] = pts
    df = samples(spark, [("m", {"s": n}, t, v) for n, pts in series.items() for t, v in pts])
    got = {}
    for r in M.rate(df, window, step, chunk=chunk).collect():
        got.setdefault(r.series_key, {})[(r.step - START).total_seconds()] = r.value
    for name, pts in series.items():
        want = reference_rate(pts, M.duration_us(window) / 1e6, M.duration_us(step) / 1e6)
        mine = got[f'{{"s":"{name}"}}']
        assert set(mine) == set(want)
        assert all(abs(mine[k] - want[k]) < 1e-9 for k in want)


def test_rate_edge_cases(spark):
    df = samples(
        spark,
        [
            ("m", {"k": "one"}, 5, 1),  # one sample: no rate
            ("m", {"k": "reset"}, 0, 100), ("m", {"k": "reset"}, 10, 4), ("m", {"k": "reset"}, 20, 6),
            ("m", {"k": "twice"}, 0, 1), ("m", {"k": "twice"}, 0, 2), ("m", {"k": "twice"}, 10, 5),
        ],
    )
    got = {r.series_key: r.value for r in M.rate(df, "1m", "1m").collect()}
    assert got == {'{"k":"reset"}': 6 / 20, '{"k":"twice"}': 3 / 10}
    with pytest.raises(ValueError):
        M.rate(df, "0s", "1s")


def test_long_windows_on_a_fine_grid(spark):
    """Window / step far above a thousand; ends count from a start where there is one."""
    rng = random.Random(8)
    points, v = [], 0.0
    for i in range(40):
        v += rng.random()
        points.append((i * 1800.0 + rng.choice([0, 7, 20]), v))
    df = samples(spark, [("m", {"s": "a"}, t, v) for t, v in points])
    got = {(r.step - START).total_seconds(): r.value for r in M.rate(df, "12h", "10s").collect()}
    want = reference_rate(points, 12 * 3600, 10)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    bounded = {(r.step - START).total_seconds() for r in M.rate(df, "2h", "1h", start=at(5400), end=at(5400 + 7200)).collect()}
    assert bounded == {5400.0, 9000.0, 12600.0}
    gauge = {(r.step - START).total_seconds(): r.value for r in M.gauge_range(df, "1h", "30m", at(3600), at(7200)).collect()}
    newest = {e: max((t, v) for t, v in points if e - 1800 < t <= e)[1] for e in (3600, 7200)}
    assert gauge == newest  # a sample at the end itself counts


def test_hot_series_is_spread_over_tasks(spark):
    """A series with most rows reaches the window step as many (series, chunk) groups."""
    df = spark.range(20000).select(
        F.lit("m").alias("metric"), F.create_map(F.lit("k"), F.lit("hot")).alias("labels"),
        F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").cast("double").alias("value"),
    )
    plan = M.rate(df, "10m", "10m")._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert "_c#" in first
    assert {round(r.value, 9) for r in M.rate(df, "10m", "10m").collect()} == {1.0}


def test_running_counter(spark):
    rows = [(i, "ab"[i % 2], at(i * 37), i % 5 + 0.25) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp, v double")
    got = M.as_counter(df, "m", {"k": F.col("k")}, increment=F.col("v"), tie="id")
    want, run = {}, {"a": 0.0, "b": 0.0}
    for i, k, t, v in rows:
        run[k] += v
        want[(k, t)] = run[k]
    assert {(r.labels["k"], r.ts): r.value for r in got.collect()} == want


def test_matchers(spark):
    df = samples(spark, [("a_b", {"x": "1"}, 0, 1), ("a_b", {"x": "12"}, 0, 1), ("a_b", {"y": "1"}, 0, 1), ("c", {"x": "1"}, 0, 1)])
    count = lambda **kw: M.select_series(df, **kw).count()
    assert count(metric="a_b", matchers=[("x", "=", "1")]) == 1
    assert count(metric="a_b", matchers=[("x", "!=", "1")]) == 2
    assert count(metric="a_b", matchers=[("x", "=~", "1")]) == 1  # the whole value has to match
    assert count(metric="a_b", matchers=[("x", "=~", "1.*|")]) == 3  # a missing label is empty
    assert count(metric="a_b", matchers=[("x", "!~", "1.*")]) == 1
    assert count(name_regex="a_.|c") == 4 and count(name_regex="a") == 0
    assert {r.label_value for r in M.label_values(df, "a_b", "x").collect()} == {"1", "12"}
    assert [r.metric for r in M.list_metrics(df, "a.*").collect()] == ["a_b"]


def test_instant_and_range(spark):
    df = samples(spark, [("g", {"k": "a"}, 10, 1), ("g", {"k": "a"}, 70, 2), ("g", {"k": "b"}, 20, 5)])
    got = {r.series_key: r.value for r in M.instant(df, at(70), "50s").collect()}
    assert got == {'{"k":"a"}': 2.0}  # (20, 70]: b's sample is just outside
    steps = {((r.step - START).total_seconds(), r.series_key[6]): r.value for r in M.gauge_range(df, "1m", "2m").collect()}
    assert steps == {(60.0, "a"): 1, (120.0, "a"): 2, (180.0, "a"): 2, (60.0, "b"): 5, (120.0, "b"): 5}


def test_vector_operators(spark):
    left = spark.createDataFrame([(1, "a", 4.0), (1, "b", 6.0), (2, "a", 1.0)], "step int, k string, value double")
    right = spark.createDataFrame([(1, "a", 2.0), (1, "b", 0.0), (1, "c", 9.0)], "step int, k string, value double")
    assert {(r.step, r.k): r.value for r in M.binary_op(left, right, "/").collect()} == {(1, "a"): 2.0, (1, "b"): None}
    both = {(r.step, r.k): r.value for r in M.vector_or(left, right).collect()}
    assert both == {(1, "a"): 4.0, (1, "b"): 6.0, (2, "a"): 1.0, (1, "c"): 9.0}
    with pytest.raises(Exception, match="several left series"):
        M.binary_op(left.union(left), right, "-").collect()


def lag_fixture(spark):
    def row(metric, labels, v):
        return (metric, labels, 30, v)

    rows = [row("kafka_group_commit_offset", {"consumer_group": "g", "topic": "t", "partition": p}, v) for p, v in (("0", 5), ("1", 7))]
    # partition 1 is reported by two instances, partition 2 was never committed, topic u has no group
    rows += [row("kafka_log_end_offset", {"topic": "t", "partition": p, "instance": i}, v) for p, i, v in (("0", "x", 10), ("1", "x", 8), ("1", "y", 9), ("2", "x", 4))]
    rows += [row("kafka_log_end_offset", {"topic": "u", "partition": "0", "instance": "x"}, 3)]
    return samples(spark, rows)


def test_lag_rules(spark):
    df = lag_fixture(spark)
    got = panel("group.consumer_lag", df, "1m", "1m", lookback="1m").collect()
    assert [(r.consumer_group, r.topic, r.value) for r in got] == [("g", "t", 23.0 - 12.0)]
    parts = {r.partition: r.value for r in panel("group.consumer_lag_by_partition", df, "1m", "1m", lookback="1m").collect()}
    assert parts == {"0": 5.0, "1": 2.0} and all(v >= 0 for v in parts.values())
    stats = panel("topic.consume_statistics", df, "1m", "1m", lookback="1m").collect()
    assert [(r.topic, r.consumer_group, r.committed, r.end_offset, r.lag) for r in stats] == [("t", "g", 12.0, 23.0, 11.0)]
    size = panel("topic.partition_total", df.withColumn("metric", F.lit("kafka_log_size")), "1m", "1m", lookback="1m").collect()
    assert [r.value for r in size] == [4]  # t: 0, 1, 2; u: 0


def test_quantiles(spark):
    bounds = [0.05, 0.1, 0.2, 0.4, 0.8, 1.6, 3.2]
    values = [(random.Random(i).random() * 4, "ab"[i % 2]) for i in range(500)]
    df = spark.createDataFrame(values, "v double, k string")
    h = M.to_histogram(df, "v", bounds, ["k"])
    top = {r.k: (r.bucket, r["count"]) for r in h.where("isnan(le) or le > 1e9").collect()}
    assert all(a == b for a, b in top.values())
    for r in M.histogram_quantile(h, [0.0, 0.5, 0.95, 1.0], ["k"], value="bucket").collect():
        mine = sorted(v for v, k in values if k == r.k)
        true = mine[min(len(mine) - 1, max(0, math.ceil(r.phi * len(mine)) - 1))]
        edges = [0.0, *bounds]
        slot = next((i for i, b in enumerate(bounds) if true <= b), None)
        if slot is None:
            assert r.value == 3.2  # the infinite bucket gives the largest bound
        elif r.phi > 0:
            assert edges[slot] <= r.value <= edges[slot + 1]
    empty = spark.createDataFrame([("0.1", 0.0), ("+Inf", 0.0)], "le string, value double")
    assert [r.value for r in M.histogram_quantile(empty, 0.9).collect()] == [None]
    slo = {r.k: r.violations for r in M.slo_violations(df, "v", 0.8, ["k"]).collect()}
    assert sum(slo.values()) == sum(v > 0.8 for v, _ in values)


def test_catch_up(spark):
    lag = spark.createDataFrame([(0, 0), (1, 3), (2, 9), (3, 4), (4, 0), (5, 0)], "step int, value int")
    ends = spark.createDataFrame([(i, 10 * i) for i in range(6)], "step int, value int")
    r = M.catch_up(lag, 1, ends).first()
    assert (r.peak_lag, r.recovered_at, r.log_growth) == (9, 4, 40)


def test_reducers(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "a"), (2, 4.0, "b")], "step int, value double, k string")
    got = {r.k: (r.last_not_null, r["mean"], r["max"]) for r in M.reduce_series(df, ["lastNotNull", "mean", "max"], ["k"]).collect()}
    assert got == {"a": (1.0, 1.0, 1.0), "b": (4.0, 4.0, 4.0)}


def test_every_panel_runs_on_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for name in PANELS:
        assert panel(name, empty).schema is not None


def test_scalars(spark):
    df = spark.createDataFrame([(-1, -1, 0.5), (5, 5, 7.0), (None, None, None)], "i int, l bigint, d double")
    got = df.select(as_unsigned("i", 32), as_unsigned("l", 64).cast("string"), clamp("d", 1.0, 5.0), classify("d", [(None, "g"), (1, "y"), (7, "r")])).collect()
    assert [tuple(r) for r in got] == [(2**32 - 1, str(2**64 - 1), 1.0, "g"), (5, "5", 5.0, "r"), (None, None, None, None)]


def test_partition_fields():
    a = parse_partition_by("[month(ts), bucket(id, 16)]")
    b = parse_partition_by(["month(ts)", "bucket(16, id)"])
    assert [p.text for p in a] == [p.text for p in b] == ["month(ts)", "bucket(id, 16)"]
    assert [p.name for p in a] == ["ts_month", "id_bucket"]
    for bad in ("week(ts)", "bucket(id)", "month(ts"):
        with pytest.raises(ValueError):
            parse_partition_by([bad])
