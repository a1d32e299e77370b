"""Metric analytics over labelled samples.

A samples table has ``metric string, labels map<string,string>, ts timestamp,
value double``; a stored ``series_key`` column saves computing it. Every range
function returns ``metric, series_key, step, value`` and every label
aggregation returns ``step``, the label columns and ``value``. A ``step`` is
``start + k * step``, or a multiple of the step where no start is given, for
every function and window. Growth covers ``[step - window, step)``; a gauge is
its newest sample in ``(step - lookback, step]``.

Range functions never hold a whole series in one task. Samples are grouped into
short time chunks per series, each chunk becomes one summary row, and only
summaries meet per series; their number is bounded by time range / chunk.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclake.functions.scalars import anchored, epoch_us

SERIES = ["metric", "series_key"]
LABELS_TYPE = "map<string,string>"


def series_key(labels: Column | str = "labels") -> Column:
    """Canonical text of a label set: maps can neither be joined nor ordered."""
    c = F.col(labels) if isinstance(labels, str) else labels
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c))))


def label_key(labels: dict[str, Column]) -> Column:
    """The same text from label columns; a null label is absent."""
    if not labels:
        return F.lit("{}")
    return F.to_json(F.struct(*[labels[n].cast("string").alias(n) for n in sorted(labels)]))


def with_series_key(df: DataFrame) -> DataFrame:
    return df if "series_key" in df.columns else df.withColumn("series_key", series_key())


def label(name: str, key: str = "series_key") -> Column:
    """A label read back from the series key; a missing label is the empty string."""
    return F.coalesce(F.try_element_at(F.from_json(F.col(key), LABELS_TYPE), F.lit(name)), F.lit(""))


def select_series(
    df: DataFrame,
    metric: str | None = None,
    matchers: list[tuple[str, str, str]] | None = None,
    name_regex: str | None = None,
) -> DataFrame:
    """Samples of a metric, by ``(label, op, value)`` with ``=``, ``!=``, ``=~`` or ``!~``.

    Regexes match whole values and a missing label equals the empty string.
    """
    if metric is not None:
        df = df.where(F.col("metric") == metric)
    if name_regex is not None:
        df = df.where(F.col("metric").rlike(anchored(name_regex)))
    for name, op, value in matchers or []:
        if "labels" in df.columns:
            got = F.coalesce(F.try_element_at(F.col("labels"), F.lit(name)), F.lit(""))
        else:
            got = label(name)
        test = {
            "=": lambda: got == value,
            "!=": lambda: got != value,
            "=~": lambda: got.rlike(anchored(value)),
            "!~": lambda: ~got.rlike(anchored(value)),
        }[op]()
        df = df.where(test)
    return df


_UNITS = {"ms": 10**3, "s": 10**6, "m": 60 * 10**6, "h": 3600 * 10**6, "d": 86400 * 10**6}


def duration_us(text: str) -> int:
    """``"1m"``, ``"30s"``, ``"2d"`` to microseconds."""
    m = re.fullmatch(r"(\d+)(ms|s|m|h|d)", text.strip())
    if not m:
        raise ValueError(f"bad duration: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def _grid(window: str, step: str) -> tuple[int, int, int]:
    """Window, step and their common pane, in microseconds."""
    w, s = duration_us(window), duration_us(step)
    if w <= 0 or s <= 0:
        raise ValueError("window and step must be positive")
    return w, s, math.gcd(w, s)


def _chunk(pane: int, chunk: str | None) -> int:
    """The largest chunk up to a minute (or ``chunk``) that divides the pane."""
    limit = duration_us(chunk) if chunk else _UNITS["m"]
    return pane // next(k for k in range(max(1, -(-pane // limit)), pane + 1) if pane % k == 0)


def _slot(t: Column, size: int) -> Column:
    """Floor division in integers, so that slot edges are exact."""
    return F.call_function("div", t - F.pmod(t, F.lit(size)), F.lit(size))


def _ends(low: Column, high: Column, s: int) -> Column:
    """Multiples of ``s`` from ``low`` to ``high``, one row each."""
    first, last = _slot(low + F.lit(s - 1), s), _slot(high, s)
    return F.explode(F.when(first <= last, F.transform(F.sequence(first, last), lambda k: k * F.lit(s))))


def _last_pane(panes: DataFrame, columns: list[str], pane: int, w: int, s: int) -> DataFrame:
    """For each end on the grid the newest pane of its window: ``_e`` and ``columns``.

    A pane answers for the ends from its own up to the next pane, so each end is made once however many panes its
    window spans. The panes are dealt anew first, for the ends of one series are many.
    """
    along = Window.partitionBy(*SERIES).orderBy("_p")
    rows = panes.withColumn("_next", F.lead("_p").over(along)).repartition(*SERIES, "_p")
    high = F.least(F.col("_next") * F.lit(pane), F.col("_p") * F.lit(pane) + F.lit(w))
    return rows.select(*SERIES, *columns, _ends((F.col("_p") + 1) * F.lit(pane), high, s).alias("_e"))


def _first_pane(panes: DataFrame, columns: list[str], pane: int, w: int, s: int) -> DataFrame:
    """For each end on the grid the oldest pane of its window."""
    along = Window.partitionBy(*SERIES).orderBy("_p")
    rows = panes.withColumn("_before", F.lag("_p").over(along)).repartition(*SERIES, "_p")
    low = F.greatest((F.col("_p") + 1) * F.lit(pane), (F.col("_before") + 1) * F.lit(pane) + F.lit(w))
    return rows.select(*SERIES, *columns, _ends(low, F.col("_p") * F.lit(pane) + F.lit(w), s).alias("_e"))


def _bounds(df: DataFrame, ts: str, start, end, w: int) -> tuple[DataFrame, Column]:
    """The samples that a grid from ``start`` to ``end`` can need, and its origin in microseconds."""
    if start is not None:
        df = df.where(F.col(ts) >= F.timestamp_micros(epoch_us(F.lit(start).cast("timestamp")) - F.lit(w)).cast(df.schema[ts].dataType))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end).cast(df.schema[ts].dataType))
    return df, F.lit(0) if start is None else epoch_us(F.lit(start).cast("timestamp"))


def _on_grid(out: DataFrame, origin: Column, start, end) -> DataFrame:
    out = out.withColumn("step", F.timestamp_micros(F.col("_e") + origin))
    if start is not None:
        out = out.where(F.col("step") >= F.lit(start).cast("timestamp"))
    if end is not None:
        out = out.where(F.col("step") <= F.lit(end).cast("timestamp"))
    return out.select(*SERIES, "step", "value")


def _samples(df: DataFrame, ts: str, value: str) -> DataFrame:
    df = with_series_key(df).where(F.col(value).isNotNull() & F.col(ts).isNotNull())
    return df.select(*SERIES, epoch_us(ts).alias("_t"), F.col(value).cast("double").alias("_v"))


def as_counter(
    df: DataFrame,
    metric: str,
    labels: dict[str, Column],
    ts: str = "ts",
    increment: Column | None = None,
    tie: str | None = None,
    chunk: str = "1m",
) -> DataFrame:
    """Samples of a running total per label set, one per row of ``df``.

    Totals run inside a time chunk, then chunk totals run per series, so a series
    that holds most of the rows is spread over its chunks. Fractions are summed as
    decimals with six places: a total must never fall by rounding.
    """
    size = duration_us(chunk)
    order = ["_t", *(["_tie"] if tie else [])]
    inc = F.lit(1) if increment is None else increment
    whole = df.select(inc.alias("_i")).schema["_i"].dataType.typeName() in ("byte", "short", "integer", "long")
    inc = inc.cast("bigint" if whole else "decimal(28,6)")
    rows = df.select(
        F.lit(metric).alias("metric"),
        label_key(labels).alias("series_key"),
        epoch_us(ts).alias("_t"),
        *([F.col(tie).alias("_tie")] if tie else []),
        inc.alias("_inc"),
    ).withColumn("_c", _slot(F.col("_t"), size))
    inside = Window.partitionBy(*SERIES, "_c").orderBy(*order)
    local = rows.withColumn("_run", F.sum("_inc").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy(*SERIES).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.groupBy(*SERIES, "_c")
        .agg(F.sum("_inc").alias("_total"))
        .select(*SERIES, "_c", F.sum("_total").over(before).alias("_base"))
    )
    return local.join(totals, [*SERIES, "_c"]).select(
        *SERIES,
        F.from_json("series_key", LABELS_TYPE).alias("labels"),
        F.timestamp_micros("_t").alias("ts"),
        F.coalesce(F.col("_base") + F.col("_run"), F.col("_run")).cast("double").alias("value"),
    )


def _reset_delta(value: Column, prev: Column) -> Column:
    """Growth since ``prev``; a fall means that the counter restarted from zero."""
    return F.when(value >= prev, value - prev).otherwise(value)


def rate(
    df: DataFrame,
    window: str,
    step: str,
    ts: str = "ts",
    value: str = "value",
    chunk: str | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """Per-second growth of counters over trailing windows, aware of resets.

    Windows are ``[end - window, end)``. At least two samples are needed; the
    growth between the first and the last of them is divided by their distance.
    There is no extrapolation to the window edges. ``start`` and ``end`` bound
    the grid (both inclusive), and its ends then count from ``start``.

    Growth runs along the panes of a series, so a window is the difference of
    two running totals, however long it is and however small the step.
    """
    w, s, pane = _grid(window, step)
    size = _chunk(pane, chunk)
    df, origin = _bounds(df, ts, start, end, w)
    rows = _samples(df, ts, value).withColumn("_t", F.col("_t") - origin).withColumn("_c", _slot(F.col("_t"), size))

    # 1. within a chunk: growth between neighbours, one shuffle of the raw rows
    inside = Window.partitionBy(*SERIES, "_c").orderBy("_t", "_v")
    chunks = (
        rows.withColumn("_next", F.lead("_t").over(inside))
        .where(F.col("_next").isNull() | (F.col("_next") != F.col("_t")))  # repeated report: keep the largest
        .withColumn("_prev", F.lag("_v").over(inside))
        .withColumn("_d", F.when(F.col("_prev").isNotNull(), _reset_delta(F.col("_v"), F.col("_prev"))))
        .groupBy(*SERIES, "_c")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.coalesce(F.sum("_d"), F.lit(0.0)).alias("_inner"),
            F.min("_t").alias("_t0"),
            F.max("_t").alias("_t1"),
            F.min_by("_v", "_t").alias("_v0"),
            F.max_by("_v", "_t").alias("_v1"),
        )
    )

    # 2. between chunks of a series: growth into the first sample of each chunk
    along = Window.partitionBy(*SERIES).orderBy("_c")
    prev = F.lag("_v1").over(along)
    panes = (
        chunks.withColumn("_lead", F.when(prev.isNotNull(), _reset_delta(F.col("_v0"), prev)).otherwise(F.lit(0.0)))
        .withColumn("_p", _slot(F.col("_c"), pane // size))
        .groupBy(*SERIES, "_p")
        .agg(
            F.sum("_n").alias("_n"),
            F.sum(F.col("_inner") + F.col("_lead")).alias("_sum"),
            F.min_by("_lead", "_c").alias("_lead"),
            F.min("_t0").alias("_t0"),
            F.max("_t1").alias("_t1"),
        )
    )

    # 3. running totals along the panes; a window lies between its oldest and its newest pane
    upto = Window.partitionBy(*SERIES).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    total, count = F.sum("_sum").over(upto), F.sum("_n").over(upto)
    panes = panes.select(
        *SERIES, "_p", "_t0", "_t1", total.alias("_at_end"), (total - F.col("_sum") + F.col("_lead")).alias("_at_start"),
        count.alias("_n_end"), (count - F.col("_n")).alias("_n_start"),
    )
    newest = _last_pane(panes, ["_t1", "_at_end", "_n_end"], pane, w, s)
    oldest = _first_pane(panes, ["_t0", "_at_start", "_n_start"], pane, w, s)
    seconds = (F.col("_t1") - F.col("_t0")) / F.lit(1e6)
    out = newest.join(oldest, [*SERIES, "_e"]).where(F.col("_n_end") - F.col("_n_start") >= 2)
    return _on_grid(out.withColumn("value", F.try_divide(F.col("_at_end") - F.col("_at_start"), seconds)), origin, start, end)


def gauge_range(
    df: DataFrame,
    step: str,
    lookback: str = "5m",
    start=None,
    end=None,
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Newest sample per series in ``(step - lookback, step]`` on a step grid.

    ``start`` and ``end`` bound the grid (both inclusive), prune the samples, and ends count from ``start``.
    """
    w, s, pane = _grid(lookback, step)
    df, origin = _bounds(df, ts, start, end, w)
    # one microsecond less turns the closed end of the window into the open end of a pane
    rows = _samples(df, ts, value).withColumn("_t", F.col("_t") - origin - 1)
    panes = rows.groupBy(*SERIES, _slot(F.col("_t"), pane).alias("_p")).agg(F.max_by("_v", "_t").alias("value"))
    return _on_grid(_last_pane(panes, ["value"], pane, w, s), origin, start, end)


def instant(df: DataFrame, at, lookback: str = "5m", ts: str = "ts", value: str = "value") -> DataFrame:
    """Newest sample per series in ``(at - lookback, at]``; ``step`` is ``at``.

    ``at`` is a time, a column or a one-row one-column DataFrame.
    """
    at = at.scalar() if isinstance(at, DataFrame) else at if isinstance(at, Column) else F.lit(at)
    at = at.cast("timestamp")
    dtype = df.schema[ts].dataType
    low = F.timestamp_micros(F.unix_micros(at) - F.lit(duration_us(lookback)))
    near = df.where((F.col(ts) > low.cast(dtype)) & (F.col(ts) <= at.cast(dtype)))
    return (
        _samples(near, ts, value)
        .groupBy(*SERIES)
        .agg(F.max_by("_v", "_t").alias("value"))
        .select(*SERIES, at.alias("step"), "value")
    )


def scale(df: DataFrame, k: float) -> DataFrame:
    return df.withColumn("value", F.col("value") * F.lit(float(k)))


# ---- aggregation by labels


def with_labels(df: DataFrame, names: list[str]) -> DataFrame:
    """Labels as columns; a column that is already there stays."""
    have = set(df.columns)
    return df.withColumns({n: label(n) for n in names if n not in have})


def agg_by(df: DataFrame, fn: str, labels: list[str] | None = None) -> DataFrame:
    """``sum``, ``max`` or ``count`` per step and label values (per step without labels)."""
    labels = labels or []
    agg = {
        "sum": lambda: F.sum("value"),
        "max": lambda: F.max("value"),
        "count": lambda: F.count(F.lit(1)),
    }[fn]()
    return with_labels(df, labels).groupBy("step", *labels).agg(agg.alias("value"))


def sum_of_max(df: DataFrame, inner: list[str], outer: list[str]) -> DataFrame:
    """One value per inner label set (largest report), then totals per outer label set."""
    return agg_by(agg_by(df, "max", inner), "sum", outer)


# ---- vector matching


def _match_columns(df: DataFrame, on: list[str] | None) -> tuple[DataFrame, list[str]]:
    labels = [c for c in df.columns if c not in ("metric", "step", "value")]
    if on is not None:
        return with_labels(df, on), ["step", *on]
    return df, ["step", *labels]


def _one_per_match(df: DataFrame, keys: list[str], side: str) -> DataFrame:
    """Fail on a second row per match key instead of multiplying rows in the join."""
    many = F.raise_error(F.lit(f"several {side} series for one match key")).cast("double")
    return df.groupBy(*keys).agg(F.when(F.count(F.lit(1)) > 1, many).otherwise(F.max("value")).alias("value"))


_OPS = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "/": F.try_divide,
}


def binary_op(left: DataFrame, right: DataFrame, op: str, on: list[str] | None = None) -> DataFrame:
    """One-to-one arithmetic of two vectors with equal labels; division by zero gives null."""
    left, keys = _match_columns(left, on)
    right, right_keys = _match_columns(right, on)
    if set(keys) != set(right_keys):
        raise ValueError(f"label columns differ: {keys} and {right_keys}")
    a = _one_per_match(left, keys, "left").withColumnRenamed("value", "_a")
    b = _one_per_match(right, keys, "right").withColumnRenamed("value", "_b")
    return a.join(b, keys).select(*keys, _OPS[op](F.col("_a"), F.col("_b")).alias("value"))


def ratio(num: DataFrame, den: DataFrame) -> DataFrame:
    """Quotient of two totals that have no labels left."""
    return binary_op(num, den, "/", on=[])


def vector_or(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` plus rows of ``b`` whose labels are not in ``a``."""
    keys = [c for c in a.columns if c not in ("metric", "value")]
    only_b = b.join(a.select(*keys).distinct(), keys, "left_anti")
    return a.unionByName(only_b.select(*a.columns))


# ---- consumer lag


GROUP = "consumer_group"


def committed_offsets(commits: DataFrame) -> DataFrame:
    return agg_by(commits, "max", [GROUP, "topic", "partition"])


def log_end_offsets(ends: DataFrame) -> DataFrame:
    return agg_by(ends, "max", ["topic", "partition"])


def consumer_lag(commits: DataFrame, ends: DataFrame, by_partition: bool = False) -> DataFrame:
    """Log end minus committed offset.

    Per topic the totals are subtracted, so partitions that a group never
    committed count fully; per partition they have no match and drop out.
    """
    keys = ["step", "topic"] + (["partition"] if by_partition else [])
    a, b = committed_offsets(commits), log_end_offsets(ends)
    if not by_partition:
        a, b = agg_by(a, "sum", [GROUP, "topic"]), agg_by(b, "sum", ["topic"])
    return (
        a.withColumnRenamed("value", "_a")
        .join(b.withColumnRenamed("value", "_b"), keys)
        .select("step", GROUP, *keys[1:], (F.col("_b") - F.col("_a")).alias("value"))
    )


def consume_statistics(commits: DataFrame, ends: DataFrame) -> DataFrame:
    """Lag table: outer merge on topic, then only the rows that have a group."""
    a = agg_by(committed_offsets(commits), "sum", [GROUP, "topic"]).withColumnRenamed("value", "committed")
    b = agg_by(log_end_offsets(ends), "sum", ["topic"]).withColumnRenamed("value", "end_offset")
    return (
        a.join(b, ["step", "topic"], "full_outer")
        .where(F.col(GROUP).isNotNull())
        .select("step", "topic", GROUP, "committed", "end_offset", (F.col("end_offset") - F.col("committed")).alias("lag"))
    )


def consumer_throughput(commits: DataFrame, window: str, step: str, by_partition: bool = False) -> DataFrame:
    """Committed messages per second per group and topic (or partition)."""
    r = rate(commits, window, step)
    if by_partition:
        return agg_by(r, "sum", [GROUP, "topic", "partition"])
    return sum_of_max(r, [GROUP, "topic", "partition"], [GROUP, "topic"])


def catch_up(lag: DataFrame, stopped_at, end_offsets: DataFrame | None = None, ts: str = "step", value: str = "value") -> DataFrame:
    """After a consumer stop: largest backlog, first step without lag, and whether the log kept growing.

    ``end_offsets`` (``step``, ``value``) gives the growth of the log between
    the stop and the recovery.
    """
    at = F.lit(stopped_at).cast(lag.schema[ts].dataType)
    after = lag.where(F.col(ts) >= at)
    out = after.agg(
        F.max(value).alias("peak_lag"),
        F.min(F.when(F.col(value) <= 0, F.col(ts))).alias("recovered_at"),
    )
    if end_offsets is not None:
        grown = end_offsets.where(F.col(ts) >= at).agg((F.max_by(value, ts) - F.min_by(value, ts)).alias("log_growth"))
        out = out.select("*", grown.scalar().alias("log_growth"))
    return out


# ---- histograms


def to_histogram(df: DataFrame, value: str, bounds: list[float], by: list[str] | None = None) -> DataFrame:
    """Cumulative bucket rows (``le``, ``bucket``) with ``sum`` and ``count`` from raw values.

    One pass with a conditional count per bound; rows unfold after aggregation.
    """
    by = by or []
    v = F.col(value)
    les = sorted(float(b) for b in bounds) + [math.inf]
    counts = [F.count_if(v <= b).alias(f"_b{i}") for i, b in enumerate(les[:-1])]
    out = df.where(v.isNotNull()).groupBy(*by).agg(*counts, F.sum(v).alias("sum"), F.count(v).alias("count"))
    columns = [F.col(f"_b{i}") for i in range(len(les) - 1)] + [F.col("count")]
    pairs = F.array(*[F.struct(F.lit(le).alias("le"), c.alias("bucket")) for le, c in zip(les, columns)])
    return out.select(*by, F.explode(pairs).alias("_p"), "sum", "count").select(
        *by, "_p.le", "_p.bucket", "sum", "count"
    )


def bucket_bound(col: Column | str = "le") -> Column:
    """The ``le`` label as a number; ``+Inf`` is infinity."""
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string")
    return F.when(text.isin("+Inf", "Inf", "Infinity", "inf"), F.lit(math.inf)).otherwise(text.try_cast("double"))


def histogram_quantile(df: DataFrame, phi: float | list[float], by: list[str] | None = None, le: str = "le", value: str = "value") -> DataFrame:
    """Quantiles from cumulative buckets, one row per group and ``phi``.

    The bucket is the first whose count reaches ``phi`` times the total; inside
    it the position is linear from the bound below (0 for the first). The
    infinite bucket yields the largest finite bound, and an empty histogram null.
    ``by`` names the columns that identify a histogram, ``step`` included.
    """
    by = list(by or [])
    phis = [phi] if isinstance(phi, (int, float)) else list(phi)
    buckets = df.groupBy(*by, bucket_bound(le).alias("_le")).agg(F.sum(value).alias("_c"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    total = F.max(F.when(F.col("_le") == math.inf, F.col("_c"))).over(group)
    ranked = (
        buckets.withColumn("_total", total)
        .withColumn("phi", F.explode(F.array(*[F.lit(float(p)) for p in phis])))
        .withColumn("_rank", F.col("phi") * F.col("_total"))
    )
    reached = F.col("_c") >= F.col("_rank")
    hit = F.min(F.when(reached, F.struct("_le", "_c")))
    finite = F.max(F.when(F.col("_le") < math.inf, F.col("_le")))
    below = F.max(F.when(~reached, F.struct("_le", "_c")))
    found = ranked.groupBy(*by, "phi").agg(
        F.max("_rank").alias("_rank"),
        F.max("_total").alias("_total"),
        hit.alias("_hit"),
        below.alias("_below"),
        finite.alias("_finite"),
    )
    hi, lo = F.col("_hit._le"), F.coalesce(F.col("_below._le"), F.lit(0.0))
    prev = F.coalesce(F.col("_below._c").cast("double"), F.lit(0.0))
    inside = lo + (hi - lo) * F.try_divide(F.col("_rank") - prev, F.col("_hit._c") - prev)
    return found.select(
        *by,
        "phi",
        F.when(F.col("_total") > 0, F.when(hi == math.inf, F.col("_finite")).otherwise(inside)).alias("value"),
    )


def slo_violations(df: DataFrame, value: str, limit: float, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(F.col(value) > limit).alias("violations"))


# ---- catalogue of series


def label_values(
    df: DataFrame,
    metric: str | None,
    name: str,
    matchers: list[tuple[str, str, str]] | None = None,
    name_regex: str | None = None,
) -> DataFrame:
    """Distinct non-empty values of a label."""
    sel = select_series(df, metric, matchers, name_regex)
    got = F.try_element_at(F.col("labels"), F.lit(name)) if "labels" in sel.columns else label(name)
    return sel.select(got.alias("label_value")).where((F.col("label_value") != "")).distinct()


def list_metrics(df: DataFrame, regex: str = "kafka_.*") -> DataFrame:
    """Distinct metric names that match, sorted."""
    return df.where(F.col("metric").rlike(anchored(regex))).select("metric").distinct().orderBy("metric")


def reduce_series(df: DataFrame, calcs: list[str], by: list[str] | None = None, order: str = "step") -> DataFrame:
    """Panel legend values: ``lastNotNull``, ``mean``, ``max`` per series."""
    v = F.col("value")
    made = {
        "lastNotNull": F.max_by(v, F.when(v.isNotNull(), F.col(order))).alias("last_not_null"),
        "mean": F.avg(v).alias("mean"),
        "max": F.max(v).alias("max"),
    }
    return df.groupBy(*(by or [])).agg(*[made[c] for c in calcs])
