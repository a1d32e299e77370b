"""Mining by zone maps against scoring all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclake.llm import hard_negatives


def brute(rows, step=5, positives=5, negatives=3):
    kept = {(i, y, tuple(math.floor(256 * x) for x in v)) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, y, q in kept:
        if i % step:
            continue
        others = [(-sum(a * b for a, b in zip(q, w)), j, z == y) for j, z, w in kept if j != i and len(w) == len(q)]
        for p, j, _ in sorted(o for o in others if o[2])[:positives]:
            hard = sorted((n, m) for n, m, same in others if not same and 50 * -p <= 100 * -n <= 95 * -p)[:negatives]
            out += [(i, j, r + 1, m, -p, -n) for r, (n, m) in enumerate(hard)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 AS id", "2 AS q", "3 AS dims", "4 AS v", "5 AS asks")
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 5 == 0, **options).collect()))


def vectors(rng, n, dims, centres=0):
    v = rng.normal(size=(n, dims)) if not centres else rng.normal(size=(centres, dims))[rng.integers(0, centres, n)] + rng.normal(size=(n, dims)) * 0.2
    return np.float32(v).tolist()


def test_curve_visits_neighbours():
    side = np.arange(8)
    for dims in (2, 3):
        cells = np.stack(np.meshgrid(*[side] * dims), -1).reshape(-1, dims)
        keys = [k.tobytes() for k in hard_negatives.hilbert_keys(cells, 3)]
        assert len(set(keys)) == 8**dims
        walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, block = rng.integers(-300, 300, (50, 16)), rng.integers(-300, 300, (40, 16))
    least, most = hard_negatives.bounds(q, block.min(0), block.max(0))
    scores = hard_negatives.products(q, block)
    assert (scores == q @ block.T).all() and (least <= scores.min(1)).all() and (scores.max(1) <= most).all()


def test_products_are_exact():
    a = np.array([[2**30, 3], [-(2**30), 5]])
    assert hard_negatives.products(a, a).tolist() == [[int(x) for x in row] for row in a.astype(object) @ a.T.astype(object)]
    with pytest.raises(OverflowError):
        hard_negatives.products(a * 8, a)


@pytest.mark.parametrize("options", [{}, {"block_rows": 16}, {"block_rows": 7, "batch_components": 500}])
def test_mining(spark, options):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 4)), v) for i, v in enumerate(vectors(rng, 200, 8, 6))]
    rows += [(300 + i, 1, rows[5][2]) for i in range(60)] + [(400 + i, 2, rows[5][2]) for i in range(20)]  # equal vectors: ties
    rows += [rows[10], rows[10], (500, None, rows[3][2]), (None, 1, rows[3][2]), (505, 1, None), (510, 1, [1.0, None]), (515, 1, [float("nan")] * 8), (520, 1, [float("inf")] * 8)]
    rows += [(525, 1, []), (530, 2, []), (535, 1, [0.0] * 8), (540, 3, [1.0, 2.0]), (541, 3, [2.0, 2.0]), (542, 2, [2.0, 1.0]), (20, 3, rows[7][2])]
    got = found(spark, rows, **options)
    assert got == brute(rows) and len(got) > 300


def test_far_blocks_are_not_read(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, np.float32(np.eye(6)[i % 6] * 10 * (-1) ** (i // 6 % 2) + rng.normal(size=6) * 0.1).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    whole = df.select(F.col("vec_id").alias("id"), "label", (F.col("vec_id") % 50 == 0).alias("asks"), F.transform("embedding", lambda x: F.floor(x * 256)).alias("q"), F.lit(6).alias("dims"))
    blocks = hard_negatives._blocks(whole, 16)
    asked = hard_negatives._askers(blocks, 5).withColumn("no", F.col("id")).toArrow()
    need = hard_negatives.Batch(asked, 6, 5, True)
    share = np.mean([len(need.needing(r.asDict())) / asked.num_rows for r in blocks.collect()])
    assert share < 0.3
    assert found(spark, rows, block_rows=16) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
