"""Hard negatives against brute force; the curve, exact products, windows that block skipping must not lose."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, block int, codes string, a int"


def brute(rows: list, anchor, positives: int = 5, negatives: int = 10) -> set:
    use = {(i, lab, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, lab, *_ in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for i, lab, v in use:
        if not anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, other) for j, other, w in use if len(w) == len(v))
        for ps, p in [(-s, j) for s, j, other in scored if other == lab and j != i][:positives]:
            hits = [(j, -s) for s, j, other in scored if other != lab and 30 * ps <= -100 * s <= 90 * ps][:negatives]
            out |= {(i, p, rank, j, ps, s) for rank, (j, s) in enumerate(hits, 1)}
    return out


def clustered(n: int, dims: int, seed: int) -> list:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    x = centres[rng.integers(0, 8, n)] + 0.3 * rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::9] = x[1]  # ties
    return [(i, [float(np.float32(y)) for y in v], int(rng.integers(0, 4)) if i % 3 else 1, 1, "c", 2) for i, v in enumerate(x)]


def odd_rows() -> list:
    rows = clustered(60, 8, 3)
    rows += [(100, None, 1, 0, "", 0), (110, [None] * 8, 1, 0, "", 0), (120, [float("nan")] * 8, 1, 0, "", 0), (130, [float("inf")] * 8, 1, 0, "", 0), (140, [0.5] * 8, None, 0, "", 0), (None, [0.5] * 8, 1, 0, "", 0)]
    rows += [rows[0], rows[0], rows[5], (150, [0.0] * 8, 2, 0, "", 0), (160, [0.25] * 3, 1, 0, "", 0), (161, [0.25] * 3, 1, 0, "", 0), (162, [0.125] * 3, 3, 0, "", 0), (170, [], 1, 0, "", 0), (171, [], 2, 0, "", 0), (172, [], 1, 0, "", 0), (180, [3e4] * 8, 1, 0, "", 0)]
    return rows


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hn.hilbert_keys(points, bits)
    assert len(set(keys)) == len(points)
    walk = points[sorted(range(len(points)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("size", [3, 1 << 11, 1 << 20, 1 << 28])
def test_products_are_exact(size):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-size, size, (5, 16)), rng.integers(-size, size, (7, 16))
    assert (hn.product(a, b) == [[sum(int(x) * int(y) for x, y in zip(r, c, strict=True)) for c in b] for r in a]).all()


def test_products_beyond_64_bits_raise():
    with pytest.raises(OverflowError):
        hn.product(np.full((1, 4), 1 << 40), np.full((1, 4), 1 << 40))


def test_equals_brute_force(spark):
    rows = clustered(400, 8, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = hn.mine(df, F.col("vec_id") % 10 == 0, block_rows=16)
    assert set(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0)


def test_rows_of_any_kind(spark):
    rows = odd_rows()
    got = hn.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, positives=3, negatives=4, block_rows=7).collect()
    assert len(set(map(tuple, got))) == len(got)
    assert set(map(tuple, got)) == brute(rows, lambda i: i % 10 == 0, 3, 4)
    assert hn.mine(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    assert hn.mine(spark.createDataFrame(rows, SCHEMA), F.lit(None).cast("boolean")).count() == 0


def test_small_cells_and_groups_give_the_same(spark):
    rows = clustered(300, 6, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * 256).cast("long"))
    blocks = hn.blocks_of(df.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), x.alias("codes"), (F.col("vec_id") % 5 == 0).alias("anchor")), 8, 4)
    asked = hn.anchors_of(blocks, 3).withColumns({"lows": F.array(F.lit(0).cast("long"), F.lit(9000).cast("long")), "highs": F.array(F.lit(20000).cast("long"), F.lit(40000).cast("long"))})
    few = hn.search(asked, blocks, False, 4, group_anchors=7, cell_blocks=3)
    many = hn.search(asked, blocks, False, 4)
    cols = ["a", "no", "id", "score", "rank"]
    assert sorted(map(tuple, few.select(cols).collect())) == sorted(map(tuple, many.select(cols).collect()))
    assert few.count() > 400


def test_blocks_out_of_every_window_are_not_read():
    rng = np.random.default_rng(5)
    x = np.array([[100, 0, 0]])
    near, far = rng.integers(90, 100, (20, 3)), rng.integers(-100, -50, (20, 3))
    w = hn.Windows(x, np.array([0]), np.array([[5000]]), np.array([[9999]]), 3)
    least, most = w.bounds(np.stack([near.min(0), far.min(0)]), np.stack([near.max(0), far.max(0)]))
    assert (least[0] <= [(x @ near.T).min(), (x @ far.T).min()]).all() and (most[0] >= [(x @ near.T).max(), (x @ far.T).max()]).all()
    assert len(w.wanting(least[:, 0], most[:, 0])) == 1 and w.wanting(least[:, 0], most[:, 0])[0] and not w.wanting(least[:, 1], most[:, 1])[0]
