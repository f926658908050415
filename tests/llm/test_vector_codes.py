"""Vector codes: the trie against plain distances, whole results against plain k-means rounds, edge rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, pos int, part string, codes int"


def plain(x: np.ndarray, e: np.ndarray):
    d = ((x[:, None, :] - e[None, :, :]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


def brute(rows: list, parts: int = 4, entries: int = 256, rounds: int = 4):
    use = [(i, lab, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, lab, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    use.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = len(use[0][2])
    same = np.array([r[2] for r in use if len(r[2]) == size])
    books = [b.copy() for b in np.split(same[:entries], parts, axis=1)]
    xs = np.split(same, parts, axis=1)
    for _ in range(rounds):
        for p in range(parts):
            near, _ = plain(xs[p], books[p])
            for e in set(near.tolist()):
                mine = xs[p][near == e]
                books[p][e] = [int(s) // len(mine) for s in mine.sum(0)]
    told = [plain(x, b) for x, b in zip(xs, books, strict=True)]
    codes = iter(["".join(f"{t[0][k]:02x}" for t in told) for k in range(len(same))])
    errors = iter([int(sum(t[1][k] for t in told)) for k in range(len(same))])
    out = [(i, lab, *((next(codes), next(errors)) if len(v) == size else (None, None))) for i, lab, v in use]
    sums = {lab: sum(r[3] or 0 for r in out if r[1] == lab) for _, lab, *_ in out}
    sha = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()
    return sorted(map(str, [(*r, sums[r[1]], sha) for r in out]))


def got(df, **more):
    return sorted(map(str, [tuple(r) for r in vc.compress(df, **more).select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256").collect()]))


@pytest.mark.parametrize("size,dims,spread", [(1, 4, 3), (300, 4, 2), (3000, 16, 400), (500, 1, 1000), (2000, 6, 3), (50, 5, 1 << 25)])
def test_trie_finds_the_nearest_entries(size, dims, spread):
    rng = np.random.default_rng(size)
    x = np.unique(rng.integers(-spread, spread + 1, (size, dims)), axis=0)
    e = rng.integers(-spread, spread + 1, (40, dims))
    e[7] = e[3]  # ties
    entry, error = vc.nearest(x, e)
    best, least = plain(x, e)
    assert (entry == best).all() and (error == least).all()
    assert len(vc.nearest(x[:0], e)[0]) == 0


def test_packed_parts_sort_like_integers():
    x = np.array([[-5, 3], [-5, -3], [0, 0], [1 << 25, -1], [-(1 << 25), 7]])
    packed = vc._packed(x)
    assert [tuple(x[i]) for i in sorted(range(5), key=lambda i: packed[i])] == sorted(map(tuple, x.tolist()))


def test_equals_plain_rounds(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 8)).astype(np.float32)
    x[::3] = x[4]  # a third of all rows are one vector
    rows = [(int(i), [float(v) for v in r], None if i % 11 == 0 else int(i % 4), 1, "x", 2) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df) == brute(rows)
    assert got(df, entries=7, parts=2) == brute(rows, parts=2, entries=7)


def test_rows_of_any_kind(spark):
    rows = [(i, [float(i % 5), -float(i), 0.5, 1.0], i % 2, 0, "", 0) for i in range(12)]
    rows += [rows[3], rows[3], (2, [9.0] * 4, 1, 0, "", 0), (None, [1.0] * 4, None, 0, "", 0), (20, None, 1, 0, "", 0), (21, [None] * 4, 1, 0, "", 0), (22, [float("nan")] * 4, 1, 0, "", 0), (23, [float("inf"), 0.0, 0.0, 0.0], 1, 0, "", 0)]
    rows += [(30, [1.0] * 8, 1, 0, "", 0), (31, [], 5, 0, "", 0)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == []
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1, 0, "", 0)], SCHEMA)
    assert [(r.code, r.error, r.label_error) for r in vc.compress(odd).collect()] == [(None, None, 0)]
    with pytest.raises(ValueError):
        vc.compress(odd, entries=257)


def test_sums_are_weighted_and_whole(spark):
    rows = [(i, [float(i % 3)] * 4, 1, 0, "", 0) for i in range(90)]
    coded = vc.coded(spark.createDataFrame(rows, SCHEMA), "vec_id", "label", "embedding", 1)
    distinct = vc.distinct_parts(coded, 2, 2)
    assert sorted((r.pos, r.n) for r in distinct.collect()) == [(p, 30) for p in range(2) for _ in range(3)]
    sums = vc.assigned_sums(distinct, [np.array([[0, 0], [2, 2]])] * 2, 2)
    assert sorted((r.pos, r.entry, r.n, tuple(r.sums)) for r in sums.collect()) == [(p, e, n, (s, s)) for p in range(2) for e, n, s in ((0, 60, 30), (1, 30, 60))]
