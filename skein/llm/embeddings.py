"""Near-duplicate vectors by spherical-cap filters over structured random product codes."""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.links import components
from skein.session import materialize

#: Rows of a bucket that one task compares with one another; larger buckets are cut into pairs of such blocks.
BLOCK = 2048
#: Rows of a tile of products; links per row of a group from which its filters are compared as matrices.
TILE, DENSE = 512, 2
#: Rows that a filter should find by chance in the largest label, at most; the chance of a pair at the threshold to share no filter.
BUCKET, MISSED = 256, 1e-5


def sized(n: int, threshold: float, cap: float = 3.0, words: int = 128) -> tuple[float, int]:
    """(cap, codewords per half) for n vectors of one label.

    A filter finds a vector by chance with probability Q(cap). Up to
    BUCKET / Q(cap) vectors the given code is right; beyond, cap rises so that a
    bucket keeps BUCKET rows whatever n is, and the code grows so that a pair at
    the threshold still shares a filter but for a chance of MISSED: given that
    one passes, the other does with probability q, so a vector needs
    log(MISSED) / log(1 - q) filters.
    """
    normal = NormalDist()
    if n * (1 - normal.cdf(cap)) <= BUCKET:
        return cap, words
    p = BUCKET / n
    cap = normal.inv_cdf(1 - p)
    q = 1 - normal.cdf((cap - threshold * (cap + 1 / cap)) / np.sqrt(1 - threshold**2))
    return cap, max(words, int(np.ceil(np.sqrt(np.log(MISSED) / np.log(1 - q) / p))))


class ProductFilters:
    """Filter directions (u_i, w_j)/sqrt(2): every pair of codewords of two random spherical codes.

    A vector passes the filters whose inner product with it reaches
    cap/sqrt(dimension). They are list-decoded: a codeword of one half can only
    matter if it and the best of the other half reach the cap together, so the
    two short lists are combined and no other direction is looked at. A vector
    with fewer than `least` filters takes its best ones. A random rotation comes
    first: without it a vector whose weight lies in one half would reach no
    filter. Vectors of fewer than 8 dimensions have no code worth the name and
    all take one filter.
    """

    def __init__(self, dim: int, words: int = 128, cap: float = 3.0, least: int = 8, seed: int = 3):
        self.dim, self.words, self.least, self.half = dim, words, least, dim // 2
        rng = np.random.default_rng([seed, dim, words])
        codes = [rng.normal(size=(n, words)) for n in (self.half, dim - self.half)]
        self.codes = [c / np.linalg.norm(c, axis=0) for c in codes] if self.half >= 4 else None
        self.cap = cap / np.sqrt(dim) * np.sqrt(2)
        self.turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0] if self.codes is not None else None

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """The sorted filter numbers of each unit vector."""
        if self.codes is None:
            return [np.zeros(1, np.int64)] * len(unit)
        unit = unit @ self.turn
        a, b, out = unit[:, : self.half] @ self.codes[0], unit[:, self.half :] @ self.codes[1], []
        for x, y in zip(a, b, strict=True):
            i, j = np.flatnonzero(x >= self.cap - y.max()), np.flatnonzero(y >= self.cap - x.max())
            p, q = np.nonzero(x[i][:, None] + y[j][None] >= self.cap)
            found = i[p] * self.words + j[q]
            if len(found) < self.least:
                found = np.argpartition(-(x[:, None] + y[None]).ravel(), self.least)[: self.least]
            out.append(np.sort(found))
        return out


def _spread(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Smallest reachable position for every position, in place."""
    while True:
        low = np.minimum(roots[a], roots[b])
        before = roots.copy()
        np.minimum.at(roots, a, low)
        np.minimum.at(roots, b, low)
        roots[:] = roots[roots]
        if (roots == before).all():
            return


def near_vectors(vectors: DataFrame, threshold: float = 0.93, words: int | None = None, cap: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept): near-duplicate vectors within a label.

    Two vectors of one length and one label that is not null link when their
    cosine in double precision is at least threshold and they pass a common
    filter. n_links counts the other rows linked directly; component_id is the
    smallest id that links reach; kept marks that row. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do
    rows without an id (their component_id is null, kept false). Equal vectors
    are one class with a row count, so copies are not compared. A pair that
    meets under several filters counts under the first; counts and a spanning
    forest leave a task, never the pairs. Rows with one id are one node. The
    code is sized by the largest label (see sized) unless cap and words say so.
    """
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind, dtype = ("float", np.float32) if element == "float" else ("double", np.float64)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast(f"array<{kind}>").alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                x = None
                if doc is not None and label is not None and v.is_valid and len(v) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(dtype) + dtype(0)
                    y = x.astype(np.float64)
                    if not np.isfinite(y).all() or not 0 < float(y @ y) < np.inf:
                        x = None
                out.append(None if x is None else x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["id", "label", "v"])

    rows = materialize(rows.mapInArrow(packed, "id long, label string, v binary").withColumn("h", F.xxhash64("label", "v")), "vectors")
    classes = rows.where("v IS NOT NULL").groupBy("h", "label", "v").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    if cap is None or words is None:
        cap, words = sized(classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0, threshold)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, ProductFilters] = {}
        for batch in batches:
            raw = batch.column("v").to_pylist()
            found: list = [None] * len(raw)
            sizes = np.array([len(x) for x in raw], np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = np.frombuffer(b"".join(raw[i] for i in at), dtype).reshape(len(at), -1).astype(np.float64)
                made = filters.setdefault(x.shape[1], ProductFilters(x.shape[1], words, cap))
                for i, f in zip(at, made.decode(x / np.linalg.norm(x, axis=1, keepdims=True)), strict=True):
                    found[i] = f
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in ("h", "label", "v", "first", "n")] + [pa.array(found, pa.list_(pa.int64()))], ["h", "label", "v", "first", "n", "filters"])

    classes = classes.mapInArrow(decoded, "h long, label string, v binary, first long, n long, filters array<long>")
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    entries = classes.select("rep", "n", "v", "filters", F.explode("filters").alias("filter"), "label")
    entries = entries.withColumn("bucket", F.xxhash64("label", F.octet_length("v"), "filter")).drop("label")
    large = entries.groupBy("bucket").count().where(F.col("count") > BLOCK).select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    entries = entries.join(large, "bucket", "left").withColumn("block", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("rep"), F.col("blocks"))).cast("int"))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    entries = entries.withColumn("other", other).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    entries = entries.select("bucket", "low", "high", "block", "filter", "rep", "n", "v", "filters").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "rep")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            key = np.stack([t.column(n).to_numpy() for n in ("bucket", "low", "high")], 1)
            cut = int(np.flatnonzero((key != key[-1]).any(1))[-1]) + 1 if (key != key[-1]).any() else 0
            held = t.slice(cut)  # the last group may go on
            if cut:
                yield _compare(t.slice(0, cut), dtype, threshold)
        if held is not None and held.num_rows:
            yield _compare(held, dtype, threshold)

    found = materialize(entries.mapInArrow(verified, "rep long, links long, root long"), "links")
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    several = rows.where("v IS NOT NULL").select("id", "h", "label", "v").distinct().groupBy("id").count().where("count > 1").select("id")
    tied = rows.join(several, "id", "left_semi").join(classes.select("h", "label", "v", "rep"), ["h", "label", "v"]).select("id", "rep")  # an id on several vectors ties their classes
    tied = tied.join(tied.groupBy("id").agg(F.min("rep").alias("a")), "id").select("a", F.col("rep").alias("b"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(tied))
    known = classes.select("h", "label", "v", "rep", "first", "n").join(degree, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("part", F.coalesce("component", "rep")).drop("component")
    known = known.join(known.groupBy("part").agg(F.min("first").alias("component")), "part")
    known = known.select(F.col("h").alias("kh"), F.col("label").alias("kl"), F.col("v").alias("kv"), F.coalesce("links", F.lit(0)).alias("links"), "n", "component")
    out = rows.join(known, (F.col("h") == F.col("kh")) & (F.col("label") == F.col("kl")) & (F.col("v") == F.col("kv")), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _compare(t: pa.Table, dtype: type, threshold: float) -> pa.RecordBatch:
    """Links of whole groups: per class the rows linked to it, and the least class that the links here reach."""
    key = np.stack([t.column(n).to_numpy() for n in ("bucket", "low", "high")], 1)
    group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(1))])
    block, at_filter, rep, weight = (t.column(n).to_numpy() for n in ("block", "filter", "rep", "n"))
    raw = t.column("v").to_pylist()
    lists = t.column("filters").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else lists.chunk(0)
    off = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()
    wide = int(np.diff(off).max(initial=0))
    names = np.full((len(rep), wide), -1, np.int64)
    names[np.repeat(np.arange(len(rep)), np.diff(off)), np.arange(off[0], off[-1]) - np.repeat(off[:-1], np.diff(off))] = flat[off[0] : off[-1]]
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    end = np.append(begin[1:], len(rep))
    ids, who = np.unique(rep, return_inverse=True)
    links, roots = np.zeros(len(ids), np.int64), np.arange(len(ids))
    unit = np.empty(len(rep), object)
    sizes = np.array([len(x) for x in raw])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = np.frombuffer(b"".join(raw[i] for i in at), dtype).reshape(len(at), -1).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for lo in range(0, len(at), 1 << 16):
            unit[at[lo : lo + (1 << 16)]] = list(x[lo : lo + (1 << 16)])
    pairs_a, pairs_b = [], []
    for lo, hi in zip(begin, end, strict=True):
        if hi - lo < 2:
            continue
        x = np.stack(unit[lo:hi])
        before = None
        for i in range(0, hi - lo, TILE):
            near = x[i : i + TILE] @ x[i:].T >= threshold
            near[:, :TILE] &= np.tri(len(near), min(TILE, near.shape[1]), 0, bool) ^ True  # each pair once
            if key[lo, 1] != key[lo, 2]:
                near &= block[lo + i : lo + i + len(near)][:, None] != block[lo + i : hi][None]
            if near.sum() > DENSE * (hi - lo):
                # a dense group: all at once, whether two rows share a filter before this one
                if before is None:
                    names_, earlier = np.unique(np.concatenate([[-1], *[flat[off[r] : off[r + 1]][flat[off[r] : off[r + 1]] < at_filter[r]] for r in range(lo, hi)]]), return_inverse=True)
                    before = np.zeros((hi - lo, len(names_)), np.float32)
                    owner = np.repeat(np.arange(hi - lo), [int(np.searchsorted(flat[off[r] : off[r + 1]], at_filter[r])) for r in range(lo, hi)])
                    before[owner, earlier[1:]] = 1
                near &= before[i : i + TILE] @ before[i:].T < 0.5
                links[who[lo + i : lo + i + len(near)]] += near @ weight[lo + i : hi]  # a class is in a group once
                links[who[lo + i : hi]] += near.T @ weight[lo + i : lo + i + len(near)]
                a, b = np.nonzero(near)
                _spread(roots, who[lo + i + a], who[lo + i + b])
                continue
            a, b = np.nonzero(near)
            if len(a):
                pairs_a.append(a + lo + i)
                pairs_b.append(b + lo + i)
    if pairs_a:
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        for i in range(0, len(a), 2048):
            p, q = a[i : i + 2048], b[i : i + 2048]
            x, y = names[p], names[q]
            same = (x[:, :, None] == y[:, None, :]) & (x[:, :, None] >= 0) & (x[:, :, None] < at_filter[p][:, None, None])
            first = ~same.any((1, 2))
            p, q = who[p[first]], who[q[first]]
            np.add.at(links, p, weight[b[i : i + 2048][first]])
            np.add.at(links, q, weight[a[i : i + 2048][first]])
            _spread(roots, p, q)
    seen = links > 0
    return pa.RecordBatch.from_arrays([pa.array(ids[seen]), pa.array(links[seen]), pa.array(ids[roots[seen]])], ["rep", "links", "root"])
