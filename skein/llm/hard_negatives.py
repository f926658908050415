"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Integer vectors are sorted by label and by their place on a Hilbert curve and
written as Parquet, one row a block of at most `block_rows` vectors of one
label, beside the block's least and greatest component in every dimension (its
zone map). For an anchor a and a block, interval arithmetic over the zone map
gives the least and greatest inner product that any of its rows can have. An
anchor reads a block only where that interval meets one of its windows, and,
while it reads, only where the block can still beat what the window holds.

A window is a range of scores of which the greatest k are wanted; both searches
are this one: positives (rows of the anchor's label, one window, from the k-th
best score in the anchor's own block up) and negatives (rows of other labels, a
window for each positive). Anchors meet blocks in cells of a grid, so a task
holds at most `group_anchors` anchors and `cell_blocks` blocks, whatever the
size of a label; what leaves a cell is k rows a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import materialize

NONE = np.iinfo(np.int64).min
#: Anchors that are compared with a block at once.
CHUNK = 256


def hilbert_keys(x: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of points with coordinates in [0, 2**bits), as bytes that sort like the curve.

    Skilling's transform: exchange and invert the low bits from the highest
    level down, then Gray-code across the dimensions; all points at once.
    """
    x = np.array(x, np.int64)
    for level in range(bits - 1, 0, -1):
        q, p = 1 << level, (1 << level) - 1
        for i in range(x.shape[1]):
            flip = (x[:, i] & q) != 0
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(flip, p, swap)
            x[:, i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=1)
    turn = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn[:, None]
    planes = (x[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    return [row.tobytes() for row in np.packbits(planes.reshape(len(x), -1).astype(np.uint8), axis=1)]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, exactly: in floating point where no partial sum can round, else in 64-bit integers."""
    most = int(a.shape[1]) * max(1, int(np.abs(a).max(initial=0))) * max(1, int(np.abs(b).max(initial=0)))
    if most < 1 << 53:
        kind = np.float32 if most < 1 << 24 else np.float64
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    if most >= 1 << 63:
        raise OverflowError("inner products need more than 64 bits")
    return a @ b.T


def _bytes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.int64).tobytes()


def _narrow(x: np.ndarray) -> bytes:
    """Integers in the fewest bytes of 2, 4 and 8 that hold them all."""
    most = int(np.abs(x).max(initial=0))
    return np.ascontiguousarray(x, np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64).tobytes()


def _wide(raw: bytes, n: int, dims: int) -> np.ndarray:
    size = len(raw) // max(1, n * dims)
    return np.frombuffer(raw, {2: np.int16, 4: np.int32}.get(size, np.int64)).astype(np.int64).reshape(n, dims)


_ROW = "id long, label long, dims int, anchor boolean, key binary, codes binary"
_BLOCK = "block long, label long, dims int, n int, ids binary, anchors binary, codes binary, low binary, high binary"


def blocks_of(rows: DataFrame, block_rows: int, bits: int) -> DataFrame:
    """rows (id, label, codes array<long>, anchor) as written blocks; exact repeats of a row count once."""
    span = rows.agg(F.min(F.array_min("codes")).alias("low"), F.max(F.array_max("codes")).alias("high")).first()
    low, width = span.low or 0, (span.high or 0) - (span.low or 0) + 1

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("codes")
            sizes = np.diff(codes.offsets.to_numpy())
            raw: list = [b""] * len(codes)
            keys: list = [b""] * len(codes)
            for dims in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == dims)
                x = np.stack([codes[int(i)].values.to_numpy(zero_copy_only=False) for i in at])
                place = ((x - low).astype(np.float64) * ((1 << bits) / width)).astype(np.int64)
                for i, k, v in zip(at, hilbert_keys(np.clip(place, 0, (1 << bits) - 1), bits), x, strict=True):
                    keys[i], raw[i] = k, _narrow(v)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(sizes, pa.int32()), batch.column("anchor"), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], ["id", "label", "dims", "anchor", "key", "codes"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, held, last = TaskContext.get().partitionId(), 0, [], None

        def block():
            label, dims = held[0][1], held[0][2]
            x = np.stack([_wide(r[5], 1, dims)[0] for r in held])
            order = np.argsort([r[0] for r in held], kind="stable")
            x, ids, anchors = x[order], np.array([r[0] for r in held], np.int64)[order], np.array([r[3] for r in held], np.uint8)[order]
            row = [(part << 32) + no, label, dims, len(held), ids.tobytes(), anchors.tobytes(), _narrow(x), _bytes(x.min(0)), _bytes(x.max(0))]
            return pa.RecordBatch.from_pylist([dict(zip((c.split()[0] for c in _BLOCK.split(", ")), row, strict=True))], schema)

        schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in _BLOCK.split(", "))])
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if row == last:
                    continue
                if held and (len(held) == block_rows or row[1:3] != last[1:3]):
                    yield block()
                    no, held = no + 1, []
                held.append(row)
                last = row
        if held:
            yield block()

    order = ["label", "dims", "key", "id", "codes"]
    rows = rows.select("id", "label", "codes", "anchor").mapInArrow(keyed, _ROW)
    return materialize(rows.repartitionByRange(*order[:4]).sortWithinPartitions(*order).mapInArrow(cut, _BLOCK), "blocks")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest scores along the last axis, ties by smaller id."""
    order = np.argsort(ids, axis=-1, kind="stable")
    scores, ids = np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)
    order = np.argsort(~scores, axis=-1, kind="stable")[..., :k]  # ~x falls as x rises and, unlike -x, never overflows
    return np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)


_ANCHOR = "id long, label long, dims int, block long, codes binary, least long"


def anchors_of(blocks: DataFrame, k: int) -> DataFrame:
    """Anchors (a, id, label, dims, block, codes, least): least is the k-th best score among the other rows of the anchor's own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                own = np.flatnonzero(np.frombuffer(b["anchors"], np.uint8))
                if len(own):
                    x, ids = _wide(b["codes"], b["n"], b["dims"]), np.frombuffer(b["ids"], np.int64)
                    s = product(x[own], x)
                    s[ids[own][:, None] == ids[None, :]] = NONE
                    least = np.sort(s, axis=1)[:, -k] if b["n"] >= k else np.full(len(own), NONE)
                    out += [(int(ids[i]), b["label"], b["dims"], b["block"], _narrow(x[i]), int(y)) for i, y in zip(own, least, strict=True)]
            cols = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [c.split()[0] for c in _ANCHOR.split(", ")])

    return materialize(blocks.mapInArrow(run, _ANCHOR).withColumn("a", F.monotonically_increasing_id()), "anchors")


class Windows:
    """The k best rows in each of the windows of some anchors, as blocks go by."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.x, self.ids, self.low, self.high, self.k = x, ids, low, high, k
        self.up, self.down = np.maximum(x, 0), np.minimum(x, 0)
        self.scores = np.full((*low.shape, k), NONE)
        self.found = np.zeros((*low.shape, k), np.int64)
        self.read = 0

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product with rows of blocks between their zone maps, (anchors, blocks)."""
        return product(self.up, low) + product(self.down, high), product(self.up, high) + product(self.down, low)

    def wanting(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Anchors with a window that a block between these bounds can add to."""
        need = np.maximum(self.low, self.scores[..., -1])
        return ((most[:, None] >= need) & (least[:, None] <= self.high) & (self.low <= self.high)).any(1)

    def add(self, at: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        """Offer a block's rows, in ascending order of ids, to some anchors."""
        self.read += len(at)
        s = product(self.x[at], rows)
        s[self.ids[at][:, None] == ids[None, :]] = NONE
        order = np.argsort(~s, axis=1, kind="stable")
        falling = np.take_along_axis(s, order, 1)
        begin = np.stack([(s > self.high[at, w][:, None]).sum(1) for w in range(self.low.shape[1])], 1)
        take = begin[..., None] + np.arange(self.k)
        inside = take < s.shape[1]
        take = np.minimum(take, s.shape[1] - 1)
        got = np.take_along_axis(falling[:, None, :], take, 2)
        who = ids[np.take_along_axis(order[:, None, :], take, 2)]
        got = np.where(inside & (got >= self.low[at][..., None]) & (got > NONE), got, NONE)
        self.scores[at], self.found[at] = _best(np.concatenate([self.scores[at], got], -1), np.concatenate([self.found[at], who], -1), self.k)


_FOUND = "a long, no int, id long, score long"
_NEEDED = "g long, cell int, block long"


def search(anchors: DataFrame, blocks: DataFrame, same_label: bool, k: int, group_anchors: int = 16384, cell_blocks: int = 512) -> DataFrame:
    """Rows (a, no, id, score, rank): the k best rows of blocks in each window of anchors (a, id, label, dims, block, codes, lows, highs).

    Window no holds scores from lows[no] to highs[no]; with same_label the rows
    of the anchor's label are searched, the others without. All anchors need
    as many windows. A group of anchors sees the zone maps first; only blocks
    that one of its anchors needs are sent to it.
    """
    sizes = blocks.count()
    cells = max(-(-sizes // cell_blocks), min(-(-sizes // 8), int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 1)
    groups = max(1, -(-anchors.count() // group_anchors))
    place = Window.partitionBy("part").orderBy("label", "dims", "block", "a")
    # Neighbours on the curve share a group: ranges of anchors first, then runs within a range.
    ranged = anchors.repartitionByRange(groups, "label", "dims", "block", "a").withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged.withColumn("g", F.shiftleft(F.col("part").cast("long"), 32) + F.floor((F.row_number().over(place) - 1) / group_anchors)).drop("part"), "groups")
    dealt = ranged.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    dealt = dealt.select(F.col("g").alias("to_g"), F.col("cell").alias("to_cell"), "a", "id", "label", "dims", "block", "codes", "lows", "highs")
    blocks = blocks.withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells)).cast("int"))

    def chunks(t: pa.Table) -> Iterator[tuple[int, np.ndarray, Windows]]:
        rows = sorted(t.to_pylist(), key=lambda r: (r["label"], r["dims"], r["block"], r["a"]))
        at = 0
        while at < len(rows):
            label, dims, to = rows[at]["label"], rows[at]["dims"], at
            while to < len(rows) and to - at < CHUNK and (rows[to]["label"], rows[to]["dims"]) == (label, dims):
                to += 1
            part = rows[at:to]
            x = np.stack([_wide(r["codes"], 1, dims)[0] for r in part])
            yield label, dims, np.array([r["a"] for r in part]), Windows(x, np.array([r["id"] for r in part]), np.array([r["lows"] for r in part]), np.array([r["highs"] for r in part]), k)
            at = to

    def fits(zones: list[dict], label: int, dims: int) -> list[dict]:
        return [z for z in zones if z["dims"] == dims and (z["label"] == label) == same_label]

    def zoned(zones: list[dict], windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        return windows.bounds(*(np.stack([np.frombuffer(z[c], np.int64) for z in zones]) for c in ("low", "high")))

    def choose(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        g, cell = (x.as_py() for x in key)
        zones, needed = right.to_pylist(), set()
        for label, dims, _, windows in chunks(left) if g is not None else ():
            if own := fits(zones, label, dims):
                least, most = zoned(own, windows)
                needed.update(z["block"] for j, z in enumerate(own) if windows.wanting(least[:, j], most[:, j]).any())
        return pa.table({"g": pa.array([g] * len(needed), pa.int64()), "cell": pa.array([cell] * len(needed), pa.int32()), "block": pa.array(sorted(needed), pa.int64())})

    def read(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        table = right.to_pylist()
        for label, dims, a, windows in chunks(left) if table else ():
            own = fits(table, label, dims)
            if not own:
                continue
            least, most = zoned(own, windows)
            for j in np.argsort(-most.max(0), kind="stable"):
                at = np.flatnonzero(windows.wanting(least[:, j], most[:, j]))
                if len(at):
                    windows.add(at, _wide(own[j]["codes"], own[j]["n"], dims), np.frombuffer(own[j]["ids"], np.int64))
            i, no, rank = np.nonzero(windows.scores > NONE)
            for column, values in zip(out, (a[i], no, windows.found[i, no, rank], windows.scores[i, no, rank]), strict=True):
                column.append(values)
        flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("a", "no", "id", "score"), flat, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)})

    pairs = ranged.select("g").distinct().withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    zones = pairs.join(blocks.select("cell", "block", "label", "dims", "low", "high"), "cell")
    needed = dealt.groupBy("to_g", "to_cell").cogroup(zones.groupBy("g", "cell")).applyInArrow(choose, _NEEDED)
    needed = materialize(needed, "needed")
    wanted = needed.select("g", "block").join(blocks.drop("anchors"), "block")
    found = dealt.groupBy("to_g", "to_cell").cogroup(wanted.groupBy("g", "cell")).applyInArrow(read, _FOUND)
    rank = F.row_number().over(Window.partitionBy("a", "no").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block_rows: int = 512, bits: int = 4) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x), x as double; scores are integer inner
    products; higher ones come first, ties by smaller id. An anchor's positives
    are its first `positives` other rows of its label; for each, the first
    `negatives` rows of other labels with low * positive_score <= 100 *
    negative_score <= high * positive_score. anchors is a condition over the
    columns of vectors.

    Rows with a null id, label or vector, or with a null or non-finite
    component, take no part. Exact repeats count once; different rows of one id
    are rows of their own, but none is a positive of that id. Vectors of
    different length are never compared; empty ones score 0 with one another.
    No anchors, or an empty table: no rows. Scores beyond 64 bits raise. Other
    columns are not read.
    """
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    fine = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    codes = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    rows = vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), codes.alias("codes"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    blocks = blocks_of(rows, block_rows, bits)
    asked = anchors_of(blocks, positives)
    greatest = F.lit(np.iinfo(np.int64).max)
    found = search(asked.withColumns({"lows": F.array("least"), "highs": F.array(greatest)}), blocks, True, positives)
    near = materialize(found.select("a", (F.col("rank") - 1).alias("no"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    p = F.col("positive_score")
    hundredths = lambda v: F.floor((v - F.pmod(v, F.lit(100))).cast("decimal(38,0)") / 100).cast("long")
    window = F.struct("no", (-hundredths(-low * p)).alias("low"), hundredths(high * p).alias("high"))
    windows = near.groupBy("a").agg(F.array_sort(F.collect_list(window)).alias("w"))
    none = F.array_repeat(F.struct(F.lit(1).alias("no"), F.lit(1).cast("long").alias("low"), F.lit(0).cast("long").alias("high")), F.lit(positives) - F.size("w"))
    windows = windows.withColumn("w", F.concat("w", none)).select("a", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    found = search(asked.join(windows, "a"), blocks, False, negatives).select("a", "no", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = found.join(near, ["a", "no"]).join(asked.select("a", F.col("id").alias("anchor_id")), "a")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
