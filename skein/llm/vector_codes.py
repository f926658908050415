"""Vector code compression: product quantization on integers, assigned over tries of distinct parts.

Vectors are cut into equal consecutive parts; every part position has a codebook
of at most 256 entries, refined for a fixed number of rounds. A round reads the
distinct parts of every position (counted once, before the rounds) in
lexicographic order, so a run of parts with a common prefix is a subtree of a
trie. The subtree is walked depth first: a node holds the distances from its
prefix to all entries, accumulated once and shared by everything below it; where
a prefix has a single part left, the rest of that part is finished in one
product. Leaves take the nearest entry and add their weighted components.

Sums leave a task already combined, one row an entry; codebooks (256 entries a
position) are the only thing the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.session import materialize

#: Unshared ends of parts that are finished in one product.
TAILS = 1024
#: Components up to this size keep squared distances and their sums exact in 64-bit integers.
MOST = 1 << 26


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the lexicographically sorted, distinct parts: its nearest entry (ties: the lower index) and the squared distance.

    Depth-first over the trie of the parts with a stack of (from, to, depth,
    distances of the prefix to every entry).
    """
    n, dims = parts.shape
    best, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    exact = dims * (2 * max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)), 1)) ** 2 < 1 << 52
    tails: dict[int, tuple[list[int], list[np.ndarray]]] = {}

    def settle(at: np.ndarray, distances: np.ndarray) -> None:
        best[at] = distances.argmin(1)  # the first of equal ones
        error[at] = distances[np.arange(len(at)), best[at]]

    def finish(depth: int) -> None:
        at, shared = tails.pop(depth)
        x, e = parts[at, depth:], entries[:, depth:]
        if exact:  # no partial sum reaches 2**53
            x, e = x.astype(np.float64), e.astype(np.float64)
            rest = (x * x).sum(1)[:, None] - 2 * (x @ e.T) + (e * e).sum(1)[None, :]
            settle(np.array(at), np.stack(shared) + rest.astype(np.int64))
        else:
            settle(np.array(at), np.stack(shared) + ((x[:, None, :] - e[None, :, :]) ** 2).sum(2))

    stack = [(0, n, 0, np.zeros(len(entries), np.int64))] if n else []
    while stack:
        lo, hi, depth, shared = stack.pop()
        if hi - lo == 1 or depth == dims:  # distinct parts: a full prefix has one part
            at, held = tails.setdefault(depth, ([], []))
            at.append(lo)
            held.append(shared)
            if len(at) == TAILS:
                finish(depth)
            continue
        column = parts[lo:hi, depth]
        begins = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
        for at in range(0, len(begins), TAILS):
            some = begins[at : at + TAILS]
            below = shared + (column[some][:, None] - entries[None, :, depth]) ** 2
            ends = [*begins[at + 1 : at + 1 + TAILS], hi - lo][: len(some)]
            stack += [(lo + int(b), lo + int(e), depth + 1, d) for b, e, d in zip(some[::-1], ends[::-1], below[::-1], strict=True)]
    for depth in list(tails):
        finish(depth)
    return best, error


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">i8").astype(np.int64).reshape(-1, dims) - (1 << 62)


def _packed(x: np.ndarray) -> list[bytes]:
    """Rows as bytes that sort like the integers do."""
    return [row.tobytes() for row in (x + (1 << 62)).astype(">i8")]


def coded(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """Rows (id, label, codes array<long>) of the vectors without null and non-finite components."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    fine = F.col(vector_col).isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("codes"))


def distinct_parts(rows: DataFrame, parts: int, dims: int) -> DataFrame:
    """Written rows (pos, part, n): the distinct parts of each position in lexicographic order, and how many vectors hold them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, parts * dims)
            if np.abs(x).max(initial=0) > MOST:
                raise OverflowError(f"components beyond {MOST} have no exact distances")
            for pos in range(parts):
                found, n = np.unique(x[:, pos * dims : (pos + 1) * dims], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), pos), pa.int32()), pa.array(_packed(found), pa.binary()), pa.array(n, pa.int64())], ["pos", "part", "n"])

    found = rows.select("codes").mapInArrow(cut, "pos int, part binary, n long").groupBy("pos", "part").agg(F.sum("n").alias("n"))
    return materialize(found.repartitionByRange("pos", "part").sortWithinPartitions("pos", "part"), "parts")


def assigned_sums(parts: DataFrame, codebooks: list[np.ndarray], dims: int) -> DataFrame:
    """Rows (pos, entry, n, sums): how many vectors' parts are nearest to each entry, and their component sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(c), np.int64) for c in codebooks]
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        for batch in batches:
            where = batch.column(0).to_numpy()
            for pos in np.unique(where):
                at = np.flatnonzero(where == pos)  # in order, as written
                x, weight = _matrix(batch.column(1).take(pa.array(at)), dims), batch.column(2).to_numpy()[at]
                order = np.lexsort(x.T[::-1])
                x, weight = x[order], weight[order]
                entry, _ = nearest(x, codebooks[pos])
                np.add.at(n[pos], entry, weight)
                np.add.at(sums[pos], entry, x * weight[:, None])
        rows = [(pos, e, int(n[pos][e]), sums[pos][e]) for pos in range(len(codebooks)) for e in np.flatnonzero(n[pos])]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], ["pos", "entry", "n", "sums"])

    local = parts.mapInArrow(run, "pos int, entry int, n long, sums array<long>")
    each = local.select("pos", "entry", "n", F.posexplode("sums").alias("i", "s")).groupBy("pos", "entry", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    return each.groupBy("pos", "entry").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "s"))).alias("sums")).withColumn("sums", F.col("sums.s"))


def train(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> list[np.ndarray]:
    """Codebooks (entries, dims) of each part position of rows (id, label, codes).

    They start as the parts of the rows of the least ids (ties: by components;
    null ids last) and take the floored means of what is nearest to them,
    rounds times; an entry without parts stays. Rows of another length than the
    first one's, or a first one that cannot be cut, give no codebooks.
    """
    first = [r.codes for r in rows.orderBy(F.col("id").asc_nulls_last(), "codes").limit(1).collect()]
    if not first or not first[0] or len(first[0]) % parts:
        return []
    size, dims = len(first[0]), len(first[0]) // parts
    rows = rows.where(F.size("codes") == size)
    start = np.array([r.codes for r in rows.orderBy(F.col("id").asc_nulls_last(), "codes").limit(entries).collect()], np.int64)
    if np.abs(start).max() > MOST:
        raise OverflowError(f"components beyond {MOST} have no exact distances")
    codebooks = [start[:, p * dims : (p + 1) * dims].copy() for p in range(parts)]
    distinct = distinct_parts(rows, parts, dims)
    for _ in range(rounds):
        for r in assigned_sums(distinct, codebooks, dims).collect():  # at most parts * entries rows
            codebooks[r.pos][r.entry] = [s // r.n for s in r.sums]
    return codebooks


def encode(rows: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """Rows (id, label, code, error): entry numbers of every part as hex, and the squared distance of a vector to what they stand for.

    Both are null for vectors of another length than the codebooks'.
    """
    dims = codebooks[0].shape[1] if codebooks else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(sizes == dims * len(codebooks)) if codebooks else np.zeros(0, np.int64)
            code, error = [None] * len(sizes), [None] * len(sizes)
            if len(at):
                x = batch.column(2).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
                chosen, total = np.zeros((len(at), len(codebooks)), np.int64), np.zeros(len(at), np.int64)
                for pos, book in enumerate(codebooks):
                    distinct, which = np.unique(x[:, pos * dims : (pos + 1) * dims], axis=0, return_inverse=True)
                    entry, distance = nearest(distinct, book)
                    chosen[:, pos] = entry[which.ravel()]
                    total += distance[which.ravel()]
                for i, c, e in zip(at, chosen, total, strict=True):
                    code[i], error[i] = "".join(f"{v:02x}" for v in c), int(e)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"id long, label {kind}, code string, error long")


def codebooks_text(codebooks: list[np.ndarray]) -> str:
    return ",".join(str(int(v)) for book in codebooks for v in book.ravel())


def compress(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """Rows (vec_id, label, code, error, label_error, codebooks_sha256), one for each vector without null or non-finite components.

    Components become floor(scale * x), x as double. code holds two hex digits
    a part (entries is at most 256), error the squared distance over all parts,
    label_error the sum of error over the rows of the label, nulls together.
    Vectors of another length than that of the row of least id, and all vectors
    where that length does not divide by parts, stay with null code and error,
    and count as nothing in label_error. Repeated rows each count and stay;
    an empty table gives no rows. Components beyond 2**26 raise, since their
    distances are not exact. Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256: a code has two hex digits a part")
    rows = materialize(coded(vectors, id_col, label_col, vector_col, scale), "coded")
    codebooks = train(rows, parts, entries, rounds)
    out = materialize(encode(rows, codebooks), "codes")
    totals = out.groupBy(F.col("label").alias("of")).agg(F.coalesce(F.sum("error"), F.lit(0)).cast("long").alias("label_error"))
    sha = hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
    return out.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(F.col("id").alias("vec_id"), "label", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def sql(entries: int = 256, rounds: int = 4, parts: int = 4) -> str:
    """DuckDB SQL with the rows of op13 over embeddings (vectors of one length that divides by parts)."""
    ctes = [
        f"""v AS (
  SELECT vec_id, label, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"p AS (SELECT r, p, c[p * len(c) // {parts} + 1 : (p + 1) * len(c) // {parts}] AS x FROM v, range({parts}) t(p))",
        f"first AS (SELECT r, row_number() OVER (ORDER BY vec_id, c) - 1 AS e FROM v QUALIFY e < {entries})",
        "c0 AS (SELECT p, e, x FROM p JOIN first USING (r))",
    ]
    distance = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for k in range(rounds + 1):
        ctes.append(f"d{k} AS (SELECT r, p, p.x, e, {distance} AS d FROM p JOIN c{k} c USING (p))")
        ctes.append(f"a{k} AS (SELECT r, p, any_value(x) AS x, arg_min(e, (d, e)) AS e, min(d) AS d FROM d{k} GROUP BY r, p)")
        if k < rounds:
            ctes.append(f"s{k} AS (SELECT p, e, i, CAST(floor(sum(y) / count(*)) AS BIGINT) AS m FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY p, e, i)")
            ctes.append(f"m{k} AS (SELECT p, e, list(m ORDER BY i) AS x FROM s{k} GROUP BY p, e)")
            ctes.append(f"c{k + 1} AS (SELECT p, e, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m USING (p, e))")
    ctes.append(f"o AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)")
    ctes.append(f"h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})")
    return f"""
WITH {', '.join(ctes)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN o USING (r), h
"""
