"""Chunks of documents and packed messages between chunks and key buckets.

Several operators ask one question about every key of the corpus ("does this
string stand in another document", "how often does this word occur"). Each
chunk of documents reduces its keys to sorted distinct arrays, sends one packed
row per key bucket, and gets the answers back in the order it asked. Spark
moves rows (bucket, chunk, payload); what a key costs a bucket is bounded by
the number of chunks, however many documents hold it. Payload bytes are in
proportion to the corpus. Rows are at most chunks times buckets and at most the
distinct keys of all chunks, for a message without keys is not sent: they grow
with the product while it is the smaller, and in proportion to the corpus once
a chunk has fewer keys than there are buckets.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunked(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = 4 << 20) -> tuple[DataFrame, int]:
    """Rows (chunk, id, text, row) and the number of chunks: documents dealt by a hash of the whole text and id.

    row holds the other columns of docs. Chunks hold about chunk_bytes of text; a
    small table has one chunk for each shuffle partition.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // chunk_bytes))
    doc, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    chunk = F.pmod(F.xxhash64(doc, text), F.lit(n)).cast("int")
    return docs.select(chunk.alias("chunk"), doc.alias("id"), text.alias("text"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]).alias("row")), n


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return start, np.append(start[1:], len(values))


def spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions first, first+1, ... of every range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a mixed 64-bit key, rising with the key, so sorted keys are grouped by bucket."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def planes(x: np.ndarray) -> bytes:
    """The first bytes of all values, then the second bytes and so on: high bytes are alike, and compress away."""
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def values(raw: bytes, kind: str) -> np.ndarray:
    """The values of planes."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


@cache
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One of each per worker: making them costs more than a small message."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeeze(raw: bytes) -> bytes:
    return _codec()[0].compress(raw)


def expand(raw: bytes) -> bytes:
    return _codec()[1].decompress(raw) if raw else b""


def pack(x: np.ndarray) -> bytes:
    return squeeze(planes(x))


def unpack(x: bytes, kind: str) -> np.ndarray:
    return values(expand(x), kind)


def table(rows: list[tuple], fields: list) -> pa.Table:
    """An Arrow table from tuples."""
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True)], [n for n, _ in fields])
