"""Byte-level BPE with a segment tree per pattern match, and its inverse."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.bpe_words import WordCache, splitter

_state: dict = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: merge the leftmost pair of least rank until none is left.

    A segment tree over byte positions holds, for each live position, the rank
    of the pair that starts there (and the position itself, so that the least
    key is the leftmost of the least ranks); a merge updates the points of the
    merged token, of its right neighbour that vanishes, and of the left one.
    """
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    none, size, get = 1 << 62, 1 << (n - 1).bit_length(), ranks.get
    tree, after, before = [none] * (2 * size), list(range(1, n + 1)), list(range(-1, n - 1))
    for i in range(n - 1):
        rank = get(word[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def put(i: int, key: int) -> None:
        i += size
        tree[i] = key
        while i > 1:
            a, b = tree[i], tree[i ^ 1]
            i >>= 1
            least = a if a < b else b
            if tree[i] == least:
                return
            tree[i] = least

    while tree[1] != none:
        i = tree[1] & 0xFFFFFFFF
        j = after[i]
        k = after[j]
        after[i] = k
        put(j, none)
        if k < n:
            before[k] = i
            rank = get(word[i : after[k]])
            put(i, none if rank is None else rank << 32 | i)
        else:
            put(i, none)
        h = before[i]
        if h >= 0:
            rank = get(word[h:k])
            put(h, none if rank is None else rank << 32 | h)
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


def _codec(path: str, pattern: str, cache_words: int):
    if _state.get("key") != (path, pattern):
        ranks = load_ranks(path)
        words = WordCache(lambda w: np.array(merge_word(w.encode(), ranks), "<u4").tobytes(), cache_words)
        split, lookup = splitter(pattern), words.__getitem__
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        _state.update(key=(path, pattern), encode=lambda text: b"".join(map(lookup, split(text))), token=tokens.__getitem__)
    return _state


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", cache_words: int = 500_000) -> DataFrame:
    """Rows (doc_id, ids): the ids of each text as little-endian unsigned 32-bit integers.

    Each match of pattern is encoded by itself; strings that name special
    tokens are ordinary text. A null or empty text has no ids. Repeated rows
    and null ids pass through; other columns are not read. Matches are
    remembered in a bounded cache (`cache_words`).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = _codec(ranks_path, pattern, cache_words)["encode"]
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([to_ids(x.as_py() or "") for x in part.column(1)], pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, cache_words: int = 500_000) -> DataFrame:
    """Rows (doc_id, ids, decoded): the bytes that packed ids stand for. Null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _codec(ranks_path, pattern, cache_words)["token"]
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                texts = [b"".join(map(token, np.frombuffer(x.as_py() or b"", "<u4").tolist())) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
