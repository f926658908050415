"""Best-fit packing of documents into token sequences under several capacities.

Documents become pieces of at most `max_tokens` tokens; every piece is a
vector (tokens, one document, attention cost length squared). Pieces of one
length are the same vector, so the placement is decided on the histogram of
lengths (at most max_tokens rows, whatever the corpus holds) and carried out
by Spark: each piece takes its rank among the pieces of its length and finds
the bin range of that rank.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.bpe_words import LETTERS, WordCache, splitter
from skein.session import materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_state: dict = {}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _encoder(path: str, cache_words: int):
    """This worker's encoder: a text's ids as little-endian unsigned 32-bit integers."""
    if _state.get("path") != path:
        import public_tokenizers
        from tokenizers import Tokenizer, models, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        model, before = tokenizer.model, tokenizer.pre_tokenizer
        ids_of = lambda w: tokenizer.encode(w, add_special_tokens=False).ids
        if isinstance(model, models.BPE) and tokenizer.normalizer is None and isinstance(before, pre_tokenizers.ByteLevel) and before.use_regex and not before.add_prefix_space:
            # such a tokenizer splits, spells bytes as letters and merges; a match is split already, so its model is asked directly
            ids_of = lambda w: [t.id for t in model.tokenize(w.encode().decode("latin-1").translate(LETTERS))]
        split, lookup = splitter(public_tokenizers.PATTERN), WordCache(lambda w: packed(ids_of(w)), cache_words).__getitem__

        def encode(text: str) -> bytes:
            if any(a in text for a in added):  # the library finds added tokens before it splits
                return packed(tokenizer.encode(text, add_special_tokens=False).ids)
            return b"".join(map(lookup, split(text)))

        _state.update(path=path, encode=encode)
    return _state["encode"]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", cache_words: int = 500_000) -> DataFrame:
    """Tokenise every text, append end_id, cut into pieces of at most max_tokens.

    Only a text of more than max_tokens is cut, and only its first piece may be
    shorter. A null or empty text is the end token alone. Repeated rows and
    null ids each give their own pieces; other columns are not read. A text that
    spells an added token goes through the tokenizer whole, which gives that
    token's id; of any other, each distinct pattern match goes through it and is
    remembered in a bounded cache (`cache_words`).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(tokenizer_path, cache_words), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                n, at, k = len(ids) // 4, 0, 0
                size = n % max_tokens or max_tokens if n > max_tokens else n
                while at < n:
                    out.append((doc, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
                    at, k, size = at + size, k + 1, max_tokens
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, PIECES)


def plan_bins(counts: dict[int, int], capacity: tuple[float, float, float], weights: tuple[float, float, float] = (1.0, 0.0, 0.0), rule: str = "norm") -> np.ndarray:
    """Vector best fit over item types, largest first: rows (length, first rank, first bin, how many, offset).

    capacity bounds tokens, documents and attention cost of a bin. Every bin
    state (residual vector) with room under all three competes: rule "norm"
    takes the least weighted squared residual after placement, "dot" the least
    weighted dot product of item and residual. Bins in the same state are one
    entry with their ranges of numbers; ties go to the state opened first.
    Raises ValueError when an item exceeds a capacity by itself.
    """
    cap, w = np.array(capacity, float), np.array(weights, float) / np.array(capacity, float) ** (2 if rule == "norm" else 1)
    states: dict[tuple, list[list[int]]] = {}
    rows, bins = [], 0
    for length in sorted(counts, reverse=True):
        item, left, rank = np.array([length, 1, float(length) ** 2]), counts[length], 0
        if (item > cap).any():
            raise ValueError(f"an item of {length} tokens exceeds the capacity {capacity}")
        while left:
            keys = list(states)
            if keys:
                res = np.array(keys)
                score = ((res - item) ** 2 @ w) if rule == "norm" else (res * item) @ w
                score[(res < item).any(1)] = np.inf
                best = int(np.argmin(score))
            if not keys or not np.isfinite(score[best]):
                n = -(-left // int(np.min(cap // item)))
                states[tuple(cap)] = [[bins, n]]
                bins += n
                continue
            key = keys[best]
            ranges, to = states.pop(key), states.setdefault(tuple(np.array(key) - item), [])
            while ranges and left:
                at, n = ranges.pop()
                take = min(n, left)
                rows.append((length, rank, at, take, int(cap[0] - key[0])))
                to.append([at, take])
                rank, left = rank + take, left - take
                if take < n:
                    ranges.append([at + take, n - take])
            if ranges:
                states[key] = ranges
    return np.array(rows, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, max_tokens: int = 1024, max_docs: int | None = None, max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 1.0, 1.0), rule: str = "norm") -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...), in as few sequences as best fit finds.

    Limits left out cannot bind: a piece has at least one token, and lengths
    that add up to max_tokens have squares that add up to at most its square.
    Ranks within a length are dealt by (length, salt), so one length shared by
    a third of all pieces is still many groups. An empty table stays empty.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces, "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most max_tokens rows
    plan = plan_bins(counts, (max_tokens, max_docs or max_tokens, max_attention or max_tokens**2), weights, rule)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = spark.sparkContext.broadcast(plan)  # a row per length and bin state that it meets: it grows with max_tokens and the limits, not with the number of pieces
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = salted.groupBy("length", "salt").count().withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    here = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("here", here).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("here") - 1).drop("salt", "here", "before")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        step = int(rows[:, 1].max(initial=0) + rows[:, 3].max(initial=0) + 1)
        keys = rows[:, 0] * step + rows[:, 1]
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, batch.column("length").to_numpy() * step + rank, "right") - 1
            put = {"sequence_id": rows[at, 2] + rank - rows[at, 1], "offset": rows[at, 4]}
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(v) for v in put.values()], names + list(put))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long").select(*pieces.columns, "sequence_id", "offset")
