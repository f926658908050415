"""Language-model scores from a probabilistic suffix tree over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.exchange import bucket_of, expand, pack, planes, runs, squeeze, table, unpack, values
from skein.llm.text import mix, utf8, word_hashes
from skein.session import discard, materialize

_END = mix(np.array([0xE2D], np.uint64))[0]
DISCOUNT = 0.75
_LONGS = pa.list_(pa.int64())
_CHUNK_FIELDS = [("chunk", pa.int64()), ("bytes", pa.int64()), ("ids", _LONGS)] + [(x, pa.binary()) for x in ("held", "sizes", "names", "own", "tokens")]
_CHUNK = "chunk long, bytes long, ids array<long>, held binary, sizes binary, names binary, own binary, tokens binary"
_STATE_FIELDS = [("chunk", pa.int64()), ("ids", _LONGS)] + [(x, pa.binary()) for x in ("held", "sizes", "numbers", "totals", "tokens")]
_STATE = "chunk long, ids array<long>, held binary, sizes binary, numbers binary, totals binary, tokens binary"
_ASK = "bucket int, chunk long, contexts binary, times binary, sizes binary, entries binary, counts binary, parents binary"
_REPLY = "chunk long, level int, bucket int, payload binary"
_ASK_FIELDS = [("bucket", pa.int32()), ("chunk", pa.int64())] + [(x, pa.binary()) for x in ("contexts", "times", "sizes", "entries", "counts", "parents")]
_REPLY_FIELDS = [("chunk", pa.int64()), ("level", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())]
#: Bits of a word's number; it tells the successors of one context apart.
_WIDTH = 40


def _gaps(x: np.ndarray) -> bytes:
    """Rising values by their differences."""
    return pack(np.diff(x.astype(np.uint64), prepend=np.uint64(0)))


def _ungaps(x: bytes) -> np.ndarray:
    return np.cumsum(unpack(x, "<u8"), dtype=np.uint64)


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Where every run of so many values begins, runs without values left out."""
    sizes = sizes[sizes > 0]
    return np.cumsum(sizes) - sizes


def _pack_successors(numbers: np.ndarray, sizes: np.ndarray) -> bytes:
    """Numbers that rise within each context, by their differences."""
    gaps, at = np.diff(numbers, prepend=0), _starts(sizes)
    gaps[at] = numbers[at]
    return pack(gaps.astype("<u8"))


def _unpack_successors(raw: bytes, sizes: np.ndarray) -> np.ndarray:
    gaps, at = unpack(raw, "<u8").astype(np.int64), _starts(sizes)
    sums = np.cumsum(gaps)
    return sums - np.repeat(sums[at] - gaps[at], sizes[sizes > 0])


def _dealt(group: pa.Table, chunk: int) -> tuple:
    """A chunk's row: its distinct tokens by hash, and its texts as places among them in order of how often they teach."""
    data, offsets = utf8(group.column("text"))
    words, at = word_hashes(data, offsets)
    sizes = np.diff(at) + 1  # with the end
    last = np.cumsum(sizes) - 1
    tokens = np.full(int(sizes.sum()), _END, np.uint64)
    slot = np.ones(len(tokens), bool)
    slot[last] = False
    tokens[slot] = words
    held = np.array(group.column("held_out").to_pylist(), bool)
    names, token = np.unique(tokens, return_inverse=True)
    own = np.bincount(token, weights=np.repeat(~held, sizes), minlength=len(names)).astype(np.int64)
    return (chunk, len(data), group.column("id").to_pylist(), pack(held.astype("u1")), pack(sizes.astype("<u4")), _gaps(names), pack(own.astype("<u4")), pack(_ranks(own)[token].astype("<u4")))


def _ranks(own: np.ndarray) -> np.ndarray:
    """The place of each name in order of its count: frequent names have small ones, which pack well."""
    out = np.empty(len(own), np.int64)
    out[np.argsort(-own, kind="stable")] = np.arange(len(own))
    return out


def _deal(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.Table]:
    """The rows of a partition in chunks of about chunk_bytes of text."""
    waiting, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < batch.num_rows:
            to = min(batch.num_rows, at + 1 + int(np.searchsorted(np.cumsum(lengths[at:]) + size, chunk_bytes)))
            waiting.append(batch.slice(at, to - at))
            size, at = size + int(lengths[at:to].sum()), to
            if size >= chunk_bytes:
                yield pa.Table.from_batches(waiting)
                waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _numbered(row: dict, told: pa.Table, least: int) -> tuple:
    """A chunk's row with the corpus' numbers and counts of its frequent words in place of hashes; rare words of one count are one symbol."""
    replies = sorted(zip(*(told.column(c).to_pylist() for c in ("bucket", "totals", "numbers")), strict=True))
    total = np.concatenate([unpack(t, "<u8") for _, t, _ in replies]).astype(np.int64)
    number = np.full(len(total), -1)
    number[total >= 2] = np.concatenate([unpack(x, "<u8") for *_, x in replies])
    own = unpack(row["own"], "<u4").astype(np.int64)
    number[total < least] = -1
    symbol = np.where(number < 0, total - least, number)  # rare ones first, by count
    names, place = np.unique(symbol, return_inverse=True)
    totals = np.zeros(len(names), np.int64)
    totals[place] = total
    token = place[np.argsort(-own, kind="stable")][unpack(row["tokens"], "<u4")]
    seen = np.bincount(token, minlength=len(names))
    ranked = _ranks(seen)
    return (row["chunk"], row["ids"], row["held"], row["sizes"], _gaps(np.maximum(names, -1) + 1), pack(np.stack([totals, seen]).astype("<u8").ravel()), pack(ranked[token].astype("<u4")))


class Chunk:
    """The tokens of one chunk, and what the corpus has answered about them so far.

    Words and grams carry the numbers that the corpus gave them; -1 marks words
    too rare to be states. A later pass over the same chunk asks and reads in
    the same order. p holds each token's probability under the longest retained
    state among those of the levels answered so far.
    """

    def __init__(self, row: dict, n: int, v: int, least: int):
        self.sizes = unpack(row["sizes"], "<u4").astype(np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        self.ids, self.held = row["ids"], unpack(row["held"], "u1").astype(bool)
        self.words = _ungaps(row["numbers"]).astype(np.int64) - 1
        self.total, seen = unpack(row["totals"], "<u8").astype(np.int64).reshape(2, -1)
        self.token = np.argsort(-seen, kind="stable")[unpack(row["tokens"], "<u4")]
        self.train = np.repeat(~self.held, self.sizes)
        self.within = np.arange(len(self.token)) - np.repeat(self.begin[:-1], self.sizes)
        self.least = least
        self.base = ((self.total + 0.1) / (n + 0.1 * (v + 1)))[self.token]
        self.p = self.base
        # gram: which gram of the current length ends at each token, -1 if it is too rare to be a state
        self.gram = np.where(self.words >= 0, np.arange(len(self.words)), -1)[self.token]
        self.number, self.count = self.words, self.total

    def entries(self, level: int, buckets: int):
        """What a level is about: heads, the frequent contexts that some token follows, by bucket and number; and (context,
        next) pairs whose two overlapping grams are frequent, ordered by head. A context without such pairs is a head too:
        whether it is a state bears on the tokens that follow it."""
        follows = np.flatnonzero(self.within >= level)
        before = self.gram[follows - 1]
        follows, before = follows[before >= 0], before[before >= 0]
        present = np.zeros(len(self.number), bool)
        present[before] = True
        named = np.flatnonzero(present)
        bucket = bucket_of(mix(self.number[named].astype(np.uint64)), buckets)
        order = np.lexsort((self.number[named], bucket))
        named, bucket = named[order], bucket[order]
        place = np.zeros(len(self.number), np.int64)
        place[named] = np.arange(len(named))
        head = place[before]
        pick = self.gram[follows] >= 0
        ends = follows[pick]
        width = max(1, len(self.words))
        pair, first, inverse = np.unique(head[pick] * np.int64(width) + self.token[ends], return_index=True, return_inverse=True)
        return follows, head, named, bucket, ends, first, inverse, pair // width, pair % width

    def ask(self, level: int, chunk: int, buckets: int) -> list[tuple]:
        _, _, named, bucket, ends, first, inverse, head, token = self.entries(level, buckets)
        own = np.bincount(inverse, weights=self.train[ends], minlength=len(token)).astype(np.int64)
        parent = np.log2(self.p[ends[first]])
        rows = []
        for s, e in zip(*runs(bucket), strict=True):
            a, b = np.searchsorted(head, [s, e])
            sizes = np.bincount(head[a:b] - s, minlength=e - s)
            rows.append((int(bucket[s]), chunk, _gaps(self.number[named[s:e]]), pack(self.count[named[s:e]].astype("<u8")), pack(sizes.astype("<u4")), _pack_successors(self.words[token[a:b]], sizes), pack(own[a:b].astype("<u4")), pack(parent[a:b].astype("<f4"))))
        return rows

    def learn_level(self, level: int, payloads: list[bytes], buckets: int) -> None:
        """Take the answers of one level, in bucket order."""
        follows, head, named, bucket, ends, _, inverse, owner, _ = self.entries(level, buckets)
        answers = [_unpack_level(x) for x in payloads]
        keep, back, total, numbers = (np.concatenate(x) if answers else np.zeros(0, np.int64) for x in (zip(*answers, strict=True) if answers else ((), (), (), ())))
        keep, frequent = keep.astype(bool), total >= self.least
        # a retained state leaves its back-off share to the shorter suffix, and adds what it has seen
        use = keep[head]
        p = self.p.copy()
        p[follows[use]] *= back[head[use]]
        seen = np.where(frequent, np.maximum(total - DISCOUNT, 0), 0) / np.maximum(self.count[named[owner]], 1)
        seen[~keep[owner]] = 0
        p[ends] += seen[inverse]
        self.p = p
        number = np.full(len(owner), -1)
        if len(numbers):
            number[frequent] = numbers * buckets + bucket[owner[frequent]]
        gram = np.full(len(self.token), -1, np.int64)
        gram[ends] = np.where(frequent[inverse], inverse, -1)
        self.gram, self.number, self.count = gram, number, total.astype(np.int64)


def _pack_level(flags: np.ndarray, weights: np.ndarray, counts: np.ndarray, numbers: np.ndarray) -> bytes:
    """numbers: those of the pairs that are states of the next level, in order; none if there is no next."""
    sizes = np.array([len(flags), len(counts), len(numbers)], "<i8")
    return squeeze(sizes.tobytes() + flags.astype("u1").tobytes() + planes(weights.astype("<f4")) + planes(counts.astype("<i8")) + planes(np.diff(numbers, prepend=0).astype("<i8")))


def _unpack_level(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = expand(payload)
    n, m, _ = np.frombuffer(raw, "<i8", 3)
    at = 24 + 5 * n
    return np.frombuffer(raw, "u1", n, 24), values(raw[24 + n : at], "<f4").astype(float), values(raw[at : at + 8 * m], "<i8"), np.cumsum(values(raw[at + 8 * m :], "<i8"))


def _ordered(replies: pa.Table, level: int) -> list[bytes]:
    found = sorted((b, p) for x, b, p in zip(*(replies.column(c).to_pylist() for c in ("level", "bucket", "payload")), strict=True) if x == level)
    return [p for _, p in found]


def score_texts(docs: DataFrame, depth: int = 2, p_min: float = 0.0, penalty: float = 0.5, id_col: str = "doc_id", text_col: str = "text", held_out_col: str = "held_out", chunk_bytes: int = 8 << 20) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Tokens are words (A-Z folded) and one end per text; a null or empty text is
    its end alone. Rows whose held_out_col is not true teach the model; without
    any, all probabilities are those of unseen words. base_score sums log10 of
    the add-0.1 word probabilities, score the log10 probabilities under the tree.

    States are contexts of up to depth words that occur twice or more, whatever
    the size of the corpus, retained when their successors that occur twice or
    more after them diverge from the shorter context's:
    the gain in log likelihood (count times divergence) must exceed penalty
    times the number of successors kept times the log of the count. A state
    gives each kept successor its discounted share and the rest of the mass to
    the next shorter suffix's distribution, so every state sums to one over the
    vocabulary and one unseen word. Counts of all words and of all grams whose
    parts occur twice are gathered over the whole corpus; no successor that
    occurs twice with its context is left out. A caller that wants a smaller
    model can ask for an empirical probability of p_min besides.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(held_out_col), F.lit(False)).alias("held_out"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # chunks stay where their texts were read, and are written once: later passes read the same ones
        part = TaskContext.get().partitionId() << 32
        for i, group in enumerate(_deal(batches, chunk_bytes)):
            yield from table([_dealt(group, part + i)], _CHUNK_FIELDS).to_batches()

    chunks = materialize(rows.mapInArrow(deal, _CHUNK), "chunks")
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // chunk_bytes))

    asks = [("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, own = _ungaps(row["names"]), unpack(row["own"], "<u4")
                where = bucket_of(names, buckets)
                yield from table([(int(where[a]), row["chunk"], _gaps(names[a:b]), pack(own[a:b])) for a, b in zip(*runs(where), strict=True)], asks).to_batches()

    def count_words(group: pa.Table) -> pa.Table:
        keys = [_ungaps(x) for x in group.column("keys").to_pylist()]
        value, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([unpack(x, "<u4") for x in group.column("counts").to_pylist()]), len(value)).astype(np.int64)
        bucket, at, out = group.column("bucket")[0].as_py(), 0, []
        number = _ranks(total) * buckets + bucket
        for chunk, x in zip(group.column("chunk").to_pylist(), keys, strict=True):
            mine = inverse[at : at + len(x)]
            out.append((chunk, bucket, pack(total[mine].astype("<u8")), pack(number[mine[total[mine] >= 2]].astype("<u8")), int(total.sum()) if not out else 0, int(np.count_nonzero(total)) if not out else 0))
            at += len(x)
        return table(out, [("chunk", pa.int64()), ("bucket", pa.int32()), ("totals", pa.binary()), ("numbers", pa.binary()), ("n", pa.int64()), ("v", pa.int64())])

    words = chunks.select("chunk", "names", "own").mapInArrow(ask_words, "bucket int, chunk long, keys binary, counts binary").groupBy("bucket").applyInArrow(count_words, "chunk long, bucket int, totals binary, numbers binary, n long, v long")
    words = materialize(words, "words")
    n, v = (int(x or 0) for x in words.agg(F.sum("n"), F.sum("v")).first())
    least = max(2, int(np.ceil(p_min * n)))

    def number(group: pa.Table, told: pa.Table) -> pa.Table:
        return table([_numbered(row, told, least) for row in group.to_pylist()], _STATE_FIELDS)

    kept = chunks.drop("bytes").groupBy("chunk").cogroup(words.drop("n", "v").groupBy("chunk"))
    state = materialize(kept.applyInArrow(number, _STATE), "numbered")
    discard(chunks)
    discard(words)

    def known(row: dict, told: pa.Table, levels: int) -> Chunk:
        c = Chunk(row, n, v, least)
        for level in range(1, levels + 1):
            c.learn_level(level, _ordered(told, level), buckets)
        return c

    def ask_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from table(Chunk(row, n, v, least).ask(1, row["chunk"], buckets), _ASK_FIELDS).to_batches()

    def asker(level: int):
        def ask(group: pa.Table, told: pa.Table) -> pa.Table:
            return table([x for row in group.to_pylist() for x in known(row, told, level - 1).ask(level, row["chunk"], buckets)], _ASK_FIELDS)

        return ask

    def counter(level: int):
        def count(group: pa.Table) -> pa.Table:
            heads = [_ungaps(x) for x in group.column("contexts").to_pylist()]
            sizes = [unpack(x, "<u4").astype(np.int64) for x in group.column("sizes").to_pylist()]
            context, owner = np.unique(np.concatenate(heads), return_inverse=True)
            times = np.zeros(len(context))
            times[owner] = np.concatenate([unpack(x, "<u8") for x in group.column("times").to_pylist()])
            entries = np.concatenate([_unpack_successors(x, s) for x, s in zip(group.column("entries").to_pylist(), sizes, strict=True)])
            key = (np.repeat(owner, np.concatenate(sizes)).astype(np.uint64) << np.uint64(_WIDTH)) | entries.astype(np.uint64)
            value, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            total = np.bincount(inverse, weights=np.concatenate([unpack(x, "<u4") for x in group.column("counts").to_pylist()]), minlength=len(value))
            parent = np.exp2(np.concatenate([unpack(x, "<f4") for x in group.column("parents").to_pylist()]).astype(float)[first])
            state = (value >> np.uint64(_WIDTH)).astype(np.int64)
            enough = total >= least
            share = np.where(enough, total - DISCOUNT, 0) / times[state]
            back = np.clip(1 - np.bincount(state, weights=share, minlength=len(context)), 1e-6, 1)
            gain = np.where(enough, total * np.log((share + back[state] * parent) / parent), 0)
            kept = np.bincount(state, weights=enough, minlength=len(context))
            gain = np.bincount(state, weights=gain, minlength=len(context)) + (times - np.bincount(state, weights=np.where(enough, total, 0), minlength=len(context))) * np.log(back)
            retain = (kept > 0) & (gain > penalty * kept * np.log(np.maximum(times, 2)))
            rank = np.cumsum(enough) - 1
            bucket, at, head, out = group.column("bucket")[0].as_py(), 0, 0, []
            for chunk, h, s in zip(group.column("chunk").to_pylist(), heads, sizes, strict=True):
                mine, pairs = owner[head : head + len(h)], inverse[at : at + int(s.sum())]
                out.append((chunk, level, bucket, _pack_level(retain[mine], back[mine], total[pairs], rank[pairs[enough[pairs]]] if level < depth else rank[:0])))
                at, head = at + len(pairs), head + len(h)
            return table(out, _REPLY_FIELDS)

        return count

    replies = docs.sparkSession.createDataFrame([], _REPLY)
    left = state.groupBy("chunk")
    for level in range(1, depth + 1):
        asked = state.mapInArrow(ask_first, _ASK) if level == 1 else left.cogroup(replies.groupBy("chunk")).applyInArrow(asker(level), _ASK)
        told = materialize(asked.groupBy("bucket").applyInArrow(counter(level), _REPLY), "replies")
        replies = told if level == 1 else replies.unionByName(told)

    out_fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]

    def finish(group: pa.Table, told: pa.Table) -> pa.Table:
        if not group.num_rows:
            return table([], out_fields)
        c = known(group.to_pylist()[0], told, depth)
        at = c.begin[:-1]
        sums = [np.add.reduceat(x, at) for x in ((c.total > 0)[c.token].astype(np.int64), np.log10(c.base), np.log10(c.p))]
        cols = [c.ids, c.held, c.sizes, sums[0], np.full(len(at), n), sums[1], sums[2]]
        return pa.table([pa.array(x, t) for x, (_, t) in zip(cols, out_fields, strict=True)], [f for f, _ in out_fields])

    schema = T.StructType.fromDDL("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return left.cogroup(replies.groupBy("chunk")).applyInArrow(finish, schema)
