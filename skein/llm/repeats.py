"""Removal of repeated byte strings by column-wise construction of a collection BWT and its common prefixes.

Strings of `length` bytes that stand in several documents must meet. Windows
are dealt by their minimiser (the least hash of the k-byte strings in them):
equal windows have equal minimisers, and neighbouring windows with one
minimiser form a segment of at most 2*length-k bytes. Minimisers found in one
document only cannot repeat and go no further; windows under a minimiser with
very many different segments are dealt one by one, by their own hash. Where
windows of a minimiser recur, the strings around them form a collection, and
the Burrows-Wheeler transform and longest-common-prefix array of the
collection are built column by column, one symbol of every string per round,
to read off the least document of every window.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skein.llm.exchange import bucket_of, chunked, expand, pack, runs, spans, squeeze, table, unpack
from skein.llm.text import _TABLE, mix, powers, utf8

NOWHERE = np.iinfo(np.int64).max
_LOW = np.uint64((1 << 20) - 1)
_HALF = np.uint64(0xFFFFFFFF)
SLICE = 1 << 19
#: Bytes of strings that one task holds at a time while it looks for recurring windows.
COLLECTION = 1 << 20
#: Different segments (by chunk) of a minimiser from which its windows are dealt by their own hash, so that no group grows with the corpus.
HEAVY = 2000


def segments(data: np.ndarray, offsets: np.ndarray, length: int, k: int) -> Iterator[tuple]:
    """Slices of the texts: (position, hash sums, inverse powers, minimisers, first and last window, hash of the segment's bytes)."""
    ends = offsets[1:]
    for lo in range(0, len(data) - length + 1, SLICE):
        b = data[lo : lo + SLICE + length - 1]
        up, down = powers(len(b))
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_TABLE[b] * up, out=total[1:])
        h = mix((total[k:] - total[:-k]) * down[: len(b) - k + 1])
        m = (h & ~_LOW) | (np.arange(len(h), dtype=np.uint64) & _LOW)
        width, span = 1, length - k + 1
        while width * 2 <= span:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        if width < span:
            m = np.minimum(m[: len(m) - (span - width)], m[span - width :])
        # windows that reach over the end of a text are none
        near = ends[np.searchsorted(ends, lo, "right") : np.searchsorted(ends, lo + len(m) + length)]
        over = np.zeros(len(m) + 1, np.int32)
        np.add.at(over, np.clip(near - length + 1 - lo, 0, len(m)), 1)
        np.add.at(over, np.clip(near - lo, 0, len(m)), -1)
        m[np.cumsum(over[:-1]) > 0] = ~np.uint64(0)
        start, end = runs(m)
        real = m[start] != ~np.uint64(0)
        start, end = start[real], end[real]
        stop = end - 1 + length
        yield lo, total, down, h[(m[start] & _LOW).astype(np.int64)], start, end - 1, mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))


class _Columns:
    """Columns in anonymous sequential files: each round reads the last round's and writes its own."""

    def __init__(self):
        self.files: dict[str, tuple] = {}

    def put(self, **columns: np.ndarray) -> None:
        for name, x in columns.items():
            if name in self.files:
                self.files[name][0].close()
            f = tempfile.TemporaryFile()
            x.tofile(f)
            self.files[name] = f, x.dtype

    def get(self, name: str) -> np.ndarray:
        f, kind = self.files[name]
        f.seek(0)
        return np.fromfile(f, kind)

    def close(self) -> None:
        for f, _ in self.files.values():
            f.close()


def collection_order(strings: list[bytes], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in the concatenated strings) of all non-empty suffixes in sorted order, and common prefixes with the one before, up to most."""
    return _order(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings], np.int64), most)


def _order(text: np.ndarray, size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Column-wise: round j inserts the suffix of length j of every string that has one.

    The symbol before each suffix (the transform) sorted stably, with ties in
    the order of the rows, is the order of the suffixes one longer, so a new
    row's place follows from its tail's row; its common prefix with its
    neighbour is one more than the least common prefix between their tails.
    """
    base = np.concatenate([[0], np.cumsum(size)])
    first = np.zeros(len(text) + 1, bool)
    first[base[:-1]] = True
    m = len(size)
    files = _Columns()
    ends = base[1:].astype(np.int32)
    files.put(at=ends, lcp=np.zeros(m, np.uint8), age=np.zeros(m, np.uint8))
    for turn in range(1, int(size.max(initial=0)) + 1):
        at, lcp, age = (files.get(n) for n in ("at", "lcp", "age"))
        more = ~first[at]
        more[:m] = size > 0
        alive = np.flatnonzero(more)
        sym = text[at[alive] - 1]
        rank = np.argsort(sym, kind="stable")
        order, sym = alive[rank], sym[rank]
        grown = age[order] + np.uint8(1)  # the length of each suffix
        fresh = grown == turn  # their tails came in the last round
        new = np.zeros(len(order), np.uint8)
        new[~fresh] = lcp[m:]
        pick = np.flatnonzero(fresh)
        pick = np.unique(np.concatenate([pick, pick + 1]))
        if len(pick) and pick[0] == 0:
            new[0], pick = 0, pick[1:]
        pick = pick[pick < len(order)]
        same = sym[pick] == sym[pick - 1]
        new[pick[~same]] = 0
        pick = pick[same]
        if len(pick):
            lo, hi = order[pick - 1] + 1, order[pick]
            level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
            mins, low = lcp, np.empty(len(pick), np.uint8)
            for d in range(int(level.max()) + 1):
                here = np.flatnonzero(level == d)
                low[here] = np.minimum(mins[lo[here]], mins[hi[here] - (1 << d) + 1])
                if d < int(level.max()):
                    mins = np.minimum(mins[: -(1 << d)], mins[1 << d :])
            new[pick] = np.minimum(low, most - 1) + 1
        files.put(at=np.concatenate([ends, at[order] - 1]), lcp=np.concatenate([np.zeros(m, np.uint8), new]), age=np.concatenate([np.zeros(m, np.uint8), grown]))
    at, lcp = files.get("at")[m:], files.get("lcp")[m:]
    files.close()
    return at, lcp


def least_documents(text: np.ndarray, size: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For every window of the strings, one string after the other, the least document of any string that holds the same window."""
    at, lcp = _order(text, size, length)
    base = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(size)), size)
    room = base[1:][owner] - np.arange(len(owner)) >= length
    best = np.where(room[at], docs[owner[at]], NOWHERE)
    start, end = runs(np.cumsum(lcp < length)) if len(lcp) else (np.zeros(0, np.int64),) * 2
    out = np.full(len(owner), NOWHERE, np.int64)
    if len(start):
        out[at] = np.repeat(np.minimum.reduceat(best, start), end - start)
    return out[room]


def _windows(data: np.ndarray, first: np.ndarray, size: np.ndarray, mark: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """The least document of every window of some pieces, as far as the pieces tell.

    Pieces are data[first : first + size], those of a mark next to one another,
    and equal windows have equal marks. A piece comes with the least document
    of its chunk; windows whose hash occurs once stand in no other piece. The strings left around recurring windows are collapsed; a mark
    with a single one is settled by it, all others form the collection.
    """
    b = data[spans(first, size)]
    base = np.concatenate([[0], np.cumsum(size)])
    n = size - length + 1
    owner = np.repeat(np.arange(len(size)), n)
    at = spans(base[:-1], n)
    up, down = powers(len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_TABLE[b] * up, out=total[1:])
    h = mix((total[at + length] - total[at]) * down[at])
    order = np.argsort(h, kind="stable")
    s, e = runs(h[order])
    again = np.zeros(len(h), bool)
    again[order] = np.repeat(e - s > 1, e - s)
    del h, order
    out = docs[owner]
    joint = np.zeros(len(at), bool)
    joint[1:] = again[1:] & again[:-1] & (owner[1:] == owner[:-1])
    begin = np.flatnonzero(again & ~joint)
    if not len(begin):
        return out
    last = np.flatnonzero(again & ~np.append(joint[1:], False))
    wide = last - begin + 1
    cut, stop = at[begin], at[last] + length
    name = mix((total[stop] - total[cut]) * down[cut] + wide.astype(np.uint64))
    m, d = mark[owner[begin]], docs[owner[begin]]
    order = np.lexsort((d, name, m))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (name[order][1:] != name[order][:-1]) | (m[order][1:] != m[order][:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(fresh) - 1
    one = order[fresh]  # the string of each name, with its least document
    size_1, doc_1 = wide[one], d[one]
    s, e = runs(m[one])
    several = np.repeat(e - s > 1, e - s)
    told = np.repeat(doc_1, size_1)
    if several.any():
        pick = one[several]
        told[np.repeat(several, size_1)] = least_documents(b[spans(cut[pick], wide[pick] + length - 1)], wide[pick] + length - 1, doc_1[several], length)
    where = np.cumsum(size_1) - size_1
    out[spans(begin, wide)] = told[spans(where[which], wide)]
    return out


class Pieces:
    """The strings of one chunk that may recur elsewhere, told apart by bucket, mark and a 64-bit hash of their bytes.

    A piece is a segment, or a single window of a heavy minimiser. The order of
    the distinct pieces follows from the texts alone, so a later pass over the
    chunk reads answers in the order in which an earlier one asked.
    """

    def __init__(self, group: pa.Table, length: int, k: int):
        ids, texts = group.column("id").to_pylist(), group.column("text").to_pylist()
        self.rows = pa.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i] or "")), pa.int64())
        self.ids = [ids[i] for i in self.rows.to_pylist()]
        self.data, self.offsets = utf8(group.column("text").take(self.rows))
        self.least = np.array([NOWHERE if i is None else i for i in self.ids], np.int64)
        self.length, self.k = length, k

    def minimisers(self, buckets: int):
        """Distinct minimisers (bucket and low half), different segments of each, and whether several documents hold it."""
        parts = [(h, seg, first + lo) for lo, _, _, h, first, _, seg in segments(self.data, self.offsets, self.length, self.k)]
        h, seg, at = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)
        doc = self.least[np.searchsorted(self.offsets, at, "right") - 1]
        key = (bucket_of(h, buckets) << np.uint64(32)) | (h & _HALF)
        order = np.lexsort((seg, key))
        key, seg, doc = key[order], seg[order], doc[order]
        start, _ = runs(key)
        if not len(start):
            return key, np.zeros(0, np.int64), np.zeros(0, bool)
        fresh = np.ones(len(key), np.int64)
        fresh[1:] = (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])
        return key[start], np.add.reduceat(fresh, start), np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start)

    def find(self, known: np.ndarray, heavy: np.ndarray, buckets: int) -> None:
        """Keep the pieces whose minimiser is known (sorted) to recur."""
        parts = []
        for lo, total, down, h, first, last, seg in segments(self.data, self.offsets, self.length, self.k) if len(known) else ():
            key = (bucket_of(h, buckets) << np.uint64(32)) | (h & _HALF)
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            hit = known[at] == key
            dense = hit & heavy[at]
            light = hit & ~dense
            parts.append((bucket_of(h[light], buckets), (h[light] & _HALF).astype(np.uint32), seg[light], first[light] + lo, (last - first + 1)[light]))
            if dense.any():
                w = spans(first[dense], (last - first + 1)[dense])
                name = mix((total[w + self.length] - total[w]) * down[w] + np.uint64(self.length))
                parts.append((bucket_of(name, buckets), (name & _HALF).astype(np.uint32), name, w + lo, np.ones(len(w), np.int64)))
        kinds = (np.uint64, np.uint32, np.uint64, np.int64, np.int64)
        where, mark, seg, self.first, self.wide = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, t) for t in kinds)
        doc = self.least[np.searchsorted(self.offsets, self.first, "right") - 1]
        order = np.lexsort((doc, seg, mark, where))
        fresh = np.ones(len(order), bool)
        for x in (where, mark, seg):
            y = x[order]
            fresh[1:] &= y[1:] == y[:-1]
        fresh[1:] = ~fresh[1:]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(fresh) - 1
        self.one = order[fresh]  # one piece of each kind, of the least document
        self.where, self.mark, self.doc = where[self.one].astype(np.int64), mark[self.one], doc[self.one]


def _size(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(x)]).astype(np.int64)


def remove_repeats(docs: DataFrame, length: int = 50, k: int = 20, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept, row struct): texts without what smaller documents hold.

    A byte goes when a string of `length` bytes over it also starts in a
    document with a smaller doc_id; strings are judged on the input, and never
    cross documents. A null or shorter text loses nothing. Rows with the same
    doc_id do not count as smaller than each other; a null doc_id neither loses
    bytes nor makes others lose any. With as_text, kept is a string, and
    partial code points that a cut leaves at its edges go with it. row holds
    the other columns of docs.
    """
    if not k < length <= 120:
        raise ValueError("length must be over k and at most 120")
    left, n = chunked(docs, id_col, text_col, chunk_bytes)
    kind = left.schema["row"].dataType
    left = left.groupBy("chunk")

    def ask(group: pa.Table) -> pa.Table:
        key, times, several = Pieces(group, length, k).minimisers(n)
        chunk = group.column("chunk")[0].as_py()
        note = (np.minimum(times, 32767) * 2 + several).astype("<u2")
        rows = [(int(key[a] >> np.uint64(32)), chunk, key[a:b].astype("<u4").tobytes(), pack(note[a:b])) for a, b in zip(*runs(key >> np.uint64(32)), strict=True)]
        return table(rows, [("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("notes", pa.binary())])

    def answer(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, "<u4") for x in group.column("keys").to_pylist()]
        note = np.concatenate([unpack(x, "<u2") for x in group.column("notes").to_pylist()])
        value, inverse, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        again = (count > 1) | (np.bincount(inverse, note & 1, len(value)) > 0)
        heavy = np.bincount(inverse, note >> 1, len(value)) > HEAVY
        bucket, at, rows = group.column("bucket")[0].as_py(), 0, []
        for chunk, x in zip(group.column("chunk").to_pylist(), keys, strict=True):
            mine = inverse[at : at + len(x)]
            at += len(x)
            hit = again[mine]
            if hit.any():
                rows.append((chunk, 0, bucket, x[hit].tobytes(), squeeze(np.packbits(heavy[mine[hit]]).tobytes())))
        return table(rows, _REPLY)

    known = left.applyInArrow(ask, "bucket int, chunk int, keys binary, notes binary").groupBy("bucket").applyInArrow(answer, _REPLY_DDL)

    def send(group: pa.Table, replies: pa.Table) -> pa.Table:
        if not group.num_rows:
            return table([], _SENT)
        c = Pieces(group, length, k)
        c.find(*_known(replies), n)
        chunk, rows = group.column("chunk")[0].as_py(), []
        first, size = c.first[c.one], c.wide[c.one] + length - 1
        for s, e in zip(*runs(c.where), strict=True):
            rows.append((int(c.where[s]), chunk, squeeze(c.data[spans(first[s:e], size[s:e])].tobytes()), pack(size[s:e].astype(np.uint8)), pack(c.doc[s:e].astype("<i8")), c.mark[s:e].astype("<u4").tobytes()))
        return table(rows, _SENT)

    def build(group: pa.Table) -> pa.Table:
        data = np.concatenate([np.frombuffer(expand(x.as_py()), np.uint8) for x in group.column("pieces")])
        size = [unpack(x.as_py(), np.uint8).astype(np.int64) for x in group.column("sizes")]
        told = np.cumsum([len(x) for x in size])
        size = np.concatenate(size)
        doc = np.concatenate([unpack(x.as_py(), "<i8") for x in group.column("docs")])
        mark = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in group.column("marks")])
        base, windows = _size(size), _size(size - length + 1)
        out = np.full(int(windows[-1]), NOWHERE, np.int64)
        order = np.argsort(mark, kind="stable")
        s, _ = runs(mark[order])
        grown = _size(size[order])
        at = 0
        while at < len(s):  # parts are cut between marks
            to = max(at + 1, int(np.searchsorted(grown[s], grown[s[at]] + COLLECTION)))
            part = order[s[at] : s[to] if to < len(s) else len(order)]
            out[spans(windows[part], size[part] - length + 1)] = _windows(data, base[part], size[part], mark[part], doc[part], length)
            at = to
        bucket, rows, lo = group.column("bucket")[0].as_py(), [], 0
        for chunk, hi in zip(group.column("chunk").to_pylist(), told.tolist(), strict=True):
            rows.append((chunk, 1, bucket, squeeze(out[windows[lo] : windows[hi]].astype("<i8").tobytes()), b""))
            lo = hi
        return table(rows, _REPLY)

    sent = left.cogroup(known.groupBy("chunk")).applyInArrow(send, "bucket int, chunk int, pieces binary, sizes binary, docs binary, marks binary")
    built = sent.groupBy("bucket").applyInArrow(build, _REPLY_DDL)
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.string() if as_text else pa.binary())]

    def cut(group: pa.Table, replies: pa.Table) -> pa.Table:
        if not group.num_rows:
            return table([], fields).append_column("row", group.column("row"))
        c = Pieces(group, length, k)
        c.find(*_known(replies), n)
        found = sorted(zip(replies.column("bucket").to_pylist(), (i for i in range(replies.num_rows)), replies.column("kind").to_pylist(), strict=True))
        payload = replies.column("payload")
        told = np.concatenate([np.zeros(0, "<i8"), *[np.frombuffer(expand(payload[i].as_py()), "<i8") for _, i, x in found if x == 1]])
        at = _size(c.wide[c.one])
        own = np.array([-NOWHERE if i is None else i for i in c.ids], np.int64)
        hit = np.zeros(len(c.data) + 1, bool)
        for lo in range(0, len(c.first), 1 << 15):
            first, wide = c.first[lo : lo + (1 << 15)], c.wide[lo : lo + (1 << 15)]
            mine = own[np.searchsorted(c.offsets, first, "right") - 1]
            hit[spans(first, wide)] = told[spans(at[c.which[lo : lo + (1 << 15)]], wide)] < np.repeat(mine, wide)
        seen = np.cumsum(hit, dtype=np.int32)
        gone = seen[:-1] > 0
        gone[length:] = seen[length:-1] > seen[: -length - 1]
        lost = _size(gone)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edge = c.offsets[:-1][np.diff(c.offsets) > 0]
        begins[edge] = gone[edge]
        starts = _size(begins)
        kept, off = c.data[~gone].tobytes(), c.offsets - lost[c.offsets]
        texts = [kept[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        cols = [c.ids, np.diff(c.offsets), np.diff(lost[c.offsets]), np.diff(starts[c.offsets]), [x.decode(errors="ignore") for x in texts] if as_text else texts]
        return pa.table([pa.array(x, t) for x, (_, t) in zip(cols, fields, strict=True)], [f for f, _ in fields]).append_column("row", group.column("row").take(c.rows))

    replies = known.unionByName(built).groupBy("chunk")
    schema = T.StructType.fromDDL(f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}").add("row", kind)
    return left.cogroup(replies).applyInArrow(cut, schema)


_REPLY = [("chunk", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary()), ("marks", pa.binary())]
_REPLY_DDL = "chunk int, kind int, bucket int, payload binary, marks binary"
_SENT = [("bucket", pa.int32()), ("chunk", pa.int32()), ("pieces", pa.binary()), ("sizes", pa.binary()), ("docs", pa.binary()), ("marks", pa.binary())]


def _known(replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The recurring minimisers of a chunk (bucket and low half, sorted) and which of them are heavy."""
    keys, heavy = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    found = sorted((b, i) for i, (x, b) in enumerate(zip(replies.column("kind").to_pylist(), replies.column("bucket").to_pylist(), strict=True)) if x == 0)
    for bucket, i in found:
        low = np.frombuffer(replies.column("payload")[i].as_py(), "<u4")
        keys.append((np.uint64(bucket) << np.uint64(32)) | low.astype(np.uint64))
        heavy.append(np.unpackbits(np.frombuffer(expand(replies.column("marks")[i].as_py()), np.uint8), count=len(low)).astype(bool))
    return np.concatenate(keys), np.concatenate(heavy)
