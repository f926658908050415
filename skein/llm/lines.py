"""Near-duplicate line removal by an exact set-similarity join.

A line is the set of its words. Chunks are ranges of doc_id, so (chunk, line
ordinal) is the order of lines. Equal sets are settled by their hash; the first
line of every set orders its words by rarity over the corpus and sends its
prefix to the buckets of those words. A bucket applies the length, positional
and bitmap filters (each a proven bound) and hands candidates back; the
candidate's words travel to the later line, where Jaccard is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.exchange import bucket_of, pack, runs, spans, table, unpack
from skein.llm.text import mix, utf8, word_hashes
from skein.session import materialize

_REPLY = [("chunk", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())]
_REPLY_DDL = "chunk int, kind int, bucket int, payload binary"
#: Kinds of replies: counts of words, lines whose set an earlier line has, lines that an earlier line resembles, unsettled lines.
COUNTS, REPEATS, REMOVED, UNSETTLED = range(4)
#: Earlier candidates of a line that one bucket reports at first; lines with more that all fail are asked about again without it.
FIRST = 64
#: Pairs of lines whose words one task compares at a time.
PAIRS = 8192
#: Bits of a word's hash in the sieve that the second round is held to; the sieve has 2**SIEVE places, whatever the corpus.
SIEVE = 20


class Lines:
    """The lines of one chunk in order of (doc_id, text, line number)."""

    def __init__(self, group: pa.Table):
        ids = group.column("id").to_pylist()
        raw = [x or b"" for x in group.column("text").cast(pa.binary()).to_pylist()]
        self.rows = sorted(range(len(raw)), key=lambda i: (ids[i] is None, ids[i] or 0, raw[i]))
        self.ids, self.texts = [ids[i] for i in self.rows], [raw[i] for i in self.rows]
        self.data, offsets = utf8(pa.array(self.texts, pa.large_binary()))
        breaks = np.flatnonzero(self.data == 10)
        self.offsets = np.append(np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable"), len(self.data))
        self.count = np.diff(np.searchsorted(breaks, offsets)) + 1
        self.first_line = np.concatenate([[0], np.cumsum(self.count)])
        self.usable = np.repeat(np.array([i is not None for i in self.ids], bool), self.count)

    def tokens(self, lines: np.ndarray | None = None) -> None:
        """The distinct words of the lines (or of some): names sorted by hash, and each word's line and name."""
        if lines is None:
            words, at = word_hashes(self.data, self.offsets)
        else:
            size = np.diff(self.offsets)[lines]
            words, at = word_hashes(self.data[spans(self.offsets[lines], size)], np.concatenate([[0], np.cumsum(size)]))
        code, names = pd.factorize(words)
        order = np.argsort(names, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.names, token = names[order], place[code]
        self.bits = np.int64(max(1, len(names)).bit_length())
        self.keys = (np.repeat(np.arange(len(at) - 1), np.diff(at)) << self.bits) | token


def _distinct(keys: np.ndarray, bits: np.int64) -> tuple[np.ndarray, np.ndarray]:
    """Lines and words of line-word keys, each once, in order."""
    keys = np.sort(keys)
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys >> bits, keys & ((np.int64(1) << bits) - 1)


def _ask(group: pa.Table, buckets: int) -> pa.Table:
    """Ask for the counts of all words, over the first lines of each set in this chunk, and for earlier lines with the same sets."""
    c, chunk, rows = Lines(group), group.column("chunk")[0].as_py(), []
    c.tokens()
    line, token = _distinct(c.keys, c.bits)
    size = np.bincount(line, minlength=len(c.usable))
    full, _ = runs(line)
    able = line[full][c.usable[line[full]]]
    sums = np.add.reduceat(mix(c.names)[token], full) if len(full) else np.zeros(0, np.uint64)
    sid = mix(sums + size[line[full]].astype(np.uint64))[c.usable[line[full]]] if len(full) else sums
    order = np.argsort(sid, kind="stable")
    sid, able = sid[order], able[order]
    start, _ = runs(sid)
    lead = np.zeros(len(size), bool)
    lead[able[start]] = True
    rest = np.ones(len(able), bool)
    rest[start] = False
    count = np.bincount(token[lead[line]], minlength=len(c.names))
    where = bucket_of(c.names, buckets)
    for a, b in zip(*runs(where), strict=True):
        rows.append((int(where[a]), chunk, COUNTS, c.names[a:b].astype("<u8").tobytes(), pack(count[a:b].astype("<u4"))))
    sid, able, again = sid[start], able[start], np.sort(able[rest])
    where = bucket_of(sid, buckets)
    for a, b in zip(*runs(where), strict=True):
        rows.append((int(where[a]), chunk, REPEATS, sid[a:b].astype("<u8").tobytes(), pack(able[a:b].astype("<u4"))))
    rows.append((chunk % buckets, chunk, REMOVED, b"", pack(again.astype("<u4"))))  # repeats within the chunk come back as they are
    return table(rows, [("bucket", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])


def _answer(group: pa.Table) -> pa.Table:
    bucket, out = group.column("bucket")[0].as_py(), []
    asked = list(zip(*(group.column(x).to_pylist() for x in ("chunk", "kind", "keys", "values")), strict=True))
    for kind in (COUNTS, REPEATS):
        mine = [(c, np.frombuffer(k, "<u8"), unpack(n, "<u4").astype(np.int64)) for c, x, k, n in asked if x == kind]
        if not mine:
            continue
        value, inverse = np.unique(np.concatenate([k for _, k, _ in mine]), return_inverse=True)
        if kind == COUNTS:
            told = np.bincount(inverse, np.concatenate([n for _, _, n in mine]), len(value)).astype("<i8")
        else:
            told = np.full(len(value), np.iinfo(np.int64).max)
            np.minimum.at(told, inverse, np.repeat([c for c, _, _ in mine], [len(k) for _, k, _ in mine]))
        at = 0
        for chunk, k, n in mine:
            x = told[inverse[at : at + len(k)]]
            at += len(k)
            out.append((chunk, kind, bucket, pack(x if kind == COUNTS else n[x != chunk].astype("<u4"))))
    out += [(c, REPEATS, -1, n) for c, x, _, n in asked if x == REMOVED]
    return table(out, _REPLY)


def _told(replies: pa.Table, kind: int, dtype: str) -> np.ndarray:
    found = sorted((b, p) for k, b, p in zip(*(replies.column(c).to_pylist() for c in ("kind", "bucket", "payload")), strict=True) if k == kind)
    return np.concatenate([unpack(p, dtype) for _, p in found]).astype(np.int64) if found else np.zeros(0, np.int64)


def _sieve(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - SIEVE)).astype(np.int64)


def _entries(group: pa.Table, replies: pa.Table, buckets: int, percent: int, sieve: np.ndarray | None) -> pa.Table:
    """The prefix of every first line of a set: words in order of rarity that no similar line can lack, if another line has them.

    With a sieve, only lines told to be unsettled look for others, and only words that may stand in them are sent.
    """
    fields = [("bucket", pa.int32()), ("chunk", pa.int32())] + [(x, pa.binary()) for x in ("words", "lines", "sizes", "places", "maps", "probes")]
    if not group.num_rows:
        return table([], fields)
    c = Lines(group)
    c.tokens()
    lead = c.usable.copy()
    lead[_told(replies, REPEATS, "<u4")] = False
    again = sieve is not None
    probe = np.full(len(lead), not again)
    probe[_told(replies, UNSETTLED, "<i8")] = True
    keys = c.keys[lead[c.keys >> c.bits]]
    token = keys & ((np.int64(1) << c.bits) - 1)
    df = _told(replies, COUNTS, "<i8")
    order = np.argsort(df, kind="stable")  # names are in order already
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    line, token = _distinct(((keys >> c.bits) << c.bits) | rank[token], c.bits)
    token = order[token]
    start, end = runs(line)
    place = np.arange(len(line)) - np.repeat(start, end - start)
    size = np.repeat(end - start, end - start)
    maps = np.zeros(len(lead), np.uint64)
    if len(start):
        maps[line[start]] = np.bitwise_xor.reduceat(np.uint64(1) << (c.names[token] >> np.uint64(58)), start)
    take = (place < size - -(-percent * size // 100) + 1) & (df[token] > 1)
    if again:
        take &= sieve[_sieve(c.names)][token]
    line, token, place, size = line[take], token[take], place[take], size[take]
    order = np.argsort(token, kind="stable")
    line, place, size, name = line[order], place[order], size[order], c.names[token[order]]
    where = bucket_of(name, buckets)
    chunk, rows = group.column("chunk")[0].as_py(), []
    for a, b in zip(*runs(where), strict=True):
        s = slice(a, b)
        rows.append((int(where[a]), chunk, name[s].astype("<u4").tobytes(), pack(line[s].astype("<u4")), pack(size[s].astype("<u4")), pack(place[s].astype("<u4")), maps[line[s]].astype("<u8").tobytes(), pack(probe[line[s]].astype("u1")) if again else b""))
    return table(rows, fields)


def _candidates(group: pa.Table, percent: int, first: int | None) -> pa.Table:
    """Per entry, the earlier entries of the same word that no filter rules out (the first few, and whether there are more)."""
    get = lambda name, kind: np.concatenate([unpack(x, kind) for x in group.column(name).to_pylist()]).astype(np.int64)
    sizes, places, lines = get("sizes", "<u4"), get("places", "<u4"), get("lines", "<u4")
    counts = [len(x) // 4 for x in group.column("words").to_pylist()]
    probe = get("probes", "u1").astype(bool) if first is None else np.ones(len(lines), bool)
    word = np.concatenate([np.frombuffer(x, "<u4") for x in group.column("words").to_pylist()])
    maps = np.concatenate([np.frombuffer(x, "<u8") for x in group.column("maps").to_pylist()])
    ref = (np.repeat(np.array(group.column("chunk").to_pylist(), np.int64), counts) << 32) | lines
    order = np.lexsort((ref, word))
    word, ref, sizes, places, maps, probe = (x[order] for x in (word, ref, sizes, places, maps, probe))

    def passing(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        # one filter after the other, each on what the one before it left
        a, b = sizes[i], sizes[j]
        ok = probe[j] & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
        at = np.flatnonzero(ok)
        a, b = a[at], b[at]
        need = -(-percent * (a + b) // (100 + percent))
        fits = np.minimum(a - places[i[at]], b - places[j[at]]) >= need
        at, room = at[fits], (a + b - 2 * need)[fits]
        ok[:] = False
        ok[at[np.bitwise_count(maps[i[at]] ^ maps[j[at]]) <= room]] = True
        return ok

    early, late, more = [], [], []

    def report(i: np.ndarray, j: np.ndarray) -> None:
        """Pairs with j ascending, and i ascending for each j."""
        if first is not None and len(j):
            s, e = runs(j)
            nth = np.arange(len(j)) - np.repeat(s, e - s)
            more.append(ref[j[s[e - s > first]]])
            i, j = i[nth < first], j[nth < first]
        early.append(ref[i])
        late.append(ref[j])

    start, end = runs(word)
    span = end - start
    small = np.flatnonzero((span > 1) & (span <= 64))
    if len(small):
        begin = np.repeat(start[small], span[small])
        at = spans(start[small], span[small])
        found_i, found_j = [], []
        for back in range(1, int(span[small].max())):
            keep = at - back >= begin
            at, begin = at[keep], begin[keep]
            ok = passing(at - back, at)
            found_i.append(at[ok] - back)
            found_j.append(at[ok])
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        order = np.lexsort((i, j))
        report(i[order], j[order])
    for a, b in zip(start[span > 64], end[span > 64], strict=True):
        for lo in range(a, b, 256):
            # a block of later entries against all earlier ones of the word, in blocks
            found_i, found_j = [], []
            hi = min(lo + 256, b)
            if not probe[lo:hi].any():
                continue
            seen = np.zeros(hi - lo, np.int64)
            for low in range(a, hi, 1024):
                j, i = np.nonzero(np.ones((hi - lo, min(low + 1024, hi) - low), bool))
                i, j = i + low, j + lo
                ok = i < j
                if first is not None:
                    ok &= seen[j - lo] <= first
                i, j = i[ok], j[ok]
                ok = passing(i, j)
                found_i.append(i[ok])
                found_j.append(j[ok])
                seen += np.bincount(j[ok] - lo, minlength=hi - lo)
            i, j = np.concatenate(found_i), np.concatenate(found_j)
            order = np.lexsort((i, j))
            report(i[order], j[order])
    fields = [("chunk", pa.int32()), ("pairs", pa.binary()), ("more", pa.bool_())]
    rows = []
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (early, late))
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    wanting = np.unique(np.concatenate(more)) if more else np.zeros(0, np.int64)
    for s, e in zip(*runs(i >> 32), strict=True):
        rows.append((int(i[s] >> 32), pack(np.concatenate([i[s:e], j[s:e]]).astype("<i8")), False))
    for s, e in zip(*runs(wanting >> 32), strict=True):
        rows.append((int(wanting[s] >> 32), pack(wanting[s:e].astype("<i8")), True))
    return table(rows, fields)


_SENT = [("chunk", pa.int32()), ("late", pa.binary()), ("which", pa.binary()), ("sizes", pa.binary()), ("words", pa.binary()), ("more", pa.bool_())]
_SENT_DDL = "chunk int, late binary, which binary, sizes binary, words binary, more boolean"


def _attach(group: pa.Table, asked: pa.Table) -> pa.Table:
    """Send the words of each earlier line to the chunks of the later lines it may equal."""
    chunk = asked.column("chunk")[0].as_py() if asked.num_rows else None
    found = [(unpack(p, "<i8"), m) for p, m in zip(asked.column("pairs").to_pylist(), asked.column("more").to_pylist(), strict=True)]
    rows = [(chunk, pack(p), b"", b"", b"", True) for p, m in found if m]
    pairs = [p.reshape(2, -1) for p, m in found if not m]
    if group.num_rows and pairs:
        c = Lines(group)
        i, j = np.concatenate(pairs, 1)
        order = np.lexsort((i, j))
        i, j = i[order] & 0xFFFFFFFF, j[order]
        fresh = np.concatenate([[True], (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        i, j = i[fresh], j[fresh]
        lines = np.unique(i)
        c.tokens(lines)
        owner, token = _distinct(c.keys, c.bits)
        size = np.bincount(owner, minlength=len(lines))
        at, name = np.concatenate([[0], np.cumsum(size)]), c.names[token]
        for s, e in zip(*runs(j >> 32), strict=True):
            mine, which = np.unique(np.searchsorted(lines, i[s:e]), return_inverse=True)
            rows.append((int(j[s] >> 32), pack((j[s:e] & 0xFFFFFFFF).astype("<i8")), pack(which.astype("<i8")), pack(size[mine].astype("<i8")), name[spans(at[mine], size[mine])].astype("<u8").tobytes(), False))
    return table(rows, _SENT)


def _verify(group: pa.Table, sent: pa.Table, percent: int) -> pa.Table:
    """Lines of this chunk that an earlier line matches, and those whose listed candidates all failed while others exist, with the sieve places of their words."""
    fields = [("chunk", pa.int32()), ("removed", pa.binary()), ("unsettled", pa.binary()), ("places", pa.binary())]
    if not group.num_rows or not sent.num_rows:
        return table([], fields)
    told = [(unpack(late, "<i8"), which, sizes, words, more) for late, which, sizes, words, more in zip(*(sent.column(x).to_pylist() for x in ("late", "which", "sizes", "words", "more")), strict=True)]
    wanting = np.unique(np.concatenate([np.zeros(0, np.int64), *[x & 0xFFFFFFFF for x, *_, more in told if more]]))
    lines = np.unique(np.concatenate([wanting, *[x for x, *_, more in told if not more]]))
    gone, places = np.zeros(len(lines), bool), np.zeros(0, np.int64)
    still = wanting
    if len(lines):
        c = Lines(group)
        c.tokens(lines)
        owner, token = _distinct(c.keys, c.bits)
        own_size = np.bincount(owner, minlength=len(lines))
        own_at, own = np.cumsum(own_size) - own_size, c.names[token]
        for late, which, sizes, words, more in told:
            if more:
                continue
            late, which, size = np.searchsorted(lines, late), unpack(which, "<i8"), unpack(sizes, "<i8")
            words, at = np.frombuffer(words, "<u8"), np.cumsum(size) - size
            for lo in range(0, len(late), PAIRS):
                j, w = late[lo : lo + PAIRS], which[lo : lo + PAIRS]
                a, b = own_size[j], size[w]
                code, names = pd.factorize(np.concatenate([own[spans(own_at[j], a)], words[spans(at[w], b)]]))
                pair = np.concatenate([np.repeat(np.arange(len(j)), a), np.repeat(np.arange(len(j)), b)])
                both = np.sort((pair << np.int64(max(1, len(names)).bit_length())) | code)
                common = np.bincount(both[1:][both[1:] == both[:-1]] >> np.int64(max(1, len(names)).bit_length()), minlength=len(j))
                gone[j[100 * common >= percent * (a + b - common)]] = True
        still = np.setdiff1d(wanting, lines[gone])
        at = np.searchsorted(lines, still)
        places = np.unique(_sieve(own[spans(own_at[at], own_size[at])]))
    chunk, lost = group.column("chunk")[0].as_py(), lines[gone]
    return table([(chunk, pack(lost.astype("<u4")), pack(still.astype("<i8")) if len(still) else b"", places.astype("<u4").tobytes())], fields)


def drop_near_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 4 << 20) -> DataFrame:
    """Rows (doc_id, n_lines, n_removed, removed array<int>, kept string, row struct): texts without lines that an earlier line resembles.

    Lines end at newlines; a line is the set of its words (A-Z folded), compared
    by 64-bit hashes. It goes when the set of an earlier line, in order of
    (doc_id, line number) and the same document included, has
    100*|intersection| >= percent*|union| with its own; lines are judged on the
    input, whether or not the earlier one stays. A line without words always
    stays. A null text counts as empty (one line). Rows that repeat a doc_id
    follow one another by text; rows with a null doc_id neither lose lines nor
    make others lose any. row holds the other columns of docs.
    """
    spark = docs.sparkSession
    text, doc = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // chunk_bytes))
    ids = docs.select(doc.alias("id")).where("id IS NOT NULL")
    edges = sorted(set(ids.approxQuantile("id", [i / n for i in range(1, n)], 1 / (4 * n)))) if n > 1 else []
    edges = np.array(edges or [0.0])

    @F.pandas_udf("int")
    def chunk_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.searchsorted(edges, s.to_numpy(np.float64, na_value=0.0), "right").astype(np.int32))

    other = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(doc.alias("id"), text.alias("text"), F.struct(F.lit(0).alias("_"), *other).alias("row"))
    chunk = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")).otherwise(chunk_of("id"))
    flat = rows.select(chunk.alias("chunk"), "id", "text", "row")
    kind = flat.schema["row"].dataType
    left = flat.groupBy("chunk")
    asked = left.applyInArrow(lambda group: _ask(group, n), "bucket int, chunk int, kind int, keys binary, values binary")
    known = materialize(asked.groupBy("bucket").applyInArrow(_answer, _REPLY_DDL), "counts")

    def settle(replies: DataFrame, sieve: np.ndarray | None) -> DataFrame:
        entries = left.cogroup(replies.groupBy("chunk")).applyInArrow(lambda g, r: _entries(g, r, n, percent, sieve), "bucket int, chunk int, words binary, lines binary, sizes binary, places binary, maps binary, probes binary")
        pairs = entries.groupBy("bucket").applyInArrow(lambda g: _candidates(g, percent, FIRST if sieve is None else None), "chunk int, pairs binary, more boolean")
        sent = left.cogroup(pairs.groupBy("chunk")).applyInArrow(_attach, _SENT_DDL)
        return materialize(left.cogroup(sent.groupBy("chunk")).applyInArrow(lambda g, s: _verify(g, s, percent), "chunk int, removed binary, unsettled binary, places binary"), "lines")

    def reply(frame: DataFrame, kind: int, column: str) -> DataFrame:
        return frame.select("chunk", F.lit(kind).alias("kind"), F.lit(0).alias("bucket"), F.col(column).alias("payload"))

    settled = settle(known, None)
    decided = reply(settled, REMOVED, "removed")
    unsettled = settled.where(F.octet_length("unsettled") > 0)
    if not unsettled.isEmpty():
        sieve = np.zeros(1 << SIEVE, bool)
        sieve[[r.place for r in unsettled.select("places").mapInArrow(_places, "place int").distinct().collect()]] = True  # 2**SIEVE rows at most
        decided = decided.unionByName(reply(settle(known.unionByName(reply(unsettled, UNSETTLED, "unsettled")), sieve), REMOVED, "removed"))

    def finish(group: pa.Table, told: pa.Table) -> pa.Table:
        fields = [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.int32())), ("kept", pa.string())]
        if not group.num_rows:
            return table([], fields).append_column("row", group.column("row"))
        c = Lines(group)
        gone = np.zeros(len(c.usable), bool)
        gone[_told(told, REPEATS, "<u4")] = True
        gone[_told(told, REMOVED, "<u4")] = True
        out = []
        for doc, text, a, b in zip(c.ids, c.texts, c.first_line[:-1], c.first_line[1:], strict=True):
            lost = np.flatnonzero(gone[a:b]).tolist()
            kept = text if not lost else b"\n".join(x for x, d in zip(text.split(b"\n"), gone[a:b], strict=True) if not d)
            out.append((doc, int(b - a), len(lost), lost, kept.decode()))
        return table(out, fields).append_column("row", group.column("row").take(pa.array(c.rows)))

    schema = T.StructType.fromDDL("doc_id long, n_lines long, n_removed long, removed array<int>, kept string").add("row", kind)
    return left.cogroup(known.where(F.col("kind") == REPEATS).unionByName(decided).groupBy("chunk")).applyInArrow(finish, schema)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, "<u4").astype(np.int32))], ["place"])
