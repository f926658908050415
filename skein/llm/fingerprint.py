"""One-permutation MinHash fingerprints with optimal densification and packed low-order bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.text import mix, shingle_hashes, utf8, word_hashes
from skein.session import materialize


class Fingerprinter:
    """Fingerprints of `bins` bytes: each shingle hash is computed once and falls into one bin.

    The top bits of a hash choose its bin, and a bin keeps its least hash. An
    empty bin probes bins by a universal hash of (bin, attempt) until it finds
    one that was not empty (optimal densification); the probe sequence depends
    on nothing else, so equal sets fill alike. The low eight bits are stored,
    and likeness corrects for their chance agreement.
    """

    def __init__(self, k: int = 5, bins: int = 256):
        self.k, self.bins = k, bins
        self.shift = np.uint64(64 - (bins - 1).bit_length())
        self.probes: list[np.ndarray] = []

    def _probe(self, t: int) -> np.ndarray:
        while len(self.probes) <= t:
            attempt = np.arange(64, dtype=np.uint64) + np.uint64(64 * len(self.probes))
            pair = np.arange(self.bins, dtype=np.uint64)[:, None] * np.uint64(1 << 32) + attempt[None, :]
            self.probes.append((mix(mix(pair) + np.uint64(17)) % np.uint64(self.bins)).astype(np.int64))
        return self.probes[t]

    def of_hashes(self, h: np.ndarray) -> bytes:
        """The packed fingerprint of one shingle set (repeats allowed); no shingles give no bytes."""
        if not len(h):
            return b""
        h = np.sort(h)
        bins = (h >> self.shift).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        value, full = np.zeros(self.bins, np.uint64), np.zeros(self.bins, bool)
        value[bins[first]], full[bins[first]] = h[first], True
        empty, t = np.flatnonzero(~full), 0
        while len(empty):
            probe = self._probe(t)[empty]
            hit = full[probe]
            at = hit.argmax(1)
            found = hit[np.arange(len(empty)), at]
            value[empty[found]] = value[probe[found, at[found]]]
            empty, t = empty[~found], t + 1
        return (value & np.uint64(255)).astype(np.uint8).tobytes()

    def of_texts(self, texts: list[str]) -> list[bytes]:
        words, at = word_hashes(*utf8(pa.array(texts, pa.large_string())))
        h, at = shingle_hashes(words, at, self.k)
        return [self.of_hashes(h[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]

    def likeness(self, a: bytes, b: bytes) -> float:
        """Estimated Jaccard similarity: agreement less the 1/256 that unequal values agree by chance; two empty sets are alike."""
        if not a or not b:
            return float(a == b)
        same = float(np.mean(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)))
        return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def fingerprints(docs: DataFrame, k: int = 5, bins: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fingerprint binary): the general form, one packed fingerprint per row.

    Shingles are k consecutive words, A-Z folded; a text of fewer words is one
    shingle; a null or empty text, or one of white space, has an empty fingerprint.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(k, bins)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                words, woff = word_hashes(*utf8(part.column(1)))
                h, off = shingle_hashes(words, woff, k)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([maker.of_hashes(h[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)], pa.binary())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint binary")


_PAIR = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compare(maker: Fingerprinter, doc: list, texts: list[str], nexts: list[str], own: list[bytes], other: list[bytes]) -> list[list]:
    from hashlib import sha256

    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, nexts, strict=True)]
    theirs = maker.of_texts(edited)
    return [doc, [len(a) for a in texts], [sha256(e.encode()).hexdigest() for e in edited], own, theirs, [maker.likeness(a, b) for a, b in zip(own, theirs, strict=True)], [maker.likeness(a, b) for a, b in zip(own, other, strict=True)]]


def edited_neighbours(docs: DataFrame, k: int = 5, bins: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint each text, its edited text and its successor by id, and how alike they are.

    The edited text replaces the last half (rounded down) by the start of the
    next text by ascending id; the last is followed by the first. Null ids come
    first, repeated ids are ordered by a hash of the text, a null text is empty.
    Rows are dealt by ranges of id and read once in order; only the first and
    last row of each range travel again, to pair neighbouring ranges.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ranged = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select(F.spark_partition_id().alias("range"), "doc_id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    edge = schema.append(pa.field("edge", pa.string())).append(pa.field("range", pa.int32())).append(pa.field("text", pa.string()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, held, place = Fingerprinter(k, bins), None, None

        def end(kind: str, row: tuple) -> pa.RecordBatch:
            blank = {f.name: [None] for f in edge}
            return pa.RecordBatch.from_pydict(blank | {"doc_id": [row[0]], "text": [row[1]], "fingerprint": [row[2]], "edge": [kind], "range": [place]}, edge)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                doc, texts = part.column(1).to_pylist(), part.column(2).to_pylist()
                prints = maker.of_texts(texts)
                if held is None:
                    place = part.column(0)[0].as_py()
                    yield end("first", (doc[0], texts[0], prints[0]))
                else:
                    doc, texts, prints = [held[0], *doc], [held[1], *texts], [held[2], *prints]
                held = doc[-1], texts[-1], prints[-1]
                if len(doc) > 1:
                    cols = _compare(maker, doc[:-1], texts[:-1], texts[1:], prints[:-1], prints[1:])
                    n = len(doc) - 1
                    yield pa.RecordBatch.from_pydict(dict(zip(schema.names, cols, strict=True)) | {"edge": [None] * n, "range": [None] * n, "text": [None] * n}, edge)
        if held is not None:
            yield end("last", held)

    walked = materialize(ranged.mapInArrow(walk, _PAIR + ", edge string, `range` int, text string"), "fingerprints")
    first = walked.where("edge = 'first'").select(F.col("range").alias("next_range"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    # one row per range of ids, whatever the table holds
    order = Window.orderBy("range")
    ends = walked.where("edge = 'last'").select("range", "doc_id", "text", "fingerprint")
    chain = ends.select("range", F.coalesce(F.lead("range").over(order), F.first("range").over(order)).alias("next_range"))
    paired = ends.join(chain, "range").join(first, "next_range").select("doc_id", "text", "next_text", "fingerprint", "next_print")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(k, bins)
        for batch in batches:
            doc, texts, nexts, own, other = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, _compare(maker, doc, texts, nexts, own, other), strict=True)), schema)

    return walked.where("edge IS NULL").select(*schema.names).unionByName(paired.mapInArrow(close, _PAIR))
