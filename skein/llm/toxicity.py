"""Toxicity by compression distance: two zstandard dictionaries, window by window."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW, STEP, LEVEL = 64, 48, 8
#: Windows of a passage: features are taken by passage, so they mean the same in a text of any length.
PASSAGE = 32


def _windows(text: bytes) -> list[bytes]:
    return [text[i : i + WINDOW] for i in range(0, max(1, len(text) - WINDOW + STEP), STEP)]


class CompressionClassifier:
    """Compares how well a toxic and an ordinary dictionary compress each window of a text.

    Both dictionaries hold the same ordinary passages; the toxic one holds
    besides the fragments that mark toxic text, so the difference of the two
    compressed lengths of a window is what those fragments save. The document
    features (largest gain; mean and share of windows above a threshold over the
    text; three largest, mean, share and excess of the passage of 32 windows
    that has most of each) are turned into a calibrated probability by logistic
    regression. None of them adds up over a text, so all keep their range
    however long it is.
    """

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = toxic, ordinary
        self.weights, self.mean, self.scale = np.zeros(8), np.zeros(7), np.ones(7)
        self.constant: float | None = None
        self._ready = None

    def __getstate__(self):
        return self.__dict__ | {"_ready": None}

    def _compressors(self):
        if self._ready is None:
            import zstandard

            made = []
            for content in (self.ordinary, self.toxic):
                dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(LEVEL)
                made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
            self._ready = made
        return self._ready

    def features(self, text: bytes) -> np.ndarray:
        ordinary, toxic = self._compressors()
        gain = np.fromiter((len(ordinary(w)) - len(toxic(w)) for w in _windows(text)), float)
        starts = sorted({*range(0, max(1, len(gain) - PASSAGE + 1), PASSAGE // 2), max(0, len(gain) - PASSAGE)})
        block = np.lib.stride_tricks.sliding_window_view(gain, min(PASSAGE, len(gain)))[starts]
        top = np.sort(block, 1)[:, -3:].sum(1) / 3
        return np.array([gain.max(), gain.mean(), (gain >= 3).mean(), top.max(), block.mean(1).max(), (block >= 5).mean(1).max(), np.maximum(block - 2, 0).sum(1).max()])

    def calibrate(self, x: np.ndarray, labels: np.ndarray, prevalence: float) -> None:
        """Logistic regression over features, with the classes weighted to their share among all labelled rows."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        x = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        each = np.where(labels == 1, prevalence / labels.mean(), (1 - prevalence) / (1 - labels.mean())) / len(labels)
        self.weights = np.zeros(x.shape[1])
        for _ in range(4000):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            self.weights -= 0.5 * (x.T @ ((p - labels) * each) + 1e-4 * self.weights)

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        return float(self.probability(self.features(text)[None])[0])

    def probability(self, x: np.ndarray) -> np.ndarray:
        x = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))

    def held_out_loss(self, x: np.ndarray, labels: np.ndarray, prevalence: float) -> float:
        """Mean log loss, weighted to prevalence, of each half of the rows under a fit to the other half."""
        loss, odd = 0.0, np.arange(len(x)) % 2 == 1
        for half in (odd, ~odd):
            if not 0 < labels[~half].mean() < 1 or not 0 < labels[half].mean() < 1:
                return np.inf
            self.calibrate(x[~half], labels[~half], prevalence)
            p, y = self.probability(x[half]), labels[half]
            loss -= prevalence * np.log(p[y == 1]).mean() + (1 - prevalence) * np.log(1 - p[y == 0]).mean()
        return loss / 2


def _grams(texts: list[bytes], n: int, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Byte n-grams (n up to 8; those of the sorted keep only) and in how many different surroundings each stands.

    Counting surroundings (the 8 bytes before) and not documents makes a text and
    its copies count once.
    """
    found = []
    for text in texts:
        b = np.frombuffer(b"\0" * 8 + text + b"\0" * 8, np.uint8)
        whole = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(b, 8)).view("<u8").ravel()
        gram = whole[8 : 8 + max(0, len(text) - n + 1)] & np.uint64((1 << 8 * n) - 1)
        pairs = np.stack([gram, whole[: len(gram)]], 1)
        if keep is not None:
            pairs = pairs[keep[np.minimum(np.searchsorted(keep, gram), len(keep) - 1)] == gram] if len(keep) else pairs[:0]
        found.append(pairs)
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(1)
    return np.unique(pairs[new, 0], return_counts=True)


def _grown(fragment: bytes, text: bytes, share: float = 0.7, longest: int = 24) -> bytes:
    """The fragment with the neighbours that stand beside most of its occurrences."""
    at, places = text.find(fragment), []
    while at >= 0:
        places.append(at)
        at = text.find(fragment, at + 1)
    for side in (-1, 1):
        reach = 0
        while len(fragment) < longest:
            seen: dict[int, int] = {}
            for p in places:
                i = p - 1 - reach if side < 0 else p + len(fragment)
                if 0 <= i < len(text):
                    seen[text[i]] = seen.get(text[i], 0) + 1
            byte, count = max(seen.items(), key=lambda x: (x[1], -x[0]), default=(0, 0))
            if count < share * len(places) or byte == 0:
                break
            keep = [p for p in places if 0 <= (i := p - 1 - reach if side < 0 else p + len(fragment)) < len(text) and text[i] == byte]
            fragment, places = (bytes([byte]) + fragment, [p - 1 for p in keep]) if side < 0 else (fragment + bytes([byte]), keep)
    return fragment


def _fragments(toxic: list[bytes], ordinary: list[bytes], size: int, least: int = 4, odds: float = 8.0) -> list[bytes]:
    """The byte strings that set toxic texts apart, strongest first.

    Six-byte strings in at least `least` surroundings and `odds` times as frequent
    as in ordinary text are ranked by count times log odds and grown to the longest
    string around them. All of them are taken, up to size bytes.
    """
    volume = sum(map(len, toxic)) / max(1, sum(map(len, ordinary)))
    gram, count = _grams(toxic, 6)
    gram, count = gram[count >= least], count[count >= least]
    other, theirs = _grams(ordinary, 6, gram)
    there = np.zeros(len(gram))
    there[np.searchsorted(gram, other)] = theirs
    ratio = count / ((there + 0.5) * volume)
    weight = np.where(ratio >= odds, count * np.log(np.maximum(ratio, 1)), 0)
    kept: list[bytes] = []
    joined = b"\0".join(toxic)
    for i in np.argsort(-weight, kind="stable"):
        g = int(gram[i]).to_bytes(8, "little")[:6]
        if weight[i] <= 0 or sum(map(len, kept)) >= size:
            break
        if not any(g in f for f in kept):
            g = _grown(g, joined)
            at = next((j for j, f in enumerate(kept) if f in g), len(kept))  # takes the place of the strongest it covers
            kept = [*kept[:at], g, *(f for f in kept[at:] if f not in g)]
    return kept


def _passages(texts: list[bytes], size: int, width: int = 100) -> bytes:
    """Passages of up to width bytes, from as many of the texts as fill size, one after another from start to end."""
    picked = texts[: -(-size // width)]
    starts = ((len(t) - width) * i // max(1, len(picked) - 1) for i, t in enumerate(picked))
    return b" ".join(t[max(0, a) : max(0, a) + width] for a, t in zip(starts, picked, strict=True))[:size]


def fit(toxic: list[bytes], ordinary: list[bytes], prevalence: float, dictionary_bytes: int, common_bytes: int) -> CompressionClassifier:
    """Dictionaries from half of the toxic and two thirds of the ordinary texts, calibrated on the others.

    Fragments that pass the tests of _fragments are candidates up to
    dictionary_bytes. How many help depends on how much toxic text there is to
    learn from, so all of them and the strongest 250, 500, 1000 ... bytes are
    tried, and the one with the least loss on rows held out of the fit is taken.
    """
    half, calm = len(toxic) // 2, len(ordinary) * 2 // 3
    fragments = _fragments(toxic[:half], ordinary[:calm], dictionary_bytes)
    common = _passages(ordinary[:calm], common_bytes)
    check = toxic[half:] + ordinary[calm:]
    labels = np.array([1.0] * (len(toxic) - half) + [0.0] * (len(ordinary) - calm))
    ends = np.cumsum([len(f) for f in fragments])
    total, best = int(ends[-1]) if len(ends) else 0, None
    for size in [*(n for n in (250 << k for k in range(16)) if n < total), total]:
        taken = fragments[: int(np.searchsorted(ends, size, "right"))]
        model = CompressionClassifier((b"".join(taken[::-1]) + common) or b" " * 8, common or b" " * 8)
        x = np.array([model.features(t) for t in check])
        loss = model.held_out_loss(x, labels, prevalence)
        if best is None or loss < best[0]:
            best = loss, model, x
    _, model, x = best
    model.calibrate(x, labels, prevalence)
    return model


def train(docs: DataFrame, labels: DataFrame, docs_per_class: int = 2500, dictionary_bytes: int = 65536, common_bytes: int = 12000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> CompressionClassifier:
    """Fit on a bounded sample of rows: docs_per_class labelled ids of each class by a hash of the id, with their whole texts.

    The sample is drawn from labels alone and only then sent to docs, so no text
    is shuffled. Half of the toxic sample builds the dictionary, the other half
    calibrates. An id labelled twice counts as toxic if any label says so; null
    labels and ids teach nothing, nor do ids without a text; of ids that stand on
    several texts, no more than docs_per_class rows a class are used. Without both
    classes the score is constant: 1.0 when only toxic texts were seen, else 0.0.
    """
    marks = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("i")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    counts = {0: 0, 1: 0} | {r["y"]: r["count"] for r in marks.groupBy("y").count().collect()}
    order = F.xxhash64(F.col("i").cast("string"))
    picked = [marks.where(F.col("y") == y).orderBy(order, "i").limit(docs_per_class) for y in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most twice docs_per_class rows
    found = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).join(sample, "i").select("y", order.alias("h"), "t")
    nth = F.row_number().over(Window.partitionBy("y").orderBy("h", F.xxhash64("t")))  # an id can stand on many texts: the bound holds for rows
    found = found.withColumn("nth", nth).where(F.col("nth") <= docs_per_class).collect()
    found.sort(key=lambda r: (r["h"], r["t"]))
    texts = {y: list(dict.fromkeys(r["t"].encode() for r in found if r["y"] == y)) for y in (1, 0)}
    if not texts[0] or len(texts[1]) < 2:
        model = CompressionClassifier(b"", b"")
        model.constant = 1.0 if texts[1] and not texts[0] else 0.0
        return model
    return fit(texts[1], texts[0], counts[1] / (counts[0] + counts[1]), dictionary_bytes, common_bytes)


def score(docs: DataFrame, model: CompressionClassifier, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, score, predicted) over every window of every text; predicted is 1 from the threshold on.

    A null text counts as empty and gets a score as well. Repeated rows and null
    ids pass through; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([model.score((x.as_py() or "").encode()) for x in batch.column(1)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def reject(docs: DataFrame, model: CompressionClassifier, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs that score below threshold, with all their columns; nothing is shuffled."""
    plain = docs.schema[text_col].dataType == T.StringType()
    scored = text_col if plain else f"_scored_{uuid.uuid4().hex}"  # no text travels twice; else a name that no column of docs bears

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [model.score((x.as_py() or "").encode()) < threshold for x in batch.column(scored)]
            left = batch.filter(pa.array(s, pa.bool_()))
            yield left if plain else left.drop_columns([scored])

    return (docs if plain else docs.withColumn(scored, F.col(text_col).cast("string"))).mapInArrow(run, docs.schema)
