"""Language identification by a byte convolutional network, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
_letter = regex.compile(r"\p{L}").search


class ByteConvNet:
    """Byte embedding, filters of several widths, ReLU and max pooling over a window, softmax over languages."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng, wide, n = np.random.default_rng(seed), max(WIDTHS), FILTERS * len(WIDTHS)
        self.languages = languages
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.conv = rng.normal(0, 0.25, (wide * EMBED, n)).astype(np.float32)
        self.mask = np.zeros_like(self.conv)  # a filter of width w reads w bytes only
        for k, w in enumerate(WIDTHS):
            self.mask[: w * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
        self.conv *= self.mask
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def _columns(self, windows: np.ndarray) -> np.ndarray:
        wide = max(WIDTHS)
        e = self.embed[windows]
        return np.concatenate([e[:, t : windows.shape[1] - wide + 1 + t] for t in range(wide)], axis=2)

    def _features(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = self._columns(windows)
        return x, (x.reshape(-1, x.shape[2]) @ self.conv).reshape(*x.shape[:2], -1), self.bias

    def logits(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for i in range(0, len(windows), 32):
            _, z, bias = self._features(windows[i : i + 32])
            out[i : i + 32] = np.maximum(z.max(1) + bias, 0) @ self.out + self.out_bias
        return out

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 4e-3, seed: int = 11) -> None:
        """Adam on cross-entropy; only the position that wins the pooling gets a gradient."""
        rng = np.random.default_rng(seed)
        names = ("embed", "conv", "bias", "out", "out_bias")
        first, second, step = {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                w, y, m = windows[pick], labels[pick], len(pick)
                x, z, _ = self._features(w)
                top = z.argmax(1)
                pooled = np.take_along_axis(z, top[:, None, :], 1)[:, 0] + self.bias
                act = np.maximum(pooled, 0)
                s = act @ self.out + self.out_bias
                p = np.exp(s - s.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(m), y] -= 1
                p /= m
                back = (p @ self.out.T) * (pooled > 0)
                seen = x[np.arange(m)[:, None], top]  # what each filter saw where it won
                grad = {"out": act.T @ p, "out_bias": p.sum(0), "bias": back.sum(0), "conv": np.einsum("mf,mfd->df", back, seen) * self.mask}
                into = back[:, :, None] * self.conv.T[None]
                e = np.zeros_like(self.embed)
                for t in range(max(WIDTHS)):
                    np.add.at(e, w[np.arange(m)[:, None], top + t], into[:, :, t * EMBED : (t + 1) * EMBED])
                grad["embed"], step = e, step + 1
                for n in names:
                    first[n] = 0.9 * first[n] + 0.1 * grad[n]
                    second[n] = 0.999 * second[n] + 0.001 * grad[n] ** 2
                    value = getattr(self, n)
                    value -= (rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def windows_of(text: bytes) -> np.ndarray:
    """All of the text in windows of fixed length; the last is filled up with spaces."""
    n = -(-len(text) // WINDOW)
    out = np.full(n * WINDOW, 32, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


def train(labelled: DataFrame, docs_per_language: int = 400, windows_per_doc: int = 6, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> ByteConvNet | None:
    """Fit the network on a bounded sample: at most docs_per_language rows of each language, those of least hash of id and text.

    Rows without text or language teach nothing. Of each text, windows_per_doc
    windows spread over its whole length are cut on the executors and come to
    the driver, some shortened so that short texts are known too. No usable row
    gives no model.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("l"))
    first = Window.partitionBy("l").orderBy(F.xxhash64("i", "t"), "i")  # a limit per group, taken before the shuffle too
    chosen = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= docs_per_language)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, nth, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                w = windows_of(text.encode())
                out += [(lang, nth, int(at), w[at].tobytes()) for at in np.unique(np.linspace(0, len(w) - 1, windows_per_doc).astype(int))] if len(w) else [(lang, nth, 0, None)]
            cols = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["l", "nth", "at", "w"])

    sample = chosen.select("l", "nth", "t").mapInArrow(cut, "l string, nth int, at long, w binary").collect()
    if not sample:
        return None
    languages, rng = sorted({r["l"] for r in sample}), np.random.default_rng(5)
    x, y = [], []
    for row in sorted((r for r in sample if r["w"] is not None), key=lambda r: (r["l"], r["nth"], r["at"])):
        one = np.frombuffer(row["w"], np.uint8).copy()
        if rng.random() < 0.3:
            one[int(rng.integers(12, WINDOW)) :] = 32
        x.append(one)
        y.append(languages.index(row["l"]))
    model = ByteConvNet(languages)
    if x:
        model.fit(np.array(x), np.array(y))
    return model


def predict(docs: DataFrame, model: ByteConvNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, lang_pred, score): the language of each whole text and its probability.

    Window scores are averaged by window length. A null text, one without any
    letter, or the lack of a model gives 'und' with score 0. Repeated rows and
    null ids pass through; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = [], []
            for at in range(0, batch.num_rows, 64):
                texts = [x.as_py() for x in batch.column(1).slice(at, 64)]
                known = [model is not None and x is not None and _letter(x) is not None for x in texts]
                parts = [x.encode() for x, k in zip(texts, known, strict=True) if k]
                stacks = [windows_of(x) for x in parts]
                logits = model.logits(np.concatenate(stacks)) if stacks else None
                i = 0
                sums = []
                for raw, w in zip(parts, stacks, strict=True):
                    weight = np.full(len(w), WINDOW, np.float64)
                    weight[-1] = len(raw) - (len(w) - 1) * WINDOW
                    s = weight @ logits[i : i + len(w)] / weight.sum()
                    p = np.exp(s - s.max())
                    sums.append(p / p.sum())
                    i += len(w)
                found = iter(sums)
                for k in known:
                    p = next(found) if k else None
                    pred.append("und" if p is None else model.languages[int(p.argmax())])
                    score.append(0.0 if p is None else float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
