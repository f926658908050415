"""Fingerprints, compression features and the network against plain loops."""

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from skein.llm import langid, toxicity
from skein.llm.fingerprint import Fingerprinter
from skein.llm.text import mix, shingle_hashes, utf8, word_hashes


@pytest.mark.parametrize("n", [1, 3, 40, 900])
def test_fingerprint_bin_by_bin(n):
    """The least hash of every bin, and for an empty bin that of the first full bin on its probe sequence."""
    rng = np.random.default_rng(n)
    text = " ".join(f"w{rng.integers(0, 5000)}" for _ in range(n))
    maker = Fingerprinter(5, 64)
    words, at = word_hashes(*utf8(pa.array([text], pa.large_string())))
    hashes = [int(x) for x in shingle_hashes(words, at, 5)[0]]
    least = {}
    for h in hashes:
        b = h >> 58
        least[b] = min(h, least.get(b, h))
    want = []
    for b in range(64):
        attempt = 0
        at_bin = b
        while at_bin not in least:
            pair = np.array([(b << 32) + attempt], np.uint64)
            at_bin = int(mix(mix(pair) + np.uint64(17))[0] % np.uint64(64))
            attempt += 1
        want.append(least[at_bin] & 255)
    assert list(maker.of_texts([text])[0]) == want
    assert maker.of_texts(["", " \n"]) == [b"", b""]


def test_compression_features_one_window_at_a_time():
    ordinary, toxic = b"the plain words of every day go here and there " * 20, b"zqxjkv brrglmph wuzzle " + b"the plain words of every day go here and there " * 20
    model = toxicity.CompressionClassifier(toxic, ordinary)
    rng = np.random.default_rng(1)
    text = b" ".join(rng.choice([b"plain", b"words", b"zqxjkv brrglmph", b"day", b"odd"]) for _ in range(900))
    pack = [zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (ordinary, toxic)]
    gains, at = [], 0
    while at == 0 or at + toxicity.WINDOW - toxicity.STEP < len(text):
        window = text[at : at + toxicity.WINDOW]
        gains.append(len(pack[0].compress(window)) - len(pack[1].compress(window)))
        at += toxicity.STEP
    blocks = [gains[i : i + toxicity.PASSAGE] for i in sorted({*range(0, max(1, len(gains) - toxicity.PASSAGE + 1), toxicity.PASSAGE // 2), max(0, len(gains) - toxicity.PASSAGE)})]
    want = [max(gains), sum(gains) / len(gains), sum(g >= 3 for g in gains) / len(gains), max(sum(sorted(b)[-3:]) / 3 for b in blocks), max(sum(b) / len(b) for b in blocks), max(sum(g >= 5 for g in b) / len(b) for b in blocks), max(sum(max(g - 2, 0) for g in b) for b in blocks)]
    assert np.allclose(model.features(text), want) and max(gains) > 5


def plain_logits(model, window):
    """The network on one window, position by position and filter by filter."""
    out = np.array(model.out_bias, float)
    wide = max(langid.WIDTHS)
    for k, width in enumerate(langid.WIDTHS):
        for f in range(k * langid.FILTERS, (k + 1) * langid.FILTERS):
            best = max(sum(float(model.embed[window[i + t], d]) * float(model.conv[t * langid.EMBED + d, f]) for t in range(width) for d in range(langid.EMBED)) for i in range(len(window) - wide + 1))
            out += max(best + float(model.bias[f]), 0) * model.out[f]
    return out


def test_network_forward():
    rng = np.random.default_rng(3)
    model = langid.ByteConvNet(["a", "b", "c"])
    windows = rng.integers(0, 256, (2, 20)).astype(np.uint8)
    got = model.logits(windows)
    assert np.allclose(got, [plain_logits(model, w) for w in windows], atol=1e-4)


def test_network_gradient():
    """One step of Adam moves every weight against the numeric gradient of the loss (its first step is the sign of the gradient)."""
    rng = np.random.default_rng(4)
    windows, labels = rng.integers(60, 70, (6, 24)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])

    def loss(model):
        s = model.logits(windows).astype(float)
        s -= s.max(1, keepdims=True)
        return -np.mean(s[np.arange(6), labels] - np.log(np.exp(s).sum(1)))

    before, after = langid.ByteConvNet(["a", "b"]), langid.ByteConvNet(["a", "b"])
    after.fit(windows, labels, epochs=1, batch=6, rate=1e-3)
    checked = 0
    for name, places in {"out": [(0, 0), (20, 1), (47, 0)], "out_bias": [(0,), (1,)], "bias": [(0,), (30,), (40,)], "conv": [(0, 0), (9, 20), (17, 40)], "embed": [(61, 0), (65, 3), (69, 7)]}.items():
        for at in places:
            probe = langid.ByteConvNet(["a", "b"])
            value = getattr(probe, name)
            value[at] += 1e-2
            up = loss(probe)
            value[at] -= 2e-2
            slope = (up - loss(probe)) / 2e-2
            if abs(slope) > 2e-4:
                checked += 1
                assert np.sign(getattr(after, name)[at] - getattr(before, name)[at]) == -np.sign(slope), (name, at)
    assert checked >= 6
    assert loss(after) < loss(before)
