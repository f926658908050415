import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skein.llm import bpe, packing
from skein.llm.bpe_words import WordCache, splitter

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
REAL = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_merges_equal_the_library(text):
    split = splitter(P.PATTERN)
    assert [i for w in split(text) for i in bpe.merge_word(w.encode(), RANKS)] == REAL.encode_ordinary(text)


def test_long_matches():
    for text in ("a" * 5000, "ab" * 3000, " " * 4000, "é" * 2000, "<|endoftext|>" * 3):
        assert [i for w in splitter(P.PATTERN)(text) for i in bpe.merge_word(w.encode(), RANKS)] == REAL.encode_ordinary(text)


def test_round_trip(docs, rows, odd, nothing):
    for frame, want in ((docs, rows), (odd, None)):
        out = bpe.decode(bpe.encode(frame, PATH, P.PATTERN), PATH, P.PATTERN).collect()
        assert len(out) == frame.count()
        if want:
            texts = {r[0]: r[1] or "" for r in want}
            for r in out:
                assert np.frombuffer(r.ids, "<u4").tolist() == REAL.encode_ordinary(texts[r.doc_id])
                assert bytes(r.decoded).decode() == texts[r.doc_id]
    assert bpe.decode(bpe.encode(nothing, PATH, P.PATTERN), PATH, P.PATTERN).count() == 0


@pytest.mark.parametrize("limit", [16, 1024])
def test_packing(docs, rows, limit):
    real = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out = packing.pack(packing.tokenized_pieces(docs, P.path("byte_bpe_50k.json"), limit), limit).collect()
    by, bins = defaultdict(list), defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for doc, text, *_ in rows:
        ids, at = np.array([*real.encode(text or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for k, r in enumerate(sorted(by[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and 0 < r.length <= limit and (k == 0 or r.length == limit)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    total = 0
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
        total += at
    assert len(bins) <= total / limit * 1.1 + 2


def test_packing_odd(odd, nothing):
    out = packing.pack(packing.tokenized_pieces(odd, P.path("byte_bpe_50k.json"), 64), 64)
    assert out.where("doc_id IS NULL").count() >= 2
    assert packing.pack(packing.tokenized_pieces(nothing, P.path("byte_bpe_50k.json"))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), min_size=1, max_size=12), st.sampled_from(["norm", "dot"]), st.integers(2, 9))
def test_every_capacity_holds(counts, rule, docs_limit):
    plan = packing.plan_bins(counts, (64, docs_limit, 2600.0 + 1500), (1.0, 0.5, 0.5), rule) if max(counts) ** 2 <= 4100 else np.zeros((0, 5), int)
    placed, used = defaultdict(int), defaultdict(lambda: np.zeros(3))
    for length, rank, at, n, _ in plan.tolist():
        assert rank == placed[length]
        placed[length] += n
        for b in range(at, at + n):
            used[b] += (length, 1, length**2)
    if len(plan):
        assert placed == counts
        assert all((u <= (64, docs_limit, 4100)).all() for u in used.values())


def test_added_tokens_as_the_library_finds_them(spark):
    path = P.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a <|endof", "x" * 3000 + "<|endoftext|><|endoftext|> y"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in packing.tokenized_pieces(frame, path).collect():
        got.setdefault(r.doc_id, {})[r.piece] = (r.start, r.length, r.ids_crc32)
    for i, text in enumerate(texts):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        for start, length, crc in got[i].values():
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
        assert sum(n for _, n, _ in got[i].values()) == len(ids)


def test_words_that_keep_coming_are_encoded_once():
    asked = []
    words = WordCache(lambda w: asked.append(w) or w.encode(), 8)
    for i in range(100):
        assert (words["the"], words[f"rare{i}"]) == (b"the", b"rare%d" % i)
        assert len(words) + len(words.old) <= 8
    assert asked.count("the") == 1
    assert words["x" * 65] == b"x" * 65 and "x" * 65 not in words


def test_matches_of_any_bytes_are_as_the_library_gives_them():
    real = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encode = packing._encoder(P.path("byte_bpe_50k.json"), 1000)
    for text in ["".join(map(chr, range(0x180))), "a" * 3000, " \x00\x7f\x85\xa0\xadÿ  x", "日本語 naïve 😀\r\n\t  end  ", *(chr(b) for b in range(256))]:
        assert np.frombuffer(encode(text), "<u4").tolist() == real.encode(text, add_special_tokens=False).ids
