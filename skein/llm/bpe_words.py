"""Pre-tokenisation into the matches of the byte-level pattern, and bounded word caches."""

from __future__ import annotations

import re

import regex

#: Where a text holds only these characters, the narrow pattern below finds the same matches as the general one.
_COMMON = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_NARROW = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+")

_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
#: The letters by which byte-level models spell bytes: printed ones of Latin-1 as they are, the others from U+0100 on.
LETTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def splitter(pattern: str):
    """A function from a text to its pattern matches in order."""
    import public_tokenizers

    general = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return general
    narrow, common = _NARROW.findall, _COMMON.fullmatch
    return lambda text: narrow(text) if common(text) else general(text)


class WordCache(dict):
    """Word to packed ids, filled on a miss, of at most `most` words.

    Half of them are the words of the moment; when they are that many, they
    become the older half in place of the former one, where a word is found
    again without work. So words that keep coming stay, and rare ones go.
    """

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.half, self.old = encode, max(1, most // 2), {}

    def __missing__(self, word: str) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            packed = self.encode(word)
        if len(word) <= 64:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[word] = packed
        return packed
