"""Ids of the word-end BPE vocabulary (lower-cased words, white space dropped).

A text is normalised and split into words, and each word is encoded on its
own; a word's last byte and its end mark are one symbol.  In the fast form
the end mark is the character U+001E, appended to every word before the
merges.  Texts with characters outside the checked range, with that mark or
with a special token are encoded by the ``tokenizers`` library itself.

The ids of a word do not depend on its neighbours, so a worker remembers the
words it has met, at most about ``KNOWN`` of them and eight ids for each, and
then starts anew; a word's ids are the same either way.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import cached_property

import numpy as np

from pomelo.llm.bpe_tree import byte_symbols, library_encoder, vocab_path

VOCAB = "word_bpe_49k.json"
MARK = "\x1e"
LAST = 0x17F    # up to here lower-case forms stay in the range, but for U+0130 (its lower case is two characters)
_OTHER = re.compile(f"[^\x00-{chr(LAST)}]|İ|{MARK}")
KNOWN = 1 << 18     # words a worker remembers
WHITE = "\t\n\x0b\x0c\r \x85\xa0"


def _char_class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(LAST + 1) if unicodedata.category(chr(c))[0] == kind)


_L, _N = _char_class("L"), _char_class("N")
# Fixed value: how the vocabulary splits a lower-cased text, with the classes written out.
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{re.escape(WHITE)}{_L}{_N}]+")


class _Words(dict):
    """Numbers of words in the order they were met; ``new`` are those not encoded yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class WordBpe:
    def __init__(self, vocab: str = VOCAB):
        import tiktoken

        self.path = vocab_path(vocab)
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols, end = byte_symbols(), spec["model"]["end_of_word_suffix"]
        special = [t["content"] for t in spec["added_tokens"]]
        ranks = {}
        for s, i in spec["model"]["vocab"].items():
            if s not in special:
                word = s.removesuffix(end)
                ranks[bytes(symbols[c] for c in word) + (MARK.encode() if word != s else b"")] = i
        self._special = re.compile("|".join(map(re.escape, special)))
        self.fast = tiktoken.Encoding("words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={})
        self._last = np.zeros(max(ranks.values()) + 1, bool)        # ids that end a word
        self._last[[i for b, i in ranks.items() if b.endswith(MARK.encode())]] = True
        self._forget()

    def _forget(self) -> None:
        self.words, self.ids, self.ends = _Words(), array("I"), array("q", [0])

    def _learn(self) -> None:
        """Encode the new words, all in one call."""
        ids = self.fast.encode_to_numpy(MARK.join(self.words.new) + MARK)
        ends = np.flatnonzero(self._last[ids]) + 1
        self.ends.frombytes((ends + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(np.uint32).tobytes())
        self.words.new = []

    @cached_property
    def slow(self):
        """The library's own encoder, loaded when a text needs it."""
        return library_encoder(self.path)

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        plain = text.isascii() and MARK not in text
        if not plain and _OTHER.search(text) or self._special.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        words = WORDS.findall(text.lower())
        if len(self.words) > KNOWN or len(self.ids) > 8 * KNOWN:
            self._forget()
        number = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        if self.words.new:
            self._learn()
        ends = np.frombuffer(self.ends, np.int64)
        start, size = ends[number], ends[number + 1] - ends[number]
        before = np.cumsum(size) - size
        at = np.repeat(start - before, size) + np.arange(size.sum())
        return np.frombuffer(self.ids, np.uint32)[at] if len(at) else np.zeros(0, np.uint32)


_ENCODERS: dict[str, WordBpe] = {}


def encoder(vocab: str) -> WordBpe:
    """One encoder per worker process and vocabulary."""
    if vocab not in _ENCODERS:
        _ENCODERS[vocab] = WordBpe(vocab)
    return _ENCODERS[vocab]
