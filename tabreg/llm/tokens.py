"""Whole-text encoding with the ``tokenizers`` library inside tasks, with a word memo.

Byte-pair encoding works word by word: the library first cuts a text into words that never
cross white space, then encodes each word on its own. Running text repeats its words, so
the encoder keeps the ids of the words it has seen (a bounded memo per Python worker,
emptied when full, which changes only speed) and asks the library for new words only.
Whatever the word rule does not cover is encoded by the library as a whole: a tokenizer
file of another build, texts that hold the string of an added token or separators on which
Python and the library differ, and words outside the plain character ranges below.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import regex

# Fixed values of the tokenizer files whose words the memo knows: normaliser steps and word rule.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that NFC leaves alone and whose lower case does not depend on context.
PLAIN = regex.compile("[!-~¡-įı-ɏ‐-‧€]+")
UNLIKE_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")


class Memo(dict):
    """Results of a function by string, emptied when ``limit`` are held; long strings are
    computed each time."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key: str) -> bytes:
        value = self.compute(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


class TextEncoder:
    """``encode(text)`` gives the ids of the whole text, without special tokens, as
    little-endian unsigned 32-bit integers in a bytes object."""

    def __init__(self, path: str, memo_words: int = 500_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.added = sorted({t["content"][:2] for t in spec.get("added_tokens", [])})
        self.by_word = self._knows(spec)
        self.rule = regex.compile(WORD_RULE)
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)
        self.chunks = Memo(self._chunk, memo_words)
        self.words = Memo(self._word, memo_words)

    @staticmethod
    def _knows(spec: dict) -> bool:
        norm = (spec.get("normalizer") or {}).get("normalizers") or []
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        return ([n["type"] for n in norm] == NORMALIZERS
                and norm[1]["pattern"] == {"Regex": r"\s+"} and norm[1]["content"] == " "
                and [p["type"] for p in pre] == ["Split", "ByteLevel"]
                and pre[0]["pattern"] == {"Regex": WORD_RULE}
                and pre[0]["behavior"] == "Removed" and pre[0]["invert"]
                and not pre[1]["add_prefix_space"] and not pre[1].get("use_regex", True)
                and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
                and spec.get("post_processor") is None)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        mapped = word if word.isascii() else self.bytes_of.pre_tokenize_str(word)[0][0]
        return array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not (chunk.isascii() or PLAIN.fullmatch(chunk)) or not chunk.isprintable():
            return self.whole(chunk)
        low = chunk.lower()
        if low.isalpha():                                   # the two common shapes of the word rule
            return self.words[low]
        if low[-1] in ",." and low[:-1].isalpha():
            return self.words[low[:-1]] + self.words[low[-1]]
        return b"".join([self.words[w] for w in self.rule.findall(low)])

    def encode(self, text: str) -> bytes:
        if not self.by_word or any(a in text for a in self.added) or any(c in text for c in UNLIKE_SPACES):
            return self.whole(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
