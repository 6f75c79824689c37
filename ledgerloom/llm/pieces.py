"""Whole texts through the tokenizers library, with repeated words taken from a cache."""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

from ledgerloom.llm.bpe import _Cache, byte_alphabet

CACHED_CHUNKS = 50_000
CACHED_WORDS = 350_000

# The normalizers and the pattern of vocabularies that lower-case a text, drop its
# white space and cut it into these words.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# Texts of these characters only: normal form C leaves them alone, and the pattern below, applied
# to their lower case, classifies them as the vocabulary's own does.
_SIMPLE = re.compile("[ -~À-ÖØ-öø-ÿ\n]*")
_SIMPLE_WORDS = re.compile("[a-zß-öø-ÿ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\\sa-z0-9ß-öø-ÿ]+")


class SplittingEncoder:
    """Ids of a text as the library's ``encode(text, add_special_tokens=False)`` gives them.

    If the vocabulary drops white space, no token spans a space, so the library is asked once for
    each distinct chunk and word; other vocabularies get every text as a whole.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        spec = json.loads(definition)
        splitter = spec["pre_tokenizer"] or {}
        steps = splitter.get("pretokenizers", [])
        self._splits = (
            (spec["normalizer"] or {}).get("normalizers") == _NORMALIZERS
            and len(steps) == 2
            and steps[0] == {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}
            and steps[1]["type"] == "ByteLevel"
            and not steps[1]["add_prefix_space"]
            and not steps[1]["use_regex"]
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]
                        or "<|" not in t["content"] for t in spec["added_tokens"])
        )
        self._to_chars = dict(enumerate(byte_alphabet()))
        self._chunks = _Cache(self._chunk, CACHED_CHUNKS)
        self._words = _Cache(self._word, CACHED_WORDS)

    def encode(self, text: str | None, kind: np.dtype) -> bytes:
        """The ids of the text as packed numbers of ``kind``."""
        if not text:
            return b""
        if not self._splits:
            return self._pack(self._tokenizer.encode(text, add_special_tokens=False).ids, kind)
        self._kind = kind
        if _SIMPLE.fullmatch(text) and "<|" not in text:
            return b"".join(map(self._words.__getitem__, _SIMPLE_WORDS.findall(text.lower())))
        return b"".join(map(self._chunks.__getitem__, text.replace("\n", " ").split(" ")))

    @staticmethod
    def _pack(ids: list[int], kind: np.dtype) -> bytes:
        return array(kind.char, ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if _SIMPLE.fullmatch(chunk) and "<|" not in chunk:
            return b"".join(map(self._words.__getitem__, _SIMPLE_WORDS.findall(chunk.lower())))
        return self._pack(self._tokenizer.encode(chunk, add_special_tokens=False).ids, self._kind)

    def _word(self, word: str) -> bytes:
        symbols = word
        if not word.isascii():
            symbols = word.encode().decode("latin-1").translate(self._to_chars)
        return self._pack([t.id for t in self._tokenizer.model.tokenize(symbols)], self._kind)
