"""Byte-pair encoding by backtracking over longest matches, and table-driven decoding.

The merges of a vocabulary decide which neighbouring tokens can stand side by side in an encoding:
a pair is compatible if, undoing the merges on both sides of the seam from the latest to the
earliest, no merge across the seam would have come first. An encoding in which all neighbours are
compatible is the one that applying the merges in order gives. So the encoder takes the longest
token that starts at a position (all matches come from one Aho-Corasick pass), checks it against
its left neighbour, shortens it as needed and steps back where nothing fits. A position from which
it stepped back is never tried again, so the work is linear in the text.

Texts are cut into pieces by the vocabulary's own pre-tokenizer. Pieces and space-separated chunks
that were seen before come from bounded caches.

Defined results: a null text encodes like an empty one, to no ids; null or empty ids decode to
the empty text; ids outside the vocabulary are skipped; whole texts of any length are encoded.
Other columns of a table are left as they are.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Bounds of the caches of one Python worker, in entries. A full cache becomes the old generation,
# from which entries still in use move to the new one.
CACHED_CHUNKS = 50_000
CACHED_PIECES = 150_000
CACHED_PAIRS = 300_000
DECODED_AT_ONCE = 1 << 18

# Texts of these characters only are cut by the pattern below, all others by the library's
# pre-tokenizer; on these characters both classify alike.
_SIMPLE = re.compile("[ -~À-ÖØ-öø-ÿ\n]*")
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PIECES = re.compile(
    rf" ?[{_LETTER}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+"
)
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_NO_LIMIT = 1 << 62


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the rest follow from code point 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(spare)) for b in range(256)]


class BytePairCodec:
    """Encoder and decoder for a byte-level vocabulary in the tokenizers library's JSON form."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(
            model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "unk_token",
                                   "continuing_subword_prefix", "end_of_word_suffix")
        )
        if not plain or spec["normalizer"] or splitter.get("type") != "ByteLevel" \
                or splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError("only plain byte-level vocabularies without normalizer are supported")
        self._specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        longest_first = sorted(self._specials, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self._splitter = None
        self._spec = definition
        self._learn(model["vocab"], model["merges"])
        self._offset_table(model["vocab"])
        self._chunks = _Cache(self._next_chunk, CACHED_CHUNKS)
        self._pieces = _Cache(self._encode_latin, CACHED_PIECES)

    # ---- tables -----------------------------------------------------------------------------

    def _learn(self, vocab: dict[str, int], merges: list) -> None:
        alphabet = byte_alphabet()
        self._to_chars = dict(enumerate(alphabet))
        symbols = [c for c in alphabet if c in vocab]
        if len(symbols) != 256:
            raise ValueError("the vocabulary lacks some bytes")
        rank = {s: i for i, s in enumerate(symbols)}
        self._left, self._right = list(range(256)), list(range(256))
        self._joined: dict[tuple[int, int], int] = {}
        for merge in merges:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if a + b in rank:
                raise ValueError(f"two merges make {a + b!r}")
            new = rank[a + b] = len(symbols)
            symbols.append(a + b)
            self._left.append(rank[a])
            self._right.append(rank[b])
            self._joined[rank[a], rank[b]] = new
        self._size = [len(s) for s in symbols]
        self._id = [vocab[s].to_bytes(4, "little") for s in symbols]
        # A token can occur in an encoding only if its own text encodes to it.
        whole = [True] * 256
        for t in range(256, len(symbols)):
            a, b = self._left[t], self._right[t]
            whole.append(whole[a] and whole[b] and self._seam_holds(a, b, t))
        known = {s: t for t, s in enumerate(symbols) if whole[t]}
        self._known = {s: self._id[t] for s, t in known.items()}
        self._automaton = ahocorasick.Automaton()
        for s, t in known.items():
            self._automaton.add_word(s, t)
        self._automaton.make_automaton()
        self._shorter = [
            next((known[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in known), -1)
            for s in symbols
        ]
        self._pairs: dict[int, bool] = {}

    def _seam_holds(self, a: int, b: int, limit: int = _NO_LIMIT) -> bool:
        """No merge across the seam of ``a`` and ``b`` comes before the merges inside them."""
        joined, left, right = self._joined, self._left, self._right
        while True:
            if joined.get((a, b), _NO_LIMIT) < limit:
                return False
            undo_a = a > b
            for _ in range(2):
                if undo_a:
                    limit, part = a, right[a]
                    if part != a:
                        a = part
                        break
                else:
                    limit, part = b + 1, left[b]
                    if part != b:
                        b = part
                        break
                undo_a = not undo_a
            else:
                return True

    def _compatible(self, key: int) -> bool:
        """Whether the two tokens packed in ``key`` may be neighbours, for a pair not in the table."""
        if len(self._pairs) >= CACHED_PAIRS:
            self._pairs.clear()
        found = self._pairs[key] = self._seam_holds(key >> 32, key & 0xFFFFFFFF)
        return found

    def _offset_table(self, vocab: dict[str, int]) -> None:
        to_byte = {c: b for b, c in self._to_chars.items()}
        raw = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items()}
        raw |= {i: s.encode() for s, i in self._specials.items()}
        sizes = np.zeros(max(raw) + 2, dtype=np.int64)
        for i, b in raw.items():
            sizes[i] = len(b)
        self._widths = sizes[:-1]
        self._starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self._blob = np.frombuffer(b"".join(raw[i] for i in sorted(raw)), dtype=np.uint8)

    # ---- encoding ---------------------------------------------------------------------------

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids (int32) of a whole text."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        if self._special is None or not self._special.search(text):
            return np.frombuffer(self._plain(text), dtype=np.int32)
        out, done = [], 0
        for hit in self._special.finditer(text):
            out.append(self._plain(text[done:hit.start()]))
            out.append(np.int32(self._specials[hit.group()]).tobytes())
            done = hit.end()
        return np.frombuffer(b"".join([*out, self._plain(text[done:])]), dtype=np.int32)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if _SIMPLE.fullmatch(text):
            return self._simple(text)
        first, *rest = text.split(" ")
        try:
            if first[-1:].isspace():
                raise _Unsplittable
            ids = b"".join(map(self._chunks.__getitem__, rest))
        except _Unsplittable:
            # Runs of white space: cut only at single spaces between other characters.
            first, *rest = _LONE_SPACE.split(text)
            ids = b"".join([self._chunk(" " + chunk) for chunk in rest])
        return self._chunk(first) + ids

    def _chunk(self, chunk: str) -> bytes:
        """Ids of text that begins and ends where the pre-tokenizer would cut."""
        if not chunk:
            return b""
        if _SIMPLE.fullmatch(chunk):
            return self._simple(chunk)
        if self._splitter is None:
            from tokenizers import Tokenizer

            self._splitter = Tokenizer.from_str(self._spec).pre_tokenizer
        return b"".join([self._piece(p) for p, _ in self._splitter.pre_tokenize_str(chunk)])

    def _simple(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, _PIECES.findall(text)))

    def _next_chunk(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Unsplittable
        return self._chunk(" " + chunk)

    def _encode_latin(self, piece: str) -> bytes:
        return self._piece(piece.encode().decode("latin-1").translate(self._to_chars))

    def _piece(self, symbols: str) -> bytes:
        known = self._known.get(symbols)
        if known is None:
            ids = self._id
            return b"".join([ids[t] for t in self._backtrack(symbols)])
        return known

    def _backtrack(self, piece: str) -> list[int]:
        sizes, shorter, pairs, compatible = self._size, self._shorter, self._pairs, self._compatible
        length, matches = len(piece), self._automaton.iter_long
        closed = set()  # positions that no encoding passes
        tokens: list[int] = []
        last, at = -1, 0
        # One longest match behind the other, as long as each is taken as it is.
        following = matches(piece)
        token = next(following)[1]
        while True:
            end = at + sizes[token]
            if end not in closed:
                if last < 0:
                    fits = True
                else:
                    key = last << 32 | token
                    fits = pairs.get(key)
                    if fits is None:
                        fits = compatible(key)
                if fits:
                    tokens.append(token)
                    if end == length:
                        return tokens
                    last, at = token, end
                    if following is None:
                        following = matches(piece, end)
                    token = next(following)[1]
                    continue
            following = None
            token = shorter[token]
            while token < 0:
                closed.add(at)
                token = tokens.pop()
                at -= sizes[token]
                last = tokens[-1] if tokens else -1
                token = shorter[token]

    # ---- decoding ---------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; byte sequences that are not UTF-8 become replacement characters."""
        ids = np.asarray(ids, dtype=np.int64)
        parts = []
        for i in range(0, len(ids), DECODED_AT_ONCE):
            some = ids[i:i + DECODED_AT_ONCE]
            some = some[(some >= 0) & (some < len(self._widths))]
            widths = self._widths[some]
            ends = np.cumsum(widths)
            if len(ends) and ends[-1]:
                at = np.repeat(self._starts[some] - ends + widths, widths)
                at += np.arange(ends[-1])
                parts.append(self._blob[at].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


class _Unsplittable(Exception):
    pass


class _Cache(dict):
    """Short keys and what ``compute`` gives for them, in two generations of bounded size."""

    def __init__(self, compute, entries: int):
        super().__init__()
        self._compute, self._entries, self._old = compute, entries, {}

    def __missing__(self, key: str) -> bytes:
        found = self._old.get(key)
        if found is None:
            found = self._compute(key)
        if len(key) <= 64:
            if len(self) >= self._entries:
                self._old = dict(self)
                self.clear()
            self[key] = found
        return found


# ---- columns ----------------------------------------------------------------------------------

_loaded: dict[int, BytePairCodec] = {}


def _codec(definition) -> BytePairCodec:
    """One codec per Python worker and vocabulary."""
    key = hash(definition.value)
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded.clear()
        _loaded[key] = BytePairCodec(definition.value)
    return _loaded[key]


def id_lists(encodings: Iterable[np.ndarray]) -> pa.Array:
    encodings = list(encodings)
    offsets = np.cumsum([0, *map(len, encodings)]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *encodings])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


class Vocabulary:
    """A vocabulary file, sent to the executors once; they need not reach its path."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as file:
            self._definition = spark.sparkContext.broadcast(file.read())

    def encode(self, text: Column) -> Column:
        """``array<int>`` of the text's token ids."""
        definition = self._definition

        def run(texts: pa.Array) -> pa.Array:
            encode = _codec(definition).encode
            return id_lists(encode(t) for t in texts.to_pylist())

        run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
        return F.arrow_udf(run, "array<int>")(text)

    def decode(self, ids: Column) -> Column:
        """The text of an ``array<int>`` of token ids."""
        definition = self._definition

        def run(ids: pa.Array) -> pa.Array:
            decode = _codec(definition).decode
            ids = ids.cast(pa.large_list(pa.int64()))
            values = np.asarray(ids.values.fill_null(-1))
            bounds = np.asarray(ids.offsets)
            valid = np.asarray(ids.is_valid())
            return pa.array(
                [
                    decode(values[a:b]) if ok else ""
                    for a, b, ok in zip(bounds[:-1], bounds[1:], valid)
                ],
                pa.string(),
            )

        run.__annotations__ = {"ids": pa.Array, "return": pa.Array}
        return F.arrow_udf(run, "string")(ids)
