"""Toxicity by the nearest labelled examples.

Examples and texts are TF-IDF vectors of length one over every word that an example has, with
document frequencies over all documents. The neighbours of a text are the examples with the largest
exact cosine (``nearest``), found by an inverted index over all words: examples that are alike lie in
one block, the postings of common words carry their largest weight in each block, and a block whose
bound does not reach the k-th best is not added up. A second search (``evidence``), by the same
weights, looks only at words that occur significantly and several times more often in toxic than in
other examples: few insults weigh little in a long text. Its blocks are taken in the order of what
they could score at most, until no block can reach the k-th best. The votes of both searches, weighted
by distance, are brought to one probability by a logistic and then a monotone fit to the examples' own
votes without themselves.

The examples are those of a sample of labelled ids of bounded size (``examples``), chosen by a hash of
the id; everything else covers all documents.

Defined results: a null text is empty; words that no example has are in no vector; a text without any
word of the examples, the empty one too, has no neighbours, and its vote is the share of toxic
examples; where the toxic words are missing, their vote is the share of toxic examples among those
without; ties in similarity go to the example listed first; without examples every score is zero;
labels that are null are no labels, an id labelled twice is toxic if one of its labels is; rows that
repeat a labelled id are an example for each different text, at most 4 for one id, chosen by a hash of
the text. Very long texts are read whole; without rows there is no row. Extra columns are kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import unused
from ledgerloom.session import spool

EXAMPLES = 20_000
LEAST_TOXIC = 4  # toxic examples that must have a word
LEAST_LIFT = 4.0  # how many times as often toxic examples have a word
LEAST_G2 = 22.0  # log-likelihood ratio of word and label
TEXTS_OF_ID = 4  # examples of one labelled id
NEIGHBOURS = 15
BLOCK = 64
_NEAR = 0.05
_BLOCKS_FIRST = 8
_REMEMBERED = 50_000
_BINS = 40
_COMMON = 16  # words of one example in so many are common
_WIDE = 256  # examples in a block of common words
_FINE = 16  # examples of which one stands for all in the search for the k-th best
_SHARE_FIRST = 4  # one block in so many is added up before bounds are looked at
_SHORT = 64  # postings of a short list
_GROUPS, _GROUP_ROUNDS = 32, 6
_TEXTS = 128  # compared at once
_PORTION = 1 << 21  # characters whose words are counted at once

_TO_WORDS = bytes(c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class BlockMaxIndex:
    """Exact nearest examples by cosine; vectors are {term: weight} of length one."""

    def __init__(self, vectors: list[dict[int, float]], block: int = BLOCK):
        self.size, self.block = len(vectors), block
        self.blocks = -(-len(vectors) // block)
        postings: dict[int, list[tuple[int, float]]] = {}
        for i, vector in enumerate(vectors):
            for term, weight in vector.items():
                postings.setdefault(term, []).append((i, weight))
        self.postings = {}
        for term, pairs in postings.items():
            at = np.array([i for i, _ in pairs])
            weight = np.array([w for _, w in pairs])
            own, first = np.unique(at // block, return_index=True)
            self.postings[term] = (at, weight, at // block, own, np.maximum.reduceat(weight, first))

    def nearest(self, query: dict[int, float], k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``k`` examples with a cosine over zero, best first, and their cosines."""
        terms = [(self.postings[t], w) for t, w in query.items() if t in self.postings]
        bound = np.zeros(self.blocks)
        for (_, _, _, own, most), w in terms:
            bound[own] += w * most
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found, score = np.zeros(0, np.int64), np.zeros(0)
        done = 0
        while done < len(order):
            # The most promising blocks first; then all that can still reach the k-th best.
            some = order[done:done + _BLOCKS_FIRST]
            if len(found) == k:
                some = order[done:][bound[order[done:]] >= score[-1] - 1e-9]
                if not len(some):
                    break
            done += len(some)
            chosen = np.zeros(self.blocks, dtype=bool)
            chosen[some] = True
            sums = np.zeros(self.size)
            for (at, weight, blocks, _, _), w in terms:
                inside = chosen[blocks]
                sums[at[inside]] += w * weight[inside]
            ids = np.flatnonzero(sums)
            ids = ids[ids != without]
            found, score = np.concatenate([found, ids]), np.concatenate([score, sums[ids]])
            if len(found) > k:  # only those that can be among the best need sorting
                close = score >= np.partition(score, len(score) - k)[len(score) - k] - 1e-9
                found, score = found[close], score[close]
            best = np.lexsort((found, -np.round(score, 12)))[:k]
            found, score = found[best], score[best]
        return found, score


def _alike(profiles: np.ndarray) -> np.ndarray:
    """A group for each row of ``profiles``: rows of one group point in similar directions, and so,
    where they can, do those of neighbouring groups."""
    length = np.linalg.norm(profiles, axis=1, keepdims=True)
    profiles = profiles / np.where(length > 0, length, 1)
    centres = profiles[np.linspace(0, len(profiles) - 1, min(_GROUPS, len(profiles))).astype(int)]
    group = np.zeros(len(profiles), np.int64)
    for _ in range(_GROUP_ROUNDS):
        group = np.argmax(profiles @ centres.T, axis=1)
        for c in range(len(centres)):
            if (group == c).any():
                total = profiles[group == c].sum(axis=0)
                centres[c] = total / max(float(np.linalg.norm(total)), 1e-30)
    alike, rank = centres @ centres.T, np.zeros(len(centres), np.int64)
    left, last = set(range(1, len(centres))), 0
    for i in range(1, len(centres)):  # always on to the nearest one that is left
        last = max(sorted(left), key=lambda c: alike[last, c])
        left.remove(last)
        rank[last] = i
    return rank[group]


class WholeTexts:
    """Exact nearest examples by cosine over all words, for several texts at once.

    Example i has ``terms[first[i]:first[i + 1]]``, with weights of length one. The index keeps the
    examples in an order in which similar ones lie together. Postings of words that few examples have
    are added up whole. Those of common words are cut into blocks of ``block`` examples, each with
    every word's largest weight there: a block is added up for the texts whose bound for it, from these
    and from the rare words, reaches the text's k-th best so far. Weights are kept in single precision.
    What cannot be among the best is left out with a margin for rounding; the common words of the rest
    are added up again in double precision, so that equal examples get equal cosines."""

    def __init__(self, first: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int, block: int = _WIDE):
        self.size = len(first) - 1
        owner = np.repeat(np.arange(self.size), np.diff(first))
        common = np.flatnonzero(np.bincount(terms, minlength=n_terms) > max(16, self.size / _COMMON))
        self.row = np.full(n_terms, -1)
        self.row[common] = np.arange(len(common))
        row = self.row[terms]
        matrix = np.zeros((self.size, len(common)), np.float32)
        matrix[owner[row >= 0], row[row >= 0]] = weights[row >= 0]
        self.order = np.lexsort((np.diff(first), _alike(matrix))) if self.size else np.zeros(0, np.int64)
        self.place = np.empty(self.size, np.int64)
        self.place[self.order] = np.arange(self.size)
        self.starts = np.arange(0, self.size, block)
        self.matrix = matrix[self.order].T  # an example's weights lie side by side
        self.blocks = [self.matrix[:, a:a + block] for a in self.starts]
        self.largest = np.zeros((len(common), len(self.blocks)), np.float32)
        for i, some in enumerate(self.blocks):
            self.largest[:, i] = some.max(axis=1)
        rest = np.flatnonzero(row < 0)
        rest = rest[np.argsort(terms[rest], kind="stable")]
        # Place and weight of a posting side by side, so that a list is read once.
        self.postings = np.empty((len(rest), 2), np.int32)
        self.postings[:, 0] = self.place[owner[rest]]
        self.postings.view(np.float32)[:, 1] = weights[rest]
        self.postings = self.postings.view(np.int64).reshape(-1)
        self.start = np.searchsorted(terms[rest], np.arange(n_terms + 1))
        self.fine = np.arange(0, self.size, _FINE)
        self.error = (len(common) + 8) * 2.0**-22

    def _rare(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sums over the words that few examples have."""
        a, n = self.start[terms], self.start[terms + 1] - self.start[terms]
        short, long = (n > 0) & (n <= _SHORT), n > _SHORT
        weights = np.concatenate([np.repeat(weights[some].astype(np.float32), n[some]) for some in (short, long)])
        if not len(weights):
            return np.zeros(self.size)
        # Short lists by their places, all at once; long ones as they lie.
        at = np.arange(n[short].sum()) + np.repeat(a[short] - (np.cumsum(n[short]) - n[short]), n[short])
        lists = [self.postings[x:x + m] for x, m in zip(a[long].tolist(), n[long].tolist())]
        found = np.concatenate([self.postings[at], *lists])
        return np.bincount(found.view(np.int32)[::2], found.view(np.float32)[1::2] * weights, self.size)

    def _add(self, sums: np.ndarray, common: np.ndarray, chosen: np.ndarray) -> None:
        """Add the common words to the ``chosen`` (text, block) pairs."""
        for start, block, texts in zip(self.starts, self.blocks, chosen.T):
            at = np.flatnonzero(texts)
            if len(at):
                sums[at, start:start + block.shape[1]] += common[at] @ block

    def nearest(
        self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each (terms, weights) up to ``k`` examples with a cosine over zero, best first, and
        their cosines; without example ``without[i]`` for text i."""
        if not self.size:
            return [(np.zeros(0, np.int64), np.zeros(0)) for _ in texts]
        common = np.zeros((len(texts), len(self.largest)), np.float32)
        sums = np.empty((len(texts), self.size), np.float32)
        for i, (terms, weights) in enumerate(texts):
            row = self.row[terms]
            common[i, row[row >= 0]] = weights[row >= 0]
            sums[i] = self._rare(terms, weights)
            if without is not None:
                sums[i, self.place[without[i]]] = -2  # stays below zero with the common words
        rare = sums.copy()
        bound = common @ self.largest + np.maximum.reduceat(sums, self.starts, axis=1)
        n = len(self.starts)
        first = max(1, n // _SHARE_FIRST)
        chosen = bound >= np.partition(bound, n - first, axis=1)[:, n - first:n - first + 1]
        self._add(sums, common, chosen)
        # What is not added up yet only makes the k-th best too small.
        rest = ~chosen & (bound >= self._least(sums, k)[:, None] - 4 * self.error)
        self._add(sums, common, rest)
        least = self._least(sums, k) - 2 * self.error
        found = []
        for i in range(len(texts)):
            at = np.flatnonzero(sums[i] >= least[i] if least[i] > 0 else sums[i] > 0)
            cosine = rare[i, at] + self.matrix.T[at].astype(float) @ common[i].astype(float)
            ids = self.order[at]
            best = np.lexsort((ids, -np.round(cosine, 12)))[:k]
            found.append((ids[best], cosine[best]))
        return found

    def _least(self, sums: np.ndarray, k: int) -> np.ndarray:
        """At most the k-th largest of each row: the k-th largest of the largest of each few."""
        n = len(self.fine)
        if n <= k:
            return np.zeros(len(sums), np.float32)
        most = np.maximum.reduceat(sums, self.fine, axis=1)
        return np.maximum(np.partition(most, n - k, axis=1)[:, n - k], 0)


def monotone_fit(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Increasing step function from votes to shares: bins of equal numbers, pooled where they
    fall. Returns the bins' mean votes and shares."""
    order = np.argsort(raw, kind="stable")
    parts = [p for p in np.array_split(order, min(_BINS, len(order))) if len(p)]
    pools: list[list[float]] = []
    for p in parts:
        pools.append([float(raw[p].sum()), float(label[p].sum()), float(len(p))])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return (np.array([a / n for a, _, n in pools]), np.array([(y + 0.5) / (n + 1) for _, y, n in pools]))


def logistic_fit(votes: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Intercept and weights of the columns of ``votes``, by Newton steps with a small penalty."""
    x = np.column_stack([np.ones(len(votes)), votes])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.1 * np.eye(len(w)), x.T @ (label - p) - 0.1 * w)
        size = float(np.abs(step).max())
        w = w + step * min(1.0, 5 / max(size, 1e-300))
        if size < 1e-9:
            break
    return w


@dataclass
class Calibration:
    """From the two votes to a probability."""

    weights: np.ndarray
    votes: np.ndarray
    shares: np.ndarray

    @classmethod
    def of(cls, votes: np.ndarray, label: np.ndarray) -> Calibration:
        if not len(label):
            return cls(np.zeros(3), np.zeros(1), np.zeros(1))
        weights = logistic_fit(votes, label)
        return cls(weights, *monotone_fit(weights[0] + votes @ weights[1:], label))

    def __call__(self, whole: float, toxic: float) -> float:
        raw = self.weights[0] + self.weights[1] * whole + self.weights[2] * toxic
        return float(np.interp(raw, self.votes, self.shares))


def _share(labels: np.ndarray, cosine: np.ndarray, prior: float, base: float) -> float:
    weight = 1 / (_NEAR + np.maximum(0.0, 1 - cosine))
    return (float(weight @ labels) + prior * base) / (float(weight.sum()) + prior)


@dataclass
class Neighbours:
    """What a task needs to vote on texts; its size is bounded by the examples and their words.

    Terms below ``n_toxic`` are the toxic words. Example i has ``words[first[i]:first[i + 1]]``,
    ``counts`` times each; those with toxic words come first."""

    n_toxic: int
    idf: np.ndarray
    first: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    labels: np.ndarray
    ids: np.ndarray

    def build(self) -> None:
        """The indexes, in each task's process; the driver does without."""
        self.seen, n = {}, len(self.labels)
        each = [self.weigh(*self.example(i)) for i in range(n)]
        weights = np.concatenate([w for _, w in each]) if n else np.zeros(0)
        self.whole = WholeTexts(self.first, self.words, weights, len(self.idf))
        vectors = [self.toxic_words(*self.example(i)) for i in range(n)]
        self.having = sum(1 for v in vectors if v)
        self.index = BlockMaxIndex(vectors[:self.having])
        self.base = float(self.labels.mean()) if n else 0.0
        none = self.labels[self.having:]
        # Share of toxic examples among those without toxic words.
        self.without = (float(none.sum()) + 0.5) / (len(none) + 1) if len(none) else 0.0

    def __getstate__(self):
        return {k: self.__dict__[k] for k in self.__dataclass_fields__}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.build()

    def example(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.first[i], self.first[i + 1]
        return self.words[a:b], self.counts[a:b]

    def weigh(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = (1 + np.log(counts)) * self.idf[words]
        return words, raw / math.sqrt(raw @ raw) if len(raw) else raw

    def toxic_words(self, words: np.ndarray, counts: np.ndarray) -> dict[int, float]:
        n = int(np.searchsorted(words, self.n_toxic))
        return dict(zip(*(x.tolist() for x in self.weigh(words[:n], counts[:n])))) if n else {}

    def toxic_vote(self, vector: dict[int, float], without: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        key = (without, *vector.items())
        if key not in self.seen:
            at, cosine = self.index.nearest(vector, NEIGHBOURS, without)
            if len(self.seen) >= _REMEMBERED:
                self.seen.clear()
            # The prior is one vote, as near as can be, for the texts without any of the words.
            self.seen[key] = _share(self.labels[at], cosine, 1 / _NEAR, self.without), at, cosine
        return self.seen[key]

    def votes(
        self, texts: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None
    ) -> Iterator[tuple[tuple[float, np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]]]:
        """Of each text (terms, counts), by all and by toxic words: vote, neighbours, cosines."""
        for a in range(0, len(texts), _TEXTS):
            some, out = texts[a:a + _TEXTS], without and without[a:a + _TEXTS]
            found = self.whole.nearest([self.weigh(*t) for t in some], NEIGHBOURS, out)
            for i, (text, (at, cosine)) in enumerate(zip(some, found)):
                # The prior is one vote at the distance of an unrelated example.
                whole = _share(self.labels[at], cosine, 1 / (1 + _NEAR), self.base)
                yield (whole, at, cosine), self.toxic_vote(self.toxic_words(*text), out[i] if out else -1)

    def named(self, found: list[tuple[float, np.ndarray, np.ndarray]]) -> pa.Array:
        """The neighbours of each text, best first: id, cosine and label."""
        sizes = [len(at) for _, at, _ in found]
        at = np.concatenate([np.zeros(0, np.int64), *(at for _, at, _ in found)])
        cosine = np.concatenate([np.zeros(0), *(cosine for _, _, cosine in found)])
        each = pa.StructArray.from_arrays(
            [pa.array(self.ids[at]), pa.array(cosine), pa.array(self.labels[at].astype(np.int32))],
            names=["doc_id", "cosine", "toxic"],
        )
        return pa.ListArray.from_arrays(np.cumsum([0, *sizes], dtype=np.int32), each)


def _term_table(terms: dict[bytes, int], texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and count of the terms that each text has, in this order; words as ``words_of``."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw).translate(_TO_WORDS), np.uint8)
    inside = np.concatenate([[False], data != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, side="right")
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside[1:-1]])]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    _, ends, values = words.dictionary.buffers()
    cuts, values = np.frombuffer(ends, np.int64)[:len(words.dictionary) + 1].tolist(), values.to_pybytes()
    place = np.array([terms.get(values[a:b], -1) for a, b in zip(cuts, cuts[1:])], np.int64)
    term = place[words.indices.to_numpy()]
    width = max(len(terms), 1)
    key, n = np.unique((text * width + term)[term >= 0], return_counts=True)
    return key // width, key % width, n


def _portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Neighbouring texts, of about ``_PORTION`` characters together."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t or "")
        if size >= _PORTION:
            yield some
            some, size = [], 0
    if some:
        yield some


def count_terms(terms: dict[bytes, int], texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Terms of each text in order, and how often it has them."""
    found = []
    for some in _portions(texts):
        text, term, n = _term_table(terms, some)
        cuts = np.searchsorted(text, np.arange(len(some) + 1))
        found += [(term[a:b], n[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    return found


class ToxicityModel:
    def __init__(self, terms, shared, calibration: Calibration):
        self._terms, self._shared, self.calibration = terms, shared, calibration

    def score(self, docs: DataFrame, name: str = "toxicity", text: str = "text", evidence: bool = False) -> DataFrame:
        """``docs`` with ``name`` (0 to 1) and, if asked for, the neighbours by toxic words
        (``evidence``) and by all words (``nearest``)."""
        terms, shared, calibration = self._terms, self._shared, self.calibration

        def run(texts: pa.Array) -> pa.Array:
            model = shared.value
            found = list(model.votes(count_terms(terms.value, texts.to_pylist())))
            score = [calibration(whole[0], toxic[0]) if len(model.ids) else 0.0 for whole, toxic in found]
            none = (0.0, np.zeros(0, np.int64), np.zeros(0))
            return pa.StructArray.from_arrays(
                [pa.array(score, pa.float64()), model.named([f[1] if evidence else none for f in found]),
                 model.named([f[0] if evidence else none for f in found])],
                names=["score", "evidence", "nearest"],
            )

        run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
        near = "array<struct<doc_id:bigint,cosine:double,toxic:int>>"
        kind = f"struct<score:double,evidence:{near},nearest:{near}>"
        both = unused(docs, "_judged")
        judged = docs.withColumn(both, F.arrow_udf(run, kind)(F.col(text)))
        judged = judged.withColumn(name, F.col(both)["score"])
        if evidence:
            judged = judged.withColumn("evidence", F.col(both)["evidence"])
            judged = judged.withColumn("nearest", F.col(both)["nearest"])
        return judged.drop(both)


def _g2(n1: np.ndarray, n0: np.ndarray, all1: float, all0: float) -> np.ndarray:
    """Log-likelihood ratio of a word's presence and the label."""
    total = all1 + all0

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    seen = n1 + n0
    return 2 * (
        part(n1, seen * all1 / total) + part(n0, seen * all0 / total)
        + part(all1 - n1, (total - seen) * all1 / total) + part(all0 - n0, (total - seen) * all0 / total)
    )


def _vocabulary(sample: DataFrame) -> tuple[list[bytes], int]:
    """All words of the examples, the best at telling toxic ones first, and how many these are:
    words that toxic examples have significantly more often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, other = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if label else other).update(set(words_of(text)))
        words = list(toxic.keys() | other.keys())
        for i in range(0, len(words), 50_000):
            some = words[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.binary()), pa.array([toxic[w] for w in some], pa.int64()),
                 pa.array([other[w] for w in some], pa.int64())],
                names=["word", "n1", "n0"],
            )

    sizes = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    all1, all0 = sizes[0], sizes[1] - sizes[0]
    counted = sample.select("text", "label").mapInArrow(count, "word binary, n1 long, n0 long")
    sums = counted.groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).toArrow()
    words = np.array(sums["word"].to_pylist(), dtype=object)
    order = np.argsort(words, kind="stable")
    words, n1, n0 = words[order], sums["n1"].to_numpy()[order], sums["n0"].to_numpy()[order]
    often = np.flatnonzero((n1 >= LEAST_TOXIC) & (n1 * all0 > LEAST_LIFT * n0 * all1))
    g2 = _g2(n1[often].astype(float), n0[often].astype(float), all1, all0) if len(often) else np.zeros(0)
    best = often[np.argsort(-g2, kind="stable")[:int((g2 >= LEAST_G2).sum())]]
    rest = np.ones(len(words), dtype=bool)
    rest[best] = False
    return [*words[best], *words[rest]], len(best)


def _document_frequencies(docs: DataFrame, shared) -> tuple[np.ndarray, int]:
    """In how many of all documents each word of the broadcast ``shared`` occurs, and their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, n = shared.value, 0
        seen = np.zeros(len(terms), np.int64)
        for batch in batches:
            n += batch.num_rows
            for some in _portions(batch.column(0).to_pylist()):
                seen += np.bincount(_term_table(terms, some)[1], minlength=len(terms))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(seen[at], n), pa.int64())], names=["term", "n"]
        )

    counted = docs.select("text").mapInArrow(count, "term int, n long")
    sums = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = sums["term"].to_numpy(), sums["n"].to_numpy()
    frequency = np.zeros(len(shared.value))
    frequency[term[term >= 0]] = n[term >= 0]
    return frequency, int(n[term < 0].sum())


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> ToxicityModel:
    """Examples are the documents of up to ``examples`` ids in ``labels`` (``doc_id``, ``label``), up to
    ``TEXTS_OF_ID`` different texts for each."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    chosen = (
        labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    )
    chosen = spool(chosen, "toxicity-labels")  # at most ``examples`` pairs of numbers
    found = docs.join(F.broadcast(chosen), "doc_id").withColumn("hash", F.xxhash64("text"))
    # Summed before the shuffle, so that an id with many rows does not land in one task.
    sample = found.groupBy("doc_id", "label", F.pmod("hash", F.lit(TEXTS_OF_ID)).alias("part")).agg(
        F.min(F.struct("hash", "text")).alias("first")
    )
    sample = spool(sample.select("doc_id", "label", "first.text"), "toxicity-examples")
    words, n_toxic = _vocabulary(sample)
    places = {w: i for i, w in enumerate(words)}
    shared = spark.sparkContext.broadcast(places)
    frequency, n = _document_frequencies(docs, shared)
    idf = np.log((1 + n) / (1 + frequency)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = count_terms(shared.value, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int32()),
                 pa.array([t for t, _ in found], pa.list_(pa.int32())),
                 pa.array([c for _, c in found], pa.list_(pa.int32()))],
                names=["doc_id", "label", "terms", "counts"],
            )

    rows = sample.mapInArrow(vectors, "doc_id long, label int, terms array<int>, counts array<int>")
    model = _model(n_toxic, idf, rows.toArrow())
    examples_shared = spark.sparkContext.broadcast(model)
    return ToxicityModel(shared, examples_shared, _calibrate(spark, examples_shared, model.labels))


def _calibrate(spark: SparkSession, shared, labels: np.ndarray) -> Calibration:
    """From the examples' own votes without themselves, which tasks compute."""
    if not len(labels):
        return Calibration.of(np.zeros((0, 2)), labels)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_pylist()
            found = list(shared.value.votes([shared.value.example(i) for i in at], at))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([v[0][0] for v in found], pa.float64()),
                 pa.array([v[1][0] for v in found], pa.float64())],
                names=["at", "whole", "toxic"],
            )

    places = spark.range(0, len(labels), 1, -(-len(labels) // 500)).withColumnRenamed("id", "at")
    votes = places.mapInArrow(vote, "at long, whole double, toxic double").toArrow().sort_by("at")
    return Calibration.of(np.column_stack([votes["whole"].to_numpy(), votes["toxic"].to_numpy()]), labels)


def _model(n_toxic: int, idf: np.ndarray, kept: pa.Table) -> Neighbours:
    ids = kept["doc_id"].to_numpy()
    each = [(np.asarray(t.values), np.asarray(c.values)) for t, c in zip(kept["terms"], kept["counts"])]

    def strongest(i: int) -> tuple:
        """Examples with the same strongest toxic word lie together, so that blocks differ in
        what they bound; those without come last."""
        words, counts = each[i]
        m = int(np.searchsorted(words, n_toxic))
        if not m:
            return (n_toxic, 0.0)
        raw = (1 + np.log(counts[:m])) * idf[words[:m]]
        top = int(np.argmax(raw))
        return (int(words[top]), -float(raw[top]) / math.sqrt(raw @ raw))

    # Examples of one id have different texts; their words put them in order.
    listed = sorted(range(len(each)), key=lambda i: (ids[i], each[i][0].tobytes(), each[i][1].tobytes()))
    order = sorted(listed, key=strongest)
    empty = [np.zeros(0, np.int64)]
    return Neighbours(
        n_toxic, idf, np.cumsum([0] + [len(each[i][0]) for i in order]),
        np.concatenate(empty + [each[i][0] for i in order]).astype(np.int32),
        np.concatenate(empty + [each[i][1] for i in order]).astype(np.int32),
        kept["label"].to_numpy()[order].astype(float) if order else np.zeros(0),
        ids[order] if order else np.zeros(0, np.int64),
    )
