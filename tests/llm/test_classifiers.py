"""Toxicity and quality: exact neighbours, held-out accuracy, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from llm.conftest import ROWS
from pyspark.sql import functions as F

from ledgerloom.llm import quality, queries, toxicity
from ledgerloom.llm.common import table

MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("block", [1, 4, 64])
def test_index_finds_the_nearest(block):
    rng = random.Random(block)

    def vector():
        v = {rng.randrange(40): rng.random() + 0.1 for _ in range(rng.randint(1, 6))}
        length = sum(w * w for w in v.values()) ** 0.5
        return {t: w / length for t, w in v.items()}

    vectors = [vector() for _ in range(500)]
    vectors += vectors[:50]  # ties
    index = toxicity.BlockMaxIndex(vectors, block)
    for _ in range(60):
        query = vector()
        cosines = np.array([sum(w * v.get(t, 0) for t, w in query.items()) for v in vectors])
        want = np.lexsort((np.arange(len(vectors)), -np.round(cosines, 12)))[:15]
        want = want[cosines[want] > 0]
        at, found = index.nearest(query, 15)
        assert at.tolist() == want.tolist() and found == pytest.approx(cosines[want])


def held_out(spark, rows, label):
    known = {r.doc_id: r[label] for r in table(spark, MIDDLE, "labels").collect()}
    return [(known[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in known]


def auc(pairs):
    ones, zeros = [s for y, s, _ in pairs if y], [s for y, s, _ in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / len(ones) / len(zeros)


@pytest.mark.parametrize(("query", "label", "least"), [
    (queries.op6_toxicity, "toxic", 0.8), (queries.op8_quality, "quality", 0.97),
])
def test_held_out_accuracy(spark, query, label, least):
    rows = query(spark, MIDDLE).collect()
    assert len(rows) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    pairs = held_out(spark, rows, label)
    assert len(pairs) > 50 and auc(pairs) >= least
    assert np.mean([y == p for y, _, p in pairs]) > 0.9


def labelled(spark):
    rows = [(i, f"{'vile rotten' if i % 3 == 0 else 'plain kind'} words {i % 7} and more", int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None), (3, 1), (999, 1)], "doc_id long, label int")
    return docs, labels


def test_toxicity_of_odd_rows(spark, odd, none):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs.unionByName(odd.select("doc_id", "text")), labels)
    got = model.score(odd, evidence=True).collect()
    assert len(got) == len(ROWS) and all(0 <= r.toxicity <= 1 for r in got)
    assert {r.row for r in got} == {"?"}
    rows = model.score(docs, evidence=True).collect()
    assert min(r.toxicity for r in rows if "vile" in r.text) > 0.8 > 0.2 > max(r.toxicity for r in rows if "kind" in r.text)
    assert all(e.toxic == 1 for r in rows if "vile" in r.text for e in r.evidence)
    assert model.score(none).count() == 0
    for nothing in (toxicity.learn(docs, labels.where("false")), toxicity.learn(none, labels)):
        assert {r.toxicity for r in nothing.score(odd).collect()} == {0.0}


def test_toxicity_looks_at_every_word(spark):
    """Texts without any toxic word have neighbours too, the same as by plain cosines."""
    docs, labels = labelled(spark)
    new = [(100, "plain words 3 and more"), (101, "kind kind 5"), (102, "vile words 2 unheard"), (103, "unheard of")]
    docs = docs.unionByName(spark.createDataFrame(new, "doc_id long, text string"))
    texts = {r.doc_id: toxicity.words_of(r.text) for r in docs.collect()}
    have = {w: sum(w in t for t in texts.values()) for w in {w for i in range(60) for w in texts[i]}}

    def vector(words):
        v = {w: (1 + np.log(words.count(w))) * (np.log((1 + len(texts)) / (1 + have[w])) + 1) for w in set(words) & have.keys()}
        return {w: x / sum(y * y for y in v.values()) ** 0.5 for w, x in v.items()}

    model = toxicity.learn(docs, labels)
    rows = {r.doc_id: r for r in model.score(docs, evidence=True).collect()}
    for i in (100, 101, 102, 4):
        own = vector(texts[i])
        want = sorted((sum(x * vector(texts[j]).get(w, 0) for w, x in own.items()) for j in range(60)), reverse=True)
        assert [e.cosine for e in rows[i].nearest] == pytest.approx(want[:15])
    assert rows[101].evidence == [] and len(rows[101].nearest) == 15 and rows[103].nearest == []
    assert max(rows[100].toxicity, rows[101].toxicity) < 0.2 < 0.5 < rows[102].toxicity


def test_repeated_ids_leave_room_for_others(spark):
    docs, labels = labelled(spark)
    hot = spark.range(3000).selectExpr("7L AS doc_id", "concat('plain text ', id % 50) AS text")
    model = toxicity.learn(docs.where("doc_id != 7").unionByName(hot), labels, examples=100)
    ids = model._shared.value.ids
    ids = ids.tolist()
    assert set(ids) == set(range(60)) and 1 < ids.count(7) <= toxicity.TEXTS_OF_ID
    assert all(ids.count(i) == 1 for i in range(60) if i != 7)


def test_whole_texts_are_exact():
    rng = np.random.default_rng(5)
    dense = (rng.random((300, 80)) < rng.random(80) ** 4) * rng.random((300, 80))
    dense[:, 79] += 0.01
    dense[250:] = dense[:50]  # ties
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    first = np.cumsum([0, *(dense > 0).sum(1)])
    index = toxicity.WholeTexts(first, np.nonzero(dense)[1], dense[dense > 0], 80)
    assert 0 < len(index.matrix) < 80
    queries_ = [(np.flatnonzero(v), v[v > 0]) for v in dense]
    for without in (None, list(range(300))):
        for i, (at, cosine) in enumerate(index.nearest(queries_, 15, without)):
            all_ = dense @ dense[i]
            all_[[] if without is None else i] = 0
            want = np.lexsort((np.arange(300), -np.round(all_, 12)))[:15]
            assert at.tolist() == want.tolist() and cosine == pytest.approx(all_[want])


@pytest.mark.parametrize("block", [4, 32])
def test_blocks_that_cannot_matter_are_left_out(block, monkeypatch):
    """Two languages without a word in common, and some short examples with large weights."""
    monkeypatch.setattr(toxicity, "_FINE", 2)  # 400 examples are few for groups of 16
    rng = np.random.default_rng(block)
    dense = np.zeros((400, 60))
    dense[:200, :30] = (rng.random((200, 30)) < 0.5) * rng.random((200, 30))
    dense[200:, 30:] = (rng.random((200, 30)) < 0.5) * rng.random((200, 30))
    dense[::20] *= rng.random((20, 60)) < 0.1
    dense[:, 0] += 1e-3
    dense = dense[rng.permutation(400)]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    index = toxicity.WholeTexts(np.cumsum([0, *(dense > 0).sum(1)]), np.nonzero(dense)[1], dense[dense > 0], 60, block)
    added, add = [], index._add
    monkeypatch.setattr(index, "_add", lambda sums, common, chosen: (added.append(chosen.mean()), add(sums, common, chosen)))
    found = index.nearest([(np.flatnonzero(v), v[v > 0]) for v in dense], 15)
    for v, (at, cosine) in zip(dense, found):
        want = np.sort(dense @ v)[::-1][:15]
        assert len(at) == len(set(at.tolist())) == 15 and cosine == pytest.approx(want, rel=1e-5)
    assert len(added) == 2 and sum(added) < 0.8


def test_words_of_many_texts_at_once(odd, monkeypatch):
    texts = [r[1] for r in ROWS] + ["İstanbul ẞ x-y_z", "\ud800 lone", " ", "again again AGAIN"]
    terms = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts[:-1] for w in toxicity.words_of(t)))}
    want = [sorted((terms[w], toxicity.words_of(t).count(w)) for w in set(toxicity.words_of(t)) & terms.keys()) for t in texts]
    for portion in (1, 50, 1 << 21):
        monkeypatch.setattr(toxicity, "_PORTION", portion)
        got = toxicity.count_terms(terms, texts)
        assert [list(zip(t.tolist(), n.tolist())) for t, n in got] == want
    assert [len(t) for t, _ in toxicity.count_terms({}, texts)] == [0] * len(texts)


@pytest.mark.parametrize("n", [1, 5, 20, 21])
def test_few_examples_are_calibrated_like_many(n):
    label = np.arange(n) % 2.0
    calibration = toxicity.Calibration.of(np.column_stack([label * 0.8, label * 0.6]), label)
    low, high = calibration(0, 0), calibration(0.8, 0.6)
    assert 0 <= low <= high <= 1 and (n < 5 or low < 0.5 < high)


def test_quality_of_odd_rows(spark, odd, none):
    docs, labels = labelled(spark)
    shouted = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.upper("text")))
    both = shouted.unionByName(odd.select("doc_id", "text"))
    model = quality.learn(both, labels)
    got = model.score(odd).collect()
    assert len(got) == len(ROWS) and all(0 <= r.quality <= 1 for r in got) and {r.row for r in got} == {"?"}
    rows = model.score(shouted).collect()
    assert min(r.quality for r in rows if r.text.islower()) > max(r.quality for r in rows if r.text.isupper())
    assert model.score(none).count() == 0
    for nothing in (quality.learn(docs, labels.where("false")), quality.learn(none, labels.where("label = 0"))):
        assert len({r.quality for r in nothing.score(odd).collect()}) == 1


def test_quality_model_has_the_least_risk(spark):
    """The fitted weights against plain gradient descent on the same risk, on overlapping classes."""
    rng = random.Random(3)

    def text(good):
        shout = 0.4 if good else 0.5
        words = [rng.choice(["plain", "river", "stone", "of", "a", "winter", "42", "x7"]) for _ in range(rng.randint(5, 40))]
        return " ".join(w.upper() if rng.random() < shout else w for w in words) + rng.choice(["", "!", ".", " ||"])

    known = [(i, i % 2) for i in range(3000)]
    texts = [text(good) for _, good in known]
    docs = spark.createDataFrame([(i, t) for (i, _), t in zip(known, texts)], "doc_id long, text string")
    labels = spark.createDataFrame([k for k in known if k[0] % 4 < 2], "doc_id long, label int")
    model = quality.learn(docs, labels)

    x = np.array([quality.text_features(t) for t in texts], np.float32).astype(float)
    scale = x.std(axis=0)
    scale[scale < 1e-9] = 1
    z = np.hstack([(x - x.mean(axis=0)) / scale, np.ones((3000, 1))])
    trusted = z[[i for i, good in known if i % 4 < 2 and good]]
    prior = (750 + 1) / (1500 + 2)
    ridge = np.append(np.full(quality.FEATURES, quality.RIDGE), 0)

    def parts(w):
        as_negative = np.logaddexp(0, z @ w).mean() - prior * np.logaddexp(0, trusted @ w).mean()
        return prior * np.logaddexp(0, -trusted @ w).mean(), as_negative, (w * w) @ ridge / 2

    def risk(w):
        positive, as_negative, size = parts(w)
        return positive + max(0, as_negative) + size

    w, speed = np.zeros(z.shape[1]), 0
    for _ in range(5_000):
        p = 1 / (1 + np.exp(-(z @ w)))
        speed = 0.9 * speed - 0.05 * (z.T @ p / len(z) - prior * trusted.mean(axis=0) + ridge * w)
        w = w + speed
    assert parts(w)[1] > 0  # the bound is not met, so descent on the plain risk finds the least
    assert model.prior == pytest.approx(prior) and model.mean == pytest.approx(x.mean(axis=0), abs=1e-6)
    assert risk(np.array(model.weights)) == pytest.approx(risk(w), abs=1e-4)
    score = {r.doc_id: r.quality for r in model.score(docs).collect()}
    assert [score[i] for i in range(3000)] == pytest.approx(1 / (1 + np.exp(-(z @ np.array(model.weights)))), abs=1e-5)


def test_prior_and_bounds():
    assert len(quality.text_features("")) == len(quality.text_features("some words here")) == quality.FEATURES
    votes, shares = toxicity.monotone_fit(np.array([0.1, 0.2, 0.9, 0.3]), np.array([0, 1, 1, 0]))
    assert (np.diff(votes) > 0).all() and (np.diff(shares) >= 0).all()
