import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import lm
from sluice.llm.common import Scratch
from tests.llm import brute

SMALL = lm.Settings(frequent=40, seeds=20, buckets=8, classes=6, sweeps=6)


def train(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 != 1


def in_train(c="doc_id"):
    return F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(5)) != 1


@pytest.mark.parametrize("settings", [SMALL, lm.Settings(), lm.Settings(frequent=0, seeds=0, buckets=4, classes=2)])
def test_counts_and_base(spark, documents, corpus, clashing, settings):
    got = {r["doc_id"]: r for r in lm.score(clashing(documents), in_train(), settings=settings).collect()}
    for i, (n, known, total, base) in brute.unigram(corpus, train).items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert np.isfinite(r["score"]) and r["score"] < 0
    assert len(got) == len(corpus)


def test_exchange_separates_what_alternates():
    """Two kinds of symbols, each always behind the other."""
    r = np.random.default_rng(0)
    pairs = np.zeros((40, 40))
    pairs[:20, 20:] = r.integers(1, 9, (20, 20))
    pairs[20:, :20] = r.integers(1, 9, (20, 20))
    cls = lm.exchange(pairs, 2, 20)
    assert len(set(cls[:20])) == len(set(cls[20:])) == 1 and cls[0] != cls[20]


def test_exchange_never_lowers_the_likelihood():
    r = np.random.default_rng(1)
    pairs = r.integers(0, 5, (30, 30)).astype(float)

    def likelihood(cls):
        m = np.zeros((30, 4))
        m[np.arange(30), cls] = 1
        g = m.T @ pairs @ m
        return lm._xlogx(g).sum() - lm._xlogx(g.sum(0)).sum() - lm._xlogx(g.sum(1)).sum()

    steps = [likelihood(lm.exchange(pairs, 4, k)) for k in range(6)]
    assert all(b >= a - 1e-9 for a, b in zip(steps, steps[1:])) and steps[-1] > steps[0]


@pytest.mark.parametrize("settings", [SMALL, lm.Settings(frequent=1000, seeds=30, classes=5)])
def test_score_by_hand(spark, documents, corpus, settings):
    """All counts and probabilities again from the texts, given each word's class."""
    model, _, _ = lm.learn(documents.select(in_train().alias("train"), "text"), Scratch(spark), settings)
    rank, size = {h: k for k, h in enumerate(model.top.tolist())}, len(model.top)
    code = lambda w: -1 if w is None else rank.get(lm.word_hash(w), size + lm.shape(w, settings.buckets))
    known = [brute.words(t) + [None] for i, t in corpus if train(i)]
    count, follows, mass = Counter(w for t in known for w in t), Counter(), Counter()
    for t in known:
        follows.update((model.classes[code(a)], model.classes[code(b)]) for a, b in zip([None, *t], t))
    for w, n in count.items():
        mass[model.classes[code(w)]] += n + 0.5
    for b in range(settings.buckets):
        mass[model.classes[size + b]] += 0.5  # a word not seen
    before, whole = Counter(), sum(mass.values())
    for (a, _), n in follows.items():
        before[a] += n
    step = lambda a, b: (follows[a, b] + settings.prior * mass[b] / whole) / (before[a] + settings.prior)
    assert all(sum(step(a, b) for b in list(mass)) == pytest.approx(1) for a in list(mass))
    got = {r["doc_id"]: r["score"] for r in lm.score(documents, in_train(), settings=settings).collect()}
    for i, t in corpus:
        words = brute.words(t) + [None]
        classes = [model.classes[code(w)] for w in [None, *words]]
        want = sum(math.log10(step(a, b) * (count[w] + 0.5) / mass[b]) for a, b, w in zip(classes, classes[1:], words))
        assert got[i] == pytest.approx(want, rel=1e-9)


def test_words_go_where_their_neighbours_say(spark):
    """Words that are no seeds, beside seeds of two tongues."""
    r = np.random.default_rng(5)
    tongues = [[f"{p}{i}{p}" for i in range(60)] for p in "xy"]
    weights = np.array([10] * 20 + [1] * 40) / 240
    docs = [(True, " ".join(r.choice(tongues[i % 2], 200, p=weights))) for i in range(200)]
    model, _, _ = lm.learn(spark.createDataFrame(docs, "train boolean, text string"), Scratch(spark), lm.Settings(frequent=200, seeds=40, buckets=4, classes=2))
    of = {h: c for h, c in zip(model.top.tolist(), model.classes.tolist())}
    assert [len({of[lm.word_hash(w.encode())] for w in t}) for t in tongues] == [1, 1] and len(set(model.classes.tolist())) == 2


def test_the_model_beats_its_base_on_held_out_text(spark):
    """Sentences of two languages: knowing the last word's class tells which words follow."""
    r = np.random.default_rng(3)
    tongues = [[f"{p}{i}{p}" for i in range(60)] for p in "xy"]
    docs = [(i, " ".join(r.choice(tongues[i % 2], 80))) for i in range(300)]
    rows = lm.score(spark.createDataFrame(docs, "doc_id long, text string"), in_train(), settings=lm.Settings(frequent=1000, seeds=40, buckets=16, classes=4), keep={"held": ~in_train()}).where("held").collect()
    assert len(rows) > 30 and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 10


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "a a b"), (1, "a a b"), (None, "c"), (2, None)], "doc_id long, text string")
    rows = lm.score(df, F.col("doc_id") == 1, settings=SMALL).collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows), key=str) == sorted([(1, 4, 4, 8), (1, 4, 4, 8), (None, 2, 1, 8), (2, 1, 1, 8)], key=str)
    none = lm.score(df, F.lit(None).cast("boolean"), settings=SMALL).collect()
    assert all(r["train_tokens"] == r["n_known"] == 0 and np.isfinite(r["score"]) for r in none)
    assert lm.score(df.limit(0), F.lit(True), settings=SMALL).count() == 0
