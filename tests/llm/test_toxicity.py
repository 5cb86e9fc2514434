import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import toxicity
from sluice.llm.queries import crc_is_one

SF = "/root/testdata/sf0.1"

INSULTS, GROUPS = ["zorgle", "plonk", "varmint"], ["martians", "robots"]


def labelled(n=900, seed=1, pairwise=False):
    r = random.Random(seed)
    words = ["".join(r.choice(["ka", "lo", "mi", "tu", "re", "sho"]) for _ in range(r.randint(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(3, 80))]
        if pairwise:
            a, b = r.random() < 0.5, r.random() < 0.5
            text += [INSULTS[0]] * a + [GROUPS[0]] * b
            toxic = a and b
        else:
            toxic = r.random() < 0.2
            text += [r.choice(INSULTS) + r.choice(["", "s", "ing", "!!"]) for _ in range(r.randint(1, 3) if toxic else 0)]
        r.shuffle(text)
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.mark.parametrize("pairwise", [False, True])
def test_held_out_accuracy(spark, pairwise, clashing):
    docs, labels = labelled(pairwise=pairwise, n=1500)
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    df, known = frames(spark, docs, [x for x in labels if x[0] not in held])
    machine = toxicity.train(clashing(df), known)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, machine).collect()}
    truth = dict(labels)
    right = np.mean([(got[i] >= 0.5) == truth[i] for i in held])
    assert right >= (0.9 if pairwise else 0.97)
    assert all(0 <= s <= 1 for s in got.values())
    wrongly = [i for i in held if not truth[i] and got[i] >= 0.7]
    assert len(wrongly) <= 0.03 * len(held)


def test_factors_learn_what_weights_cannot(spark):
    """Either of two words alone is toxic, both together or none are not."""
    r = random.Random(4)
    docs, truth = [], {}
    for i in range(1500):
        a, b = r.random() < 0.4, r.random() < 0.4
        text = ["w%d" % r.randrange(300) for _ in range(r.randint(3, 40))] + ["zorgle"] * a + ["martians"] * b
        r.shuffle(text)
        docs.append((i, " ".join(text)))
        truth[i] = int(a != b)
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    df, known = frames(spark, docs, [x for x in truth.items() if x[0] not in held])
    machine = toxicity.train(df, known)
    linear = toxicity.Machine(machine.slots, machine.bias, machine.weights, 0 * machine.factors)
    texts, labels = [t for i, t in docs if i in held], np.array([truth[i] for i in truth if i in held])
    accuracy = lambda scores: max(np.mean((scores >= x) == labels) for x in np.unique(scores))
    assert np.mean((machine.score(texts) >= 0.5) == labels) >= 0.95 and accuracy(linear.score(texts)) <= 0.87


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
def test_factors_count_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    own = labels.where(crc_is_one("doc_id", 3) == F.lit(False))
    machine = toxicity.train(docs, own)
    linear = toxicity.Machine(machine.slots, machine.bias, machine.weights, 0 * machine.factors)
    rows = docs.join(labels.where(crc_is_one("doc_id", 3)), "doc_id").select("text", "toxic").collect()
    texts, toxic = [r["text"] for r in rows], np.array([r["toxic"] for r in rows])
    whole, alone = machine.score(texts), linear.score(texts)
    logit = lambda p: np.log(p / (1 - p))
    assert np.mean(np.abs(logit(whole) - logit(alone))) >= 0.3 and ((whole >= 0.7) != (alone >= 0.7)).sum() >= 5
    found = whole >= 0.7
    assert toxic[found].mean() >= 0.95 and found[toxic == 1].mean() >= 0.78 and (found != toxic).mean() <= 0.025


def test_conflicting_labels_are_toxic(spark):
    docs, labels = labelled(300)
    df, known = frames(spark, docs, labels)
    both = known.union(known.where("toxic = 1").selectExpr("doc_id", "0")).repartition(5)
    assert toxicity.train(df, both).weights.tolist() == toxicity.train(df, known).weights.tolist()


def test_terms_do_not_depend_on_blocks(monkeypatch):
    r = random.Random(2)
    texts = [" ".join("".join(r.choice("abcé") for _ in range(r.randint(1, 9))) for _ in range(r.randint(0, 60))) for _ in range(30)] + [None, "", "é" * 50]
    whole = toxicity.term_rows(texts)
    monkeypatch.setattr(toxicity, "BLOCK", 600)
    toxicity.powers.cache_clear()
    cut = toxicity.term_rows(texts)
    toxicity.powers.cache_clear()
    assert all((a == b).all() for a, b in zip(whole, cut))
    one = [toxicity.term_rows([t])[1].tolist() for t in texts]
    assert [whole[1][whole[0] == i].tolist() for i in range(len(texts))] == one


def test_case_and_signs_do_not_matter():
    a, b = (toxicity.term_rows([t])[1].tolist() for t in ("Plonk, ZORGLE!", "zorgle plonk"))
    assert a == b


def test_odd_tables(spark):
    docs, labels = labelled(300)
    df, known = frames(spark, docs + [(5000, None), (None, "x"), (5001, ""), (5001, "")], labels + [(5000, 1), (5000, 1), (None, 1), (7, None), (8, 9)])
    machine = toxicity.train(df, known)
    out = toxicity.score(df, machine).collect()
    assert len(out) == 304 and all(r["score"] is not None for r in out)
    blank = {r["score"] for r in out if not r["text"]}
    assert len(blank) == 1 and blank.pop() < 0.7
    for some in (known.limit(0), known.where("toxic = 0")):
        flat = toxicity.train(df, some)
        assert len({r["score"] for r in toxicity.score(df, flat).collect()}) == 1
    assert toxicity.score(df.limit(0), machine).count() == 0
    assert toxicity.train(df.limit(0), known).logits(np.empty(0, int), np.empty(0, int), 1).shape == (1,)
