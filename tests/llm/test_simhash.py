import random

import pytest

from sluice.llm import simhash
from sluice.llm.common import Scratch
from tests.llm import brute


def test_fingerprint_is_the_majority_of_its_shingles(corpus):
    for _, t in corpus[:80]:
        assert simhash.fingerprint(t) == brute.simhash(t)
    assert simhash.fingerprint(None) == simhash.fingerprint(" ") == 0
    assert simhash.fingerprint("A b") == simhash.fingerprint(" a  B\n")


def test_components(documents, corpus, clashing):
    fp = {i: brute.simhash(t) for i, t in corpus}
    linked = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2]
    want = brute.components(fp, linked)
    got = {r["doc_id"]: (r["fp"] & ((1 << 64) - 1), r["component_id"]) for r in simhash.near_duplicates(clashing(documents)).collect()}
    assert got == {i: (fp[i], want[i]) for i in fp}


@pytest.mark.parametrize("pairs_up_to", [2, 4, 1000])
def test_dense_blocks_lose_no_link(spark, pairs_up_to):
    """Values around a few centres, close and just too far."""
    r = random.Random(5)
    values = set()
    for _ in range(12):
        centre = r.getrandbits(64)
        for _ in range(40):
            v = centre
            for b in r.sample(range(64), r.choice([0, 1, 2, 3, 4])):
                v ^= 1 << b
            values.add(v)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    linked = [(r["src"], r["dst"]) for r in simhash.links(df, Scratch(spark), pairs_up_to=pairs_up_to).collect()]
    nodes = {signed(v) for v in values}
    got = brute.components(nodes | {x for e in linked for x in e}, linked)
    near = [(signed(a), signed(b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2]
    want = brute.components(nodes, near)
    classes = lambda c: {frozenset(x for x in nodes if c[x] == k) for k in {c[x] for x in nodes}}
    assert classes(got) == classes(want)


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, None), (5, "")], "doc_id long, text string")
    got = [(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (None, 1), (None, 5), (5, 5)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def near_corpus():
    r = random.Random(9)
    words = ["v%d" % i for i in range(3000)]
    docs = []
    for _ in range(30):
        base = [r.choice(words) for _ in range(r.randint(60, 400))]
        docs.append(" ".join(base))
        for _ in range(r.choice([0, 1, 3, 12])):
            copy = base[:]
            for _ in range(r.choice([0, 1, 2, 4, 8])):
                copy[r.randrange(len(copy))] = r.choice(words)
            docs.append(" ".join(copy))
    return list(enumerate(docs + [None, "", " ", "one two", "ONE  two"]))


@pytest.mark.parametrize("pairs_up_to, side", [(1, 3), (2, 512), (8, 4), (64, 512)])
def test_similar_texts(spark, near_corpus, clashing, pairs_up_to, side):
    docs = dict(near_corpus)
    linked = [(a, b) for a in docs for b in docs if a < b and brute.jaccard(docs[a], docs[b]) >= 0.8]
    want = brute.components(docs, linked)
    df = clashing(spark.createDataFrame(near_corpus, "doc_id long, text string").repartition(3))
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(df, pairs_up_to=pairs_up_to, side=side).collect()}
    assert got == want


def test_similar_odd_tables(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "b")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.similar(df).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (None, 1), (None, None)], key=str)
    assert simhash.similar(df.limit(0)).count() == 0


def test_plans_hold_at_any_size():
    for n in (0, 1, 1000, 10**6, 10**9):
        p = simhash.Plan(n)
        assert 1 - (1 - (1 - p.differ) ** p.block) ** p.blocks >= 0.999 and 64 * p.words * p.differ < p.radius(p.words) < 32 * p.words


def test_similar_texts_with_repeated_shingles(spark):
    """Shared lines that are repeated many times, in texts that are else of their own, and in texts that are else alike."""
    r = random.Random(21)
    word = lambda: "u%d" % r.randrange(10**6)
    docs = []
    for _ in range(6):
        line = " ".join(word() for _ in range(11))
        for _ in range(2):
            docs.append("\n".join(f"{' '.join(word() for _ in range(8))}\n{line}" for _ in range(40)))
        base = " ".join(word() for _ in range(200))
        docs += [base, base + f"\n{line}" * 40]
        docs += [" ".join(word() for _ in range(14)) + f"\n{line}" * 60 for _ in range(2)]
    docs = dict(enumerate(docs))
    linked = [(a, b) for a in docs for b in docs if a < b and brute.jaccard(docs[a], docs[b]) >= 0.8]
    assert len(linked) == 6
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)).collect()}
    assert got == brute.components(docs, linked)
