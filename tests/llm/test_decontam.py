import random

import numpy as np
import pytest

from sluice.llm import decontam
from tests.llm import brute


@pytest.fixture(scope="module")
def data():
    r = random.Random(21)
    words = ["t%d" % i for i in range(5000)]
    prose = lambda n: [r.choice(words) for _ in range(n)]
    items = [prose(n) for n in (5, 6, 8, 12, 15, 20, 30, 41, 50, 60, 90, 150, 300)] + [prose(3)]
    docs = [prose(r.randint(0, 300)) for _ in range(40)]
    for item in items:
        for edits in (0, 1, 2, 5):
            part = item[:]
            for _ in range(edits):
                k = r.randrange(len(part))
                if r.random() < 0.5:
                    part[k] = r.choice(words)
                elif len(part) > 1:
                    del part[k]
            docs.append(prose(r.randint(0, 150)) + part + prose(r.randint(0, 150)))
        docs.append(item[2:])
        docs.append([w.upper() for w in item])
    texts = [" ".join(d) for d in docs] + [None, "", "  "]
    return list(enumerate(texts)), list(enumerate(" ".join(i) for i in items))


def test_against_brute_force(spark, data, clashing):
    docs, items = data
    want = {(i, k): round(s, 9) for i, t in docs for k, x in items if (s := brute.weighted_windows(t, x)) >= 0.8}
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    bench = clashing(spark.createDataFrame(items + [(90, None), (91, "")], "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in decontam.contaminated(df, bench).collect()}
    assert got == want
    assert len(want) > 40
    kept = {r["doc_id"] for r in decontam.clean(df, bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}


def test_multi_index_finds_all_within_the_radius():
    r = np.random.default_rng(3)
    values = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    queries = np.concatenate([values, r.integers(0, 1 << 63, 200, dtype=np.uint64)])
    for i in range(200):
        for b in r.choice(64, r.integers(0, 9), replace=False):
            queries[i] ^= np.uint64(1) << np.uint64(b)
    for radius in (0, 3, 4, 7, 21):
        q, v = decontam.MultiIndex(values, radius).near(queries)
        want = {(i, j) for i in range(400) for j in range(200) if int(queries[i] ^ values[j]).bit_count() <= radius}
        assert set(zip(q.tolist(), v.tolist())) == want


def test_blocks_of_items_and_texts(spark, data, monkeypatch):
    docs, items = data
    monkeypatch.setattr(decontam, "ITEM_BYTES", 300)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert len(list(decontam.item_blocks(bench, decontam.Settings(), "item_id", "text"))) > 3
    many = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(df, bench).collect()}
    monkeypatch.undo()
    assert many == {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(df, bench).collect()}
    monkeypatch.setattr(decontam, "BLOCK", 64)
    held = decontam.Items([(k, x) for k, x in items], decontam.Settings())
    words = [decontam.split_words(t) for _, t in docs]
    assert {(t, held.ids[k]) for t, k, _, _ in held.search(words, decontam.WordHashes())} == many


def test_odd_tables(spark):
    item = " ".join(f"u{i}" for i in range(20))
    df = spark.createDataFrame([(1, item), (1, item), (None, item), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (7, item)], "item_id long, text string")
    assert decontam.contaminated(df, bench).count() == 6 and decontam.clean(df, bench).count() == 1
    assert decontam.contaminated(df, bench.limit(0)).count() == 0 and decontam.clean(df, bench.limit(0)).count() == 4
    assert decontam.contaminated(df.limit(0), bench).count() == 0
