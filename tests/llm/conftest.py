import random

import pytest

WORDS = ["w%d" % i for i in range(400)]


@pytest.fixture(scope="session")
def corpus():
    """(id, text): random texts, copies, near copies, nulls, empties, long and unbroken ones, other scripts."""
    r = random.Random(3)
    prose = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    texts = [prose(r.randint(1, 120)) for _ in range(60)]
    passage = prose(60)
    texts += [texts[3]] * 5 + [texts[7].replace("w1", "w2", 1), None, "", "  \t\n ", "x" * 5000, "é日本語 " * 80, "a" * 350, "ab" * 300]
    texts += [prose(20) + " " + passage + " " + prose(r.randint(1, 20)) for _ in range(12)]
    long = [r.choice(WORDS) for _ in range(3000)]
    near = long[:]
    near[1500] = "changed"
    texts += [" ".join(long), " ".join(near)]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def documents(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)


@pytest.fixture
def clashing():
    """Adds columns by names the operators use for themselves."""
    from pyspark.sql import functions as F

    names = "id key h k v c fp n t p0 gone spans data low component src dst node label score sums pieces side doc conv_idx"
    return lambda df: df.withColumns({x: F.lit("clash") for x in names.split() if x not in df.columns})
