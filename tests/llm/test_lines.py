import random

from pyspark.sql import functions as F

from sluice.llm import lines
from tests.llm import brute


def documents():
    r = random.Random(12)
    pool = [" ".join(f"w{r.randrange(50)}" for _ in range(r.choice([1, 2, 5, 9, 30]))) for _ in range(25)]
    docs = [(i, "\n".join(r.choice(pool + ["", "  "]) for _ in range(r.randint(0, 25)))) for i in range(80)]
    return docs + [(80, None), (81, ""), (82, docs[5][1]), (83, "\n".join(["x " * 60] * 3)), (84, "\n\n" + docs[6][1] + "\n")]


def test_against_brute_force(spark, clashing):
    docs = documents()
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    for least in (50, 10, 1):
        got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in lines.dedup_lines(df, least).collect()}
        assert got == brute.deduped_lines(docs, least)


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "a", "x")], "doc_id long, text string, text2 string").withColumn("more", F.lit(5))
    assert lines.dedup_lines(df).first().asDict() == {"doc_id": 1, "text": "a", "text2": "x", "more": 5, "n_removed": 0}


def test_odd_tables(spark):
    line = "word " * 60
    df = spark.createDataFrame([(None, line), (1, line), (1, line), (1, line + "!"), (2, line)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_removed"]) for r in lines.dedup_lines(df).collect()), key=str)
    assert got == sorted([(None, 0), (1, 1), (1, 1), (1, 0), (2, 1)], key=str)
    twice = spark.createDataFrame([(1, line), (1, line)], "doc_id long, text string")
    assert [r["n_removed"] for r in lines.dedup_lines(twice).collect()] == [0, 0]
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_native(spark):
    """No Python, pandas or Arrow operator in the plan."""
    plan = lines.dedup_lines(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_suffix_and_lcp_arrays_against_sorted_suffixes(spark):
    """Places are those of the suffixes in one order of the lines, and neighbours' common lines are counted."""
    r = random.Random(5)
    base = [r.choice("abc") for _ in range(40)]
    texts = ["\n".join(base[r.randrange(20) :][: r.randint(1, 30)] + [r.choice("abcdef") for _ in range(r.randint(0, 6))]) for _ in range(30)]
    texts += ["\n".join("a" * n) for n in (1, 7, 20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string").repartition(3)
    scratch, least = lines.Scratch(spark), 12  # each line is a word, so runs have 12 lines
    rows = scratch.write(lines.line_rows(docs, least), "lines")
    levels, pairs = lines.suffix_array(rows, scratch)
    assert len(levels) == 5  # 16 lines
    lcp = {x["r"]: x["lcp"] for x in lines.common_prefixes(levels, pairs, scratch).collect()}

    names = {x["h0"]: (x["h0"], x["h1"]) for x in rows.collect()}
    whole = {}
    for x in sorted(rows.collect(), key=lambda x: (x["key"], x["i"])):
        whole.setdefault(x["key"], []).append(names[x["h0"]])
    suffixes = sorted(ls[i : i + 16] for ls in whole.values() for i in range(len(ls)))
    places = {}
    for k, level in enumerate(levels):
        places |= {(x["key"], x["i"]): x["r"] for x in level.collect() if x["c"] == 1 or k == len(levels) - 1}
    assert len(places) == len(suffixes)
    for (key, i), place in places.items():
        own = whole[key][i : i + 16]
        assert suffixes[place][: len(own)] == own and (place == 0 or suffixes[place - 1] < own)
    for place in set(places.values()):
        shared = 0
        if place:
            for a, b in zip(suffixes[place - 1], suffixes[place]):
                if a != b:
                    break
                shared += 1
        assert lcp.get(place, 0) == shared
    scratch.close()
