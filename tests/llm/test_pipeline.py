"""The corpus pipeline, each stage against a plain version on what its predecessor kept."""

import random

import pytest

import corpus_pipeline as P
from tests.llm import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    r = random.Random(31)
    words = ["".join(r.choice(["ka", "lo", "mi", "tu", "re", "sho"]) for _ in range(r.randint(1, 4))) for _ in range(900)]
    prose = lambda n: [r.choice(words) for _ in range(n)]
    item, passage = prose(40), " ".join(prose(60))
    rows, labels = [], []
    for i in range(400):
        text = prose(r.randint(20, 150))
        bad = r.random() < 0.2
        if bad:
            text += ["zorgle", "plonker"] * 2
        lines = [" ".join(text[k : k + 12]) for k in range(0, len(text), 12)]
        if i % 40 == 7:
            lines.insert(1, passage)
        if i % 40 == 9:
            lines.append("so " + " ".join(item) + " there")
        rows.append((i, "\n".join(lines)))
        labels.append((i, 1, int(bad)))
    near = rows[10][1].split(" ")
    near[5] = "other"
    rows += [(400, rows[10][1]), (401, " ".join(near)), (402, None), (403, "")]
    root = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS).repartition(4).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    toxic = {i for i, _, t in labels if t}
    return str(root), dict(rows), toxic, " ".join(item)


def test_the_stages(spark, world, tmp_path):
    root, docs, toxic, item = world
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    df = spark.read.parquet(f"{root}/documents.parquet")
    kept = dict(docs)
    for name, stage in P.STAGES:
        out = stage(spark, df, root)
        out.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            break
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = {r["doc_id"]: r["text"] for r in df.collect()}
        assert df.count() == len(got)
        if name == "toxicity":
            gone = set(kept) - set(got)
            assert len(gone & toxic) >= 0.95 * len(toxic) and len(gone - toxic) <= 0.02 * len(kept)
            want = {i: kept[i] for i in got}
        elif name == "line_dedup":
            want = {i: t for i, (_, t) in brute.deduped_lines(list(kept.items())).items()}
            assert all(r["n_chars"] == len(r["text"] or "") for r in df.collect() if r["text"] is not None)
        elif name == "near_dedup":
            linked = [(a, b) for a in kept for b in kept if a < b and brute.jaccard(kept[a], kept[b]) >= 0.8]
            comp = brute.components(kept, linked)
            want = {i: t for i, t in kept.items() if comp[i] == i}
        else:
            want = {i: t for i, t in kept.items() if brute.weighted_windows(t, item) < 0.8}
        assert got == want, name
        kept = got
    assert {r["doc_id"] for r in df.collect()} == set(kept)


def test_run_is_the_stages(spark, world):
    root = world[0]
    rows = P.run(spark, root)
    assert rows.columns[:3] == ["doc_id", "start", "length"] and P.ORACLE_SQL is None
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, root)
    pieces = lambda df: sorted(tuple(r) for r in df.select("doc_id", "start", "length", "crc32").collect())
    assert pieces(rows) == pieces(docs)


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_odd_tables(spark, world, name, stage):
    root = world[0]
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "x", None, None, 1), (5, "y z", "en", "s", 3), (5, "y z", "en", "s", 3), (6, "", None, None, None)], COLUMNS)
    out = stage(spark, odd, root)
    assert out.count() > 0
    assert stage(spark, odd.limit(0), root).count() == 0
    if name != "packing":
        assert out.columns == odd.columns
    from pyspark.sql import functions as F

    more = odd.withColumns({c: F.lit(1) for c in ("id", "key", "h", "t", "fp", "gone", "score")})
    assert stage(spark, more, root).count() == out.count()


def test_near_dedup_keeps_one_of_each_group_whatever_the_ids(spark):
    """Null ids, ids of several texts, and a copy that has a null id or the id of another text."""
    r = random.Random(12)
    a, b, c, d, e, f = (" ".join(r.choice("abcdefghijklmnop") * 2 + str(r.randrange(99)) for _ in range(60)) for _ in range(6))
    rows = [(None, a), (None, b), (None, a.upper()), (None, c), (7, c), (7, d), (9, d), (9, e), (9, e), (8, f), (7, f), (None, ""), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS).repartition(3)
    got = [(x["doc_id"], (x["text"] or "").lower()) for x in P.near_dedup(spark, df, "").collect()]
    assert sorted(got, key=str) == sorted([(None, a), (None, b), (7, c), (7, d), (9, e), (7, f), (None, "")], key=str)
