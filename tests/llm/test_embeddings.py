import numpy as np
import pytest

from sluice.llm import embeddings
from tests.llm import brute


def vectors():
    r = np.random.default_rng(4)
    rows = [r.standard_normal(16) for _ in range(150)]
    for _ in range(6):
        centre = r.standard_normal(16)
        rows += [centre + r.standard_normal(16) * r.choice([0.02, 0.05, 0.08, 0.12]) for _ in range(25)]
    rows += [rows[0], rows[0] * 3, rows[1], -rows[2], rows[200], rows[200] * 1e-30]
    return [[float(np.float32(x)) for x in v] for v in rows]


def expected(rows):
    sound = {i: np.array(v, float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in sound.items()}
    linked = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    comp = brute.components([i for i, _ in rows], linked)
    return {i: (sum(i in e for e in linked), comp[i], comp[i] == i) for i, _ in rows}


@pytest.mark.parametrize("settings", [embeddings.Settings(), embeddings.Settings(cell=16, block=8)])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_against_brute_force(spark, clashing, settings, kind):
    rows = list(enumerate(vectors()))
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1.0]]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    df = clashing(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(4))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(df, settings=settings).collect()}
    assert got == expected(rows)


def test_the_count_is_calibrated():
    s = embeddings.Settings()
    r = np.random.default_rng(6)
    u = embeddings.unit(r.standard_normal((4000, 64)))
    w = r.standard_normal((4000, 64))
    w -= (w * u).sum(1, keepdims=True) * u
    v = 0.95 * u + np.sqrt(1 - 0.95**2) * embeddings.unit(w)
    a = embeddings.directions(64, s.projections, 1)
    count = (np.abs(u @ a - v @ a) <= s.window).sum(1)
    assert (count >= s.collisions()).mean() >= 0.99
    assert (np.abs(u @ a - v[::-1] @ a) <= s.window).sum(1).__ge__(s.collisions()).mean() < 0.05


def test_recall_at_the_threshold(spark):
    r = np.random.default_rng(8)
    u = embeddings.unit(r.standard_normal((400, 32)))
    w = r.standard_normal((400, 32))
    w -= (w * u).sum(1, keepdims=True) * u
    v = 0.952 * u + np.sqrt(1 - 0.952**2) * embeddings.unit(w)
    rows = [(i, x.tolist()) for i, x in enumerate(np.concatenate((u, v)))]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), settings=embeddings.Settings(cell=16)).where("vec_id < 400 AND n_links > 0").count()
    assert got >= 0.95 * 400


def test_odd_tables(spark):
    df = spark.createDataFrame([(3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [1.0, 0.001]), (None, None)], "vec_id long, embedding array<float>")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 2, 3, True), (3, 2, 3, True), (None, 2, 3, False), (None, 0, None, False)], key=str)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
