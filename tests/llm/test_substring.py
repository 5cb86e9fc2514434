import hashlib

import numpy as np
import pandas as pd
import pytest

from sluice.llm import substring
from tests.llm import brute


def as_dict(docs, settings=substring.Settings()):
    rows = substring.dedup_substrings(docs, settings, form=substring.DIGESTS).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}


def test_against_brute_force(documents, corpus, clashing):
    want = brute.substring_digests(corpus)
    assert as_dict(clashing(documents)) == want
    for r in substring.dedup_substrings(documents).collect():
        spans = np.array([(s["start"], s["end"]) for s in r["spans"]], int).reshape(-1, 2)
        kept = substring.kept_bytes(bytes(r["data"]), spans[:, 0], spans[:, 1])
        assert (len(r["data"]), len(r["data"]) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) == want[r["doc_id"]]


def local(docs, length=100, rows=7):
    """The operator's steps on this process's own frames, in small batches; the key is the id."""

    def batches(df):
        return (df.iloc[i : i + rows] for i in range(0, len(df), rows))

    def ordered(df):
        return df.sort_values([c for c in substring.ORDER if c in df], ignore_index=True)

    texts = pd.DataFrame(docs, columns=["key", "text"])
    known = pd.concat(substring.match_records(batches(ordered(pd.concat(substring.find_records(length)(batches(texts)))))))
    asked = known[~known["settled"].astype(bool)].groupby("key")[list(substring.ASKED)].agg(list).map(np.array).add_prefix("a_")
    joined = texts.merge(asked, left_on="key", right_index=True)
    fetched = pd.concat(substring.fetch_contexts(length)(batches(joined)))
    done = fetched["settled"].astype(bool)
    last = pd.concat([pd.DataFrame(columns=["key", "lo", "n"]), *substring.match_contexts(length)(batches(ordered(fetched[~done])))])
    every = pd.concat([known[known["settled"].astype(bool)], fetched[done], last])
    gone = {k: (g["lo"].to_numpy(int), g["n"].to_numpy(int)) for k, g in every.groupby("key")}
    out = {}
    for k, t in docs:
        data = (t or "").encode()
        spans = substring.removed_spans(*gone.get(k, (np.empty(0, int),) * 2), length)
        kept = substring.kept_bytes(data, *spans)
        out[k] = (len(data), len(data) - len(kept), len(spans[0]), hashlib.sha256(kept).hexdigest())
    return out, known, fetched


@pytest.mark.parametrize("hot,flush,rows", [(4096, 1 << 23, 1 << 16), (2, 2000, 64), (1, 1, 8), (3, 5000, 1)])
def test_small_bounds_change_nothing(corpus, monkeypatch, hot, flush, rows):
    """With few contexts an anchor, few bytes and few rows at a time, all paths for large inputs are taken."""
    for name, value in (("HOT", hot), ("FLUSH", flush), ("ROWS", rows), ("BLOCK", 1 << 12)):
        monkeypatch.setattr(substring, name, value)
    substring.powers.cache_clear()
    got, known, fetched = local(corpus)
    substring.powers.cache_clear()
    assert got == brute.substring_digests(corpus)
    assert known["hot"].any() == (hot < 4096) and fetched["context"].isna().any() == (hot < 4096)


def test_suffix_sort_is_lexicographic_and_stable():
    r = np.random.default_rng(2)
    data = r.integers(97, 99, 600).astype(np.uint8)
    sizes = np.array([1, 40, 300, 2])
    at = r.integers(0, 500, sizes.sum())
    order = substring.SuffixSort(data, 20).sort(at, sizes)
    raw, begin = data.tobytes(), 0
    for n in sizes:
        own = list(range(begin, begin + n))
        assert order[begin : begin + n].tolist() == sorted(own, key=lambda i: raw[at[i] : at[i] + 20])
        begin += n


def test_collisions_are_caught(monkeypatch):
    data = np.frombuffer(b"abcdefgh" * 4 + b"abcdefgx" * 4, np.uint8)
    s = substring.SuffixSort(data, 8)
    monkeypatch.setattr(s, "common", lambda x, y: np.full(len(x), 8))  # every hash equal
    assert s.repeats(np.array([0, 32, 8, 24]), np.array([4])).tolist() == [False, False, True, True]


def test_odd_tables(spark):
    long = "qwertyuiop" * 12
    rows = [(1, long), (1, long), (1, "z" + long), (None, long), (None, None), (4, "x"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in substring.dedup_substrings(df, form=substring.DIGESTS).collect()), key=str)
    own = brute.substring_digests([(0, long)])[0][1]  # repeats itself every ten bytes
    later = sorted(n for _, n, _, _ in [(0, *x[1:]) for x in [brute.substring_digests([(0, long), (1, long), (2, "z" + long)])[k] for k in (1, 2)]])
    assert (None, 120, own) in got and got.count((1, 120, 120)) == 2 and (1, 121, 120) in got and later == [120, 120]
    assert (None, 0, 0) in got and (4, 1, 0) in got and (4, 0, 0) in got and len(got) == 7
    assert substring.dedup_substrings(df.limit(0)).count() == 0


@pytest.mark.parametrize("length", [64, 100, 127])
def test_lengths(spark, corpus, length):
    df = spark.createDataFrame(corpus[40:], "doc_id long, text string")
    got = as_dict(df, substring.Settings(length))
    assert got == brute.substring_digests(corpus[40:], length)
