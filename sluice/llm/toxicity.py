"""Toxicity scoring by a factorization machine over hashed terms.

Terms are whole words and the 4- to 6-byte strings within words, hashed into
buckets, so stems count in words never seen before. The machine has a weight per
term and a factor vector per term whose products are the weights of pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, release, text_batches

#: log2 of the number of buckets.
BITS = 22
#: Bytes hashed at once; texts whose terms are held at once.
BLOCK, TEXTS = 1 << 18, 32
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
#: Bytes of words: ASCII letters and digits, and all bytes of other characters.
_IN_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


@functools.cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, as many as bytes are hashed at once; made where they are used."""
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(2 * BLOCK + 64, base, np.uint64)
        x[0] = 1
        tables.append(np.cumprod(x, dtype=np.uint64))
    return tuple(tables)


def _bucket(values: np.ndarray, kind: int) -> np.ndarray:
    x = (values + np.uint64(kind * 0x51ED270B)) * _MIX
    x ^= x >> np.uint64(29)
    return (x * _MIX >> np.uint64(64 - BITS)).astype(np.int32)


def _terms(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(where it begins, bucket) of the terms of each kind in lower-cased bytes of at most 2 * BLOCK."""
    b = np.frombuffer(data, np.uint8)
    if len(b) == 0:
        return
    word = _IN_WORD[b]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], word.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    x, (up, down) = b.astype(np.uint64), powers()
    with np.errstate(over="ignore"):
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum((x + np.uint64(1)) * down[: len(x)], dtype=np.uint64)))
        yield starts, _bucket((prefix[ends] - prefix[starts]) * up[starts], 1)
        outside = np.concatenate(([0], np.cumsum(~word)))
        v = x[:-3] << np.uint64(24) | x[1:-2] << np.uint64(16) | x[2:-1] << np.uint64(8) | x[3:] if len(x) > 3 else x[:0]
        for n in (4, 5, 6):
            if n > 4:
                v = v[:-1] << np.uint64(8) | x[n - 1 :] if len(v) else v
            at = np.flatnonzero(outside[n:] == outside[:-n]) if len(v) else np.empty(0, np.int64)
            yield at, _bucket(v[at], n)


def _pieces(texts: Iterator[str | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Texts gathered into blocks of bytes: (bytes, where each part begins, its text's number).

    A text longer than a block is cut at byte that is in no word, or anywhere if there is none.
    """
    parts, starts, owners, size = [], [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        at = 0
        while True:
            stop = min(len(data), at + BLOCK)
            if stop < len(data):
                tail = np.frombuffer(data[max(at, stop - 4096) : stop], np.uint8)
                gaps = np.flatnonzero(~_IN_WORD[tail])
                stop = max(at, stop - 4096) + int(gaps[-1]) + 1 if len(gaps) else stop
            starts.append(size)
            owners.append(i)
            parts += [data[at:stop], b"\n"]
            size += stop - at + 1
            if size >= BLOCK:
                yield b"".join(parts), np.array(starts), np.array(owners)
                parts, starts, owners, size = [], [], [], 0
            at = stop
            if at >= len(data):
                break
    if parts:
        yield b"".join(parts), np.array(starts), np.array(owners)


def term_rows(texts: list[str | None], slots: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, bucket or slot), each distinct, sorted. ``slots``: slot of each bucket, -1 for none."""
    keys = []
    for data, starts, owners in _pieces(texts):
        for at, bucket in _terms(data):
            value = bucket if slots is None else slots[bucket]
            if slots is not None:
                at, value = at[value >= 0], value[value >= 0]
            owner = owners[np.searchsorted(starts, at, side="right") - 1].astype(np.int64)
            keys.append(np.unique(owner << BITS | value.astype(np.int64)))
    keys = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    return keys >> BITS, keys & ((1 << BITS) - 1)


@dataclass
class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of terms of their factors' products)."""

    slots: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, rows: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
        linear = np.bincount(rows, self.weights[slots], n)
        v = self.factors[slots]
        pair = np.zeros(n)
        for k in range(v.shape[1]):
            pair += np.bincount(rows, v[:, k], n) ** 2 - np.bincount(rows, v[:, k] ** 2, n)
        return self.bias + linear + pair / 2

    def score(self, texts: list[str | None]) -> np.ndarray:
        rows, slots = term_rows(texts, self.slots)
        return 1 / (1 + np.exp(-np.clip(self.logits(rows, slots, len(texts)), -40, 40)))


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled texts of each label to learn from at most, chosen by a hash of the id; ``task``: of them, one task's.

    ``factor_decay`` has the least log loss in five-fold cross-validation on the learning rows of
    the tables at sf0.1 (0.175; 0.211 where it is so high that the factors vanish).
    """

    sample: int = 4000
    task: int = 1024
    terms: int = 8192  # slots are 16-bit
    factors: int = 8
    rounds: int = 50
    rate: float = 0.05
    decay: float = 1e-4
    factor_decay: float = 0.01
    least_chi2: float = 9.0
    seed: int = 17


def fit(rows: np.ndarray, slots: np.ndarray, labels: np.ndarray, settings: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, weights, factors) by Adam on the log loss, whole passes in mini-batches."""
    rng = np.random.default_rng(settings.seed)
    n, size, k = len(labels), settings.terms, settings.factors
    starts = np.searchsorted(rows, np.arange(n + 1))
    theta = np.concatenate((np.zeros((size, 1)), rng.normal(0, 0.02, (size, k))), axis=1).astype(np.float32)
    bias, step, batch = 0.0, 0, 512
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    decay = (np.array([settings.decay] + [settings.factor_decay] * k) / n).astype(np.float32)
    for epoch in range(settings.rounds):
        rate = settings.rate / (1 + 0.1 * epoch)
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            who = order[lo : lo + batch]
            counts = starts[who + 1] - starts[who]
            first = np.cumsum(counts) - counts
            at = np.repeat(starts[who] - first, counts) + np.arange(counts.sum())
            own, s = np.repeat(np.arange(len(who)), counts), slots[at]
            x = theta[s]
            sums, squares, some = np.zeros((len(who), k + 1), np.float32), np.zeros(len(who), np.float32), counts > 0
            if len(s):  # a text's terms lie together
                sums[some] = np.add.reduceat(x, first[some], axis=0)
                squares[some] = np.add.reduceat(np.einsum("ij,ij->i", x[:, 1:], x[:, 1:]), first[some])
            pair = (sums[:, 1:] ** 2).sum(1) - squares
            logit = np.clip(bias + sums[:, 0] + pair / 2, -30, 30)
            err = ((1 / (1 + np.exp(-logit)) - labels[who]) / len(who)).astype(np.float32)
            g = sums[own] - x
            g[:, 0] = 1
            g *= err[own, None]
            grad = np.stack([np.bincount(s, g[:, j], size) for j in range(k + 1)], axis=1).astype(np.float32) + theta * decay * len(who)
            step += 1
            m += np.float32(0.1) * (grad - m)
            v += np.float32(0.01) * (grad**2 - v)
            theta -= np.float32(rate / (1 - 0.9**step)) * m / (np.sqrt(v / np.float32(1 - 0.99**step)) + np.float32(1e-8))
            bias -= rate * float(err.sum())
    return bias, theta[:, 0].astype(float), theta[:, 1:].astype(float)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Machine:
    """Learn a machine from the labelled texts.

    ``labels`` has (id, label); rows with a null in either are ignored, an id that has
    both labels has label 1. At most ``settings.sample`` texts of each label are learnt from,
    taken in the order of a hash of their ids; that bounded list of ids is broadcast
    to the documents. The terms are the ``settings.terms`` with the highest chi-squared
    of at least ``settings.least_chi2``. The bias is then set to the share of label 1 among all labels.
    Without examples of both labels, every text scores that share (a half without
    any label).
    """
    scratch = Scratch(docs.sparkSession)
    text_batches(docs.sparkSession)
    name = lambda c: F.col(f"`{c}`")
    own = labels.select(name(id_col).alias("id"), name(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    own = own.groupBy("id").agg(F.max("label").alias("label"))
    share = dict(own.groupBy("label").count().collect())
    some = [own.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(settings.sample) for k in (0, 1)]
    chosen, tasks = some[0].unionByName(some[1]), -(-2 * settings.sample // settings.task)
    texts = scratch.write(docs.select(name(id_col).alias("id"), name(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "label", "text").repartition(tasks, "id", F.xxhash64("text")), "labelled")
    prior = np.log((share.get(1, 0) + 0.5) / (share.get(0, 0) + 0.5))

    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = [np.zeros(1 << BITS, np.int32) for _ in range(2)]
        for pdf in batches:
            for label in (0, 1):
                group = pdf["text"][pdf["label"] == label]
                for lo in range(0, len(group), TEXTS):
                    _, bucket = term_rows(list(group.iloc[lo : lo + TEXTS]))
                    np.add.at(seen[label], bucket, 1)
        at = np.flatnonzero(seen[0] + seen[1] > 1)
        yield pd.DataFrame({"bucket": at.astype(np.int32), "n0": seen[0][at], "n1": seen[1][at]})
        del seen
        release()

    n0, n1 = (texts.where(F.col("label") == k).count() for k in (0, 1))
    empty = Machine(np.full(1 << BITS, -1, np.int16), float(prior), np.zeros(settings.terms), np.zeros((settings.terms, settings.factors)))
    if not n0 or not n1:
        return empty
    by = texts.mapInPandas(stats, "bucket int, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    a, b, n = F.col("n1"), F.col("n0"), float(n0 + n1)
    chi2 = n * F.pow(a * (n0 - b) - b * (n1 - a), F.lit(2)) / ((a + b) * (n - a - b + 1e-9) * float(n0) * float(n1))
    best = [r[0] for r in by.where(a + b >= 3).select("bucket", chi2.alias("chi2")).where(F.col("chi2") >= settings.least_chi2).orderBy(F.desc("chi2"), "bucket").limit(settings.terms).collect()]
    slots = np.full(1 << BITS, -1, np.int16)
    slots[best] = np.arange(len(best))
    sent = docs.sparkSession.sparkContext.broadcast(slots)

    def slotted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 256):
                part = pdf.iloc[lo : lo + 256]
                rows, s = term_rows(list(part["text"]), sent.value)
                cuts = np.searchsorted(rows, np.arange(1, len(part)))
                yield pd.DataFrame({"id": part["id"].array, "label": part["label"].array, "slots": np.array([x.astype("<u2").tobytes() for x in np.split(s, cuts)], object)})

    rows = texts.mapInPandas(slotted, "id long, label int, slots binary").orderBy("id", "slots").collect()
    each = [np.frombuffer(r["slots"], "<u2").astype(np.int64) for r in rows]
    labels_of = np.array([r["label"] for r in rows], float)
    learnt = np.repeat(np.arange(len(each)), [len(x) for x in each]), np.concatenate(each), labels_of
    bias, weights, factors = fit(*learnt, settings)
    scratch.drop(texts)
    return Machine(slots, float(bias + prior - np.log(n1 / n0)), weights, factors)


def score(docs: DataFrame, machine: Machine, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the score of each whole text (null: empty), 0 to 1.

    Nothing but the text is an input. Repeated rows score alike; an empty table gives
    an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    text_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [sent.value.score(list(texts.iloc[i : i + 256])) for i in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))
        release()

    return docs.withColumn(name, toxic(F.col(f"`{text_col}`")))
