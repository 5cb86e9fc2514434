"""Benchmark decontamination by SimHash of item-sized windows.

Texts and items are words (A-Z lower-cased, split at ASCII white space) and
five-word shingles. A text holds an item if a window of as many shingles as the
item has is similar to it: sum of smaller counts over sum of larger counts of
each shingle at least 0.8.

Each item has one fingerprint, of all its shingles, and so has each window of a text
of just the item's size, wherever a window can begin: at every shingle so near to one
of the item's own that a window from there holds it (others share nothing with it).
A multi-index of Hamming blocks gives all items of that size within the radius, which
a window of the very similarity exceeds with a chance of 1 in 30,000, and the exact
weighted similarity of shingles verifies each candidate.
"""

from __future__ import annotations

import functools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import release, text_batches

#: Shingles hashed at once; words whose hashes a worker keeps; bytes of items sent to workers at once.
BLOCK, WORDS_KEPT, ITEM_BYTES = 1 << 14, 400_000, 16 << 20
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


@dataclass(frozen=True)
class Settings:
    """``slack``: standard deviations of the distance of a window at the similarity, which the radius lies above it."""

    width: int = 5
    similarity: float = 0.8
    slack: float = 4.0

    @property
    def radius(self) -> int:
        differ = math.acos(2 * self.similarity / (1 + self.similarity)) / math.pi
        return int(64 * differ + self.slack * math.sqrt(64 * differ * (1 - differ)))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on, by those words' hashes."""
    n = max(0, len(words) - width + 1)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for j in range(width):
            h = h * _MIX[0] + words[j : j + n]
        h ^= h >> np.uint64(30)
        h *= _MIX[1]
        h ^= h >> np.uint64(27)
        h *= _MIX[2]
        return h ^ (h >> np.uint64(31))


def window_prints(shingles: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of all windows of ``size`` shingles: a bit is 1 if it is set in over half of them."""
    bits = np.zeros((len(shingles) + 1, 64), np.int32)
    bits[1:] = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    running = np.cumsum(bits, axis=0, dtype=np.int32)
    return np.packbits(2 * (running[size:] - running[:-size]) > size, axis=1, bitorder="little").view("<u8").ravel()


class MultiIndex:
    """All of a set of fingerprints within ``radius`` bits of a query.

    The 64 bits are cut into eight blocks. If two fingerprints differ in at most
    ``radius`` bits, they differ in at most radius // 8 bits in one block; for each value of
    each block a bit set says which fingerprints are so near there, and the union of
    a query's eight sets has every one. Those found are verified over all bits.
    """

    def __init__(self, values: np.ndarray, radius: int):
        self.values, self.radius = values, radius
        blocks = values[:, None] >> np.uint64(8) * np.arange(8, dtype=np.uint64) & np.uint64(0xFF)
        near = np.bitwise_count(np.arange(256, dtype=np.uint64)[:, None, None] ^ blocks) <= radius // 8  # value, fingerprint, block
        self.sets = np.packbits(near.transpose(2, 0, 1), axis=2, bitorder="little")

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the query, place of the value) of every pair within the radius."""
        found = [(np.empty(0, np.int64),) * 2]
        step = max(1, (1 << 22) // max(1, len(self.values)))
        for lo in range(0, len(queries), step):
            some = queries[lo : lo + step]
            union = functools.reduce(np.bitwise_or, (self.sets[k, (some >> np.uint64(8 * k) & np.uint64(0xFF)).astype(np.int64)] for k in range(8)))
            q, v = np.nonzero(np.unpackbits(union, axis=1, count=len(self.values), bitorder="little"))
            near = np.bitwise_count(some[q] ^ self.values[v]) <= self.radius
            found.append((q[near] + lo, v[near]))
        return tuple(np.concatenate(x) for x in zip(*found))


class Items:
    """Benchmark items ready to be found in texts.

    An item of under ``width`` words is one shingle, which only a text of just the same words holds.
    """

    def __init__(self, rows: list[tuple[int, str]], settings: Settings):
        self.settings, hashes = settings, WordHashes()
        self.ids, self.texts = [r[0] for r in rows], [r[1] for r in rows]
        self.short: dict[tuple, list[int]] = defaultdict(list)
        by_size, keys = defaultdict(list), []
        for k, (_, text) in enumerate(rows):
            words = split_words(text)
            n = len(words) - settings.width + 1
            if n >= 1:
                shingles = shingle_hashes(np.array([hashes[w] for w in words], np.uint64), settings.width)
                by_size[n].append((k, window_prints(shingles, n)[0]))
                keys.append(np.stack([shingles, np.full(n, n, np.uint64)]))
            elif words:
                self.short[tuple(words)].append(k)
        self.sizes = {n: (np.array([k for k, _ in x]), MultiIndex(np.array([fp for _, fp in x], np.uint64), settings.radius)) for n, x in by_size.items()}
        # which sizes of items have a shingle
        keys = np.unique(np.concatenate(keys, axis=1), axis=1) if keys else np.empty((2, 0), np.uint64)
        self.shingles, self.of_size = keys[0], keys[1].astype(np.int64)
        # tells most shingles of no item at once
        slots = min(27, max(20, len(self.shingles).bit_length() + 4))
        self.shift, self.maybe = np.uint64(64 - slots), np.zeros(1 << slots, bool)
        self.maybe[self.shingles >> self.shift] = True
        self.wanted: dict[int, Counter] = {}

    def verify(self, words: list[bytes], item: int, first: int, last: int) -> tuple[float, int]:
        """Highest similarity of the item with a window that begins from shingle ``first`` to ``last``, and where that begins."""
        width = self.settings.width
        if item not in self.wanted:
            if len(self.wanted) > 1024:
                self.wanted.clear()
            own = split_words(self.texts[item])
            self.wanted[item] = Counter(tuple(own[i : i + width]) for i in range(len(own) - width + 1))
        wanted = self.wanted[item]
        n = sum(wanted.values())
        size = min(n, len(words) - width + 1)
        row = [tuple(words[i : i + width]) for i in range(first, last + size)]
        have, both, best = Counter(), 0, (0.0, 0)
        for i, s in enumerate(row):
            have[s] += 1
            both += have[s] <= wanted.get(s, 0)
            if i >= size:
                old = row[i - size]
                both -= have[old] <= wanted.get(old, 0)
                have[old] -= 1
            if i >= size - 1:
                best = max(best, (both / (n + size - both), -(first + i - size + 1)))
        return best[0], -best[1]

    def search(self, texts: list[list[bytes]], hashes: WordHashes) -> list[tuple[int, int, float, int]]:
        """(number of the text, number of the item, similarity, first word) of the items that texts hold."""
        width, s = self.settings.width, self.settings.similarity
        hits = [(t, k, 1.0, 0) for t, words in enumerate(texts) if len(words) < width for k in self.short.get(tuple(words), ())]
        # shingles of all texts in one row; owner and place tell whose they are
        rows = [shingle_hashes(np.array([hashes[w] for w in words], np.uint64), width) for words in texts]
        lengths = np.array([len(r) for r in rows], np.int64)
        ends, whole = np.cumsum(lengths), np.concatenate(rows) if rows else np.empty(0, np.uint64)
        at = np.flatnonzero(self.maybe[whole >> self.shift])
        lo, hi = (np.searchsorted(self.shingles, whole[at], side=side) for side in ("left", "right"))
        count = hi - lo
        size = self.of_size[np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        at = np.repeat(at, count)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for n in np.unique(size).tolist():
            p = at[size == n]
            t = np.searchsorted(ends, p, side="right")
            begin, length = (ends - lengths)[t], lengths[t]
            long_enough = length >= s * n
            p, t, begin, length = (x[long_enough] for x in (p, t, begin, length))
            own = np.minimum(n, length)  # a text shorter than the item is one window
            first, last = np.maximum(begin, p - own + 1), np.minimum(p, begin + length - own)
            new = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (first[1:] > last[:-1] + 1)))) if len(t) else np.empty(0, np.int64)
            items, index = self.sizes[n]
            for a, b in zip(new.tolist(), np.append(new[1:], len(t)).tolist()):
                who, start = int(t[a]), int(begin[a])
                for lo in range(int(first[a]), int(last[b - 1]) + 1, BLOCK):
                    stop = min(lo + BLOCK, int(last[b - 1]) + 1)
                    q, v = index.near(window_prints(whole[lo : stop - 1 + int(own[a])], int(own[a])))
                    for k in np.unique(v).tolist():
                        near, item = q[v == k], int(items[k])
                        found = self.verify(texts[who], item, lo + int(near[0]) - start, lo + int(near[-1]) - start)
                        if found[0] >= s and found[0] > best.get((who, item), (0.0, 0))[0]:
                            best[who, item] = found
        return hits + [(t, k, x, first) for (t, k), (x, first) in best.items()]


def item_blocks(benchmark: DataFrame, settings: Settings, id_col: str, text_col: str) -> Iterator[Items]:
    """The items in blocks of at most ``ITEM_BYTES`` of text, read one partition at a time; what is broadcast is one block."""
    rows, size = [], 0
    own = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    for r in own.toLocalIterator():
        rows.append((r["id"], r["text"]))
        size += len(r["text"])
        if size > ITEM_BYTES:
            yield Items(rows, settings)
            rows, size = [], 0
    if rows:
        yield Items(rows, settings)


def _searched(texts: pd.Series, items: Items, hashes: WordHashes) -> Iterator[tuple[int, list]]:
    """(first place, hits) of runs of texts of bounded size."""
    run, first, size = [], 0, 0
    for i, text in enumerate(texts):
        words = split_words(text)
        run.append(words)
        size += len(words)
        if size >= 4 * BLOCK or i == len(texts) - 1:
            yield first, items.search(run, hashes)
            run, first, size = [], i + 1, 0


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per text and item that it holds: (id, item, similarity, first_word).

    ``first_word`` is where the most similar window begins. Null and empty texts and
    items hold nothing; an item of under five words is held only by a text of just the
    same words. A null id is carried along; repeated rows are found as often as they stand there, and so are repeated
    items. Empty tables give an empty result. Documents stay in their own partitions.
    """
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = f"`{id_col}` long, `{item_col}` long, similarity double, first_word long"
    text_batches(docs.sparkSession)
    found = None
    for items in item_blocks(benchmark, settings, item_col, text_col):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            hashes = WordHashes()
            for pdf in batches:
                ids = pdf["id"].astype("Int64")
                for first, hits in _searched(pdf["text"], sent.value, hashes):
                    if hits:
                        t, k, s, at = zip(*hits)
                        yield pd.DataFrame({id_col: ids.iloc[[first + x for x in t]].array, item_col: pd.array([sent.value.ids[x] for x in k], "Int64"), "similarity": s, "first_word": at})

        part = own.mapInPandas(run, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text_col: str = "text", benchmark_text: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` without the rows whose text holds an item; see ``contaminated``. No shuffle."""
    text_batches(docs.sparkSession)
    for items in item_blocks(benchmark, settings, item_col, benchmark_text):
        docs = docs.where(_free(docs.sparkSession.sparkContext.broadcast(items))(F.col(f"`{text_col}`")))
    return docs


def _free(sent):
    @F.pandas_udf("boolean")
    def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for texts in batches:
            out = np.ones(len(texts), bool)
            for first, hits in _searched(texts, sent.value, hashes):
                out[[first + h[0] for h in hits]] = False
            yield pd.Series(out)
        hashes.clear()
        release()

    return free
