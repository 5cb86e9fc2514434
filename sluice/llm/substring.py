"""Exact substring dedup by a hash-compared suffix sort.

Every window of ``length`` bytes that also starts earlier is found, over all texts.
A window is known by its anchor: the place in it of the 32-byte string with the
smallest hash, which equal windows have in the same place. Windows in a row with
one anchor are one record, so a record stands for some thirty windows, and only
records whose anchors have the same string can hold equal windows. Records whose
whole context is equal, by a cryptographic digest of its bytes, are settled at
once, first within a task and then between tasks: copied stretches, whose bytes
would else all be shuffled. Of what is left, the contexts themselves meet, and their
windows are sorted as suffixes: a mergesort in which two suffixes are compared by
binary search for their common extension on prefix polynomial hashes. Neighbours
that agree on all bytes are verified byte by byte. No polynomial hash decides
anything that is not verified.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, text_batches

#: Bytes hashed at once; bytes whose records a task holds together; rows looked at together.
BLOCK, FLUSH, ROWS = 1 << 20, 3 << 22, 1 << 16
#: Contexts of one anchor string beyond which their windows go to other tasks each by itself.
HOT = 4096
GRAM = 32
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.uint64((1 << 24) - 1)


@functools.cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, as many as bytes are hashed at once; made where they are used."""
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(2 * BLOCK + (1 << 12), base, np.uint64)
        x[0] = 1
        tables.append(np.cumprod(x, dtype=np.uint64))
    return tuple(tables)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def digests(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two 64-bit integers for each stretch of bytes: a digest that only equal bytes share."""
    view, one = memoryview(data), hashlib.blake2b
    raw = b"".join([one(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())])
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


class Prefixes:
    """Prefix polynomial hashes of some bytes; the hash of any stretch in constant time."""

    def __init__(self, data: np.ndarray):
        self.up, down = powers()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: len(data)], out=self.sums[1:])

    def hash(self, at: np.ndarray, length) -> np.ndarray:
        """Modulo 2 ** 64, unmixed: equal stretches have equal hashes wherever they lie."""
        return (self.sums[at + length] - self.sums[at]) * self.up[at]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done, m = 1, x
    while done * 2 <= width:
        m = np.minimum(m[:-done], m[done:])
        done *= 2
    return np.minimum(m[: len(m) - (width - done)], m[width - done :]) if width > done else m


def records(data: bytes, starts: np.ndarray, ends: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """One record per anchor and run of windows in some texts that lie in ``data``.

    doc: which text; lo and n: first window and number of windows; d: bytes from lo
    to the anchor; h: hash of the anchor's string; c and e: digest of the whole context; l and r: hash of
    the anchor with half of what else a window holds on its left and on its right
    (0: no window holds that), 16 bits each. Equal windows lie in records that agree
    on h and on l or r.
    """
    b = np.frombuffer(data, np.uint8)
    none = {k: np.empty(0, np.int64) for k in ("doc", "lo", "n", "d", "l", "r", "c", "e")} | {"h": np.empty(0, np.uint64)}
    if len(b) < length:
        return none
    p = Prefixes(b)
    grams = mix(p.hash(np.arange(len(b) - GRAM + 1), GRAM))
    least = sliding_min(grams & ~_PLACE | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1)
    sizes = np.maximum(0, ends - starts - length + 1)
    first = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    if not total:
        return none
    doc = np.repeat(np.arange(len(starts)), sizes)
    at = np.arange(total) + np.repeat(starts - first, sizes)
    anchor = (least[at] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))))
    n = np.diff(np.append(new, total))
    lo, a, doc = at[new], anchor[new], doc[new]
    d = a - lo
    h = grams[a]
    c, e = digests(data, lo, lo + n - 1 + length).T
    half = (length - GRAM) // 2
    left, right = d >= half, d - (n - 1) < half
    l, r = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)  # noqa: E741
    l[left] = (mix(p.hash(a[left] - half, half + GRAM)) & np.uint64(0xFFFF)).astype(np.int64) | 1
    r[right] = (mix(p.hash(a[right], length - half + 1)) & np.uint64(0xFFFF)).astype(np.int64) | 1
    small = {"doc": doc, "lo": lo - starts[doc], "n": n, "d": d, "l": l, "r": r}
    return {k: v.astype(np.int32) for k, v in small.items()} | {"h": h, "c": c, "e": e}


def merged(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges [lo, hi] of each key, those that touch joined."""
    order = np.lexsort((lo, key))
    key, lo, hi = key[order], lo[order], hi[order]
    if not len(key):
        return key, lo, hi
    group = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
    span = int(hi.max()) + 2
    reach = np.maximum.accumulate(hi + group * span)  # a key's ranges stay below the next key's
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (lo[1:] + group[1:] * span > reach[:-1] + 1)))
    at = np.flatnonzero(new)
    return key[at], lo[at], (reach - group * span)[np.append(at[1:], len(key)) - 1]


COLUMNS = "settled boolean, h long, c long, e long, l int, r int, key long, lo long, n long, d int"
#: The order in which equal records meet, the earliest first.
ORDER = ("h", "c", "e", "key", "lo")


def _again(names: tuple[str, ...], columns: dict, last: tuple | None = None) -> np.ndarray:
    """Which rows, in order of ``names``, agree in them with the one before; ``last``: what the rows before ended with."""
    x = [np.asarray(columns[k]) for k in names]
    if not len(x[0]):
        return np.empty(0, bool)
    return np.concatenate(([last == tuple(v[0] for v in x)], np.logical_and.reduce([v[1:] == v[:-1] for v in x])))


def _settled(key: np.ndarray, lo: np.ndarray, hi: np.ndarray, **more) -> pd.DataFrame:
    key, lo, hi = merged(key, lo, hi)
    return pd.DataFrame({"key": key, "lo": lo, "n": hi - lo + 1} | {k: np.full(len(key), v) for k, v in more.items()})


def find_records(length: int):
    """Records of texts; of equal ones in a task only the first goes on, the others' windows are settled."""

    def flush(parts: list[dict]) -> Iterator[pd.DataFrame]:
        x = {k: np.concatenate([p.pop(k) for p in parts]) for k in list(parts[0])}
        order = np.lexsort(tuple(x[k] for k in reversed(ORDER)))
        x = {k: x.pop(k)[order] for k in list(x)}
        again = _again(ORDER[:3], x)
        gone = _settled(x["key"][again], x["lo"][again], x["lo"][again] + x["n"][again] - 1, settled=True, h=0, c=0, e=0, l=0, r=0, d=0)
        gone["h"] = mix(gone["key"].to_numpy().astype(np.uint64)).view(np.int64)  # spread
        kept = {k: v[~again] for k, v in x.items()}
        out = pd.DataFrame({"settled": np.zeros(len(kept["h"]), bool), "h": kept["h"].view(np.int64)} | {k: kept[k] for k in ("c", "e", "l", "r", "key", "lo", "n", "d")})
        names = list(out.columns)
        for frame in (gone, out):
            for i in range(0, len(frame), ROWS):
                yield frame.iloc[i : i + ROWS][names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held, block, size = [], 0, [], 0

        def hashed():
            sizes = np.array([len(x) for _, _, x in block])
            ends = np.cumsum(sizes)
            found = records(b"".join(x for _, _, x in block), ends - sizes, ends, length)
            doc = found.pop("doc")
            found["key"] = np.array([k for k, _, _ in block], np.int64)[doc]
            found["lo"] += np.array([a for _, a, _ in block], np.int32)[doc]
            return found

        for pdf in batches:
            for key, text in zip(pdf["key"].tolist(), pdf["text"]):
                data = (text or "").encode("utf-8", "surrogatepass")
                for a in range(0, len(data) - length + 1, BLOCK):
                    block.append((key, a, data[a : a + BLOCK + length - 1]))
                    size += len(block[-1][2])
                    if size >= BLOCK:
                        parts.append(hashed())
                        held, block, size = held + size, [], 0
                if held >= FLUSH:
                    yield from flush(parts)
                    parts, held = [], 0
        if block:
            parts.append(hashed())
        if parts:
            yield from flush(parts)

    return run


def _gathered(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def match_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Settle equal records, and ask for the contexts of those that may share windows; rows in ``ORDER``.

    An anchor string with more records than fit is taken as hot as they come, so a
    task holds a bounded number of rows.
    """
    carry, hot, last = None, None, None

    def work(x: pd.DataFrame, known_hot) -> Iterator[pd.DataFrame]:
        key, lo, n = (x[k].to_numpy() for k in ("key", "lo", "n"))
        again = _again(ORDER[:3], x, last)
        yield _settled(key[again], lo[again], lo[again] + n[again] - 1, settled=True, h=0, d=0, hot=False)
        x = x[~again]
        h, l, r = x["h"].to_numpy(), x["l"].to_numpy(), x["r"].to_numpy()  # noqa: E741
        if not len(h):
            return
        _, inverse, sizes = np.unique(h, return_inverse=True, return_counts=True)
        shared = np.zeros(len(h), bool)
        for tag in (l, r):
            pairs = inverse.astype(np.int64) << 17 | tag
            _, at, times = np.unique(pairs, return_inverse=True, return_counts=True)
            shared |= (times[at] > 1) & (tag > 0)
        is_hot = (sizes[inverse] > HOT) | (h == known_hot if known_hot is not None else False)
        ask = shared | is_hot
        out = x[ask][["key", "lo", "n", "h", "d"]].copy()
        out["settled"], out["hot"] = False, is_hot[ask]
        yield out

    for pdf in _gathered(batches, ROWS):
        done = pdf["settled"].to_numpy()
        if done.any():
            out = pdf.loc[done, ["key", "lo", "n"]].copy()
            out["settled"], out["h"], out["d"], out["hot"] = True, 0, 0, False
            yield out[["settled", "key", "lo", "n", "h", "d", "hot"]]
        pdf = pdf[~done]
        if carry is not None:
            pdf = pd.concat([carry, pdf], ignore_index=True)
        if not len(pdf):
            continue
        h = pdf["h"].to_numpy()
        stop = int(np.searchsorted(h, h[-1]))  # rows are in order of h; its last value may go on
        if stop == 0 and len(pdf) < 8 * HOT:
            carry = pdf
            continue
        whole = pdf if stop == 0 else pdf.iloc[:stop]
        for out in work(whole, h[0] if stop == 0 or hot == h[0] else None):
            yield out[["settled", "key", "lo", "n", "h", "d", "hot"]]
        tail = whole.iloc[-1]
        last = tuple(tail[k] for k in ORDER[:3])
        hot = h[0] if stop == 0 else hot
        carry = None if stop == 0 else pdf.iloc[stop:]
    if carry is not None and len(carry):
        for out in work(carry, hot if hot == carry["h"].iloc[0] else None):
            yield out[["settled", "key", "lo", "n", "h", "d", "hot"]]


class SuffixSort:
    """Lexicographic order of suffixes within buckets, each cut off after ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.prefixes = data, length, Prefixes(data)
        self.steps = [1 << k for k in reversed(range(length.bit_length()))]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes that suffixes have in common, by binary search on the hashes of their prefixes."""
        n, sums, up = np.zeros(len(x), np.int64), self.prefixes.sums, self.prefixes.up
        for step in self.steps:
            fits = n + step <= self.length
            a, b = x + n, y + n
            end_a, end_b = np.where(fits, a + step, a), np.where(fits, b + step, b)
            same = fits & ((sums[end_a] - sums[a]) * up[a] == (sums[end_b] - sums[b]) * up[b])
            n += step * same
        return n

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(x, y)
        whole = n >= self.length
        k = np.where(whole, 0, n)
        return np.where(whole, or_equal, self.data[x + k] < self.data[y + k])

    def sort(self, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Stable order of the suffixes ``at``, whose buckets lie one behind the other; all merges of a level at once."""
        ends = np.repeat(np.cumsum(sizes), sizes)
        begins = ends - np.repeat(sizes, sizes)
        order, place, run = np.arange(len(at)), np.arange(len(at)), 1
        most = int(sizes.max(initial=0))
        while run < most:
            base = begins + (place - begins) // (2 * run) * (2 * run)
            left = place - base < run
            other = np.where(left, np.minimum(base + run, ends), base)
            stop = np.where(left, np.minimum(base + 2 * run, ends), np.minimum(base + run, ends))
            lo, hi, own = other.copy(), stop.copy(), at[order]
            open_ = np.flatnonzero(lo < hi)
            while len(open_):
                mid = (lo[open_] + hi[open_]) // 2
                # of the right run those less than a left suffix go before it, of the left run those not greater than a right one
                goes_first = self.less(own[mid], own[open_], ~left[open_])
                lo[open_] = np.where(goes_first, mid + 1, lo[open_])
                hi[open_] = np.where(goes_first, hi[open_], mid)
                open_ = open_[lo[open_] < hi[open_]]
            to = base + (place - np.where(left, base, base + run)) + (lo - other)
            sorted_ = np.empty_like(order)
            sorted_[to] = order
            order, run = sorted_, 2 * run
        return order

    def repeats(self, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which suffixes agree over the whole length with one further to the front of their bucket."""
        out = np.zeros(len(at), bool)
        if len(at) < 2:
            return out
        order = self.sort(at, sizes)
        bucket = np.repeat(np.arange(len(sizes)), sizes)
        x, y = order[:-1], order[1:]
        same = np.flatnonzero((bucket[x] == bucket[y]) & (self.common(at[x], at[y]) >= self.length))
        view = sliding_window_view(self.data, self.length)
        for i in range(0, len(same), 1 << 14):
            s = same[i : i + (1 << 14)]
            if not (view[at[x[s]]] == view[at[y[s]]]).all():  # equal hashes of unequal bytes: compare all by their bytes
                return self._by_bytes(at, bucket)
        out[y[same]] = True
        return out

    def _by_bytes(self, at: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        seen, raw = set(), self.data.tobytes()
        keys = [(b, raw[a : a + self.length]) for a, b in zip(at.tolist(), bucket.tolist())]
        return np.array([k in seen or seen.add(k) is not None for k in keys])


def window_repeats(group: np.ndarray, d: np.ndarray, n: np.ndarray, contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, window of it) of all windows that an earlier context of the same group also has with its anchor in the same place."""
    sizes = np.array([len(x) for x in contexts])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    owner = np.repeat(np.arange(len(n)), n)
    t = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    bucket = group[owner] * 256 + d[owner] - t
    order = np.lexsort((owner, bucket))
    _, counts = np.unique(bucket[order], return_counts=True)
    order = order[np.repeat(counts > 1, counts)]
    counts = counts[counts > 1]
    at = (np.cumsum(sizes) - sizes)[owner[order]] + t[order]
    again = order[SuffixSort(data, length).repeats(at, counts)]
    return owner[again], t[again]


def match_contexts(length: int):
    """Settle windows that another context, or for hot anchors another window, holds earlier; rows in order of h, c, key, lo.

    A hot anchor's windows come without a context, h and c being the digest of each.
    """

    def cold(x: pd.DataFrame) -> Iterator[pd.DataFrame]:
        h, n = x["h"].to_numpy(), x["n"].to_numpy()
        key, lo, d, contexts = x["key"].to_numpy(), x["lo"].to_numpy(), x["d"].to_numpy().astype(np.int64), x["context"].tolist()
        group = np.concatenate(([0], np.cumsum(h[1:] != h[:-1])))
        at = 0
        ends = np.cumsum([len(c) for c in contexts])
        while at < len(x):  # whole groups, with a bounded number of bytes in all; one group has no more than HOT contexts
            many = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK))
            stop = len(x) if many >= len(x) else int(np.searchsorted(group, group[many]))
            stop = stop if stop > at else int(np.searchsorted(group, group[at], side="right"))
            s = slice(at, stop)
            who, t = window_repeats(group[s], d[s], n[s], contexts[s], length)
            yield _settled(key[s][who], lo[s][who] + t, lo[s][who] + t)
            at = stop

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry, last = None, None
        for pdf in _gathered(batches, ROWS // 4):
            windows = pdf["context"].isna().to_numpy()
            if windows.any():
                x = pdf[windows]
                again = _again(("h", "c"), x, last)
                last = (x["h"].iloc[-1], x["c"].iloc[-1])
                yield _settled(x["key"].to_numpy()[again], x["lo"].to_numpy()[again], x["lo"].to_numpy()[again])
            pdf = pdf[~windows]
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if len(pdf):
                stop = int(np.searchsorted(pdf["h"].to_numpy(), pdf["h"].iloc[-1]))
                carry = pdf.iloc[stop:]  # no more than HOT contexts
                yield from cold(pdf.iloc[:stop])
        if carry is not None and len(carry):
            yield from cold(carry)

    return run


#: What is known of a context that is asked for; a text's come as one array each, which takes far less room than records.
ASKED = ("h", "lo", "n", "d", "hot")


def gathered(df: DataFrame, names: tuple[str, ...], prefix: str) -> DataFrame:
    """(key, <prefix><name> ...): each key's values as arrays in one order."""
    by = df.groupBy("key").agg(F.collect_list(F.struct(*names)).alias("x"))
    return by.select("key", *[F.transform("x", _field(c)).alias(f"{prefix}{c}") for c in names])


def _field(name: str):
    return lambda r: r[name]


def fetch_contexts(length: int):
    """The contexts that were asked for; a hot anchor's windows instead by a digest of each, of equal ones in a task the first."""

    def windows(held: list[tuple]) -> Iterator[pd.DataFrame]:
        h, c, key, lo = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((lo, key, c, h))
        h, c, key, lo = h[order], c[order], key[order], lo[order]
        again = _again(("h", "c"), {"h": h, "c": c})
        for own, settled in ((again, True), (~again, False)):
            k = int(own.sum())
            if k:
                yield pd.DataFrame({"settled": settled, "h": h[own], "c": c[own], "key": key[own], "lo": lo[own], "n": np.ones(k, np.int64), "d": np.zeros(k, np.int32), "context": np.full(k, None, object)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0
        for pdf in batches:
            rows = []
            for key, text, *asked in zip(pdf["key"].tolist(), pdf["text"], *[pdf[f"a_{c}"] for c in ASKED]):
                data = (text or "").encode("utf-8", "surrogatepass")
                for h, lo, n, d, hot in zip(*[a.tolist() for a in asked]):
                    context = data[lo : lo + n - 1 + length]
                    if not hot:
                        rows.append((False, h, 0, key, lo, n, d, context))
                        continue
                    at = np.arange(n)
                    held.append((*digests(context, at, at + length).T, np.full(n, key), lo + at))
                    count += n
                if count > ROWS:
                    yield from windows(held)
                    held, count = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=["settled", "h", "c", "key", "lo", "n", "d", "context"])
        if held:
            yield from windows(held)

    return run


@dataclass(frozen=True)
class Settings:
    length: int = 100


def repeated_ranges(docs: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    """(key, gone_lo, gone_n): of each text with windows that start earlier, the first and the number of each run of them.

    ``docs`` has a unique non-null long ``key``, in whose order texts stand, and ``text``.
    """
    first = docs.mapInPandas(find_records(length), COLUMNS)
    ordered = first.repartition("h").sortWithinPartitions(*ORDER)
    known = scratch.write(ordered.mapInPandas(match_records, "settled boolean, key long, lo long, n long, h long, d int, hot boolean"), "records")
    asked = gathered(known.where("NOT settled"), ASKED, "a_")
    fetched = scratch.write(docs.join(asked, "key").mapInPandas(fetch_contexts(length), "settled boolean, h long, c long, key long, lo long, n long, d int, context binary"), "contexts")
    meeting = fetched.where("NOT settled").repartition("h").sortWithinPartitions("h", "c", "key", "lo")
    sorted_out = meeting.mapInPandas(match_contexts(length), "key long, lo long, n long")
    every = known.where("settled").select("key", "lo", "n").unionByName(fetched.where("settled").select("key", "lo", "n")).unionByName(sorted_out)
    return gathered(every, ("lo", "n"), "gone_")


def removed_spans(lo: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the byte ranges covered by runs of windows, joined up and in order."""
    key = np.zeros(len(lo), np.int64)
    _, a, b = merged(key, lo.astype(np.int64), lo + n + length - 2)
    return a, b + 1


def kept_bytes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    parts, at = [], 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def _whole(ids, data: list[bytes], spans: list) -> pd.DataFrame:
    listed = [[{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())] for a, b in spans]
    return pd.DataFrame({"id": ids, "data": pd.Series(data, dtype=object).array, "spans": pd.Series(listed, dtype=object).array})


def _digests(ids, data: list[bytes], spans: list) -> pd.DataFrame:
    kept = [kept_bytes(d, a, b) for d, (a, b) in zip(data, spans)]
    n = np.array([len(d) for d in data], np.int64)
    return pd.DataFrame({"id": ids, "n_bytes": n, "n_removed": n - [len(k) for k in kept], "n_spans": [len(a) for a, _ in spans], "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept]})


#: Forms of the result: what makes them of ids, bytes and spans, and their columns.
WHOLE = (_whole, "id long, data binary, spans array<struct<start: long, end: long>>")
DIGESTS = (_digests, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup_substrings(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", form: tuple = WHOLE) -> DataFrame:
    """One row per document: (id, data, spans): its UTF-8 bytes, and the byte ranges [start, end) that start earlier elsewhere.

    With ``form`` DIGESTS: (id, n_bytes, n_removed, n_spans, kept_sha256) of the same.

    A byte is covered if a string of ``settings.length`` bytes around it also starts
    earlier: in a smaller id, or further up in the same text; overlaps count, and
    matches never cross texts. A null text is the empty one. Where ids repeat or are
    null, texts stand in the order of (id, nulls first; hash of the text), and rows that
    repeat both are one text, treated alike. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    text_batches(spark)
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    counts = own.agg(F.count("*"), F.count("id")).first()
    repeated = not own.where("id IS NOT NULL").groupBy("id").count().where("count > 1").isEmpty()
    if counts[0] != counts[1] or repeated:
        # ids that grow with the partition, after a sort of the whole: keys in the texts' order
        marked = own.withColumn("t", F.xxhash64("text"))
        keys = scratch.write(marked.select("id", "t").distinct().orderBy(F.asc_nulls_first("id"), "t").select("id", "t", F.monotonically_increasing_id().alias("key")), "keys")
        keyed = scratch.write(marked.alias("a").join(keys.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.t") == F.col("b.t"))).select("a.id", "key", "text"), "keyed")
        texts = keyed.select("key", "text").dropDuplicates(["key"])
    else:
        keyed = own.withColumn("key", F.col("id").cast("long"))
        texts = keyed.select("key", "text")
    gone = repeated_ranges(texts, scratch, settings.length)

    make, schema = form
    length, none = settings.length, (np.empty(0, np.int64), np.empty(0, np.int64))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 512):
                part = pdf.iloc[lo : lo + 512]
                spans = [none if a is None else removed_spans(a, n, length) for a, n in zip(part["gone_lo"], part["gone_n"])]
                yield make(part["id"].array, [t.encode("utf-8", "surrogatepass") for t in part["text"]], spans)

    out = keyed.join(gone, "key", "left").select("id", "text", "gone_lo", "gone_n").mapInPandas(finish, schema)
    return out.withColumnRenamed("id", id_col)
