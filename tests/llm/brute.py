"""Plain versions of the corpus operators, for small inputs."""

import hashlib
import math
from collections import Counter


def components(nodes, linked):
    """Smallest node each reaches."""
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


def substring_digests(docs, length=100):
    """docs: list of (id, text) with distinct ids."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, width):
    w = words(text)
    return [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []


def simhash(text, width=3):
    import xxhash

    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, width)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def jaccard(a, b, width=5):
    x, y = set(shingles(a, width)), set(shingles(b, width))
    return len(x & y) / len(x | y) if x or y else 1.0


def weighted_windows(text, item, width=5):
    """Highest weighted similarity of an item with a window of its size."""
    want = Counter(shingles(item, width))
    have, n = shingles(text, width), sum(want.values())
    best = 0.0
    for i in range(max(1, len(have) - n + 1)):
        c = Counter(have[i : i + n])
        both, either = sum((c & want).values()), sum((c | want).values())
        best = max(best, both / either if either else 0.0)
    return best


def unigram(docs, train):
    """{id: (tokens, known, all training tokens, base score)}"""
    c = Counter()
    for i, t in docs:
        if train(i):
            c.update(words(t) + [None])
    n, v = sum(c.values()), len(c)
    out = {}
    for i, t in docs:
        w = words(t) + [None]
        out[i] = (len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
    return out


def deduped_lines(docs, min_words=50):
    """{id: (lines removed, text)}"""
    seen, gone = set(), {i: set() for i, _ in docs}
    for i, text in sorted(docs):
        if text is None:
            continue
        lines = [(p, x) for p, x in enumerate(text.split("\n")) if x.split()]
        for k in range(len(lines)):
            total = 0
            for j in range(k, len(lines)):
                total += len(lines[j][1].split())
                if total >= min_words:
                    run = tuple(x for _, x in lines[k : j + 1])
                    if run in seen:
                        gone[i].update(range(lines[k][0], lines[j][0] + 1))
                    seen.add(run)
                    break
    return {i: (len(gone[i]), None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i])) for i, t in docs}
