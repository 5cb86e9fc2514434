"""Language-model scoring with Brown class-based n-grams.

Words are grouped into classes by exchange clustering: the most common ones in
full sweeps, every other frequent word by one exchange. A text's probability is
the product of class transitions and of words' emissions from their classes,
beside an add-half unigram base. All counts come from every training document:
word counts, bigrams and the classes around each word are pre-aggregated in each
task and summed by a shuffle. What is sent to workers is bounded by parameters (the
``frequent`` most common words, the class tables); the counts of all other words
are joined.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, release, text_batches

#: Bytes of a text split into words at once, and distinct words a task holds before it hands them on.
BLOCK, HELD = 1 << 22, 400_000
_WHITE = re.compile(rb"[\x20\x09-\x0d]")
#: Stands for the end of a text among the hashes of words.
END_HASH = -1


def word_blocks(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text, A-Z lower-cased, in blocks."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    at = 0
    while at < len(data):
        stop = len(data)
        if stop - at > BLOCK and (m := _WHITE.search(data, at + BLOCK)):
            stop = m.start()
        yield data[at:stop].split()
        at = stop


def word_hash(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def shape(word: bytes, buckets: int) -> int:
    """Bucket of a word by its last three bytes; words outside the clustered vocabulary share their bucket's symbol."""
    return zlib.crc32(word[-3:]) % buckets


@dataclass(frozen=True)
class Settings:
    """``frequent``: words with a code and a class of their own, at most; ``seeds``: the most common ones, which are exchanged in full."""

    frequent: int = 1 << 18
    seeds: int = 1000
    buckets: int = 384
    classes: int = 48
    sweeps: int = 12
    prior: float = 50.0

    @property
    def symbols(self) -> int:
        return self.seeds + self.buckets + 1


def word_counts(train: DataFrame, settings: Settings) -> DataFrame:
    """(h, shape, n) of every word and of the end, over all texts of ``train``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, ends = Counter(), 0

        def out():
            words = list(held)
            return pd.DataFrame({"h": np.fromiter(map(word_hash, words), np.int64, len(words)), "shape": np.fromiter((shape(w, settings.buckets) for w in words), np.int32, len(words)), "n": np.fromiter(held.values(), np.int64, len(words))})

        for pdf in batches:
            for text in pdf["text"]:
                ends += 1
                for words in word_blocks(text):
                    held.update(words)
                    if len(held) > HELD:
                        yield out()
                        held.clear()
        yield out()
        yield pd.DataFrame({"h": [END_HASH], "shape": [-1], "n": [ends]})

    rows = train.select("text").mapInPandas(run, "h long, shape int, n long")
    return rows.groupBy("h").agg(F.max("shape").alias("shape"), F.sum("n").alias("n")).where("n > 0")


def frequent_words(counts: DataFrame, most: int) -> pd.DataFrame:
    """The most common words, ``most`` at most, by falling count.

    Counts are binned by their logarithm, and all words above the bin that would be
    too many are fetched; no sort, and only the bins besides.
    """
    words = counts.where(F.col("h") != END_HASH)
    bins = words.groupBy(F.floor(F.log2("n") * 8).alias("bin")).count().orderBy(F.desc("bin")).collect()
    least, have = None, 0
    for b in bins:
        have += b["count"]
        if have > most:
            break
        least = b["bin"]
    found = fetched(words.where(F.floor(F.log2("n") * 8) >= F.lit(least if least is not None else 1 << 20)).select("h", "shape", "n"))
    return found.sort_values(["n", "h"], ascending=[False, True], ignore_index=True)


def fetched(df: DataFrame) -> pd.DataFrame:
    """A bounded result on the driver, as Arrow throughout: rows as Python objects would take ten times the room."""
    return df.toArrow().to_pandas(split_blocks=True, self_destruct=True)


class Codes:
    """Codes of words: the rank of a frequent word, or ``size`` and more by the bucket of any other."""

    def __init__(self, hashes: np.ndarray, ranks: np.ndarray, settings: Settings):
        self.hashes, self.ranks, self.buckets = hashes, ranks, settings.buckets
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.rare: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """(code of each word, hash of each word that is not frequent)."""
        known, size = self.known, len(self.hashes)
        try:
            codes = [known[w] for w in words]
        except KeyError:
            if len(known) > HELD:
                self.clear()
                known = self.known
            fresh = list({w for w in words if w not in known})
            h = np.fromiter(map(word_hash, fresh), np.int64, len(fresh))
            code = np.full(len(fresh), -1)
            if size:
                at = np.minimum(np.searchsorted(self.hashes, h), size - 1)
                code = np.where(self.hashes[at] == h, self.ranks[at], -1)
            for w, c, x in zip(fresh, code.tolist(), h.tolist()):
                known[w] = c if c >= 0 else size + shape(w, self.buckets)
                if c < 0:
                    self.rare[w] = x
            codes = [known[w] for w in words]
        return np.array(codes, "<i4"), [self.rare[w] for w, c in zip(words, codes) if c >= size]


def encoded(docs: DataFrame, table, settings: Settings) -> DataFrame:
    """``docs`` with ``e`` for ``text``: struct<codes: its words' codes as 32-bit integers, h, t: hashes of words that are not frequent, and how often each stands there>."""

    @F.pandas_udf("codes binary, h array<long>, t array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codes_of = Codes(*table.value, settings)
        for texts in batches:
            out = {"codes": [], "h": [], "t": []}
            for text in texts:
                parts = [codes_of(words) for words in word_blocks(text) if words]
                h, t = np.unique(np.array([x for _, rare in parts for x in rare], np.int64), return_counts=True)
                out["codes"].append(b"".join([c.tobytes() for c, _ in parts]))
                out["h"].append(h)
                out["t"].append(t.astype(np.int32))
            yield pd.DataFrame(out)
        codes_of.clear()
        release()

    return docs.select(*[c for c in docs.columns if c != "text"], encode("text").alias("e"))


def _symbols(codes: list[bytes], of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``of`` each code of some texts in a row, the end (last of ``of``) before, between and behind them; and the codes, ends as len(of) - 1."""
    end = np.array([len(of) - 1])
    row = np.concatenate([x for c in codes for x in (end, np.frombuffer(c, "<i4"))] + [end])
    return of[row], row


def pair_counts(rows: DataFrame, of: np.ndarray, size: int) -> np.ndarray:
    """How often each symbol follows another over all texts, rows (codes), as a matrix; ``of``: symbol of each code and of the end."""
    sent = rows.sparkSession.sparkContext.broadcast(of)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size * size, np.int64)
        for pdf in batches:
            s = _symbols(pdf["codes"].tolist(), sent.value)[0].astype(np.int64)
            total += np.bincount(s[:-1] * size + s[1:], minlength=size * size)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"pair": at.astype(np.int32), "n": total[at]})

    found = fetched(rows.mapInPandas(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    out = np.zeros(size * size)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(size, size)


def assigned(rows: DataFrame, of: np.ndarray, first: int, last: int, pairs: np.ndarray) -> np.ndarray:
    """Class of each code from ``first`` to ``last``: where the class bigrams' likelihood rises most as its word is exchanged.

    A word's mass is small beside a class's, so the rise is taken from the likelihood's
    derivative at ``pairs``, the class bigrams, by the classes that stand before and behind
    the word wherever it occurs. Those counts are summed by word, and each word is
    decided where they meet.
    """
    classes, sent = len(pairs), rows.sparkSession.sparkContext.broadcast(of)
    log, left, right = np.log(pairs + 1), np.log(pairs.sum(1) + classes), np.log(pairs.sum(0) + classes)

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []

        def out() -> pd.DataFrame:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pd.DataFrame({"code": (key // (2 * classes)).astype(np.int32), "slot": (key % (2 * classes)).astype(np.int16), "n": n})

        for pdf in batches:
            c, code = (x.astype(np.int64) for x in _symbols(pdf["codes"].tolist(), sent.value))
            at = np.flatnonzero((code >= first) & (code < last))  # never the first or the last, which are ends
            held += [code[at] * (2 * classes) + c[at + 1], code[at] * (2 * classes) + classes + c[at - 1]]
            if sum(map(len, held)) > 1 << 22:
                yield out()
        if held:
            yield out()
        release()

    @F.pandas_udf("int")
    def best(slots: pd.Series, counts: pd.Series) -> pd.Series:
        x = np.zeros((len(slots), 2 * classes))
        for i, (s, n) in enumerate(zip(slots, counts)):
            x[i, np.asarray(s)] = n
        r, c = x[:, :classes], x[:, classes:]
        gain = r @ log.T + c @ log - r.sum(1, keepdims=True) * left - c.sum(1, keepdims=True) * right
        return pd.Series(gain.argmax(1))

    sums = rows.mapInPandas(around, "code int, slot short, n long").groupBy("code", "slot").agg(F.sum("n").alias("n"))
    by = sums.groupBy("code").agg(F.collect_list(F.struct("slot", "n")).alias("x"))  # at most 2 * classes to a code
    found = fetched(by.select("code", best(F.col("x.slot"), F.col("x.n")).alias("class")))
    out = of[first:last].copy()
    out[found["code"].to_numpy() - first] = found["class"].to_numpy()
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class of each symbol, by exchange clustering on a matrix of symbol bigrams.

    Symbols start dealt out by rank of frequency; each in turn is taken out and put
    in the class where the class bigrams' likelihood is highest, until a sweep moves
    none.
    """
    size = len(pairs)
    weight = pairs.sum(0) + pairs.sum(1)
    order = np.argsort(-weight, kind="stable")
    cls = np.empty(size, np.int64)
    cls[order] = np.arange(size) % classes
    member = np.zeros((size, classes))
    member[np.arange(size), cls] = 1
    to, fro = pairs @ member, pairs.T @ member  # counts of each symbol before and behind each class
    g = member.T @ to
    for _ in range(sweeps):
        moved = 0
        for w in order[weight[order] > 0]:
            a, self_n = cls[w], pairs[w, w]
            r, c = to[w].copy(), fro[w].copy()
            r[a] -= self_n
            c[a] -= self_n  # without the pairs of w with itself
            g[a] -= r
            g[:, a] -= c
            g[a, a] -= self_n
            left, right = g.sum(1) + c, g.sum(0) + r  # what stands before w, and behind it, counts there whatever its class
            down, across = _xlogx(g + r) - _xlogx(g), _xlogx(g + c[:, None]) - _xlogx(g)
            own = np.diag(g)
            gain = down.sum(1) - np.diag(down) + across.sum(0) - np.diag(across) + _xlogx(own + r + c + self_n) - _xlogx(own)
            gain -= _xlogx(left + r.sum() + self_n) - _xlogx(left) + _xlogx(right + c.sum() + self_n) - _xlogx(right)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            g[b] += r
            g[:, b] += c
            g[b, b] += self_n
            if b != a:
                cls[w], moved = b, moved + 1
                to[:, a] -= pairs[:, w]
                to[:, b] += pairs[:, w]
                fro[:, a] -= pairs[w]
                fro[:, b] += pairs[w]
        if not moved:
            break
    return cls


@dataclass
class Model:
    """A word's probability in its class is (its count + 0.5) / the class's mass.

    ``top``: hashes of the frequent words in the order of their codes; ``classes``: class of each code, then
    of each bucket and of the end; ``log_counts``: log10 of the count + 0.5, zero for
    buckets; ``steps``: log10 of P(class | class before); ``mass``: log10 of each class's;
    ``base``: log10 of the unigram's denominator; ``ends``: texts learnt from.
    """

    top: np.ndarray
    classes: np.ndarray
    log_counts: np.ndarray
    steps: np.ndarray
    mass: np.ndarray
    base: float
    total: int
    ends: int

    def sums(self, codes: bytes) -> tuple[int, int, float, float]:
        """(tokens, known ones, base score, score) of a text but for words that are not frequent, whose log10 of count + 0.5 is to be added to both."""
        c, code = _symbols([codes], self.classes)
        log = self.log_counts[code[1:]].sum()
        n, known = len(code) - 1, int((code[1:-1] < len(self.top)).sum()) + (self.ends > 0)
        return n, int(known), log - n * self.base, log + self.steps[c[:-1], c[1:]].sum() - self.mass[c[1:]].sum()


def fit(counts: DataFrame, top: pd.DataFrame, rows: DataFrame, settings: Settings) -> Model:
    """The model of training texts: their words' ``counts``, frequent words ``top`` and encoded ``rows`` (codes).

    The seeds and the buckets of other words are grouped by exchange; every other
    frequent word then goes to the class where the likelihood rises most, and what stands next to
    what is counted anew with the classes of all words.
    """
    size, n = len(top), top["n"].to_numpy()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = counts.where(F.col("h") == END_HASH).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    codes = np.arange(size + settings.buckets + 1)
    bucket = np.concatenate((top["shape"].to_numpy(), np.arange(settings.buckets), [settings.buckets]))
    symbols = np.where(codes < min(size, settings.seeds), codes, settings.seeds + bucket).astype(np.int16)
    pairs = pair_counts(rows, symbols, settings.symbols)
    of_symbol = exchange(pairs, settings.classes, settings.sweeps)
    classes = of_symbol[symbols].astype(np.int16)
    first = min(size, settings.seeds)
    if size > first:
        member = np.eye(settings.classes)[of_symbol]
        classes[first:size] = assigned(rows, classes, first, size, member.T @ pairs @ member)
    g = pair_counts(rows, classes, settings.classes)
    # the mass of each class: its words, and what its buckets hold with one word unseen
    shapes = counts.where("shape >= 0").groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    rest = np.zeros(settings.buckets)
    rest[shapes["shape"]] = shapes["n"] + 0.5 * shapes["v"]
    rest -= np.bincount(top["shape"], n + 0.5, settings.buckets)
    mass = np.bincount(classes, np.concatenate((n + 0.5, rest + 0.5, [ends + 0.5])), settings.classes)
    share = mass / mass.sum()
    steps = (g + settings.prior * share) / (g.sum(1, keepdims=True) + settings.prior)
    log = np.concatenate((np.log10(n + 0.5), np.zeros(settings.buckets), [np.log10(ends + 0.5)]))
    with np.errstate(divide="ignore"):
        return Model(top["h"].to_numpy(), classes, log, np.log10(steps), np.log10(mass), float(np.log10(total + 0.5 * (distinct + 1))), int(total), int(ends))


def learn(docs: DataFrame, scratch: Scratch, settings: Settings) -> tuple[Model, DataFrame, DataFrame]:
    """(model, counts of words, docs with codes for text); docs has train and text."""
    counts = scratch.write(word_counts(docs.where("train").select("text"), settings), "counts")
    top = frequent_words(counts, settings.frequent)
    order = np.argsort(top["h"].to_numpy())
    table = docs.sparkSession.sparkContext.broadcast((top["h"].to_numpy()[order], order))
    rows = scratch.write(encoded(docs, table, settings), "encoded")
    return fit(counts, top, rows.where("train").select("e.codes"), settings), counts, rows


def score(docs: DataFrame, train: F.Column, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), keep: dict[str, F.Column] | None = None) -> DataFrame:
    """One row per document: (id, *keep, n_tokens, n_known, train_tokens, base_score, score).

    ``train`` marks the rows to learn from (null: no). A text's tokens are its words
    and one end. ``base_score`` is the add-half unigram log10 probability; ``score`` that
    of the class model: the classes' transitions and each word's add-half share in its
    class. Words that are not frequent have the class of the bucket of their last bytes.
    Null and empty texts are one end. Repeated rows are scored and counted as often as
    they stand there; a null id is carried along. Without training rows all counts are
    zero. Words are told apart by 64-bit hashes. Texts are split into words twice: to
    count them, and to write them as codes, which all that follows reads.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    text_batches(spark)
    name = lambda c: F.col(f"`{c}`")
    keep = keep or {}
    # keys from the rows' places in the input; written, so they stay
    own = docs.select(F.monotonically_increasing_id().alias("key"), F.coalesce(train, F.lit(False)).alias("train"), name(text_col).alias("text"), F.struct(name(id_col).alias("id"), *[c.alias(k) for k, c in keep.items()]).alias("doc"))
    model, counts, rows = learn(own, scratch, settings)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("n long, known long, base double, score double")
    def sums(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for codes in batches:
            yield pd.DataFrame([sent.value.sums(c) for c in codes], columns=["n", "known", "base", "score"])

    scored = rows.select("key", "doc", sums("e.codes").alias("s"))
    rare = rows.select("key", F.explode(F.arrays_zip("e.h", "e.t")).alias("x")).select("key", F.col("x.h").alias("h"), F.col("x.t").alias("t"))
    log = F.col("t") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + 0.5)
    more = rare.join(counts.select("h", "n"), "h", "left").groupBy("key").agg(F.sum(log).alias("log"), F.sum(F.when(F.col("n") > 0, F.col("t")).otherwise(0)).alias("more"))
    out, plus = scored.join(more, "key", "left"), lambda c, m: F.col(c) + F.coalesce(F.col(m), F.lit(0))
    return out.select(F.col("doc.id").alias(id_col), *[F.col(f"doc.{k}") for k in keep], F.col("s.n").alias("n_tokens"), plus("s.known", "more").alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"), plus("s.base", "log").alias("base_score"), plus("s.score", "log").alias("score"))
