"""SimHash near-duplicate detection by pigeonhole blocks.

``near_duplicates`` links 64-bit fingerprints that differ in a few bits: blocks
that any such pair must share are joined, and distances verified. ``similar`` asks
for texts of a given similarity instead. At similarity 0.8 a seventh of the bits
differ, so no 64-bit fingerprint can be split into selective blocks that such a
pair must share; it takes fingerprints of many more bits, cut into so many blocks
that a pair shares one but for a stated chance, and verifies pairs by the distance
over all bits and then by their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, components, release, text_batches

#: Members of a block up to which its pairs are compared one by one.
PAIRS_UP_TO = 32


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, as an unsigned integer.

    A-Z are lower-cased; words are runs without ASCII white space; shingles are
    ``width`` consecutive words joined by one space, repeats included. Fewer words
    give one shingle of them all; none (also null) give zero. A bit is 1 if it is
    set in over half of the shingles' XXH64 values.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    one, n, ones = xxhash.xxh64_intdigest, len(words) - width + 1, np.zeros(64, np.int64)
    starts, ends = starts[:n].tolist(), ends[width - 1 :].tolist()
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        h = np.fromiter((one(line[s:e], seed) for s, e in zip(starts[i : i + (1 << 16)], ends[i : i + (1 << 16)])), np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, text_col: str = "text", width: int = 3, seed: int = 42, name: str = "fp") -> DataFrame:
    """``docs`` without its text, with a signed 64-bit column ``name`` for the SimHash."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width, seed) for t in texts], np.uint64).view(np.int64))

    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, name)]
    return docs.select(*rest, simhash(F.col(f"`{text_col}`")).alias(name))


def _block_keys(radius: int, extra: int):
    """Which of radius + extra equal blocks must agree: any ``extra`` of them."""
    n = radius + extra
    edges = [round(64 * i / n) for i in range(n + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [(i, signed(sum(masks[j] for j in which)), [b for j in range(n) if j not in which for b in range(edges[j], edges[j + 1])]) for i, which in enumerate(combinations(range(n), extra))]


def links(values: DataFrame, scratch: Scratch, radius: int = 2, extra: int = 2, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """Edges (src, dst) whose components are those of "differs in at most ``radius`` bits".

    ``values`` has one distinct fingerprint per row in column ``fp``. The 64 bits
    are cut into radius + extra blocks; two values within the radius agree on
    ``extra`` whole blocks at least, so they meet under one of the block keys,
    where their distance is verified. A block with more than ``pairs_up_to``
    members is not compared pair by pair: for radius 2 each member is joined to the
    values one free bit away, and two members are within two bits exactly if they
    share such a point. That stays linear in the block, and loses no link; the
    points then are further nodes of the graph.
    """
    keys = _block_keys(radius, extra)
    rows = scratch.write(values.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m, _ in keys])).alias("b")).select("fp", "b.k", "b.v"), "rows")
    sizes = scratch.write(rows.groupBy("k", "v").count().where("count > 1"), "sizes")
    few = rows.join(sizes.where(F.col("count") <= pairs_up_to).select("k", "v"), ["k", "v"])
    left, right = few.withColumnRenamed("fp", "src"), few.withColumnRenamed("fp", "dst")
    near = left.join(right, ["k", "v"]).where((F.col("src") < F.col("dst")) & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= radius)).select("src", "dst")
    if sizes.where(F.col("count") > pairs_up_to).isEmpty():
        return near
    if radius != 2:
        raise ValueError("blocks of many values are handled for a radius of 2")
    many = rows.join(sizes.where(F.col("count") > pairs_up_to).select("k", "v"), ["k", "v"])
    one = lambda b: F.lit(1 << b if b < 63 else -(1 << 63))
    around = F.coalesce(*[F.when(F.col("k") == i, F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(one(b)) for b in free])) for i, _, free in keys])
    points = scratch.write(many.select("k", "v", "fp", F.explode(around).alias("p")), "points")
    shared = points.groupBy("k", "v", "p").count().where("count > 1").select("k", "v", "p")
    return near.union(points.join(shared, ["k", "v", "p"]).where("fp != p").select(F.col("fp").alias("src"), F.col("p").alias("dst")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """One row per document: (id, fp, component_id), component_id the smallest id reachable.

    Equal fingerprints are one node, so copies are never paired. Rows with a null
    id take part; a component of such rows only has a null id. Repeated rows come
    back repeated. An empty table gives an empty result. Only the id and text
    columns are read, so no further column can clash.
    """
    scratch = Scratch(docs.sparkSession)
    own = scratch.write(fingerprints(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), width=width, seed=seed), "prints")
    values = scratch.write(own.groupBy("fp").agg(F.min("id").alias("low")), "values")
    comps = components(links(values.select("fp"), scratch, radius), scratch)
    named = values.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = named.join(lows, "component").select("fp", "component_id")
    return own.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


@dataclass(frozen=True)
class Plan:
    """How many bits a wide fingerprint has, how they are cut, and how far apart similar texts may lie.

    ``miss``: chance that a pair at the very similarity shares no block, the same at every
    size of corpus. ``slack``: standard deviations above the distance of such a pair,
    beyond which a pair is taken not to be similar (one in 4,300); all others are
    compared by their texts. ``spare``: a block's value is shared by about 2 ** spare
    texts by mere chance, whose first bits tell them apart at once.
    """

    documents: int
    similarity: float = 0.8
    miss: float = 1e-3
    slack: float = 3.5
    spare: int = 2
    least_bits: int = 1024

    @property
    def differ(self) -> float:
        """Share of bits in which a pair at the similarity differs: its angle, by the cosine of equally large shingle sets; others' is less."""
        return math.acos(2 * self.similarity / (1 + self.similarity)) / math.pi

    @property
    def block(self) -> int:
        return min(40, max(8, math.ceil(math.log2(max(2, self.documents))) - self.spare))

    @property
    def blocks(self) -> int:
        return math.ceil(math.log(self.miss) / math.log1p(-((1 - self.differ) ** self.block)))

    @property
    def words(self) -> int:
        return -(-max(self.least_bits, self.blocks * self.block) // 64)

    def radius(self, words: int) -> int:
        """Most bits that differ in the first ``words`` 64-bit words of two texts that may be similar."""
        bits = 64 * words
        return int(bits * self.differ + self.slack * math.sqrt(bits * self.differ * (1 - self.differ)))


def wide_fingerprint(words: list[bytes], width: int, n: int) -> tuple[np.ndarray, int]:
    """``n`` 64-bit SimHashes of a text's set of shingles as one row of unsigned integers, and the number of its shingles.

    One XXH64 a shingle is stirred into the hashes; more of them begin with the same.
    """
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(words) - width + 1)
    starts, ends = starts[:count].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    one, ones, stir = xxhash.xxh64_intdigest, np.zeros(64 * n, np.int64), _stirs(n)
    distinct = np.unique(np.fromiter((one(line[s:e]) for s, e in zip(starts, ends)), np.uint64, count))
    count = len(distinct)
    for i in range(0, count, 2048):
        x = distinct[i : i + 2048, None] * stir
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        bits = np.unpackbits(x.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        for j in range(0, len(bits), 255):  # 255 rows fit a byte
            ones += np.add.reduce(bits[j : j + 255], axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > count, bitorder="little").view("<u8"), count


def _stirs(n: int) -> np.ndarray:
    return np.random.default_rng(20231101).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _block_values(prints: np.ndarray, plan: Plan) -> np.ndarray:
    """Number and value of each block of wide fingerprints in one, a row each."""
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(len(prints), -1), axis=1, bitorder="little")[:, : plan.blocks * plan.block]
    values = bits.reshape(len(prints), plan.blocks, plan.block) @ (np.int64(1) << np.arange(plan.block, dtype=np.int64))
    return values | np.arange(plan.blocks) << plan.block


def _all_bits(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda m, x: m + x)


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, pairs_up_to: int = 16, side: int = 512) -> DataFrame:
    """One row per document: (id, h, t, component, component_id), component_id the smallest id reachable over similar texts.

    Similarity is the Jaccard index of the sets of ``width``-word shingles. Wide
    fingerprints of those sets find the pairs, which ``Plan`` misses with a stated
    chance; a link is a pair whose texts were compared, and pairs that links join
    already are not compared. ``h`` is a hash of the text's words; texts of the same
    words, also those without any, are one node. ``component`` is the smallest node
    reachable, ``t`` Spark's hash of the text as it stands. Rows with a null id take part;
    repeated rows come back repeated; an empty table gives an empty result. Only the
    id and text columns are read.

    Blocks shared by more than ``pairs_up_to`` texts are not paired off. Each text is
    compared with its block's leader, the member that is in most such blocks: of a
    group of copies the one nearest to all, so it leads in most of the group's
    blocks and the group is joined by one link a text. What then still lies in
    another component than others of its block is compared with those others, in
    pieces of ``side`` texts, by fingerprints of ``STRAY_WORDS`` words; of a pair within
    a component nothing is left to find, so no link is lost.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    text_batches(spark)
    plan = Plan(docs.count(), similarity)
    text = F.col(f"`{text_col}`")

    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hashes, rows, sizes = [], [], []
            for words in map(split_words, pdf["text"]):
                hashes.append(_words_hash(words))
                fp, m = wide_fingerprint(words, width, plan.words) if words else (None, 0)
                rows.append(fp.view(np.int64) if words else None)
                sizes.append(m)
            yield pd.DataFrame({"id": pdf["id"].array, "t": pdf["t"].array, "h": hashes, "m": sizes, "fp": rows})
        release()

    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))
    printed = scratch.write(given.mapInPandas(prints, "id long, t long, h long, m long, fp array<long>"), "prints")
    nodes = scratch.write(printed.groupBy("h").agg(F.min("id").alias("low"), F.min("t").alias("t"), F.first("m").alias("m"), F.first("fp").alias("fp")), "nodes")
    own = scratch.write(printed.select("id", "h", "t"), "own")
    scratch.drop(printed)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 256):
                part = pdf.iloc[lo : lo + 256]
                x = np.stack(part["fp"].to_numpy())
                yield pd.DataFrame({"b": _block_values(x.view(np.uint64), plan).ravel()} | {k: np.repeat(v, plan.blocks) for k, v in (("h", part["h"].to_numpy()), ("c", x[:, 0]), ("m", part["m"].to_numpy()))})
        release()

    rows = scratch.write(nodes.where("fp IS NOT NULL").select("h", "m", "fp").mapInPandas(blocks, "b long, h long, c long, m int"), "blocks")
    sizes = scratch.write(rows.groupBy("b").agg(F.count("*").alias("n")).where("n > 1"), "sizes")

    def pairs(left: DataFrame, right: DataFrame, names: tuple[str, str], more: Column) -> DataFrame:
        """Distinct pairs of rows of either side that share a block, are of similar size and close in their first bits."""
        (a, b), (c0, c1, m0, m1) = names, (F.col(x) for x in ("c0", "c1", "m0", "m1"))
        met = left.select("b", F.col("h").alias(a), F.col("c").alias("c0"), F.col("m").alias("m0")).join(right.select("b", F.col("h").alias(b), F.col("c").alias("c1"), F.col("m").alias("m1")), "b")
        return met.where(more & (F.bit_count(c0.bitwiseXOR(c1)) <= plan.radius(1)) & (F.least(m0, m1) >= similarity * F.greatest(m0, m1))).select(a, b).distinct()

    def measured(found: DataFrame, names: tuple[str, str], name: str) -> DataFrame:
        """Pairs that may be similar, with the distance of their fingerprints."""
        a, b = names
        fp = nodes.select("h", "fp")
        both = found.join(fp.select(F.col("h").alias(a), F.col("fp").alias("f0")), a).join(fp.select(F.col("h").alias(b), F.col("fp").alias("f1")), b)
        return scratch.write(both.select(a, b, _all_bits("f0", "f1").alias("apart")).where(F.col("apart") <= plan.radius(plan.words)), name)

    def labelled(df: DataFrame, comps: DataFrame, node: str, name: str) -> DataFrame:
        return df.join(comps.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))

    def settled(found: DataFrame, comps: DataFrame | None) -> DataFrame:
        """Components of ``comps`` and of all links among ``found`` that join different ones, each link verified by its texts."""
        left = found if comps is None else labelled(labelled(found, comps, "src", "c0"), comps, "dst", "c1").where("c0 <> c1")
        left = scratch.write(left.select("src", "dst"), "open")
        if left.isEmpty():
            return comps if comps is not None else components(left, scratch)
        need = nodes.select("h", "t").join(left.select(F.col("src").alias("h")).union(left.select("dst")).distinct(), "h", "left_semi")
        texts = scratch.write(given.select("t", "text").join(need, "t").groupBy("h").agg(F.first("text").alias("text")), "texts")
        edges = _similar_pairs(texts, left, width, similarity)
        out = components(edges if comps is None else edges.unionByName(comps.select(F.col("node").alias("src"), F.col("component").alias("dst"))), scratch)
        scratch.drop(left, texts)
        return out

    few = rows.join(sizes.where(F.col("n") <= pairs_up_to).select("b"), "b")
    found = measured(pairs(few, few, ("src", "dst"), F.col("src") < F.col("dst")), ("src", "dst"), "pairs")
    hot, comps, many = sizes.where(F.col("n") > pairs_up_to), None, None
    if not hot.isEmpty():
        many = scratch.write(rows.join(hot, "b"), "hot")
        scratch.drop(rows, sizes)
        central = many.groupBy("h").agg(F.sum(F.log2("n")).alias("w"))
        leaders = many.join(central, "h").groupBy("b").agg(F.max_by(F.struct("h", "c", "m"), F.struct("w", F.xxhash64("h"))).alias("x")).select("b", "x.h", "x.c", "x.m")
        led = measured(pairs(many, leaders, ("own", "leader"), F.col("own") != F.col("leader")), ("own", "leader"), "led")
        nearest = led.groupBy("own").agg(F.min(F.struct("apart", "leader")).alias("x")).select(F.col("own").alias("src"), F.col("x.leader").alias("dst"))
        comps = settled(nearest, None)
        found = found.unionByName(led.select(F.col("own").alias("src"), F.col("leader").alias("dst"), "apart"))
    comps = settled(found, comps)
    if many is not None:
        mixed = labelled(many.select("b", "h"), comps, "h", "comp")
        mixed = scratch.write(mixed.join(mixed.groupBy("b").agg(F.count("*").alias("n"), F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("b", "n"), "b"), "mixed")
        scratch.drop(many, led)
        if not mixed.isEmpty():
            comps = settled(_strays(mixed, nodes, given, scratch, plan, width, side), comps)
        scratch.drop(mixed)
    classed = nodes.select("h", "low").join(comps.withColumnRenamed("node", "h"), "h", "left").withColumn("component", F.coalesce("component", "h"))
    lows = classed.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = scratch.write(classed.join(lows, "component").select("h", "component", "component_id"), "classes")
    scratch.drop(nodes, found, comps, *([rows, sizes] if many is None else []))
    return own.join(classes, "h").select(F.col("id").alias(id_col), "h", "t", "component", "component_id")


#: 64-bit words of the fingerprints by which the rest of large blocks is compared.
STRAY_WORDS = 64


def _strays(mixed: DataFrame, nodes: DataFrame, given: DataFrame, scratch: Scratch, plan: Plan, width: int, side: int) -> DataFrame:
    """(src, dst) of one block and different components that may be similar; ``mixed``: (b, h, comp, n), n the block's rows.

    A block is dealt into pieces of about ``side`` rows, and each pair of pieces is compared by itself.
    """
    need = nodes.select("h", "t").join(mixed.select("h").distinct(), "h", "left_semi")
    texts = given.select("t", "text").join(need, "t").groupBy("h").agg(F.first("text").alias("text"))

    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [wide_fingerprint(split_words(x), width, STRAY_WORDS) for x in pdf["text"]]
            yield pd.DataFrame({"h": pdf["h"].array, "m": [m for _, m in found], "fp": [fp.tobytes() for fp, _ in found]})
        release()

    wide = scratch.write(texts.mapInPandas(prints, "h long, m long, fp binary"), "wide")
    pieces = F.ceil(F.col("n") / side).cast("int")
    dealt = mixed.withColumn("own", F.pmod(F.xxhash64("h", F.lit(7)), pieces).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), pieces - 1)))
    dealt = dealt.select("b", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).alias("right"), "h", "comp")
    dealt = dealt.join(wide, "h").repartition("b", "lo", "hi").sortWithinPartitions("b", "lo", "hi")
    most, similarity = plan.radius(STRAY_WORDS), plan.similarity

    def compare(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        h, comp, m = (part[c].to_numpy() for c in ("h", "comp", "m"))
        if len(h) < 2 or (comp == comp[0]).all():
            return h[:0], h[:0]
        fp = np.frombuffer(b"".join(part["fp"]), "<u8").reshape(len(h), -1)
        right = part["right"].to_numpy()
        split = part["lo"].iloc[0] != part["hi"].iloc[0]
        src, dst = [h[:0]], [h[:0]]
        for i in np.flatnonzero(~right) if split else range(len(h) - 1):
            at = np.flatnonzero(right) if split else np.arange(i + 1, len(h))
            at = at[(comp[at] != comp[i]) & (np.minimum(m[at], m[i]) >= similarity * np.maximum(m[at], m[i]))]
            first = fp[at, :8] ^ fp[i, :8]  # an eighth of the bits tells most apart
            at = at[np.bitwise_count(first).sum(axis=1, dtype=np.int64) <= plan.radius(8)]
            at = at[np.bitwise_count(fp[at] ^ fp[i]).sum(axis=1, dtype=np.int64) <= most]
            src.append(np.full(len(at), h[i]))
            dst.append(h[at])
        src, dst = np.concatenate(src), np.concatenate(dst)
        return np.minimum(src, dst), np.maximum(src, dst)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, ("b", "lo", "hi"), 1 << 13):
            found = [compare(part) for _, part in pdf.groupby(["b", "lo", "hi"], sort=False)]
            src, dst = (np.concatenate(x) for x in zip(*found))
            yield pd.DataFrame({"src": src, "dst": dst}).drop_duplicates()
        release()

    found = scratch.write(dealt.mapInPandas(run, "src long, dst long").distinct(), "strays")
    scratch.drop(wide)
    return found


def whole_groups(batches: Iterator[pd.DataFrame], keys: tuple[str, ...], rows: int) -> Iterator[pd.DataFrame]:
    """Rows in order of ``keys`` gathered to about ``rows`` rows, each group of equal keys in one."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n < rows:
            continue
        x = pd.concat(held, ignore_index=True)
        last = np.logical_and.reduce([x[k].to_numpy() == x[k].iloc[-1] for k in keys])
        stop = int(np.argmax(last))
        if stop:
            yield x.iloc[:stop]
        held, n = [x.iloc[stop:]], len(x) - stop
    if n:
        yield pd.concat(held, ignore_index=True)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _words_hash(words: list[bytes]) -> int:
    h = xxhash.xxh64_intdigest(b" ".join(words))
    return h - (1 << 64) if h >> 63 else h


def jaccard(a: list[bytes], b: list[bytes], width: int) -> float:
    """Share of the shingles of either text that both have; a text of fewer words is one shingle, none of none is equal to none."""
    x, y = ({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set() for w in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


def _similar_pairs(texts: DataFrame, pairs: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of (src, dst) whose texts, rows (h, text), are similar."""

    def similar_ones(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.loc[[jaccard(split_words(a), split_words(b), width) >= similarity for a, b in zip(pdf["a"], pdf["b"])], ["src", "dst"]]

    both = pairs.join(texts.select(F.col("h").alias("src"), F.col("text").alias("a")), "src").join(texts.select(F.col("h").alias("dst"), F.col("text").alias("b")), "dst")
    return both.mapInPandas(similar_ones, "src long, dst long")
