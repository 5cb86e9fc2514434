"""Embedding near-dedup by collision counting on one-dimensional projections.

Equal vectors are one. Each distinct unit vector goes, in each of some tables, to
the cell that the signs of a few random projections name; within a cell, many
one-dimensional projections are sorted, each vector opens a window around its own
value in each of them, and a pair's collisions are the windows that hold it. Pairs
with the calibrated count of collisions are verified by cosine in double precision.
The numbers of tables and of collisions follow from the recall that is asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, components


@dataclass(frozen=True)
class Settings:
    """``miss``: chance to miss a pair at the very threshold, by its cells and again by its count."""

    cosine: float = 0.95
    miss: float = 1e-3
    projections: int = 16
    window: float = 0.5
    cell: int = 256
    block: int = 512
    seed: int = 20240229

    def signs(self, vectors: int) -> int:
        """Signs that name a cell, so that cells stay about as large whatever the corpus."""
        return max(1, math.ceil(math.log2(max(2, vectors / self.cell))))

    def tables(self, signs: int) -> int:
        same = (1 - math.acos(self.cosine) / math.pi) ** signs
        return max(1, math.ceil(math.log(self.miss) / math.log(1 - same)))

    def collisions(self) -> int:
        """The highest count that a pair at the threshold reaches but for the chance ``miss``."""
        p = math.erf(self.window / (2 * math.sqrt(1 - self.cosine)))  # the values differ by N(0, 2 - 2 cosine)
        n, below = self.projections, 0.0
        for k in range(n + 1):
            below += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            if below > self.miss:
                return k
        return n


def directions(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision, by their largest entry first so that none overflows."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cell_codes(units: np.ndarray, tables: int, signs: int, seed: int) -> np.ndarray:
    """Each vector's cell in each table."""
    bits = units @ directions(units.shape[1], tables * signs, seed) > 0
    return bits.reshape(len(units), tables, signs) @ (np.int64(1) << np.arange(signs, dtype=np.int64))


def colliding(a: np.ndarray, b: np.ndarray, window: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) within ``window`` of each other in at least ``least`` of the columns.

    Each column of b is sorted; a row of a opens its window there by binary search.
    """
    counts = np.zeros(len(a) * len(b), np.uint8)
    for j in range(a.shape[1]):
        order = np.argsort(b[:, j], kind="stable")
        x = b[order, j]
        lo, hi = np.searchsorted(x, a[:, j] - window), np.searchsorted(x, a[:, j] + window, side="right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        counts[np.repeat(np.arange(len(a)) * len(b), n) + order[at]] += 1  # a pair is once in a column
    hit = np.flatnonzero(counts >= least)
    return hit // len(b), hit % len(b)


def cell_links(units: np.ndarray, codes: np.ndarray, side: np.ndarray, table: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of a cell that no earlier table's cell holds.

    ``side``: 0 or 1 for a block of a cell that was dealt out, whose two sides are to be
    paired with each other; -1 for all with all. Rows that shared a cell in the first
    table are parted beforehand, so a dense group is gone through once.
    """
    values = units @ directions(units.shape[1], settings.projections, settings.seed + 1)
    least, found = settings.collisions(), []

    def compare(p: np.ndarray, q: np.ndarray, same: bool) -> None:
        for lo in range(0, len(p), 256):
            a = p[lo : lo + 256]
            b = q[lo:] if same else q
            i, j = colliding(values[a], values[b], settings.window, least)
            if same:
                i, j = i[i < j], j[i < j]
            i, j = a[i], b[j]
            near = np.einsum("ij,ij->i", units[i], units[j]) >= settings.cosine
            i, j = i[near], j[near]
            fresh = ~(codes[i, :table] == codes[j, :table]).any(axis=1)
            found.append((i[fresh], j[fresh]))

    def all_pairs(members: np.ndarray) -> None:
        if side[0] < 0:
            compare(members, members, True)
        else:
            compare(members[side[members] == 0], members[side[members] == 1], False)

    rest = np.arange(len(units))
    if table:
        kinds, inverse, sizes = np.unique(codes[:, 0], return_inverse=True, return_counts=True)
        for big in np.flatnonzero(sizes >= 128):
            own, other = rest[inverse[rest] == big], rest[inverse[rest] != big]
            if side[0] < 0:
                compare(own, other, False)
            else:
                compare(own[side[own] == 0], other[side[other] == 1], False)
                compare(own[side[own] == 1], other[side[other] == 0], False)
            rest = other
    all_pairs(rest)
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (zip(*found) if found else ([], [])))


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that each row reaches."""
    low = np.arange(n)
    while len(i):
        m = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == low).all():
            break
        low = new
    return low


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept).

    Vectors link at a cosine of at least ``settings.cosine`` in double precision.
    ``n_links`` counts the other rows linked, equal copies among them; ``component_id``
    is the smallest id reachable, itself included; ``kept`` says whether that is the
    row's own. A vector that is null, empty, all zero or holds a null or a non-finite
    entry links with nothing, not even a copy; vectors of different lengths never
    link. A null id takes part and is never the smallest. Only the two columns are
    read; an empty table gives an empty result.

    Cells over ``settings.block`` vectors are dealt into blocks, and each pair of
    blocks is a task's work of bounded size. A pair is counted in the first table
    whose cell it shares, so links need no further exchange; what leaves a task is a
    row for each vector at most: its number of links, and its smallest partner.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    given = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    single = dict(given.dtypes)["v"] == "array<float>"
    own = given.select("id", F.when(sound, F.xxhash64("v")).alias("k"), "v")
    distinct = scratch.write(own.where("k IS NOT NULL").groupBy("k").agg(F.first("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("low")), "distinct")
    total = distinct.count()
    signs = settings.signs(total)
    tables = settings.tables(signs)

    def by_dim(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        for _, part in pdf.groupby(pdf["v"].map(len), sort=False):
            x = np.stack(part["v"].to_numpy()).astype(np.float32 if single else np.float64)
            yield part, x

    def cells(batches: Iterator[pd.DataFrame], whole: bool) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 2048):
                for part, x in by_dim(pdf.iloc[lo : lo + 2048]):
                    codes = cell_codes(unit(x), tables, signs, settings.seed)
                    out = {"dim": np.full(codes.size, x.shape[1]), "t": np.tile(np.arange(tables), len(x)), "cell": codes.ravel()}
                    if whole:
                        raw = np.array([r.tobytes() for r in x], object)
                        out |= {"k": np.repeat(part["k"].to_numpy(), tables), "n": np.repeat(part["n"].to_numpy(), tables), "v": np.repeat(raw, tables)}
                    yield pd.DataFrame(out)

    sizes = distinct.mapInPandas(lambda b: cells(b, False), "dim int, t int, cell long").groupBy("dim", "t", "cell").count()
    hot = scratch.write(sizes.where(F.col("count") > settings.block).select("dim", "t", "cell", F.ceil(F.col("count") / settings.block).cast("int").alias("blocks")), "hot")
    rows = distinct.select("k", "n", "v").mapInPandas(lambda b: cells(b, True), "dim int, t int, cell long, k long, n long, v binary").join(hot, ["dim", "t", "cell"], "left")
    own_block = F.pmod(F.xxhash64("k", F.lit(7)), F.col("blocks")).cast("int")
    meets = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.withColumn("own", F.coalesce(own_block, F.lit(0))).withColumn("other", F.explode(meets))
    dealt = dealt.select("dim", "t", "cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "k", "n", "v", (F.col("own") > F.col("other")).cast("int").alias("side"))

    def pairs(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dim, table, _, lo, hi = (int(x) for x in key)
        pdf = pdf.sort_values("k", ignore_index=True)
        x = unit(np.frombuffer(b"".join(pdf["v"]), np.float32 if single else np.float64).reshape(len(pdf), dim))
        k, n = pdf["k"].to_numpy(), pdf["n"].to_numpy()
        codes = cell_codes(x, tables, signs, settings.seed)
        side = pdf["side"].to_numpy() if lo != hi else np.full(len(pdf), -1)
        i, j = cell_links(x, codes, side, table, settings)
        links = np.bincount(i, n[j], len(k)) + np.bincount(j, n[i], len(k))
        low = local_components(len(k), i, j)
        some = links > 0
        return pd.DataFrame({"k": k[some], "links": links[some].astype(np.int64), "low": k[low[some]]})

    found = scratch.write(dealt.groupBy("dim", "t", "cell", "lo", "hi").applyInPandas(pairs, "k long, links long, low long"), "found")
    links = found.groupBy("k").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("k").alias("src"), F.col("low").alias("dst")), scratch)
    named = distinct.select("k", "n", "low").join(links, "k", "left").join(comps.withColumnRenamed("node", "k"), "k", "left").withColumn("component", F.coalesce("component", "k"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = named.join(lows, "component").select("k", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    # rows without a sound vector get a key each, so that they do not meet in one task
    keyed = own.select("id", F.col("k").isNotNull().alias("sound"), F.coalesce("k", F.xxhash64("id")).alias("k"))
    out = keyed.join(classes, "k", "left")
    links_of = F.when(F.col("sound"), F.col("n_links")).otherwise(F.lit(0))
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce(links_of, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
