"""Line dedup: later copies of repeated line runs are deleted, with DataFrame functions only.

The documents' lines are sequences of line ids, and their suffixes are sorted by
prefix doubling: places for the suffixes by one line, then, from places by 2 ** k lines,
places by twice as many from the sorted distinct pairs (place here, place 2 ** k lines on).
Suffixes that are told apart keep their places in the suffix array and are not sorted again.
Neighbours there get the number of lines they have in common from the levels of the
sort: the LCP array. Only common prefixes of ``min_words`` words count, so a suffix lies in
the LCP interval of its first n lines that hold so many, which begins at the last place,
its own or before, where the LCP is less than n. The earliest suffix of an interval is the
first copy, all others are later ones, and overlapping runs of one text join up to
maximal runs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Scratch

#: Two independent 64-bit names, so that equal names mean equal lines at any realistic size.
_SALTS = (0, 0x5BD1E995)


def _named(line: Column, index: Column) -> Column:
    names = [F.xxhash64(line, F.lit(s)).alias(f"h{i}") for i, s in enumerate(_SALTS)]
    return F.struct(index.alias("p"), *names, F.regexp_count(line, F.lit(r"\S+")).alias("w"))


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """(key, i, p0, p1, n, h0, h1): lines with words of ``docs``, rows (key, text).

    i: number among the text's lines with words; p0: place among all; n: lines from here
    on that first hold ``min_words`` words (0: the text ends before), p1: place of the last.
    """
    levels = max(1, (min_words - 1).bit_length())  # each line has a word at least
    df = docs.select("key", F.filter(F.transform(F.split("text", "\n", -1), _named), lambda x: x["w"] > 0).alias("ls"))
    df = df.withColumn("w0", F.transform("ls", lambda x: x["w"]))
    for k in range(levels - 1):
        df = df.withColumn(f"w{k + 1}", F.transform(f"w{k}", lambda x, i: x + F.coalesce(F.get(F.col(f"w{k}"), i + F.lit(1 << k)), F.lit(0))))
    # from the longest stretches down, take what leaves the run short of its words; one more line then fills it
    df = df.withColumn("st", F.transform("ls", lambda x: F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"))))
    for k in reversed(range(levels)):

        def take(x: Column, i: Column) -> Column:
            w = x["w"] + F.get(F.col(f"w{k}"), i + x["n"])
            return F.when(w < min_words, F.struct((x["n"] + F.lit(1 << k)).alias("n"), w.alias("w"))).otherwise(x)

        df = df.withColumn("st", F.transform("st", take))

    def row(x: Column, i: Column) -> Column:
        first, last = F.get(F.col("ls"), i), F.get(F.col("ls"), i + x["n"])
        n = F.when(x["w"] + last["w"] >= min_words, x["n"] + 1).otherwise(0)
        return F.struct(i.alias("i"), first["p"].alias("p0"), F.coalesce(last["p"], first["p"]).alias("p1"), n.alias("n"), first["h0"].alias("h0"), first["h1"].alias("h1"))

    return df.select("key", F.explode(F.transform("st", row)).alias("r")).select("key", "r.*")


def _part() -> Column:
    return F.shiftright("at", 33).cast("int")


def _in_order(df: DataFrame, by: list[str], scratch: Scratch) -> DataFrame:
    """``df`` as a table sorted by ``by``; ``at`` numbers its rows in that order, from bit 33 on by the part of the sort."""
    return scratch.write(df.orderBy(*by).withColumn("at", F.monotonically_increasing_id()), "ordered")


def _before(ordered: DataFrame, total: Column, both: Callable[[int, int], int]) -> Column:
    """``total`` over all parts of the sort before a row's own; the driver gets one number from each part."""
    totals, carry = dict(ordered.groupBy(_part().alias("part")).agg(total).collect()), [0]
    for part in range(max(totals, default=0)):
        carry.append(both(carry[-1], totals.get(part) or 0))
    return F.get(F.array(*[F.lit(x).cast("long") for x in carry]), _part())


def _placed(rows: DataFrame, by: list[str], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Groups of ``rows`` that agree in ``by``, with the place ``r`` in the suffix array where each begins; and ``rows`` with it.

    ``by`` is a line's names at first. Later it is (before, s), and a group that begins at ``before`` is
    sorted by s within the places it has, so places of suffixes sorted earlier stay as they are.
    """
    first = "before" not in by
    some = [] if first else [F.min(F.struct("key", "i")).alias("one")]
    ordered = _in_order(rows.groupBy(*by).agg(F.count("*").alias("c"), *some), by, scratch)
    upto = Window.partitionBy(_part()).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("c").over(upto), F.lit(0)) + _before(ordered, F.sum("c"), int.__add__)
    groups = ordered.withColumn("r", at).drop("at")
    if not first:
        begins = groups.groupBy("before").agg(F.min("r").alias("r0"))
        groups = groups.join(begins, "before").withColumn("r", F.col("before") + F.col("r") - F.col("r0")).drop("r0")
    groups = scratch.write(groups, "groups")
    scratch.drop(ordered)
    named = groups.select(*[F.col(c).alias(f"by_{c}") for c in by], "c", "r")
    out = rows.join(named, [F.col(c) == F.col(f"by_{c}") for c in by]).select("key", "i", "p0", "p1", "n", "c", "r")
    return groups, scratch.write(out, "suffixes")


def suffix_array(lines: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], list[DataFrame]]:
    """The suffixes of ``lines`` by level, and by level the pairs of neighbours in the suffix array that it tells apart.

    Level k has (key, i, p0, p1, n, c, r) of the suffixes that 2 ** (k - 1) lines do not tell apart: by 2 ** k
    lines, c suffixes stand from place r on; with c = 1 a suffix has its place for good. Its pairs (r, lcp, x, y):
    suffixes y, of those that stand from r on, and x, of those just before, with lcp = 2 ** k lines in common and less
    than twice as many. Levels end when each suffix is sorted by its first n lines.
    """
    groups, now = _placed(lines, ["h0", "h1"], scratch)
    scratch.drop(groups)
    levels, pairs, k = [now], [], 0
    while not levels[-1].where((F.col("c") > 1) & (F.col("n") > 1 << k)).isEmpty():
        every = levels[-1].withColumn("open", F.col("c") > 1)
        for settled in levels[:-1]:
            every = every.unionByName(settled.where("c = 1").withColumn("open", F.lit(False)))
        on = Window.partitionBy("key").orderBy("i").rangeBetween(1 << k, 1 << k)
        doubled = every.withColumn("s", F.coalesce(F.max("r").over(on), F.lit(-1))).where("open")  # -1: the text ends
        doubled = scratch.write(doubled.select("key", "i", "p0", "p1", "n", F.col("r").alias("before"), "s"), "doubled")
        groups, now = _placed(doubled, ["before", "s"], scratch)
        left = groups.select(F.col("before").alias("b"), (F.col("r") + F.col("c")).alias("end"), F.col("one").alias("x"))
        apart = groups.join(left, (F.col("r") == F.col("end")) & (F.col("before") == F.col("b")))
        pairs.append(scratch.write(apart.select("r", F.lit(1 << k).alias("lcp"), "x", F.col("one").alias("y")), "pairs"))
        scratch.drop(doubled, groups)
        levels.append(now)
        k += 1
    return levels, pairs


def common_prefixes(levels: list[DataFrame], pairs: list[DataFrame], scratch: Scratch) -> DataFrame | None:
    """The LCP array, (r, lcp): how many lines the suffixes at the places r and r - 1 have in common, where that is more than none.

    Places between r and r + c of the last level are left out, where suffixes agree as far as they are sorted.
    From 2 ** k lines on, each lower level adds its lines where it has both rests of a pair at one place.
    """
    found = None
    for j in reversed(range(len(pairs))):
        found = pairs[j] if found is None else found.unionByName(pairs[j])
        if j:
            before = found
            for s in "xy":
                place = levels[j - 1].where("c > 1").select(F.col("key").alias("pk"), F.col("i").alias("pi"), F.col("r").alias(f"{s}r"))
                found = found.join(place, (F.col(f"{s}.key") == F.col("pk")) & (F.col(f"{s}.i") + F.col("lcp") == F.col("pi")), "left").drop("pk", "pi")
            more = F.when(F.col("xr") == F.col("yr"), 1 << (j - 1)).otherwise(0)
            found = scratch.write(found.select("r", (F.col("lcp") + more).alias("lcp"), "x", "y"), "pairs")
            scratch.drop(before)
    return None if found is None else found.select("r", "lcp")


def repeated_runs(docs: DataFrame, min_words: int, scratch: Scratch) -> DataFrame:
    """(key, p0, p1, at): from each line on that has a copy, the run of n lines with ``min_words`` words.

    at: the interval of the suffix array that has the run's n lines in common, by the place where it begins:
    there, and at no place of it further on, suffixes have less than n lines in common with the one before.
    """
    lines = scratch.write(line_rows(docs, min_words), "lines")
    levels, pairs = suffix_array(lines, scratch)
    scratch.drop(lines)
    lcp = common_prefixes(levels, pairs, scratch)
    # lines that stand but once, settled by the first level, have no run in common with any
    suffixes = functools.reduce(DataFrame.unionByName, [levels[-1].where("c > 1"), *[x.where("c = 1") for x in levels[1:]]])
    suffixes = suffixes.where("n > 0").select("key", "p0", "p1", "n", "r")
    places = suffixes.groupBy("r").agg(F.max("n").alias("n")).withColumn("lcp", F.lit(0))
    if lcp is not None:
        places = places.drop("lcp").join(lcp, "r", "left")
    begins = F.when(F.coalesce("lcp", F.lit(0)) < F.col("n"), F.col("r"))
    ordered = _in_order(places.select("r", begins.alias("begins")), ["r"], scratch)
    upto = Window.partitionBy(_part()).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    interval = F.greatest(F.max("begins").over(upto), _before(ordered, F.max("begins"), max))
    intervals = ordered.select("r", interval.alias("interval"))
    out = scratch.write(suffixes.join(intervals, "r").select("key", "p0", "p1", F.col("interval").alias("at")), "runs")
    scratch.drop(ordered, lcp, *levels)
    return out


def dedup_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from the text, and a column ``n_removed``.

    A line is deleted if it lies in a run of consecutive lines with ``min_words``
    words or more that also begins earlier: in a smaller id, or further up in the same
    text. Runs are judged on the input, not on what is left; lines without words take
    no part, and go with a run that they lie inside. Null ids come first; texts of one
    id stand in the order of their hashes. Rows that repeat an id and its text are one
    document and treated alike. A null text stays null; a text whose lines all go is
    empty. All other columns stay as they are.
    """
    scratch = Scratch(docs.sparkSession)
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    own = docs.select(id_.alias("id"), text.alias("text")).where("text IS NOT NULL")
    counts = own.agg(F.count("*"), F.count("id")).first()
    numbers = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    plain = numbers and counts[0] == counts[1] and own.groupBy("id").count().where("count > 1").isEmpty()
    given = docs.withColumns({"__id": id_, "__t": F.xxhash64(text)})
    if plain:
        own = own.select(F.col("id").cast("long").alias("key"), "text")
        given = given.withColumn("__key", F.col("__id").cast("long"))
    else:  # keys in the order of (id, text's hash)
        marked = own.withColumn("t", F.xxhash64("text"))
        keys = scratch.write(marked.select("id", "t").distinct().orderBy(F.asc_nulls_first("id"), "t").select(F.col("id").alias("__id"), F.col("t").alias("__t"), F.monotonically_increasing_id().alias("__key")), "keys")
        whose = lambda df, i, t: df.join(keys.withColumnsRenamed({"__id": "__i", "__t": "__h"}), F.col(i).eqNullSafe(F.col("__i")) & (F.col(t) == F.col("__h")), "left").drop("__i", "__h")
        own = scratch.write(whose(marked, "id", "t").dropDuplicates(["__key"]).select(F.col("__key").alias("key"), "text"), "own")
        given = whose(given, "__id", "__t")

    runs = repeated_runs(own, min_words, scratch)
    place = F.struct("key", "p0")
    firsts = runs.groupBy("at").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    later = runs.join(firsts, "at").where(F.col("first") != place)
    before = Window.partitionBy("key").orderBy("p0").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("key").orderBy("p0")
    apart = later.withColumn("new", F.coalesce(F.col("p0") > F.max("p1").over(before) + 1, F.lit(True)).cast("int"))
    spans = apart.withColumn("span", F.sum("new").over(upto)).groupBy("key", "span").agg(F.min("p0").alias("p0"), F.max("p1").alias("p1"))
    gone = spans.groupBy("key").agg(F.flatten(F.collect_list(F.sequence("p0", "p1"))).alias("__gone")).withColumnRenamed("key", "__k")

    both = given.join(gone, F.col("__key") == F.col("__k"), "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    out = F.when(text.isNull() | F.col("__gone").isNull(), text).otherwise(left)
    rest = [out.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != "n_removed"]
    return both.select(*rest, F.when(text.isNotNull() & F.col("__gone").isNotNull(), F.size("__gone")).otherwise(0).alias("n_removed"))
