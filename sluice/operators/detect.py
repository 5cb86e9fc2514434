"""Detection of personal data: every detector on every column, in one scan."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.text import is_missing, redact
from sluice.functions.values import percentage

DIRECT, QUASI = "direct identifier", "quasi-identifier"


@dataclass(frozen=True)
class Detector:
    name: str
    pattern: str
    category: str
    sensitivity: str
    #: What every match holds; values without it are not searched.
    holds: str = ""

    def count(self, value: str) -> Column:
        n = F.regexp_count(value, F.lit(self.pattern)).cast("long")
        return F.when(F.contains(value, F.lit(self.holds)), n).otherwise(0) if self.holds else n


# fixed values: detectors, the inventory of columns, what is suppressed, and columns that must hold no identifier
DETECTORS = (
    Detector("email", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}", DIRECT, "high", "@"),
    Detector("us_ssn", r"\b\d{3}-\d{2}-\d{4}\b", DIRECT, "critical", "-"),
    Detector("phone", r"(?<!\d)(?:\+?1[\s.\-]?)?(?:\(\d{3}\)|\d{3})[\s.\-]?\d{3}[\s.\-]?\d{4}(?!\d)", DIRECT, "high"),
    Detector("postal_code", r"\b\d{5}(?:-\d{4})?\b", QUASI, "medium"),
    Detector("date_iso", r"\b(?:19|20)\d{2}-\d{2}-\d{2}\b", QUASI, "medium", "-"),
    Detector("ip_address", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", DIRECT, "medium", "."),
)
INVENTORY = (
    ("customer_id", "pseudonymous key", "medium"),
    ("first_name", DIRECT, "high"),
    ("last_name", DIRECT, "high"),
    ("email", DIRECT, "high"),
    ("phone", DIRECT, "high"),
    ("date_of_birth", QUASI, "high"),
    ("address", QUASI, "high"),
    ("income", QUASI, "high"),
    ("account_status", "non-PII", "low"),
    ("created_date", QUASI, "medium"),
)
SUPPRESSED = (
    ("postal_code", "income", "any five digits of an amount look like a code"),
    ("postal_code", "customer_id", "any five digits of a key look like a code"),
    ("postal_code", "phone", "part of a telephone number"),
    ("date_iso", "created_date", "when the account was opened, not a birthday"),
)
LEAK_COLUMNS = ("address", "account_status", "created_date", "income")
SEVERITY = {"critical": 3, "high": 2, "medium": 1, "low": 0}


def registry() -> dict[str, Detector]:
    return {d.name: d for d in DETECTORS}


def lookup(pairs: dict, *keys: Column, default: Column | None = None) -> Column:
    """A small constant table as an expression."""
    out = default if default is not None else F.lit(None).cast("string")
    for k, v in pairs.items():
        k = k if isinstance(k, tuple) else (k,)
        out = F.when(reduce(Column.__and__, [c == x for c, x in zip(keys, k)]), F.lit(v)).otherwise(out)
    return out


def hits(df: DataFrame, columns: list[str], detectors: tuple[Detector, ...] = DETECTORS, id_col: str = "row_idx") -> DataFrame:
    """(row_idx, column, detector, n, value) for each value that a detector matches. Missing values are passed over.

    One scan: columns become rows, all patterns are counted in one projection, and
    only the counts above zero go on. Nothing is shuffled.
    """
    long = df.select(F.col(id_col).alias("row_idx"), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("x"))
    long = long.select("row_idx", "x.column", "x.value").where(~is_missing("value"))
    counts = F.array(*[F.struct(F.lit(d.name).alias("detector"), d.count("value").alias("n")) for d in detectors])
    found = long.select("row_idx", "column", "value", F.explode(F.filter(counts, lambda x: x["n"] > 0)).alias("x"))
    return found.select("row_idx", "column", "x.detector", "x.n", "value")


def suppression() -> Column:
    """Why a (detector, column) is set aside; null if it counts."""
    return lookup({(d, c): why for d, c, why in SUPPRESSED}, F.col("detector"), F.col("column"))


def category() -> Column:
    return lookup({d.name: d.category for d in DETECTORS}, F.col("detector"))


def findings(found: DataFrame, columns: list[str], samples: int = 3) -> DataFrame:
    """(column, detector, category, sensitivity, row_count, match_count, samples, suppressed), most rows first.

    The first samples are taken with a group limit below the shuffle, so a detector
    that hits every row sends a few of them from each task.
    """
    counted = found.groupBy("column", "detector").agg(F.count("*").alias("row_count"), F.sum("n").alias("match_count"))
    w = Window.partitionBy("column", "detector").orderBy("row_idx")
    first = found.withColumn("rn", F.row_number().over(w)).where(f"rn <= {samples}")
    first = first.groupBy("column", "detector").agg(F.transform(F.sort_array(F.collect_list(F.struct("rn", redact("value").alias("s")))), lambda x: x["s"]).alias("samples"))
    place = lookup({c: i for i, c in enumerate(columns)}, F.col("column")), lookup({d.name: i for i, d in enumerate(DETECTORS)}, F.col("detector"))
    out = counted.join(first, ["column", "detector"]).select(
        "column", "detector", category().alias("category"), lookup({d.name: d.sensitivity for d in DETECTORS}, F.col("detector")).alias("sensitivity"), "row_count", "match_count", "samples", suppression().alias("suppressed")
    )
    return out.orderBy(F.desc("row_count"), *[p.cast("int") for p in place])


def confirmed(f: DataFrame) -> DataFrame:
    return f.where("suppressed IS NULL")


def leaks(found: DataFrame) -> DataFrame:
    """Hits of direct identifiers in columns that should hold none."""
    return found.where(F.col("column").isin(*LEAK_COLUMNS) & (category() == DIRECT))


def leak_rows(found: DataFrame) -> DataFrame:
    """(rows): distinct rows with a leak."""
    return leaks(found).agg(F.countDistinct("row_idx").alias("rows"))


def leak_places(found: DataFrame, most: int) -> DataFrame:
    """(column, detector, rows): the first ``most`` rows of each kind of leak, limited below the shuffle."""
    w = Window.partitionBy("column", "detector").orderBy("row_idx")
    first = leaks(found).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most)
    return first.groupBy("column", "detector").agg(F.sort_array(F.collect_list("row_idx")).alias("rows"))


def worst_leak(found: DataFrame) -> DataFrame:
    """(column, detector, sensitivity) of the severest leak; by column and detector among equals."""
    level = lookup({d.name: SEVERITY[d.sensitivity] for d in DETECTORS}, F.col("detector")).cast("int")
    by = leaks(found).groupBy("column", "detector").count().withColumn("sensitivity", lookup({d.name: d.sensitivity for d in DETECTORS}, F.col("detector")))
    return by.orderBy(F.desc(level), "column", "detector").limit(1).drop("count")


def confirmation_rate(found: DataFrame) -> DataFrame:
    """(raw_rows, confirmed_rows, rate): share of hits that no rule sets aside, in per cent."""
    kept = F.coalesce(F.count_if(suppression().isNull()), F.lit(0))
    return found.agg(F.count("*").alias("raw_rows"), kept.alias("confirmed_rows")).withColumn("rate", percentage("confirmed_rows", "raw_rows"))


def residual(df: DataFrame, id_col: str = "row_idx") -> DataFrame:
    """Hits of direct identifiers in any column, nothing set aside: what must be empty before release."""
    direct = tuple(d for d in DETECTORS if d.category == DIRECT)
    return hits(df, [c for c in df.columns if c != id_col], direct, id_col)
