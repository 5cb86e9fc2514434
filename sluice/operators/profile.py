"""Profiling of a raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import is_missing, is_sentinel, shape, strip
from sluice.policy import Policy

LABELS = {"int64": "integer", "float64": "numeric", "str": "string", "date": "date"}
INVENTORIED = ("phone", "date_of_birth", "created_date")


def _unpivoted(df: DataFrame, columns: list[str], measures: dict[str, list[Column]]) -> DataFrame:
    """One row per column out of a single one-row aggregate."""
    wide = df.agg(*[m.alias(f"{name}_{i}") for name, ms in measures.items() for i, m in enumerate(ms)])
    rows = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), *[F.col(f"{name}_{i}").alias(name) for name in measures]) for i, c in enumerate(columns)])
    return wide.select(F.explode(rows).alias("x")).select("x.*")


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, rows, nulls, sentinels, missing, pct) of every column, in one pass."""
    c = [F.col(f"`{x}`") for x in columns]
    out = _unpivoted(df, columns, {"rows": [F.count(F.lit(1)) for _ in c], "nulls": [F.count_if(x.isNull()) for x in c], "sentinels": [F.count_if(is_sentinel(x)) for x in c]})
    missing = F.col("nulls") + F.col("sentinels")
    return out.withColumn("missing", missing).withColumn("pct", V.percentage("missing", "rows")).orderBy("place").drop("place")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, distinct_values), nulls left out; each column's values are one aggregate over (column, value)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    counted = long.distinct().groupBy("column").agg(F.count("value").alias("distinct_values"))
    return counted


def duplicate_ids(df: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """(id, occurrences) of raw ids that stand more than once; missing ones are no duplicates."""
    text = F.col(f"`{id_col}`").cast("string")
    return df.where(~is_missing(text)).groupBy(text.alias("id")).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def surplus(duplicates: DataFrame) -> DataFrame:
    """(ids, surplus_rows)"""
    return duplicates.agg(F.count("*").alias("ids"), F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias("surplus_rows"))


def format_inventory(df: DataFrame, column: str, top: int = 8, id_col: str = "row_idx") -> DataFrame:
    """(shape, rows, example) of the commonest shapes; the earlier of equals first, the example the earliest."""
    c = F.col(f"`{column}`").cast("string")
    by = df.where(~is_missing(c)).groupBy(shape(c).alias("shape")).agg(F.count("*").alias("rows"), F.min_by(strip(c), id_col).alias("example"), F.min(id_col).alias("first"))
    return by.orderBy(F.desc("rows"), "first").limit(top).drop("first")


def examples(df: DataFrame, value: Column, k: int, id_col: str = "row_idx", ordered: bool = False) -> DataFrame:
    """The first k distinct values (or, ``ordered``, the smallest)."""
    by = df.groupBy(value.alias("value")).agg(F.min(id_col).alias("first"))
    return by.orderBy("value" if ordered else "first").limit(k).select("value")


def invalid_checks(policy: Policy) -> dict[str, tuple[Column, Column, int, bool]]:
    """name: (predicate, example, number of examples, whether those are sorted)."""
    formats, low, high = policy.date_formats, *policy.ages
    out: dict[str, tuple] = {}
    day = {}
    for c in ("date_of_birth", "created_date"):
        present, iso, any_ = ~is_missing(c), V.iso_date(c), V.parse_dates(c, formats)
        day[c] = F.coalesce(iso, any_)
        out[f"{c}_repairable_format"] = (present & iso.isNull() & any_.isNotNull(), F.col(c), 5, False)
        out[f"{c}_unrepairable"] = (present & iso.isNull() & any_.isNull(), F.col(c), 5, False)
    number, present = V.profiled_number("income"), ~is_missing("income")
    plain = V.is_canonical("income")
    out["income_repairable_format"] = (present & ~plain & number.isNotNull(), F.col("income"), 5, False)
    out["income_unrepairable"] = (present & ~plain & number.isNull(), F.col("income"), 5, False)
    out["negative_income"] = (number < 0, number, 5, False)
    out["income_above_cap"] = ((number > policy.income_cap) & ~F.isnan(number), number, 3, False)
    age = V.years(day["date_of_birth"], policy.today)
    out["age_outside_policy"] = (~age.between(low, high), F.format_string("%.1fy", age), 5, True)
    out["future_created_date"] = (day["created_date"] > F.lit(policy.today), F.col("created_date"), 3, False)
    return out


def invalid_values(df: DataFrame, policy: Policy) -> DataFrame:
    """(check, rows) in their order; checks on a column that is not there count nothing. One pass."""
    names, tests = [], []
    for name, (predicate, *_rest) in invalid_checks(policy).items():
        column = "created_date" if "created" in name else "income" if "income" in name else "date_of_birth"
        names.append(name)
        tests.append(F.count_if(F.coalesce(predicate, F.lit(False))) if column in df.columns else F.lit(0).cast("long"))
    return _unpivoted(df, names, {"rows": tests}).orderBy("place").select(F.col("column").alias("check"), "rows")


def histogram(df: DataFrame, column: str, id_col: str = "row_idx") -> DataFrame:
    """(value, rows), commonest first, the earlier of equals first; a null reads "nan"."""
    by = df.groupBy(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("nan")).alias("value")).agg(F.count("*").alias("rows"), F.min(id_col).alias("first"))
    return by.orderBy(F.desc("rows"), "first").drop("first")


def drift(columns: list[str], policy: Policy) -> tuple[list[str], list[str]]:
    """Columns that are missing, and those the policy does not know."""
    known = set(policy.columns)
    return sorted(known - set(columns)), sorted(set(columns) - known - {"row_idx"})
