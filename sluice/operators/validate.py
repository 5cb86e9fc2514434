"""Validation: every rule on every row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import full, is_missing
from sluice.policy import CrossCheck, Policy

#: The policy's dialect writes "a letter of any script" so, which would be ASCII letters alone in Java.
_LETTER = (r"[^\W\d_]", r"[\p{L}\p{Nl}\p{No}]")
FAILURE = "array<struct<column: string, check: string, value: string>>"


def typed(c: str, dtype: str) -> Column:
    """A raw column as its declared type; null where it cannot be."""
    if dtype == "int64":
        number = V.parse_number(F.col(c).cast("string"))
        return F.when(number % 1 == 0, number.try_cast("long"))
    if dtype == "float64":
        return V.parse_number(F.col(c).cast("string"))
    if dtype == "date":
        text = F.col(c).cast("string")
        day = F.when(full(text, V.shape_of("%Y-%m-%d")), F.to_date(F.try_to_timestamp(text, F.lit(V.pattern("%Y-%m-%d")))))
        return F.when(day.between(F.lit("1677-09-22").cast("date"), F.lit("2262-04-11").cast("date")), day)
    return F.col(c).cast("string")


def _pattern(c: Column, pattern: str) -> Column:
    """Whether a value matches from its start on."""
    return c.rlike(rf"\A(?:{pattern.replace(*_LETTER)})")


def checks(policy: Policy, column: str) -> list[tuple[str, Column]]:
    """(published name, predicate that holds of a good value) of a column's rules, on its typed form."""
    spec, t, today = policy.checks(column), F.col(f"t_{column}"), policy.today
    low, high = policy.ages
    build: dict[str, Callable[[], tuple[str, Column]]] = {
        "gt": lambda: ("greater_than", t > spec["gt"]),
        "ge": lambda: ("greater_than_or_equal_to", t >= spec["ge"]),
        "le": lambda: ("less_than_or_equal_to", t <= spec["le"]),
        "income_cap": lambda: ("less_than_or_equal_to", t <= policy.income_cap),
        "isin": lambda: ("isin", t.isin(*spec["isin"])),
        "min_len": lambda: (f"length_{spec['min_len']}_{spec['max_len']}", F.length(t).between(spec["min_len"], spec["max_len"])),
        "pattern": lambda: ("str_matches", _pattern(t, spec["pattern"])),
        "min_age": lambda: (f"age_{low}_{high}", F.round(V.years(t, today), 1).between(low, high)),
        "not_future": lambda: ("not_in_future", t <= F.lit(today)),
    }
    return [build[k]() for k in build if spec.get(k) is not None and spec[k] is not False]


def cross(check: CrossCheck, columns: list[str]) -> Column:
    """Whether a row violates a rule over two columns; a null on either side does not."""
    absent = [c for c in (check.left, check.right) if c not in columns]
    if absent:
        raise ValueError(f"check {check.name}: no column {', '.join(absent)}")
    a, b = F.col(f"t_{check.left}"), F.col(f"t_{check.right}")
    holds = {"lt": a < b, "le": a <= b, "gt": a > b, "ge": a >= b}
    if check.op not in holds:
        raise ValueError(f"check {check.name}: no operation {check.op!r}")
    return F.coalesce(~holds[check.op], F.lit(False))


def validated(raw: DataFrame, policy: Policy) -> DataFrame:
    """``raw`` with typed columns (``t_<field>``), ``failures`` and ``uncoercible`` (names of columns) of each row.

    All rules stand in one projection. Repeated values of a unique column fail on
    every row that has them, also nulls if there are several; only values that repeat
    are joined back.
    """
    columns = [c for c in policy.columns if c in raw.columns]
    df = raw.withColumns({f"t_{c}": typed(c, policy.schema[c]["dtype"]) for c in columns})
    unique = [c for c in columns if policy.schema[c].get("unique")]
    for c in unique:
        times = df.groupBy(F.col(f"t_{c}").alias("dup")).agg(F.count("*").alias(f"times_{c}")).where(f"times_{c} > 1")
        df = df.join(times, F.col(f"t_{c}").eqNullSafe(F.col("dup")), "left").drop("dup")
    failures, uncoercible = [], []
    for c in columns:
        t, shown = F.col(f"t_{c}"), F.col(f"`{c}`").cast("string")
        failure = lambda name, c=c, shown=shown: F.struct(F.lit(c).alias("column"), F.lit(name).alias("check"), shown.alias("value"))
        if not policy.schema[c].get("nullable", True):
            failures.append(F.when(t.isNull(), failure("not_nullable")))
        if c in unique:
            failures.append(F.when(F.col(f"times_{c}").isNotNull(), failure("field_uniqueness")))
        failures += [F.when(t.isNotNull() & ~good, failure(name)) for name, good in checks(policy, c)]
        if policy.schema[c]["dtype"] != "str":
            uncoercible.append(F.when(~is_missing(F.col(f"`{c}`").cast("string")) & t.isNull(), F.lit(c)))
    for check in policy.cross_checks:
        shown = F.col(f"`{check.right}`").cast("string") if check.right in columns else F.lit(None)
        failures.append(F.when(cross(check, columns), F.struct(F.lit(check.right).alias("column"), F.lit(check.name).alias("check"), shown.alias("value"))))
    out = df.withColumns({"failures": F.array_compact(F.array(*failures)).cast(FAILURE), "uncoercible": F.array_compact(F.array(*uncoercible)).cast("array<string>")})
    return out.drop(*[f"times_{c}" for c in unique])


def failures(v: DataFrame) -> DataFrame:
    """(row_idx, place, column, check, value), an event each."""
    return v.select("row_idx", F.posexplode("failures").alias("place", "x")).select("row_idx", "place", "x.*")


def by_rule(v: DataFrame) -> DataFrame:
    """(rule, failures), most first, the earlier of equals first."""
    rule = F.concat("column", F.lit("."), "check").alias("rule")
    by = failures(v).groupBy(rule).agg(F.count("*").alias("failures"), F.min(F.struct("row_idx", "place")).alias("first"))
    return by.orderBy(F.desc("failures"), "first").drop("first")


def failing_rows(v: DataFrame) -> DataFrame:
    """(rows, failures, uncoercible), from one pass."""
    return v.agg(F.count_if(F.size("failures") > 0).alias("rows"), F.coalesce(F.sum(F.size("failures")), F.lit(0)).alias("failures"), F.coalesce(F.sum(F.size("uncoercible")), F.lit(0)).alias("uncoercible"))


def coercion_by_column(v: DataFrame) -> DataFrame:
    """(column, uncoercible)"""
    return v.select(F.explode("uncoercible").alias("column")).groupBy("column").agg(F.count("*").alias("uncoercible"))


def passed(v: DataFrame) -> bool:
    return v.where((F.size("failures") > 0) | (F.size("uncoercible") > 0)).isEmpty()


def delta(pre: DataFrame, post: DataFrame, key: str, count: str) -> DataFrame:
    """(key, pre, post, delta) of two frequency tables; those that only one has count as zero in the other."""
    both = pre.select(key, F.col(count).alias("pre")).join(post.select(key, F.col(count).alias("post")), key, "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return both.select(key, zero("pre").alias("pre"), zero("post").alias("post")).withColumn("delta", F.col("post") - F.col("pre"))


def sample(v: DataFrame, most: int = 40) -> DataFrame:
    """At most ``most`` failures spread over the checks: the first of each, then the second of each, and so on.

    The number of rows per check is limited below the shuffle.
    """
    w = Window.partitionBy("column", "check").orderBy("row_idx", "place")
    ranked = failures(v).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most)
    return ranked.orderBy("rn", "column", "check").limit(most)
