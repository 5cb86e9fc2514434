"""Cleaning: repair what is plain, set aside the rest with reasons, lose nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import normalise as N
from sluice.functions.text import collapse, redact, title
from sluice.functions.values import format_date, parse_date, years
from sluice.policy import Policy

REJECTION = "array<struct<reason: string, column: string, value: string>>"
REPAIR = "array<struct<column: string, tag: string>>"


def normalisers(policy: Policy, read: bool = False) -> dict[str, Column]:
    """The normaliser of every field, in the order their outcomes are listed; ``read``: its parts, over the columns that ``normalised`` makes."""
    name_checks, address_checks = policy.checks("first_name"), policy.checks("address")
    name_bounds = {k: int(name_checks[k]) for k in ("min_len", "max_len") if k in name_checks}
    address_bounds = {k: int(address_checks[k]) for k in ("min_len", "max_len") if k in address_checks}
    made = lambda **names: {k: F.col(v) for k, v in names.items()} if read else {}
    days = lambda c: {"days": [F.col(f"d{i}_{c}") for i in range(len(policy.date_formats))]} if read else {}
    return {
        "customer_id": N.customer_id("customer_id", parts=read),
        "first_name": N.name("first_name", **name_bounds, **made(text="k_first_name", titled="u_first_name"), parts=read),
        "last_name": N.name("last_name", **name_bounds, **made(text="k_last_name", titled="u_last_name"), parts=read),
        "email": N.email("email", parts=read),
        "phone": N.phone("phone", parts=read),
        "date_of_birth": N.date("date_of_birth", policy.date_formats, **days("date_of_birth"), parts=read),
        "address": N.address("address", **address_bounds, **made(text="k_address"), parts=read),
        "income": N.income("income", policy.income_cap, parts=read),
        "account_status": N.status("account_status", policy.statuses, policy.aliases, parts=read),
        "created_date": N.date("created_date", policy.date_formats, **days("created_date"), parts=read),
    }


def normalised(raw: DataFrame, policy: Policy) -> DataFrame:
    """``raw`` with each field's outcome (``n_<field>``). What is used several times is a column of its own, so it is worked out once."""
    single = {f"k_{c}": collapse(c) for c in ("first_name", "last_name", "address")}
    days = {f"d{i}_{c}": parse_date(c, f) for c in ("date_of_birth", "created_date") for i, f in enumerate(policy.date_formats)}
    titled = {f"u_{c}": title(f"k_{c}") for c in ("first_name", "last_name")}
    read = raw.withColumns(single | days).withColumns(titled)
    fields, given = normalisers(policy, read=True), [F.col(f"`{c}`") for c in raw.columns]
    parts = read.select(*given, *[x.alias(f"p{i}_{c}") for c, e in fields.items() for i, x in enumerate(e)])
    return parts.select(*given, *[N.joined(*[F.col(f"p{i}_{c}") for i in range(3)]).alias(f"n_{c}") for c in fields])


def rejection(reason: str | Column, column: str, value: Column) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(reason.alias("reason"), F.lit(column).alias("column"), F.left(F.coalesce(value, F.lit("nan")), F.lit(40)).alias("value"))


def outcomes(df: DataFrame, policy: Policy, more: list[Column] = ()) -> DataFrame:
    """``df``, of ``normalised`` rows, with ``rejections`` and ``repairs`` of each; ``more``: rejections beyond those of one row."""
    fields, (low, high) = list(normalisers(policy)), policy.ages
    born, made = F.col("n_date_of_birth.value"), F.col("n_created_date.value")
    own = [F.when(F.col(f"n_{c}.reason").isNotNull(), rejection(F.col(f"n_{c}.reason"), c, F.col(c))) for c in fields]
    across = [
        F.when(~years(born, policy.today).between(low, high), rejection("implausible_age", "date_of_birth", format_date(born))),
        F.when(made > F.lit(policy.today), rejection("future_created_date", "created_date", format_date(made))),
        F.when(made < born, rejection("created_before_birth", "created_date", format_date(made))),
    ]
    repairs = [F.when(F.col(f"n_{c}.tag").isNotNull(), F.struct(F.lit(c).alias("column"), F.col(f"n_{c}.tag").alias("tag"))) for c in fields]
    return df.withColumns({"rejections": F.array_compact(F.array(*own, *across, *more)).cast(REJECTION), "repairs": F.array_compact(F.array(*repairs)).cast(REPAIR)})


def assess(raw: DataFrame, policy: Policy) -> DataFrame:
    """``raw`` with each field's outcome (``n_<field>``), ``repairs`` and ``rejections`` of the row.

    ``raw`` has ``row_idx`` and the policy's columns as text. All rules are
    expressions over one row but for repeated ids: the first row of each parsed id
    survives, whatever else befalls it. Only the ids that repeat are joined back; that
    side is small unless many repeat, and it is for adaptive execution to choose how.
    """
    df, parsed = normalised(raw, policy), N.customer_id("customer_id")["value"]
    ids = raw.select("row_idx", parsed.alias("dup_id")).groupBy("dup_id").agg(F.min("row_idx").alias("first_row"), F.count("*").alias("n")).where("dup_id IS NOT NULL AND n > 1").drop("n")
    df = df.join(ids, F.col("n_customer_id.value") == F.col("dup_id"), "left")
    later = F.when(F.col("row_idx") > F.col("first_row"), rejection("duplicate_customer_id", "customer_id", F.col("customer_id")))
    return outcomes(df, policy, [later]).drop("dup_id", "first_row")


def cleaned(assessed: DataFrame, policy: Policy, dates_as_text: bool = True) -> DataFrame:
    """Rows without a rejection: the policy's columns alone, in its order."""
    def value(c: str) -> Column:
        v = F.col(f"n_{c}.value")
        return (format_date(v) if dates_as_text and policy.schema[c]["dtype"] == "date" else v).alias(c)

    return assessed.where(F.size("rejections") == 0).select("row_idx", *[value(c) for c in policy.columns])


def quarantined(assessed: DataFrame) -> DataFrame:
    return assessed.where(F.size("rejections") > 0)


def quarantine(assessed: DataFrame, sensitive: list[str]) -> DataFrame:
    """One row per row set aside, its reasons together. The key stays, for someone has to mend the source."""
    def shown(r: Column) -> Column:
        value = F.when(r["column"].isin(*sensitive), redact(r["value"])).otherwise(r["value"])
        return F.concat(r["column"], F.lit("="), value)

    names = lambda part: F.concat_ws("; ", F.array_sort(F.array_distinct(F.transform("rejections", lambda r: r[part]))))
    return quarantined(assessed).select(
        F.col("row_idx").alias("source_row"),
        F.coalesce("customer_id", F.lit("nan")).alias("customer_id"),
        F.size("rejections").alias("failure_count"),
        names("reason").alias("failure_reason"),
        names("column").alias("failing_columns"),
        F.left(F.concat_ws(" | ", F.transform("rejections", shown)), F.lit(180)).alias("sample_values"),
    ).orderBy("source_row")


def rejections(assessed: DataFrame) -> DataFrame:
    """(row_idx, customer_id, place, reason, column, value), an event each."""
    return assessed.select("row_idx", F.coalesce("customer_id", F.lit("nan")).alias("customer_id"), F.posexplode("rejections").alias("place", "x")).select("row_idx", "customer_id", "place", "x.*")


def repairs(assessed: DataFrame) -> DataFrame:
    """(row_idx, place, column, tag), an event each, also on rows that are set aside later."""
    return assessed.select("row_idx", F.posexplode("repairs").alias("place", "x")).select("row_idx", "place", "x.*")


def frequency(events: DataFrame, key: str) -> DataFrame:
    """(key, events), commonest first, the earlier of equals first."""
    by = events.groupBy(key).agg(F.count("*").alias("events"), F.min(F.struct("row_idx", "place")).alias("first"))
    return by.orderBy(F.desc("events"), "first").drop("first")


def touched(assessed: DataFrame, column: str) -> DataFrame:
    """(row_idx) of rows with a repair or a rejection in a column."""
    acted = F.exists("repairs", lambda r: r["column"] == column) | F.exists("rejections", lambda r: r["column"] == column)
    return assessed.where(acted).select("row_idx")


def reconciliation(assessed: DataFrame) -> DataFrame:
    """(rows_in, rows_out, rows_quarantined, balances), from one pass."""
    counts = assessed.agg(F.count("*").alias("rows_in"), F.count_if(F.size("rejections") == 0).alias("rows_out"), F.count_if(F.size("rejections") > 0).alias("rows_quarantined"))
    return counts.withColumn("balances", F.col("rows_in") == F.col("rows_out") + F.col("rows_quarantined"))


def policy_sensitivity(assessed: DataFrame, non_critical: list[str]) -> DataFrame:
    """(quarantined, recoverable, retention, retention_if_optional): what it costs that optional fields are required."""
    mild = lambda r: r["column"].isin(*non_critical) & (r["reason"] == N.MISSING)
    some = F.size("rejections") > 0
    counts = assessed.agg(F.count("*").alias("n"), F.count_if(some).alias("quarantined"), F.count_if(some & F.forall("rejections", mild)).alias("recoverable"))
    share = lambda kept: F.coalesce(F.try_divide(kept.cast("double"), F.col("n").cast("double")), F.lit(0.0))
    out = F.col("n") - F.col("quarantined")
    return counts.select("quarantined", "recoverable", share(out).alias("retention"), share(out + F.col("recoverable")).alias("retention_if_optional"))
