"""Scoring: what was planted against what each operator did about it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators import detect
from sluice.operators.detect import lookup

# fixed values: how each planted defect is expected to be dealt with
EXPECTED = {
    "income_negative": ("rejection", "income_out_of_range"),
    "income_above_cap": ("rejection", "income_out_of_range"),
    "income_non_numeric": ("rejection", "unparseable_income"),
    "phone_unparseable": ("rejection", "unparseable_phone"),
    "dob_invalid_value": ("rejection", "unparseable_date"),
    "age_impossible": ("rejection", "implausible_age"),
    "created_date_future": ("rejection", "future_created_date"),
    "email_malformed": ("rejection", "malformed_email"),
    "address_too_short": ("rejection", "address_too_short"),
    "duplicate_customer_id": ("rejection", "duplicate_customer_id"),
    "pii_leaked_in_address": ("pii_leak", "address"),
    "missing_email": ("rejection", "missing_required_field"),
    "missing_phone": ("rejection", "missing_required_field"),
    "missing_income": ("rejection", "missing_required_field"),
    "missing_address": ("rejection", "missing_required_field"),
    "missing_dob": ("rejection", "missing_required_field"),
    "phone_nonstandard_format": ("repair", "phone_normalised"),
    "dob_nonstandard_format": ("repair", "date_normalised"),
    "created_date_nonstandard_format": ("repair", "date_normalised"),
    "status_invalid": ("mixed", "status"),
    "first_name_dirty": ("mixed", "first_name"),
    "last_name_dirty": ("mixed", "last_name"),
}


def per_defect(planted: DataFrame, assessed: DataFrame, hits: DataFrame) -> DataFrame:
    """(defect, column, planted, handled, attributed, escaped, recall, attribution, containment), worst first.

    ``planted`` has (defect, column, row_idx). Handled: the row was touched in that
    column, or its leak found. Attributed: by the expected reason or tag, in whatever
    column. Escaped: neither set aside nor repaired there. Rows meet once, on their
    number; their events travel with them as arrays. Unknown defects are left out.
    """
    events = assessed.select("row_idx", "rejections", "repairs")
    leaked = detect.leaks(hits).select("row_idx").distinct().withColumn("leaked", F.lit(True))
    known = planted.where(F.col("defect").isin(*EXPECTED))
    kind, key = (lookup({d: e[i] for d, e in EXPECTED.items()}, F.col("defect")) for i in (0, 1))
    rows = known.join(events, "row_idx").join(leaked, "row_idx", "left").withColumns({"kind": kind, "key": key, "leaked": F.coalesce("leaked", F.lit(False))})
    in_column = lambda events: F.exists(events, lambda e: e["column"] == F.col("column"))
    touched = in_column("rejections") | in_column("repairs")
    handled = F.when(F.col("kind") == "pii_leak", F.col("leaked")).otherwise(touched)
    attributed = (
        F.when(F.col("kind") == "rejection", F.exists("rejections", lambda e: e["reason"] == F.col("key")))
        .when(F.col("kind") == "repair", F.exists("repairs", lambda e: e["tag"] == F.col("key")))
        .otherwise(handled)
    )
    escaped = (F.size("rejections") == 0) & ~in_column("repairs")
    out = rows.groupBy("defect", "column").agg(F.count("*").alias("planted"), F.count_if(handled).alias("handled"), F.count_if(attributed).alias("attributed"), F.count_if(escaped).alias("escaped"))
    part = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("planted")), F.lit(1.0))
    out = out.withColumns({"recall": part("handled"), "attribution": part("attributed"), "containment": 1 - F.coalesce(F.try_divide(F.col("escaped"), F.col("planted")), F.lit(0.0))})
    return out.orderBy("recall", "attribution", "defect")


def unmeasured(planted: DataFrame) -> DataFrame:
    return planted.where(~F.col("defect").isin(*EXPECTED)).select("defect").distinct()


def specificity(planted: DataFrame, assessed: DataFrame) -> DataFrame:
    """(clean_rows, falsely_quarantined): rows with no planted defect, and how many of them were set aside."""
    fine = assessed.join(planted.select("row_idx"), "row_idx", "left_anti")
    return fine.agg(F.count("*").alias("clean_rows"), F.count_if(F.size("rejections") > 0).alias("falsely_quarantined"))


def totals(scores: DataFrame) -> DataFrame:
    """(planted, handled, attributed, escaped, recall, attribution, containment, macro_recall, macro_attribution): by volume, and by defect."""
    sums = scores.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("planted", "handled", "attributed", "escaped")], F.coalesce(F.avg("recall"), F.lit(1.0)).alias("macro_recall"), F.coalesce(F.avg("attribution"), F.lit(1.0)).alias("macro_attribution"))
    part = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("planted")), F.lit(1.0))
    return sums.withColumns({"recall": part("handled"), "attribution": part("attributed"), "containment": 1 - F.coalesce(F.try_divide(F.col("escaped"), F.col("planted")), F.lit(0.0))})


