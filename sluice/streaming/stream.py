"""The row-wise operators on a stream of raw records.

Detection, cleaning, validation and masking look at one row at a time, but for
repeated ids, so they run unchanged on a stream. Repeated ids are kept out within
a watermark; what comes later than that is let through, unlike in a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.values import format_date
from sluice.operators.clean import normalised, outcomes
from sluice.operators.detect import hits
from sluice.operators.mask import apply_masks
from sluice.policy import Policy


def assess(raw: DataFrame, policy: Policy) -> DataFrame:
    """As in a batch, without the rule that only the first row of an id survives."""
    return outcomes(normalised(raw, policy), policy)


def cleaned(raw: DataFrame, policy: Policy, time_col: str | None = None, watermark: str = "1 day") -> DataFrame:
    """Clean rows of a stream; with a time column, one row per id within the watermark."""
    df = assess(raw, policy).where(F.size("rejections") == 0)
    if time_col:
        df = df.withColumn("__id", F.col("n_customer_id.value")).withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(["__id"])
    value = lambda c: (format_date(F.col(f"n_{c}.value")) if policy.schema[c]["dtype"] == "date" else F.col(f"n_{c}.value")).alias(c)
    return df.select(*([time_col] if time_col else []), *[value(c) for c in policy.columns])


def masked(raw: DataFrame, policy: Policy, time_col: str | None = None, watermark: str = "1 day") -> DataFrame:
    return apply_masks(cleaned(raw, policy, time_col, watermark), policy)


def detected(raw: DataFrame, columns: list[str], id_col: str, time_col: str, window: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """(window, column, detector, rows) of a stream, by event time."""
    long = raw.withWatermark(time_col, watermark)
    found = hits(long.withColumn("row_idx", F.struct(F.col(time_col).alias("at"), F.col(id_col).alias("id"))), columns)
    return found.select(F.col("row_idx.at").alias("at"), "column", "detector").groupBy(F.window("at", window), "column", "detector").agg(F.count("*").alias("rows"))
