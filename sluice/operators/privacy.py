"""Re-identification risk by k-anonymity over quasi-identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import full, strip
from sluice.functions.values import band, plain_number, postal_code, usable
from sluice.policy import Policy

# fixed values: bands of group sizes, in the order they are shown
BANDS = ("k=1 (unique)", "k=2", "k=3-5", "k>5")


def income_label(c: Column | str, width: int) -> Column:
    """Band of an income; a band stays, anything else is "?"."""
    if width <= 0:
        raise ValueError(f"a band's width must be positive, not {width}")
    text = strip(F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("nan")))
    number = plain_number(text)
    return F.when(full(text, r"\d+-\d+"), text).when(usable(number), band(number, width)).otherwise(F.lit("?"))


def quasi(df: DataFrame, name: str, policy: Policy) -> Column:
    """One quasi-identifier's part of a signature. A null reads "nan", which is not incomplete; an unknown name is an error."""
    if name == "address_postal":
        if "address" not in df.columns:
            raise ValueError("address_postal is derived from a column address, which is not there")
        return postal_code(F.coalesce(F.col("address"), F.lit("nan")))
    if name not in df.columns:
        raise ValueError(f"no column {name!r} to identify by; there are {', '.join(df.columns)}")
    if name == "income":
        return income_label(name, policy.band_width)
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("nan"))


def signatures(df: DataFrame, names: list[str], policy: Policy) -> DataFrame:
    """(signature): an array of texts per row; nothing to identify by gives no row."""
    if not names:
        return df.sparkSession.createDataFrame([], "signature array<string>")
    return df.select(F.array(*[quasi(df, n, policy) for n in names]).alias("signature"))


def k_buckets(signed: DataFrame) -> DataFrame:
    """(band, rows): rows, not groups, by the size of their group. A group of any size is pre-aggregated before it meets."""
    size = F.col("count")
    label = F.when(size == 1, BANDS[0]).when(size == 2, BANDS[1]).when(size <= 5, BANDS[2]).otherwise(BANDS[3])
    return signed.groupBy("signature").count().groupBy(label.alias("band")).agg(F.sum("count").alias("rows"))


def incomplete_share(signed: DataFrame) -> DataFrame:
    """(share): part of the signatures with "?" in them, 0 of none."""
    return signed.agg(F.coalesce(F.avg(F.array_contains("signature", "?").cast("double")), F.lit(0.0)).alias("share"))
