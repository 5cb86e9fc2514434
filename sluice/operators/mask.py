"""Masking of a table by policy."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluice.functions.masks import strategy
from sluice.operators.privacy import k_buckets, signatures
from sluice.policy import Policy


def apply_masks(df: DataFrame, policy: Policy) -> DataFrame:
    """Every column with a rule masked, in place, in one projection; a rule for a column that is not there is an error."""
    absent = [r.column for r in policy.mask_rules if r.column not in df.columns]
    if absent:
        raise ValueError(f"no column to mask: {', '.join(absent)}")
    return df.withColumns({r.column: strategy(policy, r.strategy)(r.column) for r in policy.mask_rules})


def risk(df: DataFrame, masked: DataFrame, policy: Policy) -> tuple[DataFrame, DataFrame]:
    """k-anonymity bands before and after masking, each by its own quasi-identifiers."""
    return k_buckets(signatures(df, policy.quasi_before, policy)), k_buckets(signatures(masked, policy.quasi_after, policy))
