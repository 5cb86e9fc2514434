"""Masking strategies, each the same when applied to its own result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import after_at, before_at, col, digits, full, strip
from sluice.functions.values import banded
from sluice.policy import Policy


def _text(c: Column | str) -> Column:
    return strip(F.coalesce(col(c).cast("string"), F.lit("")))


def initial(c: Column | str) -> Column:
    text = _text(c)
    return F.when(text == "", "").otherwise(F.concat(F.upper(F.left(text, F.lit(1))), F.lit("***")))


def email_local(c: Column | str) -> Column:
    text = _text(c)
    masked = F.concat(F.lower(F.left(before_at(text), F.lit(1))), F.lit("***@"), after_at(text))
    return F.when(~text.contains("@"), "***").when(text.startswith("***@"), text).otherwise(masked)


def last_four(c: Column | str) -> Column:
    d = digits(_text(c))
    return F.when(F.length(d) >= 4, F.concat(F.lit("***-***-"), F.right(d, F.lit(4)))).otherwise(F.lit("***-***-****"))


def year_only(c: Column | str) -> Column:
    text = _text(c)
    return F.when(full(text, r"(?:\d{4}|\*{4})-\*\*-\*\*"), text).when(full(text, r"\d{4}-\d{2}-\d{2}"), F.concat(F.left(text, F.lit(4)), F.lit("-**-**"))).otherwise(F.lit("****-**-**"))


def suppress(placeholder: str) -> Callable[[Column | str], Column]:
    return lambda c: F.lit(placeholder)


def band(width: int) -> Callable[[Column | str], Column]:
    return lambda c: banded(F.coalesce(col(c).cast("string"), F.lit("")), width)


def strategies(policy: Policy) -> dict[str, Callable[[Column | str], Column]]:
    """Every strategy by the name that a policy gives it."""
    return {"initial": initial, "email_local": email_local, "last_four": last_four, "year_only": year_only, "suppress": suppress(policy.placeholder), "band": band(policy.band_width)}


def strategy(policy: Policy, name: str) -> Callable[[Column | str], Column]:
    try:
        return strategies(policy)[name]
    except KeyError:
        raise ValueError(f"no masking strategy {name!r}") from None
