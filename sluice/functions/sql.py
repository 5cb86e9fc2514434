"""The engine's expressions as temporary SQL functions, for those who write queries as text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sluice.functions.text import SENTINELS
from sluice.policy import Policy

_STRIP = r"regexp_replace(x, r'(?U)^\s+|\s+$', '')"
_TEXT = r"regexp_replace(coalesce(x, ''), r'(?U)^\s+|\s+$', '')"
_NUMBER = r"r'(?i)\A(?:[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?)\z'"


def bodies(policy: Policy) -> dict[str, tuple[str, str]]:
    """name: (type, body over x) of each function."""
    listed = ", ".join("'" + s.replace("'", "''") + "'" for s in SENTINELS)
    w, hidden = policy.band_width, policy.placeholder.replace("'", "''")
    lo = f"CAST(floor(try_cast({_TEXT} AS DOUBLE) / {w}) * {w} AS BIGINT)"
    return {
        "strip_space": ("STRING", _STRIP),
        "is_missing": ("BOOLEAN", f"x IS NULL OR lower({_STRIP}) IN ({listed})"),
        "value_shape": ("STRING", rf"regexp_replace(regexp_replace({_STRIP}, r'\d', '9'), '[A-Za-z]', 'A')"),
        "redact": ("STRING", r"left(regexp_replace(regexp_replace(x, r'([A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]*@', '$1***@'), r'\d', '#'), 44)"),
        "postal_code": ("STRING", r"coalesce(nullif(regexp_extract(x, r'\b(\d{5})(?:-\d{4})?\b', 1), ''), '?')"),
        "mask_initial": ("STRING", f"CASE WHEN {_TEXT} = '' THEN '' ELSE concat(upper(left({_TEXT}, 1)), '***') END"),
        "mask_email_local": ("STRING", f"CASE WHEN NOT contains({_TEXT}, '@') THEN '***' WHEN startswith({_TEXT}, '***@') THEN {_TEXT} ELSE concat(lower(left(substring_index({_TEXT}, '@', 1), 1)), '***@', substring({_TEXT}, locate('@', {_TEXT}) + 1)) END"),
        "mask_last_four": ("STRING", rf"CASE WHEN length(regexp_replace({_TEXT}, r'\D', '')) >= 4 THEN concat('***-***-', right(regexp_replace({_TEXT}, r'\D', ''), 4)) ELSE '***-***-****' END"),
        "mask_year_only": ("STRING", rf"CASE WHEN {_TEXT} RLIKE r'\A(?:\d{{4}}|\*{{4}})-\*\*-\*\*\z' THEN {_TEXT} WHEN {_TEXT} RLIKE r'\A\d{{4}}-\d{{2}}-\d{{2}}\z' THEN concat(left({_TEXT}, 4), '-**-**') ELSE '****-**-**' END"),
        "mask_suppress": ("STRING", f"'{hidden}'"),
        "mask_band": ("STRING", rf"CASE WHEN {_TEXT} RLIKE r'\A\d+-\d+\z' OR {_TEXT} = 'unknown' THEN {_TEXT} WHEN {_TEXT} RLIKE {_NUMBER} AND abs(try_cast({_TEXT} AS DOUBLE)) < DOUBLE('Infinity') THEN concat(CAST({lo} AS STRING), '-', CAST({lo} + {w - 1} AS STRING)) ELSE 'unknown' END"),
    }


def register(spark: SparkSession, policy: Policy, prefix: str = "sluice_") -> list[str]:
    """Create the functions in the session; their names. Each is an expression that is put in its caller's plan."""
    names = []
    for name, (kind, body) in bodies(policy).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}(x STRING) RETURNS {kind} RETURN {body}")
        names.append(prefix + name)
    return names
