"""A customer table with every kind of defect, made from the keys of ``customer``.

One SQL text that both engines run; it uses only CASE, integer arithmetic,
concatenation and lpad, which mean the same in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_CALENDAR = {1: "January", 2: "February", 3: "March", 4: "April", 5: "May", 6: "June", 7: "July", 8: "August", 9: "September", 10: "October", 11: "November", 12: "December"}
_MONTH = "CASE {m} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _CALENDAR.items()) + " END"


def _pad(x: str, n: int = 2) -> str:
    return f"lpad(CAST({x} AS STRING), {n}, '0')"


def _dates(y: str, m: str, d: str, rare: str) -> str:
    """A date in one of the known formats, or something that is none."""
    iso = f"CAST({y} AS STRING) || '-' || {_pad(m)} || '-' || {_pad(d)}"
    return f"""CASE {rare}
    WHEN k % 17 = 3 THEN {_pad(m)} || '/' || {_pad(d)} || '/' || CAST({y} AS STRING)
    WHEN k % 17 = 5 THEN {_pad(d)} || '-' || {_pad(m)} || '-' || CAST({y} AS STRING)
    WHEN k % 17 = 7 THEN CAST({y} AS STRING) || '/' || {_pad(m)} || '/' || {_pad(d)}
    WHEN k % 17 = 9 THEN {_MONTH.format(m=m)} || ' ' || {_pad(d)} || ', ' || CAST({y} AS STRING)
    WHEN k % 151 = 11 THEN CAST({y} AS STRING) || '-' || CAST({m} AS STRING) || '-' || CAST({d} AS STRING)
    ELSE {iso} END"""


DIRTY_SQL = f"""
WITH keyed AS (
  SELECT CAST(c_custkey AS BIGINT) AS k, c_acctbal,
    CAST(1940 + (c_custkey * 7) % 66 AS BIGINT) AS y, CAST(1 + (c_custkey * 5) % 12 AS BIGINT) AS m, CAST(1 + (c_custkey * 11) % 28 AS BIGINT) AS d,
    CAST(2015 + (c_custkey * 3) % 11 AS BIGINT) AS cy, CAST(1 + (c_custkey * 7) % 12 AS BIGINT) AS cm, CAST(1 + (c_custkey * 13) % 28 AS BIGINT) AS cd,
    CAST(200 + (c_custkey * 31) % 800 AS STRING) AS p1, CAST(200 + (c_custkey * 37) % 800 AS STRING) AS p2, CAST(1000 + (c_custkey * 41) % 9000 AS STRING) AS p3
  FROM {{customer}}
)
SELECT k - 1 AS row_idx,
  CASE WHEN k % 97 = 0 THEN CAST(k - 1 AS STRING) WHEN k % 89 = 0 THEN CAST(k AS STRING) || '.9' WHEN k % 83 = 0 THEN {_pad('k', 8)}
    WHEN k % 79 = 0 THEN '  ' || CAST(k AS STRING) || ' ' WHEN k % 211 = 0 THEN '-' || CAST(k AS STRING) WHEN k % 223 = 0 THEN 'abc'
    WHEN k % 227 = 0 THEN '1e3' WHEN k % 229 = 0 THEN CAST(k AS STRING) || '.0' WHEN k % 233 = 0 THEN NULL WHEN k % 239 = 0 THEN 'N/A'
    ELSE CAST(k AS STRING) END AS customer_id,
  CASE k % 23 WHEN 0 THEN 'José' WHEN 1 THEN 'mary   jane' WHEN 2 THEN 'O''BRIEN' WHEN 3 THEN 'Zoë' WHEN 4 THEN 'J0hn' WHEN 5 THEN '  Lee  '
    WHEN 6 THEN 'Nguyễn' WHEN 7 THEN 'ANNE-MARIE' WHEN 8 THEN CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN 'N/A' ELSE 'X' END
    WHEN 9 THEN 'Łukasz' WHEN 10 THEN 'müller' ELSE 'Ann' END AS first_name,
  CASE k % 29 WHEN 0 THEN 'smith' WHEN 1 THEN 'DOE' WHEN 2 THEN 'Lee3' WHEN 3 THEN 'de la cruz' WHEN 4 THEN '   ' WHEN 5 THEN 'unknown'
    WHEN 6 THEN 'Müller' WHEN 7 THEN lpad('a', 60, 'b') ELSE 'Lee' END AS last_name,
  CASE k % 31 WHEN 0 THEN 'ANN' || CAST(k AS STRING) || '@Corp.COM' WHEN 1 THEN 'ann@@corp.com' WHEN 2 THEN 'ann.corp.com' WHEN 3 THEN 'ann@corp'
    WHEN 4 THEN '@nodomain.com' WHEN 5 THEN NULL WHEN 6 THEN 'NULL' WHEN 7 THEN ' ann' || CAST(k AS STRING) || '@corp.com ' WHEN 8 THEN 'not an email'
    ELSE 'ann.lee' || CAST(k AS STRING) || '@corp.com' END AS email,
  CASE k % 19 WHEN 0 THEN '(' || p1 || ') ' || p2 || '-' || p3 WHEN 1 THEN p1 || '.' || p2 || '.' || p3 WHEN 2 THEN '+1-' || p1 || '-' || p2 || '-' || p3
    WHEN 3 THEN '1' || p1 || p2 || p3 WHEN 4 THEN p1 || p2 || p3 WHEN 5 THEN '555-CALL-NOW' WHEN 6 THEN '+44 20 7946 0958' WHEN 7 THEN '12345'
    WHEN 8 THEN CASE WHEN k % 2 = 0 THEN NULL ELSE 'n/a' END ELSE p1 || '-' || p2 || '-' || p3 END AS phone,
  {_dates('y', 'm', 'd', "WHEN k % 61 = 0 THEN 'invalid_date' WHEN k % 67 = 0 THEN '2026-02-30' WHEN k % 71 = 0 THEN NULL WHEN k % 73 = 0 THEN '  ' WHEN k % 101 = 0 THEN '18' || lpad(CAST(k % 90 AS STRING), 2, '0') || '-05-17' WHEN k % 103 = 0 THEN '2015-06-01'")} AS date_of_birth,
  CASE k % 37 WHEN 0 THEN 'PO Box' WHEN 1 THEN 'N/A' WHEN 2 THEN NULL WHEN 3 THEN CAST(k AS STRING) || ' High  Street,   Springfield, IL 627' || {_pad('k % 100')}
    WHEN 4 THEN CAST(k AS STRING) || ' High Street, Springfield, contact ann.lee@gmail.com' WHEN 5 THEN CAST(k AS STRING) || ' High Street, tel ' || p1 || '-' || p2 || '-' || p3
    WHEN 6 THEN CAST(k AS STRING) || ' High Street, SSN ' || CAST(100 + k % 800 AS STRING) || '-' || CAST(10 + k % 90 AS STRING) || '-' || p3 WHEN 7 THEN lpad('x', 250, 'y')
    WHEN 8 THEN CAST(k AS STRING) || ' High Street, host 10.0.' || CAST(k % 250 AS STRING) || '.7' ELSE CAST(k AS STRING) || ' High Street, Springfield, IL ' || CAST(10000 + (k * 17) % 90000 AS STRING) END AS address,
  CASE k % 41 WHEN 0 THEN '75k' WHEN 1 THEN '$52,000' WHEN 2 THEN '60,000.00' WHEN 3 THEN 'not disclosed' WHEN 4 THEN NULL WHEN 5 THEN '-' || CAST(500 + k AS STRING)
    WHEN 6 THEN '1' || {_pad('k % 100000', 8)} WHEN 7 THEN 'lots' WHEN 8 THEN '$75k' WHEN 9 THEN '1.5K' WHEN 10 THEN CAST(20000 + (k * 53) % 150000 AS STRING) || '.25'
    ELSE CAST(18000 + (k * 53) % 220000 AS STRING) END AS income,
  CASE k % 43 WHEN 0 THEN 'Active' WHEN 1 THEN '  active' WHEN 2 THEN 'actv' WHEN 3 THEN 'SUSP' WHEN 4 THEN 'closed' WHEN 5 THEN 'pending' WHEN 6 THEN '1'
    WHEN 7 THEN NULL WHEN 8 THEN 'inactve' ELSE CASE k % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' ELSE 'suspended' END END AS account_status,
  {_dates('cy', 'cm', 'cd', "WHEN k % 107 = 0 THEN '2027-01-15' WHEN k % 109 = 0 THEN '1930-01-01' WHEN k % 113 = 0 THEN NULL WHEN k % 127 = 0 THEN 'soon'")} AS created_date
FROM keyed
"""

#: The same as a common table expression ahead of a DuckDB query.
DUCK = "WITH dirty AS (" + DIRTY_SQL.replace("{customer}", "customer") + ")"


def dirty(spark: SparkSession, customer: DataFrame) -> DataFrame:
    return spark.sql(DIRTY_SQL, customer=customer)
