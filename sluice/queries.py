"""The engine's registered queries, and SQL that DuckDB runs over the same tables.

What the tables lack in defects is made by ``plans.dirty``; all queries run over
whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice import policy
from sluice.functions import masks, normalise, text, values
from sluice.operators import clean, detect, generate, mask, privacy, profile, score, validate
from sluice.plans import duck, run
from sluice.plans.dirty import DUCK
from sluice.plans.dirty import dirty as dirty_view
from sluice.sources import io

Query = Callable[[SparkSession, str], DataFrame]
POLICY = policy.load()
COLUMNS = POLICY.columns
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_view(spark, io.spread(table(spark, sf_dir, "customer")))


def assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.assess(dirty(spark, sf_dir), POLICY)


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def on_dirty(name: str, sql: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name, sql)(lambda spark, sf_dir: build(dirty(spark, sf_dir)))


def on_assessed(name: str, sql: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name, duck.events(POLICY) + sql)(lambda spark, sf_dir: build(assessed(spark, sf_dir)))


def on_customers(name: str, sql: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name, sql)(lambda spark, sf_dir: build(table(spark, sf_dir, "customer")))


def _placed(df: DataFrame, name: str) -> DataFrame:
    """A short sorted table with the place of each row, so that its order is compared too."""
    return df.withColumn("__id", F.monotonically_increasing_id()).withColumn(name, F.row_number().over(Window.orderBy("__id"))).drop("__id")


# detection -----------------------------------------------------------------------------


def _text_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = detect.hits(io.spread(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("text", "documents_text"), ["documents_text"], id_col="doc_id")
    pages = detect.hits(io.spread(table(spark, sf_dir, "pages").select("page_id", "html")).withColumnRenamed("html", "pages_html"), ["pages_html"], id_col="page_id")
    turns = detect.hits(io.spread(table(spark, sf_dir, "conversations").select("conv_id", "text")).withColumnRenamed("text", "conversations_text"), ["conversations_text"], id_col="conv_id")
    return docs.unionByName(pages).unionByName(turns)


_TEXTS = (("documents", "text", "doc_id"), ("pages", "html", "page_id"), ("conversations", "text", "conv_id"))
_TEXT_ROWS = " UNION ALL ".join(
    f"SELECT '{t}_{c}' AS \"column\", '{d.name}' AS detector, count(*) AS row_count FROM {t} WHERE NOT {duck.missing(c)} AND regexp_matches({c}, {duck.quoted(duck.pattern(d.name))}) HAVING count(*) > 0" for t, c, _ in _TEXTS for d in detect.DETECTORS
)
_TEXT_MATCHES = " UNION ALL ".join(
    f"SELECT '{t}_{c}' AS \"column\", '{d.name}' AS detector, coalesce(sum(len(regexp_extract_all({c}, {duck.quoted(d.pattern)}))), 0)::BIGINT AS match_count FROM {t} WHERE NOT {duck.missing(c)} HAVING coalesce(sum(len(regexp_extract_all({c}, {duck.quoted(d.pattern)}))), 0) > 0"
    for t, c, _ in _TEXTS
    for d in detect.DETECTORS
    if d.name != "phone"
)


@query("detect_rows", _TEXT_ROWS)
def detect_rows(spark, sf_dir):
    return _text_hits(spark, sf_dir).groupBy("column", "detector").agg(F.count("*").alias("row_count"))


@query("detect_matches", _TEXT_MATCHES)
def detect_matches(spark, sf_dir):
    return _text_hits(spark, sf_dir).where("detector <> 'phone'").groupBy("column", "detector").agg(F.sum("n").alias("match_count"))


@query(
    "redact_documents",
    f"SELECT doc_id, {duck.redact('text')} AS redacted FROM documents WHERE " + " OR ".join(f"regexp_matches(text, {duck.quoted(duck.pattern(d.name))})" for d in detect.DETECTORS),
)
def redact_documents(spark, sf_dir):
    found = F.lit(False)
    for d in detect.DETECTORS:
        found = found | F.col("text").rlike(d.pattern)
    return io.spread(table(spark, sf_dir, "documents").select("doc_id", "text")).where(found).select("doc_id", text.redact("text").alias("redacted"))


_HITS = f"{DUCK}, hit AS ({duck.hits('dirty', COLUMNS, 'row_idx')})"
_CATEGORY = "CASE detector " + " ".join(f"WHEN '{d.name}' THEN '{d.category}'" for d in detect.DETECTORS) + " END"
_SENSITIVITY = "CASE detector " + " ".join(f"WHEN '{d.name}' THEN '{d.sensitivity}'" for d in detect.DETECTORS) + " END"
#: No value of the dirty table holds two telephone numbers, so rows are matches; DuckDB's patterns cannot look around a number.
_MATCHES = "CASE detector " + " ".join(f"WHEN '{d.name}' THEN " + ("1" if d.name == "phone" else f"len(regexp_extract_all(value, {duck.quoted(d.pattern)}))") for d in detect.DETECTORS) + " END"
_PLACE = "CASE detector " + " ".join(f"WHEN '{d.name}' THEN {i}" for i, d in enumerate(detect.DETECTORS)) + " END"
on_dirty(
    "detect_findings",
    f"""{_HITS}, valued AS (SELECT hit.*, CASE col {' '.join(f"WHEN '{c}' THEN dirty.{c}" for c in COLUMNS)} END AS value FROM hit JOIN dirty USING (row_idx)),
found AS (SELECT col, detector, {_CATEGORY} AS category, {_SENSITIVITY} AS sensitivity, count(*) AS row_count, sum({_MATCHES})::BIGINT AS match_count,
  array_to_string((list({duck.redact('value')} ORDER BY row_idx))[1:3], ' | ') AS samples, {duck.suppressed()} AS is_suppressed FROM valued GROUP BY col, detector)
SELECT row_number() OVER (ORDER BY row_count DESC, list_position({[*COLUMNS]}, col), {_PLACE})::INT AS place, col AS "column", * EXCLUDE (col) FROM found""",
    lambda df: _placed(detect.findings(detect.hits(df, COLUMNS), COLUMNS), "place").select("place", "column", "detector", "category", "sensitivity", "row_count", "match_count", F.array_join("samples", " | ").alias("samples"), F.col("suppressed").isNotNull().alias("is_suppressed")),
)
on_dirty("confirmed_findings", f"{_HITS} SELECT col AS \"column\", detector, count(*) AS row_count FROM hit WHERE NOT ({duck.suppressed()}) GROUP BY ALL", lambda df: detect.confirmed(detect.findings(detect.hits(df, COLUMNS), COLUMNS)).select("column", "detector", "row_count"))
on_dirty("leak_findings", f"{_HITS} SELECT row_idx, col AS \"column\", detector FROM hit WHERE {duck.leaks()}", lambda df: detect.leaks(detect.hits(df, COLUMNS)).select("row_idx", "column", "detector"))
on_dirty("leak_rows", f"{_HITS} SELECT count(DISTINCT row_idx) AS rows FROM hit WHERE {duck.leaks()}", lambda df: detect.leak_rows(detect.hits(df, COLUMNS)))
on_dirty("worst_leak", f"{_HITS} SELECT col AS \"column\", detector, {_SENSITIVITY} AS sensitivity FROM hit WHERE {duck.leaks()} GROUP BY col, detector ORDER BY CASE {_SENSITIVITY} WHEN 'critical' THEN 3 WHEN 'high' THEN 2 ELSE 1 END DESC, 1, 2 LIMIT 1", lambda df: detect.worst_leak(detect.hits(df, COLUMNS)))
on_dirty(
    "confirmation_rate",
    f"{_HITS} SELECT count(*) AS raw_rows, count(*) FILTER (NOT ({duck.suppressed()})) AS confirmed_rows, 100.0::DOUBLE * count(*) FILTER (NOT ({duck.suppressed()})) / count(*) AS rate FROM hit",
    lambda df: detect.confirmation_rate(detect.hits(df, COLUMNS)),
)
on_dirty("residual_identifiers", f"{_HITS} SELECT col AS \"column\", detector, count(*) AS rows FROM hit WHERE {duck.direct()} GROUP BY ALL", lambda df: detect.residual(df).groupBy("column", "detector").agg(F.count("*").alias("rows")))
query("pii_inventory", "SELECT * FROM (VALUES " + ", ".join(f"({duck.quoted(c)}, {duck.quoted(k)}, {duck.quoted(s)})" for c, k, s in detect.INVENTORY) + ") t(\"column\", classification, sensitivity)")(lambda spark, sf_dir: spark.createDataFrame(list(detect.INVENTORY), "column string, classification string, sensitivity string"))

# profile ----------------------------------------------------------------------------------

on_dirty(
    "completeness",
    DUCK + " " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER ({duck.sentinel(c)}) AS sentinels, count(*) FILTER ({duck.missing(c)}) AS missing, 100.0::DOUBLE * count(*) FILTER ({duck.missing(c)}) / count(*) AS pct FROM dirty" for c in COLUMNS),
    lambda df: profile.completeness(df, COLUMNS),
)
on_dirty("distinct_counts", DUCK + " " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM dirty" for c in COLUMNS), lambda df: profile.distinct_counts(df, COLUMNS))
_DUPLICATES = f"SELECT customer_id AS id, count(*) AS occurrences FROM dirty WHERE NOT {duck.missing('customer_id')} GROUP BY 1 HAVING count(*) > 1"
on_dirty("duplicate_ids", f"{DUCK} {_DUPLICATES}", profile.duplicate_ids)
on_dirty("surplus_rows", f"{DUCK} SELECT count(*) AS ids, coalesce(sum(occurrences - 1), 0)::BIGINT AS surplus_rows FROM ({_DUPLICATES})", lambda df: profile.surplus(profile.duplicate_ids(df)))
query("surplus_order_lines", "SELECT count(*) AS ids, sum(n - 1)::BIGINT AS surplus_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)")(lambda spark, sf_dir: profile.surplus(profile.duplicate_ids(table(spark, sf_dir, "lineitem"), "l_orderkey")))
for _c in profile.INVENTORIED:
    on_dirty(
        f"format_inventory_{_c}",
        f"{DUCK} SELECT {duck.shape(_c)} AS shape, count(*) AS rows, min_by({duck.strip(_c)}, row_idx) AS example FROM dirty WHERE NOT {duck.missing(_c)} GROUP BY 1 ORDER BY count(*) DESC, min(row_idx) LIMIT 8",
        lambda df, c=_c: profile.format_inventory(df, c),
    )


def _invalid_sql() -> str:
    out, f, (low, high) = [], POLICY.date_formats, POLICY.ages
    count = lambda name, cond: out.append(f"SELECT '{name}' AS \"check\", count(*) FILTER ({cond}) AS rows FROM dirty")
    for c in ("date_of_birth", "created_date"):
        count(f"{c}_repairable_format", f"NOT {duck.missing(c)} AND {duck.iso(c)} IS NULL AND {duck.day(c, f)} IS NOT NULL")
        count(f"{c}_unrepairable", f"NOT {duck.missing(c)} AND {duck.iso(c)} IS NULL AND {duck.day(c, f)} IS NULL")
    x, plain = f"coalesce({duck.thousands('income')}, {duck.number(duck.unsigned('income'))})", rf"regexp_full_match({duck.strip('income')}, '-?\d+(\.\d+)?')"
    count("income_repairable_format", f"NOT {duck.missing('income')} AND NOT {plain} AND {x} IS NOT NULL")
    count("income_unrepairable", f"NOT {duck.missing('income')} AND NOT {plain} AND {x} IS NULL")
    count("negative_income", f"{x} < 0")
    count("income_above_cap", f"{x} > {POLICY.income_cap}")
    count("age_outside_policy", f"date_diff('day', {duck.day('date_of_birth', f)}, DATE '{POLICY.today}') / 365.25 NOT BETWEEN {low} AND {high}")
    count("future_created_date", f"{duck.day('created_date', f)} > DATE '{POLICY.today}'")
    return f"{DUCK} " + " UNION ALL ".join(out)


on_dirty("invalid_value_counts", _invalid_sql(), lambda df: profile.invalid_values(df, POLICY))
on_dirty("status_histogram", f"{DUCK} SELECT coalesce(account_status, 'nan') AS value, count(*) AS rows FROM dirty GROUP BY 1", lambda df: profile.histogram(df, "account_status"))
on_dirty("status_examples", f"{DUCK} SELECT account_status AS value FROM dirty WHERE account_status NOT IN {duck.listed(POLICY.statuses)} GROUP BY 1 ORDER BY min(row_idx) LIMIT 5", lambda df: profile.examples(df.where(~F.col("account_status").isin(*POLICY.statuses)), F.col("account_status"), 5))

# cleaning ---------------------------------------------------------------------------------


def _cleaned_field(c: str):
    shown = f"strftime({c}_value, '%Y-%m-%d')" if "date" in c else f"CAST({c}_value AS STRING)" if c == "customer_id" else f"{c}_value"

    def build(df: DataFrame) -> DataFrame:
        out = clean.normalisers(POLICY)[c]
        value = values.format_date(out["value"]) if "date" in c else out["value"].cast("string") if c == "customer_id" else out["value"]
        return df.select("row_idx", value.alias("value"), out["tag"].alias("tag"), out["reason"].alias("reason"))

    on_dirty(f"clean_{c}", f"{duck.normalised(POLICY)} SELECT row_idx, {shown} AS value, {c}_tag AS tag, {c}_reason AS reason FROM n", build)


for _c in COLUMNS:
    _cleaned_field(_c)
on_assessed("clean_rows", f" SELECT row_idx, {', '.join(COLUMNS)} FROM out_rows", lambda a: clean.cleaned(a, POLICY))
_SENSITIVE = duck.listed(POLICY.sensitive)
on_assessed(
    "quarantine",
    f""" SELECT row_idx AS source_row, any_value(customer_id) AS customer_id, count(*)::INT AS failure_count,
  array_to_string(list_sort(list_distinct(list(reason))), '; ') AS failure_reason, array_to_string(list_sort(list_distinct(list(col))), '; ') AS failing_columns,
  left(string_agg(col || '=' || CASE WHEN col IN {_SENSITIVE} THEN {duck.redact('value')} ELSE value END, ' | ' ORDER BY place), 180) AS sample_values
FROM rejection GROUP BY row_idx""",
    lambda a: clean.quarantine(a, POLICY.sensitive),
)
on_assessed("rejection_reasons", " SELECT row_number() OVER (ORDER BY count(*) DESC, min((row_idx, place)))::INT AS place, reason, count(*) AS events FROM rejection GROUP BY reason", lambda a: _placed(clean.frequency(clean.rejections(a), "reason"), "place"))
on_assessed("repairs_by_tag", " SELECT tag, count(*) AS events FROM repair GROUP BY 1", lambda a: clean.frequency(clean.repairs(a), "tag"))
on_assessed("touched_phone", " SELECT DISTINCT row_idx FROM (SELECT row_idx FROM rejection WHERE col = 'phone' UNION ALL SELECT row_idx FROM repair WHERE col = 'phone')", lambda a: clean.touched(a, "phone"))
on_assessed(
    "reconciliation",
    " SELECT count(*) AS rows_in, count(*) - (SELECT count(DISTINCT row_idx) FROM rejection) AS rows_out, (SELECT count(DISTINCT row_idx) FROM rejection) AS rows_quarantined, true AS balances FROM n",
    clean.reconciliation,
)
on_assessed(
    "policy_sensitivity",
    f""", q AS (SELECT row_idx, bool_and(col IN {duck.listed(POLICY.non_critical)} AND reason = 'missing_required_field') AS mild FROM rejection GROUP BY 1)
SELECT (SELECT count(*) FROM q) AS quarantined, (SELECT count(*) FROM q WHERE mild) AS recoverable,
  (count(*) - (SELECT count(*) FROM q))::DOUBLE / count(*) AS retention, (count(*) - (SELECT count(*) FROM q WHERE NOT mild))::DOUBLE / count(*) AS retention_if_optional FROM n""",
    lambda a: clean.policy_sensitivity(a, POLICY.non_critical),
)


@query("survivorship", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 AS survives FROM orders")
def survivorship(spark, sf_dir):
    """The first order of each customer; by the smallest key of each group, joined back, so a large group is never one task's."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"))
    return orders.join(first, "o_custkey").select("o_custkey", "o_orderkey", (F.col("o_orderkey") == F.col("first")).alias("survives"))


# validation -------------------------------------------------------------------------------

_PRE = f"{DUCK}, {duck.rules(POLICY, 'dirty', 'pre')}"
on_dirty("validate_by_rule", f"{_PRE} SELECT col || '.' || chk AS rule, count(*) AS failures FROM pre GROUP BY 1", lambda df: validate.by_rule(validate.validated(df, POLICY)))
on_dirty("coercion_by_column", f"{_PRE} SELECT col AS \"column\", count(*) AS uncoercible FROM pre_coerce GROUP BY 1", lambda df: validate.coercion_by_column(validate.validated(df, POLICY)))
on_dirty("failing_rows", f"{_PRE} SELECT count(DISTINCT row_idx) AS rows, count(*) AS failures, (SELECT count(*) FROM pre_coerce) AS uncoercible FROM pre", lambda df: validate.failing_rows(validate.validated(df, POLICY)))
on_dirty("cross_column", f"{_PRE} SELECT row_idx, col AS \"column\" FROM pre WHERE chk = 'dob_before_created'", lambda df: validate.failures(validate.validated(df, POLICY)).where("check = 'dob_before_created'").select("row_idx", "column"))
on_dirty(
    "failure_sample",
    f"{_PRE}, ranked AS (SELECT *, row_number() OVER (PARTITION BY col, chk ORDER BY row_idx, place) AS rn FROM pre) SELECT row_idx, col AS \"column\", chk AS \"check\" FROM ranked ORDER BY rn, col, chk LIMIT 40",
    lambda df: validate.sample(validate.validated(df, POLICY)).select("row_idx", "column", "check"),
)
query(
    "pre_post_delta",
    f"{duck.events(POLICY)}, {duck.rules(POLICY, 'dirty', 'pre')}, {duck.rules(POLICY, 'out_rows', 'post')}, a AS (SELECT col || '.' || chk AS rule, count(*) AS n FROM pre GROUP BY 1), b AS (SELECT col || '.' || chk AS rule, count(*) AS n FROM post GROUP BY 1) SELECT rule, coalesce(a.n, 0) AS pre, coalesce(b.n, 0) AS post, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL JOIN b USING (rule)",
)(lambda spark, sf_dir: validate.delta(validate.by_rule(validate.validated(dirty(spark, sf_dir), POLICY)), validate.by_rule(validate.validated(clean.cleaned(assessed(spark, sf_dir), POLICY), POLICY)), "rule", "failures"))

# masking and privacy ----------------------------------------------------------------------

_T = {c: f"{duck.strip(f'coalesce({c}, {chr(39)}{chr(39)})')}" for c in COLUMNS}
_MASKS = {
    "first_name": f"CASE WHEN {_T['first_name']} = '' THEN '' ELSE upper(left({_T['first_name']}, 1)) || '***' END",
    "last_name": f"CASE WHEN {_T['last_name']} = '' THEN '' ELSE upper(left({_T['last_name']}, 1)) || '***' END",
    "email": f"CASE WHEN NOT contains({_T['email']}, '@') THEN '***' WHEN starts_with({_T['email']}, '***@') THEN {_T['email']} ELSE CASE WHEN starts_with({_T['email']}, '@') THEN '' ELSE lower(left({_T['email']}, 1)) END || '***@' || substr({_T['email']}, strpos({_T['email']}, '@') + 1) END",
    "phone": f"CASE WHEN length({duck.digits(_T['phone'])}) >= 4 THEN '***-***-' || right({duck.digits(_T['phone'])}, 4) ELSE '***-***-****' END",
    "address": duck.quoted(POLICY.placeholder),
}
for _c in ("date_of_birth", "created_date"):
    _MASKS[_c] = rf"CASE WHEN regexp_full_match({_T[_c]}, '(\d{{4}}|\*{{4}})-\*\*-\*\*') THEN {_T[_c]} WHEN regexp_full_match({_T[_c]}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN left({_T[_c]}, 4) || '-**-**' ELSE '****-**-**' END"


def _band(x: str) -> str:
    w = POLICY.band_width
    return f"CAST(floor({x} / {w})::BIGINT * {w} AS STRING) || '-' || CAST(floor({x} / {w})::BIGINT * {w} + {w - 1} AS STRING)"


def _income_mask(t: str) -> str:
    return rf"CASE WHEN regexp_full_match({t}, '\d+-\d+') OR {t} = 'unknown' THEN {t} WHEN {duck.number(t)} IS NOT NULL THEN {_band(duck.number(t))} ELSE 'unknown' END"


_MASKS["income"] = _income_mask(_T["income"])
for _rule in POLICY.mask_rules:
    on_dirty(f"mask_{_rule.column}", f"{DUCK} SELECT row_idx, {_MASKS[_rule.column]} AS masked FROM dirty", lambda df, r=_rule: df.select("row_idx", masks.strategy(POLICY, r.strategy)(r.column).alias("masked")))
on_customers("mask_balance_band", f"SELECT c_custkey, {_band('c_acctbal')} AS band FROM customer", lambda df: df.select("c_custkey", values.band("c_acctbal", POLICY.band_width).alias("band")))
_OUT_MASKED = ", ".join((_MASKS[c].replace("coalesce(income, '')", "coalesce(CAST(income AS STRING), '')") if c in _MASKS else c) + f" AS {c}" for c in COLUMNS)
on_assessed("masked_extract", f" SELECT row_idx, {_OUT_MASKED} FROM out_rows", lambda a: mask.apply_masks(clean.cleaned(a, POLICY), POLICY))
on_assessed(
    "record_pairs",
    f", m AS (SELECT row_idx, {_OUT_MASKED} FROM out_rows) SELECT o.row_idx, o.email AS before, m.email AS after FROM out_rows o JOIN m USING (row_idx) ORDER BY row_idx LIMIT 6",
    lambda a: (lambda c: c.select("row_idx", F.col("email").alias("before")).join(mask.apply_masks(c, POLICY).select("row_idx", F.col("email").alias("after")), "row_idx").orderBy("row_idx").limit(6))(clean.cleaned(a, POLICY)),
)


def _signature(names: list[str], source: str) -> str:
    parts = []
    for n in names:
        t = f"coalesce(CAST({n} AS STRING), 'nan')"
        if n == "address_postal":
            parts.append(r"coalesce(nullif(regexp_extract(coalesce(address, 'nan'), '\b(\d{5})(?:-\d{4})?\b', 1), ''), '?')")
        elif n == "income":
            x = duck.number(duck.unsigned(duck.strip(t)))
            parts.append(rf"CASE WHEN regexp_full_match({duck.strip(t)}, '\d+-\d+') THEN {duck.strip(t)} WHEN {x} IS NOT NULL THEN {_band(x)} ELSE '?' END")
        else:
            parts.append(t)
    return f"SELECT [{', '.join(parts)}] AS signature FROM {source}"


def _buckets(signed: str) -> str:
    return f"SELECT CASE WHEN n = 1 THEN 'k=1 (unique)' WHEN n = 2 THEN 'k=2' WHEN n <= 5 THEN 'k=3-5' ELSE 'k>5' END AS band, sum(n)::BIGINT AS rows FROM (SELECT count(*) AS n FROM ({signed}) GROUP BY signature) GROUP BY 1"


on_dirty("k_anonymity_raw", f"{DUCK} {_buckets(_signature(POLICY.quasi_before, 'dirty'))}", lambda df: privacy.k_buckets(privacy.signatures(df, POLICY.quasi_before, POLICY)))
on_assessed("k_anonymity_before", " " + _buckets(_signature(POLICY.quasi_before, "out_rows")), lambda a: privacy.k_buckets(privacy.signatures(clean.cleaned(a, POLICY), POLICY.quasi_before, POLICY)))
on_assessed("k_anonymity_after", f", m AS (SELECT row_idx, {_OUT_MASKED} FROM out_rows) " + _buckets(_signature(POLICY.quasi_after, "m")), lambda a: privacy.k_buckets(privacy.signatures(mask.apply_masks(clean.cleaned(a, POLICY), POLICY), POLICY.quasi_after, POLICY)))
on_dirty("incomplete_share", f"{DUCK} SELECT avg(list_contains(signature, '?')::INT)::DOUBLE AS share FROM ({_signature(POLICY.quasi_before, 'dirty')})", lambda df: privacy.incomplete_share(privacy.signatures(df, POLICY.quasi_before, POLICY)))
on_customers(
    "k_anonymity_customers",
    _buckets(f"SELECT [CAST(c_nationkey AS STRING), c_mktsegment, {_band('c_acctbal')}] AS signature FROM customer"),
    lambda df: privacy.k_buckets(df.select(F.array(F.col("c_nationkey").cast("string"), "c_mktsegment", values.band("c_acctbal", POLICY.band_width)).alias("signature"))),
)

# scoring ----------------------------------------------------------------------------------

#: Rows of the dirty table in which a defect is planted: those its CASE puts it in.
PLANTED = {
    "phone_unparseable": ("phone", "(row_idx + 1) % 19 IN (5, 6, 7)"),
    "phone_nonstandard_format": ("phone", "(row_idx + 1) % 19 IN (0, 1, 2, 3, 4)"),
    "email_malformed": ("email", "(row_idx + 1) % 31 IN (1, 2, 3, 4, 8)"),
    "income_negative": ("income", "(row_idx + 1) % 41 = 5"),
    "missing_income": ("income", "(row_idx + 1) % 41 IN (3, 4)"),
    "status_invalid": ("account_status", "(row_idx + 1) % 43 IN (0, 1, 2, 3, 4, 5, 6, 8)"),
    "address_too_short": ("address", "(row_idx + 1) % 37 IN (0, 1)"),
    "pii_leaked_in_address": ("address", "(row_idx + 1) % 37 IN (4, 5, 6, 8)"),
}


def _planted(df: DataFrame) -> DataFrame:
    rows = None
    for name, (column, where) in PLANTED.items():
        part = df.where(where).select(F.lit(name).alias("defect"), F.lit(column).alias("column"), "row_idx")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _score_sql() -> str:
    planted = " UNION ALL ".join(f"SELECT '{d}' AS defect, '{c}' AS col, row_idx FROM dirty WHERE {w}" for d, (c, w) in PLANTED.items())
    kind = "CASE defect " + " ".join(f"WHEN '{d}' THEN '{score.EXPECTED[d][0]}'" for d in PLANTED) + " END"
    key = "CASE defect " + " ".join(f"WHEN '{d}' THEN '{score.EXPECTED[d][1]}'" for d in PLANTED) + " END"
    return f"""{duck.events(POLICY)}, hit AS ({duck.hits('dirty', COLUMNS, 'row_idx')}),
planted AS (SELECT *, {kind} AS kind, {key} AS key FROM ({planted})),
marked AS (SELECT p.*,
  EXISTS (SELECT 1 FROM hit WHERE hit.row_idx = p.row_idx AND {duck.leaks()}) AS leaked,
  EXISTS (SELECT 1 FROM rejection r WHERE r.row_idx = p.row_idx AND r.col = p.col) OR EXISTS (SELECT 1 FROM repair r WHERE r.row_idx = p.row_idx AND r.col = p.col) AS touched,
  EXISTS (SELECT 1 FROM rejection r WHERE r.row_idx = p.row_idx AND r.reason = p.key) AS rejected_so,
  EXISTS (SELECT 1 FROM repair r WHERE r.row_idx = p.row_idx AND r.tag = p.key) AS repaired_so,
  EXISTS (SELECT 1 FROM rejection r WHERE r.row_idx = p.row_idx) AS rejected,
  EXISTS (SELECT 1 FROM repair r WHERE r.row_idx = p.row_idx AND r.col = p.col) AS repaired
FROM planted p)
SELECT defect, col AS "column", count(*) AS planted, count(*) FILTER (CASE WHEN kind = 'pii_leak' THEN leaked ELSE touched END) AS handled,
  count(*) FILTER (CASE kind WHEN 'pii_leak' THEN leaked WHEN 'rejection' THEN rejected_so WHEN 'repair' THEN repaired_so ELSE touched END) AS attributed,
  count(*) FILTER (NOT rejected AND NOT repaired) AS escaped
FROM marked GROUP BY ALL"""


_RATIOS = "handled::DOUBLE / planted AS recall, attributed::DOUBLE / planted AS attribution, 1 - escaped::DOUBLE / planted AS containment"


@query("score_defects", f"SELECT row_number() OVER (ORDER BY recall, attribution, defect)::INT AS place, * FROM (SELECT *, {_RATIOS} FROM ({_score_sql()}))")
def score_defects(spark, sf_dir):
    return _placed(_scores(spark, sf_dir), "place")


@query("score_totals", f"SELECT sum(planted)::BIGINT AS planted, sum(handled)::BIGINT AS handled, sum(attributed)::BIGINT AS attributed, sum(escaped)::BIGINT AS escaped, round(avg(handled::DOUBLE / planted), 9) AS macro_recall, round(avg(attributed::DOUBLE / planted), 9) AS macro_attribution, sum(handled)::DOUBLE / sum(planted) AS recall, sum(attributed)::DOUBLE / sum(planted) AS attribution, 1 - sum(escaped)::DOUBLE / sum(planted) AS containment FROM ({_score_sql()})")
def score_totals(spark, sf_dir):
    return score.totals(_scores(spark, sf_dir)).withColumns({c: F.round(c, 9) for c in ("macro_recall", "macro_attribution")})


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dirty(spark, sf_dir)
    return score.per_defect(_planted(df), clean.assess(df, POLICY), detect.hits(df, COLUMNS))


@query("score_specificity", f"{duck.events(POLICY)}, planted AS ({' UNION ALL '.join(f'SELECT row_idx FROM dirty WHERE {w}' for _, w in PLANTED.values())}), fine AS (SELECT row_idx FROM n WHERE row_idx NOT IN (SELECT row_idx FROM planted)) SELECT count(*) AS clean_rows, count(*) FILTER (row_idx IN (SELECT row_idx FROM rejection)) AS falsely_quarantined FROM fine")
def score_specificity(spark, sf_dir):
    df = dirty(spark, sf_dir)
    return score.specificity(_planted(df), clean.assess(df, POLICY))


# generator and run ------------------------------------------------------------------------

SEED = 42


@query(
    "generated_defects",
    "SELECT defect, \"column\", round_even((SELECT count(*) FROM customer) * rate, 0)::BIGINT AS planted FROM (VALUES "
    + ", ".join(f"('{d}', '{c}', {rate}::DOUBLE)" for d, (c, rate) in generate.RATES.items())
    + ") t(defect, \"column\", rate)",
)
def generated_defects(spark, sf_dir):
    """Defects planted in a made table of as many rows as ``customer`` has."""
    planted = generate.generate(spark, table(spark, sf_dir, "customer").count(), SEED, POLICY.today)[1]
    return planted.groupBy("defect", "column").agg(F.count("*").alias("planted"))


_STAGES = "load profile detect_pii validate_pre clean validate_post publish mask verify_release publish_masked".split()


@query(
    "governed_run",
    f"""{duck.events(POLICY)}, size AS (SELECT count(*) AS n, count(*) - (SELECT count(DISTINCT row_idx) FROM rejection) AS m FROM n)
SELECT stage, CASE WHEN stage = 'load' THEN 0 WHEN place <= 5 THEN n ELSE m END AS rows_in, CASE WHEN place <= 4 THEN n ELSE m END AS rows_out, 'ok' AS status
FROM size, (VALUES {', '.join(f"({i}, '{x}')" for i, x in enumerate(_STAGES, 1))}) t(place, stage)""",
)
def governed_run(spark, sf_dir):
    """The whole run over the dirty table, written as CSV and read again: its stages, gates passed."""
    root = io.scratch_dir(spark)
    try:
        result = run.run(spark, _raw_csv(spark, sf_dir, root), out=f"{root}/out", reports=f"{root}/reports")
        if result.error:
            raise RuntimeError(result.error)
        rows = [(s.name, s.rows_in, s.rows_out, s.status) for s in result.stages]
    finally:
        io.remove(spark, root)
    return spark.createDataFrame(rows, "stage string, rows_in long, rows_out long, status string")


def _raw_csv(spark: SparkSession, sf_dir: str, root: str) -> str:
    io.write_csv(dirty(spark, sf_dir).orderBy("row_idx").drop("row_idx"), f"{root}/customers_raw.csv")
    return f"{root}/customers_raw.csv"


@query("published_rows", duck.events(POLICY) + f" SELECT {', '.join(c + '::STRING AS ' + c if c == 'customer_id' else c for c in COLUMNS if c != 'income')} FROM out_rows")
def published_rows(spark, sf_dir):
    """The cleaned table as a reader of the published CSV finds it; amounts are compared where they are made."""
    root = io.scratch_dir(spark)
    raw = io.load_raw(spark, _raw_csv(spark, sf_dir, root))
    io.write_csv(clean.cleaned(clean.assess(raw, POLICY), POLICY).select(*COLUMNS), f"{root}/out")
    return io.load_raw(spark, f"{root}/out").select(*[c for c in COLUMNS if c != "income"])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detectors over all free text of the tables."""
    return detect_rows(spark, sf_dir)
