"""The governed run: ten stages, two gates, nothing lost and nothing published unchecked."""

from __future__ import annotations

import contextlib
import datetime as dt
import logging
import os
import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import policy as policies
from sluice.functions.text import redact
from sluice.operators import clean, detect, mask, privacy, profile, validate
from sluice.plans import report
from sluice.policy import Policy
from sluice.sources import io

log = logging.getLogger("sluice")

#: What a run may leave, and so what is taken away before one.
TABLES = {"cleaned": "customers_cleaned.csv", "masked": "customers_masked.csv", "quarantine": "quarantine.csv"}
REPORTS = ("data_quality_report.txt", "pii_detection_report.txt", "cleaning_log.txt", "validation_results.txt", "masked_sample.txt", "pipeline_execution_report.txt")


class GateError(RuntimeError):
    """What was to be published did not pass."""


@dataclass
class Stage:
    name: str
    rows_in: int = 0
    rows_out: int = 0
    seconds: float = 0.0
    status: str = "ok"
    detail: str = ""


@dataclass
class RunResult:
    started: str
    stages: list[Stage] = field(default_factory=list)
    outputs: dict[str, int] = field(default_factory=dict)
    artifacts: list[str] = field(default_factory=list)
    error: str = ""

    @property
    def ok(self) -> bool:
        return not self.error

    @property
    def seconds(self) -> float:
        return sum(s.seconds for s in self.stages)


@contextlib.contextmanager
def stage(result: RunResult, name: str, rows_in: int):
    """Times a stage and records how it ended; errors go on. Actions belong inside, or their time falls elsewhere."""
    s, began = Stage(name, rows_in, rows_in), time.perf_counter()
    result.stages.append(s)
    try:
        yield s
    except Exception:
        s.status = "FAILED"
        raise
    finally:
        s.seconds = time.perf_counter() - began
        log.info("%s: %s, %.2f s %s", name, s.status, s.seconds, s.detail)


def structure_problem(columns: list[str], pol: Policy) -> str:
    """Why a table cannot be worked on, or nothing."""
    missing, unexpected = profile.drift(columns, pol)
    if missing:
        return f"missing columns: {', '.join(missing)}"
    if unexpected and pol.unexpected == "fail":
        return f"unexpected columns: {', '.join(unexpected)}"
    return ""


def quality_report(raw: DataFrame, pol: Policy, p: report.Provenance) -> tuple[str, int]:
    columns = [c for c in raw.columns if c != "row_idx"]
    missing, unexpected = profile.drift(columns, pol)
    complete = report.rows(profile.completeness(raw, columns))
    duplicates, repeated, invalid, shown, inventories, statuses, all_statuses = (0, 0), [], [], {}, {}, [], (0, 0, 0)
    if "customer_id" in columns:
        by = profile.duplicate_ids(raw)
        duplicates = tuple(profile.surplus(by).first())
        repeated = report.rows(by.orderBy(F.desc("occurrences"), "id").limit(10).select(redact("id"), "occurrences"))
    if not {"date_of_birth", "created_date", "income"} & set(missing):
        invalid = report.rows(profile.invalid_values(raw, pol))
        checks = profile.invalid_checks(pol)
        for name, n in invalid:
            if n:
                predicate, value, k, ordered = checks[name]
                hide = any(c in name for c in pol.sensitive)
                value = value.cast("string")
                shown[name] = [r[0] for r in profile.examples(raw.where(F.coalesce(predicate, F.lit(False))), redact(value) if hide else value, k, ordered=ordered).collect()]
    inventories = {c: report.rows(profile.format_inventory(raw, c)) for c in profile.INVENTORIED if c in columns}
    if "account_status" in columns:
        by = profile.histogram(raw, "account_status")
        statuses = report.rows(by.limit(50))
        rows_of = lambda which: F.coalesce(F.sum(F.when(which, F.col("rows"))), F.lit(0))
        all_statuses = tuple(by.agg(F.count("*"), rows_of(F.lit(True)), rows_of(~F.col("value").isin(*pol.statuses))).first())
    return report.quality(p, dict(raw.select(*columns).dtypes), missing, unexpected, complete, duplicates, repeated, inventories, invalid, shown, statuses, all_statuses), sum(n for _, n in invalid)


def pii_report(raw: DataFrame, pol: Policy, p: report.Provenance) -> tuple[str, int, int]:
    columns = [c for c in raw.columns if c != "row_idx"]
    found = detect.hits(raw, columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        findings = [r.asDict() for r in detect.findings(found, columns).collect()]
        rate = tuple(detect.confirmation_rate(found).first())
        leaked = detect.leak_rows(found).first()[0]
        worst = detect.worst_leak(found).first()
        affected = {(r["column"], r["detector"]): r["rows"] for r in detect.leak_places(found, 6).collect()}
        signed = privacy.signatures(raw, [q for q in pol.quasi_before if q in columns or (q == "address_postal" and "address" in columns)], pol)
        bands, share = dict(report.rows(privacy.k_buckets(signed))), privacy.incomplete_share(signed).first()[0]
    finally:
        found.unpersist()
    return report.pii(p, findings, rate, leaked, affected, tuple(worst) if worst else None, bands, share), sum(f["suppressed"] is None for f in findings), leaked


def validation_report(pre: DataFrame, post: DataFrame | None, pol: Policy, p: report.Provenance) -> str:
    rules, coercion = validate.by_rule(pre), validate.coercion_by_column(pre)
    none_rule, none_column = rules.limit(0), coercion.limit(0)
    deltas = report.rows(validate.delta(rules, validate.by_rule(post) if post is not None else none_rule, "rule", "failures").orderBy(F.desc("pre"), "rule"))
    coerced = report.rows(validate.delta(coercion, validate.coercion_by_column(post) if post is not None else none_column, "column", "uncoercible").orderBy(F.desc("pre"), "column"))
    failing = validate.failing_rows(pre).first()[0], validate.failing_rows(post).first()[0] if post is not None else 0
    hidden = F.when(F.col("column").isin(*pol.sensitive), redact("value")).otherwise(F.left("value", F.lit(44)))
    sample = report.rows(validate.sample(pre).select("row_idx", "column", "check", hidden))
    return report.validation(p, coerced, deltas, failing, sample)


def cleaning_report(assessed: DataFrame, pol: Policy, p: report.Provenance) -> str:
    return report.cleaning(p, report.rows(clean.frequency(clean.repairs(assessed), "tag")), report.rows(clean.frequency(clean.rejections(assessed), "reason")), tuple(clean.reconciliation(assessed).first()), tuple(clean.policy_sensitivity(assessed, pol.non_critical).first()))


def masked_report(df: DataFrame, masked: DataFrame, pol: Policy, p: report.Provenance) -> tuple[str, dict, dict]:
    before, after = (dict(report.rows(x)) for x in mask.risk(df, masked, pol))
    shares = tuple(privacy.incomplete_share(privacy.signatures(x, q, pol)).first()[0] for x, q in ((df, pol.quasi_before), (masked, pol.quasi_after)))
    both = df.select("row_idx", F.struct(*pol.columns).alias("a")).join(masked.select("row_idx", F.struct(*pol.columns).alias("b")), "row_idx").orderBy("row_idx").limit(6).collect()
    return report.masked_sample(p, [(r["a"].asDict(), r["b"].asDict()) for r in both], before, after, shares), before, after


def reconcile(assessed: DataFrame) -> tuple[int, int, int]:
    rows_in, rows_out, aside, balances = clean.reconciliation(assessed).first()
    if not balances:
        raise GateError(f"{rows_in} rows in, {rows_out} cleaned and {aside} quarantined do not balance")
    return rows_in, rows_out, aside


def run(spark: SparkSession, source: str, rules: str | None = None, out: str = "data", reports: str = "reports", multi_line: bool | None = None) -> RunResult:
    """Load, profile, detect, validate, clean, validate again, publish, mask, re-scan, publish the masked.

    The cleaned table is written only if it passes its own rules, the masked one only
    if no direct identifier is found in it; what an earlier run left is taken away
    first. The assessed table is kept for the actions that share it. A report of the
    run is written however it ends; its error is in the result.
    """
    result = RunResult(dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
    paths = {k: os.path.join(out, v) for k, v in TABLES.items()}
    for path in (*paths.values(), *(os.path.join(reports, r) for r in REPORTS)):
        io.remove(spark, path)
    kept: list[DataFrame] = []
    pol: Policy | None = None
    p: report.Provenance | None = None

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def write(name: str, text: str) -> None:
        result.artifacts.append(io.write_text(spark, os.path.join(reports, name), text))

    def publish(df: DataFrame, key: str) -> None:
        io.write_csv(df, paths[key])
        result.artifacts.append(paths[key])

    try:
        with stage(result, "load", 0) as s:
            pol = policies.load(rules or policies.DEFAULT)
            raw = keep(io.load_raw(spark, source, multi_line))
            n = s.rows_out = raw.count()
            p = report.Provenance(source, io.fingerprint(spark, source), n, pol)
            missing, unexpected = profile.drift(raw.columns, pol)
            result.outputs["unexpected_columns"] = len(unexpected)
            if problem := structure_problem(raw.columns, pol):
                raise GateError(problem)
            s.detail = f"{len(raw.columns) - 1} columns"
        with stage(result, "profile", n) as s:
            text, issues = quality_report(raw, pol, p)
            write("data_quality_report.txt", text)
            result.outputs["quality_issues"], s.detail = issues, f"{issues} invalid values"
        with stage(result, "detect_pii", n) as s:
            text, kinds, leaked = pii_report(raw, pol, p)
            write("pii_detection_report.txt", text)
            result.outputs |= {"pii_findings": kinds, "pii_leaks": leaked}
            s.detail = f"{kinds} findings, {leaked} leaked rows"
        with stage(result, "validate_pre", n) as s:
            pre = keep(validate.validated(raw, pol))
            _, failures, uncoercible = validate.failing_rows(pre).first()
            result.outputs |= {"failures_pre": failures, "coercion_pre": uncoercible}
            s.detail = f"{failures} rule failures, {uncoercible} uncoercible"
        with stage(result, "clean", n) as s:
            assessed = keep(clean.assess(raw, pol))
            _, m, aside = reconcile(assessed)
            publish(clean.quarantine(assessed, pol.sensitive), "quarantine")
            write("cleaning_log.txt", cleaning_report(assessed, pol, p))
            repairs = assessed.agg(F.coalesce(F.sum(F.size("repairs")), F.lit(0))).first()[0]
            result.outputs |= {"repairs": repairs, "quarantined": aside}
            s.rows_out, s.detail = m, f"{aside} quarantined, reconciled"
        with stage(result, "validate_post", m) as s:
            cleaned = clean.cleaned(assessed, pol)
            post = keep(validate.validated(cleaned, pol))
            _, failures, uncoercible = validate.failing_rows(post).first()
            result.outputs |= {"failures_post": failures, "coercion_post": uncoercible}
            write("validation_results.txt", validation_report(pre, post, pol, p))
            s.detail = f"{failures} rule failures, {uncoercible} uncoercible"
        with stage(result, "publish", m) as s:
            if failures or uncoercible:
                raise GateError(f"the cleaned table fails {failures} rules and has {uncoercible} values that will not convert; it is not published")
            publish(cleaned.select(*pol.columns), "cleaned")
            s.detail = "passes its rules"
        with stage(result, "mask", m) as s:
            masked = keep(mask.apply_masks(cleaned, pol))
            text, before, after = masked_report(cleaned, masked, pol, report.Provenance(p.source, p.digest, m, pol))
            one = privacy.BANDS[0]
            result.outputs |= {"unique_before": before.get(one, 0), "unique_after": after.get(one, 0)}
            s.detail = f"unique {before.get(one, 0)} -> {after.get(one, 0)}"
        with stage(result, "verify_release", m) as s:
            left = detect.residual(masked).count()
            result.outputs["residual_identifiers"] = left
            if left:
                raise GateError(f"{left} direct identifiers are left in the masked table; it is not published")
            s.detail = "no direct identifier left"
        with stage(result, "publish_masked", m) as s:
            publish(masked.select(*pol.columns), "masked")
            write("masked_sample.txt", text)
            s.detail = "checked before writing"
    except (GateError, policies.PolicyError, ValueError, OSError) as e:
        result.error = str(e)
    finally:
        for df in kept:
            df.unpersist()
    if p is not None:
        write("pipeline_execution_report.txt", report.execution(p, result))
    return result
