"""Text reports, rendered on the driver from small aggregates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sluice.operators import detect, privacy
from sluice.operators.profile import LABELS
from sluice.policy import Policy

VERSION = "0.1.0"
WIDE, THIN = "=" * 78, "-" * 78


@dataclass(frozen=True)
class Provenance:
    source: str
    digest: str
    rows: int
    policy: Policy
    made: str = ""

    def head(self, title: str) -> list[str]:
        made = self.made or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        pinned = "pinned" if self.policy.pinned else "today"
        facts = (("Source", self.source), ("SHA256", self.digest), ("Rows", f"{self.rows:,}"), ("Generated", made), ("Pipeline", f"v{VERSION}"), ("Rules", f"v{self.policy.version}"), ("Reference", f"{self.policy.today} ({pinned})"))
        return [WIDE, title, WIDE, *(f"{k:<11}: {v}" for k, v in facts), ""]


def section(n: int | str, title: str) -> list[str]:
    return [THIN, f"{n}. {title}" if n else title, THIN]


def grid(head: tuple, rows: list[tuple], widths: tuple) -> list[str]:
    """Columns of fixed width, numbers to the right."""
    line = lambda cells: "  ".join(f"{c:>{w}}" if isinstance(c, (int, float)) else f"{str(c):<{w}}" for c, w in zip(cells, widths)).rstrip()
    return [line(head), *(line(r) for r in rows)]


def pct(part: float, whole: float) -> float:
    return 100 * part / whole if whole else 0.0


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def quality(p: Provenance, dtypes: dict, missing: list, unexpected: list, complete: list, duplicates: tuple, repeated: list, inventories: dict, invalid: list, examples: dict, statuses: list, all_statuses: tuple[int, int, int]) -> str:
    """``all_statuses``: status values, their rows, and the rows of those not permitted, of which ``statuses`` may list the commonest only."""
    pol = p.policy
    out = p.head("DATA QUALITY REPORT") + section(1, "SCHEMA CONFORMANCE")
    out += [f"Missing columns    : {', '.join(missing) or 'none'}", f"Unexpected columns : {', '.join(unexpected) or 'none'}", ""]
    verdict = lambda c: "unexpected" if c not in pol.schema else "as expected" if pol.schema[c]["dtype"] == "str" else "needs coercion"
    out += grid(("COLUMN", "READ AS", "EXPECTED", "VERDICT"), [(c, t, LABELS.get(pol.schema.get(c, {}).get("dtype"), "unexpected column"), verdict(c)) for c, t in dtypes.items()], (18, 8, 18, 16))
    out += ["", *section(2, "COMPLETENESS"), *grid(("COLUMN", "NULL", "SENTINEL", "MISSING", "PCT"), [(c, nulls, s, m, f"{x:.2f}%") for c, _n, nulls, s, m, x in complete], (18, 8, 9, 9, 8))]
    ids, surplus = duplicates
    out += ["", *section(3, "UNIQUENESS"), f"customer_id unique      : {'NO' if ids else 'yes'}", f"Distinct ids duplicated : {ids}", f"Surplus rows            : {surplus}"]
    if repeated:
        out.append("Examples (id x rows)    : " + ", ".join(f"{i} x{n}" for i, n in repeated))
    out += ["", *section(4, "FORMAT INVENTORY")]
    for c, shapes in inventories.items():
        hide = c in pol.sensitive
        out += [f"{c}  ({len(shapes)} shapes)", *grid(("  SHAPE", "ROWS", "EXAMPLE"), [(f"  {s}", n, "[redacted]" if hide else e) for s, n, e in shapes], (28, 8, 30)), ""]
    out += section(5, "INVALID VALUES") + grid(("CHECK", "ROWS", "EXAMPLES"), [(c, n, ", ".join(map(str, examples.get(c, [])))[:60]) for c, n in invalid], (34, 8, 60))
    values, valued, bad = all_statuses
    more = [f"Not listed: {values - len(statuses):,} rarer values in {valued - sum(n for _, n in statuses):,} rows"] if values > len(statuses) else []
    out += ["", *section(6, "CATEGORICAL VALIDITY - account_status"), f"Permitted: {', '.join(pol.statuses)}", *grid(("VALUE", "ROWS", "STATUS"), [(repr(v), n, "valid" if v in pol.statuses else "INVALID") for v, n in statuses], (20, 8, 8)), *more, f"Invalid total: {bad} rows ({pct(bad, p.rows):.2f}%)"]
    worst = max(complete, key=lambda r: r[4], default=None)
    out += ["", *section("", "SUMMARY"), f"Rows profiled            : {p.rows:,}", f"Columns with missing data: {sum(r[4] > 0 for r in complete)}"]
    if worst:
        out.append(f"Least complete column    : {worst[0]} ({worst[5]:.2f}% missing)")
    out += [f"Invalid-value findings   : {sum(n for _, n in invalid)}", f"Additional format shapes : {sum(max(0, len(s) - 1) for s in inventories.values())}"]
    return "\n".join(out) + "\n"


def pii(p: Provenance, findings: list[dict], rate: tuple, leak_rows: int, affected: dict, worst: tuple | None, bands: dict, incomplete: float) -> str:
    out = p.head("PII DETECTION REPORT") + section(1, "DECLARED INVENTORY") + grid(("COLUMN", "CLASSIFICATION", "SENS"), list(detect.INVENTORY), (18, 18, 8))
    personal = sum(kind != "non-PII" for _, kind, _ in detect.INVENTORY)
    out += ["", f"{personal} of {len(detect.INVENTORY)} columns carry personal data.", "", *section(2, "PATTERNS APPLIED"), *grid(("DETECTOR", "CLASSIFICATION", "SENS"), [(d.name, d.category, d.sensitivity) for d in detect.DETECTORS], (14, 18, 8))]
    sure, aside = [f for f in findings if f["suppressed"] is None], [f for f in findings if f["suppressed"] is not None]
    out += ["", *section(3, "CONFIRMED MATCHES"), *grid(("COLUMN", "DETECTOR", "ROWS", "MATCHES", "SAMPLE (redacted)"), [(f["column"], f["detector"], f["row_count"], f["match_count"], (f["samples"] or [""])[0]) for f in sure], (15, 13, 8, 8, 44))]
    out += ["", *section(4, "SUPPRESSED MATCHES"), *grid(("COLUMN", "DETECTOR", "ROWS", "REASON"), [(f["column"], f["detector"], f["row_count"], f["suppressed"]) for f in aside], (15, 13, 8, 50))]
    raw, kept, share = rate
    out += ["", f"Raw hits {raw:,} -> confirmed {kept:,} ({share:.1f}%)", "", *section(5, "LEAKED IDENTIFIERS"), *grid(("COLUMN", "DETECTOR", "FIRST ROWS"), [(c, d, r) for (c, d), r in affected.items()], (15, 13, 50)), "", f"Total: {leak_rows} distinct rows."]
    if worst:
        out.append(f"Highest severity: {worst[1]} in {worst[0]} ({worst[2]}).")
    out += ["", *section(6, "BREACH EXPOSURE"), f"Records containing personal data : {p.rows:,} of {p.rows:,} ({pct(p.rows, p.rows):.1f}%)", ""]
    out += section(7, "RE-IDENTIFICATION RISK") + [f"Quasi-identifiers modelled: {', '.join(p.policy.quasi_before)}", f"Signatures with an unparseable part: {100 * incomplete:.1f}%", ""]
    out += grid(("GROUP SIZE", "ROWS", "PCT"), [(b, bands[b], f"{pct(bands[b], p.rows):.1f}%") for b in privacy.BANDS if b in bands], (16, 8, 8))
    return "\n".join(out) + "\n"


def validation(p: Provenance, coercion: list, rules: list, failing: tuple[int, int], sample: list) -> str:
    total = lambda xs: ("TOTAL", sum(x[1] for x in xs), sum(x[2] for x in xs), sum(x[3] for x in xs))
    out = p.head("VALIDATION RESULTS") + section(1, "RULES APPLIED") + [f"{c}: {', '.join(k for k in p.policy.checks(c))}" for c in p.policy.columns]
    out += ["", *section(2, "TYPE COERCION"), *grid(("COLUMN", "PRE", "POST", "DELTA"), [*coercion, total(coercion)], (44, 8, 8, 8))]
    out += ["", *section(3, "RULE FAILURES"), *grid(("RULE", "PRE", "POST", "DELTA"), [*rules, total(rules)], (44, 8, 8, 8)), "", f"Rows failing : {failing[0]:,} -> {failing[1]:,}"]
    out += ["", *section(4, "FAILURE DETAIL - PRE-CLEAN"), *grid(("ROW", "COLUMN", "CHECK", "VALUE"), sample, (8, 15, 26, 44))]
    return "\n".join(out) + "\n"


def cleaning(p: Provenance, repairs: list, reasons: list, counts: tuple, sensitivity: tuple) -> str:
    rows_in, rows_out, aside, balances = counts
    _, recoverable, kept, optional = sensitivity
    out = p.head("CLEANING LOG") + section(1, "NORMALISATIONS APPLIED") + grid(("REPAIR", "ROWS"), [*repairs, ("TOTAL", sum(n for _, n in repairs))], (32, 8))
    out += ["", *section(2, "QUARANTINE"), *grid(("REASON", "ROWS"), reasons, (32, 8)), f"Distinct rows quarantined: {aside:,}"]
    out += ["", *section(3, "RECONCILIATION"), *grid(("", ""), [("Rows in", rows_in), ("Rows cleaned", rows_out), ("Rows quarantined", aside), ("Balance", rows_out + aside)], (24, 10)), "OK" if balances else "MISMATCH", f"Retention: {100 * kept:.1f}%"]
    out += ["", *section(4, "POLICY SENSITIVITY"), f"Treated as optional: {', '.join(sorted(p.policy.non_critical))}", f"Failing only on a blank optional field: {recoverable}", f"Retention if those were kept: {100 * optional:.1f}%"]
    return "\n".join(out) + "\n"


def masked_sample(p: Provenance, pairs: list[tuple[dict, dict]], before: dict, after: dict, incomplete: tuple[float, float]) -> str:
    ruled = {r.column for r in p.policy.mask_rules}
    out = p.head("MASKED SAMPLE - BEFORE / AFTER") + ["Shows unmasked values, as evidence of what masking does: handle as the source.", ""]
    out += section(1, "MASKING RULES") + grid(("COLUMN", "STRATEGY", "RULE", "RATIONALE"), [(r.column, r.strategy, r.description, r.rationale) for r in p.policy.mask_rules], (15, 12, 34, 60))
    out += [f"Untouched: {', '.join(p.policy.unmasked)}", "", *section(2, "RECORDS")]
    for i, (a, b) in enumerate(pairs, 1):
        out += [f"Record {i}", *grid(("  FIELD", "BEFORE", "AFTER"), [(("* " if c in ruled else "  ") + c, str(a[c])[:38], str(b[c])) for c in p.policy.columns], (18, 40, 40)), ""]
    out += section(3, "RE-IDENTIFICATION AFTER MASKING") + [f"Before : {', '.join(p.policy.quasi_before)} (unparseable part in {100 * incomplete[0]:.1f}%)", f"After  : {', '.join(p.policy.quasi_after)} (unparseable part in {100 * incomplete[1]:.1f}%)", ""]
    out += grid(("GROUP SIZE", "BEFORE", "AFTER"), [(b, before.get(b, 0), after.get(b, 0)) for b in privacy.BANDS], (16, 8, 8))
    one = privacy.BANDS[0]
    out += ["", f"Uniquely re-identifiable: {pct(before.get(one, 0), p.rows):.1f}% -> {pct(after.get(one, 0), p.rows):.1f}%"]
    return "\n".join(out) + "\n"


#: What each figure of a run is called.
OUTCOMES = {
    "quality_issues": "Invalid values found",
    "pii_findings": "Kinds of personal data confirmed",
    "pii_leaks": "Rows with leaked identifiers",
    "failures_pre": "Rule failures before cleaning",
    "coercion_pre": "Values that would not convert, before",
    "repairs": "Values normalised",
    "quarantined": "Rows quarantined",
    "failures_post": "Rule failures after cleaning",
    "coercion_post": "Values that would not convert, after",
    "unique_before": "Unique records before masking",
    "unique_after": "Unique records after masking",
    "residual_identifiers": "Identifiers left in the masked extract",
}


def execution(p: Provenance, result) -> str:
    out = p.head("PIPELINE EXECUTION REPORT") + [f"Started    : {result.started}", f"Status     : {'SUCCESS' if result.ok else 'FAILED'}", f"Duration   : {result.seconds:.2f}s", ""]
    out += section(1, "STAGE TIMELINE") + grid(("#", "STAGE", "IN", "OUT", "SECONDS", "STATUS", "DETAIL"), [(str(i), s.name, s.rows_in, s.rows_out, f"{s.seconds:7.2f}", s.status, s.detail) for i, s in enumerate(result.stages, 1)], (2, 16, 8, 8, 8, 7, 44))
    if result.stages:
        slow = max(result.stages, key=lambda s: s.seconds)
        out += ["", f"Slowest stage: {slow.name} ({slow.seconds:.2f}s, {pct(slow.seconds, result.seconds):.0f}% of the time)"]
    if result.error:
        out += ["", f"Stopped: {result.error}"]
    out += ["", *section(2, "OUTCOMES"), *grid(("", ""), [(label, result.outputs[k]) for k, label in OUTCOMES.items() if k in result.outputs], (44, 10))]
    out += ["", *section(3, "ARTIFACTS WRITTEN"), *(f"  {a}" for a in result.artifacts)]
    return "\n".join(out) + "\n"


def scorecard(p: Provenance, scores: list[dict], totals: dict, fine: tuple[int, int], unmeasured: list[str]) -> str:
    out = p.head("DETECTION SCORECARD") + section(1, "PER-DEFECT RESULTS")
    share = lambda x: f"{100 * x:6.1f}%"
    out += grid(("DEFECT", "COLUMN", "PLANTED", "RECALL", "ATTRIB", "CONTAIN"), [(s["defect"], s["column"], s["planted"], share(s["recall"]), share(s["attribution"]), share(s["containment"])) for s in scores], (32, 15, 8, 8, 8, 8))
    out += ["", f"Micro: {totals['planted']:,} planted, recall {share(totals['recall']).strip()}, attribution {share(totals['attribution']).strip()}, containment {share(totals['containment']).strip()}", f"Macro: recall {share(totals['macro_recall']).strip()}, attribution {share(totals['macro_attribution']).strip()}"]
    missed = [s["defect"] for s in scores if s["recall"] < 1]
    out += ["", *section(2, "NOT FULLY RECALLED"), *(missed or ["None: every planted defect was acted on."])]
    apart = [(s["defect"], s["handled"] - s["attributed"]) for s in scores if s["handled"] != s["attributed"]]
    out += ["", *section(3, "HANDLED BY ANOTHER CHECK THAN EXPECTED"), *grid(("DEFECT", "ROWS"), apart, (32, 8))]
    if unmeasured:
        out += ["", f"Not measured: {', '.join(sorted(unmeasured))}"]
    clean, wrongly = fine
    out += ["", *section("", "SUMMARY"), f"Rows without a planted defect : {clean:,}", f"  of those, quarantined       : {wrongly:,}", f"Specificity                   : {100 - pct(wrongly, clean):.1f}%"]
    return "\n".join(out) + "\n"
