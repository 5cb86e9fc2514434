"""Command line: python -m sluice generate | profile | detect | validate | clean | mask | run | score."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import os
import sys

from pyspark.sql import SparkSession

from sluice import policy as policies
from sluice.operators import clean, detect, generate, mask, score, validate
from sluice.plans import report, run
from sluice.sources import io

log = logging.getLogger("sluice")


def _spark() -> SparkSession:
    return SparkSession.builder.appName("sluice").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()


def _loaded(a):
    spark, pol = _spark(), policies.load(a.rules)
    raw = io.load_raw(spark, a.source)
    return spark, pol, raw, report.Provenance(a.source, io.fingerprint(spark, a.source), raw.count(), pol)


def _checked(raw, pol) -> None:
    if problem := run.structure_problem(raw.columns, pol):
        raise run.GateError(problem)


def _generate(a) -> None:
    spark, pol = _spark(), policies.load(a.rules)
    table, planted, about = generate.generate(spark, a.rows, a.seed, pol.today)
    io.write_csv(table.repartitionByRange("row_idx").sortWithinPartitions("row_idx").drop("row_idx") if a.rows > 1_000_000 else table.coalesce(1).drop("row_idx"), os.path.join(a.out, "customers_raw.csv"))
    io.write_manifest(planted, os.path.join(a.out, "_ground_truth.json"), about)


def _profile(a) -> None:
    spark, pol, raw, p = _loaded(a)
    io.write_text(spark, os.path.join(a.reports, "data_quality_report.txt"), run.quality_report(raw, pol, p)[0])


def _detect(a) -> None:
    spark, pol, raw, p = _loaded(a)
    io.write_text(spark, os.path.join(a.reports, "pii_detection_report.txt"), run.pii_report(raw, pol, p)[0])


def _validate(a) -> None:
    spark, pol, raw, p = _loaded(a)
    v = validate.validated(raw, pol)
    io.write_text(spark, os.path.join(a.reports, "validation_results.txt"), run.validation_report(v, None, pol, p))
    if not validate.passed(v):
        raise run.GateError("the table does not pass its rules")


def _clean(a) -> None:
    spark, pol, raw, p = _loaded(a)
    _checked(raw, pol)
    assessed = clean.assess(raw, pol).persist()
    run.reconcile(assessed)
    io.write_csv(clean.quarantine(assessed, pol.sensitive), os.path.join(a.out, run.TABLES["quarantine"]))
    io.write_text(spark, os.path.join(a.reports, "cleaning_log.txt"), run.cleaning_report(assessed, pol, p))
    cleaned = clean.cleaned(assessed, pol)
    if not validate.passed(validate.validated(cleaned, pol)):
        raise run.GateError("the cleaned table does not pass its rules; it is not written")
    io.write_csv(cleaned.select(*pol.columns), os.path.join(a.out, run.TABLES["cleaned"]))


def _mask(a) -> None:
    spark, pol, raw, p = _loaded(a)
    _checked(raw, pol)
    if not validate.passed(validate.validated(raw, pol)):
        raise run.GateError("only a table that passes its rules is masked")
    masked = mask.apply_masks(raw, pol)
    if not detect.residual(masked).isEmpty():
        raise run.GateError("direct identifiers are left in the masked table; it is not written")
    io.write_csv(masked.select(*pol.columns), os.path.join(a.out, run.TABLES["masked"]))
    io.write_text(spark, os.path.join(a.reports, "masked_sample.txt"), run.masked_report(raw, masked, pol, p)[0])


def _run(a) -> None:
    result = run.run(_spark(), a.source, a.rules, a.out, a.reports)
    if not result.ok:
        raise run.GateError(result.error)


def _score(a) -> None:
    spark, pol, raw, p = _loaded(a)
    manifest = os.path.join(os.path.dirname(a.source.rstrip("/")), "_ground_truth.json")
    if not io.exists(spark, manifest):
        raise run.GateError(f"no record of planted defects at {manifest}")
    _checked(raw, pol)
    planted, _ = io.read_manifest(spark, manifest)
    assessed = clean.assess(raw, pol).persist()
    scores = score.per_defect(planted, assessed, detect.hits(raw, pol.columns)).persist()
    text = report.scorecard(p, [r.asDict() for r in scores.collect()], score.totals(scores).first().asDict(), tuple(score.specificity(planted, assessed).first()), [r[0] for r in score.unmeasured(planted).collect()])
    io.write_text(spark, os.path.join(a.reports, "detection_scorecard.txt"), text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sluice", description=__doc__)
    verbs = top.add_subparsers(dest="verb", required=True)
    for name, f in (("generate", _generate), ("profile", _profile), ("detect", _detect), ("validate", _validate), ("clean", _clean), ("mask", _mask), ("run", _run), ("score", _score)):
        v = verbs.add_parser(name)
        v.set_defaults(act=f)
        v.add_argument("--rules", default=str(policies.DEFAULT))
        v.add_argument("--out", default="data")
        v.add_argument("--reports", default="reports")
        if name == "generate":
            v.add_argument("--rows", type=int, default=5000)
            v.add_argument("--seed", type=int, default=42)
        else:
            v.add_argument("source")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stderr)]
    if "://" not in a.reports:
        os.makedirs(a.reports, exist_ok=True)
        handlers.append(logging.FileHandler(os.path.join(a.reports, "pipeline.log"), mode="w", encoding="utf-8"))
    for h in handlers:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(h)
    log.setLevel(logging.INFO)
    began = dt.datetime.now()
    try:
        a.act(a)
    except Exception as e:  # the one place where errors become an exit code
        log.error("%s: %s", a.verb, e)
        return 1
    finally:
        for h in handlers:
            log.removeHandler(h)
            h.close()
    log.info("%s done in %s", a.verb, dt.datetime.now() - began)
    return 0
