"""The whole run, its gates, the sources and the stream."""

import os

import pytest

from sluice import cli
from sluice.operators import generate
from sluice.plans import report, run
from sluice.sources import io
from sluice.streaming import stream
from tests.test_operators import GOOD


@pytest.fixture(scope="module")
def world(spark, policy, tmp_path_factory):
    """A generated table, run and scored."""
    root = tmp_path_factory.mktemp("world")
    table, planted, about = generate.generate(spark, 600, 42, policy.today)
    io.write_csv(table.coalesce(1).drop("row_idx"), str(root / "raw/customers_raw.csv"))
    io.write_manifest(planted, str(root / "raw/_ground_truth.json"), about)
    result = run.run(spark, str(root / "raw/customers_raw.csv"), out=str(root / "out"), reports=str(root / "reports"))
    return root, result, about


def test_generator_is_exact_and_repeatable(spark, policy):
    table, planted, about = generate.generate(spark, 1000, 7, policy.today)
    counts = {r["defect"]: r["count"] for r in planted.groupBy("defect").count().collect()}
    assert {k: v["count"] for k, v in about["defects"].items()} == counts
    assert counts["phone_nonstandard_format"] == 180 and counts["duplicate_customer_id"] == 10
    assert planted.groupBy("column", "row_idx").count().where("count > 1").isEmpty()
    again = generate.generate(spark, 1000, 7, policy.today)[0]
    other = generate.generate(spark, 1000, 8, policy.today)[0]
    assert table.exceptAll(again).isEmpty() and not table.exceptAll(other).isEmpty()


def test_run(world):
    root, result, _ = world
    assert result.ok, result.error
    assert [s.name for s in result.stages] == ["load", "profile", "detect_pii", "validate_pre", "clean", "validate_post", "publish", "mask", "verify_release", "publish_masked"]
    o = result.outputs
    assert o["failures_post"] == o["coercion_post"] == o["residual_identifiers"] == 0 and o["failures_pre"] > 0 and o["unique_after"] < o["unique_before"]
    for name in ("customers_cleaned.csv", "customers_masked.csv", "quarantine.csv"):
        assert os.path.isdir(root / "out" / name)
    for name in run.REPORTS:
        assert (root / "reports" / name).read_text()
    assert "[redacted]" in (root / "reports/data_quality_report.txt").read_text()


def test_rows_balance(spark, world):
    root, result, about = world
    n = io.load_raw(spark, str(root / "out/customers_cleaned.csv")).count()
    q = io.load_raw(spark, str(root / "out/quarantine.csv"))
    assert n + q.count() == about["n_rows"] and q.count() == result.outputs["quarantined"]


def test_score(world, capsys):
    root, _, _ = world
    assert cli.main(["score", str(root / "raw/customers_raw.csv"), "--reports", str(root / "reports")]) == 0
    text = (root / "reports/detection_scorecard.txt").read_text()
    assert "None: every planted defect was acted on." in text


def csv(path, rows, extra=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(",".join(GOOD) + extra + "\n" + "".join(",".join(f'"{v}"' for v in r.values()) + "\n" for r in rows))
    return str(path)


def test_gates(spark, tmp_path, capsys):
    fax = csv(tmp_path / "fax.csv", [{**GOOD, "fax": "1"}], ",fax")
    assert cli.main(["run", fax, "--out", str(tmp_path / "o"), "--reports", str(tmp_path / "r")]) == 1
    assert "fax" in capsys.readouterr().err and not (tmp_path / "o").exists()
    dirty = csv(tmp_path / "dirty.csv", [{**GOOD, "email": "x"}])
    assert cli.main(["mask", dirty, "--out", str(tmp_path / "o"), "--reports", str(tmp_path / "r")]) == 1
    assert not (tmp_path / "o").exists()
    fine = csv(tmp_path / "fine.csv", [GOOD])
    assert cli.main(["mask", fine, "--out", str(tmp_path / "o"), "--reports", str(tmp_path / "r")]) == 0
    assert cli.main(["validate", dirty, "--reports", str(tmp_path / "r")]) == 1


def test_release_gate(spark, tmp_path):
    import yaml

    from sluice import policy as P

    raw = yaml.safe_load(P.DEFAULT.read_text())
    del raw["masking"]["rules"]["address"]
    raw["release"]["unmasked_columns"].append("address")
    rules = tmp_path / "rules.yml"
    rules.write_text(yaml.safe_dump(raw))
    leaky = csv(tmp_path / "leaky.csv", [{**GOOD, "address": "1 High Street, SSN 123-45-6789"}])
    stale = tmp_path / "o/customers_masked.csv"
    stale.mkdir(parents=True)
    result = run.run(spark, leaky, str(rules), str(tmp_path / "o"), str(tmp_path / "r"))
    assert not result.ok and result.outputs["residual_identifiers"] == 1 and not stale.exists()
    assert result.stages[-1].status == "FAILED" and "FAILED" in (tmp_path / "r/pipeline_execution_report.txt").read_text()


def test_csv_round_trip(spark, tmp_path):
    rows = [(0, " pad ", None), (1, "   ", 'q"uote, comma'), (2, "NULL", "line\nbreak"), (3, "N/A", "1e7")]
    io.write_csv(spark.createDataFrame(rows, "i long, a string, b string").coalesce(1), str(tmp_path / "t.csv"))
    got = io.load_raw(spark, str(tmp_path / "t.csv")).orderBy("row_idx").collect()
    assert [(int(r["i"]), r["a"], r["b"]) for r in got] == rows and [r["row_idx"] for r in got] == [0, 1, 2, 3]


def test_numbers_follow_the_files_names(spark, tmp_path):
    """Files of growing size, which Spark reads in the opposite order, and splits of one file."""
    at, want = 0, []
    for k, n in enumerate((3, 40, 500, 9000)):
        (tmp_path / f"part-{k}.csv").write_text("v\n" + "".join(f"{i}\n" for i in range(at, at + n)))
        want += range(at, at + n)
        at += n
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = io.load_raw(spark, str(tmp_path)).orderBy("row_idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [int(r["v"]) for r in got] == want == [r["row_idx"] for r in got]


def test_fingerprint(spark, tmp_path):
    import hashlib

    (tmp_path / "x").write_bytes(b"abc")
    assert io.fingerprint(spark, str(tmp_path / "x")) == hashlib.sha256(b"abc").hexdigest()[:16]


def test_stream(spark, policy, tmp_path):
    rows = [{**GOOD}, {**GOOD, "phone": "(555) 123-4567"}, {**GOOD, "customer_id": "2", "email": "x"}, {**GOOD, "customer_id": "3"}]
    schema = "at timestamp, id long, " + ", ".join(f"{c} string" for c in policy.columns)
    import datetime as dt

    at = dt.datetime(2026, 1, 1)
    spark.createDataFrame([(at, i, *[r[c] for c in policy.columns]) for i, r in enumerate(rows)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = stream.masked(source, policy, "at").writeStream.format("memory").queryName("masked").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["customer_id"] for r in spark.table("masked").collect()) == [1, 3]
    q = stream.detected(source, ["email", "phone"], "id", "at").writeStream.outputMode("complete").format("memory").queryName("hits").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r["column"], r["detector"]): r["rows"] for r in spark.table("hits").collect()} == {("email", "email"): 3, ("phone", "phone"): 4}


def test_all_statuses_count(spark, policy):
    """More values than the report lists; a null and a common valid value among them."""
    rows = [("active",)] * 40 + [(None,)] + [(f"odd {i}",) for i in range(70) for _ in range(2 if i < 20 else 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_idx long, account_status string")
    text, _ = run.quality_report(df, policy, report.Provenance("s", "d", len(rows), policy))
    assert "Invalid total: 91 rows (69.47%)" in text and "Not listed: 22 rarer values in 22 rows" in text
    few = df.where("row_idx < 42")
    text, _ = run.quality_report(few, policy, report.Provenance("s", "d", 42, policy))
    assert "Invalid total: 2 rows (4.76%)" in text and "Not listed" not in text
