"""Operators over small frames."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import clean, detect, mask, privacy, profile, score, validate

GOOD = {"customer_id": "1", "first_name": "Ann", "last_name": "Lee", "email": "ann.lee@corp.com", "phone": "555-123-4567", "date_of_birth": "1985-03-15", "address": "12 High Street, Springfield", "income": "52000", "account_status": "active", "created_date": "2024-01-01"}


@pytest.fixture
def frame(spark, policy):
    def make(*rows):
        data = [(i, *[({**GOOD, "customer_id": str(i + 1)} | r)[c] for c in policy.columns]) for i, r in enumerate(rows)]
        return spark.createDataFrame(data, "row_idx long, " + ", ".join(f"{c} string" for c in policy.columns))

    return make


def reasons(assessed):
    return {(r["row_idx"], r["column"], r["reason"]) for r in clean.rejections(assessed).collect()}


def test_clean_row_stays_as_it_is(frame, policy):
    a = clean.assess(frame({}), policy)
    row = clean.cleaned(a, policy).drop("row_idx").first().asDict()
    assert row == {**GOOD, "customer_id": 1, "income": 52000.0}
    assert clean.repairs(a).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_the_first_of_an_id_survives_whatever_befalls_it(frame, policy, parts):
    df = frame({"customer_id": "7", "email": "bad"}, {"customer_id": "007"}, {"customer_id": "8"}, {"customer_id": None}, {"customer_id": "N/A"}).repartition(parts)
    a = clean.assess(df, policy)
    assert reasons(a) == {(0, "email", "malformed_email"), (1, "customer_id", "duplicate_customer_id"), (3, "customer_id", "missing_required_field"), (4, "customer_id", "missing_required_field")}
    assert tuple(clean.reconciliation(a).first()) == (5, 1, 4, True)


def test_rules_across_columns(frame, policy):
    a = clean.assess(frame({"date_of_birth": "1990-01-01", "created_date": "1985-01-01"}, {"created_date": "2027-01-01"}, {"date_of_birth": "1905-01-01"}, {"date_of_birth": "2008-09-06"}, {"date_of_birth": "2008-09-07"}), policy)
    assert reasons(a) == {(0, "created_date", "created_before_birth"), (1, "created_date", "future_created_date"), (2, "date_of_birth", "implausible_age"), (3, "date_of_birth", "implausible_age"), (4, "date_of_birth", "implausible_age")} - ({(3, "date_of_birth", "implausible_age")} if 6574 / 365.25 >= 18 else set())


def test_quarantine_is_redacted_but_for_its_key(frame, policy):
    a = clean.assess(frame({"email": "ann@@corp.com", "income": "lots", "customer_id": "12"}, {}), policy)
    q = clean.quarantine(a, policy.sensitive).collect()
    assert [tuple(r) for r in q] == [(0, "12", 2, "malformed_email; unparseable_income", "email; income", "email=a***@@corp.com | income=lots")]


def test_policy_sensitivity(frame, policy):
    a = clean.assess(frame({"income": None}, {"email": "x"}, {"income": "", "phone": "n/a"}, {}), policy)
    assert tuple(clean.policy_sensitivity(a, policy.non_critical).first()) == (3, 2, 0.25, 0.75)


def test_events_keep_their_order(frame, policy):
    a = clean.assess(frame({"phone": "5551234567", "first_name": "ann"}, {"phone": "5551234567"}), policy)
    assert [tuple(r) for r in clean.frequency(clean.repairs(a), "tag").collect()] == [("phone_normalised", 2), ("name_normalised", 1)]
    assert sorted(r[0] for r in clean.touched(a, "phone").collect()) == [0, 1]


def test_validation_collects_all(frame, policy):
    v = validate.validated(frame({"email": "x", "phone": "1", "income": "-5"}, {"date_of_birth": "invalid_date"}, {"date_of_birth": None}, {}), policy)
    got = {(r["row_idx"], r["column"], r["check"]) for r in validate.failures(v).collect()}
    assert got == {(0, "email", "str_matches"), (0, "phone", "str_matches"), (0, "income", "greater_than_or_equal_to"), (1, "date_of_birth", "not_nullable"), (2, "date_of_birth", "not_nullable")}
    assert [tuple(r) for r in validate.coercion_by_column(v).collect()] == [("date_of_birth", 1)]
    assert tuple(validate.failing_rows(v).first()) == (3, 5, 1) and not validate.passed(v)
    assert validate.passed(validate.validated(frame({}), policy))


def test_validation_edges(frame, policy):
    v = validate.validated(frame({"customer_id": "12.9"}, {"customer_id": "abc"}, {"customer_id": "0"}, {"customer_id": "1e3"}, {"date_of_birth": "2024-01-01", "created_date": "2024-01-01"}, {"first_name": "José"}), policy)
    got = {(r["row_idx"], r["column"], r["check"]) for r in validate.failures(v).collect()}
    assert {(0, "customer_id", "not_nullable"), (1, "customer_id", "not_nullable"), (2, "customer_id", "greater_than"), (0, "customer_id", "field_uniqueness"), (1, "customer_id", "field_uniqueness")} <= got
    assert (4, "date_of_birth", "age_18_120") in got and not any(r in (3, 5) for r, _, _ in got)
    assert not any(c == "dob_before_created" for _, _, c in got)


def test_duplicates_all_fail(frame, policy):
    v = validate.validated(frame({"customer_id": "5"}, {"customer_id": "5"}, {"customer_id": "6"}), policy)
    assert sorted(r["row_idx"] for r in validate.failures(v).collect()) == [0, 1]


def test_cross_check_errors(frame, policy):
    from sluice.policy import CrossCheck

    with pytest.raises(ValueError):
        validate.cross(CrossCheck("x", "date_of_birth", "eq", "created_date"), policy.columns)
    with pytest.raises(ValueError):
        validate.cross(CrossCheck("x", "nowhere", "le", "created_date"), policy.columns)


def test_profile(frame, policy):
    df = frame({"customer_id": "ABC", "date_of_birth": "04/15/2020", "income": "75k"}, {"customer_id": "ABC", "date_of_birth": "invalid_date", "income": "$52,000"}, {"customer_id": None, "income": "60,000.00", "date_of_birth": "01/01/2016"}, {"customer_id": "N/A", "income": None})
    assert [tuple(r) for r in profile.duplicate_ids(df).collect()] == [("ABC", 2)]
    got = dict(tuple(r) for r in profile.invalid_values(df, policy).collect())
    assert got["date_of_birth_repairable_format"] == 2 and got["date_of_birth_unrepairable"] == 1 and got["income_repairable_format"] == 3 and got["age_outside_policy"] == 2
    by = {r["column"]: r for r in profile.completeness(df, policy.columns).collect()}
    assert (by["customer_id"]["nulls"], by["customer_id"]["sentinels"], by["income"]["missing"]) == (1, 1, 1)
    assert [tuple(r) for r in profile.format_inventory(df, "date_of_birth").collect()][0] == ("99/99/9999", 2, "04/15/2020")
    assert [r[0] for r in profile.examples(df, F.col("income"), 2).collect()] == ["75k", "$52,000"]


def test_profile_of_nothing_and_of_drift(frame, policy, spark):
    empty = frame({}).limit(0)
    assert all(r["rows"] == 0 and r["pct"] == 0 for r in profile.completeness(empty, policy.columns).collect())
    assert sum(r["rows"] for r in profile.invalid_values(empty, policy).collect()) == 0
    assert sum(r["rows"] for r in profile.invalid_values(frame({"income": "x"}).drop("income"), policy).collect()) == 0
    assert profile.drift(["customer_id", "fax"], policy)[1] == ["fax"] and "income" in profile.drift(["customer_id"], policy)[0]


def test_detection(frame, policy):
    df = frame({"address": "1 High St, contact bob@x.com 555-123-4567"}, {"address": "SSN 123-45-6789 at 10.0.0.1"}, {"phone": None})
    found = detect.hits(df, policy.columns)
    rows = {(r["column"], r["detector"]): (r["row_count"], r["suppressed"] is None) for r in detect.findings(found, policy.columns).collect()}
    assert rows["address", "email"] == (1, True) and rows["address", "us_ssn"] == (1, True) and rows["address", "ip_address"] == (1, True)
    assert rows["income", "postal_code"] == (3, False) and rows["created_date", "date_iso"] == (3, False) and rows["phone", "phone"] == (2, True)
    assert detect.leak_rows(found).first()[0] == 2
    assert detect.worst_leak(found).first()[1] == "us_ssn"
    raw, kept, rate = detect.confirmation_rate(found).first()
    assert rate == pytest.approx(100 * kept / raw)
    assert detect.confirmation_rate(found.limit(0)).first()[2] == 0


def test_masked_rows_hold_no_identifier(frame, policy):
    df = frame({"first_name": "Jonathan", "last_name": "Smithers", "address": "1 High Street, SSN 123-45-6789, bob@x.com"})
    masked = mask.apply_masks(clean.cleaned(clean.assess(df, policy), policy), policy)
    blob = " ".join(map(str, masked.first()))
    assert not any(x in blob for x in ("onathan", "mithers", "ann.lee", "555-123", "1985-03", "High Street", "123-45", "bob@", "52000 "))
    assert detect.residual(masked).isEmpty()
    assert not detect.residual(df).isEmpty()
    with pytest.raises(ValueError):
        mask.apply_masks(df.drop("phone"), policy)


def test_privacy(spark, frame, policy):
    keys = spark.createDataFrame([(["a"],)] * 4 + [(["b"],)] * 2 + [(["c", "?"],)] + [(["d"],)] * 6, "signature array<string>")
    assert dict(tuple(r) for r in privacy.k_buckets(keys).collect()) == {"k=3-5": 4, "k=2": 2, "k=1 (unique)": 1, "k>5": 6}
    assert privacy.incomplete_share(keys).first()[0] == pytest.approx(1 / 13)
    assert privacy.incomplete_share(keys.limit(0)).first()[0] == 0
    with pytest.raises(ValueError):
        privacy.signatures(frame({}), ["shoe_size"], policy)
    assert privacy.signatures(frame({}), [], policy).count() == 0


def test_scores(spark, frame, policy):
    df = frame(*[{"income": "-5"} if i == 0 else {"phone": "5551234567"} if i == 1 else {} for i in range(4)])
    planted = spark.createDataFrame([("income_negative", "income", 0), ("phone_nonstandard_format", "phone", 1), ("phone_nonstandard_format", "phone", 2), ("new_kind", "phone", 2)], "defect string, column string, row_idx long")
    a = clean.assess(df, policy)
    scores = score.per_defect(planted, a, detect.hits(df, policy.columns))
    got = {r["defect"]: (r["planted"], r["handled"], r["attributed"], r["escaped"], r["containment"]) for r in scores.collect()}
    assert got == {"income_negative": (1, 1, 1, 0, 1.0), "phone_nonstandard_format": (2, 1, 1, 1, 0.5)}
    assert [r[0] for r in score.unmeasured(planted).collect()] == ["new_kind"]
    assert tuple(score.specificity(planted, a).first()) == (1, 0)
    assert score.totals(scores).first()["recall"] == pytest.approx(2 / 3)
