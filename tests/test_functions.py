"""Expressions over single values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.functions import masks, normalise, text, values
from sluice.operators import privacy


def each(spark, build, inputs, type_="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {type_}")
    return [r[0] for r in df.orderBy("i").select(build("x").alias("y")).collect()]


def check(spark, build, cases, type_="string"):
    assert each(spark, build, list(cases), type_) == list(cases.values())


def outcomes(spark, build, cases):
    got = each(spark, build, list(cases))
    assert {k: (r["value"], r["tag"], r["reason"]) for k, r in zip(cases, got)} == cases


def test_missing(spark):
    inputs = [None, "", "   ", "NULL", " n/a ", "Na", "NONE", "nan", "Unknown", "-", "Not Disclosed", " ", "0", "nil", "x"]
    assert each(spark, text.is_missing, inputs) == [True] * 12 + [False] * 3
    assert each(spark, text.is_sentinel, [None, "", "x", "N/A"]) == [False, True, False, True]


def test_text(spark):
    check(spark, text.collapse, {"  a \t b c ": "a b c"})
    check(spark, text.shape, {" Ab-12 é": "AA-99 é"})
    check(spark, text.title, {"o'brien": "O'Brien", "ANNE-MARIE": "Anne-Marie", "josé": "José"})
    check(spark, text.redact, {"a.b@x.com 12": "a***@x.com ##", "x" * 60: "x" * 44})


def test_dates(spark):
    formats = ["%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d-%m-%Y", "%B %d, %Y"]
    d = dt.date(2020, 4, 5)
    cases = {"2020-04-05": d, "2020-4-5": d, "2020/04/05": d, "4/5/2020": d, "05-04-2020": d, "April 5, 2020": d, "april  5, 2020": d, " 2020-04-05 ": d, "2026-02-30": None, "0000-01-01": None, "soon": None, "20200405": None, "12020-01-01": None}
    check(spark, lambda c: values.parse_dates(c, formats), cases)
    check(spark, values.iso_date, {"2020-04-05": d, "2020-4-5": None, " 2020-04-05": None})


def test_numbers(spark):
    check(spark, values.parse_number, {"1": 1.0, " 2.5 ": 2.5, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "-3": -3.0, "1d": None, "1f": None, "x": None, "": None, "1 2": None})
    check(spark, values.profiled_number, {"75k": 75000.0, "$52,000": 52000.0, "$75k": None})
    check(spark, lambda c: values.banded(c, 25000), {"52000.0": "50000-74999", "0": "0-24999", "24999.99": "0-24999", "text": "unknown", "50000-74999": "50000-74999", "unknown": "unknown", "-1": "-25000--1", "": "unknown"})
    check(spark, values.postal_code, {"1 High St, IL 62701-1234": "62701", "none": "?", "12345 Main": "12345"})
    with pytest.raises(ValueError):
        values.band(F.lit(1), 0)
    check(spark, lambda c: privacy.income_label(c, 25000), {"$52,000": "50000-74999", None: "?", "50000-74999": "50000-74999", "x": "?"})


def test_names(spark):
    good = lambda v, raw: (v, None if v == raw else "name_normalised", None)
    cases = {x: good(x, x) for x in ("José", "Müller", "Nguyễn", "Zoë", "Łukasz", "Ana")}
    cases |= {x: (None, None, "malformed_name") for x in ("J0hn", "John123", "N/A@", "***", "12345", "Ana_")}
    cases |= {"  john   smith ": good("John Smith", ""), "o'brien": good("O'Brien", ""), "ANNE-MARIE": good("Anne-Marie", ""), "X": (None, None, "name_too_short"), "A" * 60: (None, None, "name_too_long"), None: (None, None, "missing_required_field")}
    outcomes(spark, normalise.name, cases)


def test_ids(spark):
    cases = {"42": (42, None, None), "007": (7, "customer_id_normalised", None), " 42 ": (42, None, None), "9" * 30: (None, None, "invalid_customer_id")}
    cases |= {x: (None, None, "invalid_customer_id") for x in ("12.9", "1e3", "12.0", "-5", "0", "abc", "4,2")} | {"N/A": (None, None, "missing_required_field")}
    outcomes(spark, normalise.customer_id, cases)


def test_contacts(spark):
    fine = ("555-123-4567", "phone_normalised", None)
    cases = {x: fine for x in ("(555) 123-4567", "555.123.4567", "+1-555-123-4567", "15551234567")} | {"555-123-4567": (*fine[:1], None, None)}
    outcomes(spark, normalise.phone, cases | {x: (None, None, "unparseable_phone") for x in ("12345", "555-CALL-NOW", "+44 20 7946 0958")})
    outcomes(spark, normalise.email, {"John.Doe@Gmail.com": ("john.doe@gmail.com", "email_normalised", None), "a@b.co": ("a@b.co", None, None), "john@@corp.com": (None, None, "malformed_email"), "a@b.co\nx": (None, None, "malformed_email")})
    outcomes(spark, normalise.address, {"y" * 250: (None, None, "address_too_long"), "PO Box": (None, None, "address_too_short"), "12 High Street, Springfield": ("12 High Street, Springfield", None, None), "12  High Street ,X": ("12 High Street ,X", "address_normalised", None)})


def test_income_status_date(spark):
    cap = 10_000_000
    outcomes(
        spark,
        lambda c: normalise.income(c, cap),
        {"75k": (75000.0, "income_suffix_expanded", None), "$75k": (75000.0, "income_suffix_expanded", None), "$52,000": (52000.0, "income_normalised", None), "52000": (52000.0, None, None), "-1": (None, None, "income_out_of_range"), "99999999999": (None, None, "income_out_of_range"), "lots": (None, None, "unparseable_income"), "nan": (None, None, "missing_required_field"), "-nan": (None, None, "unparseable_income"), "inf": (None, None, "income_out_of_range")},
    )
    status = lambda c: normalise.status(c, ["active", "inactive"], {"actv": "active"})
    outcomes(spark, status, {"  ACTIVE ": ("active", "status_normalised", None), "actv": ("active", "status_alias_mapped", None), "active": ("active", None, None), "closed": (None, None, "unmappable_account_status")})
    d = dt.date(2020, 1, 5)
    date = lambda c: normalise.date(c, ["%Y-%m-%d", "%m/%d/%Y"])
    outcomes(spark, date, {"2020-1-5": (d, None, None), "01/05/2020": (d, "date_normalised", None), "x": (None, None, "unparseable_date")})


MASKS = {
    "initial": {"John": "J***", "john": "J***", "  Mary  ": "M***", "O'Brien": "O***", "": "", None: ""},
    "email_local": {"john.doe@gmail.com": "j***@gmail.com", "JOHN@Corp.COM": "j***@Corp.COM", "@nodomain.com": "***@nodomain.com", "not-an-email": "***", "": "***", None: "***"},
    "last_four": {"555-123-4567": "***-***-4567", "(555) 123-4567": "***-***-4567", "12": "***-***-****", "": "***-***-****", None: "***-***-****"},
    "year_only": {"1985-03-15": "1985-**-**", "invalid_date": "****-**-**", "": "****-**-**", None: "****-**-**"},
    "suppress": {"12 High Street": "[MASKED ADDRESS]", None: "[MASKED ADDRESS]"},
    "band": {"52000.0": "50000-74999", "0": "0-24999", "24999.99": "0-24999", "text": "unknown", "$52,000": "unknown", None: "unknown"},
}


@pytest.mark.parametrize("name", MASKS)
def test_masks(spark, policy, name):
    f = masks.strategy(policy, name)
    check(spark, f, MASKS[name])
    once = each(spark, f, list(MASKS[name]))
    assert each(spark, f, once) == once


def test_unknown_strategy(policy):
    with pytest.raises(ValueError):
        masks.strategy(policy, "rot13")
