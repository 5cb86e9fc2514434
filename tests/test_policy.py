"""A policy with anything wrong is refused as a whole, every problem named."""

import copy

import pytest
import yaml

from sluice import policy as P

RAW = yaml.safe_load(P.DEFAULT.read_text(encoding="utf-8"))


def change(path, value=None, drop=False):
    raw = copy.deepcopy(RAW)
    at = raw
    *way, last = path
    for k in way:
        at = at[k]
    if drop:
        del at[last]
    else:
        at[last] = value
    return raw


def test_the_shipped_policy_is_fine():
    p = P.load()
    assert (p.version, p.ages, p.pinned, str(p.today)) == (3, (18, 120), True, "2026-09-06")
    assert p.columns[0] == "customer_id" and len(p.columns) == 10


@pytest.mark.parametrize(
    "path,value,part",
    [
        (("version",), 0, "version"),
        (("thresholds", "min_age"), -1, "min_age"),
        (("thresholds", "min_age"), 130, "min_age"),
        (("thresholds", "income_cap"), -5, "income_cap"),
        (("masking", "income_band_width"), 0, "income_band_width"),
        (("schema_policy", "unexpected_columns"), "ignore", "unexpected_columns"),
        (("schema", "income", "dtype"), "money", "dtype"),
        (("schema", "address", "checks", "min_len"), -1, "min_len"),
        (("schema", "address", "checks", "min_len"), 500, "min_len"),
        (("dataframe_checks", 0, "op"), "eq", "operation"),
        (("dataframe_checks", 0, "left"), "birthday", "birthday"),
        (("masking", "rules", "email", "strategy"), "rot13", "rot13"),
        (("release", "unmasked_columns"), ["customer_id", "account_status", "vip"], "vip"),
        (("remediation", "non_critical"), ["fax"], "fax"),
        (("reporting", "sensitive_columns"), ["fax"], "fax"),
        (("release", "quasi_identifiers_before"), ["shoe_size"], "shoe_size"),
        (("remediation", "status_aliases"), {"x": "gone"}, "gone"),
        (("release", "unmasked_columns"), ["customer_id"], "account_status"),
        (("reference_date",), "06/09/2026", "reference_date"),
    ],
)
def test_values(path, value, part):
    with pytest.raises(P.PolicyError, match=part):
        P.check(change(path, value))


@pytest.mark.parametrize(
    "path",
    [("version",), ("thresholds",), ("schema",), ("remediation",), ("masking",), ("release",), ("reporting",), ("thresholds", "min_age"), ("masking", "rules"), ("remediation", "date_formats"), ("release", "quasi_identifiers_after"), ("schema", "account_status", "checks", "isin"), ("masking", "rules", "email", "rationale")],
)
def test_absences(path):
    with pytest.raises(P.PolicyError, match=path[-1]):
        P.check(change(path, drop=True))


@pytest.mark.parametrize("raw", [None, {}, [], "x"])
def test_not_a_mapping(raw):
    with pytest.raises(P.PolicyError):
        P.check(raw)


def test_all_problems_at_once():
    raw = change(("version",), 0)
    raw["thresholds"]["income_cap"] = -1
    with pytest.raises(P.PolicyError) as e:
        P.check(raw)
    assert len(e.value.problems) == 2


def test_no_date_means_today():
    import datetime as dt

    assert P.check(change(("reference_date",))).today == dt.date.today()
