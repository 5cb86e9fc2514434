"""The policy that drives the engine: read from YAML, checked as a whole before anything runs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path
from typing import Any

import yaml

DEFAULT = Path(__file__).with_name("rules.yml")

# fixed values: the vocabulary of a policy file
DTYPES = ("int64", "float64", "str", "date")
OPERATIONS = ("lt", "le", "gt", "ge")
STRATEGIES = ("initial", "email_local", "last_four", "year_only", "suppress", "band")
DERIVED = ("address_postal",)
NEEDED = {
    "thresholds": ("min_age", "max_age", "income_cap"),
    "schema": (),
    "remediation": ("non_critical", "status_aliases", "date_formats"),
    "masking": ("address_placeholder", "income_band_width", "rules"),
    "release": ("unmasked_columns", "quasi_identifiers_before", "quasi_identifiers_after"),
    "reporting": ("sensitive_columns",),
}


class PolicyError(ValueError):
    """All that is wrong with a policy, one problem a line."""

    def __init__(self, problems: list[str], where: str = "policy"):
        super().__init__(f"{where} cannot be used:" + "".join(f"\n  - {p}" for p in problems))
        self.problems = problems


@dataclass(frozen=True)
class CrossCheck:
    name: str
    left: str
    op: str
    right: str
    description: str = ""


@dataclass(frozen=True)
class MaskRule:
    column: str
    strategy: str
    description: str
    rationale: str


class Policy:
    """Typed views of the policy mapping."""

    def __init__(self, raw: dict[str, Any]):
        self.raw = raw

    def __getitem__(self, path: str) -> Any:
        value: Any = self.raw
        for part in path.split("."):
            value = value[part]
        return value

    @property
    def version(self) -> int:
        return int(self["version"])

    @property
    def pinned(self) -> bool:
        return self.raw.get("reference_date") is not None

    @cached_property
    def today(self) -> dt.date:
        value = self.raw.get("reference_date")
        return dt.date.today() if value is None else value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))

    @property
    def schema(self) -> dict[str, dict]:
        return self["schema"]

    @property
    def columns(self) -> list[str]:
        return list(self.schema)

    def checks(self, column: str) -> dict:
        return self.schema[column].get("checks") or {}

    @property
    def unexpected(self) -> str:
        return (self.raw.get("schema_policy") or {}).get("unexpected_columns", "warn")

    @property
    def ages(self) -> tuple[int, int]:
        return self["thresholds.min_age"], self["thresholds.max_age"]

    @property
    def income_cap(self) -> float:
        return self["thresholds.income_cap"]

    @property
    def cross_checks(self) -> list[CrossCheck]:
        return [CrossCheck(**c) for c in self.raw.get("dataframe_checks") or []]

    @property
    def non_critical(self) -> list[str]:
        return self["remediation.non_critical"]

    @property
    def aliases(self) -> dict[str, str]:
        return self["remediation.status_aliases"]

    @property
    def date_formats(self) -> list[str]:
        return self["remediation.date_formats"]

    @property
    def statuses(self) -> list[str]:
        return self.checks("account_status")["isin"]

    @property
    def band_width(self) -> int:
        return self["masking.income_band_width"]

    @property
    def placeholder(self) -> str:
        return self["masking.address_placeholder"]

    @property
    def mask_rules(self) -> list[MaskRule]:
        return [MaskRule(c, **{k: r[k] for k in ("strategy", "description", "rationale")}) for c, r in self["masking.rules"].items()]

    @property
    def unmasked(self) -> list[str]:
        return self["release.unmasked_columns"]

    @property
    def quasi_before(self) -> list[str]:
        return self["release.quasi_identifiers_before"]

    @property
    def quasi_after(self) -> list[str]:
        return self["release.quasi_identifiers_after"]

    @property
    def sensitive(self) -> list[str]:
        return self["reporting.sensitive_columns"]


def _shape_problems(raw: dict[str, Any]) -> list[str]:
    """What is absent or has the wrong form; values are only looked at once this finds nothing."""
    found = ["version is required"] if "version" not in raw else []
    for section, keys in NEEDED.items():
        if not isinstance(raw.get(section), dict):
            found.append(f"section {section} is required")
            continue
        found += [f"{section}.{k} is required" for k in keys if k not in raw[section]]
    status = raw["schema"].get("account_status") if isinstance(raw.get("schema"), dict) else None
    if isinstance(raw.get("schema"), dict) and "isin" not in ((status or {}).get("checks") or {}):
        found.append("schema.account_status.checks.isin is required")
    day = raw.get("reference_date")
    if day is not None and not isinstance(day, dt.date):
        try:
            dt.date.fromisoformat(str(day))
        except ValueError:
            found.append(f"reference_date is not an ISO date: {day!r}")
    masking = raw.get("masking") if isinstance(raw.get("masking"), dict) else {}
    for column, rule in (masking.get("rules") or {}).items():
        found += [f"masking.rules.{column}.{k} is required" for k in ("strategy", "description", "rationale") if k not in (rule or {})]
    return found


def _value_problems(p: Policy) -> list[str]:
    low, high = p.ages
    rules = [
        (p.version < 1, f"version {p.version} is below 1"),
        (low < 0, f"thresholds.min_age {low} is negative"),
        (low >= high, f"thresholds.min_age {low} is not below max_age {high}"),
        (p.income_cap < 0, f"thresholds.income_cap {p.income_cap} is negative"),
        (p.band_width <= 0, f"masking.income_band_width {p.band_width} is not positive"),
        (p.unexpected not in ("warn", "fail"), f"schema_policy.unexpected_columns is neither warn nor fail: {p.unexpected!r}"),
    ]
    found = [text for wrong, text in rules if wrong]
    for column, spec in p.schema.items():
        if spec.get("dtype") not in DTYPES:
            found.append(f"schema.{column}.dtype {spec.get('dtype')!r} is none of {', '.join(DTYPES)}")
        bounds = {k: int(v) for k, v in p.checks(column).items() if k in ("min_len", "max_len") and v is not None}
        found += [f"schema.{column}.{k} {v} is negative" for k, v in bounds.items() if v < 0]
        if len(bounds) == 2 and bounds["min_len"] > bounds["max_len"]:
            found.append(f"schema.{column}.min_len is above max_len")
    known = set(p.columns)
    for c in p.cross_checks:
        if c.op not in OPERATIONS:
            found.append(f"dataframe check {c.name}: operation {c.op!r} is none of {', '.join(OPERATIONS)}")
        found += [f"dataframe check {c.name}: no column {x!r}" for x in (c.left, c.right) if x not in known]
    for r in p.mask_rules:
        if r.strategy not in STRATEGIES:
            found.append(f"masking.rules.{r.column}: strategy {r.strategy!r} is none of {', '.join(STRATEGIES)}")
    named = {
        "masking.rules": [r.column for r in p.mask_rules],
        "release.unmasked_columns": p.unmasked,
        "remediation.non_critical": p.non_critical,
        "reporting.sensitive_columns": p.sensitive,
    }
    found += [f"{where}: no column {c!r}" for where, columns in named.items() for c in columns if c not in known]
    for where, columns in (("quasi_identifiers_before", p.quasi_before), ("quasi_identifiers_after", p.quasi_after)):
        found += [f"release.{where}: {c!r} is neither a column nor one of {', '.join(DERIVED)}" for c in columns if c not in known and c not in DERIVED]
    found += [f"remediation.status_aliases.{a}: {t!r} is not a permitted status" for a, t in p.aliases.items() if t not in p.statuses]
    open_ = known - set(named["masking.rules"]) - set(p.unmasked)
    if open_:
        found.append(f"neither masked nor released as they are: {', '.join(sorted(open_))}")
    return found


def check(raw: Any, where: str = "policy") -> Policy:
    """The policy of a mapping, or a PolicyError with every problem found."""
    if not isinstance(raw, dict) or not raw:
        raise PolicyError(["it is not a non-empty mapping"], where)
    problems = _shape_problems(raw) or _value_problems(Policy(raw))
    if problems:
        raise PolicyError(problems, where)
    return Policy(raw)


def load(path: str | Path = DEFAULT) -> Policy:
    return check(yaml.safe_load(Path(path).read_text(encoding="utf-8")), str(path))
