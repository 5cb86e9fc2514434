"""A synthetic customer table with planted defects, made by Spark from row numbers alone.

Every value is an expression over the row's number and the seed, so any part of
the table can be made anywhere, again, and without a shuffle. In each column the
rows are dealt by a permutation of their numbers; a defect takes a slice of it,
so counts are exact and no two defects meet in a cell.
"""

from __future__ import annotations

import datetime as dt
import math
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.values import format_date, iso_date

COLUMNS = ("customer_id", "first_name", "last_name", "email", "phone", "date_of_birth", "address", "income", "account_status", "created_date")
FIRST = "Ann Ben Carla David Elena Frank Grace Hugo Ines Jack Karen Liam Maria Noah Olga Paul Quinn Rosa Sam Tara Uma Victor Wendy Yara Zoë José".split()
LAST = "Adams Baker Clark Diaz Evans Foster Garcia Hughes Ivanov Jones Klein Lopez Müller Novak Owens Perez Quist Reyes Smith Turner Usher Vance Walsh Young Zimmer O'Brien".split()
STREETS = "High Oak Maple Park Lake Hill River Church Mill Station".split()
CITIES = "Springfield Riverton Fairview Georgetown Salem Madison Clinton Arlington".split()
STATES = "AL CA CO FL IL NY OH TX WA WI".split()
DOMAINS = "gmail.com yahoo.com hotmail.com".split()

# fixed values: share of rows with each planted defect, in the order they are planted
RATES = {
    "missing_email": ("email", 0.020),
    "missing_phone": ("phone", 0.030),
    "missing_income": ("income", 0.045),
    "missing_address": ("address", 0.015),
    "missing_dob": ("date_of_birth", 0.012),
    "phone_nonstandard_format": ("phone", 0.180),
    "phone_unparseable": ("phone", 0.008),
    "dob_nonstandard_format": ("date_of_birth", 0.090),
    "dob_invalid_value": ("date_of_birth", 0.010),
    "created_date_nonstandard_format": ("created_date", 0.060),
    "created_date_future": ("created_date", 0.006),
    "income_negative": ("income", 0.014),
    "income_above_cap": ("income", 0.005),
    "income_non_numeric": ("income", 0.010),
    "status_invalid": ("account_status", 0.070),
    "email_malformed": ("email", 0.035),
    "first_name_dirty": ("first_name", 0.050),
    "last_name_dirty": ("last_name", 0.040),
    "address_too_short": ("address", 0.012),
    "pii_leaked_in_address": ("address", 0.008),
    "age_impossible": ("date_of_birth", 0.004),
    "duplicate_customer_id": ("customer_id", 0.010),
}


class Draw:
    """Numbers and choices that depend on the row, the seed and what they are for."""

    def __init__(self, seed: int):
        self.seed = seed

    def integer(self, what: str, low: int, high: int) -> Column:
        return F.pmod(F.xxhash64(F.col("row_idx"), F.lit(what), F.lit(self.seed)), F.lit(high - low + 1)) + low

    def real(self, what: str, low: float, high: float) -> Column:
        return F.round(F.lit(low) + self.integer(what, 0, 10**9) / 1e9 * (high - low), 2)

    def one_of(self, what: str, options: list) -> Column:
        return F.element_at(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), (self.integer(what, 0, len(options) - 1) + 1).cast("int"))


def dealt(n: int, column: str, seed: int, first: int = 0) -> Column:
    """The place of a row, from ``first`` on, in the permutation of its column: row * a + b modulo their number, with a prime to it."""
    r, n = random.Random(f"{seed} {column}"), max(0, n - first)
    most = max(2, min(n, (1 << 62) // max(1, n)))
    a = next(x for x in iter(lambda: r.randrange(1, most), None) if math.gcd(x, n) == 1) if n > 1 else 1
    return F.pmod((F.col("row_idx") - first) * F.lit(a) + F.lit(r.randrange(n) if n else 0), F.lit(max(1, n)))


def slices(n: int) -> dict[str, tuple[str, int, int]]:
    """defect: (column, first place, place behind the last)."""
    taken: dict[str, int] = {}
    out = {}
    for defect, (column, rate) in RATES.items():
        start = taken.get(column, 0)
        count = min(round(n * rate), (n - 1 if defect == "duplicate_customer_id" else n) - start)
        out[defect] = (column, start, start + max(0, count))
        taken[column] = start + max(0, count)
    return out


def _defects(d: Draw, c: dict[str, Column], today: dt.date) -> dict[str, Column]:
    """What stands in the cell of each defect; the lists of bad phones, dates, statuses, addresses and e-mails are fixed values."""
    p = [d.integer(f"defect phone {i}", a, b).cast("string") for i, (a, b) in enumerate(((200, 999), (200, 999), (1000, 9999)))]
    first, last = F.lower(c["first_name"]), F.lower(c["last_name"])
    blank = lambda what: d.one_of(f"blank {what}", ["", "   ", "NULL", "N/A", F.lit(None).cast("string")])
    joined = lambda *x: F.concat(*[y if isinstance(y, Column) else F.lit(y) for y in x])

    def styles(column: str) -> Column:
        day = F.coalesce(iso_date(c[column]), F.lit(dt.date(1990, 1, 1)))
        return d.one_of(f"style {column}", [F.date_format(day, f) for f in ("MM/dd/yyyy", "dd-MM-yyyy", "MMMM dd, yyyy", "yyyy/MM/dd")])

    def dirty(column: str) -> Column:
        v = c[column]
        return d.one_of(f"dirty {column}", [F.lower(v), F.upper(v), joined("  ", v, "  "), joined(v, "3"), F.lit("X"), joined(v, "123")])

    leak = [joined("contact ", first, ".", F.regexp_replace(last, "[^a-z]", "x"), "@gmail.com"), joined("tel ", p[0], "-", p[1], "-", p[2]), joined("SSN ", d.integer("ssn a", 100, 899).cast("string"), "-", d.integer("ssn b", 10, 99).cast("string"), "-", p[2])]
    old = F.make_date(d.integer("old y", 1800, 1870).cast("int"), d.integer("old m", 1, 12).cast("int"), d.integer("old d", 1, 28).cast("int"))
    return {
        **{f"missing_{k}": blank(k) for k in ("email", "phone", "income", "address", "dob")},
        "phone_nonstandard_format": d.one_of("phone style", [joined("(", p[0], ") ", p[1], "-", p[2]), joined(p[0], ".", p[1], ".", p[2]), joined(*p), joined("+1-", p[0], "-", p[1], "-", p[2]), joined(p[0], " ", p[1], " ", p[2]), joined("1-", p[0], "-", p[1], "-", p[2])]),
        "phone_unparseable": d.one_of("bad phone", ["555-CALL-NOW", "n/a", "12345", "phone pending", "+44 20 7946 0958"]),
        "dob_nonstandard_format": styles("date_of_birth"),
        "dob_invalid_value": d.one_of("bad date", ["invalid_date", "0000-00-00", "2026-02-30", "unknown"]),
        "created_date_nonstandard_format": styles("created_date"),
        "created_date_future": format_date(F.date_add(F.lit(today), d.integer("future", 30, 900).cast("int"))),
        "income_negative": F.format_string("%.2f", -d.real("negative", 500, 45_000)),
        "income_above_cap": F.format_string("%.2f", d.real("extreme", 1.2e7, 9.9e8)),
        "income_non_numeric": d.one_of("text income", ["$52,000", "75k", "not disclosed", "60,000.00"]),
        "status_invalid": d.one_of("bad status", ["Active", "ACTIVE", "  active", "actv", "Inactive", "SUSPENDED", "closed", "pending", "1"]),
        "email_malformed": d.one_of("bad email", [joined(first, "@@corp.com"), joined(first, ".corp.com"), joined(first, "@corp"), "@nodomain.com", joined(first, " @corp.com"), "not an email"]),
        "first_name_dirty": dirty("first_name"),
        "last_name_dirty": dirty("last_name"),
        "address_too_short": d.one_of("short address", ["N/A", "unknown", "PO Box", "-", "n/a"]),
        "pii_leaked_in_address": joined(c["address"], ", ", d.one_of("leak", leak)),
        "age_impossible": format_date(old),
        "duplicate_customer_id": (F.pmod(F.xxhash64(F.col("row_idx"), F.lit("duplicate"), F.lit(d.seed)), F.greatest(F.col("row_idx"), F.lit(1))) + 1).cast("string"),
    }


def generate(spark: SparkSession, n_rows: int = 5000, seed: int = 42, reference_date: dt.date | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """(table with row_idx, planted defects (defect, column, row_idx), what they were made from)."""
    today, d = reference_date or dt.date.today(), Draw(seed)
    number = lambda what, a, b: d.integer(what, a, b).cast("string")
    first, last = d.one_of("first", FIRST), d.one_of("last", LAST)
    back = lambda what, a, b: format_date(F.date_sub(F.lit(today), d.integer(what, a, b).cast("int")))
    fine = {
        "customer_id": (F.col("row_idx") + 1).cast("string"),
        "first_name": first,
        "last_name": last,
        "email": F.lower(F.concat(F.translate(first, "ëé", "ee"), F.lit("."), F.regexp_replace(F.translate(last, "ü", "u"), "'", ""), F.lit("@"), d.one_of("domain", DOMAINS))),
        "phone": F.concat_ws("-", number("p1", 200, 999), number("p2", 200, 999), number("p3", 1000, 9999)),
        "date_of_birth": back("dob", 18 * 365, 88 * 365),
        "address": F.concat(number("house", 1, 99999), F.lit(" "), d.one_of("street", STREETS), F.lit(" Street, "), d.one_of("city", CITIES), F.lit(", "), d.one_of("state", STATES), F.lit(" "), number("zip", 10000, 99999)),
        "income": F.format_string("%.2f", d.real("income", 18_000, 240_000)),
        "account_status": d.one_of("status", ["active", "inactive", "suspended"]),
        "created_date": back("created", 0, 2555),
    }
    base = spark.range(n_rows).withColumnRenamed("id", "row_idx").withColumns(fine)
    places = {c: dealt(n_rows, c, seed, int(c == "customer_id")) for c in COLUMNS}  # the first row repeats no id
    cuts = slices(n_rows)

    def within(defect: str) -> Column:
        column, lo, hi = cuts[defect]
        there = (places[column] >= lo) & (places[column] < hi)
        return there & (F.col("row_idx") > 0) if column == "customer_id" else there

    wrong = _defects(d, {c: F.col(c) for c in COLUMNS}, today)
    out = {}
    for c in COLUMNS:
        value = F.col(c)
        for defect, (column, _, _) in cuts.items():
            if column == c:
                value = F.when(within(defect), wrong[defect]).otherwise(value)
        out[c] = value
    table = base.select("row_idx", *[out[c].alias(c) for c in COLUMNS])
    marks = F.array_compact(F.array(*[F.when(within(x), F.struct(F.lit(x).alias("defect"), F.lit(c).alias("column"))) for x, (c, _, _) in cuts.items()]))
    planted = spark.range(n_rows).withColumnRenamed("id", "row_idx").select("row_idx", F.explode(marks).alias("x")).select("x.defect", "x.column", "row_idx")
    about = {"seed": seed, "reference_date": today.isoformat(), "n_rows": n_rows, "defects": {x: {"column": c, "count": hi - lo} for x, (c, lo, hi) in cuts.items()}}
    return table, planted, about
