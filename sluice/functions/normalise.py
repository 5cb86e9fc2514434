"""Field normalisers: expressions that give struct<value, tag, reason>.

``reason`` says why a value cannot be repaired, and then ``value`` is null;
``tag`` names the repair that was made, null if the value stood already. What a
normaliser reads out of a text several times can be given as columns made before;
with ``parts`` it gives its three expressions, so that the reason, which all three
of the struct's fields depend on, can be a column first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import col, collapse, digits, full, is_missing, strip, title

MISSING = "missing_required_field"
#: A letter of any script, then letters, spaces, apostrophes and hyphens.
NAME = r"[\p{L}\p{Nl}\p{No}][\p{L}\p{Nl}\p{No} '\-]*"
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"


def outcome(raw: Column, value: Column, reasons: list[tuple[Column, str]], tag: Column, kind: str, parts: bool) -> Column | tuple[Column, Column, Column]:
    """The first reason that holds, or else the value and its tag; ``parts``: (reason, value, tag), to be ``joined`` as columns."""
    why = F.when(is_missing(raw), MISSING)
    for wrong, name in reasons:
        why = why.when(wrong, name)
    found = why, value.cast(kind), tag.cast("string")
    return found if parts else joined(*found)


def joined(why: Column, value: Column, tag: Column) -> Column:
    fine = why.isNull()
    return F.struct(F.when(fine, value).alias("value"), F.when(fine, tag).alias("tag"), why.alias("reason"))


def tagged(changed: Column, name: str) -> Column:
    return F.when(changed, name)


def name(c: Column | str, min_len: int = 2, max_len: int = 50, text: Column | None = None, titled: Column | None = None, parts: bool = False) -> Column:
    raw, text = col(c), collapse(c) if text is None else text
    titled = title(text) if titled is None else titled
    reasons = [(~full(text, NAME), "malformed_name"), (F.length(text) < min_len, "name_too_short"), (F.length(text) > max_len, "name_too_long")]
    return outcome(raw, titled, reasons, tagged(titled != raw, "name_normalised"), "string", parts)


def customer_id(c: Column | str, parts: bool = False) -> Column:
    raw, text = col(c), strip(c)
    number = text.try_cast("long")
    reasons = [(~full(text, r"\d+") | number.isNull() | (number <= 0), "invalid_customer_id")]
    return outcome(raw, number, reasons, tagged(text != number.cast("string"), "customer_id_normalised"), "long", parts)


def phone(c: Column | str, parts: bool = False) -> Column:
    raw, d = col(c), digits(c)
    ten = F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)
    text = F.concat_ws("-", F.substring(ten, 1, 3), F.substring(ten, 4, 3), F.substring(ten, 7, 4))
    return outcome(raw, text, [(F.length(ten) != 10, "unparseable_phone")], tagged(text != raw, "phone_normalised"), "string", parts)


def date(c: Column | str, formats: list[str], days: list[Column] | None = None, parts: bool = False) -> Column:
    """``value`` is a date; only the first format goes untagged if that is YYYY-MM-DD. ``days``: the date by each format."""
    raw, days = col(c), [V.parse_date(c, f) for f in formats] if days is None else days
    first = F.lit(None).cast("date")
    for i, f in enumerate(formats):
        if f == "%Y-%m-%d":
            first = F.when(F.coalesce(F.lit(None).cast("date"), *days[:i]).isNull(), days[i])
    found = F.coalesce(*days)
    return outcome(raw, found, [(found.isNull(), "unparseable_date")], tagged(first.isNull(), "date_normalised"), "date", parts)


def income(c: Column | str, cap: float, parts: bool = False) -> Column:
    raw = col(c)
    text = F.translate(strip(c), ",$", "")
    expanded = V.thousands(text)
    number = F.coalesce(expanded, V.parse_number(text))
    reasons = [(number.isNull() | F.isnan(number), "unparseable_income"), ((number < 0) | (number > cap), "income_out_of_range")]
    same = F.coalesce(V.parse_number(raw) == number, F.lit(False))
    tag = F.when(expanded.isNotNull(), "income_suffix_expanded").when(~same, "income_normalised")
    return outcome(raw, F.bround(number, 2), reasons, tag, "double", parts)


def status(c: Column | str, permitted: list[str], aliases: dict[str, str], parts: bool = False) -> Column:
    raw, text = col(c), F.lower(strip(c))
    alias = F.element_at(F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair]), text) if aliases else F.lit(None).cast("string")
    direct = text.isin(*permitted)
    tag = F.when(direct & (text != raw), "status_normalised").when(~direct, "status_alias_mapped")
    return outcome(raw, F.when(direct, text).otherwise(alias), [(~direct & alias.isNull(), "unmappable_account_status")], tag, "string", parts)


def email(c: Column | str, parts: bool = False) -> Column:
    raw, text = col(c), F.lower(strip(c))
    return outcome(raw, text, [(~full(text, EMAIL), "malformed_email")], tagged(text != raw, "email_normalised"), "string", parts)


def address(c: Column | str, min_len: int = 10, max_len: int = 200, text: Column | None = None, parts: bool = False) -> Column:
    raw, text = col(c), collapse(c) if text is None else text
    return outcome(raw, text, [(F.length(text) < min_len, "address_too_short"), (F.length(text) > max_len, "address_too_long")], tagged(text != raw, "address_normalised"), "string", parts)
