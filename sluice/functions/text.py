"""Text expressions: white space, absence, shapes, redaction, title case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what reads as present but means absent, once trimmed and lower-cased
SENTINELS = ("", "null", "n/a", "na", "none", "nan", "unknown", "-", "not disclosed")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Unicode's white space, as the class \s of a pattern with (?U) has it.
WHITE = "".join(map(chr, (*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column | str) -> Column:
    """Without Unicode white space at either end; trim() by itself takes only spaces."""
    return F.btrim(col(c), F.lit(WHITE))


def collapse(c: Column | str) -> Column:
    """Each run of white space as one space, and none at the ends."""
    return strip(F.regexp_replace(col(c), r"(?U)\s+", " "))


def is_sentinel(c: Column | str) -> Column:
    return col(c).isNotNull() & F.lower(strip(c)).isin(*SENTINELS)


def is_missing(c: Column | str) -> Column:
    return col(c).isNull() | F.lower(strip(c)).isin(*SENTINELS)


def digits(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\D", "")


def full(c: Column | str, pattern: str) -> Column:
    """Whether the whole value matches; unlike ``$``, ``\\z`` lets no final line break by."""
    return col(c).rlike(rf"\A(?:{pattern})\z")


def shape(c: Column | str) -> Column:
    """Digits as 9, ASCII letters as A."""
    return F.regexp_replace(F.regexp_replace(strip(c), r"\d", "9"), "[A-Za-z]", "A")


def redact(c: Column | str) -> Column:
    """The first character of an e-mail's local part, no digits, and 44 characters at most."""
    local = F.regexp_replace(col(c), r"([A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]*@", "$1***@")
    return F.left(F.regexp_replace(local, r"\d", "#"), F.lit(44))


def safe(c: Column | str, sensitive: bool) -> Column:
    return redact(c) if sensitive else col(c)


def title(c: Column | str) -> Column:
    """A capital at the start of each run of letters, so also behind an apostrophe or hyphen."""
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit(r"(?U)([^\W\d_]+|[\W\d_]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def before_at(c: Column | str) -> Column:
    return F.substring_index(col(c), "@", 1)


def after_at(c: Column | str) -> Column:
    return F.substring(col(c), F.locate("@", col(c)) + 1, F.lit(1 << 30))
