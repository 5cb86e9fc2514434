"""SQL for DuckDB that means the same as the engine's expressions, to hold its queries against."""

from __future__ import annotations

from sluice.functions.text import SENTINELS
from sluice.operators.detect import DETECTORS, LEAK_COLUMNS, SUPPRESSED
from sluice.plans.dirty import DUCK
from sluice.policy import Policy

_NUMBER = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?"


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def listed(xs) -> str:
    return "(" + ", ".join(quoted(x) for x in xs) + ")"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def collapse(c: str) -> str:
    return strip(rf"regexp_replace({c}, '\s+', ' ', 'g')")


def missing(c: str) -> str:
    return f"({c} IS NULL OR lower({strip(c)}) IN {listed(SENTINELS)})"


def sentinel(c: str) -> str:
    return f"({c} IS NOT NULL AND lower({strip(c)}) IN {listed(SENTINELS)})"


def number(c: str) -> str:
    return f"(CASE WHEN regexp_full_match(lower({strip(c)}), '{_NUMBER}') THEN try_cast({strip(c)} AS DOUBLE) END)"


def unsigned(c: str) -> str:
    return f"replace(replace({c}, ',', ''), '$', '')"


def thousands(c: str) -> str:
    return rf"(CASE WHEN regexp_full_match({strip(c)}, '\d+(\.\d+)?[kK]') THEN try_cast(left({strip(c)}, length({strip(c)}) - 1) AS DOUBLE) * 1000 END)"


def day(c: str, formats: list[str]) -> str:
    tries = ", ".join(f"try_strptime({collapse(c) if '%B' in f else strip(c)}, {quoted(f)})" for f in formats)
    return f"CAST(coalesce({tries}) AS DATE)"


def iso(c: str) -> str:
    return rf"(CASE WHEN regexp_full_match({c}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) END)"


def title(c: str) -> str:
    return rf"array_to_string(list_transform(regexp_extract_all(lower({c}), '\p{{L}}+|[^\p{{L}}]+'), lambda x: upper(x[1]) || x[2:]), '')"


def digits(c: str) -> str:
    return rf"regexp_replace({c}, '[^0-9]', '', 'g')"


def shape(c: str) -> str:
    return rf"regexp_replace(regexp_replace({strip(c)}, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g')"


def redact(c: str) -> str:
    return rf"left(regexp_replace(regexp_replace({c}, '([A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]*@', '\1***@', 'g'), '[0-9]', '#', 'g'), 44)"


def fields(p: Policy) -> dict[str, tuple[str, str, list[tuple[str, str]]]]:
    """Of each field: its value, its tag, and (condition, reason) in order; a missing value comes first."""
    name_reasons = lambda t: [(rf"NOT regexp_full_match({t}, '[\p{{L}}\p{{Nl}}\p{{No}}][\p{{L}}\p{{Nl}}\p{{No}} ''\-]*')", "malformed_name"), (f"length({t}) < 2", "name_too_short"), (f"length({t}) > 50", "name_too_long")]
    out = {}
    i = strip("customer_id")
    out["customer_id"] = (f"try_cast({i} AS BIGINT)", f"CASE WHEN {i} <> CAST(try_cast({i} AS BIGINT) AS STRING) THEN 'customer_id_normalised' END", [(rf"NOT regexp_full_match({i}, '\d+') OR coalesce(try_cast({i} AS BIGINT), 0) <= 0", "invalid_customer_id")])
    for c in ("first_name", "last_name"):
        t = collapse(c)
        out[c] = (title(t), f"CASE WHEN {title(t)} <> {c} THEN 'name_normalised' END", name_reasons(t))
    e = f"lower({strip('email')})"
    out["email"] = (e, f"CASE WHEN {e} <> email THEN 'email_normalised' END", [(rf"NOT regexp_full_match({e}, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}')", "malformed_email")])
    d = digits("phone")
    ten = f"(CASE WHEN length({d}) = 11 AND starts_with({d}, '1') THEN substr({d}, 2) ELSE {d} END)"
    ph = f"(substr({ten}, 1, 3) || '-' || substr({ten}, 4, 3) || '-' || substr({ten}, 7, 4))"
    out["phone"] = (ph, f"CASE WHEN {ph} <> phone THEN 'phone_normalised' END", [(f"length({ten}) <> 10", "unparseable_phone")])
    for c in ("date_of_birth", "created_date"):
        out[c] = (day(c, p.date_formats), f"CASE WHEN try_strptime({strip(c)}, '%Y-%m-%d') IS NULL THEN 'date_normalised' END", [(f"{day(c, p.date_formats)} IS NULL", "unparseable_date")])
    a = collapse("address")
    out["address"] = (a, f"CASE WHEN {a} <> address THEN 'address_normalised' END", [(f"length({a}) < 10", "address_too_short"), (f"length({a}) > 200", "address_too_long")])
    t = unsigned(strip("income"))
    x = f"coalesce({thousands(t)}, {number(t)})"
    tag = f"CASE WHEN {thousands(t)} IS NOT NULL THEN 'income_suffix_expanded' WHEN coalesce({number('income')} = {x}, false) = false THEN 'income_normalised' END"
    out["income"] = (f"round({x}, 2)", tag, [(f"{x} IS NULL", "unparseable_income"), (f"{x} < 0 OR {x} > {p.income_cap}", "income_out_of_range")])
    s = f"lower({strip('account_status')})"
    alias = "CASE " + s + " " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in p.aliases.items()) + " END"
    direct = f"{s} IN {listed(p.statuses)}"
    out["account_status"] = (f"CASE WHEN {direct} THEN {s} ELSE {alias} END", f"CASE WHEN {direct} AND {s} <> account_status THEN 'status_normalised' WHEN NOT {direct} THEN 'status_alias_mapped' END", [(f"NOT {direct} AND {alias} IS NULL", "unmappable_account_status")])
    return {c: out[c] for c in ("customer_id", "first_name", "last_name", "email", "phone", "date_of_birth", "address", "income", "account_status", "created_date")}


def normalised(p: Policy) -> str:
    """CTEs: dirty, and n with <field>_value, _tag and _reason beside its columns."""
    first, then = [], []
    for c, (value, tag, reasons) in fields(p).items():
        why = f"CASE WHEN {missing(c)} THEN 'missing_required_field' " + " ".join(f"WHEN {cond} THEN '{name}'" for cond, name in reasons) + " END"
        first.append(f"{why} AS {c}_reason, {value} AS {c}_raw, {tag} AS {c}_rawtag")
        then.append(f"{c}_reason, CASE WHEN {c}_reason IS NULL THEN {c}_raw END AS {c}_value, CASE WHEN {c}_reason IS NULL THEN {c}_rawtag END AS {c}_tag")
    columns = ", ".join(fields(p))
    return f"{DUCK}, n0 AS (SELECT *, {', '.join(first)} FROM dirty), n AS (SELECT row_idx, {columns}, {', '.join(then)} FROM n0)"


def events(p: Policy) -> str:
    """Further CTEs: rejection (row_idx, customer_id, place, reason, col, value), repair (row_idx, place, col, tag), out_rows."""
    names, (low, high), today = list(fields(p)), p.ages, f"DATE '{p.today}'"
    rej = [f"SELECT row_idx, customer_id, {i} AS place, {c}_reason AS reason, '{c}' AS col, {c} AS value FROM n WHERE {c}_reason IS NOT NULL" for i, c in enumerate(names)]
    age = f"date_diff('day', date_of_birth_value, {today}) / 365.25"
    shown = "strftime({}, '%Y-%m-%d')"
    rej.append(f"SELECT row_idx, customer_id, 10, 'implausible_age', 'date_of_birth', {shown.format('date_of_birth_value')} FROM n WHERE NOT ({age} BETWEEN {low} AND {high})")
    rej.append(f"SELECT row_idx, customer_id, 11, 'future_created_date', 'created_date', {shown.format('created_date_value')} FROM n WHERE created_date_value > {today}")
    rej.append(f"SELECT row_idx, customer_id, 12, 'created_before_birth', 'created_date', {shown.format('created_date_value')} FROM n WHERE created_date_value < date_of_birth_value")
    rej.append("SELECT row_idx, customer_id, 13, 'duplicate_customer_id', 'customer_id', customer_id FROM (SELECT *, row_number() OVER (PARTITION BY customer_id_value ORDER BY row_idx) AS rn FROM n WHERE customer_id_value IS NOT NULL) WHERE rn > 1")
    rep = [f"SELECT row_idx, {i} AS place, '{c}' AS col, {c}_tag AS tag FROM n WHERE {c}_tag IS NOT NULL" for i, c in enumerate(names)]
    return f"""{normalised(p)}, rejection AS (SELECT row_idx, coalesce(customer_id, 'nan') AS customer_id, place, reason, col, left(coalesce(value, 'nan'), 40) AS value FROM ({' UNION ALL '.join(rej)})),
repair AS ({' UNION ALL '.join(rep)}),
out_rows AS (SELECT row_idx, {', '.join((shown.format(c + '_value') if 'date' in c else c + '_value') + ' AS ' + c for c in names)} FROM n WHERE row_idx NOT IN (SELECT row_idx FROM rejection))"""


def rules(p: Policy, source: str, name: str) -> str:
    """CTEs <name>_t (typed), <name> (row_idx, place, col, chk) and <name>_coerce (row_idx, col) of the rules on ``source``."""
    (low, high), today = p.ages, f"DATE '{p.today}'"
    cell = lambda c: f"CAST({c} AS STRING)"
    date = lambda c: f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"
    x = number(cell("customer_id"))
    typed = f"CASE WHEN {x} % 1 = 0 THEN CAST({x} AS BIGINT) END AS t_customer_id, {number(cell('income'))} AS t_income, {date('date_of_birth')} AS t_date_of_birth, {date('created_date')} AS t_created_date"
    t = lambda c: f"t_{c}" if p.schema[c]["dtype"] != "str" else c
    parts, place = [], 0

    def add(c: str, check: str, bad: str):
        nonlocal place
        parts.append(f"SELECT row_idx, {place} AS place, '{c}' AS col, '{check}' AS chk FROM {name}_t WHERE {bad}")
        place += 1

    patterns = {c: p.checks(c)["pattern"] for c in p.columns if "pattern" in p.checks(c)}
    for c in p.columns:
        k, v = p.checks(c), t(c)
        add(c, "not_nullable", f"{v} IS NULL")
        if p.schema[c].get("unique"):
            add(c, "field_uniqueness", f"(SELECT count(*) FROM {name}_t o WHERE o.{v} IS NOT DISTINCT FROM {name}_t.{v}) > 1")
        if "gt" in k:
            add(c, "greater_than", f"{v} <= {k['gt']}")
        if "ge" in k:
            add(c, "greater_than_or_equal_to", f"{v} < {k['ge']}")
        if "income_cap" in k:
            add(c, "less_than_or_equal_to", f"{v} > {p.income_cap}")
        if "isin" in k:
            add(c, "isin", f"{v} NOT IN {listed(k['isin'])}")
        if "min_len" in k:
            add(c, f"length_{k['min_len']}_{k['max_len']}", f"length({v}) NOT BETWEEN {k['min_len']} AND {k['max_len']}")
        if c in patterns:
            rx = r"^[\p{L}\p{Nl}\p{No}][\p{L}\p{Nl}\p{No} '\-]*$" if "name" in c else patterns[c]
            add(c, "str_matches", f"NOT regexp_matches({v}, {quoted(rx)})")
        if "min_age" in k:
            add(c, f"age_{low}_{high}", f"round(date_diff('day', {v}, {today}) / 365.25, 1) NOT BETWEEN {low} AND {high}")
        if "not_future" in k:
            add(c, "not_in_future", f"{v} > {today}")
    for check in p.cross_checks:
        op = {"lt": ">=", "le": ">", "gt": "<=", "ge": "<"}[check.op]
        add(check.right, check.name, f"{t(check.left)} {op} {t(check.right)}")
    coerce = " UNION ALL ".join(f"SELECT row_idx, '{c}' AS col FROM {name}_t WHERE NOT {missing(cell(c))} AND t_{c} IS NULL" for c in p.columns if p.schema[c]["dtype"] != "str")
    return f"{name}_t AS (SELECT *, {typed} FROM {source}), {name} AS ({' UNION ALL '.join(parts)}), {name}_coerce AS ({coerce})"


def pattern(name: str) -> str:
    """A detector's pattern for row tests; the engine there has no look-around."""
    p = next(d.pattern for d in DETECTORS if d.name == name)
    return p.replace(r"(?<!\d)", "(?:^|[^0-9])").replace(r"(?!\d)", "(?:$|[^0-9])")


def hits(source: str, columns: list[str], id_col: str) -> str:
    """SELECT of (row_idx, column, detector) of every hit."""
    return " UNION ALL ".join(
        f"SELECT {id_col} AS row_idx, '{c}' AS col, '{d.name}' AS detector FROM {source} WHERE NOT {missing(c)} AND regexp_matches({c}, {quoted(pattern(d.name))})" for c in columns for d in DETECTORS
    )


def suppressed() -> str:
    return "(detector, col) IN (" + ", ".join(f"({quoted(d)}, {quoted(c)})" for d, c, _ in SUPPRESSED) + ")"


def direct() -> str:
    return f"detector IN {listed(d.name for d in DETECTORS if d.category == 'direct identifier')}"


def leaks() -> str:
    return f"col IN {listed(LEAK_COLUMNS)} AND {direct()}"
