"""Format-preserving Feistel pseudonyms for personal data, in DataFrame operations only.

One pattern finds candidates; each is validated by its kind's rule, and a valid one is replaced by a keyed
permutation within its format. The permutation depends on the key, the kind and the value, not on the
document, so equal values keep equal pseudonyms everywhere and different values never share one.

kind    valid if                                     permuted                           kept
------  -------------------------------------------  ---------------------------------  ------------------------------------
card    13-19 digits, right Luhn digit               all digits but the last            separators; new Luhn digit
iban    15-34 characters, remainder 1 modulo 97      the account part, class by class   country, spaces; new check digits
phone   + and 8-15 digits, or 10 digits in groups    digits after the country code      country code, separators
ssn     3-2-4 digits, no area 000, 666 or 9xx, ...   among all valid numbers            hyphens
ip      four numbers of 0-255                        among all addresses                dots
date    year-month-day or day/month/year (or         among the days of its century      order of fields, separators
        month/day/year), a day of the calendar
email   local part, @ and a domain name              the local part, class by class     domain, punctuation

Digits become digits and letters letters of their case. Strings go through a Feistel network whose halves
are shifted character by character, whole numbers through one on Z_a x Z_b, where a * b is exactly the
number of valid values, so that no value leaves its domain: 88,902 * 9,999 numbers, 2^16 * 2^16 addresses,
92 * 397 days of a common century and 75 * 487 of one with a leap year in its first year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_NOT_BEFORE, _NOT_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_SPLIT = r"(?<![\p{L}\p{N}_.+-])"
#: Candidates, in the order of the alternatives; none can match the empty string.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": _NOT_BEFORE + r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + _NOT_AFTER,
    "ip": _SPLIT + r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\p{L}\p{N}_]|\.\d)",
    "ssn": _SPLIT + r"\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}_-])",
    "date": _SPLIT + r"(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}([./-])\d{2}\1\d{4})(?!\p{N}|[./-]\d)",
    "phone": r"(?<![\p{L}\p{N}_+])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{1,4})(?:[ .-]?\d{2,5}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<![.-])\d{3}([ .-])\d{3}\2\d{4})" + _NOT_AFTER,
    "card": _NOT_BEFORE + r"(?:\d{13,19}|\d{4}([ -])\d{4}\3\d{4}\3\d{1,7}|\d{4}([ -])\d{6}\4\d{5})" + _NOT_AFTER,
}
CANDIDATE = "|".join(PATTERNS.values())


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stream(key: str, tweak: str, value: str) -> str:
    return f"sha2(concat_ws('|', {_sql(key)}, {tweak}, i, {value}), 512)"


def _shifted(half: str, stream: str) -> str:
    """``half`` with each letter and digit moved on in its class by four hexadecimal digits."""
    by = f"cast(conv(substring({stream}, 1 + 4 * (j % 32), 4), 16, 10) as int)"
    move = lambda first, size: f"chr({first} + (ascii(c) - {first} + {by}) % {size})"
    return (f"array_join(transform(split({half}, ''), (c, j) -> case when c between '0' and '9' then {move(48, 10)} "
            f"when c between 'A' and 'Z' then {move(65, 26)} when c between 'a' and 'z' then {move(97, 26)} else c end), '')")


def permuted_string(value: str, tweak: str, key: str) -> str:
    """SQL: a keyed permutation of the strings with the same class of character at every place."""
    cut = f"cast(length({value}) div 2 as int)"
    x = _shifted("s.x", _stream(key, tweak, "s.y"))
    y = _shifted("s.y", _stream(key, tweak, "s.x"))
    start = f"named_struct('x', substring({value}, 1, {cut}), 'y', substring({value}, {cut} + 1))"
    return (f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, i) -> if(i % 2 = 0, named_struct('x', {x}, 'y', s.y), "
            f"named_struct('x', s.x, 'y', {y})), s -> concat(s.x, s.y))")


def permuted_number(value: str, a: str, b: str, tweak: str, key: str) -> str:
    """SQL: a keyed permutation of 0 .. a * b - 1."""
    step = lambda v: f"cast(conv(substring({_stream(key, tweak, v)}, 1, 14), 16, 10) as bigint)"
    start = f"named_struct('x', cast({value} as bigint) div {b}, 'y', cast({value} as bigint) % {b})"
    return (f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, i) -> if(i % 2 = 0, named_struct('x', (s.x + {step('s.y')}) % {a}, 'y', s.y), "
            f"named_struct('x', s.x, 'y', (s.y + {step('s.x')}) % {b})), s -> s.x * {b} + s.y)")


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _filled(m: str, digits: str) -> str:
    """``m`` with its digits replaced, in order, by ``digits``."""
    place = f"length(regexp_replace(substring({m}, 1, p + 1), '[^0-9]', ''))"
    return f"array_join(transform(split({m}, ''), (e, p) -> if(e between '0' and '9', substring({digits}, {place}, 1), e)), '')"


def _luhn(digits: str, from_right: int) -> str:
    """Luhn sum of ``digits``, the last of which stands ``from_right`` places from the right."""
    return (f"aggregate(transform(split(reverse({digits}), ''), (e, p) -> if((p + {from_right}) % 2 = 0, cast(e as int), "
            f"array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[cast(e as int)])), 0, (t, e) -> t + e)")


def _modulo97(text: str) -> str:
    return (f"aggregate(split({text}, ''), 0, (t, e) -> if(e between '0' and '9', (t * 10 + ascii(e) - 48) % 97, (t * 100 + ascii(e) - 55) % 97))")


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _card(m: str, key: str) -> tuple[str, str]:
    valid = f"{_luhn(_digits(m), 0)} % 10 = 0"
    body = f"substring({_digits(m)}, 1, length({_digits(m)}) - 1)"
    new = _let(permuted_string(body, "'card'", key), "w", _filled(m, f"concat(w, cast((10 - {_luhn('w', 1)} % 10) % 10 as string))"))
    return valid, new


def _iban(m: str, key: str) -> tuple[str, str]:
    bare = f"replace({m}, ' ', '')"
    valid = f"length({bare}) between 15 and 34 and {_modulo97(f'concat(substring({bare}, 5), substring({bare}, 1, 4))')} = 1"
    check = f"lpad(cast(98 - {_modulo97(f'concat(w, substring({m}, 1, 2), 0, 0)')} as string), 2, '0')"
    place = f"length(replace(substring({m}, 1, p + 1), ' ', ''))"
    whole = f"concat(substring({m}, 1, 2), {check}, w)"
    laid = _let(whole, "z", f"array_join(transform(split({m}, ''), (e, p) -> if(e = ' ', e, substring(z, {place}, 1))), '')")
    return valid, _let(permuted_string(f"substring({bare}, 5)", f"concat('iban', substring({m}, 1, 2))", key), "w", laid)


def _phone(m: str, key: str) -> tuple[str, str]:
    valid = f"if({m} like '+%', length({_digits(m)}) between 8 and 15, length({_digits(m)}) = 10)"
    code = f"if({m} like '+%', coalesce(nullif(length(regexp_extract({m}, '^[+]([0-9]{{1,3}})[^0-9]', 1)), 0), 2), 0)"
    rest = permuted_string(f"substring({_digits(m)}, {code} + 1)", f"concat('phone', {code})", key)
    return valid, _let(rest, "w", _filled(m, f"concat(substring({_digits(m)}, 1, {code}), w)"))


def _ssn(m: str, key: str) -> tuple[str, str]:
    area, group, serial = (f"cast(substring({m}, {at}, {n}) as bigint)" for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0"
    number = f"(({area} - 1 - if({area} > 666, 1, 0)) * 99 + {group} - 1) * 9999 + {serial} - 1"
    back = ("concat(lpad(cast(w div 989901 + 1 + if(w div 989901 >= 665, 1, 0) as string), 3, '0'), '-', "
            "lpad(cast(w div 9999 % 99 + 1 as string), 2, '0'), '-', lpad(cast(w % 9999 + 1 as string), 4, '0'))")
    return valid, _let(permuted_number(number, "88902", "9999", "'ssn'", key), "w", back)


def _ip(m: str, key: str) -> tuple[str, str]:
    valid = f"forall(split({m}, '[.]'), e -> cast(e as int) <= 255 and (e = '0' or e not like '0%'))"
    number = f"aggregate(split({m}, '[.]'), cast(0 as bigint), (t, e) -> t * 256 + cast(e as bigint))"
    back = "concat_ws('.', w div 16777216, w div 65536 % 256, w div 256 % 256, w % 256)"
    return valid, _let(permuted_number(number, "65536", "65536", "'ip'", key), "w", back)


def _date(m: str, key: str) -> tuple[str, str]:
    first_year = f"({m} rlike '^[0-9]{{4}}')"
    part = lambda at, n: f"substring({m}, {at}, {n})"
    iso = f"concat({part(1, 4)}, '-', {part(6, 2)}, '-', {part(9, 2)})"
    day_first = f"concat({part(7, 4)}, '-', {part(4, 2)}, '-', {part(1, 2)})"
    month_first = f"concat({part(7, 4)}, '-', {part(1, 2)}, '-', {part(4, 2)})"
    as_date = lambda s: f"try_to_date({s}, 'yyyy-MM-dd')"
    day = f"if({first_year}, {as_date(iso)}, coalesce({as_date(day_first)}, {as_date(month_first)}))"
    valid = f"{day} is not null and year({day}) between 1600 and 2399"
    start = "make_date(year(d) div 100 * 100, 1, 1)"
    leap = "year(d) div 100 % 4 = 0"
    moved = permuted_number(f"datediff(d, {start})", f"if({leap}, 75, 92)", f"if({leap}, 487, 397)", "concat('date', year(d) div 100)", key)
    order = f"case when {first_year} then concat('yyyy', {part(5, 1)}, 'MM', {part(5, 1)}, 'dd') when {as_date(day_first)} is not null then concat('dd', {part(3, 1)}, 'MM', {part(3, 1)}, 'yyyy') else concat('MM', {part(3, 1)}, 'dd', {part(3, 1)}, 'yyyy') end"
    written = lambda d, f: f"replace(replace(replace({f}, 'yyyy', lpad(cast(year({d}) as string), 4, '0')), 'MM', lpad(cast(month({d}) as string), 2, '0')), 'dd', lpad(cast(day({d}) as string), 2, '0'))"
    return valid, _let(day, "d", _let(f"date_add({start}, cast({moved} as int))", "w", written("w", order)))


def _email(m: str, key: str) -> tuple[str, str]:
    local = f"substring_index({m}, '@', 1)"
    rest = f"substring({m}, length({local}) + 1)"
    return f"{local} rlike '[A-Za-z0-9]'", f"concat({permuted_string(local, f'lower({rest})', key)}, {rest})"


KINDS = {"email": _email, "iban": _iban, "ip": _ip, "ssn": _ssn, "date": _date, "phone": _phone, "card": _card}


def pseudonym(m: str, key: str) -> str:
    """SQL: struct (kind, value) for one candidate ``m``; an invalid one is null and ``m`` itself. The
    first kind whose pattern and rule hold decides."""
    cases = []
    for kind, rule in KINDS.items():
        valid, new = rule(m, key)
        # a lone candidate has nothing before or after it, so looking around always succeeds; back
        # references are numbered over the whole pattern and are re-numbered for each kind
        alone = PATTERNS[kind].replace(r"\2", r"\1").replace(r"\3", r"\1").replace(r"\4", r"\2")
        cases.append(f"when {m} rlike {_sql('^(?:' + alone + ')$')} and {valid} then named_struct('kind', '{kind}', 'value', {new})")
    return f"case {' '.join(cases)} else named_struct('kind', cast(null as string), 'value', {m}) end"


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with its text column rewritten, plus ``pii_values`` (long: values replaced) and ``pii_kinds``
    (array of their kinds, in text order). Texts without personal data stay as they are; null texts stay
    null and empty ones empty. Other columns and repeated rows stay; an empty table gives an empty
    result. The two new columns replace columns of those names."""
    found = F.when(F.col(text).rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))
    new = F.expr(f"transform(pii_found, m -> {pseudonym('m', key)})")
    # the pieces between the candidates, as many as there are and one more
    parts = F.split(F.col(text), CANDIDATE, -1)
    joined = F.expr("array_join(transform(pii_parts, (x, k) -> concat(x, if(k < size(pii_new), pii_new[k].value, ''))), '')")
    marked = docs.withColumn("pii_found", F.coalesce(found, F.array().cast("array<string>"))).withColumn("pii_new", new)
    some = F.exists("pii_new", lambda v: v["kind"].isNotNull())
    return (marked.withColumn("pii_parts", F.when(some, parts)).withColumn(text, F.when(some, joined).otherwise(F.col(text)))
            .withColumn("pii_kinds", F.filter(F.transform("pii_new", lambda v: v["kind"]), lambda k: k.isNotNull()))
            .withColumn("pii_values", F.size("pii_kinds").cast("long"))
            .drop("pii_found", "pii_new", "pii_parts"))
