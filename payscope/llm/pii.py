"""Pseudonyms for personal data that keep its format, with Spark expressions only.

Candidates are found by form and validated: card numbers by issuer and check digit, account
numbers (IBAN) by theirs, addresses of machines by their ranges, social security numbers by
theirs, dates by the calendar. What holds up goes through a keyed Feistel network over its
own format: the halves of a number in mixed radix, rounds that add a keyed hash of one
half to the other. That is a permutation, so equal values get equal pseudonyms in every
document, different ones different, and each is valid again. All else stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import fresh, whole_text

ROUNDS = 8  # even, so that the halves end where they began
#: Days of the calendar's cycle of 400 years, as a product of its two halves' sizes.
CYCLE = (209, 699)

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DAY, _MONTH = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])"
_END = r"(?![.\-/][0-9])"
_DATES = {  # form -> how Spark writes it; the last that fits counts, so short ones come first
    rf"[0-9]{{4}}-{_MONTH}-{_DAY}{_END}": "yyyy-M-d",
    rf"[0-9]{{4}}/{_MONTH}/{_DAY}{_END}": "yyyy/M/d",
    rf"{_DAY}\.{_MONTH}\.[0-9]{{4}}{_END}": "d.M.yyyy",
    rf"{_MONTH}/{_DAY}/[0-9]{{4}}{_END}": "M/d/yyyy",
    r"[0-9]{4}/(?:0[1-9]|1[0-2])/[0-3][0-9]": "yyyy/MM/dd",
    r"[0-9]{4}-(?:0[1-9]|1[0-2])-[0-3][0-9]": "yyyy-MM-dd",
    r"[0-3][0-9]\.(?:0[1-9]|1[0-2])\.[0-9]{4}": "dd.MM.yyyy",
    r"(?:0[1-9]|1[0-2])/[0-3][0-9]/[0-9]{4}": "MM/dd/yyyy",
}
#: A mailbox has 64 characters, a host 127 labels of 63 at most. The engine goes one call deeper for each
#: repeat of a group, so a group that could repeat without end would overflow its stack.
_LABELS = r"(?:[A-Za-z0-9\-]{1,63}+\.){1,126}"
FORMS = {
    "email": rf"[A-Za-z0-9._%+\-]{{1,64}}+@{_LABELS}[A-Za-z]{{2,24}}",
    "ip": rf"(?:{_OCTET}\.){{3}}{_OCTET}(?!\.[0-9])",
    "date": "|".join(_DATES),
    "ssn": r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
    "card": r"[0-9]{13,19}|[0-9]{4}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}([ \-])[0-9]{6}\2[0-9]{5}",
    "phone": r"(?:\+[0-9]{1,3}[ .\-]?)?\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-][0-9]{4}|(?:\+[0-9]{1,3}[ .\-])?[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}"
    r"|\+[0-9]{1,3}(?:[ .\-][0-9]{2,4}){3,4}",
}
#: How card numbers of the known issuers begin.
ISSUERS = "^(4|5[1-5]|2(22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[0-9]|6[0245])"
#: One expression with no groups of its own, so that it splits and extracts alike. The
#: order decides between forms; nothing starts or ends inside a word or number.
_ANY = "|".join(f"(?:{FORMS[k]})" for k in ("email", "iban", "ip", "date", "ssn", "card", "phone"))
_ANY = _ANY.replace("([ \\-])[0-9]{4}\\1[0-9]{4}\\1", "(?: [0-9]{4} [0-9]{4} |-[0-9]{4}-[0-9]{4}-)").replace(
    "([ \\-])[0-9]{6}\\2", "(?: [0-9]{6} |-[0-9]{6}-)"
)
#: An ISO date may be followed by its time.
_STOP = r"(?:(?![A-Za-z0-9])|(?<=[0-9]{4}-[0-9]{2}-[0-9]{2})(?=[Tt][0-9]{2}))"
PATTERN = rf"(?<![A-Za-z0-9._%+\-])(?:{_ANY}){_STOP}|(?<![A-Za-z0-9.+\-])(?:{_ANY}){_STOP}"


def _hash(key: str, kind: str, *what: Column) -> Column:
    """60 bits of a keyed SHA-256."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), *[w.cast("string") for w in what])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _feistel(key: str, kind: str, a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """Struct (a, b) with a < size_a and b < size_b, permuted."""
    first = F.struct(*[c.cast("long").alias(n) for c, n in ((a, "a"), (b, "b"), (size_a, "m"), (size_b, "n"))])
    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    return F.aggregate(
        rounds,
        first,
        lambda s, r: F.struct(
            s.b.alias("a"), F.pmod(s.a + _hash(key, kind, r, s.b, s.m) % s.m, s.m).alias("b"), s.n.alias("m"), s.m.alias("n")
        ),
    )


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _ten(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _part(text: Column, start: Column | int, length: Column | int | None = None) -> Column:
    start = F.lit(start) if isinstance(start, int) else start
    length = F.length(text) if length is None else F.lit(length) if isinstance(length, int) else length
    return F.substring(text, start, length)


def _permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """A string of 2 to 18 digits as another of its length."""

    def halves(d: Column) -> Column:
        left = F.floor(F.length(d) / 2).cast("int")
        right = F.length(d) - left
        mixed = _feistel(key, kind, _part(d, 1, left), _part(d, left + 1), _ten(left), _ten(right))
        return _let(mixed, lambda s: F.concat(F.lpad(s.a.cast("string"), left, "0"), F.lpad(s.b.cast("string"), right, "0")))

    return _let(digits, halves)


def _filled(form: Column, digits: Column) -> Column:
    """The text with its digits replaced by those given, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(
        F.split(form, ""),
        start,
        lambda s, c: F.when(
            c.rlike("^[0-9]$"), F.struct(F.concat(s.out, F.substring(digits, s.at, F.lit(1))).alias("out"), (s.at + 1).alias("at"))
        ).otherwise(F.struct(F.concat(s.out, c).alias("out"), s.at.alias("at"))),
        lambda s: s.out,
    )


def _luhn(payload: Column) -> Column:
    """The check digit of a string of digits, as a string."""
    figures = F.reverse(F.split(payload, ""))
    weighed = F.transform(figures, lambda c, i: _let(c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    total = F.aggregate(weighed, F.lit(0), lambda s, v: s + v)
    return ((F.lit(10) - total % 10) % 10).cast("string")


def _card(key: str, m: Column) -> Column:
    """The issuer's digits stay, the account is permuted, the check digit follows."""

    def checked(d: Column) -> Column:
        body = _part(d, 1, F.length(d) - 1)
        fresh = _let(F.concat(_part(d, 1, 4), _permuted_digits(key, "card", _part(d, 5, F.length(d) - 5))), lambda p: F.concat(p, _luhn(p)))
        return F.when(d.rlike(ISSUERS) & (_luhn(body) == F.right(d, F.lit(1))), _filled(m, fresh))

    return _let(_digits(m), checked)


def _ip(key: str, m: Column) -> Column:
    def mixed(o: Column) -> Column:
        n = lambda i: F.element_at(o, i).cast("long")
        whole = _feistel(key, "ip", n(1) * 256 + n(2), n(3) * 256 + n(4), F.lit(65536), F.lit(65536))
        low = lambda v: (v % 256).cast("string")
        high = lambda v: F.floor(v / 256).cast("string")
        return _let(whole, lambda s: F.concat_ws(".", high(s.a), low(s.a), high(s.b), low(s.b)))

    return _let(F.split(m, r"\."), mixed)


def _date(key: str, m: Column) -> Column:
    def mixed(days: Column) -> Column:
        a, b = CYCLE
        since = F.pmod(days, F.lit(a * b))
        return _let(
            _feistel(key, "date", F.floor(since / b), since % b, F.lit(a), F.lit(b)),
            lambda s: F.date_add(F.lit("1600-01-01").cast("date"), (days - since + s.a * b + s.b).cast("int")),
        )

    # Which form a text has; short forms may still have some zeros in front.
    which, day = F.lit(-1), F.lit(None).cast("date")
    short = F.regexp_replace(m, "(?<![0-9])0(?=[0-9](?![0-9]))", "")
    for i, (form, name) in enumerate(_DATES.items()):
        fits, text = m.rlike(f"^{form}$"), m if "MM" in name else short
        found = F.try_to_timestamp(text, F.lit(name)).cast("date")
        day = F.when(fits, F.when(F.date_format(found, name) == text, found)).otherwise(day)
        which = F.when(fits, i).otherwise(which)

    def written(new: Column) -> Column:
        out = F.lit(None).cast("string")
        for i, name in enumerate(_DATES.values()):
            out = F.when(which == i, F.date_format(new, name)).otherwise(out)
        return out

    return _let(_let(F.datediff(day, F.lit("1600-01-01").cast("date")), mixed), written)


def _ssn(key: str, m: Column) -> Column:
    def mixed(p: Column) -> Column:
        area = F.element_at(p, 1).cast("int")
        rank = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + F.element_at(p, 2).cast("int") - 1
        two = lambda v, n: F.lpad(v.cast("string"), n, "0")

        def written(s: Column) -> Column:
            area = F.floor(s.a / 99) + 1
            return F.concat_ws("-", two(area + F.when(area >= 666, 1).otherwise(0), 3), two(s.a % 99 + 1, 2), two(s.b + 1, 4))

        return _let(_feistel(key, "ssn", rank, F.element_at(p, 3).cast("int") - 1, F.lit(898 * 99), F.lit(9999)), written)

    return _let(F.split(m, "-"), mixed)


def _shifted(text: Column, by: Column) -> Column:
    """Letters and digits moved on within their kind, by two hex digits of ``by`` each."""

    def move(c: Column, i: Column) -> Column:
        k = F.conv(F.substring(by, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        on = lambda first, n: F.chr((F.lit(first) + F.pmod(F.ascii(c) - first + k, F.lit(n))).cast("long"))
        return F.when(c.rlike("^[0-9]$"), on(48, 10)).when(c.rlike("^[a-z]$"), on(97, 26)).when(c.rlike("^[A-Z]$"), on(65, 26)).otherwise(c)

    return F.when(F.length(text) == 0, text).otherwise(F.array_join(F.transform(F.split(text, ""), move), ""))


def _permuted_text(key: str, kind: str, text: Column) -> Column:
    """Letters and digits permuted among texts of the same form."""
    left = F.floor(F.length(text) / 2).cast("int")
    first = F.struct(F.substring(text, F.lit(1), left).alias("a"), F.substring(text, left + 1, F.length(text)).alias("b"))
    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])

    def turn(s: Column, r: Column) -> Column:
        return F.struct(s.b.alias("a"), _shifted(s.a, F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), s.b), 256)).alias("b"))

    return F.aggregate(rounds, first, turn, lambda s: F.concat(s.a, s.b))


def _email(key: str, m: Column) -> Column:
    """The local part is permuted, so addresses stay with their domain."""
    at = F.instr(m, "@")
    return F.concat(_let(F.substring(m, F.lit(1), at - 1), lambda t: _permuted_text(key, "email", t)), F.substring(m, at, F.length(m)))


def _mod97(text: Column) -> Column:
    """The account number's remainder: its first four signs go last, letters count from 10."""
    moved = F.split(F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, F.lit(1), F.lit(4))), "")

    def fold(s: Column, c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), (s * 10 + c.cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(moved, F.lit(0), fold)


def _iban(key: str, m: Column) -> Column:
    def checked(flat: Column) -> Column:
        body = _let(F.substring(flat, F.lit(5), F.length(flat)), lambda t: _permuted_text(key, "iban", t))
        land = F.substring(flat, F.lit(1), F.lit(2))
        fresh = _let(body, lambda t: F.concat(land, F.lpad((F.lit(98) - _mod97(F.concat(land, F.lit("00"), t))).cast("string"), 2, "0"), t))
        spaced = _let(fresh, lambda t: F.when(m.contains(" "), F.trim(F.regexp_replace(t, "(.{4})", "$1 "))).otherwise(t))
        return F.when(_mod97(flat) == 1, spaced)

    return _let(F.replace(m, F.lit(" "), F.lit("")), checked)


def _phone(key: str, m: Column) -> Column:
    """The country code stays, the rest is permuted."""
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .\-(])", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    return F.concat(code, _filled(rest, _permuted_digits(key, "phone", _digits(rest))))


def _whole(kind: str) -> str:
    return f"^(?:{FORMS[kind]})$"


def pseudonym(key: str, m: Column) -> Column:
    """Struct (kind, value) of one candidate; kind is null where it isn't valid."""
    makers = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}
    out = F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value"))
    for kind, make in reversed(makers.items()):
        valid = _let(make(key, m), lambda v: F.struct(F.when(v.isNotNull(), kind).alias("kind"), F.coalesce(v, m).alias("value")))
        out = F.when(m.rlike(_whole(kind)), valid).otherwise(out)
    return out


def pseudonymize(docs: DataFrame, key: str, text: str = "text", found: str = "found") -> DataFrame:
    """``docs`` with its text rewritten and a column ``found`` (or as named), the array of
    (kind, value) of the pseudonyms in it, in order. ``key`` is the secret of the permutation.

    A null text stays null with nothing found; so do empty ones and empty tables. Repeated
    rows are rewritten alike; other columns stay. A column that has the name of ``found``
    already is an error, since it would be lost.
    """
    if found.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {found} already; pass another name for what is found")
    body = whole_text(text)
    made, gaps = fresh(docs, "_made"), fresh(docs, "_gaps")
    # Most texts have no digit or @ and skip both searches.
    held = F.when(body.rlike("[0-9@]"), F.regexp_extract_all(body, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    between = F.when(F.size(made) == 0, F.array(body)).otherwise(F.split(body, PATTERN))
    rest = F.transform(made, lambda s, i: F.concat(s.value, F.col(gaps)[i + 1]))
    return (
        docs.withColumn(made, F.transform(held, lambda m: pseudonym(key, m)))
        .withColumn(gaps, between)
        .withColumn(text, F.when(F.col(text).isNotNull(), F.concat(F.col(gaps)[0], F.array_join(rest, ""))))
        .withColumn(found, F.filter(made, lambda s: s.kind.isNotNull()))
        .drop(made, gaps)
    )
