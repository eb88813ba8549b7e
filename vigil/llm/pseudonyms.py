"""Format-preserving pseudonyms for personal numbers, dates and addresses.

DataFrame functions only.  One pattern finds candidates, each is validated
(Luhn sum of cards, mod-97 of IBANs, real calendar dates, number ranges), and
a valid value is replaced by a keyed permutation of the values of its format:
a Feistel network whose halves are added to keyed digests, digit by digit (and
letter by letter) or as numbers.  Equal values get equal pseudonyms in all
documents, as the permutation depends on key and kind alone; different values
stay different; ``inverse`` gives the originals back to a holder of the key.

| kind  | validated by | kept | permuted within |
| ----- | ------------ | ---- | --------------- |
| email | shape | top-level domain, marks, letter case | letters, digits |
| iban  | mod 97 | country | account characters; check digits follow |
| ip    | octet ranges | - | dotted quads |
| ipv6  | eight groups, or fewer beside one ``::`` | - | addresses, in canonical spelling |
| date  | calendar, 1700 to 2099 | separators, order of parts | days up to the 12th; later days |
| ssn   | area, group and serial ranges | dashes | valid numbers |
| card  | Luhn | first digit | the digits; the check digit follows |
| phone | 10 to 15 digits; a bare number of ten only with an area from 200 | first digit after a plus sign, marks | digits |

A day has one pseudonym in every order of its parts: days up to the 12th go
to such days, and later days to later ones, so a month-first date is still
read month first.  Days and months come back with two digits.  Ten national
digits have one pseudonym with and without ``+1`` and marks; whether area and
exchange start below 2 is kept.

Defined results: a null text stays null with no findings; an empty text stays
empty; invalid candidates stay as they are; repeated rows give equal results;
texts of any length are taken whole; there is no shuffle, so no key can be
hot.  ``columns`` of the input are passed through only when named in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "iban", "ip", "ipv6", "date", "ssn", "card", "phone")

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_DAY, _MONTH, _YEAR = r"(?:0?[1-9]|[12][0-9]|3[01])", r"(?:0?[1-9]|1[0-2])", r"(?:1[789]|20)[0-9]{2}"
_GROUP = r"[0-9A-Fa-f]{1,4}"
_DATE = "|".join(f"{_YEAR}{s}{_MONTH}{s}{_DAY}|{_DAY}{s}{_DAY}{s}{_YEAR}" for s in ("-", "/", r"\."))
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![A-Za-z0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9]|[A-Za-z])",
    "ipv6": rf"(?<![A-Za-z0-9:.])(?:{_GROUP}(?::{_GROUP}){{7}}|(?:{_GROUP}(?::{_GROUP}){{0,6}})?::(?:{_GROUP}(?::{_GROUP}){{0,6}})?)"
            r"(?![A-Za-z0-9:]|\.[0-9])",
    # a time of day may follow after T, a time zone after Z
    "date": rf"(?<![A-Za-z0-9./-])(?:{_DATE})(?![/.-]?[0-9]|(?!T[0-9]{{2}}|Z(?![A-Za-z0-9]))[A-Za-z])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "card": r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
    "phone": r"(?<![A-Za-z0-9+.-])[2-9][0-9]{9}(?![/.-]?[0-9]|[A-Za-z])|(?<![A-Za-z0-9+])\+[1-9][0-9]{9,14}(?![0-9A-Za-z])|"
             r"(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_FIRST_YEAR, _MONTHS = 1700, 4800  # 400 years, so the days of a whole calendar cycle
_LATER_DAYS = 88497  # days after the 12th of their month, as 9 * 9833
_HEX = "0123456789abcdef"


def _whole(kind: str) -> str:
    return rf"^(?:{PATTERNS[kind]})$"


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _digest(key: str, kind: str, i: Column, part: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(kind), i.cast("string"), part.cast("string")), 512)


def _rounds(inverse: bool) -> Column:
    return F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if inverse else range(ROUNDS))])


def _shifted(s: Column, digest: Column, sign: int) -> Column:
    """Each digit or letter of s moved within its class by the digest's value at its place."""
    def all_by(digest):
        def one(c, j):
            k = F.conv(F.substr(digest, F.pmod(j, F.lit(40)) * 3 + 1, F.lit(3)), 16, 10).cast("int") * sign
            code = F.ascii(c)
            move = lambda base, n: F.char(F.pmod(code - base + k, F.lit(n)) + base)
            return (F.when(c.rlike("^[0-9]$"), move(48, 10)).when(c.rlike("^[a-z]$"), move(97, 26))
                    .when(c.rlike("^[A-Z]$"), move(65, 26)).otherwise(c))

        return F.array_join(F.transform(F.filter(F.split(s, ""), lambda c: c != ""), one), "")

    return _once(digest, all_by)


def _shifted_hex(s: Column, digest: Column, sign: int) -> Column:
    """Each hex digit of s moved by the digest's digit at its place."""
    def all_by(digest):
        def one(c, j):
            k = F.conv(F.substr(digest, j + 1, F.lit(1)), 16, 10).cast("int") * sign
            return F.substr(F.lit(_HEX), F.pmod(F.conv(c, 16, 10).cast("int") + k, F.lit(16)) + 1, F.lit(1))

        return F.array_join(F.transform(F.split(s, ""), one), "")

    return _once(digest, all_by)


def permute_text(s: Column, key: str, kind: str, inverse: bool = False, shift=_shifted) -> Column:
    """Feistel permutation of the strings with the same classes of characters."""
    sign, cut = (-1 if inverse else 1), F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), cut).alias("l"), F.substr(s, cut + 1).alias("r"))

    def step(acc, i):
        even = i % 2 == 0
        by = _digest(key, kind, i, F.lower(F.when(even, acc["r"]).otherwise(acc["l"])))
        moved = shift(F.when(even, acc["l"]).otherwise(acc["r"]), by, sign)
        return F.struct(F.when(even, moved).otherwise(acc["l"]).alias("l"),
                        F.when(even, acc["r"]).otherwise(moved).alias("r"))

    return F.aggregate(_rounds(inverse), start, step, lambda a: F.concat(a["l"], a["r"]))


def permute_number(x: Column, a: int | Column, b: int | Column, key: str, kind: str, inverse: bool = False) -> Column:
    """Feistel permutation of 0 .. a*b-1 (two residues, added alternately)."""
    sign = -1 if inverse else 1
    start = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))

    def step(acc, i):
        even = i % 2 == 0
        by = F.conv(F.substr(_digest(key, kind, i, F.when(even, acc["r"]).otherwise(acc["l"])), F.lit(1), F.lit(12)),
                    16, 10).cast("long") * sign
        return F.struct(F.when(even, F.pmod(acc["l"] + by, F.lit(a))).otherwise(acc["l"]).alias("l"),
                        F.when(even, acc["r"]).otherwise(F.pmod(acc["r"] + by, F.lit(b))).alias("r"))

    return F.aggregate(_rounds(inverse), start, step, lambda s: s["l"] * b + s["r"])


def _only_digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(s: Column, digits: Column) -> Column:
    """s with its digits replaced in order by ``digits``."""
    return _once(digits, lambda new: F.aggregate(
        F.split(s, ""), F.struct(F.lit(0).alias("i"), F.lit("").alias("o")), lambda a, c: F.when(
            c.rlike("^[0-9]$"), F.struct((a["i"] + 1).alias("i"), F.concat(a["o"], F.substr(new, a["i"] + 1, F.lit(1))).alias("o")))
        .otherwise(F.struct(a["i"].alias("i"), F.concat(a["o"], c).alias("o"))), lambda a: a["o"]))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum (mod 10) of a digit string whose last digit is the check digit."""
    ds = F.transform(F.split(F.reverse(digits), ""), lambda c, j: F.when(
        j % 2 == 1, F.floor(c.cast("int") * 2 / 10) + F.pmod(c.cast("int") * 2, F.lit(10))).otherwise(c.cast("int")).cast("long"))
    return F.pmod(F.aggregate(ds, F.lit(0).cast("long"), lambda a, d: a + d), F.lit(10))


def mod97(s: Column) -> Column:
    """Remainder of an IBAN-ordered string (letters as 10 to 35)."""
    def step(a, c):
        v = F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.pmod(a * F.when(v > 9, F.lit(100)).otherwise(F.lit(10)) + v, F.lit(97)).cast("int")

    return F.aggregate(F.split(s, ""), F.lit(0), step)


def _permuted_day(day: Column, key: str, inverse: bool) -> Column:
    """Another day of 1700 to 2099 on the same side of the 12th."""
    base = F.lit(f"{_FIRST_YEAR}-01-01").cast("date")
    months = (F.year(day) - _FIRST_YEAR) * 12 + F.month(day) - 1
    dated = lambda month, d: F.date_add(F.add_months(base, month.cast("int")), d.cast("int"))
    # later days are numbered by the days since the first one less the twelve early ones of each month
    before = lambda month: F.date_diff(F.add_months(base, month.cast("int")), base) - month * 12

    def later(y):
        # month lengths stray from their mean by less than a month
        near = F.floor(y * _MONTHS / _LATER_DAYS).cast("int")
        month = F.when(before(near + 1) <= y, near + 1).when(before(near) <= y, near).otherwise(near - 1)
        return _once(month, lambda n: dated(n, y - before(n) + 12))

    early = permute_number(months * 12 + F.dayofmonth(day) - 1, 240, 240, key, "early-day", inverse)
    late = permute_number(F.date_diff(day, base) - (months + 1) * 12, 9, _LATER_DAYS // 9, key, "later-day", inverse)
    return F.when(F.dayofmonth(day) <= 12, _once(early, lambda y: dated(F.floor(y / 12), F.pmod(y, F.lit(12))))) \
        .otherwise(_once(late, later))


def _date(m: Column, key: str, inverse: bool) -> Column:
    sep = F.regexp_extract(m, "[-/.]", 0)
    p = F.split(m, "[-/.]")
    iso = F.length(p[0]) == 4
    day = lambda y, mo, d: F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")
    dmy, mdy = day(p[2], p[1], p[0]), day(p[2], p[0], p[1])
    value = F.when(iso, day(p[0], p[1], p[2])).otherwise(F.coalesce(dmy, mdy))
    form = F.when(iso, "yyyy-MM-dd").when(dmy.isNotNull(), "dd-MM-yyyy").otherwise("MM-dd-yyyy")
    text = _once(value, lambda v: F.call_function("date_format", _permuted_day(v, key, inverse), form))
    return F.when(value.isNotNull(), F.replace(text, F.lit("-"), sep))


def _ten_digits(d: Column, key: str, inverse: bool) -> Column:
    """Ten national digits; area and exchange stay below 200 or from 200 up."""
    at = lambda i, n=1: F.substr(d, F.lit(i), F.lit(n)).cast("long")
    low = lambda c: F.when(c < 2, 0).otherwise(2)
    size = lambda c: F.when(c < 2, 2).otherwise(8) * 10000

    def permuted(n):
        x = ((n.area - n.area0) * 10000 + at(2, 2) * 100 + at(5, 2)) * n.b + (n.exchange - n.exchange0) * 10000 + at(7, 4)
        return _once(permute_number(x, n.a, n.b, key, "ten-digits", inverse), lambda y: written(n, y))

    def written(n, y):
        l, r = F.floor(y / n.b), F.pmod(y, n.b)
        return F.format_string("%d%02d%d%02d%04d", F.floor(l / 10000) + n.area0, F.pmod(F.floor(l / 100), F.lit(100)),
                               F.floor(r / 10000) + n.exchange0, F.pmod(l, F.lit(100)), F.pmod(r, F.lit(10000)))

    return _once(F.struct(at(1).alias("area"), at(4).alias("exchange"), low(at(1)).alias("area0"), low(at(4)).alias("exchange0"),
                          size(at(1)).alias("a"), size(at(4)).alias("b")), permuted)


def _ipv6(m: Column, key: str, inverse: bool) -> Column:
    def eight(sides):
        # zero groups in the place of the double colon
        given = F.size(F.flatten(sides))
        full = F.when(F.size(sides) == 1, F.when(given == 8, sides[0])).when(
            given.between(1, 7), F.concat(sides[0], F.array_repeat(F.lit("0"), 8 - given), sides[1]))
        return F.array_join(F.transform(full, lambda g: F.lpad(g, 4, "0")), "")

    sides = F.transform(F.split(F.lower(m), "::"), lambda p: F.filter(F.split(p, ":"), lambda g: g != ""))

    def spelled(h):
        parts = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.regexp_replace(
            F.substr(h, i * 4 + 1, F.lit(4)), "^0{1,3}", ""))
        return _once(F.concat(F.lit(":"), F.array_join(parts, ":"), F.lit(":")), shortened)

    def shortened(s):
        # the first of the longest runs of two or more zero groups goes
        out = s
        for n in range(2, 9):
            run = ":" + "0:" * n
            at = F.locate(run, s)
            out = F.when(at > 0, F.concat(F.substr(s, F.lit(1), at - 1), F.lit("::"),
                                          F.substr(s, at + len(run)))).otherwise(out)
        return F.regexp_replace(out, "^:(?!:)|(?<!:):$", "")

    permuted = lambda h: _once(permute_text(h, key, "ipv6", inverse, _shifted_hex), spelled)
    return F.when(m.rlike("[0-9]"), _once(_once(sides, eight), lambda h: F.when(h.isNotNull(), permuted(h))))


def _pseudonym(kind: str, m: Column, key: str, inverse: bool) -> Column:
    """The pseudonym of a match, null when it isn't valid."""
    if kind == "email":
        name = F.regexp_extract(m, r"^(.*)(\.[A-Za-z]+)$", 1)
        return F.concat(permute_text(name, key, kind, inverse), F.regexp_extract(m, r"(\.[A-Za-z]+)$", 1))
    if kind == "ip":
        x = F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda a, c: a * 256 + c.cast("long"))
        y = permute_number(x, 65536, 65536, key, kind, inverse)
        return F.concat_ws(".", *[F.pmod(F.floor(y / d), F.lit(256)).cast("string") for d in (1 << 24, 1 << 16, 256, 1)])
    if kind == "ipv6":
        return _ipv6(m, key, inverse)
    if kind == "date":
        return _date(m, key, inverse)
    if kind == "ssn":
        a, g, s = (F.split(m, "-")[i].cast("long") for i in range(3))
        valid = (a > 0) & (a < 900) & (a != 666) & (g > 0) & (s > 0)
        x = (a - 1 - F.when(a > 666, 1).otherwise(0)) * (99 * 9999) + (g - 1) * 9999 + s - 1
        y = permute_number(x, 898, 99 * 9999, key, kind, inverse)
        area = F.floor(y / (99 * 9999)) + 1
        rest = F.pmod(y, F.lit(99 * 9999))
        return F.when(valid, F.format_string("%03d-%02d-%04d", (area + F.when(area >= 666, 1).otherwise(0)).cast("long"),
                                             (F.floor(rest / 9999) + 1).cast("long"), F.pmod(rest, F.lit(9999)) + 1))
    d = _only_digits(m)
    if kind == "card":
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)),
                        permute_text(F.substr(d, F.lit(2), F.length(d) - 2), key, kind, inverse))
        checked = _once(body, lambda b: F.concat(b, F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(luhn_sum(d) == 0, _refill(m, checked))
    if kind == "phone":
        lead = F.when(m.startswith("+"), F.lit(1)).otherwise(F.lit(0))
        national = ((lead == 0) & (F.length(d) == 10)) | ((lead == 1) & (F.length(d) == 11) & d.startswith("1"))
        rest = F.substr(d, lead + 1)
        new = F.concat(F.substr(d, F.lit(1), lead), F.when(national, _once(rest, lambda r: _ten_digits(r, key, inverse)))
                       .otherwise(permute_text(rest, key, kind, inverse)))
        return F.when(F.length(d).between(10, 15), _refill(m, new))
    flat = F.replace(m, F.lit(" "), F.lit(""))  # iban
    country, account = F.substr(flat, F.lit(1), F.lit(2)), F.substr(flat, F.lit(5))
    valid = mod97(F.concat(account, country, F.substr(flat, F.lit(3), F.lit(2)))) == 1
    check = lambda a: F.lpad((98 - mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0")
    new = _once(permute_text(account, key, kind, inverse), lambda a: F.concat(country, check(a), a))
    return F.when(valid, F.when(m.contains(" "), F.trim(F.regexp_replace(new, "(.{4})", "$1 "))).otherwise(new))


def _found(m: Column, key: str, inverse: bool) -> Column:
    """struct(kind, value) of a match; a null kind leaves the match as it is."""
    kind, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k in reversed(KINDS):
        is_k = m.rlike(_whole(k))
        p = _pseudonym(k, m, key, inverse)
        value = F.when(is_k, p).otherwise(value)
        kind = F.when(is_k, F.lit(k)).otherwise(kind)
    return F.struct(kind.alias("kind"), value.alias("value"))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 inverse: bool = False) -> DataFrame:
    """``keep`` columns, the text with pseudonyms, n_found, and n_<kind> counts."""
    d = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    maybe = F.col("__text").rlike("[0-9@]")
    none = F.expr("cast(array() as array<string>)")
    d = d.withColumn("__m", F.when(maybe, F.regexp_extract_all("__text", F.lit(ANY), F.lit(0))).otherwise(none))
    d = d.withColumn("__p", F.transform("__m", lambda m: _found(m, key, inverse)))
    woven = F.zip_with(F.split("__text", ANY, -1), F.zip_with("__m", "__p", lambda m, p: F.coalesce(p["value"], m)),
                       lambda gap, m: F.concat(gap, F.coalesce(m, F.lit(""))))
    hit = F.expr("transform(filter(__p, p -> p.value is not null), p -> p.kind)")
    d = d.withColumn("__hit", hit)
    return d.select(
        *keep, F.when(F.size("__hit") > 0, F.array_join(woven, "")).otherwise(F.col("__text")).alias(text),
        F.greatest(F.coalesce(F.size("__hit"), F.lit(0)), F.lit(0)).cast("long").alias("n_found"),
        *[F.coalesce(F.size(F.expr(f"filter(__hit, k -> k = '{kind}')")), F.lit(0)).cast("long").alias(f"n_{kind}")
          for kind in KINDS])
