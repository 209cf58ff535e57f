"""PII: format-preserving Feistel pseudonyms, as column expressions only.

Candidates are found by one pattern over the whole text; the text is split at the matches
and joined again with each match replaced, so no row moves.  A match is replaced only when
it is valid: card numbers by the Luhn digit, dates by the calendar (1800-2199), social
security numbers by their assigned ranges, IPv4 by its octets, phone numbers abroad by their
8 to 15 digits.  A North American number marked by +1 or by an area code in parentheses is one
whatever its ten digits, with or without separators (blank, dot or dash); an unmarked one needs
its separators and an area code and exchange of 200 to 999.  The value becomes a pair (a, b) in
Z_A x Z_B and goes through ten rounds that add a keyed SHA-256 digest of one half to the
other, a permutation of the format's own domain: the same value gets the same pseudonym in
every document, and two values of one format never share one.  Letters, separators and
lengths stay, but for dates with a day or month of one digit; a card gets its own check digit.  Mail addresses are no numbers: their local
part becomes a keyed digest, the domain stays.

Defined cases: a null text stays null with no replacements; empty texts stay; repeated rows
each give a row; an empty table gives an empty table; extra columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoflow.llm.common import whole_row

#: Key of the pseudonyms; a run on real data passes its own secret.
DEFAULT_KEY = "promoflow-pseudonyms-1"
ROUNDS = 10

# The formats.
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
_IN_YEAR = "(?:0?[1-9]|[12][0-9]|3[01])"  # a day or a month, in either order
_ISO_DATE = ("(?<![0-9])[0-9]{4}(?:[-/][0-9]{2}[-/][0-9]{2}|"
             + "|".join(f"{s}{_IN_YEAR}{s}{_IN_YEAR}" for s in ("-", "/", r"\.")) + ")(?![0-9])")
_DAY_DATE = ("(?<![0-9])(?:[0-9]{2}[./][0-9]{2}[./]|"
             + "|".join(f"{_IN_YEAR}{s}{_IN_YEAR}{s}" for s in ("-", "/", r"\.")) + ")[0-9]{4}(?![0-9])")
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
_IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
_CARD = (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}"
         r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])")
_PHONE = (r"(?:(?<![0-9+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
          r"|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
          r"|(?<![0-9+])[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4})(?![0-9])")
_PHONE_ABROAD = r"(?<![0-9+])\+[2-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,5}\)?){2,6}(?![0-9])"
ANY = "|".join([_EMAIL, _ISO_DATE, _DAY_DATE, _SSN, _IP, _CARD, _PHONE, _PHONE_ABROAD])
KINDS = ("card", "date", "email", "ip", "phone", "ssn")

#: Days of 1800-01-01 to 2199-12-31, a whole Gregorian cycle: 189 * 773.
_DAYS = (189, 773)
_DAY_0 = -62091  # 1800-01-01 in days since 1970-01-01


def _digest(key: str, tag: str, r: Column, half: Column) -> Column:
    """60 bits of a keyed digest of one half."""
    text = F.concat(F.lit(f"{key}|{tag}|"), r.cast("string"), F.lit("|"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("bigint")


def feistel(value: Column, a_size, b_size, key: str, tag: str) -> Column:
    """Keyed permutation of 0 <= value < a_size * b_size."""
    A, B = (x if isinstance(x, Column) else F.lit(x).cast("bigint") for x in (a_size, b_size))
    start = F.struct(F.floor(value / B).cast("bigint").alias("a"), F.pmod(value, B).alias("b"))
    if isinstance(b_size, Column) or b_size > 1 << 20:  # exact for large values
        start = F.struct(((value - F.pmod(value, B)) / B).cast("bigint").alias("a"), F.pmod(value, B).alias("b"))

    def turn(s, r):
        even = r % 2 == 0
        a = F.when(even, F.pmod(s["a"] + F.pmod(_digest(key, tag, r, s["b"]), A), A)).otherwise(s["a"])
        b = F.when(even, s["b"]).otherwise(F.pmod(s["b"] + F.pmod(_digest(key, tag, r, s["a"]), B), B))
        return F.struct(a.alias("a"), b.alias("b"))

    return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), start, turn, lambda s: s["a"] * B + s["b"])


def _pow10(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _zeros(v: Column, n) -> Column:
    return F.lpad(v.cast("string"), n, "0")


def permute_digits(digits: Column, key: str, tag: str) -> Column:
    """Keyed permutation of the digit strings of one length (at most 18)."""
    n = F.length(digits)
    low = n - F.floor(n / 2).cast("int")
    return _zeros(feistel(digits.cast("bigint"), _pow10(n - low), _pow10(low), key, tag), n)


def _refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order, by ``digits``."""
    def put(s, c):
        is_digit = c.between("0", "9")
        return F.struct(F.concat(s["t"], F.when(is_digit, F.substr(digits, s["k"], F.lit(1))).otherwise(c)).alias("t"),
                        F.when(is_digit, s["k"] + 1).otherwise(s["k"]).alias("k"))
    return F.aggregate(F.split(form, ""), F.struct(F.lit("").alias("t"), F.lit(1).alias("k")), put, lambda s: s["t"])


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    n = F.length(d)
    body = permute_digits(F.substr(d, F.lit(1), n - 1), key, "card")
    closed = F.transform(F.array(body), lambda b: F.concat(b, F.filter(
        F.array(*[F.lit(str(i)) for i in range(10)]), lambda c: F.call_function("luhn_check", F.concat(b, c)))[0]))[0]
    return _refill(m, closed)


def _days(day: Column, key: str) -> Column:
    """The pseudonym of a date; null outside 1800-2199."""
    v = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") - _DAY_0
    new = feistel(v, *_DAYS, key, "date")
    return F.when((v >= 0) & (v < _DAYS[0] * _DAYS[1]), F.date_add(F.lit("1800-01-01").cast("date"), new.cast("int")))


def _date(m: Column, key: str) -> Column:
    """Year first; else day first; else month first where only that is a date.  A day or a month
    of one digit is written without a zero, so that it may become two digits."""
    p = F.split(m, "[-/.]")
    mark = lambda i: F.substr(m, i, F.lit(1))
    marks = mark(F.length(p[0]) + 1), mark(F.length(p[0]) + F.length(p[1]) + 2)

    def read(y, mo, d):
        day = F.try_to_date(F.concat_ws("-", p[y], F.lpad(p[mo], 2, "0"), F.lpad(p[d], 2, "0")), "yyyy-MM-dd")
        short = lambda x, i, f: F.when(F.length(p[i]) == 1, F.date_format(x, f)).otherwise(F.date_format(x, f * 2))

        def put(x):
            out = {y: F.date_format(x, "yyyy"), mo: short(x, mo, "M"), d: short(x, d, "d")}
            return F.concat(out[0], marks[0], out[1], marks[1], out[2])
        return F.transform(F.array(_days(day, key)), put)[0]

    return F.when(F.length(p[0]) == 4, read(0, 1, 2)).otherwise(F.coalesce(read(2, 1, 0), read(2, 0, 1)))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substr(m, F.lit(i), F.lit(n)).cast("bigint") for i, n in ((1, 3), (5, 2), (8, 4)))
    place = F.when(area > 666, area - 2).otherwise(area - 1)  # areas 1 to 899 without 666
    new = feistel((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, key, "ssn")
    parts = lambda v: F.concat_ws("-", _zeros(
        F.when(F.floor(v / 989901) >= 665, F.floor(v / 989901) + 2).otherwise(F.floor(v / 989901) + 1), 3),
        _zeros(F.pmod(F.floor(v / 9999), F.lit(99)) + 1, 2), _zeros(F.pmod(v, F.lit(9999)) + 1, 4))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(ok, F.transform(F.array(new), parts)[0])


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    v = F.aggregate(octets, F.lit(0).cast("bigint"), lambda s, x: s * 256 + x)
    new = feistel(v, 65536, 65536, key, "ip")
    parts = lambda x: F.concat_ws(".", *[
        F.pmod(F.shiftright(x, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])
    return F.when(F.forall(octets, lambda x: x <= 255), F.transform(F.array(new), parts)[0])


def _phone(m: Column, key: str) -> Column:
    """Area code and exchange stay within 200-999 where both are; all other numbers are permuted
    among themselves.  A leading +1 stays."""
    d = F.regexp_replace(_digits(m), "^1(?=[0-9]{10}$)", "")
    area, exchange, line = (F.substr(d, F.lit(i), F.lit(n)).cast("bigint") for i, n in ((1, 3), (4, 3), (7, 4)))
    new = feistel(((area - 200) * 800 + exchange - 200) * 10000 + line, 80000, 80000, key, "phone")
    parts = lambda v: F.concat(
        _zeros(F.floor(v / 8000000) + 200, 3), _zeros(F.pmod(F.floor(v / 10000), F.lit(800)) + 200, 3),
        _zeros(F.pmod(v, F.lit(10000)), 4))
    # The others: 200 areas of 1,000 exchanges, then 800 areas of 200 exchanges.
    place = F.when(area < 200, area * 1000 + exchange).otherwise(200000 + (area - 200) * 200 + exchange)
    other = feistel(place * 10000 + line, 60000, 60000, key, "phone-other")
    high = lambda v: F.floor(v / 10000) - 200000
    other_parts = lambda v: F.concat(
        F.when(high(v) < 0, _zeros(F.floor(v / 10000), 6)).otherwise(F.concat(
            _zeros(F.floor(high(v) / 200) + 200, 3), _zeros(F.pmod(high(v), F.lit(200)), 3))),
        _zeros(F.pmod(v, F.lit(10000)), 4))
    lead = F.when(m.startswith("+"), F.lit("1")).otherwise("")
    return _refill(m, F.concat(lead, F.when((area >= 200) & (exchange >= 200), F.transform(F.array(new), parts)[0])
                               .otherwise(F.transform(F.array(other), other_parts)[0])))


def _phone_abroad(m: Column, key: str) -> Column:
    """The first digit of the country code stays, all others are permuted."""
    d = _digits(m)
    new = F.concat(F.substr(d, F.lit(1), F.lit(1)),
                   permute_digits(F.substr(d, F.lit(2), F.length(d) - 1), key, "phone-abroad"))
    return F.when(F.length(d).between(8, 15), _refill(m, new))


def _email(m: Column, key: str) -> Column:
    name = F.substring(F.sha2(F.concat(F.lit(f"{key}|email|"), F.lower(m)).cast("binary"), 256), 1, 12)
    return F.concat(F.lit("p"), name, F.lit("@"), F.substring_index(m, "@", -1))


def pseudonym(m: Column, key: str) -> Column:
    """struct(kind, to) of one match; ``kind`` is null where the match is no valid value."""
    digits = F.length(_digits(m))
    rules = [
        ("email", m.contains("@"), _email),
        ("date", m.rlike(f"^(?:{_ISO_DATE}|{_DAY_DATE})$"), _date),
        ("ssn", m.rlike(f"^{_SSN}$"), _ssn),
        ("ip", m.rlike(f"^{_IP}$"), _ip),
        ("card", m.rlike(f"^{_CARD}$") & F.call_function("luhn_check", F.when(digits > 0, _digits(m)).otherwise("1")), _card),
        ("phone", m.rlike(f"^{_PHONE}$"), _phone),
        ("phone", m.rlike(rf"^{_PHONE_ABROAD}$"), _phone_abroad),
    ]
    to = kind = None
    for name, holds, make in rules:
        to = F.when(holds, make(m, key)) if to is None else to.when(holds, make(m, key))
        kind = F.when(holds, F.lit(name)) if kind is None else kind.when(holds, F.lit(name))
    return F.transform(F.array(F.struct(kind.alias("kind"), to.alias("to"))), lambda x: F.struct(
        F.when(x["to"].isNotNull(), x["kind"]).alias("kind"), F.coalesce(x["to"], m).alias("to")))[0]


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """Every row of ``docs`` as the struct ``__row`` with ``__text`` and ``__found``, the
    (kind, to) of each match in order."""
    text = F.col("__row")["text"]
    cut = whole_row(docs).select(
        "__row", F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias("__m"))
    some = F.size("__m") > 0
    found = cut.select("__row", F.when(some, F.transform("__m", lambda m: pseudonym(m, key))).alias("__f"))
    joined = F.array_join(F.flatten(F.zip_with(
        F.split(text, ANY, -1), "__f", lambda gap, f: F.array(gap, F.coalesce(f["to"], F.lit(""))))), "")
    return found.select("__row", F.when(F.col("__f").isNotNull(), joined).otherwise(text).alias("__text"),
                        F.filter(F.coalesce("__f", F.array().cast("array<struct<kind:string,to:string>>")),
                                 lambda f: f["kind"].isNotNull()).alias("__found"))


def pseudonym_report(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(doc_id, text, n_<kind>...) of every row, the text with its pseudonyms."""
    count = lambda k: F.size(F.filter("__found", lambda f: f["kind"] == k)).cast("bigint")
    return pseudonymise(docs, key).select(
        F.col("__row")["doc_id"].alias("doc_id"), F.col("__text").alias("text"), *[count(k).alias(f"n_{k}") for k in KINDS])


def pseudonymised(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with its texts replaced, and n_chars, where there is one, counted anew."""
    own = {c: F.col("__row")[c] for c in docs.columns} | {"text": F.col("__text")}
    if "n_chars" in own:
        own["n_chars"] = F.length("__text").cast(docs.schema["n_chars"].dataType)
    return pseudonymise(docs, key).select(*[v.alias(c) for c, v in own.items()])
