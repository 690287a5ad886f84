"""Format-preserving pseudonyms: personal numbers, dates, addresses and keys permuted within their format.

Every value that passes its validation is replaced by a keyed Feistel permutation of its own domain, so equal values
get equal pseudonyms in all documents, different ones different pseudonyms, and the format stays valid: card numbers
keep a right check digit, IBANs their checksum, dates stay dates, octets octets. Only DataFrame functions: texts are
cut at the matches, the matches are permuted, and the pieces are joined again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KEY = "premia"
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)  # 17 x 4297 days: 1900 to 2099
AREAS, SERIALS = 898, 99 * 9999  # areas 001 to 899 but 666; groups 01 to 99, serials 0001 to 9999

_OUT = r"(?<![0-9A-Za-z])"
_END = r"(?![0-9A-Za-z])"
#: Kind: how its candidates look. Tried in this order at each place of a text.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": _OUT + r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}" + _END,
    "hex": _OUT + r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})" + _END,
    "card": _OUT + r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7})" + _END,
    "phone": r"(?<![0-9A-Za-z+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+(?!1)[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9A-Za-z]|[.-][0-9])",
    "ssn": _OUT + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END,
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z]|[./-][0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
}
ANY = "|".join(PATTERNS.values())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("long")


def feistel_text(s: Column, key: str, kind: str, letters: int = 26) -> Column:
    """A string of the same length and classes: digits stay digits, a-z and A-Z letters of their case, others themselves.

    The halves take turns: each character moves within its class by a digest of the other half, lower-cased, so values
    that differ only in case get pseudonyms that differ only in case.
    """

    def moved(half: Column, other: Column, r: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), F.lower(other)), 512)

        def step(digest: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                by = _number(F.substr(digest, 4 * (i % 32) + 1, F.lit(4)))
                turn = lambda base, size: F.char(base + (F.ascii(c) - base + by) % size)
                return (F.when(c.between("0", "9"), turn(48, 10)).when(c.between("a", chr(96 + letters)), turn(97, letters))
                        .when(c.between("A", chr(64 + letters)), turn(65, letters)).otherwise(c))

            return F.array_join(F.transform(_chars(half), one), "")

        return let(stream, step)

    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("a"), F.substr(s, half + 1, F.length(s)).alias("b"))
    turn = lambda st, r: F.struct(st["b"].alias("a"), moved(st["a"], st["b"], r).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda st: F.concat(st["a"], st["b"]))


def feistel_numbers(a: Column, b: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """Struct (a, b), a permutation of all pairs below ``sizes``."""

    def turn(st: Column, r: Column) -> Column:
        f = _number(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), st["b"].cast("string")), 256), 1, 12))
        size = F.when(r % 2 == 1, F.lit(sizes[0])).otherwise(F.lit(sizes[1])).cast("long")
        return F.struct(st["b"].alias("a"), ((st["a"] + f) % size).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), turn)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _fill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in their order."""
    put = lambda c, i: F.when(c.between("0", "9"), F.substr(digits, F.length(_digits(F.substr(form, F.lit(1), i + 1))), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(_chars(form), put), "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes payload + digit pass the Luhn test."""
    doubled = lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))
    total = F.aggregate(F.transform(_chars(F.reverse(payload)), doubled), F.lit(0), lambda t, x: t + x)
    return ((10 - total % 10) % 10).cast("string")


def _mod97(s: Column) -> Column:
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(_chars(s), F.lit(0), lambda t, c: F.when(c.between("0", "9"), t * 10 + value(c)).otherwise(t * 100 + value(c)) % 97)


def _card(m: Column, key: str) -> Column:
    def filled(d: Column) -> Column:
        payload = F.substr(d, F.lit(1), F.length(d) - 1)
        checked = let(feistel_text(payload, key, "card"), lambda p: F.concat(p, luhn_digit(p)))
        valid = luhn_digit(payload) == F.right(d, F.lit(1))
        return let(F.when(valid, checked).otherwise(feistel_text(d, key, "account")), lambda new: _fill(m, new))

    return let(_digits(m), filled)


def _iban(m: Column, key: str) -> Column:
    land, body = F.substring(m, 1, 2), F.substr(m, F.lit(5), F.length(m))
    sealed = lambda b: F.concat(land, F.lpad((98 - _mod97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0"), b)
    valid = _mod97(F.concat(body, F.substring(m, 1, 4))) == 1
    return F.when(valid, let(feistel_text(body, key, "iban"), sealed))


def _phone(m: Column, key: str) -> Column:
    def filled(d: Column) -> Column:
        country = F.when(~m.startswith("+"), 0).when(d.startswith("1") | d.startswith("7"), 1).otherwise(2)
        kept, rest = F.substr(d, F.lit(1), country), F.substr(d, country + 1, F.length(d))
        return F.when(F.length(d).between(8, 15), let(F.concat(kept, feistel_text(rest, key, "phone")), lambda new: _fill(m, new)))

    return let(_digits(m), filled)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    dense = area - F.when(area > 666, 2).otherwise(1)

    def shown(p: Column) -> Column:
        back = p["a"] + F.when(p["a"] > 664, 2).otherwise(1)
        pad = lambda n, size: F.lpad(n.cast("string"), size, "0")
        return F.concat_ws("-", pad(back, 3), pad(F.floor(p["b"] / 9999) + 1, 2), pad(p["b"] % 9999 + 1, 4))

    return F.when(valid, let(feistel_numbers(dense, (group - 1) * 9999 + serial - 1, (AREAS, SERIALS), key, "ssn"), shown))


def _date(m: Column, key: str) -> Column:
    def by(form: str) -> Column:
        day = F.datediff(F.try_to_timestamp(m, F.lit(form)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        shown = lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (p["a"] * DAYS[1] + p["b"]).cast("int")), form)
        moved = lambda d: F.when(d.between(0, DAYS[0] * DAYS[1] - 1), let(feistel_numbers(F.floor(d / DAYS[1]), d % DAYS[1], DAYS, key, "date"), shown))
        return let(day, moved)

    return F.when(m.contains("-"), by("yyyy-MM-dd")).when(m.contains("."), by("dd.MM.yyyy")).otherwise(by("MM/dd/yyyy"))


def _ip(m: Column, key: str) -> Column:
    def moved(o: Column) -> Column:
        part = lambda i: F.get(o, F.lit(i)).cast("int")
        valid = F.forall(o, lambda x: x.cast("int") < 256)
        shown = lambda p: F.concat_ws(".", *[x.cast("string") for h in ("a", "b") for x in (F.floor(p[h] / 256), p[h] % 256)])
        return F.when(valid, let(feistel_numbers(part(0) * 256 + part(1), part(2) * 256 + part(3), (65536, 65536), key, "ip"), shown))

    return let(F.split(m, r"\."), moved)


def _email(m: Column, key: str) -> Column:
    at = F.instr(m, "@")
    return F.concat(feistel_text(F.substr(m, F.lit(1), at - 1), key, "email"), F.substr(m, at, F.length(m)))


_MAKERS = {"email": _email, "iban": _iban, "hex": lambda m, key: feistel_text(m, key, "hex", 6), "card": _card, "phone": _phone, "ssn": _ssn, "date": _date, "ip": _ip}


def _found(kind: str) -> Callable[[Column], Column]:
    return lambda new: F.when(new.isNotNull(), F.struct(new.alias("new"), F.lit(kind).alias("kind")))


def replacement(match: Column, key: str) -> Column:
    """Struct (new, kind) of one match; new is null if the match fails every validation that fits its look."""
    out = F.lit(None).cast("struct<new:string,kind:string>")
    for kind in reversed(PATTERNS):
        looks = match.rlike("^(?:" + PATTERNS[kind] + ")$")
        made = let(_MAKERS[kind](match, key), _found(kind))
        out = F.when(looks, made).otherwise(out)
    return out


def pseudonymise(text: Column, key: str = KEY) -> Column:
    """Struct (text, kinds): the whole text with its personal values replaced, and the kind of each replaced value."""

    def whole(found: Column) -> Column:
        made = F.transform(found, lambda m: replacement(m, key))
        pieces = lambda out: F.zip_with(
            F.split(text, ANY, -1), F.zip_with(found, out, lambda m, o: F.coalesce(o["new"], m)), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))
        )
        return let(made, lambda out: F.struct(
            F.array_join(pieces(out), "").alias("text"), F.filter(F.transform(out, lambda o: o["kind"]), lambda k: k.isNotNull()).alias("kinds")
        ))

    unchanged = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    return F.when(text.rlike("[0-9@]|[A-Fa-f]{32}"), let(found, lambda f: F.when(F.size(f) > 0, whole(f)).otherwise(unchanged))).otherwise(unchanged)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", key: str = KEY) -> DataFrame:
    """Per row of ``docs``: id, ``text`` with pseudonyms, ``n_private`` (replaced values), ``kinds`` (distinct, sorted, comma-joined).

    Kinds: e-mail addresses (local part), IBANs, card numbers (13 to 19 digits; without a right check digit they count
    as account numbers), phone numbers, social security numbers, dates from 1900 to 2099, IPv4 addresses, hexadecimal keys
    of 32 or more digits. What looks alike but fails validation stays. Whole texts; null stays null with 0 values.
    Rows are independent: repeated rows and null ids come back as they are; other columns are ignored.
    """
    made = docs.select(docs[id_col], pseudonymise(docs[text], key).alias("_p"))
    kinds = F.array_join(F.array_sort(F.array_distinct("_p.kinds")), ",")
    return made.select(id_col, F.col("_p.text").alias(text), F.size("_p.kinds").cast("long").alias("n_private"), kinds.alias("kinds"))


def replace_text(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with the text column replaced by its pseudonymised form; all columns and rows stay."""
    return docs.withColumn(text, pseudonymise(docs[text], key)["text"])
