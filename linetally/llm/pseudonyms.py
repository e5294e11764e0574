"""Format-preserving pseudonyms by keyed Feistel networks, on built-in expressions only.

Personal values are found by one pattern, validated, and replaced by other values of the same format. Each kind has a
finite domain Z_a x Z_b, on which eight rounds of a Feistel network with modular addition are a permutation for any key;
the round function is the first 60 bits of a SHA-256 over key, kind, round and the other half. So equal values get equal
pseudonyms in every document and in every spelling (digits with or without blanks), different values stay different,
and whoever holds the key can turn a pseudonym back (``decrypt=True``).

| kind | validated by | permuted | kept |
|---|---|---|---|
| card | 13 to 19 digits, Luhn | all digits but the first and last, a domain for each length | first digit, separators; the check digit is computed anew |
| phone | +1 and ten digits, or the ten alone in groups | the ten digits | +1 or 1 and the punctuation |
| phone | + and 8 to 15 digits | all digits but the country code, a domain for each code and length | country code and punctuation |
| ssn | area, group and serial in range | area, group and serial, in range | hyphens |
| date | a real day from 1900-01-01 to 2099-11-13 | the day | layout (year first, day/month/year, day.month.year) |
| ip | four numbers to 255 | the 32 bits | dots |
| email | the pattern | letters and digits before the @, each within its class | the domain, other marks |

An address' part before the @ is no number: its characters are shifted within their class by a Feistel network over its
two halves. Values that fail validation stay as they are.

Null text stays null; empty texts and texts without a value stay as they are. Rows that repeat get the same text. Texts
of any length are handled whole. An empty table gives an empty result. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.llm.common import fresh

ROUNDS = 8
KINDS = ("email", "card", "phone", "ssn", "date", "ip")
#: Patterns by kind. None starts or ends inside a longer run of its characters.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}+(?![A-Za-z0-9-])",
    "card": r"(?<![\d.-])(?:\d{4}(?<sep>[ -]?)\d{4}\k<sep>\d{4}\k<sep>\d{4}|\d{4}(?:-\d{4}){3}-\d{3}|\d{4}(?<gap>[ -])\d{6}\k<gap>\d{4,5}|\d{13,19})(?![\d-]|\.\d)",
    "phone": r"(?<![\d+])\+1[ .-]?(?:\(\d{3}\) ?|\d{3}[ .-]?)\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<![\d+])\+[2-9](?:[ .-]?(?:\d|\(\d{1,4}\) ?)){7,14}(?!\d)"
    r"|(?<![\d+.-])(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-]|\.\d)",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)",
}
_FIRST_DAY, _DAYS = "1900-01-01", (250, 292)  # 73,000 days
_LAYOUTS = {"-": "yyyy-MM-dd", "/": "dd/MM/yyyy", ".": "dd.MM.yyyy"}


#: Country codes of one or two digits; all others have three.
_SHORT_CODES = "^(?:7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"


def _any() -> str:
    """All kinds as alternatives."""
    return "|".join(PATTERNS[k] for k in KINDS)


def _noise(key: Column, kind: str, r: Column, value: Column) -> Column:
    """60 bits out of key, kind, round and value."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", key, F.lit(kind), r.cast("string"), value), 256), 1, 15), 16, 10).cast("long")


def permuted(x: Column, y: Column, a: int | Column, b: int | Column, key: Column, kind: str | Column, decrypt: bool = False) -> Column:
    """The pair (x, y) of Z_a x Z_b moved by the keyed permutation, as a struct."""
    rounds = [F.lit(r) for r in (reversed(range(ROUNDS)) if decrypt else range(ROUNDS))]
    sign = -1 if decrypt else 1

    def step(s: Column, r: Column) -> Column:
        moved_x = F.pmod(s["x"] + sign * F.pmod(_noise(key, kind, r, s["y"].cast("string")), F.lit(a)), F.lit(a))
        moved_y = F.pmod(s["y"] + sign * F.pmod(_noise(key, kind, r, s["x"].cast("string")), F.lit(b)), F.lit(b))
        even = r % 2 == 0
        return F.struct(F.when(even, moved_x).otherwise(s["x"]).alias("x"), F.when(even, s["y"]).otherwise(moved_y).alias("y"))

    return F.aggregate(F.array(*rounds), F.struct(x.cast("long").alias("x"), y.cast("long").alias("y")), step)


def _shifted(chars: Column, stream: Column, sign: int) -> Column:
    """Letters and digits moved within their class by a stream of hex digits (two for each character)."""

    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substr(stream, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int") * sign
        code = F.ascii(c)

        def within(first: str, size: int) -> Column:
            return F.char((F.pmod(code - ord(first) + by, F.lit(size)) + ord(first)).cast("long"))

        return (
            F.when(c.rlike("^[a-z]$"), within("a", 26)).when(c.rlike("^[A-Z]$"), within("A", 26)).when(c.rlike("^[0-9]$"), within("0", 10)).otherwise(c)
        )

    return F.transform(chars, move)


def permuted_text(text: Column, key: Column, kind: str, decrypt: bool = False) -> Column:
    """Letters and digits of a short text, permuted within their classes."""
    rounds = [F.lit(r) for r in (reversed(range(ROUNDS)) if decrypt else range(ROUNDS))]
    sign = -1 if decrypt else 1
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    half = F.greatest(F.lit(1), F.floor(F.size(chars) / 2)).cast("int")
    start = F.struct(F.slice(chars, 1, half).alias("x"), F.slice(chars, half + 1, F.greatest(F.lit(1), F.size(chars))).alias("y"))

    def stream(r: Column, other: Column) -> Column:
        return F.sha2(F.concat_ws("|", key, F.lit(kind), r.cast("string"), F.array_join(other, "")), 256)

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        return F.struct(
            F.when(even, _shifted(s["x"], stream(r, s["y"]), sign)).otherwise(s["x"]).alias("x"),
            F.when(even, s["y"]).otherwise(_shifted(s["y"], stream(r, s["x"]), sign)).alias("y"),
        )

    return F.aggregate(F.array(*rounds), start, step, lambda s: F.array_join(F.concat(s["x"], s["y"]), ""))


def _luhn(payload: Column) -> Column:
    """Luhn sum of a card's digits without the last, doubled from the end."""
    digits = F.lpad(payload, 18, "0")
    total = F.lit(0)
    for i in range(18):
        d = F.substring(digits, i + 1, 1).cast("int")
        total = total + (F.when(d > 4, d * 2 - 9).otherwise(d * 2) if i % 2 else d)
    return total


def _refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))

    def step(s: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["text"], F.when(is_digit, F.substr(digits, s["next"], F.lit(1))).otherwise(c)).alias("text"),
            (s["next"] + F.when(is_digit, 1).otherwise(0)).alias("next"),
        )

    return F.aggregate(F.split(value, ""), start, step, lambda s: s["text"])


def _once(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _number(text: Column, first: int, size: int) -> Column:
    return F.substring(text, first, size).cast("long")


def _padded(number: Column, size: int) -> Column:
    return F.lpad(number.cast("string"), size, "0")


def pseudonym(value: Column, key: Column, decrypt: bool = False) -> Column:
    """Struct of kind and replacement of one value; kind null where it is not valid."""
    digits = F.regexp_replace(value, "[^0-9]", "")

    def result(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    def halves(d: Column, first: Column, size: Column, kind: Column) -> Column:
        """``size`` digits from the place ``first``, permuted."""
        h = F.floor(size / 2).cast("int")
        x, y = F.substr(d, first, h).cast("long"), F.substr(d, first + h, size - h).cast("long")
        ten = lambda n: F.pow(F.lit(10), n).cast("long")
        pair = permuted(x, y, ten(h), ten(size - h), key, kind, decrypt)
        return _once(pair, lambda s: F.concat(F.lpad(s["x"].cast("string"), h, F.lit("0")), F.lpad(s["y"].cast("string"), size - h, F.lit("0"))))

    def card(d: Column) -> Column:
        n = F.length(d)
        kind = F.when(n == 16, "card").otherwise(F.concat(F.lit("card"), n.cast("string")))
        payload = F.concat(F.substring(d, 1, 1), halves(d, F.lit(2), n - 2, kind))
        return _refill(value, _once(payload, lambda p: F.concat(p, F.pmod(-_luhn(p), F.lit(10)).cast("string"))))

    def phone(d: Column) -> Column:
        lead = F.length(d) - 10
        return _refill(value, F.concat(F.substr(d, F.lit(1), lead), halves(d, lead + 1, F.lit(10), F.lit("phone"))))

    def abroad(d: Column) -> Column:
        code = F.when(d.startswith("7"), 1).when(d.rlike(_SHORT_CODES), 2).otherwise(3)
        number = lambda c: F.concat(F.substr(d, F.lit(1), c), halves(d, c + 1, F.length(d) - c, F.concat(F.lit("phone"), F.substr(d, F.lit(1), c), F.lit("/"), F.length(d).cast("string"))))
        return _refill(value, _once(code, number))

    def ssn(d: Column) -> Column:
        area, group, serial = _number(d, 1, 3), _number(d, 4, 2), _number(d, 6, 4)
        place = F.when(area > 666, area - 2).otherwise(area - 1)  # 1 to 899 without 666
        pair = permuted(place * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn", decrypt)

        def made(s: Column) -> Column:
            p = F.floor(s["x"] / 99)
            new_area = F.when(p + 1 >= 666, p + 2).otherwise(p + 1)
            return F.concat_ws("-", _padded(new_area, 3), _padded(F.pmod(s["x"], F.lit(99)) + 1, 2), _padded(s["y"] + 1, 4))

        return _once(pair, made)

    def date(v: Column) -> Column:
        day = day_number(v)
        pair = permuted(F.floor(day / _DAYS[1]), F.pmod(day, F.lit(_DAYS[1])), *_DAYS, key, "date", decrypt)

        def made(s: Column) -> Column:
            new = F.date_add(F.lit(_FIRST_DAY).cast("date"), (s["x"] * _DAYS[1] + s["y"]).cast("int"))
            return F.coalesce(*[F.when(v.contains(m), F.date_format(new, f)) for m, f in _LAYOUTS.items()])

        return _once(pair, made)

    def day_number(v: Column) -> Column:
        found = F.coalesce(*[F.when(v.contains(m), F.try_to_date(v, f)) for m, f in _LAYOUTS.items()])
        return F.datediff(found, F.lit(_FIRST_DAY).cast("date"))

    def ip(v: Column) -> Column:
        n = F.transform(F.split(v, r"\."), lambda x: x.cast("long"))
        pair = _once(n, lambda o: permuted(F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1)), F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3)), 1 << 16, 1 << 16, key, "ip", decrypt))
        return _once(pair, lambda s: F.concat_ws(".", *[f for x in ("x", "y") for f in (F.floor(s[x] / 256).cast("string"), F.pmod(s[x], F.lit(256)).cast("string"))]))

    def email(v: Column) -> Column:
        return F.concat(permuted_text(F.substring_index(v, "@", 1), key, "email", decrypt), F.lit("@"), F.substring_index(v, "@", -1))

    def full(kind: str) -> Column:
        return value.rlike(f"^(?:{PATTERNS[kind]})$")

    stays = F.struct(F.lit(None).cast("string").alias("kind"), value.alias("text"))
    payload = F.substr(digits, F.lit(1), F.length(digits) - 1)
    octets = F.forall(F.split(value, r"\."), lambda x: x.cast("int") <= 255)
    day = day_number(value)
    area, group, serial = _number(digits, 1, 3), _number(digits, 4, 2), _number(digits, 6, 4)
    return (
        F.when(value.contains("@"), result("email", email(value)))
        .when(full("phone") & value.startswith("+") & ~value.startswith("+1"), F.when(F.length(digits).between(8, 15), result("phone", _once(digits, abroad))).otherwise(stays))
        .when(full("phone"), result("phone", _once(digits, phone)))
        .when(full("card") & (F.pmod(_luhn(payload) + F.substring(digits, -1, 1).cast("int"), F.lit(10)) == 0), result("card", _once(digits, card)))
        .when(full("ssn") & area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), result("ssn", _once(digits, ssn)))
        .when(full("ip") & octets, result("ip", ip(value)))
        .when(full("date") & (day >= 0) & (day < _DAYS[0] * _DAYS[1]), result("date", date(value)))
        .otherwise(stays)
    )


def _count(kinds: Column, kind: str) -> Column:
    return F.coalesce(F.size(F.filter(kinds, lambda x: x == kind)), F.lit(0))


def pseudonymised(docs: DataFrame, key: str, found: str = "pii_found", text_column: str = "text", decrypt: bool = False) -> DataFrame:
    """``docs`` with personal values replaced in the text, and one more column: how many of each kind, as a map."""
    key_column = F.lit(key)
    text = F.col(f"`{text_column}`")
    matches, new = fresh(docs.columns, "__matches", "__new")
    pattern = _any()
    # most texts hold neither a digit nor an @, and are done after one look
    values = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    rows = docs.withColumn(matches, values)
    given = F.transform(F.col(matches), lambda v: pseudonym(v, key_column, decrypt))
    joined = _once(
        given,
        lambda g: F.struct(
            F.array_join(F.flatten(F.zip_with(F.split(text, pattern, -1), g, lambda gap, x: F.array(gap, F.coalesce(x["text"], F.lit(""))))), "").alias("text"),
            F.filter(F.transform(g, lambda x: x["kind"]), lambda k: k.isNotNull()).alias("kinds"),
        ),
    )
    rows = rows.withColumn(new, F.when(F.size(matches) > 0, joined))
    counts = F.map_from_arrays(
        F.array(*[F.lit(k) for k in KINDS]), F.array(*[_count(F.col(new)["kinds"], k) for k in KINDS])
    )
    out = [F.coalesce(F.col(new)["text"], text).alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*out, counts.alias(found))
