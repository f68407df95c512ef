"""Format-preserving pseudonyms for personal data and secrets, in native expressions.

One regular expression finds candidates; each is validated (check digits, ranges, calendar) and, if valid, permuted
within its format by a keyed Feistel network. Numbers may stand side by side: a run of digit groups, and any candidate that
its kind rejects, is searched for cards from group to group, the longest valid one first; an IBAN ends where its country's
length does. The network works on the value without its punctuation, so a value has one
pseudonym in every document and notation, and different values have different ones.

| kind | validated by | pseudonym |
| --- | --- | --- |
| card number, 13-19 digits | check digit | all digits but the last permuted, check digit renewed |
| IBAN | remainder modulo 97 | account part permuted, check digits renewed, country kept |
| IPv4 address | four numbers up to 255 | the 32-bit number permuted |
| date | calendar | the day permuted within a span of 73,000 days, so it stays a date |
| phone number | + or (area), 10-15 digits | the last ten digits permuted, country code kept |
| social security number | area, group and serial in use | nine digits permuted |
| e-mail address | form | letters and digits before the @ permuted, domain kept |
| access key, token, password | form | letters and digits of the value permuted |

Texts without a candidate are untouched. NULL stays NULL, empty stays empty; very long texts are treated whole, in one
scan; every row and every other column is kept as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Demonstration key; a run on real data passes its own.
KEY = "change me"
SPAN_SIDE = (292, 250)  # days of a date span as a product of two sides
SPAN = SPAN_SIDE[0] * SPAN_SIDE[1]

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_SECRET = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])|(?i:password|passwd|token|secret|api_?key)\s{0,3}[=:]\s{0,3}[\"']?(?=[^\s\"']{8})[A-Za-z0-9+/_-]++(?:[.~!@#$%^&*=:]++[A-Za-z0-9+/_-]++)*+"
#: Lengths of IBANs by country; other countries' take any length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = r"(?<![A-Za-z0-9])(?:" + "|".join(
    [rf"(?:{names.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, names in IBAN_LENGTHS.items()]
    + [r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"]) + ")"
_IP = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)"
_DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d]|[./-]\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_PHONE = r"(?<![\dA-Za-z])\+\d(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d]|[.-]\d)"
#: A run of digit groups up to a date, address or number of another kind; it may hold several cards.
_CARD = (r"(?<![\d.])\d(?:(?:[ -](?!\d{4}-\d{2}-\d{2}(?!\d)|\d{2}/\d{2}/\d{4}(?!\d)|\d{2}\.\d{2}\.\d{4}(?!\d)|\d{1,3}\.\d{1,3}\.\d"
         r"|\d{3}-\d{2}-\d{4}(?![\d-])|\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-])))?\d){12,}+")
CANDIDATE = "|".join((_SECRET, _EMAIL, _IBAN, _IP, _DATE, _SSN, _PHONE, _CARD))


def _full(pattern: str) -> str:
    return f"^(?:{pattern})$"


def _noise(key: str, tweak: Column | str, i: Column, text: Column) -> Column:
    """64 hex digits that depend on key, use, round and the other half."""
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak
    return F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), text), 256)


def _shifted(text: Column, noise: Column) -> Column:
    """Each digit, capital and small letter moved within its alphabet by the noise at its place (64 places a cycle)."""

    def move(c: Column, at: Column, once: Column) -> Column:
        step = F.conv(F.substr(once, F.pmod(at * 2, F.lit(62)) + 1, F.lit(2)), 16, 10).cast("int") + at
        code = F.ascii(c)
        turned = lambda base, size: F.char(F.lit(base) + F.pmod(code - base + step, F.lit(size)))
        return (F.when(code.between(48, 57), turned(48, 10)).when(code.between(65, 90), turned(65, 26))
                .when(code.between(97, 122), turned(97, 26)).otherwise(c))

    # the noise goes through an array, so that it is evaluated once and not for each character
    return F.get(F.transform(F.array(noise), lambda once: F.array_join(F.transform(F.split(text, ""), lambda c, at: move(c, at, once)), "")), F.lit(0))


def permuted(value: Column, key: str, tweak: str) -> Column:
    """Feistel network over a string of ASCII letters and digits: a bijection on the strings of its format.

    The halves change places each round; the format of a half (which places are digits, capitals, small letters) travels
    with it, so every round is a shift that can be undone.
    """
    n = F.length(value)
    left = F.floor(n / 2).cast("int")

    def round_(acc: Column, i: Column) -> Column:
        even = F.pmod(i, F.lit(2)) == 0
        a, b = acc["a"], acc["b"]
        noise = _noise(key, F.concat(F.lit(tweak + "/"), n.cast("string")), i, F.when(even, b).otherwise(a))
        return F.struct(F.when(even, _shifted(a, noise)).otherwise(a).alias("a"), F.when(even, b).otherwise(_shifted(b, noise)).alias("b"))

    start = F.struct(F.substr(value, F.lit(1), left).alias("a"), F.substr(value, left + 1, n).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, round_, lambda acc: F.concat(acc["a"], acc["b"]))


def _permuted_number(value: Column, sides: tuple[int, int], key: str, tweak: str) -> Column:
    """Feistel network over 0 .. sides[0] * sides[1] - 1."""
    def round_(acc: Column, i: Column) -> Column:
        even = F.pmod(i, F.lit(2)) == 0
        a, b = acc["a"], acc["b"]
        step = F.conv(F.substring(_noise(key, tweak, i, F.when(even, b).otherwise(a).cast("string")), 1, 12), 16, 10).cast("long")
        return F.struct(F.when(even, F.pmod(a + step, F.lit(sides[0]))).otherwise(a).cast("long").alias("a"),
                        F.when(even, b).otherwise(F.pmod(b + step, F.lit(sides[1]))).cast("long").alias("b"))

    start = F.struct(F.floor(value / sides[1]).cast("long").alias("a"), F.pmod(value, F.lit(sides[1])).cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, round_, lambda acc: acc["a"] * sides[1] + acc["b"])


def _refilled(match: Column, value: Column, place: str = "[A-Za-z0-9]") -> Column:
    """The match with its letters and digits replaced, in turn, by those of ``value``."""
    runs, gaps = F.regexp_extract_all(match, F.lit(f"({place}+)"), F.lit(1)), F.split(match, f"{place}+", -1)
    # what a lambda takes from outside is evaluated at every step, so all of it travels in the arguments
    start = F.struct(F.lit("").alias("out"), value.alias("rest"))

    def put(acc: Column, x: Column) -> Column:
        n = F.length(x["run"])
        return F.struct(F.concat(acc["out"], x["gap"], F.substr(acc["rest"], F.lit(1), n)).alias("out"),
                        F.substr(acc["rest"], n + 1, F.length(acc["rest"])).alias("rest"))

    parts = F.zip_with(runs, gaps, lambda r, g: F.struct(F.coalesce(r, F.lit("")).alias("run"), g.alias("gap")))
    return F.aggregate(parts, start, put, lambda acc: acc["out"])


def _plain(match: Column) -> Column:
    return F.regexp_replace(match, "[^A-Za-z0-9]", "")


def _luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """Sum of digits, every second one doubled, beginning with the ``doubled_from_right``-th from the right."""
    back = F.split(F.reverse(digits), "")
    return F.aggregate(
        F.transform(back, lambda c, i: F.when(F.pmod(i, F.lit(2)) == doubled_from_right - 1,
                                              F.floor(c.cast("int") * 2 / 10) + F.pmod(c.cast("int") * 2, F.lit(10)))
                    .otherwise(c.cast("int")).cast("int")),
        F.lit(0), lambda acc, x: acc + x)


def _mod97(text: Column) -> Column:
    """Remainder of an IBAN's number, letters counted from 10."""
    return F.aggregate(
        F.split(text, ""), F.lit(0),
        lambda acc, c: F.when(c.rlike("[0-9]"), F.pmod(acc * 10 + F.ascii(c) - 48, F.lit(97)))
        .otherwise(F.pmod(acc * 100 + F.ascii(c) - 55, F.lit(97))).cast("int"))


def _is_card(digits: Column) -> Column:
    # one digit repeated passes the check but is no card number
    return (F.length(digits).between(13, 19) & (F.pmod(_luhn_sum(digits, 2), F.lit(10)) == 0)
            & (F.length(F.translate(digits, "0", "")) > 0))


def _card(match: Column, key: str) -> Column:
    digits = _plain(match)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    new = permuted(body, key, "card")
    check = F.pmod(10 - F.pmod(_luhn_sum(new, 1), F.lit(10)), F.lit(10)).cast("string")
    return _refilled(match, F.concat(new, check))


def _cards(match: Column, key: str) -> Column:
    """struct(kinds, text): the digit groups of ``match`` from the left, each card (longest first) replaced."""
    groups, gaps = F.regexp_extract_all(match, F.lit(r"(\d+)"), F.lit(1)), F.split(match, r"\d+", -1)
    windows = F.regexp_extract_all(match, F.lit(r"(?<!\d)(?=(\d(?:[ -]?\d){0,19}))"), F.lit(1))

    def part(x: Column, gap: Column) -> Column:
        ends = [F.regexp_extract(x["window"], rf"^(\d(?:[ -]?\d){{{n - 1}}})(?!\d)", 1) for n in range(19, 12, -1)]
        card = F.get(F.filter(F.array(*ends), lambda e: (e != "") & _is_card(_plain(e))), F.lit(0))
        return F.struct(gap.alias("gap"), F.coalesce(x["group"], F.lit("")).alias("group"),
                        F.when(F.length(x["window"]) >= 13, card).alias("card"))

    def step(acc: Column, x: Column) -> Column:
        card = F.struct((F.size(F.split(x["card"], "[ -]")) - 1).alias("skip"), F.array_append(acc["kinds"], F.lit("card")).alias("kinds"),
                        F.concat(acc["text"], x["gap"], _card(x["card"], key)).alias("text"))
        other = F.struct(F.lit(0).alias("skip"), acc["kinds"].alias("kinds"), F.concat(acc["text"], x["gap"], x["group"]).alias("text"))
        inside = F.struct((acc["skip"] - 1).alias("skip"), acc["kinds"].alias("kinds"), acc["text"].alias("text"))
        return F.when(acc["skip"] > 0, inside).otherwise(F.when(x["card"].isNotNull(), card).otherwise(other))

    start = F.struct(F.lit(0).alias("skip"), F.array().cast("array<string>").alias("kinds"), F.lit("").alias("text"))
    pairs = F.zip_with(groups, windows, lambda g, w: F.struct(g.alias("group"), w.alias("window")))
    return F.aggregate(F.zip_with(pairs, gaps, part), start, step, lambda acc: F.struct(acc["kinds"].alias("kinds"), acc["text"].alias("text")))


def _iban(match: Column, key: str) -> tuple[Column, Column]:
    plain = _plain(match)
    country, body = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
    valid = F.length(plain).between(15, 34) & (_mod97(F.concat(body, country, F.substr(plain, F.lit(3), F.lit(2)))) == 1)
    new = permuted(body, key, "iban")
    check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    return valid, _refilled(match, F.concat(country, check, new))


def _ip(match: Column, key: str) -> tuple[Column, Column]:
    parts = F.transform(F.split(match, r"\."), lambda x: x.cast("long"))
    valid = F.forall(parts, lambda x: x <= 255)
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x)
    new = _permuted_number(number, (65536, 65536), key, "ip")
    octets = [F.pmod(F.shiftright(new, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]
    return valid, F.concat_ws(".", *octets)


def _date(match: Column, key: str) -> tuple[Column, Column]:
    iso, dotted = match.contains("-"), match.contains(".")
    first_day = F.to_date(F.lit("1900-01-01"))
    as_dmy = F.coalesce(F.try_to_date(F.translate(match, ".", "/"), "dd/MM/yyyy"))
    as_mdy = F.try_to_date(match, "MM/dd/yyyy")
    day_first = as_dmy.isNotNull()
    day = F.when(iso, F.try_to_date(match, "yyyy-MM-dd")).otherwise(F.coalesce(as_dmy, as_mdy))
    since = F.datediff(day, first_day)
    span = F.floor(since / SPAN)
    new = F.date_add(first_day, (span * SPAN + _permuted_number(F.pmod(since, F.lit(SPAN)), SPAN_SIDE, key, "date")).cast("int"))
    text = (F.when(iso, F.date_format(new, "yyyy-MM-dd")).when(dotted, F.date_format(new, "dd.MM.yyyy"))
            .when(day_first, F.date_format(new, "dd/MM/yyyy")).otherwise(F.date_format(new, "MM/dd/yyyy")))
    return day.isNotNull() & (F.year(day) >= 1800), text


def _phone(match: Column, key: str) -> tuple[Column, Column]:
    digits = _plain(match)
    n = F.length(digits)
    head = F.substr(digits, F.lit(1), F.greatest(n - 10, F.lit(0)))
    return n.between(8, 15), _refilled(match, F.concat(head, permuted(F.substr(digits, F.length(head) + 1, n), key, "phone")))


def _ssn(match: Column, key: str) -> tuple[Column, Column]:
    valid = ~match.rlike("^(?:000|666|9..)|-00-|0000$")
    return valid, _refilled(match, permuted(_plain(match), key, "ssn"))


def _email(match: Column, key: str) -> tuple[Column, Column]:
    local, domain = F.split_part(match, F.lit("@"), F.lit(1)), F.lower(F.split_part(match, F.lit("@"), F.lit(2)))
    new = permuted(F.lower(_plain(local)), key, "email")
    return F.length(_plain(local)) > 0, F.concat(_refilled(local, new), F.lit("@"), domain)


def _secret(match: Column, key: str) -> tuple[Column, Column]:
    head = F.regexp_extract(match, r"^(?:AKIA|gh[pousr]_|[A-Za-z_]+\s*[=:]\s*[\"']?)", 0)
    value = F.substr(match, F.length(head) + 1, F.length(match))
    return F.length(_plain(value)) > 0, F.concat(head, _refilled(value, permuted(_plain(value), key, "secret")))


KINDS = (("secret", _SECRET, _secret), ("email", _EMAIL, _email), ("iban", _IBAN, _iban), ("ip", _IP, _ip), ("date", _DATE, _date),
         ("ssn", _SSN, _ssn), ("phone", _PHONE, _phone))  # cards are searched for in what these reject


def _pseudonym(match: Column, key: str) -> Column:
    """struct(kinds, text) of a candidate: the kinds replaced in it, none if no kind accepts a part of it."""
    none = F.struct(F.array().cast("array<string>").alias("kinds"), match.alias("text"))
    out = F.when(match.rlike(r"\d(?:[ -]?\d){12}"), _cards(match, key)).otherwise(none)
    for kind, pattern, build in reversed(KINDS):
        valid, text = build(match, key)
        out = F.when(match.rlike(_full(pattern)) & F.coalesce(valid, F.lit(False)), F.struct(F.array(F.lit(kind)).alias("kinds"), text.alias("text"))).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str = KEY, column: str = "text") -> DataFrame:
    """``docs`` with ``column`` pseudonymised and ``pseudonyms``, the kinds replaced in the order of the text."""
    text = F.col(column)
    hinted = text.rlike(r"[0-9@]|(?i:password|passwd|token|secret|api_?key)")
    candidate = F.lit(CANDIDATE)
    matches = F.when(hinted, F.regexp_extract_all(text, candidate, F.lit(0))).otherwise(F.array().cast("array<string>"))
    found = F.transform(matches, lambda m: _pseudonym(m, key))
    kinds = F.flatten(F.transform(F.col("_found"), lambda x: x["kinds"]))
    gaps = F.split(text, CANDIDATE, -1)
    fill = F.array_append(F.transform(F.col("_found"), lambda x: x["text"]), F.lit(""))
    new = F.when(F.size("pseudonyms") > 0, F.array_join(F.zip_with(gaps, fill, lambda g, r: F.concat(g, r)), "")).otherwise(text)
    return docs.drop("pseudonyms", "_found").withColumn("_found", found).withColumn("pseudonyms", kinds).withColumn(column, new).drop("_found")
