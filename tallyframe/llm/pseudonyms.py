"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets in texts.

A value is found by its pattern, validated, and permuted within its format by a keyed Feistel
network, so that equal values stay equal in all documents, different ones stay different, and a
pseudonym is a valid value of the same kind. All of it is built-in functions of Spark SQL.

cards      13 to 19 digits, spaces or hyphens allowed, right check digit: first digit kept, the others permuted, check digit made anew;
           looked for last, in all runs of whole groups of what lies between the other values, usual groupings first
phones     numbers of North American form: those with an area code and exchange of 2-9 first permuted among these, all others among the others
national   ddd-dd-dddd with an area of 001-899 but 666, group 01-99, serial 0001-9999: permuted among these
addresses  dotted quads of 0-255: permuted among all
dates      yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy from 1800 to 2199: permuted among these days
mail       the part before the @: letters and digits permuted within their classes
secrets    values of 8 letters, digits and + / _ - or more after password=, TOKEN = " and the like, and access keys: hexadecimal
           ones permuted within their alphabet, others within their classes; without a quote or a = right before it, a value
           needs a digit, 8 hexadecimal letters or 20 characters, as words follow a colon too
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import let

ROUNDS = 5  # of two steps each

#: What stands before a secret, up to its quote.
_LEAD = r"(?i:password|passwd|pwd|secret(?:[_-]?(?:access[_-]?)?key)?|token|api[_-]?key)[\"']?[ \t]{0,8}(?::=|=>|[=:])[ \t]{0,8}"
_QUOTE, _LETTER = "[\"'`]", "[0-9A-Za-z+/_-]"
PATTERNS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": rf"{_LEAD}(?:{_QUOTE}|(?<==)|(?=[0-9a-f]{{8}}|[A-Za-z+/_-]*+\d|{_LETTER}{{20}}))(?!(?:AKIA|ASIA)[A-Z0-9]{{16}}(?![0-9A-Za-z])){_LETTER}{{8,}}+(?:\.{_LETTER}++)*+={{0,2}}+(?!@)",
    "key": r"(?<![0-9A-Za-z])(?:AKIA|ASIA)[A-Z0-9]{16}(?![0-9A-Za-z])",
    "address": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "iso_date": r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])",
    "dotted_date": r"(?<![\d.])\d{2}\.\d{2}\.\d{4}(?!\d)",
    "slashed_date": r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])",
    "national": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d(])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
}
ANY = "|".join(PATTERNS.values())
#: Groups of digits with 13 digits or more; a group beside a letter is none.
CHAIN = r"(?<![\dA-Za-z])(?=\d(?:[ -]?\d){12})\d++(?![A-Za-z])(?:[ -]\d++(?![A-Za-z]))*+"
_USUAL = r"^\d+$|^\d{4}([ -])\d{4}\1\d{4}\1\d{4}(\1\d{3})?$|^\d{4}([ -])\d{6}\3\d{4,5}$"
DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
WALK = 32
_FIRST_DAY, _DAYS_LEFT, _DAYS_RIGHT = "1800-01-01", 189, 773  # 189 * 773 days are 400 years


def _digest(key: str, kind: str, step: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), value.cast("string")), 256)


def _number(key: str, kind: str, step: Column, value: Column) -> Column:
    return F.conv(F.substring(_digest(key, kind, step, value), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """struct(l, r): a keyed permutation of the pairs with left below a and right below b."""

    def turn(s, i):
        moved = F.pmod(s["l"] + F.pmod(_number(key, kind, i * 2, s["r"]), a), a)
        return let(moved, lambda x: F.struct(x.alias("l"), F.pmod(s["r"] + F.pmod(_number(key, kind, i * 2 + 1, x), b), b).alias("r")))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _shift(text: Column, digest: Column, alphabets: tuple[str, ...]) -> Column:
    """text with each character moved within its alphabet by its byte of the digest; others stay."""

    def one(c, j, digest):
        by = F.conv(F.substr(digest, F.pmod(j, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for letters in alphabets:
            place = F.instr(F.lit(letters), c)
            out = F.when((c != "") & (place > 0), F.substr(F.lit(letters), F.pmod(place - 1 + by, F.lit(len(letters))) + 1, F.lit(1))).otherwise(out)
        return out

    return let(digest, lambda d: F.array_join(F.transform(F.split(text, ""), lambda c, j: one(c, j, d)), ""))


def permuted_string(key: str, kind: str, text: Column, alphabets: tuple[str, ...]) -> Column:
    """text with its characters permuted within their alphabets: a Feistel network over its two halves."""
    half = F.floor(F.length(text) / 2).cast("int")

    def turn(s, i):
        moved = _shift(s["l"], _digest(key, kind, i * 2, s["r"]), alphabets)
        return let(moved, lambda x: F.struct(x.alias("l"), _shift(s["r"], _digest(key, kind, i * 2 + 1, x), alphabets).alias("r")))

    start = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text)).alias("r"))
    return let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn), lambda done: F.concat(done["l"], done["r"]))


def _walked(key: str, kind: str, text: Column, alphabets: tuple[str, ...], away: str) -> Column:
    """permuted_string among the texts that don't match away: permuted again while it does."""
    again = lambda x, _: F.when(x.rlike(away), permuted_string(key, kind, x, alphabets)).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), permuted_string(key, kind, text, alphabets), again)


def _secret(key: str, m: Column) -> Column:
    lead = F.regexp_extract(m, rf"^({_LEAD}{_QUOTE}?)", 1)

    def new(value):
        lower, upper, other = permuted_string(key, "secret", value, (HEX,)), _walked(key, "upper secret", value, (HEX.upper(),), r"^\d+$"), _walked(key, "any secret", value, (LOWER, UPPER, DIGITS), r"^(?:[0-9a-f]+|[0-9A-F]+)$")
        return F.when(value.rlike("^[0-9a-f]+$"), lower).when(value.rlike("^[0-9A-F]+$"), upper).otherwise(other)

    return let(F.substr(m, F.length(lead) + 1, F.length(m)), lambda value: F.concat(lead, new(value)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _part(digits: Column, start: int | Column, n: int | Column) -> Column:
    one = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.substr(digits, one(start), one(n)).cast("long")


def _padded(value: Column, n: int | Column) -> Column:
    return F.lpad(value.cast("string"), n, "0") if isinstance(n, int) else F.call_function("lpad", value.cast("string"), n, F.lit("0"))


def _filled(form: Column, digits: Column) -> Column:
    """form with its digits replaced by these, in order."""

    def one(c, j, digits):
        return F.when(c.rlike(r"^\d$"), F.substr(digits, F.length(_digits(F.substr(form, F.lit(1), j + 1))), F.lit(1))).otherwise(c)

    return let(digits, lambda d: F.array_join(F.transform(F.split(form, ""), lambda c, j: one(c, j, d)), ""))


def luhn_sum(digits: Column) -> Column:
    """The weighted sum of digits; divisible by 10 if the last one is the right check digit."""

    def add(acc, i):
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _card(key: str, m: Column) -> Column:
    d = _digits(m)
    n = F.length(d) - 2
    u = F.floor(n / 2).cast("int")
    v = n - u
    ten = lambda x: F.pow(F.lit(10), x).cast("long")
    moved = feistel(key, "card", _part(d, 2, u), _part(d, u + 2, v), ten(u), ten(v))
    body = let(moved, lambda x: F.concat(F.substr(d, F.lit(1), F.lit(1)), _padded(x["l"], u), _padded(x["r"], v)))
    check = lambda x: F.pmod(F.lit(10) - luhn_sum(F.concat(x, F.lit("0"))) % 10, F.lit(10))
    new = let(body, lambda x: F.concat(x, check(x).cast("string")))
    return _filled(m, new)


def _groups(chain: Column) -> Column:
    """A chain's groups of digits, each with the separator behind it."""
    return F.regexp_extract_all(chain, F.lit(r"(\d+[ -]?)"), 1)


def _picked(g: Column, usual: bool) -> Column:
    """array of struct(i, to, text): from the left, the longest card that begins at each group and after the card before."""

    def longest(i):
        # No run of more than 19 groups has 19 digits.
        text = lambda j: F.rtrim(F.array_join(F.slice(g, i + 1, j - i + 1), ""), F.lit(" -"))
        runs = F.transform(F.sequence(i, F.least(i + 18, F.size(g) - 1)), lambda j: F.struct(i.alias("i"), j.alias("to"), text(j).alias("text")))
        digits = lambda x: F.translate(x["text"], " -", "")
        fits = lambda x: F.length(digits(x)).between(13, 19) & (x["text"].rlike(_USUAL) if usual else F.lit(True)) & (luhn_sum(digits(x)) % 10 == 0)
        return F.try_element_at(F.filter(runs, fits), F.lit(-1))

    def step(s, i):
        more = let(longest(i), lambda x: F.when(x.isNull(), s).otherwise(F.struct(x["to"].alias("last"), F.concat(s["picks"], F.array(x)).alias("picks"))))
        return F.when(i <= s["last"], s).otherwise(more)

    start = F.struct(F.lit(-1).alias("last"), F.array().cast("array<struct<i:int,to:int,text:string>>").alias("picks"))
    return F.when(F.size(g) > 0, F.aggregate(F.sequence(F.lit(0), F.size(g) - 1), start, step)["picks"]).otherwise(start["picks"])


def _cards(key: str, chain: Column, usual: bool = True) -> Column:
    """struct(text, n): a chain of groups of digits with its n cards replaced.

    Runs of whole groups with 13 to 19 digits and the right check digit are cards: first those grouped
    as cards usually are, then what lies between them; earlier and longer ones before those that overlap them.
    """

    def rest(text):
        return _cards(key, text, False) if usual else F.struct(text.alias("text"), F.lit(0).alias("n"))

    def replaced(g, picks):
        # What stands before each card, and behind the last one.
        def part(k):
            first, card = F.coalesce(F.get(picks, k - 1)["to"], F.lit(-1)) + 1, F.get(picks, k)
            end = F.coalesce(card["i"], F.size(g))
            new = let(card, lambda p: F.when(p.isNull(), "").otherwise(F.concat(_card(key, p["text"]), F.regexp_replace(F.get(g, p["to"]), r"\d", ""))))
            before = rest(F.array_join(F.slice(g, first + 1, end - first), ""))
            return let(before, lambda x: F.struct(F.concat(x["text"], new).alias("text"), (x["n"] + F.when(k < F.size(picks), 1).otherwise(0)).alias("n")))

        parts = F.transform(F.sequence(F.lit(0), F.size(picks)), part)
        return let(parts, lambda x: F.struct(F.array_join(F.transform(x, lambda y: y["text"]), "").alias("text"), F.aggregate(x, F.lit(0), lambda n, y: n + y["n"]).alias("n")))

    return let(_groups(chain), lambda g: let(_picked(g, usual), lambda picks: replaced(g, picks)))


def _between(key: str, part: Column) -> Column:
    """struct(text, n): a text between other values with its n cards replaced."""
    found = F.transform(F.regexp_extract_all(part, F.lit(f"({CHAIN})"), 1), lambda m: _cards(key, m))
    new = let(found, lambda f: F.struct(F.array_join(F.zip_with(F.split(part, CHAIN, -1), f, lambda p, x: F.concat(p, F.coalesce(x["text"], F.lit("")))), "").alias("text"), F.aggregate(f, F.lit(0), lambda n, x: n + x["n"]).alias("n")))
    return F.when(part.rlike(CHAIN), new).otherwise(F.struct(part.alias("text"), F.lit(0).alias("n")))


def _phone(key: str, m: Column) -> Column:
    d = F.substr(_digits(m), F.length(_digits(m)) - 9, F.lit(10))
    area, exchange, line = _part(d, 1, 3) - 200, _part(d, 4, 3) - 200, _part(d, 7, 4)
    fits = (area >= 0) & (exchange >= 0)
    hundred = F.lit(100)
    moved = feistel(key, "phone", area * 100 + F.floor(line / hundred), exchange * 100 + line % 100, F.lit(80_000), F.lit(80_000))
    upper = lambda x: F.floor(x / hundred).cast("long")
    new = let(moved, lambda x: F.concat(_padded(upper(x["l"]) + 200, 3), _padded(upper(x["r"]) + 200, 3), _padded(x["l"] % 100, 2), _padded(x["r"] % 100, 2)))
    # The others: 200 areas with 1000 exchanges each, then 800 areas with 200 each.
    place = F.when(area < 0, (area + 200) * 1000 + exchange + 200).otherwise(200_000 + area * 200 + exchange + 200)
    spare = feistel(key, "other phone", place, line, F.lit(360_000), F.lit(10_000))
    areas = lambda x: F.when(x < 200_000, F.floor(x / 1000)).otherwise(F.floor((x - 200_000) / 200) + 200).cast("long")
    exchanges = lambda x: F.when(x < 200_000, x % 1000).otherwise((x - 200_000) % 200)
    other = let(spare, lambda x: F.concat(_padded(areas(x["l"]), 3), _padded(exchanges(x["l"]), 3), _padded(x["r"], 4)))
    lead = F.substr(_digits(m), F.lit(1), F.length(_digits(m)) - 10)
    return _filled(m, F.concat(lead, F.when(fits, new).otherwise(other)))


def _national(key: str, m: Column) -> Column:
    d = _digits(m)
    area, group, serial = _part(d, 1, 3), _part(d, 4, 2), _part(d, 6, 4)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    moved = feistel(key, "national", place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))
    areas = lambda x: F.floor(x / 99).cast("long") + F.when(x >= 665 * 99, 2).otherwise(1)
    new = let(moved, lambda x: F.concat(_padded(areas(x["l"]), 3), _padded(x["l"] % 99 + 1, 2), _padded(x["r"] + 1, 4)))
    return F.when(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), _filled(m, new)).otherwise(m)


def _address(key: str, m: Column) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    moved = feistel(key, "address", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65_536), F.lit(65_536))
    parts = lambda x: (F.floor(x["l"] / 256).cast("long"), x["l"] % 256, F.floor(x["r"] / 256).cast("long"), x["r"] % 256)
    new = let(moved, lambda x: F.concat_ws(".", *[y.cast("string") for y in parts(x)]))
    return F.when(F.forall(o, lambda x: x <= 255), new).otherwise(m)


def _date(key: str, m: Column, pattern: str) -> Column:
    day = F.try_to_date(m, pattern)
    n = F.datediff(day, F.lit(_FIRST_DAY).cast("date"))
    moved = feistel(key, "date", F.floor(n / _DAYS_RIGHT), n % _DAYS_RIGHT, F.lit(_DAYS_LEFT), F.lit(_DAYS_RIGHT))
    new = let(moved, lambda x: F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), (x["l"] * _DAYS_RIGHT + x["r"]).cast("int")), pattern))
    return F.when((n >= 0) & (n < _DAYS_LEFT * _DAYS_RIGHT), new).otherwise(m)


def pseudonym(m: Column, key: str) -> Column:
    """A found value's pseudonym; the value itself if it isn't valid."""
    at = F.instr(m, "@")
    whole = lambda kind: m.rlike(rf"^(?:{PATTERNS[kind]})$")
    return (
        F.when(whole("secret"), _secret(key, m))
        .when(at > 0, F.concat(permuted_string(key, "mail", F.substr(m, F.lit(1), at - 1), (LOWER, UPPER, DIGITS)), F.substr(m, at, F.length(m))))
        .when(whole("key"), F.concat(F.substr(m, F.lit(1), F.lit(4)), permuted_string(key, "key", F.substr(m, F.lit(5), F.length(m)), (UPPER + DIGITS,))))
        .when(whole("address"), _address(key, m))
        .when(whole("iso_date"), _date(key, m, "yyyy-MM-dd"))
        .when(whole("dotted_date"), _date(key, m, "dd.MM.yyyy"))
        .when(whole("slashed_date"), _date(key, m, "MM/dd/yyyy"))
        .when(whole("national"), _national(key, m))
        .when(whole("phone"), _phone(key, m))
        .otherwise(m)
    )


def pseudonymise(documents: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """documents with the values in text_col replaced; all other columns and the order of columns stay.

    count_col adds the number of values that were changed. Texts without a value come back as they
    are, null stays null, and no text is cut. Runs of digits without the right check digit in any
    run of whole groups, or of other lengths, and impossible dates and quads are left alone; numbers
    side by side that have the right check digit by chance count as a card. Repeated rows get equal results.
    """
    text = F.col(text_col)
    found = F.regexp_extract_all(text, F.lit(f"({ANY})"), 1)
    parts = F.split(text, ANY, -1)
    has = text.rlike("[0-9@=:]") & text.rlike(f"{ANY}|{CHAIN}")
    joined = F.array_join(F.zip_with("_parts", "_new", lambda p, n: F.concat(p["text"], F.coalesce(n, F.lit("")))), "")
    # An array that is used twice is a column of its own, or it would be computed twice.
    rows = documents.withColumns({"_found": F.when(has, found), "_parts": F.when(has, parts)})
    rows = rows.withColumns({"_new": F.transform("_found", lambda m: pseudonym(m, key)), "_parts": F.transform("_parts", lambda p: _between(key, p))})
    cards = F.aggregate("_parts", F.lit(0), lambda n, p: n + p["n"])
    changed = F.coalesce(F.size(F.filter(F.zip_with("_found", "_new", lambda a, b: a != b), lambda x: x)) + cards, F.lit(0))
    out = [F.coalesce(joined, text).alias(c) if c == text_col else F.col(c) for c in documents.columns]
    return rows.select(*out, *([changed.alias(count_col)] if count_col else []))
