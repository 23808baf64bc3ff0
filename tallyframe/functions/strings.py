"""String functions. Patterns are Java regular expressions; (?P<name>...) is accepted for (?<name>...)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.errors import EngineError


def java(pattern: str) -> str:
    return pattern.replace("(?P<", "(?<")


def pattern_of_python(pattern: str) -> str:
    """The pattern as Python's re takes it, to look at what it fits."""
    return re.sub(r"\(\?<(?=[a-zA-Z])", "(?P<", pattern)


def quoted(text: str) -> str:
    """A pattern for the text itself."""
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def _value(text: str, shift: int = 0) -> str:
    """A replacement with $1 and ${1} as references, moved by shift groups."""
    return re.sub(r"\$\{?(\d+)\}?", lambda m: f"${int(m[1]) + shift}", text)


def _literal_value(text: str) -> str:
    return text.replace("\\", r"\\").replace("$", r"\$")


class Strings:
    def __init__(self, expr):
        self.e = expr

    def len_bytes(self):
        return self.e.map(F.octet_length)

    def len_chars(self):
        return self.e.map(F.char_length)

    def contains(self, pattern: str, literal: bool = False):
        return self.e.map(lambda x: F.contains(x, F.lit(pattern)) if literal else x.rlike(java(pattern)))

    def starts_with(self, text: str):
        return self.e.map(lambda x: x.startswith(text))

    def ends_with(self, text: str):
        return self.e.map(lambda x: x.endswith(text))

    def extract(self, pattern: str, group: int = 1):
        """Null without a match."""
        return self.e.map(lambda x: F.when(x.rlike(java(pattern)), F.regexp_extract(x, java(pattern), group)))

    def extract_all(self, pattern: str):
        return self.e.map(lambda x: F.regexp_extract_all(x, F.lit(java(pattern)), F.lit(0)))

    def replace(self, pattern: str, value: str, literal: bool = False):
        """The first match only."""
        return self.replace_n(pattern, value, 1, literal)

    def replace_all(self, pattern: str, value: str, literal: bool = False):
        return self.e.map(lambda x: F.replace(x, F.lit(pattern), F.lit(value)) if literal else F.regexp_replace(x, java(pattern), _value(value)))

    def replace_n(self, pattern: str, value: str, n: int, literal: bool = False):
        """The first n matches."""
        if n < 1:
            return self.e
        if literal:
            rest = lambda parts: F.array_join(parts, value)
            return self.e.map(lambda x: rest(F.split(x, quoted(pattern), n + 1)))
        # The text before a match is group 1, so all references move by one.
        found = "((?s:.*?))(?:" + re.sub(r"\\(?:([1-9]\d*)|(.))", lambda m: f"\\{int(m[1]) + 1}" if m[1] else m[0], java(pattern), flags=re.S) + ")"
        if n == 1:
            return self.e.map(lambda x: F.regexp_replace(x, "^" + found, "$1" + _value(value, 1)))
        if re.match(pattern_of_python(pattern), ""):
            raise EngineError("INVALID", "a pattern that fits no characters can't be replaced n times")

        def several(x: Column) -> Column:
            every = lambda group: F.slice(F.regexp_extract_all(x, F.lit(found), F.lit(group)), 1, n)
            # The value's literal parts and references, in turns.
            parts = re.split(r"\$\{?(\d+)\}?", value)
            groups = [int(g) for g in parts[1::2]]
            names = {g: f"g{g}" for g in groups if g}
            rows = F.arrays_zip(every(0).alias("all"), every(1).alias("before"), *[every(g + 1).alias(k) for g, k in names.items()])

            def one(r: Column) -> Column:
                # $0 is the match without what stands before it.
                got = [r[names[g]] if g else F.substr(r["all"], F.char_length(r["before"]) + 1) for g in groups]
                return F.concat(r["before"], *[y for t, g in zip(parts[::2], [*got, F.lit("")], strict=True) for y in (F.lit(t), g)])

            seen = F.aggregate(every(0), F.lit(0), lambda a, m: a + F.char_length(m))
            return F.concat(F.array_join(F.transform(rows, one), ""), F.substr(x, seen + 1))

        return self.e.map(several)

    def count_matches(self, pattern: str, literal: bool = False):
        return self.e.map(lambda x: F.regexp_count(x, F.lit(quoted(pattern) if literal else java(pattern))))

    def to_lowercase(self):
        return self.e.map(F.lower)

    def to_uppercase(self):
        return self.e.map(F.upper)

    def to_titlecase(self):
        return self.e.map(F.initcap)

    def strip_chars(self, chars: str = ""):
        """chars is a set; empty means white space."""
        return self.e.map(lambda x: F.btrim(x, F.lit(chars)) if chars else F.regexp_replace(x, r"^\s+|\s+$", ""))

    def strip_prefix(self, text: str):
        return self.e.map(lambda x: F.when(x.startswith(text), F.substr(x, F.lit(len(text) + 1))).otherwise(x))

    def strip_suffix(self, text: str):
        return self.e.map(lambda x: F.when(x.endswith(text), F.substr(x, F.lit(1), F.char_length(x) - len(text))).otherwise(x))

    def slice(self, offset: int, length: int | None = None):
        """In characters from 0; a negative offset counts from the end, and what lies before the start is cut off."""

        def part(x: Column) -> Column:
            n = F.char_length(x)
            begin = F.lit(offset) if offset >= 0 else n + offset
            end = F.least(n, begin + length) if length is not None else n
            first = F.greatest(begin, F.lit(0))
            return F.substr(x, first + 1, F.greatest(end - first, F.lit(0)))

        return self.e.map(part)

    def split(self, by: str):
        """By a literal; an empty one splits into characters."""
        return self.e.map(lambda x: F.split(x, quoted(by), -1) if by else F.split(x, "", -1))

    def pad_start(self, length: int, fill: str = " "):
        return self._pad(F.lpad, length, fill)

    def pad_end(self, length: int, fill: str = " "):
        return self._pad(F.rpad, length, fill)

    def _pad(self, f, length: int, fill: str):
        """Never cuts."""
        if len(fill) != 1:
            raise EngineError("INVALID", "the fill is one character")
        return self.e.map(lambda x: F.when(F.char_length(x) >= length, x).otherwise(f(x, length, fill)))

    def to_date(self, fmt: str):
        from tallyframe.functions.temporal import pattern

        return self.e.map(lambda x: F.to_date(x, pattern(fmt)))

    def to_datetime(self, fmt: str):
        from tallyframe.functions.temporal import pattern

        return self.e.map(lambda x: F.to_timestamp_ntz(x, F.lit(pattern(fmt))))

    def to_time(self, fmt: str):
        from tallyframe.functions.temporal import pattern

        return self.e.map(lambda x: F.to_time(x, F.lit(pattern(fmt))))
