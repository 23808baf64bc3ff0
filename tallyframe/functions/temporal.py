"""Parts and month borders of dates and datetimes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.errors import EngineError

#: Strftime fields and the patterns that Spark reads.
FIELDS = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%f": "SSSSSS", "%y": "yy", "%b": "MMM", "%B": "MMMM", "%j": "DDD", "%p": "a", "%I": "hh", "%F": "yyyy-MM-dd", "%T": "HH:mm:ss", "%%": "%"}


def pattern(fmt: str) -> str:
    """A strftime format as a Spark pattern."""
    out, i = "", 0
    while i < len(fmt):
        if fmt[i] == "%":
            if fmt[i : i + 2] not in FIELDS:
                raise EngineError("INVALID", f"unknown field {fmt[i : i + 2]!r}")
            out += FIELDS[fmt[i : i + 2]]
            i += 2
        else:
            out += f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i]
            i += 1
    return out


class Dates:
    def __init__(self, expr):
        self.e = expr

    def year(self):
        return self.e.map(F.year)

    def month(self):
        return self.e.map(F.month)

    def day(self):
        return self.e.map(F.day)

    def weekday(self):
        """Monday is 1."""
        return self.e.map(lambda x: F.weekday(x) + 1)

    def hour(self):
        return self.e.map(F.hour)

    def minute(self):
        return self.e.map(F.minute)

    def second(self):
        return self.e.map(lambda x: F.second(x).cast("int"))

    def month_start(self):
        """A datetime keeps its time of day."""
        return self.e._typed(lambda p, x: F.trunc(x, "MM") if isinstance(p.kind(x), T.DateType) else x - F.make_dt_interval(F.day(x) - 1))

    def month_end(self):
        return self.e._typed(lambda p, x: F.last_day(x) if isinstance(p.kind(x), T.DateType) else x + F.make_dt_interval(F.day(F.last_day(x)) - F.day(x)))
