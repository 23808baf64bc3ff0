"""Expressions: columns that may be aggregates, may need an order of rows, and know their place.

An Expr builds a Spark column when it is told where it stands: in a row, in a group's aggregation,
over a window, or as a value of the whole frame beside rows. All else is Spark's.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import wraps
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.errors import EngineError, OrderError
from tallyframe.functions import dtypes

WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


@dataclass
class Place:
    """Where an expression stands. mode: row, group, over, or scalar (aggregates become values of scalars, one row for the frame)."""

    df: DataFrame
    order: list[Column] = field(default_factory=list)
    mode: str = "row"
    partition: list[Column] = field(default_factory=list)
    scalars: list[Column] = field(default_factory=list)

    def window(self, what: str, reverse: bool = False) -> WindowSpec:
        if not self.order:
            raise OrderError(what)
        return Window.partitionBy(*self.partition).orderBy(*[flipped(c) for c in self.order] if reverse else self.order)

    def aggregate(self, c: Column) -> Column:
        if self.mode == "list":
            raise EngineError("INVALID", "this reduction has no list function")
        if self.mode == "over":
            return c.over(Window.partitionBy(*self.partition).rowsBetween(*WHOLE))
        if self.mode == "scalar":
            self.scalars.append(c)
            return F.col(f"_scalar{len(self.scalars) - 1}")
        return c

    def kind(self, c: Column) -> T.DataType:
        """The type of a column of the frame."""
        return self.df.select(c).schema[0].dataType


def flipped(c: Column) -> Column:
    """An order key in the other direction; keys are made by order_key, which remembers its parts."""
    parts = getattr(c, "_order", None)
    return order_key(parts[0], not parts[1], not parts[2]) if parts else order_key(c, True, True)


def order_key(c: Column, descending: bool = False, nulls_last: bool = False) -> Column:
    """Nulls come first in both directions unless nulls_last."""
    name = ("desc" if descending else "asc") + ("_nulls_last" if nulls_last else "_nulls_first")
    out = getattr(c, name)()
    out._order = (c, descending, nulls_last)
    return out


def plain(c: Column) -> Column:
    return c._order[0] if getattr(c, "_order", None) else c


def rising(c: Column, kind: T.DataType, descending: bool = False, nulls_last: bool = False) -> Column:
    """A struct that rises along an order key, so that keys of several directions can be compared as one value."""
    value = c
    if descending:
        if dtypes.is_float(kind):
            value = F.struct(~F.isnan(c), -c)
        elif dtypes.is_integer(kind):
            value = F.bitwise_not(c)
        elif isinstance(kind, T.BooleanType):
            value = ~c
        elif isinstance(kind, T.DecimalType):
            value = -c
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = F.lit("1970-01-01").cast(kind) - c
        elif isinstance(kind, (T.StringType, T.BinaryType)):
            # Digits of the bytes, turned round; a shorter string comes after those that go on from it.
            value = F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))
        else:
            raise EngineError("INVALID", f"no descending key of {kind.simpleString()} can be compared with others")
    return F.struct(c.isNull() if nulls_last else c.isNotNull(), value)


def reduction(method):
    """Marks a method that reduces values; within a list (Lists.agg) the list function of its name stands in for it."""

    @wraps(method)
    def run(self, *args, **named):
        out = method(self, *args, **named)
        build = out.build
        out.build = lambda p: p.reduced(method.__name__, self, args, named) if p.mode == "list" else build(p)
        return out

    return run


def _power(a: Column, b: Column) -> Column:
    """Integer power by squaring over the exponent's bits; nothing is squared beyond the last bit, so only a true overflow raises."""
    last = F.length(F.bin(b)) - 1

    def step(s, i):
        bit = F.getbit(b.cast("long"), i) == 1
        return F.struct(F.when(bit, s["out"] * s["base"]).otherwise(s["out"]).alias("out"), F.when(i < last, s["base"] * s["base"]).otherwise(s["base"]).alias("base"))

    start = F.struct(F.lit(1).cast("long").alias("out"), a.cast("long").alias("base"))
    return F.when(b < 0, F.pow(a, b).cast("long")).otherwise(F.aggregate(F.sequence(F.lit(0), last), start, step)["out"])


class Expr:
    """A named column to be; see the module. Names follow the first input unless alias sets one."""

    def __init__(self, build: Callable[[Place], Column], name: str, reduces: bool = False, expand: Callable[[DataFrame], list[Expr]] | None = None, shortens: Callable[[Place], Column] | None = None, pred: Expr | None = None, sort: list[tuple[Expr, bool, bool]] | None = None):
        self.build, self.name, self.reduces, self.expand, self.shortens, self.pred, self.sort = build, name, reduces, expand, shortens, pred, sort

    # Namespaces
    @property
    def str(self):
        from tallyframe.functions.strings import Strings

        return Strings(self)

    @property
    def dt(self):
        from tallyframe.functions.temporal import Dates

        return Dates(self)

    @property
    def list(self):
        from tallyframe.functions.lists import Lists

        return Lists(self)

    def map(self, f: Callable[..., Column], *others: Any, reduces: bool = False) -> Expr:
        """A row-wise function of this column and others (expressions or values)."""
        parts = [self, *[lit(o) for o in others]]
        out = Expr(lambda p: f(*[x.build(p) for x in parts]), self.name, any(x.reduces for x in parts) or reduces)
        if self.expand:
            out.expand = lambda df: [x.map(f, *others) for x in self.expand(df)]
        return out

    def _typed(self, f: Callable[..., Column], *others: Any) -> Expr:
        """Like map, with the frame and its place as the first argument."""
        parts = [self, *[lit(o) for o in others]]
        out = Expr(lambda p: f(p, *[x.build(p) for x in parts]), self.name, any(x.reduces for x in parts))
        if self.expand:
            out.expand = lambda df: [x._typed(f, *others) for x in self.expand(df)]
        return out

    def _agg(self, f: Callable[[Place, Column], Column]) -> Expr:
        """An aggregate of the values, of those alone that pass a filter if there is one."""

        def build(p: Place) -> Column:
            inner = replace(p, mode="row") if p.mode != "over" else p
            x = self.build(inner)
            return p.aggregate(f(p, F.when(self.pred.build(inner), x) if self.pred is not None else x))

        out = Expr(build, self.name, True)
        if self.expand:
            out.expand = lambda df: [x._agg(f) for x in self.expand(df)]
        return out

    def alias(self, name: str) -> Expr:
        return Expr(self.build, name, self.reduces, shortens=self.shortens, pred=self.pred, sort=self.sort)

    # Comparison, logic, arithmetic
    def __eq__(self, o):  # type: ignore[override]
        return self.map(lambda a, b: a == b, o)

    def __ne__(self, o):  # type: ignore[override]
        return self.map(lambda a, b: a != b, o)

    __hash__ = None

    def __lt__(self, o):
        return self.map(lambda a, b: a < b, o)

    def __le__(self, o):
        return self.map(lambda a, b: a <= b, o)

    def __gt__(self, o):
        return self.map(lambda a, b: a > b, o)

    def __ge__(self, o):
        return self.map(lambda a, b: a >= b, o)

    def __and__(self, o):
        return self.map(lambda a, b: a & b, o)

    def __or__(self, o):
        return self.map(lambda a, b: a | b, o)

    def __invert__(self):
        return self.map(lambda a: ~a)

    def __xor__(self, o):
        return self._typed(lambda p, a, b: (a != b) if isinstance(p.kind(a), T.BooleanType) else a.bitwiseXOR(b), o)

    def __add__(self, o):
        """A sum; strings are joined."""
        return self._typed(lambda p, a, b: F.concat(a, b) if isinstance(p.kind(a), T.StringType) else a + b, o)

    def __sub__(self, o):
        return self.map(lambda a, b: a - b, o)

    def __mul__(self, o):
        return self.map(lambda a, b: a * b, o)

    def __truediv__(self, o):
        """Integers are divided to the integer towards zero, null by zero; others as floats, with infinities and NaN by zero."""
        return self._typed(_divide, o)

    def __mod__(self, o):
        """The remainder with the divisor's sign; null by integer zero."""
        return self._typed(lambda p, a, b: F.when(b != 0, F.try_mod(F.try_mod(a, b) + b, b)), o)

    def __pow__(self, o):
        """Integers to integers stay integers and are exact; beyond a long they raise. A negative exponent gives the power cut to an integer."""
        whole = lambda p, x: dtypes.is_integer(p.kind(x))
        return self._typed(lambda p, a, b: _power(a, b) if whole(p, a) and whole(p, b) else F.pow(a, b), o)

    # Nulls and NaN
    def is_null(self):
        return self.map(lambda a: a.isNull())

    def is_not_null(self):
        return self.map(lambda a: a.isNotNull())

    def is_nan(self):
        return self.map(lambda a: F.when(a.isNotNull(), F.isnan(a)))

    def is_finite(self):
        return self.map(lambda a: F.when(a.isNotNull(), ~F.isnan(a) & (F.abs(a) < F.lit(float("inf")))))

    def fill_null(self, value):
        return self.map(lambda a, b: F.coalesce(a, b), value)

    def fill_nan(self, value):
        return self.map(lambda a, b: F.when(F.isnan(a), b).otherwise(a), value)

    # Math
    def abs(self):
        return self.map(F.abs)

    def round(self, decimals: int = 0):
        """Halves go to the even neighbour."""
        return self.map(lambda a: F.bround(a, decimals))

    def sqrt(self):
        return self.map(F.sqrt)

    def log(self, base: float):
        """NaN below 0, minus infinity at 0."""
        value = lambda a: F.when(a < 0, F.lit(float("nan"))).when(a == 0, F.lit(float("-inf"))).otherwise(F.log(a.cast("double")) / F.log(F.lit(float(base))))
        return self.map(lambda a: F.when(a.isNotNull(), value(a)))

    def clip(self, low, high):
        return self.map(lambda a, x, y: F.when(a < x, x).when(a > y, y).otherwise(a), low, high)

    def cast(self, dtype, strict: bool = True):
        return self.map(lambda a: dtypes.cast(a, dtype, strict))

    # Aggregates
    @reduction
    def sum(self):
        """0 for no values."""
        return self._agg(lambda p, x: F.coalesce(F.sum(x), F.lit(0)))._over_safe("sum", self)

    @reduction
    def mean(self):
        return self._agg(lambda p, x: F.avg(x))

    @reduction
    def min(self):
        """NaN only if all values are NaN."""
        return self._agg(lambda p, x: _extreme(F.min, p, x))._over_safe("min", self)

    @reduction
    def max(self):
        return self._agg(lambda p, x: _extreme(F.max, p, x))._over_safe("max", self)

    @reduction
    def count(self):
        return self._agg(lambda p, x: F.count(x))

    @reduction
    def len(self):
        """Rows, nulls among them."""
        if self.pred is not None:
            return self.pred._agg(lambda p, x: F.count_if(x)).alias(self.name)
        return self._agg(lambda p, x: F.count(F.lit(1)))

    @reduction
    def null_count(self):
        base = Expr(self.build, self.name)
        if self.pred is not None:
            return base.map(lambda x, c: x.isNull() & c, self.pred)._agg(lambda p, x: F.count_if(x))
        return base._agg(lambda p, x: F.count_if(x.isNull()))

    @reduction
    def n_unique(self):
        """Distinct values, null being one."""
        parts = Expr(self.build, self.name)
        test = self.pred

        def build(p: Place) -> Column:
            inner = replace(p, mode="row") if p.mode != "over" else p
            x = parts.build(inner)
            good = test.build(inner) if test is not None else F.lit(True)
            kept = F.when(good, x)
            # Spark has no distinct aggregates over windows.
            distinct = F.size(p.aggregate(F.collect_set(kept))).cast("long") if p.mode == "over" else p.aggregate(F.count_distinct(kept))
            return distinct + F.coalesce(p.aggregate(F.max((x.isNull() & good).cast("int"))), F.lit(0))

        return Expr(build, self.name, True)

    @reduction
    def first(self):
        return self._end(True)

    @reduction
    def last(self):
        return self._end(False)

    def _end(self, front: bool) -> Expr:
        """The first or last row's value, nulls included, by the frame's order or by sort_by."""

        def build(p: Place) -> Column:
            inner = replace(p, mode="row") if p.mode != "over" else p
            if self.sort:
                values = p.aggregate(self._listed(inner))
                return F.try_element_at(values, F.lit(1 if front else -1))
            if not p.order:
                raise OrderError("first" if front else "last")
            parts = [getattr(c, "_order", (c, False, False)) for c in p.order]
            key = F.struct(*[rising(c, p.kind(c), d, n) for c, d, n in parts])
            key = F.when(self.pred.build(inner), key) if self.pred is not None else key
            return p.aggregate((F.min_by if front else F.max_by)(self.build(inner), key))

        return Expr(build, self.name, True)

    @reduction
    def median(self):
        return self._agg(lambda p, x: F.percentile(x, F.lit(0.5)))

    @reduction
    def std(self):
        """With n - 1; null for a single value."""
        return self._agg(lambda p, x: F.stddev_samp(x))

    @reduction
    def var(self):
        return self._agg(lambda p, x: F.var_samp(x))

    @reduction
    def quantile(self, q: float, method: str = "linear"):
        """method: linear, nearest, lower, higher, midpoint, equiprobable."""
        if not 0 <= q <= 1:
            raise EngineError("INVALID", "a quantile is between 0 and 1")
        if method == "linear":
            return self._agg(lambda p, x: F.percentile(x, F.lit(q)))
        if method not in ("nearest", "lower", "higher", "midpoint", "equiprobable"):
            raise EngineError("INVALID", f"unknown method {method!r}")

        def build(p: Place) -> Column:
            inner = replace(p, mode="row") if p.mode != "over" else p
            x = self.build(inner)
            x = F.when(self.pred.build(inner), x) if self.pred is not None else x
            values = F.sort_array(p.aggregate(F.collect_list(x)))
            n = F.size(values)
            at = (n - 1) * F.lit(q)
            low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
            place = {
                "lower": low,
                "higher": high,
                "nearest": F.round(at).cast("int"),
                "equiprobable": F.greatest(F.ceil(n * F.lit(q)) - 1, F.lit(0)).cast("int"),
            }
            got = (F.get(values, low) + F.get(values, high)) / 2 if method == "midpoint" else F.get(values, place[method])
            return F.when(n > 0, got).cast("double")

        return Expr(build, self.name, True)

    def _over_safe(self, kind: str, source: Expr) -> Expr:
        """The same aggregate in parts, as a function of an aggregate can't be windowed as a whole."""

        def build(p: Place) -> Column:
            if p.mode not in ("over", "scalar"):
                return self.build(p)
            inner = replace(p, mode="row") if p.mode != "over" else p
            x = source.build(inner)
            x = F.when(source.pred.build(inner), x) if source.pred is not None else x
            if kind == "sum":
                return F.coalesce(p.aggregate(F.sum(x)), F.lit(0))
            f = F.min if kind == "min" else F.max
            if not dtypes.is_float(p.kind(x)):
                return p.aggregate(f(x))
            return F.coalesce(p.aggregate(f(F.when(~F.isnan(x), x))), p.aggregate(f(x)))

        return Expr(build, self.name, True, expand=self.expand)

    def value_counts(self, sort: bool = False, normalize: bool = False, name: str = "count") -> ValueCounts:
        """Counts of each value: see Frame.value_counts, which takes one of these."""
        return ValueCounts(self, sort, normalize, name)

    # Within an aggregation
    def filter(self, pred: Expr) -> Expr:
        """Only the values for which pred holds; alone in an aggregation, their list."""
        return Expr(self.build, self.name, pred=pred, sort=self.sort)

    def sort_by(self, by: Sequence[Expr] | Expr, descending: bool | Sequence[bool] = False, nulls_last: bool | Sequence[bool] = False) -> Expr:
        """Values in the order of by; alone in an aggregation, their list. A short list of flags repeats its last."""
        by = [by] if isinstance(by, Expr) else [*by]

        def flags(x):
            x = [x] if isinstance(x, bool) else [*x]
            return (x + [x[-1]] * len(by))[: len(by)]

        return Expr(self.build, self.name, pred=self.pred, sort=[*zip(by, flags(descending), flags(nulls_last), strict=True)])

    def _listed(self, p: Place) -> Column:
        """The list aggregate of the values, nulls kept, in the order there is. (Group or window is up to the caller.)"""
        x = self.build(p)
        keys = [(e.build(p), d, n) for e, d, n in self.sort] if self.sort else [getattr(c, "_order", (c, False, False)) for c in p.order]
        row = F.struct(*[k.alias(f"k{i}") for i, (k, _, _) in enumerate(keys)], x.alias("x"))
        rows = F.collect_list(F.when(self.pred.build(p), row) if self.pred is not None else row)
        if not keys:
            return F.transform(rows, lambda r: r["x"])

        def compare(a, b):
            out = F.lit(0)
            for i, (_, desc, last) in reversed([*enumerate(keys)]):
                u, v = a[f"k{i}"], b[f"k{i}"]
                null = F.lit(1 if last else -1)
                less = F.lit(1 if desc else -1)
                out = F.when(u.isNull() & v.isNull(), out).when(u.isNull(), null).when(v.isNull(), -null).when(u < v, less).when(u > v, -less).otherwise(out)
            return out

        return F.transform(F.array_sort(rows, compare), lambda r: r["x"])

    def imploded(self) -> Expr:
        """What an expression that doesn't reduce is in an aggregation: the list of its values."""

        def build(p: Place) -> Column:
            if p.mode == "group":
                return self._listed(replace(p, mode="row"))
            x = self.build(p)
            return F.transform(F.collect_list(F.struct(x.alias("x"))).over(p.window("a list").rowsBetween(*WHOLE)), lambda r: r["x"])

        return Expr(build, self.name, True)

    # Windows
    def over(self, *partition: Expr | str, order_by: Sequence[Expr | str] = (), descending: bool = False, nulls_last: bool = False, mapping: str = "group_to_rows") -> Expr:
        """This expression within the rows that share partition. An order is for order-dependent expressions: aggregates see the whole partition. mapping: group_to_rows, join (the partition's list on each row)."""
        if not partition and not order_by:
            raise EngineError("INVALID", "over needs a partition or an order")
        if mapping not in ("group_to_rows", "join"):
            raise EngineError("INVALID", "mapping is group_to_rows or join; for explode use Frame.over_exploded")
        inner = self.imploded() if mapping == "join" and not self.reduces else self

        def within(p: Place) -> Place:
            base = replace(p, mode="row")
            keys = [order_key(col(o).build(base), descending, nulls_last) for o in order_by]
            return replace(p, mode="over", partition=[col(x).build(base) for x in partition], order=keys or p.order)

        return Expr(lambda p: inner.build(within(p)), self.name, shortens=(lambda p: self.shortens(within(p))) if self.shortens else None)

    def _windowed(self, f: Callable[[Place, Column], Column]) -> Expr:
        def build(p: Place) -> Column:
            return f(p, self.build(p))

        out = Expr(build, self.name)
        if self.expand:
            out.expand = lambda df: [x._windowed(f) for x in self.expand(df)]
        return out

    def rank(self, method: str = "dense", descending: bool = False) -> Expr:
        """method: dense, average, min, max, ordinal (ties by the frame's order). Null for null."""
        if method not in ("dense", "average", "min", "max", "ordinal"):
            raise EngineError("INVALID", f"unknown method {method!r}")

        def build(p: Place, x: Column) -> Column:
            key = order_key(x, descending, True)
            w = Window.partitionBy(*p.partition).orderBy(key)
            if method == "ordinal":
                if not p.order:
                    raise OrderError("an ordinal rank")
                got = F.row_number().over(Window.partitionBy(*p.partition).orderBy(key, *p.order))
            elif method == "dense":
                got = F.dense_rank().over(w)
            else:
                ties = F.count(F.lit(1)).over(Window.partitionBy(*p.partition, x))
                low = F.rank().over(w)
                got = {"min": low, "max": low + ties - 1, "average": low + (ties - 1) / F.lit(2.0)}[method]
            return F.when(x.isNotNull(), got)

        return self._windowed(build)

    def _running(self, what: str, f: Callable[[Column], Column], reverse: bool) -> Expr:
        return self._windowed(lambda p, x: F.when(x.isNotNull(), f(x).over(p.window(what, reverse).rowsBetween(Window.unboundedPreceding, 0))))

    def cum_sum(self, reverse: bool = False):
        return self._running("cum_sum", F.sum, reverse)

    def cum_min(self, reverse: bool = False):
        return self._running("cum_min", F.min, reverse)

    def cum_max(self, reverse: bool = False):
        return self._running("cum_max", F.max, reverse)

    def cum_count(self, reverse: bool = False):
        return self._windowed(lambda p, x: F.count(x).over(p.window("cum_count", reverse).rowsBetween(Window.unboundedPreceding, 0)))

    def cum_prod(self, reverse: bool = False):
        """Exact for integers within 64 bits. These fold the running list of the factors other than 1, of which 64 overflow, so it stays short unless a zero comes before; other numbers keep one product."""

        def build(p: Place, x: Column) -> Column:
            w = p.window("cum_prod", reverse).rowsBetween(Window.unboundedPreceding, 0)
            if not dtypes.is_integer(p.kind(x)):
                return F.when(x.isNotNull(), F.product(x.cast("double")).over(w))
            # Factors of -1 only turn the sign.
            seen = F.collect_list(F.when(~x.isin(1, -1), x.cast("long"))).over(w)
            sign = F.when(F.count_if(x == -1).over(w) % 2 == 1, -1).otherwise(1).cast("long")
            return F.when(x.isNotNull(), F.aggregate(seen, sign, lambda a, b: a * b))

        return self._windowed(build)

    def shift(self, n: int = 1):
        return self._windowed(lambda p, x: F.lag(x, n).over(p.window("shift")) if n >= 0 else F.lead(x, -n).over(p.window("shift")))

    def diff(self, n: int = 1, drop: bool = False):
        """drop: without the rows that have no value n before; only alone in a select."""
        out = self._windowed(lambda p, x: x - (F.lag(x, n).over(p.window("diff")) if n >= 0 else F.lead(x, -n).over(p.window("diff"))))
        if drop:
            out.shortens = lambda p: (F.row_number().over(p.window("diff", reverse=n < 0)) > abs(n))
        return out

    def ffill(self, limit: int | None = None):
        first = -limit if limit is not None else Window.unboundedPreceding
        return self._windowed(lambda p, x: F.last(x, ignorenulls=True).over(p.window("ffill").rowsBetween(first, 0)))

    def bfill(self, limit: int | None = None):
        last = limit if limit is not None else Window.unboundedFollowing
        return self._windowed(lambda p, x: F.first(x, ignorenulls=True).over(p.window("bfill").rowsBetween(0, last)))

    def reverse(self):
        """The column's values from the last row to the first, whatever the other columns do."""

        def build(p: Place, x: Column) -> Column:
            w = p.window("reverse")
            n, at = F.count(F.lit(1)).over(Window.partitionBy(*p.partition)), F.row_number().over(w)
            rows = F.transform(F.collect_list(F.struct(x.alias("x"))).over(w.rowsBetween(*WHOLE)), lambda r: r["x"])
            return F.get(rows, (n - at).cast("int"))

        return self._windowed(build)

    def is_duplicated(self):
        return self._windowed(lambda p, x: F.count(F.lit(1)).over(Window.partitionBy(*p.partition, x)) > 1)

    def _rolling(self, what: str, f: Callable[[Column], Column], size: int, min_periods: int, center: bool) -> Expr:
        if size < 1 or not 1 <= min_periods <= size:
            raise EngineError("INVALID", "window_size must be positive and min_periods between 1 and it")
        start, end = (-(size // 2), size - 1 - size // 2) if center else (1 - size, 0)

        def build(p: Place, x: Column) -> Column:
            w = p.window(what).rowsBetween(start, end)
            return F.when(F.count(x).over(w) >= min_periods, f(x).over(w))

        return self._windowed(build)

    def rolling_min(self, window_size: int = 1, min_periods: int = 1, center: bool = False):
        return self._rolling("rolling_min", F.min, window_size, min_periods, center)

    def rolling_max(self, window_size: int = 1, min_periods: int = 1, center: bool = False):
        return self._rolling("rolling_max", F.max, window_size, min_periods, center)

    def rolling_mean(self, window_size: int = 1, min_periods: int = 1, center: bool = False):
        return self._rolling("rolling_mean", F.avg, window_size, min_periods, center)

    def rolling_sum(self, window_size: int = 1, min_periods: int = 1, center: bool = False):
        return self._rolling("rolling_sum", F.sum, window_size, min_periods, center)

    def exclude(self, *names: str) -> Expr:
        """All columns but these; only of all_columns()."""
        if self.name != "*":
            raise EngineError("INVALID", "exclude works on all columns only")
        return all_columns(*names)

    def map_batches(self, fn, return_type=None, whole_frame: bool = False) -> Expr:
        from tallyframe.functions.udf import map_batches

        return map_batches([self], fn, return_type, whole_frame)


@dataclass
class ValueCounts:
    expr: Expr
    sort: bool
    normalize: bool
    name: str


def _divide(p: Place, a: Column, b: Column) -> Column:
    if dtypes.is_integer(p.kind(a)) and dtypes.is_integer(p.kind(b)):
        return F.when(b != 0, F.call_function("div", a, F.nullif(b, F.lit(0)))).cast("long")
    a, b = a.cast("double"), b.cast("double")
    by_zero = F.when(a.isNull(), None).when((a == 0) | F.isnan(a), F.lit(float("nan"))).when(a > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    return F.when(b == 0, by_zero).otherwise(F.try_divide(a, b))


def _extreme(f, p: Place, x: Column) -> Column:
    if not dtypes.is_float(p.kind(x)):
        return f(x)
    return F.coalesce(f(F.when(~F.isnan(x), x)), f(x))


# Constructors


def col(name: str | Expr) -> Expr:
    """A column; ^...$ is a pattern of names."""
    if isinstance(name, Expr):
        return name
    if name == "*":
        return all_columns()
    if name.startswith("^") and name.endswith("$"):
        return Expr(lambda p: F.col(name), name, expand=lambda df: [col(c) for c in df.columns if re.fullmatch(name, c)])
    return Expr(lambda p: F.col(f"`{name}`"), name)


def cols(*names: str) -> list[Expr]:
    return [col(n) for n in names]


def all_columns(*without: str) -> Expr:
    return Expr(lambda p: F.col("*"), "*", expand=lambda df: [col(c) for c in df.columns if c not in without])


def lit(value: Any) -> Expr:
    return value if isinstance(value, Expr) else Expr(lambda p: F.lit(value), "literal")


def struct(*exprs: Expr | str) -> Expr:
    parts = [col(e) for e in exprs]
    if not parts:
        raise EngineError("INVALID", "a struct needs a field")
    return Expr(lambda p: F.struct(*[e.build(p).alias(e.name) for e in parts]), parts[0].name)


class When:
    def __init__(self, pred: Expr):
        self.pred = pred

    def then(self, value: Any) -> Then:
        return Then(self.pred, lit(value))


class Then:
    def __init__(self, pred: Expr, value: Expr):
        self.pred, self.value = pred, value

    def otherwise(self, other: Any) -> Expr:
        """A null condition takes the other value."""
        parts = (self.pred, self.value, lit(other))
        return Expr(lambda p: F.when(parts[0].build(p), parts[1].build(p)).otherwise(parts[2].build(p)), self.value.name, any(x.reduces for x in parts))


def when(pred: Expr) -> When:
    return When(pred)
