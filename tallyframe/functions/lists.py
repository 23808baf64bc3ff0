"""Functions of list columns. Null lists give null unless said otherwise."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.errors import EngineError
from tallyframe.functions import dtypes
from tallyframe.functions.expr import Expr, Place, col, lit


def element() -> Expr:
    """The list's element, inside eval."""
    return Expr(lambda p: p.element, "element")


def concat_list(*exprs: Expr | str) -> Expr:
    """One list of the values; lists among them are joined."""
    parts = [col(e) for e in exprs]

    def build(p: Place) -> Column:
        columns = [e.build(p) for e in parts]
        if any(isinstance(p.kind(c), T.ArrayType) for c in columns):
            return F.concat(*[c if isinstance(p.kind(c), T.ArrayType) else F.array(c) for c in columns])
        return F.array(*columns)

    return Expr(build, parts[0].name)


def _present(x: Column) -> Column:
    return F.filter(x, lambda e: e.isNotNull())


def _sum(x: Column, start: str = "double") -> Column:
    return F.aggregate(_present(x), F.lit(0).cast(start), lambda a, e: a + e.cast(start))


def _slice(x: Column, begin: Column, end: Column) -> Column:
    """Elements from begin (0 first) up to end, both cut to the list."""
    n = F.size(x)
    first = F.greatest(begin, F.lit(0))
    return F.slice(x, first + 1, F.greatest(F.least(end, n) - first, F.lit(0)))


class Lists:
    def __init__(self, expr):
        self.e = expr

    def _kind(self, p: Place, x: Column) -> T.DataType:
        return p.kind(x).elementType

    def eval(self, evaluation: Expr) -> Expr:
        """A row-wise expression of element() for each element."""

        def build(p: Place, x: Column) -> Column:
            def one(e: Column) -> Column:
                inside = _Inside(p, e, self._kind(p, x))
                return evaluation.build(inside)

            return F.transform(x, one)

        return self.e._typed(build)

    def agg(self, evaluation: str | Expr) -> Expr:
        """A reduction by its name (sum, mean, min, max, median, std, var, len, n_unique, first, last, any, all), or an expression of element() that reduces."""
        if isinstance(evaluation, str):
            return getattr(self, evaluation)()
        if not evaluation.reduces:
            raise EngineError("INVALID", "agg needs an expression that reduces; for others use eval")
        return self.e._typed(lambda p, x: evaluation.build(_Whole(p, x)))

    def len(self):
        return self.e.map(lambda x: F.when(x.isNotNull(), F.size(x)))

    def sum(self):
        return self.e._typed(lambda p, x: _sum(x, "long" if dtypes.is_integer(self._kind(p, x)) else "double"))

    def mean(self):
        return self.e.map(lambda x: F.when(F.size(_present(x)) > 0, _sum(x) / F.size(_present(x))))

    def median(self):
        def build(x: Column) -> Column:
            s = F.sort_array(_present(x))
            n = F.size(s)
            at = lambda i: F.get(s, i.cast("int")).cast("double")
            return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)

        return self.e.map(build)

    def max(self):
        return self._extreme(F.array_max)

    def min(self):
        return self._extreme(F.array_min)

    def _extreme(self, f):
        """NaN only if nothing else is there."""
        return self.e._typed(lambda p, x: F.coalesce(f(F.filter(x, lambda e: ~F.isnan(e))), f(x)) if dtypes.is_float(self._kind(p, x)) else f(x))

    def var(self, ddof: int = 1):
        def build(x: Column) -> Column:
            n = F.size(_present(x))
            state = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("s"))

            def add(a, e):
                d = e.cast("double") - a["m"]
                m = a["m"] + d / (a["n"] + 1)
                return F.struct((a["n"] + 1).alias("n"), m.alias("m"), (a["s"] + d * (e.cast("double") - m)).alias("s"))

            return F.when(n > ddof, F.aggregate(_present(x), state, add)["s"] / F.when(n > ddof, n - ddof))

        return self.e.map(build)

    def std(self, ddof: int = 1):
        return self.var(ddof).map(F.sqrt)

    def contains(self, value):
        """False where the value is missing, even beside nulls; null equals nothing."""
        return self.e.map(lambda x, v: F.when(x.isNotNull(), F.coalesce(F.exists(x, lambda e: e == v), F.lit(False))), value)

    def sort(self, descending: bool = False, nulls_last: bool = False):
        """Nulls come first in both directions unless nulls_last."""

        def build(x: Column) -> Column:
            some = F.sort_array(_present(x), not descending)
            nulls = F.filter(x, lambda e: e.isNull())
            return F.concat(some, nulls) if nulls_last else F.concat(nulls, some)

        return self.e.map(build)

    def reverse(self):
        return self.e.map(F.reverse)

    def unique(self):
        return self.e.map(F.array_distinct)

    unique_stable = unique

    def n_unique(self):
        return self.e.map(lambda x: F.when(x.isNotNull(), F.size(F.array_distinct(x))))

    def arg_min(self):
        return self._arg(F.array_min)

    def arg_max(self):
        return self._arg(F.array_max)

    def _arg(self, f):
        return self.e.map(lambda x: F.nullif(F.array_position(x, f(x)), F.lit(0)) - 1)

    def any(self):
        return self.e.map(lambda x: F.exists(_present(x), lambda e: e))

    def all(self):
        return self.e.map(lambda x: F.forall(_present(x), lambda e: e))

    def drop_nulls(self):
        return self.e.map(F.array_compact)

    def count_matches(self, value):
        return self.e.map(lambda x, v: F.when(x.isNotNull(), F.size(F.filter(x, lambda e: e.eqNullSafe(v)))), value)

    def get(self, index: int):
        """From 0, or from the end if negative; null outside the list."""
        return self.e.map(lambda x: F.get(x, F.lit(index)) if index >= 0 else F.get(x, F.size(x) + index))

    def first(self):
        return self.get(0)

    def last(self):
        return self.get(-1)

    def gather(self, indices, null_on_oob: bool = False):
        """Elements at a list of indices; one outside the list raises unless null_on_oob."""

        def build(x: Column, ix: Column) -> Column:
            place = lambda i: F.when(i < 0, F.size(x) + i).otherwise(i).cast("int")
            if null_on_oob:
                return F.transform(ix, lambda i: F.get(x, place(i)))
            return F.transform(ix, lambda i: F.element_at(x, F.when(i < 0, i).otherwise(i + 1).cast("int")))

        given = lit(indices) if isinstance(indices, Expr) else Expr(lambda p: F.array(*[F.lit(i) for i in indices]), "indices")
        return self.e.map(build, given)

    def gather_every(self, n: int, offset: int = 0):
        return self.e.map(lambda x: F.filter(x, lambda e, i: (i >= offset) & ((i - offset) % n == 0)))

    def slice(self, offset: int, length: int | None = None):
        def build(x: Column) -> Column:
            begin = F.lit(offset) if offset >= 0 else F.size(x) + offset
            return _slice(x, begin, begin + length if length is not None else F.size(x))

        return self.e.map(build)

    def head(self, n: int = 5):
        return self.slice(0, n)

    def tail(self, n: int = 5):
        return self.e.map(lambda x: _slice(x, F.size(x) - n, F.size(x)))

    def join(self, separator: str, ignore_nulls: bool = False):
        """A null element makes the whole null unless nulls are ignored."""
        joined = lambda x: F.array_join(x, separator)
        return self.e.map(lambda x: joined(x) if ignore_nulls else F.when(~F.exists(x, lambda e: e.isNull()), joined(x)))

    def shift(self, n: int = 1):
        return self.e.map(lambda x: F.transform(x, lambda e, i: F.when(i - n >= 0, F.get(x, i - n))))

    def diff(self, n: int = 1, drop: bool = False):
        def build(x: Column) -> Column:
            out = F.transform(x, lambda e, i: e - F.when(i - n >= 0, F.get(x, i - n)))
            return _slice(out, F.lit(max(n, 0)), F.size(x) + min(n, 0)) if drop else out

        return self.e.map(build)

    def sample_n(self, n: int, seed: int | None = None, shuffle: bool = False, with_replacement: bool = False):
        """n elements (all, if fewer), in the list's order unless shuffled."""
        return self._sample(lambda size: F.least(size, F.lit(n)) if not with_replacement else F.lit(n), seed, shuffle, with_replacement)

    def sample_fraction(self, fraction: float, seed: int | None = None, shuffle: bool = False, with_replacement: bool = False):
        return self._sample(lambda size: F.floor(size * F.lit(fraction)).cast("int"), seed, shuffle, with_replacement)

    def _sample(self, many, seed, shuffle, with_replacement):
        seed = 0 if seed is None else seed

        def build(x: Column) -> Column:
            n = F.size(x)
            if with_replacement:
                return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(many(n), F.lit(1))), lambda i: F.get(x, F.pmod(F.xxhash64(x, i, F.lit(seed)), n).cast("int")))).otherwise(x)
            keys = F.transform(x, lambda e, i: F.struct(F.xxhash64(F.lit(seed), i, x).alias("k"), i.alias("i"), e.alias("e")))
            picked = F.slice(F.array_sort(keys), F.lit(1), many(n))
            picked = picked if shuffle else F.array_sort(F.transform(picked, lambda s: F.struct(s["i"].alias("i"), s["e"].alias("e"))))
            return F.transform(picked, lambda s: s["e"])

        return self.e.map(build)

    def union(self, other):
        return self.e.map(F.array_union, other)

    def set_intersection(self, other):
        return self.e.map(F.array_intersect, other)

    def set_difference(self, other):
        return self.e.map(F.array_except, other)

    def set_symmetric_difference(self, other):
        return self.e.map(lambda x, y: F.array_union(F.array_except(x, y), F.array_except(y, x)), other)


class _Inside(Place):
    """A place within a list, where element() is known and types are the element's."""

    def __init__(self, p: Place, e: Column, kind: T.DataType):
        super().__init__(**{k: v for k, v in replace(p, mode="row").__dict__.items() if k in Place.__dataclass_fields__})
        self.element, self._element_kind = e, kind

    def kind(self, c: Column) -> T.DataType:
        return self._element_kind


class _Whole(Place):
    """A place over a list, where expressions that reduce are the list functions of their names."""

    def __init__(self, p: Place, x: Column):
        super().__init__(p.df, p.order, "list", p.partition, p.scalars)
        self.outer, self.values = replace(p, mode="row"), x

    def reduced(self, name: str, source: Expr, args: tuple, named: dict) -> Column:
        inside = lambda e: _Inside(self.outer, e, self.kind(self.values).elementType)
        kept = self.values if source.pred is None else F.filter(self.values, lambda e: source.pred.build(inside(e)))
        values = Lists(Expr(lambda p: F.transform(kept, lambda e: source.build(inside(e))), source.name))
        if name in ("count", "null_count"):
            some = values.drop_nulls().list.len().build(self.outer)
            return some if name == "count" else values.len().build(self.outer) - some
        if not hasattr(values, name):
            raise EngineError("INVALID", f"lists have no {name}")
        return getattr(values, name)(*args, **named).build(self.outer)
