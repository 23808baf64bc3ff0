"""Frames: relational verbs over a Spark DataFrame and, for verbs that need one, an explicit order of rows."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.errors import EngineError, OrderError
from tallyframe.functions import dtypes
from tallyframe.functions.expr import Expr, Place, ValueCounts, col, lit, order_key, rising

JOINS = ("inner", "left", "right", "full", "semi", "anti", "cross")
SAMPLED_AT_ONCE = 100_000  # rows that one sort may hold
BUCKETS = 4096
TRIED_ROWS = 100  # rows that a schema is found from
MOST_PIVOTED = 10_000  # columns that a pivot finds by itself
_SPARK_JOIN = {"semi": "left_semi", "anti": "left_anti"}
PIVOT_AGGREGATES = ("first", "last", "sum", "min", "max", "mean", "median", "count", "len")


def _exprs(df: DataFrame, exprs: Sequence[Expr | str]) -> list[Expr]:
    out: list[Expr] = []
    for e in exprs:
        e = col(e) if isinstance(e, str) else lit(e)
        out += e.expand(df) if e.expand else [e]
    if not out:
        raise EngineError("INVALID", "no expressions")
    return out


def _flags(x: bool | Sequence[bool], n: int) -> list[bool]:
    x = [x] if isinstance(x, bool) else [*x]
    return (x + [False] * n)[:n] if len(x) != 1 or n == 1 else x * n


class Frame:
    """A DataFrame with an optional order: (column, descending, nulls_last) keys, which should be unique together. Each verb returns a new frame."""

    def __init__(self, df: DataFrame, order: Sequence[tuple[str, bool, bool]] = ()):
        self.df, self.order = df, [k for k in order if k[0] in df.columns]
        self.kept: DataFrame | None = None  # rows kept for this frame, which free gives up

    # The order of rows
    def ordered(self, *by: str, descending: bool | Sequence[bool] = False, nulls_last: bool | Sequence[bool] = False) -> Frame:
        """The same rows, with these columns as their order for the verbs that need one."""
        self._known(by)
        return Frame(self.df, [*zip(by, _flags(descending, len(by)), _flags(nulls_last, len(by)), strict=True)])

    def _keys(self, reverse: bool = False) -> list[Column]:
        return [order_key(F.col(f"`{c}`"), d != reverse, n != reverse) for c, d, n in self.order]

    def _window(self, what: str, *partition: str | Column, reverse: bool = False) -> Window:
        if not self.order:
            raise OrderError(what)
        return Window.partitionBy(*partition).orderBy(*self._keys(reverse))

    def _rising(self) -> Column:
        """One value that rises in the order of rows."""
        return F.struct(*[rising(F.col(f"`{c}`"), self.df.schema[c].dataType, d, n) for c, d, n in self.order])

    def _place(self, **more: Any) -> Place:
        return Place(self.df, self._keys(), **more)

    def _known(self, names: Sequence[str]) -> None:
        if missing := [n for n in names if n not in self.df.columns]:
            raise EngineError("NOT_FOUND", f"no column {', '.join(missing)}; there are {', '.join(self.df.columns)}")

    def _with(self, df: DataFrame) -> Frame:
        return Frame(df, self.order)

    @property
    def columns(self) -> list[str]:
        return self.df.columns

    # Projection
    def select(self, *exprs: Expr | str) -> Frame:
        """Columns from the input's rows; aggregates alone give one row, beside others they are repeated."""
        found = _exprs(self.df, exprs)
        if all(e.reduces for e in found):
            place = self._place(mode="group")
            return Frame(self.df.agg(*[e.build(place).alias(e.name) for e in found]))
        if any(e.shortens for e in found):
            if len(found) > 1:
                raise EngineError("INVALID", "an expression that drops rows stands alone")
            place = self._place()
            rows = self.df.select("*", found[0].build(place).alias("_value"), found[0].shortens(place).alias("_kept"))
            return Frame(rows.filter("_kept").select(F.col("_value").alias(found[0].name)))
        return self._with(self._projected(found, []))

    def with_columns(self, *exprs: Expr | str, **named: Expr | Any) -> Frame:
        """All expressions see the input's columns."""
        found = _exprs(self.df, exprs) if exprs else []
        found += [lit(e).alias(n) for n, e in named.items()]
        new = {e.name: e for e in found}
        return self._with(self._projected([new.pop(c, col(c)) for c in self.df.columns] + [e for e in found if e.name in new], []))

    def _projected(self, found: list[Expr], keep: list[str]) -> DataFrame:
        if not any(e.reduces for e in found):
            place = self._place()
            return self.df.select(*keep, *[e.build(place).alias(e.name) for e in found])
        # Aggregates beside rows: one row for the frame, sent to all of them.
        place = self._place(mode="scalar")
        columns = [e.build(place).alias(e.name) for e in found]
        one = self.df.agg(*[c.alias(f"_scalar{i}") for i, c in enumerate(place.scalars)])
        return self.df.join(F.broadcast(one), how="cross").select(*keep, *columns)

    def filter(self, predicate: Expr) -> Frame:
        """Rows for which predicate is true."""
        if predicate.reduces:
            return self._with(self._projected([*[col(c) for c in self.columns], predicate.alias("_kept")], []).filter("_kept").drop("_kept"))
        return self._with(self.df.filter(predicate.build(self._place())))

    def drop(self, *names: str) -> Frame:
        self._known(names)
        return self._with(self.df.drop(*names))

    def rename(self, mapping: Mapping[str, str], strict: bool = True) -> Frame:
        """All at once, so names may be swapped."""
        if strict:
            self._known([*mapping])
        new = [mapping.get(c, c) for c in self.columns]
        if len({*new}) < len(new):
            raise EngineError("INVALID", "two columns would have one name")
        return Frame(self.df.toDF(*new), [(mapping.get(c, c), d, n) for c, d, n in self.order])

    def unnest(self, *names: str) -> Frame:
        """Fields of structs in their structs' places."""
        self._known(names)
        parts = []
        for f in self.df.schema:
            parts += [F.col(f"`{f.name}`.`{x}`").alias(x) for x in f.dataType.names] if f.name in names else [F.col(f"`{f.name}`")]
        return self._with(self.df.select(*parts))

    def explode(self, *names: str) -> Frame:
        """A row for each element: none for an empty list, one for a null list; several lists go together and must be of one length."""
        self._known(names)
        if len(names) == 1:
            c = F.col(f"`{names[0]}`")
            rows = self.df.filter(c.isNull() | (F.size(c) > 0))
            return self._with(rows.select(*[F.explode_outer(c).alias(x) if x == names[0] else F.col(f"`{x}`") for x in self.columns]))
        sizes = [F.size(F.col(f"`{n}`")) for n in names]
        same = reduce(lambda a, b: a & b, [s.eqNullSafe(sizes[0]) for s in sizes[1:]])
        zipped = F.when(same, F.arrays_zip(*[F.col(f"`{n}`") for n in names])).otherwise(F.raise_error(F.lit("lists to explode differ in length")))
        rows = self.df.filter(sizes[0].isNull() | (sizes[0] > 0)).withColumn("_z", F.explode_outer(zipped))
        return self._with(rows.select(*[F.col(f"_z.`{x}`").alias(x) if x in names else F.col(f"`{x}`") for x in self.columns]))

    def over_exploded(self, partition: str, *exprs: Expr | str) -> Frame:
        """Expressions over partitions with rows laid out partition by partition, in the order of their first rows: adds _row, a key that rises so and is the frame's order."""
        if not self.order:
            raise OrderError("over_exploded")
        own = self._rising()
        at = F.struct(F.min(own).over(Window.partitionBy(partition)).alias("first"), own.alias("own"))
        found = [e.over(partition, order_by=[c for c, _, _ in self.order]) if e.reduces else e for e in _exprs(self.df, exprs)]
        rows = self.df.select(*[e.build(self._place()).alias(e.name) for e in found], at.alias("_row"))
        return Frame(rows, [("_row", False, False)])

    # Rows
    def limit(self, n: int) -> Frame:
        """n rows, the first by the order if there is one."""
        return self.slice(0, n) if self.order else self._with(self.df.limit(n))

    def head(self, n: int = 5) -> Frame:
        return self.limit(n)

    def tail(self, n: int = 5) -> Frame:
        if not self.order:
            raise OrderError("tail")
        return self.slice(-n) if n else self.limit(0)

    def slice(self, offset: int, length: int | None = None) -> Frame:
        """From an offset, which counts from the end if negative. A slice that reaches further than one sort may hold is cut from ranges of rows."""
        if not self.order:
            raise OrderError("slice")
        reach = -offset if offset < 0 else None if length is None else offset + length
        if reach is None or reach > SAMPLED_AT_ONCE:
            return self._cut(offset, length)
        if offset >= 0:
            return self._with(self.df.orderBy(*self._keys()).offset(offset).limit(length))
        last = self.df.orderBy(*self._keys(reverse=True)).limit(-offset)
        if length is None or length >= -offset:
            return self._with(last)
        # Where the frame is shorter than the offset, the part before its start is cut off.
        missing = -offset - last.count()
        return self._with(last.orderBy(*self._keys()).limit(max(0, length - missing)))

    def _cut(self, offset: int, length: int | None) -> Frame:
        """A slice by row numbers. The sorted rows are kept on disk, as a second sort might divide them into other ranges; free gives the room back."""
        kept = self.df.orderBy(*self._keys()).persist(StorageLevel.DISK_ONLY)
        start = offset if offset >= 0 else offset + kept.count()
        rows = Frame(kept)._numbered().filter(F.col("_at") >= start)
        if length is not None:
            rows = rows.filter(F.col("_at") < start + length)
        out = self._with(rows.select(*[F.col(f"`{c}`") for c in self.columns]))
        out.kept = kept
        return out

    def reverse(self) -> Frame:
        if not self.order:
            raise OrderError("reverse")
        return Frame(self.df, [(c, not d, not n) for c, d, n in self.order])

    def sort(self, *by: Expr | str, descending: bool | Sequence[bool] = False, nulls_last: bool | Sequence[bool] = False) -> Frame:
        """Nulls come first in both directions unless nulls_last; missing flags are false."""
        found, d, n = _exprs(self.df, by), _flags(descending, len(by)), _flags(nulls_last, len(by))
        rows = self.df.orderBy(*[order_key(e.build(self._place()), x, y) for e, x, y in zip(found, d, n, strict=True)])
        named = all(isinstance(b, str) for b in by)
        return Frame(rows, [*zip(by, d, n, strict=True)] if named else [])

    def drop_nulls(self, *subset: str) -> Frame:
        """NaN stays."""
        self._known(subset)
        return self._with(self.df.filter(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in subset or self.columns])))

    def _floats(self, subset: Sequence[str] = ()) -> list[str]:
        return [f.name for f in self.df.schema if dtypes.is_float(f.dataType) and (not subset or f.name in subset)]

    def drop_nans(self, *subset: str) -> Frame:
        """Nulls stay."""
        self._known(subset)
        tests = [~F.isnan(F.col(f"`{c}`")) | F.col(f"`{c}`").isNull() for c in self._floats(subset)]
        return self._with(self.df.filter(reduce(lambda a, b: a & b, tests)) if tests else self.df)

    def fill_null(self, value: Any) -> Frame:
        """All columns that can hold the value."""
        kind = self.df.select(F.lit(value)).schema[0].dataType
        numbers = isinstance(kind, T.NumericType)
        fits = lambda f: f.dataType == kind or (numbers and isinstance(f.dataType, T.NumericType))
        return self._with(self.df.select(*[F.coalesce(F.col(f"`{f.name}`"), F.lit(value)).alias(f.name) if fits(f) else F.col(f"`{f.name}`") for f in self.df.schema]))

    def fill_nan(self, value: float) -> Frame:
        floats = self._floats()
        return self.with_columns(*[col(c).fill_nan(value) for c in floats]) if floats else self

    def ffill(self, limit: int | None = None, over: Sequence[str] = ()) -> Frame:
        """Nulls take the value before them, at most limit in a row; within the partitions of over, if given."""
        return self._filled(False, limit, over)

    def bfill(self, limit: int | None = None, over: Sequence[str] = ()) -> Frame:
        return self._filled(True, limit, over)

    def _filled(self, back: bool, limit: int | None, over: Sequence[str]) -> Frame:
        """Without over, ranges of the sorted rows are filled each by itself and from the last values before it, one row a range; the sorted rows are kept on disk until free."""
        self._known(over)
        if over:
            return self.with_columns(*[(col(c).bfill(limit) if back else col(c).ffill(limit)).over(*over) for c in self.columns if c not in over])
        if not self.order:
            raise OrderError("bfill" if back else "ffill")
        kept = self.df.orderBy(*self._keys(reverse=back)).persist(StorageLevel.DISK_ONLY)
        rows = Frame(kept)._numbered()
        seen = [F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.col("_at").alias("at"), F.col(f"`{c}`").alias("x"))) for c in self.columns]
        ends = rows.groupBy("_p").agg(*[F.max_by(x, x["at"]).alias(f"_e{i}") for i, x in enumerate(seen)])
        before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select("_p", *[F.last(f"_e{i}", ignorenulls=True).over(before).alias(f"_e{i}") for i in range(len(seen))])
        within = Window.partitionBy("_p").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        last = [F.coalesce(F.last(x, ignorenulls=True).over(within), F.col(f"_e{i}")) for i, x in enumerate(seen)]
        near = [x["x"] if limit is None else F.when(F.col("_at") - x["at"] <= limit, x["x"]) for x in last]
        out = self._with(rows.join(ends, "_p").select(*[x.alias(c) for c, x in zip(self.columns, near, strict=True)]))
        out.kept = kept
        return out

    def unique(self, *subset: str, keep: str = "any") -> Frame:
        """keep: any, first, last (by the order), none (rows that are alone)."""
        self._known(subset)
        if keep not in ("any", "first", "last", "none"):
            raise EngineError("INVALID", f"unknown keep {keep!r}")
        names = [*(subset or self.columns)]
        if keep == "any":
            return self._with(self.df.dropDuplicates(names))
        by = [F.col(f"`{c}`") for c in names]
        rank = F.count(F.lit(1)).over(Window.partitionBy(*by)) if keep == "none" else F.row_number().over(self._window("unique", *by, reverse=keep == "last"))
        return self._with(self.df.withColumn("_n", rank).filter("_n = 1").drop("_n"))

    def sample_n(self, n: int, seed: int | None = None, with_replacement: bool = False) -> Frame:
        """n whole rows."""
        if with_replacement:
            total = self.df.count()
            if not total:
                return self
            # Draws of row numbers, counted, then joined: rows come as often as they were drawn.
            draws = self.df.sparkSession.range(n).select(F.floor(F.rand(seed) * total).cast("long").alias("_at")).groupBy("_at").count()
            return self._with(self._numbered().join(draws, "_at").withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("count")))).select(*self.columns))
        drawn = self.df.withColumn("_r", F.rand(random.randrange(1 << 31) if seed is None else seed))
        if n > SAMPLED_AT_ONCE:
            # All rows below a bucket of the random numbers, and of that bucket alone the lowest.
            drawn = drawn.withColumn("_b", F.floor(F.col("_r") * BUCKETS))
            below = 0
            for at, many in sorted(drawn.groupBy("_b").count().collect()):
                if below + many >= n:
                    break
                below += many
            else:
                return self
            few = drawn.filter(F.col("_b") == at).orderBy("_r").limit(n - below)
            return self._with(drawn.filter(F.col("_b") < at).unionAll(few).drop("_r", "_b"))
        return self._with(drawn.orderBy("_r").limit(n).drop("_r"))

    def sample_frac(self, fraction: float, seed: int | None = None, with_replacement: bool = False) -> Frame:
        """round(fraction * rows) whole rows."""
        return self.sample_n(round(self.df.count() * fraction), seed, with_replacement)

    def _numbered(self) -> DataFrame:
        """Rows with their partition in _p and a number from 0 in _at, without a window over the frame."""
        part = self.df.withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()})
        sizes = {r["_p"]: r["count"] for r in part.groupBy("_p").count().collect()}
        starts, at = [], 0
        for p in sorted(sizes):
            starts.append((p, at))
            at += sizes[p]
        lookup = self.df.sparkSession.createDataFrame(starts, "_p int, _s long")
        return part.join(F.broadcast(lookup), "_p").withColumn("_at", F.col("_s") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m", "_s")

    # Groups
    def group_by(self, *keys: Expr | str) -> Groups:
        return Groups(self, _exprs(self.df, keys))

    def value_counts(self, counts: ValueCounts) -> Frame:
        """Each value of an expression and its count, or its part of all."""
        e = counts.expr
        rows = self.df.select(e.build(self._place()).alias(e.name)).groupBy(e.name).agg(F.count(F.lit(1)).alias(counts.name))
        if counts.normalize:
            rows = Frame(rows).with_columns(col(counts.name).map(lambda x: x.cast("double")) / col(counts.name).sum().map(lambda x: x.cast("double"))).df
        return Frame(rows, [(counts.name, True, True), (e.name, False, False)] if counts.sort else [])

    # Joins
    def join(self, other: Frame, on: str | Expr | Sequence[str | Expr] | None = None, left_on=None, right_on=None, how: str = "inner", suffix: str = "_right") -> Frame:
        """Rows with equal keys; null keys match nothing. Right columns whose names the left has get the suffix.

        Keys of one name come once, from the left (inner, left), from the right (right), or both with
        the suffix (full). semi and anti give left columns only; anti keeps rows with null keys.
        """
        many = lambda x: [] if x is None else [x] if isinstance(x, (str, Expr)) else [*x]
        if how not in JOINS:
            raise EngineError("INVALID", f"unknown join {how!r}")
        if on is not None and (left_on is not None or right_on is not None):
            raise EngineError("INVALID", "on excludes left_on and right_on")
        left, right = [many(on) or many(x) for x in (left_on, right_on)]
        if how == "cross" and (left or right):
            raise EngineError("INVALID", "a cross join has no keys")
        if how != "cross" and (not left or len(left) != len(right)):
            raise EngineError("INVALID", "a join needs as many left keys as right keys")
        left, right = [col(x) for x in left], [col(x) for x in right]
        place, their = self._place(), other._place()
        a = self.df.withColumns({f"_l{i}": e.build(place) for i, e in enumerate(left)}) if left else self.df
        # The right side's columns get names of their own first, so that none is ambiguous.
        b = other.df.select(*[F.col(f"`{c}`").alias(f"_r_{c}") for c in other.columns], *[e.build(their).alias(f"_k{i}") for i, e in enumerate(right)])
        if how == "cross":
            joined = a.crossJoin(b)
        else:
            joined = a.join(b, reduce(lambda x, y: x & y, [F.col(f"_l{i}") == F.col(f"_k{i}") for i in range(len(left))]), _SPARK_JOIN.get(how, how))
        if how in _SPARK_JOIN:
            return self._with(joined.select(*[F.col(f"`{c}`") for c in self.columns]))
        shared = {r.name: l.name for l, r in zip(left, right, strict=True) if r.name in other.columns and l.name in self.columns}
        out = []
        for c in self.columns:
            from_right = next((r for r, l in shared.items() if l == c), None) if how == "right" else None
            out.append(F.col(f"`_r_{from_right}`").alias(c) if from_right else F.col(f"`{c}`"))
        for c in other.columns:
            if c in shared and how != "full":
                continue
            out.append(F.col(f"`_r_{c}`").alias(c + suffix if c in self.columns else c))
        return Frame(joined.select(*out), self.order if how in ("inner", "left") else [])

    # Reshaping
    def unpivot(self, on: Sequence[str] = (), index: Sequence[str] = (), variable_name: str = "variable", value_name: str = "value") -> Frame:
        """A row for each of the columns on (all but index, if none are named); mixed types become strings, mixed numbers doubles."""
        index = [*index]
        on = [*on] or [c for c in self.columns if c not in index]
        self._known([*index, *on])
        kinds = {self.df.schema[c].dataType for c in on}
        rows = self.df
        if len(kinds) > 1:
            to = T.DoubleType() if all(isinstance(k, T.NumericType) for k in kinds) else T.StringType()
            rows = rows.withColumns({c: F.col(f"`{c}`").cast(to) for c in on})
        return Frame(rows.unpivot(index, on, variable_name, value_name))

    melt = unpivot

    def pivot(self, on: str | Sequence[str], index: str | Sequence[str], values: str | Sequence[str], aggregate: str = "first", on_columns: Sequence[Any] | None = None, separator: str = "_") -> Frame:
        """A column for each value of on: those given, or those found in the order of their first rows (which needs an order, else of the values). Several on columns are joined by the separator; with several values columns the names are value_on."""
        many = lambda x: [x] if isinstance(x, str) else [*x]
        on, index, values = many(on), many(index), many(values)
        self._known([*on, *index, *values])
        if aggregate not in PIVOT_AGGREGATES:
            raise EngineError("INVALID", f"unknown aggregate {aggregate!r}")
        key = F.concat_ws(separator, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in on]) if len(on) > 1 else F.col(f"`{on[0]}`")
        rows = self.df.withColumn("_on", key)
        if on_columns is None:
            seen = rows.groupBy("_on").agg(F.min(self._rising() if self.order else F.col("_on")).alias("_first"))
            # As many columns as a frame can have, which is checked before they are named.
            found = [r["_on"] for r in seen.orderBy("_first", "_on").limit(MOST_PIVOTED + 1).collect()]
            if len(found) > MOST_PIVOTED:
                raise EngineError("INVALID", f"more than {MOST_PIVOTED} values to make columns of; name those wanted in on_columns")
        else:
            found = [separator.join(str(x) for x in (v.values() if isinstance(v, Mapping) else v)) if len(on) > 1 else v for v in on_columns]
        out = []
        for v in values:
            for x in found:
                value = Expr(lambda p, v=v: F.col(f"`{v}`"), v).filter(Expr(lambda p, x=x: F.col("_on").eqNullSafe(F.lit(x)), "on"))
                agg = getattr(value, aggregate)().build(Place(rows, self._keys(), "group"))
                out.append(agg.alias(f"{v}{separator}{x}" if len(values) > 1 else str(x) if x is not None else "null"))
        return Frame(rows.groupBy(*index).agg(*out), [(c, False, False) for c in index])

    @staticmethod
    def concat(frames: Sequence[Frame], diagonal: bool = False, to_supertypes: bool = False) -> Frame:
        """Rows of all frames. Columns must be the same, in names and types; diagonal takes all columns, to_supertypes widens types."""
        if not frames:
            raise EngineError("INVALID", "nothing to concatenate")
        first = frames[0].df
        for f in frames[1:]:
            if not diagonal and f.columns != first.columns:
                raise EngineError("INVALID", "columns differ; use diagonal")
            if not to_supertypes and any(first.schema[c].dataType != f.df.schema[c].dataType for c in f.columns if c in first.columns):
                raise EngineError("INVALID", "types differ; use to_supertypes")
        return Frame(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=diagonal), [f.df for f in frames]))

    # Summaries
    def describe(self) -> Frame:
        """count, null_count, mean, std (of the population), min, max of each column, as strings; means and deviations of numbers only."""
        stats = {
            "count": lambda c, num: F.count(c),
            "null_count": lambda c, num: F.count_if(c.isNull()),
            "mean": lambda c, num: F.avg(c) if num else F.lit(None),
            "std": lambda c, num: F.stddev_pop(c) if num else F.lit(None),
            "min": lambda c, num: F.min(c),
            "max": lambda c, num: F.max(c),
        }
        fields = [f for f in self.df.schema if isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType, T.TimestampType))]
        number = lambda f: isinstance(f.dataType, T.NumericType)
        one = self.df.agg(*[s(F.col(f"`{f.name}`"), number(f)).cast("string").alias(f"{k}|{f.name}") for k, s in stats.items() for f in fields])
        rows = F.array(*[F.struct(F.lit(k).alias("statistic"), *[F.col(f"`{k}|{f.name}`").alias(f.name) for f in fields]) for k in stats])
        return Frame(one.select(F.inline(rows)))

    def explain(self, optimized: bool = True) -> str:
        plan = self.df._jdf.queryExecution()
        return plan.optimizedPlan().toString() if optimized else plan.logical().toString()

    # User functions
    def map_rows(self, fn: Callable[[dict], dict], schema: T.StructType | str | None = None) -> Frame:
        """fn of each row as a dict, which gives a row of the schema; in Arrow batches. Without a schema it is found from the first rows, which fn sees twice then."""
        if schema is None:
            tried = [fn(r.asDict(True)) for r in self.df.limit(TRIED_ROWS).collect()]
            if not tried or None in tried:
                raise EngineError("INVALID", "no rows to find a schema from")
            schema = self.df.sparkSession.createDataFrame(tried).schema
        kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema

            target = to_arrow_schema(kind)
            for b in batches:
                rows = []
                for i, row in enumerate(b.to_pylist()):
                    new = fn(row)
                    if new is None:
                        raise ValueError(f"row {i} of a batch: the function gave nothing")
                    rows.append(new)
                yield pa.RecordBatch.from_pylist(rows, schema=target)

        return Frame(self.df.mapInArrow(run, kind))

    def map_batches(self, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str) -> Frame:
        """fn of each Arrow batch: for functions that don't look beyond a batch."""
        return Frame(self.df.mapInArrow(lambda batches: (fn(b) for b in batches), schema))

    def map_whole(self, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str, most_rows: int = 1_000_000) -> Frame:
        """fn of the whole frame as one batch, in one task: for frames of at most most_rows, which is checked."""
        if self.df.limit(most_rows + 1).count() > most_rows:
            raise EngineError("OOM", f"more than {most_rows} rows for one batch")

        def run(batches):
            yield fn(_one(batches))

        return Frame(self.df.coalesce(1).mapInArrow(run, schema))

    def lazy(self) -> Frame:
        return self

    def collect(self) -> Frame:
        """The frame's rows, kept for further use; free gives the room back."""
        self.df.persist()
        return self

    def free(self) -> None:
        self.df.unpersist()
        if self.kept is not None:
            self.kept.unpersist()


def _one(batches) -> pa.RecordBatch:
    got = pa.Table.from_batches([*batches]).combine_chunks()
    return pa.RecordBatch.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in got.columns], got.schema.names)


class Groups:
    def __init__(self, frame: Frame, keys: list[Expr]):
        self.frame, self.keys = frame, keys

    def agg(self, *aggs: Expr | str) -> Frame:
        """Aggregates of each group, null keys being one; what doesn't reduce becomes a list."""
        f = self.frame
        place = f._place(mode="group")
        named = [k.build(f._place()).alias(k.name) for k in self.keys]
        found = [e if e.reduces else e.imploded() for e in _exprs(f.df.drop(*[k.name for k in self.keys]), aggs)]
        return Frame(f.df.groupBy(*named).agg(*[e.build(place).alias(e.name) for e in found]))
