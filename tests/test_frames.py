"""Verbs and expressions on small literal frames with known results."""

import datetime

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tallyframe.errors import EngineError, OrderError, ValidationError
from tallyframe.functions.expr import all_columns, col, lit, struct, when
from tallyframe.functions.lists import concat_list, element
from tallyframe.functions.udf import map_batches
from tallyframe.operators.frame import Frame
from tallyframe.plans.sql import SQLContext, sql
from tallyframe.sources import readers, rows, writers

STAFF = [("Alice", 25, 50000, "Engineering"), ("Bob", 30, 60000, "Marketing"), ("Charlie", 35, 70000, "Engineering"), ("Diana", 28, 55000, "Sales"), ("Eve", 32, 65000, "Engineering"), ("Frank", 29, 58000, "Marketing"), ("Grace", 27, 52000, "Sales")]


@pytest.fixture(scope="module")
def staff(spark):
    found = [dict(zip(("name", "age", "salary", "department"), r, strict=True)) | {"i": i} for i, r in enumerate(STAFF)]
    return rows.from_rows(spark, found).ordered("i")


def maps(frame, *by):
    found = writers.to_maps(frame)
    return sorted(found, key=lambda r: [str(r[b]) for b in by]) if by else found


def one(frame, *by):
    return [tuple(r.values()) for r in maps(frame, *by)]


def values(spark, exprs, **columns):
    return one(rows.from_columns(spark, columns).select(*exprs))


def test_aggregates(staff):
    s = col("salary")
    got = staff.group_by("department").agg(s.sum().alias("s"), s.count().alias("n"), col("age").max().alias("a"), s.median().alias("m"), s.n_unique().alias("u"), s.quantile(0.25, "nearest").alias("q"))
    assert one(got, "department")[0] == ("Engineering", 185000, 3, 35, 65000.0, 3, 65000.0)


def test_first_last_need_an_order(staff):
    got = staff.group_by("department").agg(col("name").first().alias("f"), col("name").last().alias("l"))
    assert one(got, "department") == [("Engineering", "Alice", "Eve"), ("Marketing", "Bob", "Frank"), ("Sales", "Diana", "Grace")]
    with pytest.raises(OrderError):
        Frame(staff.df).group_by("department").agg(col("name").first())


def test_first_last_under_keys_of_several_directions(spark):
    data = {"s": ["a", "ab", None, "b", "ab"], "f": [1.0, float("nan"), 2.0, None, float("nan")], "b": [True, None, False, True, True], "i": [-(2**63), 5, 2**63 - 1, None, 4], "id": range(5)}
    frame = rows.from_columns(spark, data)
    for key in ("s", "f", "b", "i"):
        for descending in (False, True):
            for nulls_last in (False, True):
                laid = frame.ordered(key, "id", descending=[descending, not descending], nulls_last=[nulls_last, False])
                inner = [r[0] for r in laid.df.orderBy(*laid._keys()).select("id").collect()]
                got = one(laid.select(col("id").first().alias("first"), col("id").last().alias("last")))
                assert got == [(inner[0], inner[-1])], (key, descending, nulls_last)


def test_replace_n_sees_whole_texts(spark):
    x = col("x").str
    got = values(spark, [x.replace_n("a(?=b)", "_", 2).alias("ahead"), x.replace_n(r"(.)\1", "<$1$0>", 2).alias("back"), x.replace(r"(.)\1", "<$1>").alias("once"), x.replace_n("q", "", 3).alias("none"), x.replace_n("(?<l>a)", "$1.", 9).alias("all")], x=["abacabaab", "", None, "xx\nyy zz"])
    assert got[0] == ("_bac_baab", "abacab<aaa>b", "abacab<a>b", "abacabaab", "a.ba.ca.ba.a.b")
    assert got[1] == ("",) * 5 and got[2] == (None,) * 5
    assert got[3] == ("xx\nyy zz", "<xxx>\n<yyy> zz", "<x>\nyy zz", "xx\nyy zz", "xx\nyy zz")
    with pytest.raises(EngineError):
        x.replace_n("a*", "_", 2)


def test_lists_reduced_by_expressions(spark):
    frame = rows.from_columns(spark, {"l": [[1, 2, None, 4], [], None]})
    e = element()
    got = one(frame.select(col("l").list.agg((e * 2).sum() + e.count()).alias("a"), col("l").list.agg(e.filter(e > 1).len()).alias("b"), col("l").list.agg(e.null_count()).alias("c")))
    assert got[0] == (17, 2, 1) and got[1] == (0, 0, 0)
    with pytest.raises(EngineError):
        col("l").list.agg(e + 1)
    with pytest.raises(EngineError):
        maps(frame.select(col("l").list.agg(e.quantile(0.5)).alias("a")))


def test_lines_skipped_in_each_file(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text("junk\n" * 3 + "a,b\n" + "".join(f"{i},{j}\n" for j in range(i * 50)))
    frame = readers.scan_csv(spark, str(tmp_path), skip_rows=3)
    assert sorted(one(frame)) == [(i, j) for i in range(5) for j in range(i * 50)]
    assert readers.scan_csv(spark, str(tmp_path), skip_rows=3, infer_rows=10).df.schema["b"].dataType.simpleString() == "bigint"


def test_pivots_and_rows_of_unknown_shape(spark, monkeypatch):
    frame = rows.from_columns(spark, {"g": [1, 1, 2], "on": ["x", "y", "z"], "v": [1, 2, 3]})
    monkeypatch.setattr("tallyframe.operators.frame.MOST_PIVOTED", 2)
    with pytest.raises(EngineError):
        frame.pivot("on", "g", "v")
    assert one(frame.map_rows(lambda r: {"w": r["v"] * 1.5})) == [(1.5,), (3.0,), (4.5,)]
    with pytest.raises(EngineError):
        frame.map_rows(lambda r: None)


def test_filter_and_sort_by_in_groups(staff):
    got = staff.group_by("department").agg(col("name").filter(col("age") > 30).alias("old"), col("name").sort_by(col("age"), descending=True).alias("by_age"))
    assert one(got, "department") == [("Engineering", ["Charlie", "Eve"], ["Charlie", "Eve", "Alice"]), ("Marketing", [], ["Bob", "Frank"]), ("Sales", [], ["Diana", "Grace"])]


def test_empty_sums_and_nan_extremes(spark):
    nan = float("nan")
    frame = rows.from_columns(spark, {"g": ["a", "a", "b"], "x": [1.0, nan, nan], "n": [None, None, None]}, overrides={"n": "int64"})
    got = one(frame.group_by("g").agg(col("x").max().alias("x"), col("n").sum().alias("s"), col("n").n_unique().alias("u")), "g")
    assert got[0] == ("a", 1.0, 0, 1) and got[1][1] != got[1][1]


def test_joins(spark, staff):
    engineers = staff.filter(col("department") == "Engineering")
    assert [r[0] for r in one(staff.join(engineers, on="name", how="semi"), "name")] == ["Alice", "Charlie", "Eve"]
    assert [r[0] for r in one(staff.join(engineers, on="name", how="anti"), "name")] == ["Bob", "Diana", "Frank", "Grace"]
    left = rows.from_columns(spark, {"id": [1, 2, None], "v": ["a", "b", "c"]})
    right = rows.from_columns(spark, {"id": [1, 3, None], "v": ["x", "y", "z"]})
    assert one(left.join(right, on="id")) == [(1, "a", "x")]
    assert one(left.join(right, on="id", how="left"), "v") == [(1, "a", "x"), (2, "b", None), (None, "c", None)]
    assert one(left.join(right, on="id", how="right"), "v_right") == [(1, "a", "x"), (3, None, "y"), (None, None, "z")]
    assert one(left.join(right, on="id", how="full"), "v", "v_right") == [(None, None, 3, "y"), (None, None, None, "z"), (1, "a", 1, "x"), (2, "b", None, None), (None, "c", None, None)]
    assert left.join(right, how="cross").columns == ["id", "v", "id_right", "v_right"]
    for bad in ({"how": "cross", "on": "id"}, {}, {"on": "id", "left_on": "v"}, {"how": "outer", "on": "id"}):
        with pytest.raises(EngineError):
            left.join(right, **bad)


def test_windows(staff):
    got = staff.select("name", col("salary").cum_sum().over("department", order_by=["age"]).alias("c"), col("salary").rank(descending=True).over("department").alias("r"), col("salary").sum().over("department", order_by=["age"]).alias("t"))
    assert {r[0]: r[1:] for r in one(got)}["Eve"] == (115000, 2, 185000)
    first = staff.limit(3)
    got = first.select(col("age").shift(1).alias("s"), col("age").diff().alias("d"), col("age").cum_prod().alias("p"), col("name").reverse().alias("r"))
    assert one(got) == [(None, None, 25, "Charlie"), (25, 5, 750, "Bob"), (30, 5, 26250, "Alice")]
    assert one(first.select(col("age").diff(1, drop=True).alias("d"))) == [(5,), (5,)]
    with pytest.raises(OrderError):
        Frame(staff.df).select(col("age").shift(1))


def test_window_mappings(spark):
    frame = rows.from_columns(spark, {"athlete": list("ABCDEF"), "country": ["PT", "NL", "NL", "PT", "PT", "NL"], "rank": [6, 1, 5, 4, 2, 3], "i": range(6)}).ordered("rank")
    lists = {r[0]: r[1] for r in one(frame.select("country", col("rank").over("country", order_by=["rank"], mapping="join").alias("m")))}
    assert lists == {"PT": [2, 4, 6], "NL": [1, 3, 5]}
    laid = maps(frame.over_exploded("country", "athlete"))
    assert [r["athlete"] for r in laid] == ["B", "F", "C", "E", "D", "A"]


def test_rolling_and_duplicates(spark):
    frame = rows.from_columns(spark, {"v": [1, 1, 2, 4], "g": list("aabb"), "i": range(4)}).ordered("i")
    got = one(frame.select(col("v").rolling_sum(2).alias("s"), col("v").rolling_mean(2).alias("m"), col("v").rolling_min(2, 2).alias("lo"), col("g").is_duplicated().alias("d")))
    assert got == [(1, 1.0, None, True), (2, 1.0, 1, True), (3, 1.5, 1, True), (6, 3.0, 2, True)]
    with pytest.raises(EngineError):
        col("v").rolling_sum(0)


def test_rows(spark):
    frame = rows.from_columns(spark, {"id": [1, 2, 3], "age": [10, None, 30], "score": [None, 2.0, float("nan")]}).ordered("id")
    ids = lambda f: [r["id"] for r in maps(f)]
    assert ids(frame.slice(1, 2)) == [2, 3] and ids(frame.head(2)) == [1, 2] and ids(frame.tail(2)) == [2, 3]
    assert ids(frame.slice(-2, 1)) == [2] and ids(frame.slice(-5, 3)) == [1] and ids(frame.reverse()) == [3, 2, 1]
    assert ids(frame.drop_nulls("age")) == [1, 3] and ids(frame.drop_nans()) == [1, 2]
    assert [r["age"] for r in maps(frame.ffill())] == [10, 10, 30]
    assert [r["age"] for r in maps(frame.bfill())] == [10, 30, 30]
    assert [r["age"] for r in maps(frame.fill_null(0))] == [10, 0, 30]
    assert frame.rename({"id": "age", "age": "id"}).columns == ["age", "id", "score"]
    for bad in (lambda: frame.drop("no"), lambda: frame.rename({"no": "x"}), lambda: frame.drop_nulls("no")):
        with pytest.raises(EngineError):
            bad()


def test_far_slices(spark, monkeypatch):
    frame = Frame(spark.range(0, 300, 1, 7).select((F.col("id") * 7 % 300).alias("id"), F.lit("x").alias("_x"))).ordered("id", descending=True)
    want = [*range(299, -1, -1)]
    ids = lambda f: [r["id"] for r in maps(f)]
    spans = [(0, 40), (250, 100), (120, None), (400, 5), (-90, 20), (-400, 150), (-400, 50), (-30, None), (0, 0)]
    got = [sorted(ids(frame.slice(*s))) for s in spans]
    monkeypatch.setattr("tallyframe.operators.frame.SAMPLED_AT_ONCE", 10)
    for (at, n), few in zip(spans, got, strict=True):
        start = at if at >= 0 else at + 300
        full = want[max(start, 0) : max(start + n, 0) if n is not None else None]
        cut = frame.slice(at, n)
        assert sorted(ids(cut)) == few == sorted(full), (at, n)
        cut.free()
    assert sorted(ids(frame.tail(70))) == [*range(70)] and sorted(ids(frame.head(70))) == [*range(230, 300)]
    assert ids(frame.tail(0)) == [] and ids(Frame(frame.df.limit(0)).ordered("id").slice(-20)) == []


def test_fills_across_ranges(spark):
    xs = [None if i % 11 else i for i in range(1, 200)]
    frame = Frame(spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x int").repartition(5)).ordered("i", descending=True)

    def plain(values, limit):
        out, last, far = [], None, 0
        for v in values:
            last, far = (v, 0) if v is not None else (last, far + 1)
            out.append(last if limit is None or far <= limit else None)
        return out

    for limit in (None, 0, 3):
        # The order descends, so that filling forward goes from the end.
        forward = [r["x"] for r in maps(frame.ffill(limit).select("i", "x"))]
        assert forward == plain(xs[::-1], limit)
        assert [r["x"] for r in maps(frame.bfill(limit))] == plain(xs, limit)[::-1]
    with pytest.raises(OrderError):
        Frame(frame.df).ffill()


def test_running_products(spark):
    xs = [-1, 3, None, -1, 1, -5, 2**40, 0, 2**62, 7]
    frame = rows.from_columns(spark, {"i": range(10), "x": xs, "f": [None if x is None else x / 2 for x in xs]}).ordered("i")
    want, floats, at, f = [], [], 1, 1.0
    for x in xs[:7]:
        at, f = (at, f) if x is None else (at * x, f * (x / 2))
        want.append(None if x is None else at)
        floats.append(None if x is None else f)
    got = one(frame.limit(7).select(col("x").cum_prod().alias("x"), col("f").cum_prod().alias("f")))
    assert got == [*zip(want, floats, strict=True)]
    assert [r[0] for r in one(frame.select(col("x").cum_prod().alias("x")))][7:] == [0, 0, 0]
    with pytest.raises(Exception, match="OVERFLOW"):
        one(rows.from_columns(spark, {"i": range(70), "x": [2] * 70}).ordered("i").select(col("x").cum_prod().alias("x")))


def test_nulls_sort_first_unless_last(spark):
    frame = rows.from_columns(spark, {"x": [10, None, 5]})
    order = lambda **o: [r["x"] for r in maps(frame.sort("x", **o))]
    assert order() == [None, 5, 10] and order(descending=True) == [None, 10, 5] and order(nulls_last=True) == [5, 10, None]


def test_explode(spark):
    frame = Frame(spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, tags array<string>"))
    assert one(frame.explode("tags"), "id", "tags") == [(1, "a"), (1, "b"), (3, None)]
    with pytest.raises(Exception, match="differ in length"):
        maps(Frame(spark.createDataFrame([([1], [1, 2])], "a array<int>, b array<int>")).explode("a", "b"))


def test_unique_concat_unpivot_pivot(spark):
    frame = rows.from_columns(spark, {"k": [1, 1, 2], "v": [1, 2, 3]}).ordered("v")
    assert one(frame.unique("k", keep="first"), "v") == [(1, 1), (2, 3)]
    assert one(frame.unique("k", keep="last"), "v") == [(1, 2), (2, 3)]
    assert one(frame.unique("k", keep="none")) == [(2, 3)]
    with pytest.raises(EngineError):
        Frame.concat([frame, frame.drop("v")])
    assert len(one(Frame.concat([frame, frame.drop("v")], diagonal=True))) == 6
    marks = rows.from_columns(spark, {"name": ["Alice", "Bob"], "math": [90, 80], "english": [85, 70]})
    long = marks.unpivot(index=["name"])
    assert (("Alice", "math", 90)) in one(long)
    wide = long.ordered("value", descending=True).pivot("variable", "name", "value", "first")
    assert wide.columns == ["name", "math", "english"] and one(wide, "name")[0] == ("Alice", 90, 85)
    assert long.pivot("variable", "name", "value", "sum", on_columns=["english", "art"]).columns == ["name", "english", "art"]


def test_strings(spark):
    x = col("x").str
    got = values(spark, [x.strip_prefix("pre_").alias("a"), x.strip_suffix("_suf").alias("b"), x.replace("foo", "bar").alias("c"), x.replace_n("foo", "bar", 2).alias("d"), x.slice(-3, 2).alias("e"), x.slice(-50, 45).alias("f"), x.split("_").alias("g"), x.count_matches("o.", literal=True).alias("h"), x.extract("z(.)").alias("i")], x=["pre_foo_foo_suf"])
    assert got == [("foo_foo_suf", "pre_foo_foo", "pre_bar_foo_suf", "pre_bar_bar_suf", "su", "pre_foo_fo", ["pre", "foo", "foo", "suf"], 0, None)]
    got = values(spark, [x.pad_start(7, "_").alias("a"), x.pad_end(7, "_").alias("b"), x.pad_start(2, "_").alias("c"), x.strip_chars("Ae").alias("d"), x.len_bytes().alias("e"), x.len_chars().alias("f")], x=["Alicé"])
    assert got == [("__Alicé", "Alicé__", "Alicé", "licé", 6, 5)]
    with pytest.raises(EngineError):
        x.pad_end(3, "ab")


def test_dates(spark):
    x, t = col("x").str.to_date("%Y-%m-%d").dt, col("t").str.to_datetime("%Y-%m-%d %H:%M:%S").dt
    got = values(spark, [x.year().alias("a"), x.weekday().alias("b"), x.month_start().alias("c"), x.month_end().alias("d")], x=["2026-03-24"])
    assert got == [(2026, 2, datetime.date(2026, 3, 1), datetime.date(2026, 3, 31))]
    frame = rows.from_columns(spark, {"t": ["2026-03-24 10:30:45"]}).select(col("t").str.to_datetime("%Y-%m-%d %H:%M:%S").alias("t"))
    got = one(frame.select(col("t").dt.hour().alias("h"), col("t").dt.second().alias("s"), col("t").dt.month_start().alias("m"), col("t").dt.month_end().alias("e")))
    assert got == [(10, 45, datetime.datetime(2026, 3, 1, 10, 30, 45), datetime.datetime(2026, 3, 31, 10, 30, 45))]


def test_arithmetic(spark):
    a, b = col("a"), col("b")
    got = values(spark, [(a / b).alias("q"), (a % b).alias("r"), (a.cast("float64") / b).alias("f"), (a**b).alias("p")], a=[-7, 1], b=[3, 0])
    assert got[0][:2] == (-2, 2) and got[0][3] == -343 and got[1][:3] == (None, None, float("inf"))
    x = col("x")
    got = values(spark, [x.abs().alias("a"), x.round(0).alias("b"), x.clip(-2.0, 2.0).alias("c"), x.log(10).alias("d")], x=[-3.5, 2.5, 0.0])
    assert got[0][:3] == (3.5, -4.0, -2.0) and got[0][3] != got[0][3] and got[1][1] == 2.0 and got[2][3] == float("-inf")


def test_when_cast_struct_patterns(spark):
    frame = rows.from_columns(spark, {"age": [25, 35, None], "x": ["1", "z", "3"]})
    assert [r[0] for r in one(frame.select(when(col("age") > 30).then("senior").otherwise("junior").alias("s")))] == ["junior", "senior", "junior"]
    assert [r[0] for r in one(frame.select(col("x").cast("int64", strict=False)))] == [1, None, 3]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        maps(frame.select(col("x").cast("int64")))
    assert [r[0] for r in one(frame.select((col("age") * 10).cast("uint8", strict=False)))] == [250, None, None]
    assert one(frame.limit(1).select(struct("age", "x").alias("s")).unnest("s")) == [(25, "1")]
    assert frame.select(all_columns().exclude("x")).columns == ["age"] and frame.select(col("^a.*$")).columns == ["age"]
    assert one(frame.select("age", (col("age") - col("age").mean()).alias("d")), "age")[0] == (25, -5.0)


def test_lists(spark):
    frame = rows.from_columns(spark, {"a": [17], "b": [15], "c": [16]}).select(concat_list("a", "b", "c").alias("l"))
    l = col("l").list  # noqa: E741
    exprs = [l.len(), l.sum(), l.mean(), l.median(), l.max(), l.min(), l.std(), l.arg_min(), l.arg_max(), l.get(1), l.get(9), l.slice(1, 2), l.head(2), l.tail(2), l.tail(9), l.eval(element() + 1), l.agg("sum"), l.gather_every(2, 1), l.gather([0, -1]), l.shift(), l.diff(), l.sort(descending=True)]
    got = one(frame.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]))[0]
    assert got == (3, 48, 16.0, 16.0, 17, 15, 1.0, 1, 0, 15, None, [15, 16], [17, 15], [15, 16], [17, 15, 16], [18, 16, 17], 48, [15], [17, 16], [None, 17, 15], [None, -2, 1], [17, 16, 15])
    nulls = Frame(spark.createDataFrame([([1, None, 3],), ([],), (None,)], "l array<int>"))
    assert one(nulls.select(l.sum().alias("s"), l.contains(2).alias("c"), l.sort().alias("o"), l.drop_nulls().alias("d"), l.eval(element().cast("string")).list.join("-").alias("j"), l.len().alias("n"))) == [(4, False, [None, 1, 3], [1, 3], None, 3), (0, False, [], [], "", 0), (None, None, None, None, None, None)]
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        maps(nulls.limit(1).select(l.gather([7])))
    sets = Frame(spark.createDataFrame([([1, 2, 2, 4], [2, 4, 5, 5])], "a array<int>, b array<int>"))
    a = col("a").list
    got = one(sets.select(a.union(col("b")).alias("u"), a.set_difference(col("b")).alias("d"), a.set_intersection(col("b")).alias("i"), a.set_symmetric_difference(col("b")).alias("s"), a.count_matches(2).alias("n"), a.sample_n(2, seed=1).alias("r")))[0]
    assert [sorted(x) for x in got[:4]] == [[1, 2, 4, 5], [1], [2, 4], [1, 5]] and got[4] == 2 and len(got[5]) == 2


def test_large_samples_are_exact(spark, monkeypatch):
    monkeypatch.setattr("tallyframe.operators.frame.SAMPLED_AT_ONCE", 10)
    frame = rows.from_rows(spark, [{"x": i} for i in range(500)])
    for n in (11, 250, 499, 500, 900):
        got = [r["x"] for r in maps(frame.sample_n(n, seed=3))]
        assert len({*got}) == len(got) == min(n, 500)
    assert len(maps(frame.sample_frac(0.5, seed=1))) == 250


def test_list_samples_differ_by_list(spark):
    got = values(spark, [col("a").list.sample_n(3, seed=1).alias("s")], a=[[10 * k + j for j in range(8)] for k in range(20)])
    assert len({tuple(x % 10 for x in s) for (s,) in got}) > 1 and all(s == sorted(s) and len(s) == 3 for (s,) in got)


def test_integer_powers_are_exact(spark):
    a, b = [3, -2, 0, 1, -1, 7, 2, None, 10], [39, 63, 0, 10_000, 9_999, 22, 62, 3, 18]
    got = values(spark, [(col("a") ** col("b")).alias("p")], a=a, b=b)
    assert [p for (p,) in got] == [None if x is None else x**y for x, y in zip(a, b, strict=True)]
    with pytest.raises(Exception, match="(?i)overflow"):
        values(spark, [(col("a") ** col("b")).alias("p")], a=[3], b=[40])


def test_samples_and_describe(spark, staff):
    assert len(one(staff.sample_n(3, seed=1))) == 3 and len(one(staff.sample_frac(0.5, seed=1))) == 4 and len(one(staff.sample_n(20, seed=1, with_replacement=True))) == 20
    got = {r["statistic"]: r for r in maps(staff.select("name", "age").describe())}
    assert got["count"]["age"] == "7" and got["min"]["name"] == "Alice" and got["mean"]["name"] is None and got["std"]["age"].startswith("3.06")


def test_user_functions(spark):
    frame = rows.from_columns(spark, {"age": [25, 35]})
    add = lambda b: pa.RecordBatch.from_arrays([pc.add(b.column(0), 10)], ["x"])
    assert one(frame.select(map_batches(["age"], add))) == [(35,), (45,)]
    assert one(frame.map_rows(lambda r: {"a": r["age"] * 2}, "a long")) == [(50,), (70,)]
    assert one(frame.map_batches(lambda b: b, "age long")) == [(25,), (35,)]
    mean = lambda b: pa.RecordBatch.from_arrays([pa.array([pc.mean(b.column(0)).as_py()])], ["m"])
    assert one(frame.map_whole(mean, "m double")) == [(30.0,)]
    with pytest.raises(Exception, match="gave nothing"):
        maps(frame.map_rows(lambda r: None, "a long"))


def test_sql(spark, staff, tmp_path):
    context = SQLContext(spark, {"people": staff, "gone": readers.scan_csv(spark, str(tmp_path / "no.csv"))})
    assert one(context.execute("SELECT p.name FROM people p WHERE p.age > 31 ORDER BY p.name")) == [("Charlie",), ("Eve",)]
    assert one(context.execute("SHOW TABLES")) == [("gone",), ("people",)]
    with pytest.raises(EngineError, match="nope"):
        context.execute("select * from nope")
    lazy = context.execute_lazy("select * from gone")
    with pytest.raises((EngineError, AnalysisException)):
        maps(lazy)
    assert one(sql(spark, "with x as (select max(age) as a from t) select a from x", t=staff)) == [(35,)]
    with pytest.raises(EngineError):
        context.execute("  ")


def test_import_rules(spark):
    f = lambda data, **o: rows.from_rows(spark, data, **o)
    assert f([{"a": 1}, {"a": 2.5}], infer_rows=1).df.collect()[1].a == 2
    assert f([{"a": 1}, {"a": 2.5}]).df.dtypes == [("a", "double")]
    assert f([{"a": 1, "x": 2}], schema={"a": "int32", "b": "string"}).df.collect()[0].asDict() == {"a": 1, "b": None}
    assert f([{"a": 1, "b": 2}], columns=["b", "c"]).columns == ["b", "c"]
    assert f([{"a": "x"}], schema={"a": "int64"}, strict=False).df.collect()[0].a is None
    with pytest.raises(ValidationError, match="row 0 field 'a'"):
        f([{"a": "x"}], schema={"a": "int64"})
    for bad in ({"schema": {"a": "int64"}, "columns": ["a"]}, {"infer_rows": -1}, {"columns": ["a", "a"]}):
        with pytest.raises(EngineError):
            f([{"a": 1}], **bad)
    with pytest.raises(EngineError, match="no data"):
        f([])
    nested = rows.from_arrow(spark, pa.table({"id": [1], "tags": [["a"]], "p": [{"city": "x", "score": 1}]}))
    assert maps(nested) == [{"id": 1, "tags": ["a"], "p": {"city": "x", "score": 1}}]


def test_files(spark, tmp_path):
    path = tmp_path / "custom.csv"
    path.write_text("# note\nname;age;joined\n'A;lice';25;2024-01-02\n'Bob';NA;2024-02-03\n")
    frame = readers.scan_csv(spark, str(path), separator=";", quote="'", comment_prefix="#", null_value="NA", try_parse_dates=True)
    assert one(frame) == [("A;lice", 25, datetime.date(2024, 1, 2)), ("Bob", None, datetime.date(2024, 2, 3))]
    (tmp_path / "skip.csv").write_text("junk\njunk\na,b\n1,2\n## out\n3,4\n")
    assert one(readers.scan_csv(spark, str(tmp_path / "skip.csv"), skip_rows=2, comment_prefix="##")) == [(1, 2), (3, 4)]
    (tmp_path / "bad.csv").write_bytes(b"name,age\nA\xff,1\nB,x\n")
    got = one(readers.scan_csv(spark, str(tmp_path / "bad.csv"), schema={"age": "int64"}, encoding="utf8-lossy", ignore_errors=True))
    assert got == [("A�", 1), ("B", None)]
    with pytest.raises(EngineError):
        maps(readers.scan_csv(spark, str(tmp_path / "bad.csv")))
    missing = readers.scan_parquet(spark, str(tmp_path / "no.parquet"))
    with pytest.raises(AnalysisException):
        maps(missing)
    writers.write_parquet(frame, str(tmp_path / "out"))
    assert len(one(readers.scan_parquet(spark, str(tmp_path / "out")))) == 2
    writers.write_ndjson(frame, str(tmp_path / "lines"), "gzip")
    assert spark.read.json(str(tmp_path / "lines")).count() == 2


def test_excel(spark, tmp_path):
    import zipfile

    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c r="A1" t="inlineStr"><is><t>id</t></is></c><c r="B1" t="inlineStr"><is><t> name </t></is></c><c r="D1" t="inlineStr"><is><t>score</t></is></c></row><row><c r="A2"><v>1</v></c><c r="B2" t="s"><v>0</v></c><c r="D2"><v>1.5</v></c></row><row><c r="A3"><v>7</v></c><c r="D3"><v>2</v></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(tmp_path / "book.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="One" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>001</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    got = readers.read_excel(spark, str(tmp_path / "book.xlsx"))
    assert maps(got) == [{"id": 1, "name": "001", "column_3": None, "score": 1.5}, {"id": 7, "name": None, "column_3": None, "score": 2.0}]
    assert [*readers.read_excel_sheets(spark, str(tmp_path / "book.xlsx"))] == ["One"]
    with pytest.raises(EngineError):
        readers.read_excel(spark, str(tmp_path / "book.xlsx"), sheet_id=2)


def test_exports_and_limit(spark, staff):
    import dataclasses

    two = staff.limit(2).select("name", "age")
    assert writers.to_json(two) == '[{"name":"Alice","age":25},{"name":"Bob","age":30}]'
    assert writers.to_ndjson(two).count("\n") == 2 and writers.to_list(two, "age") == [25, 30]
    assert writers.to_array(two, pa.int64(), "age").to_pylist() == [25, 30] and writers.to_arrow(two).num_rows == 2
    with pytest.raises(EngineError):
        writers.to_list(two)

    @dataclasses.dataclass
    class Person:
        name: str
        years: int = dataclasses.field(metadata={"name": "age"})

    people = writers.to_structs(two, Person)
    assert people == [Person("Alice", 25), Person("Bob", 30)] and rows.from_structs(spark, people).columns == ["name", "age"]
    writers.set_memory_limit(1)
    try:
        with pytest.raises(EngineError) as e:
            writers.to_maps(two)
        assert e.value.code == "OOM"
    finally:
        writers.set_memory_limit(None)
    assert "Project" in two.explain()


def test_value_counts(spark):
    frame = rows.from_columns(spark, {"x": ["a", "b", "a", None]})
    assert one(frame.value_counts(col("x").value_counts(sort=True)))[0] == ("a", 2)
    assert one(frame.value_counts(col("x").value_counts(normalize=True, name="p")), "x")[1] == ("a", 0.5)


def test_literal_only_select(spark):
    assert one(rows.from_columns(spark, {"x": [1]}).select(lit(3).alias("three"))) == [(3,)]
