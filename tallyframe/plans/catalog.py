"""Queries over the given tables, one or more for each verb and function of the library, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tallyframe.functions.expr import all_columns, col, lit, struct, when
from tallyframe.functions.lists import concat_list, element
from tallyframe.functions.udf import map_batches
from tallyframe.operators.frame import Frame
from tallyframe.plans.sql import SQLContext
from tallyframe.session import shared_folder
from tallyframe.sources.readers import scan_csv, scan_parquet
from tallyframe.sources.writers import write_ndjson, write_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (read, spark), which gives a Frame, as a query, with its SQL if there is one."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: scan_parquet(spark, f"{sf_dir}/{name}.parquet")).df

        run.__name__ = f.__name__
        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# Group-by and aggregates


@query("""select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, avg(l_discount) as avg_disc, count(*) as n
    from lineitem where l_shipdate <= timestamp '1998-09-02' group by all""")
def pricing_summary(read):
    rows = read("lineitem").filter(col("l_shipdate") <= lit("1998-09-02").cast("datetime"))
    return rows.group_by("l_returnflag", "l_linestatus").agg(
        col("l_quantity").sum().round(2).alias("sum_qty"), (col("l_extendedprice") * (lit(1) - col("l_discount"))).alias("x").sum().round(2).alias("revenue"), col("l_discount").mean().alias("avg_disc"), col("l_quantity").len().alias("n")
    ).sort("l_returnflag", "l_linestatus")


@query("""select event_type, sum(x)::bigint as total, count(x) as known, count(*) as rows, count(*) - count(x) as nulls, min(x) as low, max(x) as high, avg(x) as mean, median(x) as mid, stddev_samp(x) as sd, var_samp(x) as var
    from (select event_type, case when event_id % 3 = 0 then null else event_id % 100 end as x from events) group by all""")
def aggregates(read):
    rows = read("events").select("event_type", when(col("event_id") % 3 == 0).then(lit(None)).otherwise(col("event_id") % 100).cast("int64").alias("x"))
    x = col("x")
    return rows.group_by("event_type").agg(x.sum().alias("total"), x.count().alias("known"), x.len().alias("rows"), x.null_count().alias("nulls"), x.min().alias("low"), x.max().alias("high"), x.mean().alias("mean"), x.median().alias("mid"), x.std().alias("sd"), x.var().alias("var"))


@query("""select user_id, cast(count(distinct k) + max(case when k is null then 1 else 0 end) as bigint) as n
    from (select user_id, case when event_id % 7 = 0 then null else event_id % 5 end as k from events) group by all""")
def n_unique(read):
    return read("events").with_columns(k=when(col("event_id") % 7 == 0).then(lit(None)).otherwise(col("event_id") % 5)).group_by("user_id").agg(col("k").n_unique().alias("n"))


@query("select user_id, arg_min(event_type, ts) as first, arg_max(event_type, ts) as last from events group by all")
def first_last(read):
    return read("events").ordered("ts").group_by("user_id").agg(col("event_type").first().alias("first"), col("event_type").last().alias("last"))


@query("""select l_returnflag, cast(quantile_cont(l_quantity, 0.25) as double) as q1, cast(quantile_disc(l_quantity, 0.9) as double) as q9,
    list_sort(list(l_quantity))[cast(floor((count(*) - 1) * 0.3) as bigint) + 1] as low, list_sort(list(l_quantity))[cast(ceil((count(*) - 1) * 0.3) as bigint) + 1] as high from lineitem group by all""")
def quantiles(read):
    q = col("l_quantity")
    return read("lineitem").group_by("l_returnflag").agg(q.quantile(0.25).alias("q1"), q.quantile(0.9, "equiprobable").alias("q9"), q.quantile(0.3, "lower").alias("low"), q.quantile(0.3, "higher").alias("high"))


@query("""select o_custkey, coalesce(sum(o_orderkey) filter (o_orderstatus = 'O'), 0)::bigint as open, coalesce(list(o_orderkey order by o_totalprice desc, o_orderkey) filter (o_totalprice > 100000), []) as large from orders group by all""")
def filtered_aggregates(read):
    large = col("o_orderkey").filter(col("o_totalprice") > 100000).sort_by([col("o_totalprice"), col("o_orderkey")], descending=[True, False])
    return read("orders").group_by("o_custkey").agg(col("o_orderkey").filter(col("o_orderstatus") == "O").sum().alias("open"), large.alias("large"))


@query("select o_custkey, list(o_orderkey order by o_orderkey) as keys from orders group by all")
def grouped_lists(read):
    return read("orders").ordered("o_orderkey").group_by("o_custkey").agg(col("o_orderkey").alias("keys"))


@query("select year(o_orderdate)::integer as y, count(*) as n from orders group by all")
def group_by_expression(read):
    return read("orders").group_by(col("o_orderdate").dt.year().alias("y")).agg(col("o_orderkey").len().alias("n"))


@query("select event_type, count(*) as n, count(*) / (select count(*) from events) as part from events group by all")
def value_counts(read):
    events = read("events")
    parts = events.value_counts(col("event_type").value_counts(normalize=True, name="part"))
    return events.value_counts(col("event_type").value_counts(sort=True, name="n")).join(parts, on="event_type")


@query("select sum(o_orderkey)::bigint as total, min(o_orderkey) as low, count(*) as n from orders")
def whole_frame_aggregates(read):
    return read("orders").select(col("o_orderkey").sum().alias("total"), col("o_orderkey").min().alias("low"), col("o_orderkey").len().alias("n"))


@query("select o_orderkey, o_orderkey - (select max(o_orderkey) from orders) as below from orders")
def aggregate_beside_rows(read):
    return read("orders").select("o_orderkey", (col("o_orderkey") - col("o_orderkey").max()).alias("below"))


# Projection, filters, sorting


@query("""select o_orderkey as k, o_custkey + 1 as next, o_totalprice from orders where o_totalprice > 100000 and not (o_orderstatus = 'F')""")
def select_filter(read):
    return read("orders").filter((col("o_totalprice") > 100000) & ~(col("o_orderstatus") == "F")).select(col("o_orderkey").alias("k"), (col("o_custkey") + 1).alias("next"), "o_totalprice")


@query("select c_custkey as c_name, c_name as c_custkey, c_nationkey from customer")
def rename_drop(read):
    return read("customer").drop("c_acctbal", "c_mktsegment").rename({"c_custkey": "c_name", "c_name": "c_custkey"})


@query("select p_partkey, p_size from part")
def columns_by_pattern(read):
    return read("part").select(col("^p_(partkey|size)$"))


@query("select * exclude (p_name, p_type) from part")
def all_but(read):
    return read("part").select(all_columns().exclude("p_name", "p_type"))


@query("select s_suppkey, s_acctbal from supplier order by s_acctbal desc, s_suppkey limit 20")
def top_rows(read):
    return read("supplier").sort("s_acctbal", "s_suppkey", descending=[True, False]).limit(20).select("s_suppkey", "s_acctbal")


@query("select event_id from events order by event_id offset 40 limit 25")
def slice_rows(read):
    return read("events").ordered("event_id").slice(40, 25).select("event_id")


@query("select event_id from (select event_id from events order by event_id desc limit 30) order by event_id limit 10")
def slice_from_end(read):
    return read("events").ordered("event_id").slice(-30, 10).select("event_id")


@query("select event_id, ts from events order by ts desc limit 15")
def tail_rows(read):
    return read("events").ordered("ts").tail(15).select("event_id", "ts")


@query("select event_id, value from (select event_id, case when event_id % 4 = 0 then null when event_id % 5 = 0 then 'nan'::double else value end as value from events) where value is not null and not isnan(value)")
def drop_nulls_nans(read):
    value = when(col("event_id") % 4 == 0).then(lit(None)).otherwise(when(col("event_id") % 5 == 0).then(float("nan")).otherwise(col("value")))
    return read("events").select("event_id", value.alias("value")).drop_nulls("value").drop_nans("value")


@query("""select event_id, coalesce(a, -1) as a, case when isnan(b) then 0 else b end as b, a is null as no_a, isnan(b) as nan_b, isfinite(b) as fin_b
    from (select event_id, case when event_id % 4 = 0 then null else event_id end as a, case when event_id % 5 = 0 then 'nan'::double else value end as b from events)""")
def fill_values(read):
    rows = read("events").select("event_id", when(col("event_id") % 4 == 0).then(lit(None)).otherwise(col("event_id")).alias("a"), when(col("event_id") % 5 == 0).then(float("nan")).otherwise(col("value")).alias("b"))
    return rows.select("event_id", col("a").fill_null(-1).alias("a"), col("b").fill_nan(0.0).alias("b"), col("a").is_null().alias("no_a"), col("b").is_nan().alias("nan_b"), col("b").is_finite().alias("fin_b"))


@query("""select event_id, case when b <> 0 then a // nullif(b, 0) end as q, case when b <> 0 then ((a % nullif(b, 0)) + b) % nullif(b, 0) end as r, case when b = 0 then (case when a = 0 then 'nan'::double when a > 0 then 'inf'::double else '-inf'::double end) else a::double / nullif(b, 0)::double end as f,
    (a * a)::bigint as sq, xor(a, b) as x, a > b as gt, case when a > 0 then 'pos' when a = 0 then 'zero' else 'neg' end as sign
    from (select event_id, event_id % 11 - 5 as a, nullif(event_id % 4, 9) as b from events)""")
def arithmetic(read):
    rows = read("events").with_columns(a=col("event_id") % 11 - 5, b=col("event_id") % 4)
    a, b = col("a"), col("b")
    sign = when(a > 0).then("pos").otherwise(when(a == 0).then("zero").otherwise("neg"))
    return rows.select("event_id", (a / b).alias("q"), (a % b).alias("r"), (a.cast("float64") / b.cast("float64")).alias("f"), (a**2).alias("sq"), (a ^ b).alias("x"), (a > b).alias("gt"), sign.alias("sign"))


@query("""select s_suppkey, abs(s_acctbal) as a, round_even(s_acctbal, 1) as r, sqrt(abs(s_acctbal)) as s, case when s_acctbal < 0 then 'nan'::double when s_acctbal = 0 then '-inf'::double else ln(s_acctbal) / ln(2.0) end as l,
    case when s_acctbal < 0 then 0 when s_acctbal > 5000 then 5000 else s_acctbal end as c, trunc(s_acctbal)::bigint as i, s_acctbal::varchar as t from supplier""")
def math(read):
    x = col("s_acctbal")
    return read("supplier").select("s_suppkey", x.abs().alias("a"), x.round(1).alias("r"), x.abs().sqrt().alias("s"), x.log(2).alias("l"), x.clip(0.0, 5000.0).alias("c"), x.cast("int64").alias("i"), x.cast("string").alias("t"))


@query("select p_partkey, try_cast(regexp_replace(p_brand, 'Brand#', '') as bigint) as n, try_cast(p_name as bigint) as none, case when p_size between 0 and 255 then p_size::smallint end as u from part")
def casts(read):
    return read("part").select("p_partkey", col("p_brand").str.replace("Brand#", "", literal=True).cast("int64").alias("n"), col("p_name").cast("int64", strict=False).alias("none"), col("p_size").cast("uint8", strict=False).alias("u"))


# Strings and dates


@query("""select p_partkey, strlen(p_name) as b, length(p_name) as c, contains(p_name, 'ri') as has, regexp_matches(p_name, '^s.*g$') as re, starts_with(p_name, 'sm') as st, ends_with(p_name, 'g') as en,
    nullif(regexp_extract(p_name, '(\\w+) (\\w+)', 2), '') as word, regexp_extract_all(p_name, '[aeiou]') as vowels, upper(p_name) as up, lower(p_type) as lo from part""")
def strings_tests(read):
    n = col("p_name").str
    return read("part").select("p_partkey", n.len_bytes().cast("int64").alias("b"), n.len_chars().cast("int64").alias("c"), n.contains("ri", literal=True).alias("has"), n.contains("^s.*g$").alias("re"), n.starts_with("sm").alias("st"), n.ends_with("g").alias("en"), n.extract(r"(\w+) (\w+)", 2).alias("word"), n.extract_all("[aeiou]").alias("vowels"), n.to_uppercase().alias("up"), col("p_type").str.to_lowercase().alias("lo"))


@query("""select p_partkey, regexp_replace(p_name, '[aeiou]', '*') as one, regexp_replace(p_name, '([aeiou])', '<\\1>', 'g') as every, replace(p_name, 'l', 'LL') as lit,
    len(regexp_extract_all(p_name, '[aeiou]')) as n, trim(p_name, 'sg') as t, case when starts_with(p_name, 'small ') then substr(p_name, 7) else p_name end as pre,
    case when ends_with(p_name, 'ring') then left(p_name, length(p_name) - 4) else p_name end as suf, substr(p_name, 2, 3) as mid, right(p_name, 3) as tail,
    string_split(p_name, ' ') as parts, case when length(p_name) >= 12 then p_name else lpad(p_name, 12, '.') end as pad, case when length(p_name) >= 12 then p_name else rpad(p_name, 12, '.') end as pad2, p_name || '!' as bang from part""")
def strings_edits(read):
    n = col("p_name").str
    return read("part").select(
        "p_partkey", n.replace("[aeiou]", "*").alias("one"), n.replace_all("([aeiou])", "<${1}>").alias("every"), n.replace_all("l", "LL", literal=True).alias("lit"), n.count_matches("[aeiou]").cast("int64").alias("n"), n.strip_chars("sg").alias("t"),
        n.strip_prefix("small ").alias("pre"), n.strip_suffix("ring").alias("suf"), n.slice(1, 3).alias("mid"), n.slice(-3).alias("tail"), n.split(" ").alias("parts"), n.pad_start(12, ".").alias("pad"), n.pad_end(12, ".").alias("pad2"), (col("p_name") + "!").alias("bang"),
    )


@query("""select o_orderkey, year(d)::integer as y, month(d)::integer as m, day(d)::integer as d, isodow(d)::integer as w, hour(t)::integer as h, minute(t)::integer as mi, second(t)::integer as s, date_trunc('month', d)::date as a, last_day(d) as z
    from (select o_orderkey, o_orderdate::date as d, o_orderdate + to_seconds(o_orderkey % 86400) as t from orders)""")
def dates(read):
    import pyspark.sql.functions as F

    rows = read("orders").with_columns(d0=col("o_orderdate").cast("date"), t=col("o_orderkey").map(lambda k, x: x + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod(k, F.lit(86400)).cast("decimal(18,6)")), col("o_orderdate")))
    d, t = col("d0").dt, col("t").dt
    return rows.select("o_orderkey", d.year().alias("y"), d.month().alias("m"), d.day().alias("d"), d.weekday().alias("w"), t.hour().alias("h"), t.minute().alias("mi"), t.second().alias("s"), d.month_start().alias("a"), d.month_end().alias("z"))


@query("select o_orderkey, strptime(s, '%d/%m/%Y')::date as d, strptime(s || ' 01:02:03', '%d/%m/%Y %H:%M:%S') as t from (select o_orderkey, strftime(o_orderdate, '%d/%m/%Y') as s from orders)")
def parse_dates(read):
    import pyspark.sql.functions as F

    rows = read("orders").select("o_orderkey", col("o_orderdate").map(lambda x: F.date_format(x, "dd/MM/yyyy")).alias("s"))
    return rows.select("o_orderkey", col("s").str.to_date("%d/%m/%Y").alias("d"), (col("s") + " 01:02:03").str.to_datetime("%d/%m/%Y %H:%M:%S").alias("t"))


# Windows


@query("select o_orderkey, round(sum(o_totalprice) over (partition by o_custkey), 2) as total, count(*) over (partition by o_custkey) as n, max(o_orderkey) over (partition by o_custkey) as top from orders")
def over_partition(read):
    return read("orders").select("o_orderkey", col("o_totalprice").sum().over("o_custkey").round(2).alias("total"), col("o_orderkey").len().over("o_custkey").alias("n"), col("o_orderkey").max().over("o_custkey").alias("top"))


@query("select o_orderkey, list(o_orderkey) over (partition by o_custkey order by o_totalprice, o_orderkey rows between unbounded preceding and unbounded following) as mates from orders")
def over_joined_lists(read):
    return read("orders").select("o_orderkey", col("o_orderkey").over("o_custkey", order_by=["o_totalprice", "o_orderkey"], mapping="join").alias("mates"))


@query("""select o_orderkey, dense_rank() over w as dense, rank() over w as low, rank() over w + count(*) over (partition by o_custkey, o_orderpriority) - 1 as high,
    rank() over w + (count(*) over (partition by o_custkey, o_orderpriority) - 1) / 2.0::double as avg, row_number() over (partition by o_custkey order by o_orderpriority, o_orderkey) as ord
    from orders window w as (partition by o_custkey order by o_orderpriority)""")
def ranks(read):
    p = col("o_orderpriority")
    rank = lambda m: p.rank(m).over("o_custkey")
    return read("orders").ordered("o_orderkey").select("o_orderkey", rank("dense").cast("int64").alias("dense"), rank("min").cast("int64").alias("low"), rank("max").cast("int64").alias("high"), rank("average").alias("avg"), rank("ordinal").cast("int64").alias("ord"))


@query("""select event_id, sum(k) over w::bigint as s, count(k) over w as n, min(k) over w as lo, max(k) over w as hi, sum(k) over (partition by user_id order by event_id desc)::bigint as back
    from (select event_id, user_id, event_id % 17 as k from events) window w as (partition by user_id order by event_id)""")
def running(read):
    rows = read("events").select("event_id", "user_id", (col("event_id") % 17).alias("k")).ordered("event_id")
    k = col("k")
    return rows.select("event_id", k.cum_sum().over("user_id").alias("s"), k.cum_count().over("user_id").alias("n"), k.cum_min().over("user_id").alias("lo"), k.cum_max().over("user_id").alias("hi"), k.cum_sum(reverse=True).over("user_id").alias("back"))


@query("select event_id, product(1 + event_id % 2) over (partition by g order by event_id)::bigint as p from (select event_id, event_id // 20 as g from events)")
def running_product(read):
    rows = read("events").select("event_id", (col("event_id") / 20).alias("g")).ordered("event_id")
    return rows.select("event_id", (lit(1).cast("int64") + col("event_id") % 2).alias("x").cum_prod().over("g").alias("p"))


@query("""select event_id, lag(value, 2) over w as before, lead(value) over w as after, event_id - lag(event_id) over w as step from events window w as (partition by user_id order by event_id)""")
def shifts(read):
    return read("events").ordered("event_id").select("event_id", col("value").shift(2).over("user_id").alias("before"), col("value").shift(-1).over("user_id").alias("after"), col("event_id").diff().over("user_id").alias("step"))


@query("""select event_id, last_value(k ignore nulls) over (w rows between unbounded preceding and current row) as f, last_value(k ignore nulls) over (w rows between 1 preceding and current row) as f1, first_value(k ignore nulls) over (w rows between current row and unbounded following) as b
    from (select event_id, user_id, case when event_id % 3 = 0 then event_id end as k from events) window w as (partition by user_id order by event_id)""")
def fills(read):
    rows = read("events").select("event_id", "user_id", when(col("event_id") % 3 == 0).then(col("event_id")).otherwise(lit(None)).alias("k")).ordered("event_id")
    k = col("k")
    return rows.select("event_id", k.ffill().over("user_id").alias("f"), k.ffill(1).over("user_id").alias("f1"), k.bfill().over("user_id").alias("b"))


@query("""select event_id, case when count(k) over a >= 2 then min(k) over a end as lo, case when count(k) over a >= 2 then max(k) over a end as hi, case when count(k) over c >= 1 then sum(k) over c end::bigint as s, case when count(k) over a >= 2 then avg(k) over a end as m
    from (select event_id, user_id, event_id % 13 as k from events) window a as (partition by user_id order by event_id rows between 2 preceding and current row), c as (partition by user_id order by event_id rows between 1 preceding and 1 following)""")
def rolling(read):
    rows = read("events").select("event_id", "user_id", (col("event_id") % 13).alias("k")).ordered("event_id")
    k = col("k")
    return rows.select("event_id", k.rolling_min(3, 2).over("user_id").alias("lo"), k.rolling_max(3, 2).over("user_id").alias("hi"), k.rolling_sum(3, 1, center=True).over("user_id").alias("s"), k.rolling_mean(3, 2).over("user_id").alias("m"))


@query("select event_id, count(*) over (partition by user_id, event_type) > 1 as dup from events")
def duplicated(read):
    return read("events").select("event_id", struct("user_id", "event_type").is_duplicated().alias("dup"))


@query("select event_id, count(distinct k) over (partition by user_id) + 0 as n, median(k) over (partition by user_id) as m from (select event_id, user_id, event_id % 6 as k from events)")
def distinct_over(read):
    rows = read("events").with_columns(k=col("event_id") % 6)
    return rows.select("event_id", col("k").n_unique().over("user_id").alias("n"), col("k").median().over("user_id").alias("m"))


# Joins


@query("select o_orderkey, o_custkey, c_name, n_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey")
def join_inner(read):
    return read("orders").join(read("customer"), left_on="o_custkey", right_on="c_custkey").join(read("nation"), left_on="c_nationkey", right_on="n_nationkey").select("o_orderkey", "o_custkey", "c_name", "n_name")


@query("select c_custkey, c_name, o_orderkey from customer left join (select * from orders where o_totalprice > 250000) on c_custkey = o_custkey")
def join_left(read):
    return read("customer").join(read("orders").filter(col("o_totalprice") > 250000), left_on="c_custkey", right_on="o_custkey", how="left").select("c_custkey", "c_name", "o_orderkey")


@query("select b.id as id, a.v as v, b.v as v_right from (select c_custkey as id, c_nationkey as v from customer where c_acctbal > 0) a right join (select s_suppkey as id, s_nationkey as v from supplier) b on a.id = b.id")
def join_right(read):
    a = read("customer").filter(col("c_acctbal") > 0).select(col("c_custkey").alias("id"), col("c_nationkey").alias("v"))
    return a.join(read("supplier").select(col("s_suppkey").alias("id"), col("s_nationkey").alias("v")), on="id", how="right")


@query("select a.id as id, b.id as id_right from (select c_custkey as id from customer where c_acctbal > 0) a full join (select s_suppkey as id from supplier) b on a.id = b.id")
def join_full(read):
    a = read("customer").filter(col("c_acctbal") > 0).select(col("c_custkey").alias("id"))
    return a.join(read("supplier").select(col("s_suppkey").alias("id")), on="id", how="full")


@query("select * from customer where c_custkey in (select o_custkey from orders where o_totalprice > 250000)")
def join_semi(read):
    return read("customer").join(read("orders").filter(col("o_totalprice") > 250000), left_on="c_custkey", right_on="o_custkey", how="semi")


@query("select * from customer where c_custkey not in (select o_custkey from orders)")
def join_anti(read):
    return read("customer").join(read("orders"), left_on="c_custkey", right_on="o_custkey", how="anti")


@query("select a.r_name, b.r_name as r_name_right from region a, region b")
def join_cross(read):
    names = read("region").select("r_name")
    return names.join(names, how="cross")


# Reshaping and sets


@query("select user_id, event_type, count(*) as n from events group by all")
def unique_any(read):
    return read("events").group_by("user_id", "event_type").agg(col("event_id").len().alias("n")).unique()


@query("select user_id, event_id from (select *, row_number() over (partition by user_id order by event_id) as n from events) where n = 1")
def unique_first(read):
    return read("events").select("user_id", "event_id").ordered("event_id").unique("user_id", keep="first")


@query("select user_id, event_id from (select *, row_number() over (partition by user_id order by event_id desc) as n from events) where n = 1")
def unique_last(read):
    return read("events").select("user_id", "event_id").ordered("event_id").unique("user_id", keep="last")


@query("select p_name, p_brand, p_size, p_partkey from (select *, count(*) over (partition by p_name, p_brand, p_size) as n from part) where n = 1")
def unique_none(read):
    return read("part").select("p_name", "p_brand", "p_size", "p_partkey").unique("p_name", "p_brand", "p_size", keep="none")


@query("select c_custkey as k, c_nationkey as n from customer union all select s_suppkey, s_nationkey from supplier")
def concat_rows(read):
    return Frame.concat([read("customer").select(col("c_custkey").alias("k"), col("c_nationkey").alias("n")), read("supplier").select(col("s_suppkey").alias("k"), col("s_nationkey").alias("n"))])


@query("select c_custkey as k, c_nationkey as n, null::varchar as name from customer union all select s_suppkey, null, s_name from supplier")
def concat_diagonal(read):
    return Frame.concat([read("customer").select(col("c_custkey").alias("k"), col("c_nationkey").alias("n")), read("supplier").select(col("s_suppkey").alias("k"), col("s_name").alias("name"))], diagonal=True)


@query("select p_partkey, unnest(string_split(p_name, ' ')) as word from part")
def explode_lists(read):
    return read("part").select("p_partkey", col("p_name").str.split(" ").alias("word")).explode("word")


@query("select p_partkey, p_name as a, p_size as b from part")
def unnest_structs(read):
    return read("part").select("p_partkey", struct(col("p_name").alias("a"), col("p_size").alias("b")).alias("s")).unnest("s")


@query("select s_suppkey, 'nation' as variable, s_nationkey::double as value from supplier union all select s_suppkey, 'balance', s_acctbal from supplier")
def unpivot_columns(read):
    rows = read("supplier").select("s_suppkey", col("s_nationkey").alias("nation"), col("s_acctbal").alias("balance"))
    return rows.unpivot(index=["s_suppkey"])


@query("select o_orderpriority, count(*) filter (o_orderstatus = 'F') as \"F\", count(*) filter (o_orderstatus = 'O') as \"O\", count(*) filter (o_orderstatus = 'P') as \"P\" from orders group by all")
def pivot_found(read):
    return read("orders").pivot("o_orderstatus", "o_orderpriority", "o_orderkey", "len")


@query("select o_orderpriority, sum(o_orderkey) filter (o_orderstatus = 'F')::bigint as \"F\", coalesce(sum(o_orderkey) filter (o_orderstatus = 'X'), 0)::bigint as \"X\" from orders group by all")
def pivot_given(read):
    return read("orders").pivot("o_orderstatus", "o_orderpriority", "o_orderkey", "sum", on_columns=["F", "X"])


@query()
def sample_rows(read):
    return read("events").sample_n(200, seed=7)


@query()
def sample_fraction(read):
    return read("events").sample_frac(0.1, seed=7)


@query("""with s as (select count(o_orderkey)::varchar as a, count(o_orderstatus)::varchar as b, min(o_orderkey)::varchar as c, max(o_orderkey)::varchar as d, min(o_orderstatus) as e, max(o_orderstatus) as f, avg(o_orderkey)::varchar as m, round(stddev_pop(o_orderkey), 3)::varchar as sd from orders)
    select 'count' as statistic, a as k, b as st from s union all select 'null_count', '0', '0' from s union all select 'mean', m, null from s union all select 'std', sd, null from s union all select 'min', c, e from s union all select 'max', d, f from s""")
def describe(read):
    return read("orders").select(col("o_orderkey").alias("k"), col("o_orderstatus").alias("st")).describe().with_columns(k=when(col("statistic") == "std").then(col("k").cast("float64").round(3).cast("string")).otherwise(col("k")))


# Lists


@query("""select k, len(l)::integer as n, coalesce(list_sum(list_filter(l, lambda x: x is not null)), 0)::bigint as s, list_avg(l) as m, list_median(l) as md, list_max(l) as hi, list_min(l) as lo, list_stddev_samp(l) as sd, list_contains(l, 3) as has,
    list_sort(l, 'asc', 'nulls first') as srt, list_reverse(l) as rev, len(list_filter(l, lambda x: x is null)) > 0 as gap, l[1] as first, l[-1] as last, l[9] as none
    from (select event_id as k, [event_id % 7, event_id % 3, nullif(event_id % 5, 4), event_id % 2] as l from events)""")
def list_reductions(read):
    e = col("event_id")
    rows = read("events").select(e.alias("k"), concat_list(e % 7, e % 3, when(e % 5 == 4).then(lit(None)).otherwise(e % 5), e % 2).alias("l"))
    x = col("l").list
    return rows.select("k", x.len().alias("n"), x.sum().alias("s"), x.mean().alias("m"), x.median().alias("md"), x.max().alias("hi"), x.min().alias("lo"), x.std().alias("sd"), x.contains(3).alias("has"), x.sort().alias("srt"), x.reverse().alias("rev"), (x.len() > x.drop_nulls().list.len()).alias("gap"), x.first().alias("first"), x.last().alias("last"), x.get(8).alias("none"))


@query("""select k, list_transform(l, lambda x: x * 2 + 1) as ev, list_slice(l, 2, 3) as sl, list_slice(l, 3, 4) as tl, list_sort(list_distinct(l)) as u, len(list_distinct(l))::integer as nu, list_position(l, list_min(l))::bigint - 1 as amin, list_position(l, list_max(l))::bigint - 1 as amax,
    array_to_string(list_transform(l, lambda x: x::varchar), '-') as j, [l[1], l[3]] as ge, [null, l[1], l[2], l[3]] as sh, [null, l[2] - l[1], l[3] - l[2], l[4] - l[3]] as di, [l[4], l[1]] as ga, len(list_filter(l, lambda x: x = 1))::integer as ones
    from (select event_id as k, [event_id % 7, event_id % 3, event_id % 5, event_id % 2] as l from events)""")
def list_edits(read):
    e = col("event_id")
    rows = read("events").select(e.alias("k"), concat_list(e % 7, e % 3, e % 5, e % 2).alias("l"))
    x = col("l").list
    return rows.select(
        "k", x.eval(element() * 2 + 1).alias("ev"), x.slice(1, 2).alias("sl"), x.tail(2).alias("tl"), x.unique().list.sort().alias("u"), x.n_unique().alias("nu"), x.arg_min().alias("amin"), x.arg_max().alias("amax"), x.eval(element().cast("string")).list.join("-").alias("j"),
        x.gather_every(2).alias("ge"), x.shift().alias("sh"), x.diff().alias("di"), x.gather([-1, 0]).alias("ga"), x.count_matches(1).alias("ones"),
    )


@query("""select k, list_sort(list_distinct(a || b)) as un, list_sort(list_distinct(list_intersect(a, b))) as it, list_sort(list_distinct(list_filter(a, lambda x: not list_contains(b, x)))) as df,
    list_sort(list_distinct(list_filter(a, lambda x: not list_contains(b, x)) || list_filter(b, lambda x: not list_contains(a, x)))) as sy, list_bool_or([k % 2 = 0, k % 3 = 0]) as an, list_bool_and([k % 2 = 0, k % 3 = 0]) as al
    from (select event_id as k, [event_id % 7, event_id % 3] as a, [event_id % 5, event_id % 2] as b from events)""")
def list_sets(read):
    e = col("event_id")
    rows = read("events").select(e.alias("k"), concat_list(e % 7, e % 3).alias("a"), concat_list(e % 5, e % 2).alias("b"), concat_list(e % 2 == 0, e % 3 == 0).alias("f"))
    a, f = col("a").list, col("f").list
    return rows.select("k", a.union(col("b")).list.sort().alias("un"), a.set_intersection(col("b")).list.sort().alias("it"), a.set_difference(col("b")).list.sort().alias("df"), a.set_symmetric_difference(col("b")).list.sort().alias("sy"), f.any().alias("an"), f.all().alias("al"))



@query()
def list_samples(read):
    return read("embeddings").select("vec_id", col("embedding").list.sample_n(5, seed=3).alias("some"))


@query("""select k, list_sum(list_transform(l, lambda x: x * x))::bigint as squares, list_max(l) - list_min(l) as spread, list_var_samp(l) as var, list_sum(list_filter(l, lambda x: x > 1))::bigint as above
    from (select event_id as k, [event_id % 7, event_id % 3, event_id % 5, event_id % 2 + 2] as l from events)""")
def list_reducing_expressions(read):
    e = col("event_id")
    rows = read("events").select(e.alias("k"), concat_list(e % 7, e % 3, e % 5, e % 2 + 2).alias("l"))
    x, one = col("l").list, element()
    return rows.select("k", x.agg((one * one).sum()).alias("squares"), x.agg(one.max() - one.min()).alias("spread"), x.var().alias("var"), x.agg(one.filter(one > 1).sum()).alias("above"))


# More of orders, windows, strings and times


@query("""select user_id, first(event_id order by event_type desc, event_id) as first, last(event_id order by event_type desc, event_id) as last, first(event_id order by value desc, event_id) as top from events group by all""")
def first_last_of_two_directions(read):
    rows = read("events").select("user_id", "event_type", "event_id", "value")
    ends = rows.ordered("event_type", "event_id", descending=[True, False]).group_by("user_id").agg(col("event_id").first().alias("first"), col("event_id").last().alias("last"))
    return ends.join(rows.ordered("value", "event_id", descending=[True, False]).group_by("user_id").agg(col("event_id").first().alias("top")), on="user_id")


@query("""select user_id, event_type, event_id, lag(event_id) over (partition by event_type order by f, event_id) as before from (select *, min(event_id) over (partition by user_id) as f from events)""")
def over_laid_out(read):
    laid = read("events").ordered("event_id").over_exploded("user_id", "user_id", "event_type", "event_id")
    return laid.select("user_id", "event_type", "event_id", col("event_id").shift().over("event_type").alias("before"))


@query("""select event_id, l[n - r + 1] as v from (select event_id, row_number() over (partition by user_id order by event_id) as r, count(*) over (partition by user_id) as n,
    list(event_type) over (partition by user_id order by event_id rows between unbounded preceding and unbounded following) as l from events)""")
def reversed_column(read):
    return read("events").ordered("event_id").select("event_id", col("event_type").reverse().over("user_id").alias("v"))


@query("select event_id, user_id from events order by event_id desc limit 12")
def reversed_rows(read):
    return read("events").select("event_id", "user_id").ordered("event_id").reverse().limit(12)


@query("select d from (select event_id - lag(event_id, 2) over w as d, row_number() over w as r from events window w as (partition by user_id order by event_id)) where r > 2")
def diff_without_first(read):
    return read("events").ordered("event_id").select(col("event_id").diff(2, drop=True).over("user_id").alias("d"))


_GAPS = "select event_id, user_id, case when event_id % 3 = 0 then event_id end as k, case when event_id % 5 = 0 then 'nan'::double when event_id % 7 = 0 then null else value end as v from events"


def _with_gaps(read):
    value = when(col("event_id") % 5 == 0).then(float("nan")).otherwise(when(col("event_id") % 7 == 0).then(lit(None)).otherwise(col("value")))
    return read("events").select("event_id", "user_id", when(col("event_id") % 3 == 0).then(col("event_id")).otherwise(lit(None)).alias("k"), value.alias("v"))


@query(f"select event_id, user_id, coalesce(k, 0) as k, case when isnan(v) then 1.5 else coalesce(v, 0) end as v from ({_GAPS})")
def frame_fill_values(read):
    return _with_gaps(read).fill_null(0).fill_nan(1.5)


@query(f"""select event_id, user_id, last_value(k ignore nulls) over (w rows between 2 preceding and current row) as k, first_value(v ignore nulls) over (w rows between current row and unbounded following) as v
    from ({_GAPS}) window w as (partition by user_id order by event_id)""")
def frame_fills(read):
    rows = _with_gaps(read).ordered("event_id")
    forward = rows.select("event_id", "user_id", "k").ffill(2, over=["user_id"])
    return forward.join(rows.select("event_id", "user_id", "v").bfill(over=["user_id"]).select("event_id", "v"), on="event_id")


@query("""select l_returnflag, l[cast(round((n - 1) * 0.3) as bigint) + 1] as near, (l[cast(floor((n - 1) * 0.35) as bigint) + 1] + l[cast(ceil((n - 1) * 0.35) as bigint) + 1]) / 2 as mid
    from (select l_returnflag, list_sort(list(l_quantity)) as l, count(*) as n from lineitem group by all)""")
def quantile_methods(read):
    q = col("l_quantity")
    return read("lineitem").group_by("l_returnflag").agg(q.quantile(0.3, "nearest").alias("near"), q.quantile(0.35, "midpoint").alias("mid"))


@query("""select p_partkey, regexp_replace(regexp_replace(p_name, '[aeiou]', '*'), '[aeiou]', '*') as two, regexp_replace(regexp_replace(p_name, '([aeiou])([a-z])', '\\2<#>'), '([aeiou])([a-z])', '\\2<#>') as turned,
    case when contains(p_type, 'E') then regexp_replace(regexp_replace(p_type, 'E', 'e'), 'E', 'e') else p_type end as lit from part""")
def replace_first_matches(read):
    n = col("p_name").str
    return read("part").select("p_partkey", n.replace_n("[aeiou]", "*", 2).alias("two"), n.replace_n("([aeiou])([a-z])", "$2<#>", 2).alias("turned"), col("p_type").str.replace_n("E", "e", 2, literal=True).alias("lit"))


@query("""select o_orderkey, strftime(t, '%H:%M:%S') as s, date_trunc('month', t) + (t - date_trunc('day', t)) as a, last_day(t) + (t - date_trunc('day', t)) as z
    from (select o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) as t from orders)""")
def datetimes(read):
    import pyspark.sql.functions as F

    later = col("o_orderkey").map(lambda k, x: x + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod(k, F.lit(86400)).cast("decimal(18,6)")), col("o_orderdate"))
    rows = read("orders").with_columns(t=later).with_columns(s=col("t").map(lambda t: F.date_format(t, "HH.mm.ss")))
    return rows.select("o_orderkey", col("s").str.to_time("%H.%M.%S").cast("string").alias("s"), col("t").dt.month_start().alias("a"), col("t").dt.month_end().alias("z"))


# Files: what a sink writes, a scan reads


def _path(frame: Frame) -> str:
    return f"{shared_folder(frame.df.sparkSession)}/tallyframe-{uuid.uuid4().hex}/files"


@query("select o_orderkey, o_totalprice, case when o_orderstatus <> 'F' then o_orderpriority end as priority, cast(o_orderdate as date) as day from orders")
def delimited_text(read):
    orders = read("orders").select("o_orderkey", "o_totalprice", when(col("o_orderstatus") != "F").then(col("o_orderpriority")).otherwise(lit(None)).alias("priority"), col("o_orderdate").cast("date").alias("day"))
    path = _path(orders)
    orders.df.write.options(header=True, sep=";", nullValue="NA").csv(path)
    return scan_csv(orders.df.sparkSession, path, separator=";", null_value="NA", try_parse_dates=True)


@query("select c_custkey as _c0, c_name as _c1, c_acctbal as _c2 from customer")
def delimited_text_without_heads(read):
    customers = read("customer").select("c_custkey", "c_name", "c_acctbal")
    path = _path(customers)
    customers.df.write.options(header=True).csv(path)
    return scan_csv(customers.df.sparkSession, path, has_header=False, skip_rows=1)


@query("select event_id, event_type, case when event_id % 4 <> 0 then value end as value from events")
def json_lines(read):
    events = read("events").select("event_id", "event_type", when(col("event_id") % 4 != 0).then(col("value")).otherwise(lit(None)).alias("value"))
    path = _path(events)
    write_ndjson(events, path, "gzip")
    return Frame(events.df.sparkSession.read.schema(events.df.schema).json(path))


@query("select p_partkey, p_size, string_split(p_name, ' ') as words from part where p_size > 10")
def parquet_files(read):
    parts = read("part").select("p_partkey", "p_size", col("p_name").str.split(" ").alias("words"))
    path = _path(parts)
    write_parquet(parts, path)
    return scan_parquet(parts.df.sparkSession, path).filter(col("p_size") > 10)


# User functions and SQL


@query("select o_orderkey, o_custkey % 10 as g, o_orderstatus || '!' as s from orders")
def map_rows_of_found_schema(read):
    return read("orders").select("o_orderkey", "o_custkey", "o_orderstatus").map_rows(lambda r: {"o_orderkey": r["o_orderkey"], "g": r["o_custkey"] % 10, "s": r["o_orderstatus"] + "!"})


@query("select o_orderkey, o_totalprice * 2 as twice from orders")
def map_batches_expression(read):
    double = lambda b: pa.RecordBatch.from_arrays([pc.multiply(b.column(0), 2.0)], ["x"])
    return read("orders").select("o_orderkey", map_batches(["o_totalprice"], double, "float64").alias("twice"))


@query("select c_custkey, upper(c_mktsegment) as seg from customer")
def map_rows(read):
    return read("customer").map_rows(lambda r: {"c_custkey": r["c_custkey"], "seg": r["c_mktsegment"].upper()}, "c_custkey long, seg string")


@query("select n_name, r_name, count(*) as n from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by all")
def sql_context(read):
    tables = {t: read(t) for t in ("customer", "nation", "region")}
    spark = tables["nation"].df.sparkSession
    return SQLContext(spark, tables).execute("select n_name, r_name, count(*) as n from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey group by n_name, r_name order by n desc")


@query("select n_regionkey as k from nation intersect select r_regionkey from region")
def sql_sets(read):
    tables = {t: read(t) for t in ("nation", "region")}
    return SQLContext(tables["nation"].df.sparkSession, tables).execute("with a as (select n_regionkey as k from nation) select k from a intersect select r_regionkey from region")
