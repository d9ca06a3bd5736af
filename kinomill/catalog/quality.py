"""Registered queries: profiling, quality metrics, series outliers and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import impute, outliers
from ..operators import quality as Q
from ..plans import domain as D
from .views import with_views

AS_OF = "2024-06-30"
_ORDER = ["ts", "event_id"]


def _holed_lines(spark, d):
    key = F.col("l_orderkey")
    return D.table(spark, d, "lineitem").select(
        "l_orderkey",
        F.when(key % 3 != 0, F.col("l_partkey")).alias("l_partkey"),
        F.when(key % 5 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(key % 2 != 0, F.col("l_returnflag")).alias("l_returnflag"),
        "l_shipdate",
    )


def profile_columns(spark, d):
    found = Q.profile(_holed_lines(spark, d))
    return found.select(
        "column",
        "row_count",
        "column_count",
        "distinct_count",
        "value_count",
        *[F.round(c, 4).alias(c) for c in ("mean", "stddev", "min", "max")],
    )


def column_completeness(spark, d):
    return Q.column_completeness(_holed_lines(spark, d)).select("column", F.round("missing_ratio", 6).alias("missing_ratio"))


def relation_completeness(spark, d):
    return Q.relation_completeness(_holed_lines(spark, d)).select(F.round("complete_ratio", 6).alias("complete_ratio"))


def redundancy(spark, d):
    found = Q.redundancy(_holed_lines(spark, d).select("l_partkey", "l_returnflag", "l_quantity"))
    return found.select("row_count", "distinct_rows", F.round("redundancy_factor", 6).alias("redundancy_factor"))


def timeliness(spark, d):
    found = Q.timeliness(D.table(spark, d, "orders"), "o_totalprice", "o_orderdate", as_of=AS_OF)
    return found.select("attribute", F.round("timeliness_score", 9).alias("timeliness_score"))


def missing_dates(spark, d):
    return Q.missing_dates(D.table(spark, d, "orders"), "o_orderdate").select(F.col("day").cast("string").alias("day"))


def missing_dates_dirty(spark, d):
    """Order dates as text, every seventh malformed."""
    written = F.when(F.col("o_orderkey") % 7 == 0, "31.02.1997 ?").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return Q.missing_dates(D.table(spark, d, "orders").select(written.alias("day")), "day").select(F.col("day").cast("string").alias("day"))


def date_coverage(spark, d):
    return Q.date_coverage(D.table(spark, d, "orders"), "o_orderdate").select(F.col("day").cast("string").alias("day"), "present")


def calendar_complete(spark, d):
    found = Q.is_complete_calendar(D.table(spark, d, "events"), "ts")
    return found.select(
        F.col("first_day").cast("string").alias("first_day"),
        F.col("last_day").cast("string").alias("last_day"),
        "days_present",
        F.col("days_missing").cast("bigint").alias("days_missing"),
        "is_complete",
    )


def ts_outliers(spark, d):
    events = D.table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    found = outliers.ts_outliers(events, "value", _ORDER, ["user_id"])
    return found.select("event_id", F.round("increase_value", 6).alias("increase_value"), "is_outlier_value")


def ts_outliers_joined(spark, d):
    """Flags of two columns attached to the base table by key."""
    base = D.table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    flags = outliers.ts_outliers(base, "value", _ORDER, ["user_id"]).select("event_id", "is_outlier_value")
    ids = D.table(spark, d, "events").select("event_id", "event_type")
    return outliers.attach_outlier_flags(ids, flags, ["event_id"])


def _gappy(spark, d):
    missing = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return D.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", missing.alias("value"))


def _values(df):
    return df.select("event_id", F.round("value", 6).alias("value"))


def impute_midpoint(spark, d):
    return _values(impute.impute_midpoint(_gappy(spark, d), _ORDER, ["user_id"], ["value"]))


def impute_linear(spark, d):
    return _values(impute.impute_midpoint(_gappy(spark, d), _ORDER, ["user_id"], ["value"], mode="linear"))


def impute_temporal(spark, d):
    """Some series have no value at all and get the fallback."""
    emptied = _gappy(spark, d).withColumn("value", F.when(F.col("user_id") % 10 != 3, F.col("value")))
    return _values(impute.impute_temporal(emptied, ["value"], _ORDER, ["user_id"]))


def impute_mode(spark, d):
    key = F.col("o_orderkey")
    holed = D.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(key % 9 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 4 == 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return impute.impute_mode(holed)


def _holed_customers(spark, d):
    key = F.col("c_custkey")
    return D.table(spark, d, "customer").select(
        "c_custkey",
        F.when(key % 3 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(key % 4 != 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.lit(None).cast("int").alias("nothing"),
    )


def impute_median(spark, d):
    return impute.impute_numeric(_holed_customers(spark, d), ["c_acctbal", "c_nationkey", "nothing"])


def impute_mean(spark, d):
    filled = impute.impute_numeric(_holed_customers(spark, d), ["c_acctbal", "c_nationkey", "nothing"], strategy="mean", default=-1.0)
    return filled.select("c_custkey", *[F.round(c, 6).alias(c) for c in ("c_acctbal", "c_nationkey", "nothing")])


def distinct_values(spark, d):
    """Values of two columns of the documents, some of them missing."""
    docs = D.table(spark, d, "documents").select("lang", F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("source"))
    return Q.distinct_values(docs)


QUERIES = {
    f.__name__: f
    for f in (
        profile_columns, column_completeness, relation_completeness, redundancy, timeliness, missing_dates, missing_dates_dirty,
        date_coverage, calendar_complete, ts_outliers, ts_outliers_joined, impute_midpoint, impute_linear,
        impute_temporal, impute_mode, impute_median, impute_mean, distinct_values,
    )
}

_HOLED = (
    "with h as (select l_orderkey, case when l_orderkey % 3 <> 0 then l_partkey end as l_partkey, "
    "case when l_orderkey % 5 <> 0 then l_quantity end as l_quantity, "
    "case when l_orderkey % 2 <> 0 then l_returnflag end as l_returnflag, l_shipdate from lineitem) "
)
_COLUMNS = ("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate")
_NUMERIC = ("l_orderkey", "l_partkey", "l_quantity")


def _profile_row(c):
    figures = (
        f"round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as stddev, min({c})::double as min, max({c})::double as max"
        if c in _NUMERIC
        else "null::double, null::double, null::double, null::double"
    )
    return (
        f"select '{c}' as \"column\", count(*) as row_count, 5 as column_count, "
        f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as distinct_count, count({c}) as value_count, {figures} from h"
    )


_OUTLIERS = (
    "with a as (select event_id, user_id, ts, coalesce(value - lag(value) over (partition by user_id order by ts, event_id), 0.0) as inc from events), "
    "b as (select event_id, inc, quantile_disc(inc, 0.25) over w as q1, quantile_disc(inc, 0.75) over w as q3 from a "
    "window w as (partition by user_id order by ts, event_id rows between 6 preceding and current row)), "
    "c as (select event_id, round(inc, 6) as increase_value, inc > q3 + 7.5 * (q3 - q1) as is_outlier_value from b) "
)


def _between_sql(value_of, source="gappy"):
    return with_views(
        "select event_id, round(v, 6) as value from (select event_id, coalesce(value, "
        f"{value_of}, p, n) as v from (select *, "
        "last_value(value ignore nulls) over (w rows between unbounded preceding and 1 preceding) as p, "
        "last_value(case when value is not null then ts end ignore nulls) over (w rows between unbounded preceding and 1 preceding) as pt, "
        "first_value(value ignore nulls) over (w rows between 1 following and unbounded following) as n, "
        "first_value(case when value is not null then ts end ignore nulls) over (w rows between 1 following and unbounded following) as nt "
        f"from {source} window w as (partition by user_id order by ts, event_id)) x) y",
        "gappy",
    )


_MODE = (
    "(select {c} from (select case when {t} then {c} end as {c} from orders) x group by 1 "
    "order by count(*) desc, {c} is null, {c} limit 1)"
)
_STATUS = ("o_orderstatus", "o_orderkey % 9 <> 0")
_PRIORITY = ("o_orderpriority", "o_orderkey % 4 = 0")

ORACLE = {
    "distinct_values": "select 'lang' as \"column\", lang as value, count(*) as n from documents group by lang union all "
    "select 'source', case when doc_id % 5 <> 0 then source end, count(*) from documents group by 2",
    "profile_columns": _HOLED + " union all ".join(_profile_row(c) for c in _COLUMNS),
    "column_completeness": _HOLED
    + " union all ".join(
        f"select '{c}' as \"column\", round(avg(case when {c} is null then 1 else 0 end), 6) as missing_ratio from h" for c in _COLUMNS
    ),
    "relation_completeness": _HOLED
    + "select round(avg(case when l_partkey is not null and l_quantity is not null and l_returnflag is not null then 1 else 0 end), 6) as complete_ratio from h",
    "redundancy": _HOLED + "select count(*) as row_count, (select count(*) from (select distinct l_partkey, l_returnflag, l_quantity from h) x) as distinct_rows, "
    "round(count(*)::double / (select count(*) from (select distinct l_partkey, l_returnflag, l_quantity from h) x), 6) as redundancy_factor from h",
    "timeliness": "select 'o_totalprice' as attribute, round(avg(1 / (1 + (date_diff('day', o_orderdate::date, date '2024-06-30') + 1e-9::double) * 12.0::double)), 9) as timeliness_score from orders",
    "missing_dates": "select cast(cast(d as date) as varchar) as day from (select unnest(generate_series((select min(o_orderdate) from orders), "
    "(select max(o_orderdate) from orders), interval 1 day)) as d) x where cast(d as date) not in (select cast(o_orderdate as date) from orders)",
    "missing_dates_dirty": "with o as (select cast(o_orderdate as date) as t from orders where o_orderkey % 7 <> 0) "
    "select cast(cast(d as date) as varchar) as day from (select unnest(generate_series((select min(t) from o), "
    "(select max(t) from o), interval 1 day)) as d) x where cast(d as date) not in (select t from o)",
    "date_coverage": "select cast(cast(d as date) as varchar) as day, cast(d as date) in (select cast(o_orderdate as date) from orders) as present from "
    "(select unnest(generate_series((select min(o_orderdate) from orders), (select max(o_orderdate) from orders), interval 1 day)) as d) x",
    "calendar_complete": "select cast(min(t) as varchar) as first_day, cast(max(t) as varchar) as last_day, count(distinct t) as days_present, "
    "date_diff('day', min(t), max(t)) + 1 - count(distinct t) as days_missing, date_diff('day', min(t), max(t)) + 1 = count(distinct t) as is_complete "
    "from (select cast(ts as date) as t from events) x",
    "ts_outliers": _OUTLIERS + "select * from c",
    "ts_outliers_joined": _OUTLIERS + "select e.event_id, e.event_type, c.is_outlier_value from events e left join c on c.event_id = e.event_id",
    "impute_midpoint": _between_sql("(p + n) / 2"),
    "impute_linear": _between_sql(
        "p + (n - p) * ((epoch_us(ts) - epoch_us(pt))::double / nullif(epoch_us(nt) - epoch_us(pt), 0)), (p + n) / 2"
    ),
    "impute_temporal": _between_sql("(p + n) / 2").replace("p, n) as v", "p, n, 0.0) as v").replace(
        "from gappy", "from (select * replace (case when user_id % 10 <> 3 then value end as value) from gappy) g"
    ),
    "impute_mode": "select o_orderkey, "
    + ", ".join(
        f"coalesce(case when {t} then {c} end, {_MODE.format(c=c, t=t)}, 'unknown') as {c}" for c, t in (_STATUS, _PRIORITY)
    )
    + " from orders",
    "impute_median": "select c_custkey, case when c_custkey % 3 <> 0 then c_acctbal else (select quantile_disc(c_acctbal, 0.5) from customer where c_custkey % 3 <> 0) end as c_acctbal, "
    "(case when c_custkey % 4 <> 0 then c_nationkey else (select quantile_disc(c_nationkey, 0.5) from customer where c_custkey % 4 <> 0) end) as c_nationkey, 0 as nothing from customer",
    "impute_mean": "select c_custkey, round(case when c_custkey % 3 <> 0 then c_acctbal else (select avg(c_acctbal) from customer where c_custkey % 3 <> 0) end, 6) as c_acctbal, "
    "round(case when c_custkey % 4 <> 0 then c_nationkey else (select avg(c_nationkey) from customer where c_custkey % 4 <> 0) end, 6) as c_nationkey, -1.0::double as nothing from customer",
}
