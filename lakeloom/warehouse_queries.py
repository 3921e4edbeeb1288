"""Queries of the loading operators over forced-branch fixtures, with independent SQL for each."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .context import OPEN_END, LoadContext, moment
from .functions import schemas
from .functions.hashing import hashdiff
from .operators import ods, pit, satellite, scd1, scd2, small
from .plans import models
from .sources import catalog, store

CTX = LoadContext(datetime(2024, 2, 1), "wf_test")
Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        _SQL[f.__name__] = sql
        return f

    return add


def _hash(*columns: str) -> str:
    return "md5(rtrim(" + " || '#' || ".join(f"trim(coalesce(cast({c} as varchar), ''))" for c in columns) + ", '#'))"


NOW, OPEN = "timestamp '2024-02-01 00:00:00'", "timestamp '5999-01-01 00:00:00'"
STAMP = f"{NOW} as dataflow_dttm, 'wf_test' as dataflow_id"
OLD = "timestamp '2024-01-01 00:00:00' as dataflow_dttm, 'wf_old' as dataflow_id"


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _old(df: DataFrame) -> DataFrame:
    return df.withColumns({"dataflow_dttm": moment("2024-01-01 00:00:00"), "dataflow_id": F.lit("wf_old")})


# ---- type 1 ----------------------------------------------------------------------------------

# Every row is on both sides; some keys are turned negative on one side, so that they are new, or missing, on the other.


def _turned(key: str, modulus: int, rest: int) -> str:
    return f"case when {key} % {modulus} = {rest} then -{key} else {key} end as {key}"


_O = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
_T_KEY, _S_KEY = _turned("o_orderkey", 10, 0), _turned("o_orderkey", 10, 1)
_ORDERS = f"""o as (select o_orderkey, o_custkey, o_orderstatus, o_orderdate from orders),
t as (select {_T_KEY}, o_custkey, o_orderstatus, o_orderdate, {OLD} from o),
s as (select {_S_KEY}, o_custkey, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as o_orderstatus, o_orderdate from o)"""


def _orders(spark, sf) -> tuple[DataFrame, DataFrame]:
    o = _read(spark, sf, "orders").select(*_O)
    status = F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus"))
    rest = ("o_custkey", "o_orderstatus", "o_orderdate")
    return _old(o.select(F.expr(_T_KEY), *rest)), o.withColumn("o_orderstatus", status).select(F.expr(_S_KEY), *rest)


@_query(f"""with {_ORDERS},
c as (select s.* from s left join t using (o_orderkey) where t.o_orderkey is null or t.o_orderstatus <> s.o_orderstatus)
select * from t where o_orderkey not in (select o_orderkey from c) union all select *, {STAMP} from c""")
def scd1_upsert(spark, sf):
    return scd1.load(*_orders(spark, sf), scd1.Scd1(("o_orderkey",)), CTX).target


@_query(f"""with {_ORDERS}
select * from t union all select *, {STAMP} from s where o_orderkey not in (select o_orderkey from t)""")
def scd1_append(spark, sf):
    return scd1.load(*_orders(spark, sf), scd1.Scd1(("o_orderkey",), "A"), CTX).target


@_query(f"with {_ORDERS} select *, {STAMP} from s")
def scd1_replace(spark, sf):
    return scd1.load(*_orders(spark, sf), scd1.Scd1(("o_orderkey",), "R"), CTX).target


@_query(f"""with {_ORDERS}
select * from t where o_orderkey not in (select s.o_orderkey from s join t using (o_orderkey) where s.o_custkey <> t.o_custkey)
union all select *, {STAMP} from s where o_orderkey not in (select o_orderkey from t)""")
def scd1_upsert_compare_fields(spark, sf):
    return scd1.load(*_orders(spark, sf), scd1.Scd1(("o_orderkey",), compare=("o_custkey",)), CTX).target


def _moved(spark, sf, moved: str, to: str) -> tuple[DataFrame, DataFrame]:
    t, _ = _orders(spark, sf)
    o = _read(spark, sf, "orders").select(F.expr(_S_KEY), "o_custkey", "o_orderstatus", "o_orderdate")
    return t, o.withColumn("o_orderdate", F.when(F.expr(moved), F.expr(to)).otherwise(F.col("o_orderdate")))


def _partition_sql(moved: str, to: str, seen: str) -> str:
    return f"""with {_ORDERS.split("s as (")[0]}
p as (select {_S_KEY}, o_custkey, o_orderstatus, case when {moved} then {to} else o_orderdate end as o_orderdate from o),
l as (select * from t where {seen}),
c as (select p.*, l.o_orderkey as k, l.o_orderdate as d from p left join l using (o_orderkey)),
f as (select * from c where k is null or d <> o_orderdate)
select t.* from t where not exists (select 1 from f where f.k = t.o_orderkey and f.d = t.o_orderdate)
union all select o_orderkey, o_custkey, o_orderstatus, o_orderdate, {STAMP} from f"""


_LATER, _MARCH = "o_orderdate + interval '50' year", "timestamp '1998-03-01 00:00:00'"


@_query(_partition_sql("day(o_orderdate) >= 16", _LATER, "o_orderdate in (select o_orderdate from p)"))
def scd1_partition_eq(spark, sf):
    return scd1.load(*_moved(spark, sf, "day(o_orderdate) >= 16", _LATER), scd1.Scd1(("o_orderkey",), partition="o_orderdate"), CTX).target


@_query(_partition_sql("true", _MARCH, "o_orderdate >= (select min(o_orderdate) from p)"))
def scd1_partition_ge(spark, sf):
    return scd1.load(*_moved(spark, sf, "true", "timestamp_ntz '1998-03-01 00:00:00'"), scd1.Scd1(("o_orderkey",), partition="o_orderdate", partition_operator=">="), CTX).target


_L = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"]


def _lines(spark, sf, code: int):
    s = _read(spark, sf, "lineitem").select(*_L)
    return scd1.load(CTX.stamped(s.limit(0)), s, scd1.Scd1(("l_orderkey", "l_linenumber"), on_duplicates=code), CTX)


_LINES = f"l as (select {', '.join(_L)} from lineitem), n as (select *, count(*) over (partition by l_orderkey, l_linenumber) as n, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_returnflag, l_shipdate) as r from l)"


@_query(f"with {_LINES} select {', '.join(_L)}, {STAMP} from n where r = 1")
def scd1_dup_keep_first(spark, sf):
    return _lines(spark, sf, scd1.KEEP_FIRST).target


@_query(f"with {_LINES} select {', '.join(_L)}, {STAMP} from n where n = 1")
def scd1_dup_drop_all(spark, sf):
    return _lines(spark, sf, scd1.DROP_ALL).target


@_query(f"with {_LINES} select {', '.join(_L)}, {STAMP} from n")
def scd1_dup_keep_all(spark, sf):
    return _lines(spark, sf, scd1.KEEP_ALL).target


@_query(f"with {_LINES} select 'scd1' as loader_nm, 'NUK' as exception_type_code, l_orderkey, l_linenumber, l_partkey from n where n > 1")
def scd1_exceptions(spark, sf):
    return _lines(spark, sf, scd1.DROP_ALL).exceptions.select("loader_nm", "exception_type_code", "l_orderkey", "l_linenumber", "l_partkey")


# ---- satellite -------------------------------------------------------------------------------

_ATTR = "nullif(event_type, 'error') as attr"
_T_USER, _S_USER = _turned("user_id", 5, 0), _turned("user_id", 5, 1)
# the same events under the target's and the source's user ids
_EV = f"e as (select {_T_USER}, nullif(event_type, 'error') as attr, ts from events), g_s as (select {_S_USER}, nullif(event_type, 'error') as attr, ts from events)"


def _sat(spark, sf, **options):
    e, came = (_read(spark, sf, "events").select(F.expr(user), F.expr(_ATTR), "ts") for user in (_T_USER, _S_USER))
    old = e.where("ts < '2024-01-16' or (user_id % 5 = 2 and ts < '2024-01-20')")
    last = old.groupBy("user_id").agg(F.max(F.struct("ts", "attr")).alias("m"))
    start = F.date_trunc("day", "m.ts").cast("timestamp_ntz") if options.get("by_date", True) else F.col("m.ts")
    t = CTX.stamped(last.select("user_id", "m.attr", start.alias("valid_from_dttm"), F.lit(0).alias("delete_flg")))
    cfg = satellite.Satellite(("user_id",), ("attr",), "ts", **options)
    return satellite.load(t, came.where("ts >= '2024-01-15'"), cfg, CTX)


def _sat_sql(by_date: bool) -> str:
    cut = "date_trunc('day', ts)" if by_date else "ts"
    return f"""with {_EV},
t as (select user_id, arg_max(struct_pack(a := attr), ts).a as attr, max({cut}) as tf from e
      where ts < timestamp '2024-01-16' or (user_id % 5 = 2 and ts < timestamp '2024-01-20') group by user_id),
s as (select user_id, attr, cast({cut} as timestamp) as vf, {_hash('attr')} as h from g_s where ts >= timestamp '2024-01-15'),
j as (select s.*, t.user_id as tk, t.tf, case when t.user_id is not null then {_hash('t.attr')} end as th from s left join t on s.user_id = t.user_id where t.user_id is null or s.vf >= t.tf),
g as (select *, coalesce(vf = tf, false) as same_from, row_number() over (partition by user_id, vf order by h, attr nulls last) as rn from j)"""


_SAT_DELETES = f"select user_id, attr, {NOW} as valid_from_dttm, 1 as delete_flg from t where user_id not in (select user_id from g where tk is not null)"
_SAT_ROLLED = """r as (select *, coalesce(lag(h) over (partition by user_id order by vf, rn), th) as before from g),
f as (select *, row_number() over (partition by user_id, vf order by rn) as first from r where not same_from and not coalesce(h = before, false))"""
_S = ("user_id", "attr", "valid_from_dttm", "delete_flg")


@_query(f"{_sat_sql(True)}, {_SAT_ROLLED} select user_id, attr, vf as valid_from_dttm, 0 as delete_flg from f where first = 1 union all {_SAT_DELETES}")
def sat_rollup(spark, sf):
    return _sat(spark, sf).changes.select(*_S)


@_query(f"{_sat_sql(False)}, {_SAT_ROLLED} select user_id, attr, vf as valid_from_dttm, 0 as delete_flg from f where first = 1 union all {_SAT_DELETES}")
def sat_timestamp_version(spark, sf):
    return _sat(spark, sf, by_date=False).changes.select(*_S)


@_query(f"{_sat_sql(True)} select user_id, attr, vf as valid_from_dttm, 0 as delete_flg from g where not same_from and h is distinct from th and rn = 1 union all {_SAT_DELETES}")
def sat_no_rollup(spark, sf):
    return _sat(spark, sf, roll_up=False).changes.select(*_S)


@_query(f"""{_sat_sql(True)}, {_SAT_ROLLED} select user_id, attr, vf as valid_from_dttm, 0 as delete_flg from f where first = 1 union all {_SAT_DELETES}
union all select user_id, null, timestamp '1970-01-01', null from g where tk is null group by user_id""")
def sat_seed_1970(spark, sf):
    return _sat(spark, sf, seed_1970=True).changes.select(*_S)


@_query(f"""{_sat_sql(True)} select user_id, attr, vf as valid_from_dttm, case when same_from and h is distinct from th then 'KAE' else 'NUK' end as exception_type_code
from g where rn > 1 or (same_from and h is distinct from th)""")
def sat_exceptions(spark, sf):
    return _sat(spark, sf).exceptions.select("user_id", "attr", "valid_from_dttm", "exception_type_code")


@_query(f"{_sat_sql(True)} {_SAT_DELETES}")
def sat_deletes(spark, sf):
    return _sat(spark, sf).changes.where("delete_flg = 1").select(*_S)


# ---- type 2 ----------------------------------------------------------------------------------

_V = ("user_id", "attr", "valid_from_dttm", "valid_to_dttm")


def _last_event(spark, sf, user: str, where: str) -> DataFrame:
    e = _read(spark, sf, "events").select(F.expr(user), F.expr(_ATTR), "ts").where(where)
    return e.groupBy("user_id").agg(F.max(F.struct("ts", "attr")).alias("m")).select("user_id", "m.attr", F.col("m.ts").alias("valid_from_dttm"))


def _scd2_now(spark, sf, **options):
    t = _last_event(spark, sf, _T_USER, "ts < '2024-01-16'").withColumn("valid_to_dttm", moment(OPEN_END))
    s = _last_event(spark, sf, _S_USER, "ts >= '2024-01-15'").select("user_id", "attr")
    return scd2.load(_old(t), s, scd2.Scd2(("user_id",), ("attr",), **options), CTX)


_SCD2_NOW = f"""with {_EV},
t as (select user_id, arg_max(struct_pack(a := attr), ts).a as attr, max(ts) as vf from e where ts < timestamp '2024-01-16' group by user_id),
s as (select user_id, arg_max(struct_pack(a := attr), ts).a as attr from g_s where ts >= timestamp '2024-01-15' group by user_id),
c as (select s.* from s left join t using (user_id) where t.user_id is null or coalesce(s.attr, '') <> coalesce(t.attr, ''))
select user_id, attr, vf as valid_from_dttm, case when user_id in (select user_id from c) then {NOW} - interval 1 microsecond else {OPEN} end as valid_to_dttm from t
union all select user_id, attr, {NOW}, {OPEN} from c"""


@_query(_SCD2_NOW)
def scd2_now(spark, sf):
    return _scd2_now(spark, sf).target.select(*_V)


@_query(f"{_SCD2_NOW} union all select user_id, null, timestamp '1970-01-01', {NOW} - interval 1 microsecond from c where user_id not in (select user_id from t)")
def scd2_seed_1970(spark, sf):
    return _scd2_now(spark, sf, seed_1970=True).target.select(*_V)


def _scd2_eff_sql(target: str, source: str) -> str:
    return f"""with {_EV},
t as (select user_id, attr, ts as tf, coalesce(lead(ts) over (partition by user_id order by ts) - interval 1 microsecond, {OPEN}) as tt, {_hash('attr')} as th from {target}),
s as (select user_id, attr, ts as vf, {_hash('attr')} as h, coalesce(lead(ts) over (partition by user_id order by ts) - interval 1 microsecond, {OPEN}) as vt, min(ts) over (partition by user_id) as mn
      from {source}),
m as (select user_id, min(vf) as f from s group by user_id),
h as (select t.* from t join m using (user_id) where m.f <= t.tf or m.f <= t.tt),
j as (select s.*, h.attr as ta, h.tf, h.tt, case when s.vf = h.tf and s.vt = h.tt and s.h = h.th then '0' when s.vf > h.tf and s.h = h.th then '3'
      when s.vf > h.tf and s.vf = s.mn and s.h <> h.th then '21' when s.h <> h.th or h.tf is null then '1' end as flag
      from s left join h on s.user_id = h.user_id and (s.vf between h.tf and h.tt or s.vt between h.tf and h.tt)),
n as (select user_id, ta as attr, tf as vf, vt, mn from j where flag = '3' union all select user_id, ta, tf, vf - interval 1 microsecond, mn from j where flag = '21'
      union all select user_id, attr, vf, vt, mn from j where flag in ('1', '21')),
u as (select *, row_number() over (partition by user_id, vf, vt order by attr nulls last) as r from n)
select user_id, attr, tf as valid_from_dttm, tt as valid_to_dttm from t where not exists (select 1 from n where n.user_id = t.user_id and t.tt > n.mn
  and (n.vf between t.tf and t.tt or n.vt between t.tf and t.tt or (n.vf < t.tf and n.vf < t.tt)))
union all select user_id, attr, vf, vt from u where r = 1"""


def _scd2_eff(spark, sf, target: str, source: str, **moved) -> DataFrame:
    e, came = (_read(spark, sf, "events").select(F.expr(user), F.expr(_ATTR), "ts") for user in (_T_USER, _S_USER))
    line = Window.partitionBy("user_id").orderBy("ts")
    end = F.coalesce(F.lead("ts").over(line) - F.expr("interval 1 microsecond"), moment(OPEN_END))
    t = e.where(target).select("user_id", "attr", F.col("ts").alias("valid_from_dttm"), end.alias("valid_to_dttm"))
    s = came.where(source).withColumns({"attr": F.coalesce("attr", F.lit("none"))} | moved)
    return scd2.load(_old(t), s, scd2.Scd2(("user_id",), ("attr",), "ts"), CTX).target.select(*_V)


@_query(_scd2_eff_sql("e where ts < timestamp '2024-01-16'", "(select user_id, coalesce(attr, 'none') as attr, ts from g_s where ts >= timestamp '2024-01-14')"))
def scd2_effective(spark, sf):
    return _scd2_eff(spark, sf, "ts < '2024-01-16'", "ts >= '2024-01-14'")


@_query(_scd2_eff_sql("e", "(select user_id, 'late ' || coalesce(attr, 'none') as attr, ts - interval 10 day as ts from g_s where ts >= timestamp '2024-01-20')"))
def scd2_late_arrival(spark, sf):
    """Every user's versions of January; rows of the last ten days arrive ten days back in time and replace what starts after them."""
    return _scd2_eff(spark, sf, "true", "ts >= '2024-01-20'", attr=F.concat(F.lit("late "), F.coalesce("attr", F.lit("none"))), ts=F.col("ts") - F.expr("interval 10 days"))


# ---- point in time ---------------------------------------------------------------------------

_P = ("user_id", "valid_from_dttm", "valid_to_dttm", "click_dttm", "purchase_dttm")


def _pit(spark, sf, where_old: str | None = None, where: str = "true", **options):
    e, held = (_read(spark, sf, "events").select(F.expr(user), "event_type", F.col("ts").alias("valid_from_dttm")) for user in ("user_id" if where_old is None else _S_USER, _T_USER))
    of = lambda kind, w, e=e: e.where(f"event_type = '{kind}'").where(w)
    full = pit.Pit(("user_id",), ("click_dttm", "purchase_dttm"), granularity=options.pop("granularity", "microsecond"), **options)
    if where_old is None:
        return pit.load(None, [of("click", where), of("purchase", where)], full, CTX)
    base = pit.load(None, [of("click", where_old, held), of("purchase", where_old, held)], pit.Pit(("user_id",), ("click_dttm", "purchase_dttm")), CTX).target
    return pit.load(base, [of("click", where), of("purchase", where)], full, CTX)


def _pit_sql(name: str, events: str, granule: str = "microsecond") -> str:
    return f"""{name} as (select user_id, vf as valid_from_dttm, coalesce(lead(vf) over w - interval 1 {granule}, {OPEN}) as valid_to_dttm,
max(c) over (partition by user_id order by vf rows unbounded preceding) as click_dttm, max(p) over (partition by user_id order by vf rows unbounded preceding) as purchase_dttm
from (select user_id, vf, max(c) as c, max(p) as p from {events} group by user_id, vf) window w as (partition by user_id order by vf))"""


def _pit_events(where: str = "true", cut: str = "ts", user: str = "user_id") -> str:
    return f"(select {user}, cast({cut} as timestamp) as vf, case when event_type = 'click' then ts end as c, case when event_type = 'purchase' then ts end as p from events where event_type in ('click', 'purchase') and {where})"


@_query(f"with {_pit_sql('b', _pit_events())} select * from b")
def pit_full(spark, sf):
    return _pit(spark, sf).target.select(*_P)


@_query(f"with {_pit_sql('b', '(select * from ' + _pit_events() + ' union all select distinct user_id, timestamp ' + chr(39) + '1970-01-01' + chr(39) + ', null, null from ' + _pit_events() + ')')} select * from b")
def pit_full_1970(spark, sf):
    return _pit(spark, sf, seed_1970=True).target.select(*_P)


@_query(f"with {_pit_sql('b', _pit_events(cut=chr(100) + 'ate_trunc(' + chr(39) + 'day' + chr(39) + ', ts)'))} select * from b")
def pit_collapse_date(spark, sf):
    return _pit(spark, sf, collapse_to_date=True).target.select(*_P)


@_query(f"with {_pit_sql('b', _pit_events(), 'second')} select * from b")
def pit_granular_second(spark, sf):
    return _pit(spark, sf, granularity="second").target.select(*_P)


_OLD_S, _NEW_S = "valid_from_dttm < '2024-01-16'", "valid_from_dttm >= '2024-01-14'"
_OLD_EV, _NEW_EV = _pit_events("ts < timestamp '2024-01-16'", user=_T_USER), _pit_events("ts >= timestamp '2024-01-14'", user=_S_USER)


@_query(f"with {_pit_sql('b', _OLD_EV)}, {_pit_sql('n', _NEW_EV)} select * from b where user_id not in (select user_id from n) union all select * from n")
def pit_rk_rewrite(spark, sf):
    return _pit(spark, sf, _OLD_S, _NEW_S, load_type="RK_REWRITE").target.select(*_P)


@_query(f"""with {_pit_sql('b', _OLD_EV)}, m as (select user_id, min(vf) as f from {_NEW_EV} group by user_id),
h as (select b.* from b join m using (user_id) where valid_to_dttm >= f),
{_pit_sql('n', '(select * from ' + _NEW_EV + ' union all select user_id, valid_from_dttm, click_dttm, purchase_dttm from h)')},
c as (select n.* from n left join h using (user_id, valid_from_dttm) where h.user_id is null or n.valid_to_dttm <> h.valid_to_dttm or n.click_dttm <> h.click_dttm or n.purchase_dttm <> h.purchase_dttm)
select * from b where not exists (select 1 from c where c.user_id = b.user_id and c.valid_from_dttm = b.valid_from_dttm) union all select * from c""")
def pit_incremental(spark, sf):
    return _pit(spark, sf, _OLD_S, _NEW_S, load_type="INCREMENTAL").target.select(*_P)


@_query(f"""with {_pit_sql('b', _OLD_EV)}, m as (select user_id, min(vf) as f from {_NEW_EV} group by user_id),
h as (select b.* from b join m using (user_id) where valid_to_dttm >= f),
{_pit_sql('n', '(select * from ' + _NEW_EV + ' union all select user_id, valid_from_dttm, click_dttm, purchase_dttm from h union all select user_id, timestamp ' + chr(39) + '1970-01-01' + chr(39) + ', null, null from m where user_id not in (select user_id from b))')},
c as (select n.* from n left join h using (user_id, valid_from_dttm) where h.user_id is null or n.valid_to_dttm <> h.valid_to_dttm or n.click_dttm <> h.click_dttm or n.purchase_dttm <> h.purchase_dttm)
select * from b where not exists (select 1 from c where c.user_id = b.user_id and c.valid_from_dttm = b.valid_from_dttm) union all select * from c""")
def pit_incremental_1970(spark, sf):
    return _pit(spark, sf, _OLD_S, _NEW_S, load_type="INCREMENTAL", seed_1970=True).target.select(*_P)


# ---- change capture --------------------------------------------------------------------------

# "X" is a code that no spelling stands for: it goes through as it is
_TYPES = {"signup": "Adjust.Created", "click": "inserted", "error": "deleted", "view": "update", "purchase": "updated"}
_CODES = {"signup": "I", "click": "I", "error": "D", "view": "U", "purchase": "U"}
_CODE_SQL = "case when event_id % 17 = 0 then 'X' " + " ".join(f"when event_type = '{k}' then '{v}'" for k, v in _CODES.items()) + " end"


def _ce(spark, sf, where: str = "true", user: str = "user_id") -> DataFrame:
    e = _read(spark, sf, "events").where(where)
    kind = F.coalesce(F.when(F.col("event_id") % 17 == 0, "X"), *[F.when(F.col("event_type") == k, v) for k, v in _TYPES.items()])
    return e.select(F.expr(user), (F.col("event_id") % 3).alias("attr"), F.col("event_id").alias("ce_version"), F.col("ts").alias("ce_time"), kind.alias("ce_type"))


def _es(spark, sf, where: str, state: DataFrame | None, user: str = "user_id"):
    rows = ods.dedup_events(_ce(spark, sf, where, user), ["user_id"], ["attr"], "ce_version", "ce_type")
    if state is None:
        state = rows.limit(0).select("user_id", "attr", "ce_version", "ce_time", F.lit(0).alias("snp_delete_flg"))
    rows = ods.against_state(rows, state, ["user_id"], ["attr"], "ce_version")
    return rows, ods.merge_state(state, rows, ["user_id"])


def _es_sql(n: str, where: str, state: str | None, user: str = "user_id") -> str:
    joined = f"left join {state} z on f.user_id = z.user_id" if state else "left join (select null::bigint as user_id, null::bigint as ce_version, null::bigint as attr) z on false"
    return f"""e{n} as (select {user}, event_id % 3 as attr, event_id as ce_version, ts as ce_time, {_CODE_SQL} as code from events where {where}),
l{n} as (select *, lag(attr) over w as pa, lag(code) over w as pc from e{n} window w as (partition by user_id order by ce_version)),
k{n} as (select *, case when code = 'I' and pc in ('I', 'U', 'D') then 'U' else code end as code2 from l{n} where pc is null or attr <> pa or code || pc in ('DI', 'DU', 'ID', 'UD')),
f{n} as (select *, row_number() over (partition by user_id order by ce_version) as ra, row_number() over (partition by user_id order by ce_version desc) as rd from k{n}),
c{n} as (select f.user_id, f.attr, f.ce_version, f.ce_time, f.rd, case when code2 = 'U' and ra = 1 and z.user_id is null then 'I' when code2 = 'I' and ra = 1 and z.user_id is not null then 'U' else code2 end as cdc_type_code
  from f{n} f {joined} where f.ce_version > z.ce_version or (z.ce_version is null and code2 in ('I', 'U', 'D'))),
z{n} as ({f'select * from {state} where user_id not in (select user_id from c{n} where rd = 1) union all ' if state else ''}
  select user_id, attr, ce_version, ce_time, case when cdc_type_code = 'D' then 1 else 0 end as snp_delete_flg from c{n} where rd = 1)"""


_A_SQL, _B_SQL = "ts < timestamp '2024-01-16'", "ts >= timestamp '2024-01-14'"
_A, _B = (x.replace("timestamp ", "") for x in (_A_SQL, _B_SQL))


@_query(f"with {_es_sql('1', 'true', None)} select user_id, attr, ce_version, ce_time, cdc_type_code, ce_time as cdc_source_dttm, {NOW} as cdc_target_dttm from c1")
def ods_es_cdc(spark, sf):
    rows, _ = _es(spark, sf, "true", None)
    return ods.change_log(rows, ["user_id"], ["attr"], CTX, "ce_version", "ce_time").drop("dataflow_dttm", "dataflow_id")


@_query(f"with {_es_sql('1', 'true', None)} select * from z1")
def ods_es_snp(spark, sf):
    return _es(spark, sf, "true", None)[1]


@_query(f"with {_es_sql('1', _A_SQL, None, _T_USER)}, {_es_sql('2', _B_SQL, 'z1', _S_USER)} select user_id, attr, ce_version, ce_time, cdc_type_code from c2")
def ods_es_next_cdc(spark, sf):
    return _es(spark, sf, _B, _es(spark, sf, _A, None, _T_USER)[1], _S_USER)[0].select("user_id", "attr", "ce_version", "ce_time", "cdc_type_code")


@_query(f"with {_es_sql('1', _A_SQL, None, _T_USER)}, {_es_sql('2', _B_SQL, 'z1', _S_USER)} select * from z2")
def ods_es_next_snp(spark, sf):
    return _es(spark, sf, _B, _es(spark, sf, _A, None, _T_USER)[1], _S_USER)[1]


_S3_SQL = """e as (select user_id, event_id % 3 as attr, event_id as version from events),
l as (select *, lag(attr) over w as pa, row_number() over w as rn from e window w as (partition by user_id order by version)),
k as (select *, case when rn = 1 then 'I' else 'U' end as cdc_type_code from l where rn = 1 or attr <> pa)"""


def _s3(spark, sf):
    rows = ods.increment_rows(_ce(spark, sf).select("user_id", "attr", F.col("ce_version").alias("version")), ["user_id"], ["attr"], "version")
    state = rows.limit(0).select("user_id", "attr", "version", F.lit(0).alias("snp_delete_flg"))
    rows = ods.against_state(rows, state, ["user_id"], ["attr"], "version")
    return rows, ods.merge_state(state, rows, ["user_id"])


@_query(f"with {_S3_SQL} select user_id, attr, version, cdc_type_code from k")
def ods_s3_cdc(spark, sf):
    return _s3(spark, sf)[0].select("user_id", "attr", "version", "cdc_type_code")


@_query(f"with {_S3_SQL} select user_id, arg_max(attr, version) as attr, max(version) as version, 0 as snp_delete_flg from k group by user_id")
def ods_s3_snp(spark, sf):
    return _s3(spark, sf)[1]


_J = ["o_custkey", "o_orderstatus"]
_JDBC = f"""{_ORDERS}, z as (select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 13 = 0 then 1 else 0 end as snp_delete_flg from t),
c as (select s.o_orderkey, s.o_custkey, s.o_orderstatus, case when z.o_orderkey is null then 'I' else 'U' end as cdc_type_code from s left join (select * from z where snp_delete_flg = 0) z using (o_orderkey)
      where z.o_orderkey is null or s.o_orderstatus <> z.o_orderstatus
      union all select o_orderkey, o_custkey, o_orderstatus, 'D' from z where snp_delete_flg = 0 and o_orderkey not in (select o_orderkey from s))"""


def _jdbc(spark, sf):
    t, s = _orders(spark, sf)
    state = t.select("o_orderkey", *_J, F.when(F.col("o_orderkey") % 13 == 0, 1).otherwise(0).alias("snp_delete_flg"))
    rows = ods.extract_changes(s.select("o_orderkey", *_J), state, ["o_orderkey"], _J)
    return rows, ods.merge_state(state, rows, ["o_orderkey"])


@_query(f"with {_JDBC} select * from c")
def ods_jdbc_cdc(spark, sf):
    return _jdbc(spark, sf)[0]


@_query(f"with {_JDBC} select * from z where o_orderkey not in (select o_orderkey from c) union all select o_orderkey, o_custkey, o_orderstatus, case when cdc_type_code = 'D' then 1 else 0 end from c")
def ods_jdbc_snp(spark, sf):
    return _jdbc(spark, sf)[1]


_JW = ["o_custkey", "o_orderstatus", "o_orderdate"]
_CUT = "o_orderdate > timestamp '1996-01-01 00:00:00' - interval '30' day"


@_query(f"""with {_ORDERS}, z as (select o_orderkey, o_custkey, o_orderstatus, o_orderdate, case when o_orderkey % 13 = 0 then 1 else 0 end as snp_delete_flg from t where {_CUT}), w as (select * from s where {_CUT})
select w.*, case when z.o_orderkey is null then 'I' else 'U' end as cdc_type_code from w left join (select * from z where snp_delete_flg = 0) z using (o_orderkey)
  where z.o_orderkey is null or w.o_orderstatus <> z.o_orderstatus
union all select o_orderkey, o_custkey, o_orderstatus, o_orderdate, 'D' from z where snp_delete_flg = 0 and o_orderkey not in (select o_orderkey from w)""")
def ods_jdbc_window(spark, sf):
    """Both sides limited to the increment's range; keys outside it are neither compared nor deleted."""
    t, s = _orders(spark, sf)
    state = t.select("o_orderkey", *_JW, F.when(F.col("o_orderkey") % 13 == 0, 1).otherwise(0).alias("snp_delete_flg"))
    window = small.cut_filter({"o_orderdate": ("1996-01-01 00:00:00", "TIMESTAMP", 30)})
    return ods.extract_changes(s.select("o_orderkey", *_JW), state, ["o_orderkey"], _JW, window=window)


_WEEKS = ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22")


_WEEK_LIST = ", ".join(f"timestamp '{d}'" for d in _WEEKS)
# every user is in every snapshot, in some of them under another (negative) id
_SNAPSHOTS = f"""u as (select distinct user_id from events), w as (select unnest([{_WEEK_LIST}]) as snap, unnest([0, 1, 2, 3]) as k),
s as (select case when (user_id + k) % 4 = 0 then -user_id - 1 else user_id end as user_id, snap, k, (user_id + k // 2) % 3 as attr from u, w)"""


def _msg_sql(n: str, weeks: str) -> str:
    return f"""l{n} as (select *, lag(attr) over p as pa, lag(k) over p as pk, lead(k) over p as nk, (select max(k) from s where {weeks}) as last from s where {weeks} window p as (partition by user_id order by snap)),
m{n} as (select user_id, attr, snap, case when pk is null or k - pk > 1 then 'I' else 'U' end as code from l{n} where pk is null or k - pk > 1 or attr <> pa
  union all select user_id, attr, (select min(snap) from w where w.k = l{n}.k + 1), 'D' from l{n} where k < last and coalesce(nk, 99) <> k + 1)"""


def _state_sql(log: str) -> str:
    return f"select user_id, arg_max(attr, snap) as attr, max(snap) as snap, case when arg_max(code, snap) = 'D' then 1 else 0 end as snp_delete_flg from {log} group by user_id"


def _snapshots(spark, sf, weeks: range) -> DataFrame:
    users = _read(spark, sf, "events").select("user_id").distinct()
    out = None
    for k in weeks:
        part = users.select(F.when((F.col("user_id") + k) % 4 == 0, -F.col("user_id") - 1).otherwise(F.col("user_id")).alias("user_id"), ((F.col("user_id") + k // 2) % 3).alias("attr"), moment(f"{_WEEKS[k]} 00:00:00").alias("snap"))
        out = part if out is None else out.unionByName(part)
    return out


def _msg(spark, sf, weeks: range, state: DataFrame | None = None):
    rows = ods.snapshot_changes(_snapshots(spark, sf, weeks), ["user_id"], ["attr"], "snap")
    if state is None:
        state = rows.limit(0).select("user_id", "attr", "snap", F.lit(0).alias("snp_delete_flg"))
    rows = ods.against_snapshots(rows, state, ["user_id"], ["attr"], "snap")
    return rows, ods.merge_state(state, rows, ["user_id"])


@_query(f"with {_SNAPSHOTS}, {_msg_sql('1', 'true')} select user_id, attr, snap, code as cdc_type_code from m1")
def ods_msg_cdc(spark, sf):
    return _msg(spark, sf, range(4))[0].select("user_id", "attr", "snap", "cdc_type_code")


@_query(f"with {_SNAPSHOTS}, {_msg_sql('1', 'true')} {_state_sql('m1')}")
def ods_msg_snp(spark, sf):
    return _msg(spark, sf, range(4))[1]


# the second batch repeats the last snapshot of the first one, which is not newer than the state
_MSG_NEXT = f"""{_SNAPSHOTS}, {_msg_sql('1', 'k <= 2')}, z as ({_state_sql('m1')}), {_msg_sql('2', 'k >= 2')},
f as (select *, row_number() over (partition by user_id order by snap, code) as ra from m2),
c as (select f.user_id, f.attr, f.snap, case when f.code = 'I' and z.user_id is not null then 'U' else f.code end as code from f left join z on f.user_id = z.user_id
  where f.snap > (select max(snap) from z) and (f.code = 'D' or f.ra <> 1 or z.user_id is null or f.attr <> z.attr)
  union all select user_id, attr, (select min(snap) from m2), 'D' from z where snp_delete_flg = 0 and user_id not in (select user_id from m2))"""


@_query(f"with {_MSG_NEXT} select user_id, attr, snap, code as cdc_type_code from c")
def ods_msg_next_cdc(spark, sf):
    return _msg(spark, sf, range(2, 4), _msg(spark, sf, range(3))[1])[0].select("user_id", "attr", "snap", "cdc_type_code")


@_query(f"with {_MSG_NEXT} select * from z where user_id not in (select user_id from c) union all {_state_sql('c')}")
def ods_msg_next_snp(spark, sf):
    return _msg(spark, sf, range(2, 4), _msg(spark, sf, range(3))[1])[1]


# ---- watermarks, partitions, dictionaries, hashes -----------------------------------------------


@_query("""select 'event_id' as column_nm, cast(max(event_id) as varchar) as cut_value from events where event_id > 100
union all select 'value_id', '999999999' union all select 'ts', cast(max(ts) as varchar) from events where ts > timestamp '2024-01-20'""")
def cut_advance(spark, sf):
    e = _read(spark, sf, "events").withColumn("value_id", F.col("event_id"))
    return small.advance_cuts(e, {"event_id": ("100", "BIGINT"), "value_id": ("999999999", "BIGINT"), "ts": ("2024-01-20 00:00:00", "TIMESTAMP")})


@_query("select event_id, ts from events where event_id > 0 or ts > timestamp '1970-01-01'")
def cut_default(spark, sf):
    """No mark yet: everything after the first number and the first day."""
    return _read(spark, sf, "events").where(small.cut_filter({"event_id": (None, "BIGINT", 0), "ts": (None, "TIMESTAMP", 0)})).select("event_id", "ts")


@_query("select event_id, ts from events where ts > timestamp '2024-01-25' or event_id > 900")
def cut_filter(spark, sf):
    return _read(spark, sf, "events").where(small.cut_filter({"ts": ("2024-01-25 00:00:00", "TIMESTAMP", 0), "event_id": ("900", "BIGINT", 0)})).select("event_id", "ts")


@_query("select event_id, ts from events where ts > timestamp '2024-01-25' - interval 1 day or event_id > (400 - 10) * 20")
def cut_filter_lag(spark, sf):
    e = _read(spark, sf, "events").withColumn("step", F.col("event_id") / F.lit(20.0))
    return e.where(small.cut_filter({"ts": ("2024-01-25 00:00:00", "TIMESTAMP", 1), "step": ("400", "BIGINT", 10)})).select("event_id", "ts")


@_query("""with m as (select cast(date_trunc('month', min(o_orderdate)) as date) as a, cast(max(o_orderdate) as date) as b from orders),
g as (select cast(a + to_months(cast(k as integer)) as date) as start_dt, cast(a + to_months(cast(k as integer) + 1) as date) as end_dt from m, range(0, 1000) r(k) where k <= ceil((b - a) / 28.0))
select 'p_orders_' || strftime(start_dt, '%Y%m%d') as partition_nm, start_dt, end_dt from g""")
def partition_plan_months(spark, sf):
    return _plan(spark, "orders", small.plan_partitions("orders", *small.span(_read(spark, sf, "orders"), "o_orderdate"), "month"))


def _plan(spark, table: str, plan) -> DataFrame:
    return spark.createDataFrame(plan, "partition_nm string, start_dt date, end_dt date")


@_query("""with m as (select cast(min(ts) as date) as a, cast(max(ts) as date) as b from events),
g as (select cast(a + to_days(cast(k as integer)) as date) as start_dt, cast(a + to_days(cast(k as integer) + 1) as date) as end_dt from m, range(0, 1000) r(k) where k <= b - a)
select 'p_events_' || strftime(start_dt, '%Y%m%d') as partition_nm, start_dt, end_dt from g""")
def partition_plan_days(spark, sf):
    return _plan(spark, "events", small.plan_partitions("events", *small.span(_read(spark, sf, "events"), "ts")))


@_query("""with m as (select cast(min(o_orderdate) as date) as a, cast(max(o_orderdate) as date) as b, date '1996-01-01' as f, date '1996-07-01' as l from orders),
n as (select *, cast(f - to_months(cast(ceil((f - a) / 28.0 / 3) as integer) * 3) as date) as e from m),
g as (select cast(l + to_months(cast(k as integer) * 3) as date) as start_dt, cast(l + to_months(cast(k as integer) * 3 + 3) as date) as end_dt from n, range(0, 1000) r(k) where b >= l and k <= ceil((b - l) / 28.0 / 3)
  union all select cast(e + to_months(cast(k as integer) * 3) as date), cast(e + to_months(cast(k as integer) * 3 + 3) as date) from n, range(0, 1000) r(k) where a < f and k <= ceil((f - e) / 28.0 / 3) and cast(e + to_months(cast(k as integer) * 3) as date) < f)
select 'p_orders_' || strftime(start_dt, '%Y%m%d') as partition_nm, start_dt, end_dt from g""")
def partition_extend_back(spark, sf):
    """The first half of 1996 exists; quarters go on from its end, and whole steps back from its start."""
    return _plan(spark, "orders", small.plan_partitions("orders", *small.span(_read(spark, sf, "orders"), "o_orderdate"), "3 months", (date(1996, 1, 1), date(1996, 7, 1))))


@_query("select cast(min(o_orderdate) as date) as least, cast(max(o_orderdate) as date) as most, 'timestamp_ntz' as kind from orders")
def minmax_partition_column(spark, sf):
    o = _read(spark, sf, "orders")
    return o.agg(F.min("o_orderdate").cast("date").alias("least"), F.max("o_orderdate").cast("date").alias("most"), F.first(F.typeof("o_orderdate")).alias("kind"))


@_query(f"""with {_es_sql('1', 'true', None)}, x as (select c1.*, events.event_type from c1 join events on c1.ce_version = events.event_id)
select distinct 'EVT' as dictionary_code, cast(attr as varchar) as element_code, event_type as source_element_code, event_type as source_element_desc,
case when cdc_type_code = 'D' then 'OBS' else 'USE' end as status_code, 'SRC' as source_system_dk, ce_time as valid_from_dttm from x""")
def udd_register(spark, sf):
    rows, _ = _es(spark, sf, "true", None)
    log = rows.join(_read(spark, sf, "events").select(F.col("event_id").alias("ce_version"), "event_type"), "ce_version")
    return small.registered_elements(log, None, None, "EVT", "attr", "event_type", "event_type", "SRC", "ce_time")


@_query(f"select 'NAT' as dictionary_code, {_hash('n_name')} as element_code, n_name as source_element_code, 'NEW' as status_code, 'SRC' as source_system_dk from (select distinct n_name from nation where n_nationkey >= 5)")
def udd_unregistered(spark, sf):
    """The dictionary knows every nation, most of them by another name."""
    n = _read(spark, sf, "nation")
    known = n.select(F.lit("NAT").alias("dictionary_code"), F.when(F.col("n_nationkey") < 5, F.col("n_name")).otherwise(F.lower("n_name")).alias("source_element_code"))
    return small.unregistered_elements(n, "n_name", known, "NAT", "SRC")


@_query("""select 'EVT' as dictionary_code, cast(event_id % 3 as varchar) as element_code, string_agg(distinct event_type, '$' order by event_type) as element_desc from events group by event_id % 3
union all select 'NAT', 'x', 'kept'""")
def udd_elements(spark, sf):
    """One dictionary's elements rebuilt from its mappings, the others kept."""
    mappings = _read(spark, sf, "events").select(F.lit("EVT").alias("dictionary_code"), (F.col("event_id") % 3).cast("string").alias("element_code"), F.col("event_type").alias("source_element_desc"))
    held = spark.createDataFrame([("EVT", "0", "old"), ("EVT", "9", "gone"), ("NAT", "x", "kept")], "dictionary_code string, element_code string, element_desc string")
    return small.rebuild_elements(held, mappings, "EVT")


@_query("select event_id, case when event_type in ('click', 'view') then 'E_' || event_type else md5(event_type) end as element_code from events")
def udd_apply(spark, sf):
    e = _read(spark, sf, "events").select("event_id", "event_type")
    mappings = spark.createDataFrame([("EVT", "click", "E_old", datetime(2020, 1, 1)), ("EVT", "click", "E_click", datetime(2021, 1, 1)), ("EVT", "view", "E_view", datetime(2020, 1, 1)), ("OTH", "error", "E_x", datetime(2020, 1, 1))], "dictionary_code string, source_element_code string, element_code string, valid_from_dttm timestamp_ntz")
    return small.apply_dictionary(e, "event_type", mappings, "EVT", "element_code").select("event_id", "element_code")


@_query(f"select c_custkey, {_hash('c_name', 'c_mktsegment', 'nullif(c_nationkey, 3)')} as hashdiff from customer")
def hashdiff_rows(spark, sf):
    return _read(spark, sf, "customer").select("c_custkey", hashdiff(["c_name", "c_mktsegment", F.expr("nullif(c_nationkey, 3)")]).alias("hashdiff"))


@_query(f"select event_id, {_CODE_SQL} as code from events")
def status_normalised(spark, sf):
    return _ce(spark, sf).select(F.col("ce_version").alias("event_id"), ods.status_code(F.col("ce_type")).alias("code"))


@_query(f"""select cast(c_custkey as varchar) as dbt_scd_id, c_mktsegment, timestamp '2024-01-01' as dbt_valid_from, case when c_custkey % 3 <> 2 then {NOW} end as dbt_valid_to from customer
union all select cast(c_custkey as varchar) || '-2', 'NEW', {NOW}, null from customer where c_custkey % 3 <> 1""")
def snapshot_merge(spark, sf):
    """Customers by turns: updated (closed, and a new row), deleted (closed), and a new row beside an open one."""
    c = _read(spark, sf, "customer")
    none = F.lit(None).cast("timestamp_ntz")
    key = F.col("c_custkey").cast("string")
    t = c.select(key.alias("dbt_scd_id"), "c_mktsegment", moment("2024-01-01 00:00:00").alias("dbt_valid_from"), none.alias("dbt_valid_to"))
    kinds = F.element_at(F.array(F.array(F.lit("update"), F.lit("insert")), F.array(F.lit("delete")), F.array(F.lit("insert"))), (F.col("c_custkey") % 3 + 1).cast("int"))
    changes = c.select("c_custkey", "c_mktsegment", F.explode(kinds).alias("dbt_change_type"))
    added = F.col("dbt_change_type") == "insert"
    changes = changes.select(F.when(added, F.concat(key, F.lit("-2"))).otherwise(key).alias("dbt_scd_id"), F.when(added, F.lit("NEW")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
                             F.when(added, CTX.clock()).otherwise(moment("2024-01-01 00:00:00")).alias("dbt_valid_from"), F.when(added, none).otherwise(CTX.clock()).alias("dbt_valid_to"), "dbt_change_type")
    return small.merge_snapshot(t, changes)


# ---- schemas, sources, catalog -------------------------------------------------------------------


@_query("""select * from (values ('only left', 'c_acctbal', 'double', null), ('only left', 'c_mktsegment', 'string', null), ('only left', 'c_name', 'string', null), ('only right', 'o_custkey', null, 'bigint'),
('common', 'key', 'bigint', 'bigint'), ('retyped', 'c_nationkey', 'int', 'bigint')) t(state, column_nm, left_type, right_type)""")
def schema_diff(spark, sf):
    """Columns of two sides: in one of them only, in both, or in both with another type."""
    left = _read(spark, sf, "customer").withColumnRenamed("c_custkey", "key").schema
    right = _read(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey", F.col("o_custkey").alias("c_nationkey")).schema
    other = schemas.retyped(right, left)
    rows = [("only left", c, left[c].dataType.simpleString(), None) for c in schemas.missing(left, right)] + [("only right", c, None, right[c].dataType.simpleString()) for c in schemas.missing(right, left)]
    rows += [("retyped", c, *types) for c, types in other.items()] + [("common", c, left[c].dataType.simpleString(), right[c].dataType.simpleString()) for c in schemas.common(left, right, other)]
    return spark.createDataFrame(rows, "state string, column_nm string, left_type string, right_type string")


@_query("""select * from (values ('t', 1, 'id', 'bigserial', 'bigint'), ('t', 2, 'price', 'numeric(10,2)', 'decimal(10,2)'), ('t', 3, 'at', 'timestamp with time zone', 'timestamp'), ('t', 4, 'day', 'date', 'date'),
('t', 5, 'body', 'jsonb', 'string'), ('u', 1, 'x', 'float8', 'double'), ('u', 2, 'y', 'timestamp(6)', 'timestamp_ntz')) t(table_nm, column_index, column_nm, source_type, kept_type)""")
def ddl_type_map(spark, sf):
    return models.registry_rows(spark, {"t": "id bigserial, price numeric(10,2), at timestamp with time zone, day date, body jsonb", "u": "x float8, y timestamp(6)"})


@_query("""select * from (values ('t', 'id', 'bigint', 'bigint', 'SAME'), ('t', 'old', 'int', null, 'GONE'), ('t', 'price', 'int', 'decimal(10,2)', 'RETYPED'), ('t', 'day', null, 'date', 'NEW')) t(table_nm, column_nm, old_type, kept_type, state)""")
def registry_sync(spark, sf):
    """The registry against what is there: a full outer join."""
    return models.registry_sync(models.registry_rows(spark, {"t": "id bigint, old integer, price integer"}), models.registry_rows(spark, {"t": "id bigint, price numeric(10,2), day date"}))


@_query("select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal, c_mktsegment, cast(null as date) as since from customer")
def schema_evolve(spark, sf):
    """A column widened and one added."""
    c = _read(spark, sf, "customer")
    expected = T.StructType([*[T.StructField(f.name, T.LongType() if f.name == "c_nationkey" else f.dataType) for f in c.schema], T.StructField("since", T.DateType())])
    return schemas.evolve(c, expected)


@_query("select o_orderkey, case when o_custkey % 11 = 0 then null else o_custkey end as o_custkey from orders")
def range_scan_union(spark, sf):
    """A table in ranges of a column, as a parallel extract reads it: the first takes nulls too, the last is open."""
    o = _read(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey")).alias("o_custkey"))
    least, most = o.agg(F.min("o_custkey"), F.max("o_custkey")).first()  # one row
    out = None
    for where in store.range_predicates("o_custkey", least, most, 4):
        out = o.where(where) if out is None else out.unionByName(o.where(where))
    return out


@_query("select c_custkey, c_nationkey, c_mktsegment from customer")
def masked_view(spark, sf):
    return catalog.masked(_read(spark, sf, "customer"), ["C_NAME", "c_acctbal"])


@contextmanager
def _database(spark, sf):
    """A database with a table and views of it, for as long as it is looked at; the table's files are the input's."""
    name = f"lakeloom_{uuid.uuid4().hex}"
    spark.sql(f"create database {name}")
    try:
        spark.sql(f"create table {name}.nation using parquet location '{sf}/nation.parquet'")
        catalog.create_view(spark, f"{name}.names", f"select n_nationkey, n_name from {name}.nation")
        catalog.create_view(spark, f"{name}.named", f"select a.n_name from {name}.names a join {name}.nation b on a.n_nationkey = b.n_nationkey")
        yield name
    finally:
        spark.sql(f"drop database {name} cascade")


@_query("""select * from (values ('named', 'VIEW', 'n_name', 1, 'string'), ('names', 'VIEW', 'n_name', 2, 'string'), ('names', 'VIEW', 'n_nationkey', 1, 'int'), ('nation', 'BASE TABLE', 'n_name', 2, 'string'),
('nation', 'BASE TABLE', 'n_nationkey', 1, 'int'), ('nation', 'BASE TABLE', 'n_regionkey', 3, 'int')) t(table_name, table_type, column_name, column_index, column_type)""")
def catalog_columns(spark, sf):
    with _database(spark, sf) as name:
        return catalog.columns(spark, name).drop("table_schema")


@_query("select * from (values ('nation', 'names'), ('names', 'named'), ('nation', 'named')) t(referenced_name, dependent_name)")
def view_lineage(spark, sf):
    with _database(spark, sf) as name:
        return catalog.lineage(spark, name).select("referenced_name", "dependent_name")


@_query("select * from (values ('named', 'VIEW'), ('names', 'VIEW')) t(table_name, table_type)")
def catalog_like(spark, sf):
    with _database(spark, sf) as name:
        return catalog.tables_like(spark, name, like="na%", ilike="%ME%", regex="e[ds]$").drop("table_schema")


@_query("""select unnest(range(1, 16)) as line_nr, unnest(['version: 2', '', 'sources:', '  - name: db', '    tables:', '      - name: named', '        columns:', '          - name: n_name', '            data_type: string', '      - name: names', '        columns:',
'          - name: n_nationkey', '            data_type: int', '          - name: n_name', '            data_type: string']) as line""")
def source_yaml(spark, sf):
    """The description of the database's views, line by line."""
    with _database(spark, sf) as name:
        lines = store.sources_yaml(spark, name).splitlines()
    lines = lines[: lines.index("      - name: nation")]
    return spark.createDataFrame([(k, line.replace(name, "db")) for k, line in enumerate(lines, 1)], "line_nr long, line string")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
