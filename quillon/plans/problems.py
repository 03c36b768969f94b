"""Queries of the general training-data problems (p2 to p6)."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.common import clean_key, squeezed, table
from quillon.operators.asof import known_as_of
from quillon.operators.control import SUSPECT, implausible_rows
from quillon.operators.grid import regular_grid
from quillon.operators.history import attribute_history
from quillon.operators.instants import ABBREVIATIONS, ABBREVIATIONS_IN, MONTHS, PATTERN, to_instants


def _instants(spark: SparkSession, d: str) -> DataFrame:
    v, z = table(spark, d, "vendor_stamp"), table(spark, d, "exchange_zone")
    return to_instants(
        v, z, raw=v["raw_value"], place=v["mic"], zone_place=z["mic"], tz_name=z["tz_name"], day_first=z["day_first"]
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose raw value names a moment, with that moment."""
    return _instants(spark, d).where("utc_us is not null").select("stamp_id", "utc_us")


def p2_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Every row with its instant as a text, null where the value names none."""
    wall = F.expr("timestamp_ntz '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(cast(utc_us as decimal(18, 0)) / 1000000 as decimal(18, 6)))")
    shown = F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return _instants(spark, d).select("stamp_id", "provider", "field_name", "mic", "raw_value", "utc_us", shown.alias("utc"))


def _grid(spark: SparkSession, d: str) -> DataFrame:
    r, s = table(spark, d, "economic_indicator"), table(spark, d, "indicator_series")
    return regular_grid(
        r, s, series=clean_key(r["series"]), day=r["event_date"], value=r["value"], revision=r["received_at"],
        calendar_series=clean_key(s["series"]), frequency=clean_key(s["frequency"]),
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Periods inside a series' span without a good reading."""
    return _grid(spark, d).where("n_readings = 0").select("series", F.date_format("period_start", "yyyy-MM-dd").alias("period_start"))


def p3_grid(spark: SparkSession, d: str) -> DataFrame:
    """The whole regular grid with observed, filled and missing periods; real numbers have six digits."""
    return _grid(spark, d).withColumns({c: F.round(c, 6) for c in ("fit", "support", "value")})


def _history(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "asset_snapshot")
    return attribute_history(
        s, entity=clean_key(s["composite_figi"]), changed_at=s["last_updated"], received_at=s["received_at"],
        carried={"__sector": F.translate(squeezed(s["sector"]), " ", ""), "active": s["active"]}, stated={"delisted": s["delisted"].cast("date")},
        labels={"sector": ("__sector", squeezed(s["sector"]))},
    ).drop("__sector")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Start of every version of every security."""
    return _history(spark, d).select(
        F.col("entity").alias("composite_figi"), F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss").alias("valid_from")
    )


def p4_history(spark: SparkSession, d: str) -> DataFrame:
    """Every version with its attributes and the time from which and until which it was valid."""
    return _history(spark, d).withColumnRenamed("entity", "composite_figi")


def _implausible(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "eod")
    return implausible_rows(
        e, source=clean_key(e["composite_figi"]), day=e["event_date"], close=e["close"], volume=e["volume"],
        split=e["split_factor"], loaded=e["loaded_at"],
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Stored rows with an implausible close, volume or split factor; suspicions aren't among them."""
    sure = F.size(F.array_except("reasons", F.array(*[F.lit(r) for r in SUSPECT]))) > 0
    return _implausible(spark, d).where(sure).select("eod_id")


def p5_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The same rows with their values and reasons."""
    return _implausible(spark, d).select(
        "eod_id", clean_key(F.col("composite_figi")).alias("composite_figi"), "event_date", "close", "volume", "split_factor", "reasons"
    )


def p5_impossible(spark: SparkSession, d: str) -> DataFrame:
    """The rows that break a physical limit."""
    rows = _implausible(spark, d).where(F.array_contains("reasons", "impossible"))
    return rows.select("eod_id", clean_key(F.col("composite_figi")).alias("composite_figi"), "event_date", "close", "volume", "split_factor")


def _known(spark: SparkSession, d: str, attributes: Sequence[str]) -> DataFrame:
    r, f = table(spark, d, "rating"), table(spark, d, "fundamental")
    filed = f.where(
        (clean_key(f["dimension"]) == "ARQ") & f["date_key"].isNotNull() & F.coalesce(f["date_key"] >= f["report_period"], F.lit(True))
    )
    return known_as_of(
        r, filed, event_key=clean_key(r["composite_figi"]), event_time=r["event_date"], fact_key=clean_key(filed["composite_figi"]),
        known_from=filed["date_key"], precedence=["event_date", "date_key", "fundamental_id"], attributes=attributes,
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Rating and the fundamental row known on its day."""
    return _known(spark, d, []).select("rating_id", F.col("fact.fundamental_id").alias("fundamental_id"))


def p6_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Rating with the measures of the fundamental row known on its day."""
    keep = ["fundamental_id", "event_date", "date_key", "report_period", "revenues", "net_income_common_stock", "total_assets", "total_debt", "equity", "shares_basic", "eps", "price", "market_capitalization"]
    return _known(spark, d, keep).select(
        "rating_id", clean_key(F.col("composite_figi")).alias("composite_figi"), F.col("event_date").alias("rated_on"), "analyst", "rating",
        *[F.col(f"fact.{c}").alias({"event_date": "period_end"}.get(c, c)) for c in keep],
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p2_found, p2_normalized, p3_found, p3_grid, p4_found, p4_history, p5_found, p5_reasons, p5_impossible, p6_found, p6_attributes)
}

_KEY = "upper(nullif(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)), ''))"
_k = lambda c: _KEY.format(c=c)
_GRID_CTE = f"""
good as (select {_k('r.series')} as series, event_date as d from economic_indicator r
         where value is not null and not isnan(value) and not isinf(value) and event_date is not null),
fr as (select {_k('series')} as series, min({_k('frequency')}) as f from indicator_series group by 1),
p as (select distinct g.series, f, case f when 'D' then d when 'B' then d when 'W' then date_trunc('week', d)::date
             when 'M' then date_trunc('month', d)::date else date_trunc('quarter', d)::date end as ps
      from good g join fr using (series) where f in ('D','W','M','Q') or (f = 'B' and isodow(d) < 6)),
span as (select series, f, min(ps) as a, max(ps) as b from p group by 1, 2),
grid as (select series, f, unnest(generate_series(a, b, case f when 'M' then interval 1 month when 'Q' then interval 3 month
                when 'W' then interval 7 day else interval 1 day end))::date as ps from span),
cells as (select * from grid where f <> 'B' or isodow(ps) < 6)"""
_ASOF_CTE = f"""
f as (select *, {_k('composite_figi')} as k from fundamental
      where {_k('dimension')} = 'ARQ' and date_key is not null and coalesce(date_key >= report_period, true)),
hit as (select r.rating_id, r.rowid_ as rid, {_k('r.composite_figi')} as composite_figi, r.event_date as rated_on, r.analyst, r.rating, f.fundamental_id,
          f.event_date as period_end, f.date_key, f.report_period, f.revenues, f.net_income_common_stock, f.total_assets, f.total_debt,
          f.equity, f.shares_basic, f.eps, f.price, f.market_capitalization,
          row_number() over (partition by r.rowid_ order by f.event_date desc nulls last, f.date_key desc, f.fundamental_id desc) as rn
        from (select *, row_number() over () as rowid_ from rating) r join f on f.k = {_k('r.composite_figi')} and f.date_key <= r.event_date)"""
_SECTOR = "nullif(lower(trim(regexp_replace(sector, '[\\s\\x{A0}\\x{2007}\\x{202F}]+', ' ', 'g'))), '')"
_HIST_CTE = f"""
s as (select {_k('composite_figi')} as e, last_updated as t, {_SECTOR} as label, replace({_SECTOR}, ' ', '') as sector, active, cast(delisted as date) as delisted, received_at,
             row_number() over (partition by {_k('composite_figi')}, last_updated order by received_at desc nulls last, {_SECTOR} desc nulls last,
               active desc nulls last, cast(delisted as date) desc nulls last) as rn
      from asset_snapshot where {_k('composite_figi')} is not null and last_updated is not null),
c as (select e, t, label, last_value(sector ignore nulls) over w as sector, last_value(active ignore nulls) over w as active, delisted
      from s where rn = 1 window w as (partition by e order by t rows between unbounded preceding and current row)),
v as (select *, row_number() over w as n, lag(sector) over w as ps, lag(active) over w as pa, lag(delisted) over w as pd
      from c window w as (partition by e order by t)),
x as (select * exclude (label), last_value(case when n = 1 or sector is distinct from ps then label end ignore nulls) over (partition by e order by t rows between unbounded preceding and current row) as label from v),
ver as (select * from x where n = 1 or sector is distinct from ps or active is distinct from pa or delisted is distinct from pd)"""

ORACLE: dict[str, str] = {
    "p3_found": f"with {_GRID_CTE} select series, strftime(ps, '%Y-%m-%d') as period_start from cells anti join p using (series, f, ps)",
    "p4_found": f"with {_HIST_CTE} select e as composite_figi, strftime(t, '%Y-%m-%d %H:%M:%S') as valid_from from ver",
    "p4_history": f"with {_HIST_CTE} select e as composite_figi, t as valid_from, lead(t) over (partition by e order by t) as valid_to, label as sector, active, delisted from ver",
    "p6_found": f"with {_ASOF_CTE} select rating_id, fundamental_id from hit where rn = 1",
    "p6_attributes": f"with {_ASOF_CTE} select * exclude (rn, rid) from hit where rn = 1",
}

_GRID_SQL = f"""with recursive g0 as (select {_k('series')} as s, event_date as d, value::double as v, received_at as r from economic_indicator
  where value is not null and not isnan(value) and not isinf(value) and event_date is not null),
day as (select s, d, v from g0 where s is not null qualify row_number() over (partition by s, d order by r desc nulls last, v desc) = 1),
fr as (select {_k('series')} as s, min({_k('frequency')}) as f from indicator_series where {_k('frequency')} in ('D', 'B', 'W', 'M', 'Q') group by 1),
n as (select day.*, f, (d - date '1970-01-01')::bigint as k from day join fr using (s)),
p0 as (select s, f, d, v, case f when 'D' then k when 'W' then floor((k - 4) / 7)::bigint
    when 'B' then case when isodow(d) < 6 then floor((k - 4) / 7)::bigint * 5 + isodow(d) - 1 end
    when 'M' then year(d) * 12 + month(d) - 1 else year(d) * 4 + quarter(d) - 1 end as i,
  case f when 'W' then date_trunc('week', d)::date when 'M' then date_trunc('month', d)::date when 'Q' then date_trunc('quarter', d)::date else d end as b from n),
p as (select s, f, d, v, i, i + ((d - b) + 0.5::double) / case f when 'W' then 7 when 'M' then ((b + interval 1 month)::date - b) when 'Q' then ((b + interval 3 month)::date - b) else 1 end as at
  from p0 where i is not null),
span as (select s, f, min(i) as a, max(i) as z from p group by 1, 2),
grid as (select s, f, unnest(generate_series(a, z)) as g from span),
near as (select grid.s, grid.f, grid.g, p.i, p.d, p.v, p.at - grid.g - 0.5::double as x, abs(p.at - grid.g - 0.5::double) / 3.0::double as u
  from grid left join p on p.s = grid.s and p.i between grid.g - 4 and grid.g + 4),
wt as (select *, case when u < 1 then (1 - u * u * u) * (1 - u * u * u) * (1 - u * u * u) end as w from near),
m as (select s, f, g, count(*) filter (where i = g) as n_readings, arg_max(v, d) filter (where i = g) as observed, sum(w) as s0, sum(w * w) as ww, sum(w * x) as s1,
  sum(w * x * x) as s2, sum(w * v) as t0, sum(w * x * v) as t1, count(*) filter (where w > 0 and x <= 0) as lt, count(*) filter (where w > 0 and x >= 0) as rt from wt group by 1, 2, 3),
e as (select *, case when s0 > 0 then case when s0 * s2 - s1 * s1 > 1e-9 * s0 * s0 then (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) else t0 / s0 end end as fit,
  coalesce(case when s0 > 0 then s0 * s0 / ww end, 0) as support from m),
st as (select *, case when n_readings > 0 then 'observed' when support >= 2 - 1e-9 and lt > 0 and rt > 0 then 'filled' else 'missing' end as status from e)
select s as series, f as frequency, g as period_index, case f when 'D' then date '1970-01-01' + g::int when 'W' then date '1970-01-05' + (g * 7)::int
    when 'B' then date '1970-01-05' + (floor(g / 5) * 7 + g % 5)::int when 'M' then make_date((g // 12)::int, (g % 12 + 1)::int, 1) else make_date((g // 4)::int, (g % 4 * 3 + 1)::int, 1) end as period_start,
  n_readings, observed, round(fit, 6) as fit, round(support, 6) as support,
  round(case status when 'observed' then observed when 'filled' then fit end, 6) as value, status from st"""

_GROUPS = re.findall(r"\(\?<(\w+)>", PATTERN)
_ABBREVIATIONS = ", ".join(f"('{k}', {v})" for k, v in ABBREVIATIONS.items())
_SPECIAL = ", ".join(f"('{tz}', '{k}', {v})" for tz, own in ABBREVIATIONS_IN.items() for k, v in own.items())
_join = lambda *names: "concat(" + ", ".join(f"g.{n}" for n in names) + ")"
_int = lambda text: f"try_cast(nullif({text}, '') as int)"
_INSTANT_SQL = f"""with zone as (select {_k('mic')} as m, max(struct_pack(tz := tz_name, df := day_first)) as z from exchange_zone where {_k('mic')} is not null group by 1),
t as (select v.*, coalesce(z.tz, 'America/New_York') as tz, coalesce(z.df, false) as df,
  regexp_extract(trim(raw_value, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(8199) || chr(8239) || chr(65279)), '{PATTERN.replace("(?<", "(?P<")}', {_GROUPS}) as g
  from vendor_stamp v left join zone on zone.m = {_k('mic')}),
q as (select *, {_join('y6', 'y8', 'ym', 'yi', 'yw', 'yo', 'ys', 'y3', 'yd', 'yn', 'yf')} as yt, {_int('g.s1')} as s1, {_int('g.s2')} as s2,
  list_position({list(MONTHS)}, upper(left({_join('mn', 'mf')}, 3))) as mname, {_int(_join('m6', 'm8', 'mm', 'mi', 'ms1', 'md'))} as mnum,
  {_int(_join('d8', 'di', 'ds', 'dd', 'dn', 'df'))} as dnum, {_int(_join('hc', 'h'))} as h0, {_int(_join('nc', 'n'))} as mi, coalesce({_int(_join('sc', 's'))}, 0) as se,
  coalesce(try_cast(rpad(nullif(left({_join('fc', 'f')}, 6), ''), 6, '0') as int), 0) as us, lower(g.ap) as ap, upper({_join('zc', 'z')}) as zt, {_join('zc', 'z')} as zraw, g.zone as named,
  coalesce(try_cast(nullif(g.us, '') as bigint), try_cast(nullif(g.ms, '') as bigint) * 1000, try_cast(nullif(g.sec, '') as bigint) * 1000000) as epoch from t),
c as (select *, case when length(yt) = 2 then try_cast(yt as int) + 2000 when try_cast(yt as int) >= 1 then try_cast(yt as int) end as y,
  coalesce(mnum, mname, case when df then s2 else s1 end) as mo, coalesce(dnum, case when df then s1 else s2 end, 1) as dy,
  case when ap = '' then h0 when h0 between 1 and 12 then h0 % 12 + case when ap = 'p' then 12 else 0 end end as h from q),
e as (select *, case when g.ww <> '' then case when try_cast(coalesce(nullif(g.wd, ''), '1') as int) between 1 and 7 and try_cast(g.ww as int) >= 1
      and isoyear(try_cast(y || '-01-04' as date) - (isodow(try_cast(y || '-01-04' as date)) - 1)::int + ((try_cast(g.ww as int) - 1) * 7)::int + 3) = y
      then try_cast(y || '-01-04' as date) - (isodow(try_cast(y || '-01-04' as date)) - 1)::int + ((try_cast(g.ww as int) - 1) * 7 + try_cast(coalesce(nullif(g.wd, ''), '1') as int) - 1)::int end
    when g."do" <> '' then case when try_cast(g."do" as int) >= 1 and year(try_cast(y || '-01-01' as date) + (try_cast(g."do" as int) - 1)::int) = y then try_cast(y || '-01-01' as date) + (try_cast(g."do" as int) - 1)::int end
    else try_cast(printf('%04d-%02d-%02d', y, mo, dy) as date) end as day,
  case when h0 is null then 0 when mi between 0 and 59 and se between 0 and 59 and (h between 0 and 23 or (h = 24 and mi = 0 and se = 0 and us = 0))
    then (h * 3600 + mi * 60 + se)::bigint * 1000000 + us end as clock,
  case when named <> '' then named when contains(zraw, '/') then zraw else tz end as region from c),
l as (select e.*, epoch_us(day::timestamp) + clock as local,
  case when left(zt, 1) in ('+', '-') then case when try_cast(substr(zt, 2, 2) as int) <= 18 and try_cast(coalesce(nullif(replace(substr(zt, 4), ':', ''), ''), '0') as int) <= 59
      then (try_cast(substr(zt, 2, 2) as int) * 60 + try_cast(coalesce(nullif(replace(substr(zt, 4), ':', ''), ''), '0') as int)) * case when left(zt, 1) = '-' then -1 else 1 end end
    else coalesce(s.o, a.o) end as offs
  from e left join (values {_ABBREVIATIONS}) a(k, o) on a.k = zt left join (values {_SPECIAL}) s(tz, k, o) on s.k = zt and s.tz = e.tz),
w as (select *, make_timestamp(local) as wall, case when zt = '' or contains(zraw, '/') then case when region in (select name from pg_timezone_names() where contains(name, '/') or name = 'UTC')
    then timezone(region, make_timestamp(local)) end end as zoned from l),
u as (select *, case when epoch is not null then epoch when zt <> '' and not contains(zraw, '/') then local - offs::bigint * 60000000
  when timezone(region, zoned - interval 1 hour) = wall then epoch_us(zoned - interval 1 hour) else epoch_us(zoned) end as utc_us from w)"""

ORACLE |= {
    "p3_grid": _GRID_SQL,
    "p2_found": f"{_INSTANT_SQL} select stamp_id, utc_us from u where utc_us is not null",
    "p2_normalized": f"{_INSTANT_SQL} select stamp_id, provider, field_name, mic, raw_value, utc_us, strftime(make_timestamp(utc_us), '%Y-%m-%dT%H:%M:%S.%fZ') as utc from u",
    "p5_impossible": f"""with b as (select *, {_k('composite_figi')} as k, coalesce(close <= 0, false) or coalesce(volume < 0, false) or coalesce(split_factor <= 0, false) as bad from eod),
        d as (select k, event_date from b where bad and k is not null and event_date is not null group by 1, 2)
        select b.eod_id, b.k as composite_figi, b.event_date, b.close, b.volume, b.split_factor from b join d on b.k = d.k and b.event_date = d.event_date""",
}
