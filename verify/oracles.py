"""What each registered query must return, as SQL over the driver's tables.

Written from the definitions of the tables, not from the Spark code: windows run over whole histories, sheets are
solved with joins and recursion, and so on.
"""

from __future__ import annotations

import re

from lodeworks.operators.quality import Check
from lodeworks.plans import checks
from verify.fixtures import SQL as FIXTURES

# Intermediate results that several oracles share.
VIEWS: dict[str, str] = {}

VIEWS["o_perf"] = """
select day, shift, site, truck, model, cap_t, sched_h, oper_h, maint_h, fail_h, cycles, payload_t, availability, rate_real,
  rate_nominal, case when rate_real / rate_nominal <= 1 then rate_real / rate_nominal else 1e0 end as performance
from (
  select m.day, m.shift, m.site, m.truck, e.model, e.cap_t, m.sched_h, m.oper_h, m.maint_h, m.fail_h, m.cycles,
    m.cycles * e.cap_t * m.fill as payload_t, m.oper_h / nullif(m.sched_h, 0) as availability,
    m.cycles * e.cap_t * m.fill / nullif(m.oper_h, 0) as rate_real, nullif(e.cap_t * e.cyc_h, 0) as rate_nominal
  from fx_maintenance m left join fx_equipment e on e.truck = m.truck
  where m.oper_h is not null)
"""
VIEWS["o_fleet"] = """
select day, shift, site, count(distinct truck) as n_trucks, avg(availability) as availability_mean,
  avg(performance) as performance_mean, sum(sched_h) as sched_total, sum(oper_h) as oper_total, sum(payload_t) as payload_total
from o_perf group by all
"""
VIEWS["o_plant"] = """
select day, shift, site, sum(tons) as processed_total, sum(feed * tons) / nullif(sum(tons), 0) as feed_mean,
  sum(conc * tons) / nullif(sum(tons), 0) as conc_mean, sum(tail * tons) / nullif(sum(tons), 0) as tail_mean
from fx_telemetry_shift where tons is not null group by all
"""
VIEWS["o_safety"] = """
select incident_id, site, day, shift, truck, upper(sev) as sev, kind, coalesce(down_h, 0e0) as down_h,
  cast(coalesce(list_extract([1, 5, 25], list_position(['LEVE', 'GRAVE', 'FATAL'], upper(sev))), 0) as bigint) as points
from fx_safety
"""
VIEWS["o_safety_shift"] = """
select day, shift, site, count(*) as incidents, count(*) filter (where sev in ('GRAVE', 'FATAL')) as serious_incidents,
  sum(down_h) as down_total, cast(sum(points) as bigint) as risk_score
from o_safety group by all
"""
VIEWS["o_kpis"] = """
with mass as (
  select *, case when feed_mean > tail_mean and conc_mean > tail_mean
    then conc_mean * (feed_mean - tail_mean) / (feed_mean * (conc_mean - tail_mean)) end as recovered
  from o_plant),
lost as (select *, coalesce(down_total, 0e0) as down, coalesce(risk_score, 0) as risk from o_safety_shift),
joined as (
  select * from o_fleet left join mass using (day, shift, site) left join lost using (day, shift, site))
select day, shift, site, n_trucks, round(100 * availability_mean, 2) as availability_pct,
  round(100 * performance_mean, 2) as performance_pct, round(100 * (sched_total - coalesce(down, 0e0)) / nullif(sched_total, 0), 2) as quality_pct,
  round(availability_mean * performance_mean * ((sched_total - coalesce(down, 0e0)) / nullif(sched_total, 0)) * 100, 2) as oee_pct,
  round(recovered * 100, 2) as recovery_pct, round(processed_total, 1) as processed_t, round(payload_total, 1) as payload_t,
  coalesce(incidents, 0) as incidents, coalesce(serious_incidents, 0) as serious_incidents, round(coalesce(down, 0e0), 2) as down_h,
  coalesce(risk, 0) as risk_score,
  list_extract(['Bajo', 'Medio', 'Alto', 'Crítico'], 1 + (coalesce(risk, 0) > 0)::int + (coalesce(risk, 0) >= 5)::int + (coalesce(risk, 0) >= 25)::int) as risk_level
from joined
"""
VIEWS["o_failure"] = """
with numbered as (
  select *, (coalesce(fail_h, 0) > 0)::int as failed, count(*) over (partition by truck order by day, shift rows unbounded preceding) as n
  from o_perf),
framed as (
  select a.truck, a.n, sum(b.maint_h) as maint_h_7, sum(b.fail_h) as fail_h_7, avg(b.availability) as availability_7
  from numbered a join numbered b on b.truck = a.truck and b.n between a.n - 6 and a.n group by a.truck, a.n),
since as (
  select a.truck, a.n, a.n - coalesce(max(b.n), 1) as shifts_since_failure
  from numbered a left join numbered b on b.truck = a.truck and b.n <= a.n and b.failed = 1 group by a.truck, a.n),
totals as (
  select a.truck, a.n, sum(b.oper_h::decimal(28, 9))::double as oper_h_total
  from numbered a join numbered b on b.truck = a.truck and b.n <= a.n group by a.truck, a.n)
select x.day, x.shift, x.site, x.truck, x.model, x.cap_t, x.oper_h, oper_h_total, x.maint_h, maint_h_7, x.fail_h, fail_h_7,
  x.availability, availability_7, x.performance, shifts_since_failure, x.failed, y.failed as fails_next_shift
from numbered x join framed using (truck, n) join since using (truck, n) join totals using (truck, n)
  left join numbered y on y.truck = x.truck and y.n = x.n + 1
"""
VIEWS["o_process"] = """
select record_id, site, ts, cast(ts as date) as day, shift, tons, avg(tons) over six as tons_6, feed, lag(feed) over h as feed_lag,
  stddev_samp(feed) over six as feed_sd_6, dose, avg(dose) over six as dose_6, ph, avg(ph) over six as ph_6,
  lag(conc) over h as conc_lag, tail, conc as target_conc,
  case when feed > tail and conc > tail then conc * (feed - tail) / (feed * (conc - tail)) * 100 end as target_recovery
from fx_telemetry where tons is not null
window h as (partition by site order by ts), six as (partition by site order by ts rows between 5 preceding and current row)
"""
VIEWS["o_daily"] = """
select day, bus, round_even(avg(p) * 100, 0) / 100 as price_mean,
  round_even(avg(p) filter (where h >= 10 and h <= 16) * 100, 0) / 100 as price_solar,
  round_even(avg(p) filter (where h >= 20 or h < 7) * 100, 0) / 100 as price_night, count(*) as hours
from (select day, bus, hour - 1 as h, case when price < 0 then 0 else price end as p from fx_hourly) where day is not null and bus is not null group by day, bus
"""
VIEWS["o_price"] = """
select day, cast(year(day) as integer) as yr, cast(month(day) as integer) as mon, bus,
  case when bus in ('Quillota', 'Charrua', 'Puerto Montt') then 'Centro-sur' else 'Norte' end as zone,
  price_mean, price_solar, price_night, hours
from fx_daily where bus <> 'Tarapaca'
"""
VIEWS["o_monthly"] = """
select make_date(yr, mon, 1) as month, bus, max(zone) as zone, count(*) as days, round(avg(price_mean), 2) as price_mean,
  round(avg(price_solar), 2) as price_solar, round(avg(price_night), 2) as price_night,
  round(avg(price_night) - avg(price_solar), 2) as night_solar_gap
from o_price group by yr, mon, bus
"""
VIEWS["o_yearbook"] = """
select tab, cast(ord as integer) as ord, cast(lvl as integer) as lvl, label, parent, grp, yr,
  case when tab in ('2.5', '2.6') then nullif(value, 0) else value end as value, unit
from fx_yearbook
"""
VIEWS["o_mines"] = """
select yr, label as mine, if(grp = 'CODELCO', 'Codelco', 'Privada') as owner, value as output_kt
from o_yearbook where tab = '2.3' and lvl = 1 and value is not null
"""
VIEWS["o_totals"] = """
select yr, max(value) filter (where label = 'CODELCO') as state_kt,
  max(value) filter (where label = 'OTROS PRODUCTORES') as private_kt,
  max(value) filter (where label = 'TOTAL PRODUCCIÓN') as total_kt
from o_yearbook where tab = '2.3' and lvl = 0 group by yr
"""
VIEWS["o_grades"] = """
select yr, max(value) filter (where label = 'Concentradora') as mill_grade,
  max(value) filter (where label = 'Lixiviación en pilas') as heap_grade,
  max(value) filter (where label = 'Lixiviación ROM y/o dump') as dump_grade,
  max(value) filter (where label = 'Promedio Chile') as mean_grade
from o_yearbook where tab = '2.4' group by yr
"""
VIEWS["o_indices"] = """
select yr, entity, max(c) as cost_index, max(p) as productivity_index
from (select yr, label as entity, value as c, null as p from o_yearbook where tab = '2.5'
      union all select yr, label, null, value from o_yearbook where tab = '2.6')
group by yr, entity
"""
VIEWS["o_energy"] = """
select yr, if(parent = 'CONSUMO TOTAL DE ENERGÍA', 'Total', parent) as process, lower(label) as source, value as energy_tj
from o_yearbook where tab = '6.5' and label <> 'Subtotal' and value is not null
"""
VIEWS["o_intensity"] = """
select yr, case label when 'Mina Rajo' then 'Mina rajo' when 'Mina Subterránea' then 'Mina subterránea'
    when 'LX-SX-EW' then 'Lixiviación (SX-EW)' else label end as process,
  max(value) filter (where tab = '6.8') as mj_per_t_metal, max(value) filter (where tab = '6.9') as mj_per_t_material
from o_yearbook where tab in ('6.8', '6.9') group by 1, 2
"""
VIEWS["o_water"] = """
select yr, if(starts_with(section, 'CONCENTRACI'), 'Concentración', 'Hidrometalurgia') as process,
  max(value) filter (where label = 'Gran Minería del Cobre') as large_m3_t,
  max(value) filter (where label = 'Mediana Minería del Cobre') as medium_m3_t,
  max(value) filter (where label = 'TOTAL NACIONAL') as national_m3_t
from (
  select r.yr, r.ord, r.label, r.value, arg_max(s.grp, s.ord) as section
  from o_yearbook r join o_yearbook s on s.tab = '6.3' and s.yr = r.yr and s.ord <= r.ord and s.label <> 'TOTAL NACIONAL'
  where r.tab = '6.3' group by all)
where not starts_with(section, 'CONSUMO UNITARIO') group by 1, 2
"""
VIEWS["o_metal"] = """
select yr, metal, exchange, max(value) filter (where label = 'Promedio anual') as mean_usc_lb,
  max(value) filter (where label = 'Mínimo anual') as min_usc_lb, max(value) filter (where label = 'Máximo anual') as max_usc_lb
from (
  select yr, label, value, if(grp = 'COBRE REFINADO', 'Cobre', parent) as metal,
    case when grp <> 'COBRE REFINADO' or parent like '%Londres' then 'LME' when parent like '%Shanghai' then 'SHFE' else parent end
      as exchange
  from o_yearbook where tab = '8.21')
group by all
"""
VIEWS["o_producer_year"] = """
with placed as (select mine, yr, owner, output_kt, dense_rank() over (partition by mine order by yr) as place from o_mines),
national as (select yr, any_value(total_kt) as total_kt from o_totals group by yr),
index_of as (select yr, entity as mine, max(cost_index) as cost_index, max(productivity_index) as productivity_index from o_indices group by all)
select now.yr, now.mine, now.owner, now.output_kt, round(now.output_kt * 100 / nullif(total_kt, 0), 3) as share_pct,
  now.output_kt - before.output_kt as change_kt, cost_index, productivity_index
from placed as now natural join national
  left join placed as before on before.mine = now.mine and before.place = now.place - 1
  left join index_of on (index_of.yr, index_of.mine) = (now.yr, now.mine)
"""
VIEWS["o_sector"] = """
select t.yr, total_kt as output_kt, state_kt as state_output_kt, round(100 * state_kt / nullif(total_kt, 0), 2) as state_share_pct,
  mill_grade, heap_grade, mean_grade,
  (select sum(energy_tj) from o_energy e where e.yr = t.yr and process = 'Total') as energy_tj,
  (select sum(energy_tj) from o_energy e where e.yr = t.yr and process = 'Total' and source = 'electricidad') as electricity_tj,
  (select sum(energy_tj) from o_energy e where e.yr = t.yr and process = 'Concentradora' and source = 'electricidad')
    as mill_electricity_tj,
  i.mj_per_t_material as mill_mj_per_t, round(i.mj_per_t_material / 3.6e0, 2) as mill_kwh_per_t,
  i.mj_per_t_metal as mill_mj_per_t_metal, wc.national_m3_t as mill_water_m3_t, wh.national_m3_t as leach_water_m3_t,
  x.cost_index, x.productivity_index, m.mean_usc_lb as price_usc_lb
from o_totals t left join o_grades g on g.yr = t.yr
  left join o_intensity i on i.yr = t.yr and i.process = 'Concentradora'
  left join o_water wc on wc.yr = t.yr and wc.process = 'Concentración'
  left join o_water wh on wh.yr = t.yr and wh.process = 'Hidrometalurgia'
  left join o_indices x on x.yr = t.yr and x.entity = 'GMP-10 + Codelco'
  left join o_metal m on m.yr = t.yr and m.metal = 'Cobre' and m.exchange = 'LME'
"""
VIEWS["o_cost"] = """
with power as (
  pivot (select yr, process, energy_tj from o_energy where source = 'electricidad' and process in ('Total', 'Concentradora'))
  on process in ('Total', 'Concentradora') using sum(energy_tj) group by yr),
valued as (
  select yr, bus, count(*) as priced_days, avg(price_mean) as usd,
    (select any_value("Total") from power where power.yr = o_price.yr) * 1e6 / 3600 as mwh,
    (select any_value("Concentradora") from power where power.yr = o_price.yr) * 1e6 / 3600 as mill_mwh,
    (select any_value(total_kt) from o_totals where o_totals.yr = o_price.yr) * 1000 as t
  from o_price where yr in (select yr from power) and yr in (select yr from o_totals)
  group by yr, bus having count(*) > 329)
select yr, bus, priced_days, round(usd, 2) as price, round(mwh, 0) as electricity_mwh, round(mwh * usd / 1e6, 1) as cost_musd,
  round(mill_mwh * usd / 1e6, 1) as mill_cost_musd, round(mwh * usd / nullif(t, 0), 1) as cost_usd_per_t
from valued
"""
VIEWS["o_cells"] = r"""
select sheet, row_num, label, c1, c2, c3, replace(label, chr(160), ' ') as plain,
  try_cast(c1 as double) as n1, try_cast(c2 as double) as n2, try_cast(c3 as double) as n3
from fx_sheet
"""
VIEWS["o_header"] = """
select sheet, header_row, cast(n1 as integer) as y1, cast(n2 as integer) as y2, cast(n3 as integer) as y3
from (
  select *, min(row_num) over (partition by sheet) as header_row from o_cells
  where n1 between 1990 and 2100 and n2 between 1990 and 2100 and n3 between 1990 and 2100
    and n1 = floor(n1) and n2 = floor(n2) and n3 = floor(n3))
where row_num = header_row
"""
VIEWS["o_body"] = r"""
select sheet, row_num, label, indent, row_number() over (partition by sheet order by row_num) as ord, c1, c2, c3, y1, y2, y3
from (
  select c.sheet, c.row_num, c.c1, c.c2, c.c3, h.y1, h.y2, h.y3, length(c.plain) - length(ltrim(c.plain)) as indent,
    trim(regexp_replace(regexp_replace(split_part(c.plain, ' / ', 1), '\(\d+\)', '', 'g'), '\s+', ' ', 'g')) as label
  from o_cells c join o_header h on h.sheet = c.sheet
  where c.row_num > h.header_row and trim(c.plain) <> '' and c.row_num < coalesce((
    select min(n.row_num) from o_cells n where n.sheet = c.sheet and n.row_num > h.header_row
      and regexp_matches(trim(n.plain), '^(\(\d+\)|Fuente|Elaborad|n\.d\.|n\.a\.|Comisi)')), 9000000000000))
"""
VIEWS["o_above"] = """
select b.sheet, b.ord, max(a.ord) as above from o_body b join o_body a
  on a.sheet = b.sheet and a.ord < b.ord and a.indent < b.indent group by all
"""
VIEWS["o_tree"] = """
select sheet, ord, cast(null as bigint) as above, ord as root, 0 as lvl from o_body
  where (sheet, ord) not in (select (sheet, ord) from o_above)
union all
select a.sheet, a.ord, a.above, t.root, t.lvl + 1 from o_above a join o_tree t on t.sheet = a.sheet and t.ord = a.above
"""
VIEWS["o_placed"] = """
select b.*, p.label as parent, r.label as grp, t.lvl
from o_body b join o_tree t on t.sheet = b.sheet and t.ord = b.ord
  join o_body r on r.sheet = b.sheet and r.ord = t.root
  left join o_body p on p.sheet = b.sheet and p.ord = t.above
"""
_MARKS = "('n.d.', 'n.a.', '-', '', 's.i.')"
_NUMBER = f"case when lower(trim({{0}})) not in {_MARKS} then try_cast(replace(trim({{0}}), ',', '.') as double) end"
VIEWS["o_long"] = f"""
select sheet as tab, cast(ord as integer) as ord, lvl, label, parent, grp, yr, {_NUMBER.format('txt')} as value, txt as value_text,
  case sheet when 'ledger-0' then 'kt' when 'sheet-1' then '%' when 'sheet-2' then 'TJ' end as unit,
  coalesce(c1, c2, c3) is not null as filled
from (select *, y1 as yr, c1 as txt from o_placed union all select *, y2, c2 from o_placed union all select *, y3, c3 from o_placed)
"""

RECURSIVE = {"o_tree"}


def needs(text: str) -> list[str]:
    """Views and fixtures that a text reads, in the order they must be defined."""
    known = {**FIXTURES, **VIEWS}
    found: list[str] = []

    def visit(t: str, seen: tuple[str, ...]) -> None:
        for name, definition in known.items():
            if name not in found and name not in seen and re.search(rf"\b{name}\b", t):
                visit(definition, (*seen, name))
                found.append(name)

    visit(text, ())
    return found


def complete(text: str) -> str:
    """The SQL text with all the views it reads as common table expressions."""
    known = {**FIXTURES, **VIEWS}
    names = needs(text)
    if not names:
        return text.strip()
    word = "with recursive" if RECURSIVE & set(names) else "with"
    # Shared views are computed once; DuckDB would otherwise inline some of them many times over.
    return f"{word} " + ",\n".join(f"{n} as {'' if n in RECURSIVE else 'materialized '}({known[n].strip()})" for n in names) + "\n" + text.strip()


# -- suites: a count per declared test ------------------------------------------------------------------


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + value + "'"


def _n_bad(check: Check, relations: dict[str, str]) -> str:
    source, column = relations[check.table], check.columns[0]
    if check.kind == "not_null":
        return f"select count(*) - count({column}) from {source}"
    if check.kind == "accepted_values":
        allowed = ", ".join(_literal(v) for v in check.args["values"])
        return f"select count(*) from {source} where {column} not in ({allowed})"
    if check.kind == "accepted_range":
        low, high = check.args.get("low"), check.args.get("high")
        inside = " and ".join([f"{column} >= {low}"] * (low is not None) + [f"{column} <= {high}"] * (high is not None))
        return f"select count(*) from {source} where not ({inside})"
    if check.kind == "relationships":
        to, where = relations[check.args["to"]], check.args["where"]
        return f"select count(distinct {column}) from {source} where {where} and {column} not in (select {check.args['field']} from {to})"
    named = ", ".join(check.columns)
    keep = f"where {column} is not null" if check.kind == "unique" else ""
    return f"select count(*) from (select {named} from {source} {keep} group by {named} having count(*) > 1)"


def suite_sql(declared: list[Check], relations: dict[str, str]) -> str:
    lines = [
        f"select '{c.table}' as tbl, '{c.kind}' as test, '{','.join(c.columns)}' as col, ({_n_bad(c, relations)}) as n_bad"
        for c in declared
    ]
    return "\nunion all\n".join(lines)


_STAGED_TELEMETRY = "(select * from fx_telemetry where tons is not null)"
_STAGED_MAINTENANCE = "(select * from fx_maintenance where oper_h is not null)"
OPERATIONAL = {
    "stg_telemetry": _STAGED_TELEMETRY,
    "stg_maintenance": _STAGED_MAINTENANCE,
    "stg_safety": "o_safety",
    "equipment": "fx_equipment",
    "equipment_performance": "o_perf",
    "shift_kpis": "o_kpis",
}
YEARBOOK = {
    "stg_yearbook": "o_yearbook",
    "yb_producers": "o_mines",
    "yb_totals": "o_totals",
    "yb_grades": "o_grades",
    "yb_indices": "o_indices",
    "yb_energy": "o_energy",
    "yb_intensity": "o_intensity",
    "yb_water": "o_water",
    "yb_prices": "o_metal",
    "dim_producer": "(select mine, owner from o_mines where mine <> 'Otros' group by all)",
    "producer_year": "o_producer_year",
    "sector_year": "o_sector",
}


def counts_sql(relations: dict[str, str]) -> str:
    return "\nunion all\n".join(f"select '{n}' as tbl, count(*) as n_rows from {r}" for n, r in relations.items())


def histogram_sql(measure: str, bins: int, by: str | None = None) -> str:
    """Bins as ranges [lo, hi), the last one closed, joined by range."""
    group = f"{by} as grp, " if by else ""
    groups = f"(select distinct {by} as grp from o_kpis where {measure} is not null) g," if by else ""
    match = "and v.grp = g.grp" if by else ""
    return f"""
      select {'g.grp,' if by else f"'{measure}' as measure,"} cast(i as integer) as bin, round(b_lo, 6) as bin_lo, round(b_hi, 6) as bin_hi,
        count(v.x) as n
      from {groups} (select i, lo + i * ((hi - lo) / {bins}) as b_lo,
              case when i = {bins - 1} then hi else lo + (i + 1) * ((hi - lo) / {bins}) end as b_hi
            from (select min({measure}) as lo, max({measure}) as hi from o_kpis), range({bins}) r(i)) b
        left join (select {group} {measure} as x from o_kpis) v
          on v.x >= b_lo and (v.x < b_hi or (i = {bins - 1} and v.x <= b_hi)) {match}
      group by all"""


def averages(columns: list[str]) -> str:
    return ", ".join(f"round(avg({c}), 6) as {c}" for c in columns)


_BY_INCIDENT = "if(incidents = 0, 'clean', 'incident')"
_SERIES = ["mill_electricity_tj", "cost_index", "output_kt", "mill_kwh_per_t", "mill_grade"]
_INDEX = "select yr, " + ", ".join(
    f"100 * {c} / nullif((select {c} from o_sector where yr = 1996), 0) as {c}" for c in _SERIES
) + " from o_sector where yr between 1996 and 2001"

_TEXTS: dict[str, str] = {
    "src_csv_roundtrip": "select * from o_daily",
    "dim_equipment": "select * from fx_equipment",
    "sink_roundtrip_counts": counts_sql(
        {
            "raw_telemetry": "fx_telemetry",
            "raw_maintenance": "fx_maintenance",
            "raw_safety": "fx_safety",
            "raw_yearbook": "fx_yearbook",
            "equipment": "fx_equipment",
        }
    ),
    "src_published_types": "select * from fx_yearbook",
    "sink_versions": """select 'first' as version, count(*) as n_rows, cast(sum(hours) as bigint) as hours from o_daily
        union all select 'again', count(*), cast(sum(hours) as bigint) from o_daily
        union all select 'newest', count(*), cast(sum(hours) as bigint) from o_daily where hours > 1""",
    "sink_clustered_filter": "select * from o_perf where site = 'Andina' and day between date '1995-01-01' and date '1996-06-30'",
    "agg_trucks_by_any_grain": """select 'shift' as grain, day, shift, site, count(distinct truck) as n_trucks from o_perf group by day, shift, site
        union all select 'day', day, null, null, count(distinct truck) from o_perf group by day
        union all select 'site', null, null, site, count(distinct truck) from o_perf group by site
        union all select 'all', null, null, null, count(distinct truck) from o_perf""",
    "agg_exact_grades": f"""select site, cast(date_trunc('month', cast(ts as date)) as date) as month, round(fsum(tons / 3 * (feed / 7)), 9) as metal,
        round(fsum(tons / 3), 9) as tons, round(favg(feed / 7), 9) as grade, true as same from {_STAGED_TELEMETRY} group by all""",
    "stg_telemetry": f"select record_id, site, ts, cast(ts as date) as day, shift, tons, feed, conc, tail, dose, ph from {_STAGED_TELEMETRY}",
    "stg_maintenance": f"select * from {_STAGED_MAINTENANCE}",
    "stg_safety": "select * exclude (points) from o_safety",
    "px_stage": "select * from o_price",
    "yb_stage": "select * from o_yearbook",
    "yb_producers": "select * from o_mines",
    "yb_totals": "select * from o_totals",
    "yb_pivot_grade": "select * from o_grades",
    "yb_pivot_index": "select * from o_indices",
    "yb_energy": "select * from o_energy",
    "yb_pivot_intensity": "select * from o_intensity",
    "yb_section_fill": "select * from o_water",
    "yb_pivot_price": "select * from o_metal",
    "fn_safe_divide": "select record_id, oper_h / nullif(sched_h, 0) as ratio from fx_maintenance",
    "fn_recovery": """select record_id, case when feed > tail and conc > tail
        then conc * (feed - tail) / (feed * (conc - tail)) * 100 end as recovery_pct from fx_telemetry""",
    "shift_of_hour": """select cast(hour(ts) as integer) as hr, case when hour(ts) < 8 or hour(ts) >= 20 then 'Noche' else 'Día' end as shift,
        count(*) as n from fx_telemetry group by all""",
    "risk_score": "select incident_id, sev, points from o_safety",
    "risk_band": """select risk_score, case when risk_score = 0 then 'Bajo' when risk_score < 5 then 'Medio'
        when risk_score < 25 then 'Alto' else 'Crítico' end as band, count(*) as n from o_safety_shift group by all""",
    "yb_clean_label": r"""select sheet, row_num, trim(regexp_replace(regexp_replace(split_part(plain, ' / ', 1), '\(\d+\)', '', 'g'),
        '\s+', ' ', 'g')) as label from o_cells where label is not null""",
    "yb_indent": "select sheet, row_num, cast(length(plain) - length(ltrim(plain)) as integer) as indent from o_cells where label is not null",
    "yb_parse_value": "select sheet, row_num, " + ", ".join(f"{_NUMBER.format(c)} as {c}" for c in ("c1", "c2", "c3")) + " from fx_sheet",
    "equipment_performance": "select * from o_perf",
    "equipment_performance_salted": "select model, count(*) as n, sum(cycles) as cycles, max(cap_t) as cap_t from o_perf group by model",
    "dq_capped_unknown": "select site, count(*) as n from o_perf where rate_real / rate_nominal is null group by site",
    "agg_equipment": "select * from o_fleet",
    "agg_telemetry": "select * from o_plant",
    "agg_safety": "select * from o_safety_shift",
    "shift_kpis": "select * from o_kpis",
    "ml_failure_features": "select * from o_failure",
    "ml_failure_features_blocked": "select * from o_failure",
    "ml_failure_features_ranked": "select * from o_failure",
    "ml_failure_streak": "select truck, day, shift, failed, shifts_since_failure from o_failure",
    "ml_label_coverage": """select 'failure' as tbl, count(*) as n_rows, count(fails_next_shift) as labelled,
        cast(null as bigint) as labelled_grade, count(*) filter (where fails_next_shift = 1) as positives from o_failure
      union all select 'process', count(*), count(target_recovery), count(target_conc), null from o_process""",
    "ml_training_rows": """select truck, day, shift, oper_h_total, fail_h_7, shifts_since_failure, fails_next_shift from o_failure
        where fails_next_shift is not null""",
    "px_daily_summary": "select * from o_daily",
    "px_monthly": "select * from o_monthly",
    "px_annual_gated": """select yr, bus, count(*) as priced_days, round(avg(price_mean), 6) as price from o_price group by yr, bus
        having count(*) >= 330""",
    "energy_cost_year": "select * from o_cost",
    "dim_producer": """select mine, owner, min(yr) as first_yr, max(yr) as last_yr, sum(output_kt) as output_total_kt from o_mines
        where mine <> 'Otros' group by mine, owner""",
    "producer_year": "select * from o_producer_year",
    "sector_year": "select * from o_sector",
    "yb_header": "select sheet, header_row, concat_ws(',', y1, y2, y3) as years from o_header",
    "yb_bad_sheets": "select sheet, count(*) as n_rows from fx_sheet where sheet not in (select sheet from o_header) group by sheet",
    "yb_body": "select sheet, cast(ord as integer) as ord, row_num, label, cast(indent as integer) as level_indent from o_body",
    "yb_hierarchy": "select sheet, cast(ord as integer) as ord, label, parent, grp, lvl from o_placed",
    "yb_unpivot": "select * exclude (filled) from o_long",
    "yb_drop_title_rows": "select * exclude (filled) from o_long where filled",
    "dq_not_null": "select record_id, site, tons from fx_telemetry where tons is null",
    "dq_unique": "select truck, count(*) as n_rows from fx_safety where truck is not null group by truck having count(*) > 1",
    "dq_unique_combo": "select day, shift, site, truck, count(*) as n_rows from fx_safety group by all having count(*) > 1",
    "dq_accepted_values": "select incident_id, sev from o_safety where sev = 'CASI'",
    "dq_accepted_range": "select truck, day, shift, oper_h from fx_maintenance where oper_h > 4 or oper_h < 0",
    "dq_relationships": f"""select truck, count(*) as n_rows from {_STAGED_MAINTENANCE} m where cycles > 10
        and not exists (select 1 from fx_equipment e where e.truck = m.truck) group by truck""",
    "dq_negative": "select day, hour, bus, price from fx_hourly where price < 0",
    "dq_negative_hours": "select truck, day, shift, oper_h - 5 as oper_h from o_perf where oper_h < 5",
    "dq_bounds": "select day, shift, site, recovery_pct from o_kpis where recovery_pct not between 0 and 100",
    "dq_kpi_grain": "select day, shift, site, count(*) + 1 as n_rows from o_kpis where incidents > 0 group by all",
    "dq_reconcile_rel": """select p.yr, p.source, p.s as part_sum, t.energy_tj as published
      from (select yr, source, sum(energy_tj) as s from o_energy where process <> 'Total' group by all) p
        join o_energy t on t.process = 'Total' and t.yr = p.yr and t.source = p.source
      where abs(p.s - t.energy_tj) > 0.01e0 * t.energy_tj""",
    "dq_reconcile_abs": """select m.yr, m.owner, m.s as part_sum, if(m.owner = 'Codelco', t.state_kt, t.private_kt) as published
      from (select yr, owner, sum(output_kt) as s from o_mines group by all) m join o_totals t on t.yr = m.yr
      where abs(m.s - if(m.owner = 'Codelco', t.state_kt, t.private_kt)) > 0.5
      union all select yr, 'Total', state_kt + private_kt, total_kt from o_totals where abs(state_kt + private_kt - total_kt) > 0.5""",
    "dq_row_invariants": f"""select 'telemetry' as tbl, cast(record_id as varchar) as row_key from fx_telemetry
        where (feed > tail and conc > feed and tons > 0) is not true
      union all select 'maintenance', concat_ws('|', truck, cast(day as varchar), shift) from {_STAGED_MAINTENANCE}
        where (oper_h >= 0 and oper_h + maint_h + fail_h <= sched_h + 0.000001) is not true""",
    "dq_coverage": """select bus, min(day) as first_day, max(day) as last_day, count(*) as n_rows,
        count(*) filter (where price_mean < 0) as n_negative from o_daily group by bus""",
    "dq_suite": suite_sql(checks.OPERATIONS, OPERATIONAL),
    "dq_suite_features": suite_sql(checks.FEATURES, {"failure_features": "o_failure", "process_features": "o_process"}),
    "dq_suite_prices": suite_sql(
        checks.PRICES, {"stg_price": "o_price", "price_monthly": "o_monthly", "energy_cost_year": "o_cost"}
    ),
    "dq_suite_yearbook": suite_sql(checks.YEARBOOK, YEARBOOK),
    "schema_contract": "select tbl, n_rows, if(tbl = 'equipment', 'tyre_size', '') as missing from ("
    + counts_sql({n: r for n, r in OPERATIONAL.items() if n != "equipment_performance"}) + ")",
    "warehouse_counts": counts_sql(
        {
            **OPERATIONAL, **YEARBOOK, "failure_features": "o_perf", "process_features": _STAGED_TELEMETRY, "stg_price": "o_price",
            "price_monthly": "o_monthly", "energy_cost_year": "o_cost",
        }
    ),
    "rpt_filter": """select day, shift, site, availability_pct, oee_pct, quality_pct, recovery_pct, incidents, risk_level from o_kpis
        where site <> 'Los Bronces' and shift = 'Día' and year(day) between 1996 and 1999""",
    "rpt_filter_domain": """select distinct 'site' as field, site as choice from o_kpis union all select distinct 'shift', shift from o_kpis
        union all select 'first_day', cast(min(day) as varchar) from o_kpis union all select 'last_day', cast(max(day) as varchar) from o_kpis""",
    "rpt_kpi_cards": f"select {averages(['availability_pct', 'oee_pct', 'recovery_pct'])}, cast(sum(incidents) as bigint) as incidents from o_kpis",
    "rpt_daily_trend": "select day, " + averages(["availability_pct", "oee_pct", "performance_pct", "quality_pct", "recovery_pct"])
    + " from o_kpis group by day",
    "rpt_clean_vs_incident": f"select {_BY_INCIDENT} as grp, count(*) as n, "
    + averages(["availability_pct", "performance_pct", "quality_pct", "oee_pct", "recovery_pct"]) + " from o_kpis group by 1",
    "rpt_histogram": histogram_sql("oee_pct", 36) + " union all " + histogram_sql("recovery_pct", 36),
    "rpt_histogram_by_incident": histogram_sql("oee_pct", 33, _BY_INCIDENT),
    "rpt_kpi_stats": " union all ".join(
        f"""select '{c}' as measure, count({c}) as n, min({c}) as min_v, max({c}) as max_v, round(avg({c}), 6) as mean_v,
          round(max({c}) - min({c}), 6) as spread_v from o_kpis"""
        for c in ("oee_pct", "recovery_pct")
    ),
    "rpt_risk_by_score": """select risk_level, risk_score, count(*) as n, max(incidents) as max_incidents, round(avg(oee_pct), 6) as oee_pct
        from o_kpis group by all""",
    "rpt_risk_stats": "select max(incidents) as max_incidents, count(distinct risk_score) as n_scores from o_kpis",
    "rpt_risk_distribution": """select l.risk_level, count(k.day) as n,
          round(100 * count(k.day) / (select count(*) from o_kpis), 6) as share_pct
        from (values ('Bajo'), ('Medio'), ('Alto'), ('Crítico')) l(risk_level) left join o_kpis k using (risk_level) group by l.risk_level""",
    "rpt_high_risk_shifts": """select day, shift, site, incidents, serious_incidents, risk_score, risk_level from o_kpis
        where risk_score >= 5 order by risk_score desc, day, site, shift""",
    "rpt_truck_summary": """select truck, site, model, round_even(avg(availability) * 100 * 10, 0) / 10 as availability_pct,
        round_even(avg(performance) * 100 * 10, 0) / 10 as performance_pct, sum(payload_t) as payload_t
        from o_perf where model is not null group by all""",
    "rpt_base_index": "select yr, " + ", ".join(f"round({c}, 6) as {c}" for c in _SERIES) + f" from ({_INDEX})",
    "rpt_index_last": " union all ".join(
        f"select '{c}' as series, max(yr) as at, round(arg_max({c}, yr), 6) as value from ({_INDEX}) where {c} is not null" for c in _SERIES
    ),
    "rpt_implied_tonnage": """select yr, round(mill_electricity_tj * 1e6 / 3.6e0 / nullif(mill_kwh_per_t, 0) / 1e6, 9) as ore_mt
        from o_sector where yr between 1996 and 2001""",
    "rpt_top_producers": """select mine, owner, output_kt, share_pct from o_producer_year where yr = 1999 and mine <> 'Otros'
        order by output_kt desc, mine limit 15""",
    "rpt_cost_selected": """select yr, bus, cost_usd_per_t, cost_musd from o_cost where bus in ('Crucero', 'Quillota', 'Puerto Montt')""",
    "rpt_zone_monthly": "select month, zone, round(avg(price_solar), 6) as solar, round(avg(price_night), 6) as night from o_monthly group by all",
    "rpt_preview": "select * from o_kpis order by day, site, shift limit 10",
}
_PROCESS = "select * replace (floor(feed_sd_6 * 1e6 + 0.123456e0) / 1e6 as feed_sd_6) from o_process"
_TEXTS["ml_process_features"] = _TEXTS["ml_process_features_bucketed"] = _PROCESS

ORACLES: dict[str, str] = {name: complete(text) for name, text in _TEXTS.items()}
