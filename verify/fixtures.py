"""Inputs of the registered queries, derived from the driver's tables.

Each text is one SELECT that Spark and DuckDB both run, so a query and its oracle start from the same rows.
Dirty cases are planted on purpose: null tonnage, equal grades, shifts without scheduled hours, null operated
hours, trucks without a dimension row, negative prices, zeros that mean "not published", totals that do not add
up, sheets without a header, and one sheet with a third of all ledger rows.

Measures are multiples of powers of two. Their sums are then exact in any order, so both engines round the same
number, and a difference is a difference in meaning.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.session import tasks

# Types of the driver's tables, so that a read needs no job to find them.
DRIVER_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

SQL: dict[str, str] = {}

SQL["fx_telemetry"] = """
select event_id as record_id,
  case user_id % 3 when 0 then 'Andina' when 1 then 'Los Bronces' else 'El Teniente' end as site, ts,
  case when extract(hour from ts) >= 8 and extract(hour from ts) < 20 then 'Día' else 'Noche' end as shift,
  case when event_id % 97 = 0 then null else 50e0 + floor(value * 8) / 8e0 end as tons,
  0.5e0 + floor(value) / 1024e0 as feed,
  case when event_id % 103 = 0 then 0.25e0 else cast(24 + event_id % 13 as double) end as conc,
  case when event_id % 101 = 0 then 0.5e0 + floor(value) / 1024e0
       else (0.5e0 + floor(value) / 1024e0) * cast(12 + event_id % 10 as double) / 128e0 end as tail,
  cast(30 + event_id % 17 as double) as dose, cast(72 + event_id % 20 as double) / 8e0 as ph
from events
"""

# The same rows on the maintenance calendar, for the shift join.
SQL["fx_telemetry_shift"] = """
select record_id, site, cast(date '1995-01-02' + cast(record_id % 2400 as int) as date) as day,
  case when cast(floor(record_id / 3) as bigint) % 2 = 0 then 'Día' else 'Noche' end as shift,
  tons, feed, conc, tail
from fx_telemetry
"""

# Grain (truck, day, shift) by the group-by; eight-hour shifts.
SQL["fx_maintenance"] = """
select min(l_orderkey * 8 + l_linenumber) as record_id,
  case l_suppkey % 3 when 0 then 'Andina' when 1 then 'Los Bronces' else 'El Teniente' end as site,
  concat('T', cast(l_suppkey as string)) as truck, cast(l_shipdate as date) as day,
  case l_linestatus when 'O' then 'Día' else 'Noche' end as shift,
  cast(case when max(l_quantity) = 50 then 0 else 8 end as double) as sched_h,
  case when min(l_quantity) <= 1 then null
       when max(l_tax) > 0.065e0 or max(l_discount) > 0.085e0 then 4e0 else 8e0 end as oper_h,
  cast(max(case when l_tax > 0.065e0 then 4 else 0 end) as double) as maint_h,
  cast(max(case when l_discount > 0.085e0 then 4 else 0 end) as double) as fail_h,
  cast(sum(l_quantity) as double) as cycles, 0.9375e0 as fill
from lineitem group by l_suppkey, cast(l_shipdate as date), l_linestatus
"""

# One truck in ten has no row.
SQL["fx_equipment"] = """
select concat('T', cast(s_suppkey as string)) as truck,
  case s_suppkey % 3 when 0 then 'Andina' when 1 then 'Los Bronces' else 'El Teniente' end as site,
  concat('M', cast(s_suppkey % 4 as string)) as model,
  cast(240 + 41 * (s_suppkey % 4) as double) as cap_t,
  case s_suppkey % 4 when 0 then 1.875e0 when 1 then 2e0 when 2 then 2.5e0 else 3.75e0 end as cyc_h
from supplier where s_suppkey % 10 <> 9
"""

SQL["fx_safety"] = """
select o_orderkey as incident_id,
  case o_custkey % 3 when 0 then 'Andina' when 1 then 'Los Bronces' else 'El Teniente' end as site,
  cast(o_orderdate as date) as day, case when o_orderkey % 2 = 0 then 'Día' else 'Noche' end as shift,
  case when o_orderkey % 5 = 0 then concat('T', cast(o_custkey % 100 as string)) end as truck,
  case when o_orderkey % 29 = 0 then 'casi' else
    case o_orderstatus when 'F' then 'leve' when 'O' then 'grave' else 'fatal' end end as sev,
  substring(o_orderpriority, 3) as kind,
  case when o_orderkey % 11 = 0 then null else floor(o_totalprice / 1000) / 64e0 end as down_h
from orders
"""

# Several rows may share (day, hour, bus); some prices are negative, some are null.
SQL["fx_hourly"] = """
select cast(l_shipdate as date) as day, cast(1 + (l_orderkey * 7 + l_linenumber) % 24 as int) as hour,
  case l_suppkey % 7 when 0 then 'Crucero' when 1 then 'Cardones' when 2 then 'Pan de Azucar' when 3 then 'Quillota'
    when 4 then 'Charrua' when 5 then 'Puerto Montt' else 'Tarapaca' end as bus,
  case when l_orderkey % 89 = 0 then null else floor(l_extendedprice / 16) / 64e0 - 4e0 end as price
from lineitem
"""

# Daily prices whose sums are exact, which a mean of hours is not.
SQL["fx_daily"] = """
select day, bus, max(price) + 4e0 as price_mean, max(case when hour between 11 and 17 then price end) + 4e0 as price_solar,
  max(case when hour > 20 or hour < 8 then price end) + 4e0 as price_night, count(*) as hours
from fx_hourly group by day, bus having max(price) is not null
"""

# The long yearbook, one text per tab. Nations stand for mines, regions for groups.
_TABS: dict[str, str] = {}
_TABS["2.3"] = """
select '2.3' as tab, ord, lvl, label, parent, grp, yr,
  case when label = 'TOTAL PRODUCCIÓN' and yr = 1997 then value + 2e0 else value end as value
from (
  select cast(1 + n_nationkey as int) as ord, 1 as lvl, case when n_nationkey = 7 then 'Otros' else n_name end as label,
    case when r_name = 'ASIA' then 'CODELCO' else 'OTROS PRODUCTORES' end as parent,
    case when r_name = 'ASIA' then 'CODELCO' else 'OTROS PRODUCTORES' end as grp,
    cast(extract(year from o_orderdate) as int) as yr, sum(floor(o_totalprice)) / 65536e0 as value
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
  group by n_nationkey, n_name, r_name, extract(year from o_orderdate)
  union all
  select case when r_name = 'ASIA' then 0 else 30 end, 0,
    case when r_name = 'ASIA' then 'CODELCO' else 'OTROS PRODUCTORES' end, cast(null as string),
    case when r_name = 'ASIA' then 'CODELCO' else 'OTROS PRODUCTORES' end,
    cast(extract(year from o_orderdate) as int), sum(floor(o_totalprice)) / 65536e0
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
  group by case when r_name = 'ASIA' then 0 else 30 end,
    case when r_name = 'ASIA' then 'CODELCO' else 'OTROS PRODUCTORES' end, extract(year from o_orderdate)
  union all
  select 40, 0, 'TOTAL PRODUCCIÓN', cast(null as string), 'TOTAL PRODUCCIÓN',
    cast(extract(year from o_orderdate) as int), sum(floor(o_totalprice)) / 65536e0
  from orders group by extract(year from o_orderdate)
) t
"""
_TABS["2.4"] = """
select '2.4' as tab, cast(l_suppkey % 4 as int) as ord, 0 as lvl,
  case l_suppkey % 4 when 0 then 'Concentradora' when 1 then 'Lixiviación en pilas'
    when 2 then 'Lixiviación ROM y/o dump' else 'Promedio Chile' end as label,
  cast(null as string) as parent, 'Ley' as grp, cast(extract(year from l_shipdate) as int) as yr,
  avg(floor(l_discount * 100)) / 8e0 as value
from lineitem group by l_suppkey % 4, extract(year from l_shipdate)
"""
_TABS["2.5"] = """
select t.tab, cast(n_nationkey as int) as ord, 0 as lvl,
  case when n_nationkey = 9 then 'GMP-10 + Codelco' else n_name end as label,
  cast(null as string) as parent, n_name as grp, cast(extract(year from o_orderdate) as int) as yr,
  case when (n_nationkey + cast(extract(year from o_orderdate) as int)) % 7 = 0 then 0e0
       else sum(floor(o_totalprice)) / 65536e0 / t.k end as value
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join (values (1, '2.5', 1), (1, '2.6', 2)) as t(one, tab, k) on t.one = case when n_nationkey < 10 then 1 end
group by t.tab, t.k, n_name, n_nationkey, extract(year from o_orderdate)
"""
# Totals of 1998 are 5% too high. Subtotal rows, which staging drops, are planted under each process.
_TABS["6.5"] = """
select '6.5' as tab, cast(0 as int) as ord, 1 as lvl, label, parent, parent as grp, yr, value
from (
  select case p_size % 3 when 0 then 'Concentradora' when 1 then 'Fundición' else 'Servicios' end as parent,
    case l_linestatus when 'O' then 'Electricidad' else 'Combustibles' end as label,
    cast(extract(year from l_shipdate) as int) as yr, cast(sum(l_quantity) as double) as value
  from lineitem join part on l_partkey = p_partkey group by p_size % 3, l_linestatus, extract(year from l_shipdate)
  union all
  select case p_size % 3 when 0 then 'Concentradora' when 1 then 'Fundición' else 'Servicios' end, 'Subtotal',
    cast(extract(year from l_shipdate) as int), cast(sum(l_quantity) as double)
  from lineitem join part on l_partkey = p_partkey group by p_size % 3, extract(year from l_shipdate)
  union all
  select 'CONSUMO TOTAL DE ENERGÍA', case l_linestatus when 'O' then 'Electricidad' else 'Combustibles' end,
    cast(extract(year from l_shipdate) as int),
    sum(l_quantity) * case when extract(year from l_shipdate) = 1998 then 1.0625e0 else 1e0 end
  from lineitem group by l_linestatus, extract(year from l_shipdate)
) t
"""
_TABS["6.8"] = """
select t.tab, cast(p_size % 4 as int) as ord, 0 as lvl,
  case p_size % 4 when 0 then 'Mina Rajo' when 1 then 'Mina Subterránea' when 2 then 'LX-SX-EW' else 'Concentradora' end as label,
  cast(null as string) as parent, 'Intensidad' as grp, cast(extract(year from l_shipdate) as int) as yr,
  sum(l_quantity) / t.k as value
from lineitem join part on l_partkey = p_partkey join (values (1, '6.8', 16), (1, '6.9', 64)) as t(one, tab, k) on t.one = case when p_size > 0 then 1 end
group by t.tab, t.k, p_size % 4, extract(year from l_shipdate)
"""
# National rows have a group of their own, so the section must be filled forward by ord.
_TABS["6.3"] = """
select '6.3' as tab, t.ord, case when t.k = 0 then 0 else 1 end as lvl, t.label, cast(null as string) as parent, t.grp, b.yr,
  case t.k when 1 then b.d / 2e0 when 2 then b.x / 4e0 when 3 then b.d + b.x end as value
from (select cast(extract(year from l_shipdate) as int) as yr, avg(floor(l_discount * 100)) as d, avg(floor(l_tax * 100)) as x
      from lineitem group by extract(year from l_shipdate)) b
join (values (1, 1, 'CONSUMO UNITARIO (m3/t)', 'CONSUMO UNITARIO (m3/t)', 0), (1, 2, 'CONCENTRACIÓN', 'CONCENTRACIÓN', 0),
  (1, 3, 'Gran Minería del Cobre', 'CONCENTRACIÓN', 1), (1, 4, 'Mediana Minería del Cobre', 'CONCENTRACIÓN', 2),
  (1, 5, 'TOTAL NACIONAL', 'TOTAL NACIONAL', 3), (1, 6, 'HIDROMETALURGIA', 'HIDROMETALURGIA', 0),
  (1, 7, 'Gran Minería del Cobre', 'HIDROMETALURGIA', 2), (1, 8, 'Mediana Minería del Cobre', 'HIDROMETALURGIA', 1),
  (1, 9, 'TOTAL NACIONAL', 'TOTAL NACIONAL', 2)) as t(one, ord, label, grp, k) on t.one = case when b.yr > 0 then 1 end
"""
_TABS["8.21"] = """
select '8.21' as tab, cast(t.k as int) as ord, 2 as lvl, t.label, b.parent, b.grp, b.yr,
  case t.k when 1 then b.a when 2 then b.mn else b.mx end as value
from (
  select case when c_mktsegment = 'BUILDING' then 'COBRE REFINADO' else 'OTROS METALES' end as grp,
    case when c_mktsegment <> 'BUILDING' then c_mktsegment when r_name = 'EUROPE' then 'Bolsa de Metales de Londres'
      when r_name = 'ASIA' then 'Bolsa de Metales de Shanghai' else r_name end as parent,
    cast(extract(year from o_orderdate) as int) as yr, avg(floor(o_totalprice)) / 1024e0 as a,
    min(floor(o_totalprice)) / 1024e0 as mn, max(floor(o_totalprice)) / 1024e0 as mx
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
  group by case when c_mktsegment = 'BUILDING' then 'COBRE REFINADO' else 'OTROS METALES' end,
    case when c_mktsegment <> 'BUILDING' then c_mktsegment when r_name = 'EUROPE' then 'Bolsa de Metales de Londres'
      when r_name = 'ASIA' then 'Bolsa de Metales de Shanghai' else r_name end, extract(year from o_orderdate)
) b join (values (1, 'Promedio anual', 1), (1, 'Mínimo anual', 2), (1, 'Máximo anual', 3)) as t(one, label, k)
  on t.one = case when b.yr > 0 then 1 end
"""
for _tab, _name in {
    "2.3": "fx_yb_output", "2.4": "fx_yb_grade", "2.5": "fx_yb_index", "6.3": "fx_yb_water", "6.5": "fx_yb_energy",
    "6.8": "fx_yb_intensity", "8.21": "fx_yb_price",
}.items():
    SQL[_name] = _TABS[_tab]
YEARBOOK_PARTS = [n for n in SQL if n.startswith("fx_yb_")]
SQL["fx_yearbook"] = "\nunion all\n".join(
    f"select tab, ord, lvl, label, parent, grp, yr, value, cast(null as string) as value_text, "
    f"cast(null as string) as unit from {n}"
    for n in YEARBOOK_PARTS
)

# One small sheet per customer, one in five without a year header, and ledgers with a row per order: every third
# order lies on one sheet. Cells are text here; `num` is set where the text is a plain number.
SQL["fx_sheet"] = """
select concat('sheet-', cast(c_custkey as string)) as sheet, cast(t.row_num as bigint) as row_num, t.label,
  case when t.row_num = 3 then cast(cast(floor(c_acctbal) as bigint) as string) else t.c1 end as c1, t.c2,
  case when t.row_num = 2 and c_custkey % 5 = 4 then null else t.c3 end as c3
from customer join (values
  (1, 1, 'Table', cast(null as string), cast(null as string), cast(null as string)),
  (1, 2, cast(null as string), '2023', '2024', '2025'), (1, 3, 'GROUP A', '10,5', '11', '12'),
  (1, 4, '     Unit  One (2) / Unit 1', '4', 'n.d.', '5'), (1, 5, '     Unit Two', '6.5', '-', '7'),
  (1, 6, 'GROUP B / Group b', null, null, null), (1, 7, concat(chr(160), chr(160), 'Unit Three'), '3', '7', '8'),
  (1, 8, '        Sub', '1', 's.i.', 'abc'), (1, 9, ' ', '9', '9', '9'), (1, 10, 'TOTAL', '13,5', '18', '20'),
  (1, 11, '(1) note', null, null, null), (1, 12, 'after note', '1', '1', '1')) as t(one, row_num, label, c1, c2, c3)
  on t.one = case when c_custkey >= 0 then 1 end
union all
select concat('ledger-', cast(l.ledger as string)), l.row_num, l.label, l.c1, l.c2, l.c3
from (
  select case when o_orderkey % 3 = 0 then 0 else 1 + o_custkey % 50 end as ledger, 10 + o_orderkey as row_num,
    concat(repeat(' ', cast((o_orderkey * 7 + o_custkey) % 5 * 2 as int)), 'Order ', cast(o_orderkey as string)) as label,
    case when o_orderkey % 13 = 0 then null else cast(cast(floor(o_totalprice) as bigint) as string) end as c1,
    case when o_orderkey % 13 = 0 then null else o_orderpriority end as c2,
    case when o_orderkey % 13 = 0 then null else concat(cast(o_custkey as string), ',5') end as c3
  from orders
  union all
  select ledger, 1, 'Fuente before the header', '1', '2', '3' from (select distinct case when o_orderkey % 3 = 0 then 0 else 1 + o_custkey % 50 end as ledger from orders) d
  union all
  select ledger, 2, null, '2001', '2002', '2003' from (select distinct case when o_orderkey % 3 = 0 then 0 else 1 + o_custkey % 50 end as ledger from orders) d
  union all
  select ledger, 1000000000 + max(row_num), 'Elaborado', null, null, null from (select case when o_orderkey % 3 = 0 then 0 else 1 + o_custkey % 50 end as ledger, o_orderkey as row_num from orders) d group by ledger
  union all
  select ledger, 2000000000 + max(row_num), 'after note', '1', '1', '1' from (select case when o_orderkey % 3 = 0 then 0 else 1 + o_custkey % 50 end as ledger, o_orderkey as row_num from orders) d group by ledger
) l
"""


def needs(text: str) -> list[str]:
    """Fixtures that a text reads, directly or through others, in the order they must be defined."""
    found: list[str] = []

    def visit(t: str) -> None:
        for name in SQL:
            if name not in found and re.search(rf"\b{name}\b", t):
                visit(SQL[name])
                if name not in found:
                    found.append(name)

    visit(text)
    return found


def with_fixtures(text: str) -> str:
    """The SQL text preceded by the fixtures it reads, as common table expressions.

    ``text`` may itself start with ``with``; its expressions are appended to the same list.
    """
    ctes = [f"{name} as ({SQL[name].strip()})" for name in needs(text)]
    body = text.strip()
    if not ctes:
        return body
    if re.match(r"with\s", body, re.I):
        return "with " + ",\n".join(ctes) + ",\n" + re.sub(r"^with\s+", "", body, flags=re.I)
    return "with " + ",\n".join(ctes) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str, spread: dict[str, str] | None = None) -> DataFrame:
    """A fixture as a DataFrame over the driver's Parquet files.

    ``spread`` names driver's tables, with their keys, that are dealt over all tasks first: of a file of few bytes, which
    is read by one task, every row may become many.
    """
    text = with_fixtures(f"select * from {name}")
    frames = {}
    for t in DRIVER_TABLES:
        if re.search(rf"\b(from|join)\s+{t}\b", text):
            frames[t] = spark.read.schema(DRIVER_TABLES[t]).parquet(f"{sf_dir}/{t}.parquet")
            if spread and t in spread:
                frames[t] = frames[t].repartition(tasks(frames[t]), spread[t])
            text = re.sub(rf"\b(from|join)\s+{t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **frames)


def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_sheet as typed sheet rows (sheet, row_num, cells)."""
    flat = table(spark, sf_dir, "fx_sheet", spread={"customer": "c_custkey"})
    cells = [F.struct(F.lit(None).cast("double").alias("num"), F.col("label").alias("txt"))]
    for c in ("c1", "c2", "c3"):
        plain = F.when(F.col(c).rlike(r"^[0-9]+(\.[0-9]+)?$"), F.col(c)).cast("double")
        cells.append(F.struct(plain.alias("num"), F.col(c).alias("txt")))
    return flat.select("sheet", "row_num", F.array(*cells).alias("cells"))
