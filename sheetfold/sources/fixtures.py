"""Stand-in inputs derived from the driver's test tables.

Each view is one SQL text used by both engines: Spark runs it through ``spark.sql`` with the
base tables passed as DataFrames, DuckDB runs it as a CTE in the oracle queries. The views only
shape rows into the schemas the jobs read (display text in sheet cells); every step of a job
runs in the library on top of them.

``{name}`` marks a table reference; identifiers are double-quoted (DuckDB) and become
back-quoted for Spark.
"""

from __future__ import annotations

import os
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetfold.operators.joins import materialize, sized_side
from sheetfold.operators.rowid import dense_index
from sheetfold.sources.grid import any_match

FX_TIMESHEET = """
select event_id, user_id,
  'Timesheet 2026 - ' || c_name || case when user_id % 10 = 0 then '-B ' else '' end as archivo_origen,
  case user_id % 3 when 0 then 'Empresarial' when 1 then 'Desarrollo' else 'Directorio' end as "Sector_Origen",
  cast(event_id as string) as consecutivo,
  case event_id % 8 when 0 then y||'-'||m||'-'||d when 1 then d||'/'||m||'/'||y when 2 then m||'/'||d||'/'||y
    when 3 then y||'-'||m||'-'||d||' 10:00:00' when 4 then d||'-'||m||'-'||y when 5 then ' '||d||'.'||m||'.'||y
    when 6 then d||'/'||m||'/'||substring(y,3,2) when 7 then case when user_id % 4 = 0 then 'pendiente' else '' end end as "Fecha",
  case event_type when 'signup' then 'Proyectos' when 'purchase' then 'Proyectos' when 'view' then 'Interno'
    when 'click' then cast(null as string) else '' end as "Category",
  case when event_id % 5 = 0 then '' else 'sub' end as "Sub-Category",
  case when event_id % 9 = 0 then '' when event_id % 10 = 0 then ' Otro '
    else '2024-' || lpad(cast(user_id % 30 as string),2,'0') || ' - NATION_' || cast(user_id % 30 as string) end as "Proyecto",
  case when event_id % 7 = 0 then '' when event_id % 11 = 0 then '  ' else props end as "Descripción",
  case when event_id % 6 = 0 then '' when event_id % 13 = 0 then 'n/a' else replace(cast(value as string),'.',',') end as "Cantidad de horas",
  'lun' as "Día", 'sin mes' as "Mes"
from (select e.*, c.c_name, case when e.user_id % 5 = 1 then '2026' else cast(year(ts) as string) end as y, lpad(cast(month(ts) as string),2,'0') as m, lpad(cast(day(ts) as string),2,'0') as d
      from {events} e join {customer} c on e.user_id = c.c_custkey) t
"""

FX_RATES = """
select c_name as "Nombre",
  case when c_custkey % 13 = 0 then '' when c_custkey % 17 = 0 then '$ ' || replace(cast(c_acctbal as string),'.',',')
    else replace(cast(c_acctbal as string),'.',',') end as "Costo interno"
from {customer} where c_custkey % 10 <> 3
union all select upper(c_name) as "Nombre", '100,5' as "Costo interno" from {customer} where c_custkey % 29 = 0
union all select c_name, '7' from {customer} where c_custkey % 31 = 0
"""

FX_PROJECTS = """
select case when n_regionkey < 2 then 'Externo' else 'Interno' end as "Tipo de proyecto",
  '2024-' || lpad(cast(n_nationkey as string),2,'0') || ' - ' || n_name || case when n_nationkey = 3 then ' ' else '' end as "Nombre de Proyecto",
  case when n_nationkey % 4 = 0 then 'No' else 'Si' end as "Activo" from {nation}
"""

FX_BUDGET = """
select 'Productividad: ' || case when c_nationkey % 5 = 0 then lpad(cast(c_nationkey as string),4,'0') else '2024-' || lpad(cast(c_nationkey as string),2,'0') end || ' NATION' as file_name,
  c_nationkey as file_ord, c_custkey as row_idx,
  case when c_custkey % 31 = 0 then 'Insertar nombre' when c_custkey % 37 = 0 then '  ' else '  ' || upper(c_name) end as "Nombre completo",
  case when c_custkey % 19 = 0 then 'x' else cast(c_custkey % 200 as string) || ',5' end as "Cantidad de horas" from {customer}
"""

FX_FINANCE = """
select o_orderkey, 'NUEVO P' || lpad(cast(o_custkey % 40 as string),2,'0') as archivo_origen,
  case when o_orderpriority in ('1-URGENT','2-HIGH') then 'Ingreso' else 'Gasto' end as "Tipo_Movimiento",
  case when o_orderkey % 11 = 0 or o_orderkey % 83 = 0 then ' ' else cast(year(o_orderdate) as string) || '-' || lpad(cast(month(o_orderdate) as string),2,'0') || '-' || lpad(cast(day(o_orderdate) as string),2,'0') end as fecha_doc,
  case when o_orderkey % 29 = 0 or o_orderkey % 83 = 0 then '' else 'P' || cast(o_custkey % 40 as string) end as "Proyecto",
  case when o_orderkey % 83 = 0 then chr(160) || ' ' when o_orderstatus = 'F' and o_orderkey % 3 = 0 then chr(160) || 'real' || chr(9)
    when o_orderstatus = 'F' then ' real ' when o_orderstatus = 'O' then 'Proyectado' else 'Anulado' end as "Situación",
  case when o_orderkey % 17 = 0 then '' when o_orderkey % 19 = 0 then 'n/a' when o_orderkey % 23 = 0 then '-' || t
       when o_orderkey % 37 = 0 then '0,00' else '$ ' || t end as "USD",
  case when o_orderkey % 41 = 0 or o_orderkey % 83 = 0 then '' else 'S/ ' || t end as "Monto con Impuestos",
  o_custkey % 40 <> 39 as has_usd
from (select o.*, case when u >= 1000 then cast(cast(floor(u/1000) as bigint) as string) || '.' || lpad(cast(u % 1000 as string),3,'0') else cast(u as string) end || ',' || lpad(cast(cents % 100 as string),2,'0') as t
      from (select *, cast(floor(cents/100) as bigint) as u from (select *, cast(round(o_totalprice*100) as bigint) as cents from {orders}) a) o) b
"""

# Grid views give rows with their order in the sheet: ``part`` (before, in or behind the data), ``ord``
# and the line itself. Each engine numbers a sheet's rows in its own way (see GRID_VIEWS).
FX_GRID_BUDGET = """
select distinct file_name, file_ord, 0 as part, cast(1 as bigint) as ord, ' #REF!|Resumen' as line from {fx_budget}
  union all select distinct file_name, file_ord, 0, cast(2 as bigint), '' from {fx_budget} where file_ord % 2 = 0
  union all select distinct file_name, file_ord, 0, cast(3 as bigint), ' Nombre completo |Cantidad de horas||Cantidad de horas'
      || case when file_ord % 9 = 2 then '|Nota|Nota_1|Nota' else '' end from {fx_budget} where file_ord % 7 <> 6
  union all select file_name, file_ord, 1, row_idx, "Nombre completo" || '|' || "Cantidad de horas"
      || case when row_idx % 10 = 0 then '|#N/A|z|extra' when row_idx % 17 = 0 then '|||e|f|g|h|i|j|k|l' else '' end from {fx_budget}
  union all select distinct file_name, file_ord, 2, cast(1 as bigint), case when file_ord % 2 = 0 then 'Total|999' else 'x|Equipo externo' end from {fx_budget} where file_ord % 5 <> 4
  union all select distinct file_name, file_ord, 2, cast(2 as bigint), 'Externo|1,5' from {fx_budget}
  union all select 'Productividad: corto ' || r_name, 1000 + r_regionkey, 0, cast(1 as bigint), 'Nombre completo|Cantidad de horas' from {region}
  union all select 'Productividad: corto ' || r_name, 1000 + r_regionkey, 2, cast(1 as bigint), 'Total' from {region} where r_regionkey % 2 = 0
"""

FX_GRID_FINANCE = """
select distinct archivo_origen, "Tipo_Movimiento" as tipo, 0 as part, cast(1 as bigint) as ord, 'Reporte||' as line from {fx_finance}
  union all select distinct archivo_origen, "Tipo_Movimiento", 0, cast(2 as bigint) + n_nationkey, 'nota' from {fx_finance}, {nation}
    where n_nationkey < case when archivo_origen = 'NUEVO P07' then 13 when archivo_origen = 'NUEVO P08' then 14 else 0 end
  union all select distinct archivo_origen, "Tipo_Movimiento", 0, cast(90 as bigint),
    case when archivo_origen = 'NUEVO P09' then 'Columna|Otra' when "Tipo_Movimiento" = 'Ingreso' then 'Fecha de emisión del comprobante|Proyecto / Cuenta analítica|Situación del pago|Monto con Impuestos|Monto con Impuestos' || case when has_usd then '|USD' else '' end
         else 'Fecha de factura proveedor|Proyecto|SItuación|MONTO CON IGV|2' || case when has_usd then '|USD' else '' end end
      || case when archivo_origen = 'NUEVO P05' then '|Proyecto B||Proyecto C' else '' end from {fx_finance}
  union all select archivo_origen, "Tipo_Movimiento", 1, o_orderkey, fecha_doc || '|' || "Proyecto" || '|' || "Situación" || '|' || "Monto con Impuestos" || '|dup' || case when has_usd then '|' || "USD" else '' end
      || case when archivo_origen = 'NUEVO P06' and o_orderkey % 5 = 0 then '|g|h|i|j|k|l|m|n|o|p|q|r|s|t|u|v|w|x|y|z|aa|ab|ac' else '' end from {fx_finance}
  union all select distinct archivo_origen, "Tipo_Movimiento", 2, cast(1 as bigint), ' | | | |' from {fx_finance}
"""

FX_LISTING = """
select case when c_custkey % 10 = 9 then c_custkey - 1 else c_custkey end as file_id, c_custkey as file_ord,
  case c_custkey % 4 when 0 then 'nuevo ' when 1 then 'NUEVO ' when 2 then 'Timesheet 2026 - ' else 'timesheet 2026 - ' end || c_name
    || case when c_custkey % 7 = 0 then ' (Copia)' when c_custkey % 11 = 0 then ' Plantilla' else '' end as file_name from {customer}
"""

FX_GRID_TIMESHEET = """
select distinct archivo_origen as file_name, "Sector_Origen" as sector, 0 as part, cast(1 as bigint) as ord, 'Registro de horas 2026' as line from {fx_timesheet}
  union all select distinct archivo_origen, "Sector_Origen", 0, cast(2 as bigint),
    case when user_id % 4 = 0 then ' ' when user_id % 4 = 1 then '...1' else 'consecutivo' end
    || '|Fecha|Día|Category|Sub-Category|' || case when user_id % 5 = 2 then 'Nombre de Proyecto' else 'Proyecto' end
    || '|Descripción|Cantidad de horas|Mes' || case when user_id % 7 = 3 then '|Notas' else '' end from {fx_timesheet}
  union all select archivo_origen, "Sector_Origen", 1, event_id,
    consecutivo || '|' || "Fecha" || '|' || "Día" || '|' || coalesce("Category", '') || '|' || "Sub-Category" || '|' || "Proyecto"
    || '|' || "Descripción" || '|' || "Cantidad de horas" || '|' || "Mes" || case when event_id % 17 = 0 then '|nota|extra' else '' end
  from {fx_timesheet}
"""

#: view name -> (tables it reads, SQL text)
FX_VIEWS: dict[str, tuple[list[str], str]] = {
    "fx_timesheet": (["events", "customer"], FX_TIMESHEET),
    "fx_rates": (["customer"], FX_RATES),
    "fx_projects": (["nation"], FX_PROJECTS),
    "fx_budget": (["customer"], FX_BUDGET),
    "fx_finance": (["orders"], FX_FINANCE),
    "fx_grid_budget": (["fx_budget", "region"], FX_GRID_BUDGET),
    "fx_grid_finance": (["fx_finance", "nation"], FX_GRID_FINANCE),
    "fx_listing": (["customer"], FX_LISTING),
    "fx_grid_timesheet": (["fx_timesheet"], FX_GRID_TIMESHEET),
}


#: Grid views: the columns that name a sheet, in output order.
GRID_VIEWS = {
    "fx_grid_budget": ["file_name", "file_ord"],
    "fx_grid_finance": ["archivo_origen", "tipo"],
    "fx_grid_timesheet": ["file_name", "sector"],
}


def number_grid_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, row_idx long, line``: rows numbered from 0 in each sheet by one range sort of all rows,
    which splits a large sheet over tasks, minus the number of the sheet's first row."""
    numbered = dense_index(rows, [*keys, "part", "ord", "line"], "_all", 0)
    numbered = materialize(numbered.select(*keys, "_all", "line"))
    first = numbered.groupBy(*keys).agg(F.min("_all").alias("_first"))
    return (numbered.join(sized_side(first), keys)
            .select(*keys, (F.col("_all") - F.col("_first")).alias("row_idx"), "line"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base test table (one parquet file per table)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Session setting naming a folder where :func:`materialize_views` stored the stand-ins.
STORED_VIEWS_CONF = "sheetfold.fixtures.dir"


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in view as a Spark DataFrame: read from the stored copy when the session names
    one (``sheetfold.fixtures.dir``, written for the same ``sf_dir``), else derived by SQL."""
    stored = spark.conf.get(STORED_VIEWS_CONF, None)
    if stored:
        path = os.path.join(stored, os.path.basename(os.path.normpath(sf_dir)), f"{name}.parquet")
        if any_match(spark, [path]):
            return spark.read.parquet(path)
    deps, sql = FX_VIEWS[name]
    frames = {d: (fx(spark, sf_dir, d) if d in FX_VIEWS else table(spark, sf_dir, d)) for d in deps}
    rows = spark.sql(sql.replace('"', "`"), **frames)
    return number_grid_rows(rows, GRID_VIEWS[name]) if name in GRID_VIEWS else rows


def materialize_views(spark: SparkSession, sf_dir: str, out_dir: str) -> None:
    """Write every stand-in view for ``sf_dir`` as Parquet under ``out_dir`` (as stored inputs
    would be) and point the session at them."""
    spark.conf.unset(STORED_VIEWS_CONF)
    base = os.path.join(out_dir, os.path.basename(os.path.normpath(sf_dir)))
    for name in FX_VIEWS:
        fx(spark, sf_dir, name).write.mode("overwrite").parquet(os.path.join(base, f"{name}.parquet"))
    spark.conf.set(STORED_VIEWS_CONF, out_dir)


@lru_cache(maxsize=None)
def _closure(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out or n not in FX_VIEWS:
            return
        for d in FX_VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def duck_with(views: list[str], query: str, extra_ctes: str = "") -> str:
    """Prefix a DuckDB query with the CTEs of the stand-in views it reads (then ``extra_ctes``,
    a comma-separated list of ``name as (...)`` definitions)."""
    names = _closure(tuple(views))
    ctes = []
    for n in names:
        deps, sql = FX_VIEWS[n]
        text = sql.format(**{d: d for d in deps}).strip()
        if n in GRID_VIEWS:
            keys = ", ".join(GRID_VIEWS[n])
            text = (f"select {keys}, cast(row_number() over (partition by {keys} order by part, ord, line) - 1 as bigint) as row_idx, line\n"
                    f"from ({text}) g")
        ctes.append(f"{n} as ({text})")
    if extra_ctes.strip():
        ctes.append(extra_ctes.strip())
    return ("with " + ",\n".join(ctes) + "\n" + query.strip()) if ctes else query.strip()


def lines_to_cells(df: DataFrame, line_col: str = "line") -> DataFrame:
    """Grid rows written as ``a|b|c`` become ``cells array<string>`` (the stand-in's only
    dialect step: DuckDB's twin is ``string_split(line, '|')``)."""
    return df.withColumn("cells", F.split(F.col(line_col), "[|]", -1)).drop(line_col)
