"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark code, in plain DuckDB SQL over the same stand-in views
(:func:`sheetfold.sources.fixtures.duck_with` prepends their CTEs). Column names and types match
the Spark results.
"""

from __future__ import annotations

from sheetfold.sources.fixtures import duck_with

ORACLE: dict[str, str] = {}


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def try_double(x: str) -> str:
    return (f"(case when regexp_full_match({x}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"then try_cast({x} as double) end)")


def first_comma_to_dot(x: str) -> str:
    return f"regexp_replace({x}, ',', '.')"


def amount_eu_text(x: str) -> str:
    return first_comma_to_dot(f"replace(regexp_replace({x}, '[^0-9,.]', '', 'g'), '.', '')")


def amount_eu(x: str) -> str:
    return try_double(amount_eu_text(x))


def hours(x: str) -> str:
    return try_double(first_comma_to_dot(x))


_FMTS4 = ["%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%Y-%m-%d%H:%M:%S", "%d-%m-%Y", "%d.%m.%Y"]


def parse_date(x: str) -> str:
    s = f"regexp_replace({strip(x)}, '\\s+', '', 'g')"
    parts = [f"(case when year(try_strptime({s}, '{f}')) >= 1000 then try_strptime({s}, '{f}') end)" for f in _FMTS4]
    parts.append(f"try_strptime({s}, '%d/%m/%y')")
    return f"cast(coalesce({', '.join(parts)}) as date)"


def month_label(d: str) -> str:
    months = "['ene','feb','mar','abr','may','jun','jul','ago','sep','oct','nov','dic']"
    return f"({months}[month({d})] || '/' || cast(year({d}) as varchar))"


def project_id(x: str) -> str:
    return f"replace(nullif(regexp_extract({x}, '^([0-9-]+)', 1), ''), '-', '_')"


def register(name: str, views: list[str], sql: str, extra_ctes: str = "") -> None:
    ORACLE[name] = duck_with(views, sql, extra_ctes)


# ---- scalar functions ---------------------------------------------------------------------

register("fn_strip_unicode", ["fx_finance"], f"""
select o_orderkey, {strip('"Situación"')} as situacion, {strip('fecha_doc')} as fecha from fx_finance""")

register("fn_case", ["fx_finance"], """
select o_orderkey, upper("Situación") as up, lower("Situación") as low from fx_finance""")

register("fn_startswith_contains", ["fx_budget"], """
select row_idx, starts_with(file_name, 'Productividad: 2024') as starts,
  contains(upper("Nombre completo"), 'INSERTAR') as has_insertar from fx_budget""")

register("fn_replace_first", ["fx_finance"], """
select o_orderkey, regexp_replace("USD", ',', '.') as usd_first,
  regexp_replace("Monto con Impuestos", '\\.', ',') as gross_first from fx_finance""")

register("fn_replace_all", ["fx_finance"], """
select o_orderkey, regexp_replace("USD", '[^0-9,.]', '', 'g') as usd_kept,
  replace("Monto con Impuestos", '.', '') as gross_nodots from fx_finance""")

register("fn_title_clean", ["fx_budget"], f"""
select distinct file_ord, {strip("replace(file_name, 'Productividad: ', '')")} as "Proyecto" from fx_budget""")

register("fn_try_double", ["fx_timesheet"], f"""
select event_id, {try_double('"Cantidad de horas"')} as raw_double from fx_timesheet""")

register("fn_amount_eu", ["fx_finance"], f"""
select o_orderkey, {amount_eu('"USD"')} as usd, {amount_eu('"Monto con Impuestos"')} as gross from fx_finance""")

register("fn_hours", ["fx_timesheet"], f"""
select event_id, {hours('"Cantidad de horas"')} as horas from fx_timesheet""")

# ---- timesheets ---------------------------------------------------------------------------

_TS_VIEWS = ["fx_timesheet", "fx_rates", "fx_projects"]

def ts_ctes(src: str) -> str:
    """The timesheet CTE chain (clean → cost → flags) over the relation ``src``."""
    return f"""
ts_parsed as (
  select t.* exclude ("Proyecto", "Cantidad de horas", "Mes", "Fecha"),
    {strip("string_split(archivo_origen, '-')[-1]")} as nombre,
    {strip('t."Proyecto"')} as "Proyecto",
    {project_id('t."Proyecto"')} as proyecto_id,
    {hours('t."Cantidad de horas"')} as "Cantidad de horas",
    case when fd is not null then {month_label('fd')} else t."Mes" end as "Mes",
    case when fd is not null then strftime(fd, '%Y-%m-%d') else t."Fecha" end as "Fecha"
  from (select *, {parse_date('"Fecha"')} as fd from {src}) t
),
ts_clean as (
  select * exclude (fd) from ts_parsed
  where "Cantidad de horas" is not null
     or ("Proyecto" is not null and {strip('"Proyecto"')} <> '')
     or ("Descripción" is not null and {strip('"Descripción"')} <> '')
     or ("Category" is not null and {strip('"Category"')} <> '')
),
rates_ts as (
  select "Nombre" as nombre, coalesce({try_double(first_comma_to_dot('"Costo interno"'))}, 0.0) as "Costo interno"
  from fx_rates
),
costed as (
  select c.*, r."Costo interno", (c."Cantidad de horas" / 8) * coalesce(r."Costo interno", 0.0) as costo_rate_interno
  from ts_clean c left join rates_ts r on c.nombre = r.nombre
),
flagged0 as (
  select *,
    cast(("Category" is null or "Category" = '') as integer) as alerta_category,
    cast(("Sub-Category" is null or "Sub-Category" = '') as integer) as alerta_subcat,
    cast(("Category" = 'Proyectos' and ("Proyecto" is null or "Proyecto" = '')) as integer) as alerta_proyectos,
    cast(("Cantidad de horas" is null) as integer) as alerta_horas,
    cast(("Descripción" is null or "Descripción" = '') as integer) as alerta_desc,
    cast(("Proyecto" is not null and "Proyecto" <> '' and "Proyecto" <> 'Otro'
          and "Proyecto" not in (select "Nombre de Proyecto" from fx_projects where "Nombre de Proyecto" is not null)) as integer)
      as alerta_proyecto_nomb
  from costed
),
flagged as (
  select *, cast(coalesce(alerta_category,0) + coalesce(alerta_subcat,0) + coalesce(alerta_proyectos,0)
    + coalesce(alerta_horas,0) + coalesce(alerta_desc,0) + coalesce(alerta_proyecto_nomb,0) as integer) as suma_alertas
  from flagged0
)"""


TS_CTES = ts_ctes("fx_timesheet")


def ts_register(name: str, select: str) -> None:
    ORACLE[name] = duck_with(_TS_VIEWS, select, TS_CTES)


register("ts_parse_dates", ["fx_timesheet"], f"""
select event_id, fd as fecha_date, case when fd is not null then strftime(fd, '%Y-%m-%d') else "Fecha" end as "Fecha"
from (select *, {parse_date('"Fecha"')} as fd from fx_timesheet)""")

register("ts_month_label", ["fx_timesheet"], f"""
select event_id, case when fd is not null then {month_label('fd')} else "Mes" end as "Mes"
from (select *, {parse_date('"Fecha"')} as fd from fx_timesheet)""")

register("ts_person_name", ["fx_timesheet"], f"""
select event_id, {strip("string_split(archivo_origen, '-')[-1]")} as nombre from fx_timesheet""")

register("dim_rates_ts", ["fx_rates"], f"""
select "Nombre" as nombre, coalesce({try_double(first_comma_to_dot('"Costo interno"'))}, 0.0) as "Costo interno" from fx_rates""")

ts_register("ts_project_id", 'select event_id, "Proyecto", proyecto_id from ts_clean')
ts_register("ts_nonempty_rows", 'select event_id, nombre, "Fecha", "Mes", "Cantidad de horas" from ts_clean')
ts_register("join_rates_exact", 'select event_id, nombre, "Costo interno" from costed')
ts_register("ts_cost", 'select event_id, nombre, "Cantidad de horas", "Costo interno", costo_rate_interno from costed')
ts_register("ts_membership_check", 'select event_id, "Proyecto", alerta_proyecto_nomb from flagged')
ts_register("ts_alert_flags", """select event_id, alerta_category, alerta_subcat, alerta_proyectos, alerta_horas,
  alerta_desc, alerta_proyecto_nomb, suma_alertas from flagged""")
ts_register("ts_alert_detail", """select archivo_origen, nombre, consecutivo, "Fecha", "Día", "Category", "Sub-Category",
  "Proyecto", "Descripción", "Cantidad de horas", "Mes", alerta_category, alerta_subcat, alerta_proyectos,
  alerta_horas, alerta_desc, alerta_proyecto_nomb, suma_alertas from flagged where suma_alertas > 0""")
SUMMARY_SELECT = """select * from (
  select nombre, alerta_category, alerta_subcat, alerta_proyectos, alerta_horas, alerta_desc, alerta_fecha,
    alerta_proyecto_nomb, max_fecha,
    cast(alerta_category + alerta_subcat + alerta_proyectos + alerta_horas + alerta_desc + alerta_proyecto_nomb
         + alerta_fecha as bigint) as suma_alertas
  from (
    select nombre,
      cast(coalesce(sum(alerta_category), 0) as bigint) as alerta_category,
      cast(coalesce(sum(alerta_subcat), 0) as bigint) as alerta_subcat,
      cast(coalesce(sum(alerta_proyectos), 0) as bigint) as alerta_proyectos,
      cast(coalesce(sum(alerta_horas), 0) as bigint) as alerta_horas,
      cast(coalesce(sum(alerta_desc), 0) as bigint) as alerta_desc,
      cast(coalesce(sum(alerta_proyecto_nomb), 0) as bigint) as alerta_proyecto_nomb,
      max("Fecha") as max_fecha,
      coalesce(cast(cast(try_strptime(max("Fecha"), '%Y-%m-%d') as date) < date '2025-02-28' as integer), 0) as alerta_fecha
    from flagged group by nombre) g) s
where suma_alertas >= 1"""
ts_register("ts_alert_summary", SUMMARY_SELECT)
ts_register("ts_consolidated", """select archivo_origen, nombre, consecutivo, "Fecha", "Día", "Category", "Sub-Category",
  "Proyecto", "Descripción", "Cantidad de horas", "Mes", "Costo interno", costo_rate_interno, "Sector_Origen" from costed""")


# ---- grids --------------------------------------------------------------------------------

def has_kw(cells: str, kws: list[str]) -> str:
    cond = " or ".join(f"contains(upper(c), '{k}')" for k in kws)
    return f"(len(list_filter({cells}, lambda c: {cond})) > 0)"


def dedupe_checked(h: str) -> str:
    base = f"(case when {strip('x')} <> '' then {strip('x')} else 'column_' || (i - 1) end)"
    pick = (f"case when not list_contains(acc, {base}) then {base} else {base} || '_' || "
            f"list_filter(range(1, len(acc) + 2), lambda k: not list_contains(acc, {base} || '_' || k))[1] end")
    return f"list_reduce({h}, lambda acc, x, i: list_append(acc, {pick}), []::varchar[])"


def dedupe_counter(bases: str) -> str:
    n = f"len(list_filter(list_slice({bases}, 1, i - 1), lambda y: y = b))"
    return f"list_transform({bases}, lambda b, i: case when {n} = 0 then b else b || '_' || {n} end)"


def counter_bases(h: str) -> str:
    return f"list_transform({h}, lambda x: case when {strip('x')} <> '' then {strip('x')} else 'Unnamed' end)"


def canonical(names: str, tipo: str) -> str:
    dct = (f"(case when {tipo} = 'Ingreso' then (case c when 'Proyecto / Cuenta analítica' then 'Proyecto' "
           f"when '2' then 'Proyecto' end) else (case c when 'Monto Total / (Monto sin Impuestos)' then "
           f"'Monto sin Impuestos' when 'SItuación' then 'Situación' end) end)")
    rule = ("(case when starts_with(upper(c), 'PROYECTO') then 'Proyecto' "
            "when c = '2' or starts_with(upper(c), 'MONTO SIN') then 'Monto sin Impuestos' "
            "when starts_with(upper(c), 'MONTO CON') then 'Monto con Impuestos' "
            "when starts_with(upper(c), 'SITUACI') then 'Situación' else c end)")
    tgt = f"coalesce({dct}, {rule})"
    pick = (f"case when not list_contains(acc, {tgt}) then {tgt} when not list_contains(acc, c) then c "
            f"else c || '_dup' || list_filter(range(1, len(acc) + 2), lambda k: not list_contains(acc, c || '_dup' || k))[1] end")
    return f"list_reduce({names}, lambda acc, c: list_append(acc, {pick}), []::varchar[])"


def pad(h: str, w: str) -> str:
    return f"list_concat({h}, list_transform(range(greatest({w} - len({h}), 0)), lambda z: ''))"


def fit(cells: str, w: str) -> str:
    return f"list_transform(range(1, {w} + 1), lambda k: coalesce({cells}[k], ''))"


BUDGET_GRID_CTES = f"""
gb as (select file_name, file_ord, row_idx, string_split(line, '|') as cells from fx_grid_budget),
gbc as (select file_name, file_ord, row_idx,
  list_transform(cells, lambda c: case when starts_with({strip('c')}, '#') then '' else c end) as cells from gb),
tl0 as (select file_ord, count(*) as n_rows, max(row_idx) as last_row,
  min(row_idx) filter (where row_idx < 30 and {has_kw('cells', ['NOMBRE COMPLETO'])}) as header_idx
  from gbc group by file_ord),
tl1 as (select t.*, (select min(g.row_idx) from gbc g where g.file_ord = t.file_ord and g.row_idx > t.header_idx
    and {has_kw('g.cells', ['TOTAL', 'EQUIPO EXTERNO'])}) as stop_idx
  from tl0 t where t.header_idx is not null and t.n_rows >= 2),
tl as (select t.*, h.cells as header, cast(coalesce(t.stop_idx, t.last_row + 1) - t.header_idx - 1 as integer) as n_data
  from tl1 t join gbc h on h.file_ord = t.file_ord and h.row_idx = t.header_idx),
tln as (select *, {dedupe_checked('header')} as names from tl),
tlk as (select *, list_filter(names, lambda n: contains(upper(n), 'NOMBRE COMPLETO'))[1] as col_nombre,
  list_filter(names, lambda n: contains(upper(n), 'CANTIDAD DE HORAS') or contains(upper(n), 'HORAS PRESUPUESTADAS'))[1] as col_horas
  from tln),
tlp as (select *, cast(list_position(names, col_nombre) - 1 as integer) as i_nombre,
  cast(list_position(names, col_horas) - 1 as integer) as i_horas from tlk),
grid_people as (select g.file_name, g.file_ord, g.row_idx, coalesce(g.cells[p.i_nombre + 1], '') as nombre,
    coalesce(g.cells[p.i_horas + 1], '') as horas_txt
  from gbc g join tlp p on g.file_ord = p.file_ord and g.row_idx > p.header_idx
    and (p.stop_idx is null or g.row_idx < p.stop_idx)
  where p.n_data > 0 and p.i_nombre is not null and p.i_horas is not null),
grid_kept as (select file_ord, row_idx, file_name as archivo_origen, nombre, {hours('horas_txt')} as h,
    {strip("replace(file_name, 'Productividad: ', '')")} as "Proyecto"
  from grid_people where {strip('nombre')} <> '' and not contains(upper(nombre), 'INSERTAR'))"""

register("grid_blank_errors", ["fx_grid_budget"],
         "select file_ord, row_idx, array_to_string(cells, '|') as line_clean from gbc", BUDGET_GRID_CTES)
register("grid_header_required", ["fx_grid_budget"],
         "select file_ord, header_idx, array_to_string(header, '|') as header_line from tl", BUDGET_GRID_CTES)
register("grid_carve_until", ["fx_grid_budget"], "select file_ord, header_idx, stop_idx, n_data from tl", BUDGET_GRID_CTES)
register("grid_min_rows", ["fx_grid_budget"], "select file_ord, n_rows, n_data from tl where n_data > 0", BUDGET_GRID_CTES)
register("hdr_keyword_lookup", ["fx_grid_budget"],
         "select file_ord, col_nombre, i_nombre, col_horas, i_horas from tlp", BUDGET_GRID_CTES)
register("hdr_dedupe_counter", ["fx_grid_budget"], f"""
select file_ord, array_to_string(nm, '|') as names_line, len(list_distinct(nm)) < len(nm) as rejected
from (select file_ord, {dedupe_counter('bs')} as nm from (select file_ord, {counter_bases('header')} as bs from tl))""",
         BUDGET_GRID_CTES)
register("grid_pad_widen", ["fx_grid_budget"], f"""
select file_ord, width, array_to_string({dedupe_checked(pad('header', 'width'))}, '|') as names_line from (
  select t.file_ord, t.header, cast(greatest(len(t.header), coalesce(max(len(g.cells)), 0)) as integer) as width
  from tl t join gbc g on g.file_ord = t.file_ord and g.row_idx > t.header_idx and (t.stop_idx is null or g.row_idx < t.stop_idx)
  where t.n_data > 0 group by t.file_ord, t.header)""", BUDGET_GRID_CTES)

FIRST_ROW_CTES = f"""
gb as (select file_name, file_ord, row_idx, string_split(line, '|') as cells from fx_grid_budget),
fr0 as (select file_ord, count(*) as n_rows from gb group by file_ord having count(*) >= 2),
frh as (select f.file_ord, g.cells as header from fr0 f join gb g on g.file_ord = f.file_ord and g.row_idx = 0)"""

register("grid_pad_truncate", ["fx_grid_budget"], f"""
select g.file_ord, g.row_idx, array_to_string({fit('g.cells', 'len(h.header)')}, '|') as line_fit
from gb g join frh h on g.file_ord = h.file_ord where g.row_idx > 0""", FIRST_ROW_CTES)

register("grid_to_table_ts", ["fx_grid_budget"], f"""
select g.file_ord, g.row_idx, cast(k - 1 as integer) as col_idx, n.names[k] as col_name, coalesce(g.cells[k], '') as value
from gb g join (select file_ord, {dedupe_counter('bs')} as names from (select file_ord, {counter_bases('header')} as bs from frh)) n
  on g.file_ord = n.file_ord, range(1, len(n.names) + 1) r(k)
where g.row_idx > 0 and len(list_distinct(n.names)) = len(n.names)""", FIRST_ROW_CTES)

register("src_range_a2i", ["fx_grid_budget"], """
select file_ord, row_idx - 1 as row_idx, cast(len(list_slice(cells, 1, 9)) as integer) as n_cells,
  array_to_string(list_slice(cells, 1, 9), '|') as line from gb where row_idx >= 1""", FIRST_ROW_CTES)

TS_GRID_CTES = f"""
gb as (select file_name, row_idx, string_split(line, '|') as cells from fx_grid_timesheet),
ra as (select file_name, row_idx - 1 as row_idx, list_slice(cells, 1, 9) as cells from gb where row_idx >= 1),
rl as (select r.file_name, r.cells as header from ra r join (select file_name from ra group by file_name having count(*) >= 2) k
  on r.file_name = k.file_name where r.row_idx = 0),
rn as (select file_name, {dedupe_counter('bs')} as names from (select file_name, {counter_bases('header')} as bs from rl)),
rok as (select *, coalesce(list_position(names, 'consecutivo'), list_position(names, '...1'), list_position(names, 'Unnamed')) as p_seq,
  coalesce(list_position(names, 'Proyecto'), list_position(names, 'Nombre de Proyecto')) as p_proj,
  list_position(names, 'Cantidad de horas') as p_hours from rn
  where len(list_distinct(names)) = len(names) and not (list_contains(names, 'Proyecto') and list_contains(names, 'Nombre de Proyecto')))"""

register("ts_rename_if_present", ["fx_grid_timesheet"], f"""
select r.file_name, r.row_idx,
  case when k.p_seq is not null then coalesce(({fit('r.cells', 'len(k.names)')})[k.p_seq], '') end as consecutivo,
  case when k.p_proj is not null then coalesce(({fit('r.cells', 'len(k.names)')})[k.p_proj], '') end as "Proyecto",
  case when k.p_hours is not null then coalesce(({fit('r.cells', 'len(k.names)')})[k.p_hours], '') end as "Cantidad de horas"
from ra r join rok k on r.file_name = k.file_name where r.row_idx > 0""", TS_GRID_CTES)

# ---- budget -------------------------------------------------------------------------------

def budget_pid(p: str) -> str:
    pid = project_id(p)
    return f"(case when {pid} is not null and regexp_full_match({pid}, '[0-9]+') then '''' || {pid} else {pid} end)"


BUDGET_CTES = f"""
bp as (select file_ord, row_idx, file_name as archivo_origen, "Nombre completo" as nombre, {hours('"Cantidad de horas"')} as h,
  {strip("replace(file_name, 'Productividad: ', '')")} as "Proyecto" from fx_budget),
people as (select * from bp where {strip('nombre')} <> '' and not contains(upper(nombre), 'INSERTAR') and h is not null),
numbered as (select *, {budget_pid('"Proyecto"')} as proyecto_id,
  cast(row_number() over (order by file_ord, row_idx) as bigint) as "ID_Presupuesto" from people),
rates_b as (select {strip('"Nombre"')} as nombre_costo,
  {try_double(first_comma_to_dot("regexp_replace(\"Costo interno\", '[^0-9.,]', '', 'g')"))} as "Costo_interno" from fx_rates),
costed_b as (select n.*, r."Costo_interno", (n.h / 8) * r."Costo_interno" as "Costo_Total_Proyecto"
  from numbered n left join rates_b r on lower({strip('n.nombre')}) = lower({strip('r.nombre_costo')}))"""

_BV = ["fx_budget", "fx_rates"]
register("budget_person_filter", _BV, 'select file_ord, row_idx, nombre, h as "Horas_Presupuestadas" from people', BUDGET_CTES)
register("tag_literals", _BV, 'select file_ord, row_idx, archivo_origen, "Proyecto" from people', BUDGET_CTES)
register("budget_project_id", _BV, f'select distinct file_ord, "Proyecto", {budget_pid(chr(34) + "Proyecto" + chr(34))} as proyecto_id from bp',
         BUDGET_CTES)
register("budget_row_id", _BV, 'select "ID_Presupuesto", file_ord, row_idx, proyecto_id from numbered', BUDGET_CTES)
register("dim_rates_budget", _BV, 'select nombre_costo, "Costo_interno" from rates_b', BUDGET_CTES)
register("join_rates_normalised", _BV, 'select "ID_Presupuesto", nombre, "Costo_interno" from costed_b', BUDGET_CTES)
register("budget_cost", _BV, '''select "ID_Presupuesto", nombre, h as "Horas_Presupuestadas", "Costo_interno",
  "Costo_Total_Proyecto" from costed_b''', BUDGET_CTES)
register("join_rates_missing", _BV, '''select "ID_Presupuesto", proyecto_id, "Proyecto", nombre, h as "Horas_Presupuestadas",
  cast(null as double) as "Costo_interno", cast(null as double) as "Costo_Total_Proyecto", archivo_origen from numbered''',
         BUDGET_CTES)

register("budget_fact", ["fx_grid_budget", "fx_rates"], f"""
select n."ID_Presupuesto", n.proyecto_id, n."Proyecto", n.nombre, n.h as "Horas_Presupuestadas", r."Costo_interno",
  (n.h / 8) * r."Costo_interno" as "Costo_Total_Proyecto", n.archivo_origen
from (select *, {budget_pid('"Proyecto"')} as proyecto_id,
        cast(row_number() over (order by file_ord, row_idx) as bigint) as "ID_Presupuesto"
      from grid_kept where h is not null) n
left join (select {strip('"Nombre"')} as nombre_costo,
  {try_double(first_comma_to_dot("regexp_replace(\"Costo interno\", '[^0-9.,]', '', 'g')"))} as "Costo_interno" from fx_rates) r
  on lower({strip('n.nombre')}) = lower({strip('r.nombre_costo')})""", BUDGET_GRID_CTES)

register("dq_missing_files", ["fx_grid_budget", "fx_budget"], """
select distinct file_ord, file_name from fx_budget
where file_ord not in (select file_ord from grid_kept where h is not null)""", BUDGET_GRID_CTES)

# ---- finance ------------------------------------------------------------------------------

def _v(name: str) -> str:
    return f"(case when list_position(canon, '{name}') is not null then coalesce(cells[list_position(canon, '{name}')], '') end)"


_FIN_COLS = ["Proyecto", "País de facturación", "Categoría", "Tipo de gasto", "Descripción",
             "Producto/Entregable/Servicio", "Monto sin Impuestos", "IGV/IVA/Otros", "Monto con Impuestos",
             "Moneda", "TC", "USD", "Fecha de entrega del producto", "Fecha de emisión del comprobante",
             "Situación", "Fecha de factura proveedor"]
_FIN_KW = ["PROYECTO", "MONTO", "SITUACI", "FACTURA"]

FIN_GRID_CTES = f"""
gf as (select archivo_origen, tipo, row_idx, string_split(line, '|') as cells from fx_grid_finance),
fl0 as (select archivo_origen, tipo, count(*) as n_rows, max(row_idx) as last_row,
  min(row_idx) filter (where row_idx < 15 and {has_kw('cells', _FIN_KW)}) as h
  from gf group by archivo_origen, tipo),
fl1 as (select archivo_origen, tipo, n_rows, last_row, coalesce(h, 0) as header_idx from fl0 where n_rows >= 2),
fl2 as (select f.*, g.cells as header from fl1 f join gf g on g.archivo_origen = f.archivo_origen and g.tipo = f.tipo
  and g.row_idx = f.header_idx),
fw as (select f.archivo_origen, f.tipo, max(len(g.cells)) as w from fl1 f join gf g
  on g.archivo_origen = f.archivo_origen and g.tipo = f.tipo and g.row_idx > f.header_idx group by f.archivo_origen, f.tipo),
fl as (select f.*, cast(greatest(len(f.header), coalesce(w.w, 0)) as integer) as width from fl2 f
  left join fw w on w.archivo_origen = f.archivo_origen and w.tipo = f.tipo where f.last_row - f.header_idx > 0),
fln as (select *, {dedupe_checked(pad('header', 'width'))} as names from fl),
flc as (select *, {canonical('names', 'tipo')} as canon from fln),
fr as (select l.archivo_origen, l.tipo, g.row_idx, g.cells, l.canon from flc l join gf g
  on g.archivo_origen = l.archivo_origen and g.tipo = l.tipo and g.row_idx > l.header_idx),
fv0 as (select archivo_origen, tipo, row_idx, {', '.join(f'{_v(c)} as "{c}"' for c in _FIN_COLS)} from fr),
fv1 as (select * exclude ("USD"), "USD" as usd_text, {amount_eu('"USD"')} as "USD",
  case when tipo = 'Ingreso' and "Fecha de emisión del comprobante" is not null then "Fecha de emisión del comprobante"
       when tipo = 'Gasto' and "Fecha de factura proveedor" is not null then "Fecha de factura proveedor" else '' end as "Fecha"
  from fv0),
fv as (select *,
  (coalesce({strip('"Proyecto"')} <> '', false) or coalesce({strip('"Situación"')} <> '', false)
   or coalesce({strip('"Monto con Impuestos"')} <> '', false) or coalesce({strip('"Descripción"')} <> '', false)
   or coalesce({strip('"Fecha"')} <> '', false)) as is_real,
  ("Situación" is null or upper({strip('"Situación"')}) in ('REAL', 'PROYECTADO')) as st_ok,
  (usd_text is null or coalesce("USD" > 0, false)) as usd_ok,
  ("Monto con Impuestos" is null or coalesce({amount_eu_text('"Monto con Impuestos"')} <> ''
     and {try_double(amount_eu_text('"Monto con Impuestos"'))} > 0, false)) as gross_ok,
  (tipo <> 'Gasto' or coalesce({strip('"Fecha"')} <> '' and "Fecha" is not null, false)) as date_ok
  from fv1),
fvalid as (select * from fv where is_real and st_ok and usd_ok and gross_ok and date_ok)"""

_FG = ["fx_grid_finance"]
register("grid_header_radar", _FG, "select archivo_origen, tipo, header_idx, array_to_string(header, '|') as header_line from fl",
         FIN_GRID_CTES)
register("hdr_dedupe_checked", _FG, "select archivo_origen, tipo, width, array_to_string(names, '|') as names_line from fln",
         FIN_GRID_CTES)
register("hdr_canonical", _FG, "select archivo_origen, tipo, array_to_string(canon, '|') as canon_line from flc", FIN_GRID_CTES)
register("grid_to_table_fin", _FG, f"""
select l.archivo_origen, l.tipo, g.row_idx, cast(k - 1 as integer) as col_idx, l.canon[k] as col_name,
  coalesce(g.cells[k], '') as value
from flc l join gf g on g.archivo_origen = l.archivo_origen and g.tipo = l.tipo and g.row_idx > l.header_idx,
  range(1, l.width + 1) r(k)""", FIN_GRID_CTES)
register("src_range_az", _FG, """select archivo_origen, tipo, row_idx, cast(len(list_slice(cells, 1, 26)) as integer) as n_cells,
  array_to_string(list_slice(cells, 1, 26), '|') as line from gf""", FIN_GRID_CTES)
register("fin_unified_date", _FG, 'select archivo_origen, tipo as "Tipo_Movimiento", row_idx, "Fecha" from fv', FIN_GRID_CTES)
register("fin_optional_columns", _FG,
         'select archivo_origen, tipo as "Tipo_Movimiento", row_idx, "USD", "Monto con Impuestos" from fvalid', FIN_GRID_CTES)
register("fin_clean", _FG, '''select archivo_origen, tipo as "Tipo_Movimiento", row_idx, "Fecha", "Proyecto", "Situación",
  "Monto con Impuestos", "USD", "Fecha de emisión del comprobante", "Fecha de factura proveedor" from fvalid''', FIN_GRID_CTES)
register("audit_counts", _FG, '''select archivo_origen, tipo as "Tipo_Movimiento", tipo,
  count(*) filter (where is_real) as n_real, count(*) filter (where is_real and st_ok and usd_ok and gross_ok and date_ok) as n_valid
  from fv group by archivo_origen, tipo''', FIN_GRID_CTES)

_INC = ["Fecha", "Proyecto", "País de facturación", "Producto/Entregable/Servicio", "Monto sin Impuestos", "IGV/IVA/Otros",
        "Monto con Impuestos", "Moneda", "TC", "USD", "Fecha de entrega del producto", "Fecha de emisión del comprobante",
        "Situación"]
_EXP = ["Fecha", "Proyecto", "País de facturación", "Categoría", "Tipo de gasto", "Descripción", "Fecha de factura proveedor",
        "Monto sin Impuestos", "IGV/IVA/Otros", "Monto con Impuestos", "Moneda", "TC", "USD", "Situación"]
_MASTER = ["archivo_origen", "Tipo_Movimiento", "Fecha", "Proyecto", "País de facturación", "Categoría", "Tipo de gasto",
           "Descripción", "Producto/Entregable/Servicio", "Monto sin Impuestos", "IGV/IVA/Otros", "Monto con Impuestos",
           "Moneda", "TC", "USD", "Fecha de entrega del producto", "Fecha de emisión del comprobante", "Situación",
           "Fecha de factura proveedor"]


def _q(cols: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in cols)


register("fin_master_order", _FG, f"""
select {_q(_MASTER)} from (
  select {_q(_INC)}, tipo as "Tipo_Movimiento", archivo_origen from fvalid where tipo = 'Ingreso'
  union all by name
  select {_q(_EXP)}, tipo as "Tipo_Movimiento", archivo_origen from fvalid where tipo = 'Gasto')""", FIN_GRID_CTES)

FX_FIN_CTES = f"""
ff as (select o_orderkey, archivo_origen, "Tipo_Movimiento", "Proyecto", "Situación", "Monto con Impuestos" as gross, has_usd,
  case when has_usd then "USD" end as usd_text,
  case when "Tipo_Movimiento" in ('Ingreso', 'Gasto') and fecha_doc is not null then fecha_doc else '' end as "Fecha"
  from fx_finance),
ff2 as (select *, {amount_eu('usd_text')} as "USD",
  (coalesce({strip('"Proyecto"')} <> '', false) or coalesce({strip('"Situación"')} <> '', false)
   or coalesce({strip('gross')} <> '', false) or coalesce({strip('"Fecha"')} <> '', false)) as r,
  ("Situación" is null or upper({strip('"Situación"')}) in ('REAL', 'PROYECTADO')) as st
  from ff),
ff3 as (select *, ((not has_usd or coalesce("USD" > 0, false))
   and (gross is null or coalesce({amount_eu_text('gross')} <> '' and {try_double(amount_eu_text('gross'))} > 0, false))) as am,
  ("Tipo_Movimiento" <> 'Gasto' or coalesce({strip('"Fecha"')} <> '' and "Fecha" is not null, false)) as dt
  from ff2)"""

_FF = ["fx_finance"]
register("fin_ghost_rows", _FF, "select o_orderkey, archivo_origen from ff3 where r", FX_FIN_CTES)
register("fin_status_in", _FF, 'select o_orderkey, "Situación" from ff3 where r and st', FX_FIN_CTES)
register("fin_amount_positive", _FF, 'select o_orderkey, "USD" from ff3 where r and st and am', FX_FIN_CTES)
register("fin_expense_date", _FF, 'select o_orderkey, "Tipo_Movimiento", "Fecha" from ff3 where r and st and am and dt',
         FX_FIN_CTES)
register("union_by_name_missing", _FF, """
select o_orderkey, "Tipo_Movimiento", fecha_doc as "Fecha de emisión del comprobante", "Proyecto" from fx_finance
  where "Tipo_Movimiento" = 'Ingreso'
union all by name
select o_orderkey, "Tipo_Movimiento", fecha_doc as "Fecha de factura proveedor", "Situación" from fx_finance
  where "Tipo_Movimiento" = 'Gasto'""")

# ---- listings -----------------------------------------------------------------------------

register("src_listing", ["fx_listing"], """
select case file_ord % 2 when 0 then 'finance-a' else 'finance-b' end as folder, file_id,
  row_number() over (order by file_ord % 2, file_name) as file_ord, file_name from fx_listing""")
register("src_dedupe_by_id", ["fx_listing"],
         "select file_id, min(file_ord) as file_ord, arg_max(file_name, file_ord) as file_name from fx_listing group by file_id")
register("src_name_filter_ci", ["fx_listing"], """
select * from (select file_id, min(file_ord) as file_ord, arg_max(file_name, file_ord) as file_name from fx_listing group by file_id)
where starts_with(upper(file_name), 'NUEVO') and not contains(upper(file_name), 'COPIA')""")
register("src_name_filter_cs", ["fx_listing"], """
select * from fx_listing where starts_with(file_name, 'Timesheet 2026 -') and not contains(file_name, 'Plantilla')""")

# ---- sinks --------------------------------------------------------------------------------

_DETAIL = ["archivo_origen", "nombre", "consecutivo", "Fecha", "Día", "Category", "Sub-Category", "Proyecto",
           "Descripción", "Cantidad de horas", "Mes", "alerta_category", "alerta_subcat", "alerta_proyectos",
           "alerta_horas", "alerta_desc", "alerta_proyecto_nomb", "suma_alertas"]
ts_register("sink_null_to_blank", "select " + ", ".join(f'coalesce(cast("{c}" as varchar), \'\') as "{c}"' for c in _DETAIL)
            + " from flagged where suma_alertas > 0")
register("sink_dates_to_text", ["fx_timesheet"], f"""
select event_id, cast({parse_date('"Fecha"')} as varchar) as fecha_date from fx_timesheet""")

# ---- timesheets from raw grids ------------------------------------------------------------

_TSG_COLS = {"consecutivo": ["consecutivo", "...1", "Unnamed"], "Fecha": ["Fecha"], "Día": ["Día"],
             "Category": ["Category"], "Sub-Category": ["Sub-Category"], "Proyecto": ["Proyecto", "Nombre de Proyecto"],
             "Descripción": ["Descripción"], "Cantidad de horas": ["Cantidad de horas"], "Mes": ["Mes"]}


def _tsg_value(col: str) -> str:
    p = "coalesce(" + ", ".join(f"list_position(k.names, '{a}')" for a in _TSG_COLS[col]) + ")"
    return f'case when {p} is not null then coalesce(a.cells[{p}], \'\') end as "{col}"'


TS_GRID_CTES = f"""
gt as (select file_name, sector, row_idx, string_split(line, '|') as cells from fx_grid_timesheet
  where starts_with(file_name, 'Timesheet 2026 -') and not contains(file_name, 'Plantilla')),
ta as (select file_name, sector, row_idx - 1 as row_idx, list_slice(cells, 1, 9) as cells from gt where row_idx >= 1),
th as (select a.file_name, a.cells as header from ta a
  join (select file_name from ta group by file_name having count(*) >= 2) n on a.file_name = n.file_name where a.row_idx = 0),
tn as (select file_name, {dedupe_counter('bs')} as names from (select file_name, {counter_bases('header')} as bs from th)),
tk as (select * from tn where len(list_distinct(names)) = len(names)
  and not (list_contains(names, 'Proyecto') and list_contains(names, 'Nombre de Proyecto'))),
trows as (select a.file_name as archivo_origen, a.sector as "Sector_Origen", {', '.join(_tsg_value(c) for c in _TSG_COLS)}
  from ta a join tk k on a.file_name = k.file_name where a.row_idx > 0),
{ts_ctes("trows").strip()}"""

_TSG_VIEWS = ["fx_grid_timesheet", "fx_rates", "fx_projects"]
register("ts_grid_consolidated", _TSG_VIEWS, """select archivo_origen, nombre, consecutivo, "Fecha", "Día", "Category",
  "Sub-Category", "Proyecto", "Descripción", "Cantidad de horas", "Mes", "Costo interno", costo_rate_interno, "Sector_Origen"
  from costed""", TS_GRID_CTES)
register("ts_grid_alert_summary", _TSG_VIEWS, SUMMARY_SELECT, TS_GRID_CTES)

register("audit_counts_ts", ["fx_timesheet"], f"""
select "Sector_Origen", count(*) as n_rows,
  count(*) filter (where {hours('"Cantidad de horas"')} is not null
     or ("Proyecto" is not null and {strip('"Proyecto"')} <> '')
     or ("Descripción" is not null and {strip('"Descripción"')} <> '')
     or ("Category" is not null and {strip('"Category"')} <> '')) as n_valid
from fx_timesheet group by "Sector_Origen"
""")

register("src_listing_folders", ["fx_grid_timesheet"], """
select folder, file_name, cast(row_number() over (order by
    case folder when 'Empresarial' then 0 when 'Desarrollo' then 1 when 'Directorio' then 2 else 3 end, folder, file_name)
  as bigint) as file_ord
from (select distinct sector as folder, file_name from fx_grid_timesheet)""")


# ---- real files, exports and sinks --------------------------------------------------------

register("src_export_listing", ["fx_grid_timesheet"],
         "select distinct sector as folder, file_name, 'Timesheet' as tab from fx_grid_timesheet")
register("src_export_range", _FG, """
select 'Presupuestos' as folder, archivo_origen as file_name, row_idx, line,
  cast(case when line = '' then 0 else len(string_split(line, '|')) end as integer) as n_cells
from (select archivo_origen, row_idx, rtrim(array_to_string(list_slice(cells, 1, 26), '|'), '|') as line from gf where tipo = 'Ingreso'
  and upper(archivo_origen) like 'NUEVO%' and upper(archivo_origen) not like '%COPIA%')""", FIN_GRID_CTES)
ORACLE["src_export_table"] = ORACLE["ts_rename_if_present"]
register("dq_unreadable_files", ["fx_grid_budget"], """
select file_name, cast(case when max(file_ord) % 10 in (3, 5, 7) then 0 else count(*) end as bigint) as n_rows,
  case max(file_ord) % 10 when 3 then 'not UTF-8 text' when 5 then 'broken quotes: not a CSV file'
    when 7 then 'holds NUL bytes: not a text file' end as reason
from fx_grid_budget group by file_name""")

_PRESENT = ["archivo_origen", "Tipo_Movimiento", "Fecha", "Proyecto", "Monto sin Impuestos", "Monto con Impuestos", "USD",
            "Fecha de emisión del comprobante", "Situación", "Fecha de factura proveedor"]
register("fin_present_columns", _FG, f"""
select {_q(_PRESENT)} from (
  select {_q(_INC)}, tipo as "Tipo_Movimiento", archivo_origen from fvalid where tipo = 'Ingreso'
  union all by name
  select {_q(_EXP)}, tipo as "Tipo_Movimiento", archivo_origen from fvalid where tipo = 'Gasto')""", FIN_GRID_CTES)
register("fin_export_order", _FG, """
select archivo_origen, tipo as "Tipo_Movimiento", "Fecha", "Monto con Impuestos",
  row_number() over (order by tipo <> 'Ingreso', archivo_origen, row_idx) as position from fvalid""", FIN_GRID_CTES)
ORACLE["ts_run_audit"] = ORACLE["audit_counts_ts"]

_PEOPLE, _RATES = "(select count(*) from people)", "(select count(*) from fx_rates)"


def _step_rows(steps: list[tuple[str, str, str]]) -> str:
    return " union all ".join(f"select '{step}' as step, cast({written} as bigint) as written, cast({held} as bigint) as held"
                              for step, written, held in steps)


register("sink_replace", _BV, _step_rows([
    ("first", _PEOPLE, _PEOPLE), ("died before publishing", _RATES, _PEOPLE), ("next", _RATES, _RATES)]), BUDGET_CTES)
register("sink_skip_empty", _BV, _step_rows([
    ("first", _PEOPLE, _PEOPLE), ("empty", "null", _PEOPLE), ("empty, replacing", "0", "0")]), BUDGET_CTES)
register("sink_protected", _BV, _step_rows([
    *[(step, "null", _PEOPLE) for step in ("the folder", "below", "above")], ("beside", "1", _PEOPLE)]), BUDGET_CTES)
register("sink_find_or_create", _BV, _step_rows([
    ("a: created", _PEOPLE, _PEOPLE), ("b: created", _RATES, _RATES), ("a again: replaced", _RATES, _RATES),
    ("a empty: skipped", "0", _RATES)]), BUDGET_CTES)
