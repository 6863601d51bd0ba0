"""The results of ``queries`` as plain SQL over the same tables, written independently."""

from saleslake.functions.dates import DAYS_OF_MONTH, MONTHS, WEEKDAYS
from saleslake.schemas import DOUBLE_COLUMNS, INTEGER_COLUMNS, RAW_REQUIRED, SILVER

POSITION = "_pos_line, _pos_supplier, _pos_quantity, _pos_price"
UNIT = "SUCURSAL, YEAR, MONTH"

_SALES = """
sales AS (
  SELECT CAST(o_orderdate AS TIMESTAMP) AS FECHA,
    l_orderkey AS NUMERO_TICKET,
    CAST(1 AS BIGINT) AS CANTIDAD_TICKET,
    CAST(c_nationkey AS BIGINT) AS ID_SUCURSAL,
    n_name AS DESCRIP_SUCURSAL,
    CAST(n_regionkey AS BIGINT) AS ID_ZONA_SUPERVISION,
    r_name AS DESC_ZONA_SUPERVICION,
    l_partkey AS ID_ARTICULO,
    p_name AS DESC_ARTICULO,
    CAST(p_size AS BIGINT) AS FAMILIA,
    p_brand AS DESC_FAMILIA,
    CAST(p_size % 7 AS BIGINT) AS DEPARTAMENTO,
    p_type AS DESC_DEPARTAMENTO,
    l_partkey % 5 AS RUBRO,
    'R' || (l_partkey % 5) AS DESC_RUBRO,
    l_partkey % 25 AS SUBRUBRO,
    'S' || (l_partkey % 25) AS DESC_SUBRUBRO,
    CAST(l_quantity AS BIGINT) AS CANTIDAD_VENDIDA,
    l_extendedprice / l_quantity AS VALOR_ARTICULO,
    l_extendedprice * (1 + l_tax) AS VENTA_BRUTA,
    CAST(0 AS DOUBLE) AS MONTO_IMPUESTOS_INTERNOS,
    l_extendedprice * l_tax AS MONTO_IVA,
    2 * p_retailprice AS COSTO_ARTICULO,
    n_name AS SUCURSAL,
    CAST(year(o_orderdate) AS INTEGER) AS YEAR,
    CAST(month(o_orderdate) AS INTEGER) AS MONTH,
    l_linenumber AS _pos_line,
    l_suppkey AS _pos_supplier,
    l_quantity AS _pos_quantity,
    l_extendedprice AS _pos_price
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

_RATES = """
rate_months AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS n
  FROM orders
),
rate_rows AS (
  SELECT year, CASE WHEN n = 25 AND again = 1 THEN CAST(13 AS INTEGER) ELSE month END AS month,
    n * 2 + again AS ord,
    CASE WHEN n = 30 OR (n = 40 AND again = 0) THEN NULL
         ELSE CAST(800.37 AS DOUBLE) + 5 * n + 50 * again END AS exchange_rate_ars_usd
  FROM rate_months CROSS JOIN (VALUES (0), (1)) AS copies(again)
  WHERE n % 17 <> 0 AND (again = 0 OR n IN (20, 25, 40))
),
rates AS (
  SELECT year, month,
    first(exchange_rate_ars_usd ORDER BY ord)
      FILTER (WHERE exchange_rate_ars_usd IS NOT NULL) AS exchange_rate_ars_usd
  FROM rate_rows WHERE month BETWEEN 1 AND 12 GROUP BY year, month
),
calendar AS (
  SELECT CAST((m - 1) // 12 AS INTEGER) AS year, CAST((m - 1) % 12 + 1 AS INTEGER) AS month
  FROM (SELECT unnest(generate_series(min(year * 12 + month), max(year * 12 + month))) AS m
        FROM rates)
),
filled AS (
  SELECT c.year, c.month,
    last_value(r.exchange_rate_ars_usd IGNORE NULLS) OVER (
      ORDER BY c.year, c.month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
    ) AS exchange_rate_ars_usd
  FROM calendar c LEFT JOIN rates r ON c.year = r.year AND c.month = r.month
),
last_rate AS (
  SELECT exchange_rate_ars_usd AS rate, year * 12 + month AS m
  FROM filled ORDER BY year DESC, month DESC LIMIT 1
)"""

_DIRTY = f"""
dirty AS (
  SELECT {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in RAW_REQUIRED if c not in (
      "FECHA", "NUMERO_TICKET", "CANTIDAD_VENDIDA", "VALOR_ARTICULO", "COSTO_ARTICULO",
      "DESC_ARTICULO"))},
    CASE WHEN NUMERO_TICKET % 97 = 0 THEN 'nan' ELSE CAST(NUMERO_TICKET AS VARCHAR) END
      AS NUMERO_TICKET,
    CASE WHEN NUMERO_TICKET % 89 = 0 THEN '12.7'
         WHEN NUMERO_TICKET % 50 = 0 THEN CAST(-CANTIDAD_VENDIDA AS VARCHAR)
         ELSE CAST(CANTIDAD_VENDIDA AS VARCHAR) END AS CANTIDAD_VENDIDA,
    CASE WHEN NUMERO_TICKET % 83 = 0 THEN '1,234' ELSE CAST(VALOR_ARTICULO AS VARCHAR) END
      AS VALOR_ARTICULO,
    CASE WHEN NUMERO_TICKET % 79 = 0 THEN '12d' ELSE CAST(COSTO_ARTICULO AS VARCHAR) END
      AS COSTO_ARTICULO,
    CASE WHEN NUMERO_TICKET % 73 = 0 THEN 'no date'
         WHEN NUMERO_TICKET % 67 = 0 THEN strftime(FECHA, '%Y-%m-%d')
         WHEN NUMERO_TICKET % 61 = 0 THEN strftime(FECHA, '%Y-%m-%dT%H:%M:%S.000')
         WHEN NUMERO_TICKET % 59 = 0 THEN strftime(FECHA, '%Y%m%d')
         ELSE strftime(FECHA, '%Y-%m-%d %H:%M:%S') END AS FECHA,
    CASE WHEN NUMERO_TICKET % 71 = 0 THEN chr(9) || ' ' || DESC_ARTICULO || ' ' || chr(9)
         WHEN NUMERO_TICKET % 47 = 0 THEN NULL ELSE DESC_ARTICULO END AS DESC_ARTICULO,
    NUMERO_TICKET AS TICKET, {UNIT}, {POSITION}
  FROM sales
)"""


def _trim(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _to_int(text: str) -> str:
    t = _trim(text)
    return (
        f"CASE WHEN regexp_matches({t}, '^[+-]?\\d+$') THEN coalesce(TRY_CAST({t} AS BIGINT), 0) "
        f"WHEN regexp_matches({t}, '{_NUMBER}') "
        f"THEN coalesce(TRY_CAST(trunc(TRY_CAST({t} AS DOUBLE)) AS BIGINT), 0) "
        "ELSE CAST(0 AS BIGINT) END"
    )


def _to_double(text: str) -> str:
    t = _trim(text)
    return (
        f"CASE WHEN regexp_matches({t}, '{_NUMBER}') "
        f"THEN coalesce(TRY_CAST({t} AS DOUBLE), 0) ELSE CAST(0 AS DOUBLE) END"
    )


_TS = (
    "CASE WHEN regexp_matches(FECHA, '^\\d{4}-\\d\\d-\\d\\d') THEN TRY_CAST(FECHA AS TIMESTAMP) "
    "WHEN regexp_matches(FECHA, '^\\d{8}$') THEN try_strptime(FECHA, '%Y%m%d') END"
)


def _in_spanish(names: list[str], position: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, start=1))
    return f"CASE {position} {cases} END"


_WEEKDAY = _in_spanish(WEEKDAYS, "isodow(FECHA)")
_OTHERS = [c for c in RAW_REQUIRED if c not in INTEGER_COLUMNS + DOUBLE_COLUMNS + ["FECHA"]]

_TYPED_DIRTY = f"""
typed AS (
  SELECT {_TS} AS FECHA,
    {", ".join(f"{_to_int(c)} AS {c}" for c in INTEGER_COLUMNS)},
    {", ".join(f"{_to_double(c)} AS {c}" for c in DOUBLE_COLUMNS)},
    {", ".join(_OTHERS)}, {UNIT}, {POSITION}
  FROM dirty WHERE {_TS} IS NOT NULL
)"""
_TYPED_CLEAN = "typed AS (SELECT * FROM sales)"


def _silver(fill: bool = False, odd_days: bool = False, order: str = POSITION) -> str:
    """CTEs from ``typed`` lines to ``silver``; with odd days some lines have no known weekday or day."""
    day, weekday = "CAST(day(FECHA) AS BIGINT)", _WEEKDAY
    if odd_days:
        day = f"CASE WHEN NUMERO_TICKET % 43 <> 0 THEN {day} END"
        weekday = f"CASE WHEN NUMERO_TICKET % 53 = 0 THEN 'Feriado' ELSE {weekday} END"
    rates = "filled" if fill else "rates"
    rate = "r.exchange_rate_ars_usd"
    if fill:
        rate = f"CASE WHEN s.YEAR * 12 + s.MONTH > l.m THEN l.rate ELSE {rate} END"
    base = [c for c in SILVER.fieldNames() if c in RAW_REQUIRED]
    return f"""
first_lines AS (
  SELECT * FROM typed
  QUALIFY row_number() OVER (
    PARTITION BY {UNIT}, FECHA, NUMERO_TICKET, ID_ARTICULO ORDER BY {order}) = 1
),
sold AS (
  SELECT *, CANTIDAD_VENDIDA * VALOR_ARTICULO AS VENTA_ARS,
    CANTIDAD_VENDIDA * COSTO_ARTICULO AS COSTO_ARS
  FROM first_lines WHERE CANTIDAD_VENDIDA * VALOR_ARTICULO > 0
),
rated AS (
  SELECT s.*, s.VENTA_ARS - s.COSTO_ARS AS MARGEN_ARS, {rate} AS TIPO_CAMBIO
  FROM sold s LEFT JOIN {rates} r ON s.YEAR = r.year AND s.MONTH = r.month
  {"CROSS JOIN last_rate l" if fill else ""}
),
silver AS (
  SELECT {", ".join(base)}, VENTA_ARS, COSTO_ARS, MARGEN_ARS, TIPO_CAMBIO,
    VENTA_ARS / TIPO_CAMBIO AS VENTA_USD,
    COSTO_ARS / TIPO_CAMBIO AS COSTO_USD,
    MARGEN_ARS / TIPO_CAMBIO AS MARGEN_USD,
    {day} AS DIA_MES,
    {weekday} AS DIA_SEMANA, {UNIT}
  FROM rated
)"""


_PRODUCTS = f"""
products AS (
  SELECT {UNIT}, ID_ARTICULO, DESC_ARTICULO,
    CAST(sum(CANTIDAD_VENDIDA) AS BIGINT) AS CANTIDAD_VENDIDA,
    {", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in (
        "VENTA_ARS", "COSTO_ARS", "MARGEN_ARS", "VENTA_USD", "COSTO_USD", "MARGEN_USD"))}
  FROM silver
  WHERE ID_ARTICULO IS NOT NULL AND DESC_ARTICULO IS NOT NULL
  GROUP BY {UNIT}, ID_ARTICULO, DESC_ARTICULO
),
product_ratios AS (
  SELECT *, coalesce(MARGEN_ARS / nullif(VENTA_ARS, 0), 0) AS MARGEN_PORC_ARS,
    coalesce(MARGEN_USD / nullif(VENTA_USD, 0), 0) AS MARGEN_PORC_USD
  FROM products
),
best_product AS (
  SELECT {UNIT}, DESC_ARTICULO AS PRODUCTO_TOP_MARGEN FROM products
  QUALIFY row_number() OVER (
    PARTITION BY {UNIT} ORDER BY MARGEN_USD DESC, ID_ARTICULO, DESC_ARTICULO) = 1
),
day_sales AS (
  SELECT {UNIT}, DIA_MES, coalesce(sum(VENTA_USD), 0) AS VENTA_USD
  FROM silver WHERE DIA_MES IS NOT NULL GROUP BY {UNIT}, DIA_MES
),
weekday_sales AS (
  SELECT {UNIT}, DIA_SEMANA, coalesce(sum(VENTA_USD), 0) AS VENTA_USD
  FROM silver GROUP BY {UNIT}, DIA_SEMANA
),
best_day AS (
  SELECT {UNIT}, CAST(DIA_MES AS INTEGER) AS DIA_MES_TOP_VENTAS FROM day_sales
  QUALIFY row_number() OVER (PARTITION BY {UNIT} ORDER BY VENTA_USD DESC, DIA_MES) = 1
),
best_weekday AS (
  SELECT {UNIT}, DIA_SEMANA AS DIA_SEMANA_TOP_VENTAS FROM weekday_sales
  QUALIFY row_number() OVER (
    PARTITION BY {UNIT} ORDER BY VENTA_USD DESC, encode(DIA_SEMANA)) = 1
)"""


def _trend(bucket: str, prefix: str, scope: str, threshold: float = 0.7) -> str:
    """CTE ``trend_<prefix>``: one row per branch or branch-month."""
    keys = "SUCURSAL" if scope == "chain" else UNIT
    pick = ", ".join(f"own.{k.strip()}" for k in keys.split(","))
    whole = bucket if scope == "chain" else f"{UNIT}, {bucket}"
    names = ", ".join(f"'{d}'" for d in WEEKDAYS)
    known = f"{bucket} IN ({names})" if bucket == "DIA_SEMANA" else "true"
    name = prefix.lower()
    return f"""
own_{name} AS (
  SELECT {keys}, {bucket}, avg(VENTA_USD) AS mean FROM silver GROUP BY {keys}, {bucket}
),
whole_{name} AS (
  SELECT {whole}, CASE WHEN {known} THEN avg(VENTA_USD) END AS mean FROM silver
  WHERE {bucket} IS NOT NULL GROUP BY {whole}
),
corr_{name} AS (
  SELECT {pick}, corr(own.mean, whole.mean) AS r
  FROM own_{name} own JOIN whole_{name} whole USING ({whole})
  GROUP BY {pick}
),
trend_{name} AS (
  SELECT {keys}, CASE WHEN isnan(r) THEN NULL ELSE round(r, 12) END AS CORRELACION_{prefix},
    coalesce(CASE WHEN isnan(r) THEN NULL ELSE round(r, 12) END >= {threshold}, false)
      AS SIGUE_TENDENCIA_{prefix}
  FROM corr_{name}
)"""


def _both_trends(scope: str) -> str:
    keys = "SUCURSAL" if scope == "chain" else UNIT
    return (
        _trend("DIA_SEMANA", "SEMANAL", scope)
        + ","
        + _trend("DIA_MES", "MENSUAL", scope)
        + f""",
flags AS (
  SELECT {keys}, CORRELACION_SEMANAL, SIGUE_TENDENCIA_SEMANAL,
    CORRELACION_MENSUAL, SIGUE_TENDENCIA_MENSUAL
  FROM trend_semanal FULL JOIN trend_mensual USING ({keys})
)"""
    )


_NUMBERED = (
    "row_number() OVER (PARTITION BY SUCURSAL, YEAR "
    f"ORDER BY TICKET, {POSITION}, ID_ARTICULO) + 1"
)


def _raw(row_no: str = "CAST(_pos_line AS BIGINT) + 1") -> str:
    required = ", ".join(f"'{c}'" for c in sorted(RAW_REQUIRED))
    without_cost = ", ".join(f"'{c}'" for c in sorted(RAW_REQUIRED) if c != "COSTO_ARTICULO")
    return f"""
branches AS (
  SELECT *, CAST(split_part(SUCURSAL, '_', 2) AS INTEGER) AS branch FROM dirty
),
raw AS (
  SELECT * REPLACE (CASE WHEN branch = 4 AND YEAR = 1996 THEN 'sin fecha' ELSE FECHA END AS FECHA),
    CASE WHEN branch = 7 THEN 'raw/ventas/Ventas.xlsx'
         WHEN branch % 2 = 1 THEN 'raw/ventas/VENTAS - ' || SUCURSAL || '.XLSX'
         ELSE 'raw/ventas/Ventas_' || SUCURSAL || '.xlsx' END AS path,
    CASE WHEN branch <> 9 THEN CAST(YEAR AS VARCHAR) END AS sheet,
    CASE WHEN branch <> 9 THEN {row_no} END AS row_no,
    CASE WHEN branch = 9 THEN NULL
         WHEN branch % 11 = 3 THEN [{without_cost}]
         WHEN branch % 5 = 1 THEN [{required}, 'OBS']
         ELSE [{required}] END AS names,
    CASE WHEN branch = 9 THEN 'unreadable_workbook: BadZipFile' END AS error
  FROM branches
),
files AS (
  SELECT *,
    replace(regexp_replace(regexp_replace(regexp_extract(path, '([^/]*)$', 1),
      '\\.[^.]*$', ''), 'ventas[_\\s-]*', '', 'gi'), ' ', '') AS file_branch,
    CASE WHEN names IS NOT NULL THEN
      array_to_string([c FOR c IN [{required}] IF NOT list_contains(names, c)], ',') END AS missing,
    CASE WHEN names IS NOT NULL THEN
      array_to_string([c FOR c IN names IF NOT list_contains([{required}], c)], ',') END AS unexpected
  FROM raw
)"""


_BRONZE = f"""
bronze AS (
  SELECT {_TS} AS FECHA,
    {", ".join(f"coalesce({_trim(c)}, 'nan') AS {c}"
               for c in RAW_REQUIRED if c not in DOUBLE_COLUMNS + ["FECHA"])},
    {", ".join(f"{_to_double(c)} AS {c}" for c in DOUBLE_COLUMNS)},
    file_branch AS SUCURSAL,
    CAST(year({_TS}) AS INTEGER) AS YEAR, CAST(month({_TS}) AS INTEGER) AS MONTH,
    path AS _src_file, row_no AS _src_row,
    CASE WHEN list_contains(names, 'OBS') THEN 'linea ' || _pos_line END AS OBS
  FROM files
  WHERE error IS NULL AND missing = '' AND file_branch <> '' AND row_no > 1
    AND {_TS} IS NOT NULL
)"""

_TYPED_FILES = f"""
typed AS (
  SELECT {_TS} AS FECHA,
    {", ".join(f"{_to_int(c)} AS {c}" for c in INTEGER_COLUMNS)},
    {", ".join(f"{_to_double(c)} AS {c}" for c in DOUBLE_COLUMNS)},
    {", ".join(f"coalesce({_trim(c)}, 'nan') AS {c}" for c in _OTHERS)},
    file_branch AS SUCURSAL, CAST(year({_TS}) AS INTEGER) AS YEAR, CAST(month({_TS}) AS INTEGER) AS MONTH,
    path, sheet, row_no
  FROM files
  WHERE error IS NULL AND missing = '' AND file_branch <> '' AND {_TS} IS NOT NULL
)"""

# Bronze by several writers; the broken branch-month is still in it.
_MIXED = f"""
mixed AS (
  SELECT * REPLACE (
      CASE WHEN k % 5 = 3 THEN trunc(VALOR_ARTICULO) ELSE VALOR_ARTICULO END AS VALOR_ARTICULO,
      CASE WHEN k % 5 = 2 THEN CAST({_to_int("NUMERO_TICKET")} AS VARCHAR) ELSE NUMERO_TICKET END AS NUMERO_TICKET,
      CASE WHEN k % 5 = 2 THEN CAST({_to_int("CANTIDAD_VENDIDA")} AS VARCHAR) ELSE CANTIDAD_VENDIDA END AS CANTIDAD_VENDIDA,
      CASE WHEN k % 5 = 3 THEN 'obs ' || FAMILIA ELSE OBS END AS OBS),
    CASE WHEN k % 5 = 2 THEN 'nota ' || ID_ARTICULO END AS NOTA,
    SUCURSAL = 'NATION_5' AND YEAR = 1997 AND MONTH = 3 AS damaged
  FROM (SELECT *, CAST(split_part(SUCURSAL, '_', 2) AS INTEGER) AS k FROM bronze)
)"""

_ROUND = {
    **{f"{m}_ARS": 5 for m in ("VENTA", "COSTO", "MARGEN")},
    **{f"{m}_USD": 4 for m in ("VENTA", "COSTO", "MARGEN")},
    "MARGEN_PORC_ARS": 6,
    "MARGEN_PORC_USD": 6,
    "CORRELACION_SEMANAL": 6,
    "CORRELACION_MENSUAL": 6,
}


def _rounded(columns: str) -> str:
    names = [c.strip() for c in columns.split(",")]
    return ", ".join(f"round({c}, {_ROUND[c]}) AS {c}" if c in _ROUND else c for c in names)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_CLEAN = (_SALES, _RATES, _TYPED_CLEAN, _silver(odd_days=True))
_PRODUCT_COLUMNS = (
    f"{UNIT}, ID_ARTICULO, DESC_ARTICULO, CANTIDAD_VENDIDA, VENTA_ARS, COSTO_ARS, MARGEN_ARS, "
    "VENTA_USD, COSTO_USD, MARGEN_USD, MARGEN_PORC_ARS, MARGEN_PORC_USD"
)
_SILVER_COLUMNS = ", ".join(SILVER.fieldNames()) + f", {UNIT}"
_TABLE_COLUMNS = (
    ", ".join(SILVER.fieldNames()) + ", SUCURSAL AS sucursal, YEAR AS year, MONTH AS month"
)
_REWRITTEN = "SUCURSAL = 'NATION_2' AND YEAR = 1996 AND MONTH = 5"
_TYPED_MIXED = f"""
typed AS (
  SELECT FECHA, {", ".join(f"{_to_int(c)} AS {c}" for c in INTEGER_COLUMNS)},
    {", ".join(DOUBLE_COLUMNS)}, {", ".join(_OTHERS)}, {UNIT}, _src_file, _src_row
  FROM mixed WHERE NOT damaged
)"""
_LINE_KEYS = f"NUMERO_TICKET, ID_ARTICULO, {POSITION}"


def _profile(keys: str, bucket: str) -> str:
    by = f"{keys}, {bucket}" if keys else bucket
    return _with(*_CLEAN) + (
        f"SELECT {by}, round(avg(VENTA_USD), 4) AS VENTA_USD FROM silver "
        f"WHERE {bucket} IS NOT NULL GROUP BY {by}"
    )


def _pivot(bucket: str, domain: list) -> str:
    literals = {d: f"'{d}'" if isinstance(d, str) else str(d) for d in domain}
    columns = ", ".join(
        f'round(avg(CASE WHEN {bucket} = {v} THEN VENTA_USD END), 4) AS "{d}"'
        for d, v in literals.items()
    )
    return _with(*_CLEAN) + f"SELECT SUCURSAL, {columns} FROM silver GROUP BY SUCURSAL"


def _trend_query(bucket: str, prefix: str, scope: str, threshold: float = 0.7) -> str:
    keys = "SUCURSAL" if scope == "chain" else UNIT
    columns = f"{keys}, CORRELACION_{prefix}, SIGUE_TENDENCIA_{prefix}"
    return (
        _with(*_CLEAN, _trend(bucket, prefix, scope, threshold))
        + f"SELECT {_rounded(columns)} FROM trend_{prefix.lower()}"
    )


def _with_best(cte: str) -> str:
    column = {
        "best_product": "PRODUCTO_TOP_MARGEN",
        "best_day": "DIA_MES_TOP_VENTAS",
        "best_weekday": "DIA_SEMANA_TOP_VENTAS",
    }[cte]
    return (
        _with(*_CLEAN, _PRODUCTS)
        + f"SELECT {_rounded(UNIT + ', ID_ARTICULO, DESC_ARTICULO, MARGEN_USD')}, {column} "
        + f"FROM products LEFT JOIN {cte} USING ({UNIT})"
    )


def _silver_of_dirty(fill: bool = False) -> str:
    return _with(_SALES, _DIRTY, _RATES, _TYPED_DIRTY, _silver(fill)) + (
        f"SELECT {_SILVER_COLUMNS} FROM silver"
    )


def _gold(scope: str, lines: tuple[str, ...] = (_SALES, _DIRTY, _RATES, _TYPED_DIRTY, _silver())) -> str:
    keys = "SUCURSAL" if scope == "chain" else UNIT
    columns = (
        f"{_PRODUCT_COLUMNS}, PRODUCTO_TOP_MARGEN, DIA_MES_TOP_VENTAS, DIA_SEMANA_TOP_VENTAS, "
        "CORRELACION_SEMANAL, SIGUE_TENDENCIA_SEMANAL, CORRELACION_MENSUAL, SIGUE_TENDENCIA_MENSUAL"
    )
    return (
        _with(*lines, _PRODUCTS, _both_trends(scope))
        + f"""
SELECT {_rounded(columns)},
  CASE WHEN MARGEN_PORC_USD < 0.20 THEN 'no alcanzó' WHEN MARGEN_PORC_USD = 0.20 THEN 'igualó'
       WHEN MARGEN_PORC_USD > 0.20 THEN 'superó' ELSE 'sin datos' END AS CUMPLIMIENTO_OBJETIVO,
  {_in_spanish(MONTHS, "MONTH")} AS MONTH_NAME
FROM product_ratios
LEFT JOIN best_product USING ({UNIT})
LEFT JOIN best_day USING ({UNIT})
LEFT JOIN best_weekday USING ({UNIT})
LEFT JOIN flags USING ({keys})"""
    )


_FAMILY_SUMS = f"""
family AS (
  SELECT {UNIT}, FAMILIA, sum(VENTA_ARS) AS va, sum(MARGEN_ARS) AS ma,
    sum(VENTA_USD) AS vu, sum(MARGEN_USD) AS mu
  FROM silver GROUP BY {UNIT}, FAMILIA
)"""


def _unit_counts(columns: str, ctes: tuple[str, ...], source: str) -> str:
    return _with(*ctes) + f"SELECT {columns}, count(*) AS row_count FROM {source} GROUP BY ALL"


ORACLES: dict[str, str] = {
    "scan_bronze": _with(_SALES, _DIRTY, _raw(), _BRONZE) + "SELECT * FROM bronze",
    "scan_silver": _with(*_CLEAN) + f"SELECT {_SILVER_COLUMNS} FROM silver",
    "scan_mixed": _with(_SALES, _DIRTY, _raw(_NUMBERED), _BRONZE, _MIXED)
    + "SELECT * EXCLUDE (k, damaged) FROM mixed WHERE NOT damaged",
    "list_workbooks": "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, "
    + "['xlsx', 'XLSX', 'Xlsx'][s_suppkey % 4 + 1] AS suffix, true AS has_content "
    + "FROM supplier WHERE s_suppkey % 4 < 3",
    "partition_rewrite": _with(*_CLEAN)
    + f"SELECT {_SILVER_COLUMNS} FROM (SELECT * REPLACE (CASE WHEN {_REWRITTEN} "
    + "THEN CANTIDAD_VENDIDA + 1000 ELSE CANTIDAD_VENDIDA END AS CANTIDAD_VENDIDA) "
    + f"FROM silver WHERE NOT ({_REWRITTEN}) OR NUMERO_TICKET % 2 = 0)",
    "table_scan": _with(*_CLEAN)
    + f"SELECT {_TABLE_COLUMNS}, CAST(0 AS BIGINT) AS rows_before FROM silver",
    "table_redefine": _with(*_CLEAN)
    + f"SELECT {_TABLE_COLUMNS}, CAST(NULL AS VARCHAR) AS OBSERVACION, "
    + "CAST(0 AS BIGINT) AS files_changed FROM silver",
    "rates_table": _with(_RATES) + "SELECT year, month, exchange_rate_ars_usd FROM rate_rows",
    "rates_load": _with(_RATES) + "SELECT year, month, exchange_rate_ars_usd FROM rate_rows",
    "rates_first": _with(_RATES) + "SELECT year, month, exchange_rate_ars_usd FROM rates",
    "partition_from_path": _unit_counts(UNIT, _CLEAN, "silver"),
    "partition_prune": _with(*_CLEAN)
    + f"SELECT {_SILVER_COLUMNS} FROM silver WHERE YEAR = 1997 AND MONTH <= 3 "
    + "AND SUCURSAL IN ('NATION_1', 'NATION_2', 'NATION_3')",
    "preview_top10": _with(*_CLEAN)
    + f"SELECT {_TABLE_COLUMNS} FROM silver "
    + "ORDER BY VENTA_ARS DESC, NUMERO_TICKET, ID_ARTICULO LIMIT 10",
    "header_normalize": _with(_SALES) + f"SELECT {', '.join(RAW_REQUIRED)} FROM sales",
    "trim_all": _with(_SALES, _DIRTY)
    + f"SELECT TICKET, {POSITION}, "
    + ", ".join(f"{_to_double(c) if c in DOUBLE_COLUMNS else _trim(c)} AS {c}" for c in RAW_REQUIRED)
    + " FROM dirty",
    "cast_text": _with(_SALES, _DIRTY)
    + "SELECT CAST(TICKET AS VARCHAR) AS TICKET, "
    + ", ".join(
        f"{_to_double(c)} AS {c}" if c in DOUBLE_COLUMNS else f"coalesce({c}, 'nan') AS {c}"
        for c in RAW_REQUIRED
    )
    + " FROM dirty",
    "contract_report": _with(_SALES, _DIRTY, _raw())
    + "SELECT path, sheet, count(*) AS row_count, max(missing) AS missing, "
    + "max(unexpected) AS unexpected, max(error) AS error, "
    + "max(error) IS NULL AND max(missing) = '' AS accepted "
    + "FROM files GROUP BY path, sheet",
    "branch_from_filename": _unit_counts(
        "path, file_branch AS SUCURSAL", (_SALES, _DIRTY, _raw()), "files"
    ),
    "derive_calendar": _with(_SALES, _DIRTY)
    + f"SELECT TICKET, {POSITION}, {_TS} AS FECHA, DESCRIP_SUCURSAL AS SUCURSAL, "
    + f"CAST(year({_TS}) AS INTEGER) AS YEAR, CAST(month({_TS}) AS INTEGER) AS MONTH "
    + f"FROM dirty WHERE {_TS} IS NOT NULL",
    "coerce_int": _with(_SALES, _DIRTY)
    + f"SELECT TICKET, {POSITION}, "
    + ", ".join(f"{_to_int(c)} AS {c}" for c in INTEGER_COLUMNS)
    + " FROM dirty",
    "coerce_double": _with(_SALES, _DIRTY)
    + f"SELECT TICKET, {POSITION}, "
    + ", ".join(f"{_to_double(c)} AS {c}" for c in DOUBLE_COLUMNS)
    + " FROM dirty",
    "coerce_timestamp": _with(_SALES, _DIRTY)
    + f"SELECT TICKET, {POSITION}, {_TS} AS FECHA FROM dirty",
    "metrics_ars": _with(_SALES)
    + f"SELECT {_LINE_KEYS}, CANTIDAD_VENDIDA * VALOR_ARTICULO AS VENTA_ARS, "
    + "CANTIDAD_VENDIDA * COSTO_ARTICULO AS COSTO_ARS, CANTIDAD_VENDIDA * VALOR_ARTICULO "
    + "- CANTIDAD_VENDIDA * COSTO_ARTICULO AS MARGEN_ARS FROM sales",
    "metrics_usd": _with(_SALES, _RATES)
    + f"SELECT {_LINE_KEYS}, exchange_rate_ars_usd AS TIPO_CAMBIO, "
    + "(CANTIDAD_VENDIDA * VALOR_ARTICULO) / exchange_rate_ars_usd AS VENTA_USD, "
    + "(CANTIDAD_VENDIDA * COSTO_ARTICULO) / exchange_rate_ars_usd AS COSTO_USD, "
    + "(CANTIDAD_VENDIDA * VALOR_ARTICULO - CANTIDAD_VENDIDA * COSTO_ARTICULO) "
    + "/ exchange_rate_ars_usd AS MARGEN_USD "
    + "FROM sales s LEFT JOIN rates r ON s.YEAR = r.year AND s.MONTH = r.month",
    "calendar_columns": _unit_counts(
        f"FECHA, CAST(day(FECHA) AS BIGINT) AS DIA_MES, {_WEEKDAY} AS DIA_SEMANA",
        (_SALES,),
        "sales",
    ),
    "month_name": _unit_counts(
        f"MONTH, {_in_spanish(MONTHS, 'MONTH')} AS MONTH_NAME", (_SALES,), "sales"
    ),
    "margin_ratio": _with(*_CLEAN, _FAMILY_SUMS)
    + f"SELECT {UNIT}, FAMILIA, round(coalesce(ma / nullif(va, 0), 0), 6) AS MARGEN_PORC_ARS, "
    + "round(coalesce(mu / nullif(vu, 0), 0), 6) AS MARGEN_PORC_USD FROM family",
    "target_class": _with(*_CLEAN, _FAMILY_SUMS)
    + f"SELECT {UNIT}, FAMILIA, CASE WHEN mu / vu < 0.20 THEN 'no alcanzó' "
    + "WHEN mu / vu = 0.20 THEN 'igualó' WHEN mu / vu > 0.20 THEN 'superó' "
    + "ELSE 'sin datos' END AS CUMPLIMIENTO_OBJETIVO FROM family",
    "filter_valid_date": _with(_SALES, _DIRTY)
    + f"SELECT TICKET, {POSITION}, {_TS} AS FECHA FROM dirty WHERE {_TS} IS NOT NULL",
    "filter_positive": _with(_SALES, _DIRTY)
    + f"SELECT TICKET, {POSITION}, {_to_int('ID_ARTICULO')} AS ID_ARTICULO, "
    + f"{_to_int('CANTIDAD_VENDIDA')} AS CANTIDAD_VENDIDA, "
    + f"({_to_int('CANTIDAD_VENDIDA')}) * ({_to_double('VALOR_ARTICULO')}) AS VENTA_ARS FROM dirty "
    + f"WHERE ({_to_int('CANTIDAD_VENDIDA')}) * ({_to_double('VALOR_ARTICULO')}) > 0",
    "rate_gap_report": _with(_SALES, _RATES)
    + "SELECT s.YEAR, s.MONTH, count(*) AS row_count, "
    + "count(*) FILTER (WHERE exchange_rate_ars_usd IS NULL) AS without_rate "
    + "FROM sales s LEFT JOIN rates r ON s.YEAR = r.year AND s.MONTH = r.month GROUP BY ALL",
    "join_rates": _with(_SALES, _RATES)
    + f"SELECT {_LINE_KEYS}, s.YEAR, s.MONTH, exchange_rate_ars_usd AS TIPO_CAMBIO "
    + "FROM sales s LEFT JOIN rates r ON s.YEAR = r.year AND s.MONTH = r.month",
    "join_rates_filled": _with(_SALES, _RATES)
    + "SELECT s.YEAR, s.MONTH, CASE WHEN s.YEAR * 12 + s.MONTH > l.m THEN l.rate "
    + "ELSE exchange_rate_ars_usd END AS TIPO_CAMBIO, count(*) AS row_count "
    + "FROM sales s LEFT JOIN filled r ON s.YEAR = r.year AND s.MONTH = r.month "
    + "CROSS JOIN last_rate l GROUP BY ALL",
    "rates_ffill": _with(_RATES) + "SELECT year, month, exchange_rate_ars_usd FROM filled",
    "dedup_first": _with(*_CLEAN)
    + f"SELECT {_LINE_KEYS}, FECHA, {UNIT}, CANTIDAD_VENDIDA FROM first_lines",
    "agg_product_month": _with(*_CLEAN, _PRODUCTS)
    + f"SELECT {_rounded(_PRODUCT_COLUMNS)} FROM product_ratios",
    "agg_day_of_month": _with(*_CLEAN, _PRODUCTS)
    + f"SELECT {_rounded(UNIT + ', DIA_MES, VENTA_USD')} FROM day_sales",
    "agg_weekday": _with(*_CLEAN, _PRODUCTS)
    + f"SELECT {_rounded(UNIT + ', DIA_SEMANA, VENTA_USD')} FROM weekday_sales",
    "top_product": _with(*_CLEAN, _PRODUCTS) + "SELECT * FROM best_product",
    "top_day": _with(*_CLEAN, _PRODUCTS) + "SELECT * FROM best_day",
    "top_weekday": _with(*_CLEAN, _PRODUCTS) + "SELECT * FROM best_weekday",
    "join_best_product": _with_best("best_product"),
    "join_best_day": _with_best("best_day"),
    "join_best_weekday": _with_best("best_weekday"),
    "profile_weekday": _with(*_CLEAN)
    + "SELECT ORDEN, d.DIA_SEMANA, round(avg(VENTA_USD), 4) AS VENTA_USD FROM (VALUES "
    + ", ".join(f"({i}, '{d}')" for i, d in enumerate(WEEKDAYS, start=1))
    + ") AS d(ORDEN, DIA_SEMANA) LEFT JOIN silver s ON s.DIA_SEMANA = d.DIA_SEMANA GROUP BY ALL",
    "profile_branch_weekday": _profile("SUCURSAL", "DIA_SEMANA"),
    "pivot_weekday": _pivot("DIA_SEMANA", WEEKDAYS),
    "trend_weekly_chain": _trend_query("DIA_SEMANA", "SEMANAL", "chain"),
    "trend_weekly_partition": _trend_query("DIA_SEMANA", "SEMANAL", "partition"),
    "profile_day": _profile("", "DIA_MES"),
    "profile_branch_day": _profile("SUCURSAL", "DIA_MES"),
    "pivot_day": _pivot("DIA_MES", DAYS_OF_MONTH),
    "trend_monthly_chain": _trend_query("DIA_MES", "MENSUAL", "chain"),
    "trend_monthly_chain_low": _trend_query("DIA_MES", "MENSUAL", "chain", 0.3),
    "trend_monthly_partition": _trend_query("DIA_MES", "MENSUAL", "partition"),
    "trend_flags": _with(*_CLEAN, _both_trends("chain"))
    + "SELECT SUCURSAL, round(CORRELACION_SEMANAL, 6) AS CORRELACION_SEMANAL, "
    + "SIGUE_TENDENCIA_SEMANAL, round(CORRELACION_MENSUAL, 6) AS CORRELACION_MENSUAL, "
    + "SIGUE_TENDENCIA_MENSUAL FROM flags",
    "bronze_build": _with(_SALES, _DIRTY, _raw(), _BRONZE) + "SELECT * FROM bronze",
    "silver_build": _silver_of_dirty(),
    "silver_build_filled": _silver_of_dirty(fill=True),
    "gold_build": _gold("chain"),
    "gold_build_partition": _gold("partition"),
    "medallion_gold": _gold(
        "chain",
        (_SALES, _DIRTY, _RATES, _raw(_NUMBERED), _TYPED_FILES, _silver(order="path, sheet, row_no")),
    ),
    "silver_audit": _with(
        _SALES, _DIRTY, _RATES, _raw(_NUMBERED), _BRONZE, _MIXED, _TYPED_MIXED, _silver(order="_src_file, YEAR, _src_row")
    )
    + f"""
, units AS (
  SELECT {UNIT}, count(*) AS rows_in, bool_or(damaged) AS damaged,
    max(CASE WHEN k % 5 = 2 THEN 'NOTA' WHEN k % 5 = 3 THEN 'OBS' END) AS unexpected
  FROM mixed GROUP BY {UNIT}
),
written AS (
  SELECT {UNIT}, count(*) AS n, count(*) FILTER (WHERE TIPO_CAMBIO IS NULL) AS without_rate
  FROM silver GROUP BY {UNIT}
)
SELECT {UNIT}, rows_in, coalesce(n, 0) AS rows_out, without_rate AS rows_without_rate, unexpected,
  CASE WHEN damaged THEN 'missing_columns: COSTO_ARTICULO' WHEN n IS NULL THEN 'no_output_rows' END AS reason,
  CASE WHEN damaged THEN 'failed' WHEN n IS NULL THEN 'empty' ELSE 'ok' END AS status
FROM units LEFT JOIN written USING ({UNIT})
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'rates_off_calendar: ' || count(*), 'warning'
FROM rate_rows WHERE month NOT BETWEEN 1 AND 12 HAVING count(*) > 0""",
    "load_audit": _with(_SALES, _DIRTY, _raw())
    + f"""
SELECT path, sheet, data_rows, bad_dates, unexpected,
  CASE WHEN reason IS NULL AND data_rows > 0 AND bad_dates = data_rows THEN 'no_valid_dates' ELSE reason END AS reason,
  CASE WHEN reason IS NOT NULL THEN 'failed' WHEN data_rows > 0 AND bad_dates = data_rows THEN 'empty' ELSE 'ok' END AS status
FROM (
  SELECT path, sheet, count(*) FILTER (WHERE row_no > 1) AS data_rows,
    count(*) FILTER (WHERE row_no > 1 AND {_TS} IS NULL) AS bad_dates,
    nullif(max(unexpected), '') AS unexpected,
    max(CASE WHEN error IS NOT NULL THEN error WHEN file_branch = '' THEN 'empty_branch'
        WHEN missing <> '' THEN 'missing_columns: ' || missing END) AS reason
  FROM files GROUP BY path, sheet
)""",
}
