"""The same questions in SQL, for the engine that checks the results."""

from __future__ import annotations

from functools import reduce

from tallyhouse import rules
from tallyhouse.workload.tables import (
    AS_OF,
    COST_HISTORY_END,
    COST_YEAR,
    CUSTOMER_RANGE,
    CUTOFF,
    HISTORY_END,
    ORDINAL_STRIDE,
    SEGMENT_CHANNELS,
    VERSION_YEARS,
)


def _case(column: str, pairs, otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_quote(key)} THEN {_quote(value)}" for key, value in pairs)
    return f"CASE {column} {whens} ELSE {otherwise} END"


def _quote(value) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_quote(value) for value in values)


def _name(column: str, names) -> str:
    return f"([{_list(names)}])[month({column})]"


CHAIN, WHOLESALER, PHARMACY = map(_quote, (rules.CHAIN, rules.WHOLESALER, rules.PHARMACY))
CENTS = "CAST(CAST({} AS DECIMAL(18,2)) * 100 AS BIGINT)"

# ------------------------------------------------------------------ segmentation
METRICS = f"""
daily AS (
  SELECT c_mktsegment AS canal, c_name AS customer_id, o_orderdate AS order_date,
         CAST(sum({CENTS.format('o_totalprice')}) AS BIGINT) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
metrics AS (
  SELECT canal, customer_id, CAST(date_diff('day', max(order_date), TIMESTAMP '{AS_OF}') AS INTEGER) AS recency_days,
         count(*) AS purchase_dates, CAST(sum(cents) AS BIGINT) AS cents
  FROM daily GROUP BY ALL)"""

SCORES = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY canal ORDER BY purchase_dates, customer_id) AS rnk FROM metrics),
cuts AS (
  SELECT canal, quantile_cont(CAST(recency_days AS DOUBLE), [.2,.4,.6,.8]) AS r,
         quantile_cont(CAST(rnk AS DOUBLE), [.2,.4,.6,.8]) AS f,
         quantile_cont(cents / 100000, [.2,.4,.6,.8]) AS m
  FROM ranked GROUP BY canal),
scores AS (
  SELECT canal, customer_id, recency_days, purchase_dates, cents,
         CAST(5 - len(list_filter(r, lambda x: x < recency_days)) AS INTEGER) AS recency_score,
         CAST(1 + len(list_filter(f, lambda x: x < rnk)) AS INTEGER) AS frequency_score,
         CAST(1 + len(list_filter(m, lambda x: x < cents / 100000)) AS INTEGER) AS monetary_score
  FROM ranked JOIN cuts USING (canal)),
segment_rules AS (
  SELECT * FROM (VALUES """ + ", ".join(
    f"({score}, {_quote(name)})" for score, name in rules.SEGMENT_OF_SCORE.items()
) + """) v(score, categoria)),
segments AS (
  SELECT customer_id AS id_cliente, recency_days AS dias_recencia, purchase_dates AS num_transacciones,
         cents / 100000 AS monto, recency_score AS recencia_punt, frequency_score AS frecuencia_punt,
         monetary_score AS valor_punt, recency_score * 100 + frequency_score * 10 + monetary_score AS score_rfm,
         canal, coalesce(categoria, 'No clasificado') AS categoria, cents / 100000 AS ingresos
  FROM scores LEFT JOIN segment_rules
    ON score = recency_score * 100 + frequency_score * 10 + monetary_score)"""

LINE_SALES = """
raw_sales AS (
  SELECT CASE WHEN NOT (o_orderpriority = '4-NOT SPECIFIED' AND l_returnflag = 'N')
              THEN o_custkey || '-' || l_linenumber END AS nit,
         CASE WHEN l_discount < 0.1 THEN CAST(l_partkey AS VARCHAR) END AS referencia,
         c_mktsegment AS linea_de_mercado,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'sin fecha'
              WHEN o_orderstatus = 'P' THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS fecha,
         CASE WHEN l_tax = 0 THEN 'n/d'
              ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') END AS valor_bruto_local,
         CAST(l_quantity AS BIGINT) AS cantidad
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
clean_sales AS (
  SELECT split_part(nit, '-', 1) AS nit, referencia, linea_de_mercado,
         CAST(coalesce(try_strptime(trim(fecha), '%Y-%m-%d'), try_strptime(trim(fecha), '%Y-%m-%d %H:%M:%S')) AS DATE)
           AS fecha,
         TRY_CAST(replace(valor_bruto_local, ',', '.') AS DECIMAL(18,2)) AS valor_bruto_local, cantidad
  FROM raw_sales),
register AS (
  SELECT CAST(c_custkey AS VARCHAR) AS nit, c_name AS razon_social FROM customer WHERE c_acctbal >= 0),
named_sales AS (
  SELECT s.*, razon_social FROM clean_sales s LEFT JOIN register USING (nit)
  WHERE referencia IS NOT NULL AND referencia NOT IN (""" + _list(rules.EXCLUDED_REFERENCES) + "))"

LINE_METRICS = f"""
daily AS (
  SELECT linea_de_mercado AS canal, razon_social AS customer_id, fecha AS order_date,
         CAST(coalesce(sum(CAST(valor_bruto_local * 100 AS BIGINT)), 0) AS BIGINT) AS cents
  FROM named_sales WHERE razon_social IS NOT NULL AND fecha IS NOT NULL GROUP BY ALL),
metrics AS (
  SELECT canal, customer_id, CAST(date_diff('day', max(order_date), DATE '{AS_OF}') AS INTEGER) AS recency_days,
         count(*) AS purchase_dates, CAST(sum(cents) AS BIGINT) AS cents
  FROM daily GROUP BY ALL)"""

# ------------------------------------------------------------------ products
PRODUCT_TEXT = """CASE
    WHEN p_type = 'STANDARD' THEN 'NAT JABO ' || upper(p_name) || ' X ' || p_size || 'UND'
    WHEN p_type = 'PROMO' THEN 'JDE CREM ' || upper(p_name) || ' X' || p_size || 'ML'
    WHEN p_type = 'ECONOMY' THEN ' nat gel duch ' || lower(p_name) || ' x ' || p_size || 'gr '
    WHEN p_type = 'SMALL' THEN 'CED HUME LIQ ' || upper(p_name)
    WHEN p_type = 'MEDIUM' THEN 'NAT  EFERV ACTI ' || upper(p_name) || ' X '
                                || CASE WHEN p_size < 25 THEN '48UND' ELSE '6UND x 2' END
    WHEN p_type = 'LARGE' AND p_size <= 40 THEN 'PER JAB VEG SPA ' || upper(p_name) || ' BOX' || p_size END"""
PRODUCT_BRAND = "CASE WHEN p_type IN ('PROMO', 'LARGE') AND p_size > 20 THEN p_brand END"


def _replaced(column: str, replacements) -> str:
    return reduce(lambda sql, rule: f"regexp_replace({sql}, '\\b{rule[0]}\\b', '{rule[1]}', 'g')", replacements, column)


def _brand(description: str, brand: str) -> str:
    whens = " ".join(f"WHEN starts_with({description}, {_quote(p)}) THEN {_quote(b)}" for p, b in rules.BRAND_PREFIXES)
    return f"coalesce({brand}, CASE {whens} END)"


def _product_columns(d: str) -> dict[str, str]:
    found = f"coalesce(nullif(regexp_extract({d}, '(?i)X\\s*(\\d+\\S*)', 1), ''), 'NA')"
    normal = f"regexp_replace({_replaced(f'trim(upper({found}))', rules.PACK_REPLACEMENTS)}, '\\s+', ' ', 'g')"
    name = f"trim(regexp_split_to_array({d}, '\\s+X\\s*\\d')[1])"
    return {
        "has_pack": f"coalesce(regexp_matches({d}, '(?i)\\s+X\\s*\\d'), false)",
        "found": found,
        "pack": f"CASE WHEN {normal} = 'NA' AND {d} IS NOT NULL THEN '1UND' ELSE {normal} END",
        "name": name,
        "product": f"regexp_replace({_replaced(f'trim(upper({name}))', rules.PRODUCT_REPLACEMENTS)}, '\\s+', ' ', 'g')",
    }


PRODUCT = _product_columns("d")
PARTS = f"parts AS (SELECT p_partkey, {PRODUCT_TEXT} AS d, {PRODUCT_BRAND} AS b FROM part)"

LINE_EXPORT = f"""
products AS (
  SELECT p_partkey, d, {_brand('d', 'b')} AS marca, b, {PRODUCT['pack']} AS cantidades, {PRODUCT['product']} AS producto
  FROM (SELECT p_partkey, {PRODUCT_TEXT} AS d, {PRODUCT_BRAND} AS b FROM part)),
export AS (
  SELECT CAST(o_orderdate AS DATE) AS fecha, b, marca, c_mktsegment AS linea_de_mercado,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN {WHOLESALER} ELSE c_name END AS razon_social,
         CAST(l_partkey AS VARCHAR) AS referencia, d AS desc_item, '77' || l_partkey AS ean_13, 'UND' AS um,
         CAST(l_linenumber AS VARCHAR) AS nit,
         CASE WHEN l_tax = 0.08 THEN CAST(l_quantity AS BIGINT) || '.5'
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS cantidad_inv,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS valor_bruto_local, cantidades, producto, l_tax, l_quantity
  FROM lineitem JOIN products ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey),
enriched AS (
  SELECT fecha, marca, linea_de_mercado, CAST(NULL AS VARCHAR) AS tipo_de_identificacion, razon_social, referencia,
         desc_item AS descitem, ean_13, um, nit, cantidad_inv, valor_bruto_local, cantidades, producto,
         CAST(l_quantity AS BIGINT) * CASE
           WHEN razon_social = {WHOLESALER} AND marca = {_quote(rules.BRAND_PREFIXES[0][1])}
           THEN {_case('cantidades', rules.PACK_UNITS, str(rules.OTHER_PACK_UNITS))} ELSE 1 END AS cantidad_invsell_int
  FROM export WHERE l_tax <> 0.08)"""

HOUSE_BRAND = _quote(rules.BRAND_PREFIXES[0][1])
ORDER_EXPORT = f"""
export AS (
  SELECT CAST(o_orderdate AS DATE) AS fecha,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN {HOUSE_BRAND} END AS marca,
         c_mktsegment AS linea_de_mercado, c_name AS razon_social,
         'NAT JABO ' || o_orderpriority || ' X 6UND' AS desc_item, CAST(o_orderkey AS VARCHAR) AS ean_13,
         CAST(day(o_orderdate) AS BIGINT) AS cantidad_inv, CAST(o_totalprice AS DECIMAL(18,2)) AS valor_bruto_local,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * {ORDINAL_STRIDE} + o_orderkey AS BIGINT)
           AS row_ord
  FROM orders JOIN customer ON o_custkey = c_custkey),
history AS (SELECT * REPLACE ({HOUSE_BRAND} AS marca) FROM export WHERE fecha < DATE '{HISTORY_END}'),
marker AS (SELECT * FROM history WHERE row_ord = (SELECT max(row_ord) FROM history)),
candidates AS (SELECT * FROM export WHERE fecha >= (SELECT max(fecha) FROM history)),
place AS (
  SELECT min(c.row_ord) AS place FROM candidates c, marker m
  WHERE coalesce(c.marca, {HOUSE_BRAND}) = m.marca AND c.linea_de_mercado = m.linea_de_mercado
    AND c.razon_social = m.razon_social AND c.fecha = m.fecha AND c.cantidad_inv = m.cantidad_inv
    AND c.valor_bruto_local = m.valor_bruto_local),
fresh AS (SELECT * FROM candidates WHERE row_ord > (SELECT place FROM place))"""

VERSION = f"(CASE WHEN year(fecha) < {VERSION_YEARS[0]} THEN 0 WHEN year(fecha) < {VERSION_YEARS[1]} THEN 1 ELSE 2 END)"
RESUME_STATUS = f"""WITH {ORDER_EXPORT} SELECT
        CASE WHEN place IS NULL THEN 'marker_missing' WHEN n = 0 THEN 'nothing_new' ELSE 'new_rows' END AS status,
        (SELECT max(fecha) FROM history) AS history_date, (SELECT fecha FROM marker) AS marker_date, n AS new_rows
        FROM place, (SELECT count(*) AS n FROM fresh)"""

# ------------------------------------------------------------------ costs
COSTS = f"""
monthly AS (
  SELECT CAST(l_partkey AS VARCHAR) AS referencia, 'item ' || l_partkey AS descitem, '001' AS instalacion, 'UND' AS um,
         ((sum({CENTS.format('l_extendedprice')}) * 100) // sum(CAST(l_quantity AS BIGINT))) / 10000 AS costo_prom,
         date_trunc('month', l_shipdate) AS m
  FROM lineitem GROUP BY l_partkey, date_trunc('month', l_shipdate)),
report AS (
  SELECT * EXCLUDE (m), upper(left(n, 1)) || substr(n, 2) AS mes, CAST(year(m) AS INTEGER) AS ano, m
  FROM (SELECT *, {_name('m', rules.MONTH_NAMES)} AS n FROM monthly)),
history AS (SELECT * EXCLUDE (n) FROM report WHERE m < DATE '{COST_HISTORY_END}'),
family AS (
  SELECT CAST(p_partkey AS VARCHAR) AS referencia, p_brand AS marca,
         CASE WHEN p_size > 10 THEN 'Si' END AS flag FROM part WHERE p_type <> 'ECONOMY'
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), NULL, 'No' FROM part WHERE p_type = 'PROMO'),
known AS (
  SELECT h.* EXCLUDE (m), marca, flag AS incluir_referencia_si_no FROM history h LEFT JOIN family USING (referencia)),
last_month AS (
  SELECT count(*) AS "rows", CAST(max(month(m)) AS INTEGER) AS month FROM history WHERE ano = {COST_YEAR}),
next_period AS (
  SELECT "rows", CAST(CASE WHEN month < 12 THEN month + 1 ELSE 1 END AS INTEGER) AS next_month,
         CAST(CASE WHEN month < 12 THEN {COST_YEAR} ELSE {COST_YEAR + 1} END AS INTEGER) AS next_year FROM last_month),
added AS (
  SELECT r.* EXCLUDE (m, n), {_quote(rules.BRAND_PREFIXES[1][1])} AS marca,
         CAST(NULL AS VARCHAR) AS incluir_referencia_si_no
  FROM report r, next_period WHERE month(m) = next_month AND year(m) = next_year)"""

# ------------------------------------------------------------------ sell-out
CHAIN_TEXT = f"""CASE WHEN n_nationkey < 10 THEN ' ' || s_name || ' - ' || n_name
    WHEN n_nationkey < 15 THEN s_name || '-' || n_name || '- LOCAL'
    WHEN n_nationkey < 18 THEN {_quote(rules.CHAIN_STORES[0][0])}
    WHEN n_nationkey < 20 THEN '  ' WHEN n_nationkey < 22 THEN NULL ELSE s_name END"""
WHOLESALE_TEXT = f"""CASE WHEN n_nationkey < 8 THEN n_nationkey || '-' || s_name || ' - ' || n_name
    WHEN n_nationkey < 14 THEN n_nationkey || '-Villa - ' || s_name || ' - ' || n_name
    WHEN n_nationkey < 16 THEN n_nationkey || {_quote('-' + rules.WHOLESALE_STORES[0][0].title())}
    WHEN n_nationkey < 18 THEN n_nationkey || {_quote('-' + rules.WHOLESALE_STORES[2][0].title())}
    WHEN n_nationkey < 20 THEN NULL WHEN n_nationkey < 21 THEN ' ' ELSE n_nationkey || '-' || s_name END"""

STORES = f"""
stores AS (
  SELECT s_suppkey, s_name, n_nationkey, n_name, {CHAIN_TEXT} AS chain_text, {WHOLESALE_TEXT} AS wholesale_text
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
chain_stores AS (
  SELECT s_suppkey, CASE WHEN name IS NULL THEN NULL {' '.join(f"WHEN name = {_quote(k)} THEN {_quote(s)}" for k, s, _ in rules.CHAIN_STORES)}
           WHEN contains(name, '-') THEN trim(split_part(name, '-', 1)) ELSE name END AS store,
         CASE WHEN name IS NULL THEN NULL {' '.join(f"WHEN name = {_quote(k)} THEN {_quote(c)}" for k, _, c in rules.CHAIN_STORES)}
           WHEN contains(name, '-') THEN trim(split_part(name, '-', 2)) ELSE {_quote(rules.UNKNOWN_CITY)} END AS city
  FROM (SELECT s_suppkey, trim(chain_text) AS name FROM stores)),
wholesale_stores AS (
  SELECT s_suppkey, CASE WHEN name IS NULL THEN '' {' '.join(f"WHEN name = {_quote(k)} THEN {_quote(s)}" for k, s, _ in rules.WHOLESALE_STORES)}
           WHEN contains(name, ' - ') THEN trim(regexp_extract(name, '^(.*) - (.*)$', 1))
           ELSE {_quote(rules.ONLY_STORE)} END AS store,
         CASE WHEN name IS NULL THEN '' {' '.join(f"WHEN name = {_quote(k)} THEN {_quote(c)}" for k, _, c in rules.WHOLESALE_STORES)}
           WHEN contains(name, ' - ') THEN trim(regexp_extract(name, '^(.*) - (.*)$', 2)) ELSE name END AS city
  FROM (SELECT s_suppkey, upper(trim(regexp_replace(wholesale_text, '^[^-]*-', ''))) AS name FROM stores))"""

HISTORY = f"""
history AS (
  SELECT {_name('d', rules.MONTH_CODES)} AS mes, CAST(year(d) AS INTEGER) AS ano, cliente, n AS unidades,
         CAST(month(d) AS INTEGER) AS nummes
  FROM (SELECT CASE o_orderstatus WHEN 'F' THEN {CHAIN} WHEN 'O' THEN {WHOLESALER} ELSE {PHARMACY} END AS cliente,
               date_trunc('month', o_orderdate) AS d, count(*) AS n FROM orders GROUP BY ALL)),
last_period AS (
  SELECT cliente, arg_max(mes, ano * 12 + nummes) AS ultimo_mes, arg_max(ano, ano * 12 + nummes) AS ultimo_ano,
         arg_max(unidades, ano * 12 + nummes) AS unidades, count(*) AS total_registros,
         max(make_date(ano, nummes, 1)) + INTERVAL 1 MONTH AS due
  FROM history GROUP BY cliente),
due AS (
  SELECT cliente, {_name('due', rules.MONTH_CODES)} AS mes, CAST(year(due) AS INTEGER) AS ano,
         CAST(month(due) AS INTEGER) AS nummes FROM last_period)"""

UNITS = "CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT)"
REPORTS = f"""{STORES}, {HISTORY}, {PARTS},
chain_detail AS (
  SELECT CAST(l_partkey AS VARCHAR) AS ean, {CHAIN} AS cliente, {_name('l_shipdate', rules.MONTH_NAMES_ENGLISH)} AS mes,
         CAST(year(l_shipdate) AS INTEGER) AS ano, store AS tienda, city AS ciudad, d AS descripcion,
         CAST(coalesce(sum(CASE WHEN l_tax > 0 THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT) AS unidades
  FROM lineitem JOIN parts ON l_partkey = p_partkey JOIN chain_stores ON l_suppkey = s_suppkey
  WHERE store <> '' AND d IS NOT NULL GROUP BY ALL),
matrix AS (
  SELECT l_suppkey, p_type, p_size, month(l_shipdate) AS month, sum({UNITS}) AS units
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
wholesale_rows AS (
  SELECT l_suppkey || '/' || p_type || p_size AS ean, {WHOLESALER} AS cliente,
         ([{_list(rules.MONTH_NAMES)}])[due.nummes] AS mes, due.ano, store AS tienda, city AS ciudad,
         p_type || ' ' || p_size AS descripcion, CAST(units AS BIGINT) AS unidades, due.nummes
  FROM matrix JOIN stores ON l_suppkey = stores.s_suppkey JOIN wholesale_stores w ON l_suppkey = w.s_suppkey
       JOIN due ON due.cliente = {WHOLESALER} AND month = due.nummes
  WHERE trim(wholesale_text) <> '' AND units <> 0),
pharmacy_rows AS (
  SELECT CAST(l_partkey AS VARCHAR) AS ean, {PHARMACY} AS cliente, due.mes, due.ano, s_name AS tienda,
         CASE WHEN n_nationkey <> 7 THEN n_name END AS ciudad, d AS descripcion,
         CAST(l_quantity * 0.5 AS DECIMAL(18,1)) AS unidades, due.nummes
  FROM lineitem JOIN parts ON l_partkey = p_partkey JOIN stores ON l_suppkey = s_suppkey
       JOIN due ON due.cliente = {PHARMACY}),
chain_city AS (SELECT c.*, due.nummes FROM chain_detail c JOIN due ON due.cliente = {CHAIN}),
wholesale_city AS (
  SELECT ean, cliente, mes, ano, tienda, ciudad, descripcion, CAST(sum(unidades) AS BIGINT) AS unidades, nummes
  FROM wholesale_rows GROUP BY ALL),
pharmacy_city AS (
  SELECT ean, cliente, mes, ano, tienda, ciudad, descripcion, CAST(floor(sum(unidades)) AS BIGINT) AS unidades, nummes
  FROM pharmacy_rows WHERE ciudad IS NOT NULL AND descripcion IS NOT NULL GROUP BY ALL),
totals AS (
  SELECT cliente, sum(unidades) AS unidades FROM (
    SELECT cliente, unidades FROM chain_detail UNION ALL SELECT cliente, unidades FROM wholesale_rows
    UNION ALL SELECT cliente, unidades FROM pharmacy_rows) GROUP BY cliente),
summary AS (
  SELECT due.mes, due.ano, due.cliente, CAST(floor(coalesce(unidades, 0)) AS BIGINT) AS unidades, due.nummes
  FROM due LEFT JOIN totals USING (cliente)),
city_history AS (
  SELECT CAST(NULL AS VARCHAR) AS ean, {PHARMACY} AS cliente, 'ENE' AS mes, CAST(1995 AS INTEGER) AS ano,
         c_mktsegment AS tienda, n_name AS ciudad, CAST(NULL AS VARCHAR) AS descripcion, count(*) AS unidades,
         CAST(1 AS INTEGER) AS nummes
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment, n_name)"""

FILES = f"""
files AS (
  SELECT k AS client_key,
         CASE p WHEN '1-URGENT' THEN c || '_' || k || e WHEN '2-HIGH' THEN lower(c) || '_' || lower(k) || e
                WHEN '3-MEDIUM' THEN c || k || e WHEN '4-NOT SPECIFIED' THEN 'XXX_' || k || e
                ELSE c || '_OTHER_' || k || e END AS file_name
  FROM (SELECT DISTINCT {_case('o_orderstatus', [('F', rules.RETAILERS[0][0]), ('O', rules.RETAILERS[1][0])], _quote(rules.RETAILERS[2][0]))} AS k,
               o_orderpriority AS p, {_name('o_orderdate', rules.MONTH_CODES)} AS c, {_quote(rules.LANDED_SUFFIX)} AS e
        FROM orders)),
gate AS (
  SELECT client_key, file_name, reason, CASE WHEN reason = 'ok' THEN upper(split_part(bare, '_', 1)) END AS month
  FROM (SELECT *, CASE
          WHEN file_name IS NULL OR trim(file_name) = '' THEN 'no_file'
          WHEN NOT contains(bare, '_') THEN 'bad_format'
          WHEN upper(split_part(bare, '_', 1)) NOT IN ({_list(rules.MONTH_CODES)}) THEN 'bad_month'
          WHEN upper(substr(bare, strpos(bare, '_') + 1)) <> upper(client_key) THEN 'wrong_client'
          ELSE 'ok' END AS reason
        FROM (SELECT *, replace(file_name, {_quote(rules.LANDED_SUFFIX)}, '') AS bare FROM files)))"""

CELLS = """
cells AS (
  SELECT o_orderkey,
         CASE o_orderpriority WHEN '1-URGENT' THEN '  ' || replace(price, '.', ',') || ' '
              WHEN '2-HIGH' THEN o_custkey || '00000' WHEN '3-MEDIUM' THEN ' NaN '
              WHEN '4-NOT SPECIFIED' THEN 'LINEA   ' || o_orderstatus || '  DOS' ELSE price END AS cell,
         CASE WHEN o_orderstatus = 'P' THEN ' ' || day || ' 12:30:00 '
              WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'pendiente' ELSE day END AS fecha,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'n/d' ELSE replace(price, '.', ',') END AS valor,
         o_custkey || CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'D' END AS codigo
  FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
               strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders))"""

TYPED_LINES = """SELECT l_orderkey AS "order", CAST(l_quantity AS BIGINT) AS units,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
        CASE WHEN l_returnflag <> 'A' THEN CAST(l_shipdate AS DATE) END AS day FROM lineitem"""
UNPIVOTED = f"""WITH {REPORTS} SELECT wholesale_text AS tienda, CAST(p_size AS VARCHAR)
        AS numero_de_articulo_makro, p_type || ' ' || p_size AS descripcion_del_articulo,
        l_suppkey || '/' || p_type || p_size AS codigo_de_barras, ([{_list(rules.MONTH_NAMES)}])[month] AS mes,
        CAST(units AS BIGINT) AS unidades FROM matrix JOIN stores ON l_suppkey = s_suppkey
        WHERE trim(wholesale_text) <> '' AND units <> 0"""

CODE_NUMBER = [(code, i) for i, code in enumerate(rules.MONTH_CODES, 1)]

ORACLES = {
    "rfm_segments": f"WITH {METRICS}, {SCORES} SELECT * FROM segments",
    "rfm_scores": f"""WITH {METRICS}, {SCORES} SELECT * EXCLUDE (cents),
        recency_score * 100 + frequency_score * 10 + monetary_score AS rfm_score FROM scores""",
    "rfm_metrics": f"WITH {METRICS} SELECT * EXCLUDE (cents), cents / 100000 AS monetary FROM metrics",
    "rfm_metrics_of_channels": f"""WITH {METRICS} SELECT * EXCLUDE (cents), cents / 100000 AS monetary FROM metrics
        WHERE canal IN ({_list(SEGMENT_CHANNELS[:2])})""",
    "daily_revenue": f"""WITH {METRICS} SELECT canal, customer_id, CAST(order_date AS DATE) AS order_date,
        cents / 100000 AS revenue_miles FROM daily""",
    "quintile_cuts": f"""WITH {METRICS}, {SCORES} SELECT canal, measure, CAST(k AS INTEGER) AS k, round(l[k], 6) AS cut
        FROM (SELECT canal, 'recency' AS measure, r AS l FROM cuts UNION ALL SELECT canal, 'frequency', f FROM cuts
              UNION ALL SELECT canal, 'monetary', m FROM cuts), range(1, 5) t(k)""",
    "frequency_rank": f'WITH {METRICS}, {SCORES} SELECT canal, customer_id, purchase_dates, rnk AS "rank" FROM ranked',
    "segment_lookup": f"""WITH {METRICS}, {SCORES}, scored AS (
        SELECT CAST(left(o_orderpriority, 1) AS INTEGER) * 100 + CAST(1 + day(o_orderdate) % 5 AS INTEGER) * 10
               + CAST(isodow(o_orderdate) AS INTEGER) - 1 AS s, count(*) AS orders FROM orders GROUP BY ALL)
        SELECT CAST(s AS INTEGER) AS score, orders, coalesce(categoria, 'No clasificado') AS categoria
        FROM scored LEFT JOIN segment_rules ON s = score""",
    "rfm_inputs": f"WITH {LINE_SALES} SELECT * FROM clean_sales",
    "rfm_customers": f"WITH {LINE_SALES} SELECT * FROM register",
    "rfm_end_to_end": f"WITH {LINE_SALES}, {LINE_METRICS}, {SCORES} SELECT * FROM segments",
    "sales_with_customer": f"WITH {LINE_SALES} SELECT * FROM named_sales",
    "unmatched_customers": f"WITH {LINE_SALES} SELECT * FROM named_sales WHERE razon_social IS NULL",
    "tax_id_root": f"""WITH {LINE_SALES} SELECT regexp_replace(nit, '-.*', '') AS nit, count(*) AS lines
        FROM raw_sales GROUP BY 1""",
    "exclude_references": f"""WITH {LINE_SALES} SELECT * FROM raw_sales WHERE referencia IS NOT NULL
        AND referencia NOT IN ({_list(rules.EXCLUDED_REFERENCES)})""",
    "customers_dedup": f"""WITH f AS (
        SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey || '-' || c_custkey END AS nit,
               c_name AS razon_social, c_custkey AS row_ord FROM customer
        UNION ALL
        SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey || '-' || c_custkey END, c_name || ' SAS',
               c_custkey + {ORDINAL_STRIDE} FROM customer)
        SELECT nit, arg_min(razon_social, row_ord) AS razon_social, min(row_ord) AS row_ord FROM f GROUP BY nit""",
    "dedup_full_row": "SELECT DISTINCT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem",
    "weekly_purchase_count": f"""WITH {LINE_SALES} SELECT CAST(year(semana) AS VARCHAR) AS ano,
        {_name('semana', rules.MONTH_NAMES)} AS mes, semana, lpad(CAST(month(semana) AS VARCHAR), 2, '0') AS mes_num,
        linea_de_mercado, nit AS razon_social, count(*) AS numcompras
        FROM (SELECT *, CAST(date_trunc('week', fecha) AS DATE) AS semana FROM clean_sales)
        WHERE semana IS NOT NULL AND nit IS NOT NULL GROUP BY ALL""",
    "brand_from_prefix": f"WITH {PARTS} SELECT p_partkey, {_brand('d', 'b')} AS brand FROM parts",
    "pack_parse": f"""WITH {PARTS} SELECT p_partkey, {PRODUCT['has_pack']} AS has_pack, {PRODUCT['found']} AS found,
        {PRODUCT['pack']} AS pack, {PRODUCT['name']} AS name FROM parts""",
    "product_normalized": f"WITH {PARTS} SELECT p_partkey, {PRODUCT['product']} AS product FROM parts",
    "pack_multiplier": f"""WITH {LINE_EXPORT} SELECT marca, cantidades, razon_social = {WHOLESALER} AS wholesaler,
        count(*) AS lines, CAST(sum(cantidad_invsell_int) AS BIGINT) AS units FROM enriched GROUP BY ALL""",
    "sales_enriched": f"WITH {LINE_EXPORT} SELECT * FROM enriched WHERE fecha > DATE '{CUTOFF}'",
    "sales_without_units": f"""WITH {LINE_EXPORT} SELECT fecha, b AS marca, linea_de_mercado, razon_social, referencia,
        desc_item, ean_13, um, nit, cantidad_inv, valor_bruto_local FROM export WHERE l_tax = 0.08""",
    "reference_key": """SELECT p_partkey, CASE WHEN p_type <> 'LARGE'
        THEN replace(replace('refn' || lower(p_name) || 'cu' || p_partkey, ' ', ''), '-', '') ELSE '' END AS key
        FROM part""",
    "sales_after_cutoff": f"WITH {ORDER_EXPORT} SELECT * FROM export WHERE fecha > DATE '{CUTOFF}'",
    "sales_since_history_max": f"WITH {ORDER_EXPORT} SELECT * FROM candidates",
    "resume_after_marker": f"WITH {ORDER_EXPORT} SELECT * RENAME (ean_13 AS ean) FROM fresh",
    "resume_status": RESUME_STATUS,
    "sales_refresh": f"""WITH {ORDER_EXPORT}
        SELECT fecha, marca, linea_de_mercado, razon_social, desc_item AS descitem, ean_13 AS ean, cantidad_inv,
               valor_bruto_local, row_ord, CAST(NULL AS VARCHAR) AS tipo_de_identificacion,
               CAST(NULL AS VARCHAR) AS cantidades, CAST(NULL AS VARCHAR) AS producto,
               CAST(NULL AS BIGINT) AS cantidad_invsell_int FROM history
        UNION ALL
        SELECT fecha, coalesce(marca, {HOUSE_BRAND}), linea_de_mercado, razon_social, desc_item, ean_13, cantidad_inv,
               valor_bruto_local, row_ord, NULL, '6UND', 'NAT JABON ' || substr(desc_item, 10, length(desc_item) - 16),
               cantidad_inv FROM fresh WHERE fecha > DATE '{CUTOFF}'""",
    "table_versions": f"""WITH {ORDER_EXPORT} SELECT CAST({VERSION} AS BIGINT) AS version, count(*) AS "rows",
        CAST(0 AS BIGINT) AS unordered, min(row_ord) AS least_order, max(row_ord) AS greatest_order,
        min(fecha) AS oldest, max(fecha) AS newest FROM export GROUP BY 1""",
    "version_rows": f"WITH {ORDER_EXPORT} SELECT * FROM export WHERE {VERSION} <= 1",
    "resume_status_by_marks": RESUME_STATUS,
    "sorted_output": """SELECT o_custkey, o_orderkey, o_totalprice,
        row_number() OVER (ORDER BY o_custkey, o_orderkey) AS place FROM orders""",
    "sorted_range": f"""SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        WHERE o_custkey BETWEEN {CUSTOMER_RANGE[0]} AND {CUSTOMER_RANGE[1]}""",
    "load_sales_tables": f"""WITH {ORDER_EXPORT}, {COSTS.replace('history', 'cost_history')}
        SELECT 'history' AS source, count(*) AS loaded, CAST(sum(valor_bruto_local) AS DOUBLE) AS total FROM export
          WHERE {VERSION} = 0
        UNION ALL SELECT 'new', count(*), CAST(sum(valor_bruto_local) AS DOUBLE) FROM export
        UNION ALL SELECT 'customers', 2 * count(*), NULL FROM customer
        UNION ALL SELECT 'costs_history', count(*), sum(ano) FROM cost_history
        UNION ALL SELECT 'costs_new', count(*), sum(ano) FROM report
        UNION ALL SELECT 'family', count(*), NULL FROM family
        UNION ALL SELECT 'untyped', 0, NULL""",
    "load_sellout_tables": f"""WITH {REPORTS}
        SELECT 'history' AS source, count(*) AS loaded, CAST(sum(unidades) AS DOUBLE) AS total FROM history
        UNION ALL SELECT 'cities', count(*), sum(unidades) FROM city_history
        UNION ALL SELECT 'report_' || {CHAIN}, count(*), sum(unidades) FROM chain_city
        UNION ALL SELECT 'report_' || {PHARMACY}, count(*), sum(unidades) FROM pharmacy_city""",
    "load_segment_tables": f"""WITH {LINE_SALES}
        SELECT 'sales' AS source, count(*) AS loaded, CAST(sum(valor_bruto_local * 100) AS DOUBLE) AS total FROM clean_sales
        UNION ALL SELECT 'unread', count(*), NULL FROM raw_sales WHERE valor_bruto_local = 'n/d' OR fecha = 'sin fecha'
        UNION ALL SELECT 'register', count(*), NULL FROM register""",
    "required_columns": f"""WITH {ORDER_EXPORT}, {LINE_SALES}, {COSTS.replace('history', 'cost_history')}
        SELECT 'orders' AS source, 'Fecha' AS "column", count(fecha) AS filled FROM export
        UNION ALL SELECT 'orders', 'Referencia', NULL
        UNION ALL SELECT 'orders', 'Valor bruto local', count(valor_bruto_local) FROM export
        UNION ALL SELECT 'lines', 'Fecha', count(fecha) FROM raw_sales
        UNION ALL SELECT 'lines', 'Referencia', count(referencia) FROM raw_sales
        UNION ALL SELECT 'lines', 'Valor bruto local', count(valor_bruto_local) FROM raw_sales
        UNION ALL SELECT 'costs', 'Fecha', NULL
        UNION ALL SELECT 'costs', 'Referencia', count(referencia) FROM cost_history
        UNION ALL SELECT 'costs', 'Valor bruto local', NULL""",
    "scan_typed": """SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate), row_number() OVER () - 1 AS place
        FROM orders""",
    "scan_string_then_type": TYPED_LINES,
    "scan_text_file": TYPED_LINES,
    "untyped_rows": """SELECT CAST(l_orderkey AS VARCHAR) AS "order", ' ' || CAST(l_quantity AS BIGINT) AS units,
        replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS amount, '?' AS day
        FROM lineitem WHERE l_returnflag = 'A'""",
    "parse_dates_strict": "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem",
    "parse_dates": f"""WITH {CELLS} SELECT o_orderkey, CAST(coalesce(try_strptime(trim(fecha), '%Y-%m-%d'),
        try_strptime(trim(fecha), '%Y-%m-%d %H:%M:%S')) AS DATE) AS day FROM cells""",
    "parse_decimal_comma": f"""WITH {CELLS} SELECT o_orderkey,
        CAST(TRY_CAST(replace(valor, ',', '.') AS DECIMAL(18,2)) AS DOUBLE) AS value FROM cells""",
    "canonical_key": f"""WITH {CELLS} SELECT o_orderkey, CASE
        WHEN length(bare) > 4 AND bare LIKE '%00000' AND rtrim(bare, '0') <> '' THEN rtrim(bare, '0') ELSE bare END AS key
        FROM (SELECT o_orderkey, CASE WHEN trim(cell) NOT IN ({_list(rules.MISSING_TEXT)})
              THEN replace(replace(replace(cell, ' ', ''), ',', ''), '.', '') END AS bare FROM cells)""",
    "clean_table": f"""WITH {CELLS}, bare AS (
        SELECT o_orderkey, CASE WHEN trim(cell) NOT IN ({_list(rules.MISSING_TEXT)})
                 THEN regexp_replace(cell, '[ ,.]', '', 'g') END AS celda_libre,
               CASE WHEN fecha <> 'pendiente' THEN replace(fecha, ' ', '') END AS dia,
               CASE WHEN valor <> 'n/d' THEN regexp_replace(valor, '[,.]', '', 'g') END AS valor_bruto, codigo
        FROM cells)
        SELECT o_orderkey, regexp_replace(celda_libre, '^(.*[^0])0{{5,}}$', '\\1') AS celda_libre, dia,
               CAST(regexp_replace(valor_bruto, '^(.*[^0])0{{5,}}$', '\\1') AS BIGINT) AS valor_bruto, codigo
        FROM bare""",
    "normalize_headers": """SELECT s_suppkey AS codigo_prov, s_name AS razon_social, s_nationkey AS pais,
        s_acctbal AS saldo_bruto FROM supplier""",
    "drop_all_null_columns": "SELECT * FROM customer",
    "drop_all_null_rows": "SELECT * FROM customer WHERE c_acctbal > 0",
    "nonblank_stores": f"""WITH {STORES} SELECT CAST(l_partkey AS VARCHAR) AS ean, chain_text AS nomb_dependencia,
        CASE WHEN l_tax > 0 THEN CAST(l_quantity AS BIGINT) END AS unidades
        FROM lineitem JOIN stores ON l_suppkey = s_suppkey WHERE trim(chain_text) <> ''""",
    "cost_with_family": f"WITH {COSTS} SELECT * FROM known",
    "cost_next_period": f"WITH {COSTS} SELECT * FROM added",
    "next_period_by_year": f"WITH {COSTS} SELECT * FROM next_period",
    "cost_consolidated": f"WITH {COSTS} SELECT * FROM known UNION ALL BY NAME SELECT * FROM added",
    "unpivot_month_matrix": UNPIVOTED,
    "month_matrix_files": UNPIVOTED,
    "other_months": f"""WITH {REPORTS} SELECT * FROM chain_city
        WHERE mes <> ([{_list(rules.MONTH_NAMES_ENGLISH)}])[nummes]""",
    "unknown_months": f"""WITH {HISTORY} SELECT CASE WHEN nummes = 6 THEN 'JUNIO' END AS mes, ano, cliente, unidades, nummes
        FROM history WHERE nummes IN (6, 7)""",
    "store_city_chain": f"WITH {STORES} SELECT * FROM chain_stores",
    "store_city_wholesale": f"WITH {STORES} SELECT * FROM wholesale_stores",
    "sellout_city_chain": f"WITH {REPORTS} SELECT * FROM chain_city",
    "sellout_city_wholesale": f"WITH {REPORTS} SELECT * FROM wholesale_city",
    "sellout_city_pharmacy": f"WITH {REPORTS} SELECT * FROM pharmacy_city",
    "sellout_summary": f"WITH {REPORTS} SELECT * FROM summary",
    "sellout_summary_append": f"WITH {REPORTS} SELECT * FROM history UNION ALL BY NAME SELECT * FROM summary",
    "sellout_city_append": f"""WITH {REPORTS} SELECT * FROM city_history UNION ALL BY NAME SELECT * FROM chain_city
        UNION ALL BY NAME SELECT * FROM wholesale_city UNION ALL BY NAME SELECT * FROM pharmacy_city""",
    "union_optional_sources": """SELECT n_name AS name, n_regionkey AS region, CAST(NULL AS DOUBLE) AS balance FROM nation
        UNION ALL SELECT c_name, NULL, c_acctbal FROM customer UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier""",
    "client_last_period": f"""WITH {HISTORY} SELECT cliente, ultimo_mes, ultimo_ano,
        ultimo_mes || ' ' || ultimo_ano AS fecha_completa, unidades, total_registros, due.mes AS siguiente_mes,
        due.ano AS siguiente_ano FROM last_period JOIN due USING (cliente)""",
    "month_codes": f"""SELECT code, {_case('code', CODE_NUMBER)} AS number,
        {_case('code', [(c, n.capitalize()) for c, n in zip(rules.MONTH_CODES, rules.MONTH_NAMES)])} AS name, orders
        FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN '???' ELSE {_name('o_orderdate', rules.MONTH_CODES)} END AS code,
              count(*) AS orders FROM orders GROUP BY 1)""",
    "file_name_gate": f"WITH {FILES} SELECT * FROM gate",
    "period_gate": f"""WITH {FILES}, {HISTORY}, joined AS (
        SELECT client_key, due.cliente AS client_name, file_name, g.month, due.mes AS expected_month,
               due.ano AS expected_year, CASE WHEN reason <> 'ok' THEN reason WHEN g.month = due.mes THEN 'ok'
                 WHEN f.n < due.nummes OR (due.nummes = 1 AND f.n > 7) THEN 'already_processed'
                 ELSE 'unexpected_month' END AS reason
        FROM gate g JOIN (VALUES {', '.join(f'({_quote(k)}, {_quote(n)})' for k, n in rules.RETAILERS)}) r(k, n)
               ON client_key = r.k JOIN due ON due.cliente = r.n
             LEFT JOIN (VALUES {', '.join(f'({_quote(c)}, {i})' for c, i in CODE_NUMBER)}) f(c, n) ON f.c = g.month)
        SELECT *, reason = 'ok' AS processable FROM joined""",
}
