"""Oracle SQL (DuckDB) for every driver query: a brute-force restatement of
the same semantics over the pre-registered views of the driver tables."""

from __future__ import annotations

from casemart.plans import sqlfrag as S
from casemart.plans.world import (CITY, DATED_SOURCE, DEAD_RULE_SHIFT, RULE_ID_BASE, UNDATED_REFERENCE_YEAR,
                                  UNDATED_SOURCE)

ORACLE: dict[str, str] = {}


def nk(x: str) -> str:
    return S.normalize_key(x)


def nt(x: str) -> str:
    return S.normalize_text(x)


# ------------------------------------------------------------- phase 1: cleaning

ORACLE["clean_int_names"] = f"""
SELECT 'customer' AS origem, c_custkey AS chave, {S.clean_int('c_name')} AS numero FROM customer
UNION ALL
SELECT 'supplier' AS origem, s_suppkey AS chave, {S.clean_int('s_name')} AS numero FROM supplier
"""

ORACLE["normalize_text_docs"] = f"SELECT doc_id, {nt('text')} AS texto_normalizado FROM documents"
ORACLE["normalize_key_docs"] = f"SELECT doc_id, {nk('text')} AS chave FROM documents"
ORACLE["match_key_docs"] = f"SELECT doc_id, {S.match_key('text')} AS chave_match FROM documents"

PLACE_VARIANT = """CASE p_partkey % 7
  WHEN 0 THEN p_name
  WHEN 1 THEN upper(p_name)
  WHEN 2 THEN translate(p_name, 'aeiou', 'áéíóú')
  WHEN 3 THEN substr(p_name, 1, CAST(p_partkey % length(p_name) AS INTEGER))
              || substr(p_name, CAST(p_partkey % length(p_name) AS INTEGER) + 2)
  WHEN 4 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
  WHEN 5 THEN '  jd ' || p_name || ' ii '
  ELSE p_brand END"""

CASE_ID = "CASE WHEN l_linenumber = 7 THEN 'Nº' ELSE ' ' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) END"
SEX = "CASE l_returnflag WHEN 'R' THEN 'Feminino' WHEN 'A' THEN 'masculino  ' ELSE '' END"

RAW_CTES = f"""
cases_base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity, l.l_returnflag, l.l_linestatus, l.l_shipdate,
         p.p_partkey, p.p_name, p.p_brand
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
raw_dated AS (
  SELECT {CASE_ID} AS _c0,
         CASE WHEN l_linenumber = 6 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE strftime(l_shipdate, '%d/%m/%Y') END AS _c1,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS _c2,
         {SEX} AS _c3,
         {PLACE_VARIANT} AS _c4,
         ' UBS ' || CAST(l_suppkey % 10 AS VARCHAR) || ' ' AS _c5,
         CASE WHEN l_returnflag = 'R' THEN 'Positivo' ELSE 'não reagente' END AS _c6
  FROM cases_base WHERE l_linestatus = 'F'),
raw_undated AS (
  SELECT {CASE_ID} AS _c0, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS _c1, {SEX} AS _c2,
         {PLACE_VARIANT} AS _c3
  FROM cases_base WHERE l_linestatus = 'O'),
linelist_dated AS (
  SELECT * FROM (
    SELECT CAST(try_strptime(trim(_c1), '%d/%m/%Y') AS DATE) AS data, {S.clean_int('_c2')} AS idade,
           {nt('_c3')} AS sexo, {nt('_c4')} AS bairro, trim(_c5) AS unidade_notificacao, {nt('_c6')} AS exame,
           '{DATED_SOURCE}' AS doenca
    FROM raw_dated WHERE regexp_full_match(trim(_c0), '[0-9]+'))
  WHERE bairro IS NOT NULL AND bairro <> ''),
linelist_undated AS (
  SELECT * FROM (
    SELECT {S.clean_int('_c1')} AS idade, {nt('_c2')} AS sexo, {nt('_c3')} AS bairro,
           {UNDATED_REFERENCE_YEAR} AS ano_referencia, '{UNDATED_SOURCE}' AS doenca
    FROM raw_undated WHERE regexp_full_match(trim(_c0), '[0-9]+'))
  WHERE bairro IS NOT NULL AND bairro <> '')"""

ORACLE["match_key_places"] = f"""
WITH {RAW_CTES}
SELECT bairro_bruto, {S.match_key('bairro_bruto')} AS chave_match
FROM (SELECT _c4 AS bairro_bruto FROM raw_dated UNION SELECT _c3 FROM raw_undated)
"""

ORACLE["linelist_dated"] = f"WITH {RAW_CTES} SELECT * FROM linelist_dated"
ORACLE["linelist_undated"] = f"WITH {RAW_CTES} SELECT * FROM linelist_undated"

# ------------------------------------------------ phase 1: dimensions and facts

ORDERS_CTES = f"""
dim_seg AS ({S.dense_id('segmento', 'id_segmento', f'SELECT {nk("c_mktsegment")} AS segmento FROM customer')}),
dim_pri AS ({S.dense_id('prioridade', 'id_prioridade', f'SELECT {nk("o_orderpriority")} AS prioridade FROM orders')}),
cal_src AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem),
cal_months AS (SELECT DISTINCT CAST(year(d) AS INTEGER) AS ano, {S.month_label('month(d)')} AS mes,
                               CAST(month(d) AS INTEGER) AS ordem_mes
               FROM cal_src WHERE d IS NOT NULL),
dim_cal AS (SELECT {S.ym_id('ano', 'ordem_mes')} AS id_tempo, ano, mes, ordem_mes, {S.ym_label('ano', 'ordem_mes')} AS ano_mes
            FROM cal_months WHERE ano IS NOT NULL AND ordem_mes IS NOT NULL),
of AS (SELECT o.o_orderkey, o.o_totalprice, o.o_orderdate AS d, {nk('c.c_mktsegment')} AS segmento,
              {nk('o.o_orderpriority')} AS prioridade
       FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
fact AS (SELECT cal.id_tempo, s.id_segmento, p.id_prioridade, of.o_orderkey, of.o_totalprice
         FROM of
         LEFT JOIN dim_cal cal ON cal.ano = year(of.d) AND cal.ordem_mes = month(of.d)
                              AND cal.mes = {S.month_label('month(of.d)')}
         LEFT JOIN dim_seg s ON s.segmento = of.segmento
         LEFT JOIN dim_pri p ON p.prioridade = of.prioridade)"""

ORACLE["dim_calendar_orders"] = f"WITH {ORDERS_CTES} SELECT * FROM dim_cal"
ORACLE["dim_segment"] = f"WITH {ORDERS_CTES} SELECT * FROM dim_seg"
ORACLE["dim_part_name_dense_id"] = S.dense_id("nome", "id_nome", f"SELECT {nk('p_name')} AS nome FROM part")
ORACLE["fact_orders_resolved"] = f"WITH {ORDERS_CTES} SELECT * FROM fact"
ORACLE["orders_by_month_segment"] = f"""
WITH {ORDERS_CTES}
SELECT c.ano_mes, s.segmento, count(*) AS pedidos,
       CAST(sum(CAST(f.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS valor_total
FROM fact f LEFT JOIN dim_cal c ON f.id_tempo = c.id_tempo LEFT JOIN dim_seg s ON f.id_segmento = s.id_segmento
GROUP BY c.ano_mes, s.segmento
"""

# --------------------------------------------------------- phase 2: sheets

ORACLE["series_monthly_sheet"] = f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, {S.month_label('month(o_orderdate)')} AS mes,
       CAST(month(o_orderdate) AS INTEGER) AS ordem_mes, CAST(count(*) AS INTEGER) AS casos,
       CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS INTEGER) AS obitos, 'pedidos' AS doenca
FROM orders WHERE o_orderdate IS NOT NULL
GROUP BY year(o_orderdate), month(o_orderdate)
"""

FIRST_YEARS_CTE = ("first_years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders "
                   "WHERE o_orderdate IS NOT NULL ORDER BY y LIMIT 2)")
SERIES_STACKED_BODY = f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, {S.month_label('month(o_orderdate)')} AS mes,
       CAST(month(o_orderdate) AS INTEGER) AS ordem_mes, CAST(count(*) AS INTEGER) AS casos,
       CAST(CASE WHEN o_orderstatus = 'P' AND year(o_orderdate) IN (SELECT y FROM first_years) THEN 0
                 ELSE count(*) FILTER (WHERE o_orderpriority = '1-URGENT') END AS INTEGER) AS obitos,
       lower(o_orderstatus) AS doenca
FROM orders WHERE o_orderdate IS NOT NULL AND o_orderstatus IN ('F', 'O', 'P')
GROUP BY o_orderstatus, year(o_orderdate), month(o_orderdate)
"""
ORACLE["series_stacked_sheet"] = f"WITH {FIRST_YEARS_CTE} {SERIES_STACKED_BODY}"
