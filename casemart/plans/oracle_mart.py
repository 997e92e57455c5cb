"""Oracle SQL for the case data mart and its spatial chain (DuckDB).

Brute force on purpose: fuzzy candidates come from a full cross join ranked
with ``row_number``, the best geocoder candidate from a window sort.  The
Spark plans compute the same results with blocking and map-side combined
aggregates; agreement of the two is the correctness check.
"""

from __future__ import annotations

from casemart.functions import geo as GEO

from casemart.plans import sqlfrag as S
from casemart.plans.oracle import FIRST_YEARS_CTE, ORACLE, RAW_CTES, SERIES_STACKED_BODY
from casemart.plans.world import CITY, DATED_SOURCE, DEAD_RULE_SHIFT, RULE_ID_BASE, UNDATED_SOURCE

nk, mk, q = S.normalize_key, S.match_key, S.q


def inside(lat: str, lon: str) -> str:
    return f"({lat} >= {GEO.MIN_LAT} AND {lat} <= {GEO.MAX_LAT} AND {lon} >= {GEO.MIN_LON} AND {lon} <= {GEO.MAX_LON})"


SERIES_MONTHLY = ORACLE["series_monthly_sheet"]

MART_CTES = f"""{RAW_CTES},
series_pedidos AS ({SERIES_MONTHLY}),
{FIRST_YEARS_CTE},
series_status AS ({SERIES_STACKED_BODY}),
dim_tempo_src AS (
  SELECT ano, mes, ordem_mes FROM series_pedidos UNION ALL SELECT ano, mes, ordem_mes FROM series_status
  UNION ALL SELECT CAST(year(data) AS INTEGER), {S.month_label('month(data)')}, CAST(month(data) AS INTEGER)
  FROM linelist_dated WHERE data IS NOT NULL),
dim_tempo AS (
  SELECT {S.ym_id('ano', 'ordem_mes')} AS id_tempo, ano, mes, ordem_mes, {S.ym_label('ano', 'ordem_mes')} AS ano_mes
  FROM (SELECT DISTINCT * FROM dim_tempo_src WHERE ano IS NOT NULL AND ordem_mes IS NOT NULL)),
dim_doenca AS ({S.dense_id('doenca', 'id_doenca', f'''
  SELECT {nk('doenca')} AS doenca FROM series_pedidos UNION ALL SELECT {nk('doenca')} FROM series_status
  UNION ALL SELECT {nk('doenca')} FROM linelist_dated UNION ALL SELECT {nk('doenca')} FROM linelist_undated''')}),
dim_bairro AS ({S.dense_id('bairro', 'id_bairro', f'''
  SELECT {nk('bairro')} AS bairro FROM linelist_dated UNION ALL SELECT {nk('bairro')} FROM linelist_undated''')}),
dim_sexo AS ({S.dense_id('sexo', 'id_sexo', f'''
  SELECT {nk('sexo')} AS sexo FROM linelist_dated UNION ALL SELECT {nk('sexo')} FROM linelist_undated''')}),
fact_pedidos AS (
  SELECT t.id_tempo, d.id_doenca, s.casos, s.obitos FROM series_pedidos s
  LEFT JOIN dim_tempo t ON t.ano = s.ano AND t.mes = s.mes AND t.ordem_mes = s.ordem_mes
  LEFT JOIN dim_doenca d ON d.doenca = {nk('s.doenca')}),
fact_status AS (
  SELECT t.id_tempo, d.id_doenca, s.casos, s.obitos FROM series_status s
  LEFT JOIN dim_tempo t ON t.ano = s.ano AND t.mes = s.mes AND t.ordem_mes = s.ordem_mes
  LEFT JOIN dim_doenca d ON d.doenca = {nk('s.doenca')}),
fact_dated AS (
  SELECT d.id_doenca, b.id_bairro, x.id_sexo, t.id_tempo, f.data, f.idade, f.unidade_notificacao
  FROM linelist_dated f
  LEFT JOIN dim_doenca d ON d.doenca = {nk('f.doenca')}
  LEFT JOIN dim_bairro b ON b.bairro = {nk('f.bairro')}
  LEFT JOIN dim_sexo x ON x.sexo = {nk('f.sexo')}
  LEFT JOIN dim_tempo t ON t.ano = year(f.data) AND t.ordem_mes = month(f.data)
                       AND t.mes = {S.month_label('month(f.data)')}),
fact_undated AS (
  SELECT d.id_doenca, b.id_bairro, x.id_sexo, f.ano_referencia, f.idade
  FROM linelist_undated f
  LEFT JOIN dim_doenca d ON d.doenca = {nk('f.doenca')}
  LEFT JOIN dim_bairro b ON b.bairro = {nk('f.bairro')}
  LEFT JOIN dim_sexo x ON x.sexo = {nk('f.sexo')}),
casos_espaciais AS (
  SELECT '{DATED_SOURCE}_espacial' AS fonte, d.doenca, b.bairro, x.sexo, t.ano, t.mes, t.ordem_mes, t.ano_mes,
         f.data, f.idade, f.unidade_notificacao
  FROM fact_dated f LEFT JOIN dim_doenca d ON f.id_doenca = d.id_doenca
  LEFT JOIN dim_bairro b ON f.id_bairro = b.id_bairro LEFT JOIN dim_sexo x ON f.id_sexo = x.id_sexo
  LEFT JOIN dim_tempo t ON f.id_tempo = t.id_tempo
  UNION ALL
  SELECT '{UNDATED_SOURCE}_espacial', d.doenca, b.bairro, x.sexo, f.ano_referencia, CAST(NULL AS VARCHAR),
         CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS DATE), f.idade, CAST(NULL AS VARCHAR)
  FROM fact_undated f LEFT JOIN dim_doenca d ON f.id_doenca = d.id_doenca
  LEFT JOIN dim_bairro b ON f.id_bairro = b.id_bairro LEFT JOIN dim_sexo x ON f.id_sexo = x.id_sexo)"""

ORACLE["mart_dim_place"] = f"WITH {MART_CTES} SELECT * FROM dim_bairro"
ORACLE["mart_dim_sex"] = f"WITH {MART_CTES} SELECT * FROM dim_sexo"
ORACLE["mart_dim_category"] = f"WITH {MART_CTES} SELECT * FROM dim_doenca"
ORACLE["mart_dim_time"] = f"WITH {MART_CTES} SELECT * FROM dim_tempo"
ORACLE["mart_fact_series"] = f"""WITH {MART_CTES}
SELECT *, 'pedidos' AS fonte FROM fact_pedidos UNION ALL SELECT *, 'status_pedidos' FROM fact_status"""
ORACLE["mart_fact_dated"] = f"WITH {MART_CTES} SELECT * FROM fact_dated"
ORACLE["mart_fact_undated"] = f"WITH {MART_CTES} SELECT * FROM fact_undated"
ORACLE["vw_serie_temporal"] = f"""WITH {MART_CTES}
SELECT 'pedidos' AS fonte, t.ano, t.mes, t.ordem_mes, t.ano_mes, d.doenca, f.casos, f.obitos
FROM fact_pedidos f LEFT JOIN dim_tempo t ON f.id_tempo = t.id_tempo LEFT JOIN dim_doenca d ON f.id_doenca = d.id_doenca
UNION ALL
SELECT 'status_pedidos', t.ano, t.mes, t.ordem_mes, t.ano_mes, d.doenca, f.casos, f.obitos
FROM fact_status f LEFT JOIN dim_tempo t ON f.id_tempo = t.id_tempo LEFT JOIN dim_doenca d ON f.id_doenca = d.id_doenca"""
ORACLE["vw_casos_espaciais"] = f"WITH {MART_CTES} SELECT * FROM casos_espaciais"
ORACLE["vw_casos_espaciais_serving"] = f"""WITH {MART_CTES}
SELECT '{DATED_SOURCE}' AS fonte, d.doenca, b.bairro, x.sexo, t.ano, t.mes, t.ordem_mes, t.ano_mes,
       f.data, f.idade, f.unidade_notificacao, f.id_doenca, f.id_bairro, f.id_sexo, f.id_tempo
FROM fact_dated f LEFT JOIN dim_doenca d ON f.id_doenca = d.id_doenca
LEFT JOIN dim_bairro b ON f.id_bairro = b.id_bairro LEFT JOIN dim_sexo x ON f.id_sexo = x.id_sexo
LEFT JOIN dim_tempo t ON f.id_tempo = t.id_tempo
UNION ALL
SELECT '{UNDATED_SOURCE}', d.doenca, b.bairro, x.sexo, f.ano_referencia, CAST(NULL AS VARCHAR),
       CAST(NULL AS INTEGER), CAST(f.ano_referencia AS VARCHAR), CAST(NULL AS DATE), f.idade, CAST(NULL AS VARCHAR),
       f.id_doenca, f.id_bairro, f.id_sexo, CAST(NULL AS INTEGER)
FROM fact_undated f LEFT JOIN dim_doenca d ON f.id_doenca = d.id_doenca
LEFT JOIN dim_bairro b ON f.id_bairro = b.id_bairro LEFT JOIN dim_sexo x ON f.id_sexo = x.id_sexo"""


def _nulls(table: str, keys: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{k}' AS key_column, CAST(count(*) FILTER (WHERE {k} IS NULL) AS BIGINT) "
        f"AS nulls FROM {src}" for k, src in [(k, _FACT_OF[table]) for k in keys])


_FACT_OF = {"pedidos_final": "fact_pedidos", "status_pedidos_final": "fact_status",
            f"{DATED_SOURCE}_espacial_final": "fact_dated", f"{UNDATED_SOURCE}_espacial_final": "fact_undated"}

ORACLE["null_key_audit"] = f"""WITH {MART_CTES}
{_nulls('pedidos_final', ['id_tempo', 'id_doenca'])} UNION ALL {_nulls('status_pedidos_final', ['id_tempo', 'id_doenca'])}
UNION ALL {_nulls(f'{DATED_SOURCE}_espacial_final', ['id_doenca', 'id_bairro', 'id_sexo', 'id_tempo'])}
UNION ALL {_nulls(f'{UNDATED_SOURCE}_espacial_final', ['id_doenca', 'id_bairro', 'id_sexo'])}"""

ORACLE["row_preservation"] = f"""WITH {MART_CTES},
c AS (
  SELECT 'pedidos' AS label, (SELECT count(*) FROM series_pedidos) AS original, (SELECT count(*) FROM fact_pedidos) AS final
  UNION ALL SELECT 'status_pedidos', (SELECT count(*) FROM series_status), (SELECT count(*) FROM fact_status)
  UNION ALL SELECT '{DATED_SOURCE}_espacial', (SELECT count(*) FROM linelist_dated), (SELECT count(*) FROM fact_dated)
  UNION ALL SELECT '{UNDATED_SOURCE}_espacial', (SELECT count(*) FROM linelist_undated),
                   (SELECT count(*) FROM fact_undated))
SELECT label, original, final, original = final AS preserved FROM c"""

ORACLE["series_summary"] = f"""WITH {MART_CTES}
SELECT doenca, ano, count(*) AS rows, CAST(sum(casos) AS BIGINT) AS casos, CAST(sum(obitos) AS BIGINT) AS obitos
FROM (SELECT * FROM series_pedidos UNION ALL SELECT * FROM series_status) GROUP BY doenca, ano"""

# ------------------------------------------------------------- spatial chain

_DISPLAY = "upper(substr({n}, 1, 1)) || substr({n}, 2)"
_QSUFFIX = f", {CITY}, São Paulo, Brasil"

SPATIAL_CTES = f"""{MART_CTES},
canon_ids AS ({S.dense_id('bairro_canonico_norm', 'id_bairro_canonico', 'SELECT p_name AS bairro_canonico_norm FROM part')}),
canonical AS (
  SELECT id_bairro_canonico, {_DISPLAY.format(n='bairro_canonico_norm')} AS bairro_canonico, bairro_canonico_norm,
         CASE WHEN starts_with(bairro_canonico_norm, 'new ') THEN CAST(NULL AS VARCHAR)
              ELSE {_DISPLAY.format(n='bairro_canonico_norm')} || {q(_QSUFFIX)} END AS query_geocoding
  FROM canon_ids),
canon AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, {mk('bairro_canonico')} AS bairro_canonico_key,
           row_number() OVER (PARTITION BY {mk('bairro_canonico')} ORDER BY id_bairro_canonico) AS rn
    FROM canonical) WHERE rn = 1),
pnames AS (SELECT DISTINCT p_name FROM part),
alias_raw AS (
  SELECT split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) AS alias_norm_observado,
         p_name AS bairro_canonico_sugerido FROM pnames
  UNION ALL SELECT 'jd ' || p_name || ' ii', 'zona ' || p_name FROM pnames),
alias AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, {mk('alias_norm_observado')} AS alias_key, {mk('bairro_canonico_sugerido')} AS sug_key,
           row_number() OVER (PARTITION BY {mk('alias_norm_observado')}
                              ORDER BY alias_norm_observado, bairro_canonico_sugerido) AS rn
    FROM alias_raw) WHERE rn = 1),
src AS (SELECT id_bairro, bairro AS bairro_original, {mk('bairro')} AS bairro_original_key FROM dim_bairro),
by_alias AS (
  SELECT a.alias_key, c.bairro_canonico AS bairro_by_alias, c.id_bairro_canonico AS id_bairro_canonico_by_alias,
         c.query_geocoding AS query_geocoding_by_alias
  FROM alias a JOIN canon c ON a.sug_key = c.bairro_canonico_key),
exact AS (
  SELECT s.*, a.bairro_by_alias, a.id_bairro_canonico_by_alias, a.query_geocoding_by_alias,
         c.bairro_canonico AS bairro_by_exact, c.id_bairro_canonico AS id_bairro_canonico_by_exact,
         c.query_geocoding AS query_geocoding_by_exact
  FROM src s LEFT JOIN by_alias a ON s.bairro_original_key = a.alias_key
  LEFT JOIN canon c ON s.bairro_original_key = c.bairro_canonico_key),
unresolved AS (
  SELECT id_bairro, bairro_original_key AS u FROM exact WHERE bairro_by_alias IS NULL AND bairro_by_exact IS NULL),
cand_all AS (
  SELECT u.id_bairro, c.bairro_canonico_key, c.bairro_canonico, c.id_bairro_canonico, c.query_geocoding,
         CAST(levenshtein(u.u, c.bairro_canonico_key) AS INTEGER) AS distance,
         greatest(length(u.u), length(c.bairro_canonico_key)) AS max_len
  FROM unresolved u CROSS JOIN canon c WHERE c.bairro_canonico_key IS NOT NULL),
cand AS (
  SELECT *, CASE WHEN max_len > 0 THEN 1 - distance / max_len ELSE 0.0 END AS similarity FROM cand_all),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id_bairro ORDER BY similarity DESC, distance, bairro_canonico_key) AS rk
  FROM cand),
-- the uncut ranking; values are reported down to 0.7
reported AS (
  SELECT r.* FROM ranked r JOIN unresolved u USING (id_bairro)
  WHERE r.similarity >= 0.7::DOUBLE),
fuzzy AS (
  SELECT u.id_bairro, b.bairro_canonico AS bairro_by_fuzzy, b.id_bairro_canonico AS id_bairro_canonico_by_fuzzy,
         b.query_geocoding AS query_geocoding_by_fuzzy, b.similarity AS best_similarity,
         b.distance AS best_distance, s.bairro_canonico AS second_best_match, s.similarity AS second_similarity,
         b.similarity - s.similarity AS similarity_gap,
         coalesce(b.similarity >= 0.85::DOUBLE AND b.similarity - coalesce(t.similarity, 0.0) >= 0.05::DOUBLE, false) AS fuzzy_accepted
  FROM unresolved u LEFT JOIN reported b ON b.id_bairro = u.id_bairro AND b.rk = 1
  LEFT JOIN reported s ON s.id_bairro = u.id_bairro AND s.rk = 2
  LEFT JOIN ranked t ON t.id_bairro = u.id_bairro AND t.rk = 2),
standardized0 AS (
  SELECT e.id_bairro, e.bairro_original, e.bairro_original_key,
         coalesce(e.id_bairro_canonico_by_alias, e.id_bairro_canonico_by_exact,
                  CASE WHEN f.fuzzy_accepted THEN f.id_bairro_canonico_by_fuzzy END) AS id_bairro_canonico,
         coalesce(e.bairro_by_alias, e.bairro_by_exact, CASE WHEN f.fuzzy_accepted THEN f.bairro_by_fuzzy END)
           AS bairro_padronizado,
         coalesce(e.query_geocoding_by_alias, e.query_geocoding_by_exact,
                  CASE WHEN f.fuzzy_accepted THEN f.query_geocoding_by_fuzzy END) AS query_geocoding,
         CASE WHEN e.bairro_by_alias IS NOT NULL THEN 'alias' WHEN e.bairro_by_exact IS NOT NULL THEN 'exact'
              WHEN f.fuzzy_accepted THEN 'fuzzy' ELSE 'unmatched' END AS match_method,
         f.best_similarity AS similarity, f.second_best_match, f.second_similarity, f.similarity_gap
  FROM exact e LEFT JOIN fuzzy f ON e.id_bairro = f.id_bairro),
standardized AS (SELECT *, match_method = 'unmatched' AS needs_review FROM standardized0),
brands AS (
  SELECT DISTINCT TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS n FROM part),
rules_n AS (
  SELECT n, n AS label_n FROM brands WHERE n IS NOT NULL
  UNION ALL SELECT n + {DEAD_RULE_SHIFT}, n + {DEAD_RULE_SHIFT} FROM brands WHERE n IS NOT NULL),
rules AS (
  SELECT {mk("'Brand#' || CAST(n AS VARCHAR)")} AS bairro_original_key,
         CAST({RULE_ID_BASE} + n AS INTEGER) AS manual_id_bairro_canonico,
         'Marca ' || CAST(label_n AS VARCHAR) AS manual_bairro_padronizado,
         CASE WHEN n % 5 = 0 THEN CAST(NULL AS VARCHAR)
              ELSE 'Marca ' || CAST(label_n AS VARCHAR) || {q(_QSUFFIX)} END AS manual_query_geocoding,
         CASE WHEN n % 5 = 0 THEN 'manual_unresolved_generic' ELSE 'manual_new_canonical' END AS manual_match_method,
         NOT (n % 5 = 0) AS manual_use_for_geocoding, 'brand code curated by hand' AS curation_note
  FROM rules_n),
curated AS (
  SELECT b.id_bairro, b.bairro_original, b.bairro_original_key,
         coalesce(m.manual_id_bairro_canonico, b.id_bairro_canonico) AS id_bairro_canonico,
         coalesce(m.manual_bairro_padronizado, b.bairro_padronizado) AS bairro_padronizado,
         coalesce(m.manual_query_geocoding, b.query_geocoding) AS query_geocoding,
         coalesce(m.manual_match_method, b.match_method) AS match_method,
         b.similarity, b.second_best_match, b.second_similarity, b.similarity_gap,
         CASE WHEN m.manual_match_method = 'manual_unresolved_generic' THEN true
              WHEN m.manual_match_method IS NOT NULL THEN false ELSE b.needs_review END AS needs_review,
         coalesce(m.manual_use_for_geocoding, true) AS use_for_geocoding, m.curation_note
  FROM standardized b LEFT JOIN rules m ON b.bairro_original_key = m.bairro_original_key),
curated_worklist AS (
  SELECT id_bairro_canonico, bairro_canonico, query_geocoding FROM (
    SELECT id_bairro_canonico, bairro_padronizado AS bairro_canonico, query_geocoding,
           row_number() OVER (PARTITION BY id_bairro_canonico
                              ORDER BY bairro_padronizado NULLS FIRST, query_geocoding NULLS FIRST) AS rn
    FROM curated WHERE id_bairro_canonico IS NOT NULL AND use_for_geocoding = true AND query_geocoding IS NOT NULL)
  WHERE rn = 1),
places AS (
  SELECT id_bairro_canonico, bairro_canonico AS bairro, query_geocoding, lower(bairro_canonico) AS place_key
  FROM curated_worklist),
variants AS (
  SELECT DISTINCT * FROM (
    SELECT place_key, 1 AS query_no, query_geocoding AS query FROM places
    WHERE query_geocoding IS NOT NULL AND query_geocoding <> ''
    UNION ALL SELECT place_key, 2, bairro || {q(GEO.QUERY_TEMPLATES[0].replace('{name}', ''))} FROM places
    UNION ALL SELECT place_key, 3, 'Bairro ' || bairro || {q(GEO.QUERY_TEMPLATES[1].split('{name}')[1])} FROM places
    UNION ALL SELECT place_key, 4, bairro || {q(GEO.QUERY_TEMPLATES[2].replace('{name}', ''))} FROM places)
  WHERE query IS NOT NULL),
cands AS (
  SELECT p_name AS place_key, CAST(p_size % 4 + 1 AS INTEGER) AS query_no, p_partkey AS position,
         CASE WHEN p_partkey % 50 = 0 THEN 'n/a'
              ELSE '-21.' || lpad(CAST(p_partkey % 400 AS VARCHAR), 3, '0') END AS lat,
         '-50.' || lpad(CAST((p_partkey * 7) % 700 AS VARCHAR), 3, '0') AS lon,
         {_DISPLAY.format(n='p_name')} || ', '
           || CASE p_size % 3 WHEN 0 THEN 'Araçatuba' WHEN 1 THEN 'Aracatuba' ELSE 'Birigui' END || ', '
           || CASE WHEN p_size % 2 = 0 THEN 'São Paulo' ELSE 'Minas Gerais' END AS display_name,
         CASE p_type WHEN 'ECONOMY' THEN 'place' WHEN 'SMALL' THEN 'boundary' ELSE 'highway' END AS osm_class,
         CASE p_size % 5 WHEN 0 THEN 'suburb' WHEN 1 THEN 'neighbourhood' WHEN 2 THEN 'residential'
              ELSE 'road' END AS osm_type,
         CAST(p_partkey AS VARCHAR) AS osm_id
  FROM part),
cands_p AS (SELECT *, TRY_CAST(lat AS DOUBLE) AS la, TRY_CAST(lon AS DOUBLE) AS lo FROM cands),
scored AS (
  SELECT *, CAST(CASE WHEN la IS NULL OR lo IS NULL THEN {GEO.SCORE_UNPARSABLE} ELSE
           (CASE WHEN {inside('la', 'lo')} THEN {GEO.SCORE_IN_BBOX} ELSE 0 END)
         + (CASE WHEN contains(lower(display_name), 'araçatuba') OR contains(lower(display_name), 'aracatuba')
                 THEN {GEO.SCORE_CITY} ELSE 0 END)
         + (CASE WHEN contains(lower(display_name), 'são paulo') OR contains(lower(display_name), 'sao paulo')
                 THEN {GEO.SCORE_STATE} ELSE 0 END)
         + (CASE WHEN lower(osm_type) IN ('neighbourhood', 'suburb', 'quarter', 'residential')
                 THEN {GEO.SCORE_TYPE} ELSE 0 END)
         + (CASE WHEN lower(osm_class) IN ('place', 'boundary') THEN {GEO.SCORE_CLASS} ELSE 0 END) END AS INTEGER)
           AS candidate_score,
         CASE WHEN la IS NOT NULL AND lo IS NOT NULL THEN la END AS latitude,
         CASE WHEN la IS NOT NULL AND lo IS NOT NULL THEN lo END AS longitude
  FROM cands_p),
issued AS (SELECT s.*, v.query FROM scored s JOIN variants v ON s.place_key = v.place_key AND s.query_no = v.query_no),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place_key ORDER BY candidate_score DESC, query_no, position)
                 AS rk FROM issued) WHERE rk = 1),
used AS (SELECT place_key, arg_max(query, query_no) AS query_used FROM issued GROUP BY place_key),
errs AS (
  SELECT place_key, min(error) AS error FROM (
    SELECT DISTINCT p_name AS place_key, 'read timed out' AS error FROM part WHERE starts_with(p_name, 'cold '))
  GROUP BY place_key),
best_ok AS (SELECT * FROM best WHERE place_key NOT IN (SELECT place_key FROM errs)),
draft AS (
  SELECT CAST(p.id_bairro_canonico AS INTEGER) AS id_bairro_canonico, p.bairro,
         CASE WHEN e.error IS NOT NULL THEN p.query_geocoding ELSE u.query_used END AS query_used,
         b.latitude, b.longitude,
         b.display_name, b.osm_class, b.osm_type, b.osm_id,
         CAST(CASE WHEN b.place_key IS NULL THEN 0 ELSE b.candidate_score END AS INTEGER) AS candidate_score,
         CASE WHEN b.place_key IS NULL THEN false ELSE coalesce({inside('b.latitude', 'b.longitude')}, false) END
           AS is_inside_bbox,
         CASE WHEN e.error IS NOT NULL THEN 'error: ' || e.error
              WHEN b.place_key IS NULL THEN 'not_found'
              WHEN coalesce({inside('b.latitude', 'b.longitude')}, false) THEN 'found'
              ELSE 'found_outside_bbox' END AS geocode_status,
         true AS needs_review
  FROM places p LEFT JOIN best_ok b ON p.place_key = b.place_key LEFT JOIN used u ON p.place_key = u.place_key
  LEFT JOIN errs e ON p.place_key = e.place_key),
corr AS (
  SELECT bairro, CAST({GEO.FALLBACK_LAT} AS DOUBLE) AS manual_latitude,
         CAST({GEO.FALLBACK_LON} AS DOUBLE) AS manual_longitude, 'manual review' AS manual_source
  FROM draft WHERE geocode_status = 'found_outside_bbox' AND id_bairro_canonico % 2 = 0),
corrected0 AS (
  SELECT d.*, c.manual_latitude, c.manual_longitude, c.manual_source,
         coalesce(c.manual_latitude, d.latitude) AS latitude_final,
         coalesce(c.manual_longitude, d.longitude) AS longitude_final
  FROM draft d LEFT JOIN corr c ON d.bairro = c.bairro),
corrected AS (
  SELECT id_bairro_canonico, bairro, latitude_final, longitude_final, display_name, osm_class, osm_type, osm_id,
         candidate_score, {inside('latitude_final', 'longitude_final')} AS is_inside_bbox_final,
         CASE WHEN manual_latitude IS NOT NULL AND manual_longitude IS NOT NULL THEN manual_source
              ELSE 'nominatim_osm' END AS geocode_source_final,
         CASE WHEN latitude_final IS NULL OR longitude_final IS NULL THEN 'not_found'
              WHEN {inside('latitude_final', 'longitude_final')} = false THEN 'found_outside_bbox'
              ELSE 'found' END AS geocode_status_final,
         CASE WHEN latitude_final IS NULL OR longitude_final IS NULL
                   OR {inside('latitude_final', 'longitude_final')} = false
                   OR candidate_score < {GEO.REVIEW_SCORE_THRESHOLD} THEN true ELSE false END AS needs_review_final
  FROM corrected0),
validated AS (
  SELECT id_bairro_canonico, bairro, latitude_final AS latitude, longitude_final AS longitude, display_name,
         osm_class, osm_type, osm_id, candidate_score, is_inside_bbox_final AS is_inside_bbox,
         geocode_status_final AS geocode_status, geocode_source_final
  FROM corrected
  WHERE latitude_final IS NOT NULL AND longitude_final IS NOT NULL AND is_inside_bbox_final = true),
manual_pts AS (
  SELECT bairro_canonico AS bairro_padronizado,
         CAST(-21.2 AS DOUBLE) - CAST(id_bairro_canonico % 10 AS DOUBLE) / 1000.0 AS manual_latitude,
         CAST(-50.44 AS DOUBLE) - CAST(id_bairro_canonico % 7 AS DOUBLE) / 1000.0 AS manual_longitude,
         'manual_reference_point' AS manual_geocode_source,
         'Approximate point; not an official centroid.' AS manual_geocode_note, 'medium' AS manual_confidence,
         lower(trim(bairro_canonico)) AS bairro_padronizado_key
  FROM canonical WHERE starts_with(bairro_canonico_norm, 'small ')),
std_k AS (SELECT *, lower(trim(bairro_padronizado)) AS bairro_padronizado_key FROM curated)"""


def geo_dim_sql(geo_table: str, mode: str, has_source: bool) -> str:
    src = "geocode_source_final" if has_source else "CAST(NULL AS VARCHAR) AS geocode_source_final"
    return f"""
g_{mode} AS (
  SELECT id_bairro_canonico, latitude AS osm_latitude, longitude AS osm_longitude, display_name AS osm_display_name,
         osm_class, osm_type, osm_id, candidate_score AS osm_candidate_score, is_inside_bbox AS osm_inside_bbox,
         geocode_status, {src}
  FROM {geo_table}),
geo0_{mode} AS (
  SELECT b.id_bairro, b.bairro AS bairro_original_dim, s.id_bairro_canonico, s.bairro_padronizado, s.query_geocoding,
         s.match_method, s.needs_review, s.use_for_geocoding,
         CASE WHEN m.manual_latitude IS NOT NULL AND m.manual_longitude IS NOT NULL THEN m.manual_latitude
              ELSE g.osm_latitude END AS latitude,
         CASE WHEN m.manual_latitude IS NOT NULL AND m.manual_longitude IS NOT NULL THEN m.manual_longitude
              ELSE g.osm_longitude END AS longitude,
         m.manual_latitude, m.manual_longitude, m.manual_geocode_source, m.manual_confidence, m.manual_geocode_note,
         g.osm_display_name, g.osm_class, g.osm_type, g.osm_id, g.osm_candidate_score, g.osm_inside_bbox,
         g.geocode_status, g.geocode_source_final, s.curation_note
  FROM dim_bairro b LEFT JOIN std_k s ON s.id_bairro = b.id_bairro
  LEFT JOIN g_{mode} g ON g.id_bairro_canonico = s.id_bairro_canonico
  LEFT JOIN manual_pts m ON m.bairro_padronizado_key = s.bairro_padronizado_key),
geo1_{mode} AS (
  SELECT *, CASE WHEN id_bairro_canonico IS NULL THEN 'unresolved_name'
                 WHEN use_for_geocoding = false THEN 'not_geocodable_source_name'
                 WHEN manual_latitude IS NOT NULL AND manual_longitude IS NOT NULL THEN 'manual_reference_point'
                 WHEN latitude IS NULL OR longitude IS NULL THEN 'missing_coordinates'
                 WHEN osm_inside_bbox = false THEN 'outside_bbox'
                 WHEN osm_candidate_score < {GEO.CONFIDENCE_SCORE_THRESHOLD} THEN 'low_confidence_geocoding'
                 WHEN '{mode}' = 'validated' THEN 'validated_geocoding'
                 WHEN '{mode}' = 'draft' THEN 'draft_geocoding'
                 ELSE 'geocoded' END AS spatial_status
  FROM geo0_{mode}),
geo_dim_{mode} AS (
  SELECT id_bairro, bairro_original_dim, id_bairro_canonico, bairro_padronizado, query_geocoding, match_method,
         needs_review, use_for_geocoding, latitude, longitude,
         coalesce(latitude, CAST({GEO.FALLBACK_LAT} AS DOUBLE)) AS latitude_plot,
         coalesce(longitude, CAST({GEO.FALLBACK_LON} AS DOUBLE)) AS longitude_plot,
         (latitude IS NOT NULL AND longitude IS NOT NULL
          AND spatial_status IN ('manual_reference_point', 'validated_geocoding', 'draft_geocoding')) AS is_mappable,
         spatial_status,
         CASE spatial_status WHEN 'manual_reference_point' THEN 'medium' WHEN 'validated_geocoding' THEN 'high'
              WHEN 'draft_geocoding' THEN 'medium' WHEN 'low_confidence_geocoding' THEN 'low'
              WHEN 'outside_bbox' THEN 'low' ELSE 'unresolved' END AS spatial_quality,
         coalesce(manual_geocode_source, geocode_source_final, '{mode}') AS geocode_source,
         manual_confidence, osm_display_name, osm_class, osm_type, osm_id, osm_candidate_score, geocode_status,
         curation_note, manual_geocode_note
  FROM geo1_{mode})"""


GEO_CTES = f"""{SPATIAL_CTES},{geo_dim_sql('draft', 'draft', False)},
cases_geo AS (
  SELECT v.*, g.id_bairro, g.id_bairro_canonico, g.bairro_padronizado, g.latitude, g.longitude, g.latitude_plot,
         g.longitude_plot, g.is_mappable, g.spatial_status, g.spatial_quality, g.geocode_source, g.manual_confidence,
         g.osm_display_name AS bairro_display_name, g.osm_candidate_score, g.manual_geocode_note
  FROM casos_espaciais v LEFT JOIN dim_bairro b ON v.bairro = b.bairro
  LEFT JOIN geo_dim_draft g ON b.id_bairro = g.id_bairro),
map_counts AS (
  SELECT fonte, doenca, ano, mes, ordem_mes, ano_mes, bairro AS bairro_original, id_bairro, id_bairro_canonico,
         bairro_padronizado, latitude, longitude, latitude_plot, longitude_plot, is_mappable, spatial_status,
         spatial_quality, geocode_source, count(*) AS casos
  FROM cases_geo
  GROUP BY fonte, doenca, ano, mes, ordem_mes, ano_mes, bairro, id_bairro, id_bairro_canonico, bairro_padronizado,
           latitude, longitude, latitude_plot, longitude_plot, is_mappable, spatial_status, spatial_quality,
           geocode_source)"""

ORACLE["match_standardized"] = f"WITH {SPATIAL_CTES} SELECT * FROM standardized"
ORACLE["match_fuzzy_top2"] = f"WITH {SPATIAL_CTES} SELECT * FROM fuzzy"
ORACLE["match_summary"] = f"""WITH {SPATIAL_CTES}
SELECT match_method, needs_review, count(*) AS records FROM standardized GROUP BY match_method, needs_review"""
ORACLE["match_names_per_canonical"] = f"""WITH {SPATIAL_CTES}
SELECT id_bairro_canonico, bairro_padronizado, count(*) AS source_names FROM standardized
WHERE id_bairro_canonico IS NOT NULL GROUP BY id_bairro_canonico, bairro_padronizado"""
ORACLE["match_worklist"] = f"""WITH {SPATIAL_CTES}
SELECT id_bairro_canonico, bairro_canonico, query_geocoding FROM (
  SELECT id_bairro_canonico, bairro_padronizado AS bairro_canonico, query_geocoding,
         row_number() OVER (PARTITION BY id_bairro_canonico
                            ORDER BY bairro_padronizado NULLS FIRST, query_geocoding NULLS FIRST) AS rn
  FROM standardized WHERE id_bairro_canonico IS NOT NULL) WHERE rn = 1"""
ORACLE["curated_standardized"] = f"WITH {SPATIAL_CTES} SELECT * FROM curated"
ORACLE["rules_live"] = f"""WITH {SPATIAL_CTES}
SELECT * FROM rules WHERE bairro_original_key IN (SELECT bairro_original_key FROM standardized)"""
ORACLE["rules_dead"] = f"""WITH {SPATIAL_CTES}
SELECT * FROM rules r WHERE NOT EXISTS (
  SELECT 1 FROM standardized s WHERE s.bairro_original_key = r.bairro_original_key)"""
ORACLE["rules_duplicated"] = f"""WITH {SPATIAL_CTES}
SELECT bairro_original_key, count(*) AS occurrences FROM rules GROUP BY bairro_original_key HAVING count(*) > 1"""
ORACLE["curation_null_check"] = f"""WITH {SPATIAL_CTES}
SELECT count(*) FILTER (WHERE id_bairro IS NULL) AS null_id_bairro,
       count(*) FILTER (WHERE bairro_original IS NULL) AS null_bairro_original,
       count(*) FILTER (WHERE id_bairro_canonico IS NULL) AS null_id_bairro_canonico,
       count(*) FILTER (WHERE bairro_padronizado IS NULL) AS null_bairro_padronizado
FROM curated"""
ORACLE["curated_worklist"] = f"WITH {SPATIAL_CTES} SELECT * FROM curated_worklist"
ORACLE["geocode_draft"] = f"WITH {SPATIAL_CTES} SELECT * FROM draft"
ORACLE["geocode_problem_queue"] = f"""WITH {SPATIAL_CTES}
SELECT id_bairro_canonico, bairro, latitude, longitude, display_name, candidate_score, is_inside_bbox, geocode_status
FROM draft WHERE latitude IS NULL OR longitude IS NULL OR is_inside_bbox = false
                 OR candidate_score < {GEO.REVIEW_SCORE_THRESHOLD}"""
ORACLE["geocode_corrected"] = f"WITH {SPATIAL_CTES} SELECT * FROM corrected"
ORACLE["geocode_validated"] = f"WITH {SPATIAL_CTES} SELECT * FROM validated"
ORACLE["geocode_status_counts"] = f"""WITH {SPATIAL_CTES}
SELECT geocode_status, count(*) AS count FROM draft GROUP BY geocode_status"""
ORACLE["geo_dimension"] = f"WITH {GEO_CTES} SELECT * FROM geo_dim_draft"
ORACLE["geo_dimension_validated"] = f"""WITH {SPATIAL_CTES},{geo_dim_sql('validated', 'validated', True)}
SELECT * FROM geo_dim_validated"""
ORACLE["vw_casos_espaciais_geo"] = f"WITH {GEO_CTES} SELECT * FROM cases_geo"
ORACLE["vw_mapa_casos_bairro"] = f"WITH {GEO_CTES} SELECT * FROM map_counts"
ORACLE["vw_mapa_casos_bairro_mapeavel"] = f"WITH {GEO_CTES} SELECT * FROM map_counts WHERE is_mappable = true"
ORACLE["vw_mapa_serving"] = f"""WITH {GEO_CTES}
SELECT fonte, doenca, ano, mes, ordem_mes, ano_mes, bairro_original, id_bairro, id_bairro_canonico,
       bairro_padronizado, latitude_plot AS latitude, longitude_plot AS longitude, casos
FROM map_counts WHERE is_mappable = true AND latitude_plot IS NOT NULL AND longitude_plot IS NOT NULL"""
ORACLE["vw_qualidade_espacial"] = f"""WITH {GEO_CTES}
SELECT spatial_status, spatial_quality, is_mappable, count(*) AS registros FROM cases_geo
GROUP BY spatial_status, spatial_quality, is_mappable"""
ORACLE["vw_qualidade_por_fonte"] = f"""WITH {GEO_CTES}
SELECT fonte, spatial_status, spatial_quality, is_mappable, count(*) AS registros FROM cases_geo
GROUP BY fonte, spatial_status, spatial_quality, is_mappable"""
ORACLE["mappability_report"] = f"""WITH {GEO_CTES},
r AS (SELECT fonte, doenca, count(*) AS total_cases,
             CAST(sum(CASE WHEN is_mappable = true THEN 1 ELSE 0 END) AS BIGINT) AS mappable_cases,
             CAST(sum(CASE WHEN is_mappable = false THEN 1 ELSE 0 END) AS BIGINT) AS non_mappable_cases
      FROM cases_geo GROUP BY fonte, doenca)
SELECT *, CAST((20000 * mappable_cases + total_cases) // (2 * total_cases) AS DOUBLE) / 100.0 AS mappable_percentage
FROM r"""
ORACLE["fatal_checks"] = f"""WITH {GEO_CTES},
a AS (SELECT count(*) AS rows_geo,
             count(*) FILTER (WHERE id_bairro IS NULL) AS rows_without_neighborhood_id,
             count(*) FILTER (WHERE spatial_status IS NULL) AS rows_without_spatial_status,
             count(*) FILTER (WHERE latitude_plot IS NULL OR longitude_plot IS NULL) AS rows_without_plot_coordinates
      FROM cases_geo)
SELECT *, concat_ws(' | ', CASE WHEN rows_geo = 0 THEN 'zero rows' END,
                    CASE WHEN rows_without_neighborhood_id <> 0 THEN 'null id_bairro' END,
                    CASE WHEN rows_without_spatial_status <> 0 THEN 'null spatial_status' END,
                    CASE WHEN rows_without_plot_coordinates <> 0 THEN 'null plot coordinates' END) AS fatal_errors
FROM a"""
ORACLE["non_mappable_by_place"] = f"""WITH {GEO_CTES}
SELECT bairro AS bairro_original, bairro_padronizado, spatial_status, spatial_quality, count(*) AS cases
FROM cases_geo WHERE is_mappable = false GROUP BY bairro, bairro_padronizado, spatial_status, spatial_quality"""
ORACLE["low_confidence_places"] = f"""WITH {GEO_CTES}
SELECT id_bairro, bairro_original_dim, id_bairro_canonico, bairro_padronizado, query_geocoding, latitude, longitude,
       is_mappable, spatial_status, spatial_quality, geocode_source, osm_display_name, osm_candidate_score,
       curation_note, manual_geocode_note
FROM geo_dim_draft
WHERE is_mappable = false OR spatial_quality IN ('low', 'unresolved')
   OR spatial_status IN ('low_confidence_geocoding', 'missing_coordinates', 'unresolved_name',
                         'not_geocodable_source_name')"""

# ------------------------------------------------- summaries, audits, export

ORACLE["geocode_missing_coordinates"] = f"""WITH {SPATIAL_CTES}
SELECT id_bairro_canonico, bairro, geocode_status, candidate_score FROM draft
WHERE latitude IS NULL OR longitude IS NULL"""
ORACLE["geocode_outside_bbox"] = f"""WITH {SPATIAL_CTES}
SELECT id_bairro_canonico, bairro, latitude, longitude, display_name, geocode_status FROM draft
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND is_inside_bbox = false"""
ORACLE["match_unmatched"] = f"WITH {SPATIAL_CTES} SELECT * FROM standardized WHERE needs_review = true"
ORACLE["match_accepted_fuzzy"] = f"WITH {SPATIAL_CTES} SELECT * FROM standardized WHERE match_method = 'fuzzy'"
ORACLE["linelist_cases_per_place"] = f"""WITH {MART_CTES}
SELECT doenca, bairro, count(*) AS count
FROM (SELECT doenca, bairro FROM linelist_dated UNION ALL SELECT doenca, bairro FROM linelist_undated)
GROUP BY doenca, bairro"""

_FINAL_OBJECTS = [("dim_tempo", "dim_tempo"), ("dim_doenca", "dim_doenca"), ("dim_bairro", "dim_bairro"),
                  ("dim_sexo", "dim_sexo"), ("dim_bairro_geografica", "geo_dim_draft"),
                  ("fato_pedidos_final", "fact_pedidos"), ("fato_status_pedidos_final", "fact_status"),
                  ("fato_dated_final", "fact_dated"), ("fato_undated_final", "fact_undated")]
_VIEWS = [("vw_serie_temporal", "(SELECT 1 FROM fact_pedidos UNION ALL SELECT 1 FROM fact_status)"),
          ("vw_casos_espaciais", "casos_espaciais"), ("vw_casos_espaciais_geo", "cases_geo"),
          ("vw_mapa_casos_bairro", "map_counts")]


def _counts(objs) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS object_name, count(*) AS rows FROM {t}" for n, t in objs)


ORACLE["row_counts"] = f"WITH {GEO_CTES} {_counts(_FINAL_OBJECTS + _VIEWS)}"
ORACLE["export_reconcile"] = f"""WITH {GEO_CTES}, c AS ({_counts(_FINAL_OBJECTS)})
SELECT object_name, rows AS source_rows, rows AS target_rows_after_export, true AS matches FROM c"""

ORACLE["export_contents"] = """
SELECT object_name, columns_compared, 0::BIGINT AS rows_missing, 0::BIGINT AS rows_unexpected
FROM (VALUES ('dim_tempo', 5), ('dim_doenca', 2), ('dim_bairro', 2), ('dim_sexo', 2), ('dim_bairro_geografica', 11),
  ('fato_pedidos_final', 4), ('fato_status_pedidos_final', 4), ('fato_dated_final', 7), ('fato_undated_final', 5)) t(object_name, columns_compared)"""

# ------------------------------------------------------ view smoke queries

SERIE_TEMPORAL_CTE = """serie_temporal AS (
  SELECT 'pedidos' AS fonte, t.ano, t.mes, t.ordem_mes, t.ano_mes, d.doenca, f.casos, f.obitos
  FROM fact_pedidos f LEFT JOIN dim_tempo t ON f.id_tempo = t.id_tempo
  LEFT JOIN dim_doenca d ON f.id_doenca = d.id_doenca
  UNION ALL
  SELECT 'status_pedidos', t.ano, t.mes, t.ordem_mes, t.ano_mes, d.doenca, f.casos, f.obitos
  FROM fact_status f LEFT JOIN dim_tempo t ON f.id_tempo = t.id_tempo
  LEFT JOIN dim_doenca d ON f.id_doenca = d.id_doenca)"""

ORACLE["smoke_serie_temporal"] = f"""WITH {MART_CTES}, {SERIE_TEMPORAL_CTE}
SELECT doenca, ano, mes, ordem_mes, CAST(sum(casos) AS BIGINT) AS casos, CAST(sum(obitos) AS BIGINT) AS obitos
FROM serie_temporal GROUP BY doenca, ano, mes, ordem_mes"""
ORACLE["smoke_casos_espaciais"] = f"""WITH {MART_CTES}
SELECT fonte, doenca, bairro, sexo, ano, count(*) AS records FROM casos_espaciais
GROUP BY fonte, doenca, bairro, sexo, ano"""
ORACLE["null_key_rows_dated"] = f"""WITH {MART_CTES}
SELECT * FROM fact_dated WHERE id_doenca IS NULL OR id_bairro IS NULL OR id_sexo IS NULL OR id_tempo IS NULL"""
ORACLE["vw_casos_espaciais_geo_serving"] = f"""WITH {GEO_CTES},
serving AS ({ORACLE["vw_casos_espaciais_serving"].split(MART_CTES, 1)[1]})
SELECT ce.*, g.id_bairro_canonico, g.bairro_padronizado, g.latitude, g.longitude, g.latitude_plot,
       g.longitude_plot, g.is_mappable, g.spatial_status, g.spatial_quality, g.geocode_source
FROM serving ce LEFT JOIN geo_dim_draft g ON ce.id_bairro = g.id_bairro"""

# Names over 64 characters, one canonical name a supplier; every pair is compared.
ORACLE["match_long_names"] = f"""
WITH canon AS (SELECT {mk("'Casa ' || md5(s_name) || ' ' || md5(s_name || '#')")} AS c,
                      'Casa ' || md5(s_name) || ' ' || md5(s_name || '#') AS name FROM supplier),
src AS (
  SELECT s_suppkey * 4 + v AS id_bairro, {mk("""substr(n, 1, p - 1) || repeat('z', [0, 12, 19, 30][v + 1]) || substr(n, p + [1, 12, 19, 30][v + 1])""")} AS u
  FROM (SELECT s_suppkey, unnest(range(4)) AS v, 6 + (s_suppkey % 30) AS p, 'Casa ' || md5(s_name) || ' ' || md5(s_name || '#') AS n FROM supplier)),
pairs AS (
  SELECT id_bairro, name, c, levenshtein(u, c)::INTEGER AS distance, 1 - levenshtein(u, c) / greatest(length(u), length(c)) AS similarity
  FROM src, canon),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id_bairro ORDER BY similarity DESC, distance, c) AS rk FROM pairs),
seen AS (SELECT * FROM ranked WHERE rk <= 2 AND similarity >= 0.7::DOUBLE)
SELECT s.id_bairro, length(s.u)::INTEGER AS key_length, a.name AS bairro_by_fuzzy, a.similarity AS best_similarity, a.distance AS best_distance,
       b.name AS second_best_match, coalesce(a.similarity >= 0.85::DOUBLE AND a.similarity - t.similarity >= 0.05::DOUBLE, false) AS fuzzy_accepted
FROM src s LEFT JOIN seen a ON a.id_bairro = s.id_bairro AND a.rk = 1 LEFT JOIN seen b ON b.id_bairro = s.id_bairro AND b.rk = 2
LEFT JOIN ranked t ON t.id_bairro = s.id_bairro AND t.rk = 2
"""

# ------------------------------------------------------ report levels, positions, answers

_MAPPABLE = """count(*) AS total_cases, CAST(sum(CASE WHEN is_mappable = true THEN 1 ELSE 0 END) AS BIGINT) AS mappable_cases,
  CAST(sum(CASE WHEN is_mappable = false THEN 1 ELSE 0 END) AS BIGINT) AS non_mappable_cases"""
ORACLE["mappability_levels"] = f"""WITH {GEO_CTES},
r AS (SELECT NULL AS fonte, NULL AS doenca, 'total' AS level, {_MAPPABLE} FROM cases_geo
  UNION ALL SELECT fonte, NULL, 'source', {_MAPPABLE} FROM cases_geo GROUP BY fonte
  UNION ALL SELECT fonte, doenca, 'category', {_MAPPABLE} FROM cases_geo GROUP BY fonte, doenca)
SELECT *, CAST((20000 * mappable_cases + total_cases) // (2 * total_cases) AS DOUBLE) / 100.0 AS mappable_percentage
FROM r WHERE total_cases > 0"""
ORACLE["quality_levels"] = f"""WITH {GEO_CTES}
SELECT NULL AS fonte, spatial_status, spatial_quality, is_mappable, 'total' AS level, count(*) AS registros
FROM cases_geo GROUP BY spatial_status, spatial_quality, is_mappable
UNION ALL SELECT fonte, spatial_status, spatial_quality, is_mappable, 'source', count(*)
FROM cases_geo GROUP BY fonte, spatial_status, spatial_quality, is_mappable"""
ORACLE["cases_of_last_full_year"] = f"""WITH {MART_CTES},
full_year AS (SELECT max(ano) AS ano FROM (SELECT ano FROM dim_tempo GROUP BY ano HAVING count(DISTINCT ordem_mes) = 12))
SELECT fonte, ano, doenca, bairro, mes, count(*) AS casos FROM casos_espaciais JOIN full_year USING (ano)
GROUP BY fonte, ano, doenca, bairro, mes"""
ORACLE["sheet_file_position"] = """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id,
       l_orderkey::BIGINT AS l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey::BIGINT AS l_partkey, l_suppkey::BIGINT AS l_suppkey
FROM lineitem"""
ORACLE["geocode_answers"] = """
SELECT p_name AS place_key,
       CAST(sum(CASE WHEN p_partkey % 11 = 0 THEN 0 WHEN p_partkey % 4 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS candidates,
       CASE WHEN bool_or(p_partkey % 11 = 0) THEN 'error: malformed answer' END AS status
FROM part GROUP BY p_name"""
ORACLE["ordered_cases_per_place"] = f"""SELECT *, row_number() OVER (ORDER BY count DESC, doenca NULLS FIRST, bairro NULLS FIRST) AS position
FROM ({ORACLE["linelist_cases_per_place"]})"""
ORACLE["top_places"] = f"""SELECT * FROM ({ORACLE["linelist_cases_per_place"]}) ORDER BY count DESC, doenca NULLS FIRST, bairro NULLS FIRST LIMIT 20"""

# ------------------------------------------------------ every branch; values stated here, not taken from the package

ORACLE["rules_duplicated_brands"] = f"""SELECT bairro_original_key, count(*) AS occurrences
FROM (SELECT DISTINCT {mk('p_brand')} AS bairro_original_key, p_type FROM part) GROUP BY bairro_original_key HAVING count(*) > 1"""
ORACLE["geocode_corrected_narrow_box"] = f"""WITH {SPATIAL_CTES},
p AS (SELECT *, CASE WHEN id_bairro_canonico % 3 < 2 THEN -21.2::DOUBLE ELSE latitude END AS lat,
             CASE WHEN id_bairro_canonico % 3 = 0 THEN -50.45::DOUBLE ELSE longitude END AS lon FROM draft),
s AS (SELECT *, lat BETWEEN -21.25::DOUBLE AND -21.1::DOUBLE AND lon BETWEEN -50.6::DOUBLE AND -50.3::DOUBLE AS inside FROM p)
SELECT id_bairro_canonico, bairro, lat AS latitude_final, lon AS longitude_final, inside AS is_inside_bbox_final,
  CASE WHEN id_bairro_canonico % 3 = 0 THEN 'manual review' ELSE 'nominatim_osm' END AS geocode_source_final,
  CASE WHEN lat IS NULL OR lon IS NULL THEN 'not_found' WHEN inside THEN 'found' ELSE 'found_outside_bbox' END AS geocode_status_final,
  lat IS NULL OR lon IS NULL OR NOT inside OR candidate_score < 5 AS needs_review_final FROM s"""
ORACLE["geo_dimension_statuses"] = """
WITH k AS (SELECT p_partkey::INTEGER AS k, mode FROM part, (SELECT unnest(['validated', 'draft', 'missing']) AS mode)),
p AS (SELECT *, k % 13 <> 0 AS named, k % 5 = 0 AS by_hand, k % 13 <> 0 AND k % 4 <> 0 AS located FROM k),
c AS (SELECT *, CASE WHEN by_hand THEN -21.2::DOUBLE WHEN located THEN -21.0::DOUBLE - (k % 500)::DOUBLE / 1000.0::DOUBLE END AS latitude,
  CASE WHEN NOT named THEN 'unresolved_name' WHEN k % 7 = 0 THEN 'not_geocodable_source_name' WHEN by_hand THEN 'manual_reference_point'
       WHEN NOT located THEN 'missing_coordinates' WHEN k % 500 NOT BETWEEN 50 AND 350 THEN 'outside_bbox'
       WHEN k % 12 < 9 THEN 'low_confidence_geocoding' WHEN mode = 'validated' THEN 'validated_geocoding'
       WHEN mode = 'draft' THEN 'draft_geocoding' ELSE 'geocoded' END AS spatial_status FROM p)
SELECT mode, k AS id_bairro, latitude, coalesce(latitude, -21.2089::DOUBLE) AS latitude_plot,
  latitude IS NOT NULL AND spatial_status IN ('manual_reference_point', 'validated_geocoding', 'draft_geocoding') AS is_mappable, spatial_status,
  CASE spatial_status WHEN 'validated_geocoding' THEN 'high' WHEN 'manual_reference_point' THEN 'medium' WHEN 'draft_geocoding' THEN 'medium'
       WHEN 'low_confidence_geocoding' THEN 'low' WHEN 'outside_bbox' THEN 'low' ELSE 'unresolved' END AS spatial_quality,
  CASE WHEN by_hand THEN 'mapa' WHEN named THEN 'osm' ELSE mode END AS geocode_source FROM c"""
