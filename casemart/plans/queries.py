"""Driver queries: one per operator family of the survey, on the given tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal the matching oracle SQL in ``casemart.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.functions.text import clean_int, match_key, normalize_key, normalize_text
from casemart.operators import dims as D
from casemart.operators import facts as FX
from casemart.operators import reshape as R
from casemart.plans.world import World
from casemart.session import freeze, stage_counted

#: Rows that one file of a written sheet holds, about: what its task sorts.
SHEET_ROWS = 500_000

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _sum_exact(c, scale: int = 2):
    """Order-independent sum of a double: exact decimal sum, then double."""
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double")


# ------------------------------------------------------------- phase 1: cleaning

@query("clean_int_names")
def clean_int_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = World(spark, sf_dir)
    c = w.t("customer").select(F.lit("customer").alias("origem"), F.col("c_custkey").alias("chave"),
                               F.col("c_name").alias("texto"))
    s = w.t("supplier").select(F.lit("supplier").alias("origem"), F.col("s_suppkey").alias("chave"),
                               F.col("s_name").alias("texto"))
    return c.unionByName(s).select("origem", "chave", clean_int(F.col("texto")).alias("numero"))


@query("normalize_text_docs")
def normalize_text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = World(spark, sf_dir).t("documents")
    return d.select("doc_id", normalize_text(F.col("text")).alias("texto_normalizado"))


@query("normalize_key_docs")
def normalize_key_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = World(spark, sf_dir).t("documents")
    return d.select("doc_id", normalize_key(F.col("text")).alias("chave"))


@query("match_key_docs")
def match_key_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = World(spark, sf_dir).t("documents")
    return d.select("doc_id", match_key(F.col("text")).alias("chave_match"))


@query("match_key_places")
def match_key_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = World(spark, sf_dir)
    raw = w.raw_dated_cases().unionByName(
        w.raw_undated_cases().select("_c3").withColumnRenamed("_c3", "_c4"), allowMissingColumns=True)
    return (raw.select(F.col("_c4").alias("bairro_bruto")).distinct()
            .select("bairro_bruto", match_key(F.col("bairro_bruto")).alias("chave_match")))


# ------------------------------------------------ phase 1: dimensions and facts

def _orders_star(spark: SparkSession, sf_dir: str):
    """Orders as a measure fact with three dimensions: calendar (order date),
    market segment (via customer) and priority."""
    w = World(spark, sf_dir)
    orders = w.t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    customer = w.t("customer").select("c_custkey", "c_mktsegment")
    dim_seg = D.build_dimension([customer.select(F.col("c_mktsegment").alias("segmento"))],
                                "segmento", "id_segmento")
    dim_pri = D.build_dimension([orders.select(F.col("o_orderpriority").alias("prioridade"))],
                                "prioridade", "id_prioridade")
    li = w.t("lineitem").select("l_shipdate")
    dim_cal = D.calendar_dimension(dated=[(orders.select(F.col("o_orderdate").alias("d")), "d"),
                                          (li.select(F.col("l_shipdate").alias("d")), "d")])
    fact = (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
            .select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("d"),
                    F.col("c_mktsegment").alias("segmento"), F.col("o_orderpriority").alias("prioridade")))
    fact = FX.with_calendar_keys(FX.with_normalized(fact, ["segmento", "prioridade"]), "d")
    resolved = FX.resolve_keys(fact, [FX.DimRef(dim_cal, ["ano", "mes", "ordem_mes"]),
                                      FX.DimRef(dim_seg, ["segmento"]), FX.DimRef(dim_pri, ["prioridade"])],
                               ["id_tempo", "id_segmento", "id_prioridade", "o_orderkey", "o_totalprice"])
    return resolved, dim_cal, dim_seg, dim_pri


@query("dim_calendar_orders")
def dim_calendar_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_star(spark, sf_dir)[1]


@query("dim_segment")
def dim_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_star(spark, sf_dir)[2]


@query("dim_part_name_dense_id")
def dim_part_name_dense_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = World(spark, sf_dir).t("part").select(F.col("p_name").alias("nome"))
    return D.build_dimension([p], "nome", "id_nome")


@query("fact_orders_resolved")
def fact_orders_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_star(spark, sf_dir)[0]


@query("orders_by_month_segment")
def orders_by_month_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: resolved fact denormalized back through its dimensions and
    aggregated per month and segment."""
    fact, dim_cal, dim_seg, _ = _orders_star(spark, sf_dir)
    v = (fact.join(dim_cal, "id_tempo", "left")
         .join(dim_seg, "id_segmento", "left"))
    return (v.groupBy("ano_mes", "segmento")
            .agg(F.count(F.lit(1)).alias("pedidos"), _sum_exact(F.col("o_totalprice")).alias("valor_total")))


# --------------------------------------------------------- phase 2: sheets

@query("series_monthly_sheet")
def series_monthly_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = World(spark, sf_dir)
    return R.series_from_sheet(w.monthly_sheet(), "_c0", w.series_layout(), "pedidos")


@query("series_stacked_sheet")
def series_stacked_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = World(spark, sf_dir)
    return R.series_from_stacked_sheet(w.stacked_sheet(), "row_id", "_c0", w.stacked_layout())


@query("linelist_dated")
def linelist_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casemart.plans.world import DATED_SOURCE
    return FX.clean_dated_linelist(World(spark, sf_dir).raw_dated_cases(), DATED_SOURCE)


@query("linelist_undated")
def linelist_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casemart.plans.world import UNDATED_REFERENCE_YEAR, UNDATED_SOURCE
    return FX.clean_undated_linelist(World(spark, sf_dir).raw_undated_cases(), UNDATED_SOURCE,
                                     UNDATED_REFERENCE_YEAR)


# ------------------------------------------------ phase 3-5: the case data mart

# Stage outputs of one run of the mart, kept per session like the stored
# tables of the run book: every view/report query of the same session reads
# them instead of rebuilding the chain.  The key carries a fingerprint of the
# input files, so changed inputs rebuild.
_STAGES: dict[tuple, tuple] = {}


def _fingerprint(sf_dir: str) -> tuple:
    import os
    out = []
    for name in ("orders", "lineitem", "part"):
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        try:
            st = os.stat(path)
            out.append((name, st.st_size, st.st_mtime_ns))
        except OSError:          # remote storage: identify by path only
            out.append((name, path))
    return tuple(out)


def clear_stages() -> None:
    _STAGES.clear()


def _stage_key(spark: SparkSession, sf_dir: str, *extra) -> tuple:
    return (id(spark.sparkContext), spark.sparkContext.applicationId, sf_dir, _fingerprint(sf_dir), *extra)


def _mart(spark: SparkSession, sf_dir: str):
    key = _stage_key(spark, sf_dir, "mart")
    if key not in _STAGES:
        _STAGES[key] = _build_mart(spark, sf_dir)
    return _STAGES[key]


def _build_mart(spark: SparkSession, sf_dir: str):
    from casemart.plans.mart import CaseMart
    from casemart.plans.world import DATED_SOURCE, UNDATED_REFERENCE_YEAR, UNDATED_SOURCE
    w = World(spark, sf_dir)
    series = {"pedidos": R.series_from_sheet(w.monthly_sheet(), "_c0", w.series_layout(), "pedidos"),
              "status_pedidos": R.series_from_stacked_sheet(w.stacked_sheet(), "row_id", "_c0", w.stacked_layout())}
    rows = {}
    for f, df in series.items():
        series[f], seen = stage_counted(df, f"series-{f}")
        rows[f] = seen["rows"]
    # the cleaned line lists feed four dimensions and two facts: one join and
    # one pass clean both, and they are stored in a folder each (columnar, so
    # each dimension scan is pruned)
    lists, seen = stage_counted(FX.clean_linelists(w.raw_cases(), "lista", w.list_layouts()), "linelists",
                                by="lista", values=(DATED_SOURCE, UNDATED_SOURCE))
    rows.update({f"{v}_espacial": seen[f"rows_{v}"] for v in (DATED_SOURCE, UNDATED_SOURCE)})
    dated = lists.filter(F.col("lista") == DATED_SOURCE).drop("lista", "ano_referencia")
    undated = lists.filter(F.col("lista") == UNDATED_SOURCE).select("idade", "sexo", "bairro", "ano_referencia", "doenca")
    mart = CaseMart(series, dated, undated, line_lists=lists, dated_source=f"{DATED_SOURCE}_espacial",
                    undated_source=f"{UNDATED_SOURCE}_espacial", undated_reference_year=UNDATED_REFERENCE_YEAR, input_rows=rows)
    return w, mart


def _spatial(spark: SparkSession, sf_dir: str, approve: bool = False):
    key = _stage_key(spark, sf_dir, "spatial", approve)
    if key not in _STAGES:
        _STAGES[key] = _build_spatial(spark, sf_dir, approve)
    return _STAGES[key]


def spatial_inputs(spark: SparkSession, sf_dir: str):
    """The spatial mart over the stored line lists, none of its stages built yet."""
    from casemart.plans.mart import SpatialMart
    w, mart = _mart(spark, sf_dir)
    canonical = w.canonical_places()
    return mart, SpatialMart(mart, canonical, w.alias_rules(), w.manual_rules(), w.geocoder_candidates(),
                             manual_points=w.manual_points(canonical), approve_geocoding=False,
                             lookup_errors=w.geocoder_errors())


def _build_spatial(spark: SparkSession, sf_dir: str, approve: bool):
    from casemart.plans.mart import SpatialMart
    w, mart = _mart(spark, sf_dir)
    if approve:
        # the approval gate changes only what follows the draft: share the
        # stored standardization, curation and draft of the draft-mode run
        base = _spatial(spark, sf_dir, approve=False)[2]
        sm = SpatialMart(mart, base.canonical, base.aliases, base.rules, base.candidates,
                         manual_points=base.manual_points, approve_geocoding=True,
                         lookup_errors=base.lookup_errors, corrections=base.corrections)
        for stage in ("standardized", "curated", "draft"):
            setattr(sm, stage, getattr(base, stage))
        return w, mart, sm
    _, sm = spatial_inputs(spark, sf_dir)
    return _with_corrections(w, mart, sm)


def _with_corrections(w, mart, sm):
    from casemart.functions.geo import FALLBACK_LAT, FALLBACK_LON
    # reviewer corrections: even-numbered places found outside the box are
    # pinned to the municipal centre
    sm.corrections = (sm.draft.filter((F.col("geocode_status") == "found_outside_bbox")
                                      & (F.col("id_bairro_canonico") % 2 == 0))
                      .select("bairro", F.lit(FALLBACK_LAT).alias("manual_latitude"),
                              F.lit(FALLBACK_LON).alias("manual_longitude"),
                              F.lit("manual review").alias("manual_source")))
    return w, mart, sm


def keep_spatial(spark: SparkSession, sf_dir: str, sm) -> None:
    """Make the built stages of ``sm`` those that the queries of this session read."""
    _STAGES[_stage_key(spark, sf_dir, "spatial", False)] = _with_corrections(*_mart(spark, sf_dir), sm)


@query("mart_dim_place")
def mart_dim_place(spark, sf_dir):
    return _mart(spark, sf_dir)[1].dim_bairro


@query("mart_dim_sex")
def mart_dim_sex(spark, sf_dir):
    return _mart(spark, sf_dir)[1].dim_sexo


@query("mart_dim_category")
def mart_dim_category(spark, sf_dir):
    return _mart(spark, sf_dir)[1].dim_doenca


@query("mart_dim_time")
def mart_dim_time(spark, sf_dir):
    return _mart(spark, sf_dir)[1].dim_tempo


@query("mart_fact_series")
def mart_fact_series(spark, sf_dir):
    m = _mart(spark, sf_dir)[1]
    parts = [m.series_fact(f).withColumn("fonte", F.lit(f)) for f in m.series]
    return parts[0].unionByName(parts[1])


@query("mart_fact_dated")
def mart_fact_dated(spark, sf_dir):
    return _mart(spark, sf_dir)[1].dated_fact


@query("mart_fact_undated")
def mart_fact_undated(spark, sf_dir):
    return _mart(spark, sf_dir)[1].undated_fact


@query("vw_serie_temporal")
def vw_serie_temporal(spark, sf_dir):
    return _mart(spark, sf_dir)[1].serie_temporal()


@query("vw_casos_espaciais")
def vw_casos_espaciais(spark, sf_dir):
    return _mart(spark, sf_dir)[1].casos_espaciais()


@query("vw_casos_espaciais_serving")
def vw_casos_espaciais_serving(spark, sf_dir):
    from casemart.plans.world import DATED_SOURCE, UNDATED_SOURCE
    return _mart(spark, sf_dir)[1].casos_espaciais(labels=(DATED_SOURCE, UNDATED_SOURCE), keep_ids=True,
                                                   undated_year_month_text=True)


@query("null_key_audit")
def null_key_audit(spark, sf_dir):
    return _mart(spark, sf_dir)[1].null_key_audit()


@query("row_preservation")
def row_preservation(spark, sf_dir):
    return _mart(spark, sf_dir)[1].row_preservation()


@query("series_summary")
def series_summary(spark, sf_dir):
    from casemart.operators.quality import series_summary as summ
    m = _mart(spark, sf_dir)[1]
    s = m.series["pedidos"].unionByName(m.series["status_pedidos"])
    return summ(s)


# -------------------------------------------------------- record linkage

@query("match_standardized")
def match_standardized(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].standardized


@query("match_fuzzy_top2")
def match_fuzzy_top2(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].fuzzy_scores()


@query("match_long_names")
def match_long_names(spark, sf_dir):
    """The fuzzy step on names over 64 characters, whose number grows with the suppliers."""
    from casemart.operators import match as M
    w = World(spark, sf_dir)
    # the suppliers are few bytes, their names are not: dealt out before they are cleaned, and stored once
    names = freeze(w.long_spellings().repartition("id_bairro").withColumn("bairro_original_key", match_key(F.col("bairro_original"))))
    scores = M.fuzzy_scores(names, freeze(M.prepare_canonical(w.long_places().repartition("id_bairro_canonico"))))
    return (names.select("id_bairro", F.length("bairro_original_key").alias("key_length")).join(scores, "id_bairro")
            .select("id_bairro", "key_length", "bairro_by_fuzzy", "best_similarity", "best_distance", "second_best_match", "fuzzy_accepted"))


@query("match_summary")
def match_summary(spark, sf_dir):
    from casemart.operators.quality import match_summary as ms
    return ms(_spatial(spark, sf_dir)[2].standardized)


@query("match_names_per_canonical")
def match_names_per_canonical(spark, sf_dir):
    from casemart.operators.quality import names_per_canonical
    return names_per_canonical(_spatial(spark, sf_dir)[2].standardized)


@query("match_worklist")
def match_worklist(spark, sf_dir):
    from casemart.operators.match import worklist
    return worklist(_spatial(spark, sf_dir)[2].standardized)


# ---------------------------------------------------------------- curation

@query("curated_standardized")
def curated_standardized(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].curated


@query("rules_live")
def rules_live(spark, sf_dir):
    from casemart.operators.curate import live_rules
    sm = _spatial(spark, sf_dir)[2]
    return live_rules(sm.rules, sm.standardized, "bairro_original_key")


@query("rules_dead")
def rules_dead(spark, sf_dir):
    from casemart.operators.curate import dead_rules
    sm = _spatial(spark, sf_dir)[2]
    return dead_rules(sm.rules, sm.standardized, "bairro_original_key")


@query("rules_duplicated")
def rules_duplicated(spark, sf_dir):
    from casemart.operators.curate import duplicated_rule_keys
    return duplicated_rule_keys(World(spark, sf_dir).manual_rules(), "bairro_original_key")


@query("rules_duplicated_brands")
def rules_duplicated_brands(spark, sf_dir):
    """Rule keys that occur more than once where every brand and type gives a rule."""
    from casemart.operators.curate import duplicated_rule_keys
    rules = World(spark, sf_dir).t("part").select(match_key(F.col("p_brand")).alias("bairro_original_key"), "p_type").distinct()
    return duplicated_rule_keys(rules, "bairro_original_key")


@query("curation_null_check")
def curation_null_check(spark, sf_dir):
    from casemart.operators.quality import curation_null_check as cnc
    return cnc(_spatial(spark, sf_dir)[2].curated)


@query("curated_worklist")
def curated_worklist(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].worklist()


# --------------------------------------------------------------- geocoding

@query("geocode_draft")
def geocode_draft(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].draft.drop("created_at")


@query("geocode_problem_queue")
def geocode_problem_queue(spark, sf_dir):
    from casemart.operators.geocode import problem_queue
    return problem_queue(_spatial(spark, sf_dir)[2].draft)


@query("geocode_corrected")
def geocode_corrected(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].corrected().drop("created_at")


@query("geocode_validated")
def geocode_validated(spark, sf_dir):
    return _spatial(spark, sf_dir, approve=True)[2].validated().drop("created_at")


@query("geocode_status_counts")
def geocode_status_counts(spark, sf_dir):
    from casemart.operators.geocode import draft_status_counts
    return draft_status_counts(_spatial(spark, sf_dir)[2].draft)


# ------------------------------------------------- geographic dimension, views

@query("geo_dimension")
def geo_dimension(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].geo_dim


@query("geo_dimension_validated")
def geo_dimension_validated(spark, sf_dir):
    return _spatial(spark, sf_dir, approve=True)[2].geo_dim


@query("vw_casos_espaciais_geo")
def vw_casos_espaciais_geo(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].cases_geo


@query("vw_mapa_casos_bairro")
def vw_mapa_casos_bairro(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].map_counts()


@query("vw_mapa_casos_bairro_mapeavel")
def vw_mapa_casos_bairro_mapeavel(spark, sf_dir):
    from casemart.operators.spatial import mappable_only
    return mappable_only(_spatial(spark, sf_dir)[2].map_counts())


@query("vw_mapa_serving")
def vw_mapa_serving(spark, sf_dir):
    from casemart.operators.spatial import mappable_only
    return mappable_only(_spatial(spark, sf_dir)[2].map_counts(), serving=True)


@query("vw_qualidade_espacial")
def vw_qualidade_espacial(spark, sf_dir):
    from casemart.operators.spatial import quality_counts
    return quality_counts(_spatial(spark, sf_dir)[2].groups_geo, weight="casos")


@query("vw_qualidade_por_fonte")
def vw_qualidade_por_fonte(spark, sf_dir):
    from casemart.operators.spatial import quality_counts
    return quality_counts(_spatial(spark, sf_dir)[2].groups_geo, by_source=True, weight="casos")


@query("mappability_report")
def mappability_report(spark, sf_dir):
    from casemart.operators.spatial import mappability_report as mr
    return mr(_spatial(spark, sf_dir)[2].groups_geo, weight="casos")


@query("geocode_corrected_narrow_box")
def geocode_corrected_narrow_box(spark, sf_dir):
    """Corrections over the draft in a narrower box: every third place gets both
    coordinates by hand, every other third the latitude alone, and points fall outside."""
    from casemart.functions.geo import BBox
    from casemart.operators.geocode import apply_corrections
    draft, k = _spatial(spark, sf_dir)[2].draft, F.col("id_bairro_canonico") % 3
    hand = draft.filter(k < 2).select("bairro", F.lit(-21.2).alias("manual_latitude"), F.when(k == 0, F.lit(-50.45)).alias("manual_longitude"),
                                      F.lit("manual review").alias("manual_source"))
    done = apply_corrections(draft, hand, BBox(min_lat=-21.25, max_lat=-21.1, min_lon=-50.6, max_lon=-50.3))
    return done.select("id_bairro_canonico", "bairro", "latitude_final", "longitude_final", "geocode_source_final", "is_inside_bbox_final",
                       "geocode_status_final", "needs_review_final")


@query("geo_dimension_statuses")
def geo_dimension_statuses(spark, sf_dir):
    """The geographic dimension of places that meet every case of the cascade, in all three modes."""
    from casemart.operators.spatial import geo_dimension as gd
    places, standardized, geocoded, points = World(spark, sf_dir).hard_places()
    parts = [gd(places, standardized, geocoded, points, mode).withColumn("mode", F.lit(mode)) for mode in ("validated", "draft", "missing")]
    return reduce(DataFrame.unionByName, parts).select("mode", "id_bairro", "latitude", "latitude_plot", "is_mappable", "spatial_status",
                                                       "spatial_quality", "geocode_source")


@query("mappability_levels")
def mappability_levels(spark, sf_dir):
    from casemart.operators.spatial import mappability_levels as ml
    return ml(_spatial(spark, sf_dir)[2].groups_geo, weight="casos")


@query("quality_levels")
def quality_levels(spark, sf_dir):
    from casemart.operators.spatial import quality_levels as ql
    return ql(_spatial(spark, sf_dir)[2].groups_geo, weight="casos")


@query("cases_of_last_full_year")
def cases_of_last_full_year(spark, sf_dir):
    return _mart(spark, sf_dir)[1].cases_of_last_full_year()


@query("sheet_file_position")
def sheet_file_position(spark, sf_dir):
    """Every line item written in order as a headerless sheet of several files,
    then read back by position: its rows are numbered across files and splits."""
    import uuid

    from casemart.session import checkpoint_dir
    from casemart.sources.tables import read_raw_sheet, with_file_position
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = World(spark, sf_dir).t("lineitem").select(*keys, "l_shipdate", "l_returnflag")
    path = f"{checkpoint_dir(spark).rstrip('/')}/sheet-{uuid.uuid4().hex}"
    files = max(3, -(-lines.count() // SHEET_ROWS))
    lines.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.csv(path)
    sheet = with_file_position(read_raw_sheet(spark, path, len(lines.columns)))
    return sheet.select("row_id", *[F.col(f"_c{i}").cast("long").alias(k) for i, k in enumerate(keys)])


@query("geocode_answers")
def geocode_answers(spark, sf_dir):
    """Candidates and malformed answers per place, where every eleventh answer is
    cut off and every fourth holds an array of two."""
    from casemart.operators.geocode import malformed_answers, parse_candidates
    answer, key = F.col("response"), F.col("position")
    raw = World(spark, sf_dir).geocoder_candidates().withColumn("response", F.when(key % 11 == 0, F.expr("substr(response, 1, length(response) - 5)"))
                                        .when(key % 4 == 0, F.concat(F.lit("["), answer, F.lit(","), answer, F.lit("]"))).otherwise(answer))
    parsed = parse_candidates(raw).groupBy("place_key").agg(F.count(F.lit(1)).alias("candidates"))
    places = raw.select("place_key").distinct()
    return (places.join(parsed, "place_key", "left").join(malformed_answers(raw), "place_key", "left")
            .select("place_key", F.coalesce("candidates", F.lit(0)).alias("candidates"), F.concat(F.lit("error: "), "error").alias("status")))


@query("fatal_checks")
def fatal_checks(spark, sf_dir):
    from casemart.operators.quality import fatal_spatial_checks
    return fatal_spatial_checks(_spatial(spark, sf_dir)[2].groups_geo, weight="casos")


@query("non_mappable_by_place")
def non_mappable_by_place(spark, sf_dir):
    from casemart.operators.spatial import non_mappable_by_place as nm
    return nm(_spatial(spark, sf_dir)[2].groups_geo, weight="casos")


@query("low_confidence_places")
def low_confidence_places(spark, sf_dir):
    from casemart.operators.spatial import low_confidence_places as lc
    return lc(_spatial(spark, sf_dir)[2].geo_dim)


# ------------------------------------------------- summaries, audits, export

@query("geocode_missing_coordinates")
def geocode_missing_coordinates(spark, sf_dir):
    from casemart.operators.geocode import draft_missing_coordinates
    return draft_missing_coordinates(_spatial(spark, sf_dir)[2].draft)


@query("geocode_outside_bbox")
def geocode_outside_bbox(spark, sf_dir):
    from casemart.operators.geocode import draft_outside_bbox
    return draft_outside_bbox(_spatial(spark, sf_dir)[2].draft)


@query("match_unmatched")
def match_unmatched(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].standardized.filter(F.col("needs_review") == F.lit(True))


@query("match_accepted_fuzzy")
def match_accepted_fuzzy(spark, sf_dir):
    return _spatial(spark, sf_dir)[2].standardized.filter(F.col("match_method") == "fuzzy")


@query("linelist_cases_per_place")
def linelist_cases_per_place(spark, sf_dir):
    m = _mart(spark, sf_dir)[1]
    return (m.dated.select("doenca", "bairro").unionByName(m.undated.select("doenca", "bairro"))
            .groupBy("doenca", "bairro").agg(F.count(F.lit(1)).alias("count")))


@query("ordered_cases_per_place")
def ordered_cases_per_place(spark, sf_dir):
    """The cases per place written most cases first, and each row's place in the files."""
    import uuid

    from casemart.session import checkpoint_dir
    from casemart.sources.tables import with_file_position, write_ordered
    path = f"{checkpoint_dir(spark).rstrip('/')}/ordered-{uuid.uuid4().hex}"
    write_ordered(linelist_cases_per_place(spark, sf_dir), path, [F.col("count").desc(), F.col("doenca"), F.col("bairro")])
    return with_file_position(spark.read.parquet(path), "position")


@query("top_places")
def top_places(spark, sf_dir):
    """Preview: the twenty places with most cases."""
    return linelist_cases_per_place(spark, sf_dir).orderBy(F.col("count").desc(), "doenca", "bairro").limit(20)


def _final_objects(spark, sf_dir) -> dict[str, DataFrame]:
    _, m, sm = _spatial(spark, sf_dir)
    objs = {"dim_tempo": m.dim_tempo, "dim_doenca": m.dim_doenca, "dim_bairro": m.dim_bairro,
            "dim_sexo": m.dim_sexo, "dim_bairro_geografica": sm.geo_dim}
    objs.update({f"fato_{f}_final": m.series_fact(f) for f in m.series})
    objs["fato_dated_final"] = m.dated_fact
    objs["fato_undated_final"] = m.undated_fact
    return objs


@query("row_counts")
def row_counts(spark, sf_dir):
    """Row-count audit over the final tables and views (one union of counts)."""
    from casemart.operators.spatial import map_counts
    from casemart.sources.tables import count_rows
    _, m, sm = _spatial(spark, sf_dir)
    objs = _final_objects(spark, sf_dir)
    objs.update({"vw_serie_temporal": m.serie_temporal(), "vw_casos_espaciais": m.casos_espaciais(),
                 "vw_casos_espaciais_geo": sm.cases_geo, "vw_mapa_casos_bairro": map_counts(sm.cases_geo)})
    return count_rows(objs)


# Target layout of the serving geographic table (columns of the relational
# target; ``updated_at`` exists only in the target and is left to its default)
SERVING_GEO_COLUMNS = ["id_bairro", "id_bairro_canonico", "bairro_padronizado", "latitude", "longitude",
                       "latitude_plot", "longitude_plot", "is_mappable", "spatial_status", "spatial_quality",
                       "geocode_source", "updated_at"]


@query("export_reconcile")
def export_reconcile(spark, sf_dir):
    """Ordered load of the final tables into a parquet target under the
    checkpoint folder (dimensions before facts), the geographic dimension
    aligned to the serving layout, then source vs target row counts."""
    import uuid

    from casemart.plans.reference_data import EXPORT_ORDER
    from casemart.session import checkpoint_dir
    from casemart.sources.tables import align_to_target, count_rows, ordered_load, reconcile
    objs = _final_objects(spark, sf_dir)
    objs["dim_bairro_geografica"] = align_to_target(objs["dim_bairro_geografica"], SERVING_GEO_COLUMNS).frame
    order = [n for n in EXPORT_ORDER if n in objs] + [n for n in objs if n not in EXPORT_ORDER]
    root = f"{checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    ordered_load([(n, objs[n]) for n in order], lambda n, df: df.write.mode("overwrite").parquet(f"{root}/{n}"))
    target = count_rows({n: spark.read.parquet(f"{root}/{n}") for n in order})
    # the facts were counted when they were written; only dimensions are counted now
    m = _mart(spark, sf_dir)[1]
    facts = {"fato_dated_final": f"{m.dated_source}_final", "fato_undated_final": f"{m.undated_source}_final",
             **{f"fato_{f}_final": f"{f}_final" for f in m.series}}
    known = spark.createDataFrame([(n, m.written[f]["rows"]) for n, f in facts.items()], "object_name string, rows bigint")
    return reconcile(known.unionByName(count_rows({n: objs[n] for n in order if n not in facts})), target)


@query("export_contents")
def export_contents(spark, sf_dir):
    """The final tables written to a parquet target of the serving layout and
    compared row by row, aligned to the target's columns and types."""
    import uuid

    from casemart.session import checkpoint_dir
    from casemart.sources.tables import align_to_target, content_differences, ordered_load
    objs = _final_objects(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    served = dict(objs, dim_bairro_geografica=align_to_target(objs["dim_bairro_geografica"], SERVING_GEO_COLUMNS).frame)
    ordered_load(list(served.items()), lambda n, df: df.write.mode("overwrite").parquet(f"{root}/{n}"))
    parts = [content_differences(df, spark.read.parquet(f"{root}/{n}"), n) for n, df in objs.items()]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------ view smoke queries

@query("smoke_serie_temporal")
def smoke_serie_temporal(spark, sf_dir):
    return (_mart(spark, sf_dir)[1].serie_temporal().groupBy("doenca", "ano", "mes", "ordem_mes")
            .agg(F.sum("casos").alias("casos"), F.sum("obitos").alias("obitos")))


@query("smoke_casos_espaciais")
def smoke_casos_espaciais(spark, sf_dir):
    return (_mart(spark, sf_dir)[1].casos_espaciais().groupBy("fonte", "doenca", "bairro", "sexo", "ano")
            .agg(F.count(F.lit(1)).alias("records")))


@query("null_key_rows_dated")
def null_key_rows_dated(spark, sf_dir):
    from casemart.operators.quality import rows_with_null_keys
    return rows_with_null_keys(_mart(spark, sf_dir)[1].dated_fact, ["id_doenca", "id_bairro", "id_sexo", "id_tempo"])


SERVING_GEO_VIEW = ["id_bairro", "id_bairro_canonico", "bairro_padronizado", "latitude", "longitude", "latitude_plot",
                    "longitude_plot", "is_mappable", "spatial_status", "spatial_quality", "geocode_source"]


@query("vw_casos_espaciais_geo_serving")
def vw_casos_espaciais_geo_serving(spark, sf_dir):
    """Serving variant: cases carry their ids and join the geographic
    dimension by id (not by name)."""
    from casemart.operators.spatial import cases_geo
    from casemart.plans.world import DATED_SOURCE, UNDATED_SOURCE
    _, m, sm = _spatial(spark, sf_dir)
    cases = m.casos_espaciais(labels=(DATED_SOURCE, UNDATED_SOURCE), keep_ids=True, undated_year_month_text=True)
    return cases_geo(cases, m.dim_bairro, sm.geo_dim, by="id", columns=SERVING_GEO_VIEW)
