"""The reference pipeline on catalog tables, end to end.

Steps (same order as the original run book): raw sheets and line lists ->
intermediate facts -> dimensions and final facts -> union views and their
validation -> name standardization -> manual curation -> geocoding draft
from a candidate table -> manual reference points -> geographic dimension
and map views -> spatial validation -> ordered export with reconciliation.

Every stage output is written as a table (``write_table``) and the next
stage reads it back, so a failed stage restarts from stored data and the
lineage of each job stays short; a failed write leaves the table as it was.
Views are registered as temp views for the run and, over the stored tables, as
views of the catalog that any session can read (``views.py``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.operators import facts as FX
from casemart.operators import match as M
from casemart.operators import quality as Q
from casemart.operators import reshape as R
from casemart.operators import spatial as SP
from casemart.operators.curate import require_unique_rules
from casemart.plans import reference_data as RD
from casemart.plans.mart import CaseMart, SpatialMart
from casemart.plans.views import create_views
from casemart.sources import tables as T


@dataclass
class PipelineConfig:
    source_prefix: str = "default"
    target_prefix: str = "default"
    fmt: str = "parquet"
    approve_geocoding: bool = False
    fail_on_validation: bool = True
    candidates_table: str = "bairro_geocoding_candidates"   # place_key, query_no, position, response (JSON)
    errors_table: str = "bairro_geocoding_errors"           # optional: place_key, error
    corrections_table: str = "bairro_geocoding_corrections"  # optional: bairro, manual_latitude, manual_longitude, manual_source
    written: list[str] = field(default_factory=list)


def file_position(df: DataFrame, out_col: str = "row_id") -> DataFrame:
    """1-based row position of a headerless sheet in file order, over all its files and splits."""
    return T.with_file_position(df, out_col)


class Pipeline:
    def __init__(self, spark: SparkSession, cfg: PipelineConfig = PipelineConfig()):
        self.spark, self.cfg = spark, cfg

    def src(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.cfg.source_prefix}.{name}")

    def optional(self, name: str) -> DataFrame | None:
        found = T.resolve_source(self.spark, [(f"{self.cfg.source_prefix}.{name}", "present")])
        return self.spark.table(found.name) if found.name else None

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """Write-then-reload barrier between steps."""
        full = f"{self.cfg.target_prefix}.{name}"
        T.replace_table(df, full, fmt=self.cfg.fmt)
        self.cfg.written.append(name)
        return self.spark.table(full)

    # ------------------------------------------------------------ stage 1
    def raw_etl(self) -> dict[str, DataFrame]:
        arb = file_position(self.src("raw_arboviroses"))
        out = {
            "fato_arboviroses": R.series_from_stacked_sheet(arb, "row_id", "_c0", RD.ARBOVIRUS_BLOCKS),
            "fato_covid": R.series_from_sheet(self.src("raw_covid"), "_c0", RD.COVID_LAYOUT, "covid"),
            "fato_escorpiao": R.series_from_sheet(self.src("raw_escorpiao"), "_c0", RD.SCORPION_LAYOUT,
                                                  "escorpiao"),
            "fato_dengue_espacial": FX.clean_dated_linelist(self.src("raw_dengue_espacial"), "dengue"),
            "fato_chikungunya_espacial": FX.clean_undated_linelist(self.src("raw_chikungunya_espacial"),
                                                                   "chikungunya", RD.UNDATED_REFERENCE_YEAR),
        }
        return {k: self.store(k, v) for k, v in out.items()}

    # ------------------------------------------------------------ stage 2
    def model(self, inter: dict[str, DataFrame]) -> CaseMart:
        mart = CaseMart({"arboviroses": inter["fato_arboviroses"], "covid": inter["fato_covid"],
                         "escorpiao": inter["fato_escorpiao"]},
                        inter["fato_dengue_espacial"], inter["fato_chikungunya_espacial"],
                        series_defaults={"escorpiao": "escorpiao"},
                        undated_reference_year=RD.UNDATED_REFERENCE_YEAR)
        for name in ["dim_tempo", "dim_doenca", "dim_bairro", "dim_sexo"]:
            setattr(mart, name, self.store(name, getattr(mart, name)))
        # what follows (views, validation) reads the stored facts
        for fonte in mart.series:
            mart.stored_series[fonte] = self.store(f"fato_{fonte}_final", mart.series_fact(fonte))
        mart.dated_fact = self.store("fato_dengue_espacial_final", mart.dated_fact)
        mart.undated_fact = self.store("fato_chikungunya_espacial_final", mart.undated_fact)
        mart.serie_temporal().createOrReplaceTempView("vw_serie_temporal")
        mart.casos_espaciais().createOrReplaceTempView("vw_casos_espaciais")
        self.validate_model(mart)
        return mart

    def validate_model(self, mart: CaseMart) -> None:
        forbidden = Q.forbidden_columns({"fato_dengue_espacial_final": mart.dated_fact,
                                         "vw_casos_espaciais": mart.casos_espaciais()}, ["exame"])
        if forbidden:
            raise ValueError(f"forbidden columns present: {forbidden}")
        nulls = mart.null_key_audit().filter(F.col("nulls") > 0)
        kept = mart.row_preservation().filter(~F.col("preserved"))
        problems = [tuple(r) for r in nulls.collect()] + [tuple(r) for r in kept.collect()]   # a row per key column and table
        if problems and self.cfg.fail_on_validation:
            raise ValueError(f"model validation failed: {problems}")

    # ------------------------------------------------------------ stage 3
    def spatial(self, mart: CaseMart) -> SpatialMart:
        canonical = self.src("canonical_neighborhoods")
        aliases = self.src("alias_seed_rules")
        T.require_columns(canonical, ["id_bairro_canonico", "bairro_canonico", "bairro_canonico_norm",
                                      "query_geocoding"], "canonical table")
        T.require_columns(aliases, ["alias_norm_observado", "bairro_canonico_sugerido"], "alias table")
        self.store("ref_bairros_canonicos", M.prepare_canonical(canonical))
        self.store("ref_bairros_alias", M.prepare_aliases(aliases))
        rules = T.literal_table(self.spark, RD.MANUAL_RULES, RD.MANUAL_RULES_SCHEMA)
        require_unique_rules(rules, "bairro_original_key")
        points = T.literal_table(self.spark, RD.MANUAL_POINTS, RD.MANUAL_POINTS_SCHEMA)
        cand = T.resolve_source(self.spark, [(f"{self.cfg.source_prefix}.{self.cfg.candidates_table}", "draft")])
        candidates = self.spark.table(cand.name) if cand.name else T.empty_table(
            self.spark, "place_key string, query_no int, position long, response string")
        sm = SpatialMart(mart, canonical, aliases, rules, candidates, manual_points=points,
                         approve_geocoding=self.cfg.approve_geocoding, lookup_errors=self.optional(self.cfg.errors_table),
                         corrections=self.optional(self.cfg.corrections_table), source_mode="draft" if cand.name else "missing")
        sm.standardized = self.store("ref_bairro_padronizado", sm.standardized)
        sm.curated = self.store("ref_bairro_padronizado_curado", sm.curated)
        self.store("ref_bairros_para_geocoding", sm.worklist())
        if cand.name:
            sm.draft = self.store("bairro_geocoding_draft", sm.draft)
            validated = sm.validated()
            if validated is not None:
                self.store("bairro_geocoding_validated", validated)
        # what an earlier run approved stays in force: validated over draft over none
        known = T.resolve_source(self.spark, [(f"{self.cfg.target_prefix}.bairro_geocoding_validated", "validated"),
                                              (f"{self.cfg.target_prefix}.bairro_geocoding_draft", "draft")])
        sm.source_mode = known.mode
        sm.geo_dim = self.store("dim_bairro_geografica", SP.geo_dimension(
            mart.dim_bairro, sm.curated, self.spark.table(known.name) if known.name else None, points, known.mode))
        sm.cases_geo = SP.cases_geo(mart.casos_espaciais(), mart.dim_bairro, sm.geo_dim)
        sm.cases_geo.createOrReplaceTempView("vw_casos_espaciais_geo")
        SP.map_counts(sm.cases_geo).createOrReplaceTempView("vw_mapa_casos_bairro")
        SP.mappable_only(SP.map_counts(sm.cases_geo)).createOrReplaceTempView("vw_mapa_casos_bairro_mapeavel")
        SP.quality_counts(sm.cases_geo).createOrReplaceTempView("vw_qualidade_espacial")
        create_views(self.spark, self.cfg.target_prefix, mart)
        self.store("ref_bairro_geocoding_manual_review_queue", SP.non_mappable_by_place(sm.cases_geo))
        Q.raise_on_failure(Q.fatal_spatial_checks(sm.cases_geo))
        return sm

    # ------------------------------------------------------------ stage 4
    def export(self, write, read_target, order=RD.EXPORT_ORDER) -> DataFrame:
        """Ordered load through ``write(name, df)`` (any Spark sink, e.g.
        ``write_jdbc``) and a reconciliation report against what
        ``read_target(name)`` then reads from the target."""
        frames = {n: self.spark.table(f"{self.cfg.target_prefix}.{n}") for n in order}
        T.ordered_load(list(frames.items()), write)
        return T.reconcile(T.count_rows(frames, spark=self.spark),
                           T.count_rows({n: read_target(n) for n in order}, spark=self.spark))

    def run(self) -> SpatialMart:
        inter = self.raw_etl()
        mart = self.model(inter)
        return self.spatial(mart)
