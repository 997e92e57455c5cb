"""The case-report data mart as one composition of casemart operators.

``CaseMart`` builds the star schema (calendar, category, place and sex
dimensions; measure and event facts; the two union views) from cleaned
series and line lists.  ``SpatialMart`` adds record linkage of place names,
manual curation, geocoder candidate scoring, the geographic dimension, the
map views and the fatal checks.  Inputs are DataFrames, so the same plan
runs on catalog tables (``pipeline.run_from_catalog``) or on anything Spark
can read.

Dimensions and facts are stored and read back (columnar, of known size);
views stay lazy, and the map views and reports aggregate the facts on their
ids before they meet the dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.functions.text import normalize_key
from casemart.operators import curate as C
from casemart.operators import dims as D
from casemart.operators import facts as FX
from casemart.operators import geocode as G
from casemart.operators import match as M
from casemart.operators import quality as Q
from casemart.operators import spatial as SP
from casemart.session import freeze, stage_counted, stage_table

SERIES_KEYS = ("id_tempo", "id_doenca")
DATED_KEYS = ("id_doenca", "id_bairro", "id_sexo", "id_tempo")
UNDATED_KEYS = ("id_doenca", "id_bairro", "id_sexo")


@dataclass
class CaseMart:
    series: Mapping[str, DataFrame]          # fonte -> (ano, mes, ordem_mes, casos, obitos[, doenca])
    dated: DataFrame                         # (data, idade, sexo, bairro, unidade_notificacao, exame, doenca)
    undated: DataFrame                       # (idade, sexo, bairro[, ano_referencia], doenca)
    dated_source: str = "dengue_espacial"
    undated_source: str = "chikungunya_espacial"
    series_defaults: Mapping[str, str] = field(default_factory=dict)   # fonte -> category when absent
    undated_reference_year: int = 2026
    stored_series: dict[str, DataFrame] = field(default_factory=dict)  # fonte -> its stored fact
    input_rows: dict[str, int] = field(default_factory=dict)           # fonte -> rows, where counted as it was written
    written: dict[str, dict[str, int]] = field(default_factory=dict)   # final fact -> counts taken as it was written
    line_lists: DataFrame | None = None      # the stored table of which dated and undated are folders

    # ------------------------------------------------------------ dimensions
    def _series_prepared(self, fonte: str) -> DataFrame:
        return FX.with_normalized(self.series[fonte], ["doenca"]) if "doenca" in self.series[fonte].columns \
            else self.series[fonte].withColumn("doenca", F.lit(self.series_defaults.get(fonte)))

    @cached_property
    def dim_tempo(self) -> DataFrame:
        return D.calendar_dimension(series=[s.select("ano", "mes", "ordem_mes") for s in self.series.values()],
                                    dated=[(self.dated, "data")])

    @cached_property
    def categories(self) -> dict[str, DataFrame]:
        """Category, place and sex dimension, from one scan of every source."""
        people = ["doenca", "bairro", "sexo"]
        sources = [(self._series_prepared(f), ["doenca"], None) for f in self.series]
        lists = [self.dated, self.undated] if self.line_lists is None else [self.line_lists]
        ids = {"doenca": "id_doenca", "bairro": "id_bairro", "sexo": "id_sexo"}
        return D.build_dimensions(sources + [(df, people, normalize_key) for df in lists], ids)

    @cached_property
    def dim_doenca(self) -> DataFrame:
        return self.categories["doenca"]

    @cached_property
    def dim_bairro(self) -> DataFrame:
        return self.categories["bairro"]

    @cached_property
    def dim_sexo(self) -> DataFrame:
        return self.categories["sexo"]

    # ----------------------------------------------------------------- facts
    def _store(self, name: str, fact: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        """Stored fact; its rows and null keys are counted by the write itself."""
        table, self.written[name] = stage_counted(fact, name, keys)
        return table

    def series_fact(self, fonte: str) -> DataFrame:
        if fonte not in self.stored_series:
            self.stored_series[fonte] = self._store(f"{fonte}_final", self._series_fact(fonte), SERIES_KEYS)
        return self.stored_series[fonte]

    def _series_fact(self, fonte: str) -> DataFrame:
        return FX.resolve_keys(self._series_prepared(fonte),
                               [FX.DimRef(self.dim_tempo, ["ano", "mes", "ordem_mes"]),
                                FX.DimRef(self.dim_doenca, ["doenca"])],
                               ["id_tempo", "id_doenca", "casos", "obitos"])

    @cached_property
    def dated_fact(self) -> DataFrame:
        base = self.dated
        if "unidade_notificacao" not in base.columns:
            base = base.withColumn("unidade_notificacao", F.lit(None).cast("string"))
        base = FX.with_calendar_keys(FX.with_normalized(base, ["doenca", "bairro", "sexo"]), "data")
        return self._store(f"{self.dated_source}_final", FX.resolve_keys(
            base, [FX.DimRef(self.dim_doenca, ["doenca"]), FX.DimRef(self.dim_bairro, ["bairro"]),
                   FX.DimRef(self.dim_sexo, ["sexo"]), FX.DimRef(self.dim_tempo, ["ano", "mes", "ordem_mes"])],
            ["id_doenca", "id_bairro", "id_sexo", "id_tempo", "data", "idade", "unidade_notificacao"]), DATED_KEYS)

    @cached_property
    def undated_fact(self) -> DataFrame:
        base = self.undated
        if "ano_referencia" not in base.columns:
            base = base.withColumn("ano_referencia", F.lit(self.undated_reference_year))
        base = FX.with_normalized(base, ["doenca", "bairro", "sexo"])
        return self._store(f"{self.undated_source}_final", FX.resolve_keys(
            base, [FX.DimRef(self.dim_doenca, ["doenca"]), FX.DimRef(self.dim_bairro, ["bairro"]),
                   FX.DimRef(self.dim_sexo, ["sexo"])],
            ["id_doenca", "id_bairro", "id_sexo", "ano_referencia", "idade"]), UNDATED_KEYS)

    def case_groups(self) -> DataFrame:
        """Cases per source, category, place and month (or year), counted on the
        stored facts' ids; only the groups meet the dimensions.  Groups are
        bounded by places and months, however many cases there are."""
        ids = ["id_doenca", "id_bairro"]
        dated = (self.dated_fact.groupBy(*ids, "id_tempo").agg(F.count(F.lit(1)).alias("casos"))
                 .join(self.dim_tempo, "id_tempo", "left")
                 .select(F.lit(self.dated_source).alias("fonte"), *ids, "ano", "mes", "ordem_mes", "ano_mes", "casos"))
        undated = (self.undated_fact.groupBy(*ids, "ano_referencia").agg(F.count(F.lit(1)).alias("casos"))
                   .select(F.lit(self.undated_source).alias("fonte"), *ids, F.col("ano_referencia").alias("ano"),
                           F.lit(None).cast("string").alias("mes"), F.lit(None).cast("int").alias("ordem_mes"),
                           F.lit(None).cast("string").alias("ano_mes"), "casos"))
        return (dated.unionByName(undated).join(self.dim_doenca, "id_doenca", "left")
                .join(self.dim_bairro, "id_bairro", "left").drop("id_doenca"))

    # ----------------------------------------------------------------- views
    def serie_temporal(self) -> DataFrame:
        """UNION ALL of every measure fact denormalized through calendar and
        category, tagged with its source."""
        t = self.dim_tempo
        d = self.dim_doenca
        parts = [self.series_fact(f).join(t, "id_tempo", "left").join(d, "id_doenca", "left")
                 .select(F.lit(f).alias("fonte"), "ano", "mes", "ordem_mes", "ano_mes", "doenca", "casos", "obitos")
                 for f in self.series]
        return reduce(DataFrame.unionByName, parts)

    def casos_espaciais(self, labels: tuple[str, str] | None = None, keep_ids: bool = False,
                        undated_year_month_text: bool = False) -> DataFrame:
        """Dated and undated cases with their dimension names; the undated
        branch gets typed NULLs for the calendar columns and ``ano =
        ano_referencia``.  ``labels``/``keep_ids``/``undated_year_month_text``
        give the serving variant."""
        d, b, s, t = (x for x in (self.dim_doenca, self.dim_bairro, self.dim_sexo, self.dim_tempo))
        dated_label, undated_label = labels or (self.dated_source, self.undated_source)
        ids = ["id_doenca", "id_bairro", "id_sexo", "id_tempo"] if keep_ids else []
        dated = (self.dated_fact.join(d, "id_doenca", "left").join(b, "id_bairro", "left")
                 .join(s, "id_sexo", "left").join(t, "id_tempo", "left")
                 .select(F.lit(dated_label).alias("fonte"), "doenca", "bairro", "sexo", "ano", "mes", "ordem_mes",
                         "ano_mes", "data", "idade", "unidade_notificacao", *ids))
        ano_mes = (F.col("ano_referencia").cast("string") if undated_year_month_text
                   else F.lit(None).cast("string"))
        undated_ids = ["id_doenca", "id_bairro", "id_sexo", F.lit(None).cast("int").alias("id_tempo")] \
            if keep_ids else []
        undated = (self.undated_fact.join(d, "id_doenca", "left").join(b, "id_bairro", "left")
                   .join(s, "id_sexo", "left")
                   .select(F.lit(undated_label).alias("fonte"), "doenca", "bairro", "sexo",
                           F.col("ano_referencia").alias("ano"), F.lit(None).cast("string").alias("mes"),
                           F.lit(None).cast("int").alias("ordem_mes"), ano_mes.alias("ano_mes"),
                           F.lit(None).cast("date").alias("data"), "idade",
                           F.lit(None).cast("string").alias("unidade_notificacao"), *undated_ids))
        return dated.unionByName(undated)

    # ----------------------------------------------------------------- audits
    def _finals(self) -> dict[str, tuple[str, DataFrame, tuple[str, ...]]]:
        """final fact -> (fonte, table, keys); reading the tables builds them."""
        out = {f"{f}_final": (f, self.series_fact(f), SERIES_KEYS) for f in self.series}
        out[f"{self.dated_source}_final"] = (self.dated_source, self.dated_fact, DATED_KEYS)
        out[f"{self.undated_source}_final"] = (self.undated_source, self.undated_fact, UNDATED_KEYS)
        return out

    def null_key_audit(self) -> DataFrame:
        """Null keys per final fact, as counted by its write; a fact that came
        from elsewhere is scanned."""
        finals = self._finals()
        known = [(name, k, self.written[name][f"{k}_nulls"]) for name, (_, _, keys) in finals.items() if name in self.written for k in keys]
        out = self.dim_doenca.sparkSession.createDataFrame(known, "table_name string, key_column string, nulls bigint")
        other = {name: (df, keys) for name, (_, df, keys) in finals.items() if name not in self.written}
        return out.unionByName(Q.null_key_audit(other)) if other else out

    def row_preservation(self) -> DataFrame:
        """Rows before and after key resolution, as counted by the writes; what
        came from elsewhere is scanned."""
        before = {**self.series, self.dated_source: self.dated, self.undated_source: self.undated}
        finals = {fonte: (name, df) for name, (fonte, df, _) in self._finals().items()}
        whole = [f for f in before if f in self.input_rows and finals[f][0] in self.written]
        rows = [(f, self.input_rows[f], n := self.written[finals[f][0]]["rows"], self.input_rows[f] == n) for f in whole]
        out = self.dim_doenca.sparkSession.createDataFrame(rows, "label string, original bigint, final bigint, preserved boolean")
        other = {f: (df, finals[f][1]) for f, df in before.items() if f not in whole}
        return out.unionByName(Q.row_preservation(other)) if other else out

    # ------------------------------------------------------- partitioned cases
    @cached_property
    def stored_cases(self) -> DataFrame:
        """``casos_espaciais`` as a table in folders by source and year, so that a
        report on some years reads those alone.  Rebalanced by folder, a hot
        source or year gets as many files as its size asks for."""
        cases = self.casos_espaciais().hint("rebalance", "fonte", "ano")
        return stage_table(cases, "cases-by-year", partition_by=("fonte", "ano"))

    def last_full_year(self) -> DataFrame:
        """``ano``: the last year with all twelve months in the calendar."""
        months = self.dim_tempo.groupBy("ano").agg(F.countDistinct("ordem_mes").alias("n"))
        return months.filter("n = 12").agg(F.max("ano").alias("ano"))

    def cases_of_last_full_year(self) -> DataFrame:
        """Cases per source, category, place and month of that year; the year is
        known at run time only, and prunes the folders then."""
        return (self.stored_cases.join(F.broadcast(self.last_full_year()), "ano")       # one row
                .groupBy("fonte", "ano", "doenca", "bairro", "mes").agg(F.count(F.lit(1)).alias("casos")))


@dataclass
class SpatialMart:
    mart: CaseMart
    canonical: DataFrame             # id_bairro_canonico, bairro_canonico, query_geocoding, ...
    aliases: DataFrame               # alias_norm_observado, bairro_canonico_sugerido
    rules: DataFrame                 # manual standardization rules
    candidates: DataFrame            # place_key, query_no, position, response (JSON)
    manual_points: DataFrame | None = None
    corrections: DataFrame | None = None
    lookup_errors: DataFrame | None = None   # place_key, error
    approve_geocoding: bool = False
    match: M.MatchConfig = field(default_factory=M.MatchConfig)
    source_mode: str = "draft"

    @cached_property
    def sources(self) -> DataFrame:
        return self.mart.dim_bairro.select("id_bairro", F.col("bairro").alias("bairro_original"))

    @cached_property
    def resolved(self) -> tuple[DataFrame, DataFrame]:
        return M.resolve_names(self.sources, self.canonical, self.aliases, self.match)

    @cached_property
    def standardized(self) -> DataFrame:
        return freeze(M.consolidate(*self.resolved))

    def fuzzy_scores(self) -> DataFrame:
        return self.resolved[1]

    @cached_property
    def curated(self) -> DataFrame:
        return freeze(C.overlay_standardization(self.standardized, self.rules))

    def worklist(self) -> DataFrame:
        return M.worklist(self.curated, require_geocodable=True)

    def places(self) -> DataFrame:
        return self.worklist().select("id_bairro_canonico", F.col("bairro_canonico").alias("bairro"),
                                      "query_geocoding", F.lower(F.col("bairro_canonico")).alias("place_key"))

    @cached_property
    def draft(self) -> DataFrame:
        places = self.places()
        variants = G.query_variants(places)
        scored = G.score_candidates(G.parse_candidates(self.candidates))
        errors = G.malformed_answers(self.candidates)
        if self.lookup_errors is not None:
            errors = errors.unionByName(self.lookup_errors.select("place_key", "error"))
        return freeze(G.best_candidates(places, variants, scored, "place_key",
                                        created_at=F.lit(None).cast("string"), errors=errors))

    def corrected(self) -> DataFrame:
        corr = self.corrections if self.corrections is not None else self.draft.sparkSession.createDataFrame(
            [], "bairro string, manual_latitude double, manual_longitude double, manual_source string")
        return G.apply_corrections(self.draft, corr)

    def validated(self) -> DataFrame | None:
        return G.publish_validated(self.corrected(), self.approve_geocoding)

    @cached_property
    def geo_dim(self) -> DataFrame:
        geo = self.draft
        mode = self.source_mode
        if self.approve_geocoding:
            geo, mode = self.validated(), "validated"
        return freeze(SP.geo_dimension(self.mart.dim_bairro, self.curated, geo, self.manual_points, mode))

    @cached_property
    def cases_geo(self) -> DataFrame:
        """Cases with the geographic dimension, joined by the place id that the facts hold."""
        cases = self.mart.casos_espaciais(keep_ids=True)
        out = SP.cases_geo(cases, self.mart.dim_bairro, self.geo_dim, by="id")
        held = [c for c in cases.columns if c not in ("id_doenca", "id_bairro", "id_sexo", "id_tempo")]
        return out.select(*held, "id_bairro", *[c for c in out.columns if c not in cases.columns])

    @cached_property
    def groups_geo(self) -> DataFrame:
        """``case_groups`` with the geographic dimension; ``casos`` weighs each row."""
        return SP.cases_geo(self.mart.case_groups(), self.mart.dim_bairro, self.geo_dim, by="id")

    def map_counts(self) -> DataFrame:
        return SP.map_counts(self.groups_geo, weight="casos")
