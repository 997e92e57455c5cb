"""End to end: synthetic raw sheets and line lists -> star schema -> map views."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from casemart.plans.pipeline import Pipeline, PipelineConfig


def _wide(n_cols, rows):
    out = []
    for r in rows:
        cells = [None] * n_cols
        for k, v in r.items():
            cells[k] = v
        out.append(tuple(cells))
    return out


def _schema(n):
    return ", ".join(f"_c{i} string" for i in range(n))


def _setup(spark, db):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    # covid: 2020 at (_c1,_c2), 2026 at (_c13,_c14)
    covid = _wide(15, [{0: "\ufeffJaneiro", 1: "1.234", 2: "", 13: "56", 14: "2"},
                       {0: " março ", 1: "0", 2: "0"}, {0: "TOTAL", 1: "1.234"}])
    spark.createDataFrame(covid, _schema(15)).write.saveAsTable(f"{db}.raw_covid")
    scorpion = _wide(25, [{0: "JANEIRO", 2: "3", 3: "0", 23: "", 24: ""}])
    spark.createDataFrame(scorpion, _schema(25)).write.saveAsTable(f"{db}.raw_escorpiao")
    arb_rows = [{0: "header"}] * 4 + [{0: "JANEIRO", 1: "10", 12: "5", 13: "1"}] + [{0: "x"}] * 20 + \
        [{0: "JANEIRO", 1: "7", 2: "1"}] + [{0: "y"}] * 18 + [{0: "FEVEREIRO", 31: "4", 32: ""}]
    spark.createDataFrame(_wide(60, arb_rows), _schema(60)).coalesce(1).write.saveAsTable(f"{db}.raw_arboviroses")
    dengue = [("1", "05/03/2026", "34", "Feminino", "Jd.  São José", " UBS 1 ", "Positivo"),
              (" 2 ", "", "x", "", "Centro", None, None),
              ("N", "a", "b", "c", "d", "e", "f"),
              ("3", "05/03/2026", "1", "M", " ", None, None),
              ("4", "06/03/2026", "50", "Masculino", "Vl Nova", "UBS 2", "Positivo")]
    spark.createDataFrame(dengue, _schema(7)).write.saveAsTable(f"{db}.raw_dengue_espacial")
    chik = [("1", "20", "Feminino", "Centro"), ("2", "30", "Feminino", "vila")]
    spark.createDataFrame(chik, _schema(4)).write.saveAsTable(f"{db}.raw_chikungunya_espacial")
    canon = [(1, "Centro", "centro", "Araçatuba", "SP", "Brasil", "bairro", True, "Centro, Araçatuba", None, None,
              None),
             (2, "Jardim São José", "jardim sao jose", "Araçatuba", "SP", "Brasil", "bairro", True, None, None, None,
              None),
             (3, "Vila Nova", "vila nova", "Araçatuba", "SP", "Brasil", "bairro", True, "Vila Nova, Araçatuba", None,
              None, None)]
    spark.createDataFrame(canon, "id_bairro_canonico int, bairro_canonico string, bairro_canonico_norm string, "
                                 "municipio string, uf string, pais string, tipo_localidade string, "
                                 "use_for_geocoding boolean, query_geocoding string, source_primary_url string, "
                                 "source_secondary_url string, observacao string") \
        .write.saveAsTable(f"{db}.canonical_neighborhoods")
    spark.createDataFrame([("vl nova", "Vila Nova", None)],
                          "alias_norm_observado string, bairro_canonico_sugerido string, observacao string") \
        .write.saveAsTable(f"{db}.alias_seed_rules")
    resp = json.dumps({"lat": "-21.2", "lon": "-50.43", "display_name": "Centro, Araçatuba, São Paulo",
                       "class": "place", "type": "suburb", "osm_id": "1"})
    spark.createDataFrame([("centro", 1, 1, resp)], "place_key string, query_no int, position long, response string") \
        .write.saveAsTable(f"{db}.bairro_geocoding_candidates")


def test_pipeline_end_to_end(spark):
    db = "cm_e2e"
    _setup(spark, db)
    p = Pipeline(spark, PipelineConfig(source_prefix=db, target_prefix=db, fail_on_validation=False))
    sm = p.run()
    covid = {(r.ano, r.mes): (r.casos, r.obitos) for r in spark.table(f"{db}.fato_covid").collect()}
    assert covid == {(2020, "JANEIRO"): (1234, 0), (2020, "MARÇO"): (0, 0), (2026, "JANEIRO"): (56, 2)}
    arb = {(r.doenca, r.ano, r.mes): (r.casos, r.obitos) for r in spark.table(f"{db}.fato_arboviroses").collect()}
    assert arb == {("dengue", 1998, "JANEIRO"): (10, 0), ("dengue", 2009, "JANEIRO"): (5, 1),
                   ("zika", 2016, "JANEIRO"): (7, 1), ("chikungunya", 2026, "FEVEREIRO"): (4, 0)}
    assert spark.table(f"{db}.fato_escorpiao").count() == 1
    assert spark.table(f"{db}.fato_dengue_espacial").count() == 3
    # dims dense and ordered
    bairros = [r.bairro for r in spark.table(f"{db}.dim_bairro").orderBy("id_bairro").collect()]
    assert bairros == sorted(bairros) and "jd. sao jose" in bairros
    std = {r.bairro_original: r for r in spark.table(f"{db}.ref_bairro_padronizado_curado").collect()}
    assert std["jd. sao jose"].match_method == "exact"
    assert std["vl nova"].match_method == "alias"
    assert std["vila"].match_method == "manual_unresolved_generic" and not std["vila"].use_for_geocoding
    geo = {r.bairro_original_dim: r for r in spark.table(f"{db}.dim_bairro_geografica").collect()}
    assert geo["centro"].spatial_status == "draft_geocoding" and geo["centro"].is_mappable
    assert geo["vila"].spatial_status == "not_geocodable_source_name"
    q = {r.spatial_status: r.registros for r in spark.table("vw_qualidade_espacial").collect()}
    assert sum(q.values()) == 5
    root = tempfile.mkdtemp(prefix="casemart-export-")

    def read(name):
        return spark.read.parquet(os.path.join(root, name))

    recon = p.export(lambda name, df: df.write.mode("overwrite").parquet(os.path.join(root, name)), read)
    assert recon.count() > 0 and recon.filter(~F.col("matches")).count() == 0
    # a writer that loses rows is noticed
    recon = p.export(lambda name, df: df.limit(1).write.mode("overwrite").parquet(os.path.join(root, name)), read)
    assert recon.filter(~F.col("matches")).count() > 0


def test_an_approved_geocoding_stays_in_force(spark):
    """Errors and corrections reach the draft; a run with the flag off keeps what an earlier run validated."""
    db = "cm_keep"
    _setup(spark, db)
    spark.createDataFrame([("vila nova", "read timed out")], "place_key string, error string").write.saveAsTable(f"{db}.bairro_geocoding_errors")
    spark.createDataFrame([("Centro", -21.3, -50.5, "review")], "bairro string, manual_latitude double, manual_longitude double, manual_source string") \
        .write.saveAsTable(f"{db}.bairro_geocoding_corrections")

    def run(approve):
        Pipeline(spark, PipelineConfig(source_prefix=db, target_prefix=db, fail_on_validation=False, approve_geocoding=approve)).run()
        return {r.bairro_original_dim: r for r in spark.table(f"{db}.dim_bairro_geografica").collect()}

    assert run(False)["centro"].spatial_status == "draft_geocoding"
    draft = {r.bairro: r.geocode_status for r in spark.table(f"{db}.bairro_geocoding_draft").collect()}
    assert draft["Vila Nova"] == "error: read timed out"
    first, later = run(True)["centro"], run(False)["centro"]
    assert (first.spatial_status, first.latitude) == (later.spatial_status, later.latitude) == ("validated_geocoding", -21.3)


def test_views_live_in_the_catalog(spark):
    """Another session over the same catalog reads the rows of the plans."""
    db = "cm_views"
    _setup(spark, db)
    spark.sql(f"USE {db}")
    try:
        sm = Pipeline(spark, PipelineConfig(source_prefix=db, target_prefix=db, fail_on_validation=False)).run()
    finally:
        spark.sql("USE default")
    other = spark.newSession()
    plans = {"vw_serie_temporal": sm.mart.serie_temporal(), "vw_casos_espaciais": sm.mart.casos_espaciais(), "vw_casos_espaciais_geo": sm.cases_geo,
             "vw_mapa_casos_bairro": spark.table("vw_mapa_casos_bairro"), "vw_mapa_casos_bairro_mapeavel": spark.table("vw_mapa_casos_bairro_mapeavel"),
             "vw_qualidade_espacial": spark.table("vw_qualidade_espacial")}
    for name, plan in plans.items():
        view = other.table(f"{db}.{name}")
        assert view.dtypes == plan.dtypes, name
        assert sorted(map(str, view.collect())) == sorted(map(str, plan.collect())) != [], name
    assert "id_tempo" in other.table(f"{db}.vw_casos_espaciais_serving").columns
    assert other.table(f"{db}.vw_mapa_serving").count() == plans["vw_mapa_casos_bairro_mapeavel"].count()
    assert {"ref_bairros_canonicos", "ref_bairros_alias"} <= {t.name for t in other.catalog.listTables(db)}


def test_a_failed_write_leaves_the_old_table(spark):
    import pytest

    from casemart.sources.tables import replace_table
    spark.sql("CREATE DATABASE IF NOT EXISTS cm_safe")
    rows = spark.range(10).withColumn("v", F.lit("old"))
    replace_table(rows, "cm_safe.t")
    bad = spark.range(100).repartition(4).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("boom"))).otherwise("new").alias("v"))
    with pytest.raises(Exception, match="boom"):
        replace_table(bad, "cm_safe.t")
    assert {(r.v, r.n) for r in spark.table("cm_safe.t").groupBy("v").agg(F.count("*").alias("n")).collect()} == {("old", 10)}
    replace_table(spark.table("cm_safe.t").withColumn("v", F.lit("new")), "cm_safe.t")           # it may read what it replaces
    assert {r.v for r in spark.table("cm_safe.t").collect()} == {"new"}
    replace_table(spark.range(3), "cm_safe.t")                                                  # other columns
    assert spark.table("cm_safe.t").columns == ["id"] and spark.table("cm_safe.t").count() == 3
