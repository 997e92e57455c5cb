"""File positions, counts taken while writing, report levels, partitioned cases, answers that are no JSON."""

import os
import re

import pytest
from pyspark.sql import functions as F

from casemart.operators import geocode as G
from casemart.operators import spatial as SP
from casemart.session import stage_counted
from casemart.sources.tables import read_raw_sheet, with_file_position

from tests.conftest import SF_SMOKE

needs_data = pytest.mark.skipif(not os.path.isdir(SF_SMOKE), reason="driver test data not present")


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


# ---- file position

@pytest.mark.parametrize("split", ["128m", "700", "64"])
def test_position_follows_files_and_splits(spark, tmp_path, split):
    lines = [f"row {i},{'x' * (i % 17)}" for i in range(300)]
    (tmp_path / "a.csv").write_text("\n".join(lines[:180]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(lines[180:]) + "\n")
    (tmp_path / "c.csv").write_text("")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "16")
        sheet = read_raw_sheet(spark, str(tmp_path), 2)
        parts = sheet.select(F.spark_partition_id().alias("p")).distinct().count()
        got = {r.row_id: r._c0 for r in with_file_position(sheet).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i + 1: f"row {i}" for i in range(300)}
    assert parts > 3 or split == "128m"


def test_position_of_an_empty_sheet(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert with_file_position(read_raw_sheet(spark, str(tmp_path), 3), "line").columns == ["_c0", "_c1", "_c2", "line"]
    assert with_file_position(read_raw_sheet(spark, str(tmp_path), 3)).count() == 0


# ---- counts taken while writing

def test_counts_come_from_the_write(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (None, None)], "a int, b int").repartition(3)
    table, seen = stage_counted(df, "test", ("a", "b"))
    assert seen == {"rows": 3, "a_nulls": 1, "b_nulls": 2} and table.count() == 3
    assert stage_counted(df.filter("a > 99"), "test", ("a",))[1] == {"rows": 0, "a_nulls": 0}


@needs_data
def test_audits_do_not_scan_the_facts_again(spark):
    from casemart.plans import queries as Q
    mart = Q._mart(spark, SF_SMOKE)[1]
    for report in (mart.row_preservation(), mart.null_key_audit()):
        assert "FileScan" not in plan_of(report)
    got = {r.label: (r.original, r.final, r.preserved) for r in mart.row_preservation().collect()}
    assert got[mart.dated_source] == (mart.dated.count(), mart.dated_fact.count(), True)
    nulls = {(r.table_name, r.key_column): r.nulls for r in mart.null_key_audit().collect()}
    assert nulls[f"{mart.undated_source}_final", "id_sexo"] == mart.undated_fact.filter("id_sexo IS NULL").count()


# ---- report levels

CASES = [("a", "x", True, "s", "q", 3), ("a", "x", False, "s", "q", 1), ("a", "y", True, "t", "q", 2), ("b", None, None, "t", None, 4)]


def test_levels_equal_the_reports_of_each_level(spark):
    df = spark.createDataFrame(CASES, "fonte string, doenca string, is_mappable boolean, spatial_status string, spatial_quality string, n long")
    got = SP.mappability_levels(df, "n")
    assert sorted(map(tuple, got.filter("level = 'category'").drop("level").collect()), key=str) == \
        sorted(map(tuple, SP.mappability_report(df, "n").collect()), key=str)
    assert {(r.fonte, r.level, r.total_cases, r.mappable_cases, r.mappable_percentage) for r in got.filter("level <> 'category'").collect()} == \
        {(None, "total", 10, 5, 50.0), ("a", "source", 6, 5, 83.33), ("b", "source", 4, 0, 0.0)}
    plan = plan_of(got)
    assert len(re.findall(r"Exchange hashpartitioning", plan.split("== Initial Plan ==")[0])) == 1 and "Expand" in plan
    q = SP.quality_levels(df, "n")
    assert sorted(map(tuple, q.filter("level = 'total'").drop("level", "fonte").collect()), key=str) == sorted(map(tuple, SP.quality_counts(df, weight="n").collect()), key=str)
    assert sorted(map(tuple, q.filter("level = 'source'").drop("level").collect()), key=str) == \
        sorted(map(tuple, SP.quality_counts(df, by_source=True, weight="n").collect()), key=str)
    assert SP.mappability_levels(df.limit(0)).count() == 0


# ---- partitioned cases

@needs_data
def test_a_year_reads_its_folders_alone(spark):
    from casemart.plans import queries as Q
    mart = Q._mart(spark, SF_SMOKE)[1]
    assert mart.stored_cases.count() == mart.casos_espaciais().count()
    one = plan_of(mart.stored_cases.filter("ano = 1994").groupBy("fonte").count())
    assert re.search(r"PartitionFilters: \[isnotnull\(ano#\d+\), \(ano#\d+ = 1994\)\]", one)
    assert "dynamicpruning" in plan_of(mart.cases_of_last_full_year())


# ---- answers

def test_broken_and_listed_answers(spark):
    one = '{"lat": "-21.2", "lon": "-50.4", "display_name": "Centro, Araçatuba, São Paulo", "class": "place", "type": "suburb"}'
    far = one.replace("-21.2", "10.0").replace("Centro, Araçatuba", "Elsewhere")
    raw = spark.createDataFrame([("centro", 1, 1, one[:-3]), ("vila", 1, 1, f"[{far}, {one}]"), ("vila", 2, 1, one), ("lago", 1, 1, "[]"), ("ilha", 1, 1, None),
                                 ("serra", 1, 1, "not json")], "place_key string, query_no int, position long, response string")
    assert {(r.place_key, r.error) for r in G.malformed_answers(raw).collect()} == {("centro", "malformed answer"), ("serra", "malformed answer")}
    parsed = G.parse_candidates(raw)
    assert sorted((r.place_key, r.query_no, r.lat) for r in parsed.collect()) == [("vila", 1, "-21.2"), ("vila", 1, "10.0"), ("vila", 2, "-21.2")]
    places = spark.createDataFrame([(i, k.title(), f"{k}, x", k) for i, k in enumerate(["centro", "vila", "lago", "ilha", "serra"])],
                                   "id_bairro_canonico int, bairro string, query_geocoding string, place_key string")
    draft = G.best_candidates(places, G.query_variants(places), G.score_candidates(parsed), "place_key", errors=G.malformed_answers(raw))
    got = {r.bairro: (r.geocode_status, r.latitude) for r in draft.collect()}
    assert got == {"Centro": ("error: malformed answer", None), "Serra": ("error: malformed answer", None), "Vila": ("found", -21.2),
                   "Lago": ("not_found", None), "Ilha": ("not_found", None)}


# ---- ordered output

def test_files_follow_the_order(spark, tmp_path):
    from casemart.sources.tables import write_ordered
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 3 == 0, "hot").alias("g")).repartition(6)
    order = [F.col("g").desc(), F.col("k")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(df, str(tmp_path / "o"), order)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "o").glob("part-*"))) > 1
    got = [(r.g, r.k) for r in with_file_position(spark.read.parquet(str(tmp_path / "o"))).orderBy("row_id").collect()]
    assert got == [(r.g, r.k) for r in df.orderBy(*order).collect()]
    assert "TakeOrderedAndProject" in plan_of(df.orderBy(*order).limit(20))


# ---- branches that the plain data never reach

@needs_data
def test_every_branch_occurs(spark):
    from casemart.plans.queries import REGISTRY as Q
    seen = {(r.spatial_status, r.spatial_quality) for r in Q["geo_dimension_statuses"](spark, SF_SMOKE).collect()}
    assert {s for s, _ in seen} == {"unresolved_name", "not_geocodable_source_name", "manual_reference_point", "missing_coordinates", "outside_bbox",
                                    "low_confidence_geocoding", "validated_geocoding", "draft_geocoding", "geocoded"}
    assert {q for _, q in seen} == {"high", "medium", "low", "unresolved"}
    done = Q["geocode_corrected_narrow_box"](spark, SF_SMOKE).collect()
    assert {r.geocode_status_final for r in done} >= {"found", "found_outside_bbox"} and {r.geocode_source_final for r in done} == {"manual review", "nominatim_osm"}
    assert Q["rules_duplicated_brands"](spark, SF_SMOKE).count() > 0


def test_sheet_grows_by_files(spark, tmp_path, monkeypatch):
    """No task sorts more than a file's rows, about: the files grow with the rows, whose numbers stay in order."""
    import glob

    from pyspark.sql import functions as F

    from casemart.plans import queries as Q
    from casemart.session import checkpoint_dir
    rows = spark.range(2000).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") * 7 % 50).alias("l_partkey"),
                                    F.lit(3).cast("long").alias("l_suppkey"), F.lit("1996-01-02").cast("timestamp").alias("l_shipdate"),
                                    F.lit("N").alias("l_returnflag"))
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(Q, "SHEET_ROWS", 250)
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/sheet-*"))
    out = Q.sheet_file_position(spark, str(tmp_path)).collect()
    (sheet,) = set(glob.glob(f"{folder}/sheet-*")) - before
    assert len(glob.glob(f"{sheet}/*.csv")) == 8
    assert sorted((r.row_id, r.l_orderkey) for r in out) == [(i + 1, i) for i in range(2000)]
