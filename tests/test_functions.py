"""Column functions against the edge tables of FIXTURES.md."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casemart.functions.calendar import month_label, month_ordinal, parse_date
from casemart.functions.geo import candidate_score, is_mappable, spatial_quality, spatial_status
from casemart.functions.text import clean_int, clean_label, match_key, normalize_key, normalize_text


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_int_table(spark):
    vals = ["1.234", " 56 ", "", "-", "1-2", "-3", "12*", "abc", None, "9999999999"]
    assert one_col(spark, vals, clean_int) == [1234, 56, None, None, None, -3, 12, None, None, None]


def test_parse_date(spark):
    vals = ["05/03/2026", " 05/03/2026 ", "5/3/2026", "31/02/2026", "2026-03-05", "", None]
    d = dt.date(2026, 3, 5)
    assert one_col(spark, vals, parse_date) == [d, d, None, None, None, None, None]


def test_month_maps(spark):
    assert one_col(spark, ["MARÇO", "MARCO", "DEZEMBRO", None], month_ordinal) == [3, None, 12, None]
    assert one_col(spark, [1, 3, 13], month_label, "int") == ["JANEIRO", "MARÇO", None]


def test_clean_label_strips_bom(spark):
    assert one_col(spark, ["\ufeffJaneiro", " março ", "TOTAL"], clean_label) == ["JANEIRO", "MARÇO", "TOTAL"]


def test_normalize_profiles(spark):
    assert one_col(spark, ["Jd.  São José", "\tñandu  x "], normalize_text) == ["JD. SAO JOSE", " NANDU X"]
    assert one_col(spark, ["  Jd.  São José ", "Ñandu"], normalize_key) == ["jd. sao jose", "ñandu"]


@pytest.mark.parametrize("raw,key", [
    ("Água Branca I", "agua branca 1"), ("agua branca i", "agua branca 1"), ("Água Branca 1", "agua branca 1"),
    ("jd brasil", "jardim brasil"), ("n.s.apda", "nossa senhora aparecida"),
    ("  Conj. Hab. ", "conjunto habitacional"), ("ARAÃ§ATUBA", "aracatuba"),
    ("Jd. São José III", "jardim sao jose 3"), ("Ibaté IV", "ibate iv"), ("Ñandu", "andu"), ("--", ""),
    (None, None),
])
def test_match_key_examples(spark, raw, key):
    assert one_col(spark, [raw], match_key) == [key]


def test_match_key_idempotent(spark):
    vals = ["Água Branca I", "jd brasil", "n.s.apda", "Conj. Hab.", "Jd. São José III"]
    once = one_col(spark, vals, match_key)
    assert one_col(spark, once, match_key) == once


def test_candidate_score_table(spark):
    rows = [("-21.2", "-50.4", "Centro, Araçatuba, São Paulo", "place", "suburb", 12),
            ("-21.2", "-50.4", "Rua X, Aracatuba", "highway", "residential", 10),
            ("-23.5", "-46.6", "Centro, Sao Paulo", "place", "city", 2),
            ("abc", "-50.4", "any", "any", "any", -1),
            ("-21.35", "-50.65", "", "", "", 5)]
    df = spark.createDataFrame(rows, "lat string, lon string, dn string, c string, t string, expected int")
    got = df.select(candidate_score("lat", "lon", "dn", "c", "t").alias("s"), "expected").collect()
    assert [r.s for r in got] == [r.expected for r in got]


def test_status_cascade_table(spark):
    # canonical id, use, manual lat/lon, lat/lon, inside, score, mode -> status, quality, mappable
    rows = [
        (None, True, None, None, None, None, None, None, "draft", "unresolved_name", "unresolved", False),
        (5, False, 1.0, 1.0, 1.0, 1.0, True, 12, "draft", "not_geocodable_source_name", "unresolved", False),
        (5, True, 1.0, 1.0, 1.0, 1.0, None, None, "missing", "manual_reference_point", "medium", True),
        (5, None, None, None, None, None, None, None, "missing", "missing_coordinates", "unresolved", False),
        (5, True, None, None, 1.0, 1.0, False, 12, "draft", "outside_bbox", "low", False),
        (5, True, None, None, 1.0, 1.0, True, 8, "draft", "low_confidence_geocoding", "low", False),
        (5, True, None, None, 1.0, 1.0, True, 9, "validated", "validated_geocoding", "high", True),
        (5, True, None, None, 1.0, 1.0, None, None, "draft", "draft_geocoding", "medium", True),
        (5, True, None, None, 1.0, 1.0, True, 12, "missing", "geocoded", "unresolved", False),
    ]
    schema = ("cid int, use boolean, mlat double, mlon double, lat double, lon double, inside boolean, "
              "score int, mode string, st string, q string, m boolean")
    df = spark.createDataFrame(rows, schema)
    for mode in ["draft", "validated", "missing"]:
        sub = df.filter(F.col("mode") == mode)
        st = spatial_status(F.col("cid"), F.col("use"), F.col("mlat"), F.col("mlon"), F.col("lat"), F.col("lon"),
                            F.col("inside"), F.col("score"), mode)
        out = sub.withColumn("s", st).withColumn("qq", spatial_quality(F.col("s"))) \
            .withColumn("mm", is_mappable(F.col("lat"), F.col("lon"), F.col("s"))).collect()
        for r in out:
            assert (r.s, r.qq) == (r.st, r.q), r
            # manual coordinates count as the place's coordinates
            if r.st == "manual_reference_point":
                continue
            assert r.mm == r.m, r


def test_cheap_paths_equal_the_patterns(spark):
    """Normalization, integers and dates on texts that pass as they are and on those that do not."""
    from casemart.functions import text as T
    from casemart.functions.calendar import parse_date
    rows = ["", " ", "a", "a b", "a  b", " \t a\tb ", "a\nb", "a\x0b\x0cb\r", "São  José", "ÁGUA\tFRIA", "ñandú", "ß  x", "1.234", "12", "-", "1-2",
            " 7 ", "٣", "妹", "03/04/2020", "2020-04-03", "3/4/2020", "31/02/2020", "03/04", "a/b/c", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    trimmed = F.trim("t")
    digits = F.regexp_replace(trimmed, r"[^0-9-]", "")
    plain = F.upper(F.translate(trimmed, T.UPPER_PROFILE_ACCENTED, T.UPPER_PROFILE_PLAIN))
    key = F.translate(F.lower(trimmed), T.LOWER_PROFILE_ACCENTED, T.LOWER_PROFILE_PLAIN)
    got = df.select("t", T.normalize_text("t"), T.normalize_key("t"), T.clean_int("t"), parse_date("t")).collect()
    want = df.select("t", F.regexp_replace(plain, r"\s+", " "), F.regexp_replace(key, r"\s+", " "),
                     F.when(digits == "", F.lit(None)).otherwise(digits).try_cast("int"), F.try_to_date(trimmed, "dd/MM/yyyy")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_a_case_is_cleaned_once(spark):
    """The filter on places tests the trimmed cell: no cleaning is repeated below it."""
    from casemart.operators import facts as FX
    rows = [("a", "1", "5", " vila \t nova "), ("a", "2", "6", "  "), ("a", "3", "x", None), ("a", "4", "7", "\t"), ("b", "5", "8", "vila")]
    raw = spark.createDataFrame(rows, "lista string, _c0 string, _c1 string, _c2 string")
    out = FX.clean_linelists(raw, "lista", {"a": FX.ListLayout("dengue", age="_c1", sex="_c1", place="_c2")})
    assert sorted((r.idade, r.bairro) for r in out.collect()) == [(5, "VILA NOVA"), (7, " ")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and ("translate" in line or "regexp_replace" in line)]
