"""DataFrame operators on small literal frames."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from casemart.operators import curate as C
from casemart.operators import dims as D
from casemart.operators import geocode as G
from casemart.operators import match as M
from casemart.operators import quality as Q
from casemart.operators import reshape as R
from casemart.operators.match import MatchConfig, segment_plan


# ----------------------------------------------------------------- dims

def test_dense_ids_equal_global_row_number(spark):
    rnd = random.Random(7)
    keys = [f"k{rnd.randrange(5000):05d}" for _ in range(3000)] + ["", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    got = {r.k: r.id for r in D.dense_ids(df, "k", "id", num_buckets=4).collect()}
    expect = {r.k: r.id for r in
              df.filter("k IS NOT NULL AND k <> ''").distinct()
              .select("k", F.row_number().over(Window.orderBy("k")).alias("id")).collect()}
    assert got == expect


def test_dense_ids_plan_has_no_single_partition_exchange(spark):
    df = spark.range(1000).select(F.format_string("n%04d", "id").alias("k"))
    plan = D.dense_ids(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_calendar_dimension(spark):
    s = spark.createDataFrame([(2024, "MARÇO", 3)], "ano int, mes string, ordem_mes int")
    d = spark.createDataFrame([("2025-01-31",), (None,)], "d string").select(F.to_date("d").alias("d"))
    rows = sorted(tuple(r) for r in D.calendar_dimension([s], [(d, "d")]).collect())
    assert rows == [(202403, 2024, "MARÇO", 3, "2024-03"), (202501, 2025, "JANEIRO", 1, "2025-01")]


def test_dedupe_by_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "z", 1)], "k int, x string, y int")
    assert sorted(tuple(r) for r in D.dedupe_by_key(df, ["k"]).collect()) == [(1, "a", 9), (2, "z", 1)]


# -------------------------------------------------------------- reshape

def test_sheet_to_series(spark):
    rows = [("\ufeffJaneiro", "1.234", "", "56", "2"), (" março ", "0", "0", "", ""),
            ("MARCO", "9", "9", "9", "9"), ("TOTAL", "1.234", "0", "56", "2")]
    df = spark.createDataFrame(rows, "_c0 string, _c1 string, _c2 string, _c3 string, _c4 string")
    layout = {2020: {"casos": "_c1", "obitos": "_c2"}, 2026: {"casos": "_c3", "obitos": "_c4"}}
    got = sorted(tuple(r) for r in R.series_from_sheet(df, "_c0", layout, "covid").collect())
    assert got == [(2020, "JANEIRO", 1, 1234, 0, "covid"), (2020, "MARÇO", 3, 0, 0, "covid"),
                   (2026, "JANEIRO", 1, 56, 2, "covid")]


def test_stacked_blocks_with_absent_measure(spark):
    rows = [(1, "JANEIRO", "5", "1"), (2, "FEVEREIRO", "6", "2"), (3, "TOTAL", "11", "3"),
            (5, "JANEIRO", "7", "x"), (9, "JANEIRO", "8", "8")]
    df = spark.createDataFrame(rows, "row_id int, _c0 string, _c1 string, _c2 string")
    blocks = [("a", 1, 3, {2020: {"casos": "_c1", "obitos": "_c2"}}),
              ("b", 4, 6, {2021: {"casos": "_c1", "obitos": None}})]
    got = sorted(tuple(r) for r in R.series_from_stacked_sheet(df, "row_id", "_c0", blocks).collect())
    assert got == [(2020, "FEVEREIRO", 2, 6, 2, "a"), (2020, "JANEIRO", 1, 5, 1, "a"),
                   (2021, "JANEIRO", 1, 7, 0, "b")]


# ---------------------------------------------------------------- match

def _canon(spark, names):
    return spark.createDataFrame([(i + 1, n, f"q {n}") for i, n in enumerate(names)],
                                 "id_bairro_canonico int, bairro_canonico string, query_geocoding string")


def _std(spark, sources, names, aliases=()):
    src = spark.createDataFrame(list(enumerate(sources, 1)), "id_bairro int, bairro_original string")
    ali = spark.createDataFrame(list(aliases) or [("zzz", "none")],
                                "alias_norm_observado string, bairro_canonico_sugerido string")
    return {r.bairro_original: r for r in M.standardize(src, _canon(spark, names), ali).collect()}


def test_fuzzy_acceptance_examples(spark):
    r = _std(spark, ["jardim planlto"], ["jardim planalto", "jardim paulista"])["jardim planlto"]
    assert r.match_method == "fuzzy" and abs(r.similarity - 14 / 15) < 1e-12
    r = _std(spark, ["vila santo"], ["vila santa", "vila sante"])["vila santo"]
    assert r.match_method == "unmatched" and r.similarity_gap == 0.0 and r.needs_review
    r = _std(spark, ["jardim nova york"], ["jardim nova iorque"])["jardim nova york"]
    assert r.match_method == "unmatched"
    r = _std(spark, ["vila santo"], ["vila santa"])["vila santo"]
    assert r.match_method == "fuzzy" and r.second_similarity is None and abs(r.similarity_gap - 0.9) < 1e-12


def test_alias_to_non_canonical_falls_through(spark):
    out = _std(spark, ["centro velho", "vl nova"], ["vila nova"], aliases=[("centro velho", "Centro Antigo")])
    assert out["centro velho"].match_method == "unmatched"
    assert out["vl nova"].match_method == "exact"


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="abc ", min_size=1, max_size=12), min_size=1, max_size=12),
       st.lists(st.text(alphabet="abc ", min_size=1, max_size=12), min_size=1, max_size=12, unique=True))
def test_blocked_candidates_equal_brute_force(spark, us, cs):
    cfg = MatchConfig()
    floor = cfg.candidate_floor
    cs = [c for c in cs if c]
    u = spark.createDataFrame(list(enumerate(us, 1)), "id_bairro int, bairro_original_key string")
    c = spark.createDataFrame([(c, c, i, None) for i, c in enumerate(cs, 1)],
                              "bairro_canonico_key string, bairro_canonico string, id_bairro_canonico int, "
                              "query_geocoding string")
    got = {(r.id_bairro, r.bairro_canonico_key) for r in M.fuzzy_candidates(u, c, cfg).collect()}
    want = set()
    for i, a in enumerate(us, 1):
        for b in cs:
            m = max(len(a), len(b))
            sim = 1 - _lev(a, b) / m if m else 0.0
            if sim >= floor:
                want.add((i, b))
    assert got == want


def test_segment_plan_segments_cover_key(spark):
    whole = {}
    for la, lc, k, cut, seg, st_, ln in segment_plan(20, 0.8):
        assert ln >= 1 and seg < cut and cut > k
        whole.setdefault((la, lc, cut), []).append((st_, ln))
    for (_, lc, _), parts in whole.items():
        assert [x for st_, ln in sorted(parts) for x in range(st_, st_ + ln)] == list(range(lc))
    for floor in (0.7, 0.8):
        assert sorted(map(tuple, M.segment_plan_frame(spark, 20, floor).collect())) == sorted(segment_plan(20, floor))


# ---------------------------------------------------------------- curate

def test_overlay_rules(spark):
    base = spark.createDataFrame(
        [(1, "a", "k1", 10, "A", "qa", "exact", None, None, None, None, False),
         (2, "b", "k2", None, None, None, "unmatched", None, None, None, None, True),
         (3, "c", "k3", None, None, None, "unmatched", None, None, None, None, True)],
        "id_bairro int, bairro_original string, bairro_original_key string, id_bairro_canonico int, "
        "bairro_padronizado string, query_geocoding string, match_method string, similarity double, "
        "second_best_match string, second_similarity double, similarity_gap double, needs_review boolean")
    rules = spark.createDataFrame(
        [("k1", 99, "Z", None, "manual_new_canonical", True, "n1"),
         ("k2", 98, "G", None, "manual_unresolved_generic", False, "n2"),
         ("kx", 97, "X", "qx", "manual_new_canonical", True, "dead")],
        "bairro_original_key string, manual_id_bairro_canonico int, manual_bairro_padronizado string, "
        "manual_query_geocoding string, manual_match_method string, manual_use_for_geocoding boolean, "
        "curation_note string")
    out = {r.id_bairro: r for r in C.overlay_standardization(base, rules).collect()}
    assert (out[1].id_bairro_canonico, out[1].query_geocoding, out[1].needs_review) == (99, "qa", False)
    assert (out[2].needs_review, out[2].use_for_geocoding) == (True, False)
    assert (out[3].needs_review, out[3].use_for_geocoding, out[3].match_method) == (True, True, "unmatched")
    assert [r.bairro_original_key for r in C.dead_rules(rules, base, "bairro_original_key").collect()] == ["kx"]
    assert C.duplicated_rule_keys(rules.unionByName(rules.limit(1)), "bairro_original_key").count() == 1


# --------------------------------------------------------------- geocode

def test_best_candidate_stable_tie_break_and_not_found(spark):
    places = spark.createDataFrame([(1, "Centro", "Centro, X", "centro"), (2, "Nada", None, "nada")],
                                   "id_bairro_canonico int, bairro string, query_geocoding string, place_key string")
    variants = G.query_variants(places)
    cands = spark.createDataFrame(
        [("centro", 1, 2, "-21.2", "-50.4", "Centro, Araçatuba", "place", "suburb", "a"),
         ("centro", 2, 1, "-21.2", "-50.4", "Centro, Araçatuba", "place", "suburb", "b"),
         ("centro", 1, 1, "-21.2", "-50.4", "Centro, Araçatuba", "place", "suburb", "c"),
         ("centro", 4, 1, "-23.0", "-46.0", "far", "x", "y", "d")],
        "place_key string, query_no int, position int, lat string, lon string, display_name string, "
        "osm_class string, osm_type string, osm_id string")
    out = {r.id_bairro_canonico: r for r in
           G.best_candidates(places, variants, G.score_candidates(cands), "place_key").collect()}
    assert out[1].osm_id == "c" and out[1].geocode_status == "found" and out[1].candidate_score == 11
    assert out[1].query_used == "Centro, Araçatuba, SP, Brazil"
    assert out[2].geocode_status == "not_found" and out[2].candidate_score == 0 and not out[2].is_inside_bbox


# --------------------------------------------------------------- quality

def test_fatal_checks_and_preservation(spark):
    df = spark.createDataFrame([(1, "ok", 1.0, 1.0), (None, None, None, 1.0)],
                               "id_bairro int, spatial_status string, latitude_plot double, longitude_plot double")
    r = Q.fatal_spatial_checks(df).first()
    assert r.rows_without_neighborhood_id == 1 and "null spatial_status" in r.fatal_errors
    a = spark.range(3)
    p = {r.label: r.preserved for r in Q.row_preservation({"x": (a, a), "y": (a, a.limit(1))}).collect()}
    assert p == {"x": True, "y": False}


def test_hot_key_holding_a_third_of_rows(spark):
    """One place holds a third of all cases.  The dimension is built from
    distinct keys, the fact join keeps every row on both the broadcast and
    the shuffle-join path (by threshold), and the per-place count is partially aggregated
    before its shuffle (the hot key is combined map-side)."""
    from collections import Counter

    from casemart.operators import facts as FX
    rows = [(i, "centro" if i % 3 == 0 else f"bairro {i % 97}") for i in range(30000)]
    fact = spark.createDataFrame(rows, "case_id long, bairro string")
    dim = D.build_dimension([fact], "bairro", "id_bairro")
    expected = dict(Counter(b for _, b in rows))
    for bound in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        resolved = FX.resolve_keys(fact, [FX.DimRef(dim, ["bairro"])], ["case_id", "bairro", "id_bairro"])
        counts = resolved.groupBy("bairro", "id_bairro").agg(F.count(F.lit(1)).alias("n"))
        got = {r.bairro: r.n for r in counts.collect()}
        assert got == expected
        assert resolved.filter(F.col("id_bairro").isNull()).count() == 0
        assert "partial_count" in counts._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab c", min_size=1, max_size=40), min_size=1, max_size=14),
       st.lists(st.text(alphabet="ab c", min_size=1, max_size=40), min_size=1, max_size=14, unique=True),
       st.integers(min_value=0, max_value=13))
def test_long_key_prefix_filter_equals_brute_force(spark, us, cs, mutate):
    """Keys beyond a small segment plan go through the q-gram prefix filter
    (and the length band for keys too short for it): same pairs as brute
    force."""
    cfg = MatchConfig(max_segment_len=6)
    floor = cfg.candidate_floor
    # near copies so that pairs above the floor exist
    us = us + [c[:mutate] + "b" + c[mutate + 1:] for c in cs[:4]]
    u = spark.createDataFrame(list(enumerate(us, 1)), "id_bairro int, bairro_original_key string")
    c = spark.createDataFrame([(k, k, i, None) for i, k in enumerate(cs, 1)],
                              "bairro_canonico_key string, bairro_canonico string, id_bairro_canonico int, "
                              "query_geocoding string")
    got = {(r.id_bairro, r.bairro_canonico_key) for r in M.fuzzy_candidates(u, c, cfg).collect()}
    want = set()
    for i, a in enumerate(us, 1):
        for b in cs:
            m = max(len(a), len(b))
            if m and 1 - _lev(a, b) / m >= floor:
                want.add((i, b))
    assert got == want


def test_long_place_names_match_through_prefix_filter(spark):
    """Names beyond the 64-character segment plan: a copy with three typos
    still finds its canonical name and is accepted; an unrelated long name
    gets no candidate."""
    cfg = MatchConfig()
    canon = ["conjunto habitacional nossa senhora aparecida jardim das palmeiras setor norte",
             "residencial vila nova esperanca chacara santa luzia loteamento parque das flores"]
    dirty = ["conjunto habitacionl nossa senhora aparecida jardim das palmeras setor nort",
             "zzzz qqqq wwww yyyy xxxx vvvv kkkk jjjj hhhh gggg ffff dddd ssss aaaa pppp oooo"]
    u = spark.createDataFrame(list(enumerate(dirty, 1)), "id_bairro int, bairro_original_key string")
    c = spark.createDataFrame([(k, k.title(), i, None) for i, k in enumerate(canon, 1)],
                              "bairro_canonico_key string, bairro_canonico string, id_bairro_canonico int, "
                              "query_geocoding string")
    top = {r.id_bairro: r for r in M.fuzzy_top2(M.fuzzy_candidates(u, c, cfg), cfg).collect()}
    assert set(top) == {1}
    assert top[1].id_bairro_canonico_by_fuzzy == 1 and top[1].fuzzy_accepted
    assert top[1].best_distance == 3


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="abc ", min_size=1, max_size=14), min_size=1, max_size=10),
       st.lists(st.text(alphabet="abc ", min_size=1, max_size=14), min_size=2, max_size=10, unique=True))
def test_fuzzy_scores_report_the_uncut_ranking_or_null(spark, us, cs):
    cfg = MatchConfig()
    u = spark.createDataFrame(list(enumerate(us, 1)), "id_bairro int, bairro_original_key string")
    c = spark.createDataFrame([(k, k, i, None) for i, k in enumerate(cs, 1)],
                              "bairro_canonico_key string, bairro_canonico string, id_bairro_canonico int, query_geocoding string")
    got = {r.id_bairro: r for r in M.fuzzy_scores(u, c, cfg).collect()}
    assert set(got) == set(range(1, len(us) + 1))
    for i, a in enumerate(us, 1):
        ranked = sorted((-(1 - _lev(a, b) / max(len(a), len(b))), _lev(a, b), b) for b in cs)
        best, second = (-ranked[0][0], ranked[0][2]), (-ranked[1][0], ranked[1][2])
        r = got[i]
        assert (r.best_similarity, r.bairro_by_fuzzy) == (best if best[0] >= cfg.last_floor else (None, None))
        assert (r.second_similarity, r.second_best_match) == (second if second[0] >= cfg.last_floor else (None, None))
        assert r.similarity_gap == (best[0] - second[0] if second[0] >= cfg.last_floor else None)
        assert r.fuzzy_accepted == (best[0] >= cfg.threshold and best[0] - second[0] >= cfg.gap)


def test_audit_lists_failures_as_rows(spark):
    from casemart.sources.tables import audit_objects, content_differences, count_rows
    spark.range(3).createOrReplaceTempView("audit_ok")
    spark.sql("CREATE OR REPLACE TEMP VIEW audit_bad AS SELECT id FROM range(3) WHERE 1 / (id - 1) > 0")
    got = {r.object_name: r for r in audit_objects(spark, ["audit_ok", "audit_bad", "audit_absent"]).collect()}
    assert got["audit_ok"].row_count == 3 and got["audit_ok"].status == "ok"
    assert all(got[n].status.startswith("error:") and len(got[n].status) <= 207 for n in ("audit_bad", "audit_absent"))
    assert count_rows({}, spark=spark).count() == 0
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 3)], "v string, k long")
    r = content_differences(a, b, "t").first()
    assert (r.columns_compared, r.rows_missing, r.rows_unexpected) == (2, 2, 1)


def _names(spark, us, cs):
    u = spark.createDataFrame(list(enumerate(us, 1)), "id_bairro int, bairro_original_key string")
    c = spark.createDataFrame([(c, c, i, None) for i, c in enumerate(cs, 1)],
                              "bairro_canonico_key string, bairro_canonico string, id_bairro_canonico int, query_geocoding string")
    return u, c


def _pairs_at(us, cs, floor):
    return {(i, b) for i, a in enumerate(us, 1) for b in cs if 1 - _lev(a, b) / max(len(a), len(b)) >= floor}


@pytest.mark.parametrize("cap,hot", [(64, 1), (64, 1024), (10, 2)])
def test_candidates_at_the_last_floor_equal_brute_force_at_every_length(spark, cap, hot):
    """Lengths 3 to 90 around both filters' border, with repeated beginnings and hot segments in salts of few keys."""
    import random
    rnd = random.Random(5)
    cs = sorted({"vila " * (i % 3) + "".join(rnd.choice("abcde ") for _ in range(3 + i)) for i in range(80)})
    us = []
    for c in cs:
        w = list(c)
        for _ in range(max(1, int(len(w) * rnd.choice([0.05, 0.2, 0.28, 0.33])))):
            at = rnd.randrange(len(w))
            w[at:at + 1] = rnd.choice([[], [rnd.choice("abcde")], [w[at], "e"]])
            w = w or ["a"]
        us.append("".join(w))
    u, c = _names(spark, us, cs)
    got = {(r.id_bairro, r.bairro_canonico_key) for r in M.fuzzy_candidates(u, c, MatchConfig(max_segment_len=cap, hot=hot), 0.7).collect()}
    assert got == _pairs_at(us, cs, 0.7)


def test_candidates_per_name_stay_few_under_a_shared_prefix(spark):
    """400 names that begin alike: the shared segments are not among the rarest, so they pair nobody."""
    import random
    rnd = random.Random(6)
    cs = ["residencial " + "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(400)]
    us = [c[:15] + c[16:] for c in cs]
    u, c = _names(spark, us, cs)
    u2 = u.withColumnRenamed("bairro_original_key", "u").withColumn("la", F.length("u"))
    c2 = c.withColumnRenamed("bairro_canonico_key", "c").withColumn("lc", F.length("c"))
    pairs = M.segment_pairs(u2, c2, 24, 0.8)
    assert pairs.count() <= 20 * len(us)                     # of 400 * 400
    assert {r.id_bairro for r in pairs.filter(F.concat(F.substring("c", 1, 15), F.substring("c", 17, 99)) == F.col("u")).collect()} == set(range(1, 401))


def test_long_and_short_names_are_searched_to_the_same_floor(spark):
    base = "conjunto habitacional nossa senhora aparecida jardim das palmeiras setor norte"
    names = [base[:n] for n in (20, 44, 45, 64, 78)]
    us = ["#" * (len(n) // 4) + n[len(n) // 4:] for n in names]            # similarity 0.75
    u, _ = _names(spark, us, [])
    _, c = _names(spark, [], names)
    got = {r.id_bairro: r for r in M.fuzzy_scores(u, c).collect()}
    assert all(abs(got[i].best_similarity - (1 - (len(n) // 4) / len(n))) < 1e-12 for i, n in enumerate(names, 1))


def test_case_lists_of_two_layouts_in_one_pass(spark):
    from casemart.operators.facts import ListLayout, clean_dated_linelist, clean_linelists, clean_undated_linelist
    kind = "lista string, _c0 string, _c1 string, _c2 string, _c3 string, _c4 string, _c5 string, _c6 string"
    rows = [("a", "1", "02/03/2024", "41", " fem ", "São João", " UBS 1 ", "positivo"),
            ("a", "Nº", "02/03/2024", "41", "fem", "Centro", "UBS", None),          # header: the id is no number
            ("a", "2", "2024-03-02", "x", None, "Centro", None, None),                # neither date nor age can be read
            ("a", "3", "02/03/2024", "1", "m", "  ", "UBS", None),                    # no place
            ("b", " 4 ", "7", "masc", "Vila Nova", "9", None, None), ("b", "5", None, None, None, None, None, None),
            ("c", "6", "1", "f", "Centro", None, None, None), (None, "7", "1", "f", "Centro", None, None, None)]
    df = spark.createDataFrame(rows, kind)
    layouts = {"a": ListLayout("dengue", date="_c1", age="_c2", sex="_c3", place="_c4", unit="_c5", exam="_c6"),
               "b": ListLayout("chik", age="_c1", sex="_c2", place="_c3", reference_year=2026)}
    out = clean_linelists(df, "lista", layouts)

    def same(name, one, cols):
        assert sorted(map(str, out.filter(F.col("lista") == name).select(*cols).collect())) == sorted(map(str, one.select(*cols).collect()))

    one = clean_dated_linelist(df.filter("lista = 'a'").drop("lista"), "dengue")
    two = clean_undated_linelist(df.filter("lista = 'b'").drop("lista"), "chik", 2026)
    same("a", one, one.columns)
    same("b", two, two.columns)
    assert out.count() == 3 and out.filter("lista = 'a' AND ano_referencia IS NOT NULL").count() == 0
    assert dict(out.dtypes)["data"] == "date" and dict(out.dtypes)["ano_referencia"] == "int"


def test_dimensions_in_one_pass_equal_single_ones(spark):
    a = spark.createDataFrame([(f"Place {i % 50:02d} ", ["F", "m", "", None][i % 4], "x") for i in range(400)], "bairro string, sexo string, outro string")
    b = spark.createDataFrame([("  new", "M", None)], a.schema)
    raw = spark.createDataFrame([("Zz Top",)], "sexo string")          # a source taken as it is
    got = D.build_dimensions([(a, ["bairro", "sexo"], D.normalize_key), (b, ["bairro", "sexo"], D.normalize_key), (raw, ["sexo"], None)],
                             {"bairro": "id_bairro", "sexo": "id_sexo", "outro": "id_outro"}, num_buckets=5)
    want = D.build_dimension([a.select("bairro"), b.select("bairro")], "bairro", "id_bairro")
    assert [tuple(r) for r in got["bairro"].orderBy("id_bairro").collect()] == [tuple(r) for r in want.orderBy("id_bairro").collect()]
    assert [tuple(r) for r in got["sexo"].orderBy("id_sexo").collect()] == [(1, "Zz Top"), (2, "f"), (3, "m")]
    assert got["outro"].count() == 0 and dict(got["bairro"].dtypes) == {"id_bairro": "int", "bairro": "string"}
    none = D.build_dimensions([(a.limit(0), ["bairro"], D.normalize_key)], {"bairro": "id_bairro"})
    assert none["bairro"].collect() == []


def test_rows_of_each_list_are_counted_by_the_write(spark):
    from casemart.session import stage_counted
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "lista string, x int")
    table, seen = stage_counted(df, "lists", ("x",), by="lista", values=("a", "b", "c"))
    assert seen == {"rows": 3, "x_nulls": 1, "rows_a": 2, "rows_b": 1, "rows_c": 0}
    assert table.filter("lista = 'a'").count() == 2
    empty, seen = stage_counted(df.limit(0), "lists", by="lista", values=("a",))
    assert empty.count() == 0 and seen == {"rows": 0, "rows_a": 0}


def test_long_names_that_begin_alike_pair_few(spark):
    """120 unlike names of 70 characters with one beginning: blocks with one edit find each name's own spelling and
    compare few others, down to the last floor."""
    import random
    rnd = random.Random(7)
    cs = ["rua de " + "".join(rnd.choice("0123456789abcdef") for _ in range(63)) for _ in range(120)]
    us = [c[:20] + "z" * 19 + c[39:] for c in cs] + [c[:30] + c[31:] for c in cs]

    def keys(texts):
        return spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "kid long, s string, l int")

    b = M.block_size(64, 70, 0.7)
    found = {(r.x_id, r.y_id) for r in M._block_pairs(keys(us[:120]), keys(cs), 0.7, b, True).collect()}
    assert {(i, i) for i in range(120)} <= found and len(found) < 0.1 * 120 * 120
    u, c = _names(spark, us, cs)
    got = {(r.id_bairro, r.bairro_canonico_key) for r in M.fuzzy_candidates(u, c, MatchConfig(), 0.7).collect()}
    assert got == {(i, c) for i, c in enumerate(cs + cs, 1)}


@pytest.mark.parametrize("cap,longest,floor", [(64, 70, 0.7), (64, 500, 0.7), (64, 500, 0.8), (6, 90, 0.7), (1, 40, 0.55)])
def test_blocks_fit_every_length(cap, longest, floor):
    b = M.block_size(cap, longest, floor)
    assert b >= 2
    assert all(b * (M.max_edits(n, floor) // 2 + 1) <= n for n in range(cap + 1, longest + 1))


def test_lost_character_at_the_end_of_a_long_name(spark):
    """The last block lost a character, every other block holds two edits."""
    c = "".join(chr(97 + i % 23) + str(i % 10) for i in range(35))[:70]
    for at in (0, 1, 35, 68, 69):
        u, cc = _names(spark, [c[:at] + c[at + 1:], c[:at] + "#" + c[at:], c[:at] + "#" + c[at + 1:]], [c])
        assert M.fuzzy_candidates(u, cc, MatchConfig(), 0.7).count() == 3


def test_long_names_that_are_unlike_leave_no_pair(spark):
    """300 unlike names of 70 characters: what the pieces pair by chance (some hundreds) ends in the task that finds it."""
    import random
    rnd = random.Random(8)
    cs = ["rua de " + "".join(rnd.choice("0123456789abcdef") for _ in range(63)) for _ in range(300)]
    us = [c[:20] + "z" * 19 + c[39:] for c in cs]

    def keys(texts):
        return spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "kid long, s string, l int")

    found = M._block_pairs(keys(us), keys(cs), 0.7, M.block_size(64, 70, 0.7), True)
    got = [(r.x_id, r.y_id) for r in found.collect()]
    assert sorted(got) == [(i, i) for i in range(300)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan                        # only keys are dealt out


@pytest.mark.parametrize("floor", [0.55, 0.7, 0.8, 0.93])
@pytest.mark.parametrize("small", [False, True])
def test_near_keys_lose_no_pair_and_give_each_once(monkeypatch, floor, small):
    """Keys of mixed lengths and few letters, edited at random, against brute force; ``small``: many indexes, slices and batches."""
    import random

    from casemart.operators import blocks as B
    if small:
        for name, value in (("INDEX_PIECES", 600), ("SLICE", 50), ("CHECK", 300), ("PAIRS", 40), ("BATCH", 90)):
            monkeypatch.setattr(B, name, value)
    rnd = random.Random(f"{floor} {small}")
    alphabet, cap = "aabç\U0001F600", 8

    def edited(t, n):
        for _ in range(n):
            at = rnd.randrange(len(t) + 1)
            t = rnd.choice((t[:at] + rnd.choice(alphabet) + t[at:], t[:at] + t[at + 1:], t[:at] + rnd.choice(alphabet) + t[at + 1:]))
        return t

    near = 0
    for _ in range(6):
        ys = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(6, 45))) for _ in range(14)]
        xs = [edited(y, rnd.randint(0, max(1, M.max_edits(len(y), floor)))) for y in ys for _ in range(2)]
        b = M.block_size(cap, max(map(len, xs + ys)), floor)
        xs, ys = [x for x in xs if len(x) > cap], [y for y in ys if len(y) >= b - 1]
        for equal in (True, False):
            want = {(i, j) for i, x in enumerate(xs) for j, y in enumerate(ys)
                    if len(y) <= len(x) - (not equal) and _lev(x, y) <= M.max_edits(len(x), floor)}
            got = [(int(i), int(j)) for a, c in B.near_keys(xs, ys, floor, b, equal) for i, j in zip(a, c, strict=True)]
            assert len(got) == len(set(got)) and want <= set(got)
            assert all(len(ys[j]) <= len(xs[i]) - (not equal) for i, j in got)
            near += len(want)
    assert near > 20
    assert list(B.near_keys([], ["abcdefghijkl"], floor, 2, True)) == list(B.near_keys(["abcdefghijkl"], [], floor, 2, True)) == []


def test_tasks_of_long_names_stay_bounded():
    for x, y in ((0, 0), (70, 70), (10 ** 6, 10 ** 5), (10 ** 8, 25 * 10 ** 6), (10, 10 ** 9), (10 ** 9, 10), (10 ** 10, 10 ** 9)):
        nx, ny = M._cells(x, y, 8)
        assert x / nx <= M.CELL_CHARS and y / ny <= M.CELL_CHARS and x * y / (nx * ny) <= M.CELL_WORK
        assert nx * ny >= min(32, x * y // M.SMALL_WORK)
    assert M._cells(0, 0, 8) == M._cells(70, 70, 8) == (1, 1)


def test_names_near_all_others_are_followed_once(monkeypatch):
    """60 names that differ in their last digits: a pair that is found is not followed again from its other blocks."""
    from casemart.operators import blocks as B
    names = [f"conjunto habitacional nossa senhora aparecida jardim das palmeiras setor norte {i:03d}" for i in range(60)]
    followed, follow = [], B._follow
    monkeypatch.setattr(B, "SLICE", 2000)
    monkeypatch.setattr(B, "_follow", lambda *a: followed.append(len(a[6])) or follow(*a))
    got = [p for i, j in B.near_keys(names, names, 0.7, M.block_size(64, 82, 0.7), True) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert sorted(got) == [(i, j) for i in range(60) for j in range(60)]
    assert sum(followed) <= 2 * 60 * 60
