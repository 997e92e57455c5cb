"""Hilbert shards, lexical search and whitening against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casemart.llm import hilbert, lexical, whitening
from casemart.llm.common import ship_package

LONG = "alpha " * 30_000
TEXTS = [None, "", "  .,;!", "Alpha beta", "alpha beta", "alpha beta", "ALPHA-beta\tgamma", "naïve Ünïcode 日本語 beta", LONG, "gamma " * 40, "delta",
         "beta beta beta alpha", "a1 b2 a1", "x" * 50_000] + [f"alpha word{i % 7} beta{i % 3}" for i in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 5}", 7, "clash") for i, t in enumerate(TEXTS)]
    rows += [(4, "alpha beta", "en", "src4", 7, None), (None, "alpha null id", None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, slot int, shard string")


# ---- Hilbert shards

@pytest.mark.parametrize("n,bits", [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_curve_visits_every_cell_in_steps_of_one(spark, n, bits):
    side = 1 << bits
    points = spark.range(side ** n)
    for i in range(n):
        points = points.withColumn(f"x{i}", (F.floor(F.col("id") / side ** i) % side).cast("int"))
    rows = points.withColumn("h", hilbert.curve_index([F.col(f"x{i}") for i in range(n)], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(side ** n))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"x{i}"] - b[f"x{i}"]) for i in range(n)) == 1


def brute_cells(values, bits):
    smaller = sorted(values, key=lambda v: (v is not None, v if v is not None else 0))
    first = {}
    for i, v in enumerate(smaller):
        first.setdefault(v, i)
    return [first[v] * (1 << bits) // len(values) for v in values]


def test_cells_have_equal_depth(spark):
    values = [None, None, 5, 5, 5, 5, 5, 5, 1, 2, 9, -3] * 3
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(4)
    cell = hilbert._cell(F.col("v"), *hilbert.cells_of(df, "v", 3), "bigint")
    got = {r.v: r.c for r in df.select("v", cell.alias("c")).collect()}
    assert got == dict(zip(values, brute_cells(values, 3)))


def test_shards_by_rows(spark, docs):
    got = hilbert.shard_documents(docs, 16).collect()
    assert len(got) == docs.count()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(16)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    again = hilbert.shard_documents(docs.repartition(5), 16).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_shards_by_bytes_and_files(spark, docs, tmp_path):
    df = docs.withColumn("size", F.octet_length("text").cast("long"))
    out = hilbert.hilbert_shards(df, ["source", "lang", "size"], 4, "bytes", "size", ("size", "doc_id"))
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "size", "curve", "shard", "slot"}      # clashing columns are replaced
    rows = out.collect()
    total, largest = sum(r.size or 0 for r in rows), max(r.size or 0 for r in rows)
    sums, slots = Counter(), defaultdict(list)
    for r in rows:
        sums[r.shard] += r.size or 0
        slots[r.shard].append(r.slot)
    assert len(rows) == docs.count() and all(abs(sums[s] - total / 4) <= largest for s in range(4))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hilbert.write_shards(out, str(tmp_path / "shards"), 10)
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r.shard, r.slot, r.doc_id or -1) for r in read.collect()) == sorted((r.shard, r.slot, r.doc_id or -1) for r in rows)


def test_a_hot_value_does_not_fill_one_shard(spark):
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"),
                                 F.when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source"))
    assert {r["count"] for r in hilbert.shard_documents(df, 16).groupBy("shard").count().collect()} == {56, 57}


def test_shards_of_few_rows_and_none(spark, docs):
    assert hilbert.shard_documents(docs.limit(0)).count() == 0
    few = hilbert.shard_documents(docs.filter("doc_id IN (1, 2, 3)")).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)]
    with pytest.raises(ValueError):
        hilbert.hilbert_shards(docs, ["lang"], 4, "key")


# ---- lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    docs = [(i, Counter(terms_of(t))) for i, t in docs if i is not None]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(terms_of(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


ITEMS = [(0, "alpha beta"), (1, None), (2, ""), (3, "nowhere to be found"), (4, "Word3 BETA2 gamma a1"), (4, "delta"), (5, "日本語 naïve"), (None, "alpha"),
         (6, LONG), (7, " ".join(f"word{i}" for i in range(300)))]


@pytest.mark.parametrize("columns,states,k", [(4096, 512, 50), (8, 4, 3), (1, 1, 5)])
def test_search_finds_what_scoring_every_document_finds(spark, docs, monkeypatch, columns, states, k):
    items = spark.createDataFrame([(i, t, 1.0, 2) for i, t in ITEMS], "item_id long, text string, score double, rank int")
    monkeypatch.setattr(lexical, "RANGE", columns)
    monkeypatch.setattr(lexical, "STATES", states)
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], ITEMS, k)
    got = sorted(map(tuple, lexical.search(docs.repartition(3), items, k).collect()))
    assert got == want and want


def test_search_in_several_rounds(spark, docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(lexical, "ROUND_TERMS", 100)
    assert sorted(map(tuple, lexical.search(docs, items, 5).collect())) == brute_search([(r.doc_id, r.text) for r in docs.collect()], ITEMS, 5)


def test_search_in_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs.filter("text IS NULL"), items).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_treap_descent_is_exact(data):
    n_rows, n_cols, k = data.draw(st.integers(1, 40)), data.draw(st.integers(1, 40)), data.draw(st.integers(1, 6))
    cells = data.draw(st.dictionaries(st.tuples(st.integers(0, n_rows - 1), st.integers(0, n_cols - 1)), st.integers(1, 4), max_size=200))
    asked = sorted(data.draw(st.sets(st.integers(0, n_rows - 1), min_size=1, max_size=8)))
    at = np.array(list(cells) or np.zeros((0, 2)), np.int64).reshape(-1, 2)
    treap = lexical.Treap(at[:, 0], at[:, 1], np.array(list(cells.values()), np.int64))
    ids = np.arange(n_cols)[::-1] * 10
    best = lexical.Best(k)
    lexical.descend(treap, np.array(asked), ids, best)
    sums = Counter()
    for (r, c), v in cells.items():
        if r in asked:
            sums[int(ids[c])] += v
    assert list(zip(best.score.tolist(), best.ids.tolist())) == [(s, i) for i, s in sorted(sums.items(), key=lambda x: (-x[1], x[0]))[:k]]


# ---- whitening

def brute_whitening(vectors, k):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    dev = ((n * x - s) ** 2).sum(1)
    c = (n * x - s).astype(float) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return n, dev, e, c @ v[:, :k] / np.sqrt(e[:k])


def check_whitening(out, ids, vectors, k):
    n, dev, e, want = brute_whitening(vectors, k)
    got = defaultdict(dict)
    for r in out:
        got[r.vec_id][r.component] = r
    assert len(out) == k * len(ids) and {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-9
    rows = np.array([[got[i][c + 1].whitened for c in range(k)] for i in ids])
    sign = np.sign((rows * want).sum(0))
    assert np.abs(rows * sign - want).max() < 1e-7
    assert [got[i][1].deviation for i in ids] == [int(d) for d in dev]
    assert np.allclose([got[ids[0]][c + 1].explained for c in range(k)], e[:k] / e.sum(), rtol=1e-8)


def test_whitening_matches_an_eigendecomposition(spark):
    ship_package(spark)
    rng = np.random.default_rng(3)
    good = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 4).tolist()
    bad = [None, [], [1.0] * 11, [1.0] * 11 + [None], [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1e30] * 12]
    rows = [(i, v, 9) for i, v in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int").repartition(5)
    check_whitening(whitening.whiten(df).collect(), list(range(300)), good, 8)


def test_whitening_of_nearly_dependent_dimensions(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 3))
    good = np.hstack([base * [30, 1, 0.05], np.ones((400, 1)), base[:, :1] * 30]).astype(np.float32).tolist()      # a constant and a copied dimension
    df = spark.createDataFrame(list(enumerate(good)), "vec_id long, embedding array<float>").repartition(3)
    check_whitening(whitening.whiten(df).collect(), list(range(400)), good, 3)


def test_whitening_without_variance(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], kind)).count() == 0
    two = whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (None, [1.0, 0.0]), (1, [0.0, 0.0])], kind)).collect()
    assert len(two) == 3 and {r.component for r in two} == {1} and abs(two[0].explained - 1) < 1e-9


def test_deviations_beyond_a_long_are_null(spark):
    centre = whitening.Centre(10, (0, 0), 1 << 40)
    x = np.array([[1 << 40, 0], [3, 4]], np.int64)
    assert centre.deviations(x).to_pylist() == [None, 2500]
