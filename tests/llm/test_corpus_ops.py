"""Near duplicates, top-k, language model, classifier, leaks, PII and the pipeline."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casemart.llm import decontaminate, lm_score, near_dedup, pii, quality, topk
from casemart.llm.common import add_blocks, fold, ship_package

SMALL = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


# ------------------------------------------------------------ near duplicates

def shingles(text, width):
    w = tokens(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def components_by_scan(rows, width, percent=80):
    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (len(s), find(i)) for i, s in sets}


def near_rows():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, i = [(0, None), (1, ""), (2, " \n "), (3, "One two"), (4, "one  TWO"), (5, "one two three"), (6, "w " * 3000), (7, "W " * 2999)], 10
    for group in range(12):
        base = [word() for _ in range(rng.choice([8, 40, 150, 600]))]
        for _ in range(rng.choice([2, 5, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((i, " ".join(copy)))
            i += 1
    chain = [word() for _ in range(60)]           # neighbours are links, the ends are not
    for k in range(12):
        rows.append((i + 11 - k, " ".join(chain)))
        chain[5 * k % 60] = word()
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_match_brute_force(spark, width):
    rows = near_rows()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(None, "no id", 1), (3, "One two", 1)], "doc_id long, text string, node int")
    got = near_dedup.near_duplicates(df, width=width).collect()
    want = components_by_scan(rows, width)
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.component_id == r.doc_id)


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(df).count() == 0


def test_bits_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 1500, np.uint64)
    for common in (400, 800, 950):
        a, b = pool[:1000], np.concatenate([pool[:common], pool[1000:2000 - common]])
        m = np.array([near_dedup.minima(a), near_dedup.minima(b)])
        x, y = near_dedup.packed(m)
        wrong = sum(int(np.bitwise_count(np.bitwise_or.reduce([x[2 * p + w] ^ y[2 * p + w] for p in range(near_dedup.BITS)]))) for w in range(2))
        agree = 1 - wrong / near_dedup.MINIMA
        assert abs((agree - 1 / 16) / (15 / 16) - common / (2000 - common)) < 0.15
        px, py = near_dedup.parity(a).view(np.uint64), near_dedup.parity(b).view(np.uint64)
        assert np.bitwise_count(px ^ py).sum() <= 2 * (1000 - common)


# ------------------------------------------------------------ exact top-k

@pytest.mark.parametrize("block", [7, 4096])
def test_topk_matches_brute_force(spark, block):
    rng = np.random.default_rng(2)
    vec = rng.normal(size=(400, 9)).round(2)
    vec[100:250] = vec[100]                       # a hot vector, all ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vec)]
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")] * 9), (650, [float("inf")] * 9), (None, [1.0] * 9), (700, []), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, v array<double>, dist int")
    vectors = topk.integer_vectors(df, "vec_id", "v")
    got = {}
    for r in topk.PivotIndex(vectors, pivots=6, annuli=8, block_rows=block).search(vectors.filter("vec_id % 50 = 0"), 5, block_queries=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ints = {i: np.array([math.floor(256 * x) for x in v] + [0] * (9 - len(v)), object) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = {}
    for q in (i for i in ints if i % 50 == 0):
        best = sorted((-int((ints[q] * x).sum()), i) for i, x in ints.items() if i != q)[:5]
        want[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert {q: sorted(v) for q, v in got.items()} == want


@pytest.mark.parametrize("times", [1, 6])
def test_topk_repeated_neighbours(spark, times):
    """The best neighbours stand in many rows of one block; all other ids must still be ranked."""
    rows = [(0, [1.0, 0.0]), *[(i, [float(i), 1.0]) for i in range(1, 101)]]
    rows += [(i, [float(i) - j / 100, 1.0]) for i in (100, 99, 97) for j in range(times)]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v")
    got = topk.PivotIndex(vectors, pivots=1, annuli=1).search(vectors.filter("vec_id = 0"), 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 256 * 256 * i) for i in (100, 99, 98, 97, 96)]


def test_topk_copies_visited_blocks_only(spark):
    """Far clusters: a query's block goes to its own group, so far fewer rows move than rows times groups."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in 50 * (np.arange(8) == i % 8) + rng.normal(size=8)]) for i in range(1600)]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v")
    index = topk.PivotIndex(vectors, pivots=16, annuli=64, block_rows=50)
    queries = vectors.filter("vec_id % 8 = 0 AND vec_id < 64")
    blocks = {r.block for r in index._visits(queries, 5, vectors=False).collect()}
    assert 0 < len(blocks) < len(set(index.block.tolist())) / 2
    got = index.search(queries, 5, block_queries=2)
    assert got.count() == 40 and {r.vec_id % 8 for r in got.collect()} == {0}


def test_topk_few_or_no_vectors(spark):
    for n in (0, 1, 3):
        df = spark.createDataFrame([(50 * i, [1.0, float(i)]) for i in range(n)], "vec_id long, v array<double>")
        vectors = topk.integer_vectors(df, "vec_id", "v")
        assert topk.PivotIndex(vectors).search(vectors, 5).count() == n * (n - 1)


# ------------------------------------------------------------ language model

def test_lm_counts_and_probabilities(spark):
    rng = random.Random(4)
    vocabulary = ["the", "of", "and", "Time", "x,", "ünder"] + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, [30, 20, 20, 9, 9, 9] + [1] * 60, k=rng.randint(0, 50)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "never seen Words"), (None, "the of"), (7, rows[7][1])]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, chunk string")
    got = lm_score.lm_scores(df, lm_score.MaxEnt(head=4, endings=3, bits=8, chunk_bytes=2000)).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    count = Counter(t for i, x in rows if not held(i) for t in [*tokens(x), "\n"])
    n, v = sum(count.values()), len(count)
    texts = dict(rows)
    for r in got:
        t = [*tokens(texts[r.doc_id]), "\n"]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(t), sum(x in count for x in t), n)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t), rel_tol=1e-9)
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 1.05


def test_lm_is_a_distribution(spark):
    """Over one more token, the probabilities of all words, an unknown one per class and the end add up to one."""
    spec = lm_score.MaxEnt(head=2, endings=2, bits=6, rounds=1)
    base = [(i, t) for i, t in enumerate(["a b c a", "a a b", "c d a b", "b a e"] * 5)]
    known = sorted({w for _, t in base for w in t.split()})
    unknown = [f"zz{i}" for i in range(8)]
    probe = [(i, "") for i in range(10_000, 10_200) if zlib.crc32(str(i).encode()) % 7 == 2][:1 + len(known) + len(unknown)]
    words = ["", *known, *unknown]
    df = spark.createDataFrame(base + [(i, w) for (i, _), w in zip(probe, words)], "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm_score.lm_scores(df, spec).collect()}
    first = {w: score[i] for (i, _), w in zip(probe, words)}
    assert all(x < 0 for x in first.values()) and first["a"] > first["zz0"]


def test_lm_model_size_follows_the_tokens():
    spec = lm_score.MaxEnt()
    assert [spec.grown(n).bits for n in (0, 1 << 26, 1 << 28, 1 << 30, 1 << 40)] == [13, 13, 14, 15, 16]
    names = pa.array([b"a", b"b", b"c", b"d", lm_score.END], pa.binary())
    vocabulary = lm_score.Vocabulary(spec, [])
    one, two = (vocabulary.features(names, np.array([i, 1, 2, 3]), np.array([4]))[:, 3] for i in (0, 3))
    assert spec.classes == 64 and len(one) == 4 and (one != two).tolist() == [False, False, True, False]


def test_lm_history_tells_words_of_an_ending_apart(spark):
    """After 'red' comes one word, after 'blue' another; both have one ending and frequency."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["red xxing", "blue yying"]) for _ in range(20))) for i in range(1000)]
    held = [i for i in range(20_000, 20_050) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    df = spark.createDataFrame([*rows, (held[0], "red xxing"), (held[1], "red yying")], "doc_id long, text string")
    spec = lm_score.MaxEnt(head=0, endings=2, bits=8, own=3, tails=2, batch=256, chunk_bytes=20_000)
    score = {r.doc_id: r.score for r in lm_score.lm_scores(df.coalesce(1), spec).collect()}
    assert score[held[0]] > score[held[1]] + 0.7


def test_lm_leaves_add_up():
    """All leaf probabilities and the shares of the words in them add up to one."""
    spec = lm_score.MaxEnt(head=1, endings=1, bits=6, own=2, tails=2)
    vocabulary = lm_score.Vocabulary(spec, [b"the"])
    vocabulary.own = {b"aa": 0, b"ba": 1}
    names = pa.array([b"aa", b"ba", b"ca", b"da", b"the", lm_score.END], pa.binary())
    assert vocabulary.classes(names).tolist() == [2, 2, 2, 2, 1, 0]
    leaf = vocabulary.leaves(names)
    assert leaf[:2].tolist() == [0, 1] and set(leaf[2:4].tolist()) <= {2, 3}
    rng = np.random.default_rng(0)
    w, b = rng.normal(size=(64, spec.leaves)).astype(np.float32), np.zeros(spec.leaves, np.float32)
    x = vocabulary.leaf_features(names, np.array([0, 2, 5]), np.array([3]), np.array([1]), np.array([2]))
    assert x.shape == (3, 1) and x[0, 0] == 2 and (x[1:] >= spec.classes).all() and (x < 64).all()
    total = sum(math.exp(lm_score.log_chance(w, b, x, np.array([t]), 8)[0]) for t in range(spec.leaves))
    assert math.isclose(total, 1, rel_tol=1e-5)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=80))
def test_lm_group_sums(keys):
    row = np.array(keys, np.uint16)
    values = np.arange(3 * len(row), dtype=np.float32).reshape(-1, 3)
    by = np.argsort(row, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], row[by][1:] != row[by][:-1]]))
    assert (lm_score.group_sums(values, by, first) == np.add.reduceat(values[by], first, axis=0)).all()


@pytest.mark.parametrize("mean", [False, True])
def test_blocks_add_up_in_a_tree(spark, mean):
    ship_package(spark)
    rows = [(p, t + 1, np.full(4, 10 * p + t, np.float32).tobytes()) for t in range(23) for p in range(3)]
    df = spark.createDataFrame(rows, "part long, n long, value binary").repartition(23, "n")
    got = add_blocks(df, 23, 3, np.float32, mean, fan_in=3)
    assert [(r.part, r.n) for r in got] == [(p, 276) for p in range(3)]
    for r in got:
        x = [(t + 1 if mean else 1) * (10 * r.part + t) for t in range(23)]
        assert np.allclose(np.frombuffer(r.value), sum(x) / (276 if mean else 1))


def test_lm_of_nothing(spark):
    assert lm_score.lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ------------------------------------------------------------ quality classifier

def test_quality_learns_and_scores_all(spark):
    rng = random.Random(6)
    good = lambda: " ".join(rng.choice(["river", "stone", "bright", "morning", "walk", "quiet"]) for _ in range(30))
    bad = lambda: " ".join(rng.choice(["BUY!!", "$$$", "win###", "cheap%%%"]) + rng.choice(["", "x"]) for _ in range(30))
    rows = [(i, good() if i % 3 else bad()) for i in range(300)]
    docs = spark.createDataFrame([(*r, "zz", 5) for r in rows] + [(800, None, None, None), (801, "", "zz", 5), (802, "long " * 30_000, "zz", 5)],
                                 "doc_id long, text string, score string, label int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(5, None), (9999, 1), (None, 1)], "doc_id long, quality int")
    small = quality.Recipe(train_rows=150, bits=12)
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels, small).collect()}
    assert len(got) == 303 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    test = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in test) for i in range(300))
    assert sum(got[i].predicted == int(i % 3 > 0) for i in test) >= 0.97 * len(test)
    assert got[800].score == got[801].score
    # labels of held-out rows change nothing
    other = labels.withColumn("quality", F.when(fold("doc_id", 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.quality_scores(docs, other, small).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_quality_learns_one_row_an_id(spark):
    """A labelled id that holds most rows is learned once: the scores are those without its copies."""
    rows = [(i, "calm river stone" if i % 2 else "BUY!! win###") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    small = quality.Recipe(train_rows=60, bits=10)
    once = {r.doc_id: r.score for r in quality.quality_scores(docs, labels, small).collect()}
    many = quality.quality_scores(docs.union(docs.filter("doc_id = 3").crossJoin(spark.range(500)).drop("id")), labels, small)
    assert {r.doc_id: r.score for r in many.distinct().collect()} == once and many.count() == 560


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.quality_scores(docs, none).collect()] == [0.5]
    assert quality.quality_scores(docs.limit(0), none).count() == 0


# ------------------------------------------------------------ decontamination

def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
    return row[-1]


def test_bit_parallel_lcs():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randint(1, 6) for _ in range(rng.randint(1, 20))] for _ in "ab")
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        assert decontaminate.longest_common(masks, len(a), b) == lcs(a, b)


def test_leaks_found_and_clean_left_alone(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: text(rng.randint(12, 130)) for i in range(30)}
    rows, want = [], set()
    for d in range(400):
        w = text(rng.randint(1, 700))
        if d % 10 == 0:
            i = d // 10 % 30
            leak = [x if d % 3 or rng.random() > 0.15 else rng.choice(vocabulary) for x in items[i]]
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() if d % 20 else x + "," for x in leak]
            want.add((d, i))
        rows.append((d, " ".join(w)))
    rows += [(1000, None), (1001, ""), (None, " ".join(items[0])), (1002, " ".join(items[1])), (1002, " ".join(items[1]))]
    want.add((1002, 1))
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, codes int")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(77, None), (78, "")], "item_id long, text string")
    got = decontaminate.find_leaks(docs, bench).collect()
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_leaks_of_excerpts_across_part_borders(spark):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: text(n) for i, n in enumerate([65, 100, 128, 129, 200, 300])}
    rows, want = [], set()
    for i, w in items.items():
        for at in range(0, len(w) - 64 + 1, 16):
            rows.append((len(rows), " ".join(text(90) + w[at:at + 64] + text(80))))
            want.add((rows[-1][0], i))
    clean = [(1000 + d, " ".join(text(200))) for d in range(100)] + [(2000, " ".join(text(90) + items[0][-1:] + text(90)))]
    docs = spark.createDataFrame(rows + clean, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()} == want


def test_verbatim_copies_of_a_large_benchmark_are_all_found(spark):
    """Thousands of items, short ones too, of frequent words and with shared openings."""
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(6000)]
    weights = [1 / (r + 8) for r in range(len(vocabulary))]
    text = lambda n: rng.choices(vocabulary, weights, k=n)
    opening = text(9)
    items = {i: (opening if i % 5 == 0 else []) + text(rng.choice([9, 12, 20, 40, 59])) for i in range(2000)}
    rows = [(d, " ".join(text(60) + items[d] + text(60))) for d in range(500)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(5000, "zwei worte")], "item_id long, text string")
    rows += [(9000, " ".join(text(70)) + " zwei worte " + " ".join(text(70))), (9001, " ".join(text(70)) + " worte zwei")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spec = decontaminate.Spec(min_cosine=0.9)          # hardly a candidate of the latent space
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench, spec).collect()}
    assert {(d, d) for d in range(500)} | {(9000, 5000)} <= got and (9001, 5000) not in got


# ------------------------------------------------------------ PII

def test_pii_surrogates(spark):
    texts = ["Mail John.Smith@Mail.example.com, again JOHN.SMITH@mail.example.com and ann@mail.example.com.", "host 10.0.0.1 and 192.168.100.254",
             "card 4111 1111 1111 1111, 4111-1111-1111-1112 ok", "call +1 (743) 555-3824 or 555-123-4567", "iban DE89 3704 0044 0532 0130 00",
             "ssn 123-45-6789", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"###', "Mr John Smith met Mrs. Anna Smith", "г-жа. Анна Иванова здесь",
             None, "", "clean 12 words, 2024-01-02 at 10:30, version 1.2.3; a@b", "x " * 50_000 + "ann@mail.example.com"]
    df = spark.createDataFrame([(i, t, "k", 3) for i, t in enumerate(texts)] + [(5, texts[5], "k", 3), (None, texts[1], "k", 3)],
                               "doc_id long, text string, raw string, kind int")
    rows = pii.replace_pii(df, "key").collect()
    assert len(rows) == len(texts) + 2 and rows[0].asDict().keys() == {"doc_id", "text", "raw", "kind", "n_entities"}
    got = {r.doc_id: r for r in rows}
    assert [got[i].text for i in (9, 10, 11)] == [None, "", texts[11]]
    mails = re.findall(r"\S+@[\w.]+\w", got[0].text)
    assert mails[0].lower() == mails[1].lower() != mails[2] and mails[1][:4].isupper()
    assert {m.lower().split("@")[1] for m in mails} == {mails[2].split("@")[1]} and got[12].text.endswith(" " + mails[2])
    ips = got[1].text.split()[1::2]
    assert [[len(x) for x in ip.split(".")] for ip in ips] == [[2, 1, 1, 1], [3, 3, 3, 3]] and got[None].text == got[1].text

    def luhn(s):
        d = [int(x) for x in reversed(s) if x.isdigit()]
        return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10

    a, b = re.findall(r"4[\d -]{18}", got[2].text)
    assert luhn(a) == 0 != luhn(b) and a[4] == " " and b[4] == "-" and "4111" not in got[2].text
    assert re.fullmatch(r"call \+1 \([2-9]\d\d\) [2-9]\d\d-[2-9]\d{3} or [2-9]\d\d-[2-9]\d\d-[2-9]\d{3}", got[3].text) and "555-" not in got[3].text
    iban = got[4].text[5:].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4}", got[5].text) and got[5].text != texts[5]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"###', got[6].text)
    m = re.fullmatch(r"Mr (\w+) (\w+) met Mrs\. (\w+) (\w+)", got[7].text)
    assert m[2] == m[4] != "Smith" and m[3].endswith("na") and not m[1].endswith("na")
    assert re.fullmatch(r"г-жа\. [А-Я][а-я]+на [А-Я][а-я]+на здесь", got[8].text)
    assert [got[i].n_entities for i in range(13)] == [3, 2, 2, 2, 1, 1, 1, 2, 1, 0, 0, 0, 1]
    assert {r.text for r in pii.replace_pii(df, "key").collect()} == {r.text for r in rows} != {r.text for r in pii.replace_pii(df, "other").collect()}
    assert pii.replace_pii(df.limit(0), "key").count() == 0


def test_pii_surrogates_stay_distinct(spark):
    """All 8,100 addresses of one narrow format among few surrogates collide often."""
    rows = [(i, f"at 1{a}.2{b}.3.4") for i, (a, b) in enumerate((a, b) for a in range(10) for b in range(10))] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.replace_pii(df, "k").collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, set()).add(r.text)
    assert all(len(v) == 1 for v in by.values()) and len(set().union(*by.values())) == 100
    assert not {t for v in by.values() for t in v} & {t for _, t in rows}


def test_pii_more_names_than_short_surrogates(spark):
    """36 ** 3 + 36 ** 2 = 47,952 Cyrillic given names of up to three syllables."""
    units = spark.range(48_500).selectExpr("'given_m' AS kind", "concat('я', translate(cast(id as string), '0123456789', 'абвгдежзик')) AS canon")
    got = pii._settle(units, "k").agg(F.count("*"), F.countDistinct("surrogate"), F.count_if(F.col("canon") == F.col("surrogate"))).first()
    assert tuple(got) == (48_500, 48_500, 0)


def surrogates_of(spark, mentions, key="k"):
    """The written surrogate of each mention, one mention a text."""
    df = spark.createDataFrame(list(enumerate(mentions)), "doc_id long, text string")
    return {mentions[r.doc_id]: r.text for r in pii.replace_pii(df, key).collect()}


def test_pii_ten_thousand_domains_of_one_shape(spark):
    code = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    mails = [f"ann@{code(37 * i)}mail.com" for i in range(10_000)]
    got = surrogates_of(spark, mails)
    domains = {m.split("@")[1] for m in got.values()}
    assert len(domains) == 10_000 and not domains & {m.split("@")[1] for m in mails} and all(d.endswith(".com") for d in domains)


def test_pii_addresses_of_a_used_up_format(spark):
    """All one-letter and two-letter addresses at one domain, and all domains of one letter."""
    letters = [chr(97 + i) for i in range(26)]
    mails = [f"{a}@mail.com" for a in letters] + [f"{a}{b}@mail.com" for a in letters for b in letters] + [f"x.y@{a}.org" for a in letters]
    got = surrogates_of(spark, mails)
    assert len(set(got.values())) == len(mails) == 728 and not set(got.values()) & set(mails)
    assert len({m.split("@")[1] for m in got.values()}) == 27


def test_pii_map_from_entities_to_surrogates_is_one_to_one(spark):
    """Every type at once, with formats narrow enough to collide: brute-force check of the written results."""
    entities = ([f"u{i}@d{i % 40}.net" for i in range(400)] + [f"10.0.{i}.1" for i in range(150)] + [f"{i:03}-55-1{i:03}" for i in range(300)]
                + [f"(2{i:02}) 555-0{i:03}" for i in range(100)] + [f"password={i:06}" for i in range(300)] + [f"::{i:x}1" for i in range(15)]
                + [f"Ms. Ana{chr(97 + i % 26)}{chr(97 + i // 26)} Lee" for i in range(300)] + ["2001:db8::1", "fe80::1:2", "00:1b:44:11:3a:b7"])
    got = surrogates_of(spark, entities)
    assert len(set(got.values())) == len(entities) and not set(got.values()) & set(entities)


def test_pii_names_are_carried_to_mentions_without_title(spark):
    texts = ["Ms. Jane Doe came. Later Jane Doe left, and Jane Doering stayed.", "Dr. Jane Doe spoke to Mr. Jane Roe.", "Dr. Mary Poe, Mrs. Mary Poe, Mary Poe",
             "Jane Doe without a title"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace_pii(df, "k").collect()}
    first = re.fullmatch(r"Ms\. (\w+ \w+) came\. Later (\w+ \w+) left, and Jane Doering stayed\.", got[0].text)
    assert first[1] == first[2] != "Jane Doe" and got[0].n_entities == 2
    second = re.fullmatch(r"Dr\. (\w+ \w+) spoke to Mr\. (\w+) (\w+)\.", got[1].text)
    assert second[1] == first[1] and second[2] == first[1].split()[0]          # one given name, one surrogate, after any title
    third = re.fullmatch(r"Dr\. (\w+ \w+), Mrs\. (\w+ \w+), (\w+ \w+)", got[2].text)
    assert third[1] == third[2] == third[3] and third[1].split()[0].endswith("na")
    assert got[3].text == texts[3]                                             # as the docstring says


def test_pii_one_phone_number_in_several_spellings(spark):
    ways = ["+1 (743) 555-3824", "(743) 555-3824", "743.555.3824", "7435553824", "+17435553824", "+1-743-555-3824"]
    got = surrogates_of(spark, ways)
    digits = {re.sub(r"\D", "", got[w])[-10:] for w in ways}
    assert len(digits) == 1 and digits != {"7435553824"}
    assert [re.sub(r"\d", "0", got[w]) for w in ways] == [re.sub(r"\d", "0", w) for w in ways]
    assert surrogates_of(spark, ["id 1735553824, 12345678901"]) == {"id 1735553824, 12345678901": "id 1735553824, 12345678901"}


def test_pii_chinese_names_and_short_ip_addresses(spark):
    got = surrogates_of(spark, ["昨天王伟先生来了", "李小龙博士", "to 2001:db8::1 and ::1", "std::vector a::b 10:30"])
    assert re.fullmatch(r"昨天\w{2}先生来了", got["昨天王伟先生来了"]) and "王伟" not in got["昨天王伟先生来了"]
    assert re.fullmatch(r"\w{3}博士", got["李小龙博士"]) and got["李小龙博士"] != "李小龙博士"
    assert re.fullmatch(r"to [0-9]{4}:[0-9a-f]{3}::[0-9] and ::[0-9]", got["to 2001:db8::1 and ::1"]) and "2001:db8" not in got["to 2001:db8::1 and ::1"]
    assert got["std::vector a::b 10:30"] == "std::vector a::b 10:30"


def test_pii_clashing_columns(spark):
    df = spark.createDataFrame([("a@b.com", 1, "x", 2, 3), (None, 1, "x", 2, 3)], "text string, row long, found string, n_entities int, of int")
    got = pii.replace_pii(df, "k").collect()
    assert sorted(r.n_entities for r in got) == [0, 1] and all((r.row, r.found, r.of) == (1, "x", 3) for r in got)


# ------------------------------------------------------------ pipeline

@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
def test_pipeline_stages(spark):
    import corpus_pipeline
    from casemart.llm.common import read
    from casemart.session import stage_table

    docs = read(spark, SMALL, "documents")
    bad = spark.createDataFrame([(10**6, None, None, None, None), (None, "null id " * 30, "en", "s", 240)], docs.schema)
    now, seen = stage_table(docs.unionByName(bad), "test"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in now.collect()}
        now = stage_table(stage(spark, now, SMALL), "test")
        after = {r.doc_id: r for r in now.collect()}
        seen[name] = (before, after)
        assert set(after) <= set(before) and len(after) == now.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
    kept = components_by_scan([(i, r.text) for i, r in seen["near_dedup"][0].items()], 5)
    assert set(seen["near_dedup"][1]) - {None} == {i for i, (_, c) in kept.items() if i == c}
    before, after = seen["decontaminate"]
    flat = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = [flat(r.text) for r in read(spark, SMALL, "benchmark").collect()]
    assert set(before) - set(after) == {i for i, r in before.items() if i is not None and any(x in flat(r.text) for x in items)}
    before, after = seen["pii"]
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.n_chars == (len(r.text) if r.text != before[i].text else before[i].n_chars)
        assert not set(re.findall(r"\b\d{13,16}\b|\S+@\S+\w", before[i].text or "")) & set(re.findall(r"\b\d{13,16}\b|\S+@\S+\w", r.text or ""))
    labels = {r.doc_id: r.quality for r in read(spark, SMALL, "labels").collect()}
    before, after = seen["quality"]
    right = [labels[i] == int(i in after) for i in labels if i in before]
    assert sum(right) >= 0.9 * len(right)
    assert corpus_pipeline.run(spark, SMALL).count() > 0
