"""Benchmark decontamination by latent semantic retrieval.

1. Words (lower case; runs of ASCII letters and digits or other characters) of
   whole documents are coded by the benchmark's vocabulary; a word that no
   benchmark text has is 0.  The coded documents are written once and read by
   the later steps.  Passages are windows of ``2 * stride`` words every
   ``stride`` words, so every benchmark part (at most ``part_words`` words)
   that a document holds lies whole in some passage.  Longer items have parts
   that overlap, so a copied excerpt long enough to be a leak lies whole in one.
2. Passages are TF-IDF vectors over the vocabulary (a term in more than
   ``max_df`` of the blocks weighs nothing, unless it is among the rarest
   ``least_terms`` of a part).  A randomised singular value decomposition of all
   passages, with the benchmark parts as further, weighted rows, gives the
   latent space: tasks multiply their passages with the broadcast random sketch
   and back, the products are added in a distributed sum, and the driver gets
   singular vectors from that one product (Nystrom's form): ``features x (rank
   + extra)`` numbers, however many passages there are.
   The rank grows with the benchmark parts while that is at most
   ``most_numbers`` numbers.
3. Candidates come by two ways.  One is a latent cosine with a benchmark part of
   at least ``min_cosine``: of the passage, and for parts of at most half, a
   quarter ... of the stride also of windows that much shorter, where other
   words dilute less.  The other is exact and does not depend on the latent
   space: a run of ``gram`` words that is kept for the part.  Kept are the
   rarest of any ``near`` neighbouring runs, unless more than ``common`` parts
   have it, and whatever else it takes that each stretch of the part that is
   long enough for a leak holds a kept run: a verbatim copy is always found.
   The text as long as the part around that run, and half as much on either
   side, is then compared.
4. A candidate is confirmed by its longest common subsequence with the part: a
   share of ``copied`` of the part's words is a leak, a share of ``similar``
   is one if the part's answer stands in the passage word for word (the answer
   is the words after the last "answer", else the closing words of the last
   sentence), which catches paraphrases.

The benchmark is broadcast; ``find_leaks`` refuses one of more than
``MAX_BENCHMARK_WORDS`` words.

Edge cases: null and empty texts and items have no words and no leaks; rows
without a doc_id (or item_id) take no part; an item of fewer than
``least_words`` words is matched word for word only; repeated rows give one
result; without documents or benchmark the result is empty; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.common import add_blocks, query, read, span_hashes, spans, text_chunks, utf8, words
from casemart.llm.shingles import _sequence_hash
from casemart.session import stage_table

MAX_BENCHMARK_WORDS = 20_000_000
_FLAT = np.full(256, 0x20, np.uint8)
_FLAT[128:] = np.arange(128, 256)
for _a, _z in ((48, 58), (97, 123)):
    _FLAT[_a:_z] = np.arange(_a, _z)
_FLAT[65:91] = np.arange(97, 123)


@dataclass(frozen=True)
class Spec:
    part_words: int = 64
    least_words: int = 8
    features: int = 1 << 16     # latent features: vocabulary codes modulo this
    rank: int = 176             # latent dimensions, or 7/8 of the parts if those are more
    extra: int = 16
    most_numbers: int = 3 << 22     # of the latent space: features x (rank + extra)
    max_df: float = 0.01
    least_terms: int = 8        # the rarest terms of a part that count whatever their frequency
    min_cosine: float = 0.4
    copied: float = 0.6
    similar: float = 0.45
    answer_words: int = 5
    gram: int = 4               # words of a run that makes a candidate
    near: int = 4               # runs of which the rarest is kept
    common: int = 64            # parts that may share a run kept for its rarity alone
    seed: int = 11


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a chunk's words and where each row's words begin."""
    flat = _FLAT[data]
    starts, ends, rows = words(flat, offsets)
    return span_hashes(flat, starts, ends), np.searchsorted(rows, np.arange(len(offsets)))


def _part_starts(n: int, spec: Spec) -> list[int]:
    """Where the parts of an item of ``n`` words begin: every run of words that
    is long enough to be a leak of a part lies whole in one of them."""
    last = max(0, n - spec.part_words)
    step = spec.part_words - math.ceil(spec.copied * spec.part_words) + 1
    return [*range(0, last, step), last] if n else []


class Benchmark:
    """Coded benchmark parts; everything here is bounded by the benchmark."""

    def __init__(self, items: list[tuple[int, str]], spec: Spec):
        texts = [t or "" for _, t in items]
        lower = pc.utf8_lower(pa.array(texts, pa.large_string()))
        seqs = []
        for _, _, data, offsets in text_chunks(lower):
            h, at = word_hashes(data, offsets)
            seqs += [h[a:z] for a, z in zip(at, at[1:])]
        self.words = np.unique(np.concatenate(seqs)) if seqs else np.zeros(0, np.uint64)
        table = 1 << max(10, int(2 * len(self.words)).bit_length())
        self.shift = np.uint64(64 - table.bit_length() + 1)
        order = (self.words >> self.shift).astype(np.int64)
        self.first = np.searchsorted(order, np.arange(table + 1))     # the words of each slot of a direct table
        self.parts, self.item, self.answer = [], [], []
        for (item, _), text, seq in zip(items, texts, seqs):
            coded = self.code(seq)
            answer = coded[len(coded) - self._answer_length(text, spec):]
            for at in _part_starts(len(coded), spec):
                self.parts.append(coded[at:at + spec.part_words])
                self.item.append(item)
                self.answer.append(answer)
        self.stride = max([16, *map(len, self.parts)])

    def code(self, h: np.ndarray) -> np.ndarray:
        """1 + position of each hash among the benchmark's words, else 0."""
        if not len(self.words):
            return np.zeros(len(h), np.int32)
        slot = (h >> self.shift).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.zeros(len(h), np.int32)
        live = np.flatnonzero(at < end)
        while len(live):
            hit = self.words[at[live]] == h[live]
            out[live[hit]] = at[live[hit]] + 1
            at[live] += 1
            live = live[~hit & (at[live] < end[live])]
        return out

    @staticmethod
    def _answer_length(text: str, spec: Spec) -> int:
        said = re.split(r"(?i)\banswer\b", text)
        tail = said[-1] if len(said) > 1 else re.split(r"[.!?]\s", text.strip())[-1]
        for _, _, data, offsets in text_chunks(pa.array([tail], pa.string())):
            return max(len(word_hashes(data, offsets)[0]), spec.answer_words)
        return spec.answer_words


def grams(codes: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(place, hash)`` of every run of ``width`` benchmark words within a document."""
    known = np.concatenate([[0], np.cumsum(codes > 0)])
    place = np.flatnonzero(known[width:] - known[:-width] == width)
    place = place[place + width <= ends[np.searchsorted(ends, place, "right")]]
    return place, _sequence_hash(codes.astype(np.uint64), place, width)


class Runs:
    """The kept runs of the parts by their hash; ``rarity`` of every code."""

    def __init__(self, parts: list[np.ndarray], rarity: np.ndarray, spec: Spec):
        lengths = np.array([len(p) for p in parts], np.int64)
        flat, ends = np.concatenate(parts) if parts else np.zeros(0, np.int32), np.cumsum(lengths)
        self.of: dict[int, tuple] = {}
        for width in sorted({min(spec.gram, int(n)) for n in lengths}):
            place, h = grams(flat, ends, width)
            part = np.searchsorted(ends, place, "right")
            mine = np.minimum(spec.gram, lengths[part]) == width
            place, h, part = place[mine], h[mine], part[mine]
            _, which = np.unique(h, return_inverse=True)
            shared = np.bincount(np.unique(which * len(parts) + part) // len(parts))[which] > spec.common
            rare = sum(rarity[flat[place + i]] for i in range(width))
            keep = np.zeros(len(h), bool)
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            for a, z in zip(edges, edges[1:]):
                least = max(1, math.ceil(spec.similar * lengths[part[a]]) - width + 1)      # runs of the shortest leak
                for size, value in ((spec.near, np.where(shared[a:z], -np.inf, rare[a:z])), (spec.part_words, rare[a:z] - 1e9 * shared[a:z])):
                    size = min(size, least, z - a)
                    best = a + np.arange(z - a - size + 1) + np.lib.stride_tricks.sliding_window_view(value, size).argmax(1)
                    keep[best[value[best - a] > -np.inf]] = True
            by = np.flatnonzero(keep)[np.argsort(h[keep], kind="stable")]
            self.of[width] = (h[by], part[by], place[by] - (ends - lengths)[part[by]])

    def find(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(place, part, start)``: where a part has a run of the documents, and where a whole copy of it would begin."""
        out = [(np.zeros(0, np.int64),) * 3]
        for width, (keys, part, offset) in self.of.items():
            place, h = grams(codes, ends, width)
            at = np.searchsorted(keys, h)
            hit = np.flatnonzero(np.append(keys, np.uint64(0))[at] == h) if len(keys) else at[:0]
            at, n = at[hit], np.searchsorted(keys, h[hit], "right") - at[hit]
            at, place = spans(at, n), np.repeat(place[hit], n)
            hit = np.stack([place, part[at], place - offset[at]])
            hit = hit[:, np.lexsort((hit[0], hit[2], hit[1]))]
            new = np.ones(hit.shape[1], bool)
            new[1:] = (hit[1:, 1:] != hit[1:, :-1]).any(0)
            out.append(tuple(hit[:, new]))
        return tuple(np.concatenate(x) for x in zip(*out))


def passages(codes: np.ndarray, ends: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, first, end, number)`` of the windows of every coded document.

    A document of n words has a window from every multiple of the stride that
    is not already the second half of the last one.
    """
    begin = np.concatenate([[0], ends[:-1]])
    n = ends - begin
    count = np.where(n > 0, np.maximum(1, -(-n // stride) - 1), 0)
    row = np.repeat(np.arange(len(n)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = begin[row] + number * stride
    return row, first, np.minimum(first + 2 * stride, ends[row]), number


def tfidf(codes: np.ndarray, first: np.ndarray, end: np.ndarray, weight: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(passage, feature, value)`` of unit rows, sorted by passage."""
    heavy = np.append(0, weight)[np.where(codes > 0, (codes - 1) % len(weight) + 1, 0)]
    some = np.flatnonzero(heavy)
    a, z = np.searchsorted(some, first), np.searchsorted(some, end)
    n = z - a
    at = some[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] if n.sum() else np.zeros(0, np.int64)
    size = len(weight)
    key = np.unique(np.repeat(np.arange(len(first)), n) * size + (codes[at].astype(np.int64) - 1) % size)
    passage, feature = key // size, key % size
    value = weight[feature]
    norm = np.sqrt(np.bincount(passage, value.astype(float) ** 2, minlength=len(first)))
    return passage, feature, (value / np.maximum(norm[passage], 1e-9)).astype(np.float32)


def project(sparse: tuple, basis: np.ndarray, rows: int) -> np.ndarray:
    passage, feature, value = sparse
    out = np.zeros((rows, basis.shape[1]), np.float32)
    if len(passage):
        first = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        out[passage[first]] = np.add.reduceat(basis[feature] * value[:, None], first, axis=0)
    return out


def back(sparse: tuple, latent: np.ndarray, total: np.ndarray) -> None:
    """Add the transposed product to ``total``."""
    passage, feature, value = sparse
    if len(passage):
        by = np.argsort(feature, kind="stable")
        f = feature[by]
        first = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
        total[f[first]] += np.add.reduceat(latent[passage[by]] * value[by, None], first, axis=0)


def _lists(b: pa.RecordBatch, most: int = 1 << 16):
    """``(first row, codes, ends)`` of a batch's coded documents, a bounded number of words at a time."""
    lists = b.column(1)
    off = lists.offsets.to_numpy().astype(np.int64)
    row = 0
    while row < b.num_rows:
        end = max(row + 1, int(np.searchsorted(off, off[row] + most, "right")) - 1)
        yield row, lists.values.slice(off[row], off[end] - off[row]).to_numpy(), off[row + 1:end + 1] - off[row]
        row = end


def _summed(coded: DataFrame, shape: tuple[int, ...], work) -> tuple[np.ndarray, int]:
    """Sum over all tasks of an array that ``work(codes, ends, total) -> rows``
    adds to, and the number of rows; only the sum comes to the driver."""
    parts, kind_of = 64, np.float32 if len(shape) > 1 else np.int64

    def run(batches):
        total, n = np.zeros(shape, kind_of), 0
        for b in batches:
            for _, codes, ends in _lists(b):
                n += work(codes, ends, total)
        if n:
            cuts = np.array_split(total, parts)
            yield pa.RecordBatch.from_arrays([pa.array(range(parts)), pa.array([n] * parts), pa.array([c.tobytes() for c in cuts])],
                                             names=["part", "n", "value"])

    blocks = coded.mapInArrow(run, "part long, n long, value binary")
    rows = add_blocks(blocks, coded.rdd.getNumPartitions(), parts, kind_of)
    if not rows:
        return np.zeros(shape), 0
    return np.concatenate([np.frombuffer(r.value).reshape(-1, *shape[1:]) for r in rows]), rows[0].n


def longest_common(masks: dict[int, int], size: int, window: list[int]) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each word of the part."""
    full = (1 << size) - 1
    state = full
    for word in window:
        m = masks.get(word)
        if m:
            u = state & m
            state = ((state + u) | (state - u)) & full
    return size - state.bit_count()


def _holds(window: np.ndarray, run: np.ndarray) -> bool:
    if not len(run) or len(run) > len(window):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(window, len(run)) == run).all(1).any())


def find_leaks(df: DataFrame, benchmark: DataFrame, spec: Spec = Spec(), id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, passage, cosine, lcs, share, answered)``: for every
    document and benchmark item that it leaks, the passage with the greatest share."""
    spark = df.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).filter("item IS NOT NULL").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > 2 * MAX_BENCHMARK_WORDS:
        raise ValueError("the benchmark is too large to broadcast; decontaminate against a part of it at a time")
    bench = Benchmark([tuple(r) for r in items.orderBy("item", "text").collect()], spec)
    shared = spark.sparkContext.broadcast(bench)
    stride = bench.stride
    m = max(1, min(spec.features, len(bench.words)))
    rank = max(spec.rank, min(len(bench.parts) * 7 // 8, spec.most_numbers // m - spec.extra))

    def code(batches):
        b0 = shared.value
        for b in batches:
            for row, end, data, offsets in text_chunks(pc.utf8_lower(utf8(b.column(1)))):
                h, at = word_hashes(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, end - row), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(b0.code(h), pa.int32()))],
                    names=["doc_id", "codes"])

    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL")
    coded = stage_table(docs.mapInArrow(code, "doc_id long, codes array<int>"), "coded-words")

    def block_terms(codes, ends, total):
        """Adds how many blocks of ``stride`` words have each feature."""
        begin = np.concatenate([[0], ends[:-1]])
        blocks = -(-(ends - begin) // stride)
        some = np.flatnonzero(codes)
        row = np.searchsorted(ends, some, "right")
        block = (np.cumsum(blocks) - blocks)[row] + (some - begin[row]) // stride
        key = np.unique(block * m + (codes[some].astype(np.int64) - 1) % m)
        total += np.bincount(key % m, minlength=m)
        return int(blocks.sum())

    df_of, n = _summed(coded, (m,), block_terms)
    rare = df_of <= spec.max_df * n
    for part in bench.parts:
        f = np.unique((part - 1) % m)
        rare[f[np.argsort(df_of[f], kind="stable")[:spec.least_terms]]] = True
    rarity = np.log((1 + n) / (1 + np.minimum(df_of, n)) + 1e-3)
    weight = np.where(rare, rarity, 0).astype(np.float32)
    runs = spark.sparkContext.broadcast(Runs(bench.parts, rarity[np.maximum(0, np.arange(len(bench.words) + 1) - 1) % m], spec))

    # benchmark rows: half of the energy of all passages
    lengths = np.array([len(p) for p in bench.parts], np.int64)
    ends = np.cumsum(lengths)
    own = tfidf(np.concatenate(bench.parts) if bench.parts else np.zeros(0, np.int32), ends - lengths, ends, weight)
    own_weight = np.float32(0.5 * max(1, n) / max(1, len(bench.parts)))

    def gram(basis: np.ndarray) -> np.ndarray:
        held = spark.sparkContext.broadcast((basis, weight))

        def work(codes, ends, total):
            basis, weight = held.value
            _, first, end, _ = passages(codes, ends, stride)
            sparse = tfidf(codes, first, end, weight)
            back(sparse, project(sparse, basis, len(first)), total)
            return len(first)

        total = _summed(coded, basis.shape, work)[0].astype(np.float32)
        mine = np.zeros(basis.shape, np.float32)
        back(own, project(own, basis, len(bench.parts)), mine)
        return total + own_weight * mine

    k = min(m, rank + spec.extra)
    sketch = np.linalg.qr(np.random.default_rng(spec.seed).standard_normal((m, k)))[0]
    product = gram(sketch.astype(np.float32)).astype(float)
    shift = 1e-6 * (np.linalg.norm(product) + 1e-9)
    product += shift * sketch
    core = sketch.T @ product
    root = np.linalg.cholesky((core + core.T) / 2 + shift * np.eye(k))
    latent = np.linalg.svd(np.linalg.solve(root, product.T).T, full_matrices=False)[0][:, :min(m, rank)].astype(np.float32)
    basis = spark.sparkContext.broadcast((latent, weight))

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    mine = spark.sparkContext.broadcast(unit(project(own, latent, len(bench.parts))))
    # windows of half, a quarter ... of a passage, each for the parts that fit them
    classes = []
    size = stride // 2
    while size >= spec.least_words and (lengths <= size).any():
        classes.append((size, np.flatnonzero((lengths <= size) & ((lengths > size // 2) | (size // 2 < spec.least_words)))))
        size //= 2
    names = ["doc_id", "item_id", "passage", "cosine", "lcs", "share", "answered"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.bool_()]

    def confirm(batches):
        b0, (latent, weight), parts, kept = shared.value, basis.value, mine.value, runs.value
        masks = []
        for part in b0.parts:
            masks.append({})
            for i, w in enumerate(part.tolist()):
                masks[-1][w] = masks[-1].get(w, 0) | 1 << i

        def latents(codes, first, end):
            return unit(project(tfidf(codes, first, end, weight), latent, len(first)))

        def near(codes, first, end, of):
            """``(window, part, cosine)`` of the windows that are near one of the parts ``of``."""
            out = [(np.zeros(0, np.int64), of[:0], np.zeros(0, np.float32))]
            for at in range(0, len(first), 4096):
                a, z = first[at:at + 4096], end[at:at + 4096]
                cosine = latents(codes[a[0]:z[-1]], a - a[0], z - a[0]) @ parts[of].T
                p, k = np.nonzero(cosine >= spec.min_cosine)
                out.append((at + p, of[k], cosine[p, k]))
            return (np.concatenate(x) for x in zip(*out))

        def candidates(codes, ends, doc, first, end):
            """``(passage, part, cosine, start, end)``: what is compared with a part, and in which passage."""
            last = np.cumsum(np.bincount(doc, minlength=len(ends))) - 1        # of each document
            p, k, cosine = near(codes, first, end, np.arange(len(parts)))
            yield p, k, cosine, first[p], end[p]

            def passage_of(place):
                d = np.searchsorted(ends, place, "right")
                begin = np.concatenate([[0], ends[:-1]])[d]
                return np.minimum(np.searchsorted(doc, d) + (place - begin) // stride, last[d])

            for size, of in classes:
                _, a, z, _ = passages(codes, ends, size)
                p, k, cosine = near(codes, a, z, of)
                yield passage_of(a[p]), k, cosine, a[p], z[p]
            place, k, start = kept.find(codes, ends)
            p, n = passage_of(place), lengths[k]
            some, which = np.unique(p, return_inverse=True)
            cosine = (latents(codes, first[some], end[some])[which] * parts[k]).sum(1)
            begin = np.concatenate([[0], ends[:-1]])[doc[p]]
            yield p, k, cosine, np.maximum(start - n // 2, begin), np.minimum(start + n + n // 2, ends[doc[p]])

        for b in batches:
            for row, codes, ends in _lists(b):
                doc, first, end, number = passages(codes, ends, stride)
                if not len(doc) or not len(parts):
                    continue
                out = []
                for p, k, cosine, starts, stops in candidates(codes, ends, doc, first, end):
                    for j, (i, k) in enumerate(zip(p, k)):
                        part, window = b0.parts[k], codes[starts[j]:stops[j]]
                        lcs = longest_common(masks[k], len(part), window.tolist())
                        share = lcs / len(part)
                        if share < min(spec.similar, spec.copied):
                            continue
                        answered = _holds(codes[min(first[i], starts[j]):max(end[i], stops[j])], b0.answer[k])
                        if share >= spec.copied and len(part) >= spec.least_words or share == 1 and _holds(window, part) \
                                or share >= spec.similar and answered and len(part) >= spec.least_words:
                            out.append((b.column(0)[int(row + doc[i])].as_py(), b0.item[k], int(number[i]), float(cosine[j]), lcs,
                                        share, answered))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    found = coded.mapInArrow(confirm, "doc_id long, item_id long, passage long, cosine double, lcs long, share double, answered boolean")
    first = Window.partitionBy("doc_id", "item_id").orderBy(F.col("share").desc(), F.col("cosine").desc(), "passage")
    return found.withColumn("rank__", F.row_number().over(first)).filter("rank__ = 1").drop("rank__")


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
