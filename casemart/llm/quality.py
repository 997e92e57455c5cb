"""Quality classifier on subword embeddings.

A document's features are its words, word pairs and character n-grams (bytes,
case kept), hashed into one table of learned vectors; their average goes
through a softmax.  Pairs of a word with itself share one vector, whatever the
word, so stuttering text is recognised by it.  Vectors and output weights are learned together by
stochastic gradient descent in numpy, one document a step.

The classifier is fitted on a bounded sample of the labelled rows
(``train_rows`` of them, those with the smallest id hashes, whole texts) in one
task.  Scoring covers every text: as the average is linear, the output weights
are folded into one logit per feature bucket, so a text's score is a mean over
a broadcast table of ``2 ** bits`` floats.

Edge cases: a null or empty text has no features and gets the score of the
output bias alone.  Labels that are null, or whose document is missing, are not
learned; the smallest label counts where an id has several, the smallest text
where several rows share an id (one row an id is learned).  Without any label
to learn from, every score is 0.5.  Repeated rows are scored one by one; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import field_type, fold, mix, query, read, span_hashes, text_chunks, utf8, words, worker_tables

_STEP = np.uint64(0x9FB21C651E98DF25)


@dataclass(frozen=True)
class Recipe:
    train_rows: int = 6000
    bits: int = 17
    dim: int = 16
    grams: tuple[int, ...] = (3, 5)
    epochs: int = 6
    rate: float = 1.0
    decay: float = 0.02      # share of the rate that is left at the end
    seed: int = 7


def feature_families(data: np.ndarray, offsets: np.ndarray, grams: tuple[int, ...], bits: int):
    """``(buckets, rows' first positions, weight of each position or None)`` per kind of feature."""
    shift = np.uint64(64 - bits)
    starts, ends, rows = words(data, offsets)
    h = span_hashes(data, starts, ends)
    first = np.searchsorted(rows, np.arange(len(offsets)))
    yield (mix(h) >> shift).astype(np.int32), first, None
    if len(h) > 1:
        pair = np.where(h[:-1] == h[1:], _STEP, mix(h[:-1] * _STEP + h[1:]))
        yield (pair >> shift).astype(np.int32), np.minimum(first, len(pair)), rows[:-1] == rows[1:]
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    for n in grams:
        code = padded[:len(data)].astype(np.uint64)
        for k in range(1, n):
            code |= padded[k:len(data) + k].astype(np.uint64) << np.uint64(8 * k)
        code = (code + np.uint64(n << 56)) * _STEP
        code ^= code >> np.uint64(32)
        code *= np.uint64(0x9E3779B97F4A7C15)
        inside = np.ones(len(data), bool)
        for k in range(1, n):
            last = offsets[1:] - k
            inside[last[last >= offsets[:-1]]] = False
        yield (code >> shift).astype(np.int32), offsets, inside


def document_features(data: np.ndarray, offsets: np.ndarray, recipe: Recipe) -> list[np.ndarray]:
    """All buckets of every document, repeated as often as they occur."""
    parts = [[] for _ in range(len(offsets) - 1)]
    for buckets, at, inside in feature_families(data, offsets, recipe.grams, recipe.bits):
        for i, (a, z) in enumerate(zip(at, at[1:])):
            parts[i].append(buckets[a:z] if inside is None else buckets[a:z][inside[a:z]])
    return [np.concatenate(p) for p in parts]


def fit(texts: pa.Array, labels: np.ndarray, recipe: Recipe) -> np.ndarray:
    """Learned logits (label 1 against 0) of the buckets, the bias last."""
    docs = []
    for _, _, data, offsets in text_chunks(texts):
        for f in document_features(data, offsets, recipe):
            bucket, times = np.unique(f, return_counts=True)
            docs.append((bucket, (times / max(1, len(f))).astype(np.float32)))
    rng = np.random.default_rng(recipe.seed)
    vectors = rng.uniform(-1, 1, (1 << recipe.bits, recipe.dim)).astype(np.float32) / recipe.dim
    out, bias = np.zeros((2, recipe.dim), np.float32), np.zeros(2, np.float32)
    step, steps = 0, recipe.epochs * len(docs)
    for _ in range(recipe.epochs):
        for i in rng.permutation(len(docs)):
            rate = np.float32(recipe.rate * max(recipe.decay, 1 - step / steps))
            step += 1
            bucket, share = docs[i]
            rows = vectors[bucket]
            x = share @ rows
            z = out @ x + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            vectors[bucket] = rows - np.outer(share * (rate * len(bucket) ** 0.5), p @ out)
            out -= rate * np.outer(p, x)
            bias -= np.float32(0.1) * rate * p
    logits = vectors @ (out[1] - out[0])
    return np.append(logits, bias[1] - bias[0]).astype(np.float32)


def score_chunk(data: np.ndarray, offsets: np.ndarray, logits: np.ndarray, recipe: Recipe) -> np.ndarray:
    total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    for buckets, at, inside in feature_families(data, offsets, recipe.grams, recipe.bits):
        value = logits[buckets].astype(float)
        if inside is not None:
            value *= inside
            n = np.concatenate([[0], np.cumsum(inside)])
            count += n[at[1:]] - n[at[:-1]]
        else:
            count += np.diff(at)
        upto = np.concatenate([[0.0], np.cumsum(value)])
        total += upto[at[1:]] - upto[at[:-1]]
    return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + logits[-1])))


def train(docs: DataFrame, labels: DataFrame, recipe: Recipe) -> np.ndarray:
    """Fit on the sample of ``labels`` (doc_id, label) that the recipe bounds."""
    chosen = (labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(recipe.train_rows))
    # at most train_rows ids, a row each
    sample = (docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
              .agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), "label")).alias("row"))
              .select("doc_id", "row.text", "row.label"))

    def learn(batches):
        worker_tables("quality")
        texts, y = [], []
        for b in batches:
            texts.append(utf8(b.column(1)))
            y.append(b.column(0).to_numpy())
        if texts:
            logits = fit(pa.concat_arrays(texts), np.concatenate(y), recipe)
            yield pa.RecordBatch.from_arrays([pa.array([logits.tobytes()])], names=["logits"])

    model = (sample.repartition(1).sortWithinPartitions("doc_id", "label", "text").select("label", "text")
             .mapInArrow(learn, "logits binary").first())
    return np.frombuffer(model.logits, np.float32) if model else np.zeros((1 << recipe.bits) + 1, np.float32)


def score_documents(df: DataFrame, logits: np.ndarray, recipe: Recipe = Recipe(), text_col: str = "text",
                    score_col: str = "score") -> DataFrame:
    """``df`` with every row's score; all columns and rows stay."""
    shared, at = df.sparkSession.sparkContext.broadcast(logits), df.columns.index(text_col)

    def score(batches):
        worker_tables("quality")
        for b in batches:
            parts = [score_chunk(data, offsets, shared.value, recipe) for _, _, data, offsets in text_chunks(b.column(at), 2 << 20)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))],
                                             names=[*b.schema.names, score_col])

    return df.mapInArrow(score, ", ".join(f"`{c}` {field_type(df, c)}" for c in df.columns) + f", `{score_col}` double")


def learn_quality(df: DataFrame, labels: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", modulus: int = 4, held: int = 2) -> np.ndarray:
    """The classifier, from labels whose ``crc32(id as text) % modulus`` is not ``held``."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.filter(fold(id_col, modulus) != held).select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
    return train(docs, known, recipe)


def quality_scores(df: DataFrame, labels: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", modulus: int = 4, held: int = 2, threshold: float = 0.7) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row of ``df``."""
    logits = learn_quality(df, labels, recipe, id_col, text_col, label_col, modulus, held)
    scored = score_documents(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), logits, recipe)
    return scored.select(F.col("doc_id").alias(id_col), (fold("doc_id", modulus) == held).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


@query("op6_quality_classifier")
def op6_quality_classifier(spark, sf_dir):
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
