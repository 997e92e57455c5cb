"""Language-model scores of documents by a hashed maximum-entropy model.

The model predicts each token from its history in factors: the token's class by
a softmax over hashed features of the history (the word before, the words two
and three before it as skips, and the pair before); then, by a second softmax
over features of the class and its history (the word before, the word two
before), the leaf within the class; and the token within its leaf by add-one
relative frequency.  Classes are the end of text, the most frequent words (one
each) and the remaining words by their endings.  The most frequent words of an
ending have a leaf each, so their probability comes from the history alone; the
other words of the ending are dealt to ``tails`` leaves by their hashes.

Steps, each a Spark job over all documents:

1. ``token_table`` reads the texts once.  A row holds a chunk of documents:
   its distinct words, how often training documents have each, and the tokens
   as indices into them.  It is written to the shared folder.
2. Word counts of the training documents: one row per chunk and distinct word,
   pre-aggregated that way, summed by word.  Counts never leave the executors;
   the driver sees totals, the words with a class or leaf of their own and one
   row per leaf.
3. Training goes over every training token once, in ``rounds`` parts.  In a
   round each task makes stochastic gradient steps from the broadcast weights
   through its chunks; the changes are averaged (weighted by tokens) in a
   tree of partial sums, and only the mean comes to the driver: ``2 ** bits x
   (classes + leaves)`` numbers, whatever the size of the data.
4. Scoring: counts are joined back to (chunk, word) rows and dealt to their
   chunks; a chunk's tokens are scored in sparse numpy batches.

Training documents are those whose ``crc32(id as text) % modulus`` is not
``held``.  Unknown words count as one word of their leaf, so probabilities
sum to one.  Weights depend on which documents share a chunk and a task, so
scores change a little when the files are split otherwise; counts and base
scores do not.

Edge cases: a null or empty text has one token, the end.  A null id hashes as
''.  With nothing to learn from, N and V are 0 and weights stay 0.  Repeated
rows are counted and scored one by one; extra columns are ignored.  Distinct
words of a chunk are told apart by 64-bit hashes, across chunks by their bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.common import add_blocks, fold, lower_ascii, mix, query, read, span_hashes, spans, text_chunks, words
from casemart.session import stage_table

_STEP = np.uint64(0x9FB21C651E98DF25)
#: The end of a text; no word holds white space.
END = b"\n"


@dataclass(frozen=True)
class MaxEnt:
    bits: int = 13           # feature buckets: 2 ** bits, more for many tokens
    most_bits: int = 16
    head: int = 31           # words with a class of their own
    endings: int = 32        # classes of all other words
    own: int = 24            # words of an ending with a leaf of their own
    tails: int = 8           # leaves of an ending's other words
    rounds: int = 2
    rate: float = 0.3
    batch: int = 8192
    chunk_bytes: int = 8 << 20

    @property
    def classes(self) -> int:
        return 1 + self.head + self.endings

    @property
    def leaves(self) -> int:
        return self.own + self.tails

    def grown(self, tokens: int) -> MaxEnt:
        """Twice the buckets for four times the tokens, from 2 ** 26 tokens on."""
        return replace(self, bits=max(self.bits, min(self.most_bits, self.bits + (tokens.bit_length() - 27) // 2)))


def token_table(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """``(chunk, doc_ids, held, ends, words, seen, tokens)`` from (doc_id, held, text)."""
    names = ["chunk", "doc_ids", "held", "ends", "words", "seen", "tokens"]

    def run(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for b in batches:
            for row, end, data, offsets in text_chunks(b.column(2), chunk_bytes):
                data = lower_ascii(data)
                starts, ends, rows = words(data, offsets)
                _, first, index, times = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True,
                                                   return_counts=True)
                by = np.argsort(-times, kind="stable")                        # frequent words get small numbers
                first, index = first[by], np.argsort(by)[index]
                n = end - row
                count = np.bincount(rows, minlength=n)
                upto = np.cumsum(count + 1)
                tokens = np.full(int(upto[-1]), len(first), np.int32)             # the end is the last word
                tokens[np.arange(len(index)) + rows] = index
                length = np.append(ends[first] - starts[first], len(END))
                blob = np.concatenate([data[spans(starts[first], length[:-1])], np.frombuffer(END, np.uint8)])
                names_of = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(
                    np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.py_buffer(blob)])
                held = b.column(1).slice(row, n)
                learn = np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), count + 1)
                seen = np.bincount(tokens[learn], minlength=len(length))

                def one(values: pa.Array) -> pa.Array:
                    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), one(b.column(0).slice(row, n)), one(held), one(pa.array(upto, pa.int64())), one(names_of),
                     one(pa.array(seen, pa.int64())), pa.array([_narrow(tokens)], pa.binary())], names=names)
                chunk += 1

    return docs.mapInArrow(run, "chunk long, doc_ids array<long>, held array<boolean>, ends array<long>, words array<binary>, "
                                "seen array<long>, tokens binary")


def _narrow(tokens: np.ndarray) -> bytes:
    """Token numbers as four compressed planes of bytes; the high ones are mostly zeros."""
    return pa.compress(np.ascontiguousarray(tokens.astype(np.int32).view(np.uint8).reshape(-1, 4).T), "zstd", asbytes=True)


def _wide(planes: bytes, n: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(planes, 4 * n, "zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(4, n).T).view(np.int32).ravel()


class Vocabulary:
    """Classes, leaves and history features of words, by their bytes alone."""

    def __init__(self, spec: MaxEnt, head: list[bytes]):
        self.spec = spec
        self.head = {w: 1 + i for i, w in enumerate(head)}
        self.head[END] = 0
        self.own: dict[bytes, int] = {}         # the leaf of a word that has one

    def classes(self, names: pa.Array) -> np.ndarray:
        data, offsets = _bytes_of(names)
        start = np.maximum(offsets[1:] - 3, offsets[:-1])
        tail = span_hashes(data, start, offsets[1:])
        out = (1 + self.spec.head + tail % np.uint64(self.spec.endings)).astype(np.int64)
        return _overlay(out, span_hashes(data, offsets[:-1], offsets[1:]), names, self.head)

    def leaves(self, names: pa.Array) -> np.ndarray:
        data, offsets = _bytes_of(names)
        full = span_hashes(data, offsets[:-1], offsets[1:])
        out = (self.spec.own + (mix(full) >> np.uint64(40)) % np.uint64(self.spec.tails)).astype(np.int64)
        return _overlay(out, full, names, self.own)

    def past(self, names: pa.Array, tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Word hashes, and for one to three steps back the word there of every token."""
        data, offsets = _bytes_of(names)
        h = np.append(span_hashes(data, offsets[:-1], offsets[1:]), np.uint64(12345))     # the last stands before a text
        begin = np.concatenate([[0], ends[:-1]])
        before = []
        for k in (1, 2, 3):
            back = np.full(len(tokens), len(h) - 1, np.int32)
            back[k:] = tokens[:-k] if len(tokens) > k else tokens[:0]
            for j in range(k):                      # the first k tokens of every text
                back[np.minimum(begin + j, ends - 1)[ends - begin > j]] = len(h) - 1
            before.append(back)
        return h, before

    def features(self, names: pa.Array, tokens: np.ndarray, ends: np.ndarray, past=None, at=slice(None)) -> np.ndarray:
        """Buckets of the history of the tokens ``at``, one row per feature."""
        h, before = past or self.past(names, tokens, ends)
        shift = np.uint64(64 - self.spec.bits)
        out = [(mix(h * np.uint64(2 * k + 3) + np.uint64(k)) >> shift).astype(np.uint16)[back[at]] for k, back in enumerate(before)]
        out.append((mix(h[before[0][at]] * _STEP + h[before[1][at]]) >> shift).astype(np.uint16))
        return np.stack(out)

    def leaf_features(self, names: pa.Array, tokens: np.ndarray, ends: np.ndarray, at: np.ndarray, classes: np.ndarray, past=None) -> np.ndarray:
        """Buckets of the class and its history for the tokens ``at``; the first is the class alone."""
        h, before = past or self.past(names, tokens, ends)
        out = [classes.astype(np.uint16)]
        for k, back in enumerate(before[:2]):
            key = mix(h[back[at]] * _STEP + (classes * 4 + k).astype(np.uint64))
            out.append((self.spec.classes + (key >> np.uint64(32)) % np.uint64((1 << self.spec.bits) - self.spec.classes)).astype(np.uint16))
        return np.stack(out)


def _overlay(out: np.ndarray, full: np.ndarray, names: pa.Array, table: dict[bytes, int]) -> np.ndarray:
    """``out`` with the table's number for every word that stands in it."""
    if table:
        data, offsets = _bytes_of(pa.array(list(table), pa.binary()))
        known = np.sort(span_hashes(data, offsets[:-1], offsets[1:]))
        at = np.minimum(np.searchsorted(known, full), len(known) - 1)
        for i in np.flatnonzero(known[at] == full):
            out[i] = table.get(names[int(i)].as_py(), out[i])
    return out


def _bytes_of(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    a = names.cast(pa.large_binary())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def class_logits(weights: np.ndarray, bias: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    z = np.take(weights, buckets[0], axis=0, mode="clip")
    one = np.empty_like(z)
    for b in buckets[1:]:
        z += np.take(weights, b, axis=0, out=one, mode="clip")
    z += bias
    high = z.max(initial=0)
    # one shift for all rows keeps every exponential above zero unless the logits lie far apart
    z -= high if high - z.min(initial=0) < 80 else z.max(1, keepdims=True)
    return z


def group_sums(values: np.ndarray, by: np.ndarray, first: np.ndarray, few: int = 8) -> np.ndarray:
    """Sums of the rows ``values[by]`` from each ``first`` to the next: small
    groups a row at a time for all of them, the others by a product."""
    count = np.diff(first, append=len(by))
    out = values[by[first]]
    live = np.flatnonzero((count > 1) & (count <= few))
    k = 1
    while len(live):
        out[live] += values[by[first[live] + k]]
        k += 1
        live = live[count[live] > k]
    ones = np.ones(count.max(initial=0), values.dtype)
    for i in np.flatnonzero(count > few):
        out[i] = ones[:count[i]] @ values[by[first[i]:first[i] + count[i]]]
    return out


def sgd(weights: np.ndarray, bias: np.ndarray, power: np.ndarray, buckets: np.ndarray, target: np.ndarray, spec: MaxEnt,
        rng: np.random.Generator) -> None:
    """One pass of adaptive gradient steps over the tokens, in place."""
    steps = -(-len(target) // spec.batch)
    ones = np.ones(weights.shape[1], np.float32)
    for at in rng.permutation(steps):
        b, y = buckets[:, at::steps], target[at::steps]         # spread over the chunk
        p = class_logits(weights, bias, b)
        np.exp(p, out=p)
        p /= (p @ ones)[:, None]
        p[np.arange(len(y)), y] -= 1
        bias -= np.float32(spec.rate / len(y)) * (np.ones(len(y), np.float32) @ p)
        for row in b:
            by = np.argsort(row, kind="stable")
            key = row[by]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            g = group_sums(p, by, first)
            u = key[first]
            power[u] += np.einsum("ij,ij->i", g, g)
            g *= (np.float32(spec.rate) / np.sqrt(power[u] + 1))[:, None]
            weights[u] -= g


def log_chance(weights: np.ndarray, bias: np.ndarray, buckets: np.ndarray, target: np.ndarray, batch: int) -> np.ndarray:
    """Natural logarithm of the softmax at every target."""
    out, ones = np.empty(len(target)), np.ones(weights.shape[1], np.float32)
    for at in range(0, len(target), batch):
        z = class_logits(weights, bias, buckets[:, at:at + batch])
        mine = z[np.arange(len(z)), target[at:at + batch]]
        np.exp(z, out=z)
        out[at:at + len(z)] = mine - np.log(z @ ones)
    return out


def _one(batch: pa.RecordBatch, i: int):
    """The columns of one chunk row as numpy and Arrow values."""
    get = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
    ends = get["ends"][i].values.to_numpy()
    tokens = _wide(get["tokens"][i].as_py(), int(ends[-1]))
    return get, get["words"][i].values, ends, tokens


class Model:
    """Weights and vocabulary statistics, all bounded by the specification."""

    def __init__(self, spec: MaxEnt, table: DataFrame, counts: DataFrame):
        self.spec, self.table, self.counts = spec, table, counts
        self.sc = table.sparkSession.sparkContext
        head = counts.filter(F.col("word") != F.lit(END)).orderBy(F.col("c").desc(), "word").limit(spec.head).collect()
        self.vocabulary = Vocabulary(spec, [bytes(r.word) for r in head])
        vocabulary = self.vocabulary

        first = 1 + spec.head

        def classed(batches):
            """Of each task the sums by class and tail leaf, and the most frequent words of every ending."""
            sums = np.zeros((2, spec.classes * spec.tails), np.int64)
            best = pa.table([pa.array([], t) for t in (pa.binary(), pa.int64(), pa.int64(), pa.int64())], names=["word", "c", "k", "leaf"])
            for b in batches:
                c, k = b.column(1).to_numpy(), vocabulary.classes(b.column(0))
                leaf = np.where(k < first, 0, vocabulary.leaves(b.column(0)) - spec.own)
                for total, x in zip(sums, (c, np.ones_like(c))):
                    np.add.at(total, k * spec.tails + leaf, x)
                some = np.flatnonzero(k >= first)
                rows = pa.table([b.column(0).take(pa.array(some)), c[some], k[some], leaf[some]], names=best.column_names)
                best = pa.concat_tables([best, rows]).sort_by([("k", "ascending"), ("c", "descending"), ("word", "ascending")])
                key = best["k"].to_numpy()
                begin = np.searchsorted(key, key)
                best = best.filter(pa.array(np.arange(len(key)) - begin < spec.own)).combine_chunks()
            at = np.flatnonzero(sums[1])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.binary()), *map(pa.array, (sums[0, at], at // spec.tails, at % spec.tails, sums[1, at]))],
                                             names=["word", "c", "k", "leaf", "v"])
            yield from best.append_column("v", pa.array(np.ones(len(best), np.int64))).to_batches()

        found = stage_table(counts.mapInArrow(classed, "word binary, c long, k long, leaf long, v long"), "classed-words")
        top = Window.partitionBy("k").orderBy(F.col("c").desc(), "word")
        own = (found.filter("word IS NOT NULL").withColumn("at", F.row_number().over(top)).filter(F.col("at") <= spec.own)
               .select("word", "c", "k", "leaf", "at").collect())                          # endings * own words
        rows = found.filter("word IS NULL").groupBy("k", "leaf").agg(F.sum("c"), F.sum("v")).collect()     # classes * tails
        self.tokens_of, self.types_of = np.zeros((2, spec.classes, spec.leaves))
        for k, leaf, c, v in rows:
            at = leaf + spec.own if k >= first else 0
            self.tokens_of[k, at], self.types_of[k, at] = c, v
        for r in own:               # from the tail leaf to one of its own
            for total, x in ((self.tokens_of, r.c), (self.types_of, 1)):
                total[r.k, spec.own + r.leaf] -= x
                total[r.k, r["at"] - 1] = x
        vocabulary.own = {bytes(r.word): r["at"] - 1 for r in own}
        self.n, self.v = int(self.tokens_of.sum()), int(self.types_of.sum())
        self.spec = vocabulary.spec = spec = spec.grown(self.n)
        size, whole = 1 << spec.bits, self.tokens_of.sum(1)
        # (weights, bias) of the classes, then of the leaves: a class's first bucket is its bias
        self.weights = [np.zeros((size, spec.classes), np.float32), np.log((whole + 1) / (self.n + spec.classes)).astype(np.float32),
                        np.zeros((size, spec.leaves), np.float32), np.zeros(spec.leaves, np.float32)]
        start = np.log((self.tokens_of + 1) / (whole[:, None] + spec.leaves))
        start[:, :spec.own][self.types_of[:, :spec.own] == 0] = -30           # no word can stand there
        self.weights[2][:spec.classes] = start

    def train(self) -> None:
        for r in range(self.spec.rounds):
            self._round(r)

    def _round(self, r: int) -> None:
        spec, vocabulary, parts = self.spec, self.vocabulary, 16
        now = self.sc.broadcast(self.weights)

        def learn(batches):
            weights, bias, inner, inner_bias = state = [x.copy() for x in now.value]
            power, inner_power, n = np.zeros(len(weights), np.float32), np.zeros(len(inner), np.float32), 0
            for b in batches:
                for i in range(b.num_rows):
                    get, names, ends, tokens = _one(b, i)
                    use = np.repeat(~get["held"][i].values.to_numpy(zero_copy_only=False).astype(bool), np.diff(ends, prepend=0))
                    if use.any():
                        k = vocabulary.classes(names)[tokens]
                        past = vocabulary.past(names, tokens, ends)
                        x = vocabulary.features(names, tokens, ends, past, use)
                        rng = np.random.default_rng(get["chunk"][i].as_py() % (1 << 32))
                        sgd(weights, bias, power, x, k[use], spec, rng)
                        n += x.shape[1]
                        at = np.flatnonzero(use & (k > spec.head))
                        x = vocabulary.leaf_features(names, tokens, ends, at, k[at], past)
                        sgd(inner, inner_bias, inner_power, x, vocabulary.leaves(names)[tokens[at]], spec, rng)
            if n:
                change = np.concatenate([(x - y).ravel() for x, y in zip(state, now.value)])
                cuts = np.array_split(change, parts)
                yield pa.RecordBatch.from_arrays([pa.array(range(parts)), pa.array([n] * parts), pa.array([c.tobytes() for c in cuts])],
                                                 names=["part", "n", "value"])

        mine = self.table.filter(F.pmod("chunk", F.lit(spec.rounds)) == r).select("chunk", "held", "ends", "words", "tokens")
        sums = add_blocks(mine.mapInArrow(learn, "part long, n long, value binary"), mine.rdd.getNumPartitions(), parts, np.float32, mean=True)
        if sums:
            mean = np.concatenate([np.frombuffer(s.value) for s in sums]).astype(np.float32)
            cuts = np.split(mean, np.cumsum([x.size for x in self.weights])[:-1])
            self.weights = [x + c.reshape(x.shape) for x, c in zip(self.weights, cuts)]

    def score(self) -> DataFrame:
        spec, vocabulary = self.spec, self.vocabulary
        inside = np.log10(self.tokens_of + self.types_of + 1)
        inside[:, :spec.own] = 0
        inside[:1 + spec.head] = 0
        state = self.sc.broadcast((self.weights, inside))
        whole = float(np.log10(self.n + self.v + 1))
        known = (self.table.select(F.col("chunk").alias("of"), F.posexplode("words").alias("i", "word"))
                 .join(self.counts, "word").select("of", "i", "c"))
        kind = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                          ("base_score", pa.float64()), ("score", pa.float64())])

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            (weights, bias, inner, inner_bias), inside = state.value
            out = []
            for b in left.combine_chunks().to_batches():
                for i in range(b.num_rows):
                    get, names, ends, tokens = _one(b, i)
                    c = np.zeros(len(names), np.int64)
                    c[right["i"].to_numpy()] = right["c"].to_numpy()
                    share = np.log10(c + 1.0)
                    k, leaf = vocabulary.classes(names), vocabulary.leaves(names)
                    leaf[k <= spec.head] = 0
                    one = (k <= spec.head) | (leaf < spec.own)          # the only word of its class or leaf
                    within = np.where(one, 0, share) - inside[k, leaf]
                    kt = k[tokens]
                    past = vocabulary.past(names, tokens, ends)
                    p = log_chance(weights, bias, vocabulary.features(names, tokens, ends, past), kt, spec.batch)
                    at = np.flatnonzero(kt > spec.head)
                    p[at] += log_chance(inner, inner_bias, vocabulary.leaf_features(names, tokens, ends, at, kt[at], past), leaf[tokens[at]], spec.batch)
                    begin = np.concatenate([[0], ends[:-1]])
                    n = ends - begin
                    out.append(pa.table([
                        get["doc_ids"][i].values, get["held"][i].values, n, np.add.reduceat((c > 0)[tokens].astype(np.int64), begin),
                        np.add.reduceat(share[tokens], begin) - n * whole,
                        np.add.reduceat(p / np.log(10) + within[tokens], begin)], schema=kind))
            return pa.concat_tables(out) if out else kind.empty_table()

        scored = (self.table.select("chunk", "doc_ids", "held", "ends", "words", "tokens").groupBy("chunk")
                  .cogroup(known.groupBy("of"))
                  .applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
        return scored.withColumn("train_tokens", F.lit(self.n).cast("long"))


def lm_scores(df: DataFrame, spec: MaxEnt = MaxEnt(), id_col: str = "doc_id", text_col: str = "text", modulus: int = 7,
              held: int = 2) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row; scores are log10."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), (fold(id_col, modulus) == held).alias("held"),
                     F.col(text_col).alias("text"))
    table = stage_table(token_table(docs, spec.chunk_bytes), "tokens", compression="zstd")
    counts = (table.select(F.inline(F.arrays_zip("words", "seen"))).toDF("word", "c").filter("c > 0")
              .groupBy("word").agg(F.sum("c").alias("c")))
    model = Model(spec, table, stage_table(counts, "word-counts"))
    model.train()
    return model.score().select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op2_lm_scores")
def op2_lm_scores(spark, sf_dir):
    return lm_scores(read(spark, sf_dir, "documents"))
