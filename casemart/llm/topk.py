"""Exact top-k by inner product over a pivot-distance index.

Every vector gets one more component that brings all of them to the greatest
norm M; then the largest inner product with a query is the smallest Euclidean
distance to it, and the triangle inequality applies.  The index keys a vector
by its nearest pivot and its distance to that pivot; distances are cut into
annuli, each with its least and greatest distance.  For a query at distance r
from a pivot, no vector of an annulus is nearer than the gap between r and the
annulus.

A query sorts the annuli by that bound and searches the nearest ones until
they hold k vectors besides its own; its k-th score then stops the expansion:
only annuli whose bound allows that score are searched.  All scores are exact
integers, so the result is that of brute force; bounds carry a slack for
rounding.

Distribution: the pivots are a bounded sample (the ``pivots`` rows with the
smallest id hashes), the annulus table has at most ``pivots * annuli`` rows.
Neighbouring annuli of a pivot form blocks of about ``block_rows`` vectors; an
annulus with more (say, a third of all rows with one vector) is salted into
several; queries are dealt in groups of ``block_queries``.  A task holds one
block and one group of queries; a block is copied to the groups that search
it and to no other.  How many blocks the bounds exclude depends on
the data: with unclustered vectors in many dimensions most are searched.

Edge cases: vectors null, or holding null or non-finite components, and rows
without an id take no part; shorter vectors count as padded with zeros; rows
that share an id count as one entry with its best score; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.common import ORACLE, query, read
from casemart.session import stage_table


def _matrix(lists: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list<long> column as a dense matrix, short rows padded with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    off = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]
    if (np.diff(off) == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    n = np.diff(off)
    out[np.repeat(np.arange(len(lists)), n), np.arange(len(flat)) - np.repeat(off[:-1] - off[0], n)] = flat
    return out


def _top(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query position, id, score)`` of the k best ids of every query row."""
    by = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], ids[by][1:] != ids[by][:-1]]))
    if len(first) < len(ids):       # rows that share an id: its best score
        scores, ids = np.maximum.reduceat(scores[:, by], first, axis=1), ids[by][first]
    out = []
    for i, row in enumerate(scores):
        keep = ids != own[i]
        if len(row) > 8 * k:        # everything that ties with or beats the k-th id, the own aside
            floor = np.partition(row[keep], -min(k, keep.sum()))[-min(k, keep.sum())] if keep.any() else 0
            keep &= row >= floor
        at = np.flatnonzero(keep)
        at = at[np.lexsort((ids[at], -row[at]))][:k]
        out.append((np.full(len(at), i), ids[at], row[at]))
    return tuple(np.concatenate(x) for x in zip(*out))


class PivotIndex:
    def __init__(self, vectors: DataFrame, pivots: int = 32, annuli: int = 64, block_rows: int = 4096):
        """``vectors``: (vec_id long, vec array<long>), every row to be indexed."""
        self.spark, self.annuli, self.block_rows = vectors.sparkSession, annuli, block_rows
        squared = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
        whole = vectors.agg(F.max(F.size("vec")), F.max(squared), F.max(F.array_max(F.transform("vec", F.abs)))).first()
        self.width, self.norm2, self.greatest = int(whole[0] or 0), float(whole[1] or 0), int(whole[2] or 0)
        if self.greatest * self.greatest * max(self.width, 1) >= 1 << 62:
            raise ValueError("components too large for long scores")
        #: products of this size add up exactly in doubles
        self.exact = self.greatest * self.greatest * max(self.width, 1) < 1 << 53
        sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
        self.pivots = np.zeros((len(sample), self.width))
        for i, r in enumerate(sample):
            self.pivots[i, :len(r.vec)] = r.vec
        self.lift = np.sqrt(np.maximum(0, self.norm2 - (self.pivots ** 2).sum(1)))
        self.table = stage_table(self._keyed(vectors), "pivot-index")
        rings = (self.table.groupBy("cell", "ring").agg(F.count("*").alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi"))
                 .orderBy("cell", "ring").collect())      # at most pivots * annuli rows
        self.rings = np.array([tuple(r) for r in rings], float).reshape(-1, 5)
        block, filled, last = -1, 0, None
        blocks, salts = [], []
        for cell, _, n, _, _ in self.rings:
            if cell != last or filled + n > block_rows:
                block, filled, last = block + 1, 0, cell
            filled += n
            blocks.append(block)
            salts.append(-(-int(n) // block_rows))
        self.block, self.salts = np.array(blocks, np.int64), np.array(salts, np.int64)

    def _keyed(self, vectors: DataFrame) -> DataFrame:
        pivots, lift, width, norm2, annuli = self.pivots, self.lift, self.width, self.norm2, self.annuli

        def key(batches):
            for b in batches:
                x = _matrix(b.column(1), width).astype(float)
                up = np.sqrt(np.maximum(0, norm2 - (x ** 2).sum(1)))
                d2 = np.maximum(0, 2 * norm2 - 2 * (x @ pivots.T + np.outer(up, lift)))
                cell = d2.argmin(1)
                dist = np.sqrt(d2[np.arange(len(x)), cell])
                ring = np.minimum(annuli - 1, dist / (2 * np.sqrt(norm2) or 1) * annuli).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(ring), pa.array(dist)],
                                                 names=["vec_id", "vec", "cell", "ring", "dist"])

        return vectors.select("vec_id", "vec").mapInArrow(key, "vec_id long, vec array<long>, cell long, ring long, dist double")

    def _visits(self, queries: DataFrame, k: int, vectors: bool = True) -> DataFrame:
        """``queries`` (vec_id, vec and perhaps floor: the score to beat) with
        one row per block and salt that they have to search; without
        ``vectors`` only their ids and one row per block."""
        rings, block, salts = self.rings, self.block, self.salts
        pivots, lift, width, norm2 = self.pivots, self.lift, self.width, self.norm2
        firm = "floor" in queries.columns

        def visit(batches):
            for b in batches:
                q = _matrix(b.column(1), width).astype(float)
                own2 = (q ** 2).sum(1)
                r = np.sqrt(np.maximum(0, own2[:, None] + norm2 - 2 * q @ pivots.T))      # a query's added component is 0
                gap = r[:, rings[:, 0].astype(int)]
                gap = np.maximum(0, np.maximum(gap - rings[:, 4], rings[:, 3] - gap))
                if firm:
                    floor = b.column(2).to_numpy(zero_copy_only=False).astype(float)      # null: nothing may be left out
                    best = (own2[:, None] + norm2 - gap ** 2) / 2 + 1e-6 * (own2[:, None] + norm2 + 1)
                    need = ~(best < floor[:, None])
                else:
                    order = np.argsort(gap, 1, kind="stable")
                    before = np.cumsum(rings[order, 2], 1) - rings[order, 2]
                    need = np.zeros(gap.shape, bool)
                    np.put_along_axis(need, order, before < k + 1, 1)
                row, ring = np.nonzero(need)
                pair = np.unique(np.stack([row, block[ring]]), axis=1)
                if not vectors:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(pair[0])), pa.array(pair[1])], names=["query_id", "block"])
                    continue
                most = np.zeros(block.max() + 1 if len(block) else 0, np.int64)
                np.maximum.at(most, block, salts)
                copies = most[pair[1]]
                at = np.repeat(np.arange(pair.shape[1]), copies)
                salt = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                rows = pa.array(pair[0][at])
                yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(pair[1][at]), pa.array(salt)],
                                                 names=["query_id", "query", "block", "salt"])

        return queries.mapInArrow(visit, "query_id long, query array<long>, block long, salt long" if vectors else "query_id long, block long")

    def _blocks(self) -> DataFrame:
        by_ring = {(int(r[0]), int(r[1])): (int(b), int(s)) for r, b, s in zip(self.rings, self.block, self.salts)}
        rows = [(*k, *v) for k, v in by_ring.items()] or [(0, 0, 0, 1)]
        table = self.spark.createDataFrame(rows, "cell long, ring long, block long, salts long")
        return (self.table.join(F.broadcast(table), ["cell", "ring"])        # at most pivots * annuli rows
                .select("block", F.pmod(F.xxhash64("vec_id"), "salts").alias("salt"), "vec_id", "vec"))

    def _search(self, queries: DataFrame, k: int, block_queries: int, n_queries: int) -> DataFrame:
        groups = max(1, -(-n_queries // block_queries))
        width, exact = self.width, self.exact
        visits = self._visits(queries, k).withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)))
        # one row a block (there are at most pivots * annuli) with the groups that search it
        searched = (self._visits(queries, k, vectors=False).select("block", F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("part"))
                    .groupBy("block").agg(F.collect_set("part").alias("parts")))
        held = self._blocks().join(searched, "block").select("block", "salt", F.explode("parts").alias("part"), "vec_id", "vec")
        kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

        def best(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return kind.empty_table()
            v, q = _matrix(left["vec"], width), _matrix(right["query"], width)
            if exact:
                v, q = v.astype(float), q.astype(float)
            ids, own = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
            out = []
            for at in range(0, len(q), 256):
                i, hit, score = _top(q[at:at + 256] @ v.T, ids, own[at:at + 256], k)
                out.append(pa.table([own[at + i], hit, score.astype(np.int64)], schema=kind))
            return pa.concat_tables(out)

        keys = ["block", "salt", "part"]
        found = held.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(best, "query_id long, vec_id long, score long")
        w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
                .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))

    def search(self, queries: DataFrame, k: int, block_queries: int = 2048) -> DataFrame:
        """``(query_id, rank, vec_id, score)``: the k best other vectors of every query."""
        queries = stage_table(queries, "pivot-queries")
        n = queries.count()
        near = self._search(queries, k, block_queries, n).filter(F.col("rank") == k).select(
            F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        near = stage_table(near, "pivot-floor")
        firm = queries.join(near, "vec_id", "left").select("vec_id", "vec", "floor")
        return self._search(firm, k, block_queries, n).select("query_id", "rank", "vec_id", "score")


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """``(vec_id, vec array<long>)``: floor(scale * x) of the usable rows."""
    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))

    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", usable))
            .select("vec_id", F.transform("v", lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("vec")))


@query("op10_exact_topk")
def op10_exact_topk(spark, sf_dir):
    vectors = integer_vectors(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return PivotIndex(vectors).search(vectors.filter(F.col("vec_id") % 50 == 0), k=5)


ORACLE["op10_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
