"""Ranked lexical search on K2-treaps.

The grid has a row per term of the search items and a column per document; an
occupied cell holds the term's integer impact on that document's score.  The
documents are cut into ranges of ``RANGE`` columns.  For each range a K2-treap
is built: a quadtree over the grid in which a node stores the greatest impact
of its square and a 4-bit map of its occupied quarters (empty squares take no
room; a child is found by counting map bits).

An item descends its rows' paths jointly: a state is a range of documents and
the node of every row over that range, and the sum of the nodes' maxima bounds
the score of each document in the range.  States are expanded best-first (the
highest bounds of the frontier together, as one numpy step); a range of one
document is its exact score.  A state whose bound is under the k-th best score
so far is dropped, at equality it stays, as ties go to the smaller id.  Nothing
else is left out, so the result is that of scoring every document.

Distribution: one pass over the texts makes the postings of each range (terms
of the items only; lengths and totals are of all terms).  Counts of documents
per term are grouped sums.  The ranges are then dealt to tasks; a task keeps
the best k of each item over all its ranges and emits those.  The final cut is
a ranking per item and salt, then per item.  What is broadcast are the items'
terms: items are dealt to rounds so that a round holds about ``ROUND_TERMS``.

Terms are runs of ASCII letters, digits and all non-ASCII characters, A-Z
lower-cased, compared by a 64-bit hash.

Edge cases: null and empty texts have no terms: such documents are not counted
and never found, such items give no rows.  Rows of one item id are one item.
Items with a null id, and documents with a null id, take no part.  Each of
repeated document rows is a document of its own.  Empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.common import ORACLE, lower_ascii, query, read, span_hashes, text_chunks, words
from casemart.session import stage_table

#: Documents of a range (columns of a treap).
RANGE = 4096
#: Ranges that a search task gets, on average.
TASK_RANGES = 4
#: Distinct (item, term) pairs that a round of items holds, on average.
ROUND_TERMS = 1 << 17
#: Frontier states that are expanded together.
STATES = 512
_TERM = np.zeros(256, bool)
_TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True
#: Number of set bits of a 4-bit map below each of its quarters.
_RANK = np.array([[(m & ((1 << q) - 1)).bit_count() for q in range(4)] for m in range(16)], np.int32).ravel()


def term_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, hashes, row of each hash)`` of the terms of a text column, in pieces."""
    for row, end, data, offsets in text_chunks(column, 1 << 20):
        data = lower_ascii(data)
        starts, ends, rows = words(data, offsets, ~_TERM)
        yield row, end, span_hashes(data, starts, ends), rows


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct ``(item_id, term)``."""
    def split(batches):
        for b in batches:
            for row, _, h, rows in term_hashes(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row + rows)), pa.array(h.view(np.int64))], names=["item_id", "term"])

    known = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).filter("item_id IS NOT NULL")
    return known.mapInArrow(split, "item_id long, term long").distinct()


def postings(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """A row per range of documents: ids and term counts ``n``; ``term`` (place in
    the sorted ``terms``), ``col`` and ``tf`` of each cell; documents per term.
    """
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def cut(batches):
        ids, n, cells, filled = [], [], [], 0

        def flush():
            nonlocal ids, n, cells, filled
            key, tf = (np.concatenate(x) for x in zip(*cells))
            term, col = np.divmod(key, RANGE)
            dterm, df = np.unique(term, return_counts=True)
            out = [pa.array([x], t) for x, t in (
                (np.concatenate(ids), pa.list_(pa.int64())), (np.concatenate(n), pa.list_(pa.int64())), (term, pa.list_(pa.int32())),
                (col, pa.list_(pa.int32())), (tf, pa.list_(pa.int32())), (dterm, pa.list_(pa.int32())), (df, pa.list_(pa.int32())))]
            ids, n, cells, filled = [], [], [], 0
            return pa.RecordBatch.from_arrays(out, names=["ids", "n", "term", "col", "tf", "dterm", "df"])

        for b in batches:
            doc_ids = b.column(0).to_numpy()
            for row, end, h, rows in term_hashes(b.column(1)):
                count = np.bincount(rows, minlength=end - row)
                place = np.minimum(np.searchsorted(held.value, h), max(len(held.value) - 1, 0))
                hit = held.value[place] == h if len(held.value) else np.zeros(len(h), bool)
                key, tf = np.unique(rows[hit] * (len(held.value) + 1) + place[hit], return_counts=True)
                at, term = np.divmod(key, len(held.value) + 1)
                some = np.flatnonzero(count)
                while len(some):                          # a piece may hold more documents than the range has room for
                    take, some = np.split(some, [RANGE - filled])
                    col = np.full(end - row, -1)
                    col[take] = filled + np.arange(len(take))
                    mine = col[at] >= 0
                    cells.append((term[mine] * RANGE + col[at][mine], tf[mine]))
                    ids.append(doc_ids[row:end][take])
                    n.append(count[take])
                    filled += len(take)
                    if filled == RANGE:
                        yield flush()
        if filled:
            yield flush()

    known = docs.filter("doc_id IS NOT NULL")
    return known.mapInArrow(cut, "ids array<long>, n array<long>, term array<int>, col array<int>, tf array<int>, dterm array<int>, df array<int>")


def _spread(x: np.ndarray) -> np.ndarray:
    """The low 31 bits of each number, with a gap before every bit."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """K2-treap of the cells (row, col, impact > 0).

    Nodes are numbered from the root (1) down, level by level; node 0 stands for
    an empty square.  ``quarters``: 4-bit map of the occupied quarters (bit 0 of a
    quarter's number: the later half of the columns, bit 1: of the rows);
    ``first``: the first child; ``most``: the greatest impact of the square.
    """

    def __init__(self, rows: np.ndarray, cols: np.ndarray, impact: np.ndarray):
        self.height = max(int(rows.max(initial=0)), int(cols.max(initial=0)), 1).bit_length()
        code = (_spread(rows) << np.uint64(1)) | _spread(cols)
        order = np.argsort(code)
        levels = [(code[order], impact[order].astype(np.int64), np.zeros(len(order), np.uint8), np.zeros(len(order), np.int64))]
        for _ in range(self.height):
            code, most = levels[-1][:2]
            up = code >> np.uint64(2)
            start = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]])) if len(up) else np.zeros(0, np.int64)
            quarter = (1 << (code & np.uint64(3)).astype(np.int64)).astype(np.uint8)
            levels.append((up[start], np.maximum.reduceat(most, start) if len(start) else most,
                           np.bitwise_or.reduceat(quarter, start) if len(start) else quarter, start))
        levels.reverse()
        base = 1 + np.cumsum([0, *(len(x[0]) for x in levels)])
        self.most = np.concatenate([[0], *(x[1] for x in levels)])
        self.quarters = np.concatenate([[0], *(x[2] for x in levels)]).astype(np.int32)
        self.first = np.concatenate([[0], *(x[3] + after for x, after in zip(levels, base[1:]))]).astype(np.int32)

    def child(self, node: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The nodes' children in these quarters, 0 where empty."""
        held = self.quarters[node]
        return np.where((held >> quarter) & 1, self.first[node] + _RANK[4 * held + quarter], 0)


class Best:
    """The k best (score, id) of an item so far: higher scores, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[order], ids[order]
        if len(order) == self.k:
            self.floor = int(self.score[-1])


def descend(treap: Treap, rows: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Add to ``best`` what the treap's documents score for the item with these term rows."""
    rows = rows[rows >> treap.height == 0].astype(np.int32)       # rows beyond the treap's square are empty
    if len(treap.most) < 2 or not len(rows):
        return
    state = (np.array([treap.most[1] * len(rows)]), np.zeros(1, np.int32), np.array([treap.height], np.int32), np.ones((1, len(rows)), np.int32))
    while len(state[0]):
        live = state[0] >= best.floor
        if not live.all():
            state = tuple(x[live] for x in state)
        if len(state[0]) > STATES:
            order = np.argpartition(state[0], len(state[0]) - STATES)
            now, state = (tuple(x[part] for x in state) for part in (order[-STATES:], order[:-STATES]))
        else:
            now, state = state, None
        _, col, level, node = now
        level = level - 1
        lower = ((rows[None, :] >> level[:, None]) & 1) << 1
        further = [] if state is None else [state]
        for half in (0, 1):
            nodes = treap.child(node, lower + half)
            bound = treap.most[nodes].sum(1)
            keep = bound >= best.floor
            done = keep & (level == 0)
            if done.any():
                best.add(bound[done], ids[2 * col[done] + half])
            keep &= level > 0
            if keep.any():
                further.append((bound[keep], 2 * col[keep] + half, level[keep], nodes[keep]))
        state = tuple(np.concatenate(x) for x in zip(*further)) if further else (np.zeros(0),)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best documents of each item."""
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = stage_table(item_terms(items, item_id, item_text), "lexical-items")
    rounds = max(1, -(-asked.count() // ROUND_TERMS))
    found = [_round(known, asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r), k) for r in range(rounds)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(F.col("item_id").alias(item_id), "rank", F.col("doc_id").alias(id_col), "score")


def _round(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    pairs = asked.orderBy("item_id", "term").toArrow()              # one round's (item, term) pairs
    item, hashed = pairs["item_id"].to_numpy(), pairs["term"].to_numpy().view(np.uint64)
    terms, seen, place = np.unique(hashed, return_index=True, return_inverse=True)
    # rows of the grid: an item's terms lie together where they can, so that their paths share nodes
    row_of = np.empty(len(terms), np.int64)
    row_of[np.argsort(seen)] = np.arange(len(terms))
    asked_ids, start = np.unique(item, return_index=True)
    rows_of = np.split(row_of[place], start[1:])

    ranges = stage_table(postings(docs, terms), "lexical-postings")
    whole = ranges.agg(F.count("*").alias("ranges"), F.sum(F.size("ids").cast("long")).alias("n"),
                       F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")).first()
    n_docs, length = whole.n or 0, whole.l or 0
    counted = (ranges.select(F.explode(F.arrays_zip("dterm", "df")).alias("z")).groupBy("z.dterm").agg(F.sum("z.df").alias("df")).collect())
    weight = np.zeros(len(terms), np.int64)
    for r in counted:                                                # at most one round's terms
        weight[r["dterm"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))

    shared = docs.sparkSession.sparkContext.broadcast((asked_ids, rows_of, row_of, weight))

    def answer(batches):
        asked_ids, rows_of, row_of, weight = shared.value
        best = [Best(k) for _ in asked_ids]
        for b in batches:
            for i in range(b.num_rows):
                ids, n, term, col, tf = (b.column(c)[i].values.to_numpy().astype(np.int64) for c in ("ids", "n", "term", "col", "tf"))
                m = 100 - 50 + (50 * n * n_docs) // length
                impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[col]))
                some = impact > 0
                treap = Treap(row_of[term[some]], col[some], impact[some])
                for rows, top in zip(rows_of, best):
                    descend(treap, rows, ids, top)
        if len(asked_ids):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(asked_ids, [len(t.ids) for t in best])), pa.array(np.concatenate([t.ids for t in best])),
                 pa.array(np.concatenate([t.score for t in best]))], names=["item_id", "doc_id", "score"])

    tasks = max(1, -(-whole.ranges // TASK_RANGES))
    dealt = ranges.select("ids", "n", "term", "col", "tf").repartition(tasks)
    found = dealt.mapInArrow(answer, "item_id long, doc_id long, score long")
    first = [F.col("score").desc(), F.col("doc_id").asc()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(32)))
    some = (salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*first)))
            .filter(F.col("rank") <= k).drop("rank", "salt"))
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*first))).filter(F.col("rank") <= k)


@query("op11_lexical_search")
def op11_lexical_search(spark, sf_dir):
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE["op11_lexical_search"] = r"""
WITH spelled AS (
  SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents WHERE doc_id IS NOT NULL),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM spelled GROUP BY ALL),
size AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS l FROM size),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term, n_docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // l))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (r), whole GROUP BY item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
