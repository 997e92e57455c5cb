"""Near-duplicate documents by b-bit MinHash.

Signatures: 128 minima over the hashes of a document's distinct word shingles.
Band candidate generation groups documents whose four minima of a band (of 32)
agree; two sets of similarity 0.8 miss every band with probability 5e-8.  Of
each minimum the low four bits are retained and packed into eight longs;
mismatching groups of bits are counted by ``bit_count`` and corrected for
chance agreement (1 in 16), and a pair goes on unless the estimate is more than
five standard deviations under the threshold, which a linked pair is with a
probability of 1.4e-6 at most.  What goes on is confirmed on the full sets, so no false
link stays.

Work per group of copies is linear where a quadratic result is not needed:

* documents with equal sets are one class and enter once;
* every class first meets up to three hubs only (a band group's hub is its
  class that meets most others, as the original of edited copies does; those
  that share most bands go first), and the confirmed links are joined into
  components;
* then each band group is searched again for pairs in *different* components,
  where one side is outside the group's largest component.  A pair inside one
  component cannot change the result.  Of the others, those are dropped whose
  parity maps (2,048 places) differ in more places than two linked sets can
  differ in shingles, which is certain; the rest is confirmed, so the size of a
  group costs no link, and few pairs are more than links.

Nothing is collected to the driver; hubs and components come from grouped
aggregates (combined map-side) and joins whose other side has one row a key,
so a hot group splits under AQE's skew handling.

Edge cases: a text that is null or without words has the empty set, is linked
with nothing and kept.  Rows that share a doc_id count as one document.  A row
with a null doc_id gets a null component and is kept.  Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.common import ORACLE, mix, query, read, worker_tables
from casemart.llm.graph import connected_components
from casemart.llm.shingles import shingle_sets
from casemart.session import stage_table

MINIMA, BAND_ROWS, BITS = 128, 4, 4
#: Hubs that a class is compared with before the search between components.
TRIES = 3
#: Places of the parity maps.
PARITY = 2048
#: Classes that a task of the search between components holds at once, and that it streams past them.
BLOCK = 2048
_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 32, MINIMA, np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, MINIMA, np.uint32)


def minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    best = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        best = np.minimum(best, (_A[:, None] * x[None, at:at + 4096] + _B[:, None]).min(1))
    return best


def band_keys(m: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands of each row of minima."""
    m = m.astype(np.uint64).reshape(len(m), MINIMA // BAND_ROWS, BAND_ROWS)
    key = np.broadcast_to(np.arange(m.shape[1], dtype=np.uint64), m.shape[:2])
    for k in range(BAND_ROWS):
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + m[:, :, k])
    return key


def packed(m: np.ndarray) -> np.ndarray:
    """The low bits of each minimum as bit planes: two longs for each of the bits."""
    low = mix(m.astype(np.uint64)).astype(np.uint8)
    planes = [np.packbits((low >> p) & 1, axis=1).view(np.uint64) for p in range(BITS)]
    return np.concatenate(planes, axis=1)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, n, s1, s2, bands, bits)``; s1 and s2 identify the whole set."""
    def sign(batches):
        worker_tables("near_dedup")
        for b in batches:
            for row, sets in shingle_sets(b.column(1), width):
                n = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(n)
                m = np.array([minima(sets[i]) for i in some], np.uint32).reshape(len(some), MINIMA)
                s1, s2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                s1[some] = [sets[i].sum() for i in some]
                s2[some] = [np.bitwise_xor.reduce(mix(sets[i])) for i in some]

                def lists(x: np.ndarray) -> pa.Array:
                    ends = np.concatenate([[0], np.cumsum(np.where(n > 0, x.shape[1], 0))])
                    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.reshape(-1).view(np.int64)))

                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, len(sets)), pa.array(n), pa.array(mix(s1).view(np.int64)), pa.array(s2.view(np.int64)),
                     lists(np.ascontiguousarray(band_keys(m))), lists(np.ascontiguousarray(packed(m)))],
                    names=["doc_id", "n", "s1", "s2", "bands", "bits"])

    return docs.mapInArrow(sign, "doc_id long, n long, s1 long, s2 long, bands array<long>, bits array<long>")


def parity(shingles: np.ndarray) -> np.ndarray:
    """How many shingles hash to each of ``PARITY`` places, odd or even, as longs."""
    odd = np.bincount((shingles % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``(node, shingles, odd)`` of the given documents."""
    def sets_of(batches):
        worker_tables("near_dedup")
        for b in batches:
            for row, sets in shingle_sets(b.column(1), width):
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                odd = np.concatenate([parity(s) for s in sets]) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, len(sets)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * (PARITY // 64), pa.int32()), pa.array(odd))],
                    names=["node", "shingles", "odd"])

    return docs.mapInArrow(sets_of, "node long, shingles array<long>, odd array<long>")


def mismatches(a: Column, b: Column) -> Column:
    """Minima whose retained bits differ between two packed signatures."""
    words = MINIMA // 64
    total = F.lit(0)
    for w in range(words):
        differ = a[w].bitwiseXOR(b[w])
        for p in range(1, BITS):
            differ = differ.bitwiseOR(a[p * words + w].bitwiseXOR(b[p * words + w]))
        total = total + F.bit_count(differ)
    return total


def most_mismatches(percent: int) -> int:
    """Mismatching minima of a pair at the threshold, and five standard deviations more."""
    chance, j = 2.0 ** -BITS, percent / 100
    agree = j + (1 - j) * chance
    return int(MINIMA * (1 - agree + 5 * (agree * (1 - agree) / MINIMA) ** 0.5))


def may_link(na: Column, nb: Column, a: Column, b: Column, percent: int) -> Column:
    """Set sizes allow a link, and the corrected estimate is not five standard
    deviations under the threshold."""
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (mismatches(a, b) <= most_mismatches(percent))


def _cross_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """``(u, v, nu, nv)``: pairs of a band group in different components, one of
    them outside its largest (``main``), that the filters let pass.

    ``rows`` has (key, node, component, main, n, bits, odd).  The rows outside
    the largest component are dealt in blocks of about ``BLOCK`` a group, all rows
    of the group in salts of as many; a task holds one block and streams one salt
    past it, so a hot group is split on both sides.
    """
    outside = rows.filter("component <> main")
    sizes = rows.groupBy("key").agg(F.ceil(F.count_if(F.col("component") != F.col("main")) / BLOCK).alias("blocks"),
                                    F.ceil(F.count("*") / BLOCK).alias("salts"))
    carried = ("node", "component", "main", "n", "bits", "odd")

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    mine = (outside.join(sizes, "key").withColumn("salt", each("salts"))
            .select("key", F.pmod(F.xxhash64("node"), "blocks").alias("block"), "salt", F.lit(0).alias("side"), *carried))
    every = (rows.join(sizes.filter("blocks > 0"), "key").withColumn("block", each("blocks"))
             .select("key", "block", F.pmod(F.xxhash64("node", F.lit(1)), "salts").alias("salt"), F.lit(1).alias("side"), *carried))
    most = most_mismatches(percent)

    def compare(batches):
        group, held = None, []
        for b in batches:
            key, block, salt, side, node, comp, main, n = (c.to_numpy() for c in b.columns[:8])
            bits, odd = (c.values.slice(c.offsets[0].as_py(), c.offsets[-1].as_py() - c.offsets[0].as_py()).to_numpy()
                         .view(np.uint64).reshape(b.num_rows, -1) for c in b.columns[8:])
            edge = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (salt[1:] != salt[:-1]) | (side[1:] != side[:-1])) + 1
            for a, z in zip(np.concatenate([[0], edge]), np.concatenate([edge, [b.num_rows]])):
                if (key[a], block[a], salt[a]) != group:
                    group, held = (key[a], block[a], salt[a]), []
                part = tuple(x[a:z] for x in (node, comp, n, bits, odd))
                if side[a] == 0:
                    held.append(part)
                    continue
                if not held:                # hashing left this block empty
                    continue
                if len(held) > 1:
                    held = [tuple(map(np.concatenate, zip(*held)))]
                for at in range(0, z - a, 256):
                    found = _near(held[0], tuple(x[at:at + 256] for x in part), main[a], percent, most)
                    if len(found[0]):
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), names=["u", "v", "nu", "nv"])

    both = mine.unionByName(every).repartition("key", "block", "salt").sortWithinPartitions("key", "block", "salt", "side")
    return both.mapInArrow(compare, "u long, v long, nu long, nv long")


def _near(left: tuple, right: tuple, main: int, percent: int, most: int) -> tuple:
    (u, cu, nu, bu, ou), (v, cv, nv, bv, ov) = left, right
    planes, out = MINIMA // 64, []
    for at in range(0, len(u), 1024):
        s = slice(at, at + 1024)
        wrong = np.zeros((len(u[s]), len(v)), np.uint16)
        for w in range(planes):
            differ = bu[s, None, w] ^ bv[None, :, w]
            for p in range(1, BITS):
                differ |= bu[s, None, p * planes + w] ^ bv[None, :, p * planes + w]
            wrong += np.bitwise_count(differ)
        ok = (wrong <= most) & (cu[s, None] != cv) & ((cv == main) | (u[s, None] < v))
        ok &= 100 * np.minimum(nu[s, None], nv) >= percent * np.maximum(nu[s, None], nv)
        i, j = np.nonzero(ok)
        # linked sets differ in no more shingles than this, so their parity maps in no more places
        apart = np.bitwise_count(ou[at + i] ^ ov[j]).sum(1, dtype=np.int64)
        keep = apart * (100 + percent) <= (nu[at + i] + nv[j]) * (100 - percent)
        out.append((at + i[keep], j[keep]))
    i, j = (np.concatenate(x) for x in zip(*out))
    return u[i], v[j], nu[i], nv[j]


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row: documents are
    linked where 100 * intersection >= percent * union of their shingle sets."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stage_table(signatures(docs, width), "signatures")
    classes = signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(F.min("doc_id").alias("node"))
    classes = stage_table(classes, "classes")
    nodes = signed.join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").withColumnRenamed("doc_id", "node")

    banded = nodes.select("node", F.explode("bands").alias("key"))
    sizes = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stage_table(banded.join(sizes, "key"), "shared-bands")
    # the original of a group of edited copies meets more of them than any copy does
    degrees = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    hubs = (shared.join(degrees, "node").groupBy("key").agg(F.max(F.struct("degree", -F.col("node"))).alias("h"))
            .select("key", (-F.col("h.col2")).alias("hub")))
    common = Window.partitionBy("node").orderBy(F.col("n").desc(), "hub")      # at most one row a band
    best = (shared.join(hubs, "key").filter("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("n"))
            .withColumn("try", F.row_number().over(common)).filter(F.col("try") <= TRIES).select("node", "hub"))
    slim = nodes.select("node", "n", "bits")
    x, y = slim.toDF("u", "nu", "bu"), slim.toDF("v", "nv", "bv")
    able = may_link(F.col("nu"), F.col("nv"), F.col("bu"), F.col("bv"), percent)
    first = best.toDF("u", "v").join(x, "u").join(y, "v").filter(able).select("u", "v", "nu", "nv")

    among = shared.select("node").distinct()
    sets = stage_table(full_sets(docs.join(among.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi"), width), "shingle-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(sets.select("node", "shingles").toDF("u", "su"), "u").join(sets.select("node", "shingles").toDF("v", "sv"), "v")
                .withColumn("common", F.size(F.array_intersect("su", "sv")).cast("long")))
        return both.filter(100 * F.col("common") >= percent * (F.col("nu") + F.col("nv") - F.col("common"))).select("u", "v")

    first = stage_table(first, "hub-pairs")
    links = stage_table(confirmed(first), "links")
    groups = connected_components(links)

    # candidates between components: in a band group, one side is outside its largest component
    placed = (shared.select("key", "node").join(groups, "node", "left")
              .select("key", "node", F.coalesce("component", "node").alias("component")))
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = (parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("largest"))
             .filter("parts > 1").select("key", F.col("largest.component").alias("main")))
    rows = stage_table(placed.join(mixed, "key").join(slim, "node").join(sets.select("node", "odd"), "node"), "mixed-bands")
    more = stage_table(_cross_pairs(rows, percent).distinct(), "mixed-pairs")
    groups = connected_components(links.unionByName(confirmed(more)))

    of = signed.select("doc_id", "n", "s1", "s2").join(classes, ["s1", "s2"], "left").join(groups, "node", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return of.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                     F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


@query("op3_near_dedup")
def op3_near_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), width=4)


ORACLE["op3_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[]
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS g FROM w),
size AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT l.v, r.root FROM reach r JOIN link l ON l.u = r.node WHERE r.root < l.v),
part AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
closed AS (
  SELECT p.node, least(p.component_id, min(q.component_id)) AS component_id
  FROM part p LEFT JOIN part q ON q.node = p.component_id GROUP BY p.node, p.component_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN size s USING (doc_id) JOIN closed c ON c.node = d.doc_id
"""
