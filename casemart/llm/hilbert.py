"""Shards along a Hilbert curve over several metadata columns, with DataFrame expressions only.

1. Quantise: each dimension is cut into ``2 ** bits`` cells of equal depth.  A
   value's cell is ``less * 2 ** bits / rows`` (rounded down), where ``less``
   counts the rows with a smaller value; so equal values share a cell and the
   cells follow the order of the values, also for strings.  Counts are exact
   and over all rows; only the first value of each cell, ``2 ** bits`` a
   dimension at most, becomes a literal of the plan.
2. Order: a row's cells give its curve index (a state machine over the digits of
   the cells, one array look-up a level); rows are range-partitioned by index,
   then by the tie columns, so a hot cell or value is split among partitions.
3. Cut: a row's place in the whole order is its place in its partition plus the
   rows before that partition.  Runs of the order are the shards, so a shard
   covers a compact box of few ranges in every dimension, and the minima and
   maxima of its files let a reader skip it.

Laws: ``rows`` cuts runs whose numbers of rows differ by one at most; ``bytes``
cuts where the running total of the sizes passes each multiple of total /
shards, by the middle of the row, so a shard is off by at most one row's size.
Neither keeps equal texts together by force: copies with the same metadata are
neighbours in the order and may lie on both sides of a cut.

Distribution: only the given columns are shuffled, once for the order (``bytes``
adds one shuffle for the running sums).  The tables between are written to the
shared folder, so positions are read back and never drawn again.  The driver
holds a few numbers per range partition and per cell.

Edge cases: a null value of a dimension is the smallest; rows whose order
columns are all equal are interchangeable; an empty table gives an empty
result; columns of the input named ``shard``, ``slot`` or ``curve`` are
replaced; other extra columns stay.  ``shard_documents`` ignores extra columns,
a null text has size 1 and the checksum of the empty text, null ids come first
among ties.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemart.llm.common import ORACLE, query, read
from casemart.session import stage_table


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """``(digits, states)`` of the Hilbert curve in ``n`` dimensions.

    Entry ``state * 2 ** n + cell`` holds the curve's digit of a sub-cell (bit i:
    upper half of dimension i) and the state inside it.  A state is the corner
    where the curve enters and the axis along which it runs; only states that
    can be reached from the first get a number.
    """
    full = (1 << n) - 1

    def turned(x: int, k: int) -> int:
        k %= n
        return ((x >> k) | (x << (n - k))) & full

    def trailing_ones(x: int) -> int:
        return (~x & (x + 1)).bit_length() - 1

    digits, states, numbers, order = [], [], {(0, 0): 0}, [(0, 0)]
    for corner, axis in order:                       # grows while it is read
        for cell in range(1 << n):
            gray, digit = turned(cell ^ corner, axis + 1), 0
            while gray:
                digit, gray = digit ^ gray, gray >> 1
            start = digit and (digit - 1) // 2 * 2
            run = trailing_ones(digit - 1 + digit % 2) if digit else 0
            inner = (corner ^ turned(start ^ (start >> 1), n - axis - 1), (axis + run + 1) % n)
            if inner not in numbers:
                numbers[inner] = len(order)
                order.append(inner)
            digits.append(digit)
            states.append(numbers[inner])
    return digits, states


def _array(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def curve_index(cells: Sequence[Column], bits: int) -> Column:
    """Place on the curve of a point given by its cells (``0 .. 2 ** bits - 1`` each)."""
    n = len(cells)
    if n * bits > 62:
        raise ValueError("the curve index must fit a long")
    digits, states = curve_tables(n)
    digits, states = _array(digits), _array(states)

    def half(j: int) -> Column:
        return sum((F.shiftleft(F.shiftright(c, j).bitwiseAND(1), i) for i, c in enumerate(cells)), F.lit(0))

    def step(at: Column, cell: Column) -> Column:
        place = at["state"] * (1 << n) + cell + 1
        return F.struct((F.shiftleft(at["h"], n) + F.element_at(digits, place)).alias("h"), F.element_at(states, place).alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("state"))
    return F.aggregate(F.array(*[half(j) for j in range(bits - 1, -1, -1)]), start, step)["h"]


def _before(df: DataFrame, weight: Column, name: str) -> dict[int, int]:
    """Sum of ``weight`` (columns of ``df``) in the bins before each ``bin``: a number per range partition."""
    sums = sorted((r[0], int(r[1] or 0)) for r in df.groupBy("bin").agg(F.sum(weight.cast("decimal(38,0)")).alias(name)).collect())
    return dict(zip((b for b, _ in sums), accumulate((s for _, s in sums), initial=0)))


def _offset(before: dict[int, int]) -> Column:
    bins = max(before, default=-1) + 1
    return F.coalesce(F.get(_array([before.get(b, 0) for b in range(bins)]) if bins else F.array().cast("array<long>"), F.col("bin")),
                      F.lit(0)).cast("long")


def _in_order(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df`` sorted over its partitions and stored, with ``bin`` and ``at`` (place in the bin)."""
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage_table(ranged.withColumn("bin", F.shiftright(place, 33).cast("int"))
                       .withColumn("at", place.bitwiseAND(F.lit((1 << 33) - 1))), name)


def cells_of(df: DataFrame, dim: str, bits: int) -> tuple[list, list[int]]:
    """``(first values, cells)``: the smallest value of every cell in use, in order; null is the smallest of all."""
    values = df.groupBy(F.col(dim).alias("v")).agg(F.count("*").alias("n"))
    ranged = _in_order(values, ["v"], "hilbert-values")
    before = _before(ranged, F.col("n"), "n")
    total = ranged.agg(F.sum("n")).first()[0] or 0
    inside = Window.partitionBy("bin").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    less = _offset(before) + F.coalesce(F.sum("n").over(inside), F.lit(0))
    cell = _div(less * (1 << bits), max(total, 1)).cast("int")
    first = ranged.select("v", cell.alias("cell")).groupBy("cell").agg(F.min_by("v", F.struct(F.col("v").isNotNull(), "v")).alias("v"))
    rows = sorted(first.collect())        # 2 ** bits at most
    return [v for _, v in rows], [c for c, _ in rows]


def _cell(value: Column, firsts: list, cells: list[int], kind: str) -> Column:
    """The cell of the last first value that is not greater."""
    known = [(F.lit(v).cast(kind), c) for v, c in zip(firsts, cells) if v is not None]
    if not known:
        return F.lit(0)
    reached = F.size(F.filter(F.array(*[v for v, _ in known]), lambda first: first <= value))
    return F.when(value.isNull(), F.lit(0)).otherwise(F.element_at(_array([0, *(c for _, c in known)]), reached + 1))


def hilbert_shards(df: DataFrame, dims: Sequence[str], shards: int, law: str = "rows", size_col: str | None = None,
                   tie_cols: Sequence[str] = (), bits: int = 6) -> DataFrame:
    """``df`` with ``curve`` (long), ``shard`` (int) and ``slot`` (long, from 0 in each shard)."""
    if law not in ("rows", "bytes") or (law == "bytes") != (size_col is not None):
        raise ValueError("the law is 'rows', or 'bytes' with a size column")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    parts = [_cell(F.col(f"`{d}`"), *cells_of(df, f"`{d}`", bits), df.schema[d].dataType.simpleString()) for d in dims]
    ties = [F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(tie_cols)]
    placed = df.select(row, curve_index(parts, bits).alias("index"), *ties,
                       *([F.col(f"`{size_col}`").cast("long").alias("size")] if size_col else []))
    ranged = _in_order(placed, ["index", *[f"t{i}" for i in range(len(ties))]], "hilbert-order")
    rows = _before(ranged, F.lit(1), "rows")
    rank, n = _offset(rows) + F.col("at"), ranged.count()
    if law == "rows":
        each, longer = divmod(n, shards)
        cut = longer * (each + 1)               # before it, shards of one row more
        late = rank - cut
        shard = F.when(rank < cut, _div(rank, each + 1)).otherwise(F.lit(longer) + _div(late, max(each, 1)))
        slot = F.when(rank < cut, rank % (each + 1)).otherwise(late % max(each, 1))
        done = ranged.withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("long"))
    else:
        sizes = _before(ranged, F.coalesce("size", F.lit(0)), "size")
        total = ranged.agg(F.sum(F.col("size").cast("decimal(38,0)"))).first()[0] or 0
        inside = Window.partitionBy("bin").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        size = F.coalesce("size", F.lit(0))
        twice = 2 * (_offset(sizes) + F.coalesce(F.sum(size).over(inside), F.lit(0))) + size
        shard = F.least(_div(twice * shards, 2 * max(int(total), 1)).cast("int"), F.lit(shards - 1))
        done = stage_table(ranged.withColumn("rank", rank).withColumn("shard", shard), "hilbert-shards")
        least = [0] * shards
        for r in done.groupBy("shard").agg(F.min("rank").alias("rank")).collect():      # one row a shard
            least[r["shard"]] = r["rank"]
        done = done.withColumn("slot", F.col("rank") - F.element_at(_array(least), F.col("shard") + 1))
    keep = [c for c in df.columns if c not in ("curve", "shard", "slot")]
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("index").alias("curve"), "shard", "slot")


def write_shards(sharded: DataFrame, path: str, rows_a_file: int = 1 << 20) -> None:
    """Parquet files under ``shard=``, each a run of slots, so that their minima and maxima are narrow."""
    run = _div(F.col("slot"), rows_a_file)
    (sharded.repartitionByRange("shard", run).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").option("maxRecordsPerFile", rows_a_file).mode("overwrite").parquet(path))


def shard_documents(df: DataFrame, shards: int = 16, dims: Sequence[str] = ("source", "lang", "size"), law: str = "rows", bits: int = 6,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every document; the texts are read once."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    named = [d for d in dims if d != "size"]
    slim = df.select(F.col(id_col).alias("id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
                     F.crc32(raw.cast("binary")).alias("crc"), *[F.col(f"`{d}`").alias(f"d{i}") for i, d in enumerate(named)])
    slim = stage_table(slim, "hilbert-documents")
    at = {**{d: f"d{i}" for i, d in enumerate(named)}, "size": "size"}
    out = hilbert_shards(slim, [at[d] for d in dims], shards, law, "size" if law == "bytes" else None, ("size", "crc", "id"), bits)
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(law).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op12_hilbert_shards")
def op12_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))


ORACLE["op12_hilbert_shards"] = r"""
WITH RECURSIVE table_of AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
hexed AS (SELECT *, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (
  SELECT doc_id, lang, source, (len(h) // 2 + 1)::BIGINT AS size,
    xor(list_reduce([4294967295] || list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
                    lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM hexed, table_of),
celled AS (
  SELECT *, ((rank() OVER (ORDER BY source NULLS FIRST) - 1) * 64 // count(*) OVER ())::BIGINT AS a,
         ((rank() OVER (ORDER BY lang NULLS FIRST) - 1) * 64 // count(*) OVER ())::BIGINT AS b,
         ((rank() OVER (ORDER BY size) - 1) * 64 // count(*) OVER ())::BIGINT AS c FROM summed),
walk(a, b, c, level, h, corner, axis) AS (
  SELECT DISTINCT a, b, c, 5, 0::BIGINT, 0::BIGINT, 0 FROM celled
  UNION ALL
  SELECT a, b, c, level - 1, h * 8 + w,
    xor(corner, ((s << (axis + 1)) | (s >> (2 - axis))) & 7), (axis + [0, 1, 1, 2, 2, 1, 1, 0][w + 1] + 1) % 3
  FROM (SELECT *, [0, 0, 0, 3, 3, 6, 6, 5][w + 1]::BIGINT AS s FROM (
    SELECT *, xor(xor(t, t >> 1), t >> 2) AS w FROM (
      SELECT *, ((p >> (axis + 1)) | (p << (2 - axis))) & 7 AS t FROM (
        SELECT *, xor(corner, ((a >> level) & 1) | (((b >> level) & 1) << 1) | (((c >> level) & 1) << 2)) AS p
        FROM walk WHERE level >= 0))))),
ranked AS (
  SELECT doc_id, size, text_crc32, count(*) OVER () AS n,
    row_number() OVER (ORDER BY h, size, text_crc32, doc_id NULLS FIRST) - 1 AS place
  FROM celled JOIN walk USING (a, b, c) WHERE level = -1)
SELECT doc_id, size, text_crc32, 'rows' AS law,
  CASE WHEN place < (n % 16) * (n // 16 + 1) THEN place // (n // 16 + 1)
       ELSE n % 16 + (place - (n % 16) * (n // 16 + 1)) // greatest(n // 16, 1) END::INTEGER AS shard,
  CASE WHEN place < (n % 16) * (n // 16 + 1) THEN place % (n // 16 + 1)
       ELSE (place - (n % 16) * (n // 16 + 1)) % greatest(n // 16, 1) END::BIGINT AS slot,
  NULL::INTEGER AS grown_shard
FROM ranked
"""
