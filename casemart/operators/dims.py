"""Dimensions and surrogate keys.

``ordinal`` is the scalable replacement for ``row_number() OVER (ORDER BY k)``
without PARTITION BY, which Spark runs in a single task.  The rows are
range-partitioned on the order columns (sampled bounds, balanced even when
one key prefix is hot) and sorted inside each partition; a reliable
checkpoint freezes that layout (recomputing a range partitioning could draw
other bounds).  One tiny job counts the rows of each partition (one integer
per partition reaches the driver), and each row's position is then
``offset[partition] + index within the partition`` - a narrow projection
over the checkpoint: no window, no single-task stage, no second shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.functions.calendar import month_label, year_month_id, year_month_label
from casemart.functions.text import normalize_key
from casemart.session import checkpoint_dir, freeze, stage_table

_PID = "_cm_pid"


def ordinal(df: DataFrame, order_cols: Sequence[str], out_col: str,
            num_buckets: int | None = None) -> DataFrame:
    """Add a 1-based position ``out_col`` following the total order of
    ``order_cols`` (ascending, nulls first as in Spark's default).

    The order must be total (unique order keys) for the result to be
    deterministic; ``dense_ids`` guarantees that by working on distinct keys.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    ordered = [F.col(c).asc() for c in order_cols]
    # without an explicit count AQE may coalesce adjacent range partitions
    # (order is kept), so a two-key dimension does not write thousands of
    # empty checkpoint files on a cluster
    ranged = (df.repartitionByRange(num_buckets, *ordered) if num_buckets
              else df.repartitionByRange(*ordered))
    frozen = ranged.sortWithinPartitions(*ordered).checkpoint(eager=True)
    sizes = dict(frozen.groupBy(F.spark_partition_id().alias(_PID)).count().collect())
    parts = frozen.rdd.getNumPartitions()
    offsets = [0] + list(accumulate(sizes.get(i, 0) for i in range(parts)))[:-1]
    # monotonically_increasing_id() = (partition index << 33) + row index in
    # the partition; the checkpoint is read back in the order it was written
    pid = F.spark_partition_id()
    index = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    offset = F.element_at(F.array(*[F.lit(o) for o in offsets]), pid + 1)
    return frozen.withColumn(out_col, (offset + index + 1).cast("int"))


def dense_ids(keys: DataFrame, key_col: str, id_col: str,
              num_buckets: int | None = None) -> DataFrame:
    """Dimension ``(id_col, key_col)`` with ids 1..n in ascending key order.

    NULL and empty keys are dropped first, duplicates collapse (partial
    aggregation before the shuffle).
    """
    distinct = (keys.select(key_col)
                .filter(F.col(key_col).isNotNull() & (F.col(key_col) != ""))
                .distinct())
    return ordinal(distinct, [key_col], id_col, num_buckets).select(id_col, key_col)


def build_dimension(sources: Sequence[DataFrame], key_col: str, id_col: str,
                    normalize=normalize_key, num_buckets: int | None = None) -> DataFrame:
    """Category dimension from several single-column sources.

    Each source's ``key_col`` is normalized, the union is filtered and made
    distinct, and dense ids follow the key order.
    """
    frames = [s.select(normalize(F.col(key_col)).alias(key_col)) if normalize else
              s.select(key_col) for s in sources]
    return dense_ids(reduce(DataFrame.unionByName, frames), key_col, id_col, num_buckets)


def build_dimensions(sources: Sequence[tuple], ids: Mapping[str, str], num_buckets: int | None = None) -> dict[str, DataFrame]:
    """Several category dimensions ``(id, key)`` in one pass over their sources.

    Each source ``(frame, key columns, normalize)`` is scanned once: its distinct
    combinations of raw keys (partial aggregation before the shuffle), of which
    the normalized keys go on (``normalize`` None: as they are), tagged with
    their dimension.  One range sort
    over (dimension, key) numbers all of them; an id is the position less the
    positions of the dimensions before it.  ``ids`` names the id column of every
    key column.  NULL and empty keys are dropped; a dimension without keys is empty.
    """
    def tagged(frame: DataFrame, cols: Sequence[str], normalize) -> DataFrame:
        keys = [F.struct(F.lit(c).alias("dim"), (normalize(F.col(c)) if normalize else F.col(c)).alias("key")) for c in cols]
        return frame.select(*cols).distinct().select(F.inline(F.array(*keys)))

    keys = (reduce(DataFrame.unionByName, [tagged(*s) for s in sources])
            .filter(F.col("key").isNotNull() & (F.col("key") != "")).distinct())
    table = stage_table(ordinal(keys, ["dim", "key"], "position", num_buckets), "dimensions", partition_by=("dim",))
    first = {r["dim"]: r["first"] for r in table.groupBy("dim").agg(F.min("position").alias("first")).collect()}   # one row a dimension
    return {c: table.filter(F.col("dim") == c).select((F.col("position") - F.lit(first.get(c, 1) - 1)).cast("int").alias(i), F.col("key").alias(c))
            for c, i in ids.items()}


def calendar_dimension(series: Sequence[DataFrame] = (), dated: Sequence[tuple[DataFrame, str]] = (),
                       year_col: str = "ano", label_col: str = "mes", ordinal_col: str = "ordem_mes",
                       id_col: str = "id_tempo", year_month_col: str = "ano_mes") -> DataFrame:
    """Monthly calendar dimension.

    ``series`` frames contribute their ``(year, label, ordinal)`` triples,
    ``dated`` frames ``(df, date_col)`` contribute the months of their non-null
    dates.  ``id_tempo`` is ``yyyymm`` and ``ano_mes`` is ``yyyy-mm``.
    """
    parts = [s.select(year_col, label_col, ordinal_col) for s in series]
    for df, date_col in dated:
        d = F.col(date_col)
        parts.append(df.filter(d.isNotNull()).select(
            F.year(d).alias(year_col), month_label(F.month(d)).alias(label_col),
            F.month(d).alias(ordinal_col)))
    if not parts:
        raise ValueError("calendar_dimension needs at least one source")
    months = (reduce(DataFrame.unionByName, parts)
              .filter(F.col(year_col).isNotNull() & F.col(ordinal_col).isNotNull())
              .distinct())
    y, m = F.col(year_col), F.col(ordinal_col)
    # a dimension is a stored table: checkpoint it once (months are few)
    return freeze(months.select(year_month_id(y, m).alias(id_col), year_col, label_col, ordinal_col,
                                year_month_label(y, m).alias(year_month_col)))


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, deterministic survivor: the row whose ``order``
    struct (default: all other columns) is smallest.

    Implemented as ``min_by`` aggregation, so the work is combined map-side
    and a hot key does not pile its rows into one task.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    payload = F.struct(*[F.col(c) for c in others])
    ordering = F.struct(*(order or [F.col(c) for c in others]))
    return (df.groupBy(*keys)
            .agg(F.min_by(payload, ordering).alias("_cm_row"))
            .select(*keys, *[F.col("_cm_row")[c].alias(c) for c in others]))
