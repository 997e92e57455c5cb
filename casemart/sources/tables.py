"""Sources, schema fitting, sinks and load reconciliation.

Sinks are ordinary Spark writers (any format, or JDBC through the same
``DataFrameWriter``), so data never passes through the driver; the ordered
load, its reconciliation and the object audit are DataFrames of counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casemart.session import freeze, stage_table


# ------------------------------------------------------------------ sources

def read_raw_sheet(spark: SparkSession, path: str, n_cols: int, sep: str = ",", encoding: str = "UTF-8"
                   ) -> DataFrame:
    """Headerless positional CSV, every column read as text (``_c0..``)."""
    schema = ", ".join(f"_c{i} STRING" for i in range(n_cols))
    return spark.read.csv(path, header=False, schema=schema, sep=sep, encoding=encoding)


def with_file_position(df: DataFrame, out_col: str = "row_id") -> DataFrame:
    """1-based row position in file order: by file path, then place in the file.

    ``df`` reads files or a table of files, which may be cut into any number of
    splits.  A task reads a split's rows in order, so within a split the row
    number follows ``monotonically_increasing_id``; the splits are put in order
    by path and start of the split, and a split's rows begin after those of the
    splits before it.  The rows are stored once with their split, as a scan may
    be cut otherwise the next time; only one row a split is counted and summed.
    """
    source = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    rows = stage_table(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), source.alias("split"),
                                 F.monotonically_increasing_id().alias("at")), "file-position")
    splits = rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1))     # a row a split
    splits = freeze(splits.select("split", "first", F.coalesce(before, F.lit(0)).alias("before")))
    return (rows.join(splits, "split")
            .select("row.*", (F.col("before") + F.col("at") - F.col("first") + 1).alias(out_col)))


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """In-code rule/reference table with an explicit schema (nullability
    included); small by construction."""
    return spark.createDataFrame(list(rows), schema)


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    """Typed empty stand-in for an optional input."""
    return spark.createDataFrame([], ddl)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Raise listing every missing table/view."""
    missing = [n for n in names if not table_exists(spark, n)]
    if missing:
        raise ValueError("missing required objects: " + ", ".join(missing))


def require_columns(df: DataFrame, required: Sequence[str], what: str = "input") -> None:
    """Raise listing required columns absent from ``df`` (checked before any
    plan is built, so it costs no job)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns in {what}: {missing}")


@dataclass(frozen=True)
class Resolved:
    name: str | None
    mode: str


def resolve_source(spark: SparkSession, preferences: Sequence[tuple[str, str]], missing_mode: str | None = "missing"
                   ) -> Resolved:
    """First existing table of ``[(name, mode), ...]``; the chosen mode is a
    value the plan can use.  ``missing_mode=None`` raises instead."""
    for name, mode in preferences:
        if table_exists(spark, name):
            return Resolved(name, mode)
    if missing_mode is None:
        raise ValueError("none of the sources exists: " + ", ".join(n for n, _ in preferences))
    return Resolved(None, missing_mode)


# ------------------------------------------------------------ schema fitting

def fit_schema(df: DataFrame, columns: Mapping[str, str], keep_extra: bool = False,
               defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Make ``df`` carry every column of ``columns`` (name -> SQL type):
    absent ones become a default or a typed NULL, all in one projection."""
    defaults = defaults or {}
    exprs = []
    for name, typ in columns.items():
        if name in df.columns:
            exprs.append(F.col(name))
        else:
            exprs.append(F.lit(defaults.get(name)).cast(typ).alias(name))
    extra = [F.col(c) for c in df.columns if c not in columns] if keep_extra else []
    return df.select(*exprs, *extra)


@dataclass(frozen=True)
class Alignment:
    frame: DataFrame
    selected: list[str]
    missing: list[str]
    extra: list[str]


def align_to_target(df: DataFrame, target_columns: Sequence[str], target_schema: StructType | None = None
                    ) -> Alignment:
    """Target-ordered projection: keep target columns present in ``df``,
    report absent and extra ones; raise when nothing matches.  With a
    ``target_schema`` the kept columns are cast to the target types."""
    selected = [c for c in target_columns if c in df.columns]
    missing = [c for c in target_columns if c not in df.columns]
    extra = [c for c in df.columns if c not in target_columns]
    if not selected:
        raise ValueError("no matching columns between source and target")
    types = {f.name: f.dataType for f in target_schema.fields} if target_schema else {}
    exprs = [F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in selected]
    return Alignment(df.select(*exprs), selected, missing, extra)


# ------------------------------------------------------------------- sinks

def write_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                path: str | None = None, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None
                ) -> None:
    """Overwrite (schema replaced) or append a table; ``path`` writes files
    instead of a catalog table."""
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    if mode == "overwrite":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w.save(path)
    else:
        w.saveAsTable(name)


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Overwrite a catalog table so that a failed write leaves the old one.

    The rows go to a fresh folder beside the table; only when all are there is
    the table pointed to it, by one change of its location where the columns are
    the same, else by making it anew.  ``df`` may read the table it replaces.
    The folder of the version before stays, for sessions that still read it.
    """
    spark = df.sparkSession
    db, _, table = name.rpartition(".")
    described = spark.sql(f"DESCRIBE DATABASE {db or spark.catalog.currentDatabase()}").filter("info_name = 'Location'").first()
    path = f"{described.info_value.rstrip('/')}/{table}-{uuid.uuid4().hex}"
    df.write.format(fmt).save(path)
    if table_exists(spark, name) and spark.table(name).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def write_ordered(df: DataFrame, path: str, order: Sequence[Column], fmt: str = "parquet") -> None:
    """Files in global order: the rows are range-partitioned on ``order`` (sampled
    bounds) and sorted within each partition, so file names follow the order and
    nothing passes through one task.  A preview needs no file:
    ``df.orderBy(...).limit(n)`` keeps the n first of each task and merges those."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.format(fmt).save(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append",
               batch_size: int = 1000, truncate: bool = False) -> None:
    """Relational sink: executors write their partitions in batches of
    ``batch_size`` (default of the reference load); ``truncate`` keeps the
    table definition on overwrite."""
    (df.write.mode(mode).option("batchsize", str(batch_size)).option("truncate", str(truncate).lower())
     .jdbc(url, table, properties=dict(properties)))


def count_rows(frames: Mapping[str, DataFrame], count_col: str = "rows", spark: SparkSession | None = None) -> DataFrame:
    """One row ``(object_name, rows)`` per frame, as a single union of
    aggregates (one job, each frame scanned once); empty for no frames."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(name).alias("object_name"), count_col)
             for name, df in frames.items()]
    if not parts:
        spark = spark or SparkSession.active()
        return spark.createDataFrame([], f"object_name string, {count_col} bigint")
    return reduce(DataFrame.unionByName, parts)


def content_differences(source: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """One row: how many rows of ``source``, aligned to the columns and types of
    ``target``, the target lacks or has too many of (repeated rows count)."""
    aligned = align_to_target(source, target.columns, target.schema)
    want, have = aligned.frame, target.select(*aligned.selected)
    return (want.withColumn("_side", F.lit(1)).unionByName(have.withColumn("_side", F.lit(-1)))
            .groupBy(*aligned.selected).agg(F.sum("_side").alias("_n"))
            .agg(F.coalesce(F.sum(F.greatest("_n", F.lit(0))), F.lit(0).cast("long")).alias("rows_missing"),
                 F.coalesce(F.sum(F.greatest(-F.col("_n"), F.lit(0))), F.lit(0).cast("long")).alias("rows_unexpected"))
            .select(F.lit(name).alias("object_name"), F.lit(len(aligned.selected)).alias("columns_compared"),
                    "rows_missing", "rows_unexpected"))


def reconcile(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Source vs target row counts per object, with a match flag."""
    s = source_counts.withColumnRenamed("rows", "source_rows")
    t = target_counts.withColumnRenamed("rows", "target_rows_after_export")
    return (s.join(t, "object_name", "full")
            .withColumn("matches", F.coalesce(F.col("source_rows") == F.col("target_rows_after_export"),
                                              F.lit(False))))


def ordered_load(tables: Sequence[tuple[str, DataFrame]], write) -> list[str]:
    """Write tables in dependency order (dimensions before facts); ``write``
    is ``(name, df) -> None``.  Returns the names written, in order."""
    done = []
    for name, df in tables:
        write(name, df)
        done.append(name)
    return done


def audit_objects(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Row count and status (``ok`` or ``error: <first 200 chars>``) of each
    table or view.  Every object is counted by a job of its own, so one that
    fails, be it in analysis or while it runs, becomes a row."""
    rows = []
    for name in names:
        try:
            rows.append((name, spark.table(name).count(), "ok"))
        except Exception as exc:  # noqa: BLE001 - the message becomes data
            rows.append((name, None, f"error: {str(exc)[:200]}"))
    return spark.createDataFrame(rows, "object_name string, row_count bigint, status string")
