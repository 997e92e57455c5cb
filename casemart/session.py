"""Session helpers.

The library never creates a cluster configuration of its own: callers pass a
SparkSession.  ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "casemart") -> SparkSession:
    """A local SparkSession with the settings the tests and the bench use."""
    parts = shuffle_partitions or (8 if cores == "*" else max(int(cores), 1))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CASEMART_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (once per application), so its Python
    functions load there even where it is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix=f"{root.name}-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))     # Spark's file server hands it to the executors
    _shipped.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it
    from the session.  Only a local master (tests, bench) may fall back to a
    fresh folder under the machine's temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a shared folder "
                "(HDFS/S3/ABFS) before running casemart operators that cut lineage")
        configured = tempfile.mkdtemp(prefix="casemart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def freeze(df):
    """Store a stage output and read it back (the write-then-reload barrier
    between pipeline steps): later branches and retries read the stored
    columns instead of recomputing the lineage, the planner knows their size
    in bytes, and a lost executor does not lose them."""
    return stage_table(df, "frozen")


def stage_table(df, name: str, compression: str = "snappy", partition_by: tuple[str, ...] = ()):
    """Write a stage output as parquet under the shared checkpoint folder and
    read it back (the intermediate tables of the run book).  Unlike a
    checkpoint the result is columnar, so later scans prune columns and push
    filters down; ``partition_by`` lets them skip whole folders."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stages/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=compression, partitionBy=list(partition_by) or None)
    # folders of no rows hold no file to take the columns from
    return (spark.read.schema(df.schema) if partition_by else spark.read).parquet(path)


def stage_counted(df, name: str, null_keys: tuple[str, ...] = (), by: str | None = None, values: tuple[str, ...] = ()):
    """``(stored table, counts)``: ``rows`` and ``<key>_nulls`` are counted while
    the table is written, by the tasks that write it, so no audit scans it again.
    With ``by`` the table stands in a folder for each value of that column, and
    ``rows_<value>`` counts the rows of each of ``values``."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(k).isNull()).alias(f"{k}_nulls") for k in null_keys],
              *[F.count_if(F.col(by) == v).alias(f"rows_{v}") for v in values]]
    table = stage_table(df.observe(seen, *counts), name, partition_by=(by,) if by else ())
    return table, dict(seen.get)
