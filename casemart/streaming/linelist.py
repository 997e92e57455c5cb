"""Incremental ingest of raw case line lists with Structured Streaming.

The reference reloads every sheet in full.  When line lists arrive as files
over time, the same stateless cleaning operators run on a file stream:
each micro-batch is cleaned and appended to the intermediate fact table
through ``foreachBatch`` (idempotent per batch id, recoverable from the
checkpoint location), and a second query keeps the per-place case counts
the source validation reports (state in the checkpoint, output written by
the executors).  Both restart exactly where they stopped
after a failure because offsets and state live in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casemart.operators.facts import clean_dated_linelist, clean_undated_linelist


def raw_linelist_stream(spark: SparkSession, path: str, n_cols: int, sep: str = ",",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Headerless positional CSV files under ``path`` as a stream of text
    columns ``_c0.._c{n-1}``."""
    schema = ", ".join(f"_c{i} STRING" for i in range(n_cols))
    reader = spark.readStream.schema(schema).option("header", "false").option("sep", sep)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(path)


def cleaned_stream(raw: DataFrame, category: str, dated: bool = True, reference_year: int = 2026) -> DataFrame:
    if dated:
        return clean_dated_linelist(raw, category)
    return clean_undated_linelist(raw, category, reference_year)


def append_batches(cleaned: DataFrame, target_path: str, checkpoint: str, fmt: str = "parquet",
                   available_now: bool = True) -> StreamingQuery:
    """Write each cleaned micro-batch to its own ``ingest_batch=<id>`` folder of
    ``target_path``.  A replayed batch overwrites its folder, so a failure
    between the write and the commit duplicates nothing; readers of
    ``target_path`` get the batch id as a partition column."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{target_path}/ingest_batch={batch_id}")

    w = cleaned.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def cases_per_place(cleaned: DataFrame, target_path: str, checkpoint: str, fmt: str = "parquet",
                    available_now: bool = True) -> StreamingQuery:
    """Running case count per place: a stateful streaming aggregation whose
    state lives in the checkpoint.  Each trigger writes the complete, updated
    counts to ``counts_batch=<id>`` under ``target_path`` (by the executors,
    nothing is kept on the driver); ``latest_counts`` reads the newest."""
    counts = cleaned.groupBy("bairro").agg(F.count(F.lit(1)).alias("count"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{target_path}/counts_batch={batch_id}")

    w = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def latest_counts(spark: SparkSession, target_path: str, fmt: str = "parquet") -> DataFrame:
    """The counts of the last finished trigger; earlier ones stay readable
    while a new one is written."""
    every = spark.read.format(fmt).load(target_path)
    last = every.agg(F.max("counts_batch")).first()[0]
    return every.filter(F.col("counts_batch") == last).drop("counts_batch")
