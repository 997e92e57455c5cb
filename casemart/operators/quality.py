"""Data-quality audits that report before they fail.

Every check is an aggregate DataFrame (one pass per relation, many checks in
one ``agg``); ``raise_on_failure`` turns a report into an exception listing
every failed check at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``<key>_nulls`` per key column."""
    return df.agg(*[F.sum(F.col(k).isNull().cast("int")).cast("long").alias(f"{k}_nulls") for k in keys])


def rows_with_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(or_, [F.col(k).isNull() for k in keys]))


def null_key_audit(facts: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Long report ``(table_name, key_column, nulls)`` for every fact/key."""
    parts = []
    for name, (df, keys) in facts.items():
        wide = null_key_counts(df, keys)
        stack = F.inline(F.array(*[F.struct(F.lit(k).alias("key_column"),
                                            F.coalesce(F.col(f"{k}_nulls"), F.lit(0)).cast("long").alias("nulls"))
                                   for k in keys]))
        parts.append(wide.select(F.lit(name).alias("table_name"), stack))
    return reduce(DataFrame.unionByName, parts)


def row_preservation(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``(label, original, final, preserved)``: catches fan-out from
    non-unique dimension keys and rows lost by inner joins."""
    parts = []
    for label, (orig, final) in pairs.items():
        parts.append(orig.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("label"),
                                                                  F.lit("original").alias("kind"), "n"))
        parts.append(final.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("label"),
                                                                   F.lit("final").alias("kind"), "n"))
    counts = reduce(DataFrame.unionByName, parts)
    return (counts.groupBy("label")
            .agg(F.max(F.when(F.col("kind") == "original", F.col("n"))).alias("original"),
                 F.max(F.when(F.col("kind") == "final", F.col("n"))).alias("final"))
            .withColumn("preserved", F.col("original") == F.col("final")))


def forbidden_columns(frames: Mapping[str, DataFrame], forbidden: Sequence[str]) -> list[tuple[str, str]]:
    """``(table, column)`` for every forbidden column still present."""
    return [(name, c) for name, df in frames.items() for c in df.columns if c in set(forbidden)]


def fatal_spatial_checks(cases_geo_df: DataFrame, weight: str | None = None) -> DataFrame:
    """One pass: total rows, rows without place id, without status, without
    plot coordinates, and the list of failed checks."""
    one = F.lit(1).cast("long") if weight is None else F.col(weight)

    def rows(bad):
        return F.coalesce(F.sum(F.when(bad, one)), F.lit(0).cast("long"))

    agg = cases_geo_df.agg(
        rows(F.lit(True)).alias("rows_geo"),
        rows(F.col("id_bairro").isNull()).alias("rows_without_neighborhood_id"),
        rows(F.col("spatial_status").isNull()).alias("rows_without_spatial_status"),
        rows(F.col("latitude_plot").isNull() | F.col("longitude_plot").isNull()).alias("rows_without_plot_coordinates"))
    errors = F.array_compact(F.array(
        F.when(F.col("rows_geo") == 0, F.lit("zero rows")),
        F.when(F.col("rows_without_neighborhood_id") != 0, F.lit("null id_bairro")),
        F.when(F.col("rows_without_spatial_status") != 0, F.lit("null spatial_status")),
        F.when(F.col("rows_without_plot_coordinates") != 0, F.lit("null plot coordinates"))))
    return agg.withColumn("fatal_errors", F.array_join(errors, " | "))


def raise_on_failure(report: DataFrame, error_col: str = "fatal_errors") -> None:
    """Collect the one-row report and raise if it lists errors."""
    row = report.select(error_col).first()
    if row and row[0]:
        raise ValueError(f"validation failed: {row[0]}")


def match_summary(standardized: DataFrame) -> DataFrame:
    return standardized.groupBy("match_method", "needs_review").agg(F.count(F.lit(1)).alias("records"))


def names_per_canonical(standardized: DataFrame) -> DataFrame:
    return (standardized.filter(F.col("id_bairro_canonico").isNotNull())
            .groupBy("id_bairro_canonico", "bairro_padronizado").agg(F.count(F.lit(1)).alias("source_names")))


def curation_null_check(curated: DataFrame) -> DataFrame:
    return curated.agg(
        F.count(F.when(F.col("id_bairro").isNull(), True)).alias("null_id_bairro"),
        F.count(F.when(F.col("bairro_original").isNull(), True)).alias("null_bairro_original"),
        F.count(F.when(F.col("id_bairro_canonico").isNull(), True)).alias("null_id_bairro_canonico"),
        F.count(F.when(F.col("bairro_padronizado").isNull(), True)).alias("null_bairro_padronizado"))


def series_summary(series: DataFrame, keys: Sequence[str] = ("doenca", "ano")) -> DataFrame:
    """Rows and measure sums per category and year (source validation)."""
    return series.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("casos").alias("casos"),
                                     F.sum("obitos").alias("obitos"))
