"""A training corpus from raw documents: five stages, each written and read again.

1. quality: documents that the classifier rejects go;
2. near_dedup: one document of each group of near copies stays (the smallest id);
3. decontaminate: documents that hold benchmark passages go;
4. pii: personal data in the texts is replaced by surrogates;
5. bpe: the texts become token ids, checked by decoding them again.

A stage takes ``(spark, docs, sf_dir)`` and works on all rows of its
predecessor.  All but the last return the columns of ``docs`` (extra columns
stay; ``n_chars``, where there is one, follows the text).  Rows with a null id
cannot be told apart: they pass the near-duplicate and benchmark stages.
Repeated rows count as one document from the near-duplicate stage on.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.llm.bpe import bpe_digests
from casemart.llm.common import read, ship_package
from casemart.llm.decontaminate import find_leaks
from casemart.llm.near_dedup import near_duplicates
from casemart.llm.pii import replace_pii
from casemart.llm.quality import learn_quality, score_documents
from casemart.session import stage_table

#: Documents whose score is lower are rejected.
QUALITY = 0.7
#: Secret of the surrogates; a real run names its own.
PII_KEY = "corpus-2024"


def _stage(fn):
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, docs, sf_dir)
    return run


@_stage
def quality(spark, docs, sf_dir):
    model = learn_quality(docs, read(spark, sf_dir, "labels"))
    return score_documents(docs, model, score_col="score__").filter(F.col("score__") >= QUALITY).select(*docs.columns)


@_stage
def near_dedup(spark, docs, sf_dir):
    kept = near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    # of rows that share an id the least one stays, whatever the order they are read in
    row = F.struct(*[F.col(c) for c in docs.columns])
    one = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("row")).select("row.*")
    return one.unionByName(docs.filter("doc_id IS NULL"))


@_stage
def decontaminate(spark, docs, sf_dir):
    leaks = find_leaks(docs, read(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


@_stage
def pii(spark, docs, sf_dir):
    clean = replace_pii(docs, PII_KEY, count_col="n_entities__")
    if "n_chars" in docs.columns:
        n = F.when(F.col("n_entities__") > 0, F.length("text")).otherwise(F.col("n_chars"))
        clean = clean.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


@_stage
def bpe(spark, docs, sf_dir):
    import public_tokenizers as P

    return bpe_digests(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, keep=("ids",))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", pii), ("bpe", bpe)]

#: SQL can express neither the classifier nor the latent search; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
