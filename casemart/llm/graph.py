"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.session import stage_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges`` (columns u, v); the
    component is its smallest node.

    Alternates two rewritings of the edge table that keep its components: every
    node's larger neighbours move to its smallest neighbour, then every node
    and its smaller neighbours do.  Each ends as a star around its smallest
    node after a number of rounds logarithmic in its size.  Every round is
    written to the shared folder, which cuts the lineage.
    """
    now = stage_table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .filter("u <> v").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.union(now.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                                 F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        now = stage_table(small, "edges")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
