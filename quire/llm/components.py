"""Connected components of an edge table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import written


def _to_ends(spark: SparkSession, hooks: DataFrame) -> DataFrame:
    """``hooks`` (node, root, root below node) with each root followed to its
    end; paths halve with every round."""
    while True:
        up = hooks.select(F.col("node").alias("_u"), F.col("root").alias("_up"))
        jumped = written(spark, hooks.join(up, F.col("root") == F.col("_u"), "left")
                         .select("node", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("moved")),
                         "hooks")
        hooks = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return hooks


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node and root, the smallest node reached, of every node of ``edges``
    (a, b) but those that are the smallest themselves.

    Each round hooks every node to its smallest smaller neighbour, follows the
    hooks to their ends and replaces nodes by those ends. Edges that became
    loops or equal go, so what is left shrinks fast; every table has a row per
    edge or node and is written."""
    def proper(df: DataFrame) -> DataFrame:
        pair = df.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return written(spark, pair.distinct(), "edges")

    rest, rounds = proper(edges), []
    while not rest.isEmpty():
        hooks = _to_ends(spark, written(spark, rest.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "hooks"))
        rounds.append(hooks)
        at_a = hooks.select(F.col("node").alias("_a"), F.col("root").alias("_ra"))
        at_b = hooks.select(F.col("node").alias("_b"), F.col("root").alias("_rb"))
        rest = proper(rest.join(at_a, F.col("a") == F.col("_a")).join(at_b, F.col("b") == F.col("_b"), "left")
                      .select(F.col("_ra").alias("a"), F.coalesce("_rb", "b").alias("b")))
    if not rounds:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    final = rounds.pop()
    while rounds:  # ends of an earlier round may have been hooked later
        later = final.select(F.col("node").alias("_l"), F.col("root").alias("_end"))
        earlier = rounds.pop().join(later, F.col("root") == F.col("_l"), "left").select("node", F.coalesce("_end", "root").alias("root"))
        final = written(spark, earlier.unionByName(final), "components")
    return final
