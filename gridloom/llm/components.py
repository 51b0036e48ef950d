"""Connected components of a graph kept as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut, join_hot, n_shuffle

#: A task of a round takes so many edges, and a round has so many tasks at least, so that files follow the edges' number.
EDGES, LEAST_TASKS = 4096, 8


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, root): for each node that has an edge, the least node that it can reach.

    Alternates the large-star and small-star steps of Kiveris and others (2014) until nothing moves: every step is an
    aggregation (combined before the shuffle) and a join, and each round is cut by a checkpoint.  Nodes with very many
    edges are told to every task (``join_hot``).  Loops and repeated edges do no harm; no edges give an empty table.
    """
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where(F.col("u") != F.col("v"))
    now = cut(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        tasks = min(n_shuffle(edges.sparkSession), max(LEAST_TASKS, now.count() // EDGES))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
        sums = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), *sums).coalesce(tasks))
        state = least.agg(F.sum("n").alias("n"), F.sum("sum"), F.max("n").alias("most")).first()
        if state == seen or not state["n"]:
            break
        seen = state
        above = both.where(F.col("v") > F.col("u"))
        if state["most"] > 100:
            met = join_hot(above, least.drop("sum"), ["u"], "n", state["n"])
        else:
            met = above.join(least.drop("sum", "n"), "u")
        large = met.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).coalesce(tasks).distinct().coalesce(tasks)
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lower.select("u", F.col("m").alias("v")))
        now = cut(small.where(F.col("u") != F.col("v")).coalesce(tasks).distinct().coalesce(tasks))
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
