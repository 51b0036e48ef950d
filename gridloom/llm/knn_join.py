"""Exact top-k search by inner product, as a Voronoi join of queries and data.

Queries and data are cut up by the same pivots (a bounded sample).  A summary of each cell tells how many vectors it
holds and how far the nearest ones and the farthest are from the pivot.  From the summaries follows, for each group of
queries, a score that its k-th best surely reaches; a data vector is copied to a group only if its score can reach that.
Groups are solved where they meet their data in running top-k tables.  Where there are fewer groups than tasks, large data
is dealt to shards too, and the shards' tables are merged; with many groups, one task solves a group against all its data.

With q = p + a, v = r + b for pivots p, r:  |<q, v> - <p, r>| <= |p||b| + |r||a| + |a||b|,  and  <q, v> <= <p, v> + |a||v|.

Defined cases: vectors that are null, empty or hold null or non-finite components, and rows without id, take no part;
shorter vectors are filled up with zeros; a query's own row is every row of its id; rows that repeat an id and a vector
are one; with fewer candidates than k all are given; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.llm.common import cut, n_shuffle
from gridloom.llm.vectors import nearest, stacked, usable

#: Queries in a cell, about; most pivots; queries in a part of a cell, at most about; rows of data in a shard, at least; rows scored at a time.
GROUP, MOST_PIVOTS, PART, SHARD, BLOCK = 512, 1024, 4096, 65_536, 1024


def whole_numbers(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) of each usable vector."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).distinct()


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    if len(q) and len(v) and float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q @ v.T


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row of (rows, n) scores and ids, ties to the smaller id."""
    if scores.shape[1] > 4 * k:  # those that the k-th score leaves out can go first; all that tie with it stay
        bar = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        width = int((scores >= bar[:, None]).sum(1).max())
        part = np.argpartition(-scores, min(width, scores.shape[1]) - 1, axis=1)[:, :width]
        scores, ids = np.take_along_axis(scores, part, 1), np.take_along_axis(ids, part, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


#: Below any score, and safe to negate.
EMPTY = -(1 << 62)


def join(rows: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores, from rank 1."""
    spark = rows.sparkSession
    vectors = cut(whole_numbers(rows, scale).withColumn("query", F.coalesce(is_query, F.lit(False))))
    facts = vectors.agg(F.count(F.lit(1)).alias("rows"), F.count_if("query").alias("queries"), F.max(F.size("v")).alias("size")).first()
    shape = "query_id long, rank int, vec_id long, score long"
    if not facts["queries"]:
        return spark.createDataFrame([], shape)
    size, n_pivots = int(facts["size"]), int(min(MOST_PIVOTS, -(-facts["queries"] // GROUP)))
    sample = vectors.orderBy(F.xxhash64(F.lit(17), "vec_id"), "vec_id").limit(n_pivots).select("v")  # bounded by MOST_PIVOTS
    pivots = stacked([r[0] for r in sample.collect()], size)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, square = nearest(stacked(batch.column(1).to_pylist(), size), pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(np.sqrt(square))], [*batch.schema.names, "cell", "far"])

    placed = cut(vectors.mapInArrow(place, "vec_id bigint, v array<bigint>, query boolean, cell int, far double"))
    # k + 1 nearest distances, as one of them may be the query itself
    near = placed.withColumn("r", F.row_number().over(W.partitionBy("cell", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("far"))).where(F.col("r") <= k + 1)
    summary = placed.groupBy("cell").agg(F.max(F.when(F.col("query"), F.col("far"))).alias("reach"), F.count_if("query").alias("queries")).collect()  # a row a pivot
    closest = near.groupBy("cell").agg(F.slice(F.array_sort(F.collect_list("far")), 1, k + 1).alias("far")).collect()  # k + 1 numbers a pivot
    reach = {r["cell"]: (r["reach"], r["queries"]) for r in summary if r["queries"]}
    distances = {r["cell"]: np.array(r["far"]) for r in closest}
    norms = np.sqrt((pivots**2).sum(1))
    sure: dict[int, float] = {}
    cells = np.repeat(list(distances), [len(d) for d in distances.values()])
    far = np.concatenate(list(distances.values()))
    for g, (a, _) in reach.items():  # at most MOST_PIVOTS times k + 1 numbers for each of MOST_PIVOTS
        low = (pivots @ pivots[g])[cells] - norms[g] * far - norms[cells] * a - a * far
        sure[g] = float(np.partition(low, len(low) - k - 1)[len(low) - k - 1]) if len(low) > k else -np.inf
    groups = sorted(reach)
    centre, radius, bar = pivots[groups], np.array([reach[g][0] for g in groups]), np.array([sure[g] for g in groups])
    parts = {g: -(-reach[g][1] // PART) for g in groups}
    shards = max(1, min(n_shuffle(spark) // sum(parts.values()), facts["rows"] // SHARD))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = stacked(batch.column(1).to_pylist(), size)
            can = v @ centre.T + radius[None, :] * np.sqrt((v**2).sum(1))[:, None] + 1e-6 * (1 + np.abs(bar[None, :])) >= bar[None, :]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([[groups[j] for j in np.flatnonzero(c)] for c in can], pa.list_(pa.int32()))], ["vec_id", "v", "groups"])

    n_parts = F.element_at(F.create_map(*(F.lit(x) for g in groups for x in (g, parts[g]))), F.col("cell"))
    hashed = F.xxhash64("vec_id")
    data = (
        placed.select("vec_id", "v").mapInArrow(needed, "vec_id bigint, v array<bigint>, groups array<int>")
        .select("vec_id", "v", F.explode("groups").alias("cell"))
        .select("cell", F.explode(F.sequence(F.lit(0), n_parts - 1)).alias("part"), F.pmod(hashed, F.lit(shards)).cast("int").alias("shard"), F.lit(1).alias("kind"), "vec_id", "v")
    )
    asked = placed.where("query").select("cell", F.pmod(F.shiftright(hashed, 8), n_parts).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(0).alias("kind"), "vec_id", "v")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result() -> pa.RecordBatch:
            ok = best != EMPTY
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, ok.sum(1))), pa.array(best_ids[ok]), pa.array(best[ok])], ["query_id", "vec_id", "score"])

        key, q_ids = None, np.zeros(0, np.int64)
        for batch in batches:
            names = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]])
            ids, vectors = batch.column(4).to_numpy(), stacked(batch.column(5).to_pylist(), size, np.int64)
            edges = [0, *(np.flatnonzero((np.diff(names, axis=1) != 0).any(0)) + 1), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if tuple(names[:3, a]) != key:
                    if len(q_ids):
                        yield result()
                    key, q_ids, q = tuple(names[:3, a]), np.zeros(0, np.int64), np.zeros((0, size), np.int64)
                    best = best_ids = np.zeros((0, k), np.int64)
                if names[3, a] == 0:
                    q_ids, q = np.append(q_ids, ids[a:b]), np.vstack([q, vectors[a:b]])
                    best, best_ids = np.full((len(q_ids), k), EMPTY), np.zeros((len(q_ids), k), np.int64)
                    continue
                for i in range(a, b if len(q_ids) else a, BLOCK):
                    e = min(i + BLOCK, b)
                    scores = products(q, vectors[i:e])
                    scores[q_ids[:, None] == ids[None, i:e]] = EMPTY
                    every = np.broadcast_to(ids[None, i:e], scores.shape)
                    best, best_ids = top(np.hstack([best, scores]), np.hstack([best_ids, every]), k)
        if len(q_ids):
            yield result()

    met = asked.unionByName(data).repartition(n_shuffle(spark), "cell", "part", "shard").sortWithinPartitions("cell", "part", "shard", "kind")
    found = met.mapInArrow(solve, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))  # k rows a shard
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
