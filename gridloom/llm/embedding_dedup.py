"""Near-duplicate vectors by product quantisation with coarse lists.

1. Vectors equal in every component are one class; only classes go on.
2. Coarse centres and the codebooks of the residuals' subspaces are trained on a bounded sample (TRAIN classes).
3. Every class is encoded: its nearest centre's list, a code a subspace, and how far its code is from it.  Lists are
   packed into blocks, a large list into several, and each keeps the radius that its members reach.
4. A class is sent, as a query, to every block that can hold a partner.  A list can't if the query is further from its
   centre than its radius and the threshold's distance together, or further than the latter from the plane half-way
   between its centre and the query's own, as members lie on their own centre's side.  A pair of blocks meets one way.
5. In a block, a query works out its product with every code word once, a table a subspace, and reads its distance to each
   member off these tables by the member's codes.  A pair goes on if that distance less the member's own coding error can
   be within the threshold, which loses no pair, and is then decided by its cosine in double precision.
6. Queries of a block that very many visit are dealt out in shares, each with the block's members: a share for so many of
   the block's own visits, so that members are copied no more often than a fixed part of the visits.
7. A task returns a row a class: its links there and one class it hangs together with.  These are summed and joined up.

No pair is lost.  The bounds prune as far as lists are tight and apart; vectors without structure, and large groups of
near copies, meet all of their like.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; shorter
vectors are filled up with zeros; rows that repeat a vec_id are vectors of their own, and share the id's component by it
only; an empty table gives an empty one; other columns, labels too, play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut, join_hot, n_shuffle
from gridloom.llm.components import connected_components
from gridloom.llm.vectors import k_means, nearest, stacked, usable

#: Classes in the training sample; members of a block; queries at a time.
TRAIN, BLOCK, QUERIES = 20_000, 2048, 256
SUBSPACES, CODEWORDS, MOST_LISTS = 8, 256, 65_536
#: Queries in a share of a block, in blocks; blocks up to which the busy ones' shares are broadcast (two numbers each).
VISITS, MOST_SHARED = 16, 1_000_000
#: Above the rounding of distances between unit vectors in double and of their squares in single precision.
SLACK, SLACK_32 = 1e-6, 1e-4


class Quantiser:
    """Coarse centres, and codebooks for the subspaces of what is left."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 9) -> None:
        rng = np.random.default_rng(seed)
        self.centres = k_means(sample, lists, 8, rng)
        which, _ = nearest(sample, self.centres)
        rest = sample - self.centres[which]
        self.parts = [p for p in np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))]
        self.books = [k_means(rest[:, p], CODEWORDS, 6, rng) for p in self.parts]

        self.gaps = np.sqrt(np.maximum(_squares(self.centres, self.centres), 0))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, distance from its centre, codes and coding error of each row."""
        which, far = nearest(x, self.centres)
        rest = x - self.centres[which]
        coded = [nearest(rest[:, p], b) for p, b in zip(self.parts, self.books, strict=True)]
        return which, np.sqrt(far), np.stack([c for c, _ in coded], 1).astype(np.uint8), np.sqrt(sum(d for _, d in coded))

    def squares(self, which: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared lengths of coded vectors."""
        out = self.centres[which].copy()
        for k, (p, b) in enumerate(zip(self.parts, self.books, strict=True)):
            out[:, p] += b[codes[:, k]]
        return (out**2).sum(1)

    def products(self, x: np.ndarray, which: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """(rows of x, coded vectors): their products, read off a table for each row and subspace."""
        lists, place = np.unique(which, return_inverse=True)
        out = np.take((x @ self.centres[lists].T).astype(np.float32), place, axis=1)
        for k, (p, b) in enumerate(zip(self.parts, self.books, strict=True)):
            out += np.take((x[:, p] @ b.T).astype(np.float32), codes[:, k], axis=1)
        return out

    def possible(self, x: np.ndarray, home: np.ndarray, radius: np.ndarray, reach: float) -> np.ndarray:
        """(rows, lists): whether a list, of that radius, can hold a vector within reach of the row; negative radius: none."""
        d = np.maximum(_squares(x, self.centres), 0)
        beyond = d - d[np.arange(len(x)), home][:, None]
        return (np.sqrt(d) <= radius[None, :] + reach + SLACK) & (beyond <= 2 * self.gaps[home] * (reach + SLACK) + SLACK) & (radius >= 0)[None, :]


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ y.T + (y**2).sum(1)[None, :]


def unit(rows: list, size: int) -> np.ndarray:
    return _unit(stacked(rows, size))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # first, so that no square overflows
    return x / np.sqrt((x**2).sum(1))[:, None]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """As stacked, from lists without nulls in an Arrow column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == size).all():
        return flat.reshape(-1, size)
    out = np.zeros((len(lengths), size))
    out[np.arange(size)[None, :] < lengths[:, None]] = flat
    return out


def links(rows: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row a vector."""
    spark = rows.sparkSession
    vector = F.col("embedding")
    good = usable(vector) & F.exists(vector, lambda x: x != 0)
    named = rows.select("vec_id", vector, good.alias("good"))
    mark = F.when(F.col("good"), F.concat_ws("-", F.hex(F.xxhash64(vector)), F.hex(F.xxhash64(F.lit(5), vector))))
    named = named.withColumn("mark", mark)
    classes = cut(named.where("good").groupBy("mark").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first(vector).alias("embedding")))
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("size")).first()
    if not facts["n"]:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    size = int(facts["size"])
    found = cut(_met(classes, int(facts["n"]), size, threshold, _trained(classes, int(facts["n"]), size)))
    sums = found.groupBy("mark").agg(F.sum("n_links").alias("more"))
    joined = connected_components(found, "mark", "parent").withColumnRenamed("node", "mark").join(classes.select("mark", "first_id"), "mark")
    roots = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = joined.join(roots, "root").select("mark", "component_id")
    of = classes.select("mark", "first_id", "copies").join(sums, "mark", "left").join(component, "mark", "left")
    of = of.select("mark", "copies", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).cast("long").alias("n_links"), F.coalesce("component_id", "first_id").alias("component_id"))
    good = named.where("good").select("vec_id", "mark")
    total = classes.agg(F.sum("copies")).first()[0]
    out = join_hot(good, cut(of), ["mark"], "copies", total).select("vec_id", "n_links", "component_id")
    out = out.unionByName(named.where(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _trained(classes: DataFrame, n: int, size: int) -> Quantiser:
    sample = classes.orderBy(F.xxhash64(F.lit(31), "mark"), "mark").limit(TRAIN).select("embedding").toPandas()
    return Quantiser(unit(sample["embedding"].tolist(), size), max(1, min(MOST_LISTS, TRAIN // 8, math.isqrt(n))))


def _blocks(lists: list[tuple[int, int, float]], centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """First block, number of blocks and radius of each list, from (list, members, radius), and the number of all blocks."""
    first, count, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres), np.int64), np.full(len(centres), -1.0)
    middle = centres - centres.mean(0)
    along = middle @ np.linalg.svd(middle, full_matrices=False)[2][0]  # so that a block's lists lie close together
    blocks, room = 0, 0
    for at, members, far in sorted(lists, key=lambda x: (along[x[0]], x[0])):
        radius[at] = far
        if members > room:
            count[at] = -(-members // BLOCK)
            first[at], blocks = blocks, blocks + int(count[at])
            room = BLOCK - members if count[at] == 1 else 0
        else:
            first[at], count[at], room = blocks - 1, 1, room - members
    return first, count, radius, blocks


def _met(classes: DataFrame, n: int, size: int, threshold: float, quantiser: Quantiser) -> DataFrame:
    """(mark, n_links, parent): what each class finds in each meeting of queries and a block."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(quantiser)  # at most TRAIN / 8 centres, and SUBSPACES books
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))  # distance of unit vectors at the threshold

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, far, codes, error = shared.value.encode(_unit(_matrix(batch.column(2), size)))
            columns = [pa.array(home.astype(np.int32)), pa.array(far), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "home", "far", "codes", "error"])

    kind = dict(classes.dtypes)["embedding"]
    fields = f"mark string, copies bigint, embedding {kind}, home int, far double, codes binary, error double"
    coded = cut(classes.select("mark", "copies", "embedding").mapInArrow(encode, fields))
    lists = coded.groupBy("home").agg(F.count(F.lit(1)).alias("members"), F.max("far").alias("radius")).collect()  # a row a list
    first, count, radius, blocks = _blocks([tuple(r) for r in lists], quantiser.centres)
    layout = spark.sparkContext.broadcast((first, count, radius))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, count, radius = layout.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                home = batch.column(3).to_numpy()
                own = first[home] + batch.column(7).to_numpy() % count[home]
                possible = shared.value.possible(_unit(_matrix(batch.column(2), size)), home, radius, reach)
                visits = []
                for o, row in zip(own, possible, strict=True):
                    k = np.flatnonzero(row)
                    many = count[k]
                    b = np.unique(np.repeat(first[k] - np.cumsum(many) + many, many) + np.arange(many.sum()))
                    visits.append(b[(b != o) & ((b > o) == ((b + o) % 2 == 0))].astype(np.int32))  # of two blocks, one goes to the other
                columns = [pa.array(own.astype(np.int32)), pa.array(visits, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:7], *columns], [*batch.schema.names[:7], "own", "visits"])

    placed = cut(coded.withColumn("of", F.abs(F.xxhash64("mark") % 1_000_003)).mapInArrow(visit, fields + ", own int, visits array<int>"))
    visited = placed.select(F.explode("visits").alias("block")).groupBy("block").agg(F.count(F.lit(1)).alias("visits"))
    # blocks that more than so many queries visit: no more than all visits divided by that
    each = VISITS * BLOCK
    busy = cut(visited.where(F.col("visits") > each).select("block", F.ceil(F.col("visits") / each).cast("int").alias("shares")))
    busy = F.broadcast(busy) if blocks <= MOST_SHARED else busy
    share = F.pmod(F.xxhash64(F.lit(7), "mark"), F.coalesce("shares", F.lit(1))).cast("int")
    body = ["mark", "copies", "embedding"]
    codes = ["home", "codes", "error"]
    # among themselves, a block's members are queries of one share each
    own = placed.withColumn("block", F.col("own")).join(busy, "block", "left")
    members = own.select("block", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)).alias("share"), F.lit(0).alias("kind"), share.alias("asks"), *body, *codes)
    asked = placed.select(F.explode("visits").alias("block"), *body).join(busy, "block", "left")
    queries = asked.select("block", share.alias("share"), F.lit(1).alias("kind"), F.lit(-1).alias("asks"), *body, *(F.lit(None).cast(t).alias(c) for c, t in zip(codes, ("int", "binary", "double"), strict=True)))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, parts = None, None, []
        for batch in batches:
            block, part, asking = (batch.column(k).to_numpy() for k in range(3))
            turns = np.flatnonzero((np.diff(block) != 0) | (np.diff(part) != 0) | (np.diff(asking) != 0)) + 1
            for low, high in zip([0, *turns], [*turns, len(block)], strict=True):
                if low == high:
                    continue
                rows = batch.slice(low, high - low)
                if (here := (int(block[low]), int(part[low]))) != key:
                    if parts:
                        yield from _among(_Block(parts, size, shared.value), key[1], threshold)
                    key, held, parts = here, None, []
                if not asking[low]:
                    parts.append(rows)
                    continue
                if parts:
                    held, parts = _Block(parts, size, shared.value), []
                    yield from _among(held, key[1], threshold)
                for at in range(0, rows.num_rows, QUERIES):
                    some = rows.slice(at, QUERIES)
                    asked = np.array(some.column(4).to_pylist(), object), some.column(5).to_numpy(), _matrix(some.column(6), size)
                    yield from _links_of(held, *asked, None, threshold)
        if parts:
            yield from _among(_Block(parts, size, shared.value), key[1], threshold)

    dealt = members.unionByName(queries).repartition(n_shuffle(spark), "block", "share").sortWithinPartitions("block", "share", "kind", "mark")
    return dealt.mapInArrow(meet, "mark string, n_links bigint, parent string")


class _Block:
    """A block's members, from rows of (block, share, kind, asks, mark, copies, embedding, home, codes, error)."""

    def __init__(self, parts: list[pa.RecordBatch], size: int, quantiser: Quantiser) -> None:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches(max_chunksize=2**31 - 1)[0]
        self.asks, self.copies = rows.column(3).to_numpy(), rows.column(5).to_numpy()
        self.marks, self.x = np.array(rows.column(4).to_pylist(), object), _matrix(rows.column(6), size)
        self.quantiser, self.home = quantiser, rows.column(7).to_numpy()
        self.codes = np.frombuffer(b"".join(rows.column(8).to_pylist()), np.uint8).reshape(rows.num_rows, -1)
        self.error, self.square = rows.column(9).to_numpy(), quantiser.squares(self.home, self.codes)


def _among(held: _Block, share: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of a block's members of a share with all of its members."""
    mine = np.flatnonzero(held.asks == share)
    for at in range(0, len(mine), QUERIES):
        k = mine[at : at + QUERIES]
        yield from _links_of(held, held.marks[k], held.copies[k], held.x[k], k, threshold)


def _links_of(held: _Block, marks: np.ndarray, copies: np.ndarray, x: np.ndarray, places: np.ndarray | None, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of some queries with a block.  places: theirs, if they are its members."""
    q = _unit(x)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + held.error + SLACK  # the threshold's distance, and the code's
    near = (held.square - reach**2 - SLACK_32 + 1).astype(np.float32)[None, :] <= 2 * held.quantiser.products(q, held.home, held.codes)
    if places is not None:
        near[np.arange(len(places)), places] = False
    i, j = np.nonzero(near)
    if not len(i):
        return
    x = x / np.abs(x).max(1, keepdims=True)
    v = held.x / np.abs(held.x).max(1, keepdims=True)
    square_x, square_v = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", v, v)
    linked = np.zeros(near.shape, bool)
    for a in range(0, len(i), 8192):
        s, t = i[a : a + 8192], j[a : a + 8192]
        linked[s, t] = np.einsum("ij,ij->i", x[s], v[t]) / np.sqrt(square_x[s] * square_v[t]) >= threshold
    a, b = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    if not len(a):
        return
    linked = linked[np.ix_(a, b)]
    top = np.arange(len(a))
    while True:  # the least query that each can reach
        below = np.where(linked, top[:, None], len(a)).min(0)
        new = np.where(linked, below[None, :], len(a)).min(1)
        if (new == top).all():
            break
        top = new
    # members of the block meet twice, once each way round; any other pair meets once, and counts for both
    n = linked.T @ copies[a] if places is None else np.zeros(len(b), np.int64)
    columns = [pa.array([*marks[a], *held.marks[b]]), pa.array(np.concatenate([linked @ held.copies[b], n]), pa.int64()), pa.array([*marks[a[top]], *marks[a[below]]])]
    yield pa.RecordBatch.from_arrays(columns, ["mark", "n_links", "parent"])
