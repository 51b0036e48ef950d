"""Packing of documents into sequences of fixed length, by a grouping genetic algorithm on islands.

Documents become token pieces of at most ``capacity`` (only longer documents are cut; the first piece takes the odd
rest).  Full pieces are sequences already.  The others are dealt at random to islands of bounded size, each a Spark task's
own population (Falkenauer's grouping GA, 1996): crossover injects whole well-filled bins of one parent into the other,
removes the bins that now hold duplicates, and best-fits the documents that this displaces.

Islands hold different documents, so what migrates are elites in general form: the lengths that fill a bin to the brim.
In the second epoch every island gets its neighbour's elites and tries them on its own documents.  Bins that stay
ill-filled at the end are opened, and their documents meet those of other islands on new islands.

Only (key, length) travels; tokens are written once and never shuffled.

Defined cases: a null or empty text is one piece, its end id; rows that repeat a doc_id are documents of their own; a
null doc_id is kept; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.llm import tokens as T
from gridloom.llm.common import cut, n_shuffle, shared_path
from gridloom.llm.shingles import runs

Bins = list[list[int]]


@dataclass(frozen=True)
class Effort:
    """How hard an island tries."""

    island: int = 3000  # documents on an island, about
    population: int = 6
    children: int = 36  # in an epoch
    elites: int = 48  # bins that migrate
    reopened: float = 0.97  # bins filled less than this are opened for the last islands
    seed: int = 11


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(key, doc_id, piece, start, length, ids): ids are little-endian, 2 or 4 bytes each; key is unique once this is written."""
    kind, width = dict(docs.dtypes)["doc_id"], T.id_width(tokenizer, end_id)

    def slice_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = T.encoder(tokenizer)
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            doc_ids = batch.column(0)
            for a, texts in T.chunks(batch.column(1)):
                which, number, starts, lengths, raw = [], [], [], [], []
                for i, ids in enumerate(encoder.encode(texts), a):
                    ids = np.append(ids, np.uint32(end_id)).astype(f"<u{width}")
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for p, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        which.append(i)
                        number.append(p)
                        starts.append(low)
                        lengths.append(high - low)
                        raw.append(ids[low:high].tobytes())
                keys = pa.array(range(key, key + len(which)), pa.int64())
                key += len(which)
                rest = [pa.array(number, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays([keys, doc_ids.take(pa.array(which, pa.int64())), *rest], ["key", "doc_id", "piece", "start", "length", "ids"])
        T.release()

    return docs.select("doc_id", "text").mapInArrow(slice_up, f"key bigint, doc_id {kind}, piece int, start bigint, length bigint, ids binary")


class Room:
    """Bins by the room left in them: finds the fullest one that still takes a length."""

    def __init__(self, capacity: int) -> None:
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def put(self, b: int, room: int) -> None:
        self.bins[room].append(b)
        self.mask |= 1 << room

    def take(self, length: int) -> tuple[int, int] | None:
        above = self.mask >> length
        if not above:
            return None
        room = length + (above & -above).bit_length() - 1
        b = self.bins[room].pop()
        if not self.bins[room]:
            self.mask ^= 1 << room
        return b, room


def best_fit(bins: Bins, items: list[int], length: list[int], capacity: int) -> Bins:
    """Adds the items to the bins, longest first, each where it leaves the least room."""
    room = Room(capacity)
    for b, held in enumerate(bins):
        if left := capacity - sum(length[i] for i in held):
            room.put(b, left)
    for i in sorted(items, key=lambda i: -length[i]):
        if found := room.take(length[i]):
            b, left = found
            bins[b].append(i)
        else:
            b, left = len(bins), capacity
            bins.append([i])
        if left := left - length[i]:
            room.put(b, left)
    return bins


class Island:
    """A population of packings of the same items."""

    def __init__(self, length: list[int], capacity: int, effort: Effort, seed: int) -> None:
        self.length, self.capacity, self.effort = length, capacity, effort
        self.rng = np.random.default_rng([effort.seed, seed])
        self.least = -(-sum(length) // capacity)
        self.population: list[tuple[float, Bins]] = []

    def fill(self, held: list[int]) -> int:
        return sum(self.length[i] for i in held)

    def add(self, bins: Bins) -> None:
        """Fewer bins are better; among as many, uneven filling, which keeps room in one place."""
        worth = -len(bins) + sum((self.fill(b) / self.capacity) ** 2 for b in bins) / max(1, len(bins))
        self.population.append((worth, bins))
        self.population.sort(key=lambda x: -x[0])
        del self.population[self.effort.population :]

    @property
    def best(self) -> Bins:
        return self.population[0][1]

    def cross(self, receiver: Bins, donated: Bins) -> Bins:
        """The receiver with the donated bins put in; bins that held any of their items go, and the rest of those is best-fitted."""
        taken = {i for b in donated for i in b}
        kept, displaced = [list(b) for b in donated], []
        for b in receiver:
            if taken.isdisjoint(b):
                kept.append(list(b))
            else:
                displaced += [i for i in b if i not in taken]
        return best_fit(kept, displaced, self.length, self.capacity)

    def good_bins(self, bins: Bins, share: float) -> Bins:
        """Some of a packing's fullest bins, at random."""
        full = [b for b in bins if self.fill(b) >= 0.995 * self.capacity]
        self.rng.shuffle(full)
        return full[: max(1, int(share * len(bins)))]

    def mutate(self, bins: Bins) -> Bins:
        """The emptiest bins and some at random are opened, and their items placed again in another order."""
        fills = np.array([self.fill(b) for b in bins]) / self.capacity
        odds = 1.002 - np.minimum(fills, 1)
        n = max(2, int(len(bins) * self.rng.uniform(0.02, 0.15)))
        opened = set(self.rng.choice(len(bins), min(n, len(bins)), replace=False, p=odds / odds.sum()).tolist())
        loose = [i for b in opened for i in bins[b]]
        return self.by_target([list(b) for k, b in enumerate(bins) if k not in opened], loose)

    def by_target(self, bins: Bins, loose: list[int]) -> Bins:
        """New bins for the loose items, each filled from a random start towards the brim; what stays ill-filled is best-fitted."""
        by_length: dict[int, list[int]] = {}
        mask = 0
        for i in loose:
            by_length.setdefault(self.length[i], []).append(i)
            mask |= 1 << self.length[i]

        def take(length: int) -> int:
            nonlocal mask
            i = by_length[length].pop()
            if not by_length[length]:
                mask ^= 1 << length
            return i

        left, made = len(loose), []
        while left:
            held, room = [take(mask.bit_length() - 1)], self.capacity
            room -= self.length[held[0]]
            left -= 1
            while room and left:
                below = mask & ((1 << room + 1) - 1)
                if not below:
                    break
                longest = below.bit_length() - 1
                if longest < room and self.rng.random() < 0.5:  # two that fill it, if there are
                    for first in _ones(below, 24):
                        second = room - first
                        if second > 0 and (below >> second) & 1 and (second != first or len(by_length[first]) > 1):
                            held += [take(first), take(second)]
                            room, left = 0, left - 2
                            break
                    if not room:
                        break
                held.append(take(longest))
                room, left = room - longest, left - 1
            made.append(held)
        full = [b for b in made if self.fill(b) >= 0.99 * self.capacity]
        rest = [i for b in made if self.fill(b) < 0.99 * self.capacity for i in b]
        return best_fit(bins + full, rest, self.length, self.capacity)

    def start(self) -> None:
        everything = list(range(len(self.length)))
        self.add(best_fit([], everything, self.length, self.capacity))
        self.add(self.by_target([], everything))

    def inject(self, elites: list[list[int]]) -> None:
        """Bins made of own items to the lengths of migrants, crossed into the best packing."""
        by_length: dict[int, list[int]] = {}
        for i, n in enumerate(self.length):
            by_length.setdefault(n, []).append(i)
        donated = []
        for pattern in elites:
            held: list[int] = []
            for n in pattern:
                if by_length.get(n):
                    held.append(by_length[n].pop())
            if len(held) == len(pattern):
                donated.append(held)
            else:
                for i in held:
                    by_length[self.length[i]].append(i)
        if donated:
            self.add(self.cross(self.best, donated))

    def evolve(self) -> None:
        for _ in range(self.effort.children):
            if len(self.best) <= self.least:
                return
            a, b = self.rng.integers(0, len(self.population), 2)
            child = self.cross(self.population[a][1], self.good_bins(self.population[b][1], self.rng.uniform(0.1, 0.5)))
            self.add(self.mutate(child))


def _ones(mask: int, most: int) -> Iterator[int]:
    """The highest set bits."""
    for _ in range(most):
        if not mask:
            return
        top = mask.bit_length() - 1
        yield top
        mask ^= 1 << top


def _epoch(items: DataFrame, capacity: int, effort: Effort, elites: bool) -> DataFrame:
    """One epoch of every island.  Rows are (island, key, length, bin, pattern): items, and migrants with a null key."""

    def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 1):
            name, migrants = rows[0][0], [r[4] for r in rows if r[1] is None]
            rows = sorted((r for r in rows if r[1] is not None), key=lambda r: r[1])
            if not rows:
                continue
            island = Island([r[2] for r in rows], capacity, effort, name & 0xFFFFFFFF)
            island.start()
            if rows[0][3] is not None:
                bins: dict[int, list[int]] = {}
                for i, r in enumerate(rows):
                    bins.setdefault(r[3], []).append(i)
                island.add(list(bins.values()))
            island.inject(migrants)
            island.evolve()
            best = sorted(island.best, key=lambda b: (-island.fill(b), min(b)))
            out = [(name, rows[i][1], rows[i][2], k, None) for k, b in enumerate(best) for i in b]
            if elites:
                patterns = [sorted((rows[i][2] for i in b), reverse=True) for b in best[: effort.elites] if len(b) > 1]
                out += [(name, None, None, None, p) for p in patterns]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())), strict=True)], ["island", "key", "length", "bin", "pattern"])

    dealt = items.select("island", "key", "length", "bin", "pattern").repartition(n_shuffle(items.sparkSession), "island").sortWithinPartitions("island")
    return dealt.mapInArrow(live, "island bigint, key bigint, length bigint, bin int, pattern array<bigint>")


def _settle(items: DataFrame, n: int, capacity: int, effort: Effort) -> DataFrame:
    """(key, length, island, bin) of (key, length): two epochs, with migration in a ring between them."""
    islands = max(1, round(n / effort.island))
    start = items.select(F.pmod(F.xxhash64("key"), F.lit(islands)).alias("island"), "key", "length", F.lit(None).cast("int").alias("bin"), F.lit(None).cast("array<bigint>").alias("pattern"))
    first = cut(_epoch(start, capacity, effort, elites=True))
    if islands > 1:
        moved = F.when(F.col("key").isNull(), F.pmod(F.col("island") + 1, F.lit(islands))).otherwise(F.col("island"))
        first = cut(_epoch(first.withColumn("island", moved), capacity, effort, elites=False))
    return first.where(F.col("key").isNotNull()).select("key", "length", "island", "bin")


def pack_lengths(items: DataFrame, capacity: int, effort: Effort = Effort()) -> DataFrame:
    """(key, sequence_id, offset) of (key, length), lengths from 1 to capacity."""
    full = items.where(F.col("length") == capacity)
    part = items.where(F.col("length") < capacity)
    n = part.count()
    settled = cut(_settle(part, n, capacity, effort).withColumn("round", F.lit(0)))
    filled = settled.groupBy("island", "bin").agg(F.sum("length").alias("fill"))
    loose = filled.where(F.col("fill") < F.lit(effort.reopened * capacity)).select("island", "bin")
    again = cut(settled.join(loose, ["island", "bin"], "left_semi").select("key", "length"))
    if (left := again.count()) and n > effort.island:
        second = _settle(again, left, capacity, effort).withColumn("round", F.lit(1))
        settled = settled.join(loose, ["island", "bin"], "left_anti").unionByName(second)
    order = W.partitionBy("round", "island", "bin").orderBy(F.desc("length"), "key")
    placed = settled.select(
        "key",
        (F.shiftleft(F.col("island") * 2 + F.col("round"), 24) + F.col("bin")).alias("sequence_id"),
        (F.sum("length").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("length")).alias("offset"),
    )
    return placed.unionByName(full.select("key", (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, effort: Effort = Effort()) -> tuple[DataFrame, DataFrame]:
    """(pieces, places): the token pieces, written in the shared folder, and for each key its sequence and offset."""
    spark = docs.sparkSession
    path = shared_path(spark, "pieces")
    pieces(docs, tokenizer, end_id, capacity).write.parquet(path)
    written = spark.read.parquet(path)
    return written, pack_lengths(written.select("key", "length"), capacity, effort)


def digest(written: DataFrame, places: DataFrame) -> DataFrame:
    """A row a piece: its ids as a crc32 of 32-bit little-endian numbers, and its place."""

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            sizes = batch.column(4).to_pylist()
            sums = [zlib.crc32(np.frombuffer(x, f"<u{len(x) // n}").astype("<u4").tobytes()) for n, x in zip(sizes, batch.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sums, pa.int64())], [*batch.schema.names[:5], "ids_crc32"])

    kind = dict(written.dtypes)["doc_id"]
    sums = written.select("key", "doc_id", "piece", "start", "length", "ids").mapInArrow(widen, f"key bigint, doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")
    return sums.join(places, "key").drop("key")
