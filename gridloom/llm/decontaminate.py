"""Benchmark passages in documents, by one Aho-Corasick automaton.

Texts are normalised to words: A-Z in lower case, and runs of ASCII letters, digits and all characters above ASCII.  A
benchmark item's windows are its runs of ``width`` words, or all its words if it has fewer.  All windows go into one
automaton, whose letters are whole words by number (0 for a word that no item has), and each document is scanned once.
The normal form keeps every byte in its place, so that a hit's words lead straight to the text as it is.

Automata are built inside tasks, once a worker, from the items' words, of which about PART_WORDS are broadcast: ten nodes
a word at most.  A larger benchmark is scanned for in parts of that size, each with its own automaton; hits of the parts
are then put together by document, so that the result doesn't depend on how items are dealt out.

Defined cases: a null or empty text has no words, and a document without words no hits; an item without words has no
windows; rows that repeat an item_id are one item with the windows of each; windows of an item without item_id make hits,
but the item is not named or counted; rows that repeat a doc_id are documents of their own; a window that several items
have counts for each; texts of any length are scanned whole; an empty benchmark gives documents without hits, an empty
table an empty one; other columns play no part.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut

WIDTH = 10
#: Words of benchmark items in an automaton, and in a piece of an item (pieces overlap, so that they have the same windows).
PART_WORDS, PIECE_WORDS = 200_000, 5_000
#: Bytes of a word as they are, A-Z lower-cased, and blanks for all others.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(rb"[^\x20]+")
SPANS = "array<struct<start: bigint, end: bigint>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Windows:
    """The automaton over the windows of some items, given as (item_id or None, words)."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        self.numbers: dict[bytes, int] = {}
        self.length: list[int] = []  # of each window, and the items that have it
        self.items: list[set[str]] = []
        known: dict[tuple[int, ...], int] = {}
        for item, words in items:
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words)
            size = min(width, len(ids))
            for a in range(len(ids) - size + 1 if size else 0):
                window = ids[a : a + size]
                k = known.setdefault(window, len(known))
                if k == len(self.length):
                    self.length.append(size)
                    self.items.append(set())
                    self.automaton.add_word(window, k)
                if item is not None:
                    self.items[k].add(item)
        if known:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of words hit, as (first, one past the last), in order and apart; and the items."""
        runs: list[tuple[int, int]] = []
        seen: set[int] = set()
        if not self.length or not words:
            return runs, set()
        for last, k in self.automaton.iter(tuple(map(self.numbers.get, words, repeat(0)))):
            seen.add(k)
            runs.append((last + 1 - self.length[k], last + 1))
        return joined(runs), set().union(*(self.items[k] for k in seen))


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as runs that don't overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def spans(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Where runs of words stand in the text as it is, in code points."""
    if not runs:
        return []
    found = [m.span() for m in WORD.finditer(text.translate(WORD_BYTES))]
    point = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)  # code points up to each byte, itself included
    return [{"start": int(point[found[a][0]]) - 1, "end": int(point[found[b - 1][1] - 1])} for a, b in runs]


_built: dict[str, Windows] = {}


def _windows(name: str, items: list[tuple[str | None, list[bytes]]], width: int) -> Windows:
    """One automaton a worker process, the one used last."""
    if name not in _built:
        _built.clear()
        _built[name] = Windows(items, width)
    return _built[name]


def _scanned(docs: DataFrame, items: list[tuple[str | None, list[bytes]]], width: int) -> DataFrame:
    """(doc_id, mark, n_words, runs, items, spans) of each document; mark tells texts of one doc_id apart."""
    shared, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex  # PART_WORDS words at most

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = _windows(name, shared.value, width)
            out: list[list] = [[], [], [], []]
            for text in batch.column(2):
                text = text.as_py() or b""
                words = words_of(text)
                runs, hit = windows.scan(words)
                for column, value in zip(out, (len(words), [{"start": a, "end": b} for a, b in runs], sorted(hit), spans(text, runs)), strict=True):
                    column.append(value)
            places = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            made = [pa.array(v, k) for v, k in zip(out, (pa.int64(), places, pa.list_(pa.string()), places), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], ["doc_id", "mark", "n_words", "runs", "items", "spans"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(scan, f"doc_id {dict(docs.dtypes)['doc_id']}, mark bigint, n_words bigint, runs {SPANS}, items array<string>, spans {SPANS}")


def _pieces(benchmark: DataFrame, width: int) -> DataFrame:
    """(item, words, size): the items' words joined by blanks, in pieces that each hold ``width - 1`` words of the next."""
    step = max(1, PIECE_WORDS - width + 1)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                pieces = [words[a : a + step + width - 1] for a in range(0, max(1, len(words) - width + 1), step)] if words else []
                rows += [(item, b" ".join(w), len(w)) for w in pieces]
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.string(), pa.binary(), pa.int64()), strict=True)], ["item", "words", "size"])

    texts = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(part, "item string, words binary, size bigint").distinct()


def _parts(benchmark: DataFrame, width: int, part_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items that have words, about so many words at a time: buckets by hash, as many together as fit."""
    pieces = cut(_pieces(benchmark, width))
    total = pieces.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = -(-8 * total // part_words) if total > part_words else 1
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("item", "words"), F.lit(buckets)))
    sizes = [tuple(r) for r in dealt.groupBy("bucket").agg(F.sum("size").alias("size")).orderBy("bucket").collect()]  # a row a bucket
    groups: list[list[int]] = [[]]
    held = 0
    for bucket, size in sizes:
        if groups[-1] and held + size > part_words:
            groups.append([])
            held = 0
        groups[-1].append(bucket)
        held += size
    for group in groups:
        some = dealt.where(F.col("bucket").between(group[0], group[-1])) if group else dealt
        yield [(r["item"], bytes(r["words"]).split()) for r in some.select("item", "words").collect()]


def _union(runs: str) -> Column:
    """As ``joined``, of a column of runs."""
    rest = F.slice(F.sort_array(runs), 2, F.greatest(F.size(runs) - 1, F.lit(0)))

    def add(out: Column, run: Column) -> Column:
        last = F.element_at(out, -1)
        longer = F.struct(last.start.alias("start"), F.greatest(last.end, run.end).alias("end"))
        return F.when(run.start < last.end, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(longer))).otherwise(F.concat(out, F.array(run)))

    return F.aggregate(rest, F.slice(F.sort_array(runs), 1, 1), add)


def find(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, part_words: int = PART_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans), a row a document.

    n_hit: words inside windows; items: the item_ids with windows there, as sorted strings; spans: what was hit, in code
    points of the text as it is.
    """
    parts = _parts(benchmark, width, part_words)
    first, second = next(parts), next(parts, None)
    found = _scanned(docs, first, width)
    if second is not None:
        # which documents a part hits is written down part by part; documents' texts are read again for each
        hits = [cut(_scanned(docs, p, width).where(F.size("runs") > 0).distinct()) for p in (first, second, *parts)]
        together = reduce(DataFrame.unionByName, hits).groupBy("doc_id", "mark").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("runs", "items", "spans")))
        together = together.select(F.col("doc_id").alias("id"), F.col("mark").alias("text_mark"), _union("runs").alias("runs"), F.sort_array(F.array_distinct("items")).alias("items"), _union("spans").alias("spans"))
        found = found.select("doc_id", "mark", "n_words").join(together, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("mark").eqNullSafe(F.col("text_mark")), "left")
        found = found.select("doc_id", "n_words", *(F.coalesce(c, F.array().cast(k)).alias(c) for c, k in (("runs", SPANS), ("items", "array<string>"), ("spans", SPANS))))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r.end - r.start)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "spans")
