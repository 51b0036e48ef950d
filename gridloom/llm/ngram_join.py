"""Similarity join of documents on word n-grams, by MinHash banding.

1. Each text gets the set of its n-gram hashes, a 128-bit fingerprint of the set and MinHash bands.  Texts of one
   fingerprint are one class, and only classes go on, so copies never meet in pairs.
2. Classes are shuffled on band hashes; classes of one hash are a bucket, and buckets with the same members one bucket.
   Bands and rows follow from the recall wanted at the threshold.
3. Buckets are verified on full n-gram sets, a pair in the least band that it shares.  Near copies share most of their
   buckets, though, so classes that buckets connect form a family, and a family is verified as a whole where that takes
   fewer comparisons than its buckets do: always if it is small, never if it is a chain of texts that drift apart.
4. Buckets and families are dealt out in blocks of bounded size, and every two blocks meet in one task.  It returns a row a
   class: its links there, and one class that it hangs together with.  Those rows are summed, and joined up into groups.

No cap stands anywhere: large buckets and families get more blocks, and the work grows with the pairs that share a band.

Defined cases: words are runs of anything but ASCII white space, case and punctuation included; a text of fewer than n
words has one n-gram, all its words; a text without words (null, empty, blank) links with nothing; rows that repeat a
doc_id are documents of their own; a null doc_id is kept, and is no class's or group's least id; texts of any length count
whole; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import shingles as S
from gridloom.llm.common import HIDDEN, cut, join_hot, n_shuffle
from gridloom.llm.components import connected_components

#: A block holds about so many classes and so many n-grams at most (one class may have more n-grams).
BLOCK_CLASSES, BLOCK_GRAMS = 768, 1_000_000


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, hash, mark, grams, bands): hash is the text's, mark the set's; mark and bands are null for a text without words."""
    kind = dict(docs.dtypes)["doc_id"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = S.WordHashes()
        for batch in batches:
            sets = [S.shingle_set(t, n, hashes) for t in batch.column(2).to_pylist()]
            full = [s for s in sets if len(s)]
            signed = iter(S.band_hashes(full, bands, rows) if full else ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([next(signed) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "hash", "mark", "grams", "bands"],
            )

    texts = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(sign, f"doc_id {kind}, hash bigint, mark binary, grams bigint, bands array<bigint>")


def join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """A row a document: (doc_id, hash, mark, class_id, n_links, n_text_links, group_id, group).

    class_id: the least doc_id of the same n-gram set; n_links: the other documents linked directly, copies included;
    n_text_links: the other n-gram sets linked; group_id: the least doc_id that links lead to; group: its key, null for a text without words; hash: of the text.
    """
    bands, rows = S.bands_for(threshold, recall)
    signed = cut(signatures(docs, n, bands, rows))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash"))  # whose text stands for the class
    first = F.first("grams").alias("grams"), F.first("bands").alias("bands"), least.getField("hash").alias("hash")
    classes = cut(signed.where(F.col("mark").isNotNull()).groupBy("mark").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), *first))
    units = _units(classes)
    links = cut(_verified(docs, classes, units, n, threshold))
    sums = links.groupBy("mark").agg(F.sum("n_links").alias("more"), F.sum("n_text_links").alias("n_text_links"))
    groups = connected_components(links, "mark", "parent").withColumnsRenamed({"node": "mark"})
    named = groups.join(classes.select("mark", "class_id"), "mark")
    roots = named.groupBy("root").agg(F.min("class_id").alias("group_id"))
    grouped = named.drop("class_id").join(roots, "root").withColumnRenamed("root", "group")
    facts = classes.select("mark", "class_id", "copies").join(sums, "mark", "left").join(grouped, "mark", "left")
    facts = facts.select(
        "mark",
        "copies",
        "class_id",
        (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"),
        F.coalesce("group_id", "class_id").alias("group_id"),
        F.coalesce("group", "mark").alias("group"),
    )
    rest = signed.where(F.col("mark").isNull()).select(
        "doc_id", "hash", "mark", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_text_links"),
        F.col("doc_id").alias("group_id"), F.lit(None).cast("binary").alias("group"),
    )
    texts = signed.where(F.col("mark").isNotNull()).select("doc_id", "hash", "mark")
    total = classes.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    return join_hot(texts, cut(facts), ["mark"], "copies", total).select(rest.columns).unionByName(rest)


def _units(classes: DataFrame) -> DataFrame:
    """(mark, units): what each class is verified in, buckets or its family, as (unit, band, blocks, block); band is -1 for a family."""
    met = classes.select("mark", F.posexplode("bands").alias("band", "hash"))
    buckets = met.groupBy("band", "hash").agg(F.min("mark").alias("hub"), F.count(F.lit(1)).alias("members"), F.sum(F.xxhash64("mark").cast("decimal(38,0)")).alias("sum"))
    # buckets of the same members are one, in the least of their bands
    one = buckets.where(F.col("members") > 1).groupBy("hub", "members", "sum").agg(F.min(F.struct("band", "hash")).alias("b"))
    buckets = cut(one.select("b.band", "b.hash", "hub", "members", F.col("members").alias("rows")))
    total = buckets.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    inside = cut(join_hot(met, buckets, ["band", "hash"], "rows", total).select("mark", "band", "hub", "members"))
    family = connected_components(inside.where(F.col("mark") != F.col("hub")).select("mark", "hub").distinct(), "mark", "hub")
    family = cut(family.withColumnsRenamed({"node": "mark", "root": "family"}).join(classes.select("mark", "grams"), "mark"))
    # a bucket belongs to its hub's family; it takes its members squared in comparisons
    costs = buckets.join(family.select(F.col("mark").alias("hub"), "family"), "hub").groupBy("family").agg(F.sum(F.col("members").cast("double") * F.col("members")).alias("cost"))
    sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("n")).join(costs, "family")
    parted = (F.col("n") > BLOCK_CLASSES) & (F.col("cost") < F.col("n").cast("double") * F.col("n"))
    sizes = cut(sizes.select("family", "n", parted.alias("parted")))
    members = cut(join_hot(family, sizes, ["family"], "n", sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]))
    whole = members.where(~F.col("parted")).select("mark", "grams", F.col("family").alias("unit"), F.lit(-1).alias("band"))
    by_bucket = inside.join(members.where("parted").select("mark", "grams"), "mark").select("mark", "grams", F.col("hub").alias("unit"), "band")
    units = cut(whole.unionByName(by_bucket))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("grams") / BLOCK_GRAMS)).cast("int")
    counted = cut(units.groupBy("unit", "band").agg(blocks.alias("blocks"), F.count(F.lit(1)).alias("n")))
    dealt = join_hot(units, counted, ["unit", "band"], "n", counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    block = F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int").alias("block")
    return dealt.groupBy("mark").agg(F.collect_list(F.struct("unit", "band", "blocks", block)).alias("units"))  # one a band at most


def _verified(docs: DataFrame, classes: DataFrame, units: DataFrame, n: int, threshold: float) -> DataFrame:
    """(mark, n_links, n_text_links, parent), a row for each class and meeting of two blocks."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = S.WordHashes()
        for batch in batches:
            *rest, text, mark = batch.columns
            sets = [S.shingle_set(t, n, hashes).tobytes() for t in text.to_pylist()]
            same = pa.array([xxhash.xxh3_128_digest(s) == m for s, m in zip(sets, mark.to_pylist(), strict=True)])
            out = pa.RecordBatch.from_arrays([*rest, mark, pa.array(sets, pa.binary())], ["units", "copies", "bands", "mark", "set"])
            yield out.filter(same)  # another text may have the hash

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in S.runs(batches, 4):  # of one unit, band, and two blocks
            rows = list({r[6]: r for r in rows}.values())  # rows that repeat a doc_id and a text
            marks, copies, block = [r[6] for r in rows], np.array([r[5] for r in rows]), np.array([r[4] for r in rows])
            linked = S.similar([np.frombuffer(r[8], np.uint64) for r in rows], threshold) if len(rows) > 1 else np.zeros((1, 1), bool)
            if rows[0][2] != rows[0][3]:  # two blocks: pairs inside a block are another task's
                linked &= block[:, None] != block[None, :]
            if rows[0][1] >= 0:  # a bucket: pairs that share an earlier one are that one's
                bands = np.array([r[7] for r in rows])
                for k in np.flatnonzero(linked.any(1)):
                    linked[k] &= (bands == bands[k]).argmax(1) == rows[0][1]
            root = S.least_reachable(linked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.binary()), pa.array((linked * copies[None, :]).sum(1), pa.int64()), pa.array(linked.sum(1), pa.int64()), pa.array([marks[i] for i in root], pa.binary())],
                ["mark", "n_links", "n_text_links", "parent"],
            )

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    held = units.join(classes.select("mark", "class_id", "copies", "bands", "hash"), "mark")
    bands = F.when(F.exists("units", lambda u: u.band >= 0), F.col("bands")).alias("bands")  # only buckets ask for them
    held = held.join(texts, F.col("class_id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))).select("units", "copies", bands, "text", "mark")
    unit = "struct<unit: binary, band: int, blocks: int, block: int>"
    sets = held.mapInArrow(grams, f"units array<{unit}>, copies bigint, bands array<bigint>, mark binary, set binary")
    each = sets.select(F.explode("units").alias("u"), "copies", "bands", "mark", "set")
    pairs = each.select("u.*", "copies", "bands", "mark", "set", F.explode(F.sequence(F.lit(0), F.col("u.blocks") - 1)).alias("other"))
    pairs = pairs.select("unit", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "copies", "mark", "bands", "set")
    dealt = pairs.repartition(n_shuffle(docs.sparkSession), "unit", "band", "i", "j").sortWithinPartitions("unit", "band", "i", "j")
    return dealt.mapInArrow(verify, "mark binary, n_links bigint, n_text_links bigint, parent binary")


def one_of_each_group(docs: DataFrame, **options: object) -> DataFrame:
    """``docs`` with one document of each group: of the least doc_id (null last), then the least text hash.

    Texts without words stay.  Rows that agree in doc_id and text are one document.
    """
    joined = join(docs, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first")
    kept = joined.where(F.col("group").isNotNull()).groupBy("group").agg(first).select("first.doc_id", "first.hash")
    kept = kept.unionByName(joined.where(F.col("group").isNull()).select("doc_id", "hash"))
    kept = kept.select(F.col("doc_id").alias(f"{HIDDEN}id"), F.col("hash").alias(f"{HIDDEN}kept"))
    same = F.col("doc_id").eqNullSafe(F.col(f"{HIDDEN}id")) & (F.col(f"{HIDDEN}hash") == F.col(f"{HIDDEN}kept"))
    stay = docs.withColumn(f"{HIDDEN}hash", F.xxhash64("text")).join(kept, same, "left_semi")
    return stay.dropDuplicates(["doc_id", f"{HIDDEN}hash"]).drop(f"{HIDDEN}hash")
