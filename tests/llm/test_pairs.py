"""Similarity joins and searches against brute force."""

from __future__ import annotations

import itertools
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import embedding_dedup, knn_join, ngram_join
from gridloom.llm import shingles as S
from gridloom.llm.common import join_hot
from gridloom.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def roots(n, links):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        label[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    place = {x: k for k, x in enumerate(nodes)}
    expected = roots(len(nodes), [(place[a], place[b]) for a, b in edges if a != b])
    assert got == {x: nodes[expected[k]] for k, x in enumerate(nodes)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def grams(text):
    words = (text or "").encode().split()
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def test_ngram_join(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 400, 120)]
    rows = []
    for i in range(60):  # one family whose members drift apart
        base[int(rng.integers(0, 120))] = f"x{i}"
        rows.append((i, " ".join(base)))
    rows += [(100 + i, " ".join(f"w{k}" for k in rng.integers(0, 400, 80))) for i in range(30)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (201, rows[0][1]), (202, None), (203, ""), (204, " \n"), (205, "two words"), (206, "two  words"), (None, rows[5][1]), (207, "w " * 5000)]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, mark string, hash string")
    sets = [grams(t) for _, t in rows]
    links = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    found = roots(len(rows), links)
    least = {}
    for k, r in enumerate(found):
        least[r] = min((x for x in (least.get(r), rows[k][0]) if x is not None), default=None)
    expected = sorted(((rows[k][0], sum(k in e for e in links), least[found[k]]) for k in range(len(rows))), key=str)
    got = sorted(((r["doc_id"], r["n_links"], r["group_id"]) for r in ngram_join.join(docs).collect()), key=str)
    assert got == expected
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    groups = len({f for k, f in enumerate(found) if sets[k]})
    assert kept.count() == groups + 3
    assert ngram_join.join(docs.limit(0)).count() == 0


def test_blocks_of_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 10)
    test_ngram_join(spark)


def test_hot_keys_meet_by_broadcast(spark):
    rng = np.random.default_rng(8)
    keys = [0] * 400 + rng.integers(1, 50, 200).tolist()
    many = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    few = many.where("k % 3 < 2").groupBy("k").agg(F.count("i").alias("n"), F.max("i").alias("top"))
    got = sorted(map(tuple, join_hot(many, few, ["k"], "n", 600, share=10, least=5).collect()))
    top = {k: max(i for i, x in enumerate(keys) if x == k) for k in keys}
    assert got == sorted((k, i, top[k]) for i, k in enumerate(keys) if k % 3 < 2)


def test_components_with_a_hub(spark):
    edges = [(7, k) for k in range(100, 2400)] + [(3, 2399), (5000, 5001)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert set(got.values()) == {3, 5000} and len(got) == 2304 and got[100] == 3 and got[5001] == 5000


def test_a_family_of_drifting_texts_is_verified_by_its_buckets(spark, monkeypatch):
    """A chain of texts costs the pairs that share a band, not the square of its length."""
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 20)
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in rng.permutation(4000)]
    docs = spark.createDataFrame([(i, " ".join(words[12 * i : 12 * i + 100])) for i in range(300)], "doc_id long, text string")
    classes = ngram_join.signatures(docs, 5, *S.bands_for(0.8, 0.9999)).selectExpr("mark", "doc_id as class_id", "1L as copies", "grams", "bands")
    units = ngram_join._units(classes).select(F.explode("units").alias("u")).select("u.*")
    pairs = units.groupBy("unit", "band").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * F.col("n"))).first()[0]
    assert units.where("band >= 0").count() > 0 and pairs < 300 * 300 / 8


@pytest.mark.parametrize("same_id", [True, False])
def test_texts_of_one_id_meet_by_their_hash(spark, same_id):
    """Rows of one doc_id, or of none, whose texts differ: time in proportion to their number."""
    n, began = 2000, time.time()
    rows = [(7 if same_id else None, " ".join(f"w{k}x{j}" for j in range(40)) + (" end" if half else "")) for k in range(n // 2) for half in (0, 1)]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).select("n_links", "n_text_links").collect()
    assert len(got) == n and all(tuple(r) == (1, 1) for r in got)
    assert time.time() - began < 240


def test_bands():
    bands, rows = S.bands_for(0.8, 0.9999)
    assert S.chance(0.8, bands, rows) >= 0.9999 and bands * rows <= 128


VECTORS = "vec_id long, embedding array<float>, label int, v int"


def vectors(spark, seed=5, n=400):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 16))
    x[100:160] = x[0] + rng.normal(0, 0.12, (60, 16))  # around the threshold
    x[160:170] = x[1]
    x[170] = 3 * x[1]
    rows = [(i, v.astype(np.float32).tolist(), 0, 0) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    return spark.createDataFrame(rows + [(1000 + k, v, None, 0) for k, v in enumerate(odd)], VECTORS), [*rows, (1006, [1.0, 2.0] + [0.0] * 14, None, 0)]


def test_embedding_links(spark, monkeypatch):
    df, good = vectors(spark)
    x = np.array([r[1] for r in good], np.float32).astype(float)
    cosine = x @ x.T / np.sqrt((x**2).sum(1)[:, None] * (x**2).sum(1)[None, :])
    assert np.abs(cosine - 0.9).min() > 1e-9
    links = np.argwhere(np.triu(cosine >= 0.9, 1))
    ids = [r[0] for r in good]
    found = roots(len(good), links.tolist())
    expected = {ids[k]: (int((links == k).sum()), ids[found[k]], found[k] == k) for k in range(len(good))}
    expected |= {1000 + k: (0, 1000 + k, True) for k in range(6)}
    for block in (embedding_dedup.BLOCK, 16):
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.links(df).collect()}
        assert set(got) == set(expected)
        recall = sum(v[0] for v in got.values()) / sum(v[0] for v in expected.values())
        assert recall >= 0.98 and all(got[i][0] <= expected[i][0] for i in got)
    assert embedding_dedup.links(df.limit(0)).count() == 0
    assert embedding_dedup.links(df.where("vec_id = 1002")).collect() == [(1002, 0, 1002, True)]


def test_tables_give_the_distances_of_the_codes():
    """Products read off the tables are those with the vectors that the codes stand for."""
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (600, 18))
    x /= np.sqrt((x**2).sum(1))[:, None]
    index = embedding_dedup.Quantiser(x, 9)
    home, far, codes, error = index.encode(x)
    decoded = index.centres[home] + np.concatenate([b[codes[:, k]] for k, b in enumerate(index.books)], 1)
    assert np.allclose(index.products(x[:50], home, codes), x[:50] @ decoded.T, atol=1e-5)
    assert np.allclose(index.squares(home, codes), (decoded**2).sum(1)) and np.allclose(error, np.sqrt(((x - decoded) ** 2).sum(1)))
    assert np.allclose(far, np.sqrt(((x - index.centres[home]) ** 2).sum(1)))


def test_blocks_in_shares(spark, monkeypatch):
    """Small blocks whose visits are dealt out in many shares: all links all the same."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    monkeypatch.setattr(embedding_dedup, "VISITS", 1)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (200, 32))
    for n in (2_000, 8_000):
        x = (centres[np.arange(n) % 200] + rng.normal(0, 0.02, (n, 32))).astype(np.float32)
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
        found = {r["vec_id"]: r["n_links"] for r in embedding_dedup.links(df).collect()}
        assert found == {i: n // 200 - 1 for i in range(n)}


def test_recall_of_the_index(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    near = rows.selectExpr("vec_id + 1000000 as vec_id", "transform(embedding, (x, i) -> cast(x + 0.05 * sin(vec_id * 64 + i) as float)) as embedding")
    both = rows.select("vec_id", "embedding").unionByName(near)
    got = both.toPandas()
    x = np.stack(got["embedding"]).astype(float)
    x /= np.sqrt((x**2).sum(1))[:, None]
    expected = int((x @ x.T >= 0.9).sum()) - len(x)
    assert embedding_dedup.links(both).agg(F.sum("n_links")).first()[0] >= 0.98 * expected > 1000


@pytest.mark.parametrize("n", [3000, 12_000])
def test_recall_in_a_dense_group(spark, n):
    rng = np.random.default_rng(n)
    x = rng.normal(0, 1, (n, 64))
    x /= np.sqrt((x**2).sum(1))[:, None]
    x[: n // 3] = x[0] + rng.normal(0, 0.229 / 8, (n // 3, 64))  # distinct near copies, cosines about 0.95
    rows = spark.createDataFrame([(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    x = x.astype(np.float32).astype(float)
    x /= np.sqrt((x**2).sum(1))[:, None]
    expected = (x @ x.T >= 0.9).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.links(rows).collect()}
    assert [got[i] for i in range(n)] == expected.tolist()


@pytest.mark.parametrize("k", [3, 500])
def test_knn_join(spark, k):
    df, good = vectors(spark)
    good.append((1002, [0.0] * 16, None, 0))  # links with nothing, but has scores
    ids = np.array([r[0] for r in good])
    v = np.floor(np.array([r[1] for r in good], np.float32).astype(float) * 64).astype(np.int64)
    expected = []
    for a in np.flatnonzero(ids % 20 == 0):
        scores = v @ v[a]
        order = [b for b in np.lexsort((ids, -scores)) if b != a][:k]
        expected += [(int(ids[a]), r + 1, int(ids[b]), int(scores[b])) for r, b in enumerate(order)]
    got = knn_join.join(df.unionByName(df.where("vec_id = 20")), F.col("vec_id") % 20 == 0, k=k)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(expected)
    assert knn_join.join(df.limit(0), F.lit(True)).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("mine"))
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
            if name != "mixing sources":
                assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert docs.count() > 0
    assert corpus_pipeline.run(spark, SF).columns == docs.columns


STAGE_ROWS = [
    (1, None, "en", None, 0), (2, "", None, "a", 0), (3, " \n\t\n ", "en", "a", 5), (4, "word " * 60_000, "en", "b", 300_000), (5, "The same short text, twice over and once again.", "en", "b", 47),
    (5, "The same short text, twice over and once again.", "en", "b", 47), (6, "The same short text, twice over and once again.", "en", None, 47), (None, "nobody's text", "fr", "c", 13),
    (None, "nobody's text", "fr", "c", 13), (None, None, None, None, None), (7, "\n".join(["a line that many documents hold, and more"] * 3), "de", "c", 130),
    (8, "a line that many documents hold, and more\nown words of eight", "de", "c", 60), (9, "A LINE that many documents hold, and more \nown words of nine", "de", "c", 60),
]


def test_stages_on_odd_rows(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables, stage by stage."""
    names = "doc_id long, text string, lang string, source string, n_chars long, score string, size int, label string"
    docs = spark.createDataFrame([(*r, "mine", 1, "x") for r in STAGE_ROWS], names)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    toxicity, lines, near, mixing, packing = (f for _, f in corpus_pipeline.STAGES)
    rows = lambda df: sorted((r["doc_id"] or 0, r["text"] or "", r["score"]) for r in df.collect())
    assert rows(toxicity(spark, docs, SF)) == rows(docs)  # none of these is insulting
    done = lines(spark, docs, SF)
    assert done.columns == docs.columns and done.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in done.where("doc_id >= 7").collect()}
    assert texts == {7: "", 8: "own words of eight", 9: STAGE_ROWS[-1][1]}
    assert all(r["n_chars"] == len(r["text"]) for r in done.collect())
    kept = near(spark, docs, SF).select("doc_id", "text").collect()
    assert sorted(r["doc_id"] for r in kept if (r["text"] or "").startswith("The same")) == [5]
    assert sorted((r["doc_id"] or 0) for r in kept if not (r["text"] or "").strip()) == [0, 1, 2, 3]
    assert [r["doc_id"] for r in kept if r["text"] == "nobody's text"] == [None]
    mixed = mixing(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.where("text is null or trim(text) = ''").count() == 0
    packed = packing(spark, docs, SF).collect()
    assert sum(r["length"] for r in packed if r["doc_id"] in (1, 2)) == 2 and max(r["offset"] + r["length"] for r in packed) <= 2048
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
