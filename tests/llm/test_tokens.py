"""Token files and packing: exact round trips against the library."""

from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridloom.llm import packing, token_store
from gridloom.llm import tokens as T
from gridloom.llm.common import shared_path
from gridloom.llm.elias_fano import EliasFano

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
FIELDS = "doc_id long, text string, length string, key string"
ODD = [(3, None), (1, ""), (5, "It's a  test\n\n of  THINGS, naïve ß ²"), (2, "日本語 text 😀 <|endoftext|> end"), (5, "It's a  test\n\n of  THINGS, naïve ß ²"), (None, "no id"), (9, "long words " * 4000), (-4, "\x0b\x85\xa0 x"), (7, "á İ")]


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize("name", FILES)
def test_encoder_is_the_library(name):
    encoder, own = T.Encoder(public_tokenizers.path(name)), library(name)
    encoder.most = 50  # forgets often

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(st.one_of(st.text(st.one_of(st.characters(max_codepoint=0x180), st.characters(exclude_categories=("Cs",)), st.sampled_from(" \n\t'smt"))), st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|"])), max_size=3).map("".join), max_size=4))
    def check(texts):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == own.encode(text, add_special_tokens=False).ids

    check()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300))
def test_elias_fano(values):
    values = sorted(values)
    code, at = EliasFano.from_bytes(EliasFano.of(np.array(values, np.uint64)).to_bytes())
    assert code.all().tolist() == values
    assert [code.select(i) for i in range(len(values))] == values
    assert len(values) < 100 or len(code.low) + len(code.high) < len(values) * (3 + max(values).bit_length()) / 8


def test_token_store(spark):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in ODD], FIELDS)
    own = library(FILES[0])
    files, held = token_store.stored(docs, shared_path(spark, "t"), public_tokenizers.path(FILES[0]), 2)
    starts = {r["name"]: r["before"] for r in token_store.file_starts(files).collect()}
    got = sorted(((r["start"] + starts[r["file"]], r["n_tokens"], r["doc_id"], bytes(r["ids"])) for r in held.collect()), key=lambda r: r[0])
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected = [np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in order]
    assert [r[3] for r in got] == [e.tobytes() for e in expected]
    assert [r[2] for r in got] == [i for i, _ in order]
    assert [r[0] for r in got] == np.cumsum([0, *map(len, expected)])[:-1].tolist()
    nothing = token_store.stored(docs.limit(0), shared_path(spark, "t"), public_tokenizers.path(FILES[0]), 2)
    assert nothing[0].count() == 0 and nothing[1].count() == 0


def pieces_of(text, own, capacity):
    ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def test_packing(spark):
    rng = np.random.default_rng(4)
    rows = ODD + [(100 + i, "some words and more " * int(rng.integers(1, 400))) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], FIELDS)
    small = packing.Effort(island=150, children=8)
    got = packing.digest(*packing.pack(docs, public_tokenizers.path(FILES[1]), 0, 2048, small)).collect()
    own = library(FILES[1])
    expected = sorted(((i, *p) for i, t in rows for p in pieces_of(t, own, 2048)), key=str)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == expected
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(sequences) <= 1.02 * -(-total // 2048) + 1
    assert packing.digest(*packing.pack(docs.limit(0), public_tokenizers.path(FILES[1]))).count() == 0


def test_crossover_keeps_every_item_once():
    island = packing.Island([700, 600, 500, 900, 1100, 300, 2000, 48, 1000, 1048], 2048, packing.Effort(), 1)
    island.start()
    child = island.cross(island.best, [[6, 7], [8, 9]])
    assert sorted(i for b in child for i in b) == list(range(10))
    assert [6, 7] in [sorted(b) for b in child] and all(island.fill(b) <= 2048 for b in child)
    assert sorted(i for b in island.mutate(child) for i in b) == list(range(10))


def test_elias_fano_stays_packed():
    """Reading holds the packed parts and little more, however the values lie."""
    rng = np.random.default_rng(6)
    for gaps in (rng.integers(1, 4000, 200_000), np.r_[np.zeros(100_000, np.int64), 1 << 40, np.ones(100_000, np.int64)]):
        values = np.cumsum(gaps).astype(np.uint64)
        data = EliasFano.of(values).to_bytes()
        tracemalloc.start()
        code, _ = EliasFano.from_bytes(data)
        for i in range(0, len(values), 997):
            assert code.select(i) == values[i]
        for i in range(0, len(values) - 300, 7919):
            assert (code.span(i, i + 300) == values[i : i + 300]).all()
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert peak < len(data) + 1_200_000 < 8 * len(values) + 1_200_000


def test_encoder_keeps_the_pieces_used_most():
    encoder = T.Encoder(public_tokenizers.path(FILES[1]))
    encoder.most, encoder.kept = 200, 50
    for k in range(60):
        encoder.encode([f"often used words stay {k} piece{k} other{k} thing{k}"])
        assert len(encoder.pieces) <= encoder.most + 10
    encoder.forget()
    assert len(encoder.pieces) == 50 and {"often", " used", " words", " stay"} <= set(encoder.pieces)


def test_wide_ids(spark):
    """An end id beyond two bytes makes all ids four bytes wide."""
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    _, held = token_store.stored(docs, shared_path(spark, "wide"), public_tokenizers.path(FILES[0]), 70_000)
    assert [int(np.frombuffer(r["ids"], "<u4")[-1]) for r in held.collect()] == [70_000, 70_000]
    rows = packing.digest(*packing.pack(docs, public_tokenizers.path(FILES[1]), 70_000, 2048)).where("doc_id = 2").collect()
    assert [r["ids_crc32"] for r in rows] == [zlib.crc32(np.array([70_000], "<u4").tobytes())]
