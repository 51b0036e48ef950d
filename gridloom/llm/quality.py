"""Quality scores: random-indexing word vectors pooled by document, a two-layer network, calibrated by temperature.

Words are runs of letters and digits, runs of other marks, and line ends; a word like the one before it is also the
event "again".  A word that the training sample rarely holds goes by its shape (case, kind and length).  Each word has a
fixed random sparse index vector; its word vector is its own plus those of its neighbours in the sample (Kanerva and
others, 2000; Sahlgren, 2005).  A document is the mean of its words' vectors, their spread, and its length and variety.

Defined cases: null and empty texts have no words, and score what the network gives for that; texts of any length are
pooled whole; rows that repeat a doc_id are scored one by one, and train as one; without labels of both kinds every score
is 0.5; labels that are null or contradict each other count as they stand; an empty table gives an empty one; other
columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import labelled_sample

#: Labelled documents that training looks at, at most, of each label.
TRAIN_EACH = 3000
SIZE, ONES, WINDOW, RARE, MOST_WORDS = 64, 6, 2, 5, 20_000
WORD = re.compile(r"[^\W_]+|[^\w\s]+|_+|\n")


def shape(word: str) -> str:
    """What stands for a rare word: its kind, case and length."""
    if word == "\n":
        return word
    size = len(word).bit_length()
    if word.isdigit():
        kind = "9"
    elif not word[0].isalnum():
        kind = f".{word[0]}" + ("*" if len(set(word)) == 1 else "?")
    elif word.isalpha():
        kind = "AA" if word.isupper() and len(word) > 1 else "Aa" if word[0].isupper() else "aa" if word.islower() else "aA"
    else:
        kind = "a9"
    return f"\0{kind}{size}"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def index_vectors(words: list[str]) -> np.ndarray:
    """The fixed random vector of each word: some ones and minus ones, the rest zeros."""
    out = np.zeros((len(words), SIZE), np.float32)
    for k, w in enumerate(words):
        rng = np.random.default_rng(xxhash.xxh64_intdigest(w))
        out[k, rng.choice(SIZE, ONES, replace=False)] = rng.choice([-1.0, 1.0], ONES)
    return out


class Vectors:
    """Word vectors, and how a document is pooled of them."""

    def __init__(self, texts: list[str | None]) -> None:
        documents = [words_of(t) for t in texts]
        held = Counter(w for d in documents for w in set(d))
        known = [w for w, n in held.most_common(MOST_WORDS) if n >= RARE]
        shapes = sorted({shape(w) for w in held} | {shape(w) for w in ("a", "A", "Ab", "AB", "aB", "1", "a1", ".")})
        self.number = {w: k for k, w in enumerate(dict.fromkeys(["\0again", "\0other", *known, *shapes]))}
        own = index_vectors(list(self.number))
        context = np.zeros_like(own)
        for d in documents:
            ids = self.ids(d)
            for step in range(1, WINDOW + 1):
                if len(ids) > step:
                    np.add.at(context, ids[:-step], own[ids[step:]] / step)
                    np.add.at(context, ids[step:], own[ids[:-step]] / step)
        norm = np.linalg.norm(context, axis=1, keepdims=True)
        self.table = own / np.sqrt(ONES) + context / np.maximum(norm, 1e-6)
        self.cache: dict[str, int] = {}

    def one(self, word: str) -> int:
        if (k := self.number.get(word)) is not None:
            return k
        return self.number.get(shape(word), 1)

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.one, words), np.int64, len(words))

    def pooled(self, texts: list[str | None]) -> np.ndarray:
        """(texts, 2 * SIZE + 4)"""
        out = np.zeros((len(texts), 2 * SIZE + 4), np.float32)
        for k, text in enumerate(texts):
            words = words_of(text)
            out[k, -1] = np.log1p(len(words)) / 5
            if not words:
                continue
            times = Counter(words)
            if len(self.cache) > 300_000:
                self.cache.clear()
            get, one = self.cache.get, self.one
            ids = np.fromiter((i if (i := get(w)) is not None else self.cache.setdefault(w, one(w)) for w in times), np.int64, len(times))
            n = np.fromiter(times.values(), np.float32, len(times))
            again = sum(map(str.__eq__, words, words[1:]))
            vectors = self.table[ids]
            mean = (n @ vectors + again * self.table[0]) / (len(words) + again)
            out[k, :SIZE] = mean
            out[k, SIZE : 2 * SIZE] = np.sqrt(np.maximum(n @ vectors**2 / len(words) - (n @ vectors / len(words)) ** 2, 0))
            out[k, -4:-1] = again / len(words), len(times) / len(words), float(n.max()) / len(words)
        return out


class Network:
    """One hidden layer of tanh, one output; trained by Adam on the log loss; then divided by a temperature."""

    def __init__(self, size: int, hidden: int, rng: np.random.Generator) -> None:
        self.parts = [rng.normal(0, 1 / np.sqrt(size), (size, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        self.mean, self.scale, self.temperature = np.zeros(size), np.ones(size), 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.parts
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int = 40, batch: int = 64, rate: float = 3e-3, decay: float = 1e-4) -> None:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        first, second = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for low in range(0, len(x), batch):
                part = order[low : low + batch]
                z = (x[part] - self.mean) / self.scale
                a, b, c, d = self.parts
                h = np.tanh(z @ a + b)
                p = 1 / (1 + np.exp(-np.clip(h @ c + d[0], -30, 30)))
                e = (p - y[part]) / len(part)
                back = np.outer(e, c) * (1 - h**2)
                slopes = [z.T @ back + decay * a, back.sum(0), h.T @ e + decay * c, np.array([e.sum()])]
                step += 1
                for k, g in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.parts[k] = self.parts[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss on documents that training didn't see."""
        z = self.logits(x)
        best = min(np.geomspace(0.25, 16, 121), key=lambda t: float(np.logaddexp(0, np.where(y > 0.5, -z, z) / t).mean()))
        self.temperature = float(best)


@dataclass
class Model:
    vectors: Vectors
    network: Network

    def score(self, texts: list[str | None]) -> np.ndarray:
        return self.network.probability(self.vectors.pooled(texts))


def train(texts: list[str | None], labels: list[int], seed: int = 3) -> Model | None:
    """A model from texts and labels; None without both kinds."""
    y = np.array(labels, np.float64)
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    vectors = Vectors(texts)
    x = vectors.pooled(texts).astype(np.float64)
    held = rng.random(len(y)) < (0.2 if len(y) >= 50 else 0.0)
    network = Network(x.shape[1], 32, rng)
    network.train(x[~held], y[~held], rng)
    if held.any():
        network.calibrate(x[held], y[held])
    return Model(vectors, network)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality") -> Model | None:
    """Trains on at most TRAIN_EACH labelled documents of each label, chosen by a hash of the doc_id."""
    got = labelled_sample(docs, labels.where(usable), label, {0: TRAIN_EACH, 1: TRAIN_EACH}, 29)
    return train(got["text"].tolist(), got["label"].tolist())


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with a column ``score``, from 0 to 1; it goes last and replaces one of that name."""
    rest = [c for c in docs.columns if c != "score"]
    plain = docs.select(*(F.col(f"`{c}`") for c in rest))
    if model is None:
        return plain.withColumn("score", F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MOST_WORDS vectors and the network
    place = rest.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            parts = [shared.value.score(texts[i : i + 500]) for i in range(0, len(texts), 500)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))], [*rest, "score"])

    return plain.mapInArrow(run, plain.withColumn("score", F.lit(0.0)).schema)
