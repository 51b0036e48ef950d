"""Toxicity scores by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel compares two words by the three-letter subsequences that they share, gaps allowed, each weighed by ``DECAY``
to the power of its span; word ends count as letters.  An insult keeps most of its kernel value when letters are put
between its own ("idxiot"), marks are put in ("i.d-iot"), letters are spaced out ("i d i o t") or it is inflected.

Training sees labelled sentences.  A toxic document is a bag of them, of which at least one is to be found guilty, by its
worst word (the MI-SVM of Andrews and others, 2003): each round takes the worst sentence of each as its witness.  Every
sentence of a clean document is innocent, and its worst word is a hard negative, the more so the more sentences it leads.
Landmarks are the strings that tell toxic bags from clean ones best, then those that tell the bags which are still
unexplained (rare insults, small languages) by more than chance, and common clean words.  A sentence's value is its
highest word's, a document's its highest sentence's, and a logistic curve makes it a probability.

A linear machine over Nyström features of this kernel is linear in the weighted subsequences too, so each distinct word
is scored by adding up a table's entries.  That is the same number, not an approximation.

Defined cases: null and empty texts score as a word that matches nothing; texts and tokens of any length count whole, long
tokens in overlapping windows; rows that repeat a doc_id are scored one by one, and train as one; without any label of
both kinds, or if nothing tells them apart, every score is 0; labels that are null, or that contradict each other for a
doc_id, count as they stand; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import math
import pickle
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import give_back, labelled_rows

DECAY, SPAN = 0.6, 5
#: Places of the second and third letter after the first.
STEPS = [(a, b) for a in range(1, SPAN - 1) for b in range(a + 1, SPAN)]
#: Numbers for letters: the fewer if these do.  Of more letters than that the rarest share some.
SYMBOLS, MOST_SYMBOLS, SHARED = 64, 128, 32
#: Letters of a word that are looked at together, and where the next look begins: what has 17 letters or fewer is seen whole.
LONGEST, STRIDE = 24, 8
LETTERS = re.compile(r"[^\W\d_]+")
SPACED = re.compile(r"(?<!\S)\S(?:\s\S(?!\S)){2,}")
LOOKALIKE = str.maketrans("013457@$!|", "oieastasil")
INSIDE = re.compile(r"(?<=[^\W\d_])[013457@$!|](?=[^\W\d_])")
SENTENCE = re.compile(r"[.!?]\s|\n")
#: Labelled documents that training looks at, at most: this many toxic ones, and this many clean ones.
TRAIN_TOXIC, TRAIN_CLEAN = 1500, 2500


def words_of(token: str) -> list[str]:
    """The words that a lower-case token may stand for, with ``^`` and ``$`` as its ends."""
    if token.isalpha():
        runs = [token]
    else:
        if not token.isascii() or any(c in "013457@$!|" for c in token):
            token = INSIDE.sub(lambda m: m[0].translate(LOOKALIKE), token)
        runs = LETTERS.findall(token)
        if len(runs) > 1:
            short = [[]]  # letters that stand alone are a word of their own, whatever stands beside them
            for run in runs:
                if len(run) <= 2:
                    short[-1].append(run)
                elif short[-1]:
                    short.append([])
            whole = "".join(runs)
            runs += [whole, *(x for x in ("".join(r) for r in short if len(r) > 2) if x != whole)]
    out = []
    for run in runs:
        marked = f"^{run}$"
        out += [marked] if len(marked) <= LONGEST else [marked[i : i + LONGEST] for i in range(0, len(marked) - LONGEST + STRIDE, STRIDE)]
    return out


def tokens_of(text: str | None) -> set[str]:
    """The distinct lower-case tokens of a text, and its spaced-out words put together."""
    text = (text or "").lower()
    return set(text.split()) | {"".join(m[0].split()) for m in SPACED.finditer(text)}


class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Sentences:
    """The words of many sentences, by number, one after the other; sentences without words are left out."""

    def __init__(self) -> None:
        self.flat, self.sizes, self.owners = array("i"), array("i"), array("i")

    def add(self, owner: int, words: list[int]) -> None:
        if words:
            self.flat.extend(words)
            self.sizes.append(len(words))
            self.owners.append(owner)

    def close(self) -> None:
        self.words, sizes, self.owner = (np.frombuffer(x, np.int32) if x else np.zeros(0, np.int32) for x in (self.flat, self.sizes, self.owners))
        self.starts = np.cumsum(sizes, dtype=np.int64) - sizes
        self.of = np.repeat(np.arange(len(sizes)), sizes)

    def worst(self, values: np.ndarray) -> np.ndarray:
        """The word of highest value in each sentence, the first numbered of equals."""
        if not len(self.starts):
            return np.zeros(0, np.int64)
        top = np.maximum.reduceat(values[self.words], self.starts)
        ties = np.where(values[self.words] == top[self.of], self.words, np.iinfo(np.int32).max)
        return np.minimum.reduceat(ties, self.starts)


class Alphabet:
    """Numbers from 1 for the letters of some strings, of any script; any other letter is 0 and matches nothing."""

    def __init__(self, strings: Iterable[str]) -> None:
        letters = [c for c, _ in Counter("".join(strings)).most_common()]
        self.symbols = SYMBOLS if len(letters) < SYMBOLS else MOST_SYMBOLS
        own = self.symbols - 1 if len(letters) < self.symbols else self.symbols - 1 - SHARED
        number = {ord(c): k + 1 if k < own else own + 1 + xxhash.xxh32_intdigest(c) % SHARED for k, c in enumerate(letters)}
        self.known = np.array(sorted(number), np.uint32)
        self.number = np.array([number[c] for c in sorted(number)], np.int64)
        self.table = np.zeros(0x300, np.int64)  # of the commonest scripts, to look up at once
        low = self.known < len(self.table)
        self.table[self.known[low]] = self.number[low]

    def codes(self, points: np.ndarray) -> np.ndarray:
        out = self.table[np.minimum(points, len(self.table) - 1)]
        if len(high := np.flatnonzero(points >= len(self.table))):
            at = np.minimum(np.searchsorted(self.known, points[high]), max(0, len(self.known) - 1))
            out[high] = np.where(self.known[at] == points[high], self.number[at], 0) if len(self.known) else 0
        return out

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word number, subsequence, weight) of every subsequence of known letters."""
        gap = "\0" * SPAN
        points = np.frombuffer((gap.join(words) + gap).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(w) + SPAN for w in words])
        owner = np.repeat(np.arange(len(words)), lengths)
        code = self.codes(points)
        at = np.flatnonzero(code[: len(code) - SPAN])
        found = []
        for a, b in STEPS:
            second, third = code[at + a], code[at + b]
            ok = (second > 0) & (third > 0)
            i = at[ok]
            found.append((owner[i], (code[i] * self.symbols + second[ok]) * self.symbols + third[ok], np.full(len(i), DECAY ** (b + 1))))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


@dataclass
class Model:
    alphabet: Alphabet
    weights: np.ndarray  # by subsequence
    bias: float
    slope: float
    offset: float

    def values(self, words: list[str], block: int = 5000) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for i in range(0, len(words), block):
            part = words[i : i + block]
            owner, sub, weight = self.alphabet.features(part)
            out[i : i + block] += np.bincount(owner, weight * self.weights[sub], len(part))
        return out

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.offset, -30, 30)))


def kernel(alphabet: Alphabet, words: list[str], landmarks: list[str]) -> np.ndarray:
    """(words, landmarks): kernel values over each landmark's value with itself."""

    def dense(strings: list[str]) -> np.ndarray:
        owner, sub, weight = alphabet.features(strings)
        column = np.searchsorted(known, sub)
        ok = (column < len(known)) & (known[np.minimum(column, len(known) - 1)] == sub)
        out = np.zeros((len(strings), len(known)), np.float64)
        np.add.at(out, (owner[ok], column[ok]), weight[ok])
        return out

    known = np.unique(alphabet.features(landmarks)[1])
    marks = dense(landmarks)
    scale = (marks**2).sum(1)
    parts = [dense(words[i : i + 200]) @ marks.T for i in range(0, len(words), 200)]
    return np.concatenate(parts) / scale if parts else np.zeros((0, len(landmarks)))


def distinct_bags(bags: list[set[str]], sketch: int = 16) -> list[set[str]]:
    """The bags without near copies of earlier ones, which would make any of their words look telling.

    A near copy has half of its least word hashes in common with one earlier bag.
    """
    holders: dict[int, list[int]] = {}
    out = []
    for b in bags:
        least = sorted(xxhash.xxh64_intdigest(w) for w in b)[:sketch]
        met = Counter(k for h in least for k in holders.get(h, ()))
        if not met or 2 * max(met.values()) < len(least):
            for h in least:
                holders.setdefault(h, []).append(len(out))
            out.append(b)
    return out


def beginnings(word: str) -> list[str]:
    """The word, and its first four to seven letters."""
    return [word, *(word[:n] for n in range(5, min(9, len(word))))]


def choose_landmarks(toxic: list[set[str]], clean: Counter, most: int, penalty: float = 8.0) -> list[str]:
    """Words and word beginnings, greedily: found in most toxic bags, and in few clean ones; a word is explained once."""
    least = max(3, math.isqrt(len(toxic)) // 3)
    often: Counter = Counter()
    for bag in toxic:
        often.update({s for w in bag for s in beginnings(w)})
    telling = {s for s, n in often.items() if n >= least}
    del often
    bags_of: dict[str, set[int]] = {}
    words: dict[str, set[str]] = {}
    for k, bag in enumerate(toxic):
        for w in bag:
            if hit := telling.intersection(beginnings(w)):
                bags_of.setdefault(w, set()).add(k)
                for s in hit:
                    words.setdefault(s, set()).add(w)
    innocent: Counter = Counter()
    for w, n in clean.items():
        for s in beginnings(w):
            if s in words:
                innocent[s] += n

    def worth(s: str) -> float:
        return len(set().union(*(bags_of[w] for w in words[s]))) - penalty * innocent[s]

    left = {s: v for s in words if innocent[s] * penalty < len(toxic) and (v := worth(s)) >= least}
    chosen: list[str] = []
    while left and len(chosen) < most:
        best = max(left, key=lambda s: (left[s], len(s), s))
        chosen.append(best)
        gone = set(words[best])
        for s in {s for w in gone for s in beginnings(w)} & telling:
            words[s] = words[s] - gone
            if s in left and (v := worth(s)) >= least:
                left[s] = v
            else:
                left.pop(s, None)
    return chosen


def rare_landmarks(toxic: list[set[str]], clean: Counter, n_clean: int, chosen: list[str], most: int, error: float = 0.05) -> list[str]:
    """Words and beginnings for bags that no chosen string explains: in three of them or more, and by no likely chance.

    Of a string's bags, clean ones included, each is one of these by chance with their share of all; that all strings
    together give one as telling has a chance of ``error``.
    """
    known = set(chosen)
    left = [b for b in toxic if not any(s in known for w in b for s in beginnings(w))]
    found: list[str] = []
    while len(left) >= 3 and len(found) < most:
        often: Counter = Counter()
        for bag in left:
            often.update({s for w in bag for s in beginnings(w)})
        telling = {s: n for s, n in often.items() if n >= 3}
        innocent: Counter = Counter()
        for w, n in clean.items():
            for s in beginnings(w):
                if s in telling:
                    innocent[s] += n
        share = len(left) / (len(left) + n_clean)
        chance = {s: binomial_tail(n, n + innocent[s], share) for s, n in telling.items()}
        passed = [s for s in telling if chance[s] * max(1, len(often)) < error and innocent[s] < telling[s]]
        if not passed:
            break
        best = min(passed, key=lambda s: (chance[s], -len(s), s))
        found.append(best)
        left = [b for b in left if not any(s == best for w in b for s in beginnings(w))]
    return found


def binomial_tail(hits: int, trials: int, share: float) -> float:
    """The chance of so many hits or more."""
    return sum(math.exp(math.lgamma(trials + 1) - math.lgamma(k + 1) - math.lgamma(trials - k + 1) + k * math.log(share) + (trials - k) * math.log1p(-share)) for k in range(hits, trials + 1))


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """A linear support vector machine: Newton steps on the squared hinge loss."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    penalty = np.diag([*np.full(x.shape[1], ridge), 1e-8])
    for _ in range(30):
        active = y * (x1 @ w) < 1
        a, s = x1[active], weight[active]
        new = np.linalg.solve((a * s[:, None]).T @ a + penalty, (a * s[:, None]).T @ y[active]) if active.any() else w
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def damaged(words: list[str], rng: np.random.Generator) -> list[str]:
    """The words with a letter put in, or one said twice."""
    out = []
    for w in words:
        inner = w.strip("^$")
        if len(inner) >= 4:
            k = int(rng.integers(1, len(inner)))
            put = inner[k - 1] if rng.random() < 0.5 else "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)]
            out.append(f"^{inner[:k]}{put}{inner[k:]}$")
    return out


def train(texts: list[str | None], labels: list[int], seed: int = 5, rounds: int = 4) -> Model | None:
    """A model from texts and their labels; None without both kinds."""
    y = np.array(labels)
    if not (y == 1).any() or not (y == 0).any():
        return None
    rng = np.random.default_rng(seed)
    words, sentences = Numbers(), Sentences()
    toxic: list[set[str]] = []
    clean: Counter = Counter()
    for k, (text, v) in enumerate(zip(texts, y, strict=True)):
        bag: set[str] = set()
        for part in SENTENCE.split(text or ""):
            held = {w for token in tokens_of(part) for w in words_of(token)}
            sentences.add(k, [words[w] for w in held])
            bag |= held
        if v == 1:
            toxic.append(bag)
        else:
            clean.update(bag)
    toxic = distinct_bags(toxic)
    sentences.close()
    guilty = choose_landmarks(toxic, clean, 96)
    guilty += rare_landmarks(toxic, clean, int((y == 0).sum()), guilty, 96)
    if not guilty:
        return None
    common = [w for w, _ in clean.most_common(48)]
    innocent = sorted(clean)
    lookalikes = [innocent[i] for i in np.argsort(-kernel_max(Alphabet(guilty), innocent, guilty), kind="stable")[:128]]
    landmarks = list(dict.fromkeys(guilty + common + lookalikes))
    alphabet = Alphabet(landmarks)
    gram = kernel(alphabet, landmarks, landmarks)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-3))  # Nyström: k(x, landmarks) @ root are x's features
    names = list(words)
    worth = kernel_max(alphabet, names, guilty)
    is_toxic = y[sentences.owner] == 1
    first = set(common) | set(lookalikes) | {innocent[i] for i in rng.integers(0, len(innocent), 4000)}
    negatives = dict.fromkeys(first, 0)
    model = None
    for _ in range(rounds):
        if model is not None:
            worth = model.values(names)
            leads = Counter(sentences.worst(worth)[~is_toxic].tolist())
            hard = sorted(leads, key=lambda i: (-worth[i], names[i]))[:1500]
            negatives |= {names[i]: max(negatives.get(names[i], 0), leads[i]) for i in hard}
        # the worst word of each toxic document's worst sentence
        worst = sentences.worst(worth)
        order = np.lexsort((-worth[worst], sentences.owner))
        order = order[is_toxic[order]]
        heads = order[np.unique(sentences.owner[order], return_index=True)[1]]
        witness = Counter(names[i] for i in worst[heads])
        witness.update(guilty)
        known = sorted(w for w in witness if w not in clean)
        bad = [w for w in damaged(known * 4, rng) if w not in clean]
        negative = sorted(negatives)
        x = kernel(alphabet, known + bad + negative, landmarks) @ root
        t = np.array([1.0] * (len(known) + len(bad)) + [-1.0] * len(negative))
        weight = np.array([2.0 + witness[w] for w in known] + [1.0] * len(bad) + [2.0 + min(negatives[w], 20) / 5 for w in negative])
        w, bias = squared_hinge(x, t, weight)
        model = Model(alphabet, _by_subsequence(alphabet, landmarks, root @ w), bias, 1.0, 0.0)
    value = model.values(names)
    best = np.full(len(y), model.bias)
    seen = np.unique(sentences.owner)
    best[seen] = -np.inf
    np.maximum.at(best, sentences.owner, value[sentences.worst(value)])
    model.slope, model.offset = logistic(best, y)
    return model


def kernel_max(alphabet: Alphabet, words: list[str], landmarks: list[str]) -> np.ndarray:
    return np.concatenate([kernel(alphabet, words[i : i + 5000], landmarks).max(1) for i in range(0, len(words), 5000)])


def _by_subsequence(alphabet: Alphabet, landmarks: list[str], share: np.ndarray) -> np.ndarray:
    owner, sub, weight = alphabet.features(landmarks)
    size = alphabet.symbols**3
    scale = np.zeros(len(landmarks))
    flat, inverse = np.unique(owner * size + sub, return_inverse=True)
    summed = np.bincount(inverse, weight)
    np.add.at(scale, flat // size, summed**2)
    out = np.zeros(size)
    np.add.at(out, sub, weight * (share / scale)[owner])
    return out


def logistic(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of Platt's curve, fitted with his smoothed targets."""
    positive = int((y == 1).sum())
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (len(y) - positive + 2))
    a, b = 2.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * value + b, -30, 30)))
        g = np.array([((p - target) * value).sum(), (p - target).sum()])
        h = p * (1 - p) + 1e-9
        hess = np.array([[(h * value**2).sum() + 1e-3, (h * value).sum()], [(h * value).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic") -> Model | None:
    """Trains on at most TRAIN_TOXIC toxic and TRAIN_CLEAN clean labelled documents, chosen by a hash of the doc_id.

    One task trains, on rows bounded by these and characters bounded by SAMPLE_CHARS, so that the driver holds the model
    only, and a lost executor costs another training of the same model.
    """
    rows = labelled_rows(docs, labels.where(usable), label, {1: TRAIN_TOXIC, 0: TRAIN_CLEAN}, 23)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, known = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            known += batch.column(1).to_pylist()
        model = train(texts, known)
        del texts
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    sample = rows.repartition(1).sortWithinPartitions("doc_id", "label").select("text", "label")
    trained = sample.mapInArrow(learn, "model binary").collect()
    return pickle.loads(trained[0]["model"]) if trained else None


class Scores(dict):
    """The value of each token, remembered up to a number of tokens."""

    most = 400_000

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def learn(self, tokens: set[str]) -> None:
        if len(self) > self.most:
            self.clear()
        new = [t for t in tokens if t not in self]
        words = [words_of(t) for t in new]
        flat = self.model.values([w for ws in words for w in ws])
        at = 0
        for t, ws in zip(new, words, strict=True):
            self[t] = max(flat[at : at + len(ws)], default=self.model.bias)
            at += len(ws)


def score(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """``docs`` with a column of scores from 0 to 1; it goes last and replaces one of that name."""
    rest = [c for c in docs.columns if c != name]
    plain = docs.select(*(F.col(f"`{c}`") for c in rest))
    if model is None:
        return plain.withColumn(name, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of MOST_SYMBOLS ** 3 numbers at most
    place = rest.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for batch in batches:
            value = np.full(batch.num_rows, shared.value.bias)
            texts = batch.column(place).to_pylist()
            for low in range(0, len(texts), 200):
                bags = [tokens_of(t) for t in texts[low : low + 200]]
                scores.learn(set().union(*bags))
                value[low : low + len(bags)] = [max(map(scores.__getitem__, b), default=shared.value.bias) for b in bags]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.probability(value))], [*rest, name])

    return plain.mapInArrow(run, plain.withColumn(name, F.lit(0.0)).schema)
