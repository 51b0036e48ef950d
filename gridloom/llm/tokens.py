"""Token ids of many texts with a public tokenizer file, a batch at a time inside tasks.

The two BPE files cut a text into pieces before any merge, and no merge crosses a piece.  So each distinct piece is
encoded once by the library and remembered, and a text's ids are gathered from its pieces.  New words go through the
library side by side in one text, and their ids are told apart by the tokens that begin or end a word.  That holds for
texts of plain characters only, for which the cutting rule below is the library's; any other text is encoded by the library whole,
as is one that holds the string of a special token, which the library reads as that token.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
from collections.abc import Iterator
from pathlib import PurePath

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

#: White space, ASCII and the letters up to U+012F: no normal form changes them, and every library agrees on their kinds.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-į]*\Z")
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-į"
NUMBERS = "0-9²³¹¼½¾"
BLANK = "\\t\\n\\r\\x20"
OTHER = f"[^{BLANK}{LETTERS}{NUMBERS}]"
#: By file name: how the file cuts a plain text, and whether it lowers its case before.
PIECES = {
    "byte_bpe_50k.json": (re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?{OTHER}+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"), False),
    "word_bpe_49k.json": (re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|{OTHER}+"), True),
}


class Pieces(dict):
    """Numbers the pieces as they come; ``new`` holds those that have no ids yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encodes texts; remembers the ids of at most ``most`` pieces, and beyond that of the ``kept`` ones used most."""

    most, kept = 240_000, 120_000
    #: Pieces that the library encodes at a time: what it returns for a piece takes about a kilobyte.
    at_once = 4_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.rule, self.lower = PIECES.get(PurePath(path).name, (None, False))
        #: By id: whether the token begins a word after a space (ends a word, in a file that drops case and spaces).
        self.edge = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab().items():
            self.edge[i] = token.endswith("</w>") if self.lower else token.startswith("Ġ")
        self.pieces = Pieces()
        self.starts = self.lengths = self.uses = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def forget(self) -> None:
        """All but the pieces used most."""
        if len(self.pieces) <= self.kept:
            return
        keep = np.sort(np.argpartition(self.uses, len(self.uses) - self.kept)[-self.kept :])
        names = list(self.pieces)
        self.pieces = Pieces()
        self.pieces.update((names[k], i) for i, k in enumerate(keep.tolist()))
        self.ids = self.gathered(keep)
        self.lengths, self.uses = self.lengths[keep], self.uses[keep] // 2  # what was used long ago counts less
        self.starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)

    def word(self, piece: str) -> bool:
        """Whether the piece is a word that stays a piece of its own beside others like it."""
        return piece.isalpha() if self.lower else piece[0] == " " and piece[1:].isalpha()

    def side_by_side(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """(lengths, ids) of words that the library reads as one text; None if the edges don't tell as many words."""
        ids = np.array(self.library.encode_batch_fast([(" " if self.lower else "").join(words)], add_special_tokens=False)[0].ids, np.uint32)
        edges = np.flatnonzero(self.edge[ids])
        if len(edges) != len(words):
            return None
        return np.diff(edges, prepend=-1) if self.lower else np.diff(edges, append=len(ids)), ids

    def one_by_one(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [x.ids for x in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        return lengths, np.fromiter((i for x in coded for i in x), np.uint32, int(lengths.sum()))

    def learn(self) -> None:
        new, self.pieces.new = self.pieces.new, []
        lengths, starts, ids, size = np.zeros(len(new), np.int32), np.zeros(len(new), np.int32), [self.ids], len(self.ids)
        words = [k for k, p in enumerate(new) if self.word(p)]
        known = set(words)
        for numbers, joint in ((words, True), ([k for k in range(len(new)) if k not in known], False)):
            for a in range(0, len(numbers), self.at_once):
                at = numbers[a : a + self.at_once]
                block = [new[k] for k in at]
                sizes, coded = (self.side_by_side(block) if joint else None) or self.one_by_one(block)
                lengths[at], starts[at] = sizes, size + np.cumsum(sizes) - sizes
                ids.append(coded)
                size += len(coded)
        if new:
            self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int32)])
            self.ids = np.concatenate(ids)

    def gathered(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of these pieces, one after the other."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[numbers] - ends + lengths, lengths) + np.arange(total)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, as uint32; none for a null."""
        if len(self.pieces) > self.most:
            self.forget()
        out: list[np.ndarray | None] = [None] * len(texts)
        cut = []
        number = self.pieces.__getitem__
        for i, text in enumerate(texts):
            text = text or ""
            if self.rule is not None and PLAIN.match(text) and not any(s in text for s in self.special):
                cut.append((i, np.fromiter(map(number, self.rule.findall(text.lower() if self.lower else text)), np.int32)))
            else:
                out[i] = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        self.learn()
        if cut:
            self.uses += np.bincount(np.concatenate([n for _, n in cut]), minlength=len(self.uses)).astype(np.int32)
        for i, numbers in cut:
            out[i] = self.gathered(numbers)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def release() -> None:
    """At the end of a task: a worker process that waits for its next one keeps the pieces used most, and no free memory."""
    for held in _encoders.values():
        held.forget()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not this C library
        ctypes.CDLL(None).malloc_trim(0)


def chunks(column: pa.Array, most_bytes: int = 1_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of an Arrow column, about so many bytes at a time (one text may be more), each with its first row's number."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes, dtype=np.int64) // most_bytes
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(column)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield a, column.slice(a, b - a).to_pylist()


def vocabulary_size(path: str) -> int:
    """How many ids the tokenizer file can give."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def id_width(path: str, end_id: int) -> int:
    """Bytes that an id takes: 2 if the vocabulary and the end id allow, else 4."""
    return 2 if max(vocabulary_size(path) - 1, end_id) < 1 << 16 else 4
