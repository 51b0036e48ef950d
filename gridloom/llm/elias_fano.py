"""Elias-Fano coding of ascending whole numbers, with select."""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<QQBQQ")  # count, largest, low bits, bytes of low part, bytes of high part
#: One bits between two samples; values packed at a time; bytes looked through at a time for samples.
SAMPLE, CHUNK, SCAN = 256, 1 << 14, 1 << 16


class EliasFano:
    """``values[i]`` without a table of values: i's low bits stand packed, the high bits are gaps in a bit vector.

    About 2 + log2(largest / count) bits each, and a quarter of a bit for the samples.  Both parts stay packed as they
    are stored: ``select`` starts at the sample before the i-th one bit and unpacks up to the next sample, no further.
    """

    def __init__(self, count: int, largest: int, low_bits: int, low: bytes | memoryview, high: bytes | memoryview) -> None:
        self.count, self.largest, self.low_bits, self.low, self.high = count, largest, low_bits, low, high
        self._low, self._high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        places, before, seen = [], [], 0
        for at in range(0, len(self._high), SCAN):
            ones = np.bitwise_count(self._high[at : at + SCAN])
            upto = seen + np.cumsum(ones, dtype=np.int64)
            wanted = np.arange(-(-seen // SAMPLE) * SAMPLE, int(upto[-1]), SAMPLE)
            byte = np.searchsorted(upto, wanted, side="right")
            places.append((at + byte).astype(np.uint32))
            before.append((wanted - upto[byte] + ones[byte]).astype(np.uint8))
            seen = int(upto[-1])
        #: The byte of every SAMPLE-th one bit, and that bit's place among the byte's ones.
        self._byte = np.concatenate(places) if places else np.zeros(0, np.uint32)
        self._skip = np.concatenate(before) if before else np.zeros(0, np.uint8)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """From ascending values that are not negative."""
        values = np.asarray(values, np.uint64)
        if not len(values):
            return cls(0, 0, 0, b"", b"")
        largest = int(values[-1])
        low_bits = max(0, (max(largest, 1) // len(values)).bit_length() - 1)
        high = np.zeros((((largest >> low_bits) + len(values)) >> 3) + 1, np.uint8)
        low = []
        for at in range(0, len(values), CHUNK):  # a multiple of 8 values, so that each chunk ends with a byte
            part = values[at : at + CHUNK]
            bits = (part[:, None] >> np.arange(low_bits, dtype=np.uint64)[None, :]) & np.uint64(1)
            low.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
            places = (part >> np.uint64(low_bits)).astype(np.int64) + np.arange(at, at + len(part))
            np.bitwise_or.at(high, places >> 3, (1 << (places & 7)).astype(np.uint8))
        return cls(len(values), largest, low_bits, b"".join(low), high.tobytes())

    def span(self, i: int, j: int) -> np.ndarray:
        """The values from the i-th up to, not including, the j-th, as uint64."""
        if not 0 <= i <= j <= self.count:
            raise IndexError((i, j))
        if i == j:
            return np.zeros(0, np.uint64)
        first, after = i // SAMPLE, (j - 1) // SAMPLE + 1
        start = int(self._byte[first])
        part = self._high[start : int(self._byte[after]) + 1 if after < len(self._byte) else None]
        full = np.flatnonzero(part)
        bits = np.unpackbits(part[full], bitorder="little").reshape(-1, 8)
        row, column = np.nonzero(bits)
        skip = i - first * SAMPLE + int(self._skip[first])
        places = (8 * (start + full[row]) + column)[skip : skip + j - i]
        high = (places - np.arange(i, j)).astype(np.uint64)
        at = i * self.low_bits
        raw = np.unpackbits(self._low[at >> 3 : (j * self.low_bits + 7) >> 3], bitorder="little")[at & 7 :]
        raw = raw[: (j - i) * self.low_bits].reshape(j - i, self.low_bits)
        out = high << np.uint64(self.low_bits)
        for k in range(self.low_bits):
            out |= raw[:, k].astype(np.uint64) << np.uint64(k)
        return out

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        return int(self.span(i, i + 1)[0])

    def all(self) -> np.ndarray:
        """All values, as uint64.  Only for small sequences: it is the table that ``span`` avoids."""
        return self.span(0, self.count)

    def to_bytes(self) -> bytes:
        return HEAD.pack(self.count, self.largest, self.low_bits, len(self.low), len(self.high)) + self.low + self.high

    @classmethod
    def from_bytes(cls, data: bytes | memoryview, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence at this place, and the place after it.  Nothing is copied."""
        data = memoryview(data)
        count, largest, low_bits, n_low, n_high = HEAD.unpack_from(data, at)
        at += HEAD.size
        return cls(count, largest, low_bits, data[at : at + n_low], data[at + n_low : at + n_low + n_high]), at + n_low + n_high
