"""Reading of embedding tables, and small numpy helpers for vectors inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether it is a vector of finite components, at least one of them."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def stacked(rows: list, size: int, dtype: type = np.float64) -> np.ndarray:
    """A matrix of the rows, shorter ones filled up with zeros."""
    out = np.zeros((len(rows), size), dtype)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def nearest(x: np.ndarray, centres: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and its squared distance."""
    which, least = np.zeros(len(x), np.int64), np.zeros(len(x))
    own = (centres**2).sum(1)
    for i in range(0, len(x), block):
        part = x[i : i + block]
        d = own[None, :] - 2 * part @ centres.T
        which[i : i + block] = d.argmin(1)
        least[i : i + block] = d.min(1) + (part**2).sum(1)
    return which, np.maximum(least, 0)


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """At most k centres of the rows by Lloyd's rounds."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        which, _ = nearest(x, centres)
        count = np.bincount(which, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, which, x)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres
