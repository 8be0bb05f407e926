"""BagMinHash signatures of multisets, for blocks of documents at a time.

An element of weight w covers the levels 0..w of a weight axis.  On that axis
runs a Poisson process of points, each with a time and a signature position; a
position's value is the least time of the points that fall under the element's
weight, over all elements.  Two multisets agree in a position with probability
sum(min) / sum(max), the weighted Jaccard similarity, since what lies under both
weights is the same points.

The axis is cut hierarchically at the powers of two: the process of the interval
(2^(j-1), 2^j] is independent of the others, runs at the interval's length as
rate and gives each point its unit level by further bits, so an element of
weight w needs log2(w) processes, not w, and only points of the last interval
may lie above the weight and be left out.  Points come in order of time; a
process stops when its time passes the document's largest value so far.

Weights are whole numbers (shingle counts), so the discretisation is exact.
"""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1
GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (two multiply-shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, m: int) -> np.ndarray:
    """(docs, m) signature values.  ``doc``, ``element`` (distinct within a
    document) and ``weight`` (at least 1) run side by side; every document has an
    element."""
    # one process per element and interval: interval 0 is (0, 1], interval j is (2^(j-1), 2^j]
    top = np.ceil(np.log2(weight)).astype(np.int64)
    owner = np.repeat(np.arange(len(doc)), top + 1)
    j = np.arange(len(owner)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    low = np.where(j == 0, 0, 1 << np.maximum(j - 1, 0))
    length = np.where(j == 0, 1, low)
    d = doc[owner].astype(np.int64)
    under = weight[owner] - low  # levels of the interval that lie under the weight
    with np.errstate(over="ignore"):
        seed = mixed(element[owner] + (j.astype(np.uint64) + np.uint64(1)) * GOLD)
        time = np.zeros(len(owner))
        value = np.full(docs * m, np.inf)
        largest = np.full(docs, np.inf)
        step = np.uint64(0)
        scale = 1.0 / (1 << 53)
        while len(seed):
            step += np.uint64(1)
            bits = mixed(seed + step * GOLD)
            time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * scale) / length
            live = time <= largest[d]
            if not live.all():
                seed, time, d, length, under, bits = seed[live], time[live], d[live], length[live], under[live], bits[live]
            more = mixed(bits ^ GOLD)
            at = d * m + ((more >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
            # the point's level inside its interval, as a whole number from 0
            fits = (more & np.uint64(0xFFFFFFFF)).astype(np.int64) % length < under
            if fits.all():
                np.minimum.at(value, at, time)
            else:
                np.minimum.at(value, at[fits], time[fits])
            largest = value.reshape(docs, m).max(axis=1)
    return value.reshape(docs, m)
