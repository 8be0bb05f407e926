"""Periodic run detection by grammar compression (operator 13).

A run is a stretch of consecutive words with smallest period q that holds at
least ``LEAST`` words and ``TIMES`` periods, and that no neighbouring word
extends with that period.

1. *Candidates.*  In a run of length L and period q the first L - q words equal
   those q further on, so each of its stretches of eight words turns up again
   within the text, at most L / 3 away.  What no such chain of recurring
   stretches covers holds no run and is set aside; what is left is cut into
   segments that hold every run whole.  The test is by hashes and only ever
   keeps too much.
2. *Grammar.*  Re-Pair replaces the most frequent pair of symbols by a new
   nonterminal until no pair occurs twice.  The sequence that remains is closed
   by a balanced tree, so the segment becomes one binary grammar.
3. *Boundaries.*  Every run has a least nonterminal that holds it whole, and it
   crosses the boundary between that nonterminal's two halves.  For each
   nonterminal, once, the runs across its boundary are found: a run is long
   enough that the eight words at one side of the boundary come again one period
   away, which gives the candidate periods; each is extended to both ends by
   comparing words.
4. *Positions.*  The runs of a nonterminal are moved to all places where it
   stands in the derivation; of intervals with equal period those inside another
   go.  What a nonterminal's end cuts short is inside the whole run found higher
   up.

Null and empty texts have no words and no runs.  A row gives a row, repeated
rows too; columns beside the id and the text are ignored; an empty table gives
an empty result.  A task works on one text at a time and needs memory in
proportion to it (about 200 bytes a word of its candidate segments).
"""

from __future__ import annotations

import hashlib
import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bagminhash import GOLD, mixed
from .common import narrow, tidy

LEAST, TIMES = 24, 3
#: Words of the stretches that candidates are found by: two runs' worth of words
#: less one period is 2 * LEAST / 3 = 16, so one side of any boundary has eight.
GRAM = 8
#: Rounds in which segments are narrowed; any number gives the same runs.
ROUNDS = 6

def grams(ids: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` ids from each position on; equal stretches have equal hashes."""
    h = ids.astype(np.uint64)
    with np.errstate(over="ignore"):
        step = 1
        while step < GRAM:
            h = mixed(h[:-step] * GOLD + h[step:])
            step *= 2
    return h


def segments(gram: np.ndarray) -> list[tuple[int, int]]:
    """(first word, end) of the stretches that may hold runs."""
    todo, out = [(0, len(gram) + GRAM - 1, 0)], []
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < LEAST:
            continue
        g = gram[lo:hi - GRAM + 1]
        if depth == 0:
            s = np.sort(g)
            if not (s[1:] == s[:-1]).any():
                continue
        order = np.argsort(g, kind="stable")
        same = g[order[1:]] == g[order[:-1]]
        gap = np.where(same, order[1:] - order[:-1], len(g) + 1)
        nearest = np.full(len(g), len(g) + 1)
        nearest[order[1:]] = gap
        nearest[order[:-1]] = np.minimum(nearest[order[:-1]], gap)
        kept = np.concatenate([[0], (nearest <= (hi - lo) // TIMES).astype(np.int8), [0]])
        edge = np.diff(kept)
        found = [(lo + a, lo + b + GRAM - 1) for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
        if found == [(lo, hi)] or depth == ROUNDS:
            out += [f for f in found if f[1] - f[0] >= LEAST]
        else:
            todo += [(a, b, depth + 1) for a, b in found]
    return out


class Grammar:
    """Re-Pair over a list of ids: ``left``, ``right``, ``size`` and ``at`` (one
    place in the text) of each nonterminal, numbered from ``base`` on, and the
    remaining sequence ``top`` of (place, symbol)."""

    def __init__(self, ids: list[int]):
        n = len(ids)
        sym, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        self.base = nxt = max(ids) + 1
        self.left, self.right, self.size, self.at = [], [], [], []
        places: dict[int, list[int]] = {}
        for i, (a, b) in enumerate(zip(ids, ids[1:])):
            places.setdefault(a << 32 | b, []).append(i)
        heap = [(-len(p), pair) for pair, p in places.items() if len(p) > 1]
        heapq.heapify(heap)
        while heap:
            count, pair = heapq.heappop(heap)
            a, b = pair >> 32, pair & 0xFFFFFFFF
            held = places.pop(pair, None)
            if held is None:
                continue
            live, last = [], -1
            for i in held:
                # places of a pair come in rising order; one that overlaps the one before does not count
                if sym[i] == a and i != last and (j := after[i]) < n and sym[j] == b:
                    live.append(i)
                    last = j
            if len(live) < 2:
                continue
            if len(live) < -count and heap and -len(live) > heap[0][0]:
                places[pair] = live
                heapq.heappush(heap, (-len(live), pair))
                continue
            self.left.append(a)
            self.right.append(b)
            self.size.append(self.length(a) + self.length(b))
            self.at.append(live[0])
            made: dict[int, list[int]] = {}
            for i in live:
                j = after[i]
                k = after[j]
                sym[i], sym[j] = nxt, -1
                after[i] = k
                h = before[i]
                if h >= 0:
                    made.setdefault(sym[h] << 32 | nxt, []).append(h)
                if k < n:
                    before[k] = i
                    made.setdefault(nxt << 32 | sym[k], []).append(i)
            for pair, p in made.items():
                if len(p) > 1:
                    places[pair] = p
                    heapq.heappush(heap, (-len(p), pair))
            nxt += 1
        self.top, i = [], 0
        while i < n:
            self.top.append((i, sym[i]))
            i = after[i]

    def length(self, symbol: int) -> int:
        return 1 if symbol < self.base else self.size[symbol - self.base]


def reach(ids: np.ndarray, i: int, j: int, limit: int, back: bool = False) -> int:
    """Words that agree from ``i`` and ``j`` on (``back``: before them), at most ``limit``."""
    k, step = 0, 64
    while k < limit:
        m = min(step, limit - k)
        a, b = (ids[i - k - m:i - k], ids[j - k - m:j - k]) if back else (ids[i + k:i + k + m], ids[j + k:j + k + m])
        differ = np.flatnonzero(a != b)
        if len(differ):
            return k + (m - 1 - int(differ[-1]) if back else int(differ[0]))
        k += m
        step *= 4
    return k


def across(ids: np.ndarray, gram: np.ndarray, lo: int, hi: int, b: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs within [lo, hi) that cross the boundary before ``b``."""
    most = (hi - lo) // TIMES
    found: list[tuple[int, int, int]] = []
    near = []
    for at in (b, b - GRAM):  # the eight words right and left of the boundary
        if lo <= at <= hi - GRAM:
            first = max(lo, at - most)
            hits = np.flatnonzero(gram[first:min(hi - GRAM, at + most) + 1] == gram[at]) + first - at
            near.append(np.abs(hits))
    periods = np.unique(np.concatenate(near)) if near else np.zeros(0, np.int64)
    periods = periods[periods > 0]
    # a period left of the boundary, then one right of it: each may belong to a run of its own
    open_left, open_right = periods <= b - lo, periods <= hi - b
    while len(periods):
        q, left, right = int(periods[0]), open_left[0], open_right[0]
        periods, open_left, open_right = periods[1:], open_left[1:], open_right[1:]
        for ok, i in ((left, b - q), (right, b)):
            if not ok:
                continue
            s = i - reach(ids, i, i + q, i - lo, back=True)
            e = i + q + reach(ids, i, i + q, hi - i - q)
            if s < b < e and e - s >= max(LEAST, TIMES * q) and (s, e, q) not in found:
                found.append((s, e, q))
                # inside the run, a multiple of its period reaches no further than the run
                multiple = periods % q == 0
                open_left = open_left & ~(multiple & (periods <= b - s))
                open_right = open_right & ~(multiple & (periods <= e - b))
                more = open_left | open_right
                periods, open_left, open_right = periods[more], open_left[more], open_right[more]
    return found


def of_segment(words: np.ndarray, gram: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the maximal runs of a segment, places in the text."""
    ids = words[lo:hi]
    gram = gram[lo:hi - GRAM + 1]
    g = Grammar(np.unique(ids, return_inverse=True)[1].tolist())
    own: list[list] = []  # runs across each nonterminal's boundary, from its first word on
    some: list[bool] = []
    for k, (size, at, left, right) in enumerate(zip(g.size, g.at, g.left, g.right)):
        here = [(s - at, e - at, q) for s, e, q in across(ids, gram, at, at + size, at + g.length(left))] if size >= LEAST else []
        own.append(here)
        some.append(bool(here) or left >= g.base and some[left - g.base] or right >= g.base and some[right - g.base])
    best: dict[int, list] = {}
    todo = [(at, x - g.base) for at, x in g.top if x >= g.base and some[x - g.base]]
    while todo:
        at, k = todo.pop()
        for s, e, q in own[k]:
            best.setdefault(q, []).append((at + s, at + e))
        for child, where in ((g.left[k], at), (g.right[k], at + g.length(g.left[k]))):
            if child >= g.base and some[child - g.base]:
                todo.append((where, child - g.base))
    # the balanced tree over what Re-Pair left
    starts = [at for at, _ in g.top] + [hi - lo]
    spans = [(0, len(g.top))]
    while spans:
        a, z = spans.pop()
        if z - a < 2 or starts[z] - starts[a] < LEAST:
            continue
        m = (a + z) // 2
        for s, e, q in across(ids, gram, starts[a], starts[z], starts[m]):
            best.setdefault(q, []).append((s, e))
        spans += [(a, m), (m, z)]
    out = {}
    for q, spans in sorted(best.items()):
        end = -1
        for s, e in sorted(spans, key=lambda x: (x[0], -x[1])):
            if e > end:
                out.setdefault((s, e), q)  # the smallest period of a stretch
                end = e
    return [(lo + s, lo + e, q) for (s, e), q in out.items()]


def find(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of words, by start, then period."""
    if len(words) < LEAST:
        return []
    gram = grams(np.fromiter(map(hash, words), np.int64, len(words)))
    cut = segments(gram)
    if not cut:
        return []
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    out = [r for lo, hi in cut for r in of_segment(ids, gram, lo, hi)]
    return sorted((s, e - s, q) for s, e, q in out)


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without what any run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), bool)
    for s, n, q in runs:
        drop[s + q:s + n] = True
    return [words[i] for i in np.flatnonzero(~drop).tolist()]


def highest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, exactly; then the first, then the smallest period."""
    best = None
    for r in runs:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def recast(words: list, doc_id: int | None) -> list:
    """The contract's words: a tenth of the documents get a periodic tail."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def each(docs: DataFrame, id_col: str, text_col: str, schema: str, make) -> DataFrame:
    """``make(doc_id, words)`` gives the rows of a document, as tuples; the words
    are UTF-8, parted at the six ASCII white-space characters."""
    typed = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in (f.split() for f in schema.split(", "))])

    def run(batches):
        for b in batches:
            rows = [r for i, t in zip(b.column(0), b.column(1).cast(pa.binary())) for r in make(i.as_py(), (t.as_py() or b"").split())]
            cols = list(zip(*rows)) or [()] * len(typed)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, typed)], schema=typed)

    return narrow(docs, {id_col: "long", text_col: "string"}).mapInArrow(tidy(run), schema)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, period): a row per run of the texts as they are."""
    return each(docs, id_col, text_col, "doc_id long, start long, length long, period long",
                lambda i, words: [(i, *r) for r in find(words)])


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): the words that stay when every run keeps one period."""
    return each(docs, id_col, text_col, "doc_id long, text string", lambda i, words: [(i, b" ".join(collapsed(words, find(words))).decode())])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: how many runs its recast words hold, the highest
    one, and SHA-256 of all runs and of the collapsed words."""
    def make(i, words):
        words = recast(words, i)
        runs = find(words)
        top = highest(runs)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        sha = [hashlib.sha256(x).hexdigest() for x in (lines, b" ".join(collapsed(words, runs)))]
        return [(i, len(runs), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None, *sha)]

    return each(docs, id_col, text_col, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                "runs_sha256 string, collapsed_sha256 string", make)
