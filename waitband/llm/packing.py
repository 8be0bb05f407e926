"""Token packing (operator 8): best-fit decreasing with a segment tree.

Documents are encoded with a byte-level rank file (so ids decode to the exact
text), documents longer than a row are split without loss into
full rows and a rest, and the rests are packed into rows of ``capacity`` tokens
by best-fit decreasing: pieces from long to short, each into the fullest row
that still takes it.  Open rows are counted by free capacity in the leaves of a
segment tree, and the search walks it for the least free capacity that is large
enough, so a piece costs log2(capacity) steps whatever the number of rows.

Pieces are dealt by a hash of the document into groups of about
``GROUP_TOKENS`` tokens; a group is packed in windows of at most
``WINDOW_TOKENS``, so a task's memory is bounded however the documents are
distributed.  Order inside a group is fixed (hash, doc_id, text), so a task that
is run again after a loss writes the same rows.

A packed row holds its ids as little-endian unsigned integers padded with
``pad``, the cumulative segment lengths (0 first, number of real tokens last),
per segment the document, the piece's place in it and where positions reset.
``write_matrices`` stores them as a table with one matrix row per row.

A null or empty text has no tokens and is in no row; a null doc_id is kept;
repeated rows are packed once each.  Other columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import tokenizer_path
from .common import materialise, narrow, tidy

CAPACITY = 2048
#: The free id above the 50,256 ranks of the default file.
PAD = 50256
GROUP_TOKENS = 2 << 20
WINDOW_TOKENS = 8 << 20
#: Partitions at most; a task packs its groups one after the other.
PARTITIONS = 20_000
SCHEMA = ("ids binary, n_tokens int, cu_seqlens array<int>, doc_ids array<bigint>, piece_starts array<bigint>, position_resets array<int>")


class Capacities:
    """How many open rows have each free capacity, as a segment tree over the
    capacities 1..top: finds the least that is at least ``need``."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, free: int, by: int) -> None:
        i = self.leaves + free
        while i:
            self.count[i] += by
            i >>= 1

    def least(self, need: int) -> int | None:
        i = self.leaves + need
        if self.count[i]:
            return need
        # up to the first left child whose right neighbour has rows, then down its left edge
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Rows as lists of piece numbers.  Pieces of equal size keep their order,
    rows of equal free capacity are filled last opened first."""
    tree, rows = Capacities(capacity), []
    by_free: dict[int, list[int]] = {}
    for p in sorted(range(len(sizes)), key=lambda p: (-sizes[p], p)):
        need = sizes[p]
        free = tree.least(need)
        if free is None:
            row, free = len(rows), capacity
            rows.append([])
        else:
            row = by_free[free].pop()
            tree.add(free, -1)
        rows[row].append(p)
        if rest := free - need:
            by_free.setdefault(rest, []).append(row)
            tree.add(rest, 1)
    return rows


@lru_cache(maxsize=2)
def encoding(path: str):
    """A rank file's encoding, one per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_path() -> str:
    return tokenizer_path("byte_bpe_50k.tiktoken")


def id_type(path: str) -> str:
    return "<u2" if encoding(path).n_vocab < 1 << 16 else "<u4"


def tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, deal, n, ids): ids as little-endian 16-bit integers (32-bit if the
    vocabulary needs them)."""
    def run(batches):
        enc, kind = encoding(path), id_type(path)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids = [np.array(enc.encode_ordinary(t.as_py() or ""), kind) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(i) for i in ids], pa.int64()),
                                                  pa.array([i.tobytes() for i in ids], pa.binary())], ["doc_id", "deal", "n", "ids"])

    rows = narrow(docs, {id_col: "long", text_col: "string"}).toDF("doc_id", "text")
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("deal"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, deal long, n long, ids binary").filter("n > 0")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, pad: int = PAD) -> DataFrame:
    """Packed rows (SCHEMA, plus group and row, which name a row)."""
    kind = id_type(path)
    rows = materialise(tokens(docs, path), "packing-tokens")
    total = rows.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // GROUP_TOKENS))
    dealt = rows.withColumn("group", F.pmod("deal", F.lit(groups)).cast("int"))
    dealt = dealt.repartitionByRange(min(groups, PARTITIONS), "group").sortWithinPartitions("group", "deal", "doc_id")

    def matrix_rows(docs_: list[tuple], group: int, start: int):
        """Rows of one window; docs_: (doc_id, ids as array)."""
        full, rest = [], []
        for i, ids in docs_:
            whole = len(ids) // capacity * capacity
            full += [[(i, at, ids[at:at + capacity])] for at in range(0, whole, capacity)]
            if whole < len(ids):
                rest.append((i, whole, ids[whole:]))
        filled = [[rest[p] for p in r] for r in best_fit([len(x[2]) for x in rest], capacity)]
        for k, segments in enumerate(full + filled):
            ends = np.cumsum([0, *(len(s[2]) for s in segments)])
            ids = np.full(capacity, pad, kind)
            ids[:ends[-1]] = np.concatenate([s[2] for s in segments])
            yield (group, start + k, ids.tobytes(), int(ends[-1]), ends.tolist(), [s[0] for s in segments], [s[1] for s in segments], ends[:-1].tolist())

    names = ["group", "row", *[f.split()[0] for f in SCHEMA.split(", ")]]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches):
        group, next_row, held, window = None, 0, 0, []

        def flush():
            nonlocal next_row, held
            found = list(matrix_rows(window, group, next_row)) if window else []
            next_row += len(found)
            held = 0
            window.clear()
            for lo in range(0, len(found), 1024):
                cols = zip(*found[lo:lo + 1024])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for b in batches:
            for g, i, ids in zip(*[b.column(c).to_pylist() for c in range(3)]):
                if g != group:
                    yield from flush()
                    group, next_row = g, 0
                ids = np.frombuffer(ids, kind)
                window.append((i, ids))
                held += len(ids)
                if held >= WINDOW_TOKENS:
                    yield from flush()
        yield from flush()

    return dealt.select("group", "doc_id", "ids").mapInArrow(tidy(run), f"group int, row long, {SCHEMA}")


def write_matrices(packed: DataFrame, path: str) -> None:
    """One table file per group of tasks: a matrix row per row, in order."""
    packed.write.parquet(path)


def unpack(packed: DataFrame, kind: str = "<u2") -> DataFrame:
    """(doc_id, start, ids) of every segment: what packing took in, for checks
    and for reading single documents."""
    def run(batches):
        for b in batches:
            out = []
            for ids, ends, docs_, starts in zip(*[b.column(c).to_pylist() for c in range(4)]):
                row = np.frombuffer(ids, kind)
                out += [(d, s, row[a:e].astype("i4").tolist()) for d, s, a, e in zip(docs_, starts, ends, ends[1:])]
            cols = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int32()))], ["doc_id", "start", "ids"])

    return packed.select("ids", "cu_seqlens", "doc_ids", "piece_starts").mapInArrow(tidy(run), "doc_id long, start long, ids array<int>")
