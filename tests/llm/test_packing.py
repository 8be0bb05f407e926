import random

import numpy as np
from pyspark.sql import functions as F

from waitband.llm import packing

from . import cases


def plain_best_fit(sizes, capacity):
    """The definition: the fullest row that still takes the piece."""
    rows, free = [], []
    for p in sorted(range(len(sizes)), key=lambda p: (-sizes[p], p)):
        fits = [r for r in range(len(rows)) if free[r] >= sizes[p]]
        if fits:
            r = min(fits, key=lambda r: free[r])
        else:
            r = len(rows)
            rows.append([])
            free.append(capacity)
        rows[r].append(p)
        free[r] -= sizes[p]
    return sorted(free)


def test_best_fit_decreasing_against_the_definition():
    rng = random.Random(6)
    for _ in range(60):
        capacity = rng.choice([1, 7, 64, 100, 2048])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
        rows = packing.best_fit(sizes, capacity)
        assert sorted(p for r in rows for p in r) == list(range(len(sizes)))
        assert sorted(capacity - sum(sizes[p] for p in r) for r in rows) == plain_best_fit(sizes, capacity)


def test_capacity_search():
    tree = packing.Capacities(100)
    held = []
    rng = random.Random(2)
    for _ in range(500):
        c = rng.randint(1, 100)
        if rng.random() < 0.6 or not held:
            held.append(c)
            tree.add(c, 1)
        else:
            tree.add(held.pop(), -1)
        need = rng.randint(1, 100)
        assert tree.least(need) == min((h for h in held if h >= need), default=None)


def test_nothing_is_lost(spark):
    docs = cases.documents(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    packed = packing.pack(docs, packing.default_path(), capacity=256)
    for r in packed.collect():
        assert len(np.frombuffer(r.ids, "<u2")) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 256
        assert r.cu_seqlens[:-1] == r.position_resets and len(r.doc_ids) == len(r.piece_starts) == len(r.position_resets)
        assert set(np.frombuffer(r.ids, "<u2")[r.n_tokens:].tolist()) <= {packing.PAD}
    whole = packing.unpack(packed).groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "ids"))), lambda x: x["ids"])).alias("ids"))
    decode = packing.encoding(packing.default_path()).decode_bytes
    assert {r.doc_id: decode(r.ids).decode() for r in whole.collect()} == {r.doc_id: r.text for r in docs.collect() if r.text}


def test_repeated_rows_windows_and_empty(spark, monkeypatch):
    docs = cases.documents(spark)
    total = sum(len(packing.encoding(packing.default_path()).encode_ordinary(r.text or "")) for r in docs.collect())
    for tokens in (1 << 20, 3000):
        monkeypatch.setattr(packing, "GROUP_TOKENS", tokens)
        monkeypatch.setattr(packing, "WINDOW_TOKENS", tokens // 2)
        rows = packing.pack(docs, packing.default_path(), capacity=512).collect()
        assert sum(r.n_tokens for r in rows) == total
        assert len({(r.group, r.row) for r in rows}) == len(rows)
    assert packing.pack(cases.empty(spark), packing.default_path()).count() == 0


def test_written_matrices_read_back(spark):
    from waitband.session import scratch_path
    docs = spark.createDataFrame([(i, f"text number {i} " * (1 + i % 40)) for i in range(120)], "doc_id long, text string")
    packed = packing.pack(docs, packing.default_path(), capacity=64)
    path = scratch_path(spark, "matrices")
    packing.write_matrices(packed, path)
    back = spark.read.parquet(path)
    assert all(len(r.ids) == 64 * 2 for r in back.select("ids").collect())
    key = lambda r: (r.doc_id, r.start, r.ids)
    assert sorted(packing.unpack(back).collect(), key=key) == sorted(packing.unpack(packed).collect(), key=key)
