"""Documents with everything that may turn up: nulls in every column, empty and
very long texts, ties, repeated rows, and columns whose names operators might use."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, key string, size int, tag string, "
          "removed int, __id int, shard string")


def prose(rng, n):
    words = ["alpha", "beta", "gamma", "delta", "omega", "river", "stone", "cloud", "ember", "field", "Été", "größe", "niño"]
    out = []
    for k in range(n):
        w = rng.choice(words) + str(rng.randint(0, 400)) * (rng.random() < 0.7)
        out.append(w + (". " if rng.random() < 0.12 else " " if rng.random() < 0.97 else "\n"))
    return "".join(out)


def documents(spark, texts=None):
    rng = random.Random(5)
    if texts is None:
        texts = [prose(rng, rng.randint(1, 120)) for _ in range(30)]
        texts += [None, "", " ", "...", "x" * 30_000, prose(rng, 20_000), texts[0], texts[1], texts[0]]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}" if i % 5 else None, None if i % 4 else 7, i, "k", 1, "t", 1, 1, "s") for i, t in enumerate(texts)]
    if len(rows) > 5:
        rows += [rows[3], rows[3], (None, *rows[4][1:]), (None, *[None] * 11), (None, *[None] * 11)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
