"""BPE encoding of a documents table (operator 2): the streaming transducer of
``bpe`` run over Arrow batches, no shuffle.

Null text counts as empty; an empty text has no ids.  A row gives a row, so
repeated rows and equal texts each keep theirs; a null doc_id stays null.
Columns beside the id and the text are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import ByteDecoder, Digester, encoder
from .common import kept, narrow, tidy


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_tokens, ids_sha256 (of the decimal ids joined by
    a space) and decoded_sha256 (of the decoded text)."""
    def run(batches):
        work = kept(f"bpe {path}", lambda: Digester(path))  # its memo serves all the tasks of a worker
        for b in batches:
            out = [work.digest(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string()),
                 pa.array([x[2] for x in out], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return narrow(docs, {id_col: "long", text_col: "string"}).mapInArrow(
        tidy(run, f"bpe {path}"), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its ids (array of int)."""
    def run(batches):
        enc = encoder(path)
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.as_py()], pa.int64()), pa.array([enc.encode(t.as_py())], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return narrow(docs, {id_col: "long", text_col: "string"}).mapInArrow(tidy(run), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, form: str = "text") -> DataFrame:
    """Ids back to text, one row per document; null ids give an empty text."""
    def run(batches):
        merges = encoder(path).merges
        for b in batches:
            texts = [ByteDecoder(merges, form).decode(ids.as_py() or []) for ids in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return narrow(encoded, {"doc_id": "long", "ids": "array<int>"}).mapInArrow(tidy(run), "doc_id long, text string")
