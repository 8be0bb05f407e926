"""run() against the stages done plainly on 200 documents."""

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_SMALL
from waitband.llm import toxicity
from waitband.llm.bpe import tokenizer_path
from waitband.llm.common import materialise
from waitband.llm.queries import toxicity_model

from . import cases, test_decontaminate, test_neardup, test_secrets


def plain(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity_model(spark, docs, SF_SMALL)
    rows = []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        cols = {model.columns[f] for w in toxicity.WORD.findall(r.text.lower()) for f in toxicity.features(w) if f in model.columns}
        x = np.array([sum(model.weights[c] for c in cols)])
        if 1 - model.probabilities(x)[0, 0] < 0.5:
            rows.append((r.doc_id, r.text))
    first = {min(c) for c in test_neardup.brute(rows)}
    rows = [r for k, r in enumerate(rows) if k in first]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    dirty = {b[0] for b in test_decontaminate.brute(rows, items) if b[5]}
    rows = [(i, test_secrets.redacted(t)) for i, t in rows if i not in dirty]
    tok = Tokenizer.from_file(tokenizer_path())
    return {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in rows}


def test_run_equals_the_plain_stages(spark):
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == plain(spark)
    assert 0 < len(got) < 200


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name


def through_all(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_SMALL), f"test-{name}")
    return docs


def test_edge_rows_go_through_every_stage(spark):
    docs = cases.documents(spark)
    got = through_all(spark, docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert set(by_id) <= set(texts) and len(by_id) == sum(r.doc_id is not None for r in got)  # a repeated row stays once
    blank = {i for i, t in texts.items() if not (t or "").strip()}
    assert blank <= set(by_id) and all(by_id[i].n_tokens == 0 for i in blank)
    # of texts given twice the least id stays, very long ones stay whole
    first = {}
    for i, t in sorted(texts.items()):
        first.setdefault(t, i)
    assert all(i in blank or first[texts[i]] == i for i in by_id)
    assert max(r.n_tokens for r in got) > 15_000
    assert any(r.doc_id is None for r in got)


def test_an_empty_table_gives_an_empty_result(spark):
    assert through_all(spark, cases.empty(spark)).count() == 0
