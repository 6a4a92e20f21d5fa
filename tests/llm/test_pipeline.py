import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from helpers import classes_by_brute_force, covered, strange, strings_cut

from loomdex.llm import toxicity
from loomdex.llm.common import blocks, keep, table
from loomdex.llm.packing import encoder
from loomdex.llm.queries import QUERIES, vocabulary


def toxic_scores(rows, model):
    """Scores of texts one by one."""
    cells, weights, bias = model
    weight = dict(zip(cells.tolist(), weights.tolist()))
    out = {}
    for doc, text in rows:
        batch = pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])
        _, _, data, at = next(blocks(batch))
        total = bias + sum(weight.get(c, 0.0) for c in set(toxicity.features(data, at)[1].tolist()))
        out[doc] = 1 / (1 + np.exp(-total))
    return out


def test_run_equals_brute_force(spark, data):
    documents = table(spark, data, "documents")
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    labels = table(spark, data, "labels").selectExpr("doc_id", "toxic as label")
    scores = toxic_scores(rows, toxicity.learn(documents, labels))
    rows = [r for r in rows if scores[r[0]] < toxicity.THRESHOLD]
    rows = sorted(rows[min(c)] for c in classes_by_brute_force(rows))
    rows = strings_cut(rows, corpus_pipeline.REPEAT)
    items = [(r.item_id, r.text) for r in table(spark, data, "benchmark").collect()]
    rows = [r for r in rows if not covered(r[1], items)]
    encode = encoder(vocabulary("byte_bpe_50k.tiktoken")).encode_ordinary
    want = set()
    for doc, text in rows:
        ids = [*encode(text), 2]
        at = 0
        for k, end in enumerate(range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)):
            want.add((doc, k, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes())))
            at = end
    got = corpus_pipeline.run(spark, data).collect()
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    filled: dict = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 1024


def test_stages_keep_columns_and_take_effect(spark, data):
    docs = table(spark, data, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given, docs = docs, keep(stage(spark, docs, data), name)
        assert docs.schema.simpleString() == given.schema.simpleString()
        assert docs.join(given, "doc_id", "left_anti").count() == 0
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] > counts[4] > 0.5 * counts[0]


def test_stages_take_strange_rows_and_none(spark, data):
    for rows in (strange(spark, "one two three four five six"), strange(spark, "x").where("false")):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            given, docs = docs, keep(stage(spark, docs, data), name)
            assert docs.count() > 0 or rows.isEmpty()
            assert name == "best_fit_packing" or docs.columns == given.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_have_stable_columns(spark, data, name):
    df = QUERIES[name](spark, data)
    assert len(set(df.columns)) == len(df.columns)
