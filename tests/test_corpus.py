import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomdex.functions.embedding import embed_text
from loomdex.operators import corpus

TEXTS = ["b a a c", "a b", "c a z", "a", ""]


@pytest.fixture(scope="module")
def words(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    return corpus.with_tokens(rows).select("id", "tokens")


def python_vocabulary(texts, cap):
    return Counter(t for x in texts for t in x.lower().split()).most_common(cap)


def python_idf(texts):
    df = Counter(t for x in texts for t in set(x.lower().split()))
    raw = {t: math.log(len(texts) - n + 0.5) - math.log(n + 0.5) for t, n in df.items()}
    mean = sum(raw.values()) / len(raw)
    return {t: 0.25 * mean if v < 0 else v for t, v in raw.items()}


@pytest.mark.parametrize("key", ["id", "name"])
def test_vocabulary_order_is_count_then_first_seen(words, key):
    named = words.withColumn("name", F.format_string("%05d", "id"))
    got = corpus.vocabulary_topk(named, key, 3).orderBy("idx").collect()
    assert [(r.token, r.n) for r in got] == python_vocabulary(TEXTS, 3)
    built = corpus.build_vocabulary(named, key, 3, pad=False).orderBy("idx").collect()
    assert [(r.token, r.n) for r in built] == python_vocabulary(TEXTS, 3)


def test_vocabulary_of_all_documents(spark, data):
    documents = spark.read.parquet(f"{data}/documents.parquet")
    texts = [r.text for r in documents.orderBy("doc_id").select("text").collect()]
    got = corpus.build_vocabulary(corpus.with_tokens(documents), "doc_id", 256).orderBy("idx").collect()
    assert [(r.token, r.n) for r in got] == python_vocabulary(texts, 256)
    idf = python_idf(texts)
    assert all(math.isclose(r.idf, idf[r.token], rel_tol=1e-9, abs_tol=1e-9) for r in got)


def test_padding_and_empty_corpus(spark, words):
    got = corpus.vocabulary_topk(words, "id", 6, pad=True).orderBy("idx").collect()
    assert [r.token for r in got][-2:] == ["", ""] and len(got) == 6
    empty = corpus.build_vocabulary(words.where("id < 0"), "id", 4)
    assert [(r.idx, r.token, r.n, r.idf) for r in empty.orderBy("idx").collect()] == [(n, "", 0, 0.0) for n in range(4)]
    with pytest.raises(ValueError):
        corpus.vocabulary_topk(words, "id", 0)


def test_idf_of_common_tokens_is_a_share_of_the_mean(words):
    got = {r.token: r.idf for r in corpus.corpus_idf(words).collect()}
    want = python_idf(TEXTS)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[t], want[t], abs_tol=1e-12) for t in want)


def test_sparse_weights_ignore_frequency_and_keep_empty_documents(words):
    entries = [("a", 2.0), ("c", 3.0), ("", 0.0), ("", 0.0)]
    got = {r.id: r.text_sparse for r in corpus.sparse_vector(words, entries).collect()}
    assert got == {0: [2, 3, 0, 0], 1: [2, 0, 0, 0], 2: [2, 3, 0, 0], 3: [2, 0, 0, 0], 4: [0, 0, 0, 0]}


def test_query_weights(spark):
    entries = [("a", 2.0), ("c", 3.0), ("", 0.0)]
    asked = spark.createDataFrame([(1, "A a x", ["C"])], "qid int, text string, keywords array<string>")

    def vector(vocab, **options):
        return corpus.sparse_query_vector(asked, vocab, **options).first().text_sparse

    assert vector(entries) == [1, 0, 0]
    assert vector(entries, weights="idf") == [2, 0, 0]
    assert vector(entries, weights="idf", keywords="keywords") == [0, 3, 0]
    assert vector(None, cap=4) == [0, 0, 0, 0]
    with pytest.raises(ValueError):
        vector(entries, weights="tfidf")


def test_hash_embedding_is_a_unit_vector_or_zero(spark):
    df = spark.createDataFrame([(1, "x y x"), (2, ""), (3, None)], "id int, text string")
    got = {r.id: r.text_dense for r in embed_text(df, dim=32).collect()}
    assert math.isclose(sum(x * x for x in got[1]), 1, rel_tol=1e-6)
    assert got[2] == [0.0] * 32 and got[3] == [0.0] * 32
    assert len([x for x in got[1] if x]) <= 2


def test_model_hook_gets_whole_batches(spark):
    def load():
        def encode(texts):
            return [[float(len(t)), float(len(texts) > 0)] for t in texts]

        return encode

    df = spark.createDataFrame([("abc",), ("",)], "text string")
    got = {r.text: r.text_dense for r in embed_text(df, embedder=load).collect()}
    assert got == {"abc": [3.0, 1.0], "": [0.0, 1.0]}


def test_vocabulary_of_any_size(spark):
    from loomdex.operators import corpus

    df = spark.range(1000).selectExpr("id", "transform(sequence(0, 119), x -> concat('t', id * 100 + x)) as tokens")
    vocab = corpus.build_vocabulary(df, "id", 100_000, pad=False)
    entries = corpus.vocabulary_entries(vocab)
    assert len(entries) == 100_000 and entries[0][0] == "t100"
    held = corpus.sparse_vector(df.where("id < 3"), entries).selectExpr("size(text_sparse) as n").collect()
    assert {r.n for r in held} == {100_000}


def test_vocabulary_of_text_keys_sorts_no_tokens_of_documents(spark):
    from loomdex.operators import corpus

    df = spark.createDataFrame([("b", ["x", "y", "y"]), ("a", ["z", "x"]), (None, None)], "id string, tokens array<string>")
    got = corpus.build_vocabulary(df, "id", 2, pad=False).orderBy("idx").collect()
    assert [(r.token, r.n) for r in got] == [("x", 2), ("y", 2)]
    ties = corpus.vocabulary_topk(df, "id", 3).orderBy("idx").collect()
    assert [r.token for r in ties] == ["x", "y", "z"]
