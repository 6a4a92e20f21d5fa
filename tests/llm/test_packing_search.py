import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import empty, strange
from tokenizers import Tokenizer

from loomdex.llm import multi_index, packing, queries
from loomdex.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenizer():
    out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out.encode_special_tokens = True
    return out


def test_ids_equal_the_other_library():
    r = random.Random(1)
    texts = ["".join(chr(r.choice([r.randint(9, 126), r.randint(160, 0x2FFF), r.randint(0x1F300, 0x1F6FF)])) for _ in range(60)) for _ in range(300)]
    texts += ["", " ", "\n\n  x", "<|endoftext|> a", "It's we'll I'd", "a" * 5000]
    encode = packing.encoder(RANKS).encode_ordinary
    assert [encode(t) for t in texts] == [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]


def test_name_of_the_end_token_in_a_text_is_that_token(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", " <|endoftext|", "<|endoftext|> <|ENDOFTEXT|>", "it's<|endoftext|>'s"]
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode_batch(texts, add_special_tokens=False)
    assert want[0].ids == [64, 220, 50256, 275]
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), RANKS, with_ids=True).collect()
    assert {r.doc_id: r.ids for r in got} == {i: [*w.ids, 2] for i, w in enumerate(want)}


@pytest.mark.parametrize("capacity", [16, 100])
def test_plan_places_all_and_is_close_to_the_bound(capacity):
    r = random.Random(capacity)
    for _ in range(40):
        counts = {r.randint(1, capacity): r.randint(1, 50) for _ in range(r.randint(1, capacity))}
        groups = packing.plan(counts, capacity)
        placed: dict = {}
        for n, lengths in groups:
            assert n > 0 and sum(lengths) <= capacity and sum(3 * x > capacity for x in lengths) <= 2
            for x in lengths:
                placed[x] = placed.get(x, 0) + n
        assert placed == counts
        half, third = (sum(n for x, n in counts.items() if d * x > capacity) for d in (2, 3))
        bound = max(half, -(-third // 2), -(-sum(x * n for x, n in counts.items()) // capacity))
        assert sum(n for n, _ in groups) <= 1.25 * bound + 1


def test_round_trip_of_whole_table(spark, data):
    docs = table(spark, data, "documents")
    rows = packing.pack(docs, RANKS, with_ids=True).collect()
    encode = tokenizer()
    by_doc: dict = {}
    for r in rows:
        assert len(r.ids) == r.length <= 1024 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        parts = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [p.start for p in parts] == np.cumsum([0, *(p.length for p in parts[:-1])]).tolist()
        assert all(p.length == 1024 for p in parts[1:])
        assert [i for p in parts for i in p.ids] == [*encode.encode(d.text, add_special_tokens=False).ids, 2]
    filled: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 1024 and len(filled) <= 1.02 * (sum(filled.values()) / 1024) + 2


def test_packing_of_strange_rows(spark):
    docs = strange(spark, "hello there")
    got = packing.pack(docs, RANKS).collect()
    assert sum(r.piece == 0 for r in got) == docs.count()
    assert sorted(r.length for r in got if r.doc_id in (2, 3)) == [1, 1]
    assert packing.pack(empty(spark), RANKS).count() == 0


def brute(ids, vectors, queries_, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in queries_:
        score = unit @ unit[q]
        order = sorted((-round(s, 12), ids[j]) for j, s in enumerate(score) if j != q)
        out[ids[q]] = [j for _, j in order[:k]]
    return out


def test_recall_of_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = table(spark, folder, "embeddings").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = brute(ids, vectors, [i for i, v in enumerate(ids) if v % 50 == 0], 5)
    got: dict = {}
    for r in queries.QUERIES["op5_inverted_multi_index"](spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_walk_at_each_size(spark, folder):
    vectors = table(spark, folder, "embeddings")
    rows = vectors.collect()
    ids = [r.vec_id for r in rows]
    want = brute(ids, np.array([r.embedding for r in rows], float), [i for i in ids if i % 50 == 0], 5)
    got: dict = {}
    for r in multi_index.search(vectors, vectors.where("vec_id % 50 = 0"), k=5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & set(want[q])) / 5 for q in want]) >= 0.9


def test_search_with_ties_odd_vectors_and_split_cells(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "PART", 3)
    monkeypatch.setattr(multi_index, "QUERIES", 1)
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [1.0, 0.0]), (9, [0.5, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [None, 1.0])]
    rows += [(None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (50, [0.0, 1.0]), (10, [float("inf"), 1.0])] + [(100 + i, [1.0, 0.1 * i + 0.1]) for i in range(20)]
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, cell int")
    got = multi_index.search(vectors, vectors.where("vec_id in (0, 50, 5)"), k=4)
    found = [(r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in got.orderBy("query_id", "rank").collect()]
    assert found[:4] == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 9, 1.0), (0, 4, 100, round(1 / 1.01**0.5, 6))]
    assert [f[2] for f in found[4:]] == [119, 118, 117, 116]
    assert multi_index.search(vectors.where("false"), vectors).count() == 0


def test_copies_of_a_query_do_not_fill_its_walk(spark):
    """Cells that hold the query's own rows only are not enough."""
    rng = np.random.default_rng(2)
    rows = [(0, [1.0, 0.0, 0.0, 0.0])] * 40 + [(i, [0.0, *map(float, rng.random(3) + 0.1)]) for i in range(1, 9)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = multi_index.search(vectors, vectors.where("vec_id = 0"), k=5).collect()
    assert len(got) == 5 and all(r.vec_id for r in got)


def test_walk_visits_cells_by_distance():
    rng = np.random.default_rng(8)
    first, second = rng.random(6), rng.random(5)
    counts = np.ones(30, np.int64)
    got = multi_index.walk(first, second, counts, 30)
    total = [first[c // 5] + second[c % 5] for c in got]
    assert sorted(got) == list(range(30)) and total == sorted(total)
    assert len(multi_index.walk(first, second, counts, 7)) == 7
