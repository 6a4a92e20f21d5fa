"""Registered queries over vectors, rankings, collections and whole searches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.catalog import inputs as i
from loomdex.catalog import sqltext as q
from loomdex.catalog.registry import query
from loomdex.catalog.tables import MOTIONS
from loomdex.functions import vectors as v
from loomdex.functions.embedding import embed_text
from loomdex.operators import corpus, postings, relational, retrieval
from loomdex.plans import jobs
from loomdex.session import scratch_path, written
from loomdex.sources.collections import Collections

# The vector table has 64 dimensions, so its prefixes are shorter than those of text embeddings.
PREFIXES = (16, 32, 48)
LIMITS = (200, 100, 50)
DIM = 1024

# One query vector per label: the mean of its vectors, so queries come from the whole table.
CENTROIDS = """cells as (select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as pos from embeddings),
 qvec as (select id, list(x order by pos) as v from (select label as id, pos, avg(x) as x from cells group by 1, 2) group by id),
 vec as (select vec_id as id, embedding::double[] as v from embeddings)"""
CASCADE = ",\n ".join(
    [q.prefix_ctes(PREFIXES, ()), q.cascade_ctes(PREFIXES, LIMITS)]
)
DENSE = q.branch_cte("dense", q.cosine("p.v", "q.v"), "vec p cross join qvec q", 10)
HITS = "select qid, id, round(score, 6) as score, rank from "


def points(spark, folder):
    return i.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("text_dense"), "label"
    )


def centroids(spark, folder):
    cells = i.table(spark, folder, "embeddings").select(
        "label", F.posexplode("embedding").alias("pos", "x")
    )
    means = cells.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"])
    return means.groupBy(F.col("label").alias("qid")).agg(ordered.alias("text_dense"))


def shown(hits, *extra):
    return hits.select("qid", "id", F.round("score", 6).alias("score"), "rank", *extra)


# Vector functions -------------------------------------------------------------------------

@query(
    "vector_prefix",
    "select vec_id, unnest(embedding[1:16])::double as x, generate_subscripts(embedding[1:16], 1) - 1 as pos from embeddings",
)
def vector_prefix(spark, folder):
    cut = i.table(spark, folder, "embeddings").select(
        "vec_id", F.posexplode(v.vector_prefix("embedding", 16)).alias("pos", "x")
    )
    return cut.select("vec_id", F.col("x").cast("double").alias("x"), F.col("pos").cast("bigint").alias("pos"))


def _to_own_centroid(name, column, sql):
    """A query that compares every vector with the mean vector of its label."""

    @query(
        name,
        f"""with {CENTROIDS} select e.vec_id, round({sql}, 6) as value
 from embeddings e join qvec q on q.id = e.label join vec p on p.id = e.vec_id""",
    )
    def run(spark, folder):
        means = centroids(spark, folder).withColumnRenamed("text_dense", "mean")
        rows = points(spark, folder).join(means, F.col("label") == F.col("qid"))
        return rows.select(
            F.col("id").alias("vec_id"), F.round(column("text_dense", "mean"), 6).alias("value")
        )

    return run


_to_own_centroid("cosine_similarity", v.cosine_similarity, q.cosine("p.v", "q.v"))
_to_own_centroid("dot_product", v.dot_product, "list_dot_product(p.v, q.v)")


@query(
    "int8_quantize",
    """with r as (select min(list_min(embedding))::double as lo, max(list_max(embedding))::double as hi from embeddings),
 c as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as pos from embeddings)
 select vec_id, pos, floor((x - lo) / (hi - lo) * 127 + 0.5)::bigint as code,
 round(lo + floor((x - lo) / (hi - lo) * 127 + 0.5) / 127 * (hi - lo), 6) as decoded from c, r""",
)
def int8_quantize(spark, folder):
    coded = retrieval.int8_quantize(i.table(spark, folder, "embeddings"), "embedding")
    cells = coded.select("vec_id", F.posexplode(F.arrays_zip("codes", "codes_decoded")).alias("pos", "c"))
    return cells.select(
        "vec_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("c.codes").cast("bigint").alias("code"),
        F.round("c.codes_decoded", 6).alias("decoded"),
    )


@query(
    "embed_text",
    f"""with src as (select doc_id as id, text from documents), {q.dense_ctes('src', '', DIM)}
 select id as doc_id, pos - 1 as pos, round(x, 6) as x
 from (select id, unnest(v) as x, generate_subscripts(v, 1) as pos from vec) where x <> 0""",
)
def embed(spark, folder):
    """The elements that are not zero, by position."""
    vectors = embed_text(i.table(spark, folder, "documents").select("doc_id", "text"))
    cells = vectors.select("doc_id", F.posexplode("text_dense").alias("pos", "x")).where("x <> 0")
    return cells.select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("x")
    )


# Rankings over the vector table -----------------------------------------------------------

@query("dense_topk", f"with {CENTROIDS}, {DENSE} {HITS} dense")
def dense_topk(spark, folder):
    return shown(retrieval.dense_topk(points(spark, folder), centroids(spark, folder), 10))


@query("query_document_cross", f"with {CENTROIDS}, {DENSE} {HITS} dense")
def query_document_cross(spark, folder):
    """The path for queries that are too many for one block: they are written once and sent block by block."""
    found = retrieval.dense_topk(points(spark, folder), centroids(spark, folder), 10, max_queries=4)
    return shown(found)


@query("matryoshka_cascade", f"with {CENTROIDS}, {CASCADE} {HITS} cascade")
def matryoshka_cascade(spark, folder):
    found = retrieval.matryoshka_cascade(
        points(spark, folder), centroids(spark, folder), PREFIXES, LIMITS
    )
    return shown(found)


@query(
    "coded_cascade",
    f"with {CENTROIDS}, {q.prefix_ctes(PREFIXES, PREFIXES[:2])},\n {q.cascade_ctes(PREFIXES, LIMITS)} {HITS} cascade",
)
def coded_cascade(spark, folder):
    """The first two stages read 8-bit codes that were stored once."""
    rows = points(spark, folder)
    bounds = retrieval.bounds_dict(retrieval.int8_bounds(rows, PREFIXES[:2]))
    codes = written(rows.select("id", retrieval.code_column("text_dense", bounds).alias("codes")), "codes")
    return shown(retrieval.coded_cascade(codes, rows, centroids(spark, folder), PREFIXES, LIMITS, bounds))


@query("candidate_semi_join", f"with {CENTROIDS}, {CASCADE} {HITS} c2")
def candidate_semi_join(spark, folder):
    """First stage by scan, second stage on its stored candidates only."""
    rows, asked = points(spark, folder), centroids(spark, folder)
    first = retrieval.dense_topk(rows, asked, LIMITS[0], prefix=PREFIXES[0])
    return shown(retrieval.rerank_candidates(rows, asked, first, LIMITS[1], PREFIXES[1]))


@query(
    "branch_union",
    f"""with {CENTROIDS}, {CASCADE}, {DENSE}
 {HITS} (select * from cascade union all select * from dense)""",
)
def branch_union(spark, folder):
    rows, asked = points(spark, folder), centroids(spark, folder)
    cascade = retrieval.matryoshka_cascade(rows, asked, PREFIXES, LIMITS)
    dense = retrieval.dense_topk(rows, asked, 10)
    return shown(retrieval.branch_union([cascade, dense]))


@query(
    "rrf_fusion",
    f"with {CENTROIDS}, {CASCADE}, {DENSE}, {q.fusion_ctes(['cascade', 'dense'], 5)} {HITS} hits",
)
def rrf_fusion(spark, folder):
    rows, asked = points(spark, folder), centroids(spark, folder)
    cascade = retrieval.matryoshka_cascade(rows, asked, PREFIXES, LIMITS)
    dense = retrieval.dense_topk(rows, asked, 10)
    return shown(retrieval.rrf_fusion([cascade, dense]))


@query(
    "payload_attach",
    f"""with {CENTROIDS}, {DENSE} select qid, d.id, round(score, 6) as score, rank, label
 from dense d join embeddings e on e.vec_id = d.id""",
)
def payload_attach(spark, folder):
    rows, asked = points(spark, folder), centroids(spark, folder)
    stored = rows.select("id", "text_dense", F.struct("label").alias("payload"))
    found = retrieval.payload_attach(retrieval.dense_topk(rows, asked, 10), stored)
    return shown(found, F.col("payload.label").alias("label"))


# Searches over texts ----------------------------------------------------------------------

ASKED = "asked as (select item_id as id, text from benchmark)"
CORPUS = "corpus as (select doc_id as id, doc_id as ord, text from documents)"


def texts(spark, folder):
    return corpus.with_tokens(
        i.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    )


def asked(spark, folder):
    return i.table(spark, folder, "benchmark").select(F.col("item_id").alias("qid"), "text")


def text_points(words, entries, dim=DIM):
    return embed_text(corpus.sparse_vector(words, entries), "text", "text_dense", dim, tokens="tokens").select(
        "id", "text_dense", "text_sparse", F.struct("text", "source").alias("payload")
    )


def _sparse_query(name, include_zero, where):
    @query(
        name,
        f"""with {CORPUS}, {ASKED}, {q.vocabulary_ctes(256, True)},
 {q.sparse_ctes('corpus', '', 'v.idf')}, {q.sparse_ctes('asked', 'q', '1.0')},
 {q.branch_cte('sparse', 'round(list_dot_product(p.w, q.w), 9)', 'sp p cross join qsp q', 10, where)}
 {HITS} sparse""",
    )
    def run(spark, folder):
        words = texts(spark, folder)
        entries = corpus.vocabulary_entries(corpus.build_vocabulary(words, "id"))
        index = postings.build_postings(corpus.sparse_vector(words, entries, dense=False))
        wanted = corpus.sparse_query_vector(asked(spark, folder), entries, dense=False)
        return shown(postings.sparse_topk_postings(index, wanted, 10, include_zero))

    return run


_sparse_query("sparse_topk", True, "")
_sparse_query("sparse_topk_matching", False, "where score <> 0")


WIDE = 100_000  # entries: more than the corpus has words at these sizes


@query(
    "sparse_topk_wide",
    f"""with {CORPUS}, {ASKED}, {q.vocabulary_ctes(WIDE, False)},
 phas as (select distinct id, token from toks),
 qhas as (select distinct id, unnest({q.tokens('text')}) as token from asked),
 scored as (select a.id as qid, p.id, round(sum(v.idf), 9) as score from qhas a join vocab v using (token) join phas p using (token) group by 1, 2)
 select qid, id, round(score, 6) as score, rank from (select *, row_number() over (partition by qid order by score desc, id) as rank
 from scored where score <> 0) where rank <= 10""",
)
def sparse_topk_wide(spark, folder):
    """Keyword search over a vocabulary that is too wide for arrays."""
    words = texts(spark, folder)
    entries = corpus.vocabulary_entries(corpus.build_vocabulary(words, "id", WIDE, pad=False))
    index = postings.build_postings(corpus.sparse_vector(words, entries, dense=False))
    wanted = corpus.sparse_query_vector(asked(spark, folder), entries, dense=False)
    return shown(postings.sparse_topk_postings(index, wanted, 10, include_zero=False))


@query(
    "point_rows",
    f"""with {CORPUS}, {q.vocabulary_ctes(256, True)}, {q.dense_ctes('corpus', '', DIM)}, {q.sparse_ctes('corpus', '', 'v.idf')}
 select d.id, round(list_sum(d.v), 5) as dense, round(list_sum(d.v[1:64]), 5) as m64,
 round(list_sum(d.v[1:128]), 5) as m128, round(list_sum(d.v[1:256]), 5) as m256,
 round(list_sum(s.w), 5) as sparse, source
 from vec d join sp s using (id) join documents o on o.doc_id = d.id""",
)
def point_rows(spark, folder):
    words = texts(spark, folder)
    entries = corpus.vocabulary_entries(corpus.build_vocabulary(words, "id"))
    rows = embed_text(corpus.sparse_vector(words, entries))

    def total(c):
        summed = F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double"))
        return F.round(summed, 5)

    return jobs.point_rows(rows, ["source"]).select(
        "id",
        total("text_dense").alias("dense"),
        *[total(f"m{n}").alias(f"m{n}") for n in (64, 128, 256)],
        total("text_sparse").alias("sparse"),
        F.col("payload.source").alias("source"),
    )


@query(
    "hybrid_search",
    f"""with {CORPUS}, {ASKED}, {q.hybrid_ctes(5)}
 select qid, rank, h.id, round(score, 6) as score, source, md5(text) as digest
 from hits h join documents d on d.doc_id = h.id""",
)
def hybrid_search(spark, folder):
    words = texts(spark, folder)
    entries = corpus.vocabulary_entries(corpus.build_vocabulary(words, "id"))
    # written once: value ranges, scan and payloads each read the points
    rows = written(text_points(words, entries), "points")
    found = retrieval.hybrid_search(rows, jobs.query_vectors(asked(spark, folder), entries))
    return found.select(
        "qid", "rank", "id", F.round("score", 6).alias("score"),
        F.col("payload.source").alias("source"), F.md5("payload.text").alias("digest"),
    )


@query(
    "demo_search",
    f"""with {CORPUS}, asked as (select item_id as id, text, string_split(text, ' ') as words from benchmark),
 {q.hybrid_ctes(10, cap=635, pad=False, limits=(100, 50, 10), quantised=(), oversample=1, query_weight='v.idf',
                query_tokens='list_transform(words, lambda w: lower(w))')}
 select qid, rank, h.id, round(score, 6) as score, substr(text, 1, 100) as preview
 from hits h join documents d on d.doc_id = h.id""",
)
def demo_search(spark, folder):
    """Keywords are the words of each query; its whole text feeds the dense branches."""
    wanted = asked(spark, folder).withColumn("keywords", F.split("text", " "))
    documents = i.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    found = jobs.demo_search(documents, wanted)
    return found.select(
        "qid", "rank", "id", F.round("score", 6).alias("score"),
        F.substring("payload.text", 1, 100).alias("preview"),
    )


# Collections ------------------------------------------------------------------------------

def _vector_store(spark):
    return Collections(spark, scratch_path(spark, "collections"))


LABEL_PAYLOAD = T.StructType([T.StructField("label", T.StringType())])


def _embedding_points(spark, folder, store, name):
    rows = points(spark, folder).select(
        F.col("id").alias("vec_id"), "text_dense", F.array(F.lit(0.0)).alias("text_sparse"),
        F.struct(F.col("label").cast("string").alias("label")).alias("payload"),
    )
    return store.with_ids(rows, name, "vec_id")


@query("create_collection", "select lang as collection, count(*) as n from documents group by lang")
def create_collection(spark, folder):
    """A new collection of all documents, counted by the language in their payload."""
    store = _vector_store(spark)
    payload = T.StructType([T.StructField("lang", T.StringType())])
    store.create("texts", 64, 1, prefixes=(64,), payload=payload, bucket_chars=1)
    rows = embed_text(i.table(spark, folder, "documents").select("doc_id", "text", "lang"), dim=64)
    rows = rows.withColumn("text_sparse", F.array(F.lit(0.0))).withColumn("payload", F.struct("lang"))
    store.upsert("texts", store.with_ids(rows, "texts", "doc_id"))
    stored = store.points("texts").groupBy(F.col("payload.lang").alias("collection"))
    return stored.agg(F.count(F.lit(1)).alias("n"))


@query(
    "upsert_points",
    """select 1 as run, count(*) as written, count(*) as stored from embeddings
 union all select 2, 0, count(*) from embeddings""",
)
def upsert_points(spark, folder):
    """A second run over the same rows adds nothing."""
    store = _vector_store(spark)
    store.create("vectors", 64, 1, PREFIXES, (), LABEL_PAYLOAD, bucket_chars=1)
    out = []
    for run in (1, 2):
        written = store.upsert("vectors", _embedding_points(spark, folder, store, "vectors"))
        out.append((run, written, store.points("vectors").count()))
    return spark.createDataFrame(out, "run bigint, written bigint, stored bigint")


@query(
    "read_collection",
    """select e.label::varchar as label, e.size, e.m16, round(sum(e.x), 5) as total, count(*) as n from
 (select label, len(embedding) as size, len(embedding[1:16]) as m16, list_sum(embedding::double[]) as x from embeddings) e
 group by 1, 2, 3""",
)
def read_collection(spark, folder):
    store = _vector_store(spark)
    store.create("vectors", 64, 1, PREFIXES, (), LABEL_PAYLOAD, bucket_chars=1)
    store.upsert("vectors", _embedding_points(spark, folder, store, "vectors"))
    size = store.vector_size("vectors", "text_dense")
    rows = store.read("vectors")
    total = F.aggregate("text_dense", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return (
        rows.select(
            F.col("payload.label").alias("label"),
            F.lit(size).cast("bigint").alias("size"),
            F.size("m16").cast("bigint").alias("m16"),
            total.alias("x"),
        )
        .groupBy("label", "size", "m16")
        .agg(F.round(F.sum("x"), 5).alias("total"), F.count(F.lit(1)).alias("n"))
    )


# Index and search as jobs -----------------------------------------------------------------

STORED = """all_docs as (select m.*, d.text as raw from (select distinct * from ({motions})) m
   join documents d on cast(d.doc_id as varchar) = m.dokument_uid),
 corpus as (select dokument_uid as id, dokument_uid as ord, {clean} as text from all_docs where {clean} <> ''),
 stored as (select c.*, m.geschaeft_uid, m.dokument_ziel_publikation as target, m.geschaeft_titel_deutsch as tde,
   m.geschaeft_titel_franz as tfr, m.geschaeft_beschluss_deutsch as bde, m.geschaeft_beschluss_franz as bfr, m.dokument_url as url
   from corpus c join all_docs m on m.dokument_uid = c.id where m.dokument_ziel_publikation is not null)""".format(
    motions=MOTIONS, clean=q.basic("raw")
)
FIELDS = """case when contains(target, 'Deutsch') then tde when target = 'Französisch' then tfr end as title,
 case when contains(target, 'Deutsch') then bde when target = 'Französisch' then bfr end as beschluss"""


def _built(spark, folder):
    store = Collections(spark, scratch_path(spark, "index"))
    jobs.build_index(
        store, "motions", i.docs(spark, folder), i.items(spark, folder),
        i.doc_content(spark, folder), extractor="text", bucket_chars=1,
    )
    return store


INDEXED = f"""with {STORED}, {q.vocabulary_ctes(256, True)}, {q.sparse_ctes('stored', '', 'v.idf')}
 select s.id as dokument_uid, geschaeft_uid, {FIELDS}, url, md5(text) as digest, round(list_sum(w), 5) as weight
 from stored s join sp on sp.id = s.id"""


def _stored(store):
    weight = F.aggregate("text_sparse", F.lit(0.0), lambda a, x: a + x)
    return store.read("motions").select(
        "payload.dokument_uid", "payload.geschaeft_uid", "payload.title", "payload.beschluss",
        "payload.url", F.md5("payload.text").alias("digest"), F.round(weight, 5).alias("weight"),
    )


@query("build_index", INDEXED)
def build_index(spark, folder):
    return _stored(_built(spark, folder))


@query("append_index", INDEXED)
def append_index(spark, folder):
    """Built from half of the documents, then from all, the index is as if built once."""
    store = Collections(spark, scratch_path(spark, "index"))
    docs, items, content = i.docs(spark, folder), i.items(spark, folder), i.doc_content(spark, folder)
    for part in (docs.where("cast(dokument_uid as bigint) % 2 = 0"), docs):
        jobs.build_index(store, "motions", part, items, content, extractor="text", bucket_chars=1)
    return _stored(store)


# Ids of stored points are digests of collection, item and document.
SEARCHED = f"""with {STORED}, {ASKED},
 keyed as (select *, sha256('motions' || chr(31) || coalesce(geschaeft_uid, '') || chr(31) || id) as pid from stored),
 pts as (select pid as id, text from keyed),
 {q.hybrid_ctes(5, points='pts')}
 select qid, rank, round(score, 6) as score, k.id as dokument_uid, k.url, {FIELDS} from hits h join keyed k on k.pid = h.id"""


@query("search_similar", SEARCHED)
def search_similar(spark, folder):
    found = jobs.search_similar(_built(spark, folder), "motions", asked(spark, folder))
    return found.select(
        "qid", "rank", F.round("score", 6).alias("score"),
        "payload.dokument_uid", "payload.url", "payload.title", "payload.beschluss",
    )


@query(
    "search_result_rows",
    SEARCHED.replace("k.id as dokument_uid, k.url,", "k.url,"),
)
def search_result_rows(spark, folder):
    found = jobs.search_similar(_built(spark, folder), "motions", asked(spark, folder))
    return relational.search_result_rows(found).withColumn("score", F.round("score", 6))
