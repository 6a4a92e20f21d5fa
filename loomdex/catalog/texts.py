"""Registered queries over texts: cleaning, extraction, corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomdex.catalog import inputs as i
from loomdex.catalog import sqltext as q
from loomdex.catalog.registry import query
from loomdex.functions import text as t
from loomdex.operators import corpus, duplicates, extract, relational
from loomdex.plans import jobs
from loomdex.session import scratch_path
from loomdex.sources import sinks

MARKED, BOILERPLATE, CONTENT = i.oracle(i.MARKED), i.oracle(i.BOILERPLATE), i.oracle(i.CONTENT)
CAP = 256
CORPUS = "corpus as (select doc_id as id, doc_id as ord, text from documents)"
STATS = f"with {CORPUS}, {q.vocabulary_ctes(CAP, False)}"


def documents(spark, folder):
    return i.table(spark, folder, "documents").select("doc_id", "text")


def tokenized(spark, folder):
    return corpus.with_tokens(documents(spark, folder)).select("doc_id", "tokens")


def _text_query(name, expression, sql, source=None, template=None):
    """A query that applies one text expression to every document."""
    base = template or "select doc_id, text from {documents}"

    @query(name, f"select doc_id, {sql} as text from ({i.oracle(base)})")
    def run(spark, folder):
        return i.view(spark, folder, base).select("doc_id", expression(F.col("text")).alias("text"))

    return run


# Cleaning ---------------------------------------------------------------------------------

_text_query("clean_simple", t.clean_simple, q.basic("coalesce(text, '')"))
_text_query("clean_basic", t.clean_basic, q.basic("text"))
_text_query("clean_advanced", t.clean_advanced, q.advanced("text"), template=i.BOILERPLATE)
_text_query("remove_patterns", t.remove_patterns, q.removed("text"), template=i.BOILERPLATE)
_text_query("strip_special_chars", t.strip_special_chars, q.stripped("text"))
_text_query("punctuation_spacing", t.punctuation_spacing, q.spaced("text"))


@query("tokenize", f"select doc_id, array_to_string({q.tokens('text')}, ' ') as tokens from documents")
def tokenize(spark, folder):
    return tokenized(spark, folder).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query(
    "keyword_lower",
    "select item_id, array_to_string(list_transform(string_split(text, ' '), lambda w: lower(w)), '|') as keywords from benchmark",
)
def keyword_lower(spark, folder):
    words = i.table(spark, folder, "benchmark").select("item_id", F.split("text", " ").alias("k"))
    return words.select("item_id", F.array_join(t.keyword_lower("k"), "|").alias("keywords"))


@query(
    "section_after_marker",
    f"select doc_id, {q.section('text')} as text from ({MARKED}) where contains(text, 'Antrag Regierungsrat')",
)
def section_after_marker(spark, folder):
    return extract.section_job(i.view(spark, folder, i.MARKED), "doc_id")


@query(
    "section_counters",
    f"select count(*) as processed, count(*) filter (contains(text, 'Antrag Regierungsrat')) as cleaned from ({MARKED})",
)
def section_counters(spark, folder):
    return extract.section_counters(i.view(spark, folder, i.MARKED))


@query(
    "contains_marker",
    f"select doc_id, contains(text, 'Antrag Regierungsrat') as marked from ({MARKED})",
)
def contains_marker(spark, folder):
    return i.view(spark, folder, i.MARKED).select("doc_id", t.contains_marker("text").alias("marked"))


@query(
    "marker_coverage",
    f"select round(avg(case when contains(text, 'Antrag Regierungsrat') then 1.0 else 0.0 end) * 100, 6) as percent from ({MARKED})",
)
def marker_coverage(spark, folder):
    share = extract.marker_coverage(i.view(spark, folder, i.MARKED))
    return share.select(F.round("percent", 6).alias("percent"))


BLANKED = "select page_id as filename, case when page_id % 17 = 0 then ' ' || chr(10) else html end as text from {pages}"


@query(
    "clean_texts_job",
    f"""select filename, case when c <> '' then 'success' else 'failed' end as status, nullif(c, '') as text
 from (select filename, {q.advanced('text')} as c from ({i.oracle(BLANKED)}))""",
)
def clean_texts_job(spark, folder):
    return extract.clean_texts_job(i.view(spark, folder, BLANKED), cleaner="advanced")


@query(
    "nonblank_filter",
    f"select filename, text from ({i.oracle(BLANKED)}) where {q.basic('text')} <> ''",
)
def nonblank_filter(spark, folder):
    return relational.nonblank_filter(i.view(spark, folder, BLANKED))


@query(
    "cleaning_counters",
    f"select count(*) as processed, count(*) filter ({q.basic('text')} <> '') as cleaned from ({i.oracle(BLANKED)})",
)
def cleaning_counters(spark, folder):
    return extract.cleaning_counters(i.view(spark, folder, BLANKED))


# Extraction -------------------------------------------------------------------------------

EXTRACTED = f"""select cast(motion_id as varchar) as motion_id,
 case when html is null then 'failed' when {q.basic('x')} <> '' then 'success' else 'failed' end as status,
 case when html is not null and {q.basic('x')} <> '' then x end as text, url, html as content,
 case when html is null then 'Download failed' when {q.basic('x')} <> '' then null
      else 'Text extraction failed or text is empty' end as error_message
 from (select *, {q.html_text('html')} as x from ({CONTENT}))"""
RESULT = "motion_id, status, text, url, error_message"
# Every page comes a second time under a higher key, so that half of the texts are repeats.
TWICE = "select * from ({src}) union all select motion_id + 1000000000 as motion_id, url, html from ({src})"
TWICE_SQL = TWICE.replace("{src}", CONTENT)
DEDUPED = f"""select {RESULT.replace('status', "case when status = 'success' and r > 1 then 'duplicate' else status end as status")}, content
 from (select *, row_number() over (partition by status = 'success', {q.basic("coalesce(text, '')")} order by motion_id) as r
 from ({EXTRACTED.replace(CONTENT, TWICE_SQL)}))"""


def content_twice(spark, folder):
    once = i.content(spark, folder)
    return once.unionAll(once.withColumn("motion_id", F.col("motion_id") + 1_000_000_000))


def deduped(spark, folder):
    return jobs.extract_dedup_job(content_twice(spark, folder))


@query("extract_text_job", f"select {RESULT} from ({EXTRACTED})")
def extract_text_job(spark, folder):
    return extract.extract_text_job(i.content(spark, folder)).drop("content")


@query("success_filter", f"select motion_id, text from ({EXTRACTED}) where status = 'success' and length(text) > 0")
def success_filter(spark, folder):
    results = extract.extract_text_job(i.content(spark, folder))
    return relational.success_filter(results).select("motion_id", "text")


@query("extract_dedup_job", f"select {RESULT} from ({DEDUPED})")
def extract_dedup_job(spark, folder):
    return deduped(spark, folder).drop("content")


# Several documents belong to one motion.
SHARED_SQL = CONTENT.replace("select page_id as motion_id", "select page_id % 40 as motion_id")
SHARED = f"""select {RESULT.replace('status', "case when status = 'success' and r > 1 then 'duplicate' else status end as status")}
 from (select *, row_number() over (partition by status = 'success', {q.basic("coalesce(text, '')")} order by cast(motion_id as bigint), url) as r
 from ({EXTRACTED.replace(CONTENT, TWICE.replace("motion_id + 1000000000 as motion_id, url", "motion_id, url || '#again' as url").replace("{src}", SHARED_SQL))}))"""


@query("extract_dedup_shared", SHARED)
def extract_dedup_shared(spark, folder):
    """Documents of shared motions, each landed under two addresses.

    Pages of one motion may have the same address and text, so the page tells them apart, and a number the copies of a
    page; it is fixed as the rows are written. Motions come by number.
    """
    motion = F.col("motion_id") % 40
    once = i.content(spark, folder).withColumns({"page": F.col("motion_id"), "motion": motion, "motion_id": motion})
    twice = once.unionAll(once.withColumn("url", F.concat("url", F.lit("#again"))))
    numbered = twice.withColumn("copy", F.monotonically_increasing_id())
    found = jobs.extract_dedup_job(numbered, row_key=["motion", "url", "page", "copy"])
    return found.drop("content", "motion", "page", "copy")


@query("status_summary", f"select status, count(*) as n from ({DEDUPED}) group by status")
def status_summary(spark, folder):
    return duplicates.status_summary(deduped(spark, folder))


@query(
    "dedup_clean_text",
    f"""select doc_id, case when row_number() over (partition by {q.basic('text')} order by doc_id) > 1
 then 'duplicate' else 'success' end as status, text from documents""",
)
def dedup_clean_text(spark, folder):
    marked = documents(spark, folder).withColumn("status", F.lit("success"))
    return duplicates.dedup_clean_text(marked, "doc_id").select("doc_id", "status", "text")


AREA = "case status when 'success' then 'extracted' else 'duplicates' end as area"
KEPT = f"select *, {AREA} from ({DEDUPED}) where status in ('success', 'duplicate')"


@query("write_text_by_key", f"select motion_id, text, area from ({KEPT})")
def write_text_by_key(spark, folder):
    path = scratch_path(spark, "texts-by-status")
    sinks.write_text_by_key(deduped(spark, folder), path)
    return spark.read.parquet(path)


@query("write_binary_by_key", f"select motion_id, md5(content) as digest, area from ({KEPT})")
def write_binary_by_key(spark, folder):
    path = scratch_path(spark, "bytes-by-status")
    sinks.write_binary_by_key(deduped(spark, folder), path)
    return spark.read.parquet(path).select("motion_id", F.md5("content").alias("digest"), "area")


@query(
    "assemble_pages",
    "select conv_id as doc, string_agg(text, chr(10) order by turn) || chr(10) as text from conversations group by 1",
)
def assemble_pages(spark, folder):
    pages = i.table(spark, folder, "conversations").select(
        F.col("conv_id").alias("doc"), F.col("turn").alias("page_no"), "text"
    )
    return extract.assemble_pages(pages)


# Corpus statistics ------------------------------------------------------------------------

@query("token_counts", f"{STATS} select token, n from firsts")
def token_counts(spark, folder):
    return corpus.token_counts(tokenized(spark, folder))


@query("document_frequency", f"{STATS} select token, df from firsts")
def document_frequency(spark, folder):
    return corpus.document_frequency(tokenized(spark, folder))


@query("vocabulary_topk", f"{STATS} select idx, token, n from ranked")
def vocabulary_topk(spark, folder):
    return corpus.vocabulary_topk(tokenized(spark, folder), "doc_id", CAP)


PADDED = 8192


@query(
    "vocabulary_padding",
    f"""with corpus as (select item_id as id, item_id as ord, text from benchmark), {q.vocabulary_ctes(PADDED, True)}
 select idx, token, n from vocab""",
)
def vocabulary_padding(spark, folder):
    texts = corpus.with_tokens(i.table(spark, folder, "benchmark"))
    return corpus.vocabulary_topk(texts, "item_id", PADDED, pad=True)


@query(
    "bm25_idf",
    f"""with counts as materialized (select token, count(*) as df from
  (select unnest(list_distinct({q.tokens('text')})) as token from documents) group by 1),
 raws as materialized (select token, df, ln((select count(*) from documents) - df + 0.5) - ln(df + 0.5) as raw from counts)
 select token, df, round(case when raw < 0 then 0.25 * (select avg(raw) from raws) else raw end, 6) as idf from raws""",
)
def bm25_idf(spark, folder):
    weights = corpus.corpus_idf(tokenized(spark, folder))
    return weights.select("token", "df", F.round("idf", 6).alias("idf"))


@query("build_vocabulary", f"{STATS} select idx, token, n, round(idf, 6) as idf from vocab")
def build_vocabulary(spark, folder):
    vocab = corpus.build_vocabulary(tokenized(spark, folder), "doc_id", CAP, pad=False)
    return vocab.select("idx", "token", "n", F.round("idf", 6).alias("idf"))


@query(
    "vocab_membership_join",
    f"""{STATS} select distinct t.id as doc_id, v.idx, round(v.idf, 6) as weight
 from toks t join vocab v on t.token = v.token""",
)
def vocab_membership_join(spark, folder):
    words = tokenized(spark, folder)
    vocab = corpus.build_vocabulary(words, "doc_id", CAP)
    postings = corpus.vocab_membership_join(words, vocab, "doc_id")
    return postings.select("doc_id", "idx", F.round("weight", 6).alias("weight"))


def asked(spark, folder):
    return i.table(spark, folder, "benchmark").select(F.col("item_id").alias("qid"), "text")


@query(
    "query_vocab_join",
    f"""{STATS} select distinct b.item_id as qid, v.idx, round(v.idf, 6) as weight
 from (select item_id, unnest({q.tokens('text')}) as token from benchmark) b join vocab v on b.token = v.token""",
)
def query_vocab_join(spark, folder):
    vocab = corpus.build_vocabulary(tokenized(spark, folder), "doc_id", CAP)
    hits = corpus.query_vocab_join(corpus.with_tokens(asked(spark, folder)), vocab, "idf")
    return hits.select("qid", "idx", F.round("weight", 6).alias("weight"))


@query(
    "sparse_vector",
    f"""{STATS}, {q.sparse_ctes('corpus', '', 'v.idf')}
 select id as doc_id, unnest(w) as weight, generate_subscripts(w, 1) - 1 as idx from sp""".replace(
        "unnest(w) as weight", "round(unnest(w), 6) as weight"
    ),
)
def sparse_vector(spark, folder):
    words = tokenized(spark, folder)
    vectors = corpus.sparse_vector(words, corpus.build_vocabulary(words, "doc_id", CAP))
    cells = vectors.select("doc_id", F.posexplode("text_sparse").alias("idx", "weight"))
    return cells.select("doc_id", F.round("weight", 6).alias("weight"), F.col("idx").cast("bigint").alias("idx"))


@query(
    "sparse_vector_pairs",
    f"""{STATS}, has as (select distinct id, token from toks)
 select h.id as doc_id, v.idx, round(v.idf, 6) as weight from has h join vocab v using (token)""",
)
def sparse_vector_pairs(spark, folder):
    """The same weights as pairs of index and value, without the zeros of absent tokens."""
    words = tokenized(spark, folder)
    vectors = corpus.sparse_vector(words, corpus.build_vocabulary(words, "doc_id", CAP), dense=False)
    cells = vectors.select("doc_id", F.inline(F.arrays_zip("text_sparse.indices", "text_sparse.values")).alias("idx", "weight"))
    return cells.select("doc_id", F.round("weight", 6).alias("weight"), F.col("idx").cast("bigint").alias("idx"))


@query(
    "sparse_query_vector",
    f"""{STATS}, asked as (select item_id as id, text from benchmark), {q.sparse_ctes('asked', 'q', '1.0::double')}
 select id as qid, unnest(w) as weight, generate_subscripts(w, 1) - 1 as idx from qsp""",
)
def sparse_query_vector(spark, folder):
    vocab = corpus.build_vocabulary(tokenized(spark, folder), "doc_id", CAP)
    vectors = corpus.sparse_query_vector(asked(spark, folder), vocab)
    cells = vectors.select("qid", F.posexplode("text_sparse").alias("idx", "weight"))
    return cells.select("qid", "weight", F.col("idx").cast("bigint").alias("idx"))
