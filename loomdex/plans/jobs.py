"""Jobs a user calls: prepare, extract, build an index and search it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.functions.embedding import DENSE_SIZE, embed_text, unpack_vector
from loomdex.functions.text import get_cleaner, tokenize
from loomdex.functions.vectors import vector_prefix
from loomdex.operators.corpus import (
    build_vocabulary,
    sparse_query_vector,
    sparse_vector,
    vocabulary_entries,
    vocabulary_of,
    with_tokens,
)
from loomdex.operators.duplicates import dedup_clean_text, dedup_rows
from loomdex.operators.extract import STATUS_SUCCESS, extract_text_job
from loomdex.operators.relational import (
    DOC_TYPES,
    ITEM_TYPE,
    localized_fields,
    merge_documents,
    sample_head,
)
from loomdex.operators.retrieval import (
    PRESETS,
    Preset,
    coded_cascade,
    get_preset,
    hybrid_search,
    payload_attach,
)
from loomdex.operators.skew import salted_join
from loomdex.operators.statistics import merged_states, token_state
from loomdex.session import remove_path, scratch_path, written
from loomdex.sources.collections import PAYLOAD_FIELDS, Collections

MOTION_ORDER = ("geschaeft_uid", "dokument_uid")


def prepare_motions(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Motion documents joined with their business item, without repeated rows.

    Both sides are filtered before the join, so the join and its hot-key check see motions only.
    """
    wanted_docs = docs.where(F.col("dokument_typ_deutsch").isin(*DOC_TYPES))
    wanted_items = items.where(F.col("geschaeft_typ_deutsch") == ITEM_TYPE)
    return dedup_rows(merge_documents(wanted_docs, wanted_items))


def extract_dedup_job(
    df: DataFrame,
    key: str = "motion_id",
    content: str = "content",
    url: str = "url",
    extractor: str | Callable[[bytes], str | None] = "html",
    cleaner: str | Callable[[Column], Column] = "simple",
    row_key: str | Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Extract text and mark repeats of cleaned text; the lowest key of a text stays unique.

    ``row_key`` names the columns that tell the rows of one text apart, by default the key and the
    address, as a motion may have several documents. Every text is extracted and digested once.
    """
    results = extract_text_job(df, key, content, url, extractor, **options)
    keys = row_key or ["motion_id", *(["url"] if "url" in results.columns else [])]
    return dedup_clean_text(results, keys, cleaner=cleaner)


def attach_content(motions: DataFrame, content: DataFrame, url: str = "dokument_url") -> DataFrame:
    """Landed bytes by address. Of several contents that landed for one address, the smallest counts."""
    landed = content.groupBy(F.col("url").alias("_url")).agg(F.min("content").alias("content"))
    return salted_join(motions, landed, [(url, "_url")], "left").drop("_url")


def extract_corpus(
    motions: DataFrame,
    content: DataFrame,
    extractor: str | Callable[[bytes], str | None] = "html",
    cleaner: str | Callable[[Column], Column] = "simple",
    **options,
) -> DataFrame:
    """Motions with their ``status`` and cleaned ``text``, failures included."""
    fetched = attach_content(motions, content)
    extracted = extract_text_job(
        fetched.withColumn("motion_id", F.col("geschaeft_uid")), "motion_id", "content", "dokument_url",
        extractor, **options,
    ).drop("content", "error_message")
    return extracted.withColumn("text", get_cleaner(cleaner)(F.col("text")))


def point_rows(
    df: DataFrame, payload: Sequence[str] = PAYLOAD_FIELDS, prefixes: Sequence[int] = (64, 128, 256)
) -> DataFrame:
    """Point structure: id, dense vector, one vector per prefix, sparse vector and payload."""
    record = F.struct(*[F.col(f).cast("string").alias(f) for f in payload])
    return df.select(
        "id",
        "text_dense",
        *[vector_prefix("text_dense", n).alias(f"m{n}") for n in prefixes],
        "text_sparse",
        record.alias("payload"),
    )


def index_points(
    corpus: DataFrame,
    entries: Sequence[tuple[str, float]],
    dim: int = DENSE_SIZE,
    embedder: Callable[[], Callable[[Sequence[str]], Any]] | None = None,
) -> DataFrame:
    """Points of the documents that can be stored: those that name a publication target. Their sparse vectors are the
    places of the ``entries`` that they have."""
    known = corpus.where(F.col("dokument_ziel_publikation").isNotNull())
    vectors = embed_text(sparse_vector(known, entries, dense=False), "text", "text_dense", dim, embedder, "tokens")
    indexed = vectors.withColumn("text_sparse", F.col("text_sparse.indices"))
    return point_rows(localized_fields(indexed), PAYLOAD_FIELDS, ())


@contextmanager
def staged(df: DataFrame, label: str = "stage"):
    """A table written to the shared folder for the length of a block.

    Extraction is costly and its result is used twice, for statistics and for vectors; a written
    table is computed once and outlives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def build_index(
    store: Collections,
    name: str,
    docs: DataFrame,
    items: DataFrame,
    content: DataFrame,
    preset: str | Preset = "pipeline",
    samples: int | str = 0,
    dim: int = DENSE_SIZE,
    extractor: str | Callable[[bytes], str | None] = "html",
    cleaner: str | Callable[[Column], Column] = "simple",
    embedder: Callable[[], Callable[[Sequence[str]], Any]] | None = None,
    random_ids: bool = False,
    bucket_chars: int = 2,
    **options,
) -> int:
    """Index the motion documents into a collection; returns the number of points added.

    Token statistics cover every extracted document, also those that are not stored afterwards, and those of earlier
    runs. They are kept with the collection, so only new documents are counted. New statistics change the weights of stored
    points when these are read; their texts are read again only if the vocabulary holds other tokens than before. A
    repeated build changes nothing, and one that breaks off leaves the collection as it was.
    """
    p = get_preset(preset)
    store.create(
        name, dim, p.vocabulary, p.prefixes, p.quantised, bucket_chars=bucket_chars, exist_ok=True, indexed=True,
    )
    motions = sample_head(prepare_motions(docs, items), samples, MOTION_ORDER)
    corpus = extract_corpus(motions, content, extractor, cleaner, **options)
    keyed = store.with_ids(corpus, name, "geschaeft_uid", "dokument_uid", random=random_ids)
    if not random_ids:
        keyed = keyed.dropDuplicates(["id"])
    with staged(keyed, "corpus") as texts:
        # success implies a text; filtering the written table keeps extraction to one run per row
        tokens = with_tokens(texts.where(F.col("status") == STATUS_SUCCESS))
        new = tokens if random_ids else store.without_known(tokens, name)
        before, counted = store.statistics(name), store.counted(name)
        uncounted = tokens.join(counted, "id", "left_anti")
        ids = written(uncounted.select("id"), "uncounted")
        slots = store.token_slots(name)
        if before is not None and ids.isEmpty():
            return store.upsert(name, index_points(new, _by_slot(slots, p.vocabulary), dim, embedder), skip_known=False)
        parts = [token_state(uncounted, "dokument_uid"), *([before] if before is not None else [])]
        state = written(merged_states(*parts), "token-state")
        rows = vocabulary_of(state, p.vocabulary, p.padded).collect()  # as many as the vocabulary's cap
        names = {r["token"]: r["idx"] for r in rows if r["token"]}
        same = before is not None and names.keys() == slots.keys()
        slots = slots if same else names
        vocab = texts.sparkSession.createDataFrame(
            [(*r, slots.get(r["token"], -1)) for r in rows], "idx bigint, token string, n bigint, idf double, slot bigint"
        )
        entries = _by_slot(slots, len(rows))
        added = index_points(new, entries, dim, embedder)
        return store.replace(name, vocab, state, ids, added, None if same else lambda old: reindexed(old, entries))


def _by_slot(slots: dict[str, int], size: int) -> list[tuple[str, float]]:
    """The tokens in order of their slots; points are stored by slot, weights come on read."""
    at = {slot: token for token, slot in slots.items()}
    return [(at.get(k, ""), 0.0) for k in range(size)]


def reindexed(points: DataFrame, entries: Sequence[tuple[str, float]]) -> DataFrame:
    """Points (id, text_dense, payload) with the slots of the vocabulary entries that their texts have."""
    tokens = points.withColumn("tokens", tokenize(F.coalesce("payload.text", F.lit(""))))
    return sparse_vector(tokens, entries, dense=False).select(
        "id", "text_dense", F.col("text_sparse.indices").alias("text_sparse"), "payload"
    )


def query_vectors(
    queries: DataFrame,
    vocab: DataFrame | Sequence[tuple[str, float]] | None,
    preset: str | Preset = "pipeline",
    dim: int = DENSE_SIZE,
    embedder: Callable[[], Callable[[Sequence[str]], Any]] | None = None,
    keywords: str | None = None,
) -> DataFrame:
    """(qid, text_dense, text_sparse) for texts; sparse weights follow the preset."""
    p = get_preset(preset)
    weighted = sparse_query_vector(queries, vocab, p.query_weights, "text", keywords, p.vocabulary)
    return embed_text(weighted, "text", "text_dense", dim, embedder).select(
        "qid", "text_dense", "text_sparse"
    )


def attach_stored_payload(store: Collections, name: str, hits: DataFrame) -> DataFrame:
    """Payloads of final hits from a collection, reading only the partitions that hold a hit.

    The hits, at most queries x limit rows, are written first: as a table of known size their partitions
    are known before the payload scan starts, and the search does not run a second time for it.
    """
    config = store.config(name)
    kept = written(hits, "hits").where(F.col("rank") >= 1)
    return payload_attach(kept, store.points(name), bucket_chars=config["bucket_chars"]).select(
        "qid", "rank", "id", "score", "payload"
    )


def search_similar(
    store: Collections,
    name: str,
    queries: DataFrame,
    limit: int | None = None,
    preset: str | Preset = "pipeline",
    embedder: Callable[[], Callable[[Sequence[str]], Any]] | None = None,
    **options,
) -> DataFrame:
    """Hybrid search of a stored collection: (qid, rank, id, score, payload) for (qid, text)."""
    config, p = store.config(name), get_preset(preset)
    limit = p.default_limit if limit is None else limit
    vectors = query_vectors(queries, store.vocabulary(name), p, config["dense_size"], embedder)
    hits = hybrid_search(
        store.points(name), vectors, limit, p, bounds=store.bounds(name), with_payload=False, **options
    )
    return attach_stored_payload(store, name, hits)


def search_coarse(
    store: Collections,
    name: str,
    queries: DataFrame,
    limit: int | None = None,
    preset: str | Preset = "pipeline",
    embedder: Callable[[], Callable[[Sequence[str]], Any]] | None = None,
    **options,
) -> DataFrame:
    """Coarse-to-fine search alone, of a collection that keeps codes: (qid, rank, id, score, payload) for (qid, text).

    The quantised stages read the stored codes, the last ones the longest stored prefix of what those kept.
    """
    config, p = store.config(name), get_preset(preset)
    limit = p.default_limit if limit is None else limit
    asked = embed_text(queries, "text", "prefix_dense", config["dense_size"], embedder).select("qid", "prefix_dense")
    stored = store.points(name).select("id", unpack_vector("prefix_dense").alias("prefix_dense"))
    found = coded_cascade(
        store.codes(name), stored, asked, config["prefixes"], p.stage_limits(limit), store.code_bounds(name), "prefix_dense", **options
    )
    return attach_stored_payload(store, name, found.where(F.col("rank") <= limit))


def demo_search(
    documents: DataFrame,
    queries: DataFrame,
    limit: int | None = None,
    key: str = "id",
    dim: int = DENSE_SIZE,
    keywords: str = "keywords",
    source: str = "sample_data",
    embedder: Callable[[], Callable[[Sequence[str]], Any]] | None = None,
) -> DataFrame:
    """Index texts and search them in one go with the ``demo`` preset.

    Queries have (qid, text, keywords); the keywords alone feed the sparse branch.
    """
    p = PRESETS["demo"]
    tokens = with_tokens(documents.withColumnRenamed(key, "id"))
    entries = vocabulary_entries(build_vocabulary(tokens, "id", p.vocabulary, pad=p.padded))
    vectors = embed_text(sparse_vector(tokens, entries), "text", "text_dense", dim, embedder, "tokens")
    points = vectors.select(
        "id", "text_dense", "text_sparse",
        F.struct(F.col("text"), F.lit(source).alias("source")).alias("payload"),
    )
    asked = query_vectors(queries, entries, p, dim, embedder, keywords)
    return hybrid_search(written(points, "points"), asked, limit, p)
