"""Token statistics, vocabulary, inverse document frequency and sparse vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdex.functions.embedding import vocabulary_pairs, vocabulary_weights
from loomdex.functions.text import keyword_lower, tokenize
from loomdex.operators.statistics import documents_of, token_state
from loomdex.session import written

IDF_EPSILON = 0.25


def with_tokens(df: DataFrame, text: str = "text", out: str = "tokens") -> DataFrame:
    return df.withColumn(out, tokenize(text))


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Term frequency over the corpus."""
    exploded = df.select(F.explode(tokens).alias("token"))
    return exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def document_frequency(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Documents per token. Repeats go inside each row, so nothing is shuffled to find them."""
    exploded = df.select(F.explode(F.array_distinct(tokens)).alias("token"))
    return exploded.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def vocabulary_topk(
    df: DataFrame, key: str, cap: int = 256, tokens: str = "tokens", pad: bool = False
) -> DataFrame:
    """The ``cap`` most frequent tokens as (idx, token, n); ties go to the token seen first.

    With ``pad`` the list is filled up with empty tokens to exactly ``cap`` rows.
    """
    return build_vocabulary(df, key, cap, tokens, pad).drop("idf")


def vocabulary_padding(vocab: DataFrame, cap: int) -> DataFrame:
    """Exactly ``cap`` rows: missing positions get the empty token with count 0."""
    slots = vocab.sparkSession.range(cap).withColumnRenamed("id", "idx")
    padded = slots.join(vocab, "idx", "left")
    fills = {"token": "", "n": 0, "idf": 0.0}
    return padded.select(
        "idx",
        *[F.coalesce(c, F.lit(fills[c])).alias(c) for c in vocab.columns if c != "idx"],
    )


def bm25_idf(
    frequencies: DataFrame, n_docs: Column, epsilon: float = IDF_EPSILON, mean: Column | None = None
) -> DataFrame:
    """Add ``idf`` to a (token, df) table.

    ln(N - df + 0.5) - ln(df + 0.5); negative values become ``epsilon`` times the mean over all
    tokens. N and the mean arrive as one-value scalar subqueries.
    """
    raw = F.ln(n_docs - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
    scored = frequencies.withColumn("idf", raw)
    if mean is None:
        mean = scored.agg(F.avg("idf")).scalar()
    return scored.withColumn(
        "idf", F.when(F.col("idf") < 0, F.lit(epsilon) * mean).otherwise(F.col("idf"))
    )


def corpus_idf(df: DataFrame, tokens: str = "tokens", epsilon: float = IDF_EPSILON) -> DataFrame:
    """(token, df, idf) for every token of the corpus."""
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    return bm25_idf(document_frequency(df, tokens), n_docs, epsilon)


def build_vocabulary(
    df: DataFrame,
    key: str,
    cap: int = 256,
    tokens: str = "tokens",
    pad: bool = True,
    epsilon: float = IDF_EPSILON,
) -> DataFrame:
    """Vocabulary with weights (idx, token, n, idf) from one pass over the corpus, whose statistics are written."""
    return vocabulary_of(written(token_state(df, key, tokens), "token-state"), cap, pad, epsilon)


def vocabulary_of(state: DataFrame, cap: int = 256, pad: bool = True, epsilon: float = IDF_EPSILON) -> DataFrame:
    """The vocabulary of a written :func:`token_state`: its ``cap`` most frequent tokens, ties to the one first used."""
    if cap < 1:
        raise ValueError("vocabulary cap must be positive")
    scored = bm25_idf(state.where("token is not null"), documents_of(state), epsilon)
    order = [F.desc("n"), F.asc("first")]
    top = scored.orderBy(*order).limit(cap)
    # at most `cap` rows are left here, so one task is enough to number them
    vocab = top.select((F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint").alias("idx"), "token", "n", "idf")
    return vocabulary_padding(vocab, cap) if pad else vocab


def vocab_membership_join(
    df: DataFrame, vocab: DataFrame, key: str, tokens: str = "tokens"
) -> DataFrame:
    """Postings (key, idx, weight): distinct document tokens that the vocabulary holds.

    Padding entries never match. Spark broadcasts a vocabulary that is small enough and shuffles a larger one, so
    this is the form for vocabularies whose weights don't fit in an array for each document.
    """
    exploded = df.select(key, F.explode(F.array_distinct(tokens)).alias("token"))
    known = vocab.where(F.col("token") != "").select("token", "idx", F.col("idf").alias("weight"))
    return exploded.join(known, "token").select(key, "idx", "weight")


def query_vocab_join(
    queries: DataFrame, vocab: DataFrame, weights: str = "binary", tokens: str = "tokens"
) -> DataFrame:
    """(qid, idx, weight) for query tokens in the vocabulary; weight 1 or the token's idf."""
    hits = vocab_membership_join(queries, vocab, "qid", tokens)
    if weights == "binary":
        return hits.withColumn("weight", F.lit(1.0))
    if weights != "idf":
        raise ValueError("weights must be 'binary' or 'idf'")
    return hits


def vocabulary_entries(vocab: DataFrame | Sequence[tuple[str, float]]) -> list[tuple[str, float]]:
    """The vocabulary as a list of (token, idf) in order: as many rows as the cap it was built with."""
    if not isinstance(vocab, DataFrame):
        return list(vocab)
    rows = vocab.select("idx", "token", "idf").collect()
    return [(r["token"], float(r["idf"])) for r in sorted(rows, key=lambda r: r["idx"])]


def sparse_vector(
    df: DataFrame,
    vocab: DataFrame | Sequence[tuple[str, float]],
    tokens: str = "tokens",
    out: str = "text_sparse",
    dense: bool = True,
) -> DataFrame:
    """Weights over a vocabulary: idf where the document has the token, else 0.

    An array of vocabulary length, or with ``dense=False`` a struct of the indices of tokens that the document has, rising, and
    their values, which is the form for wide vocabularies. Term frequency has no influence, and documents without any
    known token stay.
    """
    entries = vocabulary_entries(vocab)
    weigh = vocabulary_weights if dense else vocabulary_pairs
    return df.withColumn(out, weigh(F.col(tokens), [t for t, _ in entries], [w for _, w in entries]))


def sparse_query_vector(
    queries: DataFrame,
    vocab: DataFrame | Sequence[tuple[str, float]] | None,
    weights: str = "binary",
    text: str = "text",
    keywords: str | None = None,
    cap: int = 256,
    out: str = "text_sparse",
    dense: bool = True,
) -> DataFrame:
    """Query weights over the vocabulary; all zeros of length ``cap`` without a vocabulary. ``dense`` as in :func:`sparse_vector`.

    The tokens come from the query text or, when ``keywords`` names an array column, from there.
    """
    if vocab is None:
        none = F.struct(F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values"))
        return queries.withColumn(out, F.array_repeat(F.lit(0.0), cap) if dense else none)
    if weights not in ("binary", "idf"):
        raise ValueError("weights must be 'binary' or 'idf'")
    entries = vocabulary_entries(vocab)
    tokens = keyword_lower(keywords) if keywords else tokenize(text)
    names = [t for t, _ in entries]
    values = [1.0] * len(entries) if weights == "binary" else [w for _, w in entries]
    return queries.withColumn(out, (vocabulary_weights if dense else vocabulary_pairs)(tokens, names, values))
