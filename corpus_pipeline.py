"""Documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet into the shared folder
and reads it again as the next one's ``docs``. All but the last return the columns of ``documents``.
Stages judge what they are given: null and empty texts stay until packing, where they are an end id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.llm import minhash, packing, suffix_dedup, tiling, toxicity
from loomdex.llm.common import keep, table
from loomdex.llm.queries import vocabulary

#: Bytes of a repeated string that goes. Passages of 50 words and more that documents share have 167 to thousands of bytes
#: (check_s after the first two stages: 95 % have 251 and more, 58 % have 400 and more), so 400 would leave many.
REPEAT = 250
#: Bytes of the hashes that choose anchors: short ones make fewer anchors in a string of that length.
GRAM = 32


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold. It learns from the labelled documents among ``docs``."""
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "toxic as label")
    model = toxicity.learn(docs, labels)
    return toxicity.scored_rows(docs, model).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    return minhash.first_of_class(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without byte strings of ``REPEAT`` and more that occur more than once. No copy of them stays."""
    return suffix_dedup.without_repeats(docs, REPEAT, gram=GRAM)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    found = tiling.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("matches") == 0).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: the sequence it stands in, and where."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: Samples of weighted sets, a trained model and a tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
