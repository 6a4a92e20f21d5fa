"""License scan by diagonal voting, in DataFrame operations only.

All rolling word pairs of every document are joined by hash to the places of the same pairs in the templates. A hit
votes for its diagonal, the difference of the two places. A phrase stands where its diagonal has all votes. For
longer notices, neighbouring diagonals (words inserted or left out) are merged, and the span is verified by the
share of the notice's words that it covers. Words are compared as well as hashes, so a hit is exact.

Null texts count as empty. Rows that repeat give the same result each; a null id stays null; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that count only as a whole, and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices that may differ a little, and their labels.
NOTICES = {
    "all rights reserved": "all-rights-reserved",
    "licensed under the apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-text",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
#: Share of a notice's words that a span must cover, and how far apart the diagonals of one span may lie.
COVER, NEAR = 0.75, 2


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, GAPS), "")


def _pairs(rows: DataFrame, *keys: str) -> DataFrame:
    """Rolling pairs of the column ``words``: place, both words and their hash."""
    n = F.size("words")
    zipped = F.arrays_zip(F.slice("words", F.lit(1), n - 1).alias("a"), F.slice("words", F.lit(2), n - 1).alias("b"))
    each = rows.where(n > 1).select(*keys, F.posexplode(zipped).alias("place", "pair"))
    return each.select(*keys, "place", "pair.a", "pair.b", F.xxhash64("pair.a", "pair.b").alias("gram"))


def templates(spark, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    rows = [(t, label, whole, t.split()) for part, whole in ((phrases, True), (notices, False)) for t, label in part.items()]
    listed = spark.createDataFrame(rows, "template string, label string, whole boolean, words array<string>")
    return _pairs(listed.withColumn("size", F.size("words")), "template", "label", "whole", "size")


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, cover: float = COVER) -> DataFrame:
    """Verified spans of all documents: key, mark, label, whole, start and end (in words), share.

    ``key`` and ``mark`` name a row by its id and text.
    """
    sought = templates(docs.sparkSession, phrases, notices).withColumnsRenamed({"place": "at", "a": "ta", "b": "tb"})
    rows = docs.select(*_same_row(), words_of(F.col("text")).alias("words"))
    hits = (
        _pairs(rows, "key", "mark").join(F.broadcast(sought), "gram").where("a = ta and b = tb")  # a fixed list
        .select("key", "mark", "template", "label", "whole", "size", "at", (F.col("place") - F.col("at")).alias("diagonal"))
        .distinct()
    )
    voted = hits.groupBy("key", "mark", "template", "label", "whole", "size", "diagonal").agg(F.collect_set("at").alias("votes"))
    full = voted.where(F.col("whole") & (F.size("votes") == F.col("size") - 1)).select(
        "key", "mark", "label", "whole", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("size")).alias("end"), F.lit(1.0).alias("share")
    )
    along = Window.partitionBy("key", "mark", "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > NEAR).cast("int"), F.lit(1))
    spans = (
        voted.where(~F.col("whole"))
        .withColumn("new", new)
        .withColumn("span", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("key", "mark", "template", "label", "whole", "size", "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("votes"))).alias("votes"),
            F.min(F.col("diagonal") + F.array_min("votes")).alias("start"),
            F.max(F.col("diagonal") + F.array_max("votes") + 2).alias("end"),
        )
        .withColumn("share", F.size(F.array_union("votes", F.transform("votes", lambda x: x + 1))) / F.col("size"))
        .where(F.col("share") >= cover)
    )
    return full.unionByName(spans.select("key", "mark", "label", "whole", "start", "end", "share"))


def _same_row() -> list[Column]:
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
    ]


def licenses(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its words, the phrases in it, and all labels with the best verified share."""
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    found = (
        scan(docs, **options)
        .groupBy("key", "mark")
        .agg(
            F.count_if("whole").alias("n_base"),
            F.min(F.when(F.col("whole"), F.col("start"))).alias("first_word"),
            F.max(F.when(F.col("whole"), F.col("start"))).alias("last_word"),
            joined(F.collect_set(F.when(F.col("whole"), F.col("label")))).alias("base_labels"),
            joined(F.collect_set("label")).alias("labels"),
            F.max("share").alias("score"),
        )
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_same_row(), F.size(words_of(F.col("text"))).alias("n_words"))
    return rows.join(found, ["key", "mark"], "left").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )


def oracle() -> str:
    """The same rows in DuckDB's SQL, over ``documents``."""
    listed = ", ".join(f"('{t}', '{label}', {whole})" for part, whole in ((PHRASES, "true"), (NOTICES, "false")) for t, label in part.items())
    return rf"""with texts as (select row_number() over () as r, doc_id,
 regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
pairs as (select r, unnest(range(len(words) - 1)) as place, unnest(words[:-2]) as a, unnest(words[2:]) as b from texts where len(words) > 1),
sought as (select template, label, whole, len(words) as size, unnest(range(len(words) - 1)) as spot, unnest(words[:-2]) as a, unnest(words[2:]) as b
 from (select template, label, whole, string_split(template, ' ') as words from (values {listed}) as t(template, label, whole))),
hits as (select r, template, label, whole, size, spot, place - spot as diagonal from pairs join sought using (a, b)),
voted as (select r, template, label, whole, size, diagonal, list(spot) as votes from hits group by all),
along as (select *, diagonal - lag(diagonal) over (partition by r, template order by diagonal) as step from voted where not whole),
parted as (select *, sum(case when step is null or step > {NEAR} then 1 else 0 end) over (partition by r, template order by diagonal) as span from along),
covered as (select r, label, size, flatten(list(votes)) as votes from parted group by r, template, label, size, span),
shares as (select r, label, len(list_distinct(list_concat(votes, list_transform(votes, lambda x: x + 1)))) / size as share from covered),
spans as (select r, label, true as whole, diagonal as start, 1.0 as share from voted where whole and len(votes) = size - 1
 union all select r, label, false, null, share from shares where share >= {COVER}),
found as (select r, count(*) filter (whole) as n_base, min(start) as first_word, max(start) as last_word,
 string_agg(distinct label, ',' order by label) filter (whole) as base_labels, string_agg(distinct label, ',' order by label) as labels,
 max(share) as score from spans group by r)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_base, 0) as n_base, cast(first_word as bigint) as first_word,
 cast(last_word as bigint) as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
 cast(coalesce(score, 0) as double) as score from texts left join found using (r)"""
