"""Registered queries over the relational inputs: sources, sinks, filters, joins, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomdex.catalog import inputs as i
from loomdex.catalog.registry import query
from loomdex.functions.text import file_name, file_stem, page_image_name, text_preview
from loomdex.operators import duplicates, relational
from loomdex.plans import jobs
from loomdex.session import scratch_path
from loomdex.sources import readers, sinks

ITEMS, DOCS = i.oracle(i.ITEMS), i.oracle(i.DOCS)
MERGED = f"""select d.*, g.* from ({DOCS}) d join ({ITEMS}) g
 on d.dokument_geschaeft_uid is not distinct from g.geschaeft_uid"""
MOTIONS = f"""select * from ({MERGED}) where geschaeft_typ_deutsch = 'Motion'
 and dokument_typ_deutsch in ('Vorstosstext', 'Vorstoss')"""


def merged(spark, folder):
    return relational.merge_documents(i.docs(spark, folder), i.items(spark, folder))


# Sources and sinks ------------------------------------------------------------------------

@query("scan_csv", ITEMS)
def scan_csv(spark, folder):
    path = scratch_path(spark, "items-csv")
    sinks.write_csv(i.items(spark, folder), path)
    return readers.scan_csv(spark, path, readers.ITEM_SCHEMA)


@query("write_csv", DOCS)
def write_csv(spark, folder):
    path = scratch_path(spark, "docs-csv")
    sinks.write_csv(i.docs(spark, folder), path)
    return readers.scan_csv(spark, path, readers.DOCUMENT_SCHEMA)


def _one_file_each(spark, folder):
    """A text file for each source: its texts by id, line by line."""
    path = scratch_path(spark, "texts")
    rows = i.table(spark, folder, "documents").repartition("source").sortWithinPartitions("source", "doc_id")
    rows.select("text", "source").write.partitionBy("source").option("maxRecordsPerFile", 0).text(path)
    return path


BY_SOURCE = "string_agg(text || chr(10), '' order by doc_id)"


@query(
    "scan_text_files",
    f"select source, md5({BY_SOURCE}) as digest, length({BY_SOURCE}) as characters from documents group by source",
)
def scan_text_files(spark, folder):
    """Every file comes back whole, with the key of its folder."""
    files = readers.scan_text_files(spark, _one_file_each(spark, folder), keys=["source"])
    return files.select("source", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("characters"))


@query(
    "scan_binary_docs",
    f"select source, md5({BY_SOURCE}) as digest, strlen({BY_SOURCE}) as bytes from documents group by source",
)
def scan_binary_docs(spark, folder):
    files = readers.scan_binary_docs(spark, _one_file_each(spark, folder), "txt", keys=["source"])
    return files.select("source", F.md5("content").alias("digest"), F.octet_length("content").cast("bigint").alias("bytes"))


@query("sample_head", "select doc_id, lang, source from documents order by doc_id limit 5")
def sample_head(spark, folder):
    documents = i.table(spark, folder, "documents").select("doc_id", "lang", "source")
    return relational.sample_head(documents, "5", ["doc_id"])


# Projections and filters ------------------------------------------------------------------

@query("filter_motions", MOTIONS)
def filter_motions(spark, folder):
    return relational.filter_motions(merged(spark, folder))


@query(
    "localized_fields",
    f"""select dokument_uid, geschaeft_uid,
 case when contains(dokument_ziel_publikation, 'Deutsch') then geschaeft_titel_deutsch
      when dokument_ziel_publikation = 'Französisch' then geschaeft_titel_franz end as title,
 case when contains(dokument_ziel_publikation, 'Deutsch') then geschaeft_beschluss_deutsch
      when dokument_ziel_publikation = 'Französisch' then geschaeft_beschluss_franz end as beschluss
 from ({MERGED})""",
)
def localized_fields(spark, folder):
    named = relational.localized_fields(merged(spark, folder))
    return named.select("dokument_uid", "geschaeft_uid", "title", "beschluss")


@query("cast_keys", "select cast(doc_id as varchar) as doc_id, lang from documents")
def cast_keys(spark, folder):
    return relational.cast_keys(i.table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")


@query(
    "payload_struct",
    f"select geschaeft_uid, dokument_uid, dokument_url as url from ({MERGED})",
)
def payload_struct(spark, folder):
    renamed = merged(spark, folder).withColumnRenamed("dokument_url", "url")
    packed = relational.payload_struct(renamed, ["geschaeft_uid", "dokument_uid", "url"])
    return packed.select("payload.*")


@query("text_preview", "select doc_id, substr(text, 1, 100) as preview from documents")
def preview(spark, folder):
    return i.table(spark, folder, "documents").select("doc_id", text_preview("text").alias("preview"))


@query(
    "file_keys",
    f"""select dokument_uid, dokument_uid || '.pdf' as name, dokument_uid as stem,
 dokument_uid || '_page_1.png' as image from ({DOCS})""",
)
def file_keys(spark, folder):
    url = "dokument_url"
    return i.docs(spark, folder).select(
        "dokument_uid",
        file_name(url).alias("name"),
        file_stem(url).alias("stem"),
        page_image_name(url, F.lit(1)).alias("image"),
    )


# Joins ------------------------------------------------------------------------------------

@query("merge_documents", MERGED)
def merge_documents(spark, folder):
    return merged(spark, folder)


@query(
    "keyed_url_lookup",
    f"""select g.geschaeft_uid, coalesce(l.url, 'URL not found for motion_id') as url
 from ({ITEMS}) g left join (select dokument_geschaeft_uid as k, max_by(dokument_url, cast(dokument_uid as bigint)) as url
   from ({DOCS}) group by 1) l on g.geschaeft_uid = l.k""",
)
def keyed_url_lookup(spark, folder):
    rows = i.docs(spark, folder).select(
        F.col("dokument_geschaeft_uid").alias("geschaeft_uid"),
        "dokument_url",
        F.col("dokument_uid").cast("bigint").alias("ord"),
    )
    items = i.items(spark, folder).select("geschaeft_uid")
    return relational.keyed_url_lookup(items, rows, "geschaeft_uid", "dokument_url", "ord")


# Duplicates -------------------------------------------------------------------------------

@query("dedup_rows", "select distinct text, lang, source from documents")
def dedup_rows(spark, folder):
    return duplicates.dedup_rows(i.table(spark, folder, "documents").select("text", "lang", "source"))


@query(
    "dup_flag_rows",
    """select text, lang, source, row_number() over (partition by text, lang, source) > 1 as is_duplicate
 from documents""",
)
def dup_flag_rows(spark, folder):
    return duplicates.dup_flag_rows(
        i.table(spark, folder, "documents").select("text", "lang", "source")
    )


@query(
    "has_duplicates",
    "select count(*) > (select count(*) from (select distinct text, lang, source from documents)) as any_duplicate from documents",
)
def has_duplicates(spark, folder):
    return duplicates.has_duplicates(
        i.table(spark, folder, "documents").select("text", "lang", "source")
    )


@query("prepare_motions", f"select distinct * from ({MOTIONS})")
def prepare_motions(spark, folder):
    """Every document row comes twice; the job leaves one."""
    documents = i.docs(spark, folder)
    return jobs.prepare_motions(documents.unionAll(documents), i.items(spark, folder))
