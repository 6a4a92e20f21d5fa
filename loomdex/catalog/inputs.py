"""Inputs of the registered queries: views over the given tables, in SQL both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.sources.readers import read_parquet

SPREAD_KEYS = {
    "documents": ["doc_id"],
    "pages": ["page_id"],
    "embeddings": ["vec_id"],
    "conversations": ["conv_id"],
    "events": ["event_id"],
}

ITEMS = """select cast(nullif(o_orderkey, 3) as string) as geschaeft_uid,
 case o_orderkey % 3 when 0 then 'Motion' when 1 then 'Interpellation' else 'Postulat' end as geschaeft_typ_deutsch,
 'Titel ' || o_orderkey as geschaeft_titel_deutsch, 'Titre ' || o_orderkey as geschaeft_titel_franz,
 'Beschluss ' || o_orderpriority as geschaeft_beschluss_deutsch,
 'Decision ' || o_orderpriority as geschaeft_beschluss_franz
 from {orders}"""

DOCS = """select cast(doc_id as string) as dokument_uid,
 cast(case when doc_id % 97 = 0 then null else doc_id * 7 % 1500 end as string) as dokument_geschaeft_uid,
 case doc_id % 4 when 0 then 'Vorstosstext' when 1 then 'Vorstoss' when 2 then 'Antwort' else 'Beilage' end as dokument_typ_deutsch,
 case lang when 'de' then 'Deutsch' when 'en' then 'Deutsch und Französisch' when 'fr' then 'Französisch' end as dokument_ziel_publikation,
 'https://example.org/doc/' || doc_id || '.pdf' as dokument_url
 from {documents}"""

# Landed content of the documents: their text, by address.
DOC_CONTENT = """select 'https://example.org/doc/' || doc_id || '.pdf' as url, text from {documents}"""

# Landed pages: some were never fetched, some are blank.
CONTENT = """select page_id as motion_id, url,
 case when page_id % 13 = 0 then null when page_id % 17 = 0 then '  ' else html end as html
 from {pages}"""

MARKED = """select doc_id, case when doc_id % 3 = 0
 then text || chr(10) || 'Antrag Regierungsrat: x' || chr(10) || text else text end as text
 from {documents}"""

BOILERPLATE_PREFIX = (
    "Page 3 / 12 Seite 2 von 9 am 01.02.2020 zu 2021.RRGR.77 und 049-2022 GESCHÄFTSNUMMER: y "
    "Richtlinienmotion: NEIN, SP und FDP (SVP) EVP GLP CVP EDU https://example.org/a?b=c www.example.org "
    "RRB-Nr.: 5 Direktion: z Klassifizierung: Nicht klassifiziert Weitere Unterschriften: keine "
    "Eingereicht am: heute Eingereicht von: uns Vorstossart: Motion Vorstoss-Nr.: 1 "
    "Dringlichkeit verlangt: ja Dringlichkeit gewährt: nein Version: 3 Dok.-Nr.: 77 Auswahl "
    "Letzte Bearbeitung: 01.02.2020 Parlamentarischer Vorstoss Verteiler Grosser Rat , "
)
BOILERPLATE = (
    "select doc_id, '" + BOILERPLATE_PREFIX + "' || text as text from {documents}"
)

ELEMENTS = """select user_id as doc, event_id % 3 as page_number, event_id as element_id,
 cast(event_id % 7 as int) as type,
 cast(event_id % 50 as double) as x1, cast(event_id % 70 as double) as y1,
 cast(event_id % 50 + 10 + event_id % 40 as double) as x2,
 cast(event_id % 70 + 5 + event_id % 20 as double) as y2,
 (event_id * 37 % 100) / cast(100 as double) as confidence
 from {events}"""

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def oracle(template: str) -> str:
    """The view as SQL over the plain table names."""
    out = template
    for name in TABLES:
        out = out.replace("{" + name + "}", name)
    return out


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet", *SPREAD_KEYS.get(name, []))


def view(spark: SparkSession, folder: str, template: str) -> DataFrame:
    used = {n: table(spark, folder, n) for n in TABLES if "{" + n + "}" in template}
    return spark.sql(template, **used)


def items(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, ITEMS)


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, DOCS)


def doc_content(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, DOC_CONTENT).select("url", F.col("text").cast("binary").alias("content"))


def content(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, CONTENT).select(
        "motion_id", "url", F.col("html").cast("binary").alias("content")
    )


def elements(spark: SparkSession, folder: str) -> DataFrame:
    flat = view(spark, folder, ELEMENTS)
    return flat.select(
        "doc", "page_number", "element_id", "type",
        F.struct("x1", "y1", "x2", "y2").alias("coordinates"), "confidence",
    )
