"""Time the headline queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose data, cores and runs per query (median is kept).
BENCH_ONLY may name some queries, separated by commas.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]

HEADLINE = [
    "prepare_motions",
    "merge_documents",
    "dedup_rows",
    "dup_flag_rows",
    "dedup_clean_text",
    "extract_text_job",
    "extract_dedup_job",
    "assemble_pages",
    "clean_simple",
    "clean_advanced",
    "section_after_marker",
    "tokenize",
    "token_counts",
    "bm25_idf",
    "build_vocabulary",
    "sparse_vector",
    "embed_text",
    "int8_quantize",
    "cosine_similarity",
    "dense_topk",
    "query_document_cross",
    "matryoshka_cascade",
    "sparse_topk",
    "hybrid_search",
    "demo_search",
    "layout_report",
]


def main() -> None:
    from loomdex import build_session
    from loomdex.catalog import QUERIES
    from loomdex.catalog import inputs as i
    from loomdex.plans import jobs
    from loomdex.session import clear_scratch, scratch_path
    from loomdex.sources.collections import Collections

    # one machine: a folder of its own serves as the shared one; what was written there goes at the end
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.loomdex.inputPartitions": CPUS,  # each input is one small file here
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": scratch,
        },
    )
    spark.sparkContext.setLogLevel("OFF")

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def timed(run) -> float:
        took = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            took.append(time.perf_counter() - start)
        return round(statistics.median(took), 3)

    store: dict = {}

    def index() -> None:
        if "it" in store:
            store["it"].delete("motions")
        store["it"] = Collections(spark, scratch_path(spark, "bench-index"))
        jobs.build_index(
            store["it"], "motions", i.docs(spark, FOLDER), i.items(spark, FOLDER),
            i.doc_content(spark, FOLDER), extractor="text", bucket_chars=1,
        )

    def search() -> None:
        if "it" not in store:
            index()
        from pyspark.sql import functions as F

        asked = i.table(spark, FOLDER, "benchmark").select(F.col("item_id").alias("qid"), "text")
        drain(jobs.search_similar(store["it"], "motions", asked))

    cases = {n: (lambda n=n: drain(QUERIES[n](spark, FOLDER))) for n in HEADLINE}
    cases |= {"build_index": index, "search_similar": search}
    cases = {n: run for n, run in cases.items() if not ONLY or n in ONLY}
    drain(QUERIES["tokenize"](spark, FOLDER))  # start the JVM's and the workers' engines
    times = {name: timed(run) for name, run in cases.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
