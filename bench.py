"""Time the headline queries: one JSON line on stdout.

`BENCH_SF_DIR` (default /root/testdata/sf0.1) and `BENCH_CPUS` (default 8) choose data and cores.
Every query is timed once in one session that has run one search at the smallest scale before; a
query's time includes reading its inputs and producing every result column. `index_documents` and
`index_pages` build the index tables; the search queries after them read those tables, as searches do.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from groundline.plans import tables
from groundline.plans.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

HEADLINES = (
    "clean_all chunk_heading chunk_segments chunk_tokens chunk_paragraph chunk_table embed_terms index_build index_diff index_diff_tree index_sync "
    "index_sync_stream search_text search_text_postings search_text_weighted search_vector search_approx search_codes retrieve rag_prompts answers_extractive "
    "answer_stream history_prompts chat_prompts html_markdown article_text article_nested sitemap_urls data_array payload_rows"
).split()


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("groundline-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")  # files this small would sit in one task
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    if os.path.isdir(small):  # start the JVM and Python workers before the clock
        QUERIES["search_text"](spark, small).collect()

    def timed(work):
        start = time.time()
        work()
        return round(time.time() - start, 3)

    def drain(name):
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    times = {
        "index_documents": timed(lambda: tables.chunk_index(spark, SF_DIR, tables.document_chunks)),
        "index_pages": timed(lambda: tables.chunk_index(spark, SF_DIR, tables.page_chunks)),
        "index_postings": timed(lambda: tables.chunk_postings(tables.chunk_index(spark, SF_DIR, tables.document_chunks))),
    }
    for name in HEADLINES:
        times[name] = timed(lambda: drain(name))
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
