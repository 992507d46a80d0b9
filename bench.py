"""Time the headline queries once each and print one JSON line.

``index_build`` writes the document index to the shared folder; the retrieval queries after
it read that index, as a job that searches more than once would. Results go to a
sink that drops them, so that every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.compare import local_session
from checks.queries import QUERIES, document_index, silver_table
from gapledger.sources.shared import forget

HEADLINE = (
    "silver_policy_chunks", "silver_clean_html", "term_frequency", "doc_frequency",
    "tfidf_index", "cosine_scores", "retrieve_topk", "retrieve_topk_padded", "gap_matches",
    "gap_prompt", "chat_prompt", "retrieve_domain", "domain_idf", "report_sections",
    "chat_answers", "gold_tfidf_ml", "gold_tfidf_exact", "medallion_roundtrip", "stream_silver",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    # Warm up the JVM on the smallest data: one index build and one retrieval.
    run(QUERIES["retrieve_topk"](spark, "/root/testdata/sf0.001"))
    times: dict[str, float] = {}
    start = time.perf_counter()
    forget(folder)
    document_index(spark, folder)
    times["index_build"] = round(time.perf_counter() - start, 3)
    # Both gold queries read the silver table; neither is charged for writing it.
    start = time.perf_counter()
    silver_table(spark, folder)
    times["silver_build"] = round(time.perf_counter() - start, 3)
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        run(QUERIES[name](spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    scale = folder.rstrip("/").rpartition("sf")[2]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
