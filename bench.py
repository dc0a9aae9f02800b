"""Time the catalogue's queries. Prints one JSON line.

BENCH_SF_DIR   folder of parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
BENCH_QUERIES  names separated by commas (default: HEADLINE; "all" for every query)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textloom.plans.catalogue import QUERIES  # noqa: E402
from textloom.session import spark_session  # noqa: E402

HEADLINE = (
    "html_to_text posts_silver posts_gold_first repo_files_collision repo_gold repo_gold_latest "
    "pdf_elements_concat pdf_chunks_greedy semantic_chunks hash_embed distil_files vector_check "
    "knn_top7_two_sources knn_cells rrf_fusion context_passages retrieval_eval last_message "
    "token_budget rag_prompts training_records chat_jsonl feature_upsert table_profile "
    "index_sync_changes stream_bronze_append stream_silver_replay"
).split()


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = spark_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=str(cpus),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
