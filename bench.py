"""Time the headline queries and print one line of JSON.

Each query runs once to warm up; the value is the median of three further runs.
Results go to a sink that computes every row and keeps none.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topicloom import catalog  # noqa: E402
from topicloom.session import build_session  # noqa: E402

HEADLINE = [
    "clean_words",
    "term_frequency",
    "document_frequency",
    "tfidf_scores",
    "top_words",
    "word_count",
    "model_input",
    "heading_fill",
    "heading_fill_arrays",
    "markdown_words",
    "extracted_docs",
    "phrase_rank",
    "category_summary",
    "docs_round_trip",
]
# The fits take most of their time on fixed costs, so one run each is enough.
ONCE = ["page_categorize", "kmeans_sweep"]


def timed(run, spark, sf_dir):
    started = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        app="bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = catalog.queries()
    times = {}
    for name in HEADLINE:
        timed(found[name], spark, sf_dir)
        times[name] = round(statistics.median(timed(found[name], spark, sf_dir) for _ in range(3)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    for name in ONCE:
        times[name] = round(timed(found[name], spark, sf_dir), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
