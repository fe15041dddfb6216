"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs once over its whole
tables, all rows and columns of the result are computed. The flagship runs once before without
being counted, so that its figure holds neither the start of the session nor the compiler's.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sipnote.checks.queries import QUERIES  # noqa: E402
from sipnote.session import local_session  # noqa: E402

HEADLINE = [
    "process_reviews",
    "clean_reviews",
    "clean_translated",
    "strip_html",
    "aspect_token_matches",
    "aspect_coverage",
    "top_styles_mouthfeel",
    "translate_memory",
    "lemmatize_from_table",
    "spell_corrections",
    "stratified_split",
    "seeded_sample",
    "tfidf_vocabulary",
    "tfidf_weights",
    "baseline_predictions",
    "score_batches",
    "classification_report",
    "keyword_gap",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["process_reviews"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    if "process_reviews" in seconds:
        rows = spark.read.parquet(f"{folder}/documents.parquet").count()
        result["reviews_per_sec"] = round(rows / seconds["process_reviews"], 1)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
