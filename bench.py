"""Benchmark: run the headline queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print
one JSON line.  Each query's result is fully computed (written to the no-op sink) and timed."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mise.plans import catalog  # noqa: E402
from mise.session import get_session  # noqa: E402

HEADLINE = [
    "top_ingredients_per_cuisine", "nested_dishes", "dish_rows", "ingredient_frequency",
    "top_ingredients_with_titles", "cuisine_top_hits", "boolean_ingredients", "nested_ingredient_match",
    "bm25_match", "multi_match_documents", "fuzzy_documents", "more_like_document", "analyze_documents",
    "parse_ingredient_lines", "split_document_sections", "clean_document_lines", "extract_posts_documents",
    "load_outcomes", "upsert_ingredients", "constraint_audit", "chunk_report", "hourly_event_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(app="mise-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        conf={"spark.driver.memory": "16g", "spark.mise.spread": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    # Untimed warm-up: JVM class loading and JIT, not query work.
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        catalog.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").split("sf")[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
