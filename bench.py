"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores), BENCH_QUERIES
(comma-separated names, or ``all``).  Each query runs twice; ``queries`` holds the
second run, ``first`` the first.  Results are fully computed but not kept.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from modlens import catalog  # noqa: E402
from modlens.session import build_session  # noqa: E402


HEADLINE = """comment_rate merge_corpus two_source_merge dump_ingest record_kind dedupe_first clean_text keyword_flag
    lexicon_hits html_extract envelope_flatten export_flatten parse_reply stratified_sample annotation_splits pairwise_cohen
    fleiss consensus dataset_summary length_by_label label_by_source weekly_trend vocab tfidf_by_label score_corpus moderate
    prediction_proxy eval_report baseline_model""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    named = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    chosen = list(catalog.QUERIES) if named == ["all"] else named or HEADLINE
    settings = {
        "spark__sql__shuffle__partitions": cpus,
        "spark__driver__memory": "12g",
        "spark__ui__enabled": "false",
        "spark__ui__showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    first, second = {}, {}
    for name in chosen:
        for times in (first, second):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(name, first[name], second[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_warm_query_time",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "first": first,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "config": {
                    "spark": spark.version,
                    "master": spark.sparkContext.master,
                    "shuffle_partitions": cpus,
                    "driver_memory": settings["spark__driver__memory"],
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
