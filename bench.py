"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores. Each
query runs once on a warm session and its whole result is computed, unread.
"""

from __future__ import annotations

import json
import os
import time

from talkweave.plans.queries import QUERIES
from talkweave.session import build_session, clear_scratch

HEADLINE = [
    "x10_ngrams",
    "x12_build_tfidf",
    "q2_search_and",
    "q3_search",
    "t3_first_page",
    "j2_attach_submission",
    "m1_vocabulary_table",
    "m2_feature_rows",
    "m11_score_linear",
    "a1_sentiment_by_post",
    "a2_sentiment_by_day",
    "a3_sentiment_by_state",
    "t1_top_positive_posts",
    "m9_score",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            # The table is one file of few row groups; see tables.spread.
            "spark.talkweave.textPartitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/documents.parquet").select("text").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("/sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
