"""Seconds per headline query, as one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores, BENCH_RUNS how
often each query runs (the fastest run counts). Each query computes all its columns and rows;
the result goes nowhere. A query that fails is named in the line, and the others run all the same.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from sedimenta.session import build_session, sizing  # noqa: E402

HEADLINES = [
    "dedup_text_source",
    "silver_build",
    "sentiment_score",
    "gold_build",
    "class_distribution",
    "merge_insert_only",
    "merge_upsert",
    "layers_refresh",
    "export_train",
    "ingest_headlines",
    "ingest_posts",
    "posts_top_k",
    "stream_ingest",
    "classification_metrics",
    "train_classifier",
]


def main() -> int:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINES
    data_bytes = sum(f.stat().st_size for f in Path(folder).glob("*.parquet"))
    settings = {
        **sizing(data_bytes, int(cpus)),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    seconds, failed = {}, {}
    for name in names:
        taken = []
        try:
            for _ in range(runs):
                start = time.perf_counter()
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
                taken.append(time.perf_counter() - start)
        except Exception as error:
            traceback.print_exc()
            failed[name] = str(error)[:300]
        else:
            seconds[name] = round(min(taken), 3)
    spark.stop()
    line = {
        "metric": "total_headline_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
