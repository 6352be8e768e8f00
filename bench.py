"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the tables' folder, ``BENCH_CPUS`` the local cores. Every
query runs once cold and ``RUNS`` times warm; the best warm time counts. Results
are collected through the ``noop`` sink, so nothing travels to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vectrine.indexes import TextIndex, VectorIndex  # noqa: E402
from vectrine.plans import QUERIES  # noqa: E402
from vectrine.plans.registry import query_vector, read  # noqa: E402
from vectrine.plans.text_queries import SEARCH_TEXT  # noqa: E402
from vectrine.session import shared_dir  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2
REGISTERED = [
    "knn_l2",
    "knn_cosine",
    "knn_hamming",
    "knn_prefilter",
    "knn_batch",
    "sparse_dot",
    "bm25_top",
    "bm25_score",
    "tokens",
    "hybrid_written",
    "hybrid_linear",
    "flt_query",
    "dsl_nested",
    "part_hash",
    "ins_append",
    "ups_replace",
    "upd_where",
    "del_both",
    "auto_id",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    docs, points = read(spark, FOLDER, "documents"), read(spark, FOLDER, "embeddings")
    q = query_vector(spark, FOLDER)
    indexes = {}

    def build_text():
        indexes["text"] = TextIndex.build(docs, shared_dir(spark), "doc_id", "text")

    def build_ivf():
        indexes["ivf"] = VectorIndex.build(points, shared_dir(spark), "vec_id", "embedding", 32)

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    work = {name: (lambda name=name: drain(QUERIES[name](spark, FOLDER))) for name in REGISTERED}
    work["bm25_index_build"] = build_text
    work["bm25_index_search"] = lambda: drain(indexes["text"].search(docs, SEARCH_TEXT, names=["doc_id"], with_score=True))
    work["ivf_build"] = build_ivf
    work["ivf_search"] = lambda: drain(indexes["ivf"].search(q, 10, 8, names=["vec_id"], with_score=True))

    warm, cold = {}, {}
    for name, run in work.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:]), 3)
        print(f"{name}: cold {cold[name]}, warm {warm[name]}", file=sys.stderr, flush=True)
    total = round(sum(warm.values()), 3)
    print(json.dumps({"metric": "total_warm_seconds", "value": total, "unit": "sec", "queries": warm, "cold": cold, "sf": Path(FOLDER).name}))
    spark.stop()


if __name__ == "__main__":
    main()
