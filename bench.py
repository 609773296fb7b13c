"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
Every query runs in full; results go to Spark's no-op sink. One untimed pass over a small
query starts the JVM's threads; then each query is run BENCH_RUNS times and the best counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from sftprep.plans.catalog import QUERIES

HEADLINE = (
    "sharegpt_pairs",
    "render_chatglm2",
    "tokenize_codepoint",
    "encode_sft",
    "encode_train_on_prompt",
    "encode_predict",
    "encode_pairwise",
    "pack_blocks",
    "pad_right",
    "mix_concat",
    "interleave_over",
    "interleave_weighted_under",
    "interleave_weighted_over",
    "interleave_weighted_pcg64",
    "split_fraction",
    "split_count",
    "vocab_build",
    "vocab_encode",
    "accuracy_weighted",
    "token_accuracy_shifted",
    "argmax_scores",
    "prediction_records",
    "read_jsonl",
    "stream_encode",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        # small inputs: keep the encoding work on all cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # no call-site capture for every column expression
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = session()
    QUERIES["argmax_scores"](spark, folder).count()
    times: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(os.environ.get("BENCH_CPUS", "8")),
            }
        )
    )


if __name__ == "__main__":
    main()
