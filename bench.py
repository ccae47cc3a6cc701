"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession, Window, functions as F

from stakescore.catalog.panels import TEST, weekly_panel
from stakescore.catalog.queries import registered
from stakescore.operators import scoring
from stakescore.operators.chunked import forward_mean, trailing_sum

HEADLINE = (
    "scan_panel", "preprocess", "voting_power_score", "self_bonded_score", "moving_vote_sum",
    "validator_score_table", "top_validators", "data_scoring", "batched_scoring", "block_gaps", "key_violations",
)


def wide_window(spark, sf_dir):
    """The activity sum of the weekly panel over 64 heights."""
    points = scoring.vote_points(scoring.clean(weekly_panel(spark, sf_dir)), TEST.vote_score, TEST.propose_score)
    return scoring.moving_vote_sum(points, 64)


def one_key(spark, sf_dir):
    """All orders as one history by order key, summed over 8,000 keys back."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.lit("all").alias("history"),
        F.col("o_orderkey").cast("int").alias("block_height"),
        F.length("o_orderpriority").alias("points"),
    )
    return trailing_sum(orders, "points", 8_000, ["history"], "total", "position")


def labels_ahead(size):
    """The mean over the current and the next ``size`` orders of 50 histories of all orders."""
    def query(spark, sf_dir):
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
        histories = Window.partitionBy("history").orderBy("o_orderkey")
        buckets = orders.withColumn("history", F.col("o_custkey") % 50).select(
            "history", F.col("o_totalprice").alias("score"), (F.row_number().over(histories) - 1).alias("new_block"))
        return forward_mean(buckets, "score", size, ["history"], "new_block", "label")

    return query


WINDOWS = {
    "moving_vote_sum_win64": wide_window, "one_key_win8000": one_key,
    "forward_label_win2": labels_ahead(2), "forward_label_win672": labels_ahead(672),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = registered() | WINDOWS, {}
    for name in (*HEADLINE, *WINDOWS):
        best = None
        for _ in range(3):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - started
            best = seconds if best is None else min(best, seconds)
        times[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "best_of": 3,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
