"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Derived tables (trajectories, estimates, library, response cache) are built first, and
their build is timed as a query of its own; every other query then runs from the tables
it would find on a cluster, in full, to a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "reward",
    "logged_transitions",
    "validation_report",
    "group_folds",
    "top_label_ece",
    "bias_slices",
    "contrastive_examples",
    "factual_library",
    "retrieve_examples",
    "few_shot_messages",
    "parsed_decisions",
    "policy_zero_shot",
    "standardized_features",
    "dr_value",
    "bootstrap_ci",
    "behavior_propensity",
    "reward_model_ridge",
    "cross_fit_behavior",
    "cross_fit_estimates",
    "reward_model_comparison",
    "policy_with_backend",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from decisionlake.plans import data
    from decisionlake.plans.catalog import QUERIES, library_table

    def timed(function) -> float:
        start = time.perf_counter()
        function()
        return round(time.perf_counter() - start, 3)

    def build() -> None:
        data.trajectories(spark, sf_dir)
        data.estimates(spark, sf_dir)
        library_table(spark, sf_dir)
        data.response_cache(spark, sf_dir)

    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {"derived_tables": timed(build)}
    for name in HEADLINE:
        seconds[name] = timed(
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
