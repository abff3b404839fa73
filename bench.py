"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tabwright.plans.catalog import all_queries  # noqa: E402

HEADLINE = [
    "value_frequency", "attr_profile", "type_histogram", "type_plan", "clean_rows", "encode_orders",
    "split_customers", "balance_orders", "quota_lines", "precision_recall_lines", "roc_auc_orders",
    "roc_points_lines", "metric_panel_lines", "permutation_orders", "refit_holdout", "score_batch",
]


def timed(query, spark: SparkSession, folder: str) -> float:
    start = time.perf_counter()
    df: DataFrame = query(spark, folder)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = all_queries()
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start the session's threads
    seconds = {name: round(timed(queries[name], spark, folder), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
