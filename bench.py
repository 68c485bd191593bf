"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
Every query is planned and run to the last row (a write to the no-op sink). One
untimed run of the daily series warms the JVM up.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from marketide.plans.registry import REGISTRY
from marketide.session import build_session

HEADLINE = (
    "fact_sales", "transaction_matrix", "net_revenue_lines", "daily_sales", "daily_series",
    "q1_order_gap", "q2_segment_margin", "q3_return_reason", "q4_bounce_rate", "q5_promoted_share",
    "q6_age_group_orders", "q7_region_revenue", "q8_cancelled_payment", "q9_size_return_rate",
    "q10_installments", "null_profile", "duplicate_profile", "join_reconciliation",
    "training_matrix", "regional_series", "seasonal_forecast", "error_metrics",
    "recursive_forecast", "recursive_forecast_linear", "regional_forecast_linear",
    "fact_sales_spread", "daily_series_spread",
)


def run(spark: SparkSession, folder: str, name: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "marketide-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__session__timeZone="UTC",
        # The test tables are small next to the cores: let stages keep small partitions.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="128kB",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, folder, "daily_sales")

    seconds = {}
    for name in HEADLINE:
        seconds[name] = run(spark, folder, name)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else folder,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
