"""Times the headline queries and prints one JSON line."""

import json
import os
import tempfile
import time

from parcelworks.plans.catalog import QUERIES
from parcelworks.session import local_session
from parcelworks.sources import staging

HEADLINE = [
    "source_manifest",
    "duplicate_column_audit",
    "missing_summary",
    "numeric_summary",
    "outlier_summary",
    "rate_enrichment",
    "flag_counts",
    "cleaning_summary",
    "county_summary",
    "iqr_summary",
    "iqr_filtered",
    "market_events",
    "monthly_summary",
    "top_agents",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    shared = os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-")
    spark = local_session(
        shared, cores, cores, **{"spark.python.sql.dataFrameDebugging.enabled": "false"}
    )
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        staging.clear(spark)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
