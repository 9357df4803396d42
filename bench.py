"""Time the headline queries and print one JSON line.

Each query is run once on the small data to warm up, then timed on $BENCH_SF_DIR with a
no-op write, so that every column of the result is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bid_headers", "bid_lines", "zone_weight_profile", "product_summary", "bid_summary", "feature_table", "industry_profile",
    "binding_bounds", "optimum_with_flags", "what_if_sweep", "quotes_per_service", "segment_quotes", "updated_result_table",
]
SMALL = "/root/testdata/sf0.001"


def main() -> None:
    from tenderline.session import build_session
    from testbed.queries import REGISTRY

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": "16m"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run = REGISTRY[name][0]
        if os.path.isdir(SMALL):
            run(spark, SMALL).write.format("noop").mode("overwrite").save()
        start = time.time()
        run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
