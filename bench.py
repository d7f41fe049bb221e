"""Time the headline queries from the driver tables to their last row.

Prints one JSON line.  ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.
Every query starts from the raw tables and nothing is cached between queries.
"""

from __future__ import annotations

import json
import os
import time

from remitlens.session import build_session
from samplemap.queries import QUERIES

HEADLINE = [
    "cleanse_accepted", "validate_rejects", "merge_claims", "modifier_explode",
    "asof_fee_outer", "auth_missing_flag", "duplicate_submissions", "rule_evaluation", "rule_trace",
    "adjudicated_claims", "daily_fact", "pipeline_health", "denial_mix_by_rule", "exposure_by_defect",
    "provider_exposure_ranked", "provider_rollup", "what_if_delta", "assertion_grid", "kpi_measures",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # The first query of a session pays for loading classes; that is not a query's cost.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for key in HEADLINE:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
