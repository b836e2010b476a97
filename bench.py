"""Time the catalogue at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query runs whole, into a sink that discards the rows; the time includes the jobs a query
starts while it is built. ``rows_per_sec`` relates four headline queries to their input.
"""

from __future__ import annotations

import json
import os
import sys
import time

from fettle.plans.catalog import QUERIES
from fettle.session import build_session
from fettle.shared import scratch

HEADLINE = {
    "packed_chunks": "documents",
    "chat_prompt": "conversations",
    "group_advantage": "documents",
    "unique_chars_reward": "documents",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "fettle-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.log.level": "ERROR"},
    )

    def run(name: str) -> float:
        with scratch(spark):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - began

    run("token_counts")  # starts the executors and loads the classes every query needs
    seconds = {name: round(run(name), 3) for name in chosen}
    inputs = {
        name: spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
        for name, table in HEADLINE.items() if name in seconds
    }
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {name: round(n / seconds[name]) for name, n in inputs.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
