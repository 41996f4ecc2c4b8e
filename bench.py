"""Time every registered query and print one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of local
threads, ``BENCH_QUERIES`` (optional) a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revlens.queries import QUERIES
from revlens.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
WARM_UP = ("row_count", "product_delta", "top_words")


def run(spark, name: str) -> float:
    """Seconds to build and fully compute one query; its rows go nowhere."""
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "revlens-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    for name in WARM_UP:
        run(spark, name)
    seconds = {name: round(run(spark, name), 3) for name in chosen}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
