"""Time every query once: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import views  # noqa: E402
from checks.spark_queries import QUERIES, landing, warehouse  # noqa: E402
from shopmart.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()

    # Derived tables that several queries read are written before these and timed on their own.
    steps = {
        "write_mapping_final": lambda: views.mapping_final(spark, sf_dir),
        "write_landing_files": lambda: landing(spark, sf_dir),
    }
    for name, query in QUERIES.items():
        if name.startswith("built_"):
            steps.setdefault("write_warehouse", lambda: warehouse(spark, sf_dir))
        steps[name] = lambda query=query: query(spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
