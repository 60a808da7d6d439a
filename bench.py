"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from shelfloom.plans.queries import QUERIES
from shelfloom.sources.session import session

HEADLINES = (
    "html_tokens",
    "html_elements",
    "slugify",
    "extract_listing_a",
    "extract_listing_b",
    "extract_product",
    "descendants",
    "first_descendant",
    "dedup_products",
    "new_product_urls",
    "frontier_union",
    "surrogate_id",
    "apply_parsed",
    "product_with_source",
    "latest_status",
    "attempt_outcome",
    "run_stages",
    "incremental_listing_parse",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "shelfloom-bench",
        spark__master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    # The first round starts the Python workers and compiles the plans; the second counts.
    for name in HEADLINES:
        run(name)
    seconds = {name: run(name) for name in HEADLINES}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
