"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from sitegrade.bindings import registry
from sitegrade.session import build_session

HEADLINE = (
    "final_verdict", "site_bond_summary", "value_histogram", "rank_unseen_values",
    "score_inputs_full_outer", "bond_geometry", "image_radius_join", "nearest_metal",
    "entry_counts", "residue_selections", "declared_outcomes", "density_context",
    "condition_mining", "condition_summary", "residue_statistics", "batch_tally",
    "review_queue", "replace_by_key", "coefficient_residuals", "stream_score",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    queries["status_counts"](spark, sf_dir).collect()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
