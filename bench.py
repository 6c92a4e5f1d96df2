"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores; arguments choose queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gatehold.analogue.queries import QUERIES
from gatehold.session import local_session

HEADLINE = """
    s2_headerless_csv t3_partitioned_table t6_delete_rows t9_zorder p1_silver p2_star
    j1_gold_join j1_salted_join j2_airport_join
    a1_delay_by_route a2_delay_by_route_all_origins a3_delay_by_named_route a4_delay_by_named_route_from
    a5_delay_by_destination a6_yearly_delays a8_years_present a9_missing_counts
    o4_top_delays e2_hour_base10 d1_sql_functions
    m3_ordinal_codes m4_feature_table m6_forest m7_accuracy m8_roc_points m8_roc_area m9_confusion m13_scored_year
    m10_grid_search m11_random_search m12_runs m14_predicted_late c1_refinement_chain j1_hot_carriers t6_compact
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cores, app="bench")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the executors
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
