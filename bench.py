"""Time the headline queries: all run once to warm up, then each is timed, results discarded.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import time

from tallyframe import build_session
from tallyframe.workload import all_queries

HEADLINE = [
    "rep_register_compare", "q_agreements", "q_act_data", "q_act_data_settl", "q_act_data_cards", "q_act_final",
    "q_payments", "q_turnover", "q_red_balance", "q_red_summary", "win_latest_version", "win_running_sum",
    "win_partition_sum", "asof_balance", "asof_snapshot", "join_semi_nested", "join_full_outer", "join_star_lookup",
    "agg_pivot_sum", "c_account_status", "c_amount_compare", "c_duplicates", "rep_route", "rep_log_view",
]


def run(spark, sf_dir: str, key: str) -> float:
    start = time.perf_counter()
    all_queries()[key].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for key in HEADLINE:
        run(spark, sf_dir, key)
    seconds = {key: round(run(spark, sf_dir, key), 3) for key in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
