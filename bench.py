"""Time the headline queries on one scale and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from stratalake.plans import registry
from stratalake.session import build_session

HEADLINE = (
    "flagship_customer_state",
    "scd_01_rank_history",
    "scd_02_snapshot_history",
    "scd_03_state_history",
    "scd_04_two_source_history",
    "scd_05_cross_closure",
    "scd_07_incremental_history",
    "scd_08_append_rerank_merged",
    "scd_09_message_reconcile",
    "scd_10_action_merge",
    "scd_11_hash_upsert_merged",
    "scd_12_close_deleted",
    "win_02_global_id",
    "ded_04_latest_per_key",
    "ded_06_latest_with_ties",
    "jon_01_star",
    "jon_05_temporal_anti",
    "jon_14_two_roles",
    "agg_05_distinct_structs",
    "agg_08_collapse",
    "prj_16_explode_flatten",
    "prj_40_keyword_search",
    "key_04_state_hash",
    "set_05_multiset_diff",
    "ano_09_matched_names",
    "ops_05_rule_violations",
    "ing_01_missing_files",
    "src_04_csv_strict",
    "snk_03_merge_write",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(max(8, int(cpus))),
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    tables = registry.Tables(spark, folder)
    wanted = sys.argv[1:] or HEADLINE
    small = registry.Tables(spark, str(Path(folder).parent / "sf0.001"))
    seconds = {}
    for name in wanted:
        _timed(small, name)  # loads classes and compiles code; only the run on the full scale counts
        seconds[name] = _timed(tables, name)
    line = {
        "metric": "headline queries, build and run, each after one run on the smallest scale",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(Path(folder).name.removeprefix("sf")),
    }
    print(json.dumps(line), flush=True)


def _timed(tables: registry.Tables, name: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](tables).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


if __name__ == "__main__":
    main()
