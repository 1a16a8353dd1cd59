"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "ind_ma",
    "ind_boll",
    "ind_rsi",
    "ind_macd",
    "ind_atr",
    "agg_rps20",
    "agg_breadth",
    "agg_industry_ma",
    "agg_crowding",
    "jn_adjust",
    "jn_bars_upsert",
    "src_daily_docs",
    "prj_neutral_text",
    "min_vwap_running",
    "min_vwap_gate",
    "min_audit",
    "dq_source_health",
    "dq_run_grade",
    "scr_select",
    "scr_v2",
    "st_exit_replay",
    "st_slot",
    "strm_minutes",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from barlake.plans import catalog
    from barlake.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    # one untimed query first, so that starting the JVM is not charged to a query
    catalog.QUERIES["ind_ma"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
