"""Wall-clock of the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
Every query runs over whole tables and all its columns are produced. One untimed pass of the
smallest query warms the JVM; each number is the better of two runs.
"""

from __future__ import annotations

import json
import os
import time

from paneloom.queries import QUERIES
from paneloom.session import build_session

HEADLINE = [
    "clean_ohlcv",
    "tradability_flags",
    "universe_rolling",
    "factor_asof_daily",
    "rank_positive",
    "weighted_rank",
    "weighted_rank_combos",
    "forward_returns",
    "quantile_buckets",
    "quantile_returns",
    "factor_portfolio_return",
    "ic_daily",
    "bucket_turnover",
    "rank_autocorr",
    "pca_scores",
    "quarter_schedule_rank",
    "aligned_panel",
    "long_short_signals",
    "trade_ledger",
    "equity_curve",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        "paneloom-bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("duplicate_keys")
    seconds = {name: round(min(run(name), run(name)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
