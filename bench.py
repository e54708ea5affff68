"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query is fully executed with the ``noop`` sink (every row computed, nothing collected to
the driver). Its row count is an observed metric of that same job, so counting adds no job.
A warm-up run of the first query pays the JVM/codegen start-up once.

``value`` is the total of the report queries. The batch jobs and builds are timed apart
(rows per second of the whole job, start-up of each job included):

* checkout requests (M03) against 100-400 shop requests/s;
* bet requests (M12) against 80-330 sportsbook requests/s;
* generated orders (B12) against a 600,000-order build in up to 8 minutes (1,250/s);
* generated legs (B21) against 333 legs/s with the bad plan.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillbook import catalog  # noqa: E402
from tillbook.session import local_session  # noqa: E402

HEADLINE = (
    "sales_dashboard", "lifetime_value", "top_products", "delivery_times", "product_pages", "bets_final",
    "ggr_daily", "open_liability", "leaderboard", "running_balance", "odds_at_placement", "rolling_deposits_24h",
    "status_transitions", "outages", "request_rate", "latency_p95", "blocking_chains", "who_blocks", "skew_profile",
    "unique_rules", "price_at_order",
)
JOBS = ("place_orders", "bet_decisions", "orders_build", "bets_build", "regulatory_snapshot", "bi_extract",
        "stock_recount")

# rate name -> (query, what its rows count)
RATES = {
    "checkout_requests_per_s": "place_orders",
    "bet_requests_per_s": "bet_decisions",
    "orders_built_per_s": "orders_build",
    "legs_built_per_s": "bets_build",
}


def _run(df) -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return int(seen.get["rows"])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="tillbook-bench")
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    jobs = [n for n in JOBS if n in qs]
    _run(qs[names[0]](spark, sf_dir))  # warm-up
    times, rows = {}, {}
    for name in names + jobs:
        t0 = time.perf_counter()
        rows[name] = _run(qs[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    rates = {k: round(rows[q] / times[q], 1) for k, q in RATES.items() if q in times and times[q] > 0}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times[n] for n in names), 3),
                      "unit": "sec", "queries": {n: times[n] for n in names}, "sf": sf, "cpus": cpus,
                      "jobs": {n: times[n] for n in jobs}, "rows": rows, "rates": rates}))
    spark.stop()


if __name__ == "__main__":
    main()
