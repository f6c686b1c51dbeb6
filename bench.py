"""Times the headline queries and the build of the layers they read; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 3; the median is reported). Layers and the daily run are built once, so their time is a
single run; the first includes JVM warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketloom.queries import all_queries  # noqa: E402
from marketloom.plans.daily import run_daily  # noqa: E402
from marketloom.queries.graph import edges_of, nodes_of, tables_of  # noqa: E402
from marketloom.queries.sources import raw_files  # noqa: E402
from marketloom.session import local_session, new_folder  # noqa: E402
from marketloom.specs import TABLES  # noqa: E402
from marketloom.testbed import Bed  # noqa: E402
from marketloom.warehouse import Warehouse  # noqa: E402

HEADLINE = (
    "mart_sales_performance mart_channel_comparison mart_customer_360 mart_product_analytics "
    "score_customers global_row_number global_ntile top_n_per daily_sales monthly_sales "
    "customer_sales item_sales edges_purchased edges_shopped_at edges_returned sample_edges "
    "co_purchase customer_chain top_customers silver_store_sales anomalies_store_sales "
    "silver_customer silver_item anomaly_summary bronze_checks"
).split()


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def clock(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    bed, registry = Bed.of(spark, folder), all_queries()
    # Unified facts read stored Silver, so Silver is built first and each fact is flagged once.
    build = {
        "build_silver_24_tables": clock(bed.silver_layer),
        "build_unified_sales": clock(bed.sales),
        "build_unified_returns": clock(bed.returns),
        "build_graph_nodes": clock(lambda: nodes_of(bed)),
        "build_graph_edges": clock(lambda: (tables_of(bed), edges_of(bed))),
    }
    # The whole daily run: raw files to Bronze, Silver, marts and checks. Writing the files isn't timed.
    files, wh = raw_files(bed, list(TABLES)), Warehouse(spark, new_folder(spark, "daily"))
    build["run_daily"] = clock(lambda: run_daily(wh, files))
    facts = [f"{ch}_{kind}" for ch in ("store", "catalog", "web") for kind in ("sales", "returns")]
    loaded = sum(wh.read("bronze", t).count() for t in facts)
    queries = {}
    for name in HEADLINE:
        times = [clock(lambda: noop(registry[name](spark, folder))) for _ in range(runs)]
        queries[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "seconds, median per query, all headline queries and layer builds",
        "value": round(sum(queries.values()) + sum(build.values()), 3), "unit": "sec",
        "queries": {**build, **queries}, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "runs": runs, "daily_fact_rows": loaded, "daily_fact_rows_per_second": round(loaded / build["run_daily"]),
    }))


if __name__ == "__main__":
    main()
