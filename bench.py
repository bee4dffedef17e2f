"""Benchmark: the batch ETL and the analytics questions at one scale.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). One warm-up pass, then the median of BENCH_REPEAT
runs per query; results are fully computed (noop sink), not collected.
Prints one JSON line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermart.plans import analytics as a  # noqa: E402
from ordermart.plans import catalog, pipeline  # noqa: E402
from ordermart.session import build_session, scratch_path  # noqa: E402
from ordermart.sources import binding  # noqa: E402

HEADLINE = {
    "q01": lambda s: a.q01_avg_items(s, "city"),
    "q02": lambda s: a.q02_avg_sales(s, "city"),
    "q03": lambda s: a.q03_units_by_sku(s, "month"),
    "q04": a.q04_sales_by_date_product_city,
    "q05": a.q05_orders_by_area,
    "q06": a.q06_avg_amount_customer_date,
    "q07": a.q07_new_customers_by_date,
    "q08": a.q08_counts_by_date,
    "q09": a.q09_delivery_time,
    "q10": a.q10_orders_sliced,
}
ETL_OPS = ["etl_fact_daily_orders", "etl_dim_customer_updates", "etl_scd2_apply_product",
           "dedupe_order_items", "quality_key_checks"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app="ordermart-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    run_ts = dt.datetime(2002, 1, 1)

    def etl_batch() -> str:
        root = scratch_path(spark, "bench-warehouse")
        pipeline.run_batch(spark, binding.oltp_sources(spark, sf_dir), root, run_ts, batch_id=1)
        return root

    etl_batch()  # warm-up
    etl_times, root = [], None
    for _ in range(repeat):
        t = time.perf_counter()
        root = etl_batch()
        etl_times.append(time.perf_counter() - t)
    star = pipeline.warehouse(spark, root)

    times = {"etl_batch": statistics.median(etl_times)}
    for name, q in HEADLINE.items():
        run(q(star))
        times[name] = statistics.median(timed(lambda: run(q(star))) for _ in range(repeat))
    ops = catalog.etl_queries()
    for name in ETL_OPS:
        run(ops[name](spark, sf_dir))
        times[name] = statistics.median(timed(lambda: run(ops[name](spark, sf_dir)))
                                        for _ in range(repeat))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": {k: round(v, 3) for k, v in times.items()}, "sf": sf,
           "cpus": int(cpus), "spark": spark.version, "repeat": repeat}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
