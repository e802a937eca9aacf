"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores (default 8)
BENCH_ALL     set to run every registered query

Each query runs once to warm up and then three times into the noop sink; the
median counts. The star schema is written once before the queries that read
it, and that time is reported as ``star_build``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tillsight import registry
from tillsight.plans.star import TABLES
from tillsight.session import SETTINGS, local_session

HEADLINE = (
    "src_raw_csv snk_clean sql_surface dq_null_counts dq_duplicate_count dq_summary "
    "feat_customer_tier price_order_line "
    "q01_category_summary q02_high_value_customers q03_monthly_trend q04_above_avg_margin "
    "q05_top_customers_region q06_mom_growth q07_best_product_category q08_discount_impact "
    "q09_above_segment_avg q10_running_total q11_regional_scorecard q12_yoy_growth "
    "q13_retained_customers q14_first_vs_latest q15_quarterly_pivot "
    "eda03_region_share eda05_top_customers eda09_quarter_year_heatmap eda11_correlation_matrix "
    "rpt_customer_segments rpt_quarterly rpt_region_scorecard rpt_summary "
    "intent_tag intent_tag_texts intent_scores_texts "
    "dim_customer dim_product fact_sales "
    "m_total_orders m_revenue_yoy m_product_rank m_top20_contribution "
    "dash_kpis dash_region_matrix dash_product_table dash_tier_matrix dash_slice"
).split()


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = list(registry.QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = local_session("bench", cores=cores, partitions=int(cores) if cores.isdigit() else 8)
    run(spark, folder, "q01_category_summary")
    start = time.perf_counter()
    model = registry.star(spark, folder)
    for table in TABLES:
        getattr(model, table)  # written when asked for
    times = {"star_build": round(time.perf_counter() - start, 3)}
    for name in names:
        run(spark, folder, name)
        times[name] = round(statistics.median(run(spark, folder, name) for _ in range(3)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    print(json.dumps({
        "metric": "total wall time of the headline queries, median of 3 after a warm-up",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": folder.rsplit("sf", 1)[-1], "order_rows": rows,
        "config": {"master": spark.sparkContext.master,
                   "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                   **SETTINGS},
    }))


if __name__ == "__main__":
    main()
