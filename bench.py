"""Headline timings on the test tables, as one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs once to warm up and then five times; the median counts. Builds run over the
change tables; the reports run over the stored fact table, as they would in use.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame

from changeloom.plans import queries, reports, retail, star
from changeloom.sources import changelog
from changeloom.sources.workspace import workspace
from check import session

RUNS = 5


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timings: dict[str, float] = {}

    def timed(name: str, build, runs: int = RUNS) -> None:
        run(build())
        taken = []
        for _ in range(runs):
            begun = time.perf_counter()
            run(build())
            taken.append(time.perf_counter() - begun)
        timings[name] = round(statistics.median(taken), 3)

    timed("staging_orders", lambda: queries.staging_orders(spark, sf_dir))
    timed("staging_items", lambda: queries.staging_items(spark, sf_dir))
    timed("staging_join", lambda: queries.staging_join(spark, sf_dir))
    timed("fact_build", lambda: queries.fact_build(spark, sf_dir))
    timed("scd2_products", lambda: queries.scd2_products(spark, sf_dir))
    timed("scd2_versions", lambda: queries.scd2_versions(spark, sf_dir))
    timed("dim_resolve_asof", lambda: queries.dim_resolve_asof(spark, sf_dir))
    timed("surrogate_keys", lambda: queries.surrogate_keys(spark, sf_dir))

    log_path = workspace(spark, "log")
    retail.log(spark, sf_dir).repartition(8, "seq").write.parquet(log_path)
    log = changelog.read_log(spark, log_path)
    timed("log_decode_items", lambda: changelog.events(log, "order_items"))
    timed(
        "fact_from_log",
        lambda: star.build_facts(
            star.from_log(log),
            retail.dim_dates(spark),
            retail.customer_source(spark, sf_dir),
            retail.product_source(spark, sf_dir),
        ).fact,
    )

    fact_path = workspace(spark, "fact")
    for _ in range(2):  # the second one is warm
        begun = time.perf_counter()
        star.write_facts(
            star.build_facts(
                retail.changes(spark, sf_dir),
                retail.dim_dates(spark),
                retail.customer_source(spark, sf_dir),
                retail.product_source(spark, sf_dir),
            ).fact,
            fact_path,
        )
        timings["fact_write"] = round(time.perf_counter() - begun, 3)
    fact = spark.read.parquet(fact_path)
    timed("orders_by_delivery_status", lambda: reports.orders_by_delivery_date_and_status(fact))
    timed(
        "orders_by_delivery_status_range",
        lambda: reports.orders_by_delivery_date_and_status(fact, "open", 19960101, 19970630),
    )
    timed("top_delivery_dates", lambda: reports.top_delivery_dates(fact))
    timed("pending_quantity_by_product", lambda: reports.pending_quantity_by_product(fact))
    timed("top_customers_by_orders", lambda: reports.top_customers_by_orders(fact))
    timed("reports_star_month", lambda: reports.amounts_by_month(fact, retail.dim_dates(spark)))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
