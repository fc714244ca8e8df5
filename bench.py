"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from supplyloom.queries.catalog import QUERIES  # noqa: E402
from supplyloom.session import build_session  # noqa: E402

HEADLINES = (
    "p7_a1_a2_a7_order_record_view",
    "p1_request_dashboard",
    "p2_request_type",
    "p3_j11_price_per_request",
    "p4_a9_consolidated_targets",
    "p5_ageing_and_backlog",
    "p6_u2_kpi_report",
    "p8_s6_quality_sample",
    "p9_notification_audience",
    "p10_reminder_audience",
    "p11_anonymize_job",
    "p12_default_contacts",
    "a4_w3_productivity_points",
    "a7_line_items_text",
    "a8_comment_history",
    "h1_top_level_customer",
    "j11_price_at_date",
    "s3_sample_percent",
    "w1_global_row_number",
    "w4_flag_duplicates_two_keys",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench", **{"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": str(2 * int(cpus))}
    )
    wanted = sys.argv[1:] or HEADLINES
    QUERIES["io1_table_scan"](spark, folder).count()  # start the JVM and the first executor threads outside the clock
    seconds = {}
    for name in wanted:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
