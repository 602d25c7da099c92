"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from checks import load_all
from checks.domain import Domain
from checks.registry import QUERIES
from orderloom.session import local_session

HEADLINE = (
    "read_json_responses",
    "flatten_json",
    "map_record",
    "finish_record",
    "xml_extract_job",
    "build_requests",
    "pending_purchase_orders",
    "vendor_schedule",
    "resolve_order_id",
    "drop_loaded_invoices",
    "dedup_first_by_pair",
    "rollup_status",
    "items_object_array",
    "vendor_bill_objects",
    "coerce_and_validate",
    "upsert_invoices",
    "replace_children",
    "assign_ids",
    "feed_load_job",
    "dispatch_job",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    load_all()
    spark = local_session(cpus, int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["not_fully_billed"](spark, folder).write.format("noop").mode("overwrite").save()
    Domain(spark, folder).write_documents()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
