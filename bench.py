"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from chartloom.session import with_recommended  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = """
    scan_by_keys scan_by_many_keys role_playing_lookup nest_set nest_list group_first_row latest_n
    drug_names obs_doc encounter_doc doc_for_target patient_doc lab_order_doc labs_doc vitals_doc
    hiv_summary_doc sync_classify staging_upsert doc_write_roundtrip stream_upsert stream_rebuild
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    spark = with_recommended(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    QUERIES["join_left"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up is not timed
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
