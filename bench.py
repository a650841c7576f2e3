"""Wall seconds of the headline queries, as one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Every query is run once to warm up and then
``BENCH_RUNS`` times (3 by default); the median counts. Results are written to the no-op sink, so every column
of every row is worked out and nothing is sent to the driver.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from gaugeloom.functions.jsonflat import flatten_json, flatten_variant  # noqa: E402
from gaugeloom.operators import records  # noqa: E402
from gaugeloom.queries import QUERIES  # noqa: E402
from gaugeloom.queries.common import event_points, events, joined, load  # noqa: E402
from gaugeloom.session import build_session  # noqa: E402

HEADLINE = (
    "point_build", "default_tags", "point_filter", "name_filter_exact", "name_filter_glob", "tag_filter", "value_parse_v2",
    "status_prefix_map", "thread_state_pivot", "autoinc_ceiling", "io_waits_table", "lock_waits_unpivot", "digest_topk",
    "statement_history", "stage_history", "field_chunks", "json_flatten", "json_array", "node_sections", "amqp_queues", "xml_status",
    "mntr_parse", "info_parse", "partition_offsets", "group_offsets", "line_protocol", "line_roundtrip", "flat_record", "point_split",
    "counter_stat", "timing_stat", "series_count", "stream_points",
)


def _document(df):
    return joined('{"a":{"b":', F.col("k"), ',"list":[', F.col("value"), ',{"c":', F.col("user_id"), '}]},"s":"', F.col("event_type"), '"}')


def _wide(spark, d):
    df = events(spark, d)
    return df.filter(F.col("event_type") == "view").groupBy("user_id").agg(F.sum("value").alias("v"), F.sum("k").alias("k"))


def _maps(spark, d):
    pts = event_points(spark, d).filter(F.col("measurement") == "view")
    return pts.groupBy(F.col("tags")["user"].alias("user")).agg(
        F.sum(F.col("fields")["value"]["f"]).alias("v"), F.sum(F.col("fields")["k"]["i"]).alias("k"))


#: Two ways to do the same work, side by side.
PAIRS = {
    "pair_flatten_arrow": lambda s, d: events(s, d).select(flatten_json(_document(events(s, d))).alias("f")),
    "pair_flatten_variant": lambda s, d: events(s, d).select(flatten_variant(_document(events(s, d)), 4).alias("f")),
    "pair_point_maps": _maps,
    "pair_wide_columns": _wide,
    "pair_sink_lines": lambda s, d: records.to_lines(event_points(s, d)),
    "pair_sink_records": lambda s, d: records.to_records(event_points(s, d)),
}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus, spark__sql__files__maxPartitionBytes="4m")
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {n: QUERIES[n] for n in HEADLINE} | PAIRS
    chosen = sys.argv[1:] or list(jobs)
    seconds = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            jobs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    rows = {t: load(spark, sf_dir, t).count() for t in ("events", "orders", "lineitem", "documents")}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()
