"""Benchmark: wall time of the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is fully executed into the ``noop`` sink (no rows are pulled to the driver);
one warm-up pass over all queries, then the median of ``$BENCH_REPEAT`` timed passes.
Also reports the streaming ingest rate (``stream_rows_per_sec``).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.plans import queries as Q  # noqa: E402
from marquee.plans.queries import QUERIES  # noqa: E402
from marquee.session import local_session, work_path  # noqa: E402

HEADLINE = [
    "avg_by_group", "topk_by_group", "bucket_histogram", "dedup_first", "id_name_lookup", "array_lookup",
    "catalogue_messages", "silver_etl", "dataset_profile", "silver_avg_by_genre", "silver_top10_by_year",
    "silver_rating_buckets", "json_malformed", "stream_append", "etl_job", "analytics_job",
]


def run_once(spark, name: str, root: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def stream_rate(spark, root: str, repeat: int) -> int:
    """Streaming ingest throughput: every event landed once as a JSON message, then the
    stream (decode, stamp, idempotent append, count) run from a fresh checkpoint; rows per
    second of the median of ``repeat`` timed runs after a warm-up."""
    landing = Q._land_event_messages(spark, root)
    secs, rows = [], 0
    for i in range(repeat + 1):
        t0 = time.perf_counter()
        _, _, counter = Q._run_stream(spark, landing)
        if i:
            secs.append(time.perf_counter() - t0)
        rows = counter.totals["rows"]
    return round(rows / statistics.median(secs))


def many_files(spark, root: str, parts: int) -> str:
    """The tables with every large one in ``parts`` files instead of one file with a single
    row group, as a stored table of any size has them: copied once, before anything is timed."""
    out = work_path(spark, "bench-tables")
    for name in sorted(os.listdir(root)):
        if name.endswith(".parquet"):
            df = spark.read.parquet(f"{root}/{name}")
            n = parts if os.path.isdir(f"{root}/{name}") or os.path.getsize(f"{root}/{name}") > 1_000_000 else 1
            df.repartition(n).write.parquet(f"{out}/{name}")
    return out


def main() -> None:
    given = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    root = many_files(spark, given, int(cpus)) if os.environ.get("BENCH_AS_STORED") != "1" else given
    errors = {}
    for n in names:  # warm-up: JIT, file listing caches
        try:
            run_once(spark, n, root)
        except Exception as e:  # a failing query is reported, not allowed to hide the others
            errors[n] = f"{type(e).__name__}: {str(e)[:300]}"
    ok = [n for n in names if n not in errors]
    times = {n: [] for n in ok}
    for _ in range(repeat):
        for n in ok:
            if n in errors:
                continue
            try:
                times[n].append(run_once(spark, n, root))
            except Exception as e:
                errors[n] = f"{type(e).__name__}: {str(e)[:300]}"
    med = {n: round(statistics.median(v), 3) for n, v in times.items() if n not in errors}
    try:
        rate = stream_rate(spark, root, repeat)
    except Exception as e:
        rate, errors["stream_rows_per_sec"] = None, f"{type(e).__name__}: {str(e)[:300]}"
    m = re.search(r"sf([0-9.]+)", given)
    out = {"metric": "total_median_query_seconds", "value": round(sum(med.values()), 3), "unit": "sec",
           "queries": {n: med.get(n) for n in names}, "sf": float(m.group(1)) if m else given,
           "cpus": cpus, "repeat": repeat, "stream_rows_per_sec": rate}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
