"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and fully executed (``write.format("noop")``: every row is produced,
nothing is collected to the driver). One untimed warm-up run on the smoke data loads classes
and compiles code first, so the numbers compare steady-state work.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lineweave.catalog import QUERIES  # noqa: E402
from lineweave.session import local_session  # noqa: E402

HEADLINE = [
    "line_net_result",
    "line_net_exact",
    "unresolved_hops",
    "trip_distance",
    "trip_distance_exact",
    "collect_trip_stations",
    "expand_hop_stations",
    "line_stations_from_pages",
    "line_stations_from_payload",
    "canonical_names",
    "dedupe_coordinates",
    "first_station_per_line",
]

# Timed beside the headline, not in its total (so the total stays comparable between rounds); the
# coordinate table of coordinate_variants grows with the scale factor.
EXTRA = ["leg_stations", "attach_coordinates", "coordinate_variants", "trip_identity_duplicates"]


# The plan in the shape of the original program (full expansion, de-duplication after the
# joins, bounds searched among expanded rows); reported for comparison, not in the total.
BASELINE = "line_net_naive"


def run(spark, name, sf_dir):
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)) if cpus.isdigit() else 16, app="lineweave-bench")
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        run(spark, "line_net_exact", warm)
    times = {n: round(run(spark, n, sf_dir), 3) for n in names}
    total = round(sum(times.values()), 3)
    extra = {}
    if not sys.argv[1:]:
        times |= {n: round(run(spark, n, sf_dir), 3) for n in EXTRA}
        naive = round(run(spark, BASELINE, sf_dir), 3)
        times[BASELINE] = naive
        extra = {"baseline_naive_sec": naive, "naive_over_ours": round(naive / times["line_net_exact"], 2)}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        **extra,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
