"""Trips kept in the job's own partitioning (D1): bucketed by trip id, so that a rerun shuffles nothing.

The line net is computed again whenever the network changes (stations, coordinates, the gap mode), on the same
trips. Stored once by their id, they are read back already partitioned, and every step of the job is
local to a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lineweave.operators.distance import leg_distance, with_exact_leg_distance, with_trip_distance
from lineweave.operators.hops import clean_trip_names, mark_shared_ids, task_count, trip_identity
from lineweave.operators.legs import leg_stations, resolved_legs
from lineweave.plans.linenet import GAP_MODES, LineNetDims, hop_legs, project_result
from lineweave.sources.trips import trip_scan


#: Buckets of a table with few trips.
LEAST_BUCKETS = 16


def store_trips(trips: DataFrame, table: str, path: str, buckets: int | None = None, key_cols=None) -> None:
    """Writes the trips that have a plan, with their ids, as a table in ``buckets`` buckets under ``path`` (shared
    storage): one file a bucket, sorted by the id. A table of that name is replaced. Without ``buckets`` their number
    follows the number of trips, as a bucket is what one task of a rerun holds."""
    if buckets is None:
        buckets = max(LEAST_BUCKETS, task_count(trips.count()))
    ids = trip_identity(trip_scan(trips), key_cols).repartition(buckets, "trip_id")
    rows = mark_shared_ids(ids) if key_cols is not None else ids
    rows.write.bucketBy(buckets, "trip_id").sortBy("trip_id").option("path", path).mode("overwrite").saveAsTable(table)


def stored_line_net(spark: SparkSession, table: str, dims: LineNetDims, gap_mode: str = "bridge", extra_aliases=None) -> DataFrame:
    """The result of ``build_line_net`` for a stored table."""
    if gap_mode not in GAP_MODES:
        raise ValueError(f"gap_mode must be one of {GAP_MODES}")
    prepared = clean_trip_names(spark.table(table), extra_aliases)
    legs = resolved_legs(hop_legs(None, dims, extra_aliases=extra_aliases, prepared=prepared))
    legs = with_trip_distance(leg_distance(legs)) if gap_mode == "bridge" else with_exact_leg_distance(legs)
    return project_result(leg_stations(legs, dims.bare_lines()))
