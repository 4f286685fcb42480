"""Per-trip station lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect_trip_stations(stations: DataFrame, sep: str = ",") -> DataFrame:
    """Per trip: number of station rows, number of transfer rows (the passed station is the
    leg's own hop station), and the station names in (hop, position) order as one text.

    A trip's rows come from one plan row, so the group is bounded by that row's legs; the
    aggregation runs on the trip partitioning the pipeline already has.
    """
    is_transfer = F.col("sub_station") == F.col("station")
    agg = stations.groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.sum(is_transfer.cast("int")).cast("long").alias("n_transfers"),
        F.array_sort(F.collect_list(F.struct("hop", "num", "sub_station"))).alias("_l"),
    )
    return agg.select(
        "trip_id", "n_stations", "n_transfers",
        F.concat_ws(sep, F.transform(F.col("_l"), lambda x: x["sub_station"])).alias("stations"),
    )
