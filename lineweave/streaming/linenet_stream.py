"""Trip plans arriving as a stream (for example Parquet files landing in a folder).

The line net is a per-trip computation against small, static dimensions, so each micro-batch
is processed by the batch plan (``foreachBatch``); the dimensions are prepared once. A micro-batch is
scanned, shuffled and computed once: its results and rejects leave the plan as one frame. Every
micro-batch is written to its own ``batch_id=<n>`` folder with overwrite, so a batch retried
after a failure replaces its own output: exactly once, as long as a restarted stream is given the
same checkpoint path. With a ``reject_path``, results and rejects go to ``batch_id=<n>`` folders of two
places in their own columns (split from the written frame); without one, the frame is the output, with a
folder for each ``kind``. Without a key, equal
plan rows are numbered within their batch and the batch number joins the identity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lineweave.operators.dims import materialized
from lineweave.operators.hops import trip_identity
from lineweave.plans.linenet import line_net_frame, prepare_dims, split_frame, write_line_net_frame
from lineweave.sources.trips import trip_scan


def start_line_net_stream(
    trips_stream: DataFrame,
    line_stations: DataFrame,
    locations: DataFrame,
    out_path: str,
    checkpoint_path: str,
    reject_path: str | None = None,
    gap_mode: str = "bridge",
    key_cols=None,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start a streaming query writing the line net of every micro-batch, and its rejects, as Parquet.

    ``checkpoint_path`` and both outputs must be in storage that driver and executors share.
    """
    dims = prepare_dims(line_stations, locations)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        keys, rows = key_cols, batch.count()
        if keys is None:
            numbered = trip_identity(trip_scan(batch), out="_row_id")
            batch = numbered.withColumn("_row_id", F.concat_ws("#", F.lit(str(batch_id)), F.col("_row_id")))
            keys = ["_row_id"]
        frame = line_net_frame(batch, None, None, gap_mode=gap_mode, key_cols=keys, dims=dims, rows=rows)
        # the folder name carries batch_id as a partition column on read
        folder = f"batch_id={batch_id}"
        if reject_path is None:
            write_line_net_frame(frame, f"{out_path.rstrip('/')}/{folder}", mode="overwrite")
            return
        res, bad = split_frame(materialized(frame, "line-net-batch"))
        res.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/{folder}")
        bad.write.mode("overwrite").parquet(f"{reject_path.rstrip('/')}/{folder}")

    writer = trips_stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
