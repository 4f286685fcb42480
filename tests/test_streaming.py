from pyspark.sql import functions as F

from lineweave import build_line_net, unresolved_hops
from lineweave import fixtures as fx
from lineweave.session import shared_dir
from lineweave.streaming import start_line_net_stream
from tests.conftest import SF001


def test_stream_matches_batch_golden(spark):
    src = shared_dir(spark, "test-stream-in")
    out = shared_dir(spark, "test-stream-out")
    trips = fx.grid_trips(spark, SF001)
    # two files -> the stream sees them as input, one micro-batch per file
    trips.filter(F.col("trip_key").cast("long") % 2 == 0).write.parquet(src + "/a")
    trips.filter(F.col("trip_key").cast("long") % 2 == 1).write.parquet(src + "/b")
    stream = spark.readStream.schema(trips.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    q = start_line_net_stream(stream, fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001),
                              out, shared_dir(spark, "test-stream-ckpt"), out + "-rejects", key_cols=fx.GRID_KEY,
                              available_now=True)
    q.awaitTermination(300)
    res = spark.read.parquet(out)
    assert spark.read.parquet(out + "-rejects").count() == 0
    tot = res.groupBy("uuid").agg(F.first("distance").alias("d")).agg(F.count("*").alias("n"), F.sum("d").alias("s")).collect()[0]
    assert res.count() == 28558
    assert (tot.n, tot.s) == (1500, 35086870)


def test_restart_loses_and_doubles_nothing(spark):
    """Two runs with one checkpoint, files arriving in between; equal rows without a key stay apart."""
    src, out, ckpt, bad = (shared_dir(spark, f"test-restart-{n}") for n in ("in", "out", "ckpt", "bad"))
    trips = fx.grid_trips(spark, SF001, broken=True).drop("trip_key").limit(40)
    ls, locs = fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001)
    schema = trips.schema
    for part in ("a", "b"):
        trips.write.parquet(f"{src}/{part}")
        stream = spark.readStream.schema(schema).parquet(src + "/*")
        start_line_net_stream(stream, ls, locs, out, ckpt, bad, available_now=True).awaitTermination(300)
    res, rejects = spark.read.parquet(out), spark.read.parquet(bad)
    batch = build_line_net(trips.unionByName(trips), ls, locs)
    set_aside = unresolved_hops(trips.unionByName(trips), ls, locs)
    assert res.count() == batch.count() and rejects.count() == set_aside.count()
    assert res.select("uuid").distinct().count() == batch.select("uuid").distinct().count()
