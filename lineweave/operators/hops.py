"""Trip identity and hop rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineweave.functions.names import canonicalize
from lineweave.functions.text import is_json_array
from lineweave.schemas import HOP_SCHEMA, TRIP_COLUMNS, TRIP_NAME_COLUMNS

TRIP_ATTRS = [n for n, _ in TRIP_COLUMNS if n != "lines_result"]
#: Equal rows that one task numbers at once.
COPIES = 4096
#: Trips of one task: the legs of that many, with all that was looked up for them, are sorted in some 200 MB.
TASK_TRIPS = 1 << 15
_KEY_SEP = "\u0001"
_NULL_MARK = "\u0000"


def identity_hash(cols: Sequence[str]):
    """sha2-256 over the columns as text; nulls are marked so that null and '' differ."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(_NULL_MARK)) for c in cols]
    return F.sha2(F.concat_ws(_KEY_SEP, *parts), 256)


def trip_identity(df: DataFrame, key_cols: Sequence[str] | None = None, out: str = "trip_id") -> DataFrame:
    """Deterministic trip id, shared by every hop of the plan row.

    ``key_cols``: a natural key, unique per trip (the job sets rows that share one aside, see
    :func:`mark_shared_ids`). Without it, ``trip_pos`` (file + row
    index, see :func:`lineweave.sources.read_trips`) joins the plan columns when present, which
    needs no shuffle; otherwise identical rows are counted with partial sums and numbered, one trip per
    row. Numbers are dealt out in blocks of ``COPIES``: the blocks of a plan that fills a third of the rows
    are spread over all tasks before they become rows.
    """
    if key_cols is not None:
        return df.withColumn(out, identity_hash(key_cols))
    plan = [n for n, _ in TRIP_COLUMNS if n in df.columns]
    if "trip_pos" in df.columns:
        return df.withColumn(out, identity_hash([*plan, "trip_pos"]))
    return _numbered(df).withColumn(out, identity_hash([*plan, "_copy"])).drop("_copy")


def _numbered(df: DataFrame) -> DataFrame:
    """The rows of ``df`` with ``_copy``, a number from 1 among equal rows."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    few = copies.where(F.col("_copies") <= COPIES).select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
    many = copies.where(F.col("_copies") > COPIES)
    blocks = many.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {COPIES}"))))
    # A number of partitions is named, or adaptive execution would put the (few, small) blocks into one task.
    blocks = blocks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*df.columns, "_block"))
    first = F.col("_block") * COPIES
    numbers = F.sequence(first + 1, F.least(first + COPIES, F.col("_copies")))
    return few.unionByName(blocks.select(*df.columns, F.explode(numbers).alias("_copy")))


def mark_shared_ids(trips: DataFrame) -> DataFrame:
    """Adds ``_shared``: the row's ``trip_id`` belongs to several rows (the given key isn't unique).

    For trips partitioned by the id: a count inside the partition, no further shuffle.
    """
    return trips.withColumn("_shared", F.count(F.lit(1)).over(Window.partitionBy("trip_id")) > 1)


def task_count(rows: int, task_rows: int = TASK_TRIPS) -> int:
    """Tasks for ``rows`` trips, so that a task stays the same whatever the input."""
    return max(1, -(-rows // task_rows))


def by_trip(trips: DataFrame, rows: int, task_rows: int = TASK_TRIPS) -> DataFrame:
    """``trips`` hash-partitioned on ``trip_id``, at most about ``task_rows`` of ``rows`` trips in a task.

    Plans are short text, but their legs are many times as wide. Adaptive execution sees the text alone and would
    merge partitions until a task's sorts no longer fit, so from two tasks on their number is named.
    """
    tasks = task_count(rows, task_rows)
    if tasks == 1:
        return trips.repartition("trip_id")
    return trips.repartition(max(tasks, trips.sparkSession.sparkContext.defaultParallelism), "trip_id")


def prepare_trips(trips: DataFrame, key_cols=None, extra_aliases=None) -> DataFrame:
    """Attach ``trip_id`` (hashed from the raw columns) and clean the name columns."""
    return clean_trip_names(trip_identity(trips, key_cols), extra_aliases)


def clean_trip_names(trips: DataFrame, extra_aliases=None) -> DataFrame:
    return canonicalize(trips, TRIP_NAME_COLUMNS, extra_aliases)


def explode_hops(trips: DataFrame, keep_empty: bool = False, extra_aliases=None) -> DataFrame:
    """One row per JSON plan element: ``hop`` (0-based), ``route_raw`` (cleaned ``lineName``,
    null when absent or JSON null), ``station`` (cleaned), ``code`` (as text).

    Text that is not a JSON array, or does not parse, yields no hops (see ``unresolved_hops``).
    ``keep_empty``: a trip whose plan is null keeps one row with hop 0 and null hop fields; ``[]``
    and unusable text give no row either way.
    """
    text = F.col("lines_result")
    plan = F.when(is_json_array(text), F.from_json(text, HOP_SCHEMA))
    if keep_empty:
        none = F.lit(None).cast(HOP_SCHEMA.elementType)
        plan = F.when(text.isNull(), F.array(none)).otherwise(plan)
    gen = F.posexplode(plan)
    keep = [c for c in trips.columns if c != "lines_result"]
    exploded = trips.select(*keep, gen.alias("hop", "h"))
    hops = exploded.select(
        *keep,
        F.coalesce(F.col("hop"), F.lit(0)).cast("int").alias("hop"),
        F.col("h.lineName").alias("route_raw"),
        F.col("h.stationName").alias("station"),
        F.col("h.stationCode").alias("code"),
    )
    return canonicalize(hops, ["route_raw", "station"], extra_aliases)


def trip_window():
    return Window.partitionBy("trip_id").orderBy("hop")


def whole_trip():
    """All hops of the trip. In their order, so that one sort serves these windows and the running ones."""
    return trip_window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def carry_forward_route(hops: DataFrame) -> DataFrame:
    """``route``: the hop's line, or the nearest earlier hop's line when absent."""
    w = trip_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hops.withColumn("route", F.last("route_raw", ignorenulls=True).over(w))


def dedupe_hop_stations(hops: DataFrame) -> DataFrame:
    """Drop a hop whose (route, station) already occurred earlier in the same trip.

    The earliest hop survives as a whole, so its leg stays complete: a minimum over the trip's
    rows of the same (route, station), inside the trip's partition and without any list.
    """
    first = F.min("hop").over(Window.partitionBy("trip_id", "route", "station"))
    return hops.withColumn("_first", first).filter(F.col("hop") == F.col("_first")).drop("_first")
