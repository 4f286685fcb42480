"""Schemas of the inputs, the intermediate rows and the 19-column result."""

from pyspark.sql import types as T

# One element of a trip plan (``lines_result`` JSON text). ``lineName`` is optional: a missing
# value means "same line as the previous element".
HOP_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField("lineName", T.StringType()),
            T.StructField("stationName", T.StringType()),
            T.StructField("stationCode", T.StringType()),
        ]
    )
)

# Station-list payload: {"lines": [{"lineName": ..., "stages": [{"stageId": ..., "stageName": ...}]}]}
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField(
            "lines",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("lineName", T.StringType()),
                        T.StructField(
                            "stages",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("stageId", T.StringType()),
                                        T.StructField("stageName", T.StringType()),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

# Trip plans as stored (names fixed by the producer of the files).
TRIP_COLUMNS = [
    ("line_name", "string"),
    ("stage_id", "string"),
    ("stage_name", "string"),
    ("end_line_name", "string"),
    ("end_stage_id", "string"),
    ("end_stage_name", "string"),
    ("count", "int"),
    ("price", "int"),
    ("spend_time", "string"),
    ("lines_result", "string"),
]
TRIP_NAME_COLUMNS = ["line_name", "stage_name", "end_line_name", "end_stage_name"]

# Ordered station list of every line; ``num`` is the 0-based position on the line.
LINE_STATIONS_SCHEMA = T.StructType(
    [
        T.StructField("route", T.StringType()),
        T.StructField("num", T.IntegerType()),
        T.StructField("station", T.StringType()),
        T.StructField("station_id", T.StringType()),
    ]
)

LOCATION_COLUMNS = ["route_name", "station_name", "longitude", "latitude"]

# The result: one row per (trip, leg, station passed).
RESULT_COLUMNS = [
    "uuid",
    "from_route_name",
    "from_station_id",
    "from_station_name",
    "dest_route_name",
    "dest_station_id",
    "dest_station_name",
    "distance",
    "count",
    "price",
    "spend_time",
    "transfer_code",
    "transfer_order",
    "transfer_route_name",
    "transfer_station_name",
    "sub_station_num",
    "sub_station_name",
    "longitude",
    "latitude",
]
