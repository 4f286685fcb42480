"""Sources and sinks: trip plans, coordinates, station lists (payload, pages, CSV)."""

from lineweave.sources.csv import read_line_stations_csv, read_line_stations_records, write_line_stations_csv
from lineweave.sources.locations import location_scan, read_locations
from lineweave.sources.markup import Selectors, line_stations_from_markup, markup_rejects
from lineweave.sources.pages import line_stations_from_pages
from lineweave.sources.payload import line_stations_from_payload, read_payload
from lineweave.sources.records import accepted, read_csv_records, rejected, typed_records
from lineweave.sources.trips import conform_trips, read_trips, trip_scan, trip_value_rejects

__all__ = [
    "Selectors",
    "accepted",
    "conform_trips",
    "line_stations_from_markup",
    "line_stations_from_pages",
    "line_stations_from_payload",
    "location_scan",
    "markup_rejects",
    "read_csv_records",
    "read_line_stations_csv",
    "read_line_stations_records",
    "read_locations",
    "read_payload",
    "read_trips",
    "rejected",
    "trip_scan",
    "trip_value_rejects",
    "typed_records",
    "write_line_stations_csv",
]
