"""DataFrame-in, DataFrame-out operators; each can be used alone or through the pipeline."""

from lineweave.operators.collect import collect_trip_stations
from lineweave.operators.dedupe import keep_first
from lineweave.operators.dims import (
    attach_coordinate_variants,
    attach_coordinates,
    clean_line_stations,
    clean_locations,
    dedupe_coordinates,
    first_station_per_line,
    line_profile,
)
from lineweave.operators.distance import (
    bridge_missing_coordinates,
    exact_trip_distance,
    leg_distance,
    segment_distance,
    trip_distance,
    trip_distance_exact,
    with_exact_distance,
    with_trip_distance,
)
from lineweave.operators.elements import plan_elements
from lineweave.operators.fold import fold_hops
from lineweave.operators.hops import (
    carry_forward_route,
    dedupe_hop_stations,
    explode_hops,
    prepare_trips,
    trip_identity,
)
from lineweave.operators.legs import (
    expand_hop_stations,
    leg_destinations,
    leg_slices,
    leg_stations,
    line_arrays,
    resolved_legs,
    transfer_stations,
)
from lineweave.operators.profile import line_profile_split

__all__ = [
    "attach_coordinate_variants",
    "attach_coordinates",
    "bridge_missing_coordinates",
    "carry_forward_route",
    "clean_line_stations",
    "clean_locations",
    "collect_trip_stations",
    "dedupe_coordinates",
    "dedupe_hop_stations",
    "exact_trip_distance",
    "expand_hop_stations",
    "explode_hops",
    "first_station_per_line",
    "keep_first",
    "leg_destinations",
    "fold_hops",
    "leg_distance",
    "leg_slices",
    "leg_stations",
    "line_arrays",
    "line_profile",
    "line_profile_split",
    "plan_elements",
    "prepare_trips",
    "resolved_legs",
    "segment_distance",
    "transfer_stations",
    "trip_distance",
    "trip_distance_exact",
    "trip_identity",
    "with_exact_distance",
    "with_trip_distance",
]
