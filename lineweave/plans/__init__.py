"""Whole-job plans."""

from lineweave.plans.linenet import (
    GAP_MODES,
    LineNetDims,
    build_line_net,
    hop_legs,
    line_net_frame,
    prepare_dims,
    project_result,
    split_frame,
    unresolved_hops,
    write_line_net,
    write_line_net_frame,
)
from lineweave.plans.stored import store_trips, stored_line_net

__all__ = [
    "GAP_MODES",
    "LineNetDims",
    "build_line_net",
    "hop_legs",
    "line_net_frame",
    "prepare_dims",
    "project_result",
    "split_frame",
    "store_trips",
    "stored_line_net",
    "unresolved_hops",
    "write_line_net",
    "write_line_net_frame",
]
