"""lineweave: trip plans -> stations passed and trip distances, as Spark DataFrame jobs."""

from lineweave.plans import build_line_net, prepare_dims, unresolved_hops

__all__ = ["build_line_net", "prepare_dims", "unresolved_hops"]
