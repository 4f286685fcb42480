"""Streaming entry points."""

from lineweave.streaming.linenet_stream import start_line_net_stream

__all__ = ["start_line_net_stream"]
