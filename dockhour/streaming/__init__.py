"""The demand count (D0) as a Structured Streaming query."""
from .demand_stream import demand_counts_stream, start_demand_sink

__all__ = ["demand_counts_stream", "start_demand_sink"]
