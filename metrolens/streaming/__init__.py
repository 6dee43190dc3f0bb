"""The batch operators over a file stream.

The reference has no streaming source. Operators that need no global sort or
rank (``share_by``, ``group_count``, ``conditional_count``, ``group_sum``)
work unchanged on a streaming DataFrame; this module wires one of them to a
directory of Parquet files and a sink, with the streaming checkpoint kept
under the shared checkpoint folder.
"""

from metrolens.streaming.incremental import read_latest, read_parquet_stream, run_available, street_share_stream

__all__ = ["read_latest", "read_parquet_stream", "run_available", "street_share_stream"]
