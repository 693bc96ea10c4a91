"""Bounded and streaming scans of landing, raw, bronze and message topics."""

from tierline.sources.evolve import header_lines, hinted_schema, read_evolving
from tierline.sources.files import landing_files, read_files, stream_files
from tierline.sources.layers import read_bronze, read_raw, stream_raw
from tierline.sources.messages import message_stream

__all__ = [
    "header_lines",
    "hinted_schema",
    "landing_files",
    "message_stream",
    "read_bronze",
    "read_evolving",
    "read_files",
    "read_raw",
    "stream_files",
    "stream_raw",
]
