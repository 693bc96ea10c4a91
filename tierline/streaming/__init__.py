"""Streaming runs: intake of new files, promotion of streams, message pipelines, and their control."""

from tierline.streaming.control import run_streams
from tierline.streaming.intake import Intake, ingest_new_files
from tierline.streaming.promote import stream_bronze

__all__ = ["Intake", "ingest_new_files", "run_streams", "stream_bronze"]
