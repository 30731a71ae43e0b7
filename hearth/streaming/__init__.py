"""Structured Streaming front end for incremental loads."""

from hearth.streaming.incremental import landed_csv_stream, incremental_load
