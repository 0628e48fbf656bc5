"""The pipeline driven incrementally by Structured Streaming."""

from tierlake.streaming.incremental import new_files_stream, start_incremental

__all__ = ["new_files_stream", "start_incremental"]
