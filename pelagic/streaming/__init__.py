"""Structured Streaming entry points reusing the batch operators."""

from pelagic.streaming.incremental import depth_bin_stream, qc_stream, start_depth_bin_stream  # noqa: F401
