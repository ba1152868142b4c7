"""The stateless part of prepare on streaming sources."""

from sftforge.streaming.incremental import clean_stream, start_clean_stream

__all__ = ["clean_stream", "start_clean_stream"]
