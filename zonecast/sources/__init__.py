"""Raw trip formats and table sinks."""

from zonecast.sources.registry import read_history, register_source, source

__all__ = ["read_history", "register_source", "source"]
