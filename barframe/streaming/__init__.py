"""Structured Streaming form of the clean → enrich → yearly plan."""

from barframe.streaming.ingest import (  # noqa: F401
    clean_enriched_stream,
    read_yearly,
    run_available,
    start_clean_sink,
    start_yearly_sink,
    stream_landed_bars,
    yearly_stream,
)
