"""Structured Streaming layer jobs (available-now, checkpointed)."""

from strata.streaming.chain import start_table_stream, stream_dedup
from strata.streaming.ingest import run_available_now, run_together, start_together, start_validated_ingest

__all__ = ["run_available_now", "run_together", "start_table_stream", "start_together", "start_validated_ingest", "stream_dedup"]
