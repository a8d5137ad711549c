"""Structured Streaming entry points."""

from cdrflow.streaming.mediation_stream import (
    admitted_stream,
    mediation_batch_writer,
    run_until_done,
    start_mediation_stream,
)

__all__ = ["admitted_stream", "mediation_batch_writer", "run_until_done", "start_mediation_stream"]
