"""Streaming: the contract gate applied to every micro-batch."""

from quaystone.streaming.gate_stream import gate_batches  # noqa: F401
