"""Structured Streaming adapters.

The reference has no streaming operator.  Every puzzle / scalar operator
here is row-local (no state), so the same column expressions run on a
stream unchanged; this module wires them to ``readStream``/``writeStream``.
"""

from scoutlab.streaming.features import stream_puzzle_features

__all__ = ["stream_puzzle_features"]
