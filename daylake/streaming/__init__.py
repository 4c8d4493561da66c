"""Streaming form of the bronze CDC load.

The reference has no streaming: its increment is "the files of day X",
picked by a date window. ``stream_to_bronze`` runs the same load as a
Structured Streaming file source, so new change files are found by the
source's own log instead of by a window chosen by hand.
"""

from daylake.streaming.cdc import stream_to_bronze

__all__ = ["stream_to_bronze"]
