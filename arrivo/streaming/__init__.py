"""Incremental landing with Structured Streaming.

The reference is a monthly batch that skips files it has already landed
(S5) and writes one folder per run date (S18).  A file stream with an
``availableNow`` trigger is the Spark form of that: each run processes only
files not yet recorded in the stream's checkpoint, then stops.
"""

from arrivo.streaming.landing import land_new_files
from arrivo.streaming.status import land_with_status

__all__ = ["land_new_files", "land_with_status"]
