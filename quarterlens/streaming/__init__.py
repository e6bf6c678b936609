"""Incremental staging of append-only bronze tables with Structured Streaming.

The original model is batch-only (full rebuild).  The stateless staging
operators (casts, renames, the missing-tier flag) apply unchanged to a file
stream, so new bronze files can be staged as they land; de-duplication and
every metric remain batch rebuilds.
"""

from quarterlens.streaming.incremental import (  # noqa: F401
    STREAMABLE,
    stage_stream,
)
