"""Sources (S1-S8) and sinks."""

from tweetlake.sources.tables import table  # noqa: F401
