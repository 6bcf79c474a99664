"""feedloom: social-feed timeline fan-out expressed as Spark DataFrame plans.

Raw post JSON is parsed and validated, joined with follower edges, fanned out
on write into per-user timeline tables (normalized and denormalized layouts)
with keyed upserts and expiry, and read back as newest-N timelines for many
users in one job.  Every operator is a ``DataFrame -> DataFrame`` function, so
the batch entry points and the Structured Streaming ``foreachBatch`` body call
the very same code.
"""

from feedloom.config import FeedConfig

__all__ = ["FeedConfig"]
