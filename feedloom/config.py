"""Run configuration: a plain dataclass with defaults (no external config file)."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values that the served timelines depend on.
PAGE_STEP = 5          # a page request for n < PAGE_CAP rows shows n + PAGE_STEP rows
PAGE_CAP = 50          # from PAGE_CAP rows on, n is used as is (no upper bound)
FEED_READ_SIZE = 20    # newest rows per user in the layout comparison reads
TWITTER_TIME_FORMAT = "EEE MMM dd HH:mm:ss Z yyyy"   # created_at as delivered
STORE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ssZ"           # created_at as stored (1 s resolution)
LOCAL_TIME_FORMAT = "EEE MMM dd HH:mm:ss"            # rendered timeline time
LOCAL_TIME_ZONE = "America/New_York"
PROFILE_URL_PREFIX = "https://twitter.com/"


@dataclass(frozen=True)
class FeedConfig:
    """Switches and parameters of the fan-out job and the timeline reads.

    ``layout``  "norm" (inboxes/homepages hold tweet ids) or "denorm"
                (feedslists/historytweets hold the raw payload).
    ``store``   "set" (distinct follower sets, listener injected) or
                "list" (edge rows as delivered, duplicates kept, no listener).
    ``policy``  "upsert": one row per (uid, time), largest tid wins;
                "keep_all": rows keyed by (uid, time, tid).
    """

    n_users: int = 100_000            # user ids are folded into [0, n_users)
    ttl_seconds: int = 7 * 24 * 3600  # row expiry relative to ingest_ts
    listener: int | None = 0          # user who joins every existing follower set
    layout: str = "norm"
    store: str = "set"
    policy: str = "upsert"
    language: str | None = "en"       # keep only tweets in this language (None: all)
    local_tz: str = LOCAL_TIME_ZONE
    default_name: str = "unknown"     # username shown when the user has none
    profile_prefix: str = PROFILE_URL_PREFIX
    as_of: str = "2024-01-31 00:00:00"  # clock for expiry; always an argument
    # Fan-out skew guard: an author whose tweets times receivers exceed this many
    # rows is split over so many tasks that each makes about this many.
    skew_split_rows: int = 2_000_000
    # Largest side (in estimated bytes) broadcast when its size is measured or
    # bounded (a cached micro-batch, the ids of the requested pages).
    broadcast_bytes: int = 64 * 1024 * 1024
    # Size of the Bloom filter of an id set that is too large to be broadcast (1 MB).
    bloom_bits: int = 1 << 23
    # Parts of the delivery table, by author; a micro-batch reads those of its authors.
    author_buckets: int = 64

    def with_(self, **kw) -> "FeedConfig":
        return replace(self, **kw)

    def __post_init__(self):
        if self.layout not in ("norm", "denorm"):
            raise ValueError(f"layout must be norm|denorm, got {self.layout!r}")
        if self.store not in ("set", "list"):
            raise ValueError(f"store must be set|list, got {self.store!r}")
        if self.policy not in ("upsert", "keep_all"):
            raise ValueError(f"policy must be upsert|keep_all, got {self.policy!r}")
        if self.n_users <= 0:
            raise ValueError("n_users must be positive")
