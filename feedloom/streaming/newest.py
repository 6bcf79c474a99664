"""R1/T4 as streaming state: each user's newest rows, kept up to date by the stream.

A stateful operator holds, per user, the newest ``n`` (time, tid) - one tid a second, the
largest, as the upsert would leave them - and emits the user's page whenever it changes.
The state of a user is bounded by n, and a state TTL can clear users who got nothing for
the rows' own time to live (expired rows of a page leave at the read).  A user who receives everything is no hot key: every task
first cuts its rows to n per user, so n rows per task and user reach the state."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedloom.config import FEED_READ_SIZE
from feedloom.streaming.fanout_stream import drained

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROWS = "uid bigint, time timestamp_ntz, tid bigint"


def newest_rows(rows: pd.DataFrame, n: int) -> pd.DataFrame:
    """Per uid the newest n seconds, the largest tid of each; newest first."""
    rows = rows.sort_values(["uid", "time", "tid"], ascending=[True, False, False])
    rows = rows.drop_duplicates(["uid", "time"])
    return rows.groupby("uid", sort=False).head(n)


def newest_of_task(parts: Iterable[pd.DataFrame], n: int, least: int = 1 << 18) -> Iterator[pd.DataFrame]:
    """Per uid the newest n seconds of all ``parts``.

    Parts are gathered until they are as many rows as those held (``least`` at least) and then
    cut at once: a row is sorted a few times, not once for every part that follows it.  Never
    more than twice n rows a user, or ``least``, are held."""
    held, more, rows = None, [], 0
    for part in parts:
        more.append(part)
        rows += len(part)
        if rows >= max(least, 0 if held is None else len(held)):
            held = newest_rows(pd.concat(more if held is None else [held, *more], ignore_index=True), n)
            more, rows = [], 0
    if more:
        held = newest_rows(pd.concat(more if held is None else [held, *more], ignore_index=True), n)
    if held is not None:
        yield held


class NewestN(StatefulProcessor):
    """Page of one user: micros since the epoch and tid of its rows, newest first."""

    def __init__(self, n: int, ttl_seconds: int | None):
        self.n, self.ttl_ms = n, ttl_seconds and ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.page = handle.getValueState("page", "micros array<bigint>, tids array<bigint>", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        (uid,) = key
        have = self.page.get() if self.page.exists() else None
        parts = [pd.DataFrame({"uid": uid, "time": pd.to_datetime(pd.Series(have[0], dtype="int64"), unit="us"), "tid": have[1]})] \
            if have else []
        for part in rows:
            parts = [newest_rows(pd.concat([*parts, part], ignore_index=True), self.n)]
        page = parts[0]
        micros = page["time"].astype("datetime64[us]").astype("int64").tolist()
        tids = page["tid"].astype("int64").tolist()
        if have and [*have[0]] == micros and [*have[1]] == tids:
            return
        self.page.update((micros, tids))
        yield pd.DataFrame({"uid": uid, "time": page["time"], "tid": tids})

    def close(self) -> None:
        pass


def newest_pages(inbox: DataFrame, n: int = FEED_READ_SIZE, ttl_seconds: int | None = None) -> DataFrame:
    """Stream of pages (uid, time, tid): all rows of every page that a micro-batch changed.

    ``ttl_seconds``: state of users who got nothing for so long is cleared, for streams that
    run on; such a stream has a micro-batch at each trigger and never drains."""
    few = inbox.select("uid", "time", "tid").mapInPandas(lambda parts: newest_of_task(parts, n), ROWS)
    return few.groupBy("uid").transformWithStateInPandas(
        statefulProcessor=NewestN(n, ttl_seconds), outputStructType=ROWS, outputMode="Update",
        timeMode="None" if ttl_seconds is None else "ProcessingTime")


def run_newest(spark: SparkSession, inbox: DataFrame, out: str, checkpoint: str, n: int = FEED_READ_SIZE,
               timeout_s: int = 900) -> DataFrame:
    """Drain ``inbox`` into the pages table at ``out``; the newest page of each user.

    A micro-batch writes its pages to a folder of its own, so a replay overwrites them; the
    page of a user is that of the last micro-batch that changed it."""
    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, STATE_STORE)
    try:
        drained(newest_pages(inbox, n).writeStream.outputMode("update")
                .foreachBatch(lambda df, b: df.write.mode("overwrite").parquet(f"{out}/batch_id={b}"))
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), timeout_s)
    finally:
        spark.conf.unset(PROVIDER) if old is None else spark.conf.set(PROVIDER, old)
    return last_pages(spark, out)


def last_pages(spark: SparkSession, out: str) -> DataFrame:
    pages = spark.read.schema(ROWS + ", batch_id bigint").parquet(out)
    last = pages.groupBy("uid").agg(F.max("batch_id").alias("batch_id"))      # pages are bounded: n rows
    return pages.join(last, ["uid", "batch_id"]).select("uid", "time", "tid")
