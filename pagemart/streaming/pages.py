"""The same pipeline as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from pagemart.functions.urls import url_key
from pagemart.plans import load
from pagemart.sources.store import Store


def page_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 64) -> DataFrame:
    """Pages of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def first_of_url(pages: DataFrame, url_col: str = "url", ts_col: str | None = None, late: str = "1 hour") -> DataFrame:
    """One page for each canonical URL; with an event time, its memory ends with the watermark."""
    keyed = pages.withColumn("url_key", url_key(F.col(url_col)))
    if ts_col:
        return keyed.withWatermark(ts_col, late).dropDuplicatesWithinWatermark(["url_key"])
    return keyed.dropDuplicates(["url_key"])


def run(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Merges what there is, batch by batch, and stops. A batch that is run again merges to the same."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def until_lost(query: StreamingQuery, message: str = "") -> bool:
    """Waits for a stream; True if it ended, False if it failed with a message that holds this one. Other failures are raised."""
    try:
        query.awaitTermination()
    except Exception as e:
        if not message or message not in str(e):
            raise
        return False
    return True


def load_records(store: Store, kind: str, name: str, records: Callable[[DataFrame], DataFrame], aside: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A merge that loads each batch's records as one version of a store.

    The version keeps the batch's number under the stream's name, so a batch that
    is run again, because the stream was lost before it noted the batch, is known and left
    out unread; one that was lost between two tables has no version, and is loaded whole.
    """

    def merge(batch: DataFrame, number: int) -> None:
        if store.version_of(name, number) is None:  # else it is not read at all
            load.into_store(store, kind, records(batch), (name, number), aside)

    return merge


def with_quarantine(good_sink: Callable[[DataFrame, int], None], bad_sink: Callable[[DataFrame, int], None], errors: str = "errors") -> Callable[[DataFrame, int], None]:
    """A merge that sends rows with errors aside and goes on with the rest."""

    def merge(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            bad_sink(batch.where(F.size(errors) > 0), number)
            good_sink(batch.where(F.size(errors) == 0).drop(errors), number)
        finally:
            batch.unpersist()

    return merge


class _Waiting(StatefulProcessor):
    """Rows of one dependency, kept until it is there, or until a timer says that they have waited long enough."""

    #: Rows that are put into the list at a time.
    PIECE = 4096

    def __init__(self, dependency: str, payload: str, expires_ms: int | None):
        self.out, self.expires_ms = Row(dependency, payload, "expired"), expires_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.there = handle.getValueState("there", "there boolean")
        self.waiting = handle.getListState("waiting", "payload string")

    def _released(self, key, expired: bool) -> Iterator[Row]:
        """What waits, and no state of it after."""
        some = False
        for (payload,) in self.waiting.get():
            some = True
            yield self.out(key, payload, expired)
        if some:
            self.waiting.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """rows(dependency, payload, loaded). What arrives in a batch with its dependency does not become state; each call of a state is a
        message to the JVM, so there are as few for a key as can be.
        """
        there, new, piece = self.there.exists(), False, []
        for _, payload, loaded in rows:
            if loaded:
                if not there:
                    there = True
                    self.there.update((True,))
                    yield from self._released(key[0], False)
                    yield from (self.out(key[0], x, False) for (x,) in piece)
                    piece = []
            elif there:
                yield self.out(key[0], payload, False)
            else:
                piece.append((payload,))
                if len(piece) == self.PIECE:
                    self.waiting.appendList(piece)
                    new, piece = True, []
        if piece:
            self.waiting.appendList(piece)
            new = True
        if self.expires_ms is None:
            return
        if there:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        elif new:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.expires_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._released(key[0], True)

    def close(self) -> None:
        pass


#: Keeps state on the executors' disks, with a log in the checkpoint; release_waiting needs it.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def release_waiting(events: DataFrame, dependency: str, payload: str, loaded: str, expires_ms: int | None = None) -> DataFrame:
    """(dependency, payload, expired): rows wait until a row of their dependency with `loaded` has arrived.

    Rows whose dependency is there pass at once. Others wait in a list of their
    dependency, a state row each, which is given out and cleared when it arrives; all
    that stays is that it has. With expires_ms, what has waited that long is given out
    as expired by a timer, and leaves no state; without, rows wait as long as it takes.
    Rows with a null dependency wait for a row with a null one.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    kind = events.schema[dependency].dataType.simpleString()
    rows = events.select(dependency, F.col(payload).cast("string").alias(payload), F.coalesce(F.col(loaded), F.lit(False)).alias(loaded))
    return rows.groupBy(dependency).transformWithState(_Waiting(dependency, payload, expires_ms), f"{dependency} {kind}, {payload} string, expired boolean", "append", "None" if expires_ms is None else "ProcessingTime")
