"""Rate limit of a stream of requests, exact for every request."""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ramparts.operators.rate import WINDOW_MS, is_counted
from ramparts.operators.series import LATENESS, timed

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RATES = "clientip string, ts_ms bigint, window_count bigint"


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started within keep their state in RocksDB, which state with timers needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def window_counts(moments: list[tuple[int, int]], fresh: list[int], window_ms: int) -> Iterator[tuple[int, int]]:
    """(moment, requests in (moment - window, moment]) of the moments whose window holds one of ``fresh``.

    Both lists are sorted; ``moments`` has (moment, requests) and holds all that the windows reach back to.
    """
    total, oldest = 0, 0
    for moment, n in moments:
        total += n
        while moments[oldest][0] <= moment - window_ms:
            total -= moments[oldest][1]
            oldest += 1
        newest = bisect_right(fresh, moment)
        if newest and fresh[newest - 1] > moment - window_ms:
            yield moment, total


class RateRing(StatefulProcessor):
    """The requests of one client by millisecond, as far back as a window that can still change.

    State is a count for each millisecond with a request, so no more than the window and the lateness have
    milliseconds, however many requests come. It is one value, read and written once for each micro-batch that the client is
    seen in: a call for each millisecond would cost more than all the rest. What the watermark has left behind by a
    whole window goes when the client is next seen, or by a timer. A client with state has one timer, at or before
    the moment its state may go.
    """

    def __init__(self, window_ms: int):
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", "moments binary")

    def _kept(self, state: tuple | None, fresh: Counter[int], watermark: int) -> list[tuple[int, int]]:
        """Stored and fresh moments with their requests, in order, without those that no window needs any more."""
        packed = array("q", state[0] if state else b"")
        counts = Counter(dict(zip(packed[::2], packed[1::2])))
        counts.update(fresh)
        return sorted((moment, n) for moment, n in counts.items() if moment > watermark - self.window_ms)

    def _keep(self, kept: list[tuple[int, int]]) -> None:
        self.ring.update((array("q", chain.from_iterable(kept)).tobytes(),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh: Counter[int] = Counter()
        for row in rows:
            fresh[row.ts_ms] += row.n
        state = self.ring.get()
        kept = self._kept(state, fresh, timerValues.getCurrentWatermarkInMs())
        self._keep(kept)
        if state is None:
            self.handle.registerTimer(max(fresh) + self.window_ms)
        for moment, count in window_counts(kept, sorted(fresh), self.window_ms):
            yield Row(clientip=key[0], ts_ms=moment, window_count=count)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = self._kept(self.ring.get(), Counter(), timerValues.getCurrentWatermarkInMs())
        if kept:
            self._keep(kept)
            self.handle.registerTimer(kept[-1][0] + self.window_ms)
        else:
            self.ring.clear()
        return iter([])

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = pa.Table.from_batches([batch]).group_by(["clientip", "ts_ms"]).aggregate([([], "count_all")])
        yield from counts.rename_columns(["clientip", "ts_ms", "n"]).to_batches()


def stream_request_rates(stream: DataFrame, window_ms: int = WINDOW_MS, lateness: str = LATENESS) -> DataFrame:
    """(clientip, ts_ms, window_count): how many counted requests a client's request of that moment finds in its window,
    itself included, as ``rate.client_rates`` has them.

    For a stream in update mode: a moment comes again when requests that arrive later lie in its window, and its last count
    holds, however the input is cut into micro-batches. Requests of one client and millisecond are summed before the
    shuffle. Start the stream under ``rocksdb``.
    """
    counted = stream.filter(is_counted()).select("clientip", "ts_ms")
    moments = timed(counted.mapInArrow(_combined, "clientip string, ts_ms bigint, n bigint"), lateness)
    return moments.groupBy("clientip").transformWithState(RateRing(window_ms), RATES, "Update", "EventTime")
