"""Flush tick on a stream (W2): partial counts that leave by processing time.

Keyed by word with one counter and one timer.  The first row of a word after a
flush sets a timer ``seconds`` ahead; until it fires the word only counts.  When
it fires, the count goes out as one row and the state is gone, so the store holds
the words seen since their last flush and nothing else, and a word that many
rows repeat sends one row a tick.  Rows are counted per Arrow batch before the
shuffle, so a hot word ships one row for each batch.

Chained behind W1 and before W3 this is the word counter's stage in one query:
``stream_bound_contributions`` -> ``stream_partial_counts`` -> ``StreamRelease(cnt="cnt")``.
"""

from __future__ import annotations

import time

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from veilspark.streaming.bounding import require_rocksdb_state


class _FlushCounts(StatefulProcessor):
    def __init__(self, key: str, cnt: str, seconds: float):
        self.make, self.wait = Row(key, cnt), max(1, int(seconds * 1000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", T.StructType([T.StructField("n", T.LongType(), False)]))

    def handleInputRows(self, key, rows, timerValues):
        n = sum(row["__n"] for row in rows)
        if self.count.exists():
            n += self.count.get()[0]
        else:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)
        self.count.update((n,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n = self.count.get()[0]
        self.count.clear()
        yield self.make(key[0], n)

    def close(self) -> None:
        pass


def _batch_counts(batches):
    for batch in batches:
        if batch.num_rows:
            counted = batch.column(0).value_counts()
            yield pa.RecordBatch.from_arrays([counted.field(0), counted.field(1).cast(pa.int64())], names=[batch.schema.names[0], "__n"])


def stream_partial_counts(stream: DataFrame, key: str, seconds: float = 2.0, cnt: str = "cnt") -> DataFrame:
    """(key, cnt) rows, each a key's rows since its last flush; a key that is null is counted like any other."""
    require_rocksdb_state(stream.sparkSession)
    kind = stream.schema[key].dataType
    counted = stream.select(key).mapInArrow(_batch_counts, T.StructType([T.StructField(key, kind, True), T.StructField("__n", T.LongType(), False)]))
    return counted.groupBy(key).transformWithState(
        statefulProcessor=_FlushCounts(key, cnt, seconds),
        outputStructType=T.StructType([T.StructField(key, kind, True), T.StructField(cnt, T.LongType(), False)]),
        outputMode="Append", timeMode="ProcessingTime")


def drain(query, batches: int, timeout: float = 600.0) -> None:
    """Wait until a query has run ``batches`` micro-batches and its last stateful operator holds nothing, then stop it.

    For bounded inputs (tests, backfills): a stream in production runs on.
    """
    try:
        until = time.monotonic() + timeout
        while time.monotonic() < until:
            if query.exception():
                raise query.exception()
            last = query.lastProgress
            if last and last["batchId"] >= batches and last["stateOperators"] and last["stateOperators"][0]["numRowsTotal"] == 0:
                return
            time.sleep(0.3)
        raise TimeoutError("state was not flushed in time")
    finally:
        query.stop()
