"""Replay window as keyed streaming state.

Each producer has one state value: the highest sequence number seen and a
bitmap of the ``window`` numbers up to it (bit k: highest - k was seen), 24
bytes for a window of 128.  A micro-batch reads and writes the state of the
producers that it has rows of and no other, whatever the number of producers.
State lives in the configured state store (RocksDB), is versioned by batch and
checkpointed, so a batch that runs again starts from the same state.

Rules as in I4: a negative number, one at or below highest - window, or one
that was seen is refused with a reason; everything else is accepted and marked.
Within a micro-batch a producer's rows are taken in ``order_by`` order, for
which its task holds that producer's rows of that one batch: set the source's
rows per trigger accordingly, or use ``veilspark.streaming.replay.ReplayBatch``,
which divides even a single producer's batch over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from veilspark.params import DEFAULT_REPLAY_WINDOW
from veilspark.streaming.bounding import arrival_key, require_rocksdb_state

_STATE = T.StructType([T.StructField("highest", T.LongType(), False), T.StructField("seen", T.BinaryType(), False)])


class Window:
    """The window of one producer; ``check`` gives the reason to refuse a number, None to accept it."""

    def __init__(self, size: int, highest: int | None = None, seen: int = 0):
        self.size, self.highest, self.seen = size, highest, seen

    def check(self, seq: int | None) -> str | None:
        if seq is None:
            return "missing_seq"
        if seq < 0:
            return "negative_seq"
        if self.highest is None or seq > self.highest:
            shift = self.size if self.highest is None else seq - self.highest
            kept = self.seen << shift & (1 << self.size) - 1 if shift < self.size else 0
            self.highest, self.seen = seq, kept | 1
            return None
        age = self.highest - seq
        if age >= self.size:
            return "stale_seq"
        if self.seen >> age & 1:
            return "replayed_seq"
        self.seen |= 1 << age
        return None


class _ReplayWindow(StatefulProcessor):
    def __init__(self, seq: str, order_by: Sequence[str], window: int, columns: list[str], name: str):
        self.seq, self.order, self.window = seq, arrival_key(list(order_by)), int(window)
        self.make = Row(*columns, name)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("window", _STATE)

    def handleInputRows(self, key, rows, timerValues):
        window = Window(self.window)
        if self.state.exists():
            highest, seen = self.state.get()
            window = Window(self.window, highest, int.from_bytes(bytes(seen), "little"))
        before = window.highest, window.seen
        for row in sorted(rows, key=self.order):
            yield self.make(*row, window.check(row[self.seq]))
        if (window.highest, window.seen) != before:
            self.state.update((window.highest, window.seen.to_bytes(-(-self.window // 8), "little")))

    def close(self) -> None:
        pass


def stream_replay_filter(stream: DataFrame, producer: str, seq: str, order_by: Sequence[str],
                         window: int = DEFAULT_REPLAY_WINDOW, name: str = "reason") -> DataFrame:
    """Every row of the stream with its ``name`` (null = accepted); rows without producer have ``missing_producer``."""
    require_rocksdb_state(stream.sparkSession)
    known = stream.filter(F.col(producer).isNotNull())
    out = T.StructType([*stream.schema.fields, T.StructField(name, T.StringType(), True)])
    checked = known.groupBy(producer).transformWithState(
        statefulProcessor=_ReplayWindow(seq, order_by, window, stream.columns, name), outputStructType=out, outputMode="Append", timeMode="None")
    return checked.unionByName(stream.filter(F.col(producer).isNull()).withColumn(name, F.lit("missing_producer")))
