"""Own sources with hooks (U2) as Python data sources.

Subclass :class:`SplitSource` and say what the source is made of::

    class Lines(SplitSource):
        columns = "n long, line string"
        def splits(self, options): return [...]              # batch: one task each
        def slices(self, options, start, end): return [...]  # stream: rows start .. end - 1
        def limit(self, options): return None                # stream: how many rows there are in all, None if no end
        def open(self, options, split): ...                  # in the task, before its first row; returns a handle
        def rows(self, handle, split): yield ...
        def close(self, handle): ...                         # in the task, after its last row or a failure

    spark.dataSource.register(Lines)
    spark.read.format("Lines").option(...).load()
    spark.readStream.format("Lines").option("rowsPerBatch", 100).load()

A split or slice is any small picklable value; Spark hands each to a task and
runs a lost one again, so ``rows`` must give the same rows for the same split.
A stream is cut by row numbers: its offset is the number of rows so far, kept
in the query's checkpoint, so a restarted query goes on where the last one
committed.  ``rowsPerBatch`` paces each micro-batch; ``rowsPerSecond`` paces by
the clock instead, at most as many rows as the seconds since the last batch allow.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType


class _Split(InputPartition):
    def __init__(self, value: Any):
        self.value = value


def _rows(source: SplitSource, split: Any) -> Iterator[tuple]:
    handle = source.open(source.options, split)
    try:
        yield from source.rows(handle, split)
    finally:  # also when the rows fail, or nobody asks for the rest
        source.close(handle)


class _Batch(DataSourceReader):
    def __init__(self, source: SplitSource):
        self.source = source

    def partitions(self):
        return [_Split(s) for s in self.source.splits(self.source.options)]

    def read(self, partition):
        return _rows(self.source, partition.value)


class _Stream(DataSourceStreamReader):
    def __init__(self, source: SplitSource):
        self.source, self.last, self.at = source, None, None
        options = source.options
        self.per_batch = int(options.get("rowsperbatch", options.get("rowsPerBatch", 0)))
        self.per_second = float(options.get("rowspersecond", options.get("rowsPerSecond", 0)))
        if not (self.per_batch or self.per_second):
            raise ValueError("a stream needs rowsPerBatch or rowsPerSecond")

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        before = self.last if self.last is not None else int(self.source.options.get("from", 0))
        if self.per_batch:
            now = before + self.per_batch
        else:
            clock = time.monotonic()
            now = before + int(self.per_second * (clock - self.at)) if self.at is not None else before
            if now > before or self.at is None:
                self.at = clock
        end = self.source.limit(self.source.options)
        self.last = max(before, now if end is None else min(now, end))
        return {"rows": self.last}

    def partitions(self, start: dict, end: dict):
        # After a restart the first batch begins at the committed offset, which may be beyond what this reader has counted.
        self.last = max(self.last or 0, end["rows"])
        return [_Split(s) for s in self.source.slices(self.source.options, start["rows"], end["rows"])]

    def read(self, partition):
        return _rows(self.source, partition.value)

    def commit(self, end: dict) -> None:
        pass


class SplitSource(DataSource):
    """See the module: what a source of one's own gives."""

    columns: str = ""

    @classmethod
    def name(cls) -> str:
        return cls.__name__

    def schema(self) -> str | StructType:
        return self.columns

    def reader(self, schema):
        return _Batch(self)

    def streamReader(self, schema):
        return _Stream(self)

    def splits(self, options: dict) -> list:
        raise NotImplementedError("no batch form")

    def slices(self, options: dict, start: int, end: int) -> list:
        raise NotImplementedError("no stream form")

    def limit(self, options: dict) -> int | None:
        return None

    def open(self, options: dict, split: Any) -> Any:
        return None

    def rows(self, handle: Any, split: Any) -> Iterator[tuple]:
        raise NotImplementedError

    def close(self, handle: Any) -> None:
        pass
