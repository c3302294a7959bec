"""Helpers that the operators of this subpackage share.

Python work on texts goes through :func:`add_columns`: Arrow batches come in,
are cut to slices of a few MB so that very long texts never pile up in one
worker, and leave with new columns beside the old ones.  Spark decides which
task gets which rows; nothing here holds more than one slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Recent(dict):
    """A mapping that computes what is missing and keeps about the last ``limit`` to ``2 * limit`` keys.

    When the younger half is full it becomes the older half; a key found there
    moves back.  Keys longer than ``longest`` (0: keys have no length) are
    computed and not kept, so memory is bounded whatever the texts hold.
    """

    def __init__(self, compute: Callable, limit: int = 150_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest, self.old = compute, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key, self)
        if value is self:
            value = self.compute(key)
            if self.longest and len(key) > self.longest:
                return value
        self.trim()
        self[key] = value
        return value

    def trim(self) -> None:
        """Makes the younger half the older one if it is full."""
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()


def slices(batch: pa.RecordBatch, column: int | str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``most`` bytes of ``column`` (a single longer value is a piece of its own)."""
    start, held = 0, 0
    for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        if held and held + (n or 0) > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def add_columns(df: DataFrame, text_col: str, fields: list[T.StructField], start: Callable,
                slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``df`` with the columns ``fields``, computed from the values of ``text_col``.

    ``start()`` runs once per task and gives a function from a list of texts
    (None for null) to one list or Arrow array per field.  A column of ``df``
    that has the name of a new one is replaced by it.
    """
    names = [f.name for f in fields]
    if text_col.lower() in (n.lower() for n in names):
        raise ValueError(f"{text_col} is read and can't be replaced")
    base = df.drop(*names)
    schema = T.StructType(base.schema.fields + fields)
    at = base.columns.index(text_col)
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        columns = start()
        for batch in batches:
            for part in slices(batch, at, slice_bytes):
                made = columns(part.column(at).to_pylist())
                made = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=schema.fieldNames())

    return base.mapInArrow(run, schema)
