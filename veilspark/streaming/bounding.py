"""Stateful per-user bounding on a stream.

State is one long per user: how many contributions the user made so far, up
to the bound at least (over the whole run; no expiry, as in B1).  Users are
dealt into :data:`BUCKETS` groups by a hash, and a group's state maps each of its
users to that number: every user is read and written alone, but what a group
costs (its key, its output batch) is paid once for many users.  Within
a micro-batch a user's rows arrive in no particular order; map tasks and the
processor cut them to the *first C by arrival*, so memory follows C and not the
rows of a user, and the result is exactly the first C arrivals overall.
State lives in the configured state store (RocksDB in
``veilspark.session.build_session``) and is checkpointed.

Rows pass the state as Arrow batches packed in a binary column, one for each group
and map task's buffer, and are unpacked behind it; never as pandas frames, which would
turn a BIGINT column with a null into doubles.  Arrival orders nulls first and
NaN last, as Spark sorts, so a stream keeps the rows that its batch twin keeps.

Rows without a user bypass the state and are always kept (B2).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StructField, StructType


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def require_rocksdb_state(spark) -> None:
    """transformWithState needs the RocksDB state store; select it when the session has another."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "") != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)


def arrival_key(columns: Sequence[str]):
    """Sort key of a Spark row by ``columns`` ascending: nulls first, NaN last, as Spark orders them."""
    def key(row):
        values = [row[c] for c in columns]
        return tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in values)

    return key


#: Groups of users; fixed, as a restarted query must find its users in the same ones.
BUCKETS = 1 << 13
_BUCKET = "__bucket"


def _in_arrival_order(rows: pa.RecordBatch, first: Sequence[str], user: str, order: Sequence[str]):
    """``rows`` sorted by ``first``, user and arrival, where each user's run starts, and every row's place in its run."""
    keys = {}
    for i, c in enumerate([*first, user, *order]):
        values = rows.column(rows.schema.get_field_index(c))
        if pa.types.is_floating(values.type):
            keys[f"nan{i}"] = pa.compute.is_nan(values)
        keys[f"key{i}"] = values
    rows = rows.take(pa.compute.sort_indices(pa.table(keys), sort_keys=[(k, "ascending") for k in keys], null_placement="at_start"))
    users = rows.column(rows.schema.get_field_index(user)).dictionary_encode().indices.to_numpy()
    starts = np.flatnonzero(np.append(True, users[1:] != users[:-1]))
    return rows, starts, np.arange(len(users)) - np.repeat(starts, np.diff(np.append(starts, len(users))))


def _together(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def _pack(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpack(pack: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(pack) as rows:
        return rows.read_next_batch()


class _FirstArrivals(StatefulProcessor):
    def __init__(self, limit: int, user: StructField, order_cols: Sequence[str]):
        self.limit = int(limit)
        self.user = user
        self.order = list(order_cols)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", StructType([self.user]), StructType([StructField("n", LongType(), False)]))

    def _runs(self, held: list[pa.RecordBatch]):
        rows, starts, place = _in_arrival_order(_together(held), [], self.user.name, self.order)
        users = rows.column(rows.schema.get_field_index(self.user.name)).take(pa.array(starts)).to_pylist()
        return rows, users, np.diff(np.append(starts, rows.num_rows)), place

    def handleInputRows(self, key, rows, timerValues):
        held, n, dropped = [], 0, {}
        for row in rows:
            held.append(_unpack(row["pack"]))
            n += held[-1].num_rows
            if n >= HELD_ROWS and len(held) > 1:  # cut what is held: memory follows C a user
                cut, users, sizes, place = self._runs(held)
                for user, size in zip(users, sizes.tolist(), strict=True):
                    dropped[user] = dropped.get(user, 0) + max(0, size - self.limit)
                held = [cut.filter(pa.array(place < self.limit))]
                n = 0
        arrived, users, sizes, place = self._runs(held)
        before = [state[0] if (state := self.seen.getValue((user,))) else 0 for user in users]
        room = np.maximum(0, self.limit - np.array(before, np.int64))
        for user, size, was, left in zip(users, sizes.tolist(), before, room.tolist(), strict=True):
            if left:
                self.seen.updateValue((user,), (was + size + dropped.get(user, 0),))
        first = arrived.filter(pa.array(place < np.repeat(room, sizes)))
        if first.num_rows:
            yield Row(pack=_pack(first))

    def close(self) -> None:
        pass


#: A map task packs its rows at latest when it holds so many rows or bytes; a group's rows are cut at latest at so many rows.
HELD_ROWS = 200_000
HELD_BYTES = 32 << 20


def _partial_first_arrivals(user: str, order_by: Sequence[str], limit: int):
    """mapInArrow body: per buffer of Arrow batches, each user's first ``limit`` rows by arrival, packed by group.

    The global first ``limit`` arrivals of a user are always among the union
    of the buffers' first ``limit``, so this map-side cut is exact; it
    caps what one user ships to the stateful task at limit x buffers rows.
    Memory: one buffer.
    """
    order = list(order_by)

    def packs(held):
        rows, _, place = _in_arrival_order(_together(held), [_BUCKET], user, order)
        rows = rows.filter(pa.array(place < limit))
        if not rows.num_rows:
            return
        bucket = rows.column(rows.schema.get_field_index(_BUCKET)).to_numpy()
        rows = rows.drop_columns([_BUCKET])
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        ends = np.append(starts[1:], len(bucket))
        for at in range(0, len(starts), 1000):
            part = slice(at, at + 1000)
            made = [_pack(rows.slice(i, j - i)) for i, j in zip(starts[part].tolist(), ends[part].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts[part]]), pa.array(made, pa.binary())], names=[_BUCKET, "pack"])

    def run(batches):
        held, n, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= HELD_ROWS or size >= HELD_BYTES:
                yield from packs(held)
                held, n, size = [], 0, 0
        if held:
            yield from packs(held)

    return run


def _unpacked(batches):
    """mapInArrow body: the rows of the packs, up to ``HELD_ROWS`` a batch or one pack's."""
    for batch in batches:
        held, n = [], 0
        for pack in batch.column(0).to_pylist():
            held.append(_unpack(pack))
            n += held[-1].num_rows
            if n >= HELD_ROWS:
                yield _together(held)
                held, n = [], 0
        if held:
            yield _together(held)


def stream_bound_contributions(stream: DataFrame, user: str, order_by: Sequence[str], limit: int) -> DataFrame:
    """Keep each user's first ``limit`` contributions (arrival = ``order_by``) across micro-batches.

    Plan: map-side partial limit per input partition (``mapInArrow``), then
    the keyed state (one counter per user, by groups of users) finishes the bound exactly.  The
    counter then counts the rows that reached it: below C that is every row
    of the user (nothing was cut), and once the user has C or more rows it is
    at least C - so "room left" is exact either way.
    """
    require_rocksdb_state(stream.sparkSession)
    schema = stream.schema
    with_user = stream.filter(F.col(user).isNotNull())
    with_user = with_user.withColumn(_BUCKET, F.pmod(F.xxhash64(user), F.lit(BUCKETS)))
    packed = with_user.mapInArrow(_partial_first_arrivals(user, order_by, limit), f"{_BUCKET} long, pack binary")
    kept = packed.groupBy(_BUCKET).transformWithState(
        statefulProcessor=_FirstArrivals(limit, schema[user], order_by),
        outputStructType=StructType([StructField("pack", BinaryType())]),
        outputMode="Append",
        timeMode="None",
    ).mapInArrow(_unpacked, schema)
    return kept.unionByName(stream.filter(F.col(user).isNull()))
