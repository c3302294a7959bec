"""Order-dependent scans that stay distributed when one key is hot.

A plain ``Window.partitionBy(key).orderBy(arrival)`` puts every row of a key in
one task; a global ``row_number() over (order by x)`` puts *all* rows in one
task.  Both break when one producer/user owns a third of the data.  The
helpers here cut the arrival order into *blocks* instead:

1. ``repartitionByRange(n, *keys, *order)`` gives n contiguous, similarly sized
   ranges of the total order (a hot key spans many of them); the block id is
   the partition id.  An explicit n keeps AQE from coalescing, so block ids are
   stable within the job that assigns them (a retried task of that job uses
   the same range bounds).  n follows the rows and the bytes of the input, so a
   block of wide rows is no larger than one of narrow rows.
2. The scan runs *within* (key, block): bounded by the block size.
3. A per-(key, block) summary (at most #keys + #blocks rows) gives the carry
   from all earlier blocks of the same key through a window over that small
   table; it is joined back on (key, block).

For the key-less case (global positions) the carry table has one row per block,
a number known before, so it is broadcast up to 100,000 blocks.

The blocked rows are *pinned* (written once as a parquet table in the shared
folder, ``veilspark.session.materialize``) before the two passes read them.
Spark's range partitioner samples with a seed tied to the RDD, so two
separately planned range exchanges over the same data may cut different
blocks; reading one written copy makes the blocks of both passes identical
whatever Catalyst prunes or reuses, and the copy survives executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLK = "__blk"
_LOCAL_BITS = 33  # monotonically_increasing_id: partition id above bit 33
_MAX_BROADCAST_BLOCKS = 100_000


def _cols(cs: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


BLOCK_ROWS_CONF = "veilspark.scan.blockRows"
_DEFAULT_BLOCK_ROWS = 1_000_000
BLOCK_BYTES_CONF = "veilspark.scan.blockBytes"
_DEFAULT_BLOCK_BYTES = 128 << 20


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row has: the lengths of texts and binaries, of nested values as JSON, and 8 for any other."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size


def num_blocks(spark: SparkSession, n: int | None = None, df: DataFrame | None = None) -> int:
    """Blocks for a scan: ``n`` if given, else one for each ``veilspark.scan.blockRows`` rows
    or ``veilspark.scan.blockBytes`` bytes that ``df`` has, whichever gives more.

    Rows and bytes are counted (a pass that reads only columns of varying
    length), not estimated: give a written table where computing ``df`` is dear.
    """
    if n:
        return int(n)
    if df is None:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    per = int(spark.conf.get(BLOCK_ROWS_CONF, str(_DEFAULT_BLOCK_ROWS)))
    most = int(spark.conf.get(BLOCK_BYTES_CONF, str(_DEFAULT_BLOCK_BYTES)))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return max(1, -(-rows // max(1, per)), -(-(size or 0) // max(1, most)))


def _small(offsets: DataFrame, n: int) -> DataFrame:
    """A table of at most ``n`` rows: broadcast up to a checked size, else joined like any other."""
    return F.broadcast(offsets) if n <= _MAX_BROADCAST_BLOCKS else offsets


def _with_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the carry of their (key, block); a null key is a key like any other."""
    theirs = carry.select(*[F.col(c).alias(f"__of_{c}" if c in (*keys, BLK) else c) for c in carry.columns])
    same = F.col(BLK) == F.col(f"__of_{BLK}")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return rows.join(theirs, same, "left").drop(*[f"__of_{k}" for k in (*keys, BLK)])


def _pin(df: DataFrame) -> DataFrame:
    from veilspark.session import materialize

    return materialize(df)


def with_blocks(df: DataFrame, keys: Sequence[str], order_by: Sequence, n: int | None = None) -> DataFrame:
    """Range-partition on (keys, order), tag each row with its block id, and pin the result."""
    n = num_blocks(df.sparkSession, n, df)
    return _pin(df.repartitionByRange(n, *_cols(list(keys) + list(order_by))).withColumn(
        BLK, F.spark_partition_id().cast("long")
    ))


def global_row_number(df: DataFrame, order_by: Sequence, name: str = "rn", n: int | None = None) -> DataFrame:
    """1-based position of each row in the total order ``order_by``.

    One range shuffle into pinned blocks; positions inside a block come from
    ``monotonically_increasing_id`` after a sort within the partition, offsets
    from a broadcast table with one row per block (size fixed by ``n``).
    """
    n = num_blocks(df.sparkSession, n, df)
    mask = (1 << _LOCAL_BITS) - 1
    s = _pin(
        df.repartitionByRange(n, *_cols(order_by))
        .sortWithinPartitions(*_cols(order_by))
        .withColumn("__mid", F.monotonically_increasing_id())
        .withColumn(BLK, F.shiftright(F.col("__mid"), _LOCAL_BITS))
        .withColumn("__loc", F.col("__mid").bitwiseAND(F.lit(mask)))
    )
    sizes = s.groupBy(BLK).agg(F.count(F.lit(1)).alias("__n"))
    # <= n rows: a single-partition window here is bounded by the block count.
    offsets = sizes.select(
        BLK,
        F.coalesce(
            F.sum("__n").over(Window.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__off"),
    )
    out = s.join(_small(offsets, n), BLK, "left").withColumn(
        name, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__loc") + F.lit(1)).cast("long")
    )
    return out.drop("__mid", "__loc", "__off", BLK)


def global_running_sum(df: DataFrame, order_by: Sequence, value: str, name: str = "running",
                       n: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` in the total order ``order_by``, without a global window.

    Range blocks, a running sum inside each block (window on the block), and
    block offsets from a broadcast table with one row per block.
    """
    n = num_blocks(df.sparkSession, n, df)
    b = _pin(df.repartitionByRange(n, *_cols(order_by)).withColumn(BLK, F.spark_partition_id().cast("long")))
    local = Window.partitionBy(BLK).orderBy(*_cols(order_by)).rowsBetween(Window.unboundedPreceding, 0)
    scanned = b.withColumn("__lsum", F.sum(value).over(local))
    totals = scanned.groupBy(BLK).agg(F.sum(value).alias("__bsum"))
    offsets = totals.select(  # <= n rows
        BLK,
        F.coalesce(F.sum("__bsum").over(Window.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"),
    )
    out = scanned.join(_small(offsets, n), BLK, "left").withColumn(
        name, F.col("__lsum") + F.coalesce(F.col("__off"), F.lit(0))
    )
    return out.drop("__lsum", "__off", BLK)


def dense_index(df: DataFrame, col: str, name: str = "i", n: int | None = None) -> DataFrame:
    """0-based dense rank of the distinct non-null values of ``col`` (ascending)."""
    d = df.select(col).filter(F.col(col).isNotNull()).distinct()
    return global_row_number(d, [col], name="__r", n=n).select(col, (F.col("__r") - 1).alias(name))


def keyed_row_number(df: DataFrame, keys: Sequence[str], order_by: Sequence, name: str = "rn",
                     n: int | None = None) -> DataFrame:
    """1-based position of each row within its key, in ``order_by`` order.

    Same result as ``row_number() over (partition by keys order by order_by)``
    but a hot key is split over many blocks (see module doc).  The big side
    is shuffled once: its blocks are sorted before they are pinned, so a row's
    position in its (key, block) is its distance from the first one's id, and
    the carry (at most #keys + #blocks rows, written so that their number is
    known) is all that is joined to it.
    """
    keys = list(keys)
    n = num_blocks(df.sparkSession, n, df)
    by = _cols([*keys, *order_by])
    b = _pin(
        df.repartitionByRange(n, *by)
        .sortWithinPartitions(*by)
        .withColumn("__mid", F.monotonically_increasing_id())
        .withColumn(BLK, F.shiftright(F.col("__mid"), _LOCAL_BITS))
    )
    summary = b.groupBy(*keys, BLK).agg(F.count(F.lit(1)).alias("__cnt"), F.min("__mid").alias("__first"))
    before = F.sum("__cnt").over(Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1))
    carry = _pin(summary.select(*keys, BLK, (F.coalesce(before, F.lit(0)) - F.col("__first") + F.lit(1)).alias("__carry")))
    out = _with_carry(b, _small(carry, carry.count()), keys).withColumn(name, (F.col("__mid") + F.col("__carry")).cast("long"))
    return out.drop("__mid", "__carry", BLK)


def keyed_running_max_before(df: DataFrame, keys: Sequence[str], order_by: Sequence, value: Column,
                             name: str = "prev_max", n: int | None = None,
                             extra_local: dict[str, Column] | None = None) -> DataFrame:
    """Max of ``value`` over the *earlier* rows of the same key (null if none).

    ``extra_local`` adds window columns whose partition keys extend
    (keys, block) - e.g. (key, block, seq) - so they ride on the same
    exchange.  The result keeps the ``BLK`` column for follow-up joins.
    """
    keys = list(keys)
    b = with_blocks(df, keys, order_by, n).withColumn("__v", value)
    local = Window.partitionBy(*keys, BLK).orderBy(*_cols(order_by)).rowsBetween(Window.unboundedPreceding, -1)
    scanned = b.withColumn("__lmax", F.max("__v").over(local))
    for k, c in (extra_local or {}).items():
        scanned = scanned.withColumn(k, c)
    summary = scanned.groupBy(*keys, BLK).agg(F.max("__v").alias("__bmax"))
    carry = summary.select(
        *keys, BLK,
        F.max("__bmax").over(Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1))
        .alias("__cmax"),
    )
    out = _with_carry(scanned, carry, keys).withColumn(name, F.greatest("__lmax", "__cmax"))
    return out.drop("__v", "__lmax", "__cmax")
