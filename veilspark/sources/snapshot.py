"""Snapshot sink (S5): the released histogram, in release order.

Each snapshot is written as its own partition (``snapshot_id``) with the rank
of every key and then committed (``veilspark.sources.commits``):
``read_snapshot`` gives the newest committed one, so "current" switches at once and a
half-written snapshot is never read.  A replayed micro-batch finds its snapshot
committed and leaves it, one that died before its commit is written again.
``snapshot_lines`` renders the text form:
a banner ``=== <instant> ===`` then ``key:count`` lines in rank order;
``write_snapshot_text`` writes it as ordered parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.sources.commits import CommitLog


def snapshot_lines(release: DataFrame, key: str, count: str = "released", rank: str = "rank",
                   instant: Column | None = None) -> DataFrame:
    """(line_no, line): line 0 is the banner, then one ``key:count`` line per rank."""
    inst = instant if instant is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = release.select(
        F.col(rank).cast("long").alias("line_no"),
        F.concat_ws(":", F.col(key).cast("string"), F.col(count).cast("string")).alias("line"),
    )
    banner = release.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("line_no"), F.concat(F.lit("=== "), inst, F.lit(" ===")).alias("line")
    )
    return banner.unionByName(body)


def write_snapshot(release: DataFrame, path: str, snapshot_id: int, key: str, count: str = "released",
                   rank: str = "rank") -> bool:
    """Write one snapshot partition and commit it; False, and nothing written, if its id is committed already."""
    log = CommitLog(release.sparkSession, path)
    if log.read(snapshot_id) is not None:
        return False
    out = release.select(
        F.current_timestamp().alias("snapshot_ts"),
        F.col(rank).cast("long").alias("rank"), F.col(key).alias("key"), F.col(count).cast("long").alias("count"),
    )
    folder = f"snapshot_id={int(snapshot_id)}"
    out.write.mode("overwrite").parquet(f"{log.path}/{folder}")  # no reader looks there before the commit
    return log.commit(snapshot_id, {"folder": folder})


def read_snapshot(spark: SparkSession, path: str, snapshot_id: int | None = None) -> DataFrame | None:
    """The newest committed snapshot, or the one with the given id: (snapshot_id, snapshot_ts, rank, key, count); None if not there."""
    log = CommitLog(spark, path)
    entry = log.latest() if snapshot_id is None else log.read(snapshot_id)
    if entry is None:
        return None
    rows = spark.read.parquet(f"{log.path}/{entry['folder']}")
    return rows.select(F.lit(entry["version"]).cast("long").alias("snapshot_id"), "*")


def write_snapshot_text(release: DataFrame, path: str, key: str, count: str = "released", rank: str = "rank",
                        parts: int | None = None) -> None:
    """Text export of one snapshot: banner then ``key:count`` lines, in rank order.

    The lines are range-partitioned on their number and sorted within each
    part, so the part files read in name order are the snapshot text in
    order - no single writer task.
    """
    spark = release.sparkSession
    n = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    lines = snapshot_lines(release, key, count, rank)
    (lines.repartitionByRange(n, "line_no").sortWithinPartitions("line_no")
     .select("line").write.mode("overwrite").text(path))
