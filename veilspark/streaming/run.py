"""Running streaming queries: sources over the driver tables and availableNow runs.

Checkpoints and outputs go under the shared folder named by
``spark.checkpoint.dir`` (``veilspark.session.work_path``).  The caller names the
checkpoint: a query restarted with it resumes from its state store and offsets,
while a fresh one would give every user a new contribution budget.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.session import work_path


def parquet_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over parquet with the schema of what is there now.

    ``path`` may be a directory or a single file; a single file is streamed
    from its folder through a glob filter on its name.
    """
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    folder, _, name = path.rstrip("/").rpartition("/")
    if spark.read.format("binaryFile").option("pathGlobFilter", name).load(folder).isEmpty():  # by Spark's own file system
        return r.parquet(path)
    return r.option("pathGlobFilter", name).parquet(folder)


def arrival_stream(spark: SparkSession, table: DataFrame, order_by: list, rows_per_batch: int) -> tuple[DataFrame, int]:
    """Stream a table in arrival order, ``rows_per_batch`` rows per micro-batch; returns (stream, batches).

    A ``rate-micro-batch`` source emits arrival indices 0, 1, ... in fixed
    batches; they are joined to the table's arrival index (``order_by``
    numbering over blocks pinned in the shared folder).  Batch k is therefore
    exactly arrivals [k R, (k + 1) R) however the query is scheduled or
    restarted, which makes multi-batch runs reproducible.
    """
    from veilspark.operators.prep import dense_ids

    # the numbering reads its pinned blocks (written once), so the static side of the join is stable
    indexed = dense_ids(table, order_by, "__arrival")
    n = indexed.count()
    per = max(1, int(rows_per_batch))
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per).load()
    stream = ticks.select(F.col("value").alias("__arrival")).join(indexed, "__arrival").drop("__arrival")
    return stream, max(1, -(-n // per))


def _start(writer, runs: int):
    """Run an availableNow query ``runs`` times from the same checkpoint (each run resumes the last)."""
    for _ in range(max(1, runs)):
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()


def run_to_parquet(stream: DataFrame, name: str, out_path: str | None = None,
                   *, checkpoint: str, runs: int = 1) -> str:
    """Append the stream to parquet until all available input is processed; returns the output path.

    ``runs`` > 1 restarts the query that many times from its checkpoint
    (sources that release one batch per run, like ``arrival_stream``).
    """
    spark = stream.sparkSession
    out_path = out_path or work_path(spark, f"{name}-out")
    writer = (stream.writeStream.format("parquet").option("path", out_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    _start(writer, runs)
    return out_path


def run_foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], name: str,
                      *, checkpoint: str, processing_time: str | None = None, runs: int = 1) -> None:
    """Drive ``fn`` over micro-batches: availableNow (``runs`` restarts), or a processing-time trigger.

    With ``processing_time`` (the flush/snapshot tick of W2/W3) the query runs
    until stopped; the call blocks on it.
    """
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if processing_time:
        q = w.trigger(processingTime=processing_time).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        return
    _start(w, runs)
