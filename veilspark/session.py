"""Session helpers: building a session for tests and benches, shared work folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "veilspark",
                  driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects (UTC, AQE, no UI)."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as the cluster names it, and
    it must name one.  Only a local master (tests) gets a folder of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - older API shapes
            d = None
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="veilspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        has_dir = spark.sparkContext.getCheckpointDir() is not None
    except Exception:  # pragma: no cover - older API shapes
        has_dir = False
    if not has_dir:  # each setCheckpointDir call makes a fresh subfolder: set it once per context
        spark.sparkContext.setCheckpointDir(d)
    return spark.conf.get("spark.checkpoint.dir", None) or d


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/veilspark/{name}-{uuid.uuid4().hex}"


#: What keys and noise secrets look like in a plan: a long run of hex digits.
SECRET_SHAPE = "[0-9a-fA-F]{48,}"


def redact(spark: SparkSession) -> None:
    """A second guard for secrets that a caller's own expressions hold as literals.

    Spark hides what matches ``spark.sql.redaction.string.regex`` in most plan
    texts, though not in all that it logs; the library's own secrets are data
    (``with_secrets``).  The setting itself is logged, so it names the *shape*
    of secrets and never one of them.
    """
    cur = spark.conf.get("spark.sql.redaction.string.regex", None)
    if cur and SECRET_SHAPE in cur:
        return
    spark.conf.set("spark.sql.redaction.string.regex", f"{cur}|{SECRET_SHAPE}" if cur else SECRET_SHAPE)


def with_secrets(df, **secrets: bytes):
    """``df`` with binary columns of the given names and values.

    A literal would show in the plans that Spark logs.  The values come as a
    table of one row instead, whose contents no plan shows, joined by broadcast.
    """
    spark = df.sparkSession
    row = spark.createDataFrame([(0, *map(bytearray, secrets.values()))],
                                "__secrets long, " + ", ".join(f"{n} binary" for n in secrets))
    redact(spark)
    # Always 0, but not a constant to the optimizer: so the join is a hash join.
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    zero = F.pmod(F.xxhash64(F.col(f"`{plain[0]}`")), F.lit(1)) if plain else F.lit(0).cast("long")
    return df.withColumn("__secrets", zero).join(F.broadcast(row), "__secrets").drop("__secrets")


def table(spark: SparkSession, sf_dir: str, name: str):
    """Read one driver table (parquet) from ``sf_dir``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def materialize(df, name: str = "pinned"):
    """Cut lineage: write ``df`` as parquet under the shared folder and continue from the written table.

    One job computes ``df`` once and writes it (an eager ``Dataset.checkpoint``
    would compute it twice without a cache: once to count, once to save).
    Later passes read the same files, so they agree with each other, and the
    table outlives any executor.  Never use it on plaintext that must not rest
    on disk.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
