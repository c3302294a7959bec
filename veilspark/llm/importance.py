"""Quality classifier by importance resampling (operator 7).

Texts become bags of hashed one- and two-word grams.  Two generative models are
bucket frequencies with add-one smoothing: one of target texts, one of all raw
texts.  The logarithm of a document's importance weight is the sum over its
grams of log(target / raw).

The sample is drawn by a weight that does not grow with the length: the mean
over the grams of log((t + PRIOR) / (expected t + PRIOR)), at most zero, times
the grams of an average target document; t is the bucket's count in target
texts without the document itself.  So buckets with few occurrences say little,
ordinary grams don't make up for those that targets lack, and a labelled target
document is judged as an unlabelled one of the same kind is.
Adding independent Gumbel noise to these logarithms and taking the k largest
samples k documents without replacement in proportion to the weights; the
others are rejected.

The importance weight has ``buckets`` buckets, doubled until they hold at most
GRAMS_A_BUCKET distinct grams on average or were doubled ``doublings`` times; the
sample's weight has the most buckets at once, so that rare grams don't hide among
frequent ones.  Both models come from one pass over all texts that sums the
most buckets in each task first and folds them afterwards.  The target model reads
the texts of at most ``target_docs`` labelled documents (those whose ids have the
smallest hashes), so that their ids can travel with the task.
"""

from __future__ import annotations

import re
from binascii import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import Recent, slices
from veilspark.session import materialize

SEED = 7
PRIOR = 10
GRAMS_A_BUCKET = 10
_TOKENS = re.compile(r"\w+|[^\w\s]+").findall


def _hashes(chunk: str) -> bytes:
    return np.array([crc32(t.encode()) for t in _TOKENS(chunk.lower())], np.uint32).tobytes()


_CHUNKS = Recent(_hashes)


def grams(text: str | None, buckets: int) -> np.ndarray:
    """The bucket of every one- and two-word gram of the lower-cased text; words and runs of punctuation count as words."""
    words = np.frombuffer(b"".join([_CHUNKS[c] for c in (text or "").split()]), np.uint32).astype(np.uint64)
    pairs = (words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)
    singles = (words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return np.concatenate((singles, pairs)) % np.uint64(buckets)


def fit(docs: DataFrame, target_ids: list[int], buckets: int, doublings: int, id_col: str = "doc_id",
        text_col: str = "text") -> np.ndarray:
    """Each of the most buckets' count in target texts (those with an id in ``target_ids``) and in raw texts (all of ``docs``)."""
    ids = pa.array(target_ids, pa.int64())
    most = buckets << doublings

    def run(batches):
        raw, target = np.zeros(most, np.int64), np.zeros(most, np.int64)
        for batch in batches:
            for part in slices(batch, 1):
                chosen = pa.compute.is_in(part.column(0), value_set=ids, skip_nulls=True).to_pylist()
                found = [grams(t, most).astype(np.int64) for t in part.column(1).to_pylist()]
                raw += np.bincount(np.concatenate(found), minlength=most)
                if any(chosen):
                    target += np.bincount(np.concatenate([g for g, c in zip(found, chosen, strict=True) if c]), minlength=most)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])],
                                         names=["bucket", "raw", "target"])

    rows = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "bucket int, raw long, target long")
    rows = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()  # one row a bucket
    counts = np.zeros((2, most), np.int64)
    counts[:, rows["bucket"].to_numpy()] = rows["target"].to_numpy(), rows["raw"].to_numpy()
    return counts


def fold(counts: np.ndarray, buckets: int) -> np.ndarray:
    """``counts`` in the fewest ``buckets``, doubled as the distinct grams ask for."""
    most = counts.shape[1]
    empty = np.count_nonzero(counts[1] == 0) / most
    distinct = -most * np.log(empty) if empty else np.inf  # linear counting
    while most > buckets and distinct <= GRAMS_A_BUCKET * (most >> 1):
        most >>= 1
        counts = counts.reshape(2, 2, most).sum(1)
    return counts


def weigh(docs: DataFrame, counts: np.ndarray, buckets: int, target_ids: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``log_weight`` and the mean weight of a gram, ``__mean``."""
    sent = docs.sparkSession.sparkContext.broadcast((counts, np.sort(np.array(target_ids, np.int64))))

    def run(batches):
        (target, raw), ids = sent.value
        folded = fold(sent.value[0], buckets) + 1
        shares = folded / folded.sum(1, keepdims=True)
        ratio = np.log(shares[0] / shares[1])
        m, n = int(target.sum()), max(1, int(raw.sum()))
        plain = np.minimum(0, np.log((target + PRIOR) / (raw * (m / n) + PRIOR)))
        for batch in batches:
            for part in slices(batch, at):
                sums, means = [], []
                chosen = pa.compute.is_in(part.column(id_at), value_set=pa.array(ids), skip_nulls=True).to_pylist()
                for text, own in zip(part.column(at).to_pylist(), chosen, strict=True):
                    found = grams(text, len(raw)).astype(np.int64)
                    sums.append(float(ratio[found % len(ratio)].sum()))
                    if own and len(found):
                        kinds, times = np.unique(found, return_counts=True)
                        rest = (target[kinds] - times + PRIOR) / (raw[kinds] * ((m - len(found)) / n) + PRIOR)
                        means.append(float((np.minimum(0, np.log(rest)) * times).sum() / len(found)))
                    else:
                        means.append(float(plain[found].mean()) if len(found) else 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sums, pa.float64()), pa.array(means, pa.float64())],
                                                 names=schema.fieldNames())

    at, id_at = docs.columns.index(text_col), docs.columns.index(id_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("log_weight", T.DoubleType()), T.StructField("__mean", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def least_errors(keys: DataFrame, cuts: list[float]) -> float | None:
    """Of ``cuts``, the bound on ``gumbel_key`` that leaves the fewest labelled documents on the wrong side:
    targets (``__good``) below it and others not below it; the smallest of equal ones, None if no bound does best."""
    cuts = sorted(set(cuts))

    def run(batches):
        found = np.zeros((2, len(cuts) + 1), np.int64)
        for batch in batches:
            good = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            np.add.at(found, (good, np.searchsorted(cuts, batch.column(0).to_numpy(), "right")), 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cuts) + 1)), pa.array(found[0]), pa.array(found[1])],
                                         names=["place", "bad", "good"])

    rows = keys.select("gumbel_key", "__good").mapInArrow(run, "place long, bad long, good long")
    counts = np.zeros((2, len(cuts) + 1), np.int64)
    for place, bad, good in rows.groupBy("place").agg(F.sum("bad"), F.sum("good")).collect():  # one row a cut
        counts[:, place] = bad, good
    # Place i holds the keys from cut i - 1 up to cut i.  Errors of no bound, then of each cut.
    gained = np.concatenate(([0], np.cumsum(counts[1] - counts[0])[:-1]))
    best = int(gained.argmin())
    return cuts[best - 1] if best else None


def gumbel(*cols: str) -> Column:
    """Standard Gumbel noise that the columns' values alone decide."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *cols), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.ln(-F.ln(u))


def kth_largest(rows: DataFrame, col: str, k: int, bins: int = 2000, enough: int = 5000) -> float | None:
    """The k-th largest value of ``col``, exactly: histograms narrow the range until ``enough`` values are left in it."""
    values = rows.select(F.col(col).alias("x"))
    low, high, n = values.agg(F.min("x"), F.max("x"), F.count("x")).first()
    if not n or k <= 0:
        return None
    k = min(k, n)
    above = 0  # values over ``high``
    while n > enough and low < high:
        width = (high - low) / bins
        inside = values.filter(F.col("x").between(low, high))
        at = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)) if width else F.lit(0)
        counts = {b: (c, lo, hi) for b, c, lo, hi in inside.groupBy(at.alias("b")).agg(
            F.count("*"), F.min("x"), F.max("x")).collect()}
        for b in sorted(counts, reverse=True):
            n, low, high = counts[b]
            if above + n >= k:
                break
            above += n
    if low == high:
        return low
    left = sorted((r[0] for r in values.filter(F.col("x").between(low, high)).collect()), reverse=True)
    return left[k - above - 1]


def resample(docs: DataFrame, labels: DataFrame, target: Column | str = "quality = 1 and toxic = 0", id_col: str = "doc_id",
             text_col: str = "text", k: int | None = None, spare: float = 0.002, buckets: int = 10_000,
             doublings: int = 7, target_docs: int = 20_000, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with ``log_weight``, ``gumbel_key`` and ``kept``.

    ``kept`` is true for the ``k`` rows with the largest keys (length-normalised
    log weight plus noise); rows that tie with the last of them are kept too.
    Without ``k`` it is calibrated: as many rows as have a key not below the
    bound that leaves the fewest labelled documents on the wrong side (targets
    below, others not below).  If no labelled document is other than target, the
    bound is that of all but a share ``spare`` of the targets.  An id labelled
    both ways is a target.  Labels of ids that ``docs`` does not have play no
    part.  With no labelled target documents nothing is rejected.  Null and empty texts have no grams and
    weight zero.  The noise comes from id and text, so equal rows share their
    fate.  Input columns that have the name of an output are replaced.  An empty
    table gives an empty one.
    """
    outputs = ("log_weight", "gumbel_key", "kept")
    keep = [c for c in (keep or docs.columns) if c.lower() not in outputs]
    held = {f"__k{i}": c for i, c in enumerate(dict.fromkeys(keep))}
    rows = docs.select(*[F.col(c).alias(k_) for k_, c in held.items()], F.col(id_col).cast("long").alias("__id"),
                       F.col(text_col).alias("__text"))
    wanted = labels.filter(target).select(F.col(id_col).cast("long").alias("__id")).filter("__id is not null").distinct()
    present = materialize(wanted.join(rows.select("__id"), "__id", "left_semi"), "resample-target")
    chosen = [r[0] for r in present.orderBy(F.xxhash64("__id"), "__id").limit(target_docs).collect()]
    counts = fit(rows, chosen, buckets, doublings, "__id", "__text")
    size = float(counts[0].sum()) / max(1, len(chosen))
    scored = weigh(rows, counts, buckets, chosen, "__id", "__text")
    scored = scored.withColumn("gumbel_key", F.col("__mean") * size + gumbel("__id", "__text")).drop("__text", "__mean")
    scored = materialize(scored, "resample-keys")
    if k is None:
        good = scored.join(present, "__id", "left_semi")
        others = labels.filter(~(F.expr(target) if isinstance(target, str) else target)).select(
            F.col(id_col).cast("long").alias("__id")).filter("__id is not null").distinct()
        bad = scored.join(others.join(present, "__id", "left_anti"), "__id", "left_semi")
        marked = good.select("gumbel_key", F.lit(True).alias("__good")).unionByName(
            bad.select("gumbel_key", F.lit(False).alias("__good")))
        shares = [i / 1000 for i in range(1001)]
        n, n_bad, cuts = marked.agg(F.count_if("__good"), F.count_if(~F.col("__good")),
                                    F.percentile_approx("gumbel_key", shares, 10_000)).first()
        if n and n_bad:
            least = least_errors(marked, cuts)
        else:
            least = kth_largest(good, "gumbel_key", n - int(n * spare))
        k = scored.count() if least is None else scored.filter(F.col("gumbel_key") >= least).count()
    bound = kth_largest(scored, "gumbel_key", k)
    kept = F.col("gumbel_key") >= F.lit(bound) if bound is not None else F.lit(False)
    return scored.select(*[F.col(k_).alias(c) for k_, c in held.items()], "log_weight", "gumbel_key", kept.alias("kept"))
