"""Token counts from an exact length histogram (operator 2).

Each whole text is encoded; documents are counted by encoded length.  Sums over
all longer documents then answer, for any context limit, how many documents and
ids there are, how many would be cut, what is left after cutting, and the
quantiles, without the texts and without another pass.  The sums run within
buckets of :data:`BUCKET` lengths, and over the buckets' totals, so no task
holds more than one bucket or one row for each bucket.
"""

from __future__ import annotations

import base64
import functools

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import add_columns

BUCKET = 1024


@functools.cache
def load(rank_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; made once per worker."""
    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def with_lengths(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text", name: str = "n_tokens") -> DataFrame:
    """``df`` with the encoded length of each whole text; null and empty texts have 0."""

    def start():
        encode = load(rank_path, pattern).encode_ordinary
        return lambda texts: [pa.array([len(encode(t)) if t else 0 for t in texts], pa.int64())]

    return add_columns(df, text_col, [T.StructField(name, T.LongType())], start)


def histogram(lengths: DataFrame, col: str = "n_tokens") -> DataFrame:
    """``length``, ``docs``: documents of each length that occurs; null lengths count as 0."""
    return lengths.groupBy(F.coalesce(F.col(col), F.lit(0)).cast("long").alias("length")).agg(F.count("*").alias("docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """The histogram with sums for each length as a context limit.

    ``docs_over`` and ``tokens_over``: documents longer than it and their ids;
    ``docs_within``: the others; ``kept_tokens``: ids left if every document is
    cut to it; ``total_docs`` and ``total_tokens``: of all documents.
    """
    rows = hist.withColumns({"bucket": F.expr(f"length div {BUCKET}"), "tokens": F.col("length") * F.col("docs")})
    totals = rows.groupBy("bucket").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "bucket", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t"),
        F.sum("d").over(every).alias("total_docs"), F.sum("t").over(every).alias("total_tokens"))
    longer = Window.partitionBy("bucket").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(totals, "bucket").withColumns({
        "docs_over": F.col("d") + F.coalesce(F.sum("docs").over(longer), F.lit(0)),
        "tokens_over": F.col("t") + F.coalesce(F.sum("tokens").over(longer), F.lit(0))})
    return rows.select(
        "length", "docs", "docs_over", "tokens_over", (F.col("total_docs") - F.col("docs_over")).alias("docs_within"),
        (F.col("total_tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias("kept_tokens"),
        "total_docs", "total_tokens")


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``length_limit``, ``docs_over``, ``kept_tokens`` for any limits, whether documents of that length occur or not.

    All longer documents are those of the least longer length and those over it.
    """
    over = F.struct((F.col("docs") + F.col("docs_over")).alias("d"), (F.col("docs") * F.col("length") + F.col("tokens_over")).alias("t"))
    found = sums.agg(F.max("total_tokens").alias("all"), *[
        F.min_by(over, F.when(F.col("length") > n, F.col("length"))).alias(f"l{i}") for i, n in enumerate(limits)])
    rows = F.array(*[F.struct(F.lit(n).cast("long").alias("n"), F.col(f"l{i}").alias("o")) for i, n in enumerate(limits)])
    rows = found.select("all", F.explode(rows).alias("r"))
    d, t = F.coalesce("r.o.d", F.lit(0)), F.coalesce("r.o.t", F.lit(0))
    return rows.select(F.col("r.n").alias("length_limit"), d.alias("docs_over"),
                       (F.coalesce("all", F.lit(0)) - t + F.col("r.n") * d).alias("kept_tokens"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``share``, ``length``: the least length that at least that share of documents does not exceed."""
    found = sums.agg(*[F.min(F.when(F.col("docs_within") >= F.ceil(F.lit(q) * F.col("total_docs")), F.col("length"))).alias(f"q{i}")
                       for i, q in enumerate(shares)])
    rows = F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("length")) for i, q in enumerate(shares)])
    return found.select(F.explode(rows).alias("r")).select("r.share", "r.length")
