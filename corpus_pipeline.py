"""A corpus pipeline of five stages, each applying one operator of veilspark.llm to what the stage before kept.

1. quality rules: documents that fail the base rules or are outliers go;
2. quality classifier: documents outside the importance sample go;
3. SimHash near duplicates: one document of each component stays;
4. benchmark decontamination: documents with a benchmark passage go;
5. byte-level BPE: the ids and decoded bytes of what is left, as digests.

Each stage's result is written as Parquet and read again as the next one's
documents.  Stages 1 to 4 return the columns of documents.
"""

from __future__ import annotations

import veilspark.llm.decontaminate as decontaminate
import veilspark.llm.importance as importance
import veilspark.llm.outliers as outliers
import veilspark.llm.simhash as simhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from veilspark.llm.common import read
from veilspark.llm.queries import encoded_digests
from veilspark.session import materialize


#: Chunks that the last stage's encoder remembers: its workers stay while other stages need the executors' memory.
REMEMBERED = 150_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9; what its verdict keeps."""
    return outliers.judge(docs.withColumn("__row", F.struct(*docs.columns)), keep=["__row"]).filter("kept").select("__row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7 with the given labels; what the sample keeps."""
    judged = importance.resample(docs.withColumn("__row", F.struct(*docs.columns)), read(spark, sf_dir, "labels"), keep=["__row"])
    return judged.filter("kept").select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4; the representative of each component."""
    found = simhash.near_duplicates(docs.withColumn("__row", F.struct(*docs.columns)), shingle=3, distance=3, keep=["__row"])
    return found.filter("representative").select("__row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8 against the whole benchmark; documents without any of it."""
    found = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"), name="__matches")
    return found.filter(F.size("__matches") == 0).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6; digests of ids and decoded bytes per document."""
    return encoded_digests(docs, REMEMBERED)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level bpe", encoding),
]

#: Fingerprints, robust estimates, resampling and merges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
