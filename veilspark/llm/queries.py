"""The registered queries of this subpackage and their SQL, by name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm import bpe, conversation_trie, decontaminate, importance, langid, licenses, merkle, oracles, outliers, packing, repair_store, sharding, simhash, token_counts
from veilspark.llm.common import read
from veilspark.session import materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoded_digests(docs: DataFrame, remembered: int = 400_000) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids and of the decoded bytes."""
    out = bpe.encode_decode(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN, remembered=remembered)
    return out.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over all documents."""
    return licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over all documents."""
    return encoded_digests(read(spark, sf_dir, "documents"))


def op1_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: all documents on shards 0 to 15 with near equal bytes."""
    return sharding.place(read(spark, sf_dir, "documents"), shards=16)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: the length histogram of all documents with its suffix sums."""
    docs = read(spark, sf_dir, "documents").select("text")
    lengths = token_counts.with_lengths(docs, RANKS, public_tokenizers.PATTERN).select("n_tokens")
    return token_counts.suffix_sums(materialize(token_counts.histogram(lengths), "token-histogram"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: learn from three quarters of the documents (calibrated on an eighth of them), predict all."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"))
    part = "pmod(xxhash64(doc_id), 8) = 0"
    return langid.identify(docs, f"not held_out and not {part}", f"not held_out and {part}", keep=["doc_id", "held_out"])


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over all documents: three-word shingles, links at three or fewer differing bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, distance=3, keep=["doc_id"])


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over all documents, target: labelled good and not toxic."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return importance.resample(docs, labels, keep=["doc_id"])


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: every document against the whole benchmark, with the items found in it."""
    found = decontaminate.find_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("matches") > 0).alias("leaked"), F.col("matches.item").alias("items"), "matches")


def op9_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all documents: counts, base rules and the verdict of the robust estimate."""
    return outliers.judge(read(spark, sf_dir, "documents"), keep=["doc_id"])


def op10_repair_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: all documents written as compressed shards and read back."""
    path = repair_store.write(read(spark, sf_dir, "documents"), TOKENIZER)
    return repair_store.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: all documents in windows of 4096 ids beside their BM25 neighbours."""
    return packing.pack_documents(read(spark, sf_dir, "documents"), WORDS, end_id=2, window=4096)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: the prefix trie of all conversations, each rebuilt on the first turns of its family of twenty."""
    heads = F.crc32(F.col("conv_id").cast("string")) % 4
    turns, lengths = conversation_trie.rebuilt(read(spark, sf_dir, "conversations"), 20, heads, 3)
    return conversation_trie.trie(turns, lengths)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: manifest of all documents, proofs checked against rows of which some are tampered with."""
    doc, text = F.col("doc_id"), F.col("text")
    leaf = lambda n: merkle.leaf_hash(doc, F.col("source"), F.col("lang"), n, text)
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.when(F.crc32(doc.cast("string")) % 7 == 0, leaf(more))
    made = merkle.build(read(spark, sf_dir, "documents"), group=F.col("lang"), order=[doc], leaf=leaf(F.col("n_chars")),
                        keep={"doc_id": doc, "tampered": tampered})
    made = made.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return made.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("path")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_bounded_ring": op1_bounded_ring,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op4_simhash": op4_simhash,
    "op5_licenses": op5_licenses,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_importance_resampling": op7_importance_resampling,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality_outliers": op9_quality_outliers,
    "op10_repair_store": op10_repair_store,
    "op11_retrieval_packing": op11_retrieval_packing,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {"op12_conversation_trie": oracles.TRIE, "op13_merkle_manifest": oracles.MERKLE}
