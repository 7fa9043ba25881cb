"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.chat import neighbour_pairs, preference_turns, tokenized
from changeflow.llm.decontaminate import find_contaminated
from changeflow.llm.exact_dedup import exact_dedup
from changeflow.llm.merkle import build_manifest, folded, path_digest, proofs
from changeflow.llm.minhash import minhash_components
from changeflow.llm.ngram_join import ngram_components
from changeflow.llm.packing import pack_documents
from changeflow.llm.phrase_dedup import remove_repeats
from changeflow.llm.phrases import collocations
from changeflow.llm.quality import resample_quality
from changeflow.llm.secrets import scan_secrets
from changeflow.llm.token_files import token_digests, write_token_files
from changeflow.llm.toxicity import score_toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup(table(spark, sf_dir, "documents"), keep="largest")
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_components(table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "items", "coverage")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
        "n_linked",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(write_token_files(table(spark, sf_dir, "documents")))


def op9_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return tokenized(preference_turns(turns, neighbour_pairs(turns))).drop("ids", "mask")


def op10_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row proved; where 7 divides the CRC of its id, with a length that is one too many."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    proved = proofs(build_manifest(docs, claims={"n_chars": claimed}))
    end = folded(F.coalesce("claimed", "leaf"), F.col("path"))
    return proved.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        path_digest(F.col("path")).alias("proof_sha256"),
        end.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_components(table(spark, sf_dir, "documents"), size=5, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_ngram_join,
        op3_decontamination,
        op4_best_fit_packing,
        op5_secret_scan,
        op6_toxicity,
        op7_quality,
        op8_token_files,
        op9_preference_chat,
        op10_phrase_dedup,
        op11_merkle,
        op12_phrases,
        op13_minhash,
    )
}
