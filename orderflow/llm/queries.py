"""One query per operator, each over the whole of its table, with the columns its users compare."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import bpe, codes, collocations, decontaminate, factors, fingerprints, jaccard, pii, quality, repeats, sharding, tokens, warc
from orderflow.llm.common import read_table, saved
from orderflow.session import scratch_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(read_table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)
    both = bpe.decode(ids, BYTE_BPE, public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_with_next(read_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.find(docs, items, short=True)


SHARDS = [f"shard-{number:02d}" for number in range(64)]


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    placed = sharding.place(docs.select("doc_id", "source"), "doc_id", SHARDS)
    return placed.select("doc_id", "source", "slot", "shard")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.join(read_table(spark, sf_dir, "documents"), size=4, percent=85)
    return joined.select("doc_id", "n_shingles", "component_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "archives")
    warc.write(read_table(spark, sf_dir, "pages"), path, segment_bytes=8192)
    return warc.read(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def op7_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    tokens.write(read_table(spark, sf_dir, "documents"), WORD_BPE, path)
    docs = tokens.read(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return tokens.located(docs, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    base = pii.of_kind(F.col("spans"), "email", "ip", "card", "phone")
    counts = [
        F.size(pii.of_kind(F.col("spans"), kind)).cast("long").alias(f"n_{kind}")
        for kind in ("email", "ip", "card", "phone")
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
        *[F.size(pii.of_kind(F.col("spans"), kind)).cast("long").alias(f"n_{kind}") for kind in ("iban", "ssn")],
        F.concat_ws(",", F.transform("spans", lambda s: F.format_number(s.score, 1))).alias("scores"),
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove(read_table(spark, sf_dir, "documents"), min_words=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Learned without fold 0 of the labels."""
    labels = read_table(spark, sf_dir, "labels").where(quality.fold(F.col("doc_id")) != 0)
    return quality.train(read_table(spark, sf_dir, "documents"), labels, "quality")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        (quality.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.KEPT_SCORE).cast("int").alias("predicted"),
    )


def op11_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = factors.remove(read_table(spark, sf_dir, "documents"), length=100)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.mine(read_table(spark, sf_dir, "documents"), order=5, min_count=100, top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes.compress(read_table(spark, sf_dir, "embeddings"), carry_col="label")
    rows = saved(coded.rows, "codes")
    sums = saved(rows.groupBy(F.col("carried").alias("label")).agg(F.sum("error").alias("label_error")), "sums")
    listed = ",".join(str(x) for x in coded.codebooks.ravel().tolist())
    return rows.join(sums, F.col("carried").eqNullSafe(F.col("label"))).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(listed.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_lz_fingerprint": op2_lz_fingerprint,
        "op3_decontamination": op3_decontamination,
        "op4_sharding": op4_sharding,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_warc": op6_warc,
        "op7_repair_tokens": op7_repair_tokens,
        "op8_pii": op8_pii,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_quality": op10_quality,
        "op11_previous_factors": op11_previous_factors,
        "op12_collocations": op12_collocations,
        "op13_vector_codes": op13_vector_codes,
    }
