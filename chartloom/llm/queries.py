"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import alignment, centroids, decontaminate, jaccard_join, language_id, line_dedup, quality_lm, simhash, sql, substring_dedup, suffix_dedup, toxicity, warc
from chartloom.llm.bpe import Tokenizer
from chartloom.llm.registry import ORACLE, QUERIES, query, table
from chartloom.llm.rows import fold

__all__ = ["ORACLE", "QUERIES"]


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query(sql.LINE_DEDUP)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.summary(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(sql.SUBSTRING_DEDUP)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(sql.JACCARD_JOIN)
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"), size=3, percent=90)


@query()
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.judge(table(spark, sf_dir, "documents"))


@query(sql.DECONTAMINATION)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query()
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_copies(table(spark, sf_dir, "documents"), keep="none")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(sql.WARC)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc.write(warc.roles(table(spark, sf_dir, "pages")))
    return warc.read(packages, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query()
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return tokenizer.round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *files, public_tokenizers.PATTERN, digest=True).withColumnRenamed("groups", "groups_sha256")


@query(sql.CENTROIDS)
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dimension=64, scale=64.0, seed="1")
    name = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", name)


@query()
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.link(table(spark, sf_dir, "documents"), size=3, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
