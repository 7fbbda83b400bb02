"""Registered queries of the corpus operators: contract columns over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.llm import language, toxicity, vector_codes
from lakegate.llm.common import read_table, text_or_empty, written
from lakegate.llm.exact_dedup import normalised, refine
from lakegate.llm.html_extract import extract_pages
from lakegate.llm.imatch import fingerprints
from lakegate.llm.line_dedup import drop_shared_lines
from lakegate.llm.minhash import near_duplicates
from lakegate.llm.mixing import mix
from lakegate.llm.oracles import ORACLES
from lakegate.llm.packing import pack, with_crc
from lakegate.llm.piece_encoding import encode_documents
from lakegate.llm.token_alignment import align_documents, with_link_counts
from lakegate.llm.url_filter import judge, labelled_urls, train


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("_row", "first")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).drop("_row")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_shared_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = language.fold(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels").where(~held_out))
    return (docs.select("doc_id", held_out.alias("held_out"), toxicity.scorer(model)("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.7).cast("int")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"), train(labelled_urls(spark)))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_crc(pack(read_table(spark, sf_dir, "documents")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = language.fold(F.col("doc_id"), 5) == 0
    model = language.train(docs.where(~held_out))
    return (docs.select("doc_id", held_out.alias("held_out"), language.predictor(model)("text").alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.rejected"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    docs = docs.withColumn("text_sha256", F.sha2(normalised(text_or_empty()), 256))
    return refine(docs, carry=("text_sha256",)).drop("_row")


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups_sha256 = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = written(align_documents(read_table(spark, sf_dir, "documents"))
                      .withColumn("groups_sha256", groups_sha256).drop("groups"))
    return with_link_counts(aligned).drop("row")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_fingerprints": op3_fingerprints,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_packing": op8_packing,
    "op9_language": op9_language,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_piece_encoding": op11_piece_encoding,
    "op12_token_alignment": op12_token_alignment,
    "op13_vector_codes": op13_vector_codes,
}

__all__ = ["QUERIES", "ORACLES"]
