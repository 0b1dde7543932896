"""The registered queries of this subpackage: thin, each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import ann, bpe, chat, decontam, fim, html_main, jaccard, langid, quality, secrets, urls, warc, whiten
from tidewheel.llm.shared import read, shared_dir


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.load(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(bpe.round_trip(read(spark, sf_dir, "documents"), vocabulary))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(two)
    return chat.digests(chat.format_trees(chat.chained(rows)))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digests(decontam.decontaminate(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


#: Fixed values of the contract.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(read(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(read(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_main.extract(pages, html_main.train()).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    warc.write(warc.records(read(spark, sf_dir, "pages")), path)
    return warc.captures(warc.read(spark, path))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.usable(read(spark, sf_dir, "embeddings"))
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whiten.fit(vectors)
    return whiten.components(whiten.transform(vectors, model), model)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_chat": op2_chat,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_urls": op5_urls,
    "op6_jaccard": op6_jaccard,
    "op7_language": op7_language,
    "op8_main_text": op8_main_text,
    "op9_warc": op9_warc,
    "op10_nearest": op10_nearest,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_secrets": op12_secrets,
    "op13_whitening": op13_whitening,
}
ORACLE_SQL: dict[str, str] = {"op2_chat": chat.ORACLE, "op3_decontaminate": decontam.ORACLE, "op6_jaccard": jaccard.ORACLE, "op9_warc": warc.ORACLE, "op11_fill_in_middle": fim.ORACLE, "op12_secrets": secrets.ORACLE}
