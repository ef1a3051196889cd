"""Registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common, decontaminate, fingerprint, language, language_model, licenses, near_dedup, packing, ranked_search, repeats, substrings, token_files, url_filter, whitening
from sunledger.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return common.shipped(spark).read.parquet(f"{sf}/{name}.parquet")


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


#: Fixed by the query's contract.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = licenses.scan(docs, licenses.fit(docs))
    sure = F.filter("notices", lambda x: x["confirmed"])
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("notices").cast("long").alias("n_predicted"),
        F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
    )


def op2_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)))
    return language_model.score(docs)


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))
    model = language.fit(docs.where("not held_out"), public_tokenizers.path("piece_bpe_32k.model"))
    return language.predict(docs, model, "doc_id", "held_out")


def op4_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf, "documents"))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("text_hash")


def op9_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents")).drop("text_hash", "group_id")


def op10_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages"), URL_RULES)


def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), byte_bpe())


def op6_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.removals(table(spark, sf, "documents"))


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = common.Stage(spark).path("token-ids")
    token_files.write(table(spark, sf, "documents"), folder, byte_bpe())
    return token_files.read_digests(spark, folder)


def op11_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.removals(table(spark, sf, "documents"))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    # what does not fit 64 bits is null
    return whitening.whiten(table(spark, sf, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_language_id": op3_language_id,
    "op4_fingerprints": op4_fingerprints,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_token_files": op7_token_files,
    "op8_decontamination": op8_decontamination,
    "op9_near_dedup": op9_near_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_whitening": op12_whitening,
    "op13_ranked_search": op13_ranked_search,
}

