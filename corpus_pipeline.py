"""Corpus preparation: language, near-duplicates, repeated passages, benchmark contamination, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common, decontaminate, language, near_dedup, packing, repeats

#: Language prediction is no SQL; the stages are tested against brute force.
ORACLE_SQL = None

#: Probability of its language from which a document is accepted.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an accepted language, learned from those that have ``lang``; texts that are null or have no letter go.

    ``lang`` stays as given, also where it is null.  Without any labelled document nothing can be rejected for its
    language, so all texts with a letter stay.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = language.fit(labelled, public_tokenizers.path("piece_bpe_32k.model"))
    if not model.langs:
        return docs.where(F.col("text").rlike(language.LETTER))
    names = (common.fresh("lang_pred", docs.columns), common.fresh("score", docs.columns))
    judged = language.predict(docs, model, *docs.columns, names=names)
    return judged.where((F.col(names[0]) != language.UNKNOWN) & (F.col(names[1]) >= LEAST_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest ``doc_id``."""
    return near_dedup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that repeat; ``n_chars`` follows the text.  Documents that were nothing but such passages go."""
    cut = repeats.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.where("text is null or text <> ''").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, placed in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each staged as Parquet and read again by the next."""
    stage = common.Stage(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage.save(step(spark, docs, sf_dir), name)
        stage.release()
    return docs
