"""A training corpus from ``documents``: language ID, near duplicates, benchmark decontamination, secrets, packing.

Each stage works on all that its predecessor kept. All but the last return the columns of ``documents``:

* language_id drops documents without a language (no text or no letter), or whose words are not explained by any
  (LEAST_SCORE); without labelled documents there is no model and all pass.
* near_duplicates keeps the document of smallest doc_id in each group of 5-word-shingle similarity 0.75 or more.
* decontaminate removes the words of benchmark windows, or the document if they are more than half of it.
* secrets replaces credentials by their kind.
* packing cuts the token ids into sequences of at most 1024 and returns the pieces with their ids and places.

Null texts, and those without a letter, go in language_id where a model can be learned; without one they pass, are no
near duplicates of anything, and are packed as their end id alone. Rows without doc_id are kept and judged like all
others; of rows of one doc_id, those with alike texts are one group, those with unlike texts all stay. Of equal rows one
stays; of equally small ids in a group, the text of least hash. Very long texts are worked on whole. Extra columns pass
through all stages but the last, whatever their names. Empty tables give an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from atomframe.llm import decontaminate, jaccard, langid, packing, secrets
from atomframe.llm.common import shared_dir

#: A text's words are explained if the mean of each word's largest probability is at least this with four languages,
#: and as far above the even share with any other number. A language's part of the text does not matter.
LEAST_SCORE = 0.4

#: The workers have been through the other stages when they tokenise: they remember an eighth of the usual pieces.
SHARE = 8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. Learns from the labelled documents outside the held-out fifth."""
    model = langid.train(docs.where("doc_id is not null").where(~langid.held_out()))
    if model is None:
        return docs
    even = 1 / len(model.langs)
    least = even + (1 - even) * (LEAST_SCORE - 0.25) / 0.75
    found = langid.predict(docs.select(*[F.col(f"`{c}`").alias({"lang_pred": "__lang_pred", "score": "__score"}.get(c, c)) for c in docs.columns]), model, [{"lang_pred": "__lang_pred", "score": "__score"}.get(c, c) for c in docs.columns], "__confidence")
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("__confidence") >= least)).drop("lang_pred", "score", "__confidence")
    return kept.withColumnsRenamed({"__lang_pred": "lang_pred", "__score": "score"})


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that of smallest doc_id, chosen by row, so that other texts of the same doc_id are
    judged on their own. Documents without an id come last."""
    return jaccard.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return recounted(decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return recounted(secrets.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, share=SHARE)


def recounted(docs: DataFrame) -> DataFrame:
    """n_chars after the text has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES: list[tuple[str, Callable]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]
#: Learned stages and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
