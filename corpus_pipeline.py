"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet
to the shared folder and rereads as the next stage's docs:

1. language: documents whose language can't be told (no letters, or two languages as likely) go.
2. near_duplicates: of documents linked by a Jaccard index of 0.8 or more over
   5-word shingles the one with the smallest doc_id stays.
3. decontaminate: passages of ``benchmark`` are cut out; documents that are mostly benchmark go.
4. secrets: secrets are replaced by a mark.
5. encode: token ids and the decoded text, as counts and digests.

Stages 1 to 4 return the columns of ``documents``; n_chars follows the text where a stage changes it.  The first stage learns
from the lang of its own documents outside the held-out fold.  Empty input gives empty output.
ORACLE_SQL is None: the language model can't be written in SQL, so the stages are
tested against brute force one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import bpe, decontaminate, jaccard, language, secret_scan
from cohortkit.llm.common import stored, table
from cohortkit.llm.queries import WORD_BPE, language_fold

ORACLE_SQL = None


def _recounted(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(like.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs.filter(F.coalesce(language_fold(), F.lit(0)) != 2))
    # Columns are numbered meanwhile, so that none gives way to those the prediction adds.
    text = next(i for i, c in enumerate(docs.columns) if c.lower() == "text")
    told = language.predict(docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), model, text_col=f"c{text}", ambiguous_margin=0.01)
    return told.filter((F.col("lang_pred") != language.UND) & ~F.col("ambiguous")).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(decontaminate.remove(docs, table(spark, sf_dir, "benchmark")), docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(secret_scan.redact(docs), docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs.select("doc_id", "text"), WORD_BPE).select(
        "doc_id", bpe.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language", language_stage), ("near_duplicates", near_duplicate_stage), ("decontaminate", decontaminate_stage),
          ("secrets", secret_stage), ("encode", encode_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
