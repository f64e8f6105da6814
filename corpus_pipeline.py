"""The training-data pipeline: five stages from ``documents`` to token ids.

Each stage takes all rows its predecessor kept and is written as a table below the shared checkpoint folder before the next
one reads it, so a lost executor costs a part of one stage.

1. toxicity: documents that the toxicity operator rejects (score of 0.5 or more) go.
2. simhash: of each group of near-duplicates (3-word shingles, at most 2 bits) the document with the least id stays.
3. decontaminate: documents in which a benchmark item occurs go.
4. secrets: secrets in the texts are replaced by a mark; n_chars follows the text. No document goes.
5. bpe: token ids and their number are added.

No stage can be said in SQL as a whole (learned models, fingerprints, edit distances), so ORACLE_SQL is None and the
tests hold the stages against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listledger.llm import bpe, decontam, secrets, simhash, toxicity
from listledger.llm.common import documents, fresh, write_through
from listledger.llm.queries import tokenizer_path, toxicity_model
from listledger.session import table

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = fresh(docs, "_toxic")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir), name=score)
    return scored.where(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, shingle=3, error=2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mark = "[SECRET]"
    out = secrets.redact(docs, secrets.train(docs), mark=mark)
    if "n_chars" not in docs.columns:
        return out
    size = F.when(F.col("text").contains(mark), F.length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, tokenizer_path()).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
