"""A training-corpus pipeline of five operators over the table ``documents``.

Toxic documents go; one document of each class of near duplicates stays; secrets are masked; sources are mixed to equal
weight; the texts are encoded to token ids. Each stage takes (spark, docs, sf_dir) and works on all that the stage
before kept; between stages the rows are written as Parquet to the shared folder and read again. Tables that a stage
makes on its way are removed once its result is written; the stages' results stay, so that a run which was cut off can be
taken up from the last of them.

Defined cases, for every stage: null texts are empty texts and stay null; null ids, sources and languages are values like
others; texts are taken whole at any length; columns beside those of ``documents`` are dropped, so none can clash; an
empty table gives an empty table with the stage's columns.

* toxicity: a document at the threshold or above goes, an unlabelled one as well; repeated rows go or stay together. Without
  labels of both classes all scores are the share of toxic labels, so nothing goes unless nearly all labels are toxic.
* jaccard_join: of a class the row of least id stays (null ids last, of equal rows one); texts without words are near to
  nothing but their equals.
* secret_scan: overlapping findings get one mark; ``n_chars`` of a null text stays as it is.
* poisson_mix: a document has as many rows as it is drawn, so ids repeat from here on; a null source is a source.
* byte_bpe: a null text has no ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm import byte_bpe, jaccard_join, mixing, secrets, toxicity
from quillsieve.llm.common import scratch, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from all labelled ones, does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), F.lit(True))
    return toxicity.score(docs.select(COLUMNS), model).where("predicted = 0").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each class of texts linked by a Jaccard similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs.select(COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and ``n_chars`` brought up to date."""
    masked = secrets.redact(secrets.scan(docs.select(COLUMNS)))
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by Poisson counts whose means give all sources equal weight; the total stays as it is."""
    return mixing.mix(docs.select(COLUMNS)).select(COLUMNS)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids under the byte-level tokenizer, and whether they decode to the text."""
    tokenizer = byte_bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = byte_bpe.encode(docs.select(COLUMNS), tokenizer, decoded_col="decoded")
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("poisson_mix", mix_sources),
    ("byte_bpe", to_tokens),
]

#: No SQL has the learned toxicity model or the tokenizer's merges; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(written(stage(spark, docs, sf_dir), f"stage-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
