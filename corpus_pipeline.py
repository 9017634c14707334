"""A corpus from raw documents to token ids, in stages that each read what the one before has written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pixelframe.llm import bpe, mixing, pii, quality, simhash
from pixelframe.llm.common import materialize_table, table

#: Documents that score below this are likelier bad than the classifier may let pass.
MIN_QUALITY = 0.3


#: Rows here are whole documents: batches for Python workers are cut by these, unless the session's are smaller.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def _lean(spark: SparkSession) -> None:
    """Let the session hand whole documents to Python in small batches."""
    conf = spark.conf
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= ARROW_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on the labelled ones, does not reject."""
    _lean(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(docs, model) >= MIN_QUALITY)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest id."""
    _lean(spark)
    return simhash.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    _lean(spark)
    return pii.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares: a row for each whole or partial copy that the mix takes."""
    _lean(spark)
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every row; the ids decode to its text."""
    _lean(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                          keep_ids=True)


STAGES = [("quality", good_documents), ("simhash", one_of_each_group), ("personal_data", without_personal_data),
          ("mixing", mixed_sources), ("bpe", token_ids)]

#: Neither the classifier nor the tokenizer has a form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
