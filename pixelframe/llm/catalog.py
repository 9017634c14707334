"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (ann, bpe, conversations, hard_negatives, html_main, langid, mixing, orc_tokens, order_minhash, pii,
               quality, sharding, simhash)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_neighbours")
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@register("op5_orc_tokens")
def op5_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_tokens.write_and_digest(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("byte_bpe_50k.json"))


@register("op10_mix_sources", mixing.ORACLE_SQL)
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


@register("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@register("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@register("op6_main_text")
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_main.extract_pages(pages, html_main.learn(pages))


@register("op9_order_minhash")
def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_with_edited(table(spark, sf_dir, "documents"))


@register("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(table(spark, sf_dir, "documents")))


@register("op11_hard_negatives", hard_negatives.ORACLE_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


@register("op12_hash_tree_shards", sharding.oracle_sql(sharding.Tree.uniform()))
def op12_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), sharding.Tree.uniform()).drop("region", "rack")


@register("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
