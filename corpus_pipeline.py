"""The corpus pipeline: each stage calls one operator and returns the columns of documents; the last packs.

Columns beside doc_id and text pass through the first four stages whatever their names
(n_chars is counted anew where lines go). Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm import linededup, packing, quality, simhash, toxicity
from loamworks.llm.common import spare, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar scores below 0.5: null and empty texts, and each of repeated rows, stay."""
    grammar = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    (into,) = spare(docs, "score")
    return toxicity.score(docs, grammar, into).filter(F.col(into) < 0.5).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more; null and empty texts are scored like any others, repeated rows alike."""
    trees = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    (into,) = spare(docs, "score")
    return quality.score(docs, trees, into).filter(F.col(into) >= 0.5).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a document of smaller id holds; all rows stay, null texts stay null, null ids are one document after all others."""
    return linededup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, a similarity of 0.8 or more. Texts without words are copies of each other; of ties in id the smallest hash stays, of repeated rows one."""
    return simhash.near_dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every kept document in sequences of 2048 tokens; null and empty texts are one token, repeated rows are packed each."""
    return packing.packed_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs


#: SQL cannot express the learned stages; tests hold each stage against brute force.
ORACLE_SQL = None
