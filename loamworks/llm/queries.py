"""The registered queries of this subpackage: thin calls of the operators over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm import bpe, collocations, fingerprints, html, linededup, media, negatives, packing, quality, simhash, toxicity, windows
from loamworks.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document; null and empty texts are scored as empty, repeated rows are scored each."""
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page; null and empty html gives an empty text, repeated rows are read each."""
    found = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.selectExpr("page_id", "url", "text", "cast(char_length(text) as long) as n_chars")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of every document's ids and of its decoded bytes; null and empty texts have no ids, very long ones are encoded whole."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how many others are near; null texts are empty, equal ids are ordered by the hash of their texts."""
    return fingerprints.edit_likeness(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before and after repeated ones are dropped; null and empty texts are one empty line."""
    return linededup.dedup_digest(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens; null and empty texts are one token, repeated rows are packed each."""
    return packing.packed_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document; null and empty texts are scored by the statistics of the empty text, repeated rows are scored each."""
    return quality.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored image of every document's bytes, read back; null and empty texts are 64 zero bytes, equal texts give equal values."""
    return media.document_media(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; texts without words have fingerprint zero and link like others."""
    return simhash.document_components(table(spark, sf_dir, "documents"))


def op10_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as padded rows of 2048 ids with segment lengths and position resets; null and empty texts are one token."""
    return packing.matrices(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of documents; null texts and tables without words give none."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in windows of 2048 tokens; null and empty texts are one token, repeated rows are packed each."""
    return windows.packed_windows(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three hard negatives for each anchor and positive of embeddings; rows that cannot be scored take no part."""
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.expr(negatives.SHIFTED))
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_html_extraction,
        op3_byte_bpe,
        op4_fingerprints,
        op5_line_dedup,
        op6_best_fit_packing,
        op7_quality_classifier,
        op8_media_columns,
        op9_simhash_near_dedup,
        op10_token_matrices,
        op11_collocations,
        op12_packing,
        op13_hard_negatives,
    )
}
ORACLES = {"op5_line_dedup": linededup.DIGEST_SQL, "op11_collocations": collocations.COLLOCATIONS_SQL, "op13_hard_negatives": negatives.NEGATIVES_SQL}
