"""What the operators of this subpackage share: table access, folds and label samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamworks.session import discard, shared_dir, ship, staged

__all__ = ["LAST_ID", "TRAIN_ROWS", "discard", "fold", "shared_dir", "spare", "staged", "table", "training_rows", "whole", "wider"]

#: Labelled rows that a classifier is fitted on at most; chosen by a hash of doc_id.
TRAIN_ROWS = 20_000
#: Stands for a null id where ids are ordered: after all others.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def spare(df: DataFrame, *names: str) -> list[str]:
    """These names, each lengthened by underscores until no column of ``df`` has it: helper columns that clash with nothing."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n


def training_rows(docs: DataFrame, labels: DataFrame, label: str, train: Column, limit: int = TRAIN_ROWS) -> DataFrame:
    """(text, label) of at most ``limit`` labelled documents in the training folds.

    The ids are those with the smallest hash, so the sample does not depend on
    row order. The sample of ids is broadcast: at most ``limit`` rows of 12 bytes.
    Null ids and null labels are left out; a repeated label row counts once.
    """
    picked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(train)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    return docs.select("doc_id", whole().alias("text")).join(F.broadcast(picked), "doc_id").select("text", "label")


def wider(df: DataFrame, added: str) -> T.StructType:
    """The schema of ``df`` followed by the columns of a DDL string; the frame's own schema object stays as it is."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(added).fields])
