"""Exact quantiles without bringing a column, or a group of it, into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamworks.session import staged


def quantiles(df: DataFrame, asked: dict[str, tuple[str, float]], by: list[str] | None = None) -> DataFrame:
    """One row (with ``by``: one per group that has values), with a column per name: the (column, share) quantile, interpolated between neighbours.

    Equal values are counted first. Counts are dealt by ranges of the value, so a task holds one range whatever the
    groups' sizes; the ranges' totals, a row for each range and group, tell the rank that each begins with. Nulls and
    NaN are no values; without values the quantile is null.
    """
    by = by or []
    columns = list(dict.fromkeys(c for c, _ in asked.values()))
    spread = F.explode(F.array(*(F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns))))
    counts = df.select(*by, spread.alias("_x")).select(*by, "_x.column", "_x.v").filter("v is not null and not isnan(v)").groupBy(*by, "column", "v").agg(F.count("*").alias("n"))
    part = [*by, "column"]
    dealt = staged(counts.repartitionByRange(*part, "v").withColumn("part", F.spark_partition_id()), "values")
    sums = dealt.groupBy(*part, "part").agg(F.sum("n").alias("s"))
    begins = sums.select(*part, "part", (F.sum("s").over(Window.partitionBy(*part).orderBy("part")) - F.col("s")).alias("before"), F.sum("s").over(Window.partitionBy(*part)).alias("total"))
    ends = F.sum("n").over(Window.partitionBy(*part, "part").orderBy("v"))
    ranked = dealt.withColumn("end", ends).join(begins, [*part, "part"]).withColumn("end", F.col("end") + F.col("before"))

    def at(rank: Column, i: int) -> Column:
        """The value of this rank, counted from 0."""
        return F.max(F.when((F.col("column") == i) & (F.col("end") - F.col("n") <= rank) & (rank < F.col("end")), F.col("v")))

    out = []
    for name, (column, share) in asked.items():
        i, place = columns.index(column), F.lit(float(share)) * (F.col("total") - 1)
        low, high = at(F.floor(place), i), at(F.ceil(place), i)
        between = F.max(F.when(F.col("column") == i, place - F.floor(place)))
        out.append((low + (high - low) * between).alias(name))
    return ranked.groupBy(*by).agg(*out)


def medians(df: DataFrame, names: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """As ``quantiles``, for the half of each column."""
    return quantiles(df, {name: (column, 0.5) for name, column in names.items()}, by)
