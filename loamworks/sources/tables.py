"""Reading and writing tables and grids with Spark's own sources."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType, columns: list[str] | None = None) -> DataFrame:
    """A CSV table with a header and a given schema; only ``columns`` are parsed."""
    df = spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")
    return df.select(*columns) if columns else df


def tables_of(spark: SparkSession, database: str = "default") -> list[str]:
    """Names of the tables of a database."""
    return sorted(t.name for t in spark.catalog.listTables(database))


def read_table(spark: SparkSession, name: str, url: str | None = None) -> DataFrame:
    """A whole table of the catalog, or of a JDBC database."""
    return spark.read.jdbc(url, name) if url else spark.table(name)


def read_named(spark: SparkSession, top: str, part: str, schema: str, columns: list[str] | None = None) -> DataFrame:
    """All CSV files below ``top`` whose name holds ``part``, united; Spark lists them, so any store will do."""
    df = spark.read.csv(top, header=True, schema=schema, pathGlobFilter=f"*{part}*.csv", recursiveFileLookup=True)
    return df.select(*columns) if columns else df


def union_on_common(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames in the columns that every frame has, in the first one's order."""
    common = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    out = frames[0].select(*common)
    for f in frames[1:]:
        out = out.unionByName(f.select(*common))
    return out


def points(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """A point layer: x and y from text or numbers; rows without both are left out."""
    xy = df.withColumns({"x": F.col(lon).try_cast("double"), "y": F.col(lat).try_cast("double")})
    return xy.filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def write_grid(cells: DataFrame, path: str, tile: int = 1000) -> None:
    """A grid as Parquet in one folder per tile; a window is read back by its tiles alone."""
    tiled = cells.withColumns({"tile_r": F.floor(F.col("r") / tile).cast("int"), "tile_c": F.floor(F.col("c") / tile).cast("int")})
    tiled.repartition("tile_r", "tile_c").write.partitionBy("tile_r", "tile_c").mode("overwrite").parquet(path)


def read_grid(spark: SparkSession, path: str, r0: int, r1: int, c0: int, c1: int, tile: int = 1000) -> DataFrame:
    """Cells of the window [r0, r1) x [c0, c1); other tiles are not opened."""
    df = spark.read.parquet(path)
    tiles = F.col("tile_r").between(r0 // tile, (r1 - 1) // tile) & F.col("tile_c").between(c0 // tile, (c1 - 1) // tile)
    inside = (F.col("r") >= r0) & (F.col("r") < r1) & (F.col("c") >= c0) & (F.col("c") < c1)
    return df.filter(tiles & inside).drop("tile_r", "tile_c")


def write_reports(reports: dict[str, DataFrame], top: str, form: str = "csv") -> None:
    """One folder per report, written as one file each: reports are small by nature."""
    for name, df in reports.items():
        writer = df.coalesce(1).write.mode("overwrite")
        writer.csv(f"{top}/{name}", header=True) if form == "csv" else writer.parquet(f"{top}/{name}")


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """A catalog table created from a frame, or replaced by it; its files lie at ``path`` or in the warehouse."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def message_kind(line: Column) -> Column:
    """``error`` or ``warning`` if the line has the word, in any case; error first."""
    return F.when(line.rlike("(?i)error"), "error").when(line.rlike("(?i)warning"), "warning")


def six_digits(text: Column) -> Column:
    """The first six digits in a row, or null."""
    return F.nullif(F.regexp_extract(text, r"([0-9]{6})", 1), F.lit(""))


def message_lines(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, line, kind, code) of the lines of a text that hold a warning or error; lines count from 1."""
    lines = df.select(*key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("_n", "_line"))
    found = lines.select(*key, (F.col("_n") + 1).alias("line"), message_kind(F.col("_line")).alias("kind"), six_digits(F.col("_line")).alias("code"))
    return found.filter(F.col("kind").isNotNull())


def scan_logs(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, kind, code) of the messages in text files."""
    files = spark.read.text(path, wholetext=True).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return message_lines(files, ["file"], "value")


def safe_names(df: DataFrame, longest: int = 10) -> DataFrame:
    """Column names cut to the length that old vector formats allow, made unique by a number."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        name = re.sub(r"\W", "_", c)[:longest]
        n = seen.get(name, 0)
        seen[name] = n + 1
        names.append(name if not n else f"{name[: longest - len(str(n)) - 1]}_{n}")
    return df.toDF(*names)
