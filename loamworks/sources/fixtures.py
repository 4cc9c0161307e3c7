"""Survey-like tables derived from the driver's tables; one SQL text serves Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "conversations")

#: In order of dependence.
FIXTURES = {
    "cells": """
SELECT r, c,
  CASE WHEN k % 53 = 17 THEN NULL ELSE CAST(1000 + 3*r - 2*c + (ck % 20) AS DOUBLE) END AS dem,
  CAST((k*37 + ck*11) % 97 + 3 AS DOUBLE) AS b2,
  CAST((k*41 + ck*13) % 97 + 3 AS DOUBLE) AS b3,
  CAST((k*43 + ck*17) % 97 + 3 AS DOUBLE) AS b4,
  CAST((k*47 + ck*19) % 127 + 3 AS DOUBLE) AS b8,
  CAST((k*53 + ck*23) % 97 + 3 AS DOUBLE) AS b11,
  CAST((k*59 + ck*29) % 97 + 3 AS DOUBLE) AS b12,
  CAST(1 + (r5*3 + c8) % 12 AS INT) AS dl,
  CAST(1 + (CAST(floor(r/9.0) AS INT) + 2*CAST(floor(c/11.0) AS INT)) % 9 AS INT) AS dz,
  CAST(1 + (CAST(floor(r/4.0) AS INT) + CAST(floor(c/6.0) AS INT)) % 6 AS INT) AS pos,
  CAST(r5*1000 + c8 AS INT) AS zone_id,
  CASE WHEN ck % 41 = 0 THEN 1 ELSE 0 END AS water
FROM (SELECT k, ck, r, c, CAST(floor(r/5.0) AS INT) AS r5, CAST(floor(c/8.0) AS INT) AS c8
      FROM (SELECT o_orderkey AS k, o_custkey AS ck,
                   CAST(floor(o_orderkey/100.0) AS INT) AS r, CAST(o_orderkey % 100 AS INT) AS c
            FROM orders) a) b""",
    # the same grid with cells missing here and there
    "thin": "SELECT * FROM cells WHERE (r*7 + c*13 + r*c) % 7 NOT IN (2, 5)",
    "sites": """
SELECT c_custkey AS site_id,
  CAST((c_custkey*37) % 1000 AS DOUBLE)/10 AS x, CAST(c_custkey AS DOUBLE)/10 AS y,
  CAST(c_custkey*13 % 50 AS DOUBLE)/10 + 4 AS ph, c_acctbal AS val, c_mktsegment AS cls,
  c_nationkey AS area_id
FROM customer""",
    "samples": """
SELECT l_orderkey AS site_id, l_linenumber AS layer, l_partkey AS lab_id, l_suppkey AS run_id,
  l_extendedprice AS ord,
  CASE WHEN l_partkey % 29 = 0 THEN NULL
       WHEN l_partkey % 19 = 0 THEN '/'
       WHEN l_partkey % 23 = 0 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '*')
       ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS val_txt,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag
FROM lineitem""",
    "units": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS area,
  n_name AS township, r_name AS tl, n_name AS yl, p_type AS ts, p_brand AS tz,
  CASE l_returnflag WHEN 'A' THEN '水田' WHEN 'N' THEN '旱地' ELSE '水浇地' END AS land,
  CASE WHEN l_linenumber <= 2 THEN '山地坡下' WHEN l_linenumber <= 4 THEN '山地坡中' ELSE '山地坡上' END AS position,
  CAST(p_size AS DOUBLE) AS thickness, 4 + l_quantity/10 AS ph, l_tax*100 AS organic
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "zones": """
SELECT zone_id, min(dl) AS dl, count(*) AS n_cells,
  CAST(min(c) AS DOUBLE) AS x0, CAST(min(r) AS DOUBLE) AS y0,
  CAST(max(c) + 1 AS DOUBLE) AS x1, CAST(max(r) + 1 AS DOUBLE) AS y1
FROM cells GROUP BY zone_id""",
    "climate": "SELECT user_id % 10 AS area_id, date_trunc('month', ts) AS month, value FROM events",
}

#: Array functions differ between the engines, so this one is written for each. Shares are divided as doubles: engines differ on floats.
PROBS = "SELECT vec_id, label % 5 AS truth, {columns} FROM (SELECT vec_id, label, {firsts} FROM embeddings) e"


def probs_sql(element: str) -> str:
    firsts = ", ".join(f"CAST(abs({element}(embedding, {i + 1})) AS DOUBLE) AS a{i}" for i in range(5))
    total = " + ".join(f"a{i}" for i in range(5))
    return PROBS.format(columns=", ".join(f"a{i}/({total}) AS p{i}" for i in range(5)), firsts=firsts)


def mentioned(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", sql)]


def needed(sql: str) -> list[str]:
    """The fixtures that a text mentions, with those they depend on, in order."""
    found = set(mentioned(sql, [*FIXTURES, "probs"]))
    if found & {"zones", "thin"}:
        found.add("cells")
    return [n for n in [*FIXTURES, "probs"] if n in found]


def with_fixtures(sql: str) -> str:
    """A DuckDB statement: ``sql`` behind the common table expressions that it mentions."""
    views = {**FIXTURES, "probs": probs_sql("list_extract")}
    heads = [f"{n} AS ({views[n]})" for n in needed(sql)]
    recursive = "RECURSIVE " if "RECURSIVE" in sql else ""
    body = sql.strip().replace("WITH RECURSIVE ", "WITH ", 1) if recursive else sql.strip()
    if not heads:
        return sql.strip()
    rest = ", " + body[5:] if body.startswith("WITH ") else body
    return f"WITH {recursive}{', '.join(heads)}{rest if rest.startswith(',') else chr(10) + rest}"


class Tables:
    """The driver's tables and the fixtures as DataFrames, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in FIXTURES and name != "probs":
            raise AttributeError(name)
        sql = probs_sql("element_at") if name == "probs" else FIXTURES[name]
        if name in ("zones", "thin"):
            sql = sql.replace("FROM cells", f"FROM ({FIXTURES['cells']}) cells")
        for base in BASE:
            sql = re.sub(rf"\b(FROM|JOIN) {base}\b", rf"\1 parquet.`{self.sf_dir}/{base}.parquet` AS {base}", sql)
        return self.spark.sql(sql)
