"""Exact line dedup with levelled sorted runs of line hashes, DataFrame operations only.

A line's key is the line with blanks stripped at both ends and A-Z lower-cased. Keys
of at least ``LEAST`` code points that several documents hold lose all their lines
except those in the document with the smallest id.

The lines' 128-bit key hashes are staged once, by batch. Batches of ascending id ranges go
through the runs: a batch's distinct keys merge-join the runs of the batches before it;
keys that none of them has form a new run, in hash buckets and sorted by hash, so that no
later join exchanges or sorts it. When a level holds ``FANOUT`` runs they are merged into
one run of the next level, so a batch meets few runs. Since ids ascend from batch to
batch, the run that holds a key holds its smallest document.

A hot line is summed up before any exchange (one row per key and task), and the join
that brings the verdict back to its lines is an equi-join that Spark splits when skewed.

Null text: one empty line. Null ids count as one document after all others. Rows with
an equal id are one document. Repeated rows are all kept, each with the same lines; a
tie, the key in several lines of its first document, keeps them all. A very long text is
one row of many lines. An empty table gives no rows. Other columns stay as they are,
whatever their names.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm.common import LAST_ID, shared_dir, spare, staged, whole

# The blanks of the key, x20 and x09 to x0D, and the letters that are folded.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST = 10
#: Batches at least, documents of a batch at most (about), and runs of a level.
BATCHES, BATCH_ROWS, FANOUT = 4, 50_000_000, 2


def key_of(line: Column) -> Column:
    """The key; lower() folds A-Z alone where all bytes are ASCII, translate() elsewhere."""
    key = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(key) == F.char_length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


class Runs:
    """Levels of runs (h1, h2, first): tables in hash buckets, sorted by hash in each, so that merge joins on the hash neither exchange nor sort them."""

    #: What lets a scan of one sorted file per bucket count as sorted.
    SORTED = "spark.sql.legacy.bucketedTableScan.outputOrdering"

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.names: list[str] = []
        self.top = shared_dir(spark)
        self.before = spark.conf.get(self.SORTED)

    def __enter__(self) -> Runs:
        self.spark.conf.set(self.SORTED, "true")
        return self

    def __exit__(self, *_) -> None:
        """The tables leave the catalog; their files stay for what reads them later."""
        self.spark.conf.set(self.SORTED, self.before)
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def save(self, df: DataFrame) -> str:
        """Write rows that are dealt by (h1, h2), as after a join on them: one file for each bucket."""
        name = f"run_{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", f"{self.top}/{name}").saveAsTable(name)
        self.names.append(name)
        return name

    def plain(self, name: str) -> DataFrame:
        """A table's files without their buckets: Spark splits a join of skewed rows only if it exchanges both sides."""
        return self.spark.read.schema(self.spark.table(name).schema).parquet(f"{self.top}/{name}")

    def seen(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``seen``, the smallest id that the runs have for a key: a merge join with each run. A key is in one run at most."""
        runs = [name for level in self.levels for name in level]
        for k, name in enumerate(runs):
            run = self.spark.table(name).filter("seen is null").select("h1", "h2", F.col("first").alias(f"seen{k}"))
            keys = keys.join(run.hint("merge"), ["h1", "h2"], "left")
        found = F.coalesce(F.lit(None).cast("long"), *(f"seen{k}" for k in range(len(runs))))
        return keys.withColumn("seen", found).drop(*(f"seen{k}" for k in range(len(runs))))

    def add(self, name: str) -> None:
        """A new run at the lowest level; full levels are compacted into the next."""
        at = 0
        while True:
            if at == len(self.levels):
                self.levels.append([])
            self.levels[at].append(name)
            if len(self.levels[at]) < self.fanout:
                return
            full, self.levels[at] = self.levels[at], []
            fresh = union([self.plain(n).filter("seen is null").select("h1", "h2", "first", "seen") for n in full])
            name = self.save(fresh.repartition(self.buckets, "h1", "h2"))
            at += 1


def union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionAll, parts)


def edges_of(docs: DataFrame, batches: int) -> list[int]:
    """Upper ids of the batches but the last: quantiles of the ids, at most ``batches`` - 1 numbers."""
    found = docs.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(LAST_ID)), [i / batches for i in range(1, batches)], 10_000)).first()[0]
    return sorted(set(found or []))


def verdicts(docs: DataFrame, batches: int | None = None, least: int = LEAST) -> DataFrame:
    """(id, row_hash, pos) for every line of at least ``least`` code points whose key a document of smaller id holds."""
    if batches is None:
        batches = max(BATCHES, -(-docs.count() // BATCH_ROWS))
    edges = edges_of(docs, batches)
    split = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.xxhash64(whole()).alias("row_hash"), lines_of(whole()).alias("lines"))
    row = split.select("id", "row_hash", F.posexplode("lines").alias("pos", "line"))
    keyed = row.select("id", "row_hash", "pos", key_of(F.col("line")).alias("key")).filter(F.char_length("key") >= least)
    hashed = keyed.select("id", "row_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))
    # a batch's lines lie in a folder of their own: a batch reads no others
    number = F.expr(f"aggregate(array({', '.join(f'{e}L' for e in edges)}), 0, (m, e) -> m + cast(id > e as int))") if edges else F.lit(0)
    lines = staged(hashed.withColumn("batch", number), "lines", partition="batch")
    parts = []
    with Runs(docs.sparkSession) as runs:
        for k in range(len(edges) + 1):
            batch = lines.filter(F.col("batch") == k)
            keys = runs.seen(batch.groupBy("h1", "h2").agg(F.min("id").alias("low"), F.max("id").alias("high")))
            name = runs.save(keys.select("h1", "h2", F.coalesce("seen", "low").alias("first"), "high", "seen"))
            shared = runs.plain(name).filter("first < high").select("h1", "h2", "first")
            parts.append(batch.join(shared, ["h1", "h2"]).filter("id > first").select("id", "row_hash", "pos"))
            if k < len(edges):
                runs.add(name)
    return union(parts)


def mark(docs: DataFrame, batches: int | None = None, least: int = LEAST, kept: str = "kept_lines", lines: str = "n_lines", dropped: str = "n_dropped") -> DataFrame:
    """All columns of ``docs``, the kept lines (array) and the numbers of lines and of dropped lines; columns of these three names are replaced, no others."""
    docs = docs.drop(kept, lines, dropped)
    id_, hash_, drops_ = spare(docs, "_id", "_row_hash", "_drops")
    # One bit per line in words of 64: little comes back to a document, and a line's test takes constant time.
    drops = (
        verdicts(docs, batches, least)
        .groupBy("id", "row_hash", F.expr("cast(pos div 64 as int)").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
        .groupBy("id", "row_hash")
        .agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("sparse"))
        .select(
            F.col("id").alias(id_),
            F.col("row_hash").alias(hash_),
            F.expr("aggregate(sparse, cast(array() as array<bigint>), (a, x) -> concat(a, array_repeat(0L, x.word - size(a)), array(x.bits)))").alias(drops_),
        )
    )
    keyed = docs.withColumns({id_: F.coalesce("doc_id", F.lit(LAST_ID)), hash_: F.xxhash64(whole())})
    joined = keyed.join(drops.hint("shuffle_hash"), [id_, hash_], "left").withColumn(kept, lines_of(whole()))
    left = F.expr(f"CASE WHEN `{drops_}` IS NULL THEN `{kept}` ELSE filter(`{kept}`, (x, i) -> coalesce(getbit(get(`{drops_}`, cast(i div 64 as int)), i % 64), 0) = 0) END")
    return joined.withColumn(lines, F.size(kept).cast("long")).withColumn(kept, left).withColumn(dropped, F.col(lines) - F.size(kept)).drop(id_, hash_, drops_)


def dedup(docs: DataFrame, batches: int | None = None, least: int = LEAST) -> DataFrame:
    """``docs`` with the kept lines as ``text`` (null stays null) and, where there is such a column, ``n_chars`` counted anew; all other columns as they are."""
    kept, lines, dropped = spare(docs, "kept_lines", "n_lines", "n_dropped")
    found = mark(docs, batches, least, kept, lines, dropped).withColumn("text", F.when(F.col("text").isNotNull(), F.array_join(kept, "\n")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length(whole()).cast("long"))
    return found.select(*docs.columns)


def dedup_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for every document."""
    found = mark(docs.select("doc_id", whole().alias("text")))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.array_join("kept_lines", "\n"), 256).alias("kept_sha256"))


DIGEST_SQL = r"""
WITH l AS (
  SELECT d.doc_id, u.line, u.pos,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM documents d, LATERAL (SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS pos) u
), k AS (
  SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)
)
SELECT l.doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE l.doc_id > k.first) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE k.first IS NULL OR l.doc_id = k.first), '')) AS kept_sha256
FROM l LEFT JOIN k ON l.key = k.key AND length(l.key) >= 10
GROUP BY l.doc_id
"""
