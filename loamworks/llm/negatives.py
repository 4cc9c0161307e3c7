"""Hard negatives by rotated one-bit codes with deterministic intervals, then integer scores.

A vector becomes integers. Its code has ``LEVELS`` levels: the vector is rotated, its signs
are kept as bits, and with them its alignment, the length of its projection on the sign
vector; what the projection leaves is rotated again and coded at the next level. The length
of the last remainder is stored too. An anchor goes through the same rotations and is cut
into ``BITS`` bit planes a level, so its product with each sign vector is a sum of popcounts.
The sum over the levels estimates the inner product. By Cauchy-Schwarz it is wrong by at most
the remainder's length times the anchor's, and what the bit planes round is bounded as well:
an interval that always holds the true value. Rows whose interval cannot enter the answer are
left out, the others are scored in integers. So the result is exact whatever the codes are.

Anchors are dealt to blocks and rows to stripes of bounded size; each block meets each stripe
once, a task compares them in tiles and returns a few rows per anchor. Positives are found
first, their scores bound the search for negatives.

Rows without id, label or vector, or with a component that is null or not finite, take no part;
nor do rows whose number of components is not the table's most frequent one (of ties, the
greatest), or whose products could leave 64 bits. Repeated rows are rows of their own: each is
an anchor, a positive, a negative. Ties in score go by id. Vectors of zeros score 0 with all.
A table without anchors, or empty, gives no rows. Other columns are not read, so none can clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamworks.llm.common import staged

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
LEVELS, BITS, SEED = 4, 6, 17
#: Rows of a stripe and anchors of a block, about, and anchors of a tile.
STRIPE, BLOCK, TILE = 8192, 2048, 32
#: The label of the contract: every seventh is moved on by one.
SHIFTED = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


@lru_cache(maxsize=2)
def rotations(dim: int, levels: int) -> list[np.ndarray]:
    """Seeded orthogonal matrices, one per level."""
    return [np.linalg.qr(np.random.default_rng([SEED, k]).standard_normal((dim, dim)))[0] for k in range(levels)]


def code_width(dims: int) -> int:
    """Components of a code: those of the vector, padded to whole 64-bit words."""
    return max(64, -(-dims // 64) * 64)


def coded_vectors(ints: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Sign words (rows x levels x words) and, per row, the alignments of the levels, the last remainder's length and the vector's."""
    rows, dims = ints.shape
    width = code_width(dims)
    rest = np.zeros((rows, width))
    rest[:, :dims] = ints
    length, words, aligned = np.linalg.norm(rest, axis=1), [], []
    for turn in rotations(width, levels):
        rest = rest @ turn
        positive = rest >= 0
        words.append(np.packbits(positive, axis=1, bitorder="little").view("<u8"))
        aligned.append(np.abs(rest).sum(1) / math.sqrt(width))
        rest = rest - np.where(positive, 1.0, -1.0) * (aligned[-1] / math.sqrt(width))[:, None]
    return np.stack(words, 1), np.column_stack([*aligned, np.linalg.norm(rest, axis=1), length])


def components(rows: DataFrame) -> int:
    """The most frequent number of components."""
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().filter("d >= 0").orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return sizes[0]["d"] if sizes else 0


def coded(rows: DataFrame, anchor: Column, dims: int, scale: int = SCALE, levels: int = LEVELS) -> DataFrame:
    """uid, vec_id, label, anchor, ints, words, aligned of the rows that take part."""
    most = math.isqrt((1 << 56) // max(dims, 1))
    whole = F.col("embedding").cast("array<double>")
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") == dims)
    fit &= F.coalesce(F.forall(whole, lambda x: F.coalesce(F.abs(x) * scale < most, F.lit(False)) & ~F.isnan(x)), F.lit(False))
    kept = rows.filter(fit).select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), anchor.alias("anchor"), whole.alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ints = np.floor(scale * values.reshape(batch.num_rows, dims)).astype(np.int64)
            words, aligned = coded_vectors(ints, levels)
            top = int(np.abs(ints).max(initial=0))
            kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
            held = [pa.array([x.tobytes() for x in m], pa.binary()) for m in (ints.astype(kind), words, aligned)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("uid", "vec_id", "label", "anchor")), *held], ["uid", "vec_id", "label", "anchor", "ints", "words", "aligned"])

    return kept.mapInArrow(run, "uid long, vec_id long, label long, anchor boolean, ints binary, words binary, aligned binary")


class Coded:
    """A table of coded rows as matrices."""

    def __init__(self, table: pa.Table, levels: int):
        self.uid, self.id, self.label = (table[c].to_numpy() for c in ("uid", "vec_id", "label"))
        self.words = np.frombuffer(b"".join(table["words"].to_pylist()), "<u8").reshape(len(self.uid), levels, -1)
        self.aligned = np.frombuffer(b"".join(table["aligned"].to_pylist()), "<f8").reshape(len(self.uid), levels + 2)
        held = table["ints"].to_pylist()
        wide = [len(x) for x in held]
        dims = table["dims"][0].as_py() if len(held) else 0
        if len(set(wide)) == 1 and dims:
            self.ints = np.frombuffer(b"".join(held), f"<i{wide[0] // dims}").reshape(len(held), dims).astype(np.int64)
        else:  # batches stored their integers in different widths
            self.ints = np.array([np.frombuffer(x, f"<i{n // dims}") if dims else [] for x, n in zip(held, wide, strict=True)], np.int64).reshape(len(held), dims)


class Planes:
    """Anchors cut into bit planes at each level: what the estimates need of them."""

    def __init__(self, ints: np.ndarray, levels: int, bits: int):
        width = code_width(ints.shape[1])
        turned = np.zeros((len(ints), width))
        turned[:, : ints.shape[1]] = ints
        self.length, self.levels = np.linalg.norm(turned, axis=1), []
        for turn in rotations(width, levels):
            turned = turned @ turn
            low = turned.min(1)
            step = (turned.max(1) - low) / ((1 << bits) - 1)
            step[step == 0] = 1.0
            units = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
            near = low[:, None] + step[:, None] * units
            planes = [np.packbits((units >> j) & 1 > 0, axis=1, bitorder="little").view("<u8") for j in range(bits)]
            self.levels.append((low, step, planes, near.sum(1), np.abs(turned - near).sum(1)))

    def intervals(self, at: slice, rows: Coded) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products of some anchors with all rows."""
        width = 64 * rows.words.shape[2]
        middle, slack = 0.0, rows.aligned[None, :, -2] * self.length[at, None] * (1 + 1e-9) + rows.aligned[None, :, -1] * self.length[at, None] * 1e-9 + 1e-6
        for level, (low, step, planes, total, off) in enumerate(self.levels):
            code = rows.words[:, level]
            ones = np.bitwise_count(code).sum(1, dtype=np.int64)
            units = np.zeros((len(low[at]), len(code)), np.int32)
            for j, plane in enumerate(planes):
                for w in range(code.shape[1]):
                    units += np.bitwise_count(code[None, :, w] & plane[at, w][:, None]).astype(np.int32) << j
            product = 2 * (low[at, None] * ones[None, :] + step[at, None] * units) - total[at, None]
            share = rows.aligned[None, :, level] / math.sqrt(width)
            middle = middle + share * product
            slack = slack + share * off[at, None]
        return middle - slack, middle + slack


def kth_greatest(values: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest of each row's marked values, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return -np.partition(np.where(among, -values, np.inf), k - 1, axis=1)[:, k - 1]


def scores(anchors: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs, in pieces."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 1 << 15):
        some = slice(at, at + (1 << 15))
        out[some] = np.einsum("ij,ij->i", anchors[i[some]], rows[j[some]])
    return out


def first(i: np.ndarray, score: np.ndarray, rows: Coded, j: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k pairs of each anchor: by score, then id."""
    order = np.lexsort((rows.uid[j], rows.id[j], -score, i))
    ends = i[order]
    return order[np.arange(len(order)) - np.searchsorted(ends, ends) < k]


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def same_label(k: int) -> Callable[..., Iterator[Found]]:
    def search(anchors: Coded, rows: Coded, planes: Planes, at: slice, _) -> Iterator[Found]:
        low, high = planes.intervals(at, rows)
        mine = (anchors.label[at, None] == rows.label[None, :]) & (anchors.uid[at, None] != rows.uid[None, :])
        i, j = np.nonzero(mine & (high >= kth_greatest(low, mine, k)[:, None]))
        score = scores(anchors.ints[at], rows.ints, i, j)
        best = first(i, score, rows, j, k)
        yield i[best], j[best], score[best], score[best]

    return search


def other_label(k: int, low_share: int, high_share: int) -> Callable[..., Iterator[Found]]:
    def search(anchors: Coded, rows: Coded, planes: Planes, at: slice, wanted: list[list[int]]) -> Iterator[Found]:
        low, high = planes.intervals(at, rows)
        other = anchors.label[at, None] != rows.label[None, :]
        windows, open_ = [], np.zeros(other.shape, bool)
        for slot in range(max(map(len, wanted), default=0)):
            scored = [x[slot] if slot < len(x) else -1 for x in wanted]  # a score below 0 leaves an empty window
            least, most = (np.array([f(x) for x in scored], np.int64) for f in (lambda x: -(-low_share * x // 100), lambda x: high_share * x // 100))
            windows.append((np.array(scored), least, most))
            inside = other & (low >= least[:, None]) & (high <= most[:, None])
            enough = kth_greatest(low, inside, k)
            open_ |= other & (high >= np.maximum(least, enough)[:, None]) & (low <= most[:, None]) & (least <= most)[:, None]
        i, j = np.nonzero(open_)
        score = scores(anchors.ints[at], rows.ints, i, j)
        for scored, least, most in windows:
            here = np.flatnonzero((score >= least[i]) & (score <= most[i]))
            best = here[first(i[here], score[here], rows, j[here], k)]
            yield i[best], j[best], score[best], scored[i[best]]

    return search


def met(rows: DataFrame, anchors: DataFrame, search: Callable[..., Iterator[Found]], levels: int, bits: int) -> DataFrame:
    """anchor (uid), row (uid), row_id, score, wanted: what ``search`` finds where each block of anchors meets each stripe of rows."""
    names = ["anchor", "row", "row_id", "score", "wanted"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            held, asked = Coded(left, levels), Coded(right, levels)
            planes, wanted = Planes(asked.ints, levels, bits), right["scores"].to_pylist()
            for start in range(0, right.num_rows, TILE):
                at = slice(start, min(start + TILE, right.num_rows))
                for i, j, score, for_score in search(asked, held, planes, at, wanted[at]):
                    parts.append((asked.uid[at][i], held.uid[j], held.id[j], score, for_score))
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 5
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], names)

    units = ["block", "stripe"]
    return rows.groupBy(*units).cogroup(anchors.groupBy(*units)).applyInArrow(run, "anchor long, row long, row_id long, score long, wanted long")


def ranked(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "row_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    scale: int = SCALE, levels: int = LEVELS, bits: int = BITS, stripe: int = STRIPE, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, from rows of vec_id, label and embedding.

    An anchor's positives are its first ``positives`` other rows of the same label. A positive's negatives are the
    first ``negatives`` rows of other labels whose score is between ``low`` and ``high`` per cent of the positive's.
    """
    spark, dims = rows.sparkSession, components(rows)
    all_rows = staged(coded(rows, anchor, dims, scale, levels), "coded", compression="zstd")
    counts = all_rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("anchor").cast("long")), F.lit(0)).alias("a")).first()
    stripes = max(-(-counts["n"] // stripe), 4 * spark.sparkContext.defaultParallelism)
    blocks = max(1, -(-counts["a"] // block))
    fields = ["uid", "vec_id", "label", "ints", "words", "aligned", F.lit(dims).alias("dims")]
    within = all_rows.select(*fields, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("uid"), F.lit(stripes)).cast("int").alias("stripe"))
    asked = all_rows.filter("anchor").select(*(F.col(c).alias(c) for c in all_rows.columns))  # columns of its own: both sides are of one table

    def dealt(anchors: DataFrame) -> DataFrame:
        return anchors.withColumns({"block": F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(blocks)).cast("int"), "stripe": F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))})

    none = F.array().cast("array<long>").alias("scores")
    near = ranked(met(within, dealt(asked.select(*fields, none)), same_label(positives), levels, bits), positives, "anchor")
    near = staged(near.select("anchor", F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("nth")), "positives")
    wanted = near.filter("positive_score >= 0").groupBy(F.col("anchor").alias("uid")).agg(F.collect_set("positive_score").alias("scores"))
    sought = met(within, dealt(asked.select(*fields).join(wanted, "uid")), other_label(negatives, low, high), levels, bits)
    best = ranked(sought, negatives, "anchor", "wanted").withColumnRenamed("wanted", "positive_score")
    ids = asked.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    out = near.join(best, ["anchor", "positive_score"]).join(ids, "anchor")
    return out.select("anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


NEGATIVES_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.uid, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.uid <> b.uid WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, uid) <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY s.score DESC, s.vec_id, s.uid) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
