"""Document fingerprints by SimHash, DataFrame operations only.

The terms of a text are its different words (lower case, split at blanks); a term
weighs its length, up to ``HEAVIEST``: long words tell more than short ones. Each bit
of a term's 64-bit hash votes with that weight for or against the fingerprint's bit.
All votes are sums of longs: sixteen sums hold four 16-bit counters each, taken from
the hash by a shift and a mask, and parts of ``PART`` terms keep counters from
overflowing. So the counting is one hash aggregate over exploded terms in generated
code, mostly before the exchange.

Fingerprints within a Hamming radius are found by permuted block tables: the 64 bits
are cut into ``radius + 3`` blocks; any two that differ in at most ``radius`` bits
agree in three blocks at least, so a table for each choice of three blocks, joined on
those blocks, meets every such pair. Keys that many values share are cut again in the
bits that they leave open.

Null texts count as empty; without terms the fingerprint is zero. A very long text is
counted in parts. Ids may repeat or be null (null: after all others); equal ids follow
each other by the hash of their texts. Repeated rows have equal fingerprints. An empty
table gives no rows. Other columns are not read, so none can clash.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamworks.llm.common import LAST_ID, discard, staged, whole
from loamworks.operators.graph import components

HEAVIEST, PART = 15, 4096
LANES, LANE_MASK, HALF_MASK = 16, 0x0001000100010001, 0x0000FFFF0000FFFF
#: Ranges of ids per shuffle partition; a window finds the next document within a range.
RANGES_EACH = 4
#: Values that may share a block key before it is cut again.
HOT = 512


def terms(text: Column) -> Column:
    """The different words."""
    return F.array_distinct(F.split(F.lower(text), r"\s+"))


def fingerprints(df: DataFrame, keys: list[str], texts: dict[str, str]) -> DataFrame:
    """``keys`` (unique together) and, for each text column, its fingerprint (long) under the name it maps to."""
    tagged = F.array(*(F.struct(F.lit(i).alias("which"), terms(F.col(c)).alias("terms")) for i, c in enumerate(texts)))
    one = df.select(*keys, F.explode(tagged).alias("t")).select(*keys, "t.which", "t.terms")
    exploded = one.select(*keys, "which", F.posexplode("terms").alias("pos", "term"))
    h, w = F.xxhash64("term"), F.least(F.char_length("term"), F.lit(HEAVIEST)).cast("long")
    votes = exploded.select(*keys, "which", F.expr(f"pos div {PART}").alias("part"), h.alias("h"), w.alias("w"))
    lanes = [F.sum((F.shiftrightunsigned("h", k).bitwiseAND(F.lit(LANE_MASK))) * F.col("w")).alias(f"l{k}") for k in range(LANES)]
    parts = votes.groupBy(*keys, "which", "part").agg(*lanes, F.sum("w").alias("total"))
    # counter k + 16 j sits in bits 16 j .. 16 j + 15 of sum k; parts add up in twice as many sums of two 32-bit counters
    halves = {(k, o): F.sum(F.shiftrightunsigned(F.col(f"l{k}"), 16 * o).bitwiseAND(F.lit(HALF_MASK))).alias(f"l{k}_{o}") for k in range(LANES) for o in (0, 1)}
    sums = parts.groupBy(*keys, "which").agg(*halves.values(), F.sum("total").alias("total"))
    counters = {k + 16 * (2 * j + o): F.shiftrightunsigned(F.col(f"l{k}_{o}"), 32 * j).bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(LANES) for o in (0, 1) for j in (0, 1)}
    fp = F.lit(0).cast("long")
    for b in range(64):
        fp = fp.bitwiseOR(F.shiftleft((counters[b] * 2 > F.col("total")).cast("long"), b))
    found = sums.select(*keys, "which", fp.alias("fp"))
    return found.groupBy(*keys).agg(*(F.max(F.when(F.col("which") == i, F.col("fp"))).alias(name) for i, name in enumerate(texts.values())))


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """1 minus the share of differing bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def masks(radius: int, within: int = (1 << 64) - 1, blocks: int | None = None) -> list[int]:
    """The block tables for the bits of ``within``: for each choice of blocks that stay equal, their bits.

    The bits are cut into ``radius + 3`` blocks and a table takes three of them, so two values within ``radius`` bits
    agree in one table at least.
    """
    places = [k for k in range(64) if within >> k & 1]
    blocks = blocks or radius + 3
    cuts = [sum(1 << k for k in places[len(places) * i // blocks : len(places) * (i + 1) // blocks]) for i in range(blocks)]
    return [sum(c) for c in combinations(cuts, blocks - radius)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def tables(radius: int) -> tuple[Column, Column]:
    """The masks of the block tables, and for each those that cut its keys again in the bits that it leaves open."""
    coarse = masks(radius)
    finer = [[m | x for x in masks(radius, ~m & (1 << 64) - 1)] for m in coarse]
    return F.array(*(F.lit(signed(m)) for m in coarse)), F.array(*(F.array(*(F.lit(signed(m)) for m in row)) for row in finer))


def keyed(values: DataFrame, fp: str, radius: int, *carried: str) -> DataFrame:
    """(fp, carried, table, key): a row for each value and block table."""
    rough, _ = tables(radius)
    return values.select(fp, *carried, F.posexplode(rough).alias("table", "mask")).select(fp, *carried, "table", F.col(fp).bitwiseAND(F.col("mask")).alias("key"))


def split(keys: DataFrame, sizes: DataFrame, fp: str, radius: int, hot: int, *carried: str) -> DataFrame:
    """(fp, carried, table, sub, part): keys that are in ``sizes``, those of more than ``hot`` values cut again (``sub`` -1: not cut).

    A part fixes three quarters of the bits then, so no more than 2^16 values share it, whatever the table holds.
    """
    _, fine = tables(radius)
    shared = keys.join(sizes, ["table", "key"])
    one = F.array(F.struct(F.lit(-1).alias("sub"), F.col("key").alias("key")))
    cut = F.transform(F.get(fine, F.col("table")), lambda m, i: F.struct(i.alias("sub"), F.col(fp).bitwiseAND(m).alias("key")))
    return shared.select(fp, *carried, "table", F.inline(F.when(F.col("n") > hot, cut).otherwise(one)).alias("sub", "part"))


def first_meeting(gap: Column, radius: int) -> Column:
    """Whether a pair with the differing bits ``gap`` meets here first: in the first table, and there in the first part, where it is together."""
    rough, fine = tables(radius)
    first = lambda table: F.array_position(F.transform(table, lambda m: gap.bitwiseAND(m) == 0), True) - 1
    return (F.col("table") == first(rough)) & ((F.col("sub") < 0) | (F.col("sub") == first(F.get(fine, F.col("table")))))


def near(queries: DataFrame, corpus: DataFrame, radius: int = 3, fp: str = "fp", hot: int = HOT) -> DataFrame:
    """(query, found, distance): all pairs of a distinct query value and a distinct corpus value within ``radius`` bits.

    Equal values are pairs too; null values are in none. Copies are put together first, so a group of copies is one value.
    A key that more than ``hot`` values share is cut again: block tables of the bits that it leaves open, in which two of
    its values agree on all but a few bits. A pair that meets in several tables is taken in the first of them. The pairs of
    a close family grow with its square: for a table against itself ``near_classes`` tells of them without putting them out.
    """

    def distinct(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(fp).alias(name)).filter(F.col(name).isNotNull()).distinct()

    ours, theirs = keyed(distinct(queries, "query"), "query", radius), keyed(distinct(corpus, "found"), "found", radius)
    sides = ours.select("table", "key", F.lit(1).alias("q")).unionAll(theirs.select("table", "key", F.lit(0).alias("q")))
    sizes = staged(sides.groupBy("table", "key").agg(F.count("*").alias("n"), F.min("q").alias("a"), F.max("q").alias("b")).filter("a < b").select("table", "key", "n"), "keys")
    met = split(ours, sizes, "query", radius, hot).join(split(theirs, sizes, "found", radius, hot), ["table", "sub", "part"])
    gap = F.col("query").bitwiseXOR(F.col("found"))
    return met.filter((F.bit_count(gap) <= radius) & first_meeting(gap, radius)).select("query", "found", F.bit_count(gap).alias("distance"))


def near_classes(values: DataFrame, radius: int = 3, fp: str = "fp", hot: int = HOT) -> DataFrame:
    """(fp, n_near, near_class) of each distinct value that has others within ``radius`` bits: how many, and the smallest value (as a signed long) that is reached over such neighbours.

    No pair is written or exchanged: tasks count a value's neighbours and keep the smallest of them as the pairs arise. The
    links of values to their smallest neighbours make classes; as long as values of different classes are neighbours, every
    such class is linked to its smallest neighbouring class, which at least halves their number. Only block keys that two
    classes share are looked at again, so a family that is one class already costs nothing then.
    """
    gap = F.col("query").bitwiseXOR(F.col("found"))

    def met(keys: DataFrame, sizes: DataFrame, *carried: str) -> DataFrame:
        ours = split(keys, sizes, "fp", radius, hot, *carried)
        theirs = ours.select(F.col("fp").alias("found"), *(F.col(c).alias(f"found_{c}") for c in carried), "table", "sub", "part")
        return ours.withColumnRenamed("fp", "query").join(theirs, ["table", "sub", "part"]).filter((F.bit_count(gap) <= radius) & (F.col("query") != F.col("found")))

    keys = keyed(values.select(F.col(fp).alias("fp")).filter("fp is not null").distinct(), "fp", radius)
    sizes = staged(keys.groupBy("table", "key").agg(F.count("*").alias("n")).filter("n > 1"), "keys")
    pairs = met(keys, sizes).filter(first_meeting(gap, radius))
    counts = staged(pairs.groupBy(F.col("query").alias("fp")).agg(F.count("*").alias("n_near"), F.min("found").alias("low")), "near")
    links = components(counts, "fp", "low")
    classes = staged(counts.join(links, counts.fp == links.node).select("fp", "n_near", F.col("label").alias("near_class")), "classes")
    discard(sizes)
    discard(counts)
    while True:
        keys = keyed(classes, "fp", radius, "near_class")
        mixed = keys.groupBy("table", "key").agg(F.count("*").alias("n"), F.min("near_class").alias("a"), F.max("near_class").alias("b")).filter("a < b")
        sizes = staged(mixed.select("table", "key", "n"), "keys")
        across = met(keys, sizes, "near_class").filter("near_class <> found_near_class")
        links = staged(across.groupBy("near_class").agg(F.min("found_near_class").alias("low")), "links")
        done = links.isEmpty()
        if not done:
            labels = components(links, "near_class", "low")
            merged = classes.join(labels, classes.near_class == labels.node, "left").select("fp", "n_near", F.coalesce("label", "near_class").alias("near_class"))
            before, classes = classes, staged(merged, "classes")
            discard(before)
        discard(sizes)
        discard(links)
        if done:
            return classes


def following(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text, range, nth, last: each document with the text after it in descending id (equal ids: ascending hash), the last with the first.

    Ids are cut into ranges by approximate quantiles and a window finds the next row within a range. An id that fills more
    than a range gets ranges of its own, cut by the texts' hashes. A range's first row is also sent, as a guest, to the
    range before it, where it sorts behind its own. Only the first rows' ids and hashes, one per range, reach the driver.
    (range, nth) is unique; ``last`` marks the last row of a range.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(-LAST_ID - 1)).alias("id"), whole().alias("text")).withColumn("hash", F.xxhash64("text"))
    n = RANGES_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = Counter(rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 10 * n)).first()[0] or [])
    hot = {i: times + 1 for i, times in quantiles.items() if times > 1}  # id -> ranges
    edges = sorted({*quantiles, *(i - 1 for i in hot if i > -LAST_ID - 1)})
    number = f"aggregate(array({', '.join(f'{e}L' if e > -LAST_ID - 1 else 'bigint(-9223372036854775808)' for e in edges)}), 0, (m, e) -> m + cast(id > e as int))" if edges else "0"
    part = F.lit(0)
    for i, ranges in hot.items():
        part = F.when(F.col("id") == i, F.least(F.lit(ranges - 1), ((F.col("hash").cast("double") / 2.0**64 + 0.5) * ranges).cast("int"))).otherwise(part)
    ranged = rows.withColumns({"range": F.expr(number).cast("long") * (n + 2) + (n + 1) - part, "guest": F.lit(0)})
    heads = sorted(ranged.groupBy("range").agg(F.min(F.struct(F.bitwise_not("id").alias("down"), "hash")).alias("first")).select("range", F.bitwise_not("first.down"), "first.hash").collect())
    # a head is the guest of the next range up; the highest range's head comes after the lowest range
    sent = [(i, h, heads[(k + 1) % len(heads)][0]) for k, (_, i, h) in enumerate(heads)]
    guests = spark.createDataFrame(sent, "id long, hash long, host long")
    guest_rows = rows.join(F.broadcast(guests), ["id", "hash"]).dropDuplicates(["host"]).withColumnRenamed("host", "range").withColumn("guest", F.lit(1))
    order = Window.partitionBy("range").orderBy("guest", F.col("id").desc(), "hash")
    both = ranged.unionByName(guest_rows)
    found = both.withColumns({"nth": F.row_number().over(order), "next_text": F.lead("text").over(order), "last": F.lead("guest").over(order) == 1})
    return found.filter("guest = 0").select("doc_id", "text", "next_text", "range", "nth", "last")


def edit_likeness(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near, near_class for every document.

    The edited text has its last half, rounded down, replaced by the beginning of the next document's text. ``n_near`` is
    the number of other fingerprints in the table within three bits, ``near_class`` names the class that these links make.
    """
    half = F.expr("cast(n_chars div 2 as int)")
    texts = following(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    texts = texts.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)))
    keyed = texts.withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["range", "nth", "last", "doc_id", "n_chars", "edited_sha256"]
    found = staged(fingerprints(keyed.select(*keys, "text", "edited"), keys, {"text": "fp", "edited": "edited_fp"}), "fingerprints")
    ahead = found.withColumn("within", F.lead("fp").over(Window.partitionBy("range").orderBy("nth")))
    # the first rows of the ranges, one each, follow the last rows of the ranges above them
    heads = found.filter("nth = 1").select("range", "fp")
    after = heads.select(F.lead("range").over(Window.orderBy("range")).alias("above"), F.min("range").over(Window.partitionBy()).alias("bottom"), "fp")
    first = after.select(F.coalesce("above", "bottom").alias("range"), F.col("fp").alias("beyond"))
    joined = ahead.join(F.broadcast(first), "range").withColumn("next_fp", F.when(F.col("last"), F.col("beyond")).otherwise(F.col("within")))
    joined = joined.join(near_classes(found), "fp", "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexed(F.col("fp")).alias("fingerprint"),
        hexed(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        hexed(F.coalesce("near_class", "fp")).alias("near_class"),
    )
