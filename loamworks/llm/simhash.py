"""SimHash near-dedup: fingerprints of word shingles, compared exactly by tiles.

A fingerprint bit is set if it is set in more than half of the XXH64 hashes (seed 42)
of the text's shingles. Equal fingerprints are put together first; what is compared
are distinct fingerprints. They are dealt by hash into stripes, about the square root
of their number over ``STRIPE``, and each pair of stripes is one task's work. A task
sorts both stripes by the population counts of the four 16-bit quarters, cuts them
into tiles, skips tile pairs whose population counts differ by more than the radius
(the quarters' differences add up), and compares the rest by exclusive-or and bit
counts. It emits a spanning forest of the links it found and never the pairs, so a
large group of near copies gives no more rows than it has members.

For copies by similarity the tiles only find candidates. Nodes are distinct sets of
shingle hashes, and inside a component of candidates they are tested by the exact
Jaccard similarity of their sets. A large component is dealt into blocks, a few of its
sets go into every block, and each block is one task's work; a family of near copies is
one cluster then. The cluster of most sets needs no look inside: only the sets outside it
meet all of the component that is not of their own cluster, stripe by stripe.

Components of the links come from alternating large-star and small-star steps, each
round written to the shared folder.

Texts are lower-cased for A-Z and split at ASCII blanks. A text of fewer words than a
shingle is one shingle; a text without words (null, empty, blank) has fingerprint
zero, and such documents link to each other. Null ids count as one id after all others,
and so does the greatest long. Very long texts are hashed whole. Of ties in the smallest
id the text of smallest hash stays. Repeated rows are all classed; near_dedup keeps one.
An empty table gives no rows. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.llm.common import LAST_ID, spare, staged, whole, wider
from loamworks.operators.graph import components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: For candidates by similarity: words of a wide fingerprint, the radius of its first word, and that of all words together.
#: Two sets of similarity j differ in about acos(2j / (1 + j)) / pi of the bits: 78 of 512 at 0.8, with a deviation of 8
#: and 9.7 of 64, with a deviation of 2.9: both radii lie four deviations above or more. For sets of 4 and 5 it is 96 of 512,
#: and the radius lies 2.7 deviations above, so about 1 in 300 such pairs is not met.
WIDE, FIRST_RADIUS, WIDE_RADIUS = 8, 22, 120
#: Candidates are copies at 4 / 5 or more, in whole numbers.
SIMILAR, OF = 4, 5
#: Sets of a block of a component of candidates, and shingles of a block or stripe; sets that go into every block of a component.
BLOCK, BLOCK_SHINGLES, HUBS = 64, 1_000_000, 4
#: Parts into which the nodes of a component are dealt.
PARTS = 16
#: Distinct fingerprints per stripe where there is one stripe, and rows of a tile.
STRIPE, TILE = 4096, 256

# What separates words, and the letters that are folded.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of the text's shingles, repeats included; empty without words."""
    # UTF-8 has no ASCII bytes inside longer characters, so folding and splitting work on bytes
    words = [w for w in text.encode("utf-8", "surrogatepass").translate(FOLD).translate(_TO_SPACE).split(b" ") if w]
    n, joined, digest = len(words), b" ".join(words), xxhash.xxh64_intdigest
    if n <= shingle:
        return np.array([digest(joined, SEED)] if n else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes; zero of none."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16_384):
        votes += np.unpackbits(hashes[at : at + 16_384].byteswap().view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text."""
    return majority(shingle_hashes(text, shingle))


def wide_fingerprint(text: str, shingle: int = SHINGLE, words: int = WIDE) -> bytes:
    """Several fingerprints of one text as little-endian words: the first is its fingerprint, the others come from remixed hashes."""
    return widened(shingle_hashes(text, shingle), words)


def widened(hashes: np.ndarray, words: int = WIDE) -> bytes:
    """The wide fingerprint of these hashes."""
    out = [majority(hashes)]
    for k in range(1, words):
        mixed = (hashes ^ np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(33)
        mixed *= np.uint64(0xC4CEB9FE1A85EC53)
        out.append(majority(mixed ^ (mixed >> np.uint64(29))))
    return np.array(out, "<u8").tobytes()


def with_fingerprints(docs: DataFrame, *keep: str, shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint as a signed long) of each whole text."""
    schema = wider(docs.select(*keep), "fp long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t or "", shingle) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in keep), pa.array(found)], [*keep, "fp"])

    return docs.mapInArrow(run, schema)


def with_wide_fingerprints(docs: DataFrame, *keep: str, shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns and, of the set of each whole text's shingles, ``name`` (its 128-bit hash), ``wide`` (binary, WIDE words) and ``fp`` (the first word)."""
    schema = wider(docs.select(*keep), "name binary, wide binary, fp long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t or "", shingle)) for t in batch["text"].to_pylist()]
            names = pa.array([xxhash.xxh3_128_digest(x.tobytes(), SEED) for x in sets], pa.binary())
            found = [widened(x) for x in sets]
            first = np.array([np.frombuffer(w, "<i8", 1)[0] for w in found], np.int64)
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in keep), names, pa.array(found, pa.binary()), pa.array(first)], [*keep, "name", "wide", "fp"])

    return docs.mapInArrow(run, schema)


class Forest:
    """Union-find over positions with vectorised hooking: the smaller root wins."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (root[root] != root).any():
                root[:] = root[root]


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def compare(a: np.ndarray, b: np.ndarray | None, radius: int, tile: int = TILE, wide: np.ndarray | None = None, wide_radius: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all of ``a`` and ``b`` (uint64) within ``radius`` as (from, to) positions in both: a forest. ``b`` None: inside ``a``.

    With ``wide`` (a row of words for each of both) a pair's wide fingerprints must be within ``wide_radius`` as well.
    """
    own = b is None
    both = a if own else np.concatenate([a, b])
    forest = Forest(len(both))
    sides = []
    for start, side in ((0, a),) if own else ((0, a), (len(a), b)):
        q = _quarters(side)
        order = np.lexsort(q.T[::-1])
        cuts = np.arange(0, len(side), tile)
        sides.append((side[order], order + start, cuts, np.minimum.reduceat(q[order], cuts), np.maximum.reduceat(q[order], cuts)))
    (fa, ia, ca, low_a, high_a), (fb, ib, cb, low_b, high_b) = sides[0], sides[-1]
    for k, at in enumerate(ca.tolist()):
        gap = np.maximum(0, np.maximum(low_b - high_a[k], low_a[k] - high_b)).sum(axis=1)  # population counts of quarters, added up
        near = np.flatnonzero(gap <= radius)
        if own:
            near = near[near >= k]
        mine = fa[at : at + tile]
        for m in near.tolist():
            other = cb[m]
            bits = np.bitwise_count(mine[:, None] ^ fb[None, other : other + tile])
            hit = np.flatnonzero(bits.ravel() <= radius)
            if len(hit):
                i, j = np.divmod(hit, bits.shape[1])
                i, j = ia[at + i], ib[other + j]
                if wide is not None:  # pairs that are connected already need no look
                    apart = forest.root[i] != forest.root[j]
                    i, j = i[apart], j[apart]
                    near_too = np.bitwise_count(wide[i] ^ wide[j]).sum(axis=1, dtype=np.int64) <= wide_radius
                    i, j = i[near_too], j[near_too]
                forest.link(i, j)
    moved = np.flatnonzero(forest.root != np.arange(len(both)))
    return moved, forest.root[moved]


def links(fingerprints: DataFrame, radius: int = RADIUS, stripe: int = STRIPE, wide_radius: int | None = None) -> DataFrame:
    """(a, b) links between nodes that connect all distinct fingerprints within ``radius``.

    A node is the distinct ``fp`` value. With ``wide_radius`` the frame is a written one of distinct ``node`` with ``wide``
    beside ``fp``, and what is linked are nodes whose wide fingerprints are within that radius, too.
    """
    wide = wide_radius is not None
    distinct = fingerprints.select("node", "fp", "wide") if wide else staged(fingerprints.select("fp").distinct(), "fps")
    node = "node" if wide else "fp"
    stripes = max(1, round((distinct.count() / stripe) ** 0.5))
    tasks = stripes * (stripes + 1) // 2
    side = F.pmod(F.xxhash64(node), F.lit(stripes))
    # stripe s meets every stripe t: work item (low, high), numbered along the triangle
    sent = (
        distinct.withColumn("s", side)
        .withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
        .select(*distinct.columns, "s", F.expr("cast(least(s, t) + greatest(s, t) * (greatest(s, t) + 1) div 2 as int)").alias("item"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple]] = {}
        for batch in batches:
            items = batch["item"].to_numpy()
            words = np.frombuffer(b"".join(batch["wide"].to_pylist()), "<u8").reshape(len(items), -1) if wide else np.zeros((len(items), 0), np.uint64)
            for item in np.unique(items).tolist():
                rows = items == item
                parts.setdefault(item, []).append((batch["s"].to_numpy()[rows], batch[node].to_numpy()[rows], batch["fp"].to_numpy()[rows].view(np.uint64), words[rows]))
        for got in parts.values():
            s, nodes, fps, words = (np.concatenate(x) for x in zip(*got, strict=True))
            order = np.argsort(s, kind="stable")
            s, nodes, fps, words = s[order], nodes[order], fps[order], words[order]
            n = int((s == s[0]).sum())
            a, b = compare(fps[:n], fps[n:] if n < len(fps) else None, radius, wide=words if wide else None, wide_radius=wide_radius or 0)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], ["a", "b"])

    return sent.repartition(tasks, "item").mapInArrow(run, "a long, b long")


def similar(sets: list[np.ndarray], first: int | None = None, cluster: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all sets (sorted hashes) with a Jaccard similarity of SIMILAR / OF or more as (from, to) positions: a forest.

    With ``first`` only the pairs of one of the first sets and one of the others are compared. Sets of equal ``cluster`` are
    connected beforehand: they are not compared, and the links are those between clusters.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets], np.int64)
    ends = np.cumsum(sizes)
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    marked, forest = np.zeros(len(names), bool), Forest(n)
    before = forest.root.copy()
    if cluster is not None:
        _, least, which = np.unique(cluster, return_index=True, return_inverse=True)
        before = least[which]
        forest.link(np.arange(n), before)
    for i in range(n if first is None else first):
        others = np.arange(i + 1 if first is None else first, n)
        others = others[forest.root[others] != forest.root[i]]  # pairs that are connected already need no look
        low, high = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[low * OF >= high * SIMILAR]
        if not len(others):
            continue
        mine = flat[ends[i] - sizes[i] : ends[i]]
        marked[mine] = True
        if len(others) * 8 < n:
            shared = np.array([np.count_nonzero(marked[flat[ends[j] - sizes[j] : ends[j]]]) for j in others.tolist()], np.int64)
        else:
            counted = np.concatenate([[0], np.cumsum(marked[flat])])
            shared = counted[ends[others]] - counted[ends[others] - sizes[others]]
        marked[mine] = False
        others = others[shared * OF >= (sizes[i] + sizes[others] - shared) * SIMILAR]
        forest.link(np.full(len(others), i), others)
    moved = np.unique(before)
    moved = moved[forest.root[moved] != moved]
    return moved, forest.root[moved]


def similar_links(docs: DataFrame, fps: DataFrame, groups: DataFrame, shingle: int, block: int = BLOCK) -> DataFrame:
    """(a, b) links between nodes that connect all that are similar inside the components ``groups`` (member, label) of candidates.

    ``docs`` has id, row_hash and text, ``fps`` id, row_hash and node. The text of one document stands for a node.
    Components of more than ``block`` sets are cut into blocks, each with the same HUBS sets beside its own. What the blocks
    leave apart is then compared by stripes: the sets outside a component's largest cluster with each other and with that
    cluster. A family of near copies so costs work in proportion to its sets; the sets outside it, to their number times
    the component's.
    """
    least = fps.groupBy("node").agg(F.min(F.struct("id", "row_hash")).alias("first"))
    chosen = least.join(groups, least.node == groups.member).select("node", "label", "first.id", "first.row_hash")
    texts = docs.join(chosen.hint("shuffle_hash"), ["id", "row_hash"]).groupBy("node", "label").agg(F.first("text").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, shingle)) for t in batch["text"].to_pylist()]
            sizes = pa.array([len(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["node"], batch["label"], pa.array([x.tobytes() for x in sets], pa.binary()), sizes], ["node", "label", "hashes", "size"])

    sets = staged(texts.mapInArrow(read, "node long, label long, hashes binary, size long"), "sets")
    blocks = F.ceil(F.greatest(F.count("*") / block, F.sum("size") / BLOCK_SHINGLES)).cast("int")
    # no more rows than one for each ``block`` sets
    large = staged(sets.groupBy("label").agg(blocks.alias("blocks")).filter("blocks > 1"), "large")
    dealt = sets.join(large, "label", "left").withColumn("low", F.expr("cast(pmod(xxhash64(node), coalesce(blocks, 1)) as int)"))
    hub = F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(HUBS))
    hubs = sets.join(large, "label").groupBy("label", "blocks", hub).agg(F.min("node").alias("node")).select("label", "node", F.explode(F.expr("sequence(0, blocks - 1)")).alias("low"))
    # a hub's own block has it already
    beside = hubs.join(sets, ["label", "node"]).join(dealt.select("label", "node", "low"), ["label", "node", "low"], "left_anti")
    row = ["label", "low", F.col("low").alias("high"), F.col("low").alias("s"), "node", "hashes", F.col("node").alias("cluster")]
    inside = compared(dealt.select(*row).unionByName(beside.select(*row)))
    if large.isEmpty():
        return inside
    inside = staged(inside, "inside")
    clusters = components(inside).withColumnRenamed("label", "cluster")
    named = sets.join(large, "label").join(clusters, "node", "left").select("label", "node", "hashes", "size", F.coalesce("cluster", "node").alias("cluster"))
    return inside.unionByName(compared(striped(staged(named, "clusters"), block)))


def striped(sets: DataFrame, block: int) -> DataFrame:
    """The sets (label, node, hashes, size, cluster) by pairs of stripes of their component: ``low``, ``high`` and their own stripe ``s``.

    The sets outside the largest cluster (ties: the smallest) come first, in as many stripes as the root of their number over
    ``block``; each of theirs meets all. Stripes of the largest cluster meet those only. Components of one cluster are left out.
    """
    counts = sets.groupBy("label", "cluster").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    main = counts.groupBy("label").agg(F.max(F.struct("n", (-F.col("cluster")).alias("least"), "size")).alias("m"), F.sum("n").alias("n"), F.sum("size").alias("size"))
    stripes = lambda n, size: F.ceil(F.greatest(F.sqrt(n / block), size / BLOCK_SHINGLES)).cast("int")
    rest = stripes(F.col("n") - F.col("m.n"), F.col("size") - F.col("m.size"))
    plan = main.filter("n > m.n").select("label", (-F.col("m.least")).alias("main"), rest.alias("rest"), stripes(F.col("m.n"), F.col("m.size")).alias("more"))
    own = F.expr("cast(if(cluster = main, rest + pmod(xxhash64(node), more), pmod(xxhash64(node), rest)) as int)")
    met = F.explode(F.expr("sequence(0, if(cluster = main, rest, rest + more) - 1)"))
    sent = sets.join(plan, "label").withColumn("s", own).withColumn("t", met)
    return sent.select("label", F.least("s", "t").alias("low"), F.greatest("s", "t").alias("high"), "s", "node", "hashes", "cluster")


def compared(sent: DataFrame) -> DataFrame:
    """(a, b) links between nodes, as ``similar`` finds them in each (label, low, high): a group's task holds its sets."""
    item = ["label", "low", "high"]
    tasks = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def linked(rows: list[tuple]) -> list[tuple[int, int]]:
        rows.sort(key=lambda r: r[0])
        n = sum(r[0] == rows[0][0] for r in rows)
        a, b = similar([np.frombuffer(r[2], np.uint64) for r in rows], n if n < len(rows) else None, np.array([r[3] for r in rows], np.int64))
        return [(rows[i][1], rows[j][1]) for i, j in zip(a.tolist(), b.tolist(), strict=True)]

    def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            found = []
            for key, *row in zip(zip(*(batch[c].to_pylist() for c in item), strict=True), *(batch[c].to_pylist() for c in ("s", "node", "hashes", "cluster")), strict=True):
                if key != now:
                    found += linked(held) if held else []
                    now, held = key, []
                held.append(row)
            yield out(found)
        if held:
            yield out(linked(held))

    return sent.repartition(tasks, *item).sortWithinPartitions(*item).mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, wide_radius: int | None = None) -> DataFrame:
    """id, row_hash, fp, node, label, component for every row: components of documents whose fingerprints link.

    ``label``, the smallest node, is unique; ``component``, the smallest id (LAST_ID: null), is not where ids repeat or are null.
    """
    named = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), whole().alias("text"), F.xxhash64(whole()).alias("row_hash"))
    if wide_radius is None:
        nodes = fps = staged(with_fingerprints(named, "id", "row_hash", shingle=shingle).withColumn("node", F.col("fp")), "doc-fps")
    else:
        # a set is named by 128 bits, and its node is a number, so that no two sets share one
        fps = staged(with_wide_fingerprints(named, "id", "row_hash", shingle=shingle), "doc-fps")
        nodes = staged(fps.select("name", "fp", "wide").distinct().withColumn("node", F.monotonically_increasing_id()), "nodes")
        fps = staged(fps.select("id", "row_hash", "fp", "name").join(nodes.select("name", "node"), "name").drop("name"), "doc-nodes")
    groups = components(links(nodes, radius, wide_radius=wide_radius)).withColumnRenamed("node", "member")
    if wide_radius is not None:
        groups = components(similar_links(named, fps, groups, shingle)).withColumnRenamed("node", "member")
    # the smallest id is found over nodes, one row each, and then brought to the documents
    least = fps.groupBy("node").agg(F.min("id").alias("first"))
    joined = staged(least.join(groups, least.node == groups.member, "left").select("node", "first", "label"), "labels")
    alone = joined.filter("label is null").select("node", F.col("node").alias("label"), F.col("first").alias("component"))
    # a large component's label is one key: its nodes are dealt into parts, and each part gets its smallest id
    parted = joined.filter("label is not null").withColumn("part", F.pmod(F.xxhash64("node"), F.lit(PARTS)))
    smallest = parted.groupBy("label").agg(F.min("first").alias("component")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    # not left to the optimizer: it sizes the smaller side before it is dealt to all parts
    together = parted.join(smallest.hint("merge"), ["label", "part"]).select("node", "label", "component")
    return fps.select("id", "row_hash", "fp", "node").join(staged(alone.unionByName(together), "by-node"), "node")


def near_dedup(docs: DataFrame, radius: int = FIRST_RADIUS, shingle: int = 5, wide_radius: int | None = WIDE_RADIUS) -> DataFrame:
    """One row of each component: that with the smallest id (of several texts under this id, the one of smallest hash).

    By default documents link at a Jaccard similarity of 0.8 or more of their sets of five-word shingles; candidates are
    found by wide fingerprints. With ``wide_radius`` None they link at ``radius`` differing bits of the 64-bit fingerprints.
    """
    found = staged(classes(docs, radius, shingle, wide_radius), "classes")
    id_, hash_ = spare(docs, "_id", "_row_hash")
    first = found.groupBy("label").agg(F.min(F.struct("id", "row_hash")).alias("first")).select(F.col("first.id").alias(id_), F.col("first.row_hash").alias(hash_))
    keyed = docs.withColumns({id_: F.coalesce("doc_id", F.lit(LAST_ID)), hash_: F.xxhash64(whole())})
    kept = keyed.join(first.hint("shuffle_hash"), [id_, hash_], "left_semi")
    if not found.groupBy("id", "row_hash").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_, hash_])  # rows repeated with their id
    return kept.select(*docs.columns)


def document_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    real = lambda c: F.nullif(F.col(c), F.lit(LAST_ID))
    return classes(docs).select(real("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), real("component").alias("component_id"))
