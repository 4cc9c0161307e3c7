"""Packing token ids into sequences of fixed capacity, two ways, over the histogram of lengths.

How documents are packed depends only on how many there are of each length, and there
are at most ``capacity`` lengths. So tasks count lengths, the driver packs the histogram
(``capacity`` numbers whatever the input's size) into a plan of slots, and tasks look
up each piece's slot by its length and its rank among the pieces of that length. Ranks
come from counts per (length, salt), and a length has as many salts as its count needs:
no length's pieces meet in one task.

Documents longer than the capacity are cut into full pieces; the first piece takes the
rest, so no piece but the first is shorter. Full pieces are sequences of their own: they
need no rank and no shuffle, and are numbered where they are, behind the plan's sequences.

* ``best_two_fit``: a bin is filled greedily with the longest that fits, again and
  again; then its smallest document is replaced with the two unpacked ones that fill
  the gap it leaves more tightly, if there are such. The same filling is repeated as
  often as the counts allow it.
* ``best_fit_decreasing`` (written as matrices): lengths from long to short, each into the open bin with the
  least room that holds it. A segment tree over room values finds that room; bins of
  equal room and history are handled as an interval of sequence numbers.

Null and empty texts are one token (the end mark 0). Very long texts are encoded whole and
give many pieces. Repeated rows are packed each; ids may repeat or be null, and which of
two pieces alike in length, id, number and tokens goes where does not matter. An empty
table gives no pieces and no sequences. Other columns of the documents are not read, so
none can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamworks.llm.common import staged, whole, wider

CAPACITY = 2048
#: Pieces of one length that are ranked together, about: the most and the least, between which it is an eighth of a shuffle partition.
RANKED, RANKED_LEAST = 16_384, 256
END = 0


# --- plans: a slot row is (length, rank from, bins, sequence from, offset): ranks [from, from + bins) of the length go to as many sequences


class Slots:
    def __init__(self):
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.ranked: dict[int, int] = {}
        self.sequences = 0

    def put(self, length: int, bins: int, sequence: int, offset: int) -> None:
        at = self.ranked.get(length, 0)
        self.rows.append((length, at, bins, sequence, offset))
        self.ranked[length] = at + bins

    def open(self, bins: int) -> int:
        first, self.sequences = self.sequences, self.sequences + bins
        return first

    def table(self) -> np.ndarray:
        """Sorted by length and first rank."""
        rows = np.array(self.rows, np.int64).reshape(-1, 5)
        return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def best_two_fit(histogram: np.ndarray) -> Slots:
    """``histogram[l]``: how many documents have length l; the last index is the capacity."""
    left, slots, capacity = histogram.astype(np.int64).copy(), Slots(), len(histogram) - 1
    while True:
        there = np.flatnonzero(left[1:]) + 1
        if not len(there):
            return slots
        used, room = {}, capacity
        while room:
            fitting = there[: np.searchsorted(there, room, side="right")]
            fitting = fitting[::-1]
            length = next((int(x) for x in fitting if left[x] > used.get(int(x), 0)), 0)
            if not length:
                break
            n = min(room // length, int(left[length]) - used.get(length, 0))
            used[length] = used.get(length, 0) + n
            room -= n * length
        if room and sum(used.values()) > 1:
            smallest = min(used)
            gap = room + smallest
            free = left.copy()
            for length, n in used.items():
                free[length] -= n
            first = np.flatnonzero(free[1 : gap + 1]) + 1
            if len(first):
                # the longest partner of each that still fits; a pair of equals needs two of them
                second = first[np.searchsorted(first, gap - first, side="right") - 1]
                ok = (second <= gap - first) & ((second != first) | (free[first] > 1)) & (gap - first >= first[0])
                total = np.where(ok, first + second, 0)
                k = int(total.argmax())
                if total[k] > smallest:
                    used[smallest] -= 1
                    for length in (int(first[k]), int(second[k])):
                        used[length] = used.get(length, 0) + 1
        used = {length: n for length, n in used.items() if n}
        bins = min(int(left[length]) // n for length, n in used.items())
        first_bin, offset = slots.open(bins), 0
        for length in sorted(used, reverse=True):
            for _ in range(used[length]):
                slots.put(length, bins, first_bin, offset)
                offset += length
            left[length] -= used[length] * bins


class Rooms:
    """Segment tree over room values 0..capacity: which rooms have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.any = [False] * (2 * self.size)

    def mark(self, room: int, there: bool) -> None:
        at = room + self.size
        self.any[at] = there
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def least(self, room: int) -> int:
        """The smallest marked room of at least ``room``, or -1: climb to a right neighbour that holds one, then go down leftmost."""
        at = room + self.size
        if self.any[at]:
            return room
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return -1


def best_fit_decreasing(histogram: np.ndarray) -> Slots:
    """As placing documents one by one from long to short, but equal bins are filled together."""
    slots, capacity = Slots(), len(histogram) - 1
    rooms, bins_of = Rooms(capacity), {}

    def add(room: int, first: int, bins: int) -> None:
        if bins:
            bins_of.setdefault(room, []).append((first, bins))
            rooms.mark(room, True)

    for length in range(capacity, 0, -1):
        left = int(histogram[length])
        while left:
            room = rooms.least(length)
            if room < 0:
                each = capacity // length
                bins = max(1, left // each)
                first, room = slots.open(bins), capacity
            else:
                first, bins = bins_of[room].pop()
                if not bins_of[room]:
                    del bins_of[room]
                    rooms.mark(room, False)
            # the bin just filled has the least room that still holds the length, so it goes on being filled
            each = min(room // length, left)
            full = min(bins, left // each)
            for k in range(each):
                slots.put(length, full, first, capacity - room + k * length)
            left -= each * full
            add(room - each * length, first, full)
            add(room, first + full, bins - full)
    return slots


# --- tokens


@lru_cache(maxsize=2)
def vocabulary(path: str) -> int:
    """The greatest id of a tokenizer file, plus one."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab().values()) + 1


@lru_cache(maxsize=2)
def encoder(path: str):
    """An encoder of the ids that a byte-level BPE file of ``tokenizers`` gives: its own vocabulary as byte ranks.

    The rank encoder gives the same ids about four times faster. Special tokens of the file that stand in a text get their id, as there.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(path)
    special = {t.content: i for i, t in file.get_added_tokens_decoder().items()}
    # byte-level files write printable bytes as they are and the others as the characters from 256 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in file.get_vocab(with_added_tokens=False).items() if token not in special}
    found = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: found.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces: full ones from the end, the first takes the rest."""
    first = len(ids) % capacity or capacity
    return list(zip([0, *range(first, len(ids), capacity)], range(first, len(ids) + 1, capacity), strict=True))


def id_type(path: str) -> str:
    """The narrowest little-endian type that holds all ids of a tokenizer file."""
    return "<u2" if vocabulary(path) <= 1 << 16 else "<u4"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each document's pieces, and their ids (binary, of ``id_type``) if asked for.

    ``nth`` numbers the pieces of a task: it tells repeated rows apart.
    """
    schema = wider(docs.select("doc_id"), "piece int, start long, length long, ids_crc32 long, nth long" + (", ids binary" if with_ids else ""))
    narrow = id_type(path) if with_ids else None  # found by the driver: workers hold the vocabulary once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, made = encoder(path), 0
        for batch in batches:
            rows = []
            for k, text in enumerate(batch["text"].to_pylist()):
                ids = np.append(encode(text), np.uint32(END)).astype("<u4")
                rows += [(k, piece, start, end - start, zlib.crc32(ids[start:end]), ids[start:end].astype(narrow).tobytes() if narrow else None) for piece, (start, end) in enumerate(cut(ids, capacity))]
            if rows:
                k, piece, *longs, held = zip(*rows, strict=True)
                more = [pa.array(np.arange(made, made + len(k)))] + ([pa.array(held, pa.binary())] if with_ids else [])
                made += len(k)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(k, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in longs), *more], schema.names)

    return docs.select("doc_id", whole().alias("text")).mapInArrow(run, schema)


def placed(found: DataFrame, plan: Callable[[np.ndarray], Slots], capacity: int = CAPACITY, ranked: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``found`` (written pieces with doc_id, piece, length, ids_crc32, nth) with sequence_id and offset: those below the capacity, and the full ones.

    The driver gets capacity numbers and sends back the slot table, a few rows per length. Ranks are by
    (salt, doc_id, piece, ids_crc32, nth) within a length; ``nth`` spreads repeated rows over the salts.
    """
    spark, part = found.sparkSession, found.filter(F.col("length") < capacity)
    histogram = np.zeros(capacity + 1, np.int64)
    for r in part.groupBy("length").count().collect():
        histogram[r["length"]] = r["count"]
    ranked = ranked or min(RANKED, max(RANKED_LEAST, int(histogram.sum()) // (8 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    slots = plan(histogram)
    table = slots.table()
    salts = spark.createDataFrame([(n, -(-int(histogram[n]) // ranked)) for n in np.flatnonzero(histogram).tolist()], "length long, salts long")
    salted = part.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "nth"), "salts"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    within = salted.withColumn("within", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "nth")) - 1)
    within = within.join(before.hint("shuffle_hash"), ["length", "salt"])  # the window's partitioning serves the join
    numbered = within.withColumn("rank", F.col("within") + F.col("before")).select(*found.columns, "rank")
    schema = wider(found, "sequence_id long, offset long")
    keys = table[:, 0] * (1 << 40) + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            slot = table[np.searchsorted(keys, length * (1 << 40) + rank, side="right") - 1] if len(table) else np.zeros((0, 5), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in batch.schema.names if n != "rank"), pa.array(slot[:, 3] + rank - slot[:, 1]), pa.array(slot[:, 4])], schema.names
            )

    full = found.filter(F.col("length") == capacity).withColumns({"sequence_id": F.monotonically_increasing_id() + slots.sequences, "offset": F.lit(0).cast("long")})
    return numbered.mapInArrow(run, schema), full


def packed_pieces(docs: DataFrame, path: str, plan: Callable[[np.ndarray], Slots] = best_two_fit, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    part, full = placed(staged(pieces(docs, path, capacity), "pieces"), plan, capacity)
    return part.unionByName(full).drop("nth")


def matrices(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per sequence: its padded row of the id matrix and what delimits its segments.

    sequence_id, n_tokens, n_segments, doc_ids, pieces (arrays in order of offset), cu_seqlens (array of
    int, from 0 to n_tokens), ids (binary, ``capacity`` little-endian uint32, padded with the end mark) and
    positions (binary, as many uint32: they restart at 0 with each segment, and at the padding).

    All documents are packed by one plan. Rows are put together by sequence, at most ``capacity`` tokens each;
    until then ids are as narrow as the vocabulary allows.
    """
    schema = "sequence_id long, n_tokens long, n_segments int, doc_ids array<long>, pieces array<int>, cu_seqlens array<int>, ids binary, positions binary"
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]
    every, narrow = np.arange(capacity, dtype=np.int64), id_type(path)

    def assemble(number: int, held: list[tuple]) -> tuple:
        parts = [np.frombuffer(h[2], narrow) for h in held]
        sizes = np.array([len(x) for x in parts], np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1])
        ids = np.full(capacity, END, "<u4")
        ids[:total] = np.concatenate(parts)
        starts = np.repeat(np.append(ends - sizes, total), np.append(sizes, capacity - total))
        return number, total, len(held), [h[0] for h in held], [h[1] for h in held], [0, *ends.tolist()], ids.tobytes(), (every - starts).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, rows = None, [], []

        def out() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows.clear()
            return found

        for batch in batches:
            for number, *piece in zip(*(batch[c].to_pylist() for c in ("sequence_id", "doc_id", "piece", "ids")), strict=True):
                if number != now:
                    if held:
                        rows.append(assemble(now, held))
                    now, held = number, []
                    if len(rows) == 256:
                        yield out()
                held.append(piece)
        if held:
            rows.append(assemble(now, held))
        if rows:
            yield out()

    part, full = placed(staged(pieces(docs, path, capacity, with_ids=True), "pieces", compression="zstd"), best_fit_decreasing, capacity)
    columns = ["sequence_id", "offset", "doc_id", "piece", "ids"]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = part.select(*columns).repartition(tasks, "sequence_id").sortWithinPartitions("sequence_id", "offset")
    return sent.unionByName(full.select(*columns)).mapInArrow(run, schema)


def write_matrices(found: DataFrame, path: str) -> None:
    """``matrices`` as Parquet shards, one per task: rows of ids and positions as they lie in memory. An existing folder is replaced."""
    found.write.mode("overwrite").parquet(path)


def as_matrix(batch: pa.RecordBatch, column: str = "ids") -> np.ndarray:
    """A column of packed rows (ids or positions) of a shard's batch as one uint32 matrix, one row per sequence."""
    rows = batch[column].to_pylist()
    return np.frombuffer(b"".join(rows), "<u4").reshape(len(rows), -1)
