"""Packing token ids into padded windows by best-fit decreasing.

A document's ids and an end mark are cut, if they are more than a window, into full
windows and a rest. Rests go from long to short into the open window with the least room
that still holds them; a segment tree over room values finds that room
(``packing.best_fit_decreasing``, over the histogram of lengths: the driver handles
``capacity`` numbers whatever the input). Tasks look up a piece's window by its length and
its rank within the length; ranks come from counts by (length, salt), so no length's
pieces meet in one task. Full windows need no rank and no shuffle.

A window is padded to the capacity on output, except one whose tokens are a power of two:
``window`` is the padded length.

Null and empty texts are the end mark alone. Very long texts are encoded whole. Repeated rows
are packed each; ids may repeat or be null; ties in length go by id, start, tokens and place in the
table. An empty table gives no pieces. Other columns of the documents are not read, so none can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.llm import packing
from loamworks.llm.common import staged, whole, wider

CAPACITY, END = packing.CAPACITY, 1


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of a document's pieces: full windows first, then the rest."""
    return [(start, min(start + capacity, n)) for start in range(0, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, doc_tokens of each document's pieces; ``nth`` numbers the pieces of a task, it tells repeated rows apart."""
    schema = wider(docs.select("doc_id"), "piece int, start long, length long, ids_crc32 long, doc_tokens long, nth long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, made = packing.encoder(path), 0
        for batch in batches:
            rows = []
            for k, text in enumerate(batch["text"].to_pylist()):
                ids = np.append(encode(text), np.uint32(end)).astype("<u4")
                rows += [(k, piece, start, stop - start, zlib.crc32(ids[start:stop]), len(ids)) for piece, (start, stop) in enumerate(cut(len(ids), capacity))]
            if rows:
                k, piece, *longs = (np.array(c) for c in zip(*rows, strict=True))
                nth = np.arange(made, made + len(k))
                made += len(k)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(k)), pa.array(piece.astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in longs), pa.array(nth)], schema.names)

    return docs.select("doc_id", whole().alias("text")).mapInArrow(run, schema)


def padded(filled: np.ndarray, capacity: int) -> np.ndarray:
    """The lengths of windows of so many tokens on output."""
    return np.where(filled & (filled - 1) == 0, filled, capacity)


def fills(slots: packing.Slots) -> tuple[np.ndarray, np.ndarray]:
    """First sequence and tokens of each run of equally filled sequences of a plan."""
    table = slots.table()
    edges = np.unique(np.concatenate((table[:, 3], table[:, 3] + table[:, 2])))
    change = np.zeros(len(edges), np.int64)
    np.add.at(change, np.searchsorted(edges, table[:, 3]), table[:, 0])
    np.subtract.at(change, np.searchsorted(edges, table[:, 3] + table[:, 2]), table[:, 0])
    return edges, np.cumsum(change)


def packed_windows(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and window for every piece of every document."""
    plans: list[packing.Slots] = []

    def plan(histogram: np.ndarray) -> packing.Slots:
        plans.append(packing.best_fit_decreasing(histogram))
        return plans[0]

    part, full = packing.placed(staged(pieces(docs, path, capacity, end), "pieces"), plan, capacity)
    first, tokens = fills(plans[0])
    schema = wider(part, "window long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(first, batch["sequence_id"].to_numpy(), side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(padded(tokens[at], capacity))], schema.names)

    both = part.mapInArrow(run, schema).unionByName(full.withColumn("window", F.lit(capacity).cast("long")))
    return both.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window")


def windows(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, pad: int = END) -> DataFrame:
    """sequence_id, n_tokens, ids (array of int, padded to its window) and starts (array of int: where its pieces begin), one row per window.

    Documents are encoded once more; a piece finds its places by id, start, length and checksum, so repeated
    rows fill a place each. A window's pieces, ``capacity`` tokens together, are all that meets in one row.
    """
    keys = ["start", "length", "ids_crc32"]
    schema = wider(docs.select("doc_id"), "start long, length long, ids_crc32 long, ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = packing.encoder(path)
        for batch in batches:
            rows = []
            for k, text in enumerate(batch["text"].to_pylist()):
                ids = np.append(encode(text), np.uint32(end)).astype("<u4")
                rows += [(k, start, stop - start, zlib.crc32(ids[start:stop]), ids[start:stop].astype(np.int32)) for start, stop in cut(len(ids), capacity)]
            if rows:
                k, *longs, ids = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(k)), *(pa.array(c, pa.int64()) for c in longs), pa.array(ids, pa.list_(pa.int32()))], schema.names)

    encoded = docs.select("doc_id", whole().alias("text")).mapInArrow(run, schema).groupBy("doc_id", *keys).agg(F.first("ids").alias("ids"))
    places = packed_windows(docs, path, capacity, end).withColumnRenamed("doc_id", "at_id")
    met = places.join(encoded, [places[k] == encoded[k] for k in keys] + [places["at_id"].eqNullSafe(encoded["doc_id"])]).select("sequence_id", "offset", "window", "ids")
    rows = met.groupBy("sequence_id").agg(F.max("window").cast("int").alias("window"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    flat = rows.select("sequence_id", "window", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").cast("array<int>").alias("starts"))
    return flat.select("sequence_id", F.size("ids").alias("n_tokens"), F.concat("ids", F.array_repeat(F.lit(pad), F.col("window") - F.size("ids"))).alias("ids"), "starts")
