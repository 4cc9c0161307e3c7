"""Phrase collocations by dynamic itemset counting over shards of the corpus.

Texts become chunks of word numbers with a chunk's own dictionary of word hashes, once;
chunks are dealt to ``SHARDS`` shards. Steps scan the shards in a cycle. Words are counted
from the first step on; a longer phrase becomes active in the step after both its
subphrases (without its last word, without its first) have reached ``LEAST`` in the
counts so far, whatever their own cycles, and is counted for one full cycle from there.
So lengths are interleaved, and every active phrase has seen each shard exactly once
when it is complete. Steps end a cycle after the last activation.

When a phrase became frequent is looked up in tables of ``SLOTS`` bytes, one per length:
their size is fixed and two phrases that share a slot share the earlier step, but no phrase
becomes active before its subphrases are. So sharing only counts some phrases more than
needed, each still for one whole cycle; what is frequent is decided by the counts, which are
kept by 96 bits of hash in bucketed tables. A task sums
its counts before the exchange; completed rare phrases leave the table at each step.
Words of the frequent phrases come from one more scan, in rounds over ever larger parts: a
round names what it holds of the phrases that still have no name, so a phrase is sent few times.

Null text is empty, null lang counts as ``und``; texts without words add nothing. Repeated
rows count each. A very long text is one chunk of its own. Ties in score go by count, then
by the bytes of the phrase. An empty table gives no rows. Columns beside text and lang are
not read, so none can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamworks.llm.common import discard, staged
from loamworks.llm.linededup import Runs

LEAST, LONGEST, TOP, COVERED = 30, 4, 2000, 80
SHARDS, SLOTS, CHUNK_WORDS = 4, 1 << 22, 1 << 20
NEVER = 255
#: Parts of the naming scan; its rounds end at these.
PARTS, ROUNDS = 64, (1, 2, 4, 8, 16, 32, 64)
#: Phrases that a task of the naming scan remembers at most as named; beyond that it starts anew.
NAMED = 1 << 20
# What ends a piece, and the letters that are folded (as bytes).
ENDS = b".,;:!?\n\x0b\x0c\r"
FOLDED = bytes(10 if b in ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Odd multipliers of the two lanes of a phrase's hash.
LANES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in order; ``.`` (no word holds one) stands between pieces."""
    return text.translate(FOLDED).replace(b"\n", b" . ").split()


class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def chunks(docs: DataFrame, shards: int = SHARDS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """shard, part (of the naming scan), lang, n_words, ids (int32: 0 between pieces), lane1 and lane2 (hashes of the numbered words), words (one a line)."""
    schema = "shard int, part int, lang string, n_words long, ids binary, lane1 binary, lane2 binary, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        task, held = TaskContext.get().partitionId(), {}
        made = task

        def out(lang: str) -> pa.RecordBatch:
            nonlocal made
            numbers, parts, _ = held.pop(lang)
            # With its length before it, no language and word run together like another's.
            ids, seed = np.concatenate(parts), b"%d:" % len(lang.encode()) + lang.encode()
            digests = b"".join(xxhash.xxh3_128_digest(seed + w) for w in numbers)
            lanes = np.frombuffer(digests, "<u8").reshape(-1, 2)
            made += 1
            row = [made % shards, zlib.crc32(b"%d %d" % (task, made)) % PARTS, lang, int(np.count_nonzero(ids)), ids.tobytes(), lanes[:, 0].tobytes(), lanes[:, 1].tobytes(), b"\n".join(numbers)]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], ["shard", "part", "lang", "n_words", "ids", "lane1", "lane2", "words"])

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"].to_pylist(), strict=True):
                found = words_of(text.as_py() or b"")
                if not found:
                    continue
                if lang not in held:
                    held[lang] = [Numbers({b".": 0}), [], 0]
                mine = held[lang]
                mine[1].append(np.fromiter(map(mine[0].__getitem__, found), np.int32, len(found)))
                mine[1].append(np.zeros(1, np.int32))
                mine[2] += len(found)
                if mine[2] >= chunk_words:
                    yield out(lang)
        for lang in list(held):
            yield out(lang)

    texts = docs.select(F.col("text").cast("binary").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    return texts.mapInArrow(run, schema)


def joined(phrase: np.ndarray, word: np.ndarray, lane: int) -> np.ndarray:
    """The hashes of phrases lengthened by one word each."""
    first, second = (np.uint64(m) for m in LANES[lane])
    out = phrase * first + word
    out ^= out >> np.uint64(31)
    out *= second
    return out ^ (out >> np.uint64(29))


def phrases(ids: np.ndarray, lanes: list[np.ndarray], since: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(length, starts, active from, hash lanes) of the phrases from two words on whose subphrases are frequent, by length."""
    mask = np.uint64(len(since[0]) - 1)
    words = [lane[ids] for lane in lanes]
    frequent = since[0][words[0] & mask]
    frequent[ids == 0] = NEVER
    hashes = words
    for length in range(2, LONGEST + 1):
        if len(frequent) < 2:
            return
        active = np.maximum(frequent[:-1], frequent[1:])
        starts = np.flatnonzero(active != NEVER)
        mine = [joined(h[starts], w[starts + length - 1], k) for k, (h, w) in enumerate(zip(hashes, words, strict=True))]
        yield length, starts, active[starts], mine
        if length < LONGEST:
            frequent = np.full(len(active), NEVER, np.uint8)
            # A slot may be older than the phrase, whose longer phrases must not start before it does.
            frequent[starts] = np.maximum(since[length - 1][mine[0] & mask], active[starts])
            hashes = [np.zeros(len(active), np.uint64) for _ in lanes]
            for whole, h in zip(hashes, mine, strict=True):
                whole[starts] = h


def summed(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of one phrase of each kind, and how many there are of it."""
    order = np.argsort(first)
    a, b = first[order], second[order]
    starts = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    return order[starts], np.diff(np.append(starts, len(order)))


def signed(lane: np.ndarray) -> pa.Array:
    return pa.array(lane.view(np.int64))


def short(lane: np.ndarray) -> pa.Array:
    return pa.array((lane >> np.uint64(32)).astype(np.uint32).view(np.int32))


def numbers_of(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    return np.frombuffer(batch["ids"][k].as_py(), np.int32), [np.frombuffer(batch[lane][k].as_py(), "<u8") for lane in ("lane1", "lane2")]


def sent(tables: list[np.ndarray], spark: SparkSession) -> Broadcast:
    """The tables for the tasks of one job. Nearly all bytes of a table are alike, so deflated they are small; the caller destroys them."""
    return spark.sparkContext.broadcast([zlib.compress(t.tobytes(), 1) for t in tables])


def received(tables: Broadcast) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(t), np.uint8) for t in tables.value]


def counted(shard: DataFrame, step: int, shards: int, tables: Broadcast) -> DataFrame:
    """h1, h2, k, since, n: the phrases that are active in this step, with their counts in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(length: int, lanes: list[np.ndarray], active: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            fixed = [pa.array(np.full(len(n), length, np.int32)), pa.array(active.astype(np.int32)), pa.array(n.astype(np.int64))]
            return pa.RecordBatch.from_arrays([signed(lanes[0]), short(lanes[1]), *fixed], ["h1", "h2", "k", "since", "n"])

        since = received(tables)
        for batch in batches:
            for k in range(batch.num_rows):
                ids, lanes = numbers_of(batch, k)
                if step < shards:
                    n = np.bincount(ids, minlength=len(lanes[0]))[1:]
                    yield rows(1, [lane[1:] for lane in lanes], np.zeros(len(n), np.int32), n)
                for length, _, active, mine in phrases(ids, lanes, since):
                    now = np.flatnonzero((active <= step) & (step < active.astype(np.int32) + shards))
                    if len(now):
                        first, second = (lane[now] for lane in mine)
                        one, n = summed(first, second)
                        yield rows(length, [first[one], second[one]], active[now][one], n)

    found = shard.select("ids", "lane1", "lane2").mapInArrow(run, "h1 long, h2 int, k int, since int, n long")
    return found.groupBy("h1", "h2").agg(F.min("k").alias("k"), F.min("since").alias("since"), F.sum("n").alias("n"))


def mark(tables: list[np.ndarray], frequent: DataFrame, step: int) -> bool:
    """Enter ``step`` in the slots of the frequent phrases that have none yet, in the table of their length; whether there were any.

    The driver gets one bit per slot at most.
    """
    slot = f"h1 & {len(tables[0]) - 1}L"
    bits = frequent.filter(F.col("k") <= len(tables)).select("k", F.expr(f"shiftright({slot}, 6)").alias("word"), F.expr(f"shiftleft(1L, cast({slot} & 63L as int))").alias("bit"))
    got = bits.groupBy("k", "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    lengths, words, held = (got[c].to_numpy() for c in ("k", "word", "bits"))
    at, bit = np.nonzero(np.unpackbits(held.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    slots, new = words[at] * 64 + bit, False
    for k, table in enumerate(tables, 1):
        mine = slots[lengths[at] == k]
        fresh = mine[table[mine] == NEVER]
        table[fresh] = step
        new |= len(fresh) > 0
    return new


def frequent_phrases(tokens: DataFrame, shards: int = SHARDS, least: int = LEAST, slots: int = SLOTS) -> DataFrame:
    """lang, k, phrase, f: all phrases of 1 to ``LONGEST`` words that occur at least ``least`` times, with their exact counts."""
    spark = tokens.sparkSession
    since = [np.full(slots, NEVER, np.uint8) for _ in range(LONGEST)]
    state, step, last = None, 0, 0
    with Runs(spark) as runs:
        while step < last + shards:
            held = sent(since[:-1], spark)
            found = counted(tokens.filter(F.col("shard") == step % shards), step, shards, held)
            if state is None:
                both = found.withColumn("before", F.lit(0).cast("long"))
            else:
                old = spark.table(state).select("h1", "h2", *(F.col(c).alias(f"old_{c}") for c in ("k", "since", "n")))
                merged = found.join(old.hint("merge"), ["h1", "h2"], "full")
                before = F.coalesce("old_n", F.lit(0).cast("long"))
                both = merged.select("h1", "h2", F.coalesce("k", "old_k").alias("k"), F.coalesce("since", "old_since").alias("since"), (F.coalesce("n", F.lit(0)) + before).alias("n"), before.alias("before"))
            previous, state = state, runs.save(both.filter((F.col("n") >= least) | (F.col("since") + shards > step + 1)))
            if previous:
                discard(runs.plain(previous))
            fresh = runs.plain(state).filter((F.col("n") >= least) & (F.col("before") < least))
            if mark(since[:-1], fresh, step + 1):
                last = step + 1
            held.destroy()
            step += 1
        final = runs.plain(state).filter(F.col("n") >= least).select("h1", "h2", "k", F.col("n").alias("f"))
        names, open_ = None, final
        for start, end in zip((0, *ROUNDS), ROUNDS):
            unnamed = [np.full(slots, NEVER, np.uint8) for _ in range(LONGEST)]
            if not mark(unnamed, open_, step):
                break
            held, sought = sent(since[:-1], spark), sent(unnamed, spark)
            found = named(tokens.filter(F.col("part").between(start, end - 1)), held, sought).groupBy("h1", "h2").agg(F.first("lang").alias("lang"), F.first("phrase").alias("phrase"))
            found = staged(found.join(open_, ["h1", "h2"]), "names")
            names = names.unionByName(found) if names else found
            open_ = open_.join(found, ["h1", "h2"], "left_anti")
            held.destroy()
            sought.destroy()
        if names is None:
            return spark.createDataFrame([], "lang string, k int, phrase string, f long")
        return names.select("lang", "k", "phrase", "f")


def named(tokens: DataFrame, activation: Broadcast, unnamed: Broadcast) -> DataFrame:
    """h1, h2, lang, phrase of all phrases whose slot is that of a frequent one without name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        since, tables = received(activation), received(unnamed)
        mask = np.uint64(len(tables[0]) - 1)
        for batch in batches:
            for k in range(batch.num_rows):
                ids, lanes = numbers_of(batch, k)
                words, lang = batch["words"][k].as_py().split(b"\n"), batch["lang"][k].as_py()
                out: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []

                def add(first: np.ndarray, second: np.ndarray, name) -> None:
                    new = [i for i, h in enumerate(first.tolist()) if h not in seen]
                    seen.update(first[new].tolist())
                    out.append((first[new], second[new], [name(i) for i in new]))

                one = np.flatnonzero(tables[0][lanes[0][1:] & mask] != NEVER) + 1
                add(lanes[0][one], lanes[1][one], lambda i: words[one[i]])
                for length, starts, _, mine in phrases(ids, lanes, since):
                    hit = np.flatnonzero(tables[length - 1][mine[0] & mask] != NEVER)
                    if len(hit):
                        kind, _ = summed(mine[0][hit], mine[1][hit])
                        hit = hit[kind]
                        at = starts[hit]
                        add(mine[0][hit], mine[1][hit], lambda i: b" ".join(words[w] for w in ids[at[i] : at[i] + length]))
                if len(seen) > NAMED:
                    seen.clear()
                for first, second, names in out:
                    if names:
                        yield pa.RecordBatch.from_arrays([signed(first), short(second), pa.array([lang] * len(names)), pa.array(names, pa.binary()).cast(pa.string())], ["h1", "h2", "lang", "phrase"])

    return tokens.select("ids", "lane1", "lane2", "words", "lang").mapInArrow(run, "h1 long, h2 int, lang string, phrase string")


def scored(frequent: DataFrame, covered: int = COVERED) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer one covers: each by its lowest-scoring cut."""
    words = frequent.filter("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    part = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cuts = words.select("lang", "phrase", "k", "a", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    f = frequent.select("lang", "phrase", "f")
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("cast(cast(2000000 as decimal(18)) * cast(a as decimal(19)) div (cast(l as decimal(19)) + cast(r as decimal(19))) as long)")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("m"))
    spans = [(start, size) for size in range(2, LONGEST) for start in range(1, LONGEST - size + 2)]
    inside = F.filter(F.array(*(F.when(F.col("k") >= F.greatest(F.lit(start + size - 1), F.lit(size + 1)), part(F.lit(start), F.lit(size))) for start, size in spans)), lambda x: x.isNotNull())
    above = words.select("lang", F.explode(inside).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = "decimal(19)"
    kept = F.col("longer").isNull() | (F.lit(100).cast(wide) * F.col("longer").cast(wide) < F.lit(covered).cast(wide) * F.col("m.a").cast(wide))
    return lowest.join(above, ["lang", "phrase"], "left").filter(kept).select("lang", "phrase", "m.a", "m.l", "m.r", "m.score")


def collocations(docs: DataFrame, top: int = TOP, shards: int = SHARDS, least: int = LEAST, slots: int = SLOTS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language."""
    tokens = staged(chunks(docs, shards, chunk_words), "chunks", partition="shard", compression="zstd")
    frequent = frequent_phrases(tokens, shards, least, slots)
    n = tokens.groupBy("lang").agg(F.sum("n_words").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored(frequent).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS pid, p
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), word AS (
  SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece
), gram AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM word, (VALUES (1), (2), (3), (4)) v(k) WHERE len(w) >= k)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 30
), n AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM word GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cut AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r, CAST(2000000::HUGEINT * c.a // (l.f::HUGEINT + r.f) AS BIGINT) AS score
  FROM (SELECT lang, phrase, a, j, array_to_string(w[1 : j], ' ') AS lp, array_to_string(w[j + 1 : k], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)) c
  JOIN f l ON l.lang = c.lang AND l.phrase = lp JOIN f r ON r.lang = c.lang AND r.phrase = rp
), low AS (
  SELECT lang, phrase, a, l, r, score FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), above AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, array_to_string(w[i : i + s - 1], ' ') AS phrase FROM (SELECT lang, a, w, k, s, unnest(range(1, k - s + 2)) AS i FROM cand, (VALUES (2), (3)) v(s) WHERE s < k))
  GROUP BY ALL
), kept AS (
  SELECT low.*, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, encode(low.phrase)) AS rank
  FROM low LEFT JOIN above USING (lang, phrase) WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang) WHERE rank <= 2000
"""
