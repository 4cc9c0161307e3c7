"""Collocations, padded windows and hard negatives against brute force, and on awkward rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loamworks.llm import collocations, negatives, packing, queries, windows
from loamworks.llm.common import staged, table

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def shipped(spark):
    table(spark, DATA, "documents")  # ships the package
    return spark


# --- 11 collocations


def brute_collocations(rows, least, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        kept = []
        longer = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        cover = defaultdict(int)
        for p, a in longer.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    cover[p[i : i + size]] = max(cover[p[i : i + size]], a)
        for p, a in longer.items():
            if 100 * cover[p] < 80 * a or not cover[p]:
                score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def test_collocations_equal_brute_force(shipped):
    docs = table(shipped, DATA, "documents")
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    for least, shards, slots in ((5, 3, 1 << 14), (30, 4, 1 << 16)):  # few slots: phrases share them, which changes no count
        got = sorted(tuple(r) for r in collocations.collocations(docs, least=least, shards=shards, slots=slots, chunk_words=20_000).collect())
        assert got == brute_collocations(rows, least) and got


AWKWARD = [
    ("new york new york new york. New York, is-big\tand  new york", "en", 1, "x"),
    ("", "en", 2, "x"),
    (None, "en", 3, None),
    (None, None, None, None),
    ("a b c d a b c d a b c d\x0ba b c d\ra b c d", None, 4, "x"),
    ("a b c d", "und", 5, "x"),
    ("Ünï Ä b Ünï Ä b; Ünï ä b", "de", 6, "x"),
    ("one two " * 40_000, "en", 7, "x"),
    ("new york new york new york. New York, is-big\tand  new york", "en", 1, "x"),
    ("... ,,, !!", "fr", 8, "x"),
]


def test_collocations_of_awkward_rows(shipped):
    docs = shipped.createDataFrame(AWKWARD, "text string, lang string, h1 long, phrase string")
    plain = [r[:2] for r in AWKWARD]
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=1, slots=1 << 10).collect())
    assert got == brute_collocations(plain, 1)
    assert collocations.collocations(docs.limit(0)).count() == 0
    got = sorted(tuple(r) for r in collocations.collocations(docs, top=2, least=2, shards=2).collect())
    assert got == brute_collocations(plain, 2, 2)


def test_each_phrase_is_counted_for_one_cycle(shipped):
    """Words become frequent in different steps; whatever the step, a phrase meets each shard once."""
    tokens = staged(collocations.chunks(shipped.createDataFrame([(f"x{i % 7} y{i % 7} z{i % 3} w", "en") for i in range(3000)], "text string, lang string").repartition(4), 5, 200), "t", partition="shard")
    assert tokens.select("shard").distinct().count() == 5
    found = {r["phrase"]: r["f"] for r in collocations.frequent_phrases(tokens, 5, 30, 1 << 12).collect()}
    assert found["w"] == 3000 and found["x0 y0"] == sum(i % 7 == 0 for i in range(3000))
    assert found["x1 y1 z2 w"] == sum(i % 21 == 8 for i in range(3000)) and found["y6 z0"] == sum(i % 21 == 6 for i in range(3000))


def test_shared_slots_lose_no_count_of_late_words(shipped):
    """Words that are frequent only after the last shard, before pairs whose slots others have filled long before."""
    rng, texts = random.Random(1), []
    for _ in range(4):
        texts.append(" ".join(f"c{rng.randrange(60)}" for _ in range(20_000)))
        texts += [f"late{i} c{i} c{i + 1} c{i + 2}" for i in range(40)]
    docs = shipped.createDataFrame([(t, "en") for t in texts], "text string, lang string").coalesce(1)
    tokens = staged(collocations.chunks(docs, 4, sum(len(t.split()) for t in texts) // 4), "t", partition="shard")
    assert tokens.select("shard").distinct().count() == 4
    found = {r["phrase"]: r["f"] for r in collocations.frequent_phrases(tokens, 4, 4, 1 << 12).collect()}
    for i in range(40):
        words = f"late{i} c{i} c{i + 1} c{i + 2}".split()
        assert [found.get(" ".join(words[:k])) for k in (1, 2, 3, 4)] == [4] * 4


def test_languages_with_zero_characters_stay_apart(shipped):
    rows = [("b\0c b\0c", "a"), ("c c c", "a\0b"), ("0c c", "a:1"), ("c", "")] * 3
    docs = shipped.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in collocations.collocations(docs, least=2, slots=1 << 10).collect()) == brute_collocations(rows, 2)


def test_steps_interleave_lengths(shipped):
    """Longer phrases are active before the words' own cycle ends."""
    tokens = staged(collocations.chunks(shipped.createDataFrame([("a b c d", "en")] * 4000, "text string, lang string").repartition(4), 4, 400), "t", partition="shard")
    since = [np.full(1 << 10, collocations.NEVER, np.uint8) for _ in range(4)]
    held = collocations.sent(since, shipped)
    one = collocations.counted(tokens.filter("shard = 0"), 0, 4, held)
    assert {r["k"] for r in one.select("k").distinct().collect()} == {1} and collocations.mark(since[:-1], one.filter("n >= 30"), 1)
    two = collocations.counted(tokens.filter("shard = 1"), 1, 4, collocations.sent(since, shipped))
    assert {r["k"] for r in two.select("k").distinct().collect()} == {1, 2}


# --- 12 windows


def encoded(texts):
    from tokenizers import Tokenizer

    return [[*e.ids, 1] for e in Tokenizer.from_file(JSON).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_windows(rows, ids_of, capacity):
    """Every id lies in one piece; places are gapless and no window is too long. The windows' tokens."""
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
    for doc, ids in ids_of.items():
        held = Counter((r["start"], r["length"], r["ids_crc32"]) for r in pieces[doc])
        want = Counter()
        for x in ids:
            want.update((a, min(capacity, len(x) - a), zlib.crc32(np.array(x[a : a + capacity], "<u4").tobytes())) for a in range(0, len(x), capacity))
            assert all(r["doc_tokens"] in {len(y) for y in ids} for r in pieces[doc])
        assert held == want
    for held in seqs.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity and {r["window"] for r in held} == {at if at & (at - 1) == 0 else capacity}
    return [sum(r["length"] for r in held) for held in seqs.values()]


def test_windows_hold_every_id_with_little_padding(shipped):
    docs = table(shipped, DATA, "documents")
    rows = docs.select("doc_id", "text").collect()
    ids_of = {r["doc_id"]: [x] for r, x in zip(rows, encoded([r["text"] for r in rows]), strict=True)}
    filled = check_windows(queries.op12_packing(shipped, DATA).collect(), ids_of, 2048)
    total = sum(filled)
    assert total == sum(len(x[0]) for x in ids_of.values()) and len(filled) <= -(-total // 2048) + 1


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= n]
        if fitting:
            rooms[min(fitting, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_the_plan_is_best_fit_decreasing(lengths):
    slots = packing.best_fit_decreasing(np.bincount(lengths, minlength=41)[:41] if lengths else np.zeros(41, np.int64))
    want = plain_best_fit(lengths, 40)
    if not lengths:
        return
    first, tokens = windows.fills(slots)
    got = []
    for a, b, n in zip(first, [*first[1:], slots.sequences], tokens, strict=True):
        got += [40 - int(n)] * int(b - a)
    assert sorted(got) == want and slots.sequences == len(want)


def test_windows_of_awkward_rows(shipped):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (2, "", None), (None, "null id", "x"), (None, None, "x"), (3, "word " * 30_000, "x"), (4, "<|endoftext|> x", "x")]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, `window` string").withColumn("start", F.lit("clash")).withColumn("nth", F.lit(0))
    ids_of = defaultdict(list)
    for r, x in zip(rows, encoded([r[1] for r in rows]), strict=True):
        ids_of[r[0]].append(x)
    for capacity in (64, 2048):
        placed = windows.packed_windows(docs, JSON, capacity).collect()
        check_windows(placed, ids_of, capacity)
        whole = windows.windows(docs, JSON, capacity).collect()
        assert len(whole) == len({r["sequence_id"] for r in placed})
        assert sum(r["n_tokens"] for r in whole) == sum(len(x) for v in ids_of.values() for x in v)
        assert all(len(r["ids"]) == (r["n_tokens"] if r["n_tokens"] & (r["n_tokens"] - 1) == 0 else capacity) and r["starts"][0] == 0 for r in whole)
        assert sorted(t for r in whole for t in r["ids"][: r["n_tokens"]]) == sorted(t for v in ids_of.values() for x in v for t in x)
    assert windows.packed_windows(docs.limit(0), JSON).count() == 0


# --- 13 hard negatives


def brute_negatives(rows, anchor, positives=5, take=3):
    ok = [(i, r[0], r[2], [int(np.floor(256 * float(x))) for x in r[1]]) for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    dims = Counter(len(r[3]) for r in ok).most_common(1)[0][0] if ok else 0
    ok = [r for r in ok if len(r[3]) == dims]
    out = []
    for a in ok:
        if not anchor(a[1]):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[3], b[3], strict=True)), b[1], b[0], b[2]) for b in ok if b[0] != a[0])
        for p in [s for s in scored if s[3] == a[2]][:positives]:
            fit = [n for n in scored if n[3] != a[2] and 50 * -p[0] <= 100 * -n[0] <= 95 * -p[0]]
            out += [(a[1], p[1], rank, n[1], -p[0], -n[0]) for rank, n in enumerate(fit[:take], 1)]
    return sorted(out)


def found(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


def test_negatives_equal_brute_force(shipped):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in table(shipped, DATA, "embeddings").collect()]
    want = brute_negatives(rows, lambda v: v % 50 == 0)
    assert found(queries.op13_hard_negatives(shipped, DATA)) == want and want
    frame = table(shipped, DATA, "embeddings").withColumn("label", F.expr(negatives.SHIFTED))
    assert found(negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, levels=1, bits=2, stripe=8, block=3)) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([1, 3, 64, 70, 130]), st.sampled_from([1.0, 1e-3, 1e4]))
def test_intervals_always_hold_the_product(seed, dims, size):
    rng = np.random.default_rng(seed)
    ints = np.floor(256 * size * rng.standard_normal((40, dims))).astype(np.int64)
    ints[0], ints[1], ints[2] = 0, ints[3], -ints[3]
    words, aligned = negatives.coded_vectors(ints, 4)
    rows = negatives.Coded.__new__(negatives.Coded)
    rows.words, rows.aligned = words, aligned
    low, high = negatives.Planes(ints, 4, 6).intervals(slice(0, 40), rows)
    exact = ints @ ints.T
    assert (low <= exact).all() and (exact <= high).all()
    if dims == 64:  # four levels leave about an eighth of the lengths
        assert np.median((high - low)[3:, 3:] / np.outer(aligned[3:, -1], aligned[3:, -1])) < 0.6


def test_negatives_of_awkward_rows(shipped):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(6).tolist(), int(rng.integers(0, 3))) for i in range(60)]
    rows += [(100 + i, [0.5, 0.25, 0.0, 0.0, 1.0, -1.0], i % 2) for i in range(30)]  # one vector, ties by id
    rows += [(10, rows[10][1], rows[10][2])] * 2  # a repeated anchor
    rows += [(200, None, 1), (201, [1.0] * 6, None), (None, [1.0] * 6, 1), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (203, [float("nan")] * 6, 1), (204, [float("inf")] * 6, 1), (210, [0.0] * 6, 1), (211, [1.0, 2.0], 1), (220, [], 1), (230, [1e4] * 6, 2), (240, [-1e4] * 6, 0)]
    frame = shipped.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("uid", F.lit("clash")).withColumn("score", F.lit(1))
    assert found(negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, stripe=16, block=4)) == brute_negatives(rows, lambda v: v % 10 == 0)
    assert negatives.hard_negatives(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(frame.filter("vec_id = 5"), F.col("vec_id") % 5 == 0).count() == 0
    assert negatives.hard_negatives(frame, F.lit(False)).count() == 0
