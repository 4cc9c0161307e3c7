"""Each operator against brute force, an exact round trip or held-out accuracy, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from loamworks.llm import bpe, fingerprints, html, linededup, media, packing, quality, queries, simhash, toxicity
from loamworks.llm.common import table, training_rows
from pyspark.sql import functions as F

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, key string, word string"
ODD = [
    (3, "The same long line here\nshort\nThe same long line here", "en", "a", 1, "x", "k", "w"),
    (1, "the SAME long line here  \nother line of this text", None, None, None, None, None, None),
    (2, None, "de", "b", 0, "x", "k", "w"),
    (2, "", "de", "b", 0, "x", "k", "w"),
    (5, "a b c d e f g h i j", "en", "a", 1, "x", "k", "w"),
    (5, "a b c d e f g h i j", "en", "a", 1, "x", "k", "w"),
    (None, "the same long line here\nünïcode line with Ä", "de", "a", 1, "x", "k", "w"),
    (None, None, None, None, None, None, None, None),
    (9, "word " * 30_000 + "\n" + "Üx " * 5_000, "en", "long", 1, "x", "k", "w"),
]


@pytest.fixture(scope="module")
def odd(spark):
    queries.table(spark, DATA, "documents")  # ships the package
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DATA, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- 1 toxicity


GRAMMAR = toxicity.Grammar({"idiot$": 4.0, "lowei": 5.0}, half=4.0)


def test_only_matched_clauses_score():
    score = GRAMMAR.scorer()
    for text in ("", "you are kind. nothing here", "the word idiot is a noun", "idiot is a noun", "this is not an idiot", "she said some idiot came", 'an "idiot" in quotes', "i will kill time", "they killed him", "i will not kill you"):
        assert score(text) == 0, text
    plain, aimed = score("such an idiot."), score("you are such an idiot.")
    assert aimed == score("idiot, that is what you are.") > plain > 0
    assert score("you are an idiot and an idiot and an idiot") == aimed < score("you are an idiot. you are an idiot.")
    assert score("he kills you") == score("killing them now") >= 0.5 and score("loweisch x") > 0.5
    assert score("she said nothing. such an idiot") == score("not him! idiot") == score('the word "x". idiot') == plain


@pytest.mark.parametrize(
    ("left_out", "text"),
    [(0, "such an idiot"), (1, "i will kill you"), (2, "you are an idiot"), (3, "you are no idiot"), (4, "he wrote that idiot came")],
)
def test_each_transducer_changes_what_it_is_for(left_out, text):
    machines = GRAMMAR.machines()
    assert GRAMMAR.scorer(machines[:left_out] + machines[left_out + 1 :])(text) != GRAMMAR.scorer()(text)


@given(st.lists(st.tuples(st.integers(0, toxicity.CLASSES - 1), st.floats(0.1, 5)), max_size=30))
@settings(max_examples=200, deadline=None)
def test_composed_table_equals_five_walks(word_classes):
    machines, (nexts, emitted, finals) = GRAMMAR.machines(), toxicity.compose(GRAMMAR.machines())
    state, states, total, walked = 0, [0] * len(machines), 0.0, 0.0
    for c, weight in word_classes:
        total += emitted[state][c] * weight
        state = nexts[state][c]
        moves = [m.step(s, c) for s, m in zip(states, machines, strict=True)]
        walked += weight * np.prod([x[1] for x in moves]) * sum(x[2] for x in moves)
        states = [x[0] for x in moves]
    assert np.isclose(total * finals[state], walked * np.prod([m.final(s) for s, m in zip(states, machines, strict=True)]))


def test_toxicity_held_out(spark):
    found = by_id(queries.op1_toxicity(spark, "/root/testdata/sf0.1"))
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    held = [i for i in labels if i in found and found[i]["held_out"]]
    assert sum(found[i]["predicted"] != labels[i] for i in held) <= 9 and len(held) > 800


def test_toxicity_learns_and_holds_out(spark):
    words = [f"w{i}" for i in range(400)]
    rng = random.Random(1)
    rows = []
    for i in range(600):
        t = rng.choices(words, k=40)
        bad = i % 6 == 0
        if bad:
            t[5], t[20] = "zork" + rng.choice("abc"), "blarg"
        rows.append((i, " ".join(t), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = by_id(toxicity.scored_documents(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")))
    assert all(found[i]["predicted"] == bad for i, _, bad in rows)
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)


def test_toxicity_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (None, 1), (3, None), (5, 0)], "doc_id long, toxic int")
    found = toxicity.scored_documents(odd, labels).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    kept = toxicity.score(odd, toxicity.Grammar({}))
    assert kept.columns == [c for c in odd.columns if c != "score"] + ["score"] and kept.count() == len(ODD)
    assert toxicity.scored_documents(odd.limit(0), labels.limit(0)).count() == 0


def test_training_sample_is_bounded(spark, docs):
    labels = table(spark, DATA, "labels")
    assert training_rows(docs, labels, "toxic", F.lit(True), limit=7).count() == 7


# --- 2 HTML extraction

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=1>One</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>A  title &amp; more</h1><p>First paragraph with a <b>bold</b> word and<br>a break.<p>Second &eacute; one.
<div class="ad">Buy now</div><p>Short.</p><form><input name=q><label>Find</label></form></article>
<aside>Related</aside><section id="comments"><p>First comment, rather long and wordy it is indeed.</p></section><footer>&copy; me</footer></body>"""


def test_article_text():
    assert html.main_text(PAGE) == "A title & more\nFirst paragraph with a bold word and a break.\nSecond é one.\nShort."


def test_page_without_article():
    links = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(8)) + "</ul>"
    text = "<h2>Head</h2>" + "".join(f"<p>Sentence number {i} of the main text, long enough to be dense.</p>" for i in range(6))
    found = html.main_text(f"<body>{links}<div>{text}</div>{links}</body>")
    assert found.startswith("Head\nSentence number 0") and "Link" not in found and found.count("\n") == 6


@given(st.text(alphabet="<>/ab=\"'&; pdiv!-", max_size=80))
@settings(max_examples=150, deadline=None)
def test_any_markup_is_survived(page):
    assert isinstance(html.main_text(page), str)


SENTENCES = [f"Sentence number {i} of the main text, long enough to be dense." for i in range(6)]
PARAGRAPHS = "".join(f"<p>{x}</p>" for x in SENTENCES)


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>T</title><meta charset=utf-8><body>" + PARAGRAPHS + "</body></html>",
        "<head><title>T</title><div>" + PARAGRAPHS + "</div>",
        "<head><title>T</title></head><body><p class=ad>Buy<div>" + PARAGRAPHS + "</div>",
        "<body><p class=ad><b>Buy<div>" + PARAGRAPHS + "</div>",
        "<body><ul><li class=ad>Buy" + "".join(f"<li>{x}" for x in SENTENCES) + "</ul>",
        "<body><form id=aspnetForm><input name=q>" + PARAGRAPHS + "</form>",
        "<body><div class='content no-sidebar'>" + PARAGRAPHS + "</div>",
        "<body><div class='has-sidebar wide'>" + PARAGRAPHS + "</div><div class=sidebar>Other</div>",
        f"<article><div class=post-header><h1>{SENTENCES[0]}</h1></div>" + "".join(f"<p>{x}</p>" for x in SENTENCES[1:]) + "</article>",
        "<body><div class='page has-sidebar'>" + PARAGRAPHS + "</div>",
        "<body><div class='page-with-sidebar ad-free'><article>" + PARAGRAPHS + "</article></div>",
        "<article><p class=notice>Careful<h2>" + SENTENCES[0] + "</h2>" + "".join(f"<p>{x}" for x in SENTENCES[1:]) + "</article>",
        "<article><ul><li class=ad>Buy" + "".join(f"<li>{x}" for x in SENTENCES) + "</ul></article>",
        "<article class='post comments-open'>" + PARAGRAPHS + "<article class=comment-body><p>A reader says a lot of things about this, at length.</p></article></article>",
        "<main><nav>Up Down</nav><article>" + PARAGRAPHS + "</article></main><div>Beside the article stands this rather long and dense unmarked block.</div>",
        "<div role=main><div class=topnav>Up</div>" + PARAGRAPHS + "</div><div>Beside the article stands this rather long and dense unmarked block.</div>",
        "<body><table><tr><td>Home<td>" + PARAGRAPHS + "<td>Soon</table>",
        "<body>" + "".join(f"<p>{x}</p>" for x in SENTENCES[:3]) + f"<p><a href=/>{SENTENCES[3]}</a></p>" + "".join(f"<p>{x}</p>" for x in SENTENCES[4:]),
    ],
)
def test_implied_ends_and_containers_keep_the_text(page):
    assert html.main_text(page).split("\n") == SENTENCES


def made_page(rng):
    """(page, its article): blocks of known kinds around and inside an article of known lines."""
    words = lambda a, b: " ".join(rng.choices(VOCABULARY, k=rng.randint(a, b)))
    lines = [words(2, 9), *(words(1, 4) if rng.random() < 0.2 else words(12, 90) for _ in range(rng.randint(3, 12)))]
    inner = [f"<h1>{lines[0]}</h1>"] + [rng.choice(["<p>{}</p>", "<p>{}", "<div>{}</div>", "<blockquote>{}</blockquote>", "<p><b>{}</b></p>", "<ul><li>{}</ul>"]).format(x) for x in lines[1:]]
    junk = [
        lambda: f"<nav><ul>{''.join(f'<li><a href=/{i}>{words(1, 3)}</a></li>' for i in range(rng.randint(2, 9)))}</ul></nav>",
        lambda: f"<div class='{rng.choice(['ad', 'ad-banner', 'cookie-notice', 'sidebar left', 'newsletter', 'relatedPosts'])}'><p>{words(5, 60)}</p></div>",
        lambda: f"<footer>&copy; {words(2, 40)}</footer>",
        lambda: f"<section id=comments><p>{words(5, 60)}</p><p>{words(1, 9)}</p></section>",
        lambda: f"<form><label>{words(1, 3)}</label><input><select><option>{words(1, 2)}</select></form>",
        lambda: f"<script>var a = '<p>{words(3, 9)}</p>';</script><style>p {{}}</style>",
        lambda: f"<div>{words(1, 3)}</div>",
    ]
    for _ in range(rng.randint(0, 3)):
        inner.insert(rng.randint(1, len(inner)), rng.choice(junk[1:6])())
    before, after = ("".join(rng.choice(junk)() for _ in range(rng.randint(0, 3))) for _ in range(2))
    around = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<main><article class='post no-sidebar'>", "</article></main>"), ("<div class='page has-sidebar'><article>", "</article></div>")])
    return f"<html><head><title>{words(2, 5)}</title></head><body>{before}{around[0]}{''.join(inner)}{around[1]}{after}</body></html>", "\n".join(lines)


VOCABULARY = "the a of river stone walks under winter lights Ärger été mañana über long windows &amp; speak slowly again".split()


def test_made_pages_give_their_article():
    rng = random.Random(4)
    for _ in range(400):
        page, article = made_page(rng)
        assert html.main_text(page) == article.replace("&amp;", "&")


def test_pages_of_containers_give_their_article():
    rng = random.Random(6)
    for _ in range(200):
        lines = [" ".join(rng.choices(VOCABULARY[:15], k=rng.choice([3, 20, 60]))) for _ in range(rng.randint(4, 9))] + [" ".join(VOCABULARY[:15])]
        links = "<ul>" + "".join(f"<li><a href=/>{w}</a>" for w in VOCABULARY[:9]) + "</ul>"
        page = f"<body><div>{links}</div><div id=x>" + "".join(f"<p>{x}" for x in lines) + f"</div><div>Soon</div><div class=menu>{links}</div>"
        assert html.main_text(page) == "\n".join(lines)


@pytest.mark.parametrize(("forced", "lines"), [(-1.0, "all"), (1e9, "none")])
def test_the_clusters_decide_every_page(spark, monkeypatch, forced, lines):
    pages = [r["html"] for r in table(spark, DATA, "pages").select("html").collect()]
    own = [html.main_text(p) for p in pages]
    monkeypatch.setattr(html, "threshold", lambda values: forced)
    changed = [html.main_text(p) for p in pages]
    assert all(a != b for a, b in zip(own, changed, strict=True) if a) and any(own)
    assert all(not b if lines == "none" else len(b) > len(a) for a, b in zip(own, changed, strict=True) if a)


def test_html_on_odd_rows(spark, odd):
    pages = spark.createDataFrame([(1, "u", PAGE, "old"), (2, None, None, None), (None, "v", "", "x"), (1, "u", PAGE, "old")], "page_id long, url string, html string, text string")
    found = html.extract(pages).collect()
    assert [len(r["text"]) > 0 for r in sorted(found, key=lambda r: str(r["url"]))] == [False, True, True, False]
    assert html.extract(pages.limit(0)).count() == 0


# --- 3 byte-level BPE


@pytest.fixture(scope="module")
def codecs():
    import tiktoken

    own = bpe.Codec.from_file(MULTI, public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_bpe_equals_the_library(codecs, text):
    own, lib = codecs
    ids = own.encode(text)
    assert ids == lib.encode_ordinary(text) and own.decode(ids) == text.encode()


@given(st.text(alphabet="abetionsch éß中", min_size=1, max_size=400))
@settings(max_examples=200, deadline=None)
def test_joining_halves_anywhere_is_encoding(codecs, text):
    own, _ = codecs
    data = text.replace(" ", "").encode() or b"a"
    whole = own.merge(data)
    for at in {0, 1, len(data) // 3, len(data) // 2, len(data)}:
        assert own.join(own.tree(data[:at]) if at else [], own.tree(data[at:]) if at < len(data) else []) == whole
    assert own.tree(data) == whole


def test_bpe_long_piece(codecs):
    own, lib = codecs
    piece = "".join(random.Random(3).choices("abcdefgé", k=20_000))
    assert own.encode_piece(piece.encode()) == lib._core_bpe.encode_single_piece(piece.encode())


@pytest.mark.parametrize("unit", ["-", "a", " ", "\n", "ab", "=-", "é", "中", "的是", "aab"])
def test_bpe_long_runs_take_little_time(codecs, unit):
    own, lib = codecs
    data = (unit * 100_000).encode()[:100_001]
    began = time.process_time()
    found = own.tree(data)
    assert time.process_time() - began < 2 and found == lib._core_bpe.encode_single_piece(data)
    text = unit * 20_000
    assert own.encode(text) == lib.encode_ordinary(text)


def test_bpe_query_on_all(spark, docs, texts, codecs):
    _, lib = codecs
    found = by_id(bpe.round_trip(docs, MULTI, public_tokenizers.PATTERN))
    for i, t in texts.items():
        ids = lib.encode_ordinary(t)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_bpe_frames_on_odd_rows(odd):
    back = bpe.decode(bpe.encode(odd, MULTI, public_tokenizers.PATTERN), MULTI).collect()
    assert [bytes(r["decoded"]).decode() for r in back] == [r["text"] or "" for r in back]
    assert bpe.round_trip(odd.limit(0), MULTI, public_tokenizers.PATTERN).count() == 0


# --- 4 fingerprints


def brute_fingerprint(text):
    votes, total = [0] * 64, 0
    for w in dict.fromkeys(re.split(r"\s+", text.lower())):
        h, weight = xxhash.xxh64_intdigest(w.encode(), 42), min(15, len(w))
        total += weight
        for b in range(64):
            votes[b] += weight * (h >> b & 1)
    return sum(1 << b for b in range(64) if votes[b] * 2 > total)


def differing(a, b):
    return bin(a ^ b).count("1")


def test_fingerprints_and_next_documents(docs, texts):
    found, order = by_id(fingerprints.edit_likeness(docs)), sorted(texts, reverse=True)
    fp = {i: brute_fingerprint(t) for i, t in texts.items()}
    for k, i in enumerate(order):
        t, after = texts[i], order[(k + 1) % len(order)]
        half = len(t) // 2
        edited = t[: len(t) - half] + texts[after][:half]
        r = found[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (int(r["fingerprint"], 16), int(r["edited_fingerprint"], 16)) == (fp[i], brute_fingerprint(edited))
        assert r["near_next"] == 1 - differing(fp[i], fp[after]) / 64
        assert r["n_near"] == sum(0 < differing(fp[i], x) <= 3 for x in set(fp.values()))
        assert r["near_edited"] == 1 - differing(fp[i], brute_fingerprint(edited)) / 64


def test_long_text_in_parts(spark):
    text = " ".join(f"w{i}" for i in range(3 * fingerprints.PART + 7))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert int(fingerprints.edit_likeness(df).first()["fingerprint"], 16) == brute_fingerprint(text)


def test_fingerprints_on_odd_rows(odd):
    found = fingerprints.edit_likeness(odd).collect()
    assert len(found) == len(ODD)
    assert {r["fingerprint"] for r in found if not r["n_chars"]} == {"0" * 16}
    assert fingerprints.edit_likeness(odd.limit(0)).count() == 0
    assert fingerprints.edit_likeness(odd.filter("doc_id = 1")).first()["near_next"] == 1.0


def test_block_tables_find_all(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    many = base + [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base] + [base[0]]
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in many] + [(None,)]
    df = spark.createDataFrame(signed, "fp long")
    expected = sorted((a, b) for a in set(many) for b in set(many) if differing(a, b) <= 3)
    for hot in (1, 512):  # with 1, every shared key is cut again
        for other in (df, df.select("fp")):
            assert sorted((r["query"] % (1 << 64), r["found"] % (1 << 64)) for r in fingerprints.near(df, other, 3, hot=hot).collect()) == expected
    some = spark.createDataFrame(signed[:5], "fp long")
    assert sorted((r["query"] % (1 << 64), r["found"] % (1 << 64)) for r in fingerprints.near(some, df, 3).collect()) == [x for x in expected if x[0] in many[:5]]
    classes = {r["fp"] % (1 << 64): (r["n_near"], r["near_class"] % (1 << 64)) for r in fingerprints.near_classes(df).collect()}
    values = sorted(set(many), key=lambda x: x - (1 << 64) if x >> 63 else x)
    root = brute_classes(values, 3)
    for k, x in enumerate(values):
        n = sum(a == x for a, _ in expected) - 1
        assert classes.get(x, (0, x)) == (n, values[root[k]])


def test_a_close_family_is_counted_without_its_pairs(spark, monkeypatch):
    """All values within one bit of a centre and many within two: no table that is written has more than a few rows a value."""
    center, rng = 0x0123456789ABCDEF, random.Random(3)
    family = {center} | {center ^ 1 << k for k in range(64)} | {center ^ (1 << a | 1 << b) for a, b in (rng.sample(range(64), 2) for _ in range(900))}
    far = {rng.getrandbits(64) for _ in range(50)}
    chain = {0xF0F0 << 16 | (1 << 3 * i) - 1 for i in range(12)}  # each three bits from the next
    many = sorted(x - (1 << 64) if x >> 63 else x for x in family | far | chain)
    written, staged_ = [], fingerprints.staged
    monkeypatch.setattr(fingerprints, "staged", lambda df, label, **how: written.append((label, staged_(df, label, **how).count())) or staged_(df, label, **how))
    df = spark.createDataFrame([(x,) for x in many for _ in range(2)], "fp long").repartition(7)
    links = {x: [y for y in many if y != x and differing(x % (1 << 64), y % (1 << 64)) <= 3] for x in many}
    root = brute_classes([x % (1 << 64) for x in many], 3)
    expected = {x: (len(links[x]), many[root[i]]) for i, x in enumerate(many) if links[x]}
    for hot in (2, fingerprints.HOT):
        written.clear()
        assert {r["fp"]: (r["n_near"], r["near_class"]) for r in fingerprints.near_classes(df, hot=hot).collect()} == expected
        assert sum(map(len, links.values())) > 100 * len(many) and max(n for label, n in written if label != "keys") <= len(many)
        assert max(n for label, n in written if label == "keys") <= 20 * len(many)


def test_one_id_is_cut_into_ranges(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " + "x" * (i % 11)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashed = df.withColumn("h", F.xxhash64("text")).collect()
    order = sorted(hashed, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))
    found = fingerprints.following(df).collect()
    assert {r["text"]: r["next_text"] for r in found} == {a["text"]: b["text"] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    sizes = sorted(fingerprints.following(df).groupBy("range").count().collect(), key=lambda r: r["count"])
    assert len(found) == 600 and sizes[-1]["count"] < 120


# --- 5 line dedup


def brute_lines(rows, least=10):
    fold = str.maketrans(linededup.UPPER, linededup.LOWER)
    key = lambda line: line.strip(linededup.BLANKS).translate(fold)
    first, last = {}, {}
    at = lambda i: float("inf") if i is None else i
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= least:
                first[k], last[k] = min(first.get(k, float("inf")), at(i)), max(last.get(k, -1), at(i))
    return [(i, [x for x in (t or "").split("\n") if not (key(x) in first and first[key(x)] < last[key(x)] and at(i) > first[key(x)])]) for i, t in rows]


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_line_dedup_by_brute_force(odd, docs, batches):
    some = odd.select("doc_id", "text").unionAll(docs.select(F.col("doc_id") + 100, "text"))
    rows = [(r["doc_id"], r["text"]) for r in some.collect()]
    expected = sorted((str(i), "\n".join(kept)) for i, kept in brute_lines(rows))
    found = linededup.mark(some, batches).collect()
    assert sorted((str(r["doc_id"]), "\n".join(r["kept_lines"])) for r in found) == expected
    assert all(r["n_lines"] - r["n_dropped"] == len(r["kept_lines"]) for r in found)


def test_line_dedup_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    columns = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    found = queries.op5_line_dedup(spark, DATA).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({linededup.DIGEST_SQL})").fetchall())


def test_line_dedup_keeps_columns(odd):
    found = linededup.dedup(odd)
    assert found.columns == odd.columns and found.count() == len(ODD)
    assert all(r["n_chars"] == len(r["text"] or "") for r in found.collect())
    assert linededup.dedup(odd.limit(0)).count() == 0


def test_old_runs_are_neither_exchanged_nor_sorted(spark):
    wide = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with linededup.Runs(spark) as runs:
            for n in (100, 200, 300):
                keys = spark.range(n).selectExpr("xxhash64(id) AS h1", "xxhash64(id, 1) AS h2", "id AS low").groupBy("h1", "h2").agg(F.min("low").alias("low"))
                met = runs.seen(keys)
                plan = met._jdf.queryExecution().executedPlan().toString()
                scans = sum(map(len, runs.levels))
                # the new keys are exchanged once and sorted; the runs are scanned in their order
                assert plan.count("SortMergeJoin") == scans and plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [h1") <= 1
                assert met.filter("seen is not null").count() == (n - 100 if n > 100 else 0)
                runs.add(runs.save(met.selectExpr("h1", "h2", "coalesce(seen, low) AS first", "low AS high", "seen")))
            assert [len(level) for level in runs.levels] == [1, 1]
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("run_")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", wide)


def test_batches_read_their_own_lines(odd):
    found = linededup.verdicts(odd, 4)
    assert found.filter("pos is null").count() == 0 and linededup.edges_of(odd.filter("doc_id is null"), 4) == [(1 << 63) - 1]


# --- 6 and 10 packing


def pattern_of(slots, histogram):
    """Sequences as lists of (offset, length) from a plan."""
    out = {}
    for length, _, n, first, offset in slots.rows:
        for k in range(n):
            out.setdefault(first + k, []).append((offset, length))
    used = np.zeros_like(histogram)
    for held in out.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
            used[length] += 1
        assert at <= len(histogram) - 1
    assert (used == histogram).all()
    return out


@given(st.lists(st.integers(1, 40), max_size=200))
@settings(max_examples=150, deadline=None)
def test_plans_place_everything_once(lengths):
    histogram = np.bincount(lengths, minlength=41)
    for plan in (packing.best_two_fit, packing.best_fit_decreasing):
        n = len(pattern_of(plan(histogram), histogram))
        assert -(-sum(lengths) // 40) <= n <= 2 * (-(-sum(lengths) // 40)) + 1


@given(st.lists(st.integers(1, 30), max_size=120))
@settings(max_examples=100, deadline=None)
def test_best_fit_decreasing_one_by_one(lengths):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(30 - length)
    histogram = np.bincount(lengths, minlength=31)
    found = pattern_of(packing.best_fit_decreasing(histogram), histogram)
    assert sorted(30 - sum(x for _, x in held) for held in found.values()) == sorted(rooms)


def brute_best_two_fit(lengths, capacity):
    left, bins = sorted(lengths), []
    while left:
        held, room = [], capacity
        while fits := [x for x in left if x <= room]:
            left.remove(fits[-1])
            held.append(fits[-1])
            room -= fits[-1]
        if room and len(held) > 1:
            gap = room + min(held)
            pairs = [(left[i] + left[j], -min(left[i], left[j])) for i in range(len(left)) for j in range(i) if left[i] + left[j] <= gap]
            if pairs and max(pairs)[0] > min(held):
                total, first = max(pairs)
                smallest = min(held)
                held.remove(smallest)
                for x in (-first, total + first):
                    held.append(x)
                    left.remove(x)
                left = sorted([*left, smallest])
        bins.append(tuple(sorted(held)))
    return sorted(bins)


@given(st.lists(st.integers(1, 30), max_size=60))
@settings(max_examples=200, deadline=None)
def test_best_two_fit_one_by_one(lengths):
    found = pattern_of(packing.best_two_fit(np.bincount(lengths, minlength=31)), np.bincount(lengths, minlength=31))
    assert sorted(tuple(sorted(x for _, x in held)) for held in found.values()) == brute_best_two_fit(lengths, 30)


def test_encoder_equals_tokenizers(texts):
    from tokenizers import Tokenizer

    lib, own = Tokenizer.from_file(JSON), packing.encoder(JSON)
    for t in [*list(texts.values())[:60], "a <|endoftext|> b", "", "\x00 ÿ 中文 😀"]:
        assert own(t).tolist() == lib.encode(t, add_special_tokens=False).ids


def check_pieces(found, ids):
    at, places = {}, {}
    for r in sorted(found, key=lambda r: r["piece"]):
        assert r["start"] == at.get(r["doc_id"], 0) and (r["piece"] == 0 or r["length"] == 2048)
        at[r["doc_id"]] = r["start"] + r["length"]
        part = np.array(ids[r["doc_id"]][r["start"] : at[r["doc_id"]]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert at == {i: len(x) for i, x in ids.items()}
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 2048
    return len(places)


def test_packing_is_whole_and_tight(docs, texts):
    encode = packing.encoder(JSON)
    ids = {i: [*encode(t).tolist(), 0] for i, t in texts.items()}
    n = check_pieces(packing.packed_pieces(docs, JSON).collect(), ids)
    least = -(-sum(map(len, ids.values())) // 2048)
    assert n <= least * 1.02 + 1


def test_matrices_hold_the_ids(docs, texts):
    encode = packing.encoder(JSON)
    back = {}
    for r in packing.matrices(docs, JSON).collect():
        row, positions, ends = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["positions"], "<u4"), r["cu_seqlens"]
        assert len(row) == 2048 and ends[0] == 0 and ends[-1] == r["n_tokens"] and len(ends) == r["n_segments"] + 1
        for i, piece, a, b in zip(r["doc_ids"], r["pieces"], ends, ends[1:], strict=False):
            back[i, piece] = row[a:b].tolist()
            assert positions[a:b].tolist() == list(range(b - a))
        assert not row[r["n_tokens"] :].any()
    for i, t in texts.items():
        n = max(p for d, p in back if d == i)
        assert [x for p in range(n + 1) for x in back[i, p]] == [*encode(t).tolist(), 0]


def test_matrices_are_packed_by_one_plan(docs):
    found = packing.matrices(docs.repartition(40), JSON).collect()
    histogram = np.bincount([r["length"] for r in packing.pieces(docs, JSON).select("length").collect()], minlength=2049)
    full, histogram[2048] = int(histogram[2048]), 0
    assert len(found) == packing.best_fit_decreasing(histogram).sequences + full == len({r["sequence_id"] for r in found})
    assert {"ids", "positions"} <= set(queries.op10_token_matrices(docs.sparkSession, DATA).columns)


def test_one_length_is_ranked_in_many_parts(spark, docs):
    same = docs.select("doc_id", F.lit("one two three").alias("text"))
    found = packing.staged(packing.pieces(same, JSON), "pieces")
    part, full = packing.placed(found, packing.best_two_fit, ranked=7)
    places = [(r["sequence_id"], r["offset"]) for r in part.collect()]
    assert len(places) == len(set(places)) == same.count() and full.count() == 0


def test_written_matrices_are_read_back(spark, docs, tmp_path):
    import pyarrow.dataset

    packing.write_matrices(packing.matrices(docs, JSON), str(tmp_path / "m"))
    read = [(packing.as_matrix(b), packing.as_matrix(b, "positions"), b["n_tokens"].to_pylist()) for b in pyarrow.dataset.dataset(str(tmp_path / "m")).to_batches() if b.num_rows]
    assert sum(sum(n) for *_, n in read) == packing.pieces(docs, JSON).agg(F.sum("length")).first()[0]
    assert all(ids.shape == positions.shape == (len(n), 2048) and (positions[:, 0] == 0).all() for ids, positions, n in read)


def test_packing_on_odd_rows(odd):
    assert packing.packed_pieces(odd, JSON).filter("piece = 0").count() == len(ODD)
    assert packing.matrices(odd, JSON).agg(F.sum("n_segments")).first()[0] == packing.packed_pieces(odd, JSON).count()
    assert packing.packed_pieces(odd.limit(0), JSON).count() == packing.matrices(odd.limit(0), JSON).count() == 0


# --- 7 quality


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(0)
    x = rng.random((1500, 4))
    y = ((x[:, 0] > 0.6) ^ (x[:, 2] < 0.3)).astype(float)
    trees = quality.boost(x[:1000], y[:1000])
    assert ((trees.probability(x[1000:]) > 0.5) == y[1000:]).mean() > 0.97


def test_flat_traversal_equals_walking():
    rng = np.random.default_rng(1)
    x = rng.random((300, 3))
    trees = quality.boost(x, (x[:, 1] > 0.5).astype(float), trees=5)

    def walk(row):
        total = trees.start
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] + (row[trees.feature[node]] > trees.threshold[node])
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.probability(x), [walk(r) for r in x])


def test_quality_held_out(spark):
    found = by_id(queries.op7_quality_classifier(spark, "/root/testdata/sf0.01"))
    labels = {r["doc_id"]: r["quality"] for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    held = [i for i in labels if i in found and found[i]["held_out"]]
    assert np.mean([found[i]["predicted"] == labels[i] for i in held]) > 0.95


def test_quality_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (None, 1), (3, None), (5, 0)], "doc_id long, quality int")
    assert quality.scored_documents(odd, labels).count() == len(ODD)
    assert quality.scored_documents(odd.limit(0), labels.limit(0)).count() == 0


# --- 8 media columns


@given(st.binary(max_size=2000))
@settings(max_examples=150, deadline=None)
def test_png_round_trip(data):
    pixels = media.payload_of(data)
    image = media.write_png(pixels)
    assert (media.read_png(image) == pixels).all() and pixels.tobytes().startswith(data)


@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.integers(0, 1 << 30))
@settings(max_examples=60, deadline=None)
def test_all_filters_are_undone(kinds, seed):
    pixels = np.random.default_rng(seed).integers(0, 256, (len(kinds), 9)).astype(np.int64)
    raw = np.zeros((len(kinds), 10), np.uint8)
    for y, kind in enumerate(kinds):
        raw[y, 0] = kind
        for x in range(9):
            a, b = (pixels[y, x - 1] if x else 0), (pixels[y - 1, x] if y else 0)
            c = pixels[y - 1, x - 1] if x and y else 0
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            raw[y, x + 1] = (pixels[y, x] - [0, a, b, (a + b) // 2, paeth][kind]) % 256
    assert (media.unfilter(raw) == pixels).all()


def test_damage_is_noticed():
    image = bytearray(media.write_png(media.payload_of(b"hello world" * 30)))
    image[50] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        media.read_png(bytes(image))
    whole = media.write_png(media.payload_of(b"hello"))
    for cut in (0, 9, 20, 40, len(whole) - 1):
        with pytest.raises(ValueError):
            media.read_png(whole[:cut])
    with pytest.raises(ValueError):
        media.read_png(b"no image")


def brute_cosine_hash(pixels):
    def bounds(m):
        return [k * m // 32 for k in range(33)] if m >= 32 else None

    def mean_down(rows):
        cuts = bounds(len(rows))
        return [rows[k * len(rows) // 32] if cuts is None else [sum(r[x] for r in rows[cuts[k] : cuts[k + 1]]) / (cuts[k + 1] - cuts[k]) for x in range(len(rows[0]))] for k in range(32)]

    small = mean_down([list(map(float, r)) for r in pixels])
    small = list(zip(*mean_down(list(zip(*small, strict=True))), strict=True))
    cosine = [[np.cos(np.pi * u * (2 * x + 1) / 64) for x in range(32)] for u in range(8)]
    low = [round(sum(small[y][x] * cosine[v][y] * cosine[u][x] for y in range(32) for x in range(32)), 6) for v in range(8) for u in range(8)]
    middle = sorted(low[1:])[31]
    return sum((x > middle) << 63 - i for i, x in enumerate(low)), low, middle


def test_cosine_hash_by_brute_force():
    rng = np.random.default_rng(3)
    for rows in (1, 5, 32, 70):
        pixels = rng.integers(0, 256, (rows, 64), dtype=np.uint8)
        bits, low, middle = brute_cosine_hash(pixels.tolist())
        found = int(media.cosine_hash(pixels), 16)
        sure = [i for i, x in enumerate(low) if x == middle or abs(x - middle) > 1e-4]
        assert len(sure) > 60 and all((found >> 63 - i & 1) == (bits >> 63 - i & 1) for i in sure)


def test_media_digests(spark, docs, texts):
    found = by_id(queries.op8_media_columns(spark, DATA))
    stored = by_id(media.store(docs.select("doc_id", "text"), "text"))
    assert set(found) == set(texts)
    for i, t in texts.items():
        data = t.encode()
        payload = data + b"\0" * (max(64, -(-len(data) // 64) * 64) - len(data))
        r, image = found[i], bytes(stored[i]["media"])
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"]) == (len(data), len(payload), len(image))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-64:])
        assert r["media_sha256"] == hashlib.sha256(image).hexdigest() and media.read_png(image).tobytes() == payload


def test_media_on_odd_rows(odd):
    found = media.document_media(odd).collect()
    assert len(found) == len(ODD) and all(r["payload_bytes"] == max(1, -(-r["n_bytes"] // 64)) * 64 for r in found)
    assert len({r["media_sha256"] for r in found if not r["n_bytes"]}) == 1
    assert media.document_media(odd.limit(0)).count() == 0


# --- 9 SimHash near-dedup


def brute_simhash(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + n]).encode(), 42) for k in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aB é\n\t中", max_size=80))
@settings(max_examples=150, deadline=None)
def test_simhash_by_brute_force(text):
    assert simhash.fingerprint(text) == brute_simhash(text)


def brute_classes(fps, radius=4):
    """Smallest index of each component."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if differing(fps[i], fps[j]) <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("stripe", [4, 4096])
def test_links_connect_what_is_near(spark, odd, stripe):
    rng = random.Random(7)
    fps = [rng.getrandbits(64) for _ in range(25)]
    for _ in range(120):  # chains of near copies
        fps.append(rng.choice(fps) ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 6))))
    fps = list(dict.fromkeys(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    labels = {r["node"]: r["label"] for r in simhash.components(simhash.links(df, 4, stripe)).collect()}
    named = [labels.get(x, x) for x in signed]
    expected = brute_classes(fps)
    assert len(set(zip(named, expected, strict=True))) == len(set(named)) == len(set(expected))


def test_tiles_skip_nothing():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 1 << 63, 700, dtype=np.uint64))
    b = a[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    x, y = simhash.compare(a, b, 1, tile=16)
    assert {k + len(a) for k, v in enumerate(b.tolist()) if v not in set(a.tolist())} <= set(x.tolist()) | set(y.tolist())


def test_near_copies_by_similarity(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rng.choices(vocabulary, k=400) for _ in range(40)]
    rows, similar, other = [], {}, {}
    for i, words in enumerate(base):
        rows.append((i, " ".join(words)))
        for into, changes, at in ((similar, 5, 100), (other, 40, 200)):  # similarities of about 0.88 and 0.45
            copy = list(words)
            for k in rng.sample(range(400), changes):
                copy[k] = rng.choice(vocabulary)
            rows.append((at + i, " ".join(copy)))
            into[at + i] = i
    kept = {r["doc_id"] for r in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {*range(40), *other}


def test_first_word_is_the_fingerprint():
    for t in ("", "one", "a b c d e f g", "x " * 500):
        words = np.frombuffer(simhash.wide_fingerprint(t), "<u8")
        assert len(words) == simhash.WIDE and int(words[0]) == simhash.fingerprint(t)


def test_components_of_documents(docs, texts):
    found = by_id(simhash.document_components(docs))
    order = sorted(texts)
    fps = [brute_simhash(texts[i]) for i in order]
    assert [int(found[i]["fingerprint"], 16) for i in order] == fps
    assert [found[i]["component_id"] for i in order] == [order[k] for k in brute_classes(fps)]


def test_near_dedup_on_odd_rows(odd):
    found = simhash.document_components(odd)
    assert found.count() == len(ODD)
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns
    assert kept.filter("doc_id = 5").count() == 1 and kept.filter("coalesce(text, '') = ''").count() == 1
    assert simhash.near_dedup(odd.limit(0)).count() == simhash.document_components(odd.limit(0)).count() == 0


@pytest.mark.parametrize("wide_radius", [None, simhash.WIDE_RADIUS])
def test_near_dedup_keeps_different_texts_of_one_id(spark, wide_radius):
    rows = [(i, " ".join(f"{name}{k}" for k in range(60))) for i, name in ((None, "a"), (None, "b"), (None, "c"), (7, "d"), (7, "e"), (8, "f"))]
    kept = simhash.near_dedup(spark.createDataFrame([*rows, rows[0], rows[3]], "doc_id long, text string"), wide_radius=wide_radius, radius=4 if wide_radius is None else simhash.FIRST_RADIUS)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(rows, key=str)


def test_near_copies_at_the_limit(spark):
    rng = random.Random(3)
    rows, kept = [], []
    for i in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(404)]
        # the last k words are in k of 400 shingles: similarities of 356 / 444 and 355 / 445
        for at, k, stays in ((0, 0, True), (100, 44, False), (200, 45, True)):
            rows.append((at + i, " ".join(words[: 404 - k] + [f"v{at + i}x{j}" for j in range(k)])))
            kept += [at + i] if stays else []
    zeros = "0 " * 600
    for i in (300, 301):  # one shingle is most of both
        rows.append((i, zeros + " ".join(f"z{i}x{j}" for j in range(80))))
        kept.append(i)
    words = " ".join(f"y{j}" for j in range(200))  # the same shingles, repeated in one
    rows += [(400, "1 1 1 1 1 1 " + words), (401, "1 " * 900 + words)]
    kept.append(400)
    found = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(kept)


@pytest.mark.parametrize("block", [3, 64])
def test_similar_sets_by_brute_force(spark, block):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[: 60 - rng.randrange(20)] + [f"v{rng.randrange(40)}" for _ in range(rng.randrange(30))]) for _ in range(60)]
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, row_hash long, text string")
    groups = spark.createDataFrame([(i, 0) for i in range(60)], "member long, label long")
    links = simhash.similar_links(docs, docs.selectExpr("id", "row_hash", "id as node"), groups, 5, block)
    found = {r["node"]: r["label"] for r in simhash.components(links).collect()}
    label = list(range(60))
    for i in range(60):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert [found.get(i, i) for i in range(60)] == label and len(set(label)) > 1


@pytest.mark.parametrize("block", [5, 16])
def test_a_family_of_near_copies_costs_its_sets(spark, block):
    """A third of all sets is one family; no set of it is sent but to its block and to the few stripes of the sets outside."""
    rng = random.Random(11)
    base, rest = [f"w{i}" for i in range(120)], []
    texts = [" ".join(f"v{i}x{j}" if j == i % 120 else w for j, w in enumerate(base)) for i in range(100)]
    for i in range(12):  # near a member of the family, near one another, or alone
        rest.append(" ".join(w if j < 108 + i % 7 else f"u{i // 2}x{j}" for j, w in enumerate(base)))
    texts += rest + [" ".join(f"z{rng.randrange(9999)}" for _ in range(50)) for _ in range(8)]
    sets = [np.unique(simhash.shingle_hashes(t, 5)) for t in texts]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, row_hash long, text string")
    groups = spark.createDataFrame([(i, 0) for i in range(len(texts))], "member long, label long")
    links = simhash.similar_links(docs, docs.selectExpr("id", "row_hash", "id as node"), groups, 5, block)
    found = {r["node"]: r["label"] for r in simhash.components(links).collect()}
    want = simhash.Forest(len(texts))
    whole = [set(s.tolist()) for s in sets]
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(whole[i] & whole[j]) >= 4 * len(whole[i] | whole[j]):
                want.link(np.array([i]), np.array([j]))
    assert [found.get(i, i) for i in range(len(texts))] == want.root.tolist()
    rows = [(0, i, s.tobytes(), len(s), int(want.root[i])) for i, s in enumerate(sets)]
    sent = simhash.striped(spark.createDataFrame(rows, "label long, node long, hashes binary, size long, cluster long"), block)
    family = int(np.bincount(want.root).argmax())
    times = {r["node"]: r["count"] for r in sent.groupBy("node").count().collect()}
    outside = sum(x != family for x in want.root)
    assert 0 < outside <= 20 and max(n for i, n in times.items() if want.root[i] == family) <= 1 + (outside / block) ** 0.5
    assert simhash.compared(sent).isEmpty()  # nothing was left apart
    assert simhash.striped(spark.createDataFrame([r for r in rows if r[4] == family], sent.sparkSession.createDataFrame(rows[:1], "label long, node long, hashes binary, size long, cluster long").schema), block).isEmpty()
