"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers read a clause as a string of word classes: insult, threat,
target, negation and reported speech. Each maps (state, class) to (state, factor,
emission) and gives a factor to the clause by the state it ends in; their composition is
one table over the product states. What scores is the matched clause:

* an insult that is used: not one that the clause only mentions ("the word idiot",
  "idiot is a noun"), denies or reports; a repeat within the clause adds nothing;
* more, if somebody is named in the same clause, before or after (it is aimed);
* a verb of threat with somebody named after it, neither denied nor reported.

A document scores 1 - 2**-(sum of its clauses / half), where half is the sum that parts
labelled toxic from clean rows with the fewest errors, each row scored without what its
own counts add to the lexicon; a threat weighs as much as half.

The insult transducer's lexicon is learned: word beginnings of four to seven letters
and whole words whose document counts differ between labelled toxic and clean rows
(likelihood ratio beyond what chance gives the best of so many candidates), so inflected
forms of a learned stem match as well. It has no limit but that of the labelled rows.

Null and empty texts score 0, and so does everything without labels of both kinds but
threats. Very long texts are read whole, in time in proportion to their length. Equal
texts and repeated rows score alike. An empty table gives no rows. Column names other
than ``doc_id`` and ``text`` are never read; a column named as the score is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.llm.common import TRAIN_ROWS, fold, staged, training_rows, whole, wider

#: Least log odds of a lexicon entry, and the fewest toxic documents that hold it.
LEAST_ODDS, LEAST_TOXIC = 2.5, 3
#: Higher least odds that are tried; the one with the fewest errors on the labelled rows is taken, the highest of equals.
ODDS_CUTS = (2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 6.0)
#: Share of an entry's toxic documents that one longer entry may have; beyond it the longer one alone stays.
EXPLAINED = 0.8
#: Different entries that one worker counts before it passes them on.
COUNTED = 100_000
#: Words whose class one worker remembers.
REMEMBERED = 50_000

# Word classes.
NEUTRAL, INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK, QUOTE, MENTION = range(9)
CLASSES = 9

# Closed word classes of the grammar in English, German, French and Spanish.
TARGETS = "you your yourself he she they him her them people everyone du dich ihr euch sie tu te vous toi ils usted ustedes ellos"
NEGATIONS = "not no never nobody isn't aren't wasn't don't doesn't won't nicht kein keine nie niemals pas jamais aucun nunca jamás ningún"
REPORTS = "said says claimed quoted wrote reported called sagte schrieb behauptete disait écrit dijo escribió"
MENTIONS = "word words term noun adjective spelled spelling wort begriff mot terme palabra término"
#: Stems of threats and the endings of what is yet to come; past tenses tell, they do not threaten.
THREATS = (
    ("kill murder hurt stab shoot destroy", " s ing"),
    ("strangl", "e es ing"),
    ("töt ermord erwürg erstech erschieß", "e en est et t"),
    ("tu assassin étrangl", "e er es erai eras"),
    ("mat asesin estrangul", "o ar as a aré arás"),
)

#: What words outside the lexicon are, by class; shared by all of them.
PLAIN = [(c, 1.0) for c in range(CLASSES)]
TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[.!?;\n]|[\"“”«»]")
WORD = re.compile(r"[^\W_]{3,}")
STEMS = (4, 5, 6, 7)


def keys_of(word: str) -> list[str]:
    """The lexicon keys of a lower-case word: its beginnings, then the word itself with an end mark."""
    return [word[:n] for n in STEMS if len(word) > n] + [word + "$"]


class Machine(NamedTuple):
    """A transducer over word classes that starts in state 0.

    ``step(state, class)`` gives the next state, a factor on what all machines emit at this word, and the machine's own
    emission, which the word's weight multiplies; ``final(state)`` gives the factor on the clause that ends there.
    """

    states: int
    step: Callable[[int, int], tuple[int, float, float]]
    final: Callable[[int], float] = lambda s: 1.0


def insult_machine(before: int = 2, after: int = 3) -> Machine:
    """Insults emit, but not within ``before`` words after a word of mention; a word of mention within ``after`` words behind one voids the clause."""
    void = before + after + 1

    def step(s, c):
        if s == void:
            return void, 1.0, 0.0
        if c == MENTION:
            return (void if s > before else before), 1.0, 0.0
        if c == INSULT and not 0 < s <= before:
            return before + after, 1.0, 1.0
        return (s - 1 if s not in (0, before + 1) else 0), 1.0, 0.0

    return Machine(void + 1, step, lambda s: float(s != void))


def threat_machine(weight: float = 1.0) -> Machine:
    """A threatening verb emits when a target follows within the clause."""
    return Machine(2, lambda s, c: (0, 1.0, weight) if s and c == TARGET else (int(s or c == THREAT), 1.0, 0.0))


def target_machine(factor: float = 1.5) -> Machine:
    """A clause that names somebody weighs half as much again."""
    return Machine(2, lambda s, c: (int(s or c == TARGET), 1.0, 0.0), lambda s: factor if s else 1.0)


def negation_machine(span: int = 3) -> Machine:
    """A negation silences the next ``span`` words."""
    return Machine(span + 1, lambda s, c: (span if c == NEGATION else max(0, s - 1), 0.0 if s else 1.0, 0.0))


def report_machine() -> Machine:
    """After a verb of speech or an opening quote nothing is emitted until the quote or clause ends."""

    def step(s, c):
        if c == QUOTE:
            return 0 if s == 2 else 2, 1.0, 0.0
        return (1 if c == REPORT and not s else s), 0.0 if s else 1.0, 0.0

    return Machine(3, step)


class Table(NamedTuple):
    """A composed transducer: next state, and factor times emission, by state and class; the clause's factor by state."""

    nexts: list[list[int]]
    emitted: list[list[float]]
    finals: list[float]


def compose(machines: Sequence[Machine]) -> Table:
    """The machines side by side: factors multiply, emissions add up."""
    states = list(product(*(range(m.states) for m in machines)))
    number = {s: i for i, s in enumerate(states)}
    moves = [[[m.step(s, c) for s, m in zip(state, machines, strict=True)] for c in range(CLASSES)] for state in states]
    return Table(
        [[number[tuple(x[0] for x in found)] for found in row] for row in moves],
        [[math.prod(x[1] for x in found) * sum(x[2] for x in found) for found in row] for row in moves],
        [math.prod(m.final(s) for s, m in zip(state, machines, strict=True)) for state in states],
    )


class Words(dict):
    """Word -> (class, weight), filled on demand and emptied when it holds ``most`` words."""

    def __init__(self, lexicon: dict[str, float], most: int = REMEMBERED):
        super().__init__()
        self.lexicon, self.most = lexicon, most
        self.closed = {w: c for text, c in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (MENTIONS, MENTION)) for w in text.split()}
        self.closed |= {stem + ending: THREAT for stems, endings in THREATS for stem in stems.split() for ending in endings.split(" ")}

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= self.most:
            self.clear()
        if word in ".!?;\n":
            found = (BREAK, 0.0)
        elif word in '"“”«»':
            found = (QUOTE, 0.0)
        else:
            weight = max((self.lexicon[k] for k in keys_of(word) if k in self.lexicon), default=0.0)
            found = (INSULT, weight) if weight else PLAIN[self.closed.get(word, NEUTRAL)]
        self[word] = found
        return found


class Grammar:
    """The composed transducer with a lexicon; small and picklable. ``half`` is the sum of clauses that scores 0.5, which one threat weighs."""

    def __init__(self, lexicon: dict[str, float], half: float = LEAST_ODDS):
        self.lexicon, self.half = lexicon, half

    def machines(self) -> list[Machine]:
        return [insult_machine(), threat_machine(self.half), target_machine(), negation_machine(), report_machine()]

    def scorer(self, machines: Sequence[Machine] | None = None) -> Callable[[str], float]:
        total, half = self.summer(machines=machines), self.half
        return lambda text: 1.0 - 2.0 ** (-total(text)[0] / half)

    def summer(self, cuts: tuple[float, ...] = (0.0,), machines: Sequence[Machine] | None = None) -> Callable[[str], list[float]]:
        """A function from a text to the sums of its clauses' scores, one for each least odds of the lexicon's entries."""
        nexts, emitted, finals = compose(self.machines() if machines is None else machines)
        words = Words(self.lexicon)
        look = words.__getitem__

        def clauses(tokens: list[str], found: list[tuple[int, float]]) -> float:
            state, total, clause, seen = 0, 0.0, 0.0, set()
            for word, (c, weight) in zip(tokens, found, strict=True):
                if c == BREAK:
                    if clause:
                        total += clause * finals[state]
                    state, clause = 0, 0.0
                    seen.clear()
                    continue
                if c == INSULT:
                    if word in seen:
                        c = NEUTRAL
                    seen.add(word)
                clause += emitted[state][c] * weight
                state = nexts[state][c]
            return total + clause * finals[state]

        def sums(text: str) -> list[float]:
            tokens = TOKEN.findall(text.lower())
            found = list(map(look, tokens))
            live = {c for c, _ in set(found)}
            if INSULT not in live and THREAT not in live:
                return [0.0] * len(cuts)
            out = []
            for cut in cuts:
                if cut:  # entries below the cut are read as if the lexicon did not have them
                    found = [PLAIN[words.closed.get(t, NEUTRAL)] if c == INSULT and weight < cut else (c, weight) for t, (c, weight) in zip(tokens, found, strict=True)]
                out.append(clauses(tokens, found))
            return out

        return sums


def fit(training: DataFrame) -> Grammar:
    """Learn the lexicon from (text, label) rows, which are read twice; counts are made in tasks and summed by key."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out():
            keys = list({**counts[0], **counts[1]})
            return pa.RecordBatch.from_pydict({"key": keys, "clean": [counts[0][k] for k in keys], "toxic": [counts[1][k] for k in keys]}, schema)

        schema = pa.schema([("key", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())])
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                counts[label > 0].update({k for w in set(WORD.findall(text.lower())) for k in keys_of(w)})
                if len(counts[0]) + len(counts[1]) > COUNTED:
                    yield out()
                    counts = (Counter(), Counter())
        yield out()

    sizes = {bool(r["toxic"]): r["count"] for r in training.groupBy((F.col("label") > 0).alias("toxic")).count().collect()}
    n_clean, n_toxic = sizes.get(False, 0), sizes.get(True, 0)
    if not n_clean or not n_toxic:
        return Grammar({})
    sums = training.mapInArrow(count, "key string, clean long, toxic long").groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    part = lambda c, n: F.coalesce(F.col(c) * F.log(F.nullif(F.col(c), F.lit(0)) / (n * share)), F.lit(0.0))
    tried = staged(sums.filter(F.col("toxic") >= LEAST_TOXIC), "candidates")
    # what the best of so many entries without meaning would reach: the tail of the ratio falls as exp(-ratio / 2)
    least = 2 * math.log(max(1, tried.count()))
    kept = tried.withColumn("ratio", 2 * (part("toxic", n_toxic) + part("clean", n_clean))).filter((F.col("ratio") >= least) & (share * n_toxic < F.col("toxic")))

    def odds(toxic: int, clean: int) -> float:
        return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))

    scored = [r for r in kept.collect() if odds(r["toxic"], r["clean"]) >= LEAST_ODDS]
    # a beginning that owes its count to one longer entry says nothing of its own
    explained: dict[str, int] = {}
    for key, _, toxic, _ in scored:
        for n in range(STEMS[0], len(key)):
            explained[key[:n]] = max(explained.get(key[:n], 0), toxic)
    counts = {key: (toxic, clean) for key, clean, toxic, _ in scored if explained.get(key, 0) < EXPLAINED * toxic}
    lexicon = {key: odds(*n) for key, n in counts.items()}
    # a labelled row is read with a lexicon that was learned without it
    without = (
        Grammar({key: odds(toxic, max(0, clean - 1)) for key, (toxic, clean) in counts.items()}),
        Grammar({key: odds(toxic - 1, clean) for key, (toxic, clean) in counts.items() if toxic > LEAST_TOXIC}),
    )
    insults = [insult_machine(), threat_machine(0.0), target_machine(), negation_machine(), report_machine()]  # threats are not learned

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [grammar.summer(ODDS_CUTS, insults) for grammar in without]
        for batch in batches:
            totals = [sums[label > 0](t) for t, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(totals, pa.list_(pa.float64())), batch["label"]], ["totals", "label"])

    rows = training.mapInArrow(add_up, "totals array<double>, label int").collect()
    totals, labels = np.array([r[0] for r in rows]).reshape(len(rows), len(ODDS_CUTS)), np.array([r[1] > 0 for r in rows])
    cuts = [best_cut(totals[:, k], labels) for k in range(len(ODDS_CUTS))]
    best = min(range(len(ODDS_CUTS)), key=lambda k: (cuts[k][0], -k))
    return Grammar({key: odds for key, odds in lexicon.items() if odds >= ODDS_CUTS[best]}, cuts[best][1])


def best_cut(totals: np.ndarray, labels: np.ndarray) -> tuple[int, float]:
    """(errors, cut) of the sum that parts toxic (from it on) from clean rows best; above all sums if none does."""
    order = np.argsort(totals, kind="stable")
    totals, labels = totals[order], labels[order]
    cuts = np.unique(totals[totals > 0])
    if not len(cuts):
        return int(labels.sum()), LEAST_ODDS
    at = np.searchsorted(totals, cuts)
    errors = np.r_[0, np.cumsum(labels)][at] + (~labels).sum() - np.r_[0, np.cumsum(~labels)][at]
    k = int(errors.argmin())
    below = totals[at[k] - 1] if at[k] else 0.0
    return int(errors[k]), float((max(below, cuts[k] / 2) + cuts[k]) / 2)


def score(docs: DataFrame, grammar: Grammar, into: str = "score") -> DataFrame:
    """All columns of ``docs`` kept in place, with ``into`` (0 to 1) added; a column of that name is replaced."""
    kept = docs.drop(into)
    schema = wider(kept, f"`{into}` double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = grammar.scorer()
        for batch in batches:
            scores = pa.array([one(t) if t else 0.0 for t in batch["text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, into])

    return kept.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Grammar:
    """The grammar learned from ``labels.toxic`` of the training folds (remainder of crc32 by 5 is not 0)."""
    return fit(staged(training_rows(docs, labels, "toxic", fold("doc_id", 5) != 0, limit), "sample"))


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    narrow = docs.select("doc_id", whole().alias("text"))
    found = score(narrow, learn(docs, labels))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
