"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, threat, intent, target, negation, reported speech, clause end, other. Five transducers are composed
into one machine that reads a text once: what a negation governs, what a verb of speech or a quotation governs, what is aimed at
a target in its clause, which insults are strung together or pursued, which threats are meant. A target may stand behind the word
it is meant for, so a sixth machine reads the text from its end and marks the words with a target ahead. Each match is an arc
with a weight; a text's score is the weight of its path. A lone insult that is aimed at nobody and never taken up again takes no
weighted arc, and so scores like an empty text; threats count without insults.

What is learnt comes from a bounded sample of labelled rows: the insult vocabulary (words and word beginnings that stand out in
toxic texts, or that only toxic texts repeat) and the weights of the arcs. Targets, intents, negations and verbs of speech are
closed classes and stay as they are listed.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.samples import labelled, remainder
from tidemark.llm.shared import slices, texts

FOLDS, HELD_OUT = 3, 1
#: Labelled rows of each class that are learnt from, and the size of the learnt vocabulary: bounds, whatever the corpus.
SAMPLE, VOCABULARY = 8_000, 2_000
#: A learnt word stands (or is repeated) in at least ``LEAST`` toxic texts, and in that ``SHARE`` of them (rarer words stand out by
#: chance), and is that much likelier there (log-likelihood ratio, log odds).
LEAST, SHARE, EVIDENCE, ODDS = 4, 0.02, 18.0, 3.5
BEGINNINGS = (4, 5, 6, 7)
#: Log odds at which a word counts once; a listed insult counts once.
UNIT, MOST = 4.0, 8.0
#: Clauses within which an insult is pursued, and resumed.
NEAR, FAR = 4, 24
#: Terms a task keeps at once while counting.
TERMS = 100_000
THRESHOLD = 0.7

# Fixed word lists (English, German, French, Spanish).
INSULTS = "idiot moron stupid loser pathetic scum worthless trash clown disgusting imbecile dumb fool bastard vermin " \
          "dummkopf arschloch trottel abschaum connard abruti ordure crétin imbécil estúpido basura escoria".split()
THREATS = "kill murder shoot stab strangle hurt destroy töten umbringen erschießen tuer égorger abattre matar apuñalar disparar".split()
INTENTS = "will gonna should must deserve deserves werde wirst sollte vais vas devrait voy vas debería".split()
TARGETS = "you your yours u they them du dich dir ihr euch tu toi vous ils tú ti usted ustedes ellos".split()
NEGATIONS = "not never no nobody isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais aucun nunca jamás".split()
REPORTS = "said says say called calls quoted wrote claimed sagte sagt nannte dit disait appelé dijo dice llamó".split()

_WORD = re.compile(r"[^\W_]+(?:['’][^\W\d_]+)?|[.!?;:\n]|[\"«»„“”]")
END, QUOTE, OTHER = "end", "quote", "other"
_BASES = ("insult", "threat")
#: Arcs that carry a weight.
KINDS = [
    "targeted insult", "strung insult", "pursued insult", "resumed insult", "negated insult", "reported insult",
    "targeted threat", "intended threat", "negated threat", "reported threat",
]


# The grammar ------------------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer: ``step(state, symbol)`` gives the next state and the symbol handed on."""

    start: object
    step: object

    def then(self, other: Transducer) -> Transducer:
        """Composition: what this one hands on is what the other reads."""

        def step(state, symbol):
            a, passed = self.step(state[0], symbol)
            b, out = other.step(state[1], passed)
            return (a, b), out

        return Transducer((self.start, other.start), step)

    def table(self, symbols) -> dict:
        """All reachable transitions, so that running needs look-ups only."""
        found, open_ = {}, [self.start]
        seen = {self.start}
        while open_:
            state = open_.pop()
            for s in symbols:
                after, out = found[state, s] = self.step(state, s)
                if after not in seen:
                    seen.add(after)
                    open_.append(after)
        return found


def _ahead(target: bool, symbol: str):
    """Read from the end: an insult or threat with a target behind it in its clause is marked."""
    if symbol == END:
        return False, symbol
    if symbol == "target":
        return True, symbol
    return target, f"{symbol} at" if target and symbol in _BASES else symbol


def _negated(left: int, symbol: str):
    """A negation governs the next three words of its clause."""
    if symbol == "negation":
        return 3, OTHER
    if symbol in (END, QUOTE):
        return 0, symbol
    base = symbol.removesuffix(" at")
    if left and base in _BASES:
        return left - 1, f"negated {base}"
    return max(left - 1, 0), symbol


def _reported(state: tuple[bool, bool], symbol: str):
    """A verb of speech governs its clause and the quotation that follows; quotation marks alone govern nothing."""
    spoke, quoted = state
    if symbol == "report":
        return (True, quoted), OTHER
    if symbol == QUOTE:
        return (spoke, spoke and not quoted), OTHER
    if symbol == END:
        return (quoted, quoted), END
    base = symbol.removesuffix(" at")
    if (spoke or quoted) and base in _BASES:
        return state, f"reported {base}"
    return state, symbol


def _aimed(target: bool, symbol: str):
    """An insult or threat in the clause of a target is aimed at it, on whichever side the target stands."""
    if symbol == END:
        return False, END
    if symbol == "target":
        return True, OTHER
    base = symbol.removesuffix(" at")
    if base in _BASES:
        return target, f"targeted {base}" if target or symbol != base else base
    return target, symbol


def _insulting(state: tuple[bool, int], symbol: str):
    """An insult that is not aimed counts if its clause strings it to another, or if it takes up one of the clauses before.

    The machine remembers for ``FAR`` clauses that it has met an insult: a word that recurs a page later is not taken up.
    """
    here, since = state
    if symbol == END:
        return (False, 1 if here else min(since + 1, FAR + 1) if since else 0), END
    if symbol == "targeted insult":
        return (True, since), symbol
    if symbol == "insult":
        taken_up = "" if not 0 < since <= FAR else "pursued insult" if since <= NEAR else "resumed insult"
        return (True, since), "strung insult" if here else taken_up
    return state, symbol


def _threatening(intent: bool, symbol: str):
    """A threat that is not aimed needs an intent in its clause."""
    if symbol == END:
        return False, ""
    if symbol == "intent":
        return True, ""
    if symbol == "threat":
        return intent, "intended threat" if intent else ""
    return intent, symbol if symbol in KINDS else ""


SYMBOLS = [*_BASES, "intent", "target", "negation", "report", END, QUOTE, OTHER]
#: The machines by name, in the order they are composed.
MACHINES = {
    "negation": Transducer(0, _negated), "report": Transducer((False, False), _reported), "target": Transducer(False, _aimed),
    "insult": Transducer((False, 0), _insulting), "threat": Transducer(False, _threatening),
}


@dataclass(frozen=True)
class Grammar:
    """The composed machine and the one that reads from the end, as tables."""

    start: object
    table: dict
    ahead: dict


@lru_cache(8)
def grammar(without: frozenset[str] = frozenset()) -> Grammar:
    """The composition of all machines but those named."""
    whole = reduce(Transducer.then, (m for name, m in MACHINES.items() if name not in without))
    back = {} if "target" in without else Transducer(False, _ahead).table(SYMBOLS)
    return Grammar(whole.start, whole.table([*SYMBOLS, *(f"{b} at" for b in _BASES)]), back)


_CLASSES = {
    **dict.fromkeys(TARGETS, "target"), **dict.fromkeys(INTENTS, "intent"), **dict.fromkeys(REPORTS, "report"),
    **dict.fromkeys(NEGATIONS, "negation"), **dict.fromkeys(".!?;:\n", END), **dict.fromkeys('"«»„“”', QUOTE),
    **dict.fromkeys(THREATS, "threat"),
}


@dataclass(frozen=True)
class Model:
    words: tuple[tuple[str, float], ...]
    beginnings: tuple[tuple[str, float], ...]
    weights: tuple[float, ...]


#: Weight of a path without matches, and the weights of the arcs (as ``KINDS``) before any label is seen.
EMPTY = -4.0
PRIOR = np.array([5.0, 2.5, 2.5, 1.5, 0.3, 0.4, 2.2, 1.8, 0.1, 0.2])
#: How much matches of one kind count at most.
FULL = 4.0


class Scorer:
    def __init__(self, model: Model, without: frozenset[str] = frozenset()):
        self.words, self.beginnings, self.weights = dict(model.words), dict(model.beginnings), np.array(model.weights)
        self.lengths, self.grammar = sorted({len(b) for b in self.beginnings}), grammar(without)
        self.finder = ahocorasick.Automaton()
        for term in {*self.words, *self.beginnings, *THREATS}:
            self.finder.add_word(term, term)
        if len(self.finder):
            self.finder.make_automaton()

    def insult(self, word: str) -> float:
        stems = (self.beginnings.get(word[:n], 0.0) for n in self.lengths if len(word) >= n)
        return max(self.words.get(word, 0.0), *stems, 0.0)

    def matches(self, text: str) -> Iterator[tuple[str, float]]:
        """The weighted arcs that a text's path takes, each with how much its word counts (1 for a threat)."""
        low = text.lower()
        if not len(self.finder) or next(self.finder.iter(low), None) is None:
            return
        symbols, counts = [], []
        for word in _WORD.findall(low):
            symbol, count = _CLASSES.get(word), 1.0
            if symbol is None:
                count = self.insult(word)
                symbol = "insult" if count else OTHER
            symbols.append(symbol)
            counts.append(count)
        if self.grammar.ahead:
            state, table = False, self.grammar.ahead
            for i in range(len(symbols) - 1, -1, -1):
                state, symbols[i] = table[state, symbols[i]]
        state, table = self.grammar.start, self.grammar.table
        for symbol, count in zip(symbols, counts):
            state, out = table[state, symbol]
            if out:
                yield out, count

    def features(self, text: str) -> np.ndarray:
        """Per kind of arc, how much its matches count together."""
        sums: dict[str, float] = defaultdict(float)
        for kind, count in self.matches(text):
            sums[kind] += count
        return np.array([min(sums.get(k, 0.0), FULL) for k in KINDS])

    def score(self, text: str) -> float:
        return float(1 / (1 + math.exp(-np.clip(EMPTY + self.weights @ self.features(text), -30, 30))))


# Learning ---------------------------------------------------------------------


def _terms(text: str) -> set[str]:
    """Words and word beginnings (``stem*``) of a text; those that stand in it twice also with a ``+``, three times with two."""
    words = Counter(w for w in _WORD.findall(text.lower()) if len(w) > 2)
    terms = words + Counter()
    for w, n in words.items():
        for size in BEGINNINGS:
            if len(w) >= size:
                terms[f"{w[:size]}*"] += n
    return {f"{t}{'+' * k}" for t, n in terms.items() for k in range(min(n, 3))}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other texts per term, added up within the task as far as ``TERMS`` terms go; Spark adds up the rest."""
    seen: dict[str, list[int]] = {}

    def rows() -> pa.RecordBatch:
        columns = [pa.array(list(seen), pa.string()), *(pa.array([n[k] for n in seen.values()], pa.int64()) for k in (1, 0))]
        return pa.RecordBatch.from_arrays(columns, ["term", "toxic", "other"])

    for batch in slices(batches, rows=64):
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            for term in _terms(text):
                seen.setdefault(term, [0, 0])[int(label == 1)] += 1
            if len(seen) > TERMS:
                yield rows()
                seen.clear()
    yield rows()


def learn_vocabulary(sample: DataFrame, toxic: int, other: int) -> tuple[dict[str, float], dict[str, float]]:
    """Words and word beginnings that mark toxic texts, with how much they count.

    A term stands out by standing in a text, or by being repeated in one (twice, three times). Of beginnings that say the same the longest is kept,
    and a word that a learnt beginning covers is left out.
    """
    if not toxic or not other:
        return {}, {}
    a, b = F.col("toxic"), F.col("other")
    share = toxic / (toxic + other)
    n = a + b
    evidence = 2 * (a * F.log(a / (n * share)) + F.when(b > 0, b * F.log(b / (n * (1 - share)))).otherwise(0.0))
    odds = F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (other + 1))
    rows = (
        sample.mapInArrow(_counted, "term string, toxic long, other long").groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where(a >= max(LEAST, SHARE * toxic)).withColumn("odds", odds).withColumn("evidence", evidence)
        .where((F.col("odds") >= ODDS) & (F.col("evidence") >= EVIDENCE))
        .orderBy(F.desc("evidence"), "term").limit(VOCABULARY).collect()
    )
    best: dict[str, tuple[float, float]] = {}
    for r in rows:  # a term counts by the repetition that tells most
        term = r["term"].rstrip("+")
        evidence, odds = best.get(term, (0.0, 0.0))
        best[term] = max(evidence, round(r["evidence"], 6)), max(odds, r["odds"])
    beginnings: dict[str, float] = {}
    words: dict[str, float] = {}
    for term, (_, odds) in sorted(best.items(), key=lambda t: (-t[1][0], -len(t[0]), t[0])):
        stem, count = term.removesuffix("*"), min(odds, MOST) / UNIT
        if any(stem.startswith(k) for k in beginnings):
            continue
        if term == stem:
            words[stem] = count
        elif not any(k.startswith(stem) for k in beginnings):
            beginnings[stem] = count
    return {w: c for w, c in words.items() if not any(w.startswith(k) for k in beginnings)}, beginnings


def learn_weights(x: np.ndarray, y: np.ndarray, pull: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the prior (which it keeps without labels)."""
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(EMPTY + x @ w, -30, 30)))
        gradient = x.T @ (p - y) + pull * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from about ``SAMPLE`` labelled rows of each class outside the held-out fold.

    Without labels, or without one of the classes, the fixed word lists and prior weights are the model.
    """
    sample, counts = labelled(docs, labels, "toxic", FOLDS, HELD_OUT, SAMPLE)
    toxic, other = counts.get(1, 0), counts.get(0, 0)
    words, beginnings = learn_vocabulary(sample, toxic, other)
    words = {w: 1.0 for w in INSULTS} | words
    model = Model(tuple(sorted(words.items())), tuple(sorted(beginnings.items())), tuple(PRIOR))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in batches:
            rows = Counter((label, tuple(scorer.features(t))) for t, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in rows], pa.int32()), pa.array([list(k[1]) for k in rows], pa.list_(pa.float64())), pa.array(list(rows.values()), pa.int64())],
                ["label", "x", "n"],
            )

    rows = sample.mapInArrow(run, "label int, x array<double>, n long").groupBy("label", "x").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return model
    x = np.repeat(np.array([r["x"] for r in rows]), [r["n"] for r in rows], axis=0)
    y = np.repeat(np.array([float(r["label"] == 1) for r in rows]), [r["n"] for r in rows])
    return Model(model.words, model.beginnings, tuple(learn_weights(x, y)))


@lru_cache(4)
def _scorer(model: Model) -> Scorer:
    return Scorer(model)


# The operator -----------------------------------------------------------------


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    NULL, empty and blank texts match no clause and get the score of such texts. Repeated rows each keep their row; a
    row without ``doc_id`` is not held out. A very long text is read whole. An empty table gives an empty result.
    """
    model = fit(docs, labels)
    source = texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in slices(batches):
            found = [scorer.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score below the threshold.

    NULL and empty texts stay, as do repeated rows; a very long text is read whole. An empty table stays empty.
    """
    model, at = fit(docs, labels), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in slices(batches):
            yield batch.filter(pa.array([scorer.score(t or "") < THRESHOLD for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
