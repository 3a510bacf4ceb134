"""Personal data: fixed patterns, and a skip-chain conditional random field that spreads their labels over a document.

The patterns give the base spans, which always stay. Everything in a text that looks like a number or an address is a node
of the field, labelled other, email, ip, card or phone. Neighbouring nodes form a chain; nodes with equal or similar text
("+1 (974) 555-3436" and a later "(974) 555-3436") share a potential, however far apart. Loopy belief propagation makes the
labels consistent across the document: a node the patterns missed takes the label of its repetitions, if its own look allows.
Nodes under base spans are observed.

All weights, the couplings too, are learnt together by pseudo-likelihood from a bounded sample of documents, with the base spans
as labels. The patterns are no judge of what they miss: a node without a base span that repeats one with it in another form is
hidden, neither a label nor evidence against the coupling.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.samples import thinned
from tidemark.llm.shared import slices, texts

KINDS = ("email", "ip", "card", "phone")
#: Documents the weights are learnt from (a bound, whatever the corpus), and how sure an added label must be.
SAMPLE, SURE = 20_000, 0.9
#: What the couplings are drawn to before any document is seen: neighbours say little, the same number or address much.
CHAIN, SKIP, PULL = 0.0, 6.0, 5.0

Span = tuple[int, int, int]  # kind (place in KINDS), start, end

# Base patterns ----------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number can only begin where a run of digits does, and runs never give digits back: linear in any text.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest local part before it and the domain behind it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        part = text[floor:at]
        start = floor + len(part.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            yield start, domain.end()
        floor = domain.end() if start < at and domain else at + 1
        at = text.find("@", max(floor, at + 1))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d - 9 if d > 9 else d for d in (2 * int(c) for c in digits[-2::-2]))) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that pass its test, by start, then kind."""
    found = [(0, *m) for m in _emails(text)]
    if _DIGIT.search(text):
        found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, *m.span()))
        if "+" in text:
            found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found, key=lambda s: (s[1], s[0]))


# The field --------------------------------------------------------------------

_NODE = re.compile(r"(?<![A-Za-z0-9])(?:[A-Za-z0-9._%+-]{1,64}(?:@|\x20?\[at\]\x20?|\(at\))[A-Za-z0-9.-]+|\+?\(?[0-9][0-9().\x20-]*)(?![A-Za-z])")
#: Words that announce a kind (fixed values; English, German, French, Spanish).
_CUES = {
    "mail": 0, "email": 0, "e-mail": 0, "correo": 0, "courriel": 0, "ip": 1, "host": 1, "server": 1, "card": 2, "visa": 2,
    "karte": 2, "carte": 2, "tarjeta": 2, "phone": 3, "tel": 3, "call": 3, "telefon": 3, "fax": 3, "teléfono": 3,
}
STATES = len(KINDS) + 1  # the last is "other"
FEATURES = 26


def nodes(text: str, base: list[Span]) -> list[tuple[int, int, int]]:
    """``start, end, observed kind`` (-1: none) of everything that looks like a number or an address."""
    out, k = [], 0
    if "@" not in text and "at" not in text and not _DIGIT.search(text):
        return out
    for m in _NODE.finditer(text):
        start, end = m.start(), m.start() + len(m[0].rstrip(" .-()"))
        if end <= start:
            continue
        while k < len(base) and base[k][2] <= start:
            k += 1
        seen = next((s[0] for s in base[k:k + 4] if s[1] < end and s[2] > start), -1)
        out.append((start, end, seen))
    return out


def features(text: str, start: int, end: int) -> tuple[int, ...]:
    """The look of a node, as places of the features that are set."""
    word = text[start:end]
    digits = [c for c in word if "0" <= c <= "9"]
    n, dots = len(digits), word.count(".")
    on = [0, 1 + min(n, 20) // 3]
    on += [i for i, is_set in enumerate((
        "@" in word or "at" in word, word.startswith("+"), "(" in word, dots == 1, dots == 3, dots > 3, "-" in word, " " in word,
        12 <= n <= 19 and luhn("".join(digits)), n == len(word), end - start > 40,
    ), 9) if is_set]
    before = text[max(0, start - 24):start].lower().replace(":", " ").split()[-2:]
    return tuple(sorted({*on, *(20 + _CUES[w.strip(".,;#")] for w in before if w.strip(".,;#") in _CUES)}))


def same(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Skip edges between nodes with equal or similar text: each node is tied to the one before it in its group.

    Numbers are similar if their last seven digits are the same, addresses if they differ in case only. Linking neighbours
    within a group connects all of it with as many edges as nodes.
    """
    last: dict[str, int] = {}
    edges = []
    for i, (a, b, _) in enumerate(found):
        word = text[a:b]
        digits = "".join(c for c in word if "0" <= c <= "9")
        key = word.lower().replace("[at]", "@").replace("(at)", "@").replace(" ", "") if "@" in word or "at" in word else digits[-7:]
        if len(key) < 7:
            continue
        if key in last:
            edges.append((last[key], i))
        last[key] = i
    return edges


@dataclass(frozen=True)
class Weights:
    look: tuple[tuple[float, ...], ...]  # a row per state
    chain: float  # neighbours share a label
    skip: float  # repetitions share a label


def beside(found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Chain edges: nodes that follow each other closely."""
    return [(i, i + 1) for i in range(len(found) - 1) if found[i + 1][0] - found[i][1] <= 80]


def potentials(weights: Weights, text: str, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Log potentials of the nodes by themselves; an observed one has a single state."""
    look = np.array(weights.look)
    node = np.stack([look[:, list(features(text, a, b))].sum(axis=1) for a, b, _ in found])
    for i, (_, _, seen) in enumerate(found):
        if seen >= 0:
            node[i] = -50.0
            node[i, seen] = 0.0
    return node


def marginals(weights: Weights, text: str, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Beliefs of every node after loopy sum-product with damping; exact where the graph is a tree."""
    node = potentials(weights, text, found)
    chain, skip = beside(found), same(text, found)
    pairs = np.array(chain + skip, np.int64).reshape(-1, 2)
    if not len(pairs):
        return _softmax(node)
    force = np.exp(np.array([weights.chain] * len(chain) + [weights.skip] * len(skip)))
    source, target = np.concatenate([pairs, pairs[:, ::-1]]).T
    force = np.concatenate([force, force])[:, None]
    half = len(pairs)
    back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
    message = np.full((2 * half, STATES), -np.log(STATES))
    for _ in range(30):
        total = node.copy()
        np.add.at(total, target, message)
        inward = total[source] - message[back]
        weight = np.exp(inward - inward.max(axis=1, keepdims=True))
        fresh = np.log(weight.sum(axis=1, keepdims=True) + (force - 1) * weight + 1e-300)
        fresh -= np.log(np.exp(fresh).sum(axis=1, keepdims=True))
        moved = np.abs(fresh - message).max()
        message = 0.5 * message + 0.5 * fresh
        if moved < 1e-4:
            break
    total = node.copy()
    np.add.at(total, target, message)
    return _softmax(total)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def all_spans(weights: Weights, text: str, base: list[Span]) -> list[Span]:
    """The base spans and those the field adds, by start, then kind."""
    found = nodes(text, base)
    if all(seen >= 0 for _, _, seen in found):
        return base
    beliefs = marginals(weights, text, found)
    added = [
        (int(b.argmax()), start, end) for (start, end, seen), b in zip(found, beliefs)
        if seen < 0 and b.argmax() < len(KINDS) and b.max() >= SURE
    ]
    return sorted(base + added, key=lambda s: (s[1], s[0]))


# Learning ---------------------------------------------------------------------


def examples(text: str) -> Iterator[tuple[int, ...]]:
    """What learning takes from a text, a row per node that is not hidden: its label, the labels of its neighbours in the chain
    and among its repetitions (counted per state), then its look."""
    found = nodes(text, base_spans(text))
    chain, skip = beside(found), same(text, found)
    labels = [seen if seen >= 0 else STATES - 1 for _, _, seen in found]
    hidden = {j for a, b in skip for i, j in ((a, b), (b, a)) if found[i][2] >= 0 > found[j][2]}
    near = np.zeros((2, len(found), STATES), int)
    for kind, edges in enumerate((chain, skip)):
        for a, b in edges:
            for i, j in ((a, b), (b, a)):
                if j not in hidden:
                    near[kind, i, labels[j]] += 1
    for i, (start, end, _) in enumerate(found):
        if i not in hidden:
            yield (labels[i], *near[0, i].tolist(), *near[1, i].tolist(), *features(text, start, end))


def learn(docs: DataFrame) -> Weights:
    """Weights from the base labels of about ``SAMPLE`` documents, by pseudo-likelihood: each node given its neighbours.

    That is a regression with one weight per look and state, and one for each coupling: how much a neighbour's label speaks for
    the same label. Looks are pulled to zero, the couplings to ``CHAIN`` and ``SKIP``. Examples are counted in Spark; what reaches
    the driver is a row per distinct one.
    """
    sample = thinned(texts(docs), docs.count(), SAMPLE, "personal data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                seen.update(examples(text))
        rows = list(seen.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(k) for k, _ in rows], pa.list_(pa.int32())), pa.array([n for _, n in rows], pa.int64())], ["look", "n"]
        )

    rows = sample.mapInArrow(run, "look array<int>, n long").groupBy("look").agg(F.sum("n").alias("n")).orderBy("look").collect()
    return learnt([(tuple(r["look"]), r["n"]) for r in rows])


def learnt(rows: list[tuple[tuple[int, ...], int]], steps: int = 400) -> Weights:
    """Weights of greatest pseudo-likelihood for counted ``examples``."""
    x, y = np.zeros((len(rows), FEATURES)), np.zeros((len(rows), STATES))
    near = np.zeros((2, len(rows), STATES))
    for i, (row, n) in enumerate(rows):
        y[i, row[0]] = n
        near[0, i], near[1, i] = row[1:1 + STATES], row[1 + STATES:1 + 2 * STATES]
        x[i, list(row[1 + 2 * STATES:])] = 1
    size = y.sum(axis=1, keepdims=True)
    total, prior = max(float(y.sum()), 1.0), np.array([CHAIN, SKIP])
    w, couple = np.zeros((STATES, FEATURES)), prior.copy()
    for _ in range(steps if len(rows) else 0):
        wrong = _softmax(x @ w.T + couple[0] * near[0] + couple[1] * near[1]) * size - y
        w -= 2.0 * (wrong.T @ x / total + 1e-3 * w)
        # the couplings by a damped Newton step each, as few nodes have neighbours
        for k in (0, 1):
            share = _softmax(x @ w.T + couple[0] * near[0] + couple[1] * near[1])
            mean = (share * near[k]).sum(axis=1, keepdims=True)
            slope = ((share * size - y) * near[k]).sum() + PULL * (couple[k] - prior[k])
            curve = (size * share * (near[k] - mean) ** 2).sum() + PULL
            couple[k] = np.clip(couple[k] - np.clip(slope / curve, -0.5, 0.5), 0.0, 8.0)
    return Weights(tuple(map(tuple, w)), float(couple[0]), float(couple[1]))


# The operator -----------------------------------------------------------------


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row.

    NULL and empty texts have no spans (the digest is that of the empty text); very long ones are read whole. Repeated rows, and rows without ``doc_id``,
    each keep their row. An empty table gives an empty result.
    """
    weights, source = learn(docs), texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                per_kind = Counter(k for k, _, _ in base)
                digest = hashlib.sha256(_written(base).encode()).hexdigest()
                rows.append((*(per_kind[k] for k in range(4)), digest, _written(all_spans(weights, text, base))))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return source.mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced as one, by the first kind."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with all found spans masked in ``text`` (NULL stays NULL); a column ``n_chars`` follows the new text."""
    weights, at = learn(docs), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            new = [t and masked(t, all_spans(weights, t, base_spans(t))) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    done = docs.mapInArrow(run, docs.schema)
    if "n_chars" not in docs.columns:
        return done
    size = F.when(F.col("n_chars").isNotNull(), F.char_length(F.coalesce("text", F.lit(""))))
    return done.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
