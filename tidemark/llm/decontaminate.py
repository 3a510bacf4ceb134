"""Benchmark decontamination by pigeonhole edit matching.

An item may differ from a passage by ``k`` edits, one per ``LETTERS_PER_EDIT`` characters. Cut into ``k + 1`` pieces,
at least one piece must stand in the passage unchanged. One automaton finds all pieces of all items in a text; around
each hit, Myers' bit-parallel algorithm finds the smallest edit distance between the item and any substring.

The items are the stated query set: they are read in blocks of at most ``BLOCK`` characters, each sent to the
executors and run against all documents, so what is broadcast stays bounded whatever the benchmark's size.
"""

from __future__ import annotations

import math
from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shared import slices, texts

LETTERS_PER_EDIT = 16
BLOCK = 1 << 20
_BLANKS = {c: " " for c in (*range(9, 14), *range(28, 32), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}


def plain(text: str) -> str:
    """Lower case, every kind of blank a space; places stay as they are."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(d := c.lower()) != 1 else d for c in text)
    return low.translate(_BLANKS)


def budget(item: str) -> int:
    return len(item) // LETTERS_PER_EDIT


def pieces(item: str) -> list[tuple[int, str]]:
    """``budget + 1`` pieces with their places; none is empty."""
    cuts = np.linspace(0, len(item), budget(item) + 2).astype(int).tolist()
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


class Pattern:
    """Edit distance of an item to substrings of a text, a machine word (of any length) per text letter."""

    def __init__(self, item: str):
        self.item, self.size, self.limit = item, len(item), budget(item)
        self.masks = self._masks(item)
        self.reverse = self._masks(item[::-1])

    @staticmethod
    def _masks(item: str) -> dict[str, int]:
        masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            masks[c] |= 1 << i
        return dict(masks)

    def _best(self, masks: dict[str, int], text: str, anywhere: bool) -> tuple[int, int]:
        """Smallest distance to a substring (to a prefix, unless ``anywhere``) and its first end."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score = full, 0, self.size
        best, end = score, 0
        for i, c in enumerate(text, 1):
            eq = masks.get(c, 0)
            same = (((eq & up) + up) ^ up) | eq | down
            grow = down | (full & ~(same | up))
            shrink = up & same
            if grow & top:
                score += 1
            elif shrink & top:
                score -= 1
            grow = (grow << 1 | (0 if anywhere else 1)) & full
            shrink = (shrink << 1) & full
            up = shrink | (full & ~((eq | down) | grow))
            down = (eq | down) & grow
            if score < best:
                best, end = score, i
        return best, end

    def find(self, window: str) -> tuple[int, int, int] | None:
        """``distance, start, end`` of the closest substring, if within the budget; of equals, the first to end."""
        distance, end = self._best(self.masks, window, True)
        if distance > self.limit:
            return None
        back = window[max(0, end - self.size - self.limit):end][::-1]
        return distance, end - self._best(self.reverse, back, False)[1], end

    def find_all(self, window: str) -> Iterator[tuple[int, int, int]]:
        """The closest substring, then those left and right of it, until nothing is within the budget."""
        open_ = [(0, len(window))]
        while open_:
            a, b = open_.pop()
            hit = self.find(window[a:b]) if b - a >= self.size - self.limit else None
            if hit:
                start, end = a + hit[1], a + hit[2]
                yield hit[0], start, end
                open_ += [(a, start), (end, b)]


class Finder:
    """The automaton of all pieces of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        self.patterns = [Pattern(t) for _, t in items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, item) in enumerate(items):
            for at, piece in pieces(item):
                places[piece].append((n, at))
        self.pieces = ahocorasick.Automaton()
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        self.pieces.make_automaton()

    def matches(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """``item_id, start, end, distance`` of every matched passage; hits of one passage are judged once."""
        low, starts = plain(text), defaultdict(set)
        for end, (size, where) in self.pieces.iter(low):
            for n, at in where:
                starts[n].add(end + 1 - size - at)
        found = []
        for n, hits in starts.items():
            p = self.patterns[n]
            runs: list[list[int]] = []
            for s in sorted(hits):
                if runs and s - runs[-1][1] <= 2 * p.limit:
                    runs[-1][1] = s
                else:
                    runs.append([s, s])
            hits = []
            for a, b in runs:
                left = max(0, a - p.limit)
                hits += [(d, left + start, left + end) for d, start, end in p.find_all(low[left:b + p.size + p.limit])]
            kept: list[tuple[int, int]] = []
            for distance, start, end in sorted(hits):  # windows may overlap, passages of an item do not
                at = bisect(kept, (start, end))
                if (not at or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0]):
                    kept.insert(at, (start, end))
                    found.append((self.ids[n], start, end, distance))
        return sorted(found, key=lambda m: (m[1], m[2], m[0] is None, m[0]))


@lru_cache(4)
def _finder(items: tuple) -> Finder:
    return Finder(list(items))


def blocks(benchmark: DataFrame) -> Iterator[tuple]:
    """The distinct items, normalised, in blocks of about ``BLOCK`` characters (NULL and blank items match nothing)."""
    items = benchmark.select("item_id", "text").where("trim(text) <> ''").distinct()
    size = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    count = math.ceil(size / BLOCK)
    for b in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b).collect()
        rows = {(r["item_id"], plain(r["text"]).strip()) for r in part}
        block = tuple(sorted(((i, t) for i, t in rows if t), key=lambda r: (r[0] is None, r[0], r[1])))
        if block:
            yield block


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, end, distance``: the passages of documents that items match (code points, end exclusive).

    NULL and empty texts and items match nothing; repeated documents each give their rows, repeated items one; rows
    without ``doc_id`` or ``item_id`` keep it NULL. An empty side gives no rows.
    """
    spark, source = docs.sparkSession, texts(docs)
    kinds = source.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start int, `end` int, distance int"
    item_kind = pa.int64() if kinds[1] == "bigint" else pa.int32() if kinds[1] == "int" else pa.string()
    found = spark.createDataFrame([], schema)
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            finder = _finder(sent.value)
            for batch in slices(batches):
                rows = [(k, m) for k, t in enumerate(batch.column(1).to_pylist()) for m in finder.matches(t)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([k for k, _ in rows], pa.int32())),
                        pa.array([m[0] for _, m in rows], item_kind),
                        *(pa.array([m[i] for _, m in rows], pa.int32()) for i in (1, 2, 3)),
                    ],
                    ["doc_id", "item_id", "start", "end", "distance"],
                )

        found = found.unionByName(source.mapInArrow(run, schema))
    return found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text holds no passage that an item matches."""
    spark, at = docs.sparkSession, docs.columns.index("text")
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            finder = _finder(sent.value)
            for batch in slices(batches):
                yield batch.filter(pa.array([not (t and finder.matches(t)) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
