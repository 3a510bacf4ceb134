"""Exact substring dedup with a run-length index (r-index) over what can repeat at all.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the corpus.

1. Every window of ``LENGTH`` bytes selects an anchor, the ``GRAM``-byte string of smallest hash inside it (the rightmost of
   equals). The choice depends on the window's bytes alone, so equal windows select equal anchors at the same offset. The
   windows that select one anchor form a stretch; a document has a stretch about every 180 bytes.
2. A stretch whose anchor occurs nowhere else holds no repeated window. Stretches that are equal as a whole are repeated as a
   whole: counting settles both, and a large group of copies is one counted class, of which one stands for all from here on.
3. Stretches that share an anchor but differ (the ends of shared passages, the surroundings of edits) are gathered by anchor, and a run-length index is built over it: the Burrows-Wheeler transform is cut into runs, and only the
   text positions at run ends are kept, with their longest common prefixes. Matching statistics stream from these samples:
   between two of them the longest match shrinks by one per byte. Where it reaches ``LENGTH``, the window is repeated.
4. An anchor with more than ``GROUP`` different stretches does not have to fit into one task: its windows are compared by
   digest, first in blocks of ``STEP`` windows, then one by one where blocks differ at an end.
5. The same stretches show shorter passages too: strings of ``SHORT`` bytes that stand elsewhere are reported, never removed.
   They are found where both places select one anchor, as all strings of ``LENGTH`` bytes do and nearly all shorter passages.
   A text of ``SHORT`` to ``LENGTH`` bytes is one stretch, whose ``more`` windows after the first are negative.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shared import lanes, slices, stored, texts

LENGTH, GRAM = 400, 32
#: Bytes of the strings that are reported.
SHORT = 250
SPAN = LENGTH - GRAM + 1
#: Different stretches of one anchor that are indexed together, bytes of an index, windows of a block.
GROUP, INDEX_BYTES, STEP = 200, 1 << 17, 16

_VALUES = np.array([xxhash.xxh64_intdigest(bytes([b]), 3) | 1 for b in range(256)], np.uint64)
_BASE = 0x9E3779B97F4A7C15


# Anchors ----------------------------------------------------------------------


def _grams(data: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of the ``GRAM`` bytes from every position, by doubling."""
    h, size, power = _VALUES[data], 1, _BASE
    while size < GRAM:
        h = h[:-size] * np.uint64(power) + h[size:]
        power, size = power * power & 0xFFFFFFFFFFFFFFFF, size * 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def stretches(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``first, last`` window, anchor ``place`` and its ``hash`` of every stretch, in parts of a bounded number of windows."""
    part = 1 << 19
    windows = len(data) - LENGTH + 1
    held = None
    if windows < 1 and len(data) >= SHORT:
        h = _grams(np.frombuffer(data, np.uint8))
        place = len(h) - 1 - int(np.argmin(h[::-1]))
        yield tuple(np.array([x]) for x in (0, windows - 1, place, h[place].view(np.int64)))
    for at in range(0, max(windows, 0), part):
        piece = np.frombuffer(data, np.uint8, min(part, windows - at) + LENGTH - 1, at)
        h = _grams(piece)
        low = np.uint64((1 << 20) - 1)
        key = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))  # of equal hashes the rightmost is least
        size = 1
        while size * 2 <= SPAN:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        key = np.minimum(key[:len(key) - (SPAN - size)], key[SPAN - size:])
        place = (low - (key & low)).astype(np.int64)
        cut = np.flatnonzero(np.diff(place)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]]) - 1
        places, hashes = place[first] + at, h[place[first]].view(np.int64)
        first, last = first + at, last + at
        if held is not None and held[2] == places[0]:  # a stretch across two parts
            first[0] = held[0]
        elif held is not None:
            yield tuple(np.array([x]) for x in held)
        held = (first[-1], last[-1], places[-1], hashes[-1])
        yield first[:-1], last[:-1], places[:-1], hashes[:-1]
    if held is not None:
        yield tuple(np.array([x]) for x in held)


def _key(data: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(data)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in slices(batches, size=1 << 20):
        found: list[list[np.ndarray]] = []
        for text, k0, k1 in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode("utf-8", "surrogatepass")
            for first, last, place, h in stretches(data):
                whole = np.array([digest(data[a:b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())], np.uint64)
                n = len(first)
                found.append([np.full(n, k0), np.full(n, k1), first, last - first, place - first, h, whole.view(np.int64)])
        if found:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int64(), pa.int64()]
            columns = [pa.array(np.concatenate(c), k) for c, k in zip(zip(*found), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["k0", "k1", "first", "more", "place", "anchor", "whole"])


ANCHORS = "k0 long, k1 long, first int, more short, place short, anchor long, whole long"


# The run-length index ---------------------------------------------------------


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array by prefix doubling over what is not yet told apart, and the ranks at each depth.

    Texts end in symbols of their own, so suffixes differ before they leave their text.
    """
    n = len(symbols)
    counts = np.bincount(symbols)
    rank = (np.cumsum(counts) - counts)[symbols].astype(np.int32)
    depths, depth = [(1, rank)], 1
    open_ = np.flatnonzero(counts[symbols] > 1)
    while len(open_):
        after = np.where(open_ + depth < n, rank[np.minimum(open_ + depth, n - 1)] + 1, 0)
        order = np.argsort(rank[open_].astype(np.int64) * (n + 1) + after)
        at, r, a = open_[order], rank[open_][order], after[order]
        new_group = np.concatenate([[True], r[1:] != r[:-1]])
        new_key = new_group | np.concatenate([[True], a[1:] != a[:-1]])
        where = np.arange(len(at))
        group = np.maximum.accumulate(np.where(new_group, where, 0))
        start = np.maximum.accumulate(np.where(new_key, where, 0))
        rank = rank.copy()
        rank[at] = r + start - group
        depth *= 2
        depths.append((depth, rank))
        alone = new_key & np.concatenate([new_key[1:], [True]])
        open_ = np.sort(at[~alone])
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, depths


def common(a: np.ndarray, b: np.ndarray, depths: list[tuple[int, np.ndarray]], n: int) -> np.ndarray:
    """Longest common prefixes of pairs of suffixes, from the ranks at each depth."""
    a, b, size = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for depth, rank in reversed(depths):
        inside = (a < n) & (b < n)
        equal = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        size += depth * equal
        a += depth * equal
        b += depth * equal
    return size


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of some texts, with samples at the ends of its runs.

    Within a run, stepping back by one letter keeps neighbours in suffix order neighbours, so the match of a position with
    its neighbour is one shorter than that of the position before. Only where a run begins (for the neighbour above) or ends
    (for the neighbour below) does a match have to be kept.
    """

    def __init__(self, texts_: list[bytes]):
        self.starts = np.cumsum([0, *(len(t) + 1 for t in texts_)])
        symbols = np.empty(self.starts[-1], np.int64)
        for i, (t, at) in enumerate(zip(texts_, self.starts)):
            symbols[at:at + len(t)] = np.frombuffer(t, np.uint8)
            symbols[at + len(t)] = 256 + i
        n = self.n = len(symbols)
        order, depths = suffix_order(symbols)
        before = symbols[order - 1]  # the transform; the first suffix is preceded by the last symbol
        change = before[1:] != before[:-1]
        heads = np.flatnonzero(np.concatenate([[True], change]))
        tails = np.flatnonzero(np.concatenate([change, [True]]))
        self.runs = len(heads)
        self.letters = before[heads]
        self.samples = []
        for ends, beside in ((heads, heads - 1), (tails, tails + 1)):
            known = (beside >= 0) & (beside < n)
            place, other = order[ends], order[np.clip(beside, 0, n - 1)]
            size = np.where(known, common(place, other, depths, n), 0)
            by_place = np.argsort(place)
            self.samples.append((place[by_place], size[by_place]))

    def matching_statistics(self) -> np.ndarray:
        """For every position, the longest match of its suffix anywhere else."""
        at = np.arange(self.n)
        best = np.zeros(self.n, np.int64)
        for place, size in self.samples:
            last = np.searchsorted(place, at, side="right") - 1
            value = np.where(last >= 0, size[np.maximum(last, 0)] - (at - place[np.maximum(last, 0)]), 0)
            best = np.maximum(best, value)
        return best

    def repeated(self, length: int, best: np.ndarray | None = None) -> list[np.ndarray]:
        """Per text, the places where a string of ``length`` bytes starts that also starts elsewhere; ``best``: the statistics."""
        hit = np.flatnonzero((self.matching_statistics() if best is None else best) >= length)
        cuts = np.searchsorted(hit, self.starts)
        return [hit[a:b] - s for a, b, s in zip(cuts, cuts[1:], self.starts)]


def _runs(places: np.ndarray) -> list[tuple[int, int]]:
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.concatenate([[0], cut + 1])].tolist(), places[np.concatenate([cut, [len(places) - 1]])].tolist()))


def _joined(parts: list[tuple]) -> list[tuple]:
    """Parts of one text that overlap as one, so that no byte is in an index twice and matches itself."""
    out: list[tuple] = []
    for k0, k1, first, data in sorted(parts, key=lambda p: p[:3]):
        inside = out[-1][2] + len(out[-1][3]) - first if out and out[-1][:2] == (k0, k1) else -1
        if inside >= 0:
            out[-1] = (*out[-1][:3], out[-1][3] + data[inside:])
        else:
            out.append((k0, k1, first, data))
    return out


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows among the stretches of a stream sorted by anchor; several anchors share an index."""
    waiting: list[tuple] = []
    size, last = 0, None

    def marks() -> pa.RecordBatch:
        rows: list[tuple] = []
        if waiting:
            parts = _joined(waiting)
            index = RunIndex([p[3] for p in parts])
            best = index.matching_statistics()
            for (k0, k1, first, _), long, short in zip(parts, index.repeated(LENGTH, best), index.repeated(SHORT, best)):
                if len(short):
                    removed = _runs(long)
                    rows += [(k0, k1, first + a, first + b, LENGTH) for a, b in removed]
                    rows += [(k0, k1, first + a, first + b, SHORT) for a, b in _runs(short) if (a, b + SHORT - LENGTH) not in removed]
        return _records(rows, MARKS)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("anchor", "k0", "k1", "first", "bytes")]
        for anchor, *row in zip(*columns):
            if anchor != last and size >= INDEX_BYTES:
                yield marks()
                waiting, size = [], 0
            waiting.append(tuple(row))
            size, last = size + len(row[3]), anchor
    yield marks()


MARKS = "k0 long, k1 long, a int, b int, size short"


# Anchors with many stretches --------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of windows of a stretch: the digests of what all windows of such a block share, and of all this one covers.

    Blocks are counted back from the anchor, so they line up between stretches. At the ends of a stretch they are cut short;
    what a full block would share is still inside.
    """
    for batch in slices(batches, rows=256):
        rows = []
        for k0, k1, first, place, anchor, data in zip(*(batch.column(c).to_pylist() for c in ("k0", "k1", "first", "place", "anchor", "bytes"))):
            for size, a, b in ((n, *ab) for n in (LENGTH, SHORT) for ab in _cut(len(data) - n, place)):
                far = place - (place - a) // STEP * STEP
                core = data[far:far - STEP + 1 + size]
                rows.append((k0, k1, first, a, b, size, anchor, far - place, *_key(core), *_key(data[a:b + size])))
        yield _records(rows, BLOCKS)


def _cut(more: int, place: int) -> list[tuple[int, int]]:
    """Windows 0 to ``more`` in blocks of ``STEP`` counted back from the anchor: a block is ``place - STEP * i`` and before."""
    out, a = [], 0
    while a <= more:
        b = min(more, place - ((place - a) // STEP) * STEP)
        out.append((a, b))
        a = b + 1
    return out


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the windows of undecided blocks."""
    for batch in slices(batches, rows=256):
        yield _records([
            (k0, k1, first + i, cut["size"], anchor, *_key(data[i:i + cut["size"]]))
            for k0, k1, first, anchor, data, cuts in zip(*(batch.column(c).to_pylist() for c in ("k0", "k1", "first", "anchor", "bytes", "cuts")))
            for cut in cuts for i in range(cut["a"], cut["b"] + 1)
        ], WINDOWS)


BLOCKS = "k0 long, k1 long, first int, a int, b int, size short, anchor long, block int, c0 long, c1 long, w0 long, w1 long"
WINDOWS = "k0 long, k1 long, a int, size short, anchor long, w0 long, w1 long"


def _records(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "short": pa.int16(), "boolean": pa.bool_(), "binary": pa.binary()}
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _dealt(keys: DataFrame) -> DataFrame:
    """A join side dealt anew, so that the join shuffles both sides itself and can split a key that many rows share."""
    return keys.repartition(lanes(keys.sparkSession))


def _classes(rows: DataFrame, kind: list[str], place: list[str]) -> DataFrame:
    """``times``, how often each kind occurs, and ``least`` of the digests of its places; a number, so that it is aggregated
    by hash and no task sorts its rows for it."""
    return rows.groupBy(*kind).agg(F.count("*").alias("times"), F.min(F.xxhash64(*place)).alias("least"))


def _one_of_each(rows: DataFrame, classes: DataFrame, kind: list[str], place: list[str]) -> DataFrame:
    """``rows`` with what their class has, and ``stands``, true for one row of each kind."""
    return rows.join(_dealt(classes), kind).withColumn("stands", F.xxhash64(*place) == F.col("least")).drop("least")


def _by_digest(many: DataFrame) -> DataFrame:
    """Repeated windows of stretches whose anchor has too many of them for one index.

    A block equal to another is repeated as a whole. A window of any other can only be repeated if the core of its block
    occurs in a block that differs; the windows of these blocks, and of one block of each kind, are compared.
    """
    core, whole = ["anchor", "size", "block", "c0", "c1"], ["anchor", "size", "block", "w0", "w1"]
    place, cut = ["k0", "k1", "first", "a"], many.mapInArrow(_blocks, BLOCKS)
    blocks = stored(_one_of_each(cut, _classes(cut, whole, place), whole, place), "blocks")
    settled = blocks.where("times > 1").select("k0", "k1", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"), "size")
    standing = blocks.where("stands")
    shared = standing.groupBy(*core).agg(F.count("*").alias("kinds")).where("kinds > 1").drop("kinds")
    open_ = (
        standing.join(_dealt(shared), core, "left_semi").groupBy("k0", "k1", "first")
        .agg(F.collect_list(F.struct("a", "b", "size")).alias("cuts"))
    )
    windows = many.join(_dealt(open_), ["k0", "k1", "first"]).select("k0", "k1", "first", "anchor", "bytes", "cuts").mapInArrow(_windows, WINDOWS)
    windows = stored(windows, "windows")
    # stretches of one text can overlap by a short window, which then comes twice from one place
    at = F.xxhash64("k0", "k1", "a")
    twice = (
        windows.groupBy("anchor", "size", "w0", "w1").agg(F.count("*").alias("times"), F.min(at).alias("least"), F.max(at).alias("most"))
        .where((F.col("times") > 1) & ((F.col("size") == LENGTH) | (F.col("least") != F.col("most")))).drop("times", "least", "most")
    )
    single = windows.join(_dealt(twice), ["anchor", "size", "w0", "w1"], "left_semi").select("k0", "k1", "a", F.col("a").alias("b"), "size")
    return settled.unionByName(single)


# The operator -----------------------------------------------------------------


PARTS = "k0 long, k1 long, first int, place short, anchor long, many boolean, bytes binary"


def _stretch_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of a text's undecided stretches."""
    for batch in slices(batches, rows=64):
        rows = []
        for text, k0, k1, found in zip(*(batch.column(c).to_pylist() for c in ("text", "k0", "k1", "found"))):
            data = text.encode("utf-8", "surrogatepass")
            rows += [(k0, k1, s["first"], s["place"], s["anchor"], s["many"], data[s["first"]:s["first"] + s["more"] + LENGTH]) for s in found]
        yield _records(rows, PARTS)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``k0, k1``, the digest of their text; made by Spark, so that a text need not go through Python for it."""
    half = lambda at: F.conv(F.substring(F.md5("text"), at, 16), 16, -10).cast("long")
    return docs.withColumns({"k0": half(1), "k1": half(17)})


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``k0, k1, marks``: per text (by digest) with repeated strings of ``size`` bytes, the runs ``a`` to ``b`` of their starts."""
    spark = docs.sparkSession
    long = _keyed(texts(docs).where(F.octet_length("text") >= SHORT))
    rows = stored(long.select("text", "k0", "k1").mapInArrow(_anchors, ANCHORS), "anchors")
    kind, place = ["anchor", "whole", "more", "place"], ["k0", "k1", "first"]
    classes = _classes(rows, kind, place)
    per_anchor = classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("times").alias("all")).where(F.col("all") > 1)
    classes = classes.join(per_anchor.drop("all"), "anchor")
    state = stored(_one_of_each(rows, classes, kind, place).drop("whole"), "stretches")
    size = F.when(F.col("more") < 0, SHORT).otherwise(LENGTH).cast("short")
    settled = state.where("times > 1").select(
        "k0", "k1", F.col("first").alias("a"), (F.col("first") + F.col("more") + LENGTH - size).cast("int").alias("b"), size.alias("size"),
    )
    # one stretch of each kind, so nothing here grows with a group of copies; copies of a text give it once
    found = (
        state.where("kinds > 1 AND stands").select(*place, "more", "place", "anchor", (F.col("kinds") > GROUP).alias("many")).distinct()
        .groupBy("k0", "k1").agg(F.collect_list(F.struct("first", "more", "place", "anchor", "many")).alias("found"))
    )
    parts = stored(
        long.join(_dealt(found), ["k0", "k1"]).select("text", "k0", "k1", "found")
        .mapInArrow(_stretch_bytes, PARTS).dropDuplicates(["k0", "k1", "first"]), "parts"
    )
    few = (
        parts.where("NOT many").repartition(lanes(spark), "anchor").sortWithinPartitions("anchor")
        .select("anchor", "k0", "k1", "first", "bytes").mapInArrow(_indexed, MARKS)
    )
    marks = settled.unionByName(few).unionByName(_by_digest(parts.where("many")))
    return marks.distinct().groupBy("k0", "k1").agg(F.sort_array(F.collect_list(F.struct("a", "b", "size"))).alias("marks"))


def covered_spans(marks: list[dict], least: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by strings of ``least`` bytes or more that start in the sorted runs ``a`` to ``b``."""
    out: list[list[int]] = []
    for m in marks:
        if m["size"] < least:
            continue
        a, b = m["a"], m["b"] + m["size"]
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept, repeated``: the removed byte spans of every row, the bytes that stay, and all spans of
    strings of ``SHORT`` bytes that were found elsewhere too, removed or not.

    NULL and empty texts, and texts shorter than a window, lose nothing. Repeated rows are copies of each other, and rows
    without ``doc_id`` are documents like any other. An empty table gives an empty result.
    """
    source = texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                spans, repeated = (covered_spans(marks or [], least) for least in (LENGTH, SHORT))
                edges = [0, *(x for s in spans for x in s), len(data)]
                rows.append((len(data), [{"start": a, "end": b} for a, b in spans], b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), [{"start": a, "end": b} for a, b in repeated]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.int64(), span, pa.binary(), span]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], ["doc_id", "n_bytes", "spans", "kept", "repeated"])

    none = F.lit(None).cast("array<struct<a: int, b: int, size: smallint>>").alias("marks")
    marks = stored(repeated_windows(docs), "marks").repartition(lanes(docs.sparkSession))
    long = _keyed(source.where(F.octet_length("text") >= SHORT)).join(marks, ["k0", "k1"], "left").select("doc_id", "text", "marks")
    short = source.where(F.octet_length("text") < SHORT).select("doc_id", "text", none)
    schema = f"doc_id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary, repeated array<struct<start: long, end: long>>"
    return long.unionByName(short).mapInArrow(run, schema)
