"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 32 bytes decides where a text is cut, so after an insertion the cuts fall into place
again. Chunks are compared by a 128-bit digest across the whole corpus. Only runs of at least ``MIN_RUN`` bytes of
repeated chunks count, so that a stray phrase in a clean text does not; a run that is a whole text always counts. Of equal
chunks the first, by ``doc_id`` and place, stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.shared import slices, texts

#: A cut needs ``CUT_BITS`` zero bits: a chunk has 16 to 256 bytes, about 48 on average. A shared passage loses the chunks at
#: its ends, so of passages of 51 words (about 330 bytes) some 2 % keep less than ``MIN_RUN`` bytes of whole chunks, of 60 words
#: under 1 %, of 80 words none.
CUT_BITS, SHORTEST, LONGEST, WINDOW = 5, 16, 256, 32
MIN_RUN = 100
#: Bytes of unpacked texts that a batch of results holds, but for a single long one.
UNPACKED = 8 << 20


def _gear() -> np.ndarray:
    """A random 32-bit number per byte value, by rule."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)


GEAR = _gear()


def _rolling(data: np.ndarray, silent: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: the sum over the last 32 bytes of their numbers, shifted by age."""
    h = GEAR[data]
    h[silent] = 0
    for s in (1, 2, 4, 8, 16):
        older = h[:-s] << np.uint32(s)
        h = h.copy()
        h[s:] += older
    return h


def cuts(texts_: list[bytes]) -> list[list[int]]:
    """Chunk ends of each text; the last is its length (an empty text has none)."""
    gap = b"\0" * WINDOW
    data = np.frombuffer(gap + gap.join(texts_) + gap, np.uint8)
    starts, at = [], WINDOW
    silent = np.zeros(len(data), bool)
    for t in texts_:
        silent[at - WINDOW:at] = True
        starts.append(at)
        at += len(t) + WINDOW
    silent[at - WINDOW:] = True
    marks = np.flatnonzero(_rolling(data, silent) >> np.uint32(32 - CUT_BITS) == 0) + 1
    out = []
    for start, t in zip(starts, texts_):
        lo, hi = np.searchsorted(marks, [start + 1, start + len(t) + 1])
        ends, last = [], 0
        for m in (marks[lo:hi] - start).tolist():
            while m - last > LONGEST:
                last += LONGEST
                ends.append(last)
            if m - last >= SHORTEST:
                ends.append(m)
                last = m
        while len(t) - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if len(t) > last:
            ends.append(len(t))
        out.append(ends)
    return out


def _again(text: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """1 where a text holds a chunk that it holds before too; chunks come text by text, in order."""
    order = np.lexsort((codes[:, 1], codes[:, 0], text))  # stable: of equal chunks the first comes first
    t, c = text[order], codes[order]
    again = np.zeros(len(order), np.int32)
    again[order[1:]] = (t[1:] == t[:-1]) & (c[1:] == c[:-1]).all(axis=1)
    return again


def chunks(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, start, piece, d0, d1``: a row per chunk; ``tag`` tells texts under one ``doc_id`` apart, ``piece`` is four
    times the size, plus two for a chunk that its text holds before too, plus one for the last of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in slices(batches, size=1 << 20):
            whole = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            ends = cuts(whole)
            counts = [len(e) for e in ends]
            begins = [[0, *e[:-1]] if e else [] for e in ends]
            made = b"".join(digest(t[a:b]) for t, bs, es in zip(whole, begins, ends) for a, b in zip(bs, es))
            codes = np.frombuffer(made, "<i8").reshape(-1, 2)
            starts, stops = (np.array([x for xs in v for x in xs], np.int32) for v in (begins, ends))
            last = np.zeros(len(starts), np.int32)
            last[np.cumsum([c for c in counts if c], dtype=np.int64) - 1] = 1
            tags = np.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in whole], np.int64)
            again = _again(np.repeat(np.arange(len(whole)), counts), codes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(whole)), counts))),
                    pa.array(np.repeat(tags, counts)),
                    pa.array(starts), pa.array(4 * (stops - starts) + 2 * again + last),
                    pa.array(np.ascontiguousarray(codes[:, 0])), pa.array(np.ascontiguousarray(codes[:, 1])),
                ],
                ["doc_id", "tag", "start", "piece", "d0", "d1"],
            )

    source = texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, tag long, start int, piece int, d0 long, d1 long")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, start, size, later``: maximal runs of repeated chunks, ``MIN_RUN`` bytes at least or a whole text.

    A run with ``later`` false covers all chunks that occur more than once, wherever; with ``later`` true only those that
    occur before too, which dedup removes. NULL and empty texts have no chunks. Rows repeated with one ``doc_id`` and text
    count as copies of each other and give their runs once; rows without ``doc_id`` are ordered before all others.
    """
    rows = chunks(docs)  # made twice: cheaper than to store or shuffle them once more
    first = F.min(F.struct("doc_id", "tag"))  # within a text, `piece` tells which chunk is the first
    many = rows.groupBy("d0", "d1").agg(F.count("*").alias("times"), first.alias("first")).where("times > 1")
    # Joined by another expression than it was grouped by, so that the join shuffles both sides and can split a chunk that many
    # texts share.
    many = many.select(F.col("d0").bitwiseXOR(F.lit(1)).alias("e0"), F.col("d1").alias("e1"), "first")
    found = (
        rows.join(many, (F.col("d0").bitwiseXOR(F.lit(1)) == F.col("e0")) & (F.col("d1") == F.col("e1")))
        .select("doc_id", "tag", "start", "piece",
                (F.col("piece").bitwiseAND(2) > 0).alias("again"), (~F.struct("doc_id", "tag").eqNullSafe(F.col("first"))).alias("after"))
        .groupBy("doc_id", "tag", "start", "piece").agg(F.max(F.col("after") | F.col("again")).alias("after"))
        .withColumn("size", F.shiftright("piece", 2))
    )
    # Both kinds of run from one window, doubled only after its shuffle.
    before = Window.partitionBy("doc_id", "tag").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    sizes = {"run": F.col("size"), "run_later": F.when(F.col("after"), F.col("size"))}
    runs = found.withColumns({name: F.col("start") - F.coalesce(F.sum(size).over(before), F.lit(0)) for name, size in sizes.items()})
    kinds = F.when(F.col("after"), F.expr("array(struct(false AS later, run), struct(true AS later, run_later AS run))"))
    runs = runs.select("doc_id", "tag", "start", "size", "piece", F.inline(kinds.otherwise(F.expr("array(struct(false AS later, run))"))))
    return (
        runs.groupBy("doc_id", "tag", "later", "run")
        .agg(F.min("start").alias("start"), F.sum("size").cast("int").alias("size"), F.max(F.col("piece") % 2).alias("ends"))
        .where((F.col("size") >= MIN_RUN) | ((F.col("start") == 0) & (F.col("ends") == 1)))
        .select("doc_id", "tag", "start", "size", "later")
    )


def summary(docs: DataFrame) -> DataFrame:
    """``doc_id, n_repeated, n_removed, n_spans``: the documents that share passages with others.

    ``n_repeated`` counts the bytes of all repeated runs, ``n_removed`` and ``n_spans`` those that dedup removes.
    Documents without repeated runs have no row.
    """
    return _per_text(docs).select("doc_id", "n_repeated", "n_removed", "n_spans")


def _per_text(docs: DataFrame) -> DataFrame:
    """The counts of :func:`summary` by ``doc_id, tag``, and the removed ``spans`` in order: as many as a text has at most."""
    size, removed = F.col("size").cast("long"), F.when(F.col("later"), F.struct("start", "size"))
    return repeated_spans(docs).groupBy("doc_id", "tag").agg(
        F.sum(F.when(~F.col("later"), size).otherwise(0)).alias("n_repeated"),
        F.sum(F.when(F.col("later"), size).otherwise(0)).alias("n_removed"),
        F.sum(F.when(F.col("later"), 1).otherwise(0)).cast("long").alias("n_spans"),
        F.array_sort(F.collect_list(removed)).alias("spans"),
    )


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_repeated, n_removed, spans, kept``: every row, with the byte spans dedup removes and the bytes that stay.

    NULL and empty texts lose nothing, nor do rows that come twice with one ``doc_id`` and text lose it to each other.
    """
    source = texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in slices(batches):
            whole = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            tags = [xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in whole]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(tags, pa.int64()), pa.array([len(t) for t in whole], pa.int64()),
                    pa.array([codec.compress(t, asbytes=True) for t in whole], pa.binary()),
                ],
                ["doc_id", "tag", "n_bytes", "packed"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches):
            start, held, spans, kept = 0, 0, [], []
            for i, (size, small, found) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n_bytes", "packed", "spans")))):
                data = codec.decompress(small, size, asbytes=True) if size else b""
                gone = [(s["start"], s["start"] + s["size"]) for s in found or []]
                edges = [0, *(x for s in gone for x in s), len(data)]
                spans.append([{"start": a, "end": b} for a, b in gone])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                held += len(kept[-1])
                if held >= UNPACKED or i + 1 == batch.num_rows:  # texts may have been packed a thousandfold
                    rows = batch.slice(start, len(kept))
                    yield pa.RecordBatch.from_arrays(
                        [*(rows.column(c) for c in ("doc_id", "n_bytes", "n_repeated", "n_removed")), pa.array(spans, span), pa.array(kept, pa.binary())],
                        ["doc_id", "n_bytes", "n_repeated", "n_removed", "spans", "kept"],
                    )
                    start, held, spans, kept = i + 1, 0, [], []

    # Every text meets its spans: a shuffle of the whole table, packed for it.
    rows = source.mapInArrow(packed, f"doc_id {kind}, tag long, n_bytes long, packed binary").alias("t")
    joined = rows.join(_per_text(docs).alias("f"), F.expr("t.doc_id <=> f.doc_id AND t.tag = f.tag"), "left")
    none = F.lit(0).cast("long")
    return joined.select(
        "t.doc_id", "t.n_bytes", "t.packed", F.coalesce("n_repeated", none).alias("n_repeated"), F.coalesce("n_removed", none).alias("n_removed"), "spans"
    ).mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_repeated long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")
