"""Bounded samples of labelled rows, and the folds that keep some labels from the models."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.shared import stored, texts


def remainder(folds: int) -> Column:
    """crc32 of ``doc_id`` as text, modulo ``folds`` (a row without ``doc_id`` counts as the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


def thinned(rows: DataFrame, count: int, limit: int, salt: str) -> DataFrame:
    """About ``limit`` of ``count`` rows, drawn by a hash of ``doc_id``; all of them if there are fewer."""
    if count <= limit:
        return rows
    h = F.xxhash64(F.lit(salt), "doc_id")
    # 63 bits, the lowest 20 first, so that no table is large enough for a threshold of 0
    place = F.shiftleft(h.bitwiseAND(F.lit((1 << 20) - 1)), 43).bitwiseOR(F.shiftrightunsigned(h, 21))
    return rows.where(place < F.lit((limit << 63) // count))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the smallest hash of a text's three-word shingles, which copies and most near copies share."""
    for batch in batches:
        marks = []
        for text in batch.column("text").to_pylist():
            w = text.split()
            grams = zip(w, w[1:], w[2:]) if len(w) > 2 else [w]
            marks.append(min(xxhash.xxh64_intdigest(" ".join(g).encode("utf-8", "surrogatepass")) for g in grams) - (1 << 63))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], [*batch.schema.names, "mark"])


def distinct(rows: DataFrame, *within: str) -> DataFrame:
    """One row of each group of near copies; only equal values of the columns ``within`` make copies."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_signed, f"{fields}, mark long").dropDuplicates([*within, "mark"]).drop("mark")


def labelled(docs: DataFrame, labels: DataFrame, column: str, folds: int, held_out: int, limit: int) -> tuple[DataFrame, dict]:
    """Texts of at most about ``limit`` rows of each class with their ``label``, held-out rows left out; and the class counts.

    The sampled ids are few whatever the size of the tables, so they are broadcast and the documents stay in place.
    Near copies within a class count once, so that a large group of them teaches no more than one text. A document labelled
    twice counts with its higher label.
    """
    known = (
        labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (remainder(folds) != held_out))
        .groupBy("doc_id").agg((F.max(column) > 0).cast("int").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ids = known.where("false")
    for c, n in counts.items():
        ids = ids.unionByName(thinned(known.where(F.col("label") == c), n, limit, f"label {c}"))
    rows = texts(docs).join(F.broadcast(ids), "doc_id").select("text", "label")
    rows = stored(distinct(rows, "label"), "labelled")
    return rows, {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
