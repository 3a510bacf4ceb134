"""Byte-level BPE: overlapping chunks pre-tokenised in parallel, stitched where their boundaries meet, then encoded.

A text of more than ``CHUNK`` characters is cut into chunks that reach ``OVERLAP`` characters into the next one, and
the chunks are dealt over the cluster. Each is pre-tokenised from its own start. Two sequences of pre-tokens that share
one boundary agree from there on (no alternative of the pattern looks back), so chunk ``k`` holds from the first boundary
it shares with chunk ``k - 1`` up to the first that chunk ``k + 1`` shares with it. The ends of a chunk, where its view is
cut off, are not trusted. Should two chunks share none inside the overlap (one run of blanks or letters longer than it),
the text is encoded as a whole. Shorter texts are one chunk and stay where they are.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shared import lanes, slices, texts

CHUNK, OVERLAP = 1 << 15, 1 << 10
KEEP, LONG = 300_000, 48


class Coder:
    """The library's encoder for a rank file, the pre-tokeniser and the bytes of every id."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines]
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in pairs}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode_ordinary(text), "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        """The ids of one pre-token; a bounded number of short ones is remembered."""
        found = self.pieces.get(piece)
        if found is None:
            found = self.whole(piece)
            if len(piece) <= LONG and len(self.pieces) < KEEP:
                self.pieces[piece] = found
        return found

    def boundaries(self, text: str, start: int = 0) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text, start)]

    def decode(self, ids: bytes) -> bytes:
        return self.library.decode_bytes(np.frombuffer(ids, "<u4").tolist())


@lru_cache(2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def encode_chunk(code: Coder, view: str, last: bool, chunk: int = CHUNK) -> dict:
    """Ids of a chunk's pre-tokens up to where the next chunk takes over.

    ``stop`` is the boundary shared with the next chunk, counted from its start (-1: none inside the overlap);
    ``heads`` and ``sizes`` are the first boundaries and the ids before each, where the chunk before may cut.
    """
    starts = code.boundaries(view)
    stop = len(view)
    if not last:
        trusted = starts[:-2]
        following = set(code.boundaries(view[chunk:])[:-2])
        stop = next((s for s in trusted if s >= chunk and s - chunk in following), -1)
    ends = [*starts[1:], len(view)]
    ids, heads, sizes, size = [], [], [], 0
    for a, b in zip(starts, ends):
        if stop >= 0 and a >= stop:
            break
        if a <= OVERLAP:
            heads.append(a)
            sizes.append(size)
        ids.append(code.piece(view[a:b]))
        size += len(ids[-1])
    return {"stop": stop - chunk if stop >= 0 and not last else -1 if not last else 0, "ids": b"".join(ids),
            "heads": np.array(heads, "<i4").tobytes(), "sizes": np.array(sizes, "<i8").tobytes()}


def stitch(code: Coder, chunks: list[dict]) -> bytes:
    """Join the chunks of a text at their shared boundaries; without one, encode the text as a whole."""
    out, start = [], 0
    for c in chunks:
        at = np.searchsorted(np.frombuffer(c["heads"], "<i4"), start)
        heads, sizes = np.frombuffer(c["heads"], "<i4"), np.frombuffer(c["sizes"], "<i8")
        cut = int(sizes[at]) if at < len(heads) and heads[at] == start else None
        if cut is None or c["stop"] < 0:
            return code.whole("".join(x["core"] for x in chunks))
        out.append(c["ids"][cut:])
        start = c["stop"]
    return b"".join(out)


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) for every row.

    NULL and empty texts have no ids. Rows without ``doc_id`` and repeated rows each keep their row; an empty table
    gives an empty result.
    """
    source = texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        for batch in slices(batches):
            ids = [code.whole(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        for batch in slices(batches, rows=64):
            views, lasts = batch.column("view").to_pylist(), batch.column("last").to_pylist()
            made = [encode_chunk(code, v, last, chunk) for v, last in zip(views, lasts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("k"),
                    pa.array([v[:chunk] for v in views]), pa.array([m["stop"] for m in made], pa.int32()),
                    *(pa.array([m[c] for m in made], pa.binary()) for c in ("heads", "sizes", "ids")),
                ],
                ["key", "k", "core", "stop", "heads", "sizes", "ids"],
            )

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        chunks = rows.sort_values("k").to_dict("records")
        return pd.DataFrame({"key": [chunks[0]["key"]], "ids": [stitch(coder(path, pattern), chunks)]})

    size = F.char_length("text")
    long = source.where(size > chunk).withColumn("key", F.sha2("text", 256))
    last = F.floor((size - 1) / chunk).cast("int")
    views = long.select("key", "text", F.explode(F.sequence(F.lit(0), last)).alias("k"), last.alias("end")).select(
        "key", "k", (F.col("k") == F.col("end")).alias("last"), F.substring("text", F.col("k") * chunk + 1, F.lit(chunk + OVERLAP)).alias("view"),
    )
    # A text that many rows share is cut and encoded once; tasks combine its chunks before they are shuffled.
    distinct = views.groupBy("key", "k").agg(F.first("last").alias("last"), F.first("view").alias("view"))
    made = (
        distinct.mapInArrow(part, "key string, k int, core string, stop int, heads binary, sizes binary, ids binary")
        .groupBy("key").applyInPandas(join, "key string, ids binary")
    )
    joined = long.select("doc_id", "key").join(made, "key").select("doc_id", "ids")
    return source.where(F.char_length("text") <= chunk).mapInArrow(short, f"doc_id {kind}, ids binary").unionByName(joined)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decoded``, the bytes of the ids in a row, added to every row of ``ids``."""
    schema = encoded.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        for batch in slices(batches):
            decoded = [code.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")
