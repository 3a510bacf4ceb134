"""SimHash near-duplicates: tiles of fingerprints compared exactly.

1. Each text gets a 64-bit fingerprint: the majority vote, bit by bit, of the hashes of its word shingles.
2. Equal fingerprints collapse to one row (its smallest ``doc_id``), so a large group of copies is one point.
3. The points are put into cells by the population counts of equal words of the fingerprint. Two cells are compared only if
   these counts differ by no more than the radius allows; cells are cut into blocks of ``BLOCK`` points, and every pair of
   blocks is one tile: numpy exclusive-or and bit counts. The more points there are, the shorter the words and the more the
   cells, so a cell stays about a block and a point meets a bounded number of tiles whatever the size of the table.
4. A tile hands on a spanning set of its links, never all pairs; components follow from the links.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import blocks_by_key, lanes, slices, stored, texts

#: Points of a block. A cell of up to this many is compared as one tile; guests of a block come in parts of ``PART``.
BLOCK, PART = 1 << 14, 2048
#: Words a fingerprint is cut into for its cell, with about how many points (over ``BLOCK``) each choice spreads over the cells:
#: the entropy of the words' population counts in random fingerprints is 12, 20 and 32 bits.
WORDS = ((4, 1 << 12), (8, 1 << 20), (16, 1 << 32))
SEED = 42


def shingles(text: str, words: int) -> list[bytes]:
    """Word shingles of a text with A-Z lower-cased; fewer words make one shingle, no words none."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if len(w) <= words:
        return [b" ".join(w)] if w else []
    return list(map(b" ".join, zip(*(w[i:] for i in range(words)))))


def _majority(h: np.ndarray) -> int:
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        bits = np.unpackbits(h[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: str, words: int) -> int:
    """The fingerprint of a text (zero without words)."""
    grams, digest = shingles(text, words), xxhash.xxh64_intdigest
    return _majority(np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(grams))) if grams else 0


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, tag, f0`` for every row; ``tag`` is a hash of the text. NULL and blank texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made)], ["doc_id", "tag", "f0"])

    source = texts(docs).withColumn("tag", F.xxhash64("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, tag long, f0 long")


def _neighbours(width: int, radius: int) -> list[tuple[int, ...]]:
    """Steps between population-count vectors that at most ``radius`` differing bits can cause, one of each +/- pair."""
    found = set()
    for n in range(1, radius + 1):
        for places in itertools.combinations_with_replacement(range(width), n):
            for signs in itertools.product((1, -1), repeat=n):
                step = [0] * width
                for p, sign in zip(places, signs):
                    step[p] += sign
                found.add(tuple(step))
    return sorted(s for s in found if s > (0,) * width)


def _cells(points: DataFrame, words: int, radius: int) -> tuple[DataFrame, list[int]]:
    """Cell: the population counts of ``words`` equal words, each a digit; and the steps to the cells beside it.

    A step that leaves the range of a digit only leads to a cell where nothing is near.
    """
    width = 64 // words
    digit = 3 if words == 16 else 5  # counts up to 4, 8 or 16
    mask = F.lit((1 << width) - 1)
    cell = sum(
        (F.shiftleft(F.bit_count(F.shiftrightunsigned("f0", width * i).bitwiseAND(mask)).cast("long"), digit * i) for i in range(words)),
        F.lit(0).cast("long"),
    )
    steps = {sum(d << (digit * i) for i, d in enumerate(s)) for s in _neighbours(words, radius)}
    return points.withColumn("cell", cell), sorted(steps - {0})


def _tiles(radius: int):
    """Compare the tiles of a stream sorted by cell, block and role: first a block's own points, then its visitors."""

    def points(cols, keep=slice(None)):
        w = cols["f0"][keep].astype(np.int64).view(np.uint64)
        c = np.bitwise_count(w).astype(np.int64)
        order = np.argsort(c, kind="stable")
        return {"w": w[order], "id": cols["rep"][keep][order], "c": c[order]}

    def links(own, other, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near pairs; runs of points whose population counts rule all of them out are skipped."""
        for i in range(0, len(own["id"]), 256):
            a = {k: v[i:i + 256] for k, v in own.items()}
            lo, hi = np.searchsorted(other["c"], [a["c"][0] - radius, a["c"][-1] + radius + 1])
            lo = max(lo, i) if same else lo
            for at in range(lo, hi, PART):
                part = slice(at, min(at + PART, hi))
                b = {k: v[part] for k, v in other.items()}
                near = np.bitwise_count(a["w"][:, None] ^ b["w"][None, :]) <= radius
                first, has = near.argmax(axis=0), near.any(axis=0)
                yield a["id"][first[has]], b["id"][has]
                rows, cols = np.nonzero(near)
                merge = np.unique(rows * 256 + first[cols])
                yield a["id"][merge // 256], a["id"][merge % 256]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, own = [], None

        def found(other, same):
            tree: dict[int, int] = {}

            def root(x):
                while tree.setdefault(x, x) != x:
                    tree[x] = tree[tree[x]]
                    x = tree[x]
                return x

            out = []
            for a, b in links(own, other, same):
                apart = a != b
                for x, y in zip(a[apart].tolist(), b[apart].tolist()):
                    p, q = root(x), root(y)
                    if p != q:
                        tree[max(p, q)] = min(p, q)
                        out.append((x, y))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"]
                )

        def closed():
            nonlocal own, mine
            if mine:
                own = points({k: np.concatenate([m[k] for m in mine]) for k in mine[0]})
                mine = []
                yield from found(own, True)

        for fresh, cols in blocks_by_key(batches, ["cell", "block"]):
            if fresh:
                yield from closed()
                own = None
            role = cols["role"]
            if (role == 0).any():
                mine.append({k: v[role == 0] for k, v in cols.items()})
            guests = np.flatnonzero(role == 1)
            if len(guests):
                yield from closed()
                for at in range(0, len(guests), PART) if own is not None else ():
                    yield from found(points(cols, guests[at:at + PART]), False)
        yield from closed()

    return run


def near_links(points: DataFrame, radius: int, words: int | None = None) -> DataFrame:
    """Links ``(a, b)`` between points ``(rep, f0)`` within ``radius`` bits, enough to connect all that are linked.

    ``words`` fixes the words per cell; by default the number of points decides.
    """
    spark = points.sparkSession
    if words is None:
        n = points.count()
        words = next((w for w, room in WORDS if n <= room * BLOCK), WORDS[-1][0])
    celled, steps = _cells(points, words, radius)
    sizes = celled.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    at = F.pmod(F.xxhash64(F.lit("block"), "f0"), "blocks").alias("block")
    own = celled.join(sizes, "cell").select("cell", at, "rep", "f0", "blocks")
    beside = (
        celled.withColumn("cell", F.explode(F.array(*[F.col("cell") + F.lit(s) for s in steps])))
        .join(sizes, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "rep", "f0")
    )
    within = own.where("block + 1 < blocks").select(
        "cell", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)).alias("block"), "rep", "f0"
    )
    rows = own.drop("blocks").withColumn("role", F.lit(0)).unionByName(
        beside.unionByName(within).withColumn("role", F.lit(1))
    )
    rows = rows.withColumn("block", F.col("block").cast("long"))
    return (
        rows.repartition(lanes(spark), "cell", "block").sortWithinPartitions("cell", "block", "role")
        .mapInArrow(_tiles(radius), "a long, b long")
    )


def _grouped(docs: DataFrame, words: int, radius: int) -> DataFrame:
    """The prints of every row with ``low``: the smallest ``doc_id`` of its group, and the smallest ``tag`` under it."""
    prints = stored(fingerprints(docs, words), "fingerprints")
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "tag"))
    classes = stored(
        prints.groupBy("f0").agg(F.min(row).alias("low")).withColumn("rep", F.monotonically_increasing_id()), "classes"
    )
    groups = components(near_links(classes.select("rep", "f0"), radius))
    lowest = (
        groups.join(classes, groups["node"] == classes["rep"]).groupBy("component").agg(F.min("low").alias("lowest"))
        .repartition(lanes(docs.sparkSession))
    )
    linked = groups.join(lowest, "component").select("node", "lowest")
    named = classes.join(linked, classes["rep"] == linked["node"], "left").select("f0", F.coalesce("lowest", "low").alias("low"))
    return prints.join(named, "f0")


#: Shingle length and bits that may differ: those of the contract.
SHINGLE, RADIUS = 3, 2


def near_duplicates(docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, f0, component_id`` for every row of ``docs``.

    Fingerprints at ``radius`` or fewer differing bits are linked; ``component_id`` is the smallest ``doc_id`` reachable, itself
    included. Texts without words (NULL, empty, blank) have fingerprint zero and are linked like any other; a very long text has
    one fingerprint like any other. Rows without ``doc_id`` keep their row; their component is the smallest ``doc_id`` of its
    group, or NULL if none has one. Repeated rows each keep their row. No rows, no result.
    """
    return _grouped(docs, words, radius).select("doc_id", "f0", F.col("low.doc_id").alias("component_id"))


def first_of_each_group(docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, one of each group of ``near_duplicates``: that with the smallest ``doc_id``, and of several texts
    under it that with the smallest hash.

    Equal texts repeated under one ``doc_id`` count as copies; rows without ``doc_id`` are kept. All columns stay as they are.
    """
    groups = _grouped(docs, words, radius)
    kept = stored(
        groups.where("doc_id = low.doc_id AND tag = low.tag")
        .groupBy(F.col("doc_id").alias("kept_id"), F.col("tag").alias("kept_tag")).agg(F.count("*").alias("rows")), "kept"
    )
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    same = (F.col("doc_id") == F.col("kept_id")) & (tag == F.col("kept_tag"))
    # the same join at every size: one shuffle of the documents
    named = docs.hint("merge").join(kept.drop("rows"), same, "left_semi")
    again = kept.where("rows > 1").drop("rows")
    nameless = docs.where("doc_id IS NULL")
    if again.isEmpty():
        return named.unionByName(nameless)
    repeated = named.join(again, same, "left_semi").withColumn("kept_tag", tag).dropDuplicates(["doc_id", "kept_tag"]).drop("kept_tag")
    return named.join(again, same, "left_anti").unionByName(repeated).unionByName(nameless)
