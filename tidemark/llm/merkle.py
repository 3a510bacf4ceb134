"""Merkle manifest of a table: leaves by language and ``doc_id``, roots, a proof per row.

Leaf coordinates come from bitmaps, not from sorting the rows. Tasks combine the ids of a language into 64-bit words, the
shuffle merges them; every word, and every 2^16, 2^32 and 2^48 words above it, knows how many rows stand before it (a directory
whose groups never exceed 65,536 entries). A row's rank is the directory's count for its word plus the population count of the
word's lower bits. Rows then go to their block of ``ARITY ** DEPTH`` leaves, whose slot array is filled by coordinate and reduced
four levels at a time. Block roots are the nodes of the next layer; proofs come back down the same layers.

A ``doc_id`` that several rows of a language share takes a stretch of ranks, ordered by leaf. Equal rows are counted before
anything is shuffled, and travel as one run of slots, cut at blocks: a hot row, id or language meets no single task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.shared import blocks_by_key, lanes, stored

#: Children of a node, and levels reduced by one task.
ARITY, DEPTH = 8, 4
#: The word of rows without ``doc_id``: before all others.
NAMELESS = -(1 << 57) - 1
DIGIT = 16

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """The digest of a row whose text is ``text``, as 32 bytes."""
    parts = [_field(text if c == "text" else F.col(c)) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def lowered(text: Column) -> Column:
    """A to Z in lower case, nothing else changed: what tampering does."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text.cast("string"), upper, upper.lower())


def tampered() -> Column:
    """Rows whose text is tampered with: 3 divides the crc32 of ``doc_id`` as text (never without ``doc_id``)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


# Coordinates ------------------------------------------------------------------


def entries(docs: DataFrame) -> DataFrame:
    """``g, word, bit, doc_id, leaf, altered, n``: each distinct row with its number of copies.

    ``g`` names the language (empty: NULL) and sorts as the languages do; ``altered`` is the leaf after tampering.
    """
    leaf = leaf_digest(F.col("text"))
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("g"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"),
        F.when(tampered(), leaf_digest(lowered(F.col("text")))).alias("altered"),
    )
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n")).select(
        "g", F.expr(f"coalesce(shiftright(doc_id, 6), {NAMELESS}L)").alias("word"),
        F.expr("cast(coalesce(doc_id & 63, 0) AS int)").alias("bit"), "doc_id", "leaf", "altered", "n",
    )


def bitmaps(rows: DataFrame) -> DataFrame:
    """``g, word, bits, n, repeated``: a word of ids with its rows; ``repeated`` lists the ids (at most 64) with several rows."""
    ids = rows.groupBy("g", "word", "bit").agg(F.sum("n").alias("n"), F.count("*").alias("leaves"))
    many = F.when(F.col("n") > 1, F.struct("bit", "n", "leaves"))
    return ids.groupBy("g", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.sum("n").alias("n"), F.collect_list(many).alias("repeated")
    )


def directory(words: DataFrame) -> DataFrame:
    """``g, word, before``: the rows of smaller words of the same language.

    Each level counts within its parent only, in groups of at most 65,536 entries whatever the ids are.
    """
    levels = [words.select("g", F.col("word").alias("key"), "n")]
    for _ in range(3):
        up = F.shiftright("key", DIGIT)
        levels.append(levels[-1].groupBy("g", up.alias("key")).agg(F.sum("n").alias("n")))
    found = None
    for n, level in enumerate(reversed(levels)):
        parent = F.shiftright("key", DIGIT) if n else F.lit(0)
        level = level.withColumn("parent", parent)
        order = Window.partitionBy("g", "parent").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
        if found is not None:
            above = found.select("g", F.col("key").alias("parent"), F.col("before").alias("above"))
            level = level.join(above, ["g", "parent"]).withColumn("before", F.col("before") + F.col("above"))
        found = level.select("g", "key", "before")
    return found.withColumnRenamed("key", "word")


def coordinates(rows: DataFrame, words: DataFrame) -> DataFrame:
    """The rows with ``start``, the coordinate of their first copy: a rank query on the bitmaps."""
    ranked = words.select("g", "word", "bits", "repeated").join(directory(words), ["g", "word"])
    rank = (
        "before + bit_count(bits & ~shiftleft(-1L, bit))"
        " + aggregate(filter(repeated, r -> r.bit < bit), 0L, (a, r) -> a + r.n - 1)"
    )
    placed = rows.join(ranked, ["g", "word"]).select(
        *rows.columns, F.expr(rank).alias("start"), F.expr("exists(repeated, r -> r.bit = bit AND r.leaves > 1)").alias("shared")
    )
    placed = stored(placed, "ranks")
    # Different rows under one id: counted by the first 16 bits of the leaf, then within them.
    key = ["g", "word", "bit"]
    several = placed.where("shared").withColumn("part", F.substring("leaf", 1, 2))
    parts = several.groupBy(*key, "part").agg(F.sum("n").alias("rows"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("outer", F.coalesce(F.sum("rows").over(before.partitionBy(*key).orderBy("part")), F.lit(0)))
    inner = F.coalesce(F.sum("n").over(before.partitionBy(*key, "part").orderBy("leaf")), F.lit(0))
    several = several.withColumn("inner", inner).join(parts.drop("rows"), [*key, "part"])
    several = several.withColumn("start", F.col("start") + F.col("outer") + F.col("inner"))
    return placed.where("NOT shared").drop("shared").unionByName(several.select(*rows.columns, "start"))


# Layers -----------------------------------------------------------------------


def _levels(nodes: list[bytes], total: int, block: int) -> list[list[bytes]]:
    """The levels above a block's ``nodes`` (hex digests), themselves first, up to a single one.

    In a layer of more nodes than a block holds, a block's root stands as high as those of the full blocks.
    """
    made, width = [nodes], min(total, block)
    while width > 1:
        width = -(-width // ARITY)
        last = made[-1]
        made.append([sha256(b"".join(last[i:i + ARITY])).hexdigest().encode() for i in range(0, len(last), ARITY)])
    return made


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[str, int, int, list, dict | None]]:
    """``g, block, total, slots, above`` of each block in a stream sorted by them.

    A slot holds ``(digest, altered, doc_id)``; ``above`` is the row that came down from the layer above, if any.
    """
    state = None
    for fresh, cols in blocks_by_key(batches, ["g", "block"]):
        if fresh:
            if state:
                yield state
            total, at = int(cols["total"][0]), int(cols["block"][0])
            state = (cols["g"][0], at, total, [None] * min(block, total - at * block), None)
        names = [c for c in ("role", "slot", "n", "leaf", "altered", "doc_id", "above", "subroot") if c in cols]
        for row in zip(*(cols[c].tolist() for c in names)):
            r = dict(zip(names, row))
            if r.get("role") == 0:
                state = (*state[:4], r)
            else:
                node = (r["leaf"].hex().encode(), r["altered"].hex().encode() if r.get("altered") else None, r.get("doc_id"))
                state[3][r["slot"]:r["slot"] + r["n"]] = [node] * r["n"]
    if state:
        yield state


def _reduce(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, at, total, slots, _ in _blocks(batches, block):
            top = _levels([s[0] for s in slots], total, block)[-1][0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g]), pa.array([at], pa.int64()), pa.array([total], pa.int64()), pa.array([bytes.fromhex(top.decode())], pa.binary())],
                ["g", "block", "total", "root"],
            )

    return run


def _grouped(rows: DataFrame, *order: str) -> DataFrame:
    keys = ["g", "block"]
    return rows.repartition(lanes(rows.sparkSession), *keys).sortWithinPartitions(*keys, *order)


def _climb(nodes: DataFrame, block: int) -> tuple[list[DataFrame], DataFrame]:
    """The layers above ``nodes(g, block, slot, n, total, leaf)``, themselves first, and the root of each ``g``."""
    layers = [nodes]
    while True:
        wide = layers[-1].agg(F.max("total")).first()[0]
        rows = layers[-1].select("g", "block", "slot", "n", "total", "leaf")
        roots = stored(_grouped(rows).mapInArrow(_reduce(block), "g string, block long, total long, root binary"), "roots")
        if wide is None or wide <= block:
            return layers, roots.select("g", F.col("root").alias("leaf"))
        layers.append(roots.select(
            "g", F.expr(f"block div {block}").alias("block"), (F.col("block") % block).cast("int").alias("slot"), F.lit(1).alias("n"),
            F.ceil(F.col("total") / block).cast("long").alias("total"), F.col("root").alias("leaf"),
        ))


def _steps(levels: list[list[bytes]], slot: int) -> Iterator[tuple[int, list[bytes]]]:
    """Up from a slot: its place in its run of siblings, and the run, level by level."""
    for nodes in levels[:-1]:
        run = slot // ARITY
        yield slot % ARITY, nodes[run * ARITY:run * ARITY + ARITY]
        slot = run


def _pack(steps) -> bytes:
    """Steps as bytes: place, number of siblings, siblings."""
    return b"".join(
        bytes([at, len(run) - 1]) + bytes.fromhex(b"".join(run[:at] + run[at + 1:]).decode()) for at, run in steps
    )


def _unpack(data: bytes) -> list[tuple[bytes, bytes]]:
    """The siblings to the left and to the right, per step."""
    out, i = [], 0
    while i < len(data):
        at, n = data[i], data[i + 1]
        text = data[i + 2:i + 2 + 32 * n].hex().encode()
        out.append((text[:64 * at], text[64 * at:]))
        i += 2 + 32 * n
    return out


def _descend(block: int):
    """The path of each slot of a layer: its own steps within the block, then those of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, at, total, slots, above in _blocks(batches, block):
            levels = _levels([s[0] for s in slots], total, block)
            paths = [_pack(_steps(levels, i)) + above["above"] for i in range(len(slots))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * len(slots)), pa.array([at * block + i for i in range(len(slots))], pa.int64()),
                 pa.array(paths, pa.binary()), pa.array([above["subroot"]] * len(slots), pa.binary())],
                ["g", "block", "above", "subroot"],
            )

    return run


def _proofs(block: int, root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, at, total, slots, above in _blocks(batches, block):
            levels = _levels([s[0] for s in slots], total, block)
            beyond = _unpack(above["above"])
            out = {c: [] for c in ("doc_id", "leaf", "proof", "folded")}
            for first in range(0, len(slots), ARITY):
                here = slots[first:first + ARITY]
                # what the eight leaves of a run share: every step above their own
                steps = [(b"".join(r[:i]), b"".join(r[i + 1:])) for i, r in _steps(levels, first)][1:] + beyond
                tail = b"".join(a + b for a, b in steps)
                alone = len(levels) == 1
                for i, (leaf, altered, doc_id) in enumerate(here):
                    left = b"" if alone else b"".join(s[0] for s in here[:i])
                    right = b"" if alone else b"".join(s[0] for s in here[i + 1:])
                    node = altered or leaf
                    for a, b in steps if alone else [(left, right), *steps]:
                        node = sha256(a + node + b).hexdigest().encode()
                    out["doc_id"].append(None if doc_id is None else int(doc_id))
                    out["leaf"].append(leaf.decode())
                    out["proof"].append(sha256(left + right + tail).hexdigest())
                    out["folded"].append(node.decode())
            n = len(slots)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["leaf"]), pa.array([above["subroot"].hex()] * n), pa.array([root] * n),
                 pa.array(out["proof"]), pa.array(out["folded"]), pa.array([f == root for f in out["folded"]])],
                MANIFEST_COLUMNS,
            )

    return run


MANIFEST_COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
MANIFEST = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, a row per document.

    NULL fields count as ``-``; the NULL language is a group of its own, before all others. Rows without ``doc_id`` stand before
    all others of their language and are not tampered with. Rows that share a ``doc_id`` stand in the order of their leaves; equal
    rows are each a leaf. Very long texts are hashed in place and never leave their row. An empty table gives no rows, further
    columns are not looked at. Languages are numbered in one small window, as there is one row per language.
    """
    spark = docs.sparkSession
    block = ARITY ** depth
    rows = stored(entries(docs), "leaves")
    words = stored(bitmaps(rows), "bitmaps")
    groups = stored(words.groupBy("g").agg(F.sum("n").alias("total")), "languages")
    count = groups.count()
    if not count:
        return spark.createDataFrame([], MANIFEST)
    end = F.col("start") + F.col("n")
    runs = coordinates(rows, words).join(groups, "g").withColumn(
        "block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + n - 1) div {block}")))
    )
    origin = F.col("block") * block
    leaves = stored(runs.select(
        "g", "block", (F.greatest("start", origin) - origin).cast("int").alias("slot"),
        (F.least(end, origin + block) - F.greatest("start", origin)).cast("int").alias("n"), "total", "leaf", "altered",
        F.col("doc_id").cast("string").alias("doc_id"),  # text: NULLs beside numbers would make doubles of them
    ), "slots")
    layers, subroots = _climb(leaves, block)
    place = F.row_number().over(Window.orderBy("g")).cast("long") - 1
    tops = stored(subroots.select(F.col("g").alias("lang_group"), place.alias("place"), "leaf"), "subroots")
    nodes = tops.select(
        F.lit("").alias("g"), F.expr(f"place div {block}").alias("block"), (F.col("place") % block).cast("int").alias("slot"),
        F.lit(1).alias("n"), F.lit(count).cast("long").alias("total"), "leaf",
    )
    upper, roots = _climb(nodes, block)
    root = roots.first()["leaf"].hex()
    start = spark.createDataFrame([("", 0, b"", b"")], "g string, block long, above binary, subroot binary")
    paths = _down(upper, start, block)
    paths = paths.join(tops, paths["block"] == tops["place"]).select(
        F.col("lang_group").alias("g"), F.lit(0).cast("long").alias("block"), "above", F.col("leaf").alias("subroot")
    )
    paths = _down(layers[1:], paths, block)
    return _with_paths(leaves, paths).mapInArrow(_proofs(block, root), MANIFEST)


def _down(layers: list[DataFrame], paths: DataFrame, block: int) -> DataFrame:
    """Paths of the nodes of the lowest of ``layers``, from those of the blocks of the highest."""
    for layer in reversed(layers):
        made = _with_paths(layer, paths).mapInArrow(_descend(block), "g string, block long, above binary, subroot binary")
        paths = stored(made, "paths")
    return paths


def _with_paths(layer: DataFrame, paths: DataFrame) -> DataFrame:
    """Each block's path, then its nodes, in one stream."""
    totals = layer.groupBy("g", "block").agg(F.max("total").alias("total"))
    heads = paths.join(totals, ["g", "block"]).withColumns({"role": F.lit(0), "slot": F.lit(0), "n": F.lit(0)})
    rows = layer.withColumn("role", F.lit(1))
    return _grouped(heads.unionByName(rows, allowMissingColumns=True), "role")
