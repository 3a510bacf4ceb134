"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is built from a bounded sample and indexes every vector. A query walks it with a priority queue, always opening the
node whose centre promises the largest inner product, and so visits leaves in order of promise. How many it visits is
calibrated: the smallest number at which a sample of queries finds ``TARGET`` of its true neighbours, known by brute force.

Leaves are cut into blocks of at most ``BLOCK`` vectors. A query is sent to the blocks of the leaves it visits; within a
block, scores are one matrix product in double precision. A task keeps the best of each of its queries, so what it hands on
does not grow with the leaves. Equal vectors are one entry with its smallest ``k + 1`` ids, as no more can be answers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.samples import thinned
from tidemark.llm.shared import blocks_by_key, lanes, stored

#: Vectors the tree is built from, and queries its visits are calibrated on: bounds, whatever the table.
SAMPLE, CALIBRATION = 60_000, 256
TARGET = 0.95
BRANCHES, LEAVES, BLOCK, KEPT = 8, 4096, 4096, 50_000


@dataclass
class Tree:
    """Nodes in order of creation; ``children`` of a leaf is empty, ``leaf`` its number (-1 for inner nodes)."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down the nearest centres."""
        out = np.zeros(len(x), np.int32)
        open_ = [(0, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            c = self.centres[below]
            nearest = ((c * c).sum(axis=1) - 2 * x[rows] @ c.T).argmin(axis=1)
            open_ += [(n, rows[nearest == i]) for i, n in enumerate(below) if (nearest == i).any()]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in the order of a best-bin-first walk."""
        promise = self.centres @ query
        queue = [(-promise[0], 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for n in self.children[node]:
                    heapq.heappush(queue, (-promise[n], n))
            else:
                yield int(self.leaf[node])


def build(x: np.ndarray, leaves: int, seed: int = 5) -> Tree:
    """Split the largest cells by k-means until there are about ``leaves``; a cell of equal vectors stays whole."""
    rng = np.random.default_rng(seed)
    centres, children = [x.mean(axis=0)], [[]]
    queue = [(-len(x), 0, np.arange(len(x)))]
    count = 1
    while queue and count < leaves:
        _, node, rows = heapq.heappop(queue)
        k = min(BRANCHES, leaves - count + 1, len(rows))
        parts = _split(x[rows], k, rng) if k > 1 else []
        if len(parts) < 2:
            continue
        for part in parts:
            child = len(centres)
            centres.append(x[rows[part]].mean(axis=0))
            children.append([])
            children[node].append(child)
            heapq.heappush(queue, (-len(part), child, rows[part]))
        count += len(parts) - 1
    leaf = np.full(len(centres), -1)
    ends = [n for n, c in enumerate(children) if not c]
    leaf[ends] = np.arange(len(ends))
    return Tree(np.array(centres), children, leaf)


def _split(x: np.ndarray, k: int, rng) -> list[np.ndarray]:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(8):
        nearest = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        c = np.stack([x[nearest == i].mean(axis=0) if (nearest == i).any() else c[i] for i in range(k)])
    return [p for p in (np.flatnonzero(nearest == i) for i in range(k)) if len(p)]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def usable(table: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part.

    NULL and zero vectors, and those holding NULL or non-finite components, take no part; nor do rows without ``vec_id`` or
    vectors of another length than most.
    """
    e = F.col("embedding")
    sound = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    rows = table.select("vec_id", e.cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL").where(sound)
    size = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (size["d"] if size else 0))


def _packed(rows: DataFrame, name: str, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = [np.array(v, "<f8").tobytes() for v in b.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(name), pa.array(vec, pa.binary())], [name, "vec"])

    return rows.select(name, "embedding").mapInArrow(run, f"{name} {kind}, vec binary")


def entries(rows: DataFrame, k: int) -> DataFrame:
    """``ids, vec``: each distinct vector once with its smallest ``k + 1`` ids."""
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.distinct().withColumn("rank", rank).where(F.col("rank") <= k + 1)
    few = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return _packed(few, "ids", "array<long>")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties by smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _truth(queries: list[tuple[int, bytes]], k: int):
    """True neighbours of a few queries, as each task sees them, with the leaves that hold them."""
    own = np.array([q for q, _ in queries])
    q = np.frombuffer(b"".join(v for _, v in queries), "<f8").reshape(len(queries), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            leaf, first = b.column("leaf").to_numpy(), np.array([i[0] for i in b.column("ids").to_pylist()])
            scores = q @ _matrix(b.column("vec")).T
            rows = [(n, p) for n in range(len(q)) for p in _best(scores[n], first, k + 1) if first[p] != own[n]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([scores[r] for r in rows], pa.float64()),
                 pa.array([int(first[p]) for _, p in rows], pa.int64()), pa.array([int(leaf[p]) for _, p in rows], pa.int32())],
                ["query", "score", "id", "leaf"],
            )

    return run


def calibrate(indexed: DataFrame, tree: Tree, k: int) -> int:
    """The smallest number of visits at which a sample of queries finds ``TARGET`` of its neighbours."""
    n = indexed.count()
    drawn = thinned(indexed.select(F.element_at("ids", 1).alias("doc_id"), "vec"), n, CALIBRATION, "calibration")
    queries = [(r[0], bytes(r[1])) for r in drawn.collect()]
    if not queries and n:
        raise ValueError(f"no queries to calibrate with, of {n} vectors")
    near = indexed.mapInArrow(_truth(queries, k), "query int, score double, id long, leaf int")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    truth = near.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "leaf").collect()
    orders = [{leaf: i for i, leaf in enumerate(tree.visits(np.frombuffer(v, "<f8")))} for _, v in queries]
    needed = np.sort([orders[r["query"]][r["leaf"]] + 1 for r in truth])
    return int(needed[max(int(np.ceil(TARGET * len(needed))) - 1, 0)]) if len(needed) else 1


def _searched(k: int):
    """Best answers per query in a stream sorted by leaf, block and role: a block's vectors, then the queries that visit it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        mine: list[dict] = []
        block = None

        def flushed() -> pa.RecordBatch:
            sizes = [len(s) for s, _ in best.values()]
            ids = np.concatenate([i for _, i in best.values()]) if best else np.zeros(0, np.int64)
            scores = np.concatenate([s for s, _ in best.values()]) if best else np.zeros(0)
            out = [pa.array(np.repeat(np.array(list(best), np.int64), sizes)), pa.array(ids), pa.array(scores)]
            best.clear()
            return pa.RecordBatch.from_arrays(out, ["query_id", "vec_id", "score"])

        for fresh, cols in blocks_by_key(batches, ["leaf", "block"]):
            if fresh:
                mine, block = [], None
            vectors_, guests = (np.flatnonzero(cols["role"] == r) for r in (0, 1))
            if len(vectors_):
                mine.append({c: cols[c][vectors_] for c in ("ids", "vec")})
            if not len(guests) or not (mine or block):
                continue
            if block is None or len(vectors_):
                ids = [i for m in mine for i in m["ids"]]
                x = np.frombuffer(b"".join(v for m in mine for v in m["vec"]), "<f8").reshape(len(ids), -1)
                member = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
                block = x, np.concatenate([np.asarray(i, np.int64) for i in ids]), member
            x, ids, member = block
            for at in range(0, len(guests), 512):
                part = guests[at:at + 512]
                q = np.frombuffer(b"".join(cols["vec"][part]), "<f8").reshape(len(part), -1)
                scores = (q @ x.T)[:, member]
                for row, query in zip(scores, cols["query_id"][part].astype(np.int64).tolist()):
                    places = _best(row, ids, k + 1)
                    places = places[ids[places] != query][:k]
                    s, i = row[places], ids[places]
                    if query in best:
                        s, i = np.concatenate([best[query][0], s]), np.concatenate([best[query][1], i])
                        keep = _best(s, i, k)
                        s, i = s[keep], i[keep]
                    best[query] = s, i
                if len(best) > KEPT:
                    yield flushed()
        yield flushed()

    return run


def search(table: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose ``vec_id`` is divisible by ``every``, the ``k`` rows of
    largest inner product found, nearest first, ties to the smaller ``vec_id``; all others if there are fewer.

    Rows repeated under one ``vec_id`` with equal vectors count once; with different vectors, each is indexed and each asks.
    An empty table, or one without usable vectors, gives no rows.
    """
    spark = table.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(table)
    distinct = stored(entries(rows, k), "vectors")
    n = distinct.count()
    if not n:
        return spark.createDataFrame([], schema)
    sample = thinned(distinct.select(F.element_at("ids", 1).alias("doc_id"), "vec"), n, SAMPLE, "tree").orderBy("doc_id").collect()
    x = np.frombuffer(b"".join(bytes(r["vec"]) for r in sample), "<f8").reshape(len(sample), -1)
    tree = build(x, int(np.clip(np.sqrt(n) / 4, 1, min(LEAVES, max(len(x) // 12, 1)))))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.assign(_matrix(b.column("vec"))), pa.int32())], ["ids", "vec", "leaf"])

    indexed = stored(distinct.mapInArrow(assigned, "ids array<long>, vec binary, leaf int"), "leaves")
    visits = calibrate(indexed, tree, k)
    sizes = {r["leaf"]: (r["entries"], r["rows"]) for r in indexed.groupBy("leaf").agg(F.count("*").alias("entries"), F.sum(F.size("ids")).alias("rows")).collect()}
    blocks = {leaf: -(-entries // BLOCK) for leaf, (entries, _) in sizes.items()}

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query once for every block of the leaves it visits; on, while they hold too few rows for ``k`` answers."""
        for b in batches:
            rows = []
            for query, vec in zip(b.column("query_id").to_pylist(), b.column("vec").to_pylist()):
                seen = held = 0
                for leaf in tree.visits(np.frombuffer(vec, "<f8")):
                    if seen >= visits and held > k:
                        break
                    seen += 1
                    if leaf in sizes:
                        held += sizes[leaf][1]
                        rows += [(query, vec, leaf, block) for block in range(blocks[leaf])]
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "vec", "leaf", "block"])

    per_leaf = F.create_map(*[F.lit(v) for leaf, n_ in blocks.items() if n_ > 1 for v in (leaf, n_)]) if any(b > 1 for b in blocks.values()) else None
    count = F.coalesce(per_leaf[F.col("leaf")], F.lit(1)) if per_leaf is not None else F.lit(1)
    own = indexed.select("leaf", F.pmod(F.xxhash64(F.element_at("ids", 1)), count).cast("long").alias("block"), F.lit(0).alias("role"),
                         F.lit(None).cast("long").alias("query_id"), "ids", "vec")
    asking = rows.where(F.col("vec_id") % every == 0).distinct().withColumnRenamed("vec_id", "query_id")
    queries = _packed(asking.repartition(lanes(spark)), "query_id", "long")
    guests = queries.mapInArrow(asked, "query_id long, vec binary, leaf int, block long").select(
        "leaf", "block", F.lit(1).alias("role"), "query_id", F.lit(None).cast("array<long>").alias("ids"), "vec"
    )
    found = (
        own.unionByName(guests).withColumn("query_id", F.coalesce("query_id", F.lit(-1)))
        .repartition(lanes(spark), "leaf", "block").sortWithinPartitions("leaf", "block", "role")
        .mapInArrow(_searched(k), "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

