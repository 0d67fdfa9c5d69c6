"""Approximate nearest neighbours by learned partitions.

On a bounded sample the neighbour graph is built and cut into partitions of equal size with few cut edges (spectral
bisection, then swaps). A small network learns to tell from a vector alone where its neighbours lie. It places every
row of the index into its most probable partition and routes a query to the several most probable ones, whose rows are
ranked exactly. How many are probed is set on the sample, by recall against brute force.

Equal vectors are one entry of the index with their smallest ids, so a vector that a third of all rows hold is compared
once. Partitions are compared in blocks of bounded size on both sides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from overround.llm.shared import hashed_sample, written

#: Vectors that the partitions are learned on, at most; wanted distinct vectors in a partition; partitions at most.
SAMPLE, PART_ROWS, MAX_PARTS = 8192, 1024, 128
NEIGHBOURS, HIDDEN, EPOCHS = 10, 96, 40
#: Recall on the sample that sets the number of probes; rows and queries of a block.
RECALL, BLOCK = 0.97, 4096


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row of unit vectors, by blocks."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _halves(heads: np.ndarray, tails: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Two halves of n nodes with few edges (given in both directions) between them: marks of the second half."""
    degree = np.maximum(np.bincount(heads, minlength=n), 1)
    root = np.sqrt(degree)
    first = root / np.linalg.norm(root)
    v = rng.standard_normal(n)
    for _ in range(60):  # second eigenvector of the smoothed walk on the graph
        v -= first * (first @ v)
        v /= max(np.linalg.norm(v), 1e-12)
        v = 0.5 * v + 0.5 * np.bincount(heads, (v / root)[tails], n) / root
    side = np.zeros(n, bool)
    side[np.argsort(v / root, kind="stable")[n // 2 :]] = True
    for _ in range(10):  # swap the nodes of either side that have most edges to the other
        across = side[heads] != side[tails]
        gain = np.bincount(heads, np.where(across, 1.0, -1.0), n)
        a, b = np.flatnonzero(~side), np.flatnonzero(side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        good = int((gain[a[:m]] + gain[b[:m]] > 2).sum()) // 2
        if not good:
            break
        side[a[:good]], side[b[:good]] = True, False
    return side


def balanced_partition(neighbours: np.ndarray, parts: int, seed: int = 1) -> np.ndarray:
    """Partition of each node; sizes differ by the rounding of halves only. ``parts`` is a power of two."""
    rng, n = np.random.default_rng(seed), len(neighbours)
    heads = np.repeat(np.arange(n), neighbours.shape[1])
    tails = neighbours.ravel()
    heads, tails = np.concatenate([heads, tails]), np.concatenate([tails, heads])
    part = np.zeros(n, np.int64)
    while parts > 1:
        new = part * 2
        for p in range(int(part.max()) + 1):
            nodes = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            own = (part[heads] == p) & (part[tails] == p)
            new[nodes] += _halves(place[heads[own]], place[tails[own]], len(nodes), rng)
        part, parts = new, parts // 2
    return part


@dataclass
class Router:
    """A network with one hidden layer; ``probes`` partitions are searched for each query."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.hidden + self.hidden_bias, 0) @ self.output + self.output_bias

    def ranked(self, vectors: np.ndarray) -> np.ndarray:
        """Partitions by falling probability (ties: the smaller number)."""
        return np.argsort(-self.logits(unit(vectors)), axis=1, kind="stable")


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = np.asarray(vectors, np.float64)
    peak = np.abs(vectors).max(axis=1, keepdims=True)  # squares of very large or small values leave the range
    vectors = vectors / peak
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _train(x: np.ndarray, target: np.ndarray, seed: int = 1) -> Router:
    """Cross-entropy to the share of a vector's neighbours in each partition, by Adam."""
    rng = np.random.default_rng(seed)
    w = [rng.standard_normal((x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]) * 2, np.zeros(HIDDEN),
         rng.standard_normal((HIDDEN, target.shape[1])) * np.sqrt(1 / HIDDEN), np.zeros(target.shape[1])]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    last = EPOCHS * -(-len(x) // 256)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for k in range(0, len(x), 256):
            rows = order[k : k + 256]
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            dh = (d @ w[2].T) * (h > 0)
            step += 1
            rate = 0.01 * (1 - step / (last + 1)) + 1e-4
            for a, b, c, g in zip(w, m, v, (x[rows].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0)), strict=True):
                b += 0.1 * (g - b)
                c += 0.001 * (g * g - c)
                a -= rate * (b / (1 - 0.9**step)) / (np.sqrt(c / (1 - 0.999**step)) + 1e-8)
    return Router(*w, probes=1)


def learn(vectors: np.ndarray, total: int, seed: int = 1) -> Router | None:
    """Router learned on a sample of ``total`` distinct vectors; None if one partition is enough."""
    parts = 1
    while parts < MAX_PARTS and parts * PART_ROWS < total and parts * 32 < len(vectors):
        parts *= 2
    if parts == 1:
        return None
    x = unit(vectors)
    near = neighbour_graph(x, min(NEIGHBOURS, len(x) - 1))
    part = balanced_partition(near, parts, seed)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1 / near.shape[1])
    router = _train(x, 0.8 * target + 0.2 * np.eye(parts)[part], seed)
    ranked = router.ranked(vectors)
    home = ranked[:, 0]
    five = neighbour_graph(x, min(5, len(x) - 1))
    place = np.argsort(ranked, axis=1)  # rank of each partition for each vector
    depth = place[np.arange(len(x))[:, None], home[five]]  # probes that find each true neighbour
    found = np.cumsum(np.bincount(depth.ravel(), minlength=parts)) / depth.size
    router.probes = min(parts, 1 + int(np.searchsorted(found, RECALL)))
    return router


def _route(router: Router | None, probes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, parts): the most probable partitions of each vector."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 2048):
                part = batch.slice(k, 2048)
                ranked = router.ranked(_matrix(part.column(1)))[:, :probes] if router else np.zeros((len(part), 1), np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ranked.tolist(), pa.list_(pa.int64()))],
                                                 [*part.schema.names, "parts"])

    return rows


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _best(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k best entries of a block of the index for each query of a block: (query, key, score)."""
    schema = pa.schema([("query", pa.int64()), ("key", pa.int64()), ("score", pa.float64())])

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(queries) or not len(rows):
            return schema.empty_table()
        keys = rows.column("key").to_numpy()
        order = np.argsort(keys, kind="stable")
        keys, x = keys[order], _matrix(rows.column("vector"))[order]
        x = unit(x)
        ids, out = queries.column("query").to_numpy(), []
        q = unit(_matrix(queries.column("vector")))
        n = min(k, len(keys))
        for a in range(0, len(q), 512):
            s = q[a : a + 512] @ x.T
            floor = -np.partition(-s, n - 1, axis=1)[:, n - 1 : n]
            row, column = np.nonzero(s >= floor)  # all that tie with the last
            rank = np.lexsort((keys[column], -s[row, column], row))
            row, column = row[rank], column[rank]
            start = np.searchsorted(row, row)
            keep = np.arange(len(row)) - start < n
            out.append((ids[a + row[keep]], keys[column[keep]], s[row[keep], column[keep]]))
        return pa.table([np.concatenate([o[c] for o in out]) for c in range(3)], schema=schema)

    return search


def nearest(vectors: DataFrame, is_query: str, *, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k nearest other rows by cosine, nearest first.

    ``is_query`` is SQL over ``id``, the row's integer id. Ties go to the smaller id; a query with fewer than k other
    rows gets all of them. Vectors that are null, empty, zero, or hold null or non-finite values, rows without an id,
    and vectors of another dimension than most (ties: the larger) take no part. Rows that repeat id and vector count
    once; one id with several vectors is several rows, none of which is a neighbour of the others. Other columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    finite = "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vector, x -> x != 0)"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(
        "id is not null and vector is not null").where(finite)
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("vector") == (sizes["d"] if sizes else 0)).withColumn("asked", F.expr(is_query))

    # Equal vectors: one entry, with the k + 1 smallest ids (one of which may be the query's own).
    entries = rows.groupBy("vector").agg(F.min("id").alias("key"), F.max("asked").alias("asked"))
    entries = written(entries.select("key", "vector", "asked"), "entries")
    named = written(rows.join(entries.select("vector", "key"), "vector").select("key", "id", "asked").distinct(), "members")
    smallest = named.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("n") <= k + 1)
    smallest = smallest.select("key", "id")
    total = entries.count()
    sample = hashed_sample(entries.select("key", "vector"), "key", SAMPLE, "sample").orderBy("key").collect()
    router = learn(np.array([r["vector"] for r in sample], np.float64), total) if total else None
    probes = router.probes if router else 1

    placed = written(entries.mapInArrow(_route(router, 1), "key long, vector array<double>, asked boolean, parts array<long>").select(
        "key", "vector", F.get("parts", F.lit(0)).alias("part")), "placed")
    counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # MAX_PARTS rows at most
    blocks = F.create_map(*(F.lit(x) for p, n in sorted(counts.items()) for x in (p, -(-n // BLOCK)))) if counts else None

    def searched(queries: DataFrame) -> DataFrame:
        """(query, vec_id, score) of the k + 1 best entries for (query, vector, part)."""
        chunks = queries.groupBy("part").count().select("part", F.ceil(F.col("count") / BLOCK).cast("int").alias("chunks"))
        salted = queries.join(F.broadcast(chunks), "part").withColumn(
            "chunk", F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int")).drop("chunks")
        left = salted.withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(blocks, F.col("part")) - 1)))
        right = placed.join(F.broadcast(chunks), "part").withColumn(
            "block", F.pmod(F.xxhash64("key"), F.element_at(blocks, F.col("part"))).cast("int")).withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
        by = ["part", "chunk", "block"]
        found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_best(k + 1), "query long, key long, score double")
        best = Window.partitionBy("query").orderBy(F.desc("score"), "key")
        return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).join(smallest, "key").select(
            "query", F.col("id").alias("vec_id"), "score")

    def per_query(found: DataFrame) -> DataFrame:
        asked = named.where("asked").select(F.col("key").alias("query"), F.col("id").alias("query_id"))
        own = asked.join(found, "query").where("vec_id != query_id")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = entries.where("asked")
    routed = asked.mapInArrow(_route(router, probes), "key long, vector array<double>, asked boolean, parts array<long>").select(
        F.col("key").alias("query"), "vector", F.explode("parts").alias("part"))
    routed = routed.where(F.col("part").isin(sorted(counts)))
    out = written(per_query(searched(routed)), "nearest")
    # Queries whose partitions hold too few other rows are compared with all.
    ids = named.select("id").distinct().count()
    enough = min(k, ids - 1)
    done = out.groupBy("query_id").count().where(F.col("count") >= enough)
    short = named.where("asked").join(done, F.col("id") == F.col("query_id"), "left_anti").select("key").distinct() if enough else None
    if short is None or short.isEmpty():
        return out
    everywhere = asked.join(short, "key", "left_semi").select(
        F.col("key").alias("query"), "vector", F.explode(F.array(*(F.lit(p) for p in sorted(counts)))).alias("part"))
    rest = per_query(searched(everywhere)).join(done, "query_id", "left_anti")
    return out.join(done, "query_id", "left_semi").unionByName(rest)
