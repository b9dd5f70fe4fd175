"""Operator 5: approximate nearest neighbours by learned partitions.

A bounded sample (PER_PART rows a part, the smallest hashes of vec_id) is joined into a neighbour graph, which is halved again
and again into parts of equal size that cut few edges; the number of parts grows with the square root of the table, from 16 to
MOST_PARTS. A small network (one hidden layer) learns which part a vector's neighbours lie in. Every row is indexed under
its most probable part; a query goes to its most probable parts, as many as the recall of held-out rows of the sample asks
for (RECALL), and is compared with every row there, exactly. Parts are dealt into blocks of about BLOCK_NUMBERS numbers, so one very
common vector or a large part does not land in one task. A row goes to one block, once; a block is held while its
queries stream past it, and sends on each query's nearest rows only.

Components may have any finite size: vectors are scaled by powers of two before their norms.

Vectors that are null, zero, hold null or non-finite components, or have another length than most take no part; nor do
rows without vec_id. Ties go to the smaller vec_id. With fewer candidates than k, all that were found are returned. Rows
repeating a vec_id are candidates each by itself, but never for a query of that id; of queries repeating an id, the smallest
vector counts. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

PER_PART, LEAST_SAMPLE, MOST_PARTS, NEIGHBOURS, HIDDEN, BLOCK_NUMBERS, RECALL, HELD_OUT = 64, 4000, 256, 10, 128, 1 << 20, 0.95, 400


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """k nearest rows of each row, by blocks."""
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 500):
        near = x[i : i + 500] @ x.T
        near[np.arange(len(near)), np.arange(i, i + len(near))] = -np.inf
        out[i : i + 500] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part of each node: halves along the graph's slowest vector, evened out at the median, then refined by swaps that cut fewer edges."""
    rng = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(len(graph)), graph.shape[1]), graph.ravel()
    out = np.zeros(len(graph), np.int64)
    size = 1
    while size < parts:
        for part in range(size):
            inside = out == part
            nodes = np.flatnonzero(inside)
            if len(nodes) < 2:
                continue
            place = np.full(len(graph), -1)
            place[nodes] = np.arange(len(nodes))
            own = inside[a] & inside[b]
            s, t = place[a[own]], place[b[own]]
            n = len(nodes)
            degree = np.bincount(s, minlength=n) + np.bincount(t, minlength=n) + 1e-9
            v = rng.standard_normal(n)
            for _ in range(60):
                v -= (v * degree).sum() / degree.sum()
                v = (v + (np.bincount(s, v[t], n) + np.bincount(t, v[s], n)) / degree) / 2
                v /= np.abs(v).max() + 1e-12
            side = np.zeros(n, bool)
            side[np.argsort(v, kind="stable")[n // 2 :]] = True
            for _ in range(8):
                pull = np.bincount(s, side[t] * 2.0 - 1, n) + np.bincount(t, side[s] * 2.0 - 1, n)
                gain = np.where(side, -pull, pull)
                left, right = np.flatnonzero(~side), np.flatnonzero(side)
                left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
                m = min(len(left), len(right))
                m = int(((gain[left[:m]] + gain[right[:m]]) > 0).sum()) // 2
                if not m:
                    break
                side[left[:m]], side[right[:m]] = True, False
            out[nodes[side]] = part + size
        size *= 2
    return out


class Router:
    """Softmax over parts, from one hidden layer; fitted to the parts of each sample row and of its neighbours."""

    def __init__(self, dims: int, hidden: int, parts: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.w = [rng.standard_normal((dims, hidden)) * np.sqrt(2 / dims), np.zeros(hidden), rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]

    def fit(self, x: np.ndarray, target: np.ndarray, steps: int = 600, rate: float = 3e-3, decay: float = 1e-3, seed: int = 1) -> "Router":
        rng, mean, square = np.random.default_rng(seed), [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        for step in range(1, steps + 1):
            i = rng.integers(0, len(x), min(512, len(x)))
            h = np.maximum(x[i] @ self.w[0] + self.w[1], 0)
            z = h @ self.w[2] + self.w[3]
            p = np.exp(z - z.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - target[i]) / len(i)
            back = (d @ self.w[2].T) * (h > 0)
            for k, g in enumerate((x[i].T @ back, back.sum(0), h.T @ d, d.sum(0))):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                self.w[k] -= rate * (mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8) + decay * self.w[k])
        return self


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component near 1: cosines are the same to the bit, norms don't overflow or vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_router(x: np.ndarray, parts: int, neighbours: int = NEIGHBOURS) -> Router:
    x = units(x)
    router = Router(x.shape[1], HIDDEN, parts)
    if len(x) <= 2 * neighbours:
        return router
    graph = neighbour_graph(x, neighbours)
    part = balanced_parts(graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x)), part), 1.0)
    np.add.at(target, (np.repeat(np.arange(len(x)), neighbours), part[graph].ravel()), 1.0)
    return router.fit(x, target / target.sum(1, keepdims=True))


def needed_probes(router: Router, parts: int, x: np.ndarray, held: np.ndarray, k: int, recall: float) -> int:
    """Fewest parts in which the k nearest rows of x of the held-out vectors are found, to a share of recall."""
    if not len(held) or len(x) <= k:
        return parts
    x, held = units(x), units(held)
    near = np.argpartition(-(held @ x.T), k - 1, axis=1)[:, :k]
    part = router.scores(x).argmax(1)[near]
    place = np.argsort(np.argsort(-router.scores(held), axis=1, kind="stable"), axis=1, kind="stable")
    found = np.bincount(place[np.arange(len(held))[:, None], part].ravel(), minlength=parts).cumsum() / near.size
    return int(np.searchsorted(found, min(recall, found[-1]))) + 1


def table_parts(rows: int) -> int:
    return int(np.clip(1 << round(np.log2(max(1, rows) ** 0.5 / 8 + 1)), 16, MOST_PARTS))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _routed(router: Router, probes: int):
    """Adds parts, the most probable first."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v"))
                parts = np.argsort(-router.scores(units(x)), axis=1, kind="stable")[:, :probes].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts.shape[1]), pa.array(parts.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), lists], names=["id", "v", "parts"])

    return run


class _Block:
    """Rows of a block, and the k nearest of them to each of some queries, by exact cosines; ties to the smaller id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], scaled(vectors[order])
        self.norm = np.linalg.norm(self.vectors, axis=1)
        self.unit = self.vectors / self.norm[:, None]

    def nearest(self, ids: np.ndarray, q: np.ndarray, k: int):
        q = scaled(q)
        out, norm = [], np.linalg.norm(q, axis=1)
        for i in range(0, len(q), 256):
            near = np.round(q[i : i + 256] / norm[i : i + 256, None] @ self.unit.T, 12)
            near[ids[i : i + 256, None] == self.ids[None, :]] = -np.inf
            for j, row in enumerate(near, i):
                m = min(2 * k, len(row))
                least = np.partition(row, len(row) - m)[len(row) - m]
                some = np.flatnonzero(row >= max(least, -2))
                some = some[np.argsort(-row[some], kind="stable")[:m]]
                score = np.einsum("ij,j->i", self.vectors[some], q[j]) / (self.norm[some] * norm[j])
                best = np.lexsort((self.ids[some], -score))[:k]
                out.append((np.full(len(best), ids[j]), self.ids[some][best], score[best]))
        return [np.concatenate(x) for x in zip(*out, strict=True)]


def _nearest(k: int):
    """Rows (part, salt, asks, id, v), sorted by block, its rows before its queries -> (query_id, vec_id, score)."""

    def run(batches):
        current, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            part, salt, asks, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "salt", "asks", "id"))
            v = _matrix(batch.column("v"))
            cuts = np.flatnonzero((part[1:] != part[:-1]) | (salt[1:] != salt[:-1]) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip(np.append(0, cuts).tolist(), np.append(cuts, len(ids)).tolist(), strict=True):
                if current != (part[lo], salt[lo]):
                    current, held, block = (part[lo], salt[lo]), [], None
                if not asks[lo]:
                    held.append((ids[lo:hi], v[lo:hi]))
                    continue
                if block is None and held:
                    block, held = _Block(*(np.concatenate(x) for x in zip(*held, strict=True))), []
                if block is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in block.nearest(ids[lo:hi], v[lo:hi], k)], names=["query_id", "vec_id", "score"])

    return run


def valid_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id, v (array of double) of the vectors that take part."""
    out = rows.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    out = out.where("size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    common = out.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    return out.where(F.size("v") == (common.dims if common else 0))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, parts: int | None = None, probes: int | None = None, block_rows: int | None = None) -> DataFrame:
    """rows, queries (id, v), as valid_vectors() gives them -> query_id, rank, vec_id, score. parts, probes, block_rows: found from the table if not given."""
    total = rows.count()
    parts = parts or table_parts(total)
    held = min(HELD_OUT, total // 10)
    seen = rows.orderBy(F.xxhash64("id"), "id").limit(max(LEAST_SAMPLE, PER_PART * parts) + held).toPandas()
    x = np.stack(seen["v"].to_numpy()) if len(seen) else np.ones((1, 1))
    router = fit_router(x[: len(x) - held], parts)
    probes = probes or needed_probes(router, parts, x[: len(x) - held], x[len(x) - held :], k, RECALL)
    indexed = stored(rows.mapInArrow(_routed(router, 1), "id long, v array<double>, parts array<int>").select("id", "v", F.col("parts")[0].alias("part")), "index")
    sizes = {r.part: r["count"] for r in indexed.groupBy("part").count().collect()}  # one number a part
    block_rows = block_rows or max(1024, BLOCK_NUMBERS // x.shape[1])
    salts = F.create_map(*[F.lit(x) for p in range(parts) for x in (p, max(1, -(-sizes.get(p, 0) // block_rows)))])
    salted = indexed.withColumn("salt", F.pmod(F.xxhash64("id"), salts[F.col("part")]).cast("int")).withColumn("asks", F.lit(False))
    asked = queries.groupBy("id").agg(F.min("v").alias("v")).mapInArrow(_routed(router, probes), "id long, v array<double>, parts array<int>")
    asked = asked.select("id", "v", F.explode("parts").alias("part")).withColumn("salt", F.explode(F.sequence(F.lit(0), salts[F.col("part")] - 1))).withColumn("asks", F.lit(True))
    columns = ["part", "salt", "asks", "id", "v"]
    both = salted.select(columns).unionByName(asked.select(columns)).repartition("part", "salt").sortWithinPartitions("part", "salt", "asks")
    found = both.mapInArrow(_nearest(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = valid_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return nearest(rows, rows.where("id % 50 = 0"))
