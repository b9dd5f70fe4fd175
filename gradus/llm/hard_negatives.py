"""Operator 13: hard negatives through an inverted multi-index, exact by certified windows.

Vectors are halved. Each half has a codebook, fitted to a bounded sample (PER_CODE rows a code, the smallest hashes of the
id); a row lies in the cell of its two nearest codes. The codes follow the square root of the table, up to MOST_CODES a half
(cells are then one number of two bytes; larger cells are searched in more blocks). A code's radius is the largest distance of any row of the
table from it, so inner products with a half lie within anchor.code plus or minus |anchor| * radius.

For an anchor, a heap over the two sorted lists of half bounds visits cells by falling sum. It stops when no cell that is left can hold a row
that changes the answer: its bound lies below what is asked, or below the k-th row found (ties are still visited). Cells
whose upper and lower bound miss every window are skipped. Cells are searched in rounds, each GROWTH times as many as the one before, and
only by anchors that aren't certified yet; what is found is exact, never approximate. Within a round, a cell is dealt into blocks of about
BLOCK_NUMBERS numbers, so one very common vector does not land in one task; a block is held while its anchors stream past it, and sends on
at most k rows a window.

Scores are inner products of floor(256 * x), in whole numbers: as doubles where these are exact, else as Python's integers;
one that doesn't fit a long is an error. On vectors without structure bounds are wide and most cells are visited.

Rows without id or label, with a null vector, or with a null or non-finite component take no part. A shorter vector counts as filled up
with zeros. Rows that repeat an id are candidates each by itself, but never for an anchor of that id; of anchors that repeat an id, the smallest
(label, vector) asks. Other columns are ignored. An empty table gives no rows.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

CELL_ROWS, MOST_CODES, PER_CODE, LEAST_SAMPLE = 512, 256, 40, 2000
FIRST, GROWTH, BLOCK_NUMBERS = 16, 8, 1 << 20
LOW, HIGH = -(1 << 63), (1 << 63) - 1
_ASK = "id long, label long, v array<double>, low array<long>, high array<long>, need array<long>"


def codebook(x: np.ndarray, codes: int, seed: int = 0, steps: int = 12) -> np.ndarray:
    """Centres of the rows of x, each step moving them to the mean of the rows nearest to them."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), codes, replace=len(x) < codes)].copy()
    for _ in range(steps):
        near = nearest_codes(x, centres)
        count = np.bincount(near, minlength=codes)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest_codes(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for i in range(0, len(x), 4096):
        out[i : i + 4096] = ((centres**2).sum(1) - 2 * (x[i : i + 4096] @ centres.T)).argmin(1)
    return out


def cells_by_bound(first: np.ndarray, second: np.ndarray):
    """(bound, i, j) of all pairs by falling first[i] + second[j], from a heap that holds one candidate a started row."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, a[i], b[j]
        if j + 1 < len(b):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


class MultiIndex:
    """Two codebooks with their radii, and the number of rows of each cell."""

    def __init__(self, halves: list[np.ndarray]):
        self.halves = halves
        self.codes, self.cut = len(halves[0]), halves[0].shape[1]
        self.radii, self.sizes = [np.zeros(self.codes)] * 2, np.zeros(self.codes**2, np.int64)

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, : self.cut], x[:, self.cut :]]

    def bounds(self, v: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Least and most of the inner product of each half of v with a row of each code, rounding allowed for."""
        out = []
        with np.errstate(all="ignore"):
            for part, centres, radius in zip(self.split(v[None]), self.halves, self.radii, strict=True):
                norm = np.linalg.norm(part)
                middle, wide = centres @ part[0], norm * radius
                slack = 1e-9 * (norm * np.linalg.norm(centres, axis=1) + wide) + 1e-3
                out.append((np.nan_to_num(middle - wide - slack, nan=-np.inf, neginf=-np.inf), np.nan_to_num(middle + wide + slack, nan=np.inf, posinf=np.inf)))
        return out

    def visits(self, v: np.ndarray, low: list[int], high: list[int], need: list[int], seen: int, most: int) -> tuple[list[int], int, bool]:
        """Cells to search next, after the first so many in the order of bounds: at most so many that hold rows. Also how many
        were passed by then, and whether any can be left."""
        windows = [(max(a, n), b) for a, b, n in zip(low, high, need, strict=True) if a <= b]
        if not windows:
            return [], seen, False
        (least1, most1), (least2, most2) = self.bounds(v)
        out, k, stop = [], 0, min(a for a, _ in windows)
        for bound, i, j in cells_by_bound(most1, most2):
            if bound < stop:
                return out, k, False
            if k >= seen:
                if len(out) == most:
                    return out, k, True
                lowest = least1[i] + least2[j]
                if self.sizes[i * self.codes + j] and any(bound >= a and not lowest > b for a, b in windows):
                    out.append(i * self.codes + j)
            k += 1
        return out, k, False


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values, size = flat.flatten().to_numpy(zero_copy_only=False), np.diff(flat.offsets.to_numpy())
    if (size == width).all():
        return values.reshape(len(flat), width)
    out = np.zeros((len(flat), width))
    out[np.arange(width) < size[:, None]] = values
    return out


def _lists(rows: list[list[int]], kind=None) -> pa.Array:
    return pa.array(rows, pa.list_(kind or pa.int64()))


def _whole(width: int):
    """v becomes floor(256 * v)."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v = np.floor(256 * _matrix(batch.column("v"), width))
                offsets = pa.array(np.arange(len(v) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.ListArray.from_arrays(offsets, pa.array(v.ravel()))], names=["id", "label", "v"])

    return run


def _placed(index: MultiIndex, width: int):
    """Adds the cell and the distances from its two codes."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                halves = index.split(_matrix(batch.column("v"), width))
                code = [nearest_codes(x, c) for x, c in zip(halves, index.halves, strict=True)]
                far = [np.linalg.norm(x - c[k], axis=1) for x, c, k in zip(halves, index.halves, code, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((code[0] * index.codes + code[1]).astype(np.int32)), *map(pa.array, far)], names=["id", "label", "v", "cell", "far1", "far2"])

    return run


def _planned(index: MultiIndex, width: int, most: int):
    """Adds the cells that each ask goes to in this round, and how far it has come."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v, rows = _matrix(batch.column("v"), width), batch.select(["low", "high", "need", "seen"]).to_pylist()
            got = [index.visits(x, r["low"], r["high"], r["need"], r["seen"], most) for x, r in zip(v, rows, strict=True)]
            columns = [batch.column(c) for c in ("id", "label", "v", "low", "high", "need")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([g[1] for g in got], pa.int64()), _lists([g[0] for g in got], pa.int32()), pa.array([g[2] for g in got])], names=["id", "label", "v", "low", "high", "need", "seen", "cells", "open"])

    return run


def _products(asks: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    most = np.abs(asks).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if most < 1 << 53:
        return asks @ rows.T
    if not np.isfinite(asks).all() or not np.isfinite(rows).all():
        raise ValueError("256 times a component is no double")
    whole = np.frompyfunc(int, 1, 1)
    return whole(asks).dot(whole(rows).T)


class _Block:
    def __init__(self, ids, labels, vectors):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]

    def search(self, asks: list[dict], vectors: np.ndarray, same: bool, k: int):
        """The k best rows of each window of each ask: (id, w, other, score)."""
        out = []
        for i in range(0, len(asks), 256):
            products = _products(vectors[i : i + 256], self.vectors)
            for ask, score in zip(asks[i : i + 256], products, strict=True):
                least = [max(a, n) for a, n in zip(ask["low"], ask["need"], strict=True)]
                some = np.flatnonzero(((self.labels == ask["label"]) == same) & (self.ids != ask["id"]))
                if score.dtype == object and len(some) and not LOW <= score[some].min() <= score[some].max() <= HIGH:
                    raise ValueError("a score doesn't fit a long")
                some = some[(score[some] >= min(least)) & (score[some] <= max(ask["high"]))]
                some = some[np.argsort(-score[some], kind="stable")]
                ordered = score[some]
                for w, (low, high) in enumerate(zip(least, ask["high"], strict=True)):
                    first = int(np.searchsorted(-ordered, -high))
                    for at in range(first, min(first + k, len(some))):
                        if ordered[at] < low:
                            break
                        out.append((ask["id"], w, int(self.ids[some[at]]), int(ordered[at])))
        return out


def _searched(same: bool, k: int, width: int):
    """Rows sorted by block, its rows before its asks -> what each block has for them."""

    def run(batches):
        current, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, salt, asks, ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "salt", "asks", "id", "label"))
            v = _matrix(batch.column("v"), width)
            cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (salt[1:] != salt[:-1]) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip(np.append(0, cuts).tolist(), np.append(cuts, len(ids)).tolist(), strict=True):
                if current != (cell[lo], salt[lo]):
                    current, held, block = (cell[lo], salt[lo]), [], None
                if not asks[lo]:
                    held.append((ids[lo:hi], labels[lo:hi], v[lo:hi]))
                    continue
                if block is None and held:
                    block, held = _Block(*(np.concatenate(x) for x in zip(*held, strict=True))), []
                if block is not None:
                    found = block.search(batch.slice(lo, hi - lo).select(["id", "label", "low", "high", "need"]).to_pylist(), v[lo:hi], same, k)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64() if n != 1 else pa.int32()) for n, x in enumerate(zip(*found, strict=True))], names=["id", "w", "other", "score"])

    return run


class Searcher:
    """The index over all rows (id, label, v), and searches in it."""

    def __init__(self, rows: DataFrame, codes: int | None = None, block_rows: int | None = None):
        stats = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
        self.width = stats.width or 0
        codes = codes or int(np.clip((stats.n / CELL_ROWS) ** 0.5, 1, MOST_CODES))
        whole = rows.mapInArrow(_whole(self.width), "id long, label long, v array<double>")
        sample = rows.orderBy(F.xxhash64("id"), "id").limit(max(LEAST_SAMPLE, PER_CODE * codes)).select("v").toPandas()["v"]
        x = np.zeros((max(1, len(sample)), self.width))
        for i, v in enumerate(sample):
            x[i, : len(v)] = np.floor(256 * np.asarray(v))
        with np.errstate(all="ignore"):
            halves = [codebook(part, codes) for part in (x[:, : self.width // 2], x[:, self.width // 2 :])]
        self.index = MultiIndex([np.nan_to_num(h) for h in halves])
        self.rows = stored(whole.mapInArrow(_placed(self.index, self.width), "id long, label long, v array<double>, cell int, far1 double, far2 double"), "cells")
        for r in self.rows.groupBy("cell").count().collect():  # a number a cell
            self.index.sizes[r.cell] = r["count"]
        code1, code2 = F.expr(f"cell div {codes}"), F.expr(f"cell % {codes}")
        self.index.radii = []
        for code, far in ((code1, "far1"), (code2, "far2")):  # a number a code
            radius = np.zeros(codes)
            for r in self.rows.groupBy(code.alias("code")).agg(F.max(far).alias("far")).collect():
                radius[r.code] = r.far
            self.index.radii.append(radius)
        self.block_rows = block_rows or max(1024, BLOCK_NUMBERS // max(1, self.width))

    def anchors(self, chosen: DataFrame) -> DataFrame:
        """id, label, v as whole numbers of chosen (id, label, v); of rows that repeat an id, the smallest."""
        one = chosen.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")
        return one.mapInArrow(_whole(self.width), "id long, label long, v array<double>")

    def search(self, asks: DataFrame, same: bool, k: int, first: int = FIRST, growth: int = GROWTH) -> DataFrame:
        """asks: id, label, v, low, high (arrays: windows of scores, ends included). Of rows of the ask's label or, unless same, of
        others: the k best of each window, as (id, w: the window's place, other: the row's id, score)."""
        best = stored(asks.sparkSession.createDataFrame([], "id long, w int, other long, score long"), "best")
        state, most = asks.select("id", "label", "v", "low", "high", F.col("low").alias("need"), F.lit(0).cast("long").alias("seen")), first
        planned_as = f"{_ASK}, seen long, cells array<int>, open boolean"
        while True:
            planned = stored(state.mapInArrow(_planned(self.index, self.width, most), planned_as), "asks")
            if planned.where("size(cells) > 0").isEmpty():
                return best
            best = stored(self._top(best.unionByName(self._blocks(planned, same, k)), k), "best")
            kth = best.groupBy("id", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
            kth = kth.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kth"))  # a row a window
            need = F.expr("transform(low, (x, i) -> greatest(x, coalesce(kth[i], x)))")
            state = planned.where("open").join(kth, "id", "left").select("id", "label", "v", "low", "high", need.alias("need"), "seen")
            most *= growth

    def _top(self, found: DataFrame, k: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("id", "w").orderBy(F.desc("score"), "other"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")

    def _blocks(self, planned: DataFrame, same: bool, k: int) -> DataFrame:
        asked = planned.select("id", "label", "v", "low", "high", "need", F.explode("cells").alias("cell"))
        wanted = F.broadcast(planned.select(F.explode("cells").alias("cell")).distinct())  # no more than cells
        salts = {c: -(-int(n) // self.block_rows) for c, n in enumerate(self.index.sizes) if n > self.block_rows}
        spread = F.coalesce(F.create_map(*[F.lit(x) for c, n in salts.items() for x in (c, n)])[F.col("cell")], F.lit(1)) if salts else F.lit(1)
        none = F.expr("cast(array() as array<long>)")
        rows = self.rows.join(wanted, "cell", "left_semi").select("cell", F.pmod(F.xxhash64("id", "v"), spread).cast("int").alias("salt"), F.lit(False).alias("asks"), "id", "label", "v", *[none.alias(c) for c in ("low", "high", "need")])
        asked = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), spread - 1))).withColumn("asks", F.lit(True)).select(*rows.columns)
        both = rows.unionByName(asked).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "asks")
        return both.mapInArrow(_searched(same, k, self.width), "id long, w int, other long, score long")


def valid_rows(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """id, label, v (array of double) of the rows that take part."""
    out = rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull())
    out = out.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    return out.where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, codes: int | None = None, block_rows: int | None = None) -> DataFrame:
    """rows, anchors (id, label, v), as valid_rows() gives them. For each anchor and each of its first positives: the first rows of other
    labels whose score lies between low and high hundredths of the positive's.

    anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    searcher = Searcher(rows, codes, block_rows)
    asks = stored(searcher.anchors(anchors), "anchors")
    ends = [F.array(F.lit(x).cast("long")).alias(n) for x, n in ((LOW, "low"), (HIGH, "high"))]
    found = searcher.search(asks.select("*", *ends), True, positives)
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "other")) - 1
    chosen = stored(found.select("id", place.alias("w"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    score = F.col("positive_score").cast("decimal(20,0)")
    ends = chosen.select("id", "w", F.ceil(score * low / 100).cast("long").alias("low"), F.floor(score * high / 100).cast("long").alias("high"))
    windows = ends.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("w", "low", "high"))).alias("x"))  # a row a positive
    near = searcher.search(asks.join(windows.select("id", "x.low", "x.high"), "id"), False, negatives)
    rank = F.row_number().over(Window.partitionBy("id", "w").orderBy(F.desc("score"), "other"))
    out = near.withColumn("rank", rank).join(chosen, ["id", "w"])
    return out.select(F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def query(spark, sf_dir: str) -> DataFrame:
    rows = valid_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, rows.where("id % 50 = 0"))


#: All anchors against all rows.
ORACLE = """
with v as (
    select vec_id as id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label, list_transform(embedding::double[], lambda x: floor(256 * x)) as q
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x::double))) is not false),
s as (
    select a.id as a, b.id as b, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
    from v a join v b on a.id <> b.id where a.id % 50 = 0),
p as (
    select a, b, score from s where same
    qualify row_number() over (partition by a order by score desc, b) <= 5)
select p.a as anchor_id, p.b as positive_id, row_number() over (partition by p.a, p.b order by s.score desc, s.b)::int as rank, s.b as negative_id,
    p.score as positive_score, s.score as negative_score
from p join s on s.a = p.a and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
qualify row_number() over (partition by p.a, p.b order by s.score desc, s.b) <= 3
"""
