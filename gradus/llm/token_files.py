"""Operator 3: token files whose shards are wavelet matrices.

Texts are dealt by ranges of doc_id and tokenized in that order. Whole documents are gathered into shards of about
SHARD tokens. A shard is one row of a Parquet file: its ids as bit-planes, from the highest bit down, each plane holding
the ids stably sorted by the bits above, with the number of ones before every 512th bit; so a token can be read, and
occurrences counted and found, from the planes alone. Ids of earlier documents are counted by adding up the shards' totals, first
by part and then within a part.

Rows without doc_id are left out; a null text is empty and gives the end id alone. Rows that share a doc_id are written
one after the other. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import new_path
from .spans import text_blocks
from .tokens import file_codec, with_end

SHARD, BLOCK = 1 << 18, 512
SCHEMA = "part int, seq int, n_tokens long, docs binary, doc_tokens binary, planes array<binary>, ranks array<binary>, zeros array<int>"


class WaveletMatrix:
    """Of unsigned ids below 2**len(planes)."""

    def __init__(self, n: int, planes: list, ranks: list, zeros: list[int]):
        self.n, self.planes, self.ranks, self.zeros = n, planes, ranks, zeros

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        bits, current = max(1, int(ids.max(initial=0)).bit_length()), ids.astype(np.uint16 if ids.max(initial=0) < 1 << 16 else np.uint32)
        planes, ranks, zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            one = (current & current.dtype.type(1 << level)) != 0
            packed = np.packbits(one, bitorder="little")
            count = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), BLOCK // 8), dtype=np.uint32)
            planes.append(packed)
            ranks.append((np.cumsum(count) - count).astype("<u4"))
            low = np.compress(~one, current)
            current = np.concatenate([low, np.compress(one, current)])
            zeros.append(len(low))
        return cls(len(ids), planes, ranks, zeros)

    def rank(self, level: int, at: int) -> int:
        """Ones before place at in a plane."""
        block = min(at // BLOCK, len(self.ranks[level]) - 1)
        first = block * BLOCK // 8
        some = np.unpackbits(self.planes[level][first : (at + 7) // 8], bitorder="little")[: at - block * BLOCK]
        return int(self.ranks[level][block]) + int(some.sum())

    def access(self, at: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            one = int(self.planes[level][at // 8] >> (at % 8) & 1)
            ones = self.rank(level, at)
            value, at = value * 2 + one, self.zeros[level] + ones if one else at - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            a, b = self.rank(level, lo), self.rank(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if token >> (len(self.planes) - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of token in [lo, hi)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence of token, from 0; -1 beyond the last."""
        lo, hi = self._range(token, 0, self.n)
        if k >= hi - lo:
            return -1
        at = lo + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = at >= self.zeros[level]
            want = at - self.zeros[level] if one else at
            ranks = self.ranks[level].astype(np.int64)
            before = ranks if one else np.arange(len(ranks)) * BLOCK - ranks
            block = int(np.searchsorted(before, want, "right")) - 1
            bits = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
            at = block * BLOCK + int(np.flatnonzero(bits == one)[want - int(before[block])])
        return at

    def locate(self, token: int) -> np.ndarray:
        """All places of token, ascending: its run in the lowest plane, followed up plane by plane."""
        lo, hi = self._range(token, 0, self.n)
        at = np.arange(lo, hi)
        for level in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            bits = np.unpackbits(self.planes[level], count=self.n, bitorder="little")
            one = at[0] >= self.zeros[level]  # a token's places share their bit
            at = np.flatnonzero(bits)[at - self.zeros[level]] if one else np.flatnonzero(bits == 0)[at]
        return at

    def decode(self) -> np.ndarray:
        """All ids in order: the planes are undone from the lowest up."""
        value = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(value)
            above[~one], above[one] = value[: self.zeros[level]], value[self.zeros[level] :] | value.dtype.type(1 << (len(self.planes) - 1 - level))
            value = above
        return value


def shard_matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], [np.frombuffer(x, np.uint8) for x in row["planes"]], [np.frombuffer(x, "<u4") for x in row["ranks"]], list(row["zeros"]))


def _writer(path: str, end_id: int, shard: int):
    def row(seq, ids, docs, counts):
        m = WaveletMatrix.build(np.concatenate(ids))
        record = {"part": TaskContext.get().partitionId(), "seq": seq, "n_tokens": m.n, "docs": np.concatenate(docs).astype("<i8").tobytes(), "doc_tokens": np.concatenate(counts).astype("<i8").tobytes(), "planes": [x.tobytes() for x in m.planes], "ranks": [x.tobytes() for x in m.ranks], "zeros": m.zeros}
        kind = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("docs", pa.binary()), ("doc_tokens", pa.binary()), ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())), ("zeros", pa.list_(pa.int32()))])
        return pa.RecordBatch.from_pylist([record], kind)

    def run(batches):
        codec, seq, held, size = file_codec(path, "space"), 0, ([], [], []), 0
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text", 2 << 20):
            ids, total = with_end(*codec.ids(buf, offsets), end_id)
            docs, ends, i = rows.column("doc_id").to_numpy(zero_copy_only=False), np.append(0, np.cumsum(total)), 0
            while i < len(total):
                j = max(i + 1, int(np.searchsorted(ends, ends[i] + shard - size, "right")) - 1) if size < shard else i
                for kept, new in zip(held, (ids[ends[i] : ends[j]], docs[i:j], total[i:j]), strict=True):
                    kept.append(new)
                size += int(ends[j] - ends[i])
                if j < len(total) or size >= shard:
                    yield row(seq, *held)
                    held, size, seq = ([], [], []), 0, seq + 1
                i = j
        if size:
            yield row(seq, *held)

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard: int = SHARD) -> None:
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(_writer(tokenizer, end_id, shard), SCHEMA).write.option("compression", "zstd").parquet(path)


def _reader(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = shard_matrix(row).decode().astype("<u4")
            total = np.frombuffer(row["doc_tokens"], "<i8")
            ends = np.append(0, np.cumsum(total))
            n = len(total)
            kept = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((ends * 4).astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["docs"], "<i8")), pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["seq"], np.int32)), pa.array(ends[:-1]), pa.array(total), kept], names=["doc_id", "part", "seq", "at", "n_tokens", "ids"])


def read_token_files(spark, path: str) -> DataFrame:
    """doc_id, part, seq (its shard), at (ids before it in the shard), n_tokens, ids (little-endian unsigned 32-bit)."""
    return spark.read.parquet(path).mapInArrow(_reader, "doc_id long, part int, seq int, at long, n_tokens long, ids binary")


def shard_starts(spark, path: str) -> DataFrame:
    """part, seq, before: ids in all shards before."""
    shards = spark.read.parquet(path).select("part", "seq", "n_tokens")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    parts = parts.withColumn("base", F.sum("total").over(Window.orderBy("part")) - F.col("total")).drop("total")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return shards.withColumn("inside", inside).join(parts, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("before"))


def _shards(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row, shard_matrix(row)


def count_tokens(spark, path: str, tokens: list[int]) -> DataFrame:
    """token, n: occurrences in all files, counted in the planes; a token that doesn't occur has 0."""
    wanted = sorted({int(t) for t in tokens})

    def run(batches):
        for _, m in _shards(batches):
            yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array([m.count(t) for t in wanted], pa.int64())], names=["token", "n"])

    counts = spark.read.parquet(path).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    asked = spark.createDataFrame([(t,) for t in wanted], "token long")
    return asked.join(counts, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


def locate_tokens(spark, path: str, tokens: list[int]) -> DataFrame:
    """token, doc_id, position (ids before it in all files), at (ids before it in its document): a row an occurrence."""

    def run(batches):
        for row, m in _shards(batches):
            docs, ends = np.frombuffer(row["docs"], "<i8"), np.cumsum(np.frombuffer(row["doc_tokens"], "<i8"))
            for token in sorted(set(tokens)):
                place = m.locate(token)
                doc = np.searchsorted(ends, place, "right")
                inside = place - np.append(0, ends)[doc]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), token)), pa.array(docs[doc]), pa.array(np.full(len(place), row["part"], np.int32)), pa.array(np.full(len(place), row["seq"], np.int32)), pa.array(place), pa.array(inside)], names=["token", "doc_id", "part", "seq", "place", "at"])

    found = spark.read.parquet(path).mapInArrow(run, "token long, doc_id long, part int, seq int, place long, at long")
    return found.join(shard_starts(spark, path), ["part", "seq"]).select("token", "doc_id", (F.col("before") + F.col("place")).alias("position"), "at")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "tokens")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"))
    rows = read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return rows.join(shard_starts(spark, path), ["part", "seq"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
