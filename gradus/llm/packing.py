"""Operator 2: harmonic packing of tokenized documents into sequences of at most CAPACITY tokens.

The piece sizes are the reciprocal-capacity classes CAPACITY // k for k = 1 ... 16, then the powers of two below. A
document is cut greedily into such pieces, largest first, and a sequence of class k takes exactly k pieces, so a bin of
class k is never emptier than CAPACITY - k + 1. Every worker fills its own bins while it reads, with at most one open bin
a class; nothing is shuffled. At a worker's end the open bins' pieces are cut into powers of two and grouped so that
each remaining sequence is as long as a power of two, which needs no padding.

Rows without doc_id are left out; a null text is empty and gives the end id alone. Rows that share a doc_id are packed
each by itself. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import ragged, text_blocks
from .tokens import file_codec, with_end

CAPACITY = 4096
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def classes(capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(piece size, pieces a sequence), largest size first; ends with the powers of two down to 1."""
    sizes = {capacity // k for k in range(1, 17)} | {1 << i for i in range((capacity // 16).bit_length())}
    return [(s, capacity // s) for s in sorted(sizes, reverse=True) if s]


def cut(lengths: np.ndarray, sizes: list[tuple[int, int]]):
    """For each class: the texts that have such pieces, and where each piece starts; for whole lengths."""
    left, at, out = lengths.copy(), np.zeros(len(lengths), np.int64), []
    for size, _ in sizes:
        n = left // size
        text = np.repeat(np.arange(len(lengths)), n)
        out.append((text, np.repeat(at, n) + size * ragged(np.zeros(len(n), np.int64), n)))
        at, left = at + n * size, left - n * size
    return out


class _Rows:
    def __init__(self):
        self.columns, self.ids = [[] for _ in range(6)], []

    def add(self, ids: np.ndarray, *columns) -> None:
        self.ids.append(ids)
        for kept, new in zip(self.columns, columns, strict=True):
            kept.append(np.asarray(new, np.int64))

    def batch(self) -> pa.RecordBatch:
        doc, start, length, tokens, sequence, offset = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in self.columns)
        data = np.concatenate(self.ids).astype("<u4").tobytes() if self.ids else b""
        ends = np.append(0, np.cumsum(length * 4)).astype(np.int32)
        ids = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(length), ids, pa.array(tokens), pa.array(sequence), pa.array(offset)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def _packer(path: str, end_id: int, capacity: int):
    sizes = classes(capacity)

    def run(batches):
        codec = file_codec(path, "words")
        base = TaskContext.get().partitionId() << 40
        used, held = 0, [[] for _ in sizes]  # held: pieces of the open bin of each class

        def sequences(n: int) -> np.ndarray:
            nonlocal used
            used += n
            return base + np.arange(used - n, used)

        for rows, buf, offsets in text_blocks(batches, "doc_id", "text"):
            doc = rows.column("doc_id").to_numpy(zero_copy_only=False)
            ids, total = with_end(*codec.ids(buf, offsets), end_id)
            begin, out = np.cumsum(total) - total, _Rows()
            for c, ((size, per), (text, start)) in enumerate(zip(sizes, cut(total, sizes), strict=True)):
                old = len(held[c])
                full = (old + len(text)) // per
                place = np.arange(full * per)
                if full:
                    number = sequences(full)[place // per]
                    for i, (d, s, piece, t) in enumerate(held[c]):
                        out.add(piece, [d], [s], [size], [t], number[i : i + 1], [i * size])
                    held[c] = []
                    new, x, s = full * per - old, text[: full * per - old], start[: full * per - old]
                    out.add(ids[ragged(begin[x] + s, np.full(new, size))], doc[x], s, np.full(new, size), total[x], number[old:], (place % per)[old:] * size)
                    text, start = text[new:], start[new:]
                held[c] += [(doc[x], s, ids[begin[x] + s : begin[x] + s + size], total[x]) for x, s in zip(text.tolist(), start.tolist(), strict=True)]
            yield out.batch()

        out, rest = _Rows(), {size: [] for size, _ in sizes if not size & (size - 1)}
        for (size, _), pieces in zip(sizes, held, strict=True):
            for d, s, piece, t in pieces:
                while len(piece):
                    n = 1 << (len(piece).bit_length() - 1)
                    rest[n].append((d, s, piece[:n], t))
                    s, piece = s + n, piece[n:]
        for size, pieces in rest.items():
            while pieces:
                n = min(capacity // size, 1 << (len(pieces).bit_length() - 1))
                number = sequences(1)[0]
                for i, (d, s, piece, t) in enumerate(pieces[:n]):
                    out.add(piece, [d], [s], [size], [t], [number], [i * size])
                pieces = pieces[n:]
        if out.ids:
            yield out.batch()

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit). tokenizer: path of a file that every executor has. capacity: a power of two of 16 or more."""
    if capacity < 16 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two of 16 or more")
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_packer(tokenizer, end_id, capacity), SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
