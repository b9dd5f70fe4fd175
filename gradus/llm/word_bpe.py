"""Operator 8: byte-level BPE by a global shuffle of distinct words.

1. A scan cuts texts into pre-tokens, block by block (some MB of whole texts). For each block it emits the positions
   (each pre-token as its number among the block's distinct words) and the distinct words themselves, dealt into buckets
   by their hash.
2. Buckets meet across all blocks: every distinct word is encoded once, and each block gets its words' ids back.
3. In each block the ids join the positions, and documents are reassembled. Decoding joins the token-byte table.

Positions and word lists travel as compressed arrays, one row a block and bucket: a row for every pre-token would be
several times the input. The scan runs once for the positions and once for the words, so docs must be rows that read the
same twice (a table); a block whose words don't return raises an error. The number of buckets follows the size of the texts, so
that no bucket grows with the corpus.

Rows without doc_id are left out; a null text is empty and has no ids. Rows that share a doc_id are encoded each by
itself. Other columns are ignored.
"""

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import prefix_sums, ragged, span_hash, text_blocks
from .tokens import space_led

BLOCK = 3 << 20  #: bytes of text that share a word list
BUCKET_BYTES = 64 << 20  #: bytes of text for each bucket of words, about; bounds the words that a task remembers
_memo: dict = {}
_ranks: dict = {}
_ROW = "block long, bucket int, n int, payload binary"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _encoding(path: str, pattern: str):
    if (path, pattern) not in _ranks:
        import tiktoken

        _ranks[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
    return _ranks[path, pattern]


def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: all tokens' bytes one after the other, and where each id's begin; a gap is empty."""
    if path not in _ranks:
        table = {b: a for a, b in load_ranks(path).items()}
        tokens = [table.get(i, b"") for i in range(max(table) + 1)]
        _ranks[path] = np.frombuffer(b"".join(tokens), np.uint8), np.append(0, np.cumsum([len(x) for x in tokens])).astype(np.int64)
    return _ranks[path]


def _pack(x: bytes) -> bytes:
    return zstandard.compress(x, 3)


def _split(pattern: str):
    """Pre-tokens of a chunk that begins a text or with the space before a word."""
    find = regex.compile(pattern).findall
    memo = _memo.setdefault(pattern, {})

    def run(key: int, chunk: bytes) -> list[bytes]:
        got = memo.get(key)
        if got is None:
            got = [x.encode() for x in find(chunk.decode("utf-8", "replace"))]
            if len(memo) < 60_000:
                memo[key] = got
        return got

    return run


def _block_words(pattern: str, buf: np.ndarray, offsets: np.ndarray):
    """Distinct words of a block in order of appearance, the position-ordered word numbers, and pre-tokens a text."""
    split, step = _split(pattern), 2 << 20
    number: dict[bytes, int] = {}
    positions, counts, i = [], [], 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + step, "right")) - 1)
        part, at = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        start, end, text = space_led(part, at)
        code, seen = pd.factorize(span_hash(prefix_sums(part), start, end))
        first = np.zeros(len(seen), np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        data, flat, sizes = part.tobytes(), [], []
        for key, s, e in zip(seen.tolist(), start[first].tolist(), end[first].tolist(), strict=True):
            found = split(key, data[s:e])
            sizes.append(len(found))
            flat += [number.setdefault(w, len(number)) for w in found]
        flat, sizes = np.array(flat, np.uint32), np.array(sizes, np.int64)
        count = sizes[code]
        positions.append(flat[ragged((np.cumsum(sizes) - sizes)[code], count)])
        counts.append(np.bincount(text, weights=count, minlength=j - i).astype(np.int64))
        i = j
    return list(number), np.concatenate(positions or [np.zeros(0, np.uint32)]), np.concatenate(counts or [np.zeros(0, np.int64)])


def _dealt(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, and the order in which a block's words stand in its buckets."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words]).astype(np.int64)
    starts = np.append(0, ends[:-1]).astype(np.int64) if len(words) else ends
    bucket = (span_hash(prefix_sums(data), starts, ends) >> np.uint64(20)).astype(np.int64) % buckets if len(words) else ends
    return bucket, np.argsort(bucket, kind="stable")


def _block_id(docs: np.ndarray, offsets: np.ndarray, buf: np.ndarray) -> int:
    """From the block's rows, so that a second reading gives the same."""
    found = hashlib.blake2b(docs.astype("<i8").tobytes() + offsets.astype("<i8").tobytes(), digest_size=8)
    found.update(buf)
    return int.from_bytes(found.digest(), "little", signed=True)


def _scan(pattern: str, buckets: int, what: str):
    def rows(batches):
        for batch, buf, offsets in text_blocks(batches, "doc_id", "text", BLOCK):
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            block = _block_id(docs, offsets, buf)
            words, positions, counts = _block_words(pattern, buf, offsets)
            bucket, order = _dealt(words, buckets)
            if what == "positions":  # words are numbered as they stand in their buckets
                number = np.empty(len(words), np.uint32)
                number[order] = np.arange(len(words), dtype=np.uint32)
                payload = b"".join(x.astype(k).tobytes() for x, k in ((docs, "<i8"), (counts, "<i8"), (number[positions], "<u4")))
                yield {"block": block, "bucket": len(docs), "n": len(words), "payload": _pack(payload)}
                continue
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                own = [words[i] for i in order[edges[b] : edges[b + 1]].tolist()]
                if own:
                    yield {"block": block, "bucket": b, "n": len(own), "payload": _pack(np.array([len(w) for w in own], "<u4").tobytes() + b"".join(own))}

    return _batched(rows)


_KIND = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("payload", pa.binary())])


def _batched(rows):
    def run(batches):
        held = []
        for row in rows(batches):
            held.append(row)
            if len(held) >= 256 or len(row["payload"]) > 1 << 20:
                yield pa.RecordBatch.from_pylist(held, _KIND)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, _KIND)

    return run


def _encode(path: str, pattern: str):
    """Rows (block, bucket, words), bucket by bucket -> (block, bucket, ids); each distinct word is encoded once."""

    def rows(batches):
        encode, bucket, known = _encoding(path, pattern)._encode_single_piece, None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                data, n = zstandard.decompress(row["payload"]), row["n"]
                ends = np.append(0, np.cumsum(np.frombuffer(data[: 4 * n], "<u4"), dtype=np.int64)).tolist()
                sizes, out = np.zeros(n, "<u4"), []
                for i in range(n):
                    word = data[4 * n + ends[i] : 4 * n + ends[i + 1]]
                    got = known.get(word)
                    if got is None:
                        got = known[word] = np.array(encode(word), "<u4").tobytes()
                    sizes[i] = len(got) // 4
                    out.append(got)
                yield row | {"payload": _pack(sizes.tobytes() + b"".join(out))}

    return _batched(rows)


def _reassemble():
    """Of a block: its positions row and its words' ids -> (doc_id, ids)."""

    def solve(key, positions: pa.Table, ids: pa.Table) -> pa.Table:
        parts = {r["bucket"]: r for r in ids.to_pylist()}  # equal blocks have equal words
        sizes, flat = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
        for _, p in sorted(parts.items()):
            data = np.frombuffer(zstandard.decompress(p["payload"]), "<u4")
            sizes.append(data[: p["n"]])
            flat.append(data[p["n"] :])
        sizes, flat = np.concatenate(sizes).astype(np.int64), np.concatenate(flat)
        starts = np.cumsum(sizes) - sizes
        out_docs, out_ids, out_len = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for row in positions.to_pylist():
            if row["n"] != len(sizes):
                raise ValueError("a block's words didn't return: docs gave other rows when read again")
            data, n_docs = zstandard.decompress(row["payload"]), row["bucket"]
            docs, counts = np.frombuffer(data[: 8 * n_docs], "<i8"), np.frombuffer(data[8 * n_docs : 16 * n_docs], "<i8")
            at = np.frombuffer(data[16 * n_docs :], "<u4")
            count = sizes[at]
            out_docs.append(docs)
            out_ids.append(flat[ragged(starts[at], count)])
            ends, total = np.cumsum(counts), np.append(0, np.cumsum(count))
            out_len.append(total[ends] - total[ends - counts])
        docs, lengths, data = np.concatenate(out_docs), np.concatenate(out_len), np.concatenate(out_ids)
        offsets = np.append(0, np.cumsum(lengths * 4)).astype(np.int32)
        return pa.table({"doc_id": pa.array(docs), "ids": pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])})

    return solve


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit). ranks: path of a rank file that every executor has."""
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    words = docs.mapInArrow(_scan(pattern, buckets, "words"), _ROW).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    ids = words.mapInArrow(_encode(ranks, pattern), _ROW)
    positions = docs.mapInArrow(_scan(pattern, buckets, "positions"), _ROW)
    return positions.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_reassemble(), "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """encoded with decoded (binary): the ids joined with the token-byte table, which holds the vocabulary and no more."""

    def run(batches):
        table, starts = _token_bytes(ranks)
        for batch in batches:
            column = batch.column("ids")
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            parts, i = [], 0
            while i < len(column):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + (4 << 20), "right")) - 1)
                ids = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[i] : offsets[j]].tobytes()
                ids = np.frombuffer(ids, "<u4").astype(np.int64)
                size = starts[ids + 1] - starts[ids]
                data = table[ragged(starts[ids], size)]
                ends = np.append(0, np.cumsum(size))[(offsets[i : j + 1] - offsets[i]) // 4]
                parts.append(pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]))
                rows = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*rows.columns, parts.pop()], names=[*rows.schema.names, "decoded"])
                i = j

    from pyspark.sql.types import BinaryType, StructType

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields]).add("decoded", BinaryType()))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.PATTERN), path)
    return rows.select("doc_id", F.expr("cast(octet_length(ids) / 4 as long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
