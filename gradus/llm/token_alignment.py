"""Operator 12: alignment of two tokenizers' tokens, each distinct text once.

1. Documents are shuffled by their full text; each distinct text, with the number of its documents, is tokenized by both
   tokenizers and cut into groups at the byte offsets where tokens of both end. A block (BLOCK bytes of whole texts) is kept as
   one row: its texts' measures, its distinct pairs of linked ids, and how often each text has each.
2. A pair's count, the documents that hold it linked, is summed over blocks, a row for each block's distinct pair; a text
   weighs as many documents as have it. The highest count of each A id is a table no larger than A's vocabulary.
3. Counts go back to the blocks that hold the pair, and each block adds up its texts' measures.
4. Measures join the documents by the SHA-256 of the text.

Tokens are found chunk by chunk: a chunk begins where neither tokenizer can join what stands on both sides, so groups never
cross it. Distinct chunks are encoded once as long as a worker remembers them (MEMO of them). A text longer than a block is read
window by window, so memory follows the window, its longest stretch without a single space or line end between words, and the
distinct pairs of the text.

A text that is null, empty, or whose tokens' bytes of either tokenizer aren't its own bytes (B reads U+2581 as a space) has no
tokens: zeros and an empty digest. Rows without doc_id and rows that repeat count as documents; each gets its row. Other columns
are ignored. Nothing is cut off or left out, whatever the sizes.
"""

import hashlib
import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import stored
from .spans import prefix_sums, ragged, span_hash, text_blocks

BLOCK, MEMO = 1 << 20, 1 << 18
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_aligners: dict = {}


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level tokenizer writes for each byte: printable ones stand for themselves, the rest follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), np.uint8), np.append(0, np.cumsum([len(x) for x in tokens])).astype(np.int64)


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _flat([str(i).encode() for i in range(n)])


def _unique(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each stands, or its weights' sum."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable") if weights is not None else None
    keys = np.sort(keys) if order is None else keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.diff(np.append(first, len(keys))) if order is None else np.add.reduceat(weights[order], first)


#: The characters of more than one byte that are white space, in UTF-8.
_WIDE_SPACES = {c.encode() for c in map(chr, range(0x80, 0x3001)) if c.isspace()}


def joint_starts(buf: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where chunks begin: at begins, before a single space between two characters that are no white space, and before a line end
    after such a character."""
    cut = np.zeros(len(buf), bool)
    solid = (buf > 32) & (buf != 0xC2) & (buf != 0xE1) & (buf != 0xE2) & (buf != 0xE3)  # begins no white space
    cut[1:-1] = (buf[1:-1] == 32) & solid[2:] & (buf[:-2] != 32)
    lines = np.flatnonzero(buf[1:] == 10) + 1
    lines = lines[buf[lines - 1] > 32]
    if len(lines):
        data = buf.tobytes()
        wide = np.flatnonzero(buf[lines - 1] > 127)
        lines = np.delete(lines, [i for i in wide.tolist() if data[lines[i] - 2 : lines[i]] in _WIDE_SPACES or data[max(0, lines[i] - 3) : lines[i]] in _WIDE_SPACES])
    cut[lines] = True
    cut[begins] = True
    return np.flatnonzero(cut)


_PLAIN = re.compile(rb"\x20[\x21-\x7E]+")


def _plain(chunk: bytes) -> bool:
    """Is it a word after a space that both tokenizers read alike wherever it stands, its own bytes?"""
    if _PLAIN.fullmatch(chunk):
        return True
    if chunk[0] != 32 or len(chunk) < 2 or chunk[1] <= 32 or chunk[1] in b"\xc2\xe1\xe2\xe3" or b"\0" in chunk or "▁".encode() in chunk:
        return False
    return chunk[-1] > 32 and chunk[-2:] not in _WIDE_SPACES and chunk[-3:] not in _WIDE_SPACES


class Aligner:
    """Measures, digest and linked pairs of chunks; those of the last MEMO distinct chunks, about, are remembered."""

    def __init__(self, a_path: str, b_path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        a_tokens = [bytes(letters.get(c, 63) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_tokens = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = [_flat(a_tokens), _flat(b_tokens)]
        self.digits = _digits(max(len(a_tokens), len(b_tokens)))
        self.space = pieces.index("▁")
        self.memo = memo
        self._forget()

    def _forget(self):
        self.number: dict[int, int] = {}
        self.strings: list[bytes] = []
        self.sums, self.valid = np.zeros((0, 4), np.int64), np.zeros(0, bool)
        self.pairs, self.times, self.ends = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _alone(self, texts: list[str]):
        """Lists of ids of A and of B of each text, as if it stood within another."""
        b = self.b.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)  # a space is put before each
        b = [([self.space] if t == " " else ids) if t[0] == " " else ids[2:] for t, ids in zip(texts, b, strict=True)]
        return [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)], b

    def _ids(self, chunks: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B, chunk after chunk, and each chunk's count. Words after a space are encoded many at a time."""
        plain = np.fromiter(map(_plain, chunks), bool, len(chunks))
        words, rest = [c for c, p in zip(chunks, plain.tolist(), strict=True) if p], [c for c, p in zip(chunks, plain.tolist(), strict=True) if not p]
        size = np.array([len(w) for w in words], np.int64)
        out = []
        for side, (alone, step) in enumerate(zip(self._alone([c.decode() for c in rest]), (512, 64), strict=True)):
            joined = [b"".join(words[k : k + step]).decode() for k in range(0, len(words), step)]
            found = [x.ids for x in self.a.encode_batch_fast(joined, add_special_tokens=False)] if side == 0 else self.b.encode([t[1:] for t in joined], num_threads=1)
            flat = np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for x in found)])
            starts = self.bytes[side][1]
            ends, borders = np.cumsum(starts[flat + 1] - starts[flat]), np.cumsum(size)
            upto = np.searchsorted(ends, borders)
            if len(words) and not (upto[-1] == len(ends) - 1 and np.array_equal(ends[upto], borders)):
                raise ValueError("a token crosses a word's border")
            count = np.zeros(len(chunks), np.int64)
            count[plain] = np.diff(upto + 1, prepend=0)
            count[~plain] = [len(ids) for ids in alone]
            first = np.cumsum(count) - count
            ids = np.empty(int(count.sum()), np.int64)
            ids[ragged(first[plain], count[plain])] = flat
            ids[ragged(first[~plain], count[~plain])] = [i for x in alone for i in x]
            out.append((ids, count))
        return out

    def _learn(self, keys: list[int], chunks: list[bytes]) -> None:
        sides, buf = self._ids(chunks), np.frombuffer(b"".join(chunks), np.uint8)
        size = np.array([len(c) for c in chunks], np.int64)
        valid = np.ones(len(chunks), bool)
        for (ids, count), (table, starts) in zip(sides, self.bytes, strict=True):
            length = starts[ids + 1] - starts[ids]
            of = np.repeat(np.arange(len(chunks)), count)
            same = np.bincount(of, weights=length, minlength=len(chunks)) == size
            some = same[of]
            own = np.repeat(same, size)
            ok = table[ragged(starts[ids[some]], length[some])] == buf[own]
            same[np.repeat(np.flatnonzero(same), size[same])[~ok]] = False
            valid &= same
        tokens = []  # of valid chunks: id, end, chunk
        place = np.cumsum(np.where(valid, size, 0))
        for (ids, count), (_, starts) in zip(sides, self.bytes, strict=True):
            of = np.repeat(np.arange(len(chunks)), count)
            ids, of = ids[valid[of]], of[valid[of]]
            tokens.append((ids, np.cumsum(starts[ids + 1] - starts[ids]), of))
        (a, a_end, a_of), (b, b_end, b_of) = tokens
        borders = np.intersect1d(a_end, b_end, assume_unique=True)
        group_of = np.searchsorted(place, borders)
        groups = [np.searchsorted(borders, end) for end in (a_end, b_end)]
        n_a, n_b = (np.bincount(g, minlength=len(borders)) for g in groups)
        per = lambda of, w=None: np.bincount(of, weights=w, minlength=len(chunks)).astype(np.int64)
        sums = np.stack([per(a_of), per(b_of), per(group_of), per(group_of, n_a * n_b)], axis=1)
        # pairs: distinct ids of each group, all of A with all of B
        wide = len(self.bytes[1][1]) + len(self.bytes[0][1])
        (ka, ca), (kb, cb) = _unique(groups[0] * wide + a), _unique(groups[1] * wide + b)
        ub = np.bincount(kb // wide, minlength=len(borders))
        first_b = np.cumsum(ub) - ub
        repeat = ub[ka // wide]
        left, right = np.repeat(np.arange(len(ka)), repeat), ragged(first_b[ka // wide], repeat)
        code = (ka[left] % wide) << 32 | kb[right] % wide
        order = np.lexsort((code, group_of[ka[left] // wide]))
        chunk, code, times = group_of[ka[left] // wide][order], code[order], (ca[left] * cb[right])[order]
        first = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
        chunk, code, times = chunk[first], code[first], np.add.reduceat(times, first) if len(first) else times
        # digest: a1,a2|b1; for each group
        last = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in groups]
        ids, signs = np.concatenate([a, b]), np.concatenate([np.where(last[0], 124, 44), np.where(last[1], 59, 44)]).astype(np.uint8)
        order = np.argsort(np.concatenate([groups[0] * 2, groups[1] * 2 + 1]), kind="stable")
        ids, signs, of = ids[order], signs[order], np.concatenate([a_of, b_of])[order]
        table, starts = self.digits
        length = starts[ids + 1] - starts[ids]
        ends = np.cumsum(length + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        out[ragged(ends - length - 1, length)] = table[ragged(starts[ids], length)]
        out[ends - 1] = signs
        edges = np.append(0, np.cumsum(np.bincount(of, weights=length + 1, minlength=len(chunks)).astype(np.int64))).tolist()
        out = out.tobytes()

        self.number |= dict(zip(keys, range(len(self.strings), len(self.strings) + len(keys)), strict=True))
        self.strings += [out[s:e] for s, e in zip(edges, edges[1:], strict=False)]
        self.sums, self.valid = np.concatenate([self.sums, sums]), np.concatenate([self.valid, valid])
        self.pairs, self.times = np.concatenate([self.pairs, code]), np.concatenate([self.times, times])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.bincount(chunk, minlength=len(chunks)))])

    def window(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each chunk among those remembered."""
        code, seen = pd.factorize(span_hash(prefix_sums(buf), start, end))
        if len(self.number) + len(seen) > self.memo:
            self._forget()
        seen = seen.tolist()
        new = [i for i, k in enumerate(seen) if k not in self.number]
        if new:
            first = np.zeros(len(seen), np.int64)
            first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            first = first[new]
            data = buf.tobytes()
            self._learn([seen[i] for i in new], [data[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)])
        return np.fromiter(map(self.number.__getitem__, seen), np.int64, len(seen))[code]


def _aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _led(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text with a space before it; an empty one stays empty."""
    size = np.diff(offsets)
    led = size + (size > 0)
    ends = np.append(0, np.cumsum(led))
    out = np.full(int(ends[-1]), 32, np.uint8)
    out[ragged(ends[:-1] + (size > 0), size)] = buf
    return out, ends


def _windows(buf: np.ndarray, offsets: np.ndarray, size: int):
    """(bytes, chunk starts, chunk ends, text of each chunk): all texts at once, or one long text in parts that end with a chunk."""
    if len(buf) <= size or len(offsets) > 2:
        start = joint_starts(buf, offsets[:-1][np.diff(offsets) > 0])
        yield buf, start, np.append(start[1:], len(buf)), np.searchsorted(offsets, start, "right") - 1
        return
    at, width = 0, size
    while at < len(buf):
        part = buf[at : at + width]
        start = joint_starts(part, np.zeros(1, np.int64))
        if at + len(part) < len(buf):
            start = start[start < len(part) - 2]  # what follows decides on the last ones
            if len(start) < 2:
                width *= 2
                continue
            part, start = part[: start[-1]], start[:-1]
        yield part, start, np.append(start[1:], len(part)), np.zeros(len(start), np.int64)
        at, width = at + len(part), size


class _Digest:
    """SHA-256 of groups, each followed by a semicolon, without the last one."""

    def __init__(self):
        self.sha, self.held = hashlib.sha256(), b""

    def add(self, groups: bytes) -> None:
        self.sha.update(self.held)
        self.held = groups

    def raw(self) -> bytes:
        self.sha.update(self.held[:-1])
        return self.sha.digest()


def align_block(aligner: Aligner, buf: np.ndarray, offsets: np.ndarray, size: int = BLOCK):
    """Measures and digest (raw, empty without tokens) of each text; and text, pair and times of all links, by text and pair."""
    buf, offsets = _led(buf, offsets)
    n = len(offsets) - 1
    sums, valid, digests = np.zeros((n, 4), np.int64), np.diff(offsets) > 0, [_Digest() for _ in range(n)]
    texts, pairs, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part, start, end, text in _windows(buf, offsets, size) if len(buf) else ():
        number = aligner.window(part, start, end)
        for k in range(4):
            sums[:, k] += np.bincount(text, weights=aligner.sums[number, k], minlength=n).astype(np.int64)
        valid[text[~aligner.valid[number]]] = False
        key, count = _unique(text * len(aligner.strings) + number)
        owner, number_of = key // len(aligner.strings), key % len(aligner.strings)
        size_of = aligner.ends[number_of + 1] - aligner.ends[number_of]
        at = ragged(aligner.ends[number_of], size_of)
        seen, code = np.unique(aligner.pairs[at], return_inverse=True)
        key, total = _unique(np.repeat(owner, size_of) * max(1, len(seen)) + code, aligner.times[at] * np.repeat(count, size_of))
        texts.append(key // max(1, len(seen)))
        pairs.append(seen[key % max(1, len(seen))])
        times.append(total)
        edges, number, get = np.searchsorted(text, np.arange(n + 1)).tolist(), number.tolist(), aligner.strings.__getitem__
        for i in range(n):
            digests[i].add(b"".join(map(get, number[edges[i] : edges[i + 1]])))
    text, pair, time = np.concatenate(texts), np.concatenate(pairs), np.concatenate(times)
    if len(texts) > 2:  # of one text, over its windows
        pair, time = _unique(pair, time)
        text = np.zeros(len(pair), np.int64)
    some = valid[text]
    sums[~valid] = 0
    return sums, [d.raw() if v else b"" for d, v in zip(digests, valid.tolist(), strict=True)], text[some], pair[some], time[some]


# --- the job ---

_BLOCKS = "block long, n int, payload binary, pairs binary, counts binary"


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(x.tobytes() for x in arrays), 1)


def _read(data: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _scan(a_path: str, b_path: str, size: int):
    """Rows (text, copies) -> a row a block."""

    def run(batches):
        aligner, base, k = _aligner(a_path, b_path), TaskContext.get().partitionId() << 33, 0
        for rows, buf, offsets in text_blocks(batches, "copies", "text", size):
            sums, digests, text, pair, time = align_block(aligner, buf, offsets, size)
            raw = buf.tobytes()
            keys = b"".join(hashlib.sha256(raw[s:e]).digest() for s, e in zip(offsets.tolist(), offsets[1:].tolist(), strict=False))
            shas = b"".join(d or bytes(32) for d in digests)
            distinct, number = np.unique(pair, return_inverse=True)
            copies = rows.column("copies").to_numpy(zero_copy_only=False)
            held = np.bincount(number, weights=copies[text], minlength=len(distinct)).astype("<i8")
            per = np.bincount(text, minlength=len(copies)).astype("<i8")
            payload = zstandard.compress(keys + shas + sums.astype("<i8").tobytes() + per.tobytes() + time.astype("<i8").tobytes() + number.astype("<u4").tobytes(), 1)
            row = {"block": base + k, "n": len(copies), "payload": payload, "pairs": _pack(np.diff(distinct, prepend=0).astype("<i8")), "counts": _pack(held)}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("block", pa.int64()), ("n", pa.int32()), ("payload", pa.binary()), ("pairs", pa.binary()), ("counts", pa.binary())]))
            k += 1

    return run


def _pairs(batches):
    for batch in batches:
        for row in batch.to_pylist():
            pair = np.cumsum(_read(row["pairs"]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), row["block"])), pa.array(pair), pa.array(_read(row["counts"]))], names=["block", "pair", "n"])


def _finish(key, blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """Of a block: its row, and (pair, n, best) of its pairs -> a row a text."""
    names = ["key", *MEASURES, "n_best", "count_sum", "groups_sha256"]
    row = blocks.to_pylist()[0]
    n, data = row["n"], zstandard.decompress(row["payload"])
    keys, shas, data = data[: 32 * n], data[32 * n : 64 * n], data[64 * n :]
    sums = np.frombuffer(data[: 32 * n], "<i8").reshape(n, 4)
    per = np.frombuffer(data[32 * n : 40 * n], "<i8")
    links = int(per.sum())
    time, number = np.frombuffer(data[40 * n : 40 * n + 8 * links], "<i8"), np.frombuffer(data[40 * n + 8 * links :], "<u4")
    pair, total, best = (counts.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    if not np.array_equal(pair[order], np.cumsum(_read(row["pairs"]))):
        raise ValueError("a block's pairs didn't return")
    total, best = total[order][number], best[order][number]
    text = np.repeat(np.arange(n), per)

    def added(values):
        before = np.append(0, np.cumsum(values))
        ends = np.cumsum(per)
        return before[ends] - before[ends - per]

    columns = [sums[:, k] for k in range(4)] + [added(time * best), added(time * total)]
    hexes = lambda raw: [raw[32 * i : 32 * i + 32].hex() for i in range(n)]
    digests = [d if s else "" for d, s in zip(hexes(shas), (sums[:, 0] > 0).tolist(), strict=True)]
    return pa.table(dict(zip(names, [pa.array(hexes(keys)), *(pa.array(np.ascontiguousarray(c)) for c in columns), pa.array(digests)], strict=True)))


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, block: int = BLOCK) -> DataFrame:
    """Blocks of distinct texts, written: their measures and links, for pair_counts() and text_measures()."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    return stored(texts.mapInArrow(_scan(a_path, b_path, block), _BLOCKS), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a, b, n: documents that hold the two ids linked, and best: is it the highest count of a?"""
    rows = blocks.select("block", "pairs", "counts").mapInArrow(_pairs, "block long, pair long, n long")
    counts = stored(rows.groupBy("pair").agg(F.sum("n").alias("n")).select(F.shiftright("pair", 32).alias("a"), F.expr("pair & 4294967295").alias("b"), "n"), "pairs")
    highest = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("highest")))  # no more rows than A has ids
    return counts.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


def text_measures(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """key (SHA-256 of the text), measures, n_best, count_sum, groups_sha256: a row a distinct text."""
    wanted = blocks.select("block", "pairs", "counts").mapInArrow(_pairs, "block long, pair long, n long").select("block", "pair")
    back = wanted.join(counts.select((F.shiftleft("a", 32) + F.col("b")).alias("pair"), "n", F.col("best").cast("long").alias("best")), "pair")
    schema = "key string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocks.drop("counts").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_finish, schema)


def align(docs: DataFrame, a_path: str, b_path: str, block: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    blocks = aligned_blocks(docs, a_path, b_path, block)
    measures = stored(text_measures(blocks, pair_counts(blocks)), "measures")
    rows = docs.select("doc_id", F.sha2(F.col("text").cast("string"), 256).alias("key"))
    empty = {c: F.coalesce(c, F.lit(0).cast("long")) for c in (*MEASURES, "n_best", "count_sum")}
    joined = rows.join(measures, "key", "left").withColumns(empty | {"groups_sha256": F.coalesce("groups_sha256", F.lit(""))})
    return joined.select("doc_id", *MEASURES, "n_best", "count_sum", "groups_sha256")


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, groups: `a1,a2|b1;a3|b2`, the ids of A and B of each group of every row; empty without tokens."""

    def run(batches):
        aligner = _aligner(a_path, b_path)
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text", BLOCK):
            buf, offsets = _led(buf, offsets)
            n = len(offsets) - 1
            out, valid = [[] for _ in range(n)], np.diff(offsets) > 0
            for part, start, end, text in _windows(buf, offsets, BLOCK) if len(buf) else ():
                number = aligner.window(part, start, end)
                valid[text[~aligner.valid[number]]] = False
                for i, k in zip(text.tolist(), number.tolist(), strict=True):
                    out[i].append(aligner.strings[k])
            texts = [b"".join(x)[:-1].decode() if v else "" for x, v in zip(out, valid.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "groups"])

    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, StructType([docs.schema["doc_id"]]).add("groups", "string"))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
