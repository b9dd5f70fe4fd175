"""Operator 6: a hidden Markov language model over words.

Words (A-Z lower-cased) and one end a text are hashed into CLASSES classes; the end is a class of its own. Hidden states
emit classes, and a word has its share of its class, by counts: both tables keep their size whatever the corpus, and the
word counts, which grow with it, are joined to the texts and never broadcast.

1. One pass over the texts writes blocks (some MB of whole texts): the block's distinct words as 64-bit hashes, and the texts
   as numbers among them. All that follows reads these blocks, which are less than half as large as the texts.
2. Each block's words with their training counts are dealt by class into buckets, whose number follows the words listed. Buckets
   meet across all blocks, add up the counts, and hand every block its words' counts (learned from all training texts).
3. Baum-Welch, ROUNDS times over all training texts: each partition adds up its expected transitions and emissions by
   scaled forward-backward over whole texts; partitions' sums are added chunk by chunk. A long text is computed in stretches side
   by side: products of its transition matrices give the exact state distribution at each stretch's two ends, so nothing is cut.
4. In each block the counts join the words; the scaled forward recursion over whole texts gives the exact likelihood
   of the classes, and the words' shares of their classes are added.

Rows without doc_id are left out; a null text is empty (its end alone). Rows that share a doc_id fare each by itself, and all
are learned from. Other columns are ignored. Without training rows the counts are 0 and the model scores by its start values.
"""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fold, stored
from .spans import LOWER, U, prefix_sums, span_hash, text_blocks, words

CLASSES, STATES, ROUNDS, BLOCK, CHUNKS = 1 << 15, 8, 4, 4 << 20, 64
STRETCH = 512  #: tokens of a text computed one after the other; longer texts are computed in several stretches side by side
BUCKET_WORDS = 1 << 20  #: words listed in a bucket, about
_ROW = "block long, bucket int, n int, payload binary"
_BLOCK = "block long, n_words int, n_learn int, docs binary, learn binary, counts binary, hashes binary, places binary"


def _tokens(buf: np.ndarray, offsets: np.ndarray):
    """Hash and text of each word; 2 MB of text at a time."""
    parts, i = [], 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + (2 << 20), "right")) - 1)
        low = LOWER[buf[offsets[i] : offsets[j]]]
        start, end, text = words(low, offsets[i : j + 1] - offsets[i])
        parts.append((span_hash(prefix_sums(low), start, end), text + i))
        i = j
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _class(h: np.ndarray) -> np.ndarray:
    return (h & U(CLASSES - 1)).astype(np.int64)


def _with_ends(classes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class sequences with the end's class (CLASSES) after each text; tokens a text."""
    out = np.full(len(classes) + len(count), CLASSES)
    out[np.arange(len(classes)) + np.repeat(np.arange(len(count)), count)] = classes
    return out, count + 1


def _distinct(h: np.ndarray):
    """Distinct hashes by class and hash, and each token's place among them."""
    number, seen = pd.factorize(h)
    order = np.lexsort((seen, _class(seen)))
    place = np.empty(len(seen), np.int64)
    place[order] = np.arange(len(seen))
    return seen[order], place[number]


def _scan(batches):
    """Texts (doc_id, text, learn) -> rows of _BLOCK."""
    base = TaskContext.get().partitionId() << 32
    for number, (rows, buf, offsets) in enumerate(text_blocks(batches, "doc_id", "text", BLOCK)):
        docs, learn = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "learn"))
        h, text = _tokens(buf, offsets)
        seen, place = _distinct(h)
        count = np.bincount(text, minlength=rows.num_rows)
        data = [docs.astype("<i8"), learn.astype(np.uint8), count.astype("<u4"), seen.astype("<u8"), place.astype("<u4")]
        columns = [pa.array([base + number]), pa.array([len(seen)], pa.int32()), pa.array([int(learn.sum())], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in data]]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "n_words", "n_learn", "docs", "learn", "counts", "hashes", "places"])


def text_words(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, learn), learn not null -> blocks of texts as numbers among their distinct words."""
    return stored(docs.mapInArrow(_scan, _BLOCK), "words")


def _unpacked(row: dict):
    """learn, words a text, hashes, places of a block."""
    return [np.frombuffer(row[c], k) for c, k in (("learn", bool), ("counts", "<u4"), ("hashes", "<u8"), ("places", "<u4"))]


def _blocks(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


_KIND = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("payload", pa.binary())])


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _KIND, strict=True)], schema=_KIND)


def _listed(buckets: int):
    """Blocks -> (block, bucket, n, hashes and training counts): a word is known by its 64-bit hash."""

    def run(batches):
        for row in _blocks(batches):
            learn, counts, seen, place = _unpacked(row)
            count = np.bincount(place[np.repeat(learn, counts)], minlength=len(seen))
            bucket, out = _class(seen) % buckets, []
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                own = order[edges[b] : edges[b + 1]]
                out.append((row["block"], b, len(own), zlib.compress(seen[own].tobytes() + count[own].astype("<u4").tobytes(), 1)))
            if out:
                yield _rows(out)

    return run


def _counted(batches):
    """Of a bucket: every block's words with their counts over all blocks; and the bucket's sums by class as one row with n = -1."""

    def solve(rows):
        parts = [(r["block"], r["n"], zlib.decompress(r["payload"])) for r in rows]
        h = np.concatenate([np.frombuffer(p[: 8 * n], U) for _, n, p in parts])
        number, seen = pd.factorize(h)
        total = np.bincount(number, np.concatenate([np.frombuffer(p[8 * n :], "<u4") for _, n, p in parts]), len(seen)).astype(np.int64)
        at, out = 0, []
        for block, n, _ in parts:
            out.append((block, rows[0]["bucket"], n, zlib.compress(total[number[at : at + n]].astype("<u8").tobytes(), 1)))
            at += n
        known = total > 0
        own = _class(seen[known])
        some = np.unique(own)
        sums = np.stack([some, np.bincount(own, total[known], CLASSES)[some].astype(np.int64), np.bincount(own, minlength=CLASSES)[some]])
        out.append((0, rows[0]["bucket"], -1, sums.astype("<i8").tobytes()))
        return _rows(out)

    held = []
    for row in _blocks(batches):
        if held and held[0]["bucket"] != row["bucket"]:
            yield solve(held)
            held = []
        held.append(row)
    if held:
        yield solve(held)


class Model:
    """start, move (STATES x STATES), emit (classes + 1 rows, a state a column), and log10 of a known or unknown word's share of its class."""

    def __init__(self, class_tokens: np.ndarray, class_words: np.ndarray, texts: int, seed: int = 0):
        self.tokens, self.words, self.texts = class_tokens, class_words, texts
        self.n, self.v = int(class_tokens.sum()) + texts, int(class_words.sum()) + (texts > 0)
        prior = np.append(class_tokens + 0.5 * (class_words + 1), texts + 0.5)
        self.prior = prior / prior.sum()
        noise = np.exp(np.random.default_rng(seed).standard_normal((CLASSES + 1, STATES)))
        self.set(np.ones(STATES), np.eye(STATES) * 40 + 1, self.prior[:, None] * noise)

    def set(self, start, move, emit):
        self.start, self.move = start / start.sum(), move / move.sum(1, keepdims=True)
        self.emit = emit / emit.sum(0)

    def learned(self, start, move, emit, mass: float = 2000.0):
        self.set(start + 1, move + 1, emit + mass * self.prior[:, None])

    def share(self, classes: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of a word's part of its class: known words by count, and one unknown word a class."""
        return np.log10((count + 0.5) / (self.tokens[classes] + 0.5 * (self.words[classes] + 1)))


class Stretches:
    """Texts (obs, count) in stretches of at most `size` tokens, longest stretch first, and how states enter and leave them.

    Tokens are laid out step by step: the first tokens of all stretches, then the second ones, so that a step is one slice.
    """

    def __init__(self, model: Model, obs: np.ndarray, count: np.ndarray, size: int):
        self.model = model
        parts = np.maximum(1, -(-count // size))
        text = np.repeat(np.arange(len(count)), parts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        first = (np.cumsum(count) - count)[text] + nth * size
        length = np.minimum(size, count[text] - nth * size)
        order = np.argsort(-length, kind="stable")
        self.text, self.nth, self.parts, self.length = text[order], nth[order], parts[text[order]], length[order]
        live = np.searchsorted(-self.length, -np.arange(self.length[0] if len(order) else 0), "left")
        self.live, self.at = live.tolist(), np.append(0, np.cumsum(live)).tolist()
        step = np.repeat(np.arange(len(live)), live)
        self.row = np.arange(len(obs)) - np.repeat(self.at[:-1], live)
        self.obs = obs[first[order][self.row] + step]
        self.emit = model.emit[self.obs]
        self.last = np.array(self.at[:-1] + [0])[self.length - 1] + np.arange(len(order))
        self.enter, self.leave = np.zeros((len(order), STATES)), np.ones((len(order), STATES))
        many = np.flatnonzero(self.parts > 1)
        if len(many):
            self._join(many)

    def _products(self, many: np.ndarray) -> np.ndarray:
        """Of each stretch: P[i, j] in proportion to the probability of its tokens and of state j at its last one, given state i before it."""
        move, length = self.model.move, self.length[many]
        head = (self.nth[many] == 0)[:, None, None]  # a text's first token has no step before it
        out = np.where(head, np.eye(STATES), move) * self.emit[many][:, None, :]
        live = np.searchsorted(-length, -np.arange(length[0]), "left").tolist()
        for t in range(1, len(live)):
            k = live[t]
            step = (out[:k].reshape(-1, STATES) @ move).reshape(k, STATES, STATES)
            step *= self.emit[self.at[t] + many[:k]][:, None, :]
            if t % 8 == 0:
                step /= step.sum((1, 2), keepdims=True)
            out[:k] = step
        return out / out.sum((1, 2), keepdims=True)

    def _join(self, many: np.ndarray) -> None:
        product = self._products(many)
        by = np.lexsort((self.nth[many], self.text[many]))  # a text's stretches one after the other
        head = np.flatnonzero(self.nth[many][by] == 0)
        parts = self.parts[many][by][head]
        head, parts = head[np.argsort(-parts, kind="stable")], np.sort(parts)[::-1]
        left, right = np.tile(self.model.start, (len(head), 1)), np.ones((len(head), STATES))
        for k in range(parts[0]):
            n = int((parts > k).sum())
            at = by[head[:n] + k]
            self.enter[many[at]] = left[:n]
            left = np.einsum("ni,nij->nj", left[:n], product[at])
            left /= left.sum(1, keepdims=True)
        for k in range(parts[0] - 1, -1, -1):
            n = int((parts > k).sum())
            at = by[head[:n] + k]
            self.leave[many[at]] = right[:n]
            right[:n] = np.einsum("nij,nj->ni", product[at], right[:n])
            right[:n] /= right[:n].sum(1, keepdims=True)

    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        """The states' distribution at every token, and its scale."""
        alpha, scale, ones = np.empty_like(self.emit), np.empty(len(self.obs)), np.ones(STATES)
        for t, n in enumerate(self.live):
            a = self.at[t]
            now = alpha[a : a + n]
            if t:
                np.matmul(alpha[self.at[t - 1] : self.at[t - 1] + n], self.model.move, out=now)
            else:
                now[:] = np.where((self.nth == 0)[:, None], self.model.start, self.enter @ self.model.move)
            now *= self.emit[a : a + n]
            total = now @ ones
            now /= total[:, None]
            scale[a : a + n] = total
        return alpha, scale


def forward(model: Model, obs: np.ndarray, count: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """log10 likelihood of each whole text, by the scaled forward recursion."""
    s = Stretches(model, obs, count, stretch)
    return np.bincount(s.text[s.row], np.log10(s.forward()[1]), len(count))


def expected(model: Model, obs: np.ndarray, count: np.ndarray, stretch: int = STRETCH):
    """Expected starts, transitions and emissions of whole texts, by scaled forward-backward."""
    s = Stretches(model, obs, count, stretch)
    alpha, scale = s.forward()
    right = s.emit / scale[:, None]
    back, move = np.ascontiguousarray(model.move.T), np.zeros((STATES, STATES))
    beta = s.leave / (alpha[s.last] * s.leave).sum(1, keepdims=True)
    ends = alpha[s.last] * beta
    for t in range(len(s.live) - 1, 0, -1):
        n, a, before = s.live[t], s.at[t], s.at[t - 1]
        step = right[a : a + n]
        step *= beta[:n]
        now = alpha[before : before + n]
        move += now.T @ step
        np.matmul(step, back, out=beta[:n])
        now *= beta[:n]  # from here on, the probability of each state at that token
    alpha[s.last] = ends
    later = np.flatnonzero(s.nth > 0)  # the step into a stretch
    move += s.enter[later].T @ (beta[later] * right[later])
    emit = np.stack([np.bincount(s.obs, alpha[:, k], CLASSES + 1) for k in range(STATES)], 1)
    return alpha[: len(s.nth)][s.nth == 0].sum(0), move * model.move, emit


def _expectations(model):
    def run(batches):
        m = model.value
        start, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES + 1, STATES))
        for row in _blocks(batches):
            learn, counts, seen, place = _unpacked(row)
            obs, count = _with_ends(_class(seen)[place[np.repeat(learn, counts)]], counts[learn].astype(np.int64))
            if len(count):
                for total, more in zip((start, move, emit), expected(m, obs, count), strict=True):
                    total += more
        flat = np.concatenate([start, move.ravel(), emit.ravel()]).astype("<f8")
        size = -(-len(flat) // CHUNKS)
        chunks = pa.array([flat[i * size : (i + 1) * size].tobytes() for i in range(CHUNKS)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CHUNKS, dtype=np.int32)), chunks], names=["chunk", "sums"])

    return run


def _added(batches):
    total: dict[int, np.ndarray] = {}
    for row in _blocks(batches):
        part = np.frombuffer(row["sums"], "<f8")
        total[row["chunk"]] = total[row["chunk"]] + part if row["chunk"] in total else part
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["chunk", "sums"])


def baum_welch(blocks: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """blocks as text_words() gives them: all their texts with learn are learned from, in every round."""
    blocks = blocks.select("learn", "counts", "hashes", "places")
    for _ in range(rounds):
        shared = blocks.sparkSession.sparkContext.broadcast(model)  # a fixed number of states and classes
        sums = blocks.mapInArrow(_expectations(shared), "chunk int, sums binary").repartition(CHUNKS, "chunk").mapInArrow(_added, "chunk int, sums binary")
        flat = np.concatenate([np.zeros(0), *[np.frombuffer(r.sums, float) for r in sorted(sums.collect(), key=lambda r: r.chunk)]])
        if not len(flat):
            return model
        a, b = STATES, STATES + STATES * STATES
        model.learned(flat[:a], flat[a:b].reshape(STATES, STATES), flat[b:].reshape(CLASSES + 1, STATES))
        shared.unpersist()
    return model


def word_counts(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Each block's words' counts over the texts to learn from, bucket by bucket; and the number of buckets."""
    listed = blocks.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-listed // BUCKET_WORDS))
    blocks = blocks.select("block", "learn", "counts", "hashes", "places")
    dealt = blocks.mapInArrow(_listed(buckets), _ROW).repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
    return stored(dealt.mapInArrow(_counted, _ROW), "counts"), buckets


_SCORES = [("doc_id", pa.int64()), ("learn", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]


def _scored(model):
    def solve(key, texts: pa.Table, counts: pa.Table) -> pa.Table:
        m, out = model.value, []
        found = {r["bucket"]: np.frombuffer(zlib.decompress(r["payload"]), "<u8") for r in counts.to_pylist()}
        for row in texts.to_pylist():  # one
            learn, words_, seen, place = _unpacked(row)
            docs, words_ = np.frombuffer(row["docs"], "<i8"), words_.astype(np.int64)
            n = len(docs)
            text, own = np.repeat(np.arange(n), words_), _class(seen)
            count = np.zeros(len(seen), np.int64)
            order = np.argsort(own % m.buckets, kind="stable")
            count[order] = np.concatenate([np.zeros(0, np.int64), *[found[b].astype(np.int64) for b in sorted(found)]])
            known = np.bincount(text, count[place] > 0, n) + (m.texts > 0)
            base = np.bincount(text, np.log10(count + 0.5)[place], n) + np.log10(m.texts + 0.5)
            share = np.bincount(text, m.share(own, count)[place], n)
            obs, size = _with_ends(own[place], words_)
            score = forward(m, obs, size) + share
            base -= size * np.log10(m.n + 0.5 * (m.v + 1))
            out.append([pa.array(docs), pa.array(learn), pa.array(size), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)])
        columns = [pa.concat_arrays(x) for x in zip(*out, strict=True)] if out else [pa.array([], t) for _, t in _SCORES]
        return pa.table(columns, schema=pa.schema(_SCORES))

    return solve


def fit(blocks: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """blocks as text_words() gives them -> the model, and the blocks' word counts."""
    counts, buckets = word_counts(blocks)
    tokens, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.where("n = -1").select("payload").toLocalIterator():  # a row a bucket, of at most CLASSES cells together
        at, n, v = np.frombuffer(r.payload, "<i8").reshape(3, -1)
        tokens[at] += n
        kinds[at] += v
    model = Model(tokens, kinds, int(blocks.agg(F.sum("n_learn")).first()[0] or 0))
    model.buckets = buckets
    return baum_welch(blocks, model, rounds), counts.where("n >= 0")


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """docs (doc_id, text, learn) -> doc_id, learn, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce("learn", F.lit(False)).alias("learn"))
    blocks = text_words(docs)
    model, counts = fit(blocks, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_scored(shared), "doc_id long, learn boolean, n_tokens long, n_known long, base double, score double")
    return found.select("doc_id", "learn", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (fold("doc_id") != 1).alias("learn"))
    return score(docs).select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
