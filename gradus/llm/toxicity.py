"""Operator 9: toxicity of texts whose words may be disguised.

Words that look disguised (figures or signs among letters, letters repeated three times, single letters set apart) are
read as noisy forms, whatever their length: a lattice gives each sign the letters it may stand for and lets repeats and
separators vanish, and Viterbi finds the most probable word under a letter trigram model learned from all texts that may be
learned from. Letters count as set apart from three in a row. The restored text is then scored by a logistic regression over hashed pieces of words (4 to 6 bytes, and whole words).

The classifier is fitted on labelled rows: up to POSITIVES and NEGATIVES of them, by the smallest hashes of doc_id,
weighted back to the shares of all labelled rows; equal texts count once. Of all pieces that a few toxic texts hold, it keeps
the FEATURES most typical of them. A whole word among them that OFTEN of the toxic texts hold sets a least score, its own odds: one
such word is enough.

A null text is empty and scores like a text without typical pieces. Null labels are not learned from; a doc_id labelled
more than once counts as toxic if any label says so. Without labels of both kinds the score is the share of toxic labels (0
without any). Rows without doc_id are left out; rows that share one fare each by itself. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fold, stored
from .spans import LOWER, SPACE, U, prefix_sums, span_hash, text_blocks, words

POSITIVES, NEGATIVES, FEATURES, PIECES = 8000, 16_000, 2048, (4, 5, 6)
SIEVE = 1 << 22  #: cells of the table by which pieces of other texts are picked that toxic texts hold, too
OFTEN = 0.03  #: share of toxic texts that hold a word which is enough by itself
MEMO = 64  #: bytes of the longest words whose readings are kept for the next time
LEAST_GAIN = 15.0  #: nats by which a piece must tell toxic texts from others; chance gives this to one piece in millions
#: Letters a sign may stand for (fixed values).
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
SIGN_COST, REPEAT_COST, SEPARATORS = 1.0, 1.0, b".-_*~ "
_LETTERS, _EDGE, _OTHER = 28, 26, 27
_CLASS = np.full(256, _EDGE, np.int64)
_CLASS[128:] = _OTHER
_CLASS[97:123] = np.arange(26)
_CLASS[65:91] = np.arange(26)
_IS_LETTER = (_CLASS < 26) | (_CLASS == _OTHER)
_IS_SIGN = np.zeros(256, bool)
_IS_SIGN[[ord(c) for c in SIGNS if ord(c) < 128]] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b"!|+(")] = True  #: punctuation unless a letter follows
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(b".-_*~")] = True


def _letter_counts(batches):
    total = np.zeros(_LETTERS**3, np.int64)
    for _, buf, offsets in text_blocks(batches, "doc_id", "text"):
        x = np.full(len(buf) + len(offsets), _EDGE)
        x[np.arange(len(buf)) + np.repeat(np.arange(1, len(offsets)), np.diff(offsets))] = _CLASS[buf]
        total += np.bincount((x[:-2] * _LETTERS + x[1:-1]) * _LETTERS + x[2:], minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])


def letter_model(docs: DataFrame) -> np.ndarray:
    """log p(letter | two before), from all of docs; 28 x 28 x 28."""
    cells = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(_letter_counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(_LETTERS**3)
    table[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy()
    table = table.reshape((_LETTERS,) * 3)
    pair = table.sum(0) + 0.5
    pair = pair / pair.sum(1, keepdims=True)
    table = table + 5 * pair[None]
    return np.log(table / table.sum(2, keepdims=True))


def decode(token: str, model: np.ndarray) -> str:
    """The most probable reading of a disguised word, by Viterbi over its lattice; letters outside ASCII stay."""
    states: dict = {(_EDGE, _EDGE): (0.0, None)}  # score, and the letters read as a chain from the last one
    for i, raw in enumerate(token):
        c = raw.lower()
        options = [(x, SIGN_COST) for x in SIGNS.get(c, "")]
        if c.isalpha():
            options.append((c, 0.0))
        if i and token[i - 1].lower() == c and (options or c == " "):
            options.append(("", REPEAT_COST))
        if raw.encode()[:1] in (bytes([x]) for x in SEPARATORS):
            options = [("", 0.3), (" ", 0.0)]
        if not options:
            options = [(c, 0.0)]
        found: dict = {}
        for (a, b), (score, text) in states.items():
            for x, cost in options:
                if x:
                    k = int(_CLASS[x.encode()[0]])
                    key, value = (b, k), score + model[a, b, k] - cost
                else:
                    key, value = (a, b), score - cost
                if key not in found or value > found[key][0]:
                    found[key] = (value, (text, x) if x else text)
        states = found
    best = max(states, key=lambda at: states[at][0] + model[at[0], at[1], _EDGE])
    text, out = states[best][1], []
    while text is not None:
        text, x = text
        out.append(x)
    return "".join(reversed(out))


def disguised(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that look like disguised words: start, end, text."""
    start, end, text = words(buf, offsets)
    if not len(start):
        return start, end, text
    letter, after, before = _IS_LETTER[buf], np.append(buf[1:], 32), np.append(32, buf[:-1])
    before = before.astype(np.uint8)
    sign = _IS_SIGN[buf] & (_IS_LETTER[after] | (_IS_LETTER[before] & ~_IS_MARK[buf]))
    low = LOWER[buf]
    triple = np.zeros(len(buf), bool)
    triple[2:] = letter[2:] & (low[2:] == low[1:-1]) & (low[2:] == low[:-2])
    gap = _IS_BREAK[buf] & _IS_LETTER[before] & _IS_LETTER[after]
    total = {k: np.append(0, np.cumsum(v)) for k, v in (("letter", letter), ("sign", sign), ("triple", triple), ("gap", gap))}
    n = {k: v[end] - v[start] for k, v in total.items()}
    odd = ((n["sign"] > 0) & (n["letter"] > 0)) | (n["triple"] > 0) | ((n["gap"] >= 2) & (n["letter"] == n["gap"] + 1))
    single = (end - start == 1) & (letter[start] | _IS_SIGN[buf[start]])
    joined = np.zeros(len(start), bool)
    joined[1:] = single[1:] & single[:-1] & (start[1:] == end[:-1] + 1) & (text[1:] == text[:-1])
    head = np.flatnonzero(single & ~joined)
    tail = np.flatnonzero(single & ~np.append(joined[1:], False))
    long = tail - head >= 2
    covered = np.zeros(len(start), bool)
    covered[single] = np.repeat(long, tail - head + 1)
    odd &= ~covered
    s, e, t = np.append(start[odd], start[head[long]]), np.append(end[odd], end[tail[long]]), np.append(text[odd], text[head[long]])
    order = np.argsort(s, kind="stable")
    return s[order], e[order], t[order]


class Restorer:
    def __init__(self, model: np.ndarray):
        self.model, self.memo = model, {}

    def __call__(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, end, text = disguised(buf, offsets)
        if not len(start):
            return buf, offsets
        data, parts, grown, at = buf.tobytes(), [], np.zeros(len(offsets), np.int64), 0
        for s, e, t in zip(start.tolist(), end.tolist(), text.tolist(), strict=True):
            token = data[s:e]
            got = self.memo.get(token)
            if got is None:
                got = decode(token.decode("utf-8", "replace"), self.model).encode()
                if len(token) <= MEMO and len(self.memo) < 500_000:
                    self.memo[token] = got
            parts += [data[at:s], got]
            grown[t + 1] += len(got) - (e - s)
            at = e
        return np.frombuffer(b"".join([*parts, data[at:]]), np.uint8), offsets + np.cumsum(grown)


def restore(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """doc_id, text with disguised words read as what they stand for."""

    def run(batches):
        restorer = Restorer(model)
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text"):
            new, at = restorer(buf, offsets)
            text = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(new.tobytes())])
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), text.cast(pa.string())], names=["doc_id", "text"])

    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(run, "doc_id long, text string")


def pieces(buf: np.ndarray, offsets: np.ndarray):
    """(hash, text) of word pieces, a size at a time."""
    low = LOWER[buf]
    start, end, text = words(low, offsets)
    sums = prefix_sums(low)
    yield span_hash(sums, start, end) ^ U(1), text
    gaps = np.append(0, np.cumsum(SPACE[low]))
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for n in PIECES:
        if len(low) >= n:
            at = np.flatnonzero((gaps[n:] == gaps[:-n]) & (owner[n - 1 :] == owner[: len(owner) - n + 1]))
            yield span_hash(sums, at, at + n), owner[at]


class Lookup:
    """Number of a hash among the chosen ones."""

    def __init__(self, chosen: np.ndarray):
        self.chosen = chosen
        self.order = np.argsort(chosen)
        self.sorted = chosen[self.order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(chosen & U((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, number) pairs."""
        found = []
        for h, text in pieces(buf, offsets):
            some = np.flatnonzero(self.maybe[(h & U((1 << 20) - 1)).astype(np.int64)])
            h, text = h[some], text[some]
            at = np.minimum(np.searchsorted(self.sorted, h), max(0, len(self.sorted) - 1))
            ok = self.sorted[at] == h if len(self.sorted) else np.zeros(len(h), bool)
            found.append(text[ok].astype(np.int64) * len(self.chosen) + self.order[at[ok]])
        pair = np.unique(np.concatenate(found))
        return pair // max(1, len(self.chosen)), pair % max(1, len(self.chosen))


def _piece_counts(sieve=None):
    """Texts that hold each piece (of those in the sieve); by blocks and a size at a time, so memory doesn't follow the partition."""

    def run(batches):
        for _, buf, offsets in text_blocks(batches, "doc_id", "text"):
            for i, (h, t) in enumerate(pieces(buf, offsets)):
                if sieve is not None:
                    some = np.flatnonzero(sieve.value[(h & U(SIEVE - 1)).astype(np.int64)])
                    h, t = h[some], t[some]
                order = np.lexsort((t, h))
                h, t = h[order], t[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
                value, n = np.unique(h[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n), pa.array(np.full(len(value), i == 0))], names=["h", "n", "word"])

    return run


def typical_pieces(sample: DataFrame, count: dict[int, int]) -> DataFrame:
    """h, word, with_toxic, without, gain: the FEATURES pieces that tell toxic texts best, over all pieces that a few of them hold.

    Pieces are counted, compared and ranked as rows; the driver sees the chosen ones, and which cells of the sieve are taken."""
    least = max(3, int(0.003 * count[1]))
    often = sample.where("toxic = 1").mapInArrow(_piece_counts(), "h long, n long, word boolean").groupBy("h", "word").agg(F.sum("n").alias("with_toxic")).where(F.col("with_toxic") >= least)
    often = stored(often, "pieces")
    cells = often.select(F.col("h").bitwiseAND(F.lit(SIEVE - 1)).cast("int").alias("cell")).distinct().toPandas()["cell"].to_numpy(np.int64)  # SIEVE numbers at most
    taken = np.zeros(SIEVE, bool)
    taken[cells] = True
    sieve = sample.sparkSession.sparkContext.broadcast(taken)
    seen = sample.where("toxic = 0").mapInArrow(_piece_counts(sieve), "h long, n long, word boolean").groupBy("h", "word").agg(F.sum("n").alias("without"))
    both = often.join(seen, ["h", "word"], "left").withColumn("without", F.coalesce("without", F.lit(0)))
    p, q = (F.col("with_toxic") + 0.5) / (count[1] + 1), (F.col("without") + 0.5) / (count[0] + 1)
    gain = F.when(p > 2 * q, count[1] * (p * F.log(p / q) + (1 - p) * F.log((1 - p) / (1 - q))))
    return both.withColumn("gain", gain).where(F.col("gain") > LEAST_GAIN).orderBy(F.desc("gain"), "h", "word").limit(FEATURES)


def _hit_rows(chosen: np.ndarray):
    def run(batches):
        lookup = Lookup(chosen)
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text"):
            text, number = lookup.hits(buf, offsets)
            ends = np.append(0, np.cumsum(np.bincount(text, minlength=len(offsets) - 1))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([rows.column("toxic"), pa.ListArray.from_arrays(pa.array(ends), pa.array(number.astype(np.int32)))], names=["toxic", "hits"])

    return run


def logistic(text: np.ndarray, piece: np.ndarray, y: np.ndarray, weight: np.ndarray, n: int, steps: int = 2000, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias, by Adam on all rows."""
    w, mean, square = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = np.log((weight * y).sum() / (weight * (1 - y)).sum())
    for step in range(1, steps + 1):
        z = np.clip(w[n] + np.bincount(text, w[piece], len(y)), -30, 30)
        r = weight * (1 / (1 + np.exp(-z)) - y) / weight.sum()
        g = np.append(np.bincount(piece, r[text], n), r.sum())
        g[:n] += decay * w[:n] / max(1, n)
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return w[:n], float(w[n])


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> dict:
    """docs (doc_id, text) and labels (doc_id, toxic) of rows that may be learned from."""
    letters = letter_model(docs.where("doc_id is not null"))
    labels = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = [labels.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k, most in ((1, positives), (0, negatives))]
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sample = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")  # positives + negatives rows of two numbers at most
    sample = stored(restore(sample.select("doc_id", "text"), letters).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").dropDuplicates(["text", "toxic"]), "labelled")
    share = labels.agg(F.avg("toxic")).first()[0] or 0.0
    count = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not count.get(0) or not count.get(1):
        return {"letters": letters, "pieces": np.zeros(0, U), "weights": np.zeros(0), "bias": None, "alone": np.zeros(0), "share": share}
    best = typical_pieces(sample, count).toPandas()
    hashes, with_toxic, without = best["h"].to_numpy(np.int64).view(U), best["with_toxic"].to_numpy(float), best["without"].to_numpy(float)
    alone = np.log(with_toxic / count[1] * share) - np.log((without + 1) / count[0] * (1 - share))
    alone = np.where(best["word"].to_numpy(bool) & (with_toxic >= OFTEN * count[1]) & (best["gain"].to_numpy(float) > 2 * LEAST_GAIN), alone, -np.inf)
    rows = sample.mapInArrow(_hit_rows(hashes), "toxic int, hits array<int>").toPandas()  # a bounded sample's hits among few pieces
    y = rows["toxic"].to_numpy(float)
    size = rows["hits"].map(len).to_numpy(np.int64)
    piece = np.concatenate([*rows["hits"], np.zeros(0, np.int32)]).astype(np.int64)
    weight = np.where(y == 1, share / count[1], (1 - share) / count[0]) * len(y)
    weights, bias = logistic(np.repeat(np.arange(len(y)), size), piece, y, weight, len(hashes))
    return {"letters": letters, "pieces": hashes, "weights": weights, "bias": bias, "alone": alone, "share": share}


def _values(model: dict):
    """A function from a block's bytes and offsets to its texts' scores."""
    restorer, lookup = Restorer(model["letters"]), Lookup(model["pieces"])

    def run(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if model["bias"] is None:
            return np.full(n, float(model["share"]))
        text, piece = lookup.hits(*restorer(buf, offsets))
        z = model["bias"] + np.bincount(text, model["weights"][piece], n)
        np.maximum.at(z, text, model["alone"][piece])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, predicted."""

    def run(batches):
        values = _values(model)
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text"):
            value = values(buf, offsets)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(value), pa.array((value >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(run, "doc_id long, score double, predicted int")


def without_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of docs, all columns, whose text isn't predicted to be toxic; one pass, no shuffle. Rows without doc_id go, too."""

    def run(batches):
        values = _values(model)
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text"):
            yield rows.filter(pa.array(values(buf, offsets) < 0.5))

    return docs.where("doc_id is not null").mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    model = train(docs.where(fold("doc_id") != 0).select("doc_id", "text"), labels.where(fold("doc_id") != 0).select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")
