import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gradus.llm import hmm


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute(rows, learned):
    count = Counter(t for d, x in rows if learned(d) for t in tokens(x))
    n, v = sum(count.values()), len(count)
    out = {}
    for doc, text in rows:
        own = tokens(text)
        out[doc] = (not learned(doc), len(own), sum(count[t] > 0 for t in own), n, sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own))
    return out


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(rows, lambda d: zlib.crc32(str(d).encode()) % 5 != 1)
    got = hmm.query(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        held, n, known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total) and r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_is_exact():
    r = np.random.default_rng(1)
    m = hmm.Model(r.integers(0, 9, hmm.CLASSES), r.integers(0, 3, hmm.CLASSES), 5)
    seqs = [r.integers(0, hmm.CLASSES + 1, n) for n in (1, 7, 300, 7)]
    got = hmm.forward(m, np.concatenate(seqs), np.array([len(s) for s in seqs]))
    for s, x in zip(seqs, got, strict=True):
        state, total = m.start * m.emit[s[0]], 0.0
        for o in s[1:]:
            total += math.log10(state.sum())
            state = (state / state.sum()) @ m.move * m.emit[o]
        assert x == pytest.approx(total + math.log10(state.sum()))


def test_baum_welch_raises_likelihood():
    r = np.random.default_rng(2)
    obs, count = np.concatenate([r.integers(a, a + 40, 50) for a in (0, 1000) * 10]), np.full(20, 50)
    m = hmm.Model(np.bincount(obs, minlength=hmm.CLASSES), np.bincount(obs, minlength=hmm.CLASSES) > 0, 20)
    before = hmm.forward(m, obs, count).sum()
    for _ in range(4):
        start, move, emit = hmm.expected(m, obs, count)
        assert start.sum() == pytest.approx(20) and move.sum() == pytest.approx(20 * 49) and emit.sum() == pytest.approx(1000)
        m.set(start + 1e-9, move + 1e-9, emit + 1e-12)
        after = hmm.forward(m, obs, count).sum()
        assert after >= before - 1e-6
        before = after


def plain(m, seq):
    """Forward-backward of one sequence, step by step: log10 likelihood, starts, transitions, emissions."""
    alpha, scale = [], []
    for i, o in enumerate(seq):
        state = (m.start if i == 0 else alpha[-1] @ m.move) * m.emit[o]
        scale.append(state.sum())
        alpha.append(state / state.sum())
    beta, move, emit = np.ones(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros_like(m.emit)
    for i in range(len(seq) - 1, -1, -1):
        emit[seq[i]] += alpha[i] * beta
        gamma = alpha[i] * beta
        right = m.emit[seq[i]] * beta / scale[i]
        if i:
            move += alpha[i - 1][:, None] * m.move * right[None]
        beta = m.move @ right
    return np.log10(scale).sum(), gamma, move, emit


def test_whole_texts_in_stretches_equal_plain_forward_backward():
    r = np.random.default_rng(4)
    m = hmm.Model(r.integers(0, 9, hmm.CLASSES), r.integers(0, 3, hmm.CLASSES), 5)
    m.set(r.random(hmm.STATES), r.random((hmm.STATES,) * 2) ** 3, r.random((hmm.CLASSES + 1, hmm.STATES)) ** 4)
    count = np.array([1, 7, 8, 9, 40, 33, 1, 100, 64])
    obs = r.integers(0, hmm.CLASSES + 1, count.sum())
    seqs = np.split(obs, np.cumsum(count)[:-1])
    found = [plain(m, s) for s in seqs]
    for stretch in (1, 8, 1000):
        assert hmm.forward(m, obs, count, stretch) == pytest.approx([f[0] for f in found])
        for got, i in zip(hmm.expected(m, obs, count, stretch), (1, 2, 3), strict=True):
            assert got == pytest.approx(sum(f[i] for f in found), abs=1e-9)


def test_long_text_is_one_sequence(spark, tmp_path):
    """100,000 words and short texts over several partitions: the summed counts of a round, and every score, as on one machine."""
    r = np.random.default_rng(5)
    rows = [(1, " ".join(f"w{x}" for x in r.integers(0, 300, 100_000)), True)] + [(d, " ".join(f"w{x}" for x in r.integers(0, 400, d)), d % 3 > 0) for d in range(2, 40)]
    spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(5).write.parquet(f"{tmp_path}/d")
    blocks = hmm.text_words(spark.read.parquet(f"{tmp_path}/d"))
    model, _ = hmm.fit(blocks, rounds=1)
    first, _ = hmm.fit(blocks, rounds=0)

    def seq(text):
        raw = [w.encode() for w in text.split()]
        buf, ends = np.frombuffer(b" ".join(raw) + b" ", np.uint8), None
        ends = np.cumsum([len(w) + 1 for w in raw]) - 1
        h = hmm.span_hash(hmm.prefix_sums(buf), np.append(0, ends[:-1] + 1), ends)
        return np.append(hmm._class(h), hmm.CLASSES)

    found = [plain(first, seq(text)) for _, text, learn in rows if learn]
    first.learned(*(sum(f[i] for f in found) for i in (1, 2, 3)))
    for a, b in ((model.start, first.start), (model.move, first.move), (model.emit, first.emit)):
        assert a == pytest.approx(b, rel=1e-7, abs=1e-12)
    count = Counter(w for _, text, learn in rows if learn for w in text.split())
    scores = {x.doc_id: x.score for x in hmm.score(spark.read.parquet(f"{tmp_path}/d"), rounds=1).collect()}
    for doc, text, _ in rows:
        own = seq(text)
        share = model.share(own[:-1], np.array([count[w] for w in text.split()])).sum()
        assert scores[doc] == pytest.approx(plain(model, own)[0] + share, rel=1e-9)


def test_edges(spark, tmp_path):
    rows = [(1, None, True), (2, "", True), (3, "A b a", True), (4, "zzz b", False), (5, "a " * 30_000, True), (6, " \n", None), (3, "A b a", True), (None, "q", True)]
    spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, learn boolean, block long, bucket string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    got = sorted(hmm.score(docs, rounds=1).collect(), key=lambda r: r.doc_id)
    count = Counter(t for d, x, l in rows if l and d for t in tokens(x))
    n, v = sum(count.values()), len(count)
    assert [r.doc_id for r in got] == [1, 2, 3, 3, 4, 5, 6] and {r.train_tokens for r in got} == {n}
    for r in got:
        own = tokens(next(x for d, x, _ in rows if d == r.doc_id))
        assert r.n_tokens == len(own) and r.n_known == sum(count[t] > 0 for t in own)
        assert r.base_score == pytest.approx(sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own))
        assert math.isfinite(r.score)
    assert hmm.score(docs.limit(0)).count() == 0
    assert all(math.isfinite(r.score) and r.n_known == 0 for r in hmm.score(docs.drop("learn").selectExpr("*", "false as learn")).collect())
