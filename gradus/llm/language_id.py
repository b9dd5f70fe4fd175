"""Operator 10: language identification of mixed-language texts.

Training counts, for each language, hashed byte trigrams of words (ASCII and Latin-1 capitals folded) and the scripts of
its letters, over all documents that may be learned from; the tables have BUCKETS cells a language, whatever the corpus.
A word's script narrows its candidates to languages that use it; each candidate's score is the word's log probability;
Viterbi over the words, with a penalty for every switch, labels spans. A text's language is the one that holds the most
bytes of its words that have letters, and the score is that share.

A null text, or one without letters, is `und` with score 0. A null lang is not learned from. Without anything to learn
from, every text is `und`. Rows without doc_id are left out; rows that share one fare each by itself.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fold
from .spans import LOWER, SPACE, text_blocks, words

BUCKETS, SCRIPTS, PENALTY, BLOCK = 1 << 15, 16, 12.0, 8 << 20
MOST_LANGUAGES = 1000
#: Script of a character by its first UTF-8 byte (fixed ranges): 4 Latin, 5 Greek, 6 Cyrillic, 7 Armenian or Hebrew,
#: 8 Arabic, 9 scripts of India and South-East Asia, 10 others below U+2000, 11 symbols and kana, 12 CJK, 13 Hangul and others
_SCRIPT = np.zeros(256, np.uint8)
for _low, _high, _script in ((0x41, 0x5A, 4), (0x61, 0x7A, 4), (0xC3, 0xCA, 4), (0xCD, 0xCF, 5), (0xD0, 0xD4, 6), (0xD5, 0xD7, 7), (0xD8, 0xDF, 8), (0xE0, 0xE0, 9), (0xE1, 0xE1, 10), (0xE3, 0xE3, 11), (0xE4, 0xE9, 12), (0xEA, 0xED, 13)):
    _SCRIPT[_low : _high + 1] = _script
#: First bytes of letters, signs and emoji alike; there the character decides. 1 to 3 are those that other scripts in a word
#: outweigh: U+2000 to U+2FFF, full- and half-width forms, U+10000 to U+1FFFF.
_MIXED = np.zeros(256, bool)
_MIXED[[0xC2, 0xCB, 0xE2, 0xEF, 0xF0]] = True
_CHARACTER = np.zeros(0x40000, np.uint8)
for _low, _high, _script in ((0x80, 0xBF, 4), (0x2C0, 0x2FF, 4), (0x2000, 0x2FFF, 1), (0xF900, 0xFAFF, 12), (0xFB00, 0xFB06, 4), (0xFB07, 0xFB4F, 7), (0xFB50, 0xFEFF, 8), (0xFF00, 0xFFFF, 2), (0x10000, 0x1FFFF, 3), (0x20000, 0x3FFFF, 12)):
    _CHARACTER[_low : _high + 1] = [_script * chr(c).isalpha() for c in range(_low, _high + 1)]


def _folded(buf: np.ndarray) -> np.ndarray:
    out = LOWER[buf]
    capital = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)) + 1
    out[capital] += 32
    return out


def _spaced(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before the first and after each."""
    out = np.full(len(buf) + len(offsets), 32, np.uint8)
    out[np.arange(len(buf)) + np.repeat(np.arange(1, len(offsets)), np.diff(offsets))] = buf
    return out, offsets + np.arange(len(offsets))


def _trigrams(buf: np.ndarray) -> np.ndarray:
    x = np.where(SPACE[buf], np.uint8(32), buf).astype(np.uint32)
    key = (x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)
    return (key >> np.uint32(17)).astype(np.int64)


def _word_scripts(buf: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Highest script code among the letters of each word (words in order, covering all but spaces)."""
    if not len(start):
        return np.zeros(0, np.uint8)
    script, at = _SCRIPT[buf], np.flatnonzero(_MIXED[buf])
    first, (b, c, d) = buf[at], (np.append(buf, np.zeros(3, np.uint8))[at + i].astype(np.int64) & 63 for i in (1, 2, 3))
    point = np.where(first < 0xE0, (first & 31).astype(np.int64) << 6 | b, np.where(first < 0xF0, (first & 15).astype(np.int64) << 12 | b << 6 | c, b << 12 | c << 6 | d))
    script[at] = _CHARACTER[point]
    return np.maximum.reduceat(script, start)


def _counts(languages: list[str]):
    cells = BUCKETS + SCRIPTS

    def run(batches):
        index = {x: i for i, x in enumerate(languages)}
        total = np.zeros(len(languages) * cells, np.int64)
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text"):
            lang = np.array([index[x] for x in rows.column("lang").to_pylist()])
            buf, at = _spaced(_folded(buf), offsets)
            start, end, text = words(buf, np.array([0, len(buf)]))
            text = np.searchsorted(at, start, "right") - 1
            script = _word_scripts(buf, start)
            lettered = script > 0
            key, n = _trigrams(buf), (end - start)[lettered]
            inside = np.zeros(len(buf) + 1, np.int64)
            np.add.at(inside, start[lettered] - 1, 1)
            np.add.at(inside, start[lettered] - 1 + n, -1)
            pos = np.flatnonzero(np.cumsum(inside)[: len(key)])
            owner = lang[np.minimum(np.searchsorted(at, pos, "right") - 1, len(lang) - 1)] if len(lang) else pos
            total += np.bincount(owner * cells + key[pos], minlength=len(total))
            total += np.bincount(lang[text[lettered]] * cells + BUCKETS + script[lettered], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    return run


def train(docs: DataFrame) -> dict:
    """From (doc_id, text, lang): every row with a lang. The model is two arrays of a fixed size for each language."""
    docs = docs.where("lang is not null").select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    languages = sorted(r.lang for r in docs.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    cells = docs.mapInArrow(_counts(languages), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(len(languages) * (BUCKETS + SCRIPTS))
    table[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy()
    table = table.reshape(len(languages), BUCKETS + SCRIPTS)
    grams, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
    log_p = np.log((grams + 0.1) / (grams.sum(1, keepdims=True) + 0.1 * BUCKETS))
    uses = scripts >= 0.001 * np.maximum(1, scripts.sum(1, keepdims=True))
    uses[:, ~uses.any(0)] = True
    return {"languages": languages, "log_p": log_p.astype(np.float32), "uses": uses}


def viterbi(score: np.ndarray, first: np.ndarray, count: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word; sequences first[i] ... first[i] + count[i] side by side, the longest first."""
    label = np.zeros(len(score), np.int8 if score.shape[1] < 128 else np.int16)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    if not len(count) or not count[0]:
        return label
    live = np.searchsorted(-count, -np.arange(count[0]), "left")
    came = np.zeros(score.shape, bool)  # came from the best label of the word before
    best = np.zeros(len(score), label.dtype)  # the best label up to a word
    state = score[first[: live[0]]].copy()
    best[first[: live[0]]] = state.argmax(1)
    for t in range(1, count[0]):
        n = live[t]
        state, at = state[:n], first[:n] + t
        other = state.max(1, keepdims=True) - penalty
        came[at] = other > state
        state = np.maximum(state, other) + score[at]
        best[at] = state.argmax(1)
    last = first + count - 1
    has = count > 0
    label[last[has]] = best[last[has]]
    for t in range(count[0] - 1, 0, -1):
        at = first[: live[t]] + t
        label[at - 1] = np.where(came[at, label[at]], best[at - 1], label[at])
    return label


def _labelled(model: dict, penalty: float):
    languages, log_p, uses = model["languages"], model["log_p"], model["uses"]

    def word_scores(buf, offsets):
        start, end, text = words(buf, offsets)
        spaced, at = _spaced(_folded(buf), offsets)
        shift = text + 1
        script = _word_scripts(spaced, start + shift)
        key, score = _trigrams(spaced), np.zeros((len(start), len(languages)), np.float32)
        for i in range(len(languages)):
            total = np.append(0.0, np.cumsum(log_p[i][key], dtype=float))
            score[:, i] = total[end + shift - 1] - total[start + shift - 1]
        score[~uses[:, script].T] = -1e4
        score[script == 0] = 0
        return start, end, text, script, score

    def run(batches):
        names = pa.array([*languages, "und"])
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text", BLOCK):
            n, parts, i = len(offsets) - 1, [], 0
            while i < n:
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + (1 << 20), "right")) - 1)
                start, end, text, script, score = word_scores(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                parts.append((start + offsets[i], end + offsets[i], text + i, script, score))
                i = j
            start, end, text, script, score = (np.concatenate(x) for x in zip(*parts, strict=True))
            count = np.bincount(text, minlength=n)
            first = np.cumsum(count) - count
            label = viterbi(score, first, count, penalty).astype(np.int64) if languages else np.zeros(len(start), np.int64)
            lettered = script > 0
            weight = np.bincount(text[lettered] * max(1, len(languages)) + label[lettered], (end - start)[lettered], n * max(1, len(languages))).reshape(n, -1)
            total, best = weight.sum(1), weight.argmax(1)
            share = np.where(total > 0, weight[np.arange(n), best] / np.maximum(total, 1), 0.0)
            for t in np.flatnonzero((total > 0) & ~_has_latin(buf, offsets)):  # bytes that may not be letters after all
                if not any(map(str.isalpha, buf[offsets[t] : offsets[t + 1]].tobytes().decode("utf-8", "replace"))):
                    total[t] = share[t] = 0
            best = np.where((total > 0) & bool(languages), best, len(languages))
            share = np.where(best == len(languages), 0.0, share)
            new = np.ones(len(start), bool)
            new[1:] = (text[1:] != text[:-1]) | (label[1:] != label[:-1])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(start)) - 1
            spans = pa.StructArray.from_arrays([pa.array((start[head] - offsets[text[head]]) if len(head) else head), pa.array((end[tail] - offsets[text[head]]) if len(head) else head), names.take(pa.array(label[head]))], names=["start", "end", "lang"])
            ends = np.append(0, np.cumsum(np.bincount(text[head], minlength=n))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), names.take(pa.array(best)), pa.array(share), pa.ListArray.from_arrays(pa.array(ends), spans)], names=["doc_id", "lang_pred", "score", "spans"])

    return run


def _has_latin(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    letters = np.append(0, np.cumsum((LOWER[buf] >= 97) & (LOWER[buf] <= 122)))
    return letters[offsets[1:]] > letters[offsets[:-1]]


def label_languages(docs: DataFrame, model: dict, penalty: float = PENALTY) -> DataFrame:
    """doc_id, lang_pred, score, spans (byte ranges of the UTF-8 text, with their language)."""
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_labelled(model, penalty), "doc_id long, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(fold("doc_id") != 0))
    return label_languages(docs, model).select("doc_id", (fold("doc_id") == 0).alias("held_out"), "lang_pred", "score")
