import hashlib
import random
import time
import tracemalloc

import numpy as np
import pytest

from gradus.llm import suffix_dedup


def brute(rows, length):
    seen, out = set(), []
    for doc, text in sorted((d, t or "") for d, t in rows):
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return out


def result(df):
    from pyspark.sql import functions as F

    return sorted(tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())


def corpus(seed):
    r = random.Random(seed)
    words = ["été", "ab", "cde", "f", "the ", "zz z", "\n"]
    bits = ["".join(r.choice(words) for _ in range(r.randint(5, 60))) for _ in range(12)]
    rows = [(i, "".join(r.choice(bits)[r.randint(0, 9) :] for _ in range(r.randint(0, 6)))) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "a" * 700), (103, "x" + "a" * 300), (104, rows[3][1]), (105, "short")]


@pytest.mark.parametrize(("seed", "length", "gram", "group", "often"), [(1, 40, 12, 4096, 16), (2, 40, 12, 2, 16), (3, 24, 8, 1, 16), (4, 100, 32, 1, 16), (5, 40, 12, 3, 2), (6, 24, 8, 1, 0)])
def test_against_brute_force(spark, seed, length, gram, group, often):
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(suffix_dedup.remove_repeats(docs, length, gram, group, often=often)) == brute(rows, length)


@pytest.mark.parametrize("window", [41, 100, 333])
def test_windows(spark, window):
    """Texts longer than a window: any cut gives the same result."""
    rows = corpus(7) + [(200, "".join(t or "" for _, t in corpus(7)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert result(suffix_dedup.remove_repeats(docs, 40, 12, 3, window=window)) == brute(rows, 40)


def test_memory_of_a_long_text():
    """The anchors of 16 MB take a few bytes for each of the text's."""
    buf = np.random.default_rng(1).integers(97, 123, 16 << 20).astype(np.uint8)
    tracemalloc.start()
    found = suffix_dedup._block_anchors(buf, np.array([0, len(buf)]), 100, 32, suffix_dedup.WINDOW)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) > 16 << 14 and peak < 320 << 20
    assert (np.diff(found[2]) > 0).all() and found[2][-1] + found[3][-1] == len(buf)


def test_edges(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, s long, e long, akey string")
    assert suffix_dedup.remove_repeats(docs).count() == 0
    text = "0123456789" * 3 + "x" * 90
    rows = [(1, text, 5, None, "k"), (1, text, 5, None, "k"), (2, text, None, 1, None), (None, text, 1, 1, "k")]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, s long, e long, akey string"))
    assert {"s", "e", "akey"} <= set(got.columns)
    assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == [(1, 0), (1, 0), (2, 120)]


def test_query_on_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in suffix_dedup.query(spark, sf).collect()) == brute(rows, 100)


def test_one_id_with_several_texts(spark):
    """Each text is a document of its own, and only what it repeats goes."""
    a, b = "".join(f"{i:03d}" for i in range(50)), "".join(f"{i:03d}" for i in range(500, 550))
    docs = spark.createDataFrame([(1, a, "x"), (2, a, "y"), (2, b, "z"), (2, b, "z")], "doc_id long, text string, kept string")
    got = suffix_dedup.remove_repeats(docs)
    assert sorted((r.doc_id, r.text == a, r.n_removed) for r in got.collect()) == [(1, True, 0), (2, False, 0), (2, False, 0), (2, True, 150)]
    assert got.columns == ["doc_id", "text", "n_bytes", "n_spans", "kept", "n_removed"]


def test_whole_characters(spark):
    """A span that ends inside a character leaves the whole character."""
    text = "é" * 70
    rows = [(1, "x" + text + "è€"), (2, "y" + text + "ê€"), (3, text[:51])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, whole_characters=True).collect()}
    assert bytes(got[1].kept).decode() == "xéè€"  # the bytes before the last of è are a repeat
    assert bytes(got[2].kept).decode() == "yê€" and bytes(got[3].kept) == b""


def test_very_long_text(spark):
    r = random.Random(9)
    long = "".join(r.choice("abcdefgh ") for _ in range(300_000))
    rows = [(1, long), (2, "q" + long[100_000:200_000] + "r"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((x.doc_id, x.n_removed, x.n_spans) for x in suffix_dedup.remove_repeats(docs).collect()) == [(1, 0, 0), (2, 100_000, 1), (3, 0, 0)]


def test_line_in_every_document(spark):
    """A line under other surroundings in all documents: its anchors are listed, dealt one by one, and the result is exact."""
    r = random.Random(3)
    line = "".join(r.choice("abcdefgh ") for _ in range(130))
    around = lambda: "".join(r.choice("klmnopqr ") for _ in range(r.randint(30, 90)))
    rows = [(i, around() + line + around()) for i in range(150)] + [(i, around() + line[:90] + around()) for i in range(150, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert len(suffix_dedup.frequent_anchors(docs, 100, 32, 50, 16)) > 0
    assert result(suffix_dedup.remove_repeats(docs, group=50)) == brute(rows, 100)


def test_many_spans_in_one_text(spark):
    """A long text cut at thousands of places, in time linear in them."""
    r = random.Random(5)
    word = lambda n: "".join(r.choices("abcdefghijklmnop ", k=n))
    lines = [word(120) for _ in range(50)]
    text = "".join(word(20) + lines[i % 50] + word(20) for i in range(12_000))
    rows = [(1, text), (2, "é" + text[5000:9000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.time()
    got = result(suffix_dedup.remove_repeats(docs))
    assert time.time() - began < 90
    assert got == brute(rows, 100) and got[0][3] == 11_950
