import re
from collections import Counter

import corpus_pipeline
from gradus.llm import toxicity
from gradus.llm.shared import fold

from .test_dedup import brute_near
from .test_tokens import WORD_BPE, crc, whole


def rows_of(df):
    return sorted((r.doc_id, r.text or "") for r in df.collect())


def cut(rows, length=100):
    seen, out = set(), []
    for doc, text in rows:
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        out.append((doc, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def valid(raw):
    try:
        return raw.decode() is not None
    except UnicodeDecodeError:
        return False


def test_every_stage_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, rows_of(docs)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{i}")
        out = spark.read.parquet(f"{tmp_path}/{i}")
        if name == "packing":
            got = out.collect()
            ids = {d: whole(WORD_BPE, t) + [2] for d, t in before}
            assert sum(r.length for r in got) == sum(map(len, ids.values()))
            assert all(r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(ids[r.doc_id]) for r in got)
            continue
        assert out.columns == columns
        after = rows_of(out)
        if name == "toxicity":
            labels = spark.read.parquet(f"{sf}/labels.parquet").where(fold("doc_id") != 0)
            model = toxicity.train(docs.where(fold("doc_id") != 0), labels)
            bad = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
            assert after == [(d, t) for d, t in before if d not in bad]
        elif name == "exact dedup":
            best = {}
            for d, t in before:
                key = re.sub(r"[\x20\x09-\x0D]", "", t)
                best[key] = min(best.get(key, (1, 0, "")), (-len(t), d, t))
            assert after == sorted((d, t) for _, d, t in best.values())
        elif name == "near dedup":
            kept = {d for d, _, _, k in brute_near(before) if k}
            assert after == [(d, t) for d, t in before if d in kept]
        else:
            expected = cut(before)
            assert all(t.encode() == x for (_, t), (_, x) in zip(after, expected, strict=True) if valid(x))
            assert all(len(x) <= len(t.encode()) <= len(x) + 6 * (1 + x.count(b"\n")) + 60 for (_, t), (_, x) in zip(after, expected, strict=True)) and not any("\ufffd" in t for _, t in after)
            assert all(r.n_chars == len(r.text) for r in out.collect())
        docs, before = out, after
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()).keys() == {d for d, _ in before}


def test_pipeline_edges(spark, tmp_path):
    spark.createDataFrame([(1, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, None, "en", "s", None), (2, "", None, None, 0), (3, "a b", "en", "s", 3), (3, "a b", "en", "s", 3), (None, "x", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {1, 2, 3}
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_stages_with_clashing_columns_shared_ids_ties_and_long_texts(spark, tmp_path):
    """An own column named like an operator's stays; of rows with one doc_id each is judged by its own text."""
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(60_000))
    a, b = "one two three four five six seven", "red green blue black white grey pink"
    rows = [(1, a, "p", "k", 7), (2, a, "q", "k", 7), (2, b, "r", "k", 7), (3, long, "s", "k", 7), (4, long + " w1 w2", "t", "k", 7), (5, None, "u", None, None), (5, None, "u", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, row string, n_chars int")
    copies = corpus_pipeline.drop_copies(spark, docs, str(tmp_path))
    assert copies.columns == docs.columns
    assert sorted((r.doc_id, r.kept) for r in copies.collect()) == [(1, "p"), (2, "r"), (3, "s"), (4, "t"), (5, "u"), (5, "u")]
    near = corpus_pipeline.drop_near_copies(spark, copies, str(tmp_path))
    assert sorted((r.doc_id, r.kept) for r in near.collect()) == [(1, "p"), (2, "r"), (3, "s"), (5, "u"), (5, "u")]
    cut_ = corpus_pipeline.cut_repeats(spark, copies, str(tmp_path))
    got = {(r.doc_id, r.kept): r for r in cut_.collect()}
    assert cut_.columns == docs.columns and got[2, "r"].text == b and got[3, "s"].text == long
    assert got[4, "t"].row == "k" and len(got[4, "t"].text) == got[4, "t"].n_chars < 200
