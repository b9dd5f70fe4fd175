import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from gradus.llm import word_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def brute(rows):
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=word_bpe.load_ranks(PATH), special_tokens={})
    out = []
    for doc, text in rows:
        ids = enc.encode_ordinary(text or "")
        out.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out)


def digest(df):
    return sorted((r.doc_id, len(r.ids) // 4, hashlib.sha256(r.ids).hexdigest(), hashlib.sha256(r.decoded).hexdigest()) for r in df.collect())


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in word_bpe.query(spark, sf).collect()) == brute(rows)


def test_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "  it's\n\n  a 漢字 tëst\t 　 x   y123!!\u0085 z <|endoftext|> "), (4, "ab " * 20_000), (5, "x" * 5000), (-6, "ß'LL we'll \x1c z"), (1, None), (7, "\n \n"), (7, "\n \n")]
    spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, bucket int, ids string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    assert digest(word_bpe.decode(word_bpe.encode(docs, PATH, PATTERN), PATH)) == brute(rows)
    assert word_bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0
