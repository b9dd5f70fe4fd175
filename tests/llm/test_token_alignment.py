import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gradus.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
a_tok.encode_special_tokens = True
LETTERS = ta._byte_letters()


def tokens(text):
    """(ids, ends) of both, or None."""
    if not text:
        return None
    raw = (" " + text).encode()
    a = a_tok.encode(" " + text, add_special_tokens=False).ids
    b = b_tok.encode(text)
    a_bytes = [bytes(LETTERS[c] for c in a_tok.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return None
    return [(ids, np.cumsum([len(x) for x in parts]).tolist()) for ids, parts in ((a, a_bytes), (b, b_bytes))]


def groups(text):
    found = tokens(text)
    if found is None:
        return []
    (a, a_end), (b, b_end) = found
    borders = sorted(set(a_end) & set(b_end))
    out, i, j = [], 0, 0
    for border in borders:
        p, q = a_end.index(border, i) + 1, b_end.index(border, j) + 1
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def written(found):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)


def brute(rows):
    parts = [(doc, groups(text)) for doc, text in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in parts]
    count = Counter(pair for c in links for pair in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (doc, g), c in zip(parts, links, strict=True):
        digest = hashlib.sha256(written(g).encode()).hexdigest() if g else ""
        out.append((doc, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()), sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()), digest))
    return sorted(out, key=repr)


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])).astype(np.int64)


@settings(max_examples=250, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB '\n\t   　▁́é漢1!.s\x1c\x85Σ🙂İ<"), max_size=40), min_size=1, max_size=4), st.sampled_from([8, 64, 1 << 20]))
def test_chunks_give_the_groups_of_whole_texts(texts, size):
    aligner = ta._aligner(A, B)
    for some in (texts, texts[:1]):
        sums, digests, text, pair, time = ta.align_block(aligner, *block(some), size)
        for i, t in enumerate(some):
            g = groups(t)
            assert sums[i].tolist() == [sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(len(x) * len(y) for x, y in g)]
            assert digests[i] == (hashlib.sha256(written(g).encode()).digest() if g else b"")
            links = Counter((x << 32 | y) for a, b in g for x in a for y in b)
            assert dict(zip(pair[text == i].tolist(), time[text == i].tolist(), strict=True)) == links


def test_a_worker_that_forgets():
    aligner, r = ta.Aligner(A, B, memo=40), random.Random(2)
    for _ in range(40):
        t = " ".join(r.choice(["Zürich", "tokeniser", "x=1", "naïve", "42", "\nline"]) + str(r.randrange(30)) for _ in range(30))
        _, digests, *_ = ta.align_block(aligner, *block([t]))
        assert digests[0] == hashlib.sha256(written(groups(t)).encode()).digest()


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in ta.query(spark, sf).collect()), key=repr) == brute(rows)


def test_edges(spark):
    """Nulls, empty and repeated texts, a text of many windows, ids that repeat, clashing columns."""
    rows = [(1, None), (2, ""), (3, " "), (4, "   two  three   "), (5, "has ▁ in it"), (6, "漢字かな交じり文🙂" * 30), (None, "same text"), (7, "same text"), (7, "same text"), (8, "same text again"), (9, "<|endoftext|> <s> <0x0A>"), (10, "long text of words\n and lines " * 2000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, block int").repartition(3)
    for size in (1 << 12, ta.BLOCK):
        assert sorted((tuple(r) for r in ta.align(docs, A, B, size).collect()), key=repr) == brute(rows)
    assert sorted((tuple(r) for r in ta.groups(docs, A, B).collect()), key=repr) == sorted(((d, written(groups(t))) for d, t in rows), key=repr)
    assert ta.align(docs.limit(0), A, B).count() == 0
