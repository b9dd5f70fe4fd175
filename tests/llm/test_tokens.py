import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gradus.llm import packing, token_files
from gradus.llm.tokens import file_codec

SPACE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
_loaded = {}


def whole(path, text):
    if path not in _loaded:
        _loaded[path] = Tokenizer.from_file(path)
        _loaded[path].encode_special_tokens = True
    return _loaded[path].encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])).astype(np.int64)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB '\n\t   　́é漢1!.s\x1c\x85ΣİI"), max_size=30), min_size=1, max_size=4))
def test_chunks_give_the_ids_of_whole_texts(texts):
    for path, kind in ((SPACE_BPE, "space"), (WORD_BPE, "words")):
        ids, count = file_codec(path, kind).ids(*block(texts))
        expected = [whole(path, t) for t in texts]
        assert count.tolist() == [len(x) for x in expected]
        assert ids.tolist() == sum(expected, [])


def check_packing(rows, docs, capacity=4096):
    """Round trip, gapless sequences, little padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, text in docs:
        expected = whole(WORD_BPE, text or "") + [2]
        found = sorted(pieces.pop(doc))
        assert sum((x[1] for x in found), []) == expected
        assert all(x[2] == len(expected) for x in found)
        assert [x[0] for x in found] == [sum(len(y[1]) for y in found[:i]) for i in range(len(found))]
    assert not pieces
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
        padding += 0 if not end & (end - 1) else capacity - end
    assert padding <= 16 * len(sequences)


def test_packing(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000, None), (10_001, ""), (10_002, "Ünï cödé " * 3000), (10_003, "　 \x1c")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string").repartition(3)
    check_packing(packing.pack(docs, WORD_BPE).collect(), rows)
    check_packing(packing.pack(docs, WORD_BPE, capacity=256).collect(), rows, 256)
    assert packing.pack(docs.limit(0), WORD_BPE).count() == 0
    assert packing.pack(spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id long, text string"), WORD_BPE).count() == 2


def test_packing_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = packing.query(spark, sf).collect()
    expected = {r.doc_id: whole(WORD_BPE, r.text or "") + [2] for r in docs}
    assert all(r.ids_crc32 == crc(expected[r.doc_id][r.start : r.start + r.length]) for r in got)
    assert sum(r.length for r in got) == sum(map(len, expected.values()))


def test_wavelet_matrix():
    r = np.random.default_rng(1)
    for n in (1, 7, 512, 513, 5000):
        ids = (r.integers(0, 50_000, n) * (r.random(n) < 0.5)).astype(np.uint32)
        m = token_files.WaveletMatrix.build(ids)
        assert (m.decode() == ids).all()
        for at in r.integers(0, n, 20):
            token = int(ids[at])
            where = np.flatnonzero(ids == token)
            assert m.access(int(at)) == token and m.count(token) == len(where) and m.count(token, 0, int(at)) == (where < at).sum()
            k = random.randrange(len(where))
            assert m.locate(token).tolist() == where.tolist()
            assert m.select(token, k) == where[k] and m.select(token, len(where)) == -1
        assert m.count(60_001) == (ids == 60_001).sum() and m.count(1 << 20) == 0


def expected_files(rows):
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        ids = whole(SPACE_BPE, text or "") + [0]
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_token_files(spark, sf, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in token_files.query(spark, sf).collect()) == expected_files(rows)
    rows = rows[:40] + [(-5, None), (10_001, ""), (10_002, "  a\n b " * 3000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows] + [(None, "z", 1)], "doc_id long, text string, part int")
    token_files.write_token_files(docs, f"{tmp_path}/t", SPACE_BPE, shard=2000)
    got = token_files.read_token_files(spark, f"{tmp_path}/t").join(token_files.shard_starts(spark, f"{tmp_path}/t"), ["part", "seq"]).collect()
    assert sorted((r.doc_id, r.before + r["at"], r.n_tokens, zlib.crc32(r.ids)) for r in got) == expected_files(rows)
    whole_ids = [x for _, text in sorted((r for r in rows), key=lambda r: r[0]) for x in [*whole(SPACE_BPE, text or ""), 0]]
    tokens = [whole_ids[0], whole_ids[77], 0, 49_999]
    assert {r.token: r.n for r in token_files.count_tokens(spark, f"{tmp_path}/t", tokens).collect()} == {t: whole_ids.count(t) for t in tokens}
    places = token_files.locate_tokens(spark, f"{tmp_path}/t", tokens).collect()
    assert sorted((r.token, r.position) for r in places) == sorted((t, i) for t in set(tokens) for i, x in enumerate(whole_ids) if x == t)
    starts = {doc: start for doc, start, _, _ in expected_files(rows)}
    assert all(r.position == starts[r.doc_id] + r["at"] for r in places)
    token_files.write_token_files(docs.limit(0), f"{tmp_path}/e", SPACE_BPE)
    assert token_files.read_token_files(spark, f"{tmp_path}/e").count() == 0


def test_codec_forgets_without_harm(monkeypatch):
    from gradus.llm import tokens

    monkeypatch.setattr(tokens, "SLOTS", 16)
    monkeypatch.setattr(tokens, "POOL", 64)
    file_codec(SPACE_BPE, "space")
    codec = tokens.Codec(tokens._codecs[SPACE_BPE, "space"].encode, tokens.space_led)
    r = random.Random(3)
    for _ in range(60):
        texts = ["".join(r.choice(["ab", " c", ".", " Zürich", "\n", " 12", "'s"]) for _ in range(r.randrange(40))) for _ in range(3)]
        ids, count = codec.ids(*block(texts))
        expected = [whole(SPACE_BPE, t) for t in texts]
        assert ids.tolist() == sum(expected, []) and count.tolist() == [len(x) for x in expected]
