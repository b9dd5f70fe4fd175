import numpy as np
import pytest

from gradus.llm import language_id, toxicity
from gradus.llm.shared import fold


def joined(df, table, columns):
    return df.join(table.select("doc_id", *columns), "doc_id").toPandas()


def test_language_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = joined(language_id.query(spark, sf), docs, ["lang"])
    assert len(got) == docs.count() and got.held_out.sum() > 100
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()


def test_language_edges(spark):
    train = [(i, "the of and this that with thing", "en") for i in range(20)] + [(i, "привет мир это слово", "ru") for i in range(20, 40)] + [(50, "xx", None), (51, None, "en")]
    model = language_id.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model["languages"] == ["en", "ru"]
    rows = [(1, None), (2, ""), (3, "123 !? 4"), (4, "the thing and that"), (5, "это слово"), (6, "the thing that with " * 20 + "это слово привет мир " * 30), (7, "—…·"), (8, "the " * 30_000), (None, "the"), (4, "the thing and that")]
    docs = spark.createDataFrame([(*r, "xx", 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    got = language_id.label_languages(docs, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 9 and [by[i].lang_pred for i in (1, 2, 3, 4, 5, 6, 7, 8)] == ["und", "und", "und", "en", "ru", "ru", "und", "en"]
    assert by[1].score == 0 and [s.lang for s in by[6].spans] == ["en", "ru"] and by[6].spans[0].end == 399
    empty = docs.limit(0)
    assert language_id.label_languages(empty, model).count() == 0
    none = language_id.train(empty)
    assert {r.lang_pred for r in language_id.label_languages(docs, none).collect()} == {"und"}


def test_viterbi_against_every_path():
    from itertools import product

    r = np.random.default_rng(3)
    for n in (1, 2, 6):
        score, penalty = r.normal(size=(n, 3)), 1.5
        got = language_id.viterbi(score, np.array([0]), np.array([n]), penalty).tolist()
        value = lambda p, s=score: sum(s[i, x] for i, x in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:]))
        assert value(got) == pytest.approx(max(map(value, product(range(3), repeat=n))))


def test_decoding_against_every_reading():
    """The reading that decode() gives is as probable as the best of all readings of the lattice."""
    from itertools import product

    r = np.random.default_rng(7)
    model = np.log(r.dirichlet(np.full(28, 0.3), (28, 28)))

    def options(token, i):
        c = token[i].lower()
        out = [(x, toxicity.SIGN_COST) for x in toxicity.SIGNS.get(c, "")] + ([(c, 0.0)] if c.isalpha() else [])
        if i and token[i - 1].lower() == c and (out or c == " "):
            out.append(("", toxicity.REPEAT_COST))
        if c in ".-_*~ ":
            out = [("", 0.3), (" ", 0.0)]
        return out or [(c, 0.0)]

    def value(reading):
        state, total = (26, 26), 0.0
        for x, cost in reading:
            total -= cost
            if x:
                k = int(toxicity._CLASS[x.encode()[0]])
                total += model[state[0], state[1], k]
                state = (state[1], k)
        return total + model[state[0], state[1], 26]

    for token in ("1d10t", "m0r0n", "looool", "s.c.u.m", "i d i o t", "p@th3t!c", "é1é", "aa|+", "€11", "7", "a-1-1"):
        best: dict = {}
        for reading in product(*[options(token, i) for i in range(len(token))]):
            text = "".join(x for x, _ in reading)
            best[text] = max(best.get(text, -np.inf), value(reading))
        assert best[toxicity.decode(token, model)] == pytest.approx(max(best.values()))


def test_pieces_are_chosen_from_all(spark):
    """The pieces kept are those of the largest gain among all that toxic texts hold, counted one by one."""
    r = np.random.default_rng(8)
    rows = [(i, int(i % 3 == 0), " ".join([f"w{x}" for x in r.integers(0, 200, 30)] + (["vile", f"rot{i % 4}"] if i % 3 == 0 else []))) for i in range(120)]
    sample = spark.createDataFrame(rows, "doc_id long, toxic int, text string").repartition(3)
    got = toxicity.typical_pieces(sample, {1: 40, 0: 80}).collect()
    count: dict = {}
    for _, toxic, text in rows:
        buf = np.frombuffer(text.encode(), np.uint8)
        for j, (h, _) in enumerate(toxicity.pieces(buf, np.array([0, len(buf)]))):
            for x in set(h.view(np.int64).tolist()):
                count.setdefault((x, j == 0), [0, 0])[toxic] += 1

    def gain(n, m):
        p, q = (m + 0.5) / 41, (n + 0.5) / 81
        return 40 * (p * np.log(p / q) + (1 - p) * np.log((1 - p) / (1 - q))) if m >= 3 and p > 2 * q else -1

    expected = {k: v for k, v in count.items() if gain(*v) > toxicity.LEAST_GAIN}
    assert len(expected) > 3 and {(x.h, x.word): [x.without, x.with_toxic] for x in got} == expected


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.1"
    got = joined(toxicity.query(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"), ["toxic"])
    held = got[got.held_out]
    assert len(held) > 500 and (held.toxic == held.predicted).mean() > 0.96
    assert held[held.toxic == 0].predicted.mean() < 0.02 and got.score.between(0, 1).all()


def test_disguises_are_read(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.train(docs.where(fold("doc_id") != 0), labels.where(fold("doc_id") != 0))
    forms = ["1d10t", "m0r0n", "idiooooot", "stuuupid", "i d i o t", "s.c.u.m", "p@thetic", "w0rthle55"]
    plain = "the thing of and that with "
    rows = [(i, plain + x + " and this") for i, x in enumerate(forms)] + [(100, plain), (101, None), (102, ""), (103, plain * 4000), (None, "x"), (100, plain)]
    got = toxicity.score(spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double"), model).collect()
    caught = sum(r.predicted for r in got if r.doc_id < 100)
    assert caught >= 7 and not any(r.predicted for r in got if r.doc_id >= 100) and len(got) == len(rows) - 1
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    for labels, share in (([], 0.0), ([(1, 1), (1, 0), (2, None), (None, 0)], 1.0)):
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {r.score for r in toxicity.score(docs, model).collect()} == {share}


def test_long_disguises_are_read(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.train(docs.where(fold("doc_id") != 0), labels.where(fold("doc_id") != 0))
    sentence = "the thing with that is this and so on but you are an idiot and that thing with the other is this so on and on and so the end of it all"
    apart = " ".join(sentence.replace(" ", ""))
    assert apart.count(" ") >= 99
    joined = "the,thing,of,and,that,with,the,other,1d10t,and,that,is,all,of,it"
    plain = "the thing of and that with "
    clean = " ".join((plain * 6).replace(" ", ""))
    rows = list(enumerate([apart, plain + "idi" + "o" * 196 + "t", joined])) + [(100, clean), (101, plain + joined.replace("1d10t", "1nsect")), (102, "a b " * 50_000)]
    got = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 100: 0, 101: 0, 102: 0}


def test_three_letters_set_apart():
    docs = np.frombuffer(b"x y o u z1 o f", np.uint8)
    start, end, _ = toxicity.disguised(docs, np.array([0, len(docs)]))
    assert (0, 7) in set(zip(start.tolist(), end.tolist(), strict=True))
    docs = np.frombuffer(b"and y o u or", np.uint8)
    start, end, _ = toxicity.disguised(docs, np.array([0, len(docs)]))
    assert (start.tolist(), end.tolist()) == ([4], [9])


def test_every_letter_has_a_script():
    letters = "".join(c for c in map(chr, range(0x40000)) if c.isalpha())
    buf = np.frombuffer(" ".join(letters).encode(), np.uint8)
    start, _, _ = language_id.words(buf, np.array([0, len(buf)]))
    script = language_id._word_scripts(buf, start)
    assert len(script) == len(letters) and script.min() > 0 and script.max() < language_id.SCRIPTS
    signs = np.frombuffer("— € · 😀 ™ 。".encode(), np.uint8)
    assert language_id._word_scripts(signs, language_id.words(signs, np.array([0, len(signs)]))[0])[:5].tolist() == [0] * 5


def test_languages_of_other_scripts(spark):
    wide, tifinagh, adlam = "ｔｈｅ ｏｆ ａｎｄ ｔｈｉｓ", "ⴰⵣⵓⵍ ⵜⴰⵎⴰⵣⵉⵖⵜ ⴷ", "𞤢𞤣𞤤𞤢𞤥 𞤨𞤵𞤤𞤢𞤪"
    train = [(i, "the of and this don’t ﬁrst — that", "en") for i in range(20)] + [(i, tifinagh, "zgh") for i in range(20, 40)] + [(i, adlam, "ff") for i in range(40, 60)]
    model = language_id.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    rows = [(1, tifinagh), (2, adlam), (3, wide), (4, "😀 👍 — … ™"), (5, "don’t ﬁrst"), (6, "𝐭𝐡𝐞"), (7, "ﾃｽﾄ"), (8, "the — — — — — — — — —")]
    got = {r.doc_id: r for r in language_id.label_languages(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 4, 5, 8)] == ["zgh", "ff", "und", "en", "en"] and got[4].score == 0
    assert all(got[i].lang_pred != "und" and got[i].score > 0 for i in (3, 6, 7))
