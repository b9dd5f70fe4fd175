import numpy as np

from gradus.llm import ann


def brute(ids, x, k=5):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[i]
        score[ids == ids[i]] = -9
        order = np.lexsort((ids, -np.round(score, 12)))[:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_query_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    expected = brute(rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float))
    got = found(ann.query(spark, sf))
    assert got.keys() == expected.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * 5 * len(expected)
    exact = {q: dict(v) for q, v in expected.items()}
    assert all(abs(s - exact[q][v]) < 1e-12 for q in got for v, s in got[q] if v in exact[q])


def test_few_parts_are_probed_where_vectors_have_structure(spark):
    """Recall at two sizes of clustered vectors, and the probes that held-out rows ask for."""
    r = np.random.default_rng(6)
    centres = r.standard_normal((60, 24)) * 3
    for n in (3000, 12_000):
        x = centres[r.integers(0, 60, n)] + r.standard_normal((n, 24))
        parts = ann.table_parts(n)
        router = ann.fit_router(x[:2500], parts)
        assert ann.needed_probes(router, parts, x[:2500], x[2500:2900], 5, 0.95) <= parts // 3
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
        valid = ann.valid_vectors(rows)
        got, expected = found(ann.nearest(valid, valid.where("id % 50 = 0"))), brute(np.arange(n), x)
        assert sum(len({a for a, _ in got[q]} & {a for a, _ in expected[q]}) for q in expected) >= 0.9 * 5 * len(expected)
    assert [ann.table_parts(n) for n in (0, 1, 10**4, 10**6, 10**12)] == [16, 16, 16, 128, 256]


def test_queries_that_repeat_an_id(spark):
    """The smallest vector of the id asks; its other rows are never its neighbours."""
    rows = [(50, [0.0, 1.0]), (50, [1.0, 0.0]), (1, [0.1, 1.0]), (2, [1.0, 0.1]), (2, [1.0, 0.1])]
    valid = ann.valid_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert [v for v, _ in found(ann.nearest(valid, valid.where("id = 50")))[50]] == [1, 2, 2]


def test_components_of_any_size(spark):
    """Vectors of 1e200 and 1e-200 among others, and alone, have the neighbours that their directions give."""
    r = np.random.default_rng(8)
    x = r.standard_normal((400, 12))
    plain = {q: [v for v, _ in near] for q, near in brute(np.arange(400), x).items()}
    for size, some in ((1e200, [7, 150]), (1e-200, [7, 150]), (1e300, range(0, 400, 2)), (1e-300, range(400))):
        y = x.copy()
        y[list(some)] *= size
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "vec_id long, embedding array<double>").repartition(3)
        valid = ann.valid_vectors(rows)
        got = found(ann.nearest(valid, valid.where("id % 50 = 0"), probes=16))
        assert {q: [v for v, _ in near] for q, near in got.items()} == plain
        assert all(abs(s - (x[q] @ x[v]) / np.linalg.norm(x[q]) / np.linalg.norm(x[v])) < 1e-12 for q in got for v, s in got[q])


def test_edges(spark):
    base = [1.0, 2.0, 3.0]
    rows = [(i, base) for i in range(0, 30)] + [(50, [2.0, 4.0, 6.0]), (100, [0.0, 0.0, 0.0]), (150, None), (200, [1.0, None, 2.0]), (250, [1.0, float("nan"), 2.0]), (300, [1.0, float("inf"), 0.0]), (350, [1.0]), (None, base), (400, [-1.0, 0.0, 1.0]), (400, [-1.0, 0.0, 1.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, part int, id string")
    valid = ann.valid_vectors(df)
    got = found(ann.nearest(valid, valid.where("id % 50 = 0"), parts=16, probes=16, block_rows=7))
    assert got.keys() == {0, 50, 400}
    assert [v for v, _ in got[0]] == [1, 2, 3, 4, 5] and [v for v, _ in got[50]] == [0, 1, 2, 3, 4]
    assert [v for v, _ in got[400]] == [0, 1, 2, 3, 4]
    none = ann.valid_vectors(df.limit(0))
    assert ann.nearest(none, none).count() == 0
    two = ann.valid_vectors(df.where("vec_id in (0, 1)"))
    assert found(ann.nearest(two, two.where("id = 0")))[0][0][0] == 1


def test_parts_are_balanced():
    x = np.random.default_rng(0).standard_normal((1000, 8))
    part = ann.balanced_parts(ann.neighbour_graph(x / np.linalg.norm(x, axis=1, keepdims=True), 10), 16)
    assert np.bincount(part, minlength=16).min() >= 60
