import duckdb
import numpy as np
import pytest

from gradus.llm import hard_negatives as hn


def brute(rows, k=5, m=3):
    """rows: (id, label, vector) that take part."""
    width = max((len(v) for *_, v in rows), default=0)
    q = [[int(np.floor(256 * float(x))) for x in v] + [0] * (width - len(v)) for *_, v in rows]
    out, asked = [], {}
    for i, (a, label, v) in enumerate(rows):
        if a % 50 == 0 and (a not in asked or (label, v) < asked[a][1:]):
            asked[a] = (i, label, v)
    for a, (i, label, _) in asked.items():
        scored = sorted((-sum(x * y for x, y in zip(q[i], q[j], strict=True)), b, lb) for j, (b, lb, _) in enumerate(rows) if b != a)
        for s, p, _ in [x for x in scored if x[2] == label][:k]:
            ps = -s
            got = [(b, -t) for t, b, lb in scored if lb != label and 50 * ps <= 100 * -t <= 95 * ps][:m]
            out += [(a, p, r, b, ps, t) for r, (b, t) in enumerate(got, 1)]
    return sorted(out)


def table(spark, rows):
    df = spark.createDataFrame([(a, b, [float(x) for x in v] if v is not None else None, "x") for a, b, v in rows], "vec_id long, label int, embedding array<double>, score string")
    return hn.valid_rows(df.repartition(3))


def mined(rows, **more):
    return sorted(tuple(r) for r in hn.hard_negatives(rows, rows.where("id % 50 = 0"), **more).collect())


def test_query_equals_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        con = duckdb.connect()
        con.sql(f"create view embeddings as select * from '/root/testdata/{sf}/embeddings.parquet'")
        expected = con.sql(hn.ORACLE).fetchall()
        got = hn.query(spark, f"/root/testdata/{sf}")
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(tuple(r) for r in got.collect()) == sorted(expected) and expected


def test_many_cells_rounds_and_blocks(spark):
    """Clustered vectors, ties, copies and one very common vector; few rows a block and cells over several rounds."""
    r = np.random.default_rng(3)
    centres = r.standard_normal((12, 9))
    rows = [(i, int(r.integers(0, 4)), (np.round(centres[i % 12] + 0.3 * r.standard_normal(9), 1) / 3).tolist()) for i in range(700)]
    rows += [(1000 + i, int(i % 3), [0.25] * 9) for i in range(300)]
    valid = table(spark, rows)
    expected = brute(rows)
    assert mined(valid, codes=5, block_rows=40) == expected
    assert mined(valid) == expected


def test_few_cells_are_visited_where_vectors_have_structure():
    r = np.random.default_rng(5)
    centres = r.standard_normal((20, 16)) * 100
    x = np.floor(centres[r.integers(0, 20, 4000)] + r.standard_normal((4000, 16)))
    index = hn.MultiIndex([hn.codebook(h, 20) for h in (x[:, :8], x[:, 8:])])
    codes = [hn.nearest_codes(h, c) for h, c in zip(index.split(x), index.halves, strict=True)]
    index.radii = [np.array([np.linalg.norm(h[k == i] - c[i], axis=1).max(initial=0) for i in range(20)]) for h, c, k in zip(index.split(x), index.halves, codes, strict=True)]
    index.sizes = np.bincount(codes[0] * 20 + codes[1], minlength=400)
    for v in x[:50]:
        score = x @ v
        fifth = int(np.sort(score)[-6])
        cells, _, left = index.visits(v, [hn.LOW], [hn.HIGH], [fifth], 0, 1000)
        assert not left and len(cells) <= 6
        inside = np.isin(codes[0] * 20 + codes[1], cells)
        assert (score[~inside] < fifth).all()
        bounds = [b for b, _, _ in hn.cells_by_bound(*[m for _, m in index.bounds(v)])]
        assert len(bounds) == 400 and bounds == sorted(bounds, reverse=True)


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    bad = [(2, 1, None), (3, None, [1.0, 1.0]), (4, 1, [inf, 0.0]), (5, 1, [nan, 0.0]), (None, 1, [1.0, 1.0])]
    good = [(0, 1, [0.5, 0.25]), (50, 2, [0.5]), (6, 1, [1.0, 0.5]), (7, 2, [0.5, 0.125]), (8, 2, [0.25, 0.25, 0.25]), (9, 1, []), (10, 2, [0.0, 0.0]), (50, 1, [0.75, 0.0]), (6, 1, [1.0, 0.5]), (100, 3, [-1.0, -1.0])]
    assert mined(table(spark, bad + good)) == brute(good) != []
    valid = table(spark, good)
    assert mined(valid.limit(0)) == [] and mined(table(spark, [(0, 1, [1.0])])) == []
    wide = [(0, 1, [2.0**28, 1.0]), (1, 1, [2.0**10, 3.0]), (2, 2, [2.0**9 + 0.5, 2.0**20]), (3, 2, [2.0**9, 7.0])]
    assert mined(table(spark, wide)) == brute(wide) != []
    for rows, said in (([(0, 1, [1e307]), (1, 1, [1e307]), (2, 2, [1e300])], "no double"), ([(0, 1, [1e20]), (1, 1, [1e20]), (2, 2, [1.0])], "fit a long")):
        with pytest.raises(Exception, match=said):
            mined(table(spark, rows))
