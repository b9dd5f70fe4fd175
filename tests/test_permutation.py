"""The keyed bijection, and the variance net of chance that is made with it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import metrics


def test_places_are_a_bijection_for_every_size(spark):
    sizes = [*range(1, 12), 16, 17, 99, 100, 101, 1000, 4097]
    seen = {}
    for n in sizes:
        rows = spark.range(n).select("id", *[metrics.permuted_place(F.col("id"), n, seed).alias(f"p{seed}") for seed in (1, 2, 99)]).collect()
        for seed in (1, 2, 99):
            places = [r[f"p{seed}"] for r in rows]
            assert sorted(places) == list(range(n))
            seen[n, seed] = places
    assert seen[1000, 1] != seen[1000, 2] != seen[1000, 99]
    for seed in (1, 2, 99):
        p = np.array(seen[4097, seed])
        assert abs(np.corrcoef(p, np.arange(4097))[0, 1]) < 0.06 and (np.abs(np.diff(p)) == 1).sum() < 20 and (p == np.arange(4097)).sum() < 8


def test_net_variance(spark):
    r = np.random.default_rng(3)
    group = r.integers(0, 5, 800)
    rows = [(int(i), f"g{g}" if g else None, float(g + r.normal()) if i % 11 else None) for i, g in enumerate(group)]
    df = spark.createDataFrame(rows, "k long, g string, v double").repartition(3)
    got = metrics.net_variance(df, "v", "g", ["k"]).first()
    seen = metrics.correlation_ratio(df, ["v"], "g").first().eta2
    assert got.observed == pytest.approx(seen) and got.net == pytest.approx(got.observed - got.chance) and 0 < got.chance < 0.03
    sums = metrics.permuted_sums(df, "v", "g", ["k"], 3).groupBy("round").agg(F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum("rows").alias("rows")).collect()
    assert len(sums) == 4 and {(s.n, round(s.t, 6), s.rows) for s in sums} == {(sums[0].n, round(sums[0].t, 6), 800)}
    flat = metrics.net_variance(df.withColumn("v", F.lit(2.0)), "v", "g", ["k"]).first()
    assert tuple(flat) == (0.0, 0.0, 0.0)
    assert metrics.net_variance(df.limit(0), "v", "g", ["k"]).first().observed is None
