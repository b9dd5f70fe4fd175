"""Properties of model fitting; the trees themselves are the library's."""

import pytest
from pyspark.sql import functions as F

from gradus.operators import learning, metrics, reconcile

NUMERIC, CATEGORIES = ["a", "b"], ["kind"]


@pytest.fixture(scope="module")
def rows(spark):
    u = (F.xxhash64("id") % 1000 + 1000) / 2000
    df = spark.range(0, 1200).select("id", (F.col("id") % 40).alias("key"), (F.col("id") % 6 + 2015).alias("session"), u.alias("a"), F.when(F.col("id") % 9 != 0, F.col("id") % 5).alias("b"), F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("kind"), F.lit(1.0).alias("w"))
    y = F.least(F.lit(1.0), 0.6 * F.col("a") + 0.1 * (F.col("id") % 3))
    return df.withColumn("y", y).withColumn("anchor", F.col("a") * 0.5).withColumn("p", F.col("a") * 0.8).persist()


def halves(rows):
    return rows.where("session < 2019"), rows.where("session = 2019"), rows.where("session = 2020")


def test_the_round_of_least_staged_error_is_kept(rows):
    """Staged errors equal those of models with so many rounds, and the fit keeps the least."""
    train, val, test = halves(rows)
    noisy = train.withColumn("y", F.least(F.lit(1.0), F.col("y") + (F.xxhash64("id", F.lit(3)) % 100) / 120))
    features = learning.Features.fit(noisy, NUMERIC, CATEGORIES)
    own, held, asked = (features.written(df, ["id", "y", "w"]) for df in (noisy, val, test))
    boosted = learning.fit_trees(own, held, "y", "w", rounds=12, step=0.5)
    assert len(boosted.errors) == 12 and boosted.rounds == boosted.errors.index(min(boosted.errors)) + 1
    assert boosted.stopped == (boosted.rounds < 12)
    whole = learning.fit_trees(own, None, "y", "w", rounds=12, step=0.5).model
    for n in (1, 5, 12, boosted.rounds):
        error = metrics.errors(learning.served(learning.truncated(whole, n), held, ["y", "w"]), "y", "prediction", "w").first().mae_weighted
        assert error == pytest.approx(boosted.errors[n - 1], abs=1e-12)
    a, b = (learning.served(m, asked, ["id"]).orderBy("id").collect() for m in (boosted.model, learning.truncated(whole, boosted.rounds)))
    assert a == b


def test_a_gap_is_stopped_on_the_rate(rows):
    train, val, _ = halves(rows)
    features = learning.Features.fit(train, NUMERIC, CATEGORIES)
    own, held = (features.written(df, ["y", "w", "anchor"]) for df in (train, val))
    boosted = learning.fit_trees(own.withColumn("_gap", F.col("y") - F.col("anchor")), held, "y", "w", "_gap", "anchor", rounds=6)
    error = metrics.errors(learning.served(boosted.model, held, ["y", "w"], anchor="anchor"), "y", "prediction", "w").first().mae_weighted
    assert error == pytest.approx(min(boosted.errors), abs=1e-12)


def test_boosting_beats_the_mean(rows):
    train, val, test = halves(rows)
    model = learning.fit_boosted(train, val, NUMERIC, CATEGORIES, "y", "w", rounds=25)
    assert 1 <= len(model.stages[-1].trees) <= 25
    found = learning.predict(model, test, NUMERIC, CATEGORIES, ["id", "y", "w", "a"])
    assert found.columns == ["id", "y", "w", "a", "prediction"] and found.where("prediction not between 0 and 1").isEmpty()
    assert found.join(test.select("id", F.col("a").alias("given")), "id").where("a <> given").isEmpty()
    mean = train.agg(F.avg("y")).first()[0]
    error = metrics.errors(found.withColumn("mean", F.lit(mean)), "y", "prediction", "w").first().mae
    assert error < 0.5 * found.select(F.avg(F.abs(F.col("y") - mean))).first()[0]


def test_isotonic_is_monotone_and_clipped(rows):
    got = learning.calibrate(learning.fit_isotonic(rows, "p", "y", "w"), rows.select("id", "p"), "p", "c").orderBy("p").collect()
    assert all(x.c <= y.c + 1e-12 for x, y in zip(got, got[1:], strict=False)) and all(0 <= x.c <= 1 for x in got)


def test_out_of_fold_keeps_groups_together(rows):
    """Each row equals a fit without its group's fold, and no group lies in two folds."""
    df = rows.select("id", "key", "p", "y", "w")
    got = learning.calibrated_out_of_fold(df, "p", "y", "w", "key")
    assert got.count() == df.count()
    fold = F.pmod(F.xxhash64("key"), F.lit(3))
    assert df.groupBy("key").agg(F.count_distinct(fold).alias("n")).where("n > 1").isEmpty()
    for k in range(3):
        own = learning.calibrate(learning.fit_isotonic(df.where(fold != k), "p", "y", "w"), df.where(fold == k), "p", "again")
        assert own.join(got.select("id", "calibrated"), "id").where("abs(again - calibrated) > 1e-9").isEmpty()


def test_grid_compares_all_settings(rows):
    train, val, _ = halves(rows)
    table = learning.grid(train, val, NUMERIC, CATEGORIES, "y", "w", "session", "key", "kind", "anchor", 2018, rounds=2).persist()
    got = {r.variant: r for r in table.collect()}
    assert len(got) == 16 and all(r.group_ece >= 0 and r.mae_weighted > 0 and 1 <= r.rounds <= 2 for r in got.values())
    best = learning.best_of(table).collect()
    assert len(best) == 1 and best[0].mae_weighted <= min(r.mae_weighted for r in got.values()) + 0.0005


def test_refit_ablation_and_curve(rows):
    train, val, test = halves(rows)
    assert learning.refit(train, val, test, NUMERIC, CATEGORIES, "y", "w", ["id"], rounds=5).count() == test.count()
    table = {r.variant: r for r in learning.ablation(train, val, test, NUMERIC, CATEGORIES, "y", "w", {"without_a": ["a"], "only_kind": NUMERIC}, rounds=6).collect()}
    assert table["all"].delta_mae == 0 and table["all"].delta_ece == 0 and len(table) == 3
    assert table["without_a"].delta_mae == pytest.approx(table["without_a"].mae_weighted - table["all"].mae_weighted) and table["without_a"].delta_mae > 0
    curve = learning.learning_curve(train, val, test, NUMERIC, CATEGORIES, "y", "w", "session", ["id"], rounds=6)
    assert [r.variant for r in curve.collect()] == ["0.1", "0.25", "0.5", "1"]


def test_batch_prediction_is_null_free_and_repeatable(rows):
    train, _, test = halves(rows)
    model = learning.fit_boosted(train, None, NUMERIC, CATEGORIES, "y", "w", rounds=2)
    a, b = (learning.predict(model, test.withColumn("kind", F.when(F.col("id") % 4 != 0, "new")), NUMERIC, CATEGORIES, ["id"]).orderBy("id").collect() for _ in "ab")
    assert a == b and all(r.prediction is not None for r in a)


def test_alike_rows_are_fitted_as_one(rows):
    """Fewer rows reach the trees, sums stay, and the trees are those of the rows one by one."""
    features = learning.Features.fit(rows, ["b"], CATEGORIES)
    own = features.written(rows.withColumn("w", F.col("id") % 3 + 1), ["y", "w"])
    merged = learning.merged_rows(own, "features", "y", "w").persist()
    assert merged.count() == own.select("features").distinct().count() < 30
    sums = [df.agg(F.sum("w").alias("w"), F.sum(F.col("y") * F.col("w")).alias("s")).first() for df in (own, merged)]
    assert sums[0].w == sums[1].w and sums[0].s == pytest.approx(sums[1].s)
    plain = learning.GBTRegressor(labelCol="y", weightCol="w", featuresCol="features", predictionCol="_p", maxIter=5, maxDepth=3, seed=1, maxBins=64, stepSize=0.5).fit(own)
    got = learning.fit_trees(own, None, "y", "w", rounds=5, step=0.5).model
    for a, b in zip(*(learning.served(m, merged.orderBy("y"), ["y"]).collect() for m in (plain, got)), strict=True):
        assert a.y == b.y and a.prediction == pytest.approx(b.prediction, abs=1e-9)


def test_a_share_brings_no_stratum_to_one_task(spark, rows):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        strata = reconcile.placed_strata(rows.select("id", "session"), "session", ["id"])
        assert "SortMergeJoin" not in strata._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    places = {s: sorted(r["_at"] for r in strata.where(F.col("session") == s).collect()) for s in range(2015, 2021)}
    assert all(p == list(range(200)) for p in places.values()) and strata.where("_n <> 200").isEmpty()
    assert reconcile.share_of(strata, 0.25).groupBy("session").count().where("count <> 50").isEmpty()
