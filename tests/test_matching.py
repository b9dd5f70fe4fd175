"""Recommendations by distinct wishes against all pairs of profiles and programmes."""

import random

import pytest
from pyspark.sql import functions as F

from gradus.operators import matching


def pairs(spark, seed, n_profiles, n_programmes, areas):
    r = random.Random(seed)
    pick = lambda *x: r.choice(x)
    profiles = [(i, r.randrange(2), pick(None, "Red", "blue", "é!", "??", "none of all"), r.choice([None, *range(areas)])) for i in range(n_profiles)]
    programmes = [(i, r.randrange(2), " ".join(r.sample(["red", "blue", "green", "é"], 2)), r.choice([None, *range(areas)]), r.choice([None, 0.0, 0.5, 1.5, r.random()]), r.choice([0.0, 1.0, r.random()])) for i in range(n_programmes)]
    p = matching.with_word_key(spark.createDataFrame(profiles, "profile int, kind int, word string, area int"), "word")
    k = matching.with_text_key(spark.createDataFrame(programmes, "id int, kind int, label string, place int, taux double, deb double"), ["label"])
    return p, k


@pytest.mark.parametrize("seed,sizes", [(1, (60, 150, 3)), (2, (40, 12, 6)), (3, (30, 200, 1))])
def test_wishes_equal_all_pairs(spark, seed, sizes):
    p, k = pairs(spark, seed, *sizes)
    factor = matching.affinity(F.lit(None).cast("string"), F.lit("x"), "word", [], "area", "place", keys=("_word", "_text"))
    columns = ["profile", "id", "affinite", "accessibilite", "deb", "score", "rang"]
    for top in (1, 4):
        expected = sorted(map(tuple, matching.recommend(p, k, ["kind"], "profile", ["id"], factor, "taux", "deb", top).select(columns).collect()), key=repr)
        got = sorted(map(tuple, matching.recommend_by_wish(p, k, ["kind"], "profile", "_word", "area", ["id"], "_text", "place", "taux", "deb", top).select(columns).collect()), key=repr)
        assert got == expected and expected
    assert matching.recommend_by_wish(p.limit(0), k, ["kind"], "profile", "_word", "area", ["id"], "_text", "place", "taux", "deb", 3).count() == 0


def test_pairs_are_limited_before_they_are_shuffled(spark, monkeypatch):
    plans, real = [], matching._written

    def written(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    monkeypatch.setattr(matching, "_written", written)
    p, k = pairs(spark, 4, 200, 400, 4)
    matching.recommend_by_wish(p, k, ["kind"], "profile", "_word", "area", ["id"], "_text", "place", "taux", "deb", 3)
    assert [n for n, _ in plans] == ["programmes"] + ["list"] * 4
    assert all("WindowGroupLimit" in plan for n, plan in plans if n == "list") and sum(plan.count("WindowGroupLimit") for _, plan in plans) >= 6
