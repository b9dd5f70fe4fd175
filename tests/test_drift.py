"""Drift of any two sets of sessions against a plain version, and the report made from it."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import drift

COMPARISONS = {"train-later": ([1, 2], [3]), "1-2": ([1], [2]), "2-3": ([2], [3]), "3-none": ([3], [9]), "none-1": ([9], [1])}


def brute_psi(a, b, bins=10):
    if not len(a) or not len(b):
        return 0.0
    edges = np.unique(np.quantile(a, np.linspace(0, 1, bins + 1)))
    if len(edges) < 2:
        return 0.0
    shares = [np.bincount(np.searchsorted(edges[1:-1], x), minlength=len(edges) - 1) / len(x) for x in (a, b)]
    return index(*shares)


def index(p, q):
    p, q = (np.maximum(x, drift.FLOOR) for x in (p, q))
    return float(((q - p) * np.log(q / p)).sum())


def brute_ks(a, b):
    if not len(a) or not len(b):
        return None
    grid = np.union1d(a, b)
    return float(np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b)).max())


def brute_categories(a, b, top):
    if not a or not b:
        return 0.0
    kept = [c for c, _ in sorted(Counter(a).items(), key=lambda x: (-x[1], x[0]))[:top]]
    counts = [Counter(c if c in kept else "__autre__" for c in x) for x in (a, b)]
    names = sorted(set(counts[0]) | set(counts[1]))
    return index(*[np.array([c[n] for n in names]) / sum(c.values()) for c in counts])


def rows(seed, n=900):
    r = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        s = int(r.integers(1, 4))
        x = float(np.round(r.normal(s / 4, 1), int(r.integers(0, 3)))) if r.random() > 0.1 else None
        out.append((s, x, 0.1 * float(r.integers(0, 4)) if s != 2 else 0.3, None if s == 3 else 7.0, str(r.integers(0, 3 + 2 * s)) if r.random() > 0.1 else None))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_the_plain_version(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, "session int, x double, few double, flat double, word string").repartition(3)
    got = {(r.variable, r.comparison): r for r in drift.drift_report(df, "session", ["x", "few", "flat"], ["word"], COMPARISONS, {"few": "target"}, top=4).collect()}
    assert len(got) == 4 * len(COMPARISONS)
    for name, (a, b) in COMPARISONS.items():
        for i, variable in enumerate(["x", "few", "flat"], 1):
            left, right = (np.array([d[i] for d in data if d[0] in s and d[i] is not None]) for s in (a, b))
            r = got[variable, name]
            assert (r.type, r.n_reference, r.n_comparison, r.family) == ("numerique", len(left), len(right), "target" if variable == "few" else "variable")
            assert r.psi == pytest.approx(brute_psi(left, right), abs=1e-9) and r.beyond == (r.psi >= 0.2)
            assert r.ks == (None if (k := brute_ks(left, right)) is None else pytest.approx(k, abs=1e-12))
        left, right = ([d[4] or "__manquant__" for d in data if d[0] in s] for s in (a, b))
        r = got["word", name]
        assert (r.type, r.ks, r.n_reference, r.n_comparison) == ("categorielle", None, sum(x != "__manquant__" for x in left), sum(x != "__manquant__" for x in right))
        assert r.psi == pytest.approx(brute_categories(left, right, 4), abs=1e-9)


def test_histograms_add_up(spark):
    df = spark.createDataFrame(rows(5, 200), "session int, x double, few double, flat double, word string")
    first, later = (drift.histogram(df.where(c), "session", ["x"], ["word"]) for c in ("session < 3", "session = 3"))
    whole = drift.histogram(df, "session", ["x"], ["word"])
    assert sorted(map(tuple, drift.merged([first, later]).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert drift.drift(drift.histogram(df.limit(0), "session", ["x"], ["word"]), COMPARISONS).count() == 0


def test_who_asks_for_retraining(spark):
    """The median of the variables counts, not one of them; a target or a prediction counts alone; only production comparisons do."""
    row = lambda v, f, c, psi: (v, f, c, psi, psi >= 0.2)
    make = lambda data: spark.createDataFrame(data, "variable string, family string, comparison string, psi double, beyond boolean")
    calm = [row("a", "variable", "p", 0.9), row("b", "variable", "p", 0.1), row("c", "variable", "p", 0.1), row("y", "target", "p", 0.0), row("z", "prediction", "q", 0.9)]
    got = drift.retraining(make(calm), ["p"]).collect()
    assert [(r.comparison, r.median_psi, r.variables, r.target, r.prediction, r.retrain) for r in got] == [("p", 0.1, False, False, False, False)]
    both = {r.comparison: r.retrain for r in drift.retraining(make(calm), ["p", "q"]).collect()}
    assert both == {"p": True, "q": True}
    assert drift.retraining(make([row("a", "variable", "p", 0.2)]), ["p"]).first().retrain
    assert [r.variable for r in drift.worst(make([*calm, row("y", "target", "p", 5.0)]), "p", 2).collect()] == ["a", "b"]


def test_only_blocks_that_can_hold_an_answer_are_looked_into(spark, monkeypatch):
    """Values are put in order by one shuffle, and quantiles, bins and distances come from few of their blocks."""
    monkeypatch.setattr(drift, "BLOCK", 16)
    stored, looked = drift._stored, []
    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    class Watched(drift.Ordered):
        def within(self, blocks):
            looked.append(blocks.count())
            return super().within(blocks)

    monkeypatch.setattr(drift, "_stored", noted)
    monkeypatch.setattr(drift, "Ordered", Watched)
    r = np.random.default_rng(3)
    data = [(int(s), float(np.round(r.normal(s, 1), 3)), float(r.integers(0, 40)) if s < 3 else None) for s in r.integers(1, 4, 4000)]
    df = spark.createDataFrame(data, "session int, x double, few double").repartition(3)
    got = {(q.variable, q.comparison): q for q in drift.drift_report(df, "session", ["x", "few"], [], COMPARISONS).collect()}
    for name, (a, b) in COMPARISONS.items():
        for i, variable in enumerate(["x", "few"], 1):
            left, right = (np.array([d[i] for d in data if d[0] in s and d[i] is not None]) for s in (a, b))
            assert got[variable, name].psi == pytest.approx(brute_psi(left, right), abs=1e-9)
            assert got[variable, name].ks == (None if (k := brute_ks(left, right)) is None else pytest.approx(k, abs=1e-12))
    assert plans["ordered"].count("Exchange ") == 1
    blocks = len({d[1] for d in data}) // 16
    assert len(looked) == 2 and max(looked) < blocks / 2


def test_numbers_are_counted_by_a_key_without_texts(spark):
    df = spark.createDataFrame(rows(7, 50), "session int, x double, few double, flat double, word string")
    plan = drift.histogram(df, "session", ["x", "few"])._jdf.queryExecution().executedPlan().toString()
    keys = plan[plan.index("HashAggregate(keys=[") :].split("]")[0]
    assert "category" not in keys and "Generate" not in plan
    both = drift.histogram(df, "session", ["x"], ["word"])
    assert both.columns == ["variable", "text", "session", "value", "category", "n", "present"]
    counted = {tuple(r) for r in both.groupBy("variable").agg(F.sum("n"), F.sum("present")).collect()}
    assert counted == {("x", 50, df.where("x is not null").count()), ("word", 50, df.where("word is not null").count())}
