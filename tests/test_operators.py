"""Edge rows of single operators, made by hand."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from gradus.functions import exprs as X
from gradus.operators import drift, features, governance, matching, metrics, reconcile, register, retrieval, star
from gradus.streaming import journals


def test_bounded_rate_vector(spark):
    rows = [(6, 10), (12, 10), (0, 10), (5, 0), (None, 10), (0, 0), (6, None)]
    df = spark.createDataFrame(rows, "num long, den long")
    got = [tuple(r) for r in df.select(X.bounded_rate("num", "den"), X.rate_overflow("num", "den")).collect()]
    assert got == [(0.6, False), (1.0, True), (0.0, False), (1.0, True), (None, None), (None, None), (None, None)]


def test_scd2_null_equals_null_and_gaps(spark):
    rows = [("a", 2018, "x"), ("a", 2019, "x"), ("a", 2021, "x"), ("a", 2022, "y"), ("a", 2023, "x"), ("b", 2019, None), ("b", 2020, None), ("b", 2021, "z")]
    got = star.versions(spark.createDataFrame(rows, "k string, s int, v string"), "k", "s", ["v"])
    assert sorted((r.k, r.debut, r.fin, r.v) for r in got.collect()) == [("a", 2018, 2021, "x"), ("a", 2022, 2022, "y"), ("a", 2023, 2023, "x"), ("b", 2019, 2020, None), ("b", 2021, 2021, "z")]


def test_guards(spark):
    df = spark.createDataFrame([(1, 2019), (1, 2019)], "k int, session int")
    with pytest.raises(ValueError):
        star.guarded_join(df, df, ["k"])
    with pytest.raises(ValueError):
        features.without_sessions(df, [2019])
    with pytest.raises(ValueError):
        features.split(df, [2000])
    with pytest.raises(ValueError):
        features.checked_columns(df, {"k"})
    with pytest.raises(ValueError):
        reconcile.stratified_sample(df, "session", ["k"], 1.5)
    with pytest.raises(ValueError):
        X.recency_weight("session", 2020, 0.5)


def test_lag_is_never_the_current_value(spark):
    y = spark.createDataFrame([("a", 2020, 1), ("a", 2021, None), ("a", 2023, 3)], "k string, s int, v int")
    got = {r.s: (r.lag__v, r.antecedent) for r in features.lagged_lookup(y.select("k", "s"), y, "k", "s", ["v"]).collect()}
    assert got == {2020: (None, False), 2021: (1, True), 2023: (None, False)}


def test_drift_extremes(spark):
    rows = [("c", True, 1.0), ("c", False, 1.0)] + [("s", True, float(i)) for i in range(50)] + [("s", False, float(i + 100)) for i in range(50)] + [("n", True, None), ("n", False, 1.0)]
    df = spark.createDataFrame(rows, "variable string, side boolean, v double")
    psi = {r.variable: r.psi for r in drift.psi_numeric(df, "variable", "side", "v").collect()}
    assert psi["c"] == 0 and psi["n"] == 0 and psi["s"] > 1
    assert {r.variable: r.ks for r in drift.ks(df, "variable", "side", "v").collect()}["s"] == 1.0


def test_disparate_impact_without_selection(spark):
    audit = spark.createDataFrame([("d", "a", 0.0, True), ("d", "b", 0.0, True), ("e", "a", 0.5, True), ("e", "b", 0.1, True), ("e", "c", 0.9, False)], "dimension string, grp string, selected double, reliable boolean")
    got = {(r.dimension, r.grp): (r.ratio, r.below) for r in metrics.disparate_impact(audit).collect()}
    assert got["d", "a"][0] != got["d", "a"][0] and not got["d", "a"][1] and got["e", "b"] == (0.2, True) and ("e", "c") not in got


def test_affinity_edges(spark):
    rows = [("p", "Écoles d'ingénieurs", "75", None, None, None), ("p", "BTS", "75", "q", None, None), ("p", "BTS Génie", "75", "p", "genie", "69"), ("p", "BTS", "75", None, "!!", None)]
    df = spark.createDataFrame(rows, "kind string, label string, dep string, wt string, ww string, wa string")
    got = [r.affinite for r in df.withColumns(matching.affinity("wt", "kind", "ww", ["label"], "wa", "dep")).collect()]
    assert got == [1.0, 0.0, 0.6, 0.0]


def test_refused_attempts_do_not_count(spark):
    rows = [(1, "a", 0), (2, "a", 10), (3, "a", 20), (4, "a", 61), (5, "b", 5)]
    df = spark.createDataFrame(rows, "id long, who string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.id: r.accepted for r in journals.limited(df, "who", "id", "ts", 2, 60).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True, 5: True}


def test_limiter_at_the_edge_and_against_brute_force(spark):
    rows = [(1, "a", 0), (2, "a", 10), (3, "a", 60), (4, "a", 61), (5, "a", 62)]
    df = spark.createDataFrame(rows, "id long, who string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.id: r.accepted for r in journals.limited(df, "who", "id", "ts", 2, 60).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True, 5: False}  # an attempt exactly one window old still counts
    r = random.Random(4)
    rows = [(i, r.choice(["a", "a", "b", None]), r.randrange(900)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, who string, s long").repartition(3).withColumn("ts", F.timestamp_seconds("s"))
    expected, past = {}, {}
    for i, who, s in sorted(rows, key=lambda x: (x[2], x[0])):
        if who:
            recent = [x for x in past.setdefault(who, []) if s - x <= 60]
            expected[i] = len(recent) < 3
            past[who] = recent + [s] * expected[i]
    assert {x.id: x.accepted for x in journals.limited(df, "who", "id", "ts", 3, 60).collect()} == expected


def test_every_matching_record_is_found_and_erased(spark):
    rows = [("a", "x", 1), ("a", "x", 1), ("b", "a", 2), ("b", "c", 3), (None, None, 4), ("a", None, 5)]
    df = spark.createDataFrame(rows, "mail string, name string, n int")
    wanted = spark.createDataFrame([("a",), ("a",), (None,)], "w string")
    found = matching.any_identifier(df, ["mail", "name"], wanted, "w")
    assert sorted(r.n for r in found.collect()) == [1, 1, 2, 5] and found.columns == df.columns
    left, trace = governance.erased(df, ["mail", "name"], wanted, "w")
    assert sorted(r.n for r in left.collect()) == [3, 4] and tuple(trace.first()) == (4, 6)


def test_register_counts(spark):
    """Employers alone, open and closed units apart, other states out, new codes among the open ones."""
    rows = [("t", "a", "A", True, "01", "2024-01-01", "n"), ("t", "a", "A", True, "NN", "2020-01-01", None), ("t", "a", "F", True, "01", "2024-01-01", "n"), ("t", "a", "A", False, "01", "2024-01-01", "n"), ("t", "a", "X", True, "01", "2024-01-01", "n"), (None, "a", "A", True, "01", "2024-01-01", "n"), ("u", "a", "F", True, "01", None, None)]
    df = spark.createDataFrame(rows, "town string, act string, state string, employer boolean, code string, created string, new string").withColumn("created", F.to_date("created"))
    employers = register.filtered(df, employer=F.col("employer"))
    tier = X.tier("code", X.WORKFORCE_TIERS)
    got = {r.town: r for r in register.town_activity(employers, "town", "act", "state", "A", "F", tier, ["1_9", "non_renseignee"], "created", "2025-01-01", "new").collect()}
    t = got["t"]
    assert (t.n_actifs, t.n_fermes, t["n_1_9"], t.n_non_renseignee, t.n_nouveau_code, t.n_recents) == (2, 1, 1, 1, 1, 1) and str(t.date_reference) == "2025-01-01"
    assert t.age_moyen == pytest.approx((366 + 1827) / 2 / 365.25)
    assert (got["u"].n_actifs, got["u"].n_fermes, got["u"].age_moyen) == (0, 1, None)


def test_drift_bins_and_categories(spark):
    values = [(True, 0.0)] * 25 + [(True, float(i)) for i in range(1, 76)] + [(False, 0.0)] * 5 + [(False, float(i)) for i in range(1, 96)]
    df = spark.createDataFrame([("v", *x) for x in values], "variable string, side boolean, v double")
    assert drift.psi_numeric(df, "variable", "side", "v").first().psi == pytest.approx(0.439, abs=1e-3)
    rows = [(True, "Île-de_France"), (True, "ile de france"), (True, None), (False, "ILE  DE FRANCE"), (False, "Île de France"), (False, " ")]
    df = spark.createDataFrame([("c", *x) for x in rows], "variable string, side boolean, c string")
    assert drift.psi_categorical(df, "variable", "side", "c").first().psi == pytest.approx(0.0)
    ks = spark.createDataFrame([("v", i % 3 == 0, float(i * i % 97)) for i in range(500)] + [("w", True, 1.0)], "variable string, side boolean, v double")
    got = {r.variable: r.ks for r in drift.ks(ks, "variable", "side", "v").collect()}
    a, b = ([float(i * i % 97) for i in range(500) if (i % 3 == 0) == s] for s in (True, False))
    assert got["v"] == pytest.approx(max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in set(a + b))) and got["w"] is None


def test_outlets(spark):
    rows = spark.createDataFrame([(1, 10, "d"), (2, 11, "d"), (3, 12, "d"), (4, 13, "d"), (5, None, "d"), (6, 10, None), (7, 10, "e"), (8, 14, "d")], "id long, code long, dep string")
    divisions = spark.createDataFrame([(10, "A"), (11, "B"), (12, None), (14, "C")], "code long, division string")
    counts = spark.createDataFrame([("d", "A", 50)], "departement string, division string, n long")
    every = spark.createDataFrame([("d", "A", 50), ("d", "B", 2)], "departement string, division string, n long")
    active = spark.createDataFrame([(14, False)], "code long, actif boolean")
    got = {r.id: (r.statut, r.debouches) for r in matching.outlet_term(rows, "code", "dep", divisions, counts, every, active, 100).collect()}
    gone = (matching.WITHDRAWN, 0.0)  # no division, no link at all, or not active
    assert got == {1: (matching.MEASURED, 0.5), 2: (matching.SUPPRESSED, 1.0), 3: gone, 4: gone, 5: (matching.NO_LINK, 1.0), 6: (matching.NO_AREA, 1.0), 7: (matching.MEASURED, 0.0), 8: gone}
    none = {r.id: r.debouches for r in matching.outlet_term(rows, "code", "dep", divisions, counts, every, active, 0).collect()}
    assert none[1] == 1.0 and none[7] == 0.0


def test_folding_equals_compatibility_decomposition(spark):
    texts = ["œuvre Ça", "ﬁn ½ ²", "ạ Ǆ ﷺ", "Ελλάδα ΐ", "й ё", "ＡＢＣ１", "é", "日本 ㍿", "İ", "it's \\ fine", "", None, "a'ﬀ'b"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    plain = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    got = {r.i: r for r in df.select("i", X.folded("text").alias("f"), X.label_key("text").alias("k"), X.category_key("text").alias("c")).collect()}
    for i, x in enumerate(texts):
        assert got[i].f == (None if x is None else plain(x))
        if x is not None:
            ascii_ = unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode().lower()
            assert got[i].k == " ".join(re.sub("[^a-z0-9 ]", " ", ascii_).split())
            assert got[i].c == (" ".join(plain(x).lower().replace("-", " ").replace("_", " ").split()) or "__manquant__")
    assert got[11].c == "__manquant__"


def test_search_over_letters_of_any_script(spark):
    docs = spark.createDataFrame([(1, "Ελλάδα και θάλασσα"), (2, "синее море"), (3, "œuvre d'art"), (4, "rien"), (5, None)], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "ελλαδα"), (2, "МОРЕ"), (3, "œuvre"), (4, "le la"), (5, None)], "item_id long, text string")
    got = {(r.item_id, r.doc_id) for r in retrieval.search(docs, "doc_id", queries, "item_id").collect()}
    assert got == {(1, 1), (2, 2), (3, 3)}


def test_quantiles_by_ranges(spark):
    """As the exact percentile: ties, one value, nulls, null groups, groups without values, no rows."""
    r = random.Random(6)
    rows = [(r.choice(["a", "b", None]), r.choice([None, r.random(), float(r.randrange(5))])) for _ in range(500)] + [("one", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    at = [0.0, 0.1, 0.5, 0.77, 1.0]
    exact = F.percentile("v", F.array(*map(F.lit, at)))
    got = {x.g: x.q for x in reconcile.quantiles(df, "v", at, "g").collect()}
    expected = {x.g: x.q for x in df.groupBy("g").agg(exact.alias("q")).collect()}
    assert got.keys() == expected.keys() and got["one"] == [2.0] * 5 and got["none"] == [None] * 5
    assert all(got[g] == pytest.approx(expected[g]) for g in ("a", "b", None))
    assert reconcile.quantiles(df, "v", at).first().q == pytest.approx(df.agg(exact.alias("q")).first().q)
    assert reconcile.quantiles(df.limit(0), "v", [0.5]).first().q == [None]
    sizes = df.groupBy("g").agg(F.count("v").alias("n"))
    assert {x.g: x.m for x in reconcile.with_quantiles(sizes, df, "v", {"m": 0.5}, "g").collect()} == {g: q[2] for g, q in got.items()}


def test_surrogates_samples_and_permutations_by_ranges(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 7).alias("s"), (F.col("id") / 3).alias("v")).repartition(5)
    numbered = star.numbered(df, "sk", [F.desc("k")]).collect()
    assert sorted((r.sk, r.k) for r in numbered) == [(i + 1, 999 - i) for i in range(1000)]
    some = reconcile.stratified_sample(df, "s", ["k"], 0.1, seed=3)
    again = reconcile.stratified_sample(df.repartition(2), "s", ["k"], 0.1, seed=3)
    assert some.columns == df.columns and sorted(map(tuple, some.collect())) == sorted(map(tuple, again.collect()))
    assert {r.s: r["count"] for r in some.groupBy("s").count().collect()} == {s: 14 for s in range(7)}
    a, b = (sorted(map(tuple, metrics.permuted(df, "v", ["k"], 5).select("k", "s", "v").collect())) for _ in "ab")
    before = sorted(map(tuple, df.collect()))
    assert a == b != before and sorted(x[2] for x in a) == sorted(x[2] for x in before) and [x[:2] for x in a] == [x[:2] for x in before]
    net = metrics.net_variance(df, "v", "s", ["k"]).first()
    assert net.net == pytest.approx(net.observed - net.chance) and 0 <= net.chance < 0.1
