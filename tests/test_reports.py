"""Reports of coverage, completeness, importance and definitions on hand-made rows; Hangul by arithmetic."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from gradus.functions import exprs as X
from gradus.operators import metrics, profile


def test_hangul_equals_compatibility_decomposition(spark):
    rows = [("".join(map(chr, range(a, min(a + 64, 0xD7A4)))),) for a in range(0xAC00, 0xD7A4, 64)] + [("서울 Café ﬁ",), ("漢字",), ("각각",)]
    got = spark.createDataFrame(rows, "t string").select("t", X.folded("t").alias("f"), X.category_key("t").alias("k")).collect()
    plain = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    assert len(got) == len(rows) and all(r.f == plain(r.t) and r.k == plain(r.t).lower() for r in got)


def test_bridge_coverage(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    programmes = frame([("a",), ("b",), ("c",), (None,), (" ",)], "code string")
    certificates = frame([("a", "x"), ("a", "y"), ("b", "z"), ("q", "x")], "code string, occ string")
    occupations = frame([("x", "1"), ("x", "2"), ("w", "1")], "occ string, division string")
    final = frame([("a", "x", "1", None), ("a", "x", "2", True)], "code string, occ string, division string, actif boolean")
    got = {r.link: (r.total, r.kept) for r in profile.bridge_coverage(programmes, "code", certificates, occupations, "occ", final, "actif").collect()}
    assert got == {"programme -> code": (5, 3), "certificate -> occupation": (3, 3), "programme with code -> division": (3, 1), "occupation -> division": (3, 1), "programme -> division": (5, 1), "row -> active": (2, 1), "reached programme -> active": (1, 1)}
    empty = profile.bridge_coverage(programmes.limit(0), "code", certificates.limit(0), occupations, "occ", final.limit(0), "actif").collect()
    assert len(empty) == 7 and all(r.rate is None and r.total == 0 for r in empty)


def test_completeness_report(spark):
    rows = [(2019, "k", 1, None, True), (2019, None, None, None, False), (2020, "k", 2, 3, None)]
    df = spark.createDataFrame(rows, "session int, key string, a int, b int, found boolean")
    got = {(r.measure, r.session, r.column): r.value for r in profile.completeness_report(df, "session", "key", ["a", "b"], "found", 2020).collect()}
    assert got == {("rows", 2019, None): 2, ("rows", 2020, None): 1, ("key_coverage", 2019, None): 0.5, ("key_coverage", 2020, None): 1, ("missing_column", 2019, "b"): 1, ("null_share", None, "a"): pytest.approx(1 / 3), ("null_share", None, "b"): pytest.approx(2 / 3), ("without_antecedent", None, None): 2, ("before_first_label", None, None): 2}


def test_importance_needs_weight_and_names_may_lack(spark):
    df = spark.createDataFrame([(1.0, -3.0, 2.0), (0.0, 1.0, 1.0)], "a double, b double, w double")
    found = metrics.importance(df, ["a", "b"], "w")
    assert {r.variable: (round(r.importance, 6), round(r.share, 6)) for r in found.collect()} == {"a": (0.666667, 0.222222), "b": (2.333333, 0.777778)}
    assert {r.variable: round(r.share, 6) for r in metrics.named_shares(found, ["b", "z"]).collect()} == {"b": 0.777778, "z": 0.0}
    assert {r.share for r in metrics.importance(df.withColumns({"a": F.lit(0.0), "b": F.lit(0.0)}), ["a", "b"], "w").collect()} == {0.0}
    for w in (0.0, -1.0):
        with pytest.raises(Exception, match="total weight"):
            metrics.importance(df.withColumn("w", F.lit(w)), ["a", "b"], "w").collect()
