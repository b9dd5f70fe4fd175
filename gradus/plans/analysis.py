"""Queries of joins, aggregates, the star schema, audits and drift (C, D, E)."""

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import drift, features, governance, matching, metrics, profile, reconcile, register, star
from ..sources import tables as S
from .bindings import CELLS, RATE, RATED, UNITS, YEARLY, cells, query, r6, rated, t, units, yearly
from .tables import _CONTRIB, _LINES, SHAP, contributions

_SCD = f"""{YEARLY}, s AS (SELECT *, CASE WHEN lag(session) OVER w IS NULL OR flag IS DISTINCT FROM lag(flag) OVER w OR level IS DISTINCT FROM lag(level) OVER w THEN 1 ELSE 0 END AS new FROM yearly WINDOW w AS (PARTITION BY key ORDER BY session)),
  g AS (SELECT *, sum(new) OVER (PARTITION BY key ORDER BY session)::BIGINT AS version FROM s),
  dim AS (SELECT key, version, any_value(flag) AS flag, max(level) AS level, min(session) AS debut, max(session) AS fin FROM g GROUP BY 1, 2)"""


def dimension(spark, sf):
    return star.versions(yearly(spark, sf), "key", "session", ["flag", "level"])


@query("c01_version_lookup", f"WITH {_SCD} SELECT y.key, y.session, d.version, d.level FROM yearly y LEFT JOIN dim d ON y.key = d.key AND y.session BETWEEN d.debut AND d.fin")
def _(spark, sf):
    return star.version_lookup(yearly(spark, sf).select("key", "session"), dimension(spark, sf), "key", "session", ["version", "level"])


@query("c02_guarded_join", "SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def _(spark, sf):
    n = t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return star.guarded_join(t(spark, sf, "customer").select("c_custkey", "c_nationkey"), n, ["c_nationkey"])


@query("c03_orphans", "SELECT count(*) AS orphans FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)")
def _(spark, sf):
    dim = t(spark, sf, "customer").where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("o_custkey"))
    return star.orphans(t(spark, sf, "orders"), dim, "o_custkey")


@query("c04_null_safe_lookup", f"WITH {YEARLY}, d AS (SELECT town, row_number() OVER (ORDER BY town NULLS FIRST)::INT AS sk FROM (SELECT DISTINCT town FROM yearly)) SELECT key, session, d.sk FROM yearly y JOIN d ON y.town IS NOT DISTINCT FROM d.town")
def _(spark, sf):
    y = yearly(spark, sf)
    dim = star.numbered(y.select("town").distinct(), "sk", [F.asc_nulls_first("town")])
    return star.null_safe_lookup(y, dim, ["town"], ["sk"]).select("key", "session", "sk")


@query("c05_current_lookup", f"WITH {CELLS}, {YEARLY} SELECT c.key, c.session, c.kind, c.scholar, y.level FROM cells c LEFT JOIN yearly y USING (key, session)")
def _(spark, sf):
    return features.current_lookup(cells(spark, sf), yearly(spark, sf), ["key", "session"], ["level"]).select("key", "session", "kind", "scholar", "level")


_LAG = f"{YEARLY}, f AS (SELECT a.key, a.session, b.level AS lag__level, b.n AS lag__n, b.key IS NOT NULL AS antecedent FROM yearly a LEFT JOIN yearly b ON b.key = a.key AND b.session + 1 = a.session)"


@query("c06_lagged_lookup", f"WITH {_LAG} SELECT * FROM f")
def _(spark, sf):
    y = yearly(spark, sf)
    return features.lagged_lookup(y.select("key", "session"), y, "key", "session", ["level", "n"])


@query("c07_taxonomy_bridge", "SELECT p_partkey, l_suppkey, s_nationkey, p_size > 25 AS actif, count(*) AS n FROM part JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL")
def _(spark, sf):
    p, line, s = t(spark, sf, "part"), t(spark, sf, "lineitem"), t(spark, sf, "supplier")
    status = p.select("p_partkey", (F.col("p_size") > 25).alias("actif"))
    out = matching.bridge(p.select("p_partkey"), line.select(F.col("l_partkey").alias("p_partkey"), "l_suppkey"), s.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), status, ["p_partkey", "l_suppkey"], "p_partkey")
    return out.groupBy("p_partkey", "l_suppkey", "s_nationkey", "actif").agg(F.count(F.lit(1)).alias("n"))


_KEY, _LABEL = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))", "p_name || '-' || p_type || '-' || p_size"


@query("c08_unambiguous_labels", f"WITH r AS (SELECT {_KEY.format(_LABEL)} AS k, min(p_brand) AS brand FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) = 1) SELECT p_partkey, brand FROM part JOIN r ON r.k = {_KEY.format(_LABEL)}")
def _(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.concat_ws("-", "p_name", "p_type", "p_size").alias("label"), F.col("p_brand").alias("brand"))
    return matching.unambiguous_labels(p.select("p_partkey", "label"), "label", p.select("label", "brand"), "label", "brand").select("p_partkey", "brand")


_OUTLETS = """cnt AS (SELECT CASE WHEN l_partkey % 20 < 18 THEN l_partkey % 20 END AS departement, l_linenumber AS division, count(*) AS n FROM lineitem GROUP BY ALL), pub AS (SELECT * FROM cnt WHERE n >= (SELECT avg(n) FROM cnt)),
dv AS (SELECT s_suppkey AS code, CASE WHEN s_suppkey % 6 <> 0 THEN s_suppkey % 7 + 1 END AS division FROM supplier)"""


def _outlet(q):
    """status and value of the rows (id, code, departement) of q."""
    return f"""j AS (SELECT q.*, (SELECT sum(n) FROM dv JOIN pub USING (division) WHERE dv.code = q.code AND pub.departement = q.departement) AS n, EXISTS (SELECT 1 FROM dv JOIN cnt USING (division) WHERE dv.code = q.code AND cnt.departement = q.departement) AS e FROM {q} q),
s AS (SELECT *, CASE WHEN departement IS NULL THEN 'indisponible_territoire_non_renseigne' WHEN code IS NULL THEN 'indisponible_chaine_rompue' WHEN code NOT IN (SELECT code FROM dv WHERE division IS NOT NULL AND code % 10 <> 0) THEN 'indisponible_certification_radiee' WHEN n IS NOT NULL OR NOT e THEN 'mesure' ELSE 'indisponible_k_anonymat' END AS statut FROM j),
o AS (SELECT id, statut, CASE statut WHEN 'mesure' THEN least(1.0, coalesce(n, 0) / 2000.0) WHEN 'indisponible_certification_radiee' THEN 0.0 ELSE 1.0 END::DOUBLE AS debouches FROM s)"""


def outlets(spark, sf, rows):
    """Outlet terms of rows (id, code, departement): departments without an area, codes without division and withdrawn codes are built in."""
    line = t(spark, sf, "lineitem").select(F.when(F.col("l_partkey") % 20 < 18, F.col("l_partkey") % 20).alias("departement"), F.col("l_linenumber").cast("long").alias("division"))
    every = line.groupBy("departement", "division").agg(F.count(F.lit(1)).alias("n"))
    published = every.crossJoin(F.broadcast(every.agg(F.avg("n").alias("least")))).where("n >= least").drop("least")  # one row
    s = t(spark, sf, "supplier")
    divisions = s.select(F.col("s_suppkey").alias("code"), F.when(F.col("s_suppkey") % 6 != 0, F.col("s_suppkey") % 7 + 1).alias("division"))
    active = s.select(F.col("s_suppkey").alias("code"), (F.col("s_suppkey") % 10 != 0).alias("actif"))
    return matching.outlet_term(rows, "code", "departement", divisions, published, every, active, 2000)


@query("c09_outlet_term", f"WITH {_OUTLETS}, q AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 120 + 1 END AS code, CASE WHEN c_custkey % 8 <> 0 THEN c_custkey % 20 END AS departement FROM customer), {_outlet('q')} SELECT * FROM o")
def _(spark, sf):
    c = F.col("c_custkey")
    rows = t(spark, sf, "customer").select(c.alias("id"), F.when(c % 9 != 0, c % 120 + 1).alias("code"), F.when(c % 8 != 0, c % 20).alias("departement"))
    return outlets(spark, sf, rows).select("id", "statut", "debouches")


@query("c10_default_group", "SELECT d.doc_id, coalesce('q' || quality, 'indetermine') AS grp FROM documents d LEFT JOIN labels USING (doc_id)")
def _(spark, sf):
    groups = t(spark, sf, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("grp"))
    return matching.with_default_group(t(spark, sf, "documents").select("doc_id"), groups, "doc_id", "grp")


@query("c11_recommendation", f"""WITH {_OUTLETS}, p AS (SELECT s_suppkey AS profile, s_nationkey AS area, s_suppkey % 5 AS kind, CASE WHEN s_suppkey % 3 = 0 THEN 'green' END AS word FROM supplier),
q AS (SELECT p_partkey AS id, p_partkey % 120 + 1 AS code, p_size % 25 AS departement FROM part), {_outlet('q')},
k AS (SELECT p_partkey, p_partkey % 5 AS kind, p_size % 25 AS area2, lower(p_name) AS label, ((p_partkey * 37) % 1000) / 1000::DOUBLE AS taux, debouches FROM part JOIN o ON id = p_partkey),
x AS (SELECT profile, p_partkey, CASE WHEN word IS NOT NULL AND NOT contains(label, word) THEN 0.0 WHEN area <> area2 THEN 0.6 ELSE 1.0 END::DOUBLE AS affinite, taux AS accessibilite, debouches FROM p JOIN k USING (kind)),
r AS (SELECT *, affinite * accessibilite * debouches AS score, row_number() OVER (PARTITION BY profile ORDER BY affinite * accessibilite * debouches DESC, p_partkey)::INT AS rang FROM x)
SELECT profile, p_partkey, affinite, accessibilite, debouches, round(score, 6) AS score, rang FROM r WHERE rang <= 10""")
def _(spark, sf):
    p = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("profile"), F.col("s_nationkey").alias("area"), (F.col("s_suppkey") % 5).alias("kind"), F.when(F.col("s_suppkey") % 3 == 0, "green").alias("word"))
    k = t(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 120 + 1).alias("code"), (F.col("p_size") % 25).cast("long").alias("departement"), "p_partkey", (F.col("p_partkey") % 5).alias("kind"), F.col("p_name").alias("label"), (F.col("p_partkey") * 37 % 1000 / F.lit(1000.0)).alias("taux"))
    k = outlets(spark, sf, k).withColumnRenamed("departement", "area2")
    p, k = matching.with_word_key(p, "word"), matching.with_text_key(k, ["label"])  # once a row, not once a pair
    out = matching.recommend_by_wish(p, k, ["kind"], "profile", "_word", "area", ["p_partkey"], "_text", "area2", "taux", "debouches", 10)
    return out.select("profile", "p_partkey", "affinite", "accessibilite", "debouches", *r6("score"), "rang")


@query("c12_point_lookup", f"WITH {CELLS} SELECT key, session, kind, scholar, effectif FROM cells WHERE key % 100 = 3 AND session = 1997")
def _(spark, sf):
    wanted = t(spark, sf, "customer").where("c_custkey % 100 = 3").select(F.col("c_custkey").alias("key"), F.lit(1997).alias("session"))
    return cells(spark, sf).join(wanted, ["key", "session"], "left_semi").select("key", "session", "kind", "scholar", "effectif")


@query("c13_any_identifier", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_partkey % 500 = 7 OR l_suppkey % 500 = 7")
def _(spark, sf):
    wanted = t(spark, sf, "part").where("p_partkey % 500 = 7").select(F.col("p_partkey").alias("id")).unionByName(t(spark, sf, "supplier").where("s_suppkey % 500 = 7").select(F.col("s_suppkey").alias("id")))
    return matching.any_identifier(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_partkey", "l_suppkey"], wanted, "id")


@query("c14_survival", f"WITH {YEARLY} SELECT a.session, count(*) AS n, round(avg(CASE WHEN b.key IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS survival FROM yearly a LEFT JOIN yearly b ON b.key = a.key AND b.session = a.session + 1 GROUP BY 1")
def _(spark, sf):
    return matching.survival(yearly(spark, sf), "key", "session").select("session", "n", *r6("survival"))


@query("c15_enriched_predictions", f"WITH {RATED} SELECT key, session, kind, scholar, segment, round(taux, 6) AS taux, pred FROM rated")
def _(spark, sf):
    return rated(spark, sf).select("key", "session", "kind", "scholar", "segment", *r6("taux"), "pred")


_TIERS = ["0", "1_9", "10_49", "50_249", "250_plus", "non_renseignee"]
_CODES = {"0": "00", "1_9": "01", "10_49": "11", "50_249": "21", "250_plus": "32", "non_renseignee": "NN"}
_AGE = "date_diff('day', created, DATE '2002-08-01') / 365.25"
D01 = (
    "SELECT town, activity, count(*) FILTER (s = 'O') AS n_actifs, count(*) FILTER (s = 'F') AS n_fermes, "
    + ", ".join(f"count(*) FILTER (s = 'O' AND code = '{_CODES[x]}') AS n_{x}" for x in _TIERS)
    + f", count(*) FILTER (s = 'O' AND created >= DATE '1998-01-01') AS n_nouveau_code, round(avg({_AGE}) FILTER (s = 'O'), 6) AS age_moyen, count(*) FILTER (s = 'O' AND {_AGE} <= 3) AS n_recents, '2002-08-01' AS date_reference"
    + " FROM (SELECT *, CASE WHEN activity = '0049' THEN 'X' ELSE state END AS s FROM units) WHERE town IS NOT NULL AND employer AND s IN ('O', 'F') GROUP BY 1, 2"
)


def town_activity(spark, sf):
    rows = units(spark, sf).withColumn("state", F.when(F.col("activity") == "0049", "X").otherwise(F.col("state")))
    rows = rows.withColumn("new_code", F.when(F.col("created") >= F.lit("1998-01-01").cast("date"), F.col("activity")))
    employers = register.filtered(rows, employer=F.col("employer"))
    return register.town_activity(employers, "town", "activity", "state", "O", "F", X.tier("code", X.WORKFORCE_TIERS), _TIERS, "created", "2002-08-01", "new_code")


@query("d01_town_activity", f"WITH {UNITS} {D01}")
def _(spark, sf):
    a = town_activity(spark, sf)
    return a.select(*[c for c in a.columns if c not in ("date_reference", "age_moyen")], *r6("age_moyen"), F.col("date_reference").cast("string").alias("date_reference"))


@query("d02_totals", f"WITH {UNITS}, a AS ({D01}) SELECT count(*) AS cellules, sum(n_actifs)::BIGINT AS n_actifs, sum(n_fermes)::BIGINT AS n_fermes, sum(n_nouveau_code)::BIGINT AS n_nouveau_code FROM a")
def _(spark, sf):
    return register.totals(town_activity(spark, sf), ["n_actifs", "n_fermes", "n_nouveau_code"])


_D03 = "SELECT left(town, 2) AS departement, left(activity, 2) AS division, count(*) AS n FROM units WHERE town IS NOT NULL AND state = 'O' AND employer AND code <> '00' GROUP BY 1, 2"


def department_division(spark, sf):
    return register.department_division(units(spark, sf), X.department("town", ()), X.division("activity"), F.col("town").isNotNull() & (F.col("state") == "O") & F.col("employer") & (F.col("code") != "00"))


@query("d03_department_division", f"WITH {UNITS} {_D03}")
def _(spark, sf):
    return department_division(spark, sf)


@query("d04_k_anonymity", f"WITH {UNITS}, a AS ({_D03}) SELECT count(*) AS cellules, count(*) FILTER (n < 50) AS cellules_perdues, coalesce(sum(n) FILTER (n < 50), 0)::BIGINT AS unites_perdues, round(count(*) FILTER (n < 50) / nullif(count(*), 0)::DOUBLE, 6) AS part_cellules, round(coalesce(sum(n) FILTER (n < 50), 0) / nullif(sum(n), 0)::DOUBLE, 6) AS part_unites FROM a")
def _(spark, sf):
    lost = register.k_anonymous(department_division(spark, sf), 50)[1]
    return lost.select("cellules", "cellules_perdues", "unites_perdues", *r6("part_cellules", "part_unites"))


_ERR = "count(*) AS n, round(avg((p IS NOT NULL)::INT), 6) AS coverage, round(sum(CASE WHEN p IS NOT NULL AND taux IS NOT NULL THEN abs(taux - p) * effectif END) / nullif(sum(CASE WHEN p IS NOT NULL AND taux IS NOT NULL THEN effectif END), 0), 6) AS mae_weighted, round(avg(abs(taux - p)), 6) AS mae"


@query("d05_errors", f"WITH {RATED}, e AS (SELECT *, pred AS p FROM rated) SELECT {_ERR} FROM e")
def _(spark, sf):
    return metrics.errors(rated(spark, sf), "taux", "pred", "effectif").select("n", *r6("coverage", "mae_weighted", "mae"))


@query("d06_errors_with_coverage", f"WITH {RATED}, e AS (SELECT *, baseline AS p FROM rated) SELECT segment, {_ERR} FROM e GROUP BY 1")
def _(spark, sf):
    return metrics.errors(rated(spark, sf), "taux", "baseline", "effectif", ["segment"]).select("segment", "n", *r6("coverage", "mae_weighted", "mae"))


@query("d07_scoped_errors", f"WITH {RATED}, s AS (SELECT * FROM (VALUES ('train', 1995, 1999), ('test', 2000, 2001), ('all', 1995, 2001)) v(scope, a, b)), e AS (SELECT scope, variant, taux, effectif, CASE variant WHEN 'pred' THEN pred ELSE baseline END AS p FROM rated JOIN s ON session BETWEEN a AND b, (VALUES ('pred'), ('baseline')) w(variant)) SELECT scope, variant, {_ERR} FROM e GROUP BY 1, 2")
def _(spark, sf):
    scopes = {"train": range(1995, 2000), "test": range(2000, 2002), "all": range(1995, 2002)}
    return metrics.scoped_errors(rated(spark, sf), "taux", ["pred", "baseline"], "effectif", "session", scopes).select("scope", "variant", "n", *r6("coverage", "mae_weighted", "mae"))


@query("d08_baseline_equal_coverage", f"WITH {RATED}, e AS (SELECT *, coalesce(baseline, pred) AS p FROM rated WHERE session IN (2000, 2001)) SELECT {_ERR} FROM e")
def _(spark, sf):
    rows = features.fallback_prediction(rated(spark, sf), "baseline", "pred", "session", [2000, 2001])
    return metrics.errors(rows, "taux", "prediction", "effectif").select("n", *r6("coverage", "mae_weighted", "mae"))


_CAL = "least(floor(greatest(least(pred, 1.0), 0.0) * 10), 9)::INT AS bin, count(*) AS n, sum(effectif) AS weight, sum(pred * effectif) / sum(effectif) AS predicted, sum(taux * effectif) / sum(effectif) AS observed"


@query("d09_calibration", f"WITH {RATED} SELECT bin, n, weight, round(predicted, 6) AS predicted, round(observed, 6) AS observed, round(predicted - observed, 6) AS gap FROM (SELECT {_CAL} FROM rated WHERE taux IS NOT NULL GROUP BY 1)")
def _(spark, sf):
    return metrics.calibration(rated(spark, sf), "taux", "pred", "effectif").select("bin", "n", "weight", *r6("predicted", "observed", "gap"))


_AUDIT = f"""{RATED}, l AS (SELECT 'segment' AS dimension, coalesce(segment, 'indetermine') AS grp, * FROM rated UNION ALL SELECT 'kind', kind, * FROM rated),
  b AS (SELECT dimension, grp, least(floor(pred * 10), 9) AS bin, sum(effectif) AS w, abs(sum(pred * effectif) / sum(effectif) - sum(taux * effectif) / sum(effectif)) AS gap FROM l WHERE taux IS NOT NULL GROUP BY ALL),
  e AS (SELECT dimension, grp, sum(gap * w) / sum(w) AS ece FROM b GROUP BY ALL),
  a AS (SELECT dimension, grp, count(*) AS n, sum(effectif) AS weight, count(*) >= 30 AS reliable, sum(CASE WHEN taux IS NOT NULL THEN abs(taux - pred) * effectif END) / sum(CASE WHEN taux IS NOT NULL THEN effectif END) AS mae_model,
    sum(CASE WHEN taux IS NOT NULL AND baseline IS NOT NULL THEN abs(taux - baseline) * effectif END) / sum(CASE WHEN taux IS NOT NULL AND baseline IS NOT NULL THEN effectif END) AS mae_baseline, avg(abs(taux - pred)) AS mae_plain,
    sum(CASE WHEN pred >= 0.5 THEN effectif ELSE 0 END) / sum(effectif) AS selected, sum(CASE WHEN taux >= 0.5 THEN effectif ELSE 0 END) / sum(effectif) AS selected_observed FROM l GROUP BY ALL)"""


def audit(spark, sf):
    return metrics.group_audit(rated(spark, sf), ["segment", "kind"], "taux", "pred", "baseline", "effectif")


@query("d10_group_audit", f"WITH {_AUDIT} SELECT dimension, grp, n, weight, reliable, round(mae_model, 6) AS mae_model, round(mae_baseline, 6) AS mae_baseline, round(mae_plain, 6) AS mae_plain, round(selected, 6) AS selected, round(selected_observed, 6) AS selected_observed, round(ece, 6) AS ece FROM a LEFT JOIN e USING (dimension, grp)")
def _(spark, sf):
    return audit(spark, sf).select("dimension", "grp", "n", "weight", "reliable", *r6("mae_model", "mae_baseline", "mae_plain", "selected", "selected_observed", "ece"))


@query("d11_disparate_impact", f"WITH {_AUDIT} SELECT dimension, grp, round(selected / max(selected) OVER (PARTITION BY dimension), 6) AS ratio, selected / max(selected) OVER (PARTITION BY dimension) < 0.99 AS below FROM a WHERE reliable")
def _(spark, sf):
    return metrics.disparate_impact(audit(spark, sf), least=0.99).select("dimension", "grp", *r6("ratio"), "below")


def _eta(v):
    return f"SELECT '{v}' AS variable, round(sum(n * (m - g) ** 2) FILTER (c_mktsegment IS NOT NULL) / sum(n * (m - g) ** 2 + n * s2), 6) AS eta2 FROM (SELECT c_mktsegment, count({v}) AS n, avg({v}) AS m, var_pop({v}) AS s2, (SELECT avg({v}) FROM customer) AS g FROM customer GROUP BY 1)"


@query("d12_correlation_ratio", f"{_eta('c_acctbal')} UNION ALL {_eta('c_nationkey')}")
def _(spark, sf):
    return metrics.correlation_ratio(t(spark, sf, "customer"), ["c_acctbal", "c_nationkey"], "c_mktsegment").select("variable", *r6("eta2"))


def _walk(steps: int, rounds: int) -> str:
    """The permutation as SQL: a column a Feistel step; places beyond the last row are sent on."""
    keys = lambda step: f"((round * 7919 + {step * 104_729 + 12_345}) % 2147483647)"
    text, x = [f"numbered AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS rn, c_mktsegment AS grp, c_acctbal AS v, count(*) OVER () AS n FROM customer), s AS (SELECT *, ceil(sqrt(n))::BIGINT AS a FROM numbered), w0 AS (SELECT *, ceil(n / a)::BIGINT AS b, unnest(range({rounds + 1})) AS round, rn AS x FROM s)"], "x"
    for k in range(1, steps + 1):
        columns = ["(x // b) AS h0", "(x % b) AS l0"]
        for step in range(6):
            other, base, own, keep = (("l", "a", "h", "l") if step % 2 == 0 else ("h", "b", "l", "h"))
            columns += [f"(({other}{step} * 48271 + {keys(step)}) % 2147483647) AS t{step}", f"(({own}{step} + (t{step} * t{step} + t{step}) % 2147483647) % {base}) AS {own}{step + 1}", f"{keep}{step} AS {keep}{step + 1}"]
        text.append(f"w{k} AS (SELECT rn, grp, v, n, a, b, round, CASE WHEN round = 0 OR ({k} > 1 AND x < n) THEN x ELSE h6 * b + l6 END AS x FROM (SELECT *, {', '.join(columns)} FROM w{k - 1}))")
    return ", ".join(text)


@query("d13_net_variance", f"""WITH {_walk(16, 5)}, g AS (SELECT w.round, q.grp, count(w.v) AS n, avg(w.v) AS m FROM w16 w JOIN numbered q ON q.rn = w.x GROUP BY ALL),
  e AS (SELECT round, sum(n * (m - (SELECT avg(c_acctbal) FROM customer)) ** 2) FILTER (grp IS NOT NULL) / (SELECT var_pop(c_acctbal) * count(c_acctbal) FROM customer) AS eta2 FROM g GROUP BY 1)
  SELECT round(max(eta2) FILTER (round = 0), 6) AS observed, round(avg(eta2) FILTER (round > 0), 6) AS chance, round(max(eta2) FILTER (round = 0) - avg(eta2) FILTER (round > 0), 6) AS net FROM e""")
def _(spark, sf):
    return metrics.net_variance(t(spark, sf, "customer"), "c_acctbal", "c_mktsegment", ["c_custkey"]).select(*r6("observed", "chance", "net"))


_GAP = "CASE WHEN d0 > 0 AND d1 > 0 THEN least(n0 / d0::DOUBLE, 1.0) - least(n1 / d1::DOUBLE, 1.0) END"


@query("d14_rate_gap", "WITH w AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 250000) AS n0, nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS d0, count(*) FILTER (o_orderstatus = 'O' AND o_totalprice > 250000) AS n1, nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS d1 FROM orders GROUP BY 1), g AS (SELECT " + _GAP + " AS gap FROM w) SELECT round(median(gap), 6) AS median_gap, round(avg((abs(gap) < 0.05)::INT), 6) AS share_close, count(*) FILTER (gap IS NULL) AS undetermined FROM g")
def _(spark, sf):
    big = F.col("o_totalprice") > 250000
    agg = [x for i, s in enumerate("FO") for x in (F.count_if((F.col("o_orderstatus") == s) & big).alias(f"n{i}"), F.nullif(F.count_if(F.col("o_orderstatus") == s), F.lit(0)).alias(f"d{i}"))]
    w = t(spark, sf, "orders").groupBy("o_custkey").agg(*agg)
    return metrics.rate_gap(w, ("n0", "d0"), ("n1", "d1")).select(*r6("median_gap", "share_close"), "undetermined")


@query("d15_composition", f"WITH {CELLS}, c AS (SELECT key, sum(num) AS num, sum(effectif) AS den FROM cells WHERE session = 2000 GROUP BY 1) SELECT key, CASE WHEN num / den < 0.2 THEN 'minoritaire' WHEN num / den <= 0.8 THEN 'mixte' ELSE 'majoritaire' END AS composition FROM c")
def _(spark, sf):
    c = cells(spark, sf).where("session = 2000").groupBy("key").agg(F.sum("num").alias("num"), F.sum("effectif").alias("den"))
    return c.select("key", X.composition(X.bounded_rate("num", "den")).alias("composition"))


_NUMBERS, _CATEGORIES = ["quantity", "price", "discount", "tax", "rate", "prediction"], ["flag", "label"]
_FAMILIES = {"rate": "target", "prediction": "prediction"}
_TRAIN, _YEARS = [1995, 1996, 1997, 1998], range(1995, 2001)
#: Reference and later years of each comparison: the training years with validation and test, and every two consecutive years.
COMPARISONS = {"train-validation": (_TRAIN, [1999]), "train-test": (_TRAIN, [2000])} | {f"{y}-{y + 1}": ([y], [y + 1]) for y in _YEARS}
_PRODUCTION = ["train-validation", "train-test"]


def drift_rows(spark, sf):
    """Order lines by year: measures, a rate with its prediction, and two texts, one of which is spelt in two ways and may lack."""
    part = F.when(F.col("l_suppkey") % 30 != 3, F.concat(F.when(F.col("l_orderkey") % 2 == 0, "Côte_").otherwise("cote - "), (F.col("l_suppkey") % 30).cast("string")))
    return t(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("session"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        X.bounded_rate("l_discount", "l_tax").alias("rate"), (F.col("l_partkey") * 37 % 1000 / F.lit(1000.0)).alias("prediction"), F.concat_ws("-", "l_returnflag", "l_linestatus").alias("flag"), part.alias("label"),
    )


_SIDES = ", ".join(f"('{name}', {y}, {i == 0})" for name, sides in COMPARISONS.items() for i, years in enumerate(sides) for y in years)
_DRIFT = f"""sides(comparison, session, side) AS (VALUES {_SIDES}),
  y AS (SELECT year(l_shipdate) AS session, unnest(['quantity', 'price', 'discount', 'tax', 'rate', 'prediction']) AS variable,
    unnest([l_quantity::DOUBLE, l_extendedprice::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE, CASE WHEN l_tax = 0 THEN CASE WHEN l_discount > 0 THEN 1.0::DOUBLE END ELSE least(l_discount / l_tax, 1.0::DOUBLE) END,
      (l_partkey * 37 % 1000) / 1000::DOUBLE]) AS v FROM lineitem),
  r AS (SELECT {{'variable': variable, 'comparison': comparison}} AS variable, side, v FROM y JOIN sides USING (session) WHERE v IS NOT NULL),
  yc AS (SELECT year(l_shipdate) AS session, unnest(['flag', 'label']) AS variable, unnest([lower(l_returnflag || ' ' || l_linestatus), CASE WHEN l_suppkey % 30 = 3 THEN '__manquant__' ELSE 'cote ' || (l_suppkey % 30) END]) AS c FROM lineitem),
  rc AS (SELECT {{'variable': variable, 'comparison': comparison}} AS variable, side, c FROM yc JOIN sides USING (session))"""
_PSI = """q AS (SELECT variable, list_filter(list_distinct(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])), lambda x: x > min(v) AND x < max(v)) AS e FROM r WHERE side GROUP BY variable),
  b AS (SELECT variable, len(list_filter(e, lambda x: x < v)) AS bin, count(*) FILTER (side) AS a, count(*) FILTER (NOT side) AS b FROM r JOIN q USING (variable) GROUP BY ALL),
  s AS (SELECT variable, greatest(a / sum(a) OVER w, 0.0001) AS p, greatest(b / sum(b) OVER w, 0.0001) AS q FROM b WINDOW w AS (PARTITION BY variable)),
  p AS (SELECT variable, sum((q - p) * ln(q / p)) AS psi FROM s GROUP BY 1)"""
_PSIC = """kc AS (SELECT variable, c FROM (SELECT variable, c, row_number() OVER (PARTITION BY variable ORDER BY count(*) DESC, c) AS rn FROM rc WHERE side GROUP BY variable, c) WHERE rn <= 20),
  bc AS (SELECT rc.variable, CASE WHEN kc.c IS NULL THEN '__autre__' ELSE rc.c END AS bin, count(*) FILTER (side) AS a, count(*) FILTER (NOT side) AS b FROM rc LEFT JOIN kc ON kc.variable = rc.variable AND kc.c = rc.c GROUP BY ALL),
  sc AS (SELECT variable, greatest(a / sum(a) OVER w, 0.0001) AS p, greatest(b / sum(b) OVER w, 0.0001) AS q FROM bc WINDOW w AS (PARTITION BY variable)),
  pc AS (SELECT variable, sum((q - p) * ln(q / p)) AS psi FROM sc GROUP BY 1)"""
_KS = """c AS (SELECT variable, v, count(*) FILTER (side) AS a, count(*) FILTER (NOT side) AS b FROM r GROUP BY ALL),
  k AS (SELECT variable, abs(sum(a) OVER u / sum(a) OVER w - sum(b) OVER u / sum(b) OVER w) AS d FROM c WINDOW u AS (PARTITION BY variable ORDER BY v), w AS (PARTITION BY variable)),
  m AS (SELECT variable, max(d) AS ks FROM k GROUP BY 1)"""
_OF = "variable.variable AS variable, variable.comparison AS comparison"
_REPORT = f"""{_DRIFT}, {_PSI}, {_PSIC}, {_KS},
  n AS (SELECT variable, count(*) FILTER (side) AS n_reference, count(*) FILTER (NOT side) AS n_comparison FROM (SELECT variable, side FROM r UNION ALL SELECT variable, side FROM rc WHERE c <> '__manquant__') GROUP BY 1),
  x AS (SELECT variable, 'numerique' AS type, psi, ks FROM p JOIN m USING (variable) UNION ALL SELECT variable, 'categorielle', psi, NULL FROM pc),
  report AS (SELECT {_OF}, type, n_reference, n_comparison, psi, ks, psi >= 0.2 AS beyond,
    CASE variable.variable WHEN 'rate' THEN 'target' WHEN 'prediction' THEN 'prediction' ELSE 'variable' END AS family FROM x JOIN n USING (variable))"""


def drift_counts(spark, sf, numbers=_NUMBERS, categories=_CATEGORIES):
    return drift.stored_histogram(drift_rows(spark, sf), "session", numbers, categories)


def report(spark, sf):
    return drift.drift_report(drift_rows(spark, sf), "session", _NUMBERS, _CATEGORIES, COMPARISONS, _FAMILIES)


@query("d16_psi_numeric", f"WITH {_DRIFT}, {_PSI} SELECT {_OF}, round(psi, 6) AS psi FROM p")
def _(spark, sf):
    return drift.numeric_index(drift_counts(spark, sf, categories=()), COMPARISONS).select("variable", "comparison", *r6("psi"))


@query("d17_psi_categorical", f"WITH {_DRIFT}, {_PSIC} SELECT {_OF}, round(psi, 6) AS psi FROM pc")
def _(spark, sf):
    return drift.categorical_index(drift_counts(spark, sf, numbers=()), COMPARISONS).select("variable", "comparison", *r6("psi"))


@query("d18_ks", f"WITH {_DRIFT}, {_KS} SELECT {_OF}, round(ks, 6) AS ks FROM m")
def _(spark, sf):
    return drift.distances(drift_counts(spark, sf, categories=()), COMPARISONS).select("variable", "comparison", *r6("ks"))


@query("d19_drift_report", f"WITH {_REPORT} SELECT variable, type, family, comparison, n_reference, n_comparison, round(psi, 6) AS psi, round(ks, 6) AS ks, beyond FROM report")
def _(spark, sf):
    return report(spark, sf).select("variable", "type", "family", "comparison", "n_reference", "n_comparison", *r6("psi", "ks"), "beyond")


@query("d19_retraining", f"""WITH {_REPORT}, g AS (SELECT comparison, median(psi) FILTER (family = 'variable') AS m, bool_or(beyond) FILTER (family = 'target') AS target, bool_or(beyond) FILTER (family = 'prediction') AS prediction
  FROM report WHERE comparison IN ('train-validation', 'train-test') GROUP BY 1)
  SELECT comparison, round(m, 6) AS median_psi, m >= 0.2 AS variables, target, prediction, bool_or(m >= 0.2 OR target OR prediction) OVER () AS retrain FROM g""")
def _(spark, sf):
    return drift.retraining(report(spark, sf), _PRODUCTION).select("comparison", *r6("median_psi"), "variables", "target", "prediction", "retrain")


@query("d19_worst_variables", f"WITH {_REPORT} SELECT variable, round(psi, 6) AS psi, round(ks, 6) AS ks, beyond FROM report WHERE comparison = 'train-test' AND family = 'variable' ORDER BY report.psi DESC, variable LIMIT 15")
def _(spark, sf):
    return drift.worst(report(spark, sf), "train-test").select("variable", *r6("psi", "ks"), "beyond")


@query("d20_expanding_mean", f"WITH {RATED}, s AS (SELECT segment, session, sum(taux * effectif) AS s, sum(effectif) AS w FROM rated GROUP BY ALL), m AS (SELECT segment, session, sum(s) OVER x / sum(w) OVER x AS expanding FROM s WINDOW x AS (PARTITION BY segment ORDER BY session RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT segment, session, round(expanding, 6) AS expanding, count(*) AS n FROM rated JOIN m USING (segment, session) GROUP BY ALL")
def _(spark, sf):
    rows = features.expanding_mean(rated(spark, sf), "taux", "effectif", "session", ["segment"])
    return rows.groupBy("segment", "session", F.round("expanding", 6).alias("expanding")).agg(F.count(F.lit(1)).alias("n"))


@query("d21_coverage_links", f"WITH {RATED} SELECT 'taux' AS link, count(*) AS total, count(taux) AS kept, round(count(taux) / count(*)::DOUBLE, 6) AS rate FROM rated UNION ALL SELECT 'baseline', count(taux), count(*) FILTER (taux IS NOT NULL AND baseline IS NOT NULL), round(count(*) FILTER (taux IS NOT NULL AND baseline IS NOT NULL) / count(taux)::DOUBLE, 6) FROM rated")
def _(spark, sf):
    has = F.col("taux").isNotNull()
    return profile.coverage_links({"taux": (F.lit(True), has), "baseline": (has, F.col("baseline").isNotNull())}, rated(spark, sf)).select("link", "total", "kept", *r6("rate"))


@query("d21_bridge_coverage", """WITH p AS (SELECT CASE WHEN p_partkey % 10 <> 0 THEN p_partkey END AS code FROM part), c AS (SELECT DISTINCT l_partkey AS code, l_suppkey AS occ FROM lineitem WHERE l_partkey % 7 <> 0),
  o AS (SELECT s_suppkey AS occ, s_nationkey AS division FROM supplier WHERE s_suppkey % 5 <> 0), st AS (SELECT p_partkey AS code, p_size > 25 AS actif FROM part WHERE p_partkey % 13 <> 0),
  f AS (SELECT code, occ, division, actif FROM p JOIN c USING (code) JOIN o USING (occ) LEFT JOIN st USING (code)),
  n AS (SELECT (SELECT count(*) FROM p) AS a, (SELECT count(code) FROM p) AS b, (SELECT count(DISTINCT code) FROM c) AS c, (SELECT count(DISTINCT occ) FROM c) AS d, (SELECT count(DISTINCT occ) FROM c SEMI JOIN o USING (occ)) AS e,
    (SELECT count(*) FROM f) AS g, (SELECT count(*) FILTER (actif) FROM f) AS h, (SELECT count(DISTINCT code) FROM f) AS i, (SELECT count(DISTINCT code) FILTER (actif) FROM f) AS j),
  l AS (SELECT unnest(['programme -> code', 'certificate -> occupation', 'programme with code -> division', 'occupation -> division', 'programme -> division', 'row -> active', 'reached programme -> active']) AS link,
    unnest([a, c, b, d, a, g, i]) AS total, unnest([b, c, i, e, i, h, j]) AS kept FROM n)
  SELECT *, round(kept / total::DOUBLE, 6) AS rate FROM l""")
def _(spark, sf):
    p, line, s = t(spark, sf, "part"), t(spark, sf, "lineitem"), t(spark, sf, "supplier")
    programmes = p.select(F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey")).alias("code"))
    certificates = line.where("l_partkey % 7 <> 0").select(F.col("l_partkey").alias("code"), F.col("l_suppkey").alias("occ")).distinct()
    occupations = s.where("s_suppkey % 5 <> 0").select(F.col("s_suppkey").alias("occ"), F.col("s_nationkey").alias("division"))
    status = p.where("p_partkey % 13 <> 0").select(F.col("p_partkey").alias("code"), (F.col("p_size") > 25).alias("actif"))
    final = matching.bridge(programmes, certificates, occupations, status, ["code", "occ"], "code")
    return profile.bridge_coverage(programmes, "code", certificates, occupations, "occ", final, "actif").select("link", "total", "kept", *r6("rate"))


@query("d22_completeness_report", f"""WITH {YEARLY}, y AS (SELECT a.session, a.town, a.level, a.flag, CASE WHEN a.session >= 1998 THEN a.top END AS late, b.key IS NOT NULL AS found FROM yearly a LEFT JOIN yearly b ON b.key = a.key AND b.session = a.session - 1)
  SELECT 'rows' AS measure, session, NULL AS "column", count(*)::DOUBLE AS value FROM y GROUP BY session UNION ALL SELECT 'key_coverage', session, NULL, round(count(town) / count(*)::DOUBLE, 6) FROM y GROUP BY session
  UNION ALL SELECT 'missing_column', session, 'late', 1 FROM y GROUP BY session HAVING count(late) = 0
  UNION ALL SELECT 'null_share', NULL, unnest(['level', 'flag', 'late']), unnest([round(1 - count(level) / count(*)::DOUBLE, 6), round(1 - count(flag) / count(*)::DOUBLE, 6), round(1 - count(late) / count(*)::DOUBLE, 6)]) FROM y
  UNION ALL SELECT 'without_antecedent', NULL, NULL, count(*) FILTER (NOT found) FROM y UNION ALL SELECT 'before_first_label', NULL, NULL, count(*) FILTER (session < 1997) FROM y""")
def _(spark, sf):
    y = yearly(spark, sf).withColumn("late", F.when(F.col("session") >= 1998, F.col("top")))
    before = y.select("key", (F.col("session") + 1).alias("session"), F.lit(True).alias("found"))
    return profile.completeness_report(y.join(before, ["key", "session"], "left"), "session", "town", ["level", "flag", "late"], "found", 1997).select("measure", "session", "column", *r6("value"))


@query("d22_volumes", f"WITH {YEARLY} SELECT session, count(*) AS n, round(avg((town IS NOT NULL)::INT), 6) AS key_coverage FROM yearly GROUP BY 1")
def _(spark, sf):
    return profile.volumes(yearly(spark, sf), "session", "town").select("session", "n", *r6("key_coverage"))


@query("d23_importance", f"WITH {_LINES}, c AS (SELECT l_quantity, {_CONTRIB} FROM lines), u AS (UNPIVOT c ON shap__q, shap__d, shap__t INTO NAME variable VALUE v), i AS (SELECT variable, sum(abs(v) * l_quantity) / sum(l_quantity) AS importance FROM u GROUP BY 1) SELECT variable, round(importance, 6) AS importance, round(importance / sum(importance) OVER (), 6) AS share FROM i")
def _(spark, sf):
    return metrics.importance(contributions(spark, sf), SHAP, "l_quantity").select("variable", *r6("importance", "share"))


@query("d23_named_shares", f"WITH {_LINES}, c AS (SELECT l_quantity, {_CONTRIB} FROM lines), u AS (UNPIVOT c ON shap__q, shap__d, shap__t INTO NAME variable VALUE v), i AS (SELECT variable, sum(abs(v) * l_quantity) AS s FROM u GROUP BY 1) SELECT n AS variable, round(coalesce(max(s) FILTER (variable = n), 0) / sum(s), 6) AS share FROM i, (VALUES ('shap__t'), ('shap__none')) v(n) GROUP BY 1")
def _(spark, sf):
    found = metrics.importance(contributions(spark, sf), SHAP, "l_quantity")
    return metrics.named_shares(found, ["shap__t", "shap__none"]).select("variable", *r6("share"))


@query("d24_extreme_examples", f"WITH {_LINES}, c AS (SELECT l_orderkey, l_linenumber, l_quantity, {_CONTRIB} FROM lines WHERE l_quantity >= 10), b AS (SELECT max((shap__q, l_orderkey, l_linenumber)) AS h, min((shap__q, l_orderkey, l_linenumber)) AS l FROM c) SELECT 'high' AS which, h[2] AS l_orderkey, h[3] AS l_linenumber, round(h[1], 6) AS prediction FROM b UNION ALL SELECT 'low', l[2], l[3], round(l[1], 6) FROM b")
def _(spark, sf):
    return metrics.extreme_examples(contributions(spark, sf), "shap__q", "l_quantity", 10, ["l_orderkey", "l_linenumber"], SHAP).select("which", "l_orderkey", "l_linenumber", *r6("prediction"))


_CAND = f"{RATED}, cand AS (SELECT kind AS name, sum(abs(taux - pred) * effectif) / sum(effectif) AS err, abs(avg(pred - taux)) AS ece, CASE WHEN kind <> '5-LOW' THEN avg(abs(pred - taux)) END AS grp FROM rated WHERE taux IS NOT NULL GROUP BY 1)"


def candidates(spark, sf):
    return rated(spark, sf).where("taux is not null").groupBy(F.col("kind").alias("name")).agg((F.sum(F.abs(F.col("taux") - F.col("pred")) * F.col("effectif")) / F.sum("effectif")).alias("err"), F.abs(F.avg(F.col("pred") - F.col("taux"))).alias("ece"), F.avg(F.abs(F.col("pred") - F.col("taux"))).alias("g")).select("name", "err", "ece", F.when(F.col("name") != "5-LOW", F.col("g")).alias("grp"))


@query("d25_chosen_candidate", f"WITH {_CAND}, a AS (SELECT * FROM cand WHERE err <= (SELECT min(err) FROM cand) + 0.01), b AS (SELECT * FROM a WHERE ece <= (SELECT min(ece) FROM a) + 0.01) SELECT name, round(err, 6) AS err FROM b ORDER BY coalesce(grp, 'inf'::DOUBLE), name LIMIT 1")
def _(spark, sf):
    return metrics.choose_candidate(candidates(spark, sf), "err", "ece", "grp", "name", (0.01, 0.01)).select("name", *r6("err"))


@query("d26_promotion", f"WITH {_CAND} SELECT name, err < grp AND ece < 0.2 AS promoted FROM cand")
def _(spark, sf):
    return candidates(spark, sf).select("name", metrics.promoted("err", "grp", "ece", 0.2).alias("promoted"))


@query("d27_merged_counts", "SELECT event_type, user_id % 10 AS u, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    e = t(spark, sf, "events").select("event_id", "event_type", (F.col("user_id") % 10).alias("u"))
    table = S.VersionedTable(spark, S.scratch(spark, "counts"))
    for batch in (0, 1, 0, 1, 2):  # two come again, and count once
        new = e.where(F.col("event_id") % 3 == batch).groupBy("event_type", "u").agg(F.count(F.lit(1)).alias("n"))
        governance.merge_counts(table, new, ["event_type", "u"], "journal", batch)
    return table.read()


@query("d28_candidate_key", "SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS combinations FROM lineitem")
def _(spark, sf):
    return profile.candidate_key(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("d29_constant_columns", f"WITH {CELLS} SELECT unnest(['num', 'kind', 'one']) AS \"column\", unnest([(SELECT count(DISTINCT num) <= 1 FROM cells), (SELECT count(DISTINCT kind) <= 1 FROM cells), true]) AS constant")
def _(spark, sf):
    return profile.constant_columns(cells(spark, sf).withColumn("one", F.lit(1)), ["num", "kind", "one"])


@query("d30_missing_by_group", "SELECT source, count(*) AS n, round(avg((quality IS NULL)::INT), 6) AS missing FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1 HAVING count(*) >= 20")
def _(spark, sf):
    rows = t(spark, sf, "documents").select("doc_id", "source").join(t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return profile.missing_by_group(rows, "quality", "source", 20).select("source", "n", *r6("missing"))


_RAW = "SELECT *, num / nullif(den, 0) AS r FROM cells"


@query("d31_rate_distribution", f"WITH {CELLS}, x AS ({_RAW}) SELECT kind, count(*) AS n, count(r) AS defined, round(avg((r > 1)::INT), 6) AS over, round(avg((r = 0)::INT), 6) AS zero, round(avg((r = 1)::INT), 6) AS one, round(avg(r), 6) AS mean_raw, round(median(r), 6) AS median, round(avg(CASE WHEN r > 1 THEN 1.0 ELSE r END), 6) AS mean_capped, round(avg(r) FILTER (r <= 1), 6) AS mean_excluded FROM x GROUP BY 1")
def _(spark, sf):
    return profile.rate_distribution(cells(spark, sf), "kind").select("kind", "n", "defined", *r6("over", "zero", "one", "mean_raw", "median", "mean_capped", "mean_excluded"))


@query("d32_threshold_sweep", "SELECT threshold::DOUBLE AS threshold, count(*) FILTER (o_totalprice >= threshold) AS n, round(avg((o_totalprice >= threshold)::INT), 6) AS share FROM orders, (VALUES (100000), (200000), (300000)) v(threshold) GROUP BY 1")
def _(spark, sf):
    return profile.threshold_sweep(t(spark, sf, "orders"), "o_totalprice", [100000, 200000, 300000]).select("threshold", "n", *r6("share"))


@query("d32_definitions", f"""WITH {CELLS}, r AS (SELECT unnest(['num / den', 'num / effectif', 'effectif / den', 'den / num']) AS definition, unnest([CASE WHEN den > 0 THEN num / den END, CASE WHEN effectif > 0 THEN num / effectif END, CASE WHEN den > 0 THEN effectif / den END, CASE WHEN num > 0 THEN den / num END]) AS r FROM cells)
  SELECT definition, count(r) AS n, count(*) FILTER (r > 1) AS over, round(avg((r > 1)::INT), 6) AS share_over, round(avg(r), 6) AS mean, round(median(r), 6) AS median FROM r WHERE r IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    pairs = {f"{a} / {b}": (a, b) for a, b in (("num", "den"), ("num", "effectif"), ("effectif", "den"), ("den", "num"))}
    return profile.definitions(cells(spark, sf), pairs).select("definition", "n", "over", *r6("share_over", "mean", "median"))


@query("d33_paired_gap", f"WITH {RATED}, g AS (SELECT taux - pred AS gap FROM rated WHERE taux IS NOT NULL) SELECT count(*) AS n, round(avg(gap), 6) AS mean, round(quantile_cont(gap, 0.1), 6) AS p10, round(median(gap), 6) AS median, round(quantile_cont(gap, 0.9), 6) AS p90, round(avg((gap > 0)::INT), 6) AS positive, round(avg((abs(gap) <= 0.05)::INT), 6) AS close FROM g")
def _(spark, sf):
    return profile.paired_gap(rated(spark, sf), F.col("taux"), F.col("pred"), 0.05).select("n", *r6("mean", "p10", "median", "p90", "positive", "close"))


@query("d34_quantile_bins", "WITH q AS (SELECT list_distinct(quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8])) AS e FROM customer) SELECT len(list_filter(e, lambda x: x < c_acctbal))::INT AS bin, count(*) AS n, round(median(c_nationkey), 6)::DOUBLE AS median FROM customer, q GROUP BY 1")
def _(spark, sf):
    return profile.quantile_bins(t(spark, sf, "customer"), "c_acctbal", "c_nationkey").select("bin", "n", *r6("median"))


@query("d34_group_medians", "SELECT n_name, count(c_acctbal) AS n, round(median(c_acctbal), 6) AS median FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 HAVING count(c_acctbal) >= 50")
def _(spark, sf):
    rows = t(spark, sf, "customer").join(t(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return profile.group_medians(rows, "c_acctbal", "n_name", 50).select("n_name", "n", *r6("median"))


@query("d35_pooled_rates", f"WITH {CELLS}, x AS ({_RAW}) SELECT session, round(sum(num) FILTER (den > 0) / sum(den) FILTER (den > 0), 6) AS pooled, round(avg(r), 6) AS mean, round(median(r), 6) AS median, round(avg((r = 0)::INT), 6) AS zero, round(avg((r >= 1)::INT), 6) AS \"full\" FROM x GROUP BY 1")
def _(spark, sf):
    return profile.pooled_rates(cells(spark, sf), "session").select("session", *r6("pooled", "mean", "median", "zero", "full"))


@query("d36_presence", f"WITH {YEARLY} SELECT session, unnest(['flag', 'level', 'town']) AS \"column\", unnest([count(flag) > 0, count(level) > 0, count(town) > 0]) AS present FROM yearly GROUP BY 1")
def _(spark, sf):
    return profile.presence(yearly(spark, sf), "session", ["flag", "level", "town"])


@query("d36_mean_series", f"WITH {CELLS} SELECT session, unnest(['num', 'den', 'pred', 'baseline']) AS indicator, unnest([round(avg(num), 6), round(avg(den), 6), round(avg(pred), 6), round(avg(baseline), 6)]) AS mean FROM cells GROUP BY 1")
def _(spark, sf):
    return profile.mean_series(cells(spark, sf), "session", ["num", "den", "pred", "baseline"]).select("session", "indicator", *r6("mean"))


@query("e01_scd2_versions", f"WITH {_SCD} SELECT * FROM dim")
def _(spark, sf):
    return dimension(spark, sf)


@query("e02_surrogate_keys", f"WITH {_SCD} SELECT key, debut, row_number() OVER (ORDER BY key, debut)::INT AS sk_formation FROM dim")
def _(spark, sf):
    return star.numbered(dimension(spark, sf), "sk_formation", ["key", "debut"]).select("key", "debut", "sk_formation")


@query("e03_first_rows", f"WITH {YEARLY}, r AS (SELECT town, level, key, row_number() OVER (PARTITION BY town ORDER BY level NULLS FIRST, key, session) AS rn FROM yearly) SELECT town, level, key FROM r WHERE rn = 1")
def _(spark, sf):
    return star.first_rows(yearly(spark, sf), ["town"], [F.asc_nulls_first("level"), "key", "session"]).select("town", "level", "key")


@query("e04_profile_dimension", "WITH p AS (SELECT DISTINCT o_orderpriority AS type_bac FROM orders) SELECT row_number() OVER (ORDER BY type_bac, boursier) AS sk_profil, type_bac, boursier FROM p, (VALUES (false), (true)) v(boursier)")
def _(spark, sf):
    return star.profile_dimension(t(spark, sf, "orders"), "o_orderpriority")


@query("e05_session_dimension", f"WITH {CELLS} SELECT session, bool_or(session > 1996 AND den > 0) AS label_disponible FROM (SELECT session, coalesce(den, 0) AS den FROM cells) GROUP BY 1")
def _(spark, sf):
    c = cells(spark, sf)
    return star.session_dimension(c, c.where("session > 1996 and den > 0"))


@query("e06_code_labels", "SELECT c_custkey, c_name FROM customer")
def _(spark, sf):
    return star.labels_of(t(spark, sf, "customer"), "c_custkey", "c_name")


_FACT = f"{_SCD}, {CELLS}, num AS (SELECT *, row_number() OVER (ORDER BY key, debut)::INT AS sk_formation FROM dim)"


def fact(spark, sf):
    dim = star.numbered(dimension(spark, sf), "sk_formation", ["key", "debut"])
    return star.fact_table(cells(spark, sf), dim)


@query("e07_fact_table", f"WITH {_FACT} SELECT c.session, c.key, c.kind, c.scholar, sk_formation, effectif, round({RATE}, 6) AS taux, CASE WHEN {RATE} IS NOT NULL THEN den = 0 OR num > den END AS taux_depasse_1 FROM cells c LEFT JOIN num d ON c.key = d.key AND c.session BETWEEN d.debut AND d.fin".replace("num IS NULL", "c.num IS NULL"))
def _(spark, sf):
    return fact(spark, sf).select("session", "key", "kind", "scholar", "sk_formation", "effectif", *r6("taux"), "taux_depasse_1")


@query("e08_feature_table", f"WITH {CELLS}, {_LAG} SELECT c.key, c.session, c.kind, c.scholar, y.level, f.lag__level, f.lag__n, f.antecedent FROM cells c LEFT JOIN yearly y USING (key, session) LEFT JOIN f USING (key, session)")
def _(spark, sf):
    y = yearly(spark, sf)
    rows = features.current_lookup(cells(spark, sf).select("key", "session", "kind", "scholar"), y, ["key", "session"], ["level"])
    return features.lagged_lookup(rows, y, "key", "session", ["level", "n"])


@query("e09_silver", "SELECT year(o_orderdate)::INT AS session, o_orderkey::VARCHAR AS cod, o_custkey AS places, o_orderpriority AS priority, CASE WHEN year(o_orderdate) >= 1997 AND o_custkey % 5 <> 0 THEN (o_custkey % 90) + 0.5 END::DOUBLE AS share FROM orders")
def _(spark, sf):
    from .tables import _vintages

    return reconcile.reconcile(_vintages(spark, sf), ["cod", "url", "places", "priority", "share"], "cod", "url", text=["priority", "url"]).drop("url")
