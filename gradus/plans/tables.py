"""Queries of sources, sinks, reshaping, scalar rules and set operations (A, B, F, G)."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..operators import features, matching, metrics, reconcile, register
from ..sources import tables as S
from .bindings import CELLS, RATE, RATED, UNITS, YEARLY, cells, query, r6, rated, t, units, yearly

ORDERS_TEXT = "SELECT o_orderkey::VARCHAR AS cod, o_orderpriority AS priority, round(o_totalprice, 2)::VARCHAR AS price FROM orders"


FIRST_SHARE = 1997  #: the vintage from which there is one column more


def _vintages(spark, sf):
    """Yearly text files written from orders and read back, one vintage for every year there is."""
    key = F.col("o_orderkey")
    share = F.when(F.col("o_custkey") % 5 != 0, F.concat((F.col("o_custkey") % 90).cast("string"), F.lit(".5")))
    rows = t(spark, sf, "orders").select(
        F.year("o_orderdate").alias("session"), F.when(key % 3 != 0, key.cast("string")).alias("cod"), F.concat(F.lit("https://x/?g_ta_cod="), key.cast("string")).alias("url"),
        F.col("o_orderpriority").alias("priority"), F.col("o_custkey").cast("string").alias("places"), share.alias("share"),
    )
    early = S.write_csv(rows.where(F.col("session") < FIRST_SHARE).drop("share"), S.scratch(spark, "vintage"), partition_by=["session"])
    late = S.write_csv(rows.where(F.col("session") >= FIRST_SHARE), S.scratch(spark, "vintage"), partition_by=["session"])
    years = sorted(r.session for r in rows.select("session").distinct().collect())  # a number a vintage
    return {y: S.read_delimited(spark, f"{early if y < FIRST_SHARE else late}/session={y}", required=["cod"]) for y in years}


_V = """v AS (SELECT year(o_orderdate)::INT AS session, o_orderkey AS k, o_custkey AS places, o_orderpriority AS priority,
  CASE WHEN year(o_orderdate) >= 1997 AND o_custkey % 5 <> 0 THEN (o_custkey % 90) + 0.5 END::DOUBLE AS share FROM orders)"""


@query("a01_read_delimited", f"WITH {_V} SELECT session, count(*) AS n, count(CASE WHEN k % 3 <> 0 THEN 1 END) AS keys FROM v GROUP BY 1")
def _(spark, sf):
    parts = [df.agg(F.lit(y).alias("session"), F.count(F.lit(1)).alias("n"), F.count("cod").alias("keys")) for y, df in _vintages(spark, sf).items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("a02_read_taxonomy", "SELECT p_partkey::VARCHAR AS code, p_name AS label FROM part")
def _(spark, sf):
    path = S.write_csv(t(spark, sf, "part").select(F.col("p_partkey").alias("code"), F.col("p_name").alias("label")), S.scratch(spark, "taxonomy"))
    return S.read_delimited(spark, path, required=["code", "label"])


@query("a03_projected_scan", "SELECT l_suppkey, l_linestatus, l_quantity FROM lineitem WHERE l_quantity > 45")
def _(spark, sf):
    return S.read_columns(spark, f"{sf}/lineitem.parquet", ["l_suppkey", "l_linestatus", "l_quantity"], F.col("l_quantity") > 45)


@query("a04_filtered_scan", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'")
def _(spark, sf):
    return S.read_columns(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey"], F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


@query("a05_file_profile", "SELECT unnest([0, 1, 2, 3, 4])::INT AS position, unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS \"column\", (SELECT count(*) FROM customer) AS n_rows")
def _(spark, sf):
    return S.file_profile(spark, f"{sf}/customer.parquet")


EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("props", T.StructType([T.StructField("k", T.LongType())]))])


def journal_files(spark, sf):
    path = S.scratch(spark, "journal")
    t(spark, sf, "events").select("event_id", "user_id", F.col("event_type").alias("kind"), F.from_json("props", "k long").alias("props")).write.json(path)
    return path


@query("a06_read_journal", "SELECT event_id, user_id, event_type AS kind, (props->>'k')::BIGINT AS k FROM events")
def _(spark, sf):
    return S.read_journal(spark, journal_files(spark, sf), EVENT).select("event_id", "user_id", "kind", F.col("props.k").alias("k"))


@query("a07_read_manifest", "SELECT 's' || s_suppkey AS id, 'https://x/' || s_suppkey AS url, '2026-01-' || lpad((s_nationkey + 1)::VARCHAR, 2, '0') AS date FROM supplier")
def _(spark, sf):
    entry = F.struct(F.concat(F.lit("https://x/"), "s_suppkey").alias("url"), F.format_string("2026-01-%02d", F.col("s_nationkey") + 1).alias("date"))
    entries = t(spark, sf, "supplier").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("s"), "s_suppkey"), entry)))).alias("value"))
    path = S.scratch(spark, "manifest")
    entries.coalesce(1).write.text(path)
    return S.read_manifest(spark, path, T.StructType([T.StructField("url", T.StringType()), T.StructField("date", T.StringType())]))


@query("a08_latest_snapshot", "SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') = (SELECT max(strftime(o_orderdate, '%Y-%m-%d')) FROM orders)")
def _(spark, sf):
    rows = t(spark, sf, "orders").withColumn("file", F.concat(F.lit("export_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv")))
    return S.latest_snapshot(rows, "file").select("o_orderkey")


@query("a09_versioned_table", f"WITH {YEARLY} SELECT session::INT AS session, count(*) AS n, sum(n)::BIGINT AS total FROM yearly GROUP BY 1")
def _(spark, sf):
    table = S.VersionedTable(spark, S.scratch(spark, "silver"))
    table.write(yearly(spark, sf).where("session < 1998"), partition_by=["session"])
    table.write(table.read().unionByName(yearly(spark, sf).where("session >= 1998")), partition_by=["session"])  # made from itself
    return table.read().groupBy("session").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total"))


@query("a10_report_sinks", "SELECT s_suppkey, round(s_acctbal, 2) AS s_acctbal FROM supplier")
def _(spark, sf):
    rows = t(spark, sf, "supplier").select("s_suppkey", F.round("s_acctbal", 2).alias("s_acctbal"))
    path = S.write_version(rows, S.scratch(spark, "report"), form="json")
    return spark.read.schema(rows.schema).json(path)


@query("a11_union_of_vintages", f"WITH {_V} SELECT session, count(*) AS n, count(share) AS shares, sum(places)::BIGINT AS places FROM v GROUP BY 1")
def _(spark, sf):
    rows = reconcile.harmonised(_vintages(spark, sf), ["cod", "url", "places", "share"])
    return rows.groupBy("session").agg(F.count(F.lit(1)).alias("n"), F.count("share").alias("shares"), F.sum(F.col("places").cast("long")).alias("places"))


@query("a12_inferred_types", "SELECT unnest(['cod', 'url', 'priority', 'places', 'share', 'nothing']) AS \"column\", unnest(['bigint', 'string', 'string', 'bigint', 'double', 'double']) AS type")
def _(spark, sf):
    return reconcile.inferred_types(reconcile.harmonised(_vintages(spark, sf), ["cod", "url", "priority", "places", "share", "nothing"]), ["session"])


@query("a13_rebuilt_keys", f"WITH {_V} SELECT session, round(avg(CASE WHEN k % 3 <> 0 THEN 1.0 ELSE 0.0 END), 6) AS before, 1.0::DOUBLE AS after FROM v GROUP BY 1")
def _(spark, sf):
    rows = reconcile.harmonised(_vintages(spark, sf), ["cod", "url"])
    before = reconcile.key_coverage(rows, "cod", "session").select("session", F.round("coverage", 6).alias("before"))
    return before.join(reconcile.key_coverage(rows.withColumn("cod", F.coalesce("cod", reconcile.key_from_url("url"))), "cod", "session").withColumnRenamed("coverage", "after"), "session")


_WIDE = "SELECT o_custkey AS key, year(o_orderdate)::INT AS session, " + ", ".join(f"count(*) FILTER (o_orderpriority = '{p}' AND o_totalprice > 250000) AS n{i}, nullif(count(*) FILTER (o_orderpriority = '{p}'), 0) AS d{i}" for i, p in enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM"))) + " FROM orders GROUP BY ALL"
PAIRS = {f"c{i}": (f"n{i}", f"d{i}") for i in range(3)}


def wide(spark, sf):
    agg = [x for i, p in enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM")) for x in (F.count_if((F.col("o_orderpriority") == p) & (F.col("o_totalprice") > 250000)).alias(f"n{i}"), F.nullif(F.count_if(F.col("o_orderpriority") == p), F.lit(0)).alias(f"d{i}"))]
    return t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("session")).agg(*agg)


@query("a14_wide_to_long", f"WITH w AS ({_WIDE}) " + " UNION ALL ".join(f"SELECT key, session, 'c{i}' AS category, n{i}::DOUBLE AS num, d{i}::DOUBLE AS den FROM w WHERE d{i} > 0" for i in range(3)))
def _(spark, sf):
    return reconcile.unpivot_cells(wide(spark, sf), PAIRS, ["key", "session"])


@query("a15_carried_headers", "WITH r AS (SELECT l_orderkey AS sheet, l_linenumber AS pos, l_linenumber IN (1, 4) AS h, l_linenumber || '-' || (l_orderkey % 3) AS label FROM lineitem), c AS (SELECT *, last_value(CASE WHEN h THEN label END IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY pos) AS section FROM r) SELECT sheet, pos, section FROM c WHERE NOT h AND section IS NOT NULL AND section <> '1-0'")
def _(spark, sf):
    rows = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("sheet"), F.col("l_linenumber").alias("pos"), F.concat_ws("-", "l_linenumber", (F.col("l_orderkey") % 3)).alias("label"))
    return reconcile.carried_header(rows, "sheet", "pos", F.col("pos").isin(1, 4), F.col("label"), "1-0").select("sheet", "pos", "section")


@query("a16_systematic_sample", "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, greatest(count(*) OVER () // 100, 1) AS s FROM orders) SELECT o_orderkey FROM r WHERE i % s = 0 AND i < s * 100")
def _(spark, sf):
    return reconcile.systematic_sample(t(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 100)


@query("a17_stratified_sample", "SELECT year(o_orderdate)::INT AS session, round_even(count(*) * 0.1, 0)::BIGINT AS n FROM orders GROUP BY 1")
def _(spark, sf):
    rows = t(spark, sf, "orders").select(F.year("o_orderdate").alias("session"), "o_orderkey")
    return reconcile.stratified_sample(rows, "session", ["o_orderkey"], 0.1).groupBy("session").agg(F.count(F.lit(1)).alias("n"))


@query("a18_allowed_columns", "SELECT c_custkey, c_mktsegment FROM customer")
def _(spark, sf):
    return S.allowed_columns(t(spark, sf, "customer"), ["c_custkey", "c_name", "c_mktsegment"], deny=["c_name"])[0]


@query("a19_table_difference", "SELECT true AS same_schema, (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 0) AS only_left, 0::BIGINT AS only_right")
def _(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return reconcile.table_difference(o, o.where("o_orderkey % 100 <> 0"))


@query("a20_prediction_catalogue", f"WITH {RATED} SELECT key::VARCHAR AS key, session, segment, pred AS taux_predit FROM rated")
def _(spark, sf):
    return S.prediction_catalogue(rated(spark, sf), {"key": "string", "session": "int"}, ["segment"], "pred")


@query("b01_computable_rows", f"WITH w AS ({_WIDE}) SELECT key, session FROM w WHERE d0 > 0 OR d1 > 0")
def _(spark, sf):
    return wide(spark, sf).where(reconcile.computable({k: PAIRS[k] for k in ("c0", "c1")}, "key")).select("key", "session")


@query("b02_bounded_rate", f"WITH {CELLS}, c AS (SELECT session, key, kind, scholar, num * 2 AS num, den FROM cells) SELECT session, key, kind, scholar, round({RATE}, 6) AS taux, CASE WHEN {RATE} IS NOT NULL THEN den = 0 OR num > den END AS taux_depasse_1 FROM c")
def _(spark, sf):
    c = cells(spark, sf).withColumn("num", F.col("num") * 2)
    return c.select("session", "key", "kind", "scholar", F.round(X.bounded_rate("num", "den"), 6).alias("taux"), X.rate_overflow("num", "den").alias("taux_depasse_1"))


@query("b03_cell_weight", "SELECT o_custkey AS key, count(*)::DOUBLE AS poids FROM orders GROUP BY 1")
def _(spark, sf):
    return t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("n")).select("key", X.cell_weight("n").alias("poids"))


@query("b04_category_names", "SELECT DISTINCT o_orderpriority AS type_bac, o_orderstatus = 'F' AS boursier, o_orderpriority || CASE WHEN o_orderstatus = 'F' THEN '_brs' ELSE '' END AS category FROM orders")
def _(spark, sf):
    names = t(spark, sf, "orders").select(X.category_name("o_orderpriority", F.col("o_orderstatus") == "F").alias("category")).distinct()
    return names.select(X.category_type("category").alias("type_bac"), X.category_is_scholarship("category").alias("boursier"), "category")


@query("b05_department", "SELECT s_suppkey, CASE WHEN length(c) < 2 THEN NULL WHEN left(c, 2) IN ('97', '98') THEN CASE WHEN length(c) >= 3 THEN left(c, 3) END ELSE left(c, 2) END AS departement FROM (SELECT s_suppkey, s_suppkey::VARCHAR AS c FROM supplier)")
def _(spark, sf):
    return t(spark, sf, "supplier").select("s_suppkey", X.department(F.col("s_suppkey").cast("string")).alias("departement"))


@query("b06_division", "SELECT p_partkey, left(p_brand, 2) AS division, CASE WHEN regexp_matches(left(p_partkey::VARCHAR, 2), '^[0-9]{2}$') THEN left(p_partkey::VARCHAR, 2) END AS numeric_division FROM part")
def _(spark, sf):
    return t(spark, sf, "part").select("p_partkey", X.division("p_brand").alias("division"), X.division(F.col("p_partkey").cast("string"), numeric=True).alias("numeric_division"))


_TIER = "CASE code WHEN '00' THEN '0' WHEN '01' THEN '1_9' WHEN '11' THEN '10_49' WHEN '21' THEN '50_249' WHEN '32' THEN '250_plus' WHEN 'NN' THEN 'non_renseignee' END"


@query("b07_workforce_tier", f"WITH {UNITS} SELECT code, {_TIER} AS palier, count(*) AS n FROM units GROUP BY ALL")
def _(spark, sf):
    return units(spark, sf).groupBy("code", X.tier("code", X.WORKFORCE_TIERS).alias("palier")).agg(F.count(F.lit(1)).alias("n"))


@query("b08_age", "SELECT o_orderkey, round(date_diff('day', o_orderdate::DATE, DATE '2002-08-01') / 365.25, 6) AS age FROM orders")
def _(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", F.round(X.age_years("o_orderdate", "2002-08-01"), 6).alias("age"))


@query("b09_switched_filters", f"WITH {UNITS} SELECT state, count(*) AS n FROM units WHERE state = 'O' GROUP BY 1")
def _(spark, sf):
    u = register.filtered(units(spark, sf), state=F.col("state") == "O", employer=None)
    return u.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


_PLAIN = "lower(regexp_replace(strip_accents({}), '[^\\x00-\\x7F]', '', 'g'))"


@query("b10_label_key", f"SELECT doc_id, md5(trim(regexp_replace({_PLAIN.format('text')}, '[^a-z0-9]+', ' ', 'g'))) AS key FROM documents")
def _(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.md5(X.label_key("text")).alias("key"))


@query("b11_header_key", f"SELECT p_partkey, {_PLAIN.format('trim(p_name)')} AS key FROM part")
def _(spark, sf):
    return t(spark, sf, "part").select("p_partkey", X.header_key("p_name").alias("key"))


@query("b12_category_key", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '__manquant__' ELSE trim(regexp_replace(lower(o_orderpriority), '[-_ ]+', ' ', 'g')) || ' ελ ete' END AS key FROM orders")
def _(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", X.category_key(F.when(F.col("o_orderkey") % 5 != 0, F.concat("o_orderpriority", F.lit("_ΈΛ-été")))).alias("key"))


@query("b13_affinity", """WITH a AS (SELECT p_partkey, p_brand = 'Brand#11' AS type_ok, contains(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', ' ', 'g'), 'green') AS word_ok, p_size < 20 AS area_ok FROM part)
SELECT p_partkey, type_ok, word_ok, area_ok, CASE WHEN NOT type_ok OR NOT word_ok THEN 0.0 WHEN NOT area_ok THEN 0.6 ELSE 1.0 END::DOUBLE AS affinite FROM a""")
def _(spark, sf):
    c = matching.affinity(F.lit("Brand#11"), "p_brand", F.lit("Green!"), ["p_name", "p_type"], F.lit("near"), F.when(F.col("p_size") < 20, "near").otherwise("far"))
    return t(spark, sf, "part").withColumns(c).select("p_partkey", "type_ok", "word_ok", "area_ok", "affinite")


@query("b14_clip", "SELECT c_custkey, round(greatest(least(c_acctbal / 5000, 1.0), 0.0)::DOUBLE, 6) AS p FROM customer")
def _(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", F.round(X.clip01(F.col("c_acctbal") / 5000), 6).alias("p"))


@query("b15_rebuilt_prediction", f"WITH {CELLS}, p AS (SELECT coalesce(baseline, pred + 0.4) AS raw FROM cells) SELECT count(*) AS n, count(*) FILTER (raw < 0 OR raw > 1) AS clipped, round(avg(greatest(least(raw, 1.0), 0.0)), 6) AS mean FROM p")
def _(spark, sf):
    raw = F.coalesce("baseline", F.col("pred") + 0.4)
    return cells(spark, sf).select(raw.alias("raw"), X.rebuilt_prediction("baseline", "pred", F.lit(0.4)).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("raw") < 0) | (F.col("raw") > 1)).alias("clipped"), F.round(F.avg("p"), 6).alias("mean"))


@query("b16_recency_weight", "SELECT DISTINCT year(o_orderdate)::INT AS session, round(pow(0.5, (2001 - year(o_orderdate)) / 2.0), 6)::DOUBLE AS w FROM orders")
def _(spark, sf):
    return t(spark, sf, "orders").select(F.year("o_orderdate").alias("session")).distinct().select("session", F.round(X.recency_weight("session", 2001, 2), 6).alias("w"))


@query("b17_composition", f"WITH {CELLS}, c AS (SELECT {RATE} AS s FROM cells) SELECT CASE WHEN s IS NULL THEN 'indetermine' WHEN s < 0.2 THEN 'minoritaire' WHEN s <= 0.8 THEN 'mixte' ELSE 'majoritaire' END AS composition, count(*) AS n FROM c GROUP BY 1")
def _(spark, sf):
    return cells(spark, sf).groupBy(X.composition(X.bounded_rate("num", "den")).alias("composition")).agg(F.count(F.lit(1)).alias("n"))


@query("b18_rate_by_category", f"WITH w AS ({_WIDE}) SELECT key, session, CASE WHEN key % 2 = 0 THEN CASE WHEN d0 > 0 THEN least(n0 / d0::DOUBLE, 1.0) END ELSE CASE WHEN d1 > 0 THEN least(n1 / d1::DOUBLE, 1.0) END END::DOUBLE AS p FROM w")
def _(spark, sf):
    kind = F.when(F.col("key") % 2 == 0, "a").otherwise("b")
    return wide(spark, sf).withColumn("kind", kind).select("key", "session", X.pick_by_category("kind", F.lit(True), {("a", True): PAIRS["c0"], ("b", True): PAIRS["c1"]}).alias("p"))


@query("b19_previous_rate", f"WITH {CELLS} SELECT session, key, kind, scholar, round({RATE}, 6) AS taux_precedent, {RATE} IS NOT NULL AS a_antecedent FROM cells")
def _(spark, sf):
    return features.with_previous_rate(cells(spark, sf), "num", "den").select("session", "key", "kind", "scholar", *r6("taux_precedent"), "a_antecedent")


@query("b20_fallback_prediction", f"WITH {CELLS} SELECT session, key, kind, scholar, coalesce(baseline, pred) AS prediction FROM cells WHERE session IN (2000, 2001)")
def _(spark, sf):
    return features.fallback_prediction(cells(spark, sf), "baseline", "pred", "session", [2000, 2001]).select("session", "key", "kind", "scholar", "prediction")


@query("b21_checked_columns", f"WITH {YEARLY} SELECT key, session, n FROM yearly")
def _(spark, sf):
    return features.checked_columns(yearly(spark, sf).select("key", "session", "n"), {"key", "session", "n", "flag"}, {"lag__n"})


@query("b22_temporal_split", f"WITH {CELLS} SELECT session, count(*) AS n FROM cells WHERE session <= 1998 GROUP BY 1")
def _(spark, sf):
    return features.split(cells(spark, sf), [1995, 1996, 1997, 1998]).groupBy("session").agg(F.count(F.lit(1)).alias("n"))


@query("b23_held_out_guard", f"WITH {CELLS} SELECT count(*) AS n FROM cells WHERE session < 2001")
def _(spark, sf):
    return features.without_sessions(cells(spark, sf).where("session < 2001"), [2001]).agg(F.count(F.lit(1)).alias("n"))


@query("b24_capped_slices", "SELECT n_nationkey, count(c_custkey) AS n, CASE WHEN count(c_custkey) > 60 THEN 'trop_grand' ELSE 'ok' END AS status FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def _(spark, sf):
    c = t(spark, sf, "customer").withColumnRenamed("c_nationkey", "area")
    n = t(spark, sf, "nation").select("n_nationkey", F.col("n_nationkey").alias("area"))
    return matching.capped_slices(n, c, ["area"], "n_nationkey", 60)


@query("b25_code_order", "SELECT code, row_number() OVER (ORDER BY CASE WHEN code = '99' THEN 2 ELSE 0 END, CASE code WHEN '2A' THEN 20.1 WHEN '2B' THEN 20.2 ELSE try_cast(code AS DOUBLE) END, code)::INT AS place FROM (SELECT CASE s_suppkey % 100 WHEN 20 THEN '2A' WHEN 0 THEN '2B' ELSE lpad((s_suppkey % 100)::VARCHAR, 2, '0') END AS code FROM supplier GROUP BY 1)")
def _(spark, sf):
    n = F.col("s_suppkey") % 100
    codes = t(spark, sf, "supplier").select(F.when(n == 20, "2A").when(n == 0, "2B").otherwise(F.lpad(n.cast("string"), 2, "0")).alias("code")).distinct()
    from pyspark.sql import Window

    return codes.select("code", F.row_number().over(Window.orderBy(X.code_order("code"))).alias("place"))


@query("b26_retention_tier", "SELECT CASE WHEN o_orderdate <= TIMESTAMP '2001-01-01' - INTERVAL 1095 DAY THEN 'agreger' WHEN o_orderdate <= TIMESTAMP '2001-01-01' - INTERVAL 365 DAY THEN CASE WHEN o_orderstatus = 'F' THEN 'deja_pseudonymise' ELSE 'pseudonymiser' END ELSE 'conserver' END AS palier, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    tier = X.retention_tier("o_orderdate", "2001-01-01", 365, 1095, F.col("o_orderstatus") == "F")
    return t(spark, sf, "orders").groupBy(tier.alias("palier")).agg(F.count(F.lit(1)).alias("n"))


@query("b27_model_matrix", f"WITH {YEARLY} SELECT key, session, top, 0.0::DOUBLE AS top__absent, coalesce(level, '__manquant__') AS level, coalesce(town, '__manquant__') AS town FROM yearly")
def _(spark, sf):
    return features.model_matrix(yearly(spark, sf), ["top"], ["level", "town"], ["key", "session"])


@query("f01_top_n", f"WITH {RATED}, r AS (SELECT segment, session, key, kind, scholar, pred, row_number() OVER (PARTITION BY segment ORDER BY pred DESC, session, key, kind, scholar)::INT AS rang FROM rated) SELECT * FROM r WHERE rang <= 10")
def _(spark, sf):
    rows = rated(spark, sf).select("segment", "session", "key", "kind", "scholar", "pred")
    return matching.ranked(rows, ["segment"], "pred", ["session", "key", "kind", "scholar"], 10)


@query("f02_sort_nulls_last", f"WITH {CELLS} SELECT key, session, kind, scholar, baseline FROM cells")
def _(spark, sf):
    return cells(spark, sf).select("key", "session", "kind", "scholar", "baseline").orderBy(F.asc_nulls_last("baseline"), "key", "session", "kind", "scholar")


_CONTRIB = "(l_quantity - 25) / 25 AS shap__q, (l_discount - 0.05) * 10 AS shap__d, (l_tax - 0.04) * 8 AS shap__t"
_LINES = "lines AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity, max(l_discount) AS l_discount, max(l_tax) AS l_tax FROM lineitem GROUP BY ALL)"
SHAP = ["shap__q", "shap__d", "shap__t"]


def contributions(spark, sf):
    lines = t(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.max(c).alias(c) for c in ("l_quantity", "l_discount", "l_tax")])
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", ((F.col("l_quantity") - 25) / 25).alias("shap__q"), ((F.col("l_discount") - 0.05) * 10).alias("shap__d"), ((F.col("l_tax") - 0.04) * 8).alias("shap__t"))


@query("f03_top_contributions", f"""WITH {_LINES}, c AS (SELECT l_orderkey, l_linenumber, {_CONTRIB} FROM lines), u AS (UNPIVOT c ON shap__q, shap__d, shap__t INTO NAME variable VALUE v),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY abs(v) DESC, variable)::INT AS rang FROM u) SELECT l_orderkey, l_linenumber, rang, round(abs(v), 6) AS size FROM r WHERE rang <= 2""")
def _(spark, sf):
    rows = contributions(spark, sf).select("l_orderkey", "l_linenumber", F.posexplode(metrics.top_contributions(SHAP, 2)).alias("p", "c"))
    return rows.select("l_orderkey", "l_linenumber", (F.col("p") + 1).alias("rang"), F.round(F.abs("c.value"), 6).alias("size"))


@query("f04_worst_k", f"WITH {CELLS}, m AS (SELECT unnest(['baseline', 'den', 'num', 'pred']) AS \"column\", unnest([avg((baseline IS NULL)::INT), avg((den IS NULL)::INT), avg((num IS NULL)::INT), avg((pred IS NULL)::INT)]) AS missing FROM cells) SELECT \"column\", round(missing, 6) AS missing FROM m ORDER BY missing DESC, 1 LIMIT 2")
def _(spark, sf):
    from ..operators import profile

    return profile.worst(profile.missing_shares(cells(spark, sf), ["num", "den", "pred", "baseline"]), "missing", "column", 2).select("column", *r6("missing"))


@query("g01_union_all", "SELECT c_name AS name FROM customer UNION ALL SELECT p_name FROM part")
def _(spark, sf):
    return reduce(lambda a, b: a.unionByName(b), [t(spark, sf, "customer").select(F.col("c_name").alias("name")), t(spark, sf, "part").select(F.col("p_name").alias("name"))])


@query("g02_intersect_difference", "SELECT 'both' AS side, count(*) AS n FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'only_customers', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)")
def _(spark, sf):
    c, s, o = (t(spark, sf, x) for x in ("customer", "supplier", "orders"))
    both = c.select("c_nationkey").intersect(s.select("s_nationkey")).agg(F.lit("both").alias("side"), F.count(F.lit(1)).alias("n"))
    return both.unionByName(c.select("c_custkey").subtract(o.select("o_custkey")).agg(F.lit("only_customers").alias("side"), F.count(F.lit(1)).alias("n")))


@query("g03_distinct", "SELECT DISTINCT p_brand, p_size FROM part")
def _(spark, sf):
    return t(spark, sf, "part").select("p_brand", "p_size").dropDuplicates()
