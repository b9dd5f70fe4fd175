"""Queries of quality rules, retrieval, journals, streams and model fitting (H, I, J, K)."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..operators import governance, learning, matching, quality, reconcile, retrieval
from ..sources import tables as S
from ..streaming import journals
from .bindings import CELLS, RATED, cells, query, r6, rated, t
from .tables import EVENT, journal_files

B, W = quality.BLOCKING, quality.WARNING


def _lines(spark, sf):
    return t(spark, sf, "lineitem")


def _line_rules():
    return {
        "domain_status": ("domain", B, quality.outside("l_linestatus", ["O"])),
        "pattern_flag": ("pattern", W, quality.pattern("l_returnflag", "^[AR]$")),
        "negative": ("sign", B, quality.negative("l_quantity", "l_discount")),
    }


_H01 = "SELECT 'lineitem' AS source, unnest(['domain_status', 'pattern_flag', 'negative']) AS rule, unnest(['domain', 'pattern', 'sign']) AS family, unnest(['bloquant', 'avertissement', 'bloquant']) AS severity, unnest([count(*) FILTER (l_linestatus <> 'O'), count(*) FILTER (l_returnflag NOT IN ('A', 'R')), count(*) FILTER (l_quantity < 0 OR l_discount < 0)]) AS violations, count(*) AS n FROM lineitem"


@query("h01_findings", f"WITH f AS ({_H01}) SELECT * FROM f WHERE violations > 0")
def _(spark, sf):
    return quality.findings(quality.rule_counts(_lines(spark, sf), "lineitem", _line_rules()))


@query("h01_blocking_gate", f"WITH f AS ({_H01}) SELECT count(*) AS n_findings, count(*) FILTER (severity = 'bloquant') > 0 AS blocked FROM f WHERE violations > 0")
def _(spark, sf):
    return quality.blocking(quality.findings(quality.rule_counts(_lines(spark, sf), "lineitem", _line_rules())))


@query("h02_required_columns", "SELECT 'c_phone' AS missing, count(*) AS n FROM customer")
def _(spark, sf):
    c = t(spark, sf, "customer")
    missing = quality.required_columns(c, {"c_custkey": 2018, "c_phone": 2019, "c_later": 2030}, 2020)
    return c.agg(F.lit(", ".join(missing)).alias("missing"), F.count(F.lit(1)).alias("n"))


@query("h03_pattern_rules", "SELECT unnest(['brand', 'name']) AS rule, unnest([count(*) FILTER (NOT regexp_matches(p_brand, '^Brand#[1-3]')), count(*) FILTER (NOT regexp_matches(p_name, '^[a-m]'))]) AS violations FROM part")
def _(spark, sf):
    rules = {"brand": ("pattern", B, quality.pattern("p_brand", "^Brand#[1-3]")), "name": ("pattern", W, quality.pattern("p_name", "^[a-m]"))}
    return quality.rule_counts(t(spark, sf, "part"), "part", rules).select("rule", "violations")


@query("h04_completeness", f"WITH {CELLS}, f AS (SELECT unnest(['den', 'pred']) AS \"column\", unnest([avg((den IS NOT NULL)::INT), avg((pred IS NOT NULL)::INT)]) AS filled FROM cells) SELECT \"column\", round(filled, 6) AS filled, filled < 0.99 AS too_low FROM f")
def _(spark, sf):
    return quality.completeness(cells(spark, sf), ["den", "pred"]).select("column", *r6("filled"), "too_low")


@query("h05_bimodal", "SELECT source, round(avg((quality IS NOT NULL)::INT), 6) AS filled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1 HAVING avg((quality IS NOT NULL)::INT) NOT IN (0, 1)")
def _(spark, sf):
    rows = t(spark, sf, "documents").select("doc_id", "source").join(t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return quality.bimodal(rows, "quality", "source").select("source", *r6("filled"))


_SUM = "SELECT o_custkey AS key, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY 1"


@query("h06_sum_identity", f"WITH s AS ({_SUM}) SELECT count(*) FILTER (total <> f + o) AS violations, max(abs(total - f - o)) AS largest FROM s")
def _(spark, sf):
    is_ = lambda s: F.count_if(F.col("o_orderstatus") == s)
    s = t(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total"), is_("F").alias("f"), is_("O").alias("o"))
    return s.agg(F.count_if(quality.sum_differs("total", ["f", "o"])).alias("violations"), F.max(F.abs(F.col("total") - F.col("f") - F.col("o"))).alias("largest"))


@query("h07_non_negative", "SELECT count(*) FILTER (c_acctbal < 0) AS violations FROM customer")
def _(spark, sf):
    return t(spark, sf, "customer").agg(F.count_if(quality.negative("c_acctbal")).alias("violations"))


@query("h08_percentages", f"WITH {CELLS} SELECT count(*) FILTER (abs(pred * 100 - num / nullif(den, 0) * 100) > 0.500001) AS violations FROM cells")
def _(spark, sf):
    return cells(spark, sf).agg(F.count_if(quality.percentage_differs(F.col("pred") * 100, "num", "den")).alias("violations"))


@query("h09_domains", "SELECT count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS violations FROM orders")
def _(spark, sf):
    return t(spark, sf, "orders").agg(F.count_if(quality.outside("o_orderpriority", ["1-URGENT", "2-HIGH"])).alias("violations"))


@query("h10_conditional_pattern", "SELECT count(*) FILTER (l_linestatus = 'O' AND l_returnflag <> 'N') AS violations FROM lineitem")
def _(spark, sf):
    return _lines(spark, sf).agg(F.count_if((F.col("l_linestatus") == "O") & quality.pattern("l_returnflag", "^N$")).alias("violations"))


@query("h11_future_dates", "SELECT count(*) FILTER (o_orderdate::DATE > DATE '1996-01-01' AND o_orderdate::DATE <= DATE '2001-01-01') AS near, count(*) FILTER (o_orderdate::DATE > DATE '2001-01-01') AS far FROM orders")
def _(spark, sf):
    return t(spark, sf, "orders").agg(F.count_if(quality.dated_after("o_orderdate", "1996-01-01", (0, 5))).alias("near"), F.count_if(quality.dated_after("o_orderdate", "1996-01-01", (5, None))).alias("far"))


@query("h12_date_format", "SELECT count(*) FILTER (o_custkey % 7 = 0) AS violations FROM orders")
def _(spark, sf):
    day = F.when(F.col("o_custkey") % 7 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_custkey") % 7 == 1, "").otherwise(F.date_format("o_orderdate", "d/M/yyyy"))
    return t(spark, sf, "orders").select(day.alias("day")).agg(F.count_if(quality.bad_date("day")).alias("violations"))


@query("h13_freshness", "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'manquante' WHEN o_orderkey % 11 = 1 THEN 'illisible' WHEN o_orderdate > TIMESTAMP '2000-01-01' THEN 'future' WHEN o_orderdate < TIMESTAMP '2000-01-01' - INTERVAL 365 DAY THEN 'perimee' ELSE 'ok' END AS status FROM orders")
def _(spark, sf):
    date = F.when(F.col("o_orderkey") % 11 == 0, None).when(F.col("o_orderkey") % 11 == 1, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return quality.freshness(t(spark, sf, "orders").withColumn("date", date), "date", "2000-01-01", 365).select("o_orderkey", "status")


@query("h14_grain", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, sf):
    return reconcile.duplicate_keys(_lines(spark, sf), ["l_orderkey", "l_linenumber"])


@query("h15_declared_tests", "SELECT 'not_null_c_name' AS test, count(*) FILTER (c_name IS NULL) AS failures FROM customer UNION ALL SELECT 'accepted_c_mktsegment', count(*) FILTER (c_mktsegment NOT IN ('BUILDING')) FROM customer UNION ALL SELECT 'unique_c_nationkey', count(*) FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1)")
def _(spark, sf):
    return quality.declared(t(spark, sf, "customer"), unique=["c_nationkey"], not_null=["c_name"], accepted={"c_mktsegment": ["BUILDING"]})


@query("h16_label_contract", f"WITH {RATED} SELECT count(*) FILTER (taux NOT BETWEEN 0 AND 1) AS out_of_range, count(*) FILTER (effectif IS NULL) AS no_weight, count(*) FILTER (effectif <= 1) AS low_weight FROM rated")
def _(spark, sf):
    return rated(spark, sf).agg(F.count_if(~F.col("taux").between(0, 1)).alias("out_of_range"), F.count_if(F.col("effectif").isNull()).alias("no_weight"), F.count_if(F.col("effectif") <= 1).alias("low_weight"))


@query("h17_personal_data", r"""SELECT 'email' AS rule, count(*) FILTER (regexp_matches(text, '[\w.+-]+@[\w-]+\.[A-Za-z]{2,}')) AS violations FROM documents
UNION ALL SELECT 'phone', count(*) FILTER (regexp_matches(text, '(^|[^\d])(\+33|0)\s?[1-9]([\s.-]?\d{2}){4}([^\d]|$)')) FROM documents
UNION ALL SELECT 'national_id', count(*) FILTER (regexp_matches(text, '(^|[^\d])[12]\d{2}(0[1-9]|1[0-2])\d{2}\d{3}\d{3}(\s?\d{2})?([^\d]|$)')) FROM documents
UNION ALL SELECT 'bank_account', count(*) FILTER (regexp_matches(text, '\bFR\d{2}[\sA-Z0-9]{11,}\b')) FROM documents""")
def _(spark, sf):
    return quality.personal_data(t(spark, sf, "documents"), "text").select("rule", "violations")


@query("i01_documents", "SELECT 'ideo:parts:' || p_partkey AS id, concat_ws(' — ', trim(p_name), nullif(CASE WHEN p_size % 2 = 0 THEN p_brand ELSE ' ' END, ' '), trim(p_type)) AS text, CASE WHEN p_size % 3 = 0 THEN 'https://x/' || p_partkey ELSE 'https://x' END AS url FROM part")
def _(spark, sf):
    rows = t(spark, sf, "part").withColumn("brand", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(" "))
    return retrieval.documents(rows, F.lit("parts"), "p_partkey", ["p_name", "brand", "p_type"], F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("https://x/"), F.col("p_partkey"))), "https://x")


_STOP = ", ".join(f"'{w}'" for w in retrieval.STOP_WORDS)
_TOK = "list_filter(string_split_regex(strip_accents(lower({})), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: length(x) >= 2 AND x NOT IN (" + _STOP + "))"


def _terms(source, key, text):
    return f"(SELECT {key} AS k, unnest(list_concat(w, CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END)) AS term FROM (SELECT {key}, {_TOK.format(text)} AS w FROM {source}))"


_TF = f"tf AS (SELECT k, term, count(*) AS tf FROM {_terms('documents', 'doc_id', 'text')} GROUP BY ALL), idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM tf GROUP BY 1)"


_indexes: dict = {}


def index(spark, sf):
    """The documents' index, made once a session and table."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _indexes:
        _indexes[key] = retrieval.SearchIndex(spark, S.scratch(spark, "index"))
        _indexes[key].add(t(spark, sf, "documents"), "doc_id", "text")
    return _indexes[key]


@query("i02_tfidf_index", f"WITH {_TF}, w AS (SELECT k, term, tf * idf AS w FROM tf JOIN idf USING (term)) SELECT k AS doc_id, count(*) AS terms, round(max(w) / sqrt(sum(w * w)), 6) AS largest FROM w GROUP BY 1")
def _(spark, sf):
    rows = index(spark, sf).lengths().where("terms is not null")
    return rows.select(F.col("doc").alias("doc_id"), "terms", F.round(F.col("heaviest") / F.col("length"), 6).alias("largest"))


_SEARCH = f"""{_TF}, q0 AS (SELECT k, term, count(*) AS tf FROM {_terms('benchmark', 'item_id', 'text')} GROUP BY ALL), d AS (SELECT k, term, tf * idf AS w FROM tf JOIN idf USING (term)), q AS (SELECT k, term, tf * idf AS w FROM q0 JOIN idf USING (term)),
dn AS (SELECT k, sqrt(sum(w * w)) AS n FROM d GROUP BY 1), qn AS (SELECT k, sqrt(sum(w * w)) AS n FROM q GROUP BY 1),
s AS (SELECT q.k AS item_id, d.k AS doc_id, sum(q.w * d.w) / any_value(qn.n) / any_value(dn.n) AS score FROM d JOIN q USING (term) JOIN dn ON dn.k = d.k JOIN qn ON qn.k = q.k GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id)::INT AS rang FROM s WHERE score > 0 AND score >= 0.05)"""


def found(spark, sf):
    return index(spark, sf).search(t(spark, sf, "benchmark"), "item_id", least=0.05).withColumnRenamed("doc", "doc_id")


@query("i03_search", f"WITH {_SEARCH} SELECT item_id, doc_id, round(score, 6) AS score, rang FROM r WHERE rang <= 5")
def _(spark, sf):
    return found(spark, sf).select("item_id", "doc_id", *r6("score"), "rang")


@query("i04_citations", f"WITH {_SEARCH} SELECT item_id, string_agg('[' || rang || '] ' || text || ' (doc/' || doc_id || ')', chr(10) ORDER BY rang) AS extrait FROM r JOIN documents USING (doc_id) WHERE rang <= 5 GROUP BY 1")
def _(spark, sf):
    docs = t(spark, sf, "documents").select("doc_id", "text")
    return retrieval.citations(found(spark, sf), docs, "doc_id", "item_id", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")))


def journal(spark, sf):
    return t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("who"), F.col("o_orderdate").alias("ts"), (F.col("o_orderstatus") == "F").alias("done"), F.col("o_orderpriority").alias("kind"))


_TIER = "CASE WHEN o_orderdate <= TIMESTAMP '2001-01-01' - INTERVAL 1095 DAY THEN 'agreger' WHEN o_orderdate <= TIMESTAMP '2001-01-01' - INTERVAL 365 DAY THEN CASE WHEN o_orderstatus = 'F' THEN 'deja_pseudonymise' ELSE 'pseudonymiser' END ELSE 'conserver' END"


def purged(spark, sf):
    """The journal and the counts after a pass, and a second one that must change nothing."""
    journal_table, counts = (S.VersionedTable(spark, S.scratch(spark, n)) for n in ("journal", "counts"))
    journal_table.write(journal(spark, sf).withColumn("before", F.col("who")))
    for _ in "ab":
        governance.purge(journal_table, counts, "ts", "2001-01-01", "who", "done", {"kind": "inconnu"}, dry_run=False)
    return journal_table.read(), counts.read()


@query("i05_retention", f"WITH x AS (SELECT o_orderstatus, o_custkey, {_TIER} AS palier FROM orders) SELECT count(*) AS kept, count(*) FILTER (o_orderstatus = 'F' OR palier = 'pseudonymiser') AS done, count(*) FILTER (palier <> 'pseudonymiser') AS unchanged FROM x WHERE palier <> 'agreger'")
def _(spark, sf):
    return purged(spark, sf)[0].agg(F.count(F.lit(1)).alias("kept"), F.count_if("done").alias("done"), F.count_if(F.col("who") == F.col("before").cast("string")).alias("unchanged"))


@query("i05_retained_counts", f"WITH x AS (SELECT o_orderpriority AS kind, {_TIER} AS palier FROM orders) SELECT kind, count(*) AS n FROM x WHERE palier = 'agreger' GROUP BY 1")
def _(spark, sf):
    return purged(spark, sf)[1]


@query("i05_retention_report", f"SELECT {_TIER} AS palier, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return governance.retention_report(governance.tiered(journal(spark, sf), "ts", "2001-01-01", done="done"))


@query("i06_subject_access", "SELECT event_id::VARCHAR AS event_id, event_type AS kind, '{\"k\":' || (props->>'k') || '}' AS props, user_id::VARCHAR AS user_id FROM events WHERE user_id % 50 = 7")
def _(spark, sf):
    records = S.read_journal(spark, journal_files(spark, sf), EVENT)
    wanted = t(spark, sf, "events").where("user_id % 50 = 7").select("user_id")
    return governance.exported(matching.any_identifier(records.withColumn("props", F.to_json("props")), ["user_id"], wanted.withColumnRenamed("user_id", "w"), "w"))


@query("i07_erasure", "SELECT count(*) FILTER (user_id % 50 <> 7) AS left_over, count(*) FILTER (user_id % 50 = 7) AS effaces, count(*) AS avant FROM events")
def _(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id")
    table = S.VersionedTable(spark, S.scratch(spark, "erased"))
    table.write(e)
    trace = governance.erase(table, ["user_id"], e.where("user_id % 50 = 7").select(F.col("user_id").alias("w")), "w", S.scratch(spark, "trace"), dry_run=False)
    return table.read().agg(F.count(F.lit(1)).alias("left_over")).crossJoin(trace)  # one row each


@query("i08_deadlines", "SELECT o_orderkey, round_even(date_diff('second', TIMESTAMP '1998-01-01', o_orderdate + INTERVAL 72 HOUR) / 3600.0::DOUBLE, 1) AS heures FROM orders")
def _(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", X.hours_left("o_orderdate", "1998-01-01").alias("heures"))


@query("i09_attribution", "SELECT source, count(*) AS n, min(lang) AS premiere, max(lang) AS derniere, min(lang) AS licence FROM documents GROUP BY 1")
def _(spark, sf):
    d = t(spark, sf, "documents").select(F.concat("source", F.lit(":"), F.col("doc_id").cast("string")).alias("entry"), "lang", F.col("lang").alias("licence"))
    return governance.attribution(d, "entry", "lang", "licence")


@query("j01_journal_ingestion", "SELECT event_id, user_id, event_type AS kind FROM events")
def _(spark, sf):
    target = S.scratch(spark, "ingested")
    journals.ingest(spark, journal_files(spark, sf), EVENT, target, S.scratch(spark, "checkpoint"))
    return spark.read.parquet(target).select("event_id", "user_id", "kind")


@query("j02_attempts", "SELECT event_id, count(*) OVER (PARTITION BY user_id % 20 ORDER BY epoch_us(ts) RANGE BETWEEN 21600000000 PRECEDING AND CURRENT ROW) AS attempts FROM events")
def _(spark, sf):
    e = t(spark, sf, "events").withColumn("who", F.col("user_id") % 20)
    return journals.attempts(e, "who", "ts", 21_600).select("event_id", "attempts")


@query("j02_rate_limit")
def _(spark, sf):
    e = t(spark, sf, "events").withColumn("who", F.col("user_id") % 20)
    return journals.limited(e, "who", "event_id", "ts", 2, 21_600)


TIMED = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("who", T.LongType()), T.StructField("ts", T.TimestampType())])


@query("j02_streamed_limit")
def _(spark, sf):
    """The journal arrives in two parts, each decided by a run of its own over one checkpoint."""
    e = t(spark, sf, "events").select("event_id", (F.col("user_id") % 20).alias("who"), F.col("ts").cast("timestamp").alias("ts"))
    source, target, checkpoint = (S.scratch(spark, n) for n in ("arrived", "decided", "checkpoint"))
    middle = e.agg(F.timestamp_seconds((F.min(F.unix_timestamp("ts")) + F.max(F.unix_timestamp("ts"))) / 2).alias("middle"))
    for early in (True, False):
        e.crossJoin(F.broadcast(middle)).where((F.col("ts") < F.col("middle")) == early).drop("middle").write.mode("append").json(source)  # one row
        journals.limit_journal(spark, source, TIMED, "who", "event_id", "ts", 2, 21_600, target, checkpoint)
    return spark.read.schema("event_id long, accepted boolean").parquet(target)


ENTRY = T.StructType([T.StructField("decision", T.StringType()), T.StructField("entrees", T.StructType([T.StructField("session", T.LongType()), T.StructField("type_bac", T.StringType()), T.StructField("boursier", T.BooleanType())]))])
COUNTED = {"session": "inconnue", "type_bac": "inconnu", "boursier": "inconnu", "decision": "inconnue"}
_DECISION = "CASE WHEN o_custkey % 9 <> 0 THEN CASE WHEN o_totalprice > 250000 THEN 'suivi' ELSE 'ecarte' END END"


def decisions(spark, sf):
    """Supervised decisions with their nested inputs; some lack a decision, some a type."""
    inputs = F.struct(F.year("o_orderdate").alias("session"), F.when(F.col("o_custkey") % 11 != 0, F.col("o_orderpriority")).alias("type_bac"), (F.col("o_orderstatus") == "F").alias("boursier"))
    return t(spark, sf, "orders").select(F.expr(_DECISION).alias("decision"), inputs.alias("entrees"), F.col("o_orderkey").alias("id"))


@query("j03_running_counts", f"SELECT year(o_orderdate)::VARCHAR AS session, CASE WHEN o_custkey % 11 <> 0 THEN o_orderpriority ELSE 'inconnu' END AS type_bac, (o_orderstatus = 'F')::VARCHAR AS boursier, coalesce({_DECISION}, 'inconnue') AS decision, count(*) AS n FROM orders GROUP BY ALL")
def _(spark, sf):
    source, checkpoint, table = S.scratch(spark, "decisions"), S.scratch(spark, "checkpoint"), S.VersionedTable(spark, S.scratch(spark, "counts"))
    for part in (0, 1):  # two arrivals, two runs
        decisions(spark, sf).where(F.col("id") % 2 == part).drop("id").write.mode("append").json(source)
        journals.running_counts(spark, source, ENTRY, COUNTED, table, checkpoint, lambda df: df.select("decision", "entrees.*"))
    return table.read()


NUMERIC, CATEGORIES = ["effectif", "previous"], ["kind", "segment", "scholar"]


def learning_rows(spark, sf):
    """Cells with a rate, in training, validation and test years; what is known beforehand is the customer's rate of the year before."""
    rows = rated(spark, sf).select("session", F.col("key").cast("long").alias("key"), "kind", "scholar", "segment", "effectif", "pred", "taux")
    before = Window.partitionBy("key").orderBy("session").rangeBetween(-1, -1)
    rows = rows.withColumn("previous", F.avg("taux").over(before)).where("taux is not null")
    path = S.scratch(spark, "learning")
    rows.write.parquet(path)  # once for all fits and passes
    rows = spark.read.schema(rows.schema).parquet(path)
    return [rows.where(c) for c in ("session <= 1998", "session in (1999, 2000)", "session = 2001")]


@query("k01_boosted_trees")
def _(spark, sf):
    train, val, test = learning_rows(spark, sf)
    return learning.predict(learning.fit_boosted(train, val, NUMERIC, CATEGORIES, "taux", "effectif"), test, NUMERIC, CATEGORIES, ["key", "kind", "scholar"])


@query("k02_isotonic")
def _(spark, sf):
    train, _, test = learning_rows(spark, sf)
    return learning.calibrate(learning.fit_isotonic(train, "pred", "taux", "effectif"), test.select("key", "kind", "scholar", "pred"), "pred", "calibrated")


@query("k03_out_of_fold")
def _(spark, sf):
    train, _, _ = learning_rows(spark, sf)
    return learning.calibrated_out_of_fold(train.select("key", "session", "kind", "scholar", "pred", "taux", "effectif"), "pred", "taux", "effectif", "key")


@query("k04_grid")
def _(spark, sf):
    train, val, _ = learning_rows(spark, sf)
    return learning.best_of(learning.grid(train, val, NUMERIC, CATEGORIES, "taux", "effectif", "session", "key", "segment", "pred", 1998))


@query("k05_refit")
def _(spark, sf):
    train, val, test = learning_rows(spark, sf)
    return learning.refit(train, val, test, NUMERIC, CATEGORIES, "taux", "effectif", ["key", "kind", "scholar"])


@query("k06_ablation")
def _(spark, sf):
    train, val, test = learning_rows(spark, sf)
    return learning.ablation(train, val, test, NUMERIC, CATEGORIES, "taux", "effectif", {"without_segment": ["segment"], "without_kind": ["kind"], "without_previous": ["previous"], "without_size": ["effectif"], "only_previous": ["effectif", *CATEGORIES], "only_categories": NUMERIC})


@query("k07_learning_curve")
def _(spark, sf):
    train, val, test = learning_rows(spark, sf)
    return learning.learning_curve(train, val, test, NUMERIC, CATEGORIES, "taux", "effectif", "session", ["key", "kind", "scholar"])


@query("k08_batch_prediction")
def _(spark, sf):
    train, val, test = learning_rows(spark, sf)
    model = learning.fit_boosted(train, val, NUMERIC, CATEGORIES, "taux", "effectif")
    return learning.predict(model, train.unionByName(val).unionByName(test), NUMERIC, CATEGORIES, ["session", "key", "kind", "scholar"])
