"""The operators' roles bound to the given tables, once for Spark and once as SQL text, and the registry of queries."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import bounded_rate

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def t(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(*columns):
    return [F.round(c, 6).alias(c) for c in columns]


def cells(spark, sf: str) -> DataFrame:
    """A cell: customer and year by order priority and status. Denominators of 0 and null are built in."""
    o = t(spark, sf, "orders").select(F.year("o_orderdate").alias("session"), F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("kind"), (F.col("o_orderstatus") == "F").alias("scholar"), "o_totalprice")
    c = o.groupBy("session", "key", "kind", "scholar").agg(F.count_if(F.col("o_totalprice") > 250000).cast("double").alias("num"), F.count(F.lit(1)).cast("double").alias("effectif"))
    c = c.withColumn("den", F.when(F.col("key") % 17 == 0, 0.0).when(F.col("key") % 19 != 0, F.col("effectif")))
    return c.withColumn("pred", (F.col("key") * 37 % 1000) / F.lit(1000.0)).withColumn("baseline", F.when(F.col("key") % 7 != 0, (F.col("key") * 53 % 1000) / F.lit(1000.0)))


CELLS = """cells AS (SELECT session, key, kind, scholar, num, effectif, CASE WHEN key % 17 = 0 THEN 0.0 WHEN key % 19 <> 0 THEN effectif END AS den,
  (key * 37 % 1000) / 1000::DOUBLE AS pred, CASE WHEN key % 7 <> 0 THEN (key * 53 % 1000) / 1000::DOUBLE END AS baseline
  FROM (SELECT year(o_orderdate)::INT AS session, o_custkey AS key, o_orderpriority AS kind, o_orderstatus = 'F' AS scholar,
    (count(*) FILTER (o_totalprice > 250000))::DOUBLE AS num, count(*)::DOUBLE AS effectif FROM orders GROUP BY ALL))"""
RATE = "CASE WHEN num IS NULL OR den IS NULL THEN NULL WHEN den = 0 THEN CASE WHEN num > 0 THEN 1.0::DOUBLE END ELSE least(num / den, 1.0::DOUBLE) END"


def rated(spark, sf: str) -> DataFrame:
    """Cells with the observed rate and the customer's segment."""
    seg = t(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    return cells(spark, sf).withColumn("taux", bounded_rate("num", "den")).join(seg, "key")


RATED = f"{CELLS}, rated AS (SELECT cells.*, {RATE} AS taux, c_mktsegment AS segment FROM cells JOIN customer ON key = c_custkey)"


def yearly(spark, sf: str) -> DataFrame:
    """Per customer and year: attributes to track, a town that may be null."""
    o = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("session")).agg(F.bool_or(F.col("o_orderstatus") == "F").alias("flag"), F.max(F.col("o_totalprice")).alias("top"), F.count(F.lit(1)).alias("n"))
    return o.withColumn("town", F.when(F.col("key") % 11 != 0, F.concat(F.lit("t"), (F.col("key") % 50).cast("string")))).withColumn("level", F.when(F.col("top") > 350000, "high").when(F.col("top") > 50000, "mid"))


YEARLY = """yearly AS (SELECT *, CASE WHEN key % 11 <> 0 THEN 't' || (key % 50)::VARCHAR END AS town, CASE WHEN top > 350000 THEN 'high' WHEN top > 50000 THEN 'mid' END AS level
  FROM (SELECT o_custkey AS key, year(o_orderdate)::INT AS session, bool_or(o_orderstatus = 'F') AS flag, max(o_totalprice) AS top, count(*) AS n FROM orders GROUP BY ALL))"""


def units(spark, sf: str) -> DataFrame:
    """Establishments from order lines: state, employer, workforce code, creation date, town, activity."""
    codes = F.array(*[F.lit(c) for c in ("00", "01", "11", "21", "32", "NN", "zz")])
    line = t(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity", "l_shipdate")
    return line.select(
        F.when(F.col("l_suppkey") % 13 != 0, F.lpad(F.col("l_suppkey").cast("string"), 5, "9")).alias("town"), F.lpad((F.col("l_linenumber") * 7).cast("string"), 4, "0").alias("activity"),
        F.col("l_linestatus").alias("state"), (F.col("l_returnflag") != "N").alias("employer"), codes[F.col("l_quantity").cast("int") % 7].alias("code"), F.col("l_shipdate").cast("date").alias("created"),
    )


UNITS = """units AS (SELECT CASE WHEN l_suppkey % 13 <> 0 THEN lpad(left(l_suppkey::VARCHAR, 5), 5, '9') END AS town, lpad((l_linenumber * 7)::VARCHAR, 4, '0') AS activity, l_linestatus AS state,
  l_returnflag <> 'N' AS employer, (['00', '01', '11', '21', '32', 'NN', 'zz'])[l_quantity::INT % 7 + 1] AS code, l_shipdate::DATE AS created FROM lineitem)"""
