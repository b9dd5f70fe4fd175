"""Star schema: SCD2 dimension, small dimensions, interval and null-safe lookups, guarded joins, the fact table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import bounded_rate, rate_overflow
from .reconcile import placed


def versions(df: DataFrame, key: str, session: str, tracked: Sequence[str]) -> DataFrame:
    """Consecutive observed sessions with equal tracked values (null equals null) as one row: key, tracked, start, end."""
    by = Window.partitionBy(key).orderBy(session)
    now = F.struct(*tracked)
    new = F.when(F.lag(session).over(by).isNull() | ~now.eqNullSafe(F.lag(now).over(by)), 1).otherwise(0)
    runs = df.select(key, session, *tracked).withColumn("_new", new).withColumn("version", F.sum("_new").over(by))
    return runs.groupBy(key, "version").agg(*[F.min_by(c, session).alias(c) for c in tracked], F.min(session).alias("debut"), F.max(session).alias("fin"))


def numbered(dim: DataFrame, name: str, order: Sequence) -> DataFrame:
    """Dense surrogate key 1 ... n in a stated order, by ranges: a dimension of versions grows with the register."""
    return placed(dim, order, name).withColumn(name, (F.col(name) + 1).cast("int"))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key in a stated order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def profile_dimension(df: DataFrame, kind: str) -> DataFrame:
    """Every type of df with and without scholarship, numbered in order."""
    kinds = df.select(F.col(kind).alias("type_bac")).distinct().select("type_bac", F.explode(F.array(F.lit(False), F.lit(True))).alias("boursier"))
    return placed(kinds, ["type_bac", "boursier"], "sk_profil").select((F.col("sk_profil") + 1).alias("sk_profil"), "type_bac", "boursier")


def session_dimension(silver: DataFrame, base: DataFrame, session: str = "session") -> DataFrame:
    """Sessions, and whether any of their rows can carry a label."""
    seen = base.select(session).distinct().withColumn("label_disponible", F.lit(True))
    return silver.select(session).distinct().join(seen, session, "left").withColumn("label_disponible", F.coalesce("label_disponible", F.lit(False)))


def labels_of(df: DataFrame, code: str, label: str) -> DataFrame:
    """code, label: one label a code. Two labels for a code, or none at all, is an error."""
    pairs = df.select(code, label).dropna().dropDuplicates()
    if pairs.isEmpty():
        raise ValueError("no code has a label")
    if not ambiguous(pairs, code, label).isEmpty():
        raise ValueError("a code has two labels")
    return pairs


def ambiguous(df: DataFrame, code: str, label: str) -> DataFrame:
    return df.groupBy(code).agg(F.count_distinct(label).alias("labels")).where("labels > 1")


def guarded_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that may not add rows: keys that repeat on the right are an error, found before joining."""
    if not right.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError("keys repeat on the right side")
    return left.join(right, list(keys), "left")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return fact.join(dim.select(key).distinct(), key, "left_anti").agg(F.count(F.lit(1)).alias("orphans"))


def version_lookup(fact: DataFrame, dim: DataFrame, key: str, session: str, columns: Sequence[str]) -> DataFrame:
    """The version valid in the fact's session: equal keys and session between its bounds."""
    d = dim.select(F.col(key).alias("_key"), F.col("debut").alias("_from"), F.col("fin").alias("_to"), *columns)
    return fact.join(d, (F.col(key) == F.col("_key")) & F.col(session).between(F.col("_from"), F.col("_to")), "left").drop("_key", "_from", "_to")


def null_safe_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join in which a null key finds the right side's null."""
    r = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *columns)
    on = None
    for k in keys:
        on = F.col(k).eqNullSafe(F.col(f"_{k}")) if on is None else on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(r, on, "left").drop(*[f"_{k}" for k in keys])


def fact_table(cells: DataFrame, dim: DataFrame, key: str = "key", session: str = "session") -> DataFrame:
    """Cells (key, session, type, scholarship, num, den, effectif) with the surrogate of the version valid then, rate and overflow."""
    out = version_lookup(cells, dim, key, session, ["sk_formation"])
    return out.withColumn("taux", bounded_rate("num", "den")).withColumn("taux_depasse_1", rate_overflow("num", "den"))
