"""Leakage-safe features and baselines: current and lagged lookups, expanding means, splits and guards."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import bounded_rate


def current_lookup(fact: DataFrame, silver: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns of the same session; the right side is reduced to one row a key, the smallest."""
    right = silver.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_r")).select(*keys, "_r.*")
    return fact.join(right, list(keys), "left")


def lagged_lookup(fact: DataFrame, silver: DataFrame, key: str, session: str, columns: Sequence[str], prefix: str = "lag__", found: str = "antecedent") -> DataFrame:
    """Columns of the session before, by a join (gaps stay null); found tells "no row" from "row with null"."""
    right = silver.select(F.col(key), (F.col(session) + 1).alias(session), *[F.col(c).alias(prefix + c) for c in columns], F.lit(True).alias(found))
    return fact.join(right, [key, session], "left").withColumn(found, F.coalesce(found, F.lit(False)))


def checked_columns(df: DataFrame, allowed: Iterable[str], new: Iterable[str] = ()) -> DataFrame:
    """df if all its columns are allowed and none clashes with those to be added; an error otherwise."""
    if illegal := sorted(set(df.columns) - set(allowed)):
        raise ValueError(f"columns not allowed: {', '.join(illegal)}")
    if clash := sorted(set(df.columns) & set(new)):
        raise ValueError(f"columns exist already: {', '.join(clash)}")
    return df


def split(df: DataFrame, sessions: Sequence[int], session: str = "session") -> DataFrame:
    out = df.where(F.col(session).isin(*sessions))
    if out.isEmpty():
        raise ValueError("the split is empty")
    return out


def without_sessions(df: DataFrame, forbidden: Sequence[int], session: str = "session") -> DataFrame:
    """df, or an error if it holds a session that is held out."""
    if not df.where(F.col(session).isin(*forbidden)).limit(1).isEmpty():
        raise ValueError("held-out sessions are present")
    return df


def expanding_mean(df: DataFrame, value: str, weight: str, session: str, group: Sequence[str] = ()) -> DataFrame:
    """Weighted mean over strictly earlier sessions of the group; null in the first. A null value adds its weight alone."""
    keys = [*group, session]
    sums = df.groupBy(*keys).agg(F.sum(F.col(value) * F.col(weight)).alias("_s"), F.sum(weight).alias("_w"))
    by = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy(session).rangeBetween(Window.unboundedPreceding, -1)
    means = sums.select(*keys, F.try_divide(F.sum("_s").over(by), F.sum("_w").over(by)).alias("expanding"))
    return df.join(means, keys, "left")


def fallback_prediction(df: DataFrame, first: str, second: str, session: str, sessions: Sequence[int]) -> DataFrame:
    """coalesce(first, second) on the chosen sessions."""
    return df.where(F.col(session).isin(*sessions)).withColumn("prediction", F.coalesce(first, second))


def with_previous_rate(df: DataFrame, num: str, den: str) -> DataFrame:
    rate = bounded_rate(num, den)
    return df.withColumn("taux_precedent", rate).withColumn("a_antecedent", rate.isNotNull())


def model_matrix(df: DataFrame, numeric: Sequence[str], categories: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Numbers as doubles with missing flags, texts and booleans as texts with null as a category of its own."""
    numbers = [c for n in numeric for c in (F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n), F.col(n).isNull().cast("double").alias(f"{n}__absent"))]
    return df.select(*[k for k in keep if k not in (*numeric, *categories)], *numbers, *[F.coalesce(F.col(c).cast("string"), F.lit("__manquant__")).alias(c) for c in categories])
