"""Register aggregates: town by activity, department by division, k-anonymity."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import age_years


def filtered(df: DataFrame, **conditions: Column | None) -> DataFrame:
    """df where every condition that is switched on (not None) holds."""
    for condition in conditions.values():
        if condition is not None:
            df = df.where(condition)
    return df


def town_activity(df: DataFrame, town: str, activity: str, state: str, is_open: str, is_closed: str, tier: Column, tiers: Sequence[str], created: str, as_of: str, new_code: str, recent_years: float = 3.0) -> DataFrame:
    """One scan, one shuffle: open and closed units; of the open ones, counts by tier, those with a new code, mean age and recent ones.

    Units of another state are left out. Pass employers alone (filtered()) where only they count."""
    active, age = F.col(state) == is_open, age_years(created, as_of)
    return df.where(F.col(town).isNotNull() & F.col(state).isin(is_open, is_closed)).groupBy(town, activity).agg(
        F.count_if(active).alias("n_actifs"), F.count_if(~active).alias("n_fermes"),
        *[F.count_if(active & (tier == t)).alias(f"n_{t}") for t in tiers],
        F.count_if(active & F.col(new_code).isNotNull()).alias("n_nouveau_code"), F.avg(F.when(active, age)).alias("age_moyen"),
        F.count_if(active & (age <= recent_years)).alias("n_recents"),
    ).withColumn("date_reference", F.lit(as_of).cast("date"))


def totals(aggregate: DataFrame, counts: Sequence[str]) -> DataFrame:
    return aggregate.agg(F.count(F.lit(1)).alias("cellules"), *[F.sum(c).alias(c) for c in counts])


def department_division(df: DataFrame, department: Column, division: Column, where: Column) -> DataFrame:
    return df.where(where).groupBy(department.alias("departement"), division.alias("division")).agg(F.count(F.lit(1)).alias("n"))


def k_anonymous(aggregate: DataFrame, k: int, count: str = "n") -> tuple[DataFrame, DataFrame]:
    """Cells of k units or more, and a one-row report of what was lost; the report's ratios are null without cells."""
    small = F.col(count) < k
    lost = aggregate.agg(
        F.count(F.lit(1)).alias("cellules"), F.count_if(small).alias("cellules_perdues"), F.sum(F.when(small, F.col(count)).otherwise(0)).alias("unites_perdues"),
        F.try_divide(F.count_if(small), F.count(F.lit(1))).alias("part_cellules"), F.try_divide(F.sum(F.when(small, F.col(count)).otherwise(0)), F.sum(count)).alias("part_unites"),
    )
    return aggregate.where(F.col(count) >= k), lost
