"""Profiles of a table: volumes, missing values, keys, constants, distributions, sweeps, series."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reconcile import quantiles, with_quantiles


def _long(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in columns])).alias("r")).select("r.*")


def missing_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _long(df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]), columns, "column", "missing")


def worst(df: DataFrame, value: str, name: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(value), name).limit(k)


def volumes(df: DataFrame, session: str, key: str) -> DataFrame:
    return df.groupBy(session).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(key).isNotNull().cast("double")).alias("key_coverage"))


def completeness_report(df: DataFrame, session: str, key: str, columns: Sequence[str], antecedent: str, first_labelled: int) -> DataFrame:
    """measure, session, column, value, of one pass that groups by session and by nothing: rows and key coverage of each session, columns
    that a session lacks altogether, null share of each column over all, cells without antecedent, rows before the first labelled session."""
    without = F.count_if(~F.coalesce(F.col(antecedent), F.lit(False))).alias("_without")
    counts = [F.count(F.lit(1)).alias("_n"), F.count(key).alias("_keys"), without, F.count_if(F.col(session) < first_labelled).alias("_before")]
    sums = df.rollup(session).agg(*counts, *[F.count(c).alias(f"_c{i}") for i, c in enumerate(columns)], F.grouping(session).alias("_all"))
    none = F.lit(None).cast("string")
    row = lambda measure, column, value, when: F.when(when, F.struct(F.lit(measure).alias("measure"), column.alias("column"), value.cast("double").alias("value")))
    one, whole, share = F.col("_all") == 0, F.col("_all") == 1, lambda c: F.try_divide(F.col(c), F.col("_n"))
    rows = [row("rows", none, F.col("_n"), one), row("key_coverage", none, share("_keys"), one)]
    rows += [row("without_antecedent", none, F.col("_without"), whole), row("before_first_label", none, F.col("_before"), whole)]
    rows += [row("missing_column", F.lit(c), F.lit(1), one & (F.col(f"_c{i}") == 0)) for i, c in enumerate(columns)]
    rows += [row("null_share", F.lit(c), 1 - share(f"_c{i}"), whole) for i, c in enumerate(columns)]
    return sums.select(F.when(one, F.col(session)).alias("session"), F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.measure", "session", "r.column", "r.value")


def candidate_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*keys)).alias("combinations"))


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with at most one value: least equals largest, which needs no distinct count."""
    row = df.agg(*[F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in columns])
    return _long(row, columns, "column", "constant")


def missing_by_group(df: DataFrame, column: str, group: str, least: int) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(column).isNull().cast("double")).alias("missing")).where(F.col("n") >= least)


def rate_distribution(cells: DataFrame, by: str) -> DataFrame:
    """Raw rates num / den (den > 0) of each category, and their mean raw, capped and without overflows."""
    raw = F.try_divide(F.col("num"), F.col("den"))
    share = lambda c: F.avg(c.cast("double"))
    rows = cells.withColumn("r", raw)
    out = rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.count("r").alias("defined"), share(F.col("r") > 1).alias("over"), share(F.col("r") == 0).alias("zero"), share(F.col("r") == 1).alias("one"),
        F.avg("r").alias("mean_raw"), F.avg(F.least("r", F.when(F.col("r").isNotNull(), 1.0))).alias("mean_capped"), F.avg(F.when(F.col("r") <= 1, F.col("r"))).alias("mean_excluded"),
    )
    return with_quantiles(out, rows, "r", {"median": 0.5}, by)


def threshold_sweep(df: DataFrame, value: str, thresholds: Sequence[float]) -> DataFrame:
    """Rows at or over each threshold; thresholds are rows repeated inside the scan, grouped once."""
    at = F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))
    return df.select(value, at.alias("threshold")).groupBy("threshold").agg(F.count_if(F.col(value) >= F.col("threshold")).alias("n"), F.avg((F.col(value) >= F.col("threshold")).cast("double")).alias("share"))


def definitions(df: DataFrame, alternatives: dict[str, tuple[str, str]]) -> DataFrame:
    """definition, n, over, share_over, mean, median of each alternative num / den where den > 0; rows are repeated inside the scan."""
    each = F.array(*[F.struct(F.lit(name).alias("definition"), F.when(F.col(d) > 0, F.col(n) / F.col(d)).alias("rate")) for name, (n, d) in alternatives.items()])
    rows = df.select(F.explode(each).alias("r")).select("r.*").where("rate is not null")
    over = F.col("rate") > 1
    figures = [F.count("rate").alias("n"), F.count_if(over).alias("over"), F.avg(over.cast("double")).alias("share_over"), F.avg("rate").alias("mean")]
    out = rows.groupBy("definition").agg(*figures)
    return with_quantiles(out, rows, "rate", {"median": 0.5}, "definition")


def paired_gap(df: DataFrame, a: Column, b: Column, close: float) -> DataFrame:
    gap = df.select((a - b).alias("gap")).where("gap is not null")
    row = gap.agg(F.count(F.lit(1)).alias("n"), F.avg("gap").alias("mean"), F.avg((F.col("gap") > 0).cast("double")).alias("positive"), F.avg((F.abs("gap") <= close).cast("double")).alias("close"))
    return with_quantiles(row, gap, "gap", {"p10": 0.1, "median": 0.5, "p90": 0.9}).select("n", "mean", "p10", "median", "p90", "positive", "close")


def group_medians(df: DataFrame, value: str, group: str, least: int) -> DataFrame:
    sizes = df.groupBy(group).agg(F.count(value).alias("n")).where(F.col("n") >= least)
    return with_quantiles(sizes, df, value, {"median": 0.5}, group)


def quantile_bins(df: DataFrame, by: str, value: str, bins: int = 5) -> DataFrame:
    """Bins of `by` between its exact quantiles, (a, b], equal edges merged: n and the median of value."""
    edges = quantiles(df, by, [i / bins for i in range(1, bins)]).select(F.array_distinct("q").alias("edges"))
    rows = df.where(F.col(by).isNotNull()).crossJoin(F.broadcast(edges))  # one row
    rows = rows.withColumn("bin", F.expr(f"size(filter(edges, e -> e < {by}))"))
    return with_quantiles(rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n")), rows, value, {"median": 0.5}, "bin")


def pooled_rates(cells: DataFrame, session: str) -> DataFrame:
    raw = F.try_divide(F.col("num"), F.col("den"))
    rows = cells.withColumn("r", raw)
    pooled = F.try_divide(F.sum(F.when(F.col("den") > 0, F.col("num"))), F.sum(F.when(F.col("den") > 0, F.col("den"))))
    out = rows.groupBy(session).agg(pooled.alias("pooled"), F.avg("r").alias("mean"), F.avg((F.col("r") == 0).cast("double")).alias("zero"), F.avg((F.col("r") >= 1).cast("double")).alias("full"))
    return with_quantiles(out, rows, "r", {"median": 0.5}, session)


def presence(df: DataFrame, session: str, columns: Sequence[str]) -> DataFrame:
    """A row a column, a column a session: whether any value is there."""
    row = df.groupBy(session).agg(*[(F.count(c) > 0).alias(c) for c in columns])
    return row.unpivot([session], list(columns), "column", "present")


def mean_series(df: DataFrame, session: str, indicators: Sequence[str]) -> DataFrame:
    """session, indicator, mean: null where a session has no value."""
    row = df.groupBy(session).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in indicators])
    return row.unpivot([session], list(indicators), "indicator", "mean")


def bridge_coverage(programmes: DataFrame, code: str, certificates: DataFrame, occupations: DataFrame, occupation: str, final: DataFrame, active: str) -> DataFrame:
    """link, total, kept, rate of every join of a bridge, never one rate for all.

    programmes (code, may lack or be blank), certificates (code, occupation), occupations (occupation, division), final: the joined bridge
    with its status, which may be unknown."""
    count = lambda df, **c: df.agg(*[x.alias(k) for k, x in c.items()])
    given = F.col(code).isNotNull() & (F.trim(F.col(code).cast("string")) != "")
    first = count(programmes, programmes=F.count(F.lit(1)), with_code=F.count_if(given))
    second = count(certificates, certificates=F.count_distinct(code))
    known = occupations.select(occupation).distinct().withColumn("_known", F.lit(True))
    third = count(certificates.select(occupation).distinct().join(known, occupation, "left"), occupations=F.count(occupation), covered=F.count("_known"))
    fourth = count(final, rows=F.count(F.lit(1)), rows_active=F.count_if(F.col(active)), reached=F.count_distinct(code), reached_active=F.count_distinct(F.when(F.col(active), F.col(code))))
    row = first.crossJoin(second).crossJoin(third).crossJoin(fourth)  # one row each
    links = {
        "programme -> code": ("programmes", "with_code"),
        "certificate -> occupation": ("certificates", "certificates"),
        "programme with code -> division": ("with_code", "reached"),
        "occupation -> division": ("occupations", "covered"),
        "programme -> division": ("programmes", "reached"),
        "row -> active": ("rows", "rows_active"),
        "reached programme -> active": ("reached", "reached_active"),
    }
    each = F.array(*[F.struct(F.lit(n).alias("link"), F.col(a).alias("total"), F.col(b).alias("kept")) for n, (a, b) in links.items()])
    return row.select(F.explode(each).alias("r")).select("r.*").withColumn("rate", F.try_divide(F.col("kept"), F.col("total")))


def coverage_links(parts: dict[str, tuple[Column, Column]], df: DataFrame) -> DataFrame:
    """link, total, kept, rate: one aggregate, one row a link. parts: link -> (counts in total, kept)."""
    row = df.agg(*[F.struct(F.count_if(t).alias("total"), F.count_if(t & k).alias("kept")).alias(n) for n, (t, k) in parts.items()])
    return _long(row, list(parts), "link", "r").select("link", "r.*").withColumn("rate", F.try_divide(F.col("kept"), F.col("total")))
