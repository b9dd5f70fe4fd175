"""Errors, calibration, group audits and choices over a predictions table."""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import bounded_rate, clip01
from .reconcile import placed, with_quantiles


def weighted_mae(y, p, w) -> Column:
    y, p, w = (F.col(x) if isinstance(x, str) else x for x in (y, p, w))
    ok = y.isNotNull() & p.isNotNull()
    return F.try_divide(F.sum(F.when(ok, F.abs(y - p) * w)), F.sum(F.when(ok, w)))


def errors(df: DataFrame, y: str, p: str, w: str, by: Sequence[str] = ()) -> DataFrame:
    """Weighted and plain mean absolute error over predicted rows, with the share predicted; none predicted: null."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(p).isNotNull().cast("double")).alias("coverage"), weighted_mae(y, p, w).alias("mae_weighted"), F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"),
    )


def scoped_errors(df: DataFrame, y: str, variants: Sequence[str], w: str, session: str, scopes: dict[str, Sequence[int]]) -> DataFrame:
    """Errors of every variant in every (overlapping) scope: rows are repeated for their scopes once, then grouped once."""
    scope = F.array_compact(F.array(*[F.when(F.col(session).isin(*s), F.lit(name)) for name, s in scopes.items()]))
    long = df.select(y, w, F.explode(scope).alias("scope"), F.array(*[F.struct(F.lit(v).alias("variant"), F.col(v).cast("double").alias("p")) for v in variants]).alias("v"))
    return errors(long.select(y, w, "scope", F.explode("v").alias("v")).select(y, w, "scope", "v.*"), y, "p", w, ["scope", "variant"])


def calibration(df: DataFrame, y: str, p: str, w: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins of the clipped prediction, the last one closed: n, weight, weighted means, gap. Empty bins are absent."""
    at = F.least(F.floor(clip01(p) * bins), F.lit(bins - 1)).cast("int")
    rows = df.where(F.col(p).isNotNull() & F.col(y).isNotNull()).withColumn("bin", at)
    mean = lambda c: F.sum(F.col(c) * F.col(w)) / F.sum(w)
    out = rows.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"), F.sum(w).alias("weight"), mean(p).alias("predicted"), mean(y).alias("observed"))
    return out.withColumn("gap", F.col("predicted") - F.col("observed"))


def calibration_error(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return table.groupBy(*by).agg((F.sum(F.abs("gap") * F.col("weight")) / F.sum("weight")).alias("ece"))


def by_dimensions(df: DataFrame, dimensions: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """A row for each of a row's groups: dimension, grp."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("indetermine")).alias("grp")) for d in dimensions])
    return df.select(*keep, F.explode(pairs).alias("g")).select(*keep, "g.*")


def group_audit(df: DataFrame, dimensions: Sequence[str], y: str, p: str, baseline: str, w: str, threshold: float = 0.5, least: int = 30, bins: int = 10) -> DataFrame:
    """For each group of each dimension: size, weight, reliability, errors of both predictions, calibration error, selection rates."""
    long = by_dimensions(df, dimensions, [y, p, baseline, w])
    share = lambda c: F.sum(F.when(F.col(c) >= threshold, F.col(w)).otherwise(0.0)) / F.sum(w)
    audit = long.groupBy("dimension", "grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("weight"), (F.count(F.lit(1)) >= least).alias("reliable"), weighted_mae(y, p, w).alias("mae_model"),
        weighted_mae(y, baseline, w).alias("mae_baseline"), F.avg(F.abs(F.col(y) - F.col(p))).alias("mae_plain"), share(p).alias("selected"), share(y).alias("selected_observed"),
    )
    ece = calibration_error(calibration(long, y, p, w, bins, ["dimension", "grp"]), ["dimension", "grp"])
    return audit.join(ece, ["dimension", "grp"], "left")


def disparate_impact(audit: DataFrame, rate: str = "selected", least: float = 0.8) -> DataFrame:
    """Rate over the dimension's largest, among reliable groups; NaN when nothing is selected anywhere, and then not below."""
    top = F.max(rate).over(Window.partitionBy("dimension"))
    out = audit.where("reliable").withColumn("ratio", F.when(top == 0, F.lit(float("nan"))).otherwise(F.try_divide(F.col(rate), top)))
    return out.select("dimension", "grp", "ratio", (~F.isnan("ratio") & (F.col("ratio") < least)).alias("below"))


def correlation_ratio(df: DataFrame, values: Sequence[str], group: str) -> DataFrame:
    """eta squared of each value by group: between over total sum of squares; no variance: 0; no value: null. Null groups add nothing between."""
    long = df.select(group, F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("v")) for v in values])).alias("r")).select(group, "r.*").where("v is not null")
    groups = long.groupBy("variable", group).agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s2"))
    total = groups.groupBy("variable").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    joined = groups.join(F.broadcast(total), "variable")  # one row a variable
    dev = F.col("n") * F.pow(F.col("m") - F.col("mean"), 2)
    sums = joined.groupBy("variable").agg(F.sum(F.when(F.col(group).isNotNull(), dev)).alias("between"), F.sum(dev + F.col("n") * F.col("s2")).alias("total"))
    return sums.select("variable", F.when(F.col("total") == 0, 0.0).otherwise(F.try_divide("between", "total")).alias("eta2"))


#: Of the permutation: a prime modulus whose squares fit a long, multiplier and round keys (any will do), rounds.
_PRIME, _FACTOR, _ROUNDS = (1 << 31) - 1, 48_271, 6


def permutation_key(seed: int, step: int) -> int:
    return (seed * 7_919 + step * 104_729 + 12_345) % _PRIME


def permuted_place(place: Column, n: int, seed: int) -> Column:
    """A keyed bijection of 0..n-1: a Feistel network on two digits, whose sums modulo their bases leave every step reversible.

    The digits' bases make little more than n; a place that lands beyond is sent on, as often as needed (16 times at most where more
    than 15 places lie beyond; a longer way has a chance of n**-7 and is an error downstream, as rows are counted)."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    keys = F.array(*[F.struct(F.lit(permutation_key(seed, step)).cast("long").alias("key"), F.lit(b if step % 2 else a).cast("long").alias("base")) for step in range(_ROUNDS)])

    def mixed(pair: Column, k: Column) -> Column:
        """(own, other) -> (other, own + what other's digit is mixed to): the two change places at every step."""
        t = (pair["other"] * _FACTOR + k["key"]) % _PRIME
        own = (pair["own"] + (t * t + t) % _PRIME) % k["base"]
        return F.struct(pair["other"].alias("own"), own.alias("other"))

    def once(x: Column) -> Column:
        first = F.struct(F.floor(x / b).cast("long").alias("own"), (x % b).cast("long").alias("other"))
        return F.aggregate(keys, first, mixed, lambda pair: pair["own"] * b + pair["other"])

    steps = F.sequence(F.lit(1), F.lit(min(a * b - n, 15))) if a * b > n else F.array().cast("array<int>")
    return F.aggregate(steps, once(place), lambda x, _: F.when(x < n, x).otherwise(once(x)))


def permuted(df: DataFrame, value: str, key: Sequence[str], seed: int) -> DataFrame:
    """The same rows with value dealt anew: rows are numbered by the key's order, once, and each takes the value of its permuted place."""
    rows = placed(df, list(key), "_rn")
    dealt = rows.select(permuted_place(F.col("_rn"), rows.count(), seed).alias("_rn"), F.col(value))
    return rows.drop(value).join(dealt, "_rn").drop("_rn").select(*df.columns)


def permuted_sums(df: DataFrame, value: str, group: str, key: Sequence[str], rounds: int = 5) -> DataFrame:
    """round (0: as it is), group, n, total: count and sum of value in each group after each of the permutations.

    Rows are numbered once; all rounds go through one join on the place."""
    order = [f"_k{i}" for i in range(len(key))]
    plain = df.select(F.col(group).alias("group"), F.col(value).cast("double").alias("value"), *[F.col(k).alias(o) for k, o in zip(key, order, strict=True)])
    rows = placed(plain, order, "_rn").select("_rn", "group", "value")
    n = rows.count()
    places = F.array(*[F.struct(F.lit(r).alias("round"), (permuted_place(F.col("_rn"), n, r) if r else F.col("_rn")).alias("place")) for r in range(rounds + 1)])
    dealt = rows.select("value", F.explode(places).alias("p")).select("value", F.col("p.round").alias("round"), F.col("p.place").alias("_rn"))
    return dealt.join(rows.select("_rn", "group"), "_rn").groupBy("round", "group").agg(F.count("value").alias("n"), F.sum("value").alias("total"), F.count(F.lit(1)).alias("rows"))


def net_variance(df: DataFrame, value: str, group: str, key: Sequence[str], rounds: int = 5) -> DataFrame:
    """observed: eta squared, chance: its mean over permutations, and net, their difference."""
    sums = permuted_sums(df, value, group, key, rounds)
    whole = df.agg(F.avg(F.col(value).cast("double")).alias("mean"), (F.var_pop(F.col(value).cast("double")) * F.count(value)).alias("spread"), F.count(F.lit(1)).alias("all"))
    part = F.when(F.col("group").isNotNull() & (F.col("n") > 0), F.col("n") * F.pow(F.col("total") / F.col("n") - F.col("mean"), F.lit(2)))
    between, same = F.coalesce(F.sum(part), F.lit(0.0)).alias("between"), [F.first(c).alias(c) for c in ("spread", "all")]
    each = sums.crossJoin(F.broadcast(whole)).groupBy("round").agg(between, F.sum("rows").alias("rows"), *same)  # one row
    lost = F.raise_error(F.lit("a permuted place is missing"))
    eta = F.when(F.col("rows") != F.col("all"), lost.cast("double")).when(F.col("spread").isNull(), float("nan")).when(F.col("spread") == 0, 0.0).otherwise(F.col("between") / F.col("spread"))
    each = each.select("round", eta.alias("eta2"))
    seen, chance = F.max(F.when(F.col("round") == 0, F.col("eta2"))), F.avg(F.when(F.col("round") > 0, F.col("eta2")))
    return each.agg(seen.alias("observed"), chance.alias("chance"), (seen - chance).alias("net"))


def rate_gap(df: DataFrame, a: tuple[str, str], b: tuple[str, str], close: float = 0.05) -> DataFrame:
    """Gap of two bounded rates in one row: median, share under `close`, undetermined rows."""
    gap = bounded_rate(*a) - bounded_rate(*b)
    rows = df.select(gap.alias("gap"))
    row = rows.agg(F.avg((F.abs("gap") < close).cast("double")).alias("share_close"), F.count_if(F.col("gap").isNull()).alias("undetermined"))
    return with_quantiles(row, rows, "gap", {"median_gap": 0.5})


def choose_candidate(table: DataFrame, error: str, ece: str, group_ece: str, name: str, slack: tuple[float, float] = (0.0005, 0.001)) -> DataFrame:
    """Least error within a slack, then least calibration error within a slack, then least group error; missing is infinite, ties by name."""
    inf = F.lit(float("inf"))
    rows = table.select("*", *[F.coalesce(F.col(c).cast("double"), inf).alias(f"_{i}") for i, c in enumerate((error, ece, group_ece))])
    for i, s in enumerate(slack):
        rows = rows.crossJoin(F.broadcast(rows.agg(F.min(f"_{i}").alias("_best")))).where(F.col(f"_{i}") <= F.col("_best") + s).drop("_best")  # a number
    return rows.orderBy("_2", name).limit(1).select(*table.columns)


def promoted(error, baseline, ece, most: float = 0.0322) -> Column:
    return (F.col(error) < F.col(baseline)) & (F.col(ece) < most)


def importance(df: DataFrame, columns: Sequence[str], w: str) -> DataFrame:
    """variable, importance: weighted mean of absolute contribution, share (0 if nothing contributes). A total weight of 0 or less is an error."""
    long = df.select(w, F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("v")) for c in columns])).alias("r")).select(w, "r.*")
    total = F.sum(F.col(w).cast("double"))
    mean = F.when(F.coalesce(total, F.lit(0.0)) <= 0, F.raise_error(F.lit("the total weight must be over 0")).cast("double")).otherwise(F.sum(F.abs("v") * F.col(w)) / total)
    out = long.groupBy("variable").agg(mean.alias("importance"))
    return out.withColumn("share", F.coalesce(F.try_divide(F.col("importance"), F.sum("importance").over(Window.partitionBy(F.lit(0)))), F.lit(0.0)))  # a row a variable


def named_shares(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """variable, share of the named variables, 0 for one that is not among importance()'s."""
    wanted = found.sparkSession.createDataFrame([(n,) for n in names], "variable string")
    return wanted.join(found.select("variable", "share"), "variable", "left").withColumn("share", F.coalesce("share", F.lit(0.0)))


def top_contributions(columns: Sequence[str], k: int) -> Column:
    """The k largest contributions of a row by absolute value, ties by name."""
    items = F.array(*[F.struct((-F.abs(F.col(c))).alias("order"), F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns])
    return F.transform(F.slice(F.array_sort(items), 1, k), lambda x: F.struct(x["variable"].alias("variable"), x["value"].alias("value")))


def extreme_examples(df: DataFrame, p: str, w: str, least: float, key: Sequence[str], columns: Sequence[str], k: int = 8) -> DataFrame:
    """The rows with the highest and lowest prediction among those of enough weight, with their top contributions."""
    row = F.struct(*key, F.col(p).alias("prediction"), top_contributions(columns, k).alias("top"))
    rows = df.where(F.col(w) >= least)
    both = rows.agg(F.max_by(row, F.struct(F.col(p), *[F.col(c) for c in key])).alias("high"), F.min_by(row, F.struct(F.col(p), *[F.col(c) for c in key])).alias("low"))
    return both.select(F.explode(F.array(F.struct(F.lit("high").alias("which"), F.col("high").alias("r")), F.struct(F.lit("low").alias("which"), F.col("low").alias("r")))).alias("x")).select("x.which", "x.r.*")
