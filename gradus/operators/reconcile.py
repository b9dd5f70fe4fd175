"""Yearly files into one typed table, reshaping and sampling."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import scratch


def harmonised(vintages: dict[int, DataFrame], columns: Sequence[str], session: str = "session") -> DataFrame:
    """All vintages under one column list; a column a vintage lacks is null there."""
    parts = [df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]).withColumn(session, F.lit(year)) for year, df in sorted(vintages.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def inferred_types(df: DataFrame, text: Sequence[str] = ()) -> DataFrame:
    """column, type: double unless a value would be lost, bigint if every value is whole; an all-null column is double. One pass."""
    columns = [c for c in df.columns if c not in text]
    number = {c: F.expr(f"try_cast(`{c}` as double)") for c in columns}
    fit = lambda c: number[c].isNotNull() & ~F.isnan(number[c])
    whole = lambda c: fit(c) & (number[c] == F.floor(number[c]))
    row = df.agg(*[F.struct(F.count_if(F.col(c).isNotNull() & ~F.coalesce(fit(c), F.lit(False))).alias("lost"), F.count_if(F.col(c).isNotNull() & ~F.coalesce(whole(c), F.lit(False))).alias("broken"), F.count(c).alias("n")).alias(c) for c in columns])
    rows = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.lost").alias("lost"), F.col(f"`{c}`.broken").alias("broken"), F.col(f"`{c}`.n").alias("n")) for c in columns])).alias("r")).select("r.*")
    kind = F.when(F.col("n") == 0, "double").when(F.col("lost") > 0, "string").when(F.col("broken") == 0, "bigint").otherwise("double")
    return rows.select("column", kind.alias("type"))


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast by a type table; whole numbers written as decimals become integers."""
    cast = lambda c, t: F.expr(f"cast(cast(`{c}` as double) as bigint)") if t == "bigint" else F.col(c).cast(t)
    return df.select(*[cast(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def key_from_url(url, pattern: str = r"g_ta_cod=(\d+)") -> Column:
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def key_coverage(df: DataFrame, key: str, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(F.col(key).isNotNull().cast("double")).alias("coverage"))


def computable(pairs: dict[str, tuple[str, str]], key: str) -> Column:
    """Whether the key and at least one (num, den) pair can give a rate: den > 0 and num present."""
    return F.col(key).isNotNull() & reduce(lambda a, b: a | b, [F.coalesce((F.col(d) > 0) & F.col(n).isNotNull(), F.lit(False)) for n, d in pairs.values()])


def unpivot_cells(df: DataFrame, pairs: dict[str, tuple[str, str]], keep: Sequence[str]) -> DataFrame:
    """A row for each category whose cell is computable: keep, category, num, den."""
    cells = F.array(*[F.struct(F.lit(c).alias("category"), F.col(n).cast("double").alias("num"), F.col(d).cast("double").alias("den")) for c, (n, d) in pairs.items()])
    return df.select(*keep, F.explode(cells).alias("r")).select(*keep, "r.*").where("den > 0 and num is not null")


def carried_header(df: DataFrame, sheet: str, pos: str, is_header: Column, header: Column, drop: str | None = None) -> DataFrame:
    """Detail rows with the last section header above them; rows of the section `drop` go."""
    by = Window.partitionBy(sheet).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("section", F.last(F.when(is_header, header), ignorenulls=True).over(by)).where(~is_header & F.col("section").isNotNull())
    return out.where(F.col("section") != drop) if drop else out


def ranged(df: DataFrame, order: Sequence) -> DataFrame:
    """df dealt by ranges of a stated order, written and read back, with its range (_part) and its place there (_at, from 0).

    Written, as ranges are drawn anew whenever they are computed."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    path = scratch(df.sparkSession, "ranges")
    parts.withColumn("_part", F.spark_partition_id()).withColumn("_at", place).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def placed(df: DataFrame, order: Sequence, name: str) -> DataFrame:
    """df with its place in a stated order, from 0: a range's rows are counted where they are, and only those counts are summed."""
    parts = ranged(df, order)
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row a range
    return parts.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def quantiles(df: DataFrame, value: str, at: Sequence[float], by: str | None = None) -> DataFrame:
    """by, q: exact quantiles of each group, interpolated between neighbours; nulls don't count, a group without values has null ones.

    Distinct values are counted and dealt by ranges, so a large group is many tasks' work. Without by there is always one row."""
    counts = df.groupBy((F.lit(0) if by is None else F.col(by)).alias("_by"), F.col(value).cast("double").alias("_v")).agg(F.count(value).alias("_n"))
    parts = ranged(counts, ["_by", "_v"])
    group = Window.partitionBy("_by")
    sums = parts.groupBy("_by", "_part").agg(F.sum("_n").alias("_pn"))
    sums = sums.select(F.col("_by").alias("_b"), F.col("_part").alias("_p"), (F.sum("_pn").over(group.orderBy("_part")) - F.col("_pn")).alias("_before"), F.sum("_pn").over(group).alias("_total"))  # a row a range
    rows = parts.join(sums, F.col("_by").eqNullSafe(F.col("_b")) & (F.col("_part") == F.col("_p")))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy("_by", "_part").orderBy("_v"))
    rows = rows.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_n"))
    there = lambda place: F.max(F.when((F.col("_from") <= place) & (place < F.col("_upto")), F.col("_v")))

    def quantile(q: float) -> Column:
        place = F.lit(float(q)) * (F.col("_total") - 1)
        low, part = there(F.floor(place)), F.max(place - F.floor(place))
        return F.when(part == 0, low).otherwise(low + part * (there(F.ceil(place)) - low))

    found = F.array(*[quantile(q) for q in at]).alias("q")
    return rows.groupBy().agg(found) if by is None else rows.groupBy("_by").agg(found).withColumnRenamed("_by", by)


def with_quantiles(groups: DataFrame, df: DataFrame, value: str, names: dict[str, float], by: str | None = None) -> DataFrame:
    """groups (a row for each value of by, nulls too; without by one row) with the quantiles of df as columns, name -> quantile."""
    q = quantiles(df, value, list(names.values()), by)
    if by is None:
        out = groups.crossJoin(F.broadcast(q))  # one row each
    else:
        q = q.withColumnRenamed(by, "_by")
        out = groups.join(q, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")
    return out.withColumns({name: F.col("q")[i] for i, name in enumerate(names)}).drop("q")


def systematic_sample(df: DataFrame, order: Sequence[str], target: int) -> DataFrame:
    """Every stride-th row in a stated order, stride = max(total // target, 1), the first target of them."""
    stride = max(df.count() // target, 1)
    return placed(df, order, "_place").where((F.col("_place") % stride == 0) & (F.col("_place") < stride * target)).drop("_place")


def stratified_sample(df: DataFrame, stratum: str, key: Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    """round(fraction * n) rows of each stratum, by a seeded hash of the key; 1 keeps all. A stratum is spread over ranges."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must lie in (0, 1]")
    return df if fraction == 1 else share_of(placed_strata(df, stratum, key, seed), fraction)


def placed_strata(df: DataFrame, stratum: str, key: Sequence[str], seed: int = 0) -> DataFrame:
    """df with _at, a row's place in its stratum by a seeded hash of the key, and _n, the stratum's rows. Ranges are put in order, and only the
    few counts of ranges and strata are brought together, so no task gets a stratum."""
    parts = ranged(df.withColumn("_hash", F.xxhash64(F.lit(seed), *key)), [stratum, "_hash", *key])
    counts = parts.groupBy(F.col(stratum).alias("_stratum"), "_part").agg(F.count(F.lit(1)).alias("_pn"), F.min("_at").alias("_least"))
    own = Window.partitionBy("_stratum")
    counts = counts.select("_stratum", F.col("_part").alias("_p"), (F.sum("_pn").over(own.orderBy("_part")) - F.col("_pn") - F.col("_least")).alias("_shift"), F.sum("_pn").over(own).alias("_n"))
    rows = parts.join(F.broadcast(counts), F.col(stratum).eqNullSafe(F.col("_stratum")) & (F.col("_part") == F.col("_p")))  # a row a stratum and range
    return rows.select(*df.columns, (F.col("_at") + F.col("_shift")).alias("_at"), "_n")


def share_of(strata: DataFrame, fraction: float) -> DataFrame:
    """round(fraction * n) rows of each stratum of placed_strata(), the first."""
    return strata.where(F.col("_at") < F.bround(F.col("_n") * F.lit(fraction), 0)).drop("_at", "_n")


def table_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """same_schema, only_left, only_right: both 0 when a rerun gave the same rows."""
    if a.schema.simpleString() != b.schema.simpleString():
        return a.limit(1).agg(F.lit(False).alias("same_schema"), F.lit(None).cast("long").alias("only_left"), F.lit(None).cast("long").alias("only_right"))
    left, right = a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_left")), b.exceptAll(a).agg(F.count(F.lit(1)).alias("only_right"))
    return left.crossJoin(right).select(F.lit(True).alias("same_schema"), "only_left", "only_right")  # one row each


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the grain that occur more than once; keys with a null don't count."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def reconcile(vintages: dict[int, DataFrame], columns: Sequence[str], key: str, url: str | None = None, text: Sequence[str] = ()) -> DataFrame:
    """Silver: harmonised vintages, rebuilt keys, types inferred over the union, session and key unique."""
    rows = harmonised(vintages, columns)
    if url:
        rows = rows.withColumn(key, F.coalesce(key, key_from_url(url)))
    kinds = {r["column"]: r["type"] for r in inferred_types(rows, [*text, key, "session"]).collect()}  # a row a column
    out = typed(rows, kinds)
    if not duplicate_keys(out, ["session", key]).isEmpty():
        raise ValueError("a key occurs twice in a session")
    return out
