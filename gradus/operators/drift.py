"""Drift between a reference and a later sample, for any two sets of sessions, from one histogram.

histogram() counts each value of each variable by session; that table can be added to one of later sessions (merged()). Values are then put
in order once, by ranges, and cut into blocks, with the counts by session before and up to each block (Ordered). Deciles, bins and
distribution functions of every comparison are differences of running counts, so no row is repeated for a comparison; and only blocks that can
hold an answer are looked into.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import category_key
from ..sources.tables import scratch

FLOOR = 1e-4
#: Values of a block.
BLOCK = 1024
Comparisons = dict[str, tuple[Sequence, Sequence]]


def histogram(df: DataFrame, session: str, numbers: Sequence[str], categories: Sequence[str] = ()) -> DataFrame:
    """variable, session, value (of a number), category (of a text, canonical; missing is one of them), n, present: rows whose value
    isn't null. Numbers and texts are each unpivoted and counted in one scan of their columns and one shuffle, by a key no wider than they need."""
    parts, none = [], F.lit(None)
    if numbers:
        rows = df.select(F.col(session).alias("_session"), *[F.col(c).cast("double").alias(c) for c in numbers]).unpivot("_session", list(numbers), "variable", "value")
        counts = rows.groupBy("variable", F.col("_session").alias("session"), "value").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("present"))
        parts.append(counts.select("variable", F.lit(False).alias("text"), "session", "value", none.cast("string").alias("category"), "n", "present"))
    if categories:
        rows = df.select(F.col(session).alias("_session"), *[F.col(c).cast("string").alias(c) for c in categories]).unpivot("_session", list(categories), "variable", "category")
        counts = rows.groupBy("variable", F.col("_session").alias("session"), "category").agg(F.count(F.lit(1)).alias("n"), F.count("category").alias("present"))
        key = category_key("category").alias("category")  # once a distinct category and session
        parts.append(merged([counts.select("variable", F.lit(True).alias("text"), "session", none.cast("double").alias("value"), key, "n", "present")]))
    return reduce(DataFrame.unionByName, parts)


def stored_histogram(df: DataFrame, session: str, numbers: Sequence[str], categories: Sequence[str] = ()) -> DataFrame:
    """histogram(), written once for all that is read from it."""
    return _stored(histogram(df, session, numbers, categories), "histogram")


def merged(histograms: Sequence[DataFrame]) -> DataFrame:
    """Counts of all the histograms together."""
    whole = histograms[0]
    for other in histograms[1:]:
        whole = whole.unionByName(other)
    return whole.groupBy("variable", "text", "session", "value", "category").agg(F.sum("n").alias("n"), F.sum("present").alias("present"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sides(comparisons: Comparisons) -> tuple[list, list[tuple[str, list[int], list[int]]]]:
    """All sessions, and each comparison with the places of its sessions among them."""
    sessions = list(dict.fromkeys(s for a, b in comparisons.values() for s in (*a, *b)))
    return sessions, [(name, [sessions.index(s) for s in a], [sessions.index(s) for s in b]) for name, (a, b) in comparisons.items()]


def _total(array: str, places: Sequence[int]) -> Column:
    return sum((F.col(array)[i] for i in places), F.lit(0).cast("long"))


def _by_session(sessions: Sequence, count: str) -> Column:
    """Sums by session, in order, of a group."""
    return F.array(*[F.coalesce(F.sum(F.when(F.col("session") == F.lit(s), F.col(count))), F.lit(0)).cast("long") for s in sessions])


class Ordered:
    """The numbers of a histogram in order. rows: variable, block, value, n (counts by session). blocks: a row a block, with its least value and
    the variable's counts by session before it, up to its end, and of all."""

    def __init__(self, hist: DataFrame, sessions: Sequence):
        self.n = range(len(sessions))
        variable = Window.partitionBy("variable")
        # Dealt by ranges first: a value's sessions meet there, so counting them asks for no shuffle of its own.
        dealt = hist.where("not text and value is not null and session is not null").select("variable", "value", "session", "n").repartitionByRange("variable", "value")
        counts = [F.coalesce(F.sum(F.when(F.col("session") == F.lit(s), F.col("n"))), F.lit(0)).cast("long").alias(f"s{i}") for i, s in enumerate(sessions)]
        parts = dealt.groupBy("variable", "value").agg(*counts).sortWithinPartitions("variable", "value")
        place = F.monotonically_increasing_id()  # the range in the upper bits, the place there in the lower 33
        self.rows = _stored(parts.withColumn("block", place - place % BLOCK), "ordered")
        blocks = self.rows.groupBy("variable", "block").agg(F.min("value").alias("least"), *[F.sum(f"s{i}").alias(f"s{i}") for i in self.n])
        upto = F.array(*[F.sum(f"s{i}").over(variable.orderBy("block")) for i in self.n])
        before = F.array(*[F.sum(f"s{i}").over(variable.orderBy("block")) - F.col(f"s{i}") for i in self.n])
        whole = F.array(*[F.sum(f"s{i}").over(variable) for i in self.n])
        self.blocks = _stored(blocks.select("variable", "block", "least", before.alias("before"), upto.alias("upto"), whole.alias("all")), "blocks")

    def within(self, blocks: DataFrame) -> DataFrame:
        """Rows of some blocks: variable, block, value, n, run (the counts by session up to the value), all."""
        upto = Window.partitionBy("variable", "block").orderBy("value")
        rows = self.rows.join(F.broadcast(blocks.select("variable", "block", "before", "all")), ["variable", "block"])  # a row a block
        run = F.array(*[F.col("before")[i] + F.sum(f"s{i}").over(upto) for i in self.n])
        return rows.select("variable", "block", "value", F.array(*[f"s{i}" for i in self.n]).alias("n"), run.alias("run"), "all")

    def at(self, asked: DataFrame) -> DataFrame:
        """asked: variable, x, others. Adds run, the counts by session up to x (null before the first value).

        asked is a small table: each of its rows belongs to one block, whose values up to x are counted."""
        of = self.blocks.select("variable", "block", "least", "before").join(F.broadcast(asked), "variable").where("least <= x")  # asked's rows
        of = of.groupBy(*asked.columns).agg(F.max("block").alias("block"), F.max_by("before", "block").alias("before"))
        counts = self.rows.join(F.broadcast(of), ["variable", "block"]).where("value <= x")  # asked's rows
        run = F.array(*[F.first("before")[i] + F.sum(f"s{i}") for i in self.n])
        found = counts.groupBy(*asked.columns).agg(run.alias("run"))
        return asked.join(F.broadcast(found), list(asked.columns), "left")  # asked's rows

    def quantiles(self, references: Sequence[tuple[int, ...]], bins: int) -> DataFrame:
        """variable, reference (its place), q: least value, inner quantiles, largest value, interpolated between neighbours."""
        of = self.blocks.select("variable", "block", "before", "upto", "all", F.posexplode(F.array(*[F.array(*map(F.lit, r)) for r in references])).alias("reference", "places"))
        add = "aggregate(places, 0L, (t, i) -> t + {}[i])"
        of = of.withColumns({c: F.expr(add.format(array)) for c, array in (("first", "before"), ("end", "upto"), ("total", "all"))}).where("first < end")
        place = F.col("k") * (F.col("total") - 1) / F.lit(float(bins))
        wanted = of.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(bins)))).withColumn("share", place - F.floor(place))
        wanted = wanted.withColumn("pos", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place))))).where("first <= pos and pos < end")
        wanted = _stored(wanted.select("variable", "block", "before", "all", "reference", "places", "k", "share", "pos"), "wanted")
        rows = self.within(wanted.dropDuplicates(["variable", "block"])).join(F.broadcast(wanted.drop("before", "all")), ["variable", "block"])  # quantiles of each variable and reference
        rows = rows.withColumn("end", F.expr(add.format("run"))).where(F.col("pos") < F.col("end")).where(F.col("pos") >= F.col("end") - F.expr(add.format("n")))
        value = F.min("value") + F.max("share") * (F.max("value") - F.min("value"))
        each = rows.groupBy("variable", "reference", "k").agg(value.alias("q"))
        return each.groupBy("variable", "reference").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "q"))), lambda r: r["q"]).alias("q"))  # bins + 1 a group


def _index(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, psi of counts (by, a, b: rows of a bin); 0 where a side is empty. Bins that are empty on both sides add nothing."""
    group = Window.partitionBy(*by)
    p, q = (F.greatest(F.try_divide(F.col(c), F.sum(c).over(group)), F.lit(FLOOR)) for c in "ab")
    shares = counts.withColumn("whole", (F.sum("a").over(group) > 0) & (F.sum("b").over(group) > 0)).withColumn("p", p).withColumn("q", q)
    term = (F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))
    return shares.groupBy(*by).agg(F.sum(F.when(F.col("whole"), term).otherwise(0.0)).alias("psi"))


def _numeric(ordered: Ordered, sides, bins: int) -> DataFrame:
    """variable, comparison, psi. Bins are the reference's quantile bins: equal edges merged, ends open, (a, b]."""
    references = list(dict.fromkeys(tuple(a) for _, a, _ in sides))
    edges = _stored(ordered.quantiles(references, bins), "edges")  # a row a variable and reference

    def comparison(name: str, a: list[int], b: list[int]) -> Column:
        places = [F.array(*map(F.lit, x)).alias(n) for n, x in (("a_of", a), ("b_of", b))]
        return F.struct(F.lit(name).alias("comparison"), F.lit(references.index(tuple(a))).alias("of"), *places)

    of = F.array(*[comparison(*side) for side in sides])
    inner = F.expr("filter(array_distinct(q), e -> e > q[0] and e < q[size(q) - 1])")
    asked = edges.where("q[0] < element_at(q, -1)").select("variable", "reference", F.explode(F.concat(inner, F.array(F.element_at("q", -1)))).alias("x"))
    ends = ordered.blocks.groupBy("variable").agg(F.first("all").alias("all"))
    last = edges.select("variable", "reference", F.element_at("q", -1).alias("last"))
    runs = ordered.at(asked).join(F.broadcast(ends), "variable").join(F.broadcast(last), ["variable", "reference"])  # a row a variable
    run = F.when(F.col("x") == F.col("last"), F.col("all")).otherwise(F.coalesce("run", F.transform("all", lambda x: x * 0)))  # the last bin is open
    rows = runs.withColumn("run", run).withColumn("c", F.explode(of)).where("c.of = reference").select("variable", "c.*", "x", "run")
    add = "aggregate({0}_of, 0L, (t, i) -> t + run[i])"
    upto = Window.partitionBy("variable", "comparison").orderBy("x")
    for side in "ab":
        total = F.expr(add.format(side))
        rows = rows.withColumn(f"{side}_run", total).withColumn(side, F.col(f"{side}_run") - F.coalesce(F.lag(f"{side}_run").over(upto), F.lit(0)))
    return _index(rows, ["variable", "comparison"])


def _distances(ordered: Ordered, sides) -> DataFrame:
    """variable, comparison, ks: the largest distance of the two distribution functions, null if a side is empty.

    It is known at the ends of blocks. Inside a block neither function leaves what it is before it and at its end, so only blocks whose bounds
    lie further apart than any ends do are looked into."""
    share = lambda run, places: F.try_divide(_total(run, places), _total("all", places))
    far = lambda run: [F.max(F.abs(share(run, a) - share(run, b))) for _, a, b in sides]
    ends = _stored(ordered.blocks.groupBy("variable").agg(*[d.alias(f"e{i}") for i, d in enumerate(far("upto"))]), "ends")  # a row a variable
    bound = [F.greatest(share("upto", a) - share("before", b), share("upto", b) - share("before", a)) for _, a, b in sides]
    further = reduce(lambda x, y: x | y, [F.coalesce(d > F.col(f"e{i}"), F.lit(False)) for i, d in enumerate(bound)])
    inside = ordered.within(ordered.blocks.join(F.broadcast(ends), "variable").where(further)).groupBy("variable").agg(*[d.alias(f"d{i}") for i, d in enumerate(far("run"))])
    each = F.array(*[F.struct(F.lit(name).alias("comparison"), F.greatest(f"e{i}", f"d{i}").alias("ks")) for i, (name, _, _) in enumerate(sides)])
    return ends.join(F.broadcast(inside), "variable", "left").select("variable", F.explode(each).alias("r")).select("variable", "r.*")  # a row a variable


def _categorical(hist: DataFrame, sessions: Sequence, sides, top: int, other: str) -> DataFrame:
    """variable, comparison, psi over the reference's most frequent categories (ties by name) and one bin for the rest."""
    wide = hist.where("text and session is not null").groupBy("variable", "category").agg(_by_session(sessions, "n").alias("n"))
    each = F.array(*[F.struct(F.lit(name).alias("comparison"), _total("n", a).alias("a"), _total("n", b).alias("b")) for name, a, b in sides])
    rows = wide.select("variable", "category", F.explode(each).alias("c")).select("variable", "category", "c.*").where("a > 0 or b > 0")
    rank = F.row_number().over(Window.partitionBy("variable", "comparison").orderBy(F.desc("a"), "category"))
    ranked = rows.where("a > 0").withColumn("rank", rank).where(F.col("rank") <= top).select("variable", "comparison", "category", F.lit(True).alias("kept"))
    named = rows.join(F.broadcast(ranked), ["variable", "comparison", "category"], "left")  # top rows a variable and comparison
    bins = named.groupBy("variable", "comparison", F.when(F.col("kept"), F.col("category")).otherwise(other).alias("bin")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return _index(bins, ["variable", "comparison"])


def numeric_index(hist: DataFrame, comparisons: Comparisons, bins: int = 10) -> DataFrame:
    """variable, comparison, psi of the numbers."""
    sessions, sides = _sides(comparisons)
    return _numeric(Ordered(hist, sessions), sides, bins)


def categorical_index(hist: DataFrame, comparisons: Comparisons, top: int = 20, other: str = "__autre__") -> DataFrame:
    """variable, comparison, psi of the categories."""
    return _categorical(hist, *_sides(comparisons), top, other)


def distances(hist: DataFrame, comparisons: Comparisons) -> DataFrame:
    """variable, comparison, ks of the numbers."""
    sessions, sides = _sides(comparisons)
    return _distances(Ordered(hist, sessions), sides)


def drift(hist: DataFrame, comparisons: Comparisons, bins: int = 10, top: int = 20, other: str = "__autre__", limit: float = 0.2) -> DataFrame:
    """variable, type, comparison, n_reference, n_comparison (rows with a value), psi, ks (null for categories), beyond: psi >= limit.

    comparisons: name -> (reference's sessions, later sessions). Write hist first; it is read several times."""
    sessions, sides = _sides(comparisons)
    present = hist.groupBy("variable", "text").agg(_by_session(sessions, "present").alias("n"))
    each = F.array(*[F.struct(F.lit(name).alias("comparison"), _total("n", a).alias("n_reference"), _total("n", b).alias("n_comparison")) for name, a, b in sides])
    base = present.select("variable", F.when(F.col("text"), "categorielle").otherwise("numerique").alias("type"), F.explode(each).alias("c")).select("variable", "type", "c.*")
    ordered, on = Ordered(hist, sessions), ["variable", "comparison"]
    psi = _numeric(ordered, sides, bins).unionByName(_categorical(hist, sessions, sides, top, other))
    out = base.join(psi, on, "left").join(_distances(ordered, sides), on, "left")
    return out.withColumn("psi", F.coalesce("psi", F.lit(0.0))).withColumn("beyond", F.col("psi") >= limit)


def drift_report(df: DataFrame, session: str, numbers: Sequence[str], categories: Sequence[str], comparisons: Comparisons, families: dict[str, str] | None = None, **more) -> DataFrame:
    """drift() of all variables, written, with each one's family: that of families (target, prediction), else "variable"."""
    hist = stored_histogram(df, session, numbers, categories)
    family = F.coalesce(F.create_map(*[F.lit(x) for item in (families or {}).items() for x in item])[F.col("variable")], F.lit("variable")) if families else F.lit("variable")
    return _stored(drift(hist, comparisons, **more).withColumn("family", family), "drift")


def retraining(report: DataFrame, production: Sequence[str], limit: float = 0.2) -> DataFrame:
    """comparison, median_psi of the variables, whether it, a target or a prediction lies beyond the limit; retrain: does any
    production comparison ask for it? A single variable beyond the limit is shown by worst(), and asks for nothing."""
    of = F.col("comparison").isin(*production)
    beyond = lambda family: F.coalesce(F.bool_or(F.when(F.col("family") == family, F.col("beyond"))), F.lit(False))
    median = F.median(F.when(F.col("family") == "variable", F.col("psi"))).alias("median_psi")
    rows = report.where(of).groupBy("comparison").agg(median, beyond("target").alias("target"), beyond("prediction").alias("prediction"))
    rows = rows.withColumn("variables", F.coalesce(F.col("median_psi") >= limit, F.lit(False)))
    asks = F.bool_or(F.col("variables") | F.col("target") | F.col("prediction")).over(Window.partitionBy(F.lit(0)))  # a row a comparison
    return rows.withColumn("retrain", asks)


def worst(report: DataFrame, comparison: str, k: int = 15) -> DataFrame:
    """The k variables of a comparison that drifted most, the most drifted first; ties by name."""
    return report.where((F.col("comparison") == comparison) & (F.col("family") == "variable")).orderBy(F.desc("psi"), "variable").limit(k)


def _two(df: DataFrame, variable: str, side: str, numbers: str | None, category: str | None) -> DataFrame:
    """Histogram of rows that are unpivoted already, with side as their session."""
    value = (F.col(numbers) if numbers else F.lit(None)).cast("double")
    key = category_key(category) if category else F.lit(None).cast("string")
    rows = df.select(F.col(variable).alias("variable"), F.lit(category is not None).alias("text"), F.col(side).alias("session"), value.alias("value"), key.alias("category"))
    counts = rows.groupBy("variable", "text", "session", "value", "category").agg(F.count(F.lit(1)).alias("n"))
    return _stored(counts.withColumn("present", F.col("n")), "histogram")


_BOTH: Comparisons = {"": ([True], [False])}


def psi_numeric(df: DataFrame, variable: str, side: str, value: str, bins: int = 10) -> DataFrame:
    """Stability index of each variable. side: true for the reference, whose deciles (equal ones merged, ends open, (a, b]) are the
    bins. A constant or empty side gives 0."""
    return drift(_two(df, variable, side, value, None), _BOTH, bins).select(F.col("variable").alias(variable), "psi")


def psi_categorical(df: DataFrame, variable: str, side: str, category: str, top: int = 20, other: str = "__autre__") -> DataFrame:
    """Over the reference's most frequent categories (ties by name) and one cell for the rest. Categories are compared without
    accents, case and separators; a missing one is a category like others."""
    sessions, sides = _sides(_BOTH)
    found = _categorical(_two(df, variable, side, None, category), sessions, sides, top, other)
    return df.select(variable).distinct().join(found.select(F.col("variable").alias(variable), "psi"), variable, "left").withColumn("psi", F.coalesce("psi", F.lit(0.0)))


def ks(df: DataFrame, variable: str, side: str, value: str) -> DataFrame:
    """Largest distance of the two distribution functions of each variable; null if a side is empty."""
    sessions, sides = _sides(_BOTH)
    return _distances(Ordered(_two(df, variable, side, value, None), sessions), sides).select(F.col("variable").alias(variable), "ks")
