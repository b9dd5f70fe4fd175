"""Distributed model fitting: boosted trees, isotonic calibration, grids, ablation, learning curves.

Features are indexed and assembled once and written; every fit of a grid reads them, several side by side. A fit keeps the rounds whose
weighted absolute error on the validation set is least, of the predictions as they are served (clipped, an anchor added)."""

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clip01, recency_weight
from ..sources.tables import scratch
from .features import model_matrix
from .metrics import calibration, calibration_error, choose_candidate, errors
from .reconcile import placed_strata, share_of

#: Rounds that a fit tries. `stopped` tells whether the least error came before the last of them.
MOST_ROUNDS, STEP, SIDE_BY_SIDE = 40, 0.2, 4


def _absent(c: str) -> str:
    return f"{c}__absent"


@dataclass
class Features:
    """Indexers and assembler fitted to training rows; layout: the columns behind each place of the vector."""

    stages: PipelineModel
    numeric: list[str]
    categories: list[str]

    @classmethod
    def fit(cls, train: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> "Features":
        stages = [StringIndexer(inputCols=list(categories), outputCols=[f"{c}__i" for c in categories], handleInvalid="keep")] if categories else []  # one pass
        stages.append(VectorAssembler(inputCols=[*numeric, *map(_absent, numeric), *[f"{c}__i" for c in categories]], outputCol="features"))
        return cls(Pipeline(stages=stages).fit(model_matrix(train, numeric, categories)), list(numeric), list(categories))

    @property
    def layout(self) -> list[str]:
        return [*self.numeric, *self.numeric, *self.categories]

    def assembled(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """keep, as given, and features."""
        own = (*self.numeric, *self.categories)
        rows = df.withColumns({f"_keep_{c}": F.col(c) for c in keep if c in own})
        kept = [f"_keep_{c}" if c in own else c for c in keep]
        out = self.stages.transform(model_matrix(rows, self.numeric, self.categories, kept))
        return out.select(*[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], "features")

    def written(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return _written(self.assembled(df, keep), "features")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged_rows(df: DataFrame, by: str, y: str, w: str) -> DataFrame:
    """by, y (its weighted mean), w (its sum): rows that are alike in by as one. Fits by squares see no difference: what they choose depends
    on sums of w and w x y alone, the squares of y being a constant of them all. Rows without y, w or weight go."""
    rows = df.where(F.col(y).isNotNull() & (F.col(w) > 0))
    whole = F.sum(F.col(w).cast("double"))
    return rows.groupBy(by).agg((F.sum(F.col(y).cast("double") * F.col(w)) / whole).alias(y), whole.alias(w))


def truncated(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of its first rounds."""
    from pyspark import SparkContext

    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml.regression
    trees, weights = gateway.new_array(ml.DecisionTreeRegressionModel, rounds), gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = model._java_obj.trees()[i], float(model.treeWeights[i])
    out = GBTRegressionModel(ml.GBTRegressionModel(model._java_obj.uid(), trees, weights))
    return out.setFeaturesCol("features").setPredictionCol("_p")


def staged_errors(model: GBTRegressionModel, rows: DataFrame, y: str, w: str, anchor: str | None = None) -> list[float]:
    """Weighted mean absolute error after each round, of predictions as served: one pass over rows (features, y, w, anchor).

    Every tree predicts once for each different vector of features; running sums give the predictions of all rounds, and rows that are alike
    in features, y and anchor count as one."""
    rows, base = rows.where(F.col(y).isNotNull() & F.col(w).isNotNull()), F.col(anchor) if anchor else F.lit(0.0)
    alike = rows.groupBy("features", F.col(y).alias("_y"), base.cast("double").alias("_base")).agg(F.sum(F.col(w).cast("double")).alias("_w"))
    alike = _written(alike, "alike")
    each, names = alike.select("features").distinct(), []
    for i, tree in enumerate(model.trees):
        names.append(f"_t{i}")
        each = tree.setFeaturesCol("features").setPredictionCol(names[-1]).transform(each)
    values = F.array(*[F.col(n) * F.lit(float(t)) for n, t in zip(names, model.treeWeights, strict=True)])
    run = F.aggregate(values, F.array().cast("array<double>"), lambda a, x: F.array_append(a, x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0.0))))
    after = alike.join(_written(each.select("features", run.alias("_run")), "runs"), "features")
    error = lambda i: F.sum(F.abs(F.col("_y") - clip01(F.col("_base") + F.col("_run")[i])) * F.col("_w")) / F.sum("_w")
    return list(after.agg(F.array(*[error(i) for i in range(len(names))]).alias("errors")).first().errors)  # a number a round


@dataclass
class Boosted:
    """Trees up to the best round, and the errors of all rounds that were tried."""

    model: GBTRegressionModel
    errors: list[float]

    @property
    def rounds(self) -> int:
        return len(self.model.trees)

    @property
    def stopped(self) -> bool:
        return self.rounds < len(self.errors)


def fit_trees(
    train: DataFrame, validation: DataFrame | None, y: str, w: str, target: str | None = None, anchor: str | None = None,
    rounds: int = MOST_ROUNDS, depth: int = 3, seed: int = 1, step: float = STEP,
) -> Boosted:
    """Weighted trees on rows with features. With a validation set: the rounds of least weighted absolute error in y there; without,
    all rounds. target: what the trees fit, if not y: its gap to the anchor."""
    target = target or y
    rows = _written(merged_rows(train, "features", target, w), "merged")
    model = GBTRegressor(labelCol=target, weightCol=w, featuresCol="features", predictionCol="_p", maxIter=rounds, maxDepth=depth, seed=seed, maxBins=64, stepSize=step).fit(rows)
    if validation is None:
        return Boosted(model, [])
    found = staged_errors(model, validation, y, w, anchor)
    return Boosted(truncated(model, found.index(min(found)) + 1), found)


def fit_boosted(
    train: DataFrame, validation: DataFrame | None, numeric: Sequence[str], categories: Sequence[str], y: str, w: str,
    rounds: int = MOST_ROUNDS, depth: int = 3, seed: int = 1, step: float = STEP,
) -> PipelineModel:
    """fit_trees() with its features as one model, for predict()."""
    features = Features.fit(train, numeric, categories)
    rows, held = (None if df is None else features.written(df, [y, w]) for df in (train, validation))
    return PipelineModel([*features.stages.stages, fit_trees(rows, held, y, w, rounds=rounds, depth=depth, seed=seed, step=step).model])


def predict(model, df: DataFrame, numeric: Sequence[str], categories: Sequence[str], keep: Sequence[str], name: str = "prediction") -> DataFrame:
    """keep and the clipped prediction of fit_boosted()'s model."""
    return served(model.stages[-1], Features(PipelineModel(model.stages[:-1]), list(numeric), list(categories)).assembled(df, keep), keep, name)


def served(model, rows: DataFrame, keep: Sequence[str], name: str = "prediction", anchor: str | None = None) -> DataFrame:
    """keep and the clipped prediction of rows with features; with an anchor, the model's value is a gap to it."""
    out = model.transform(rows)
    return out.select(*keep, clip01(F.col("_p") if anchor is None else F.col("_p") + F.col(anchor)).alias(name))


def _side_by_side(tasks: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """Run fits at the same time, a few; their rows together."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        parts = list(pool.map(lambda f: f(), tasks))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fit_isotonic(df: DataFrame, p: str, y: str, w: str):
    return IsotonicRegression(featuresCol=p, labelCol=y, weightCol=w, predictionCol="_iso").fit(merged_rows(df.where(F.col(p).isNotNull()), p, y, w))


def calibrate(model, df: DataFrame, p: str, name: str) -> DataFrame:
    return model.transform(df).withColumn(name, clip01("_iso")).drop("_iso")


def calibrated_out_of_fold(df: DataFrame, p: str, y: str, w: str, group: str, folds: int = 3, name: str = "calibrated") -> DataFrame:
    """Each row calibrated by a fit that saw no row of its group."""
    rows = df.withColumn("_fold", F.pmod(F.xxhash64(group), F.lit(folds)))
    parts = [calibrate(fit_isotonic(rows.where(F.col("_fold") != k), p, y, w), rows.where(F.col("_fold") == k), p, name) for k in range(folds)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("_fold")


def scores(df: DataFrame, y: str, p: str, w: str, variant: str, group: str | None = None) -> DataFrame:
    """variant, mae_weighted, mae, ece, and with a group the largest calibration error of its groups."""
    ece = calibration_error(calibration(df, y, p, w))
    columns = ["mae_weighted", "mae", "ece"]
    if group:
        by_group = calibration_error(calibration(df, y, p, w, by=[group]), [group]).agg(F.max("ece").alias("group_ece"))
        ece, columns = ece.crossJoin(by_group), [*columns, "group_ece"]  # one row each
    return errors(df, y, p, w).crossJoin(ece).select(F.lit(variant).alias("variant"), *columns)  # one row each


#: Half-lives of the training weights by session; None is no decay.
HALF_LIVES = (None, 1, 2, 3)


def grid(
    train: DataFrame, validation: DataFrame, numeric, categories, y: str, w: str, session: str, fold: str, group: str, anchor: str,
    reference: int, half_lives: Sequence[float | None] = HALF_LIVES, rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """Every recency setting by both targets (the rate, and its gap to an anchor), with and without calibration, scored on the
    validation set, on which each fit stops: variant, errors, rounds, stopped."""
    features = Features.fit(train, numeric, categories)
    rows = features.written(train, [y, w, session, anchor])
    held = features.written(validation, [y, w, fold, group, anchor])

    def fit(half_life, gap: bool) -> DataFrame:
        weight = F.col(w) if half_life is None else F.col(w) * recency_weight(session, reference, half_life)
        own = rows.withColumn(w, weight).withColumn("_gap", F.col(y) - F.col(anchor))
        boosted = fit_trees(own, held, y, w, "_gap" if gap else None, anchor if gap else None, rounds)
        found = _written(served(boosted.model, held, [y, w, fold, group, anchor], anchor=anchor if gap else None), "found")
        calibrated = calibrated_out_of_fold(found, "prediction", y, w, fold)
        name = f"{'gap' if gap else 'rate'}, half-life {half_life or 'none'}"
        both = scores(found, y, "prediction", w, name, group).unionByName(scores(calibrated, y, "calibrated", w, f"{name}, calibrated", group))
        return both.withColumn("rounds", F.lit(boosted.rounds)).withColumn("stopped", F.lit(boosted.stopped))

    return _side_by_side([lambda h=h, g=g: fit(h, g) for h in half_lives for g in (False, True)])


def best_of(table: DataFrame) -> DataFrame:
    return choose_candidate(table, "mae_weighted", "ece", "group_ece", "variant")


def refit(train: DataFrame, validation: DataFrame, test: DataFrame, numeric, categories, y: str, w: str, keep: Sequence[str], rounds: int = MOST_ROUNDS) -> DataFrame:
    """Stop on the validation set, then fit that many rounds on both and predict the test set."""
    best = len(fit_boosted(train, validation, numeric, categories, y, w, rounds=rounds).stages[-1].trees)
    both = train.unionByName(validation)
    return predict(fit_boosted(both, None, numeric, categories, y, w, rounds=best), test, numeric, categories, keep)


def ablation(
    train: DataFrame, validation: DataFrame, test: DataFrame, numeric: Sequence[str], categories: Sequence[str], y: str, w: str,
    without: dict[str, Sequence[str]], rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """Scores on the test set of fits that leave columns out, beside the full one, and their differences from it; each stops on the
    validation set: variant, errors, rounds, stopped, delta_mae, delta_ece."""
    features = Features.fit(train, numeric, categories)
    frames = [features.written(df, [y, w]) for df in (train, validation, test)]

    def fit(name: str, left_out: Sequence[str]) -> DataFrame:
        places = [i for i, c in enumerate(features.layout) if c not in left_out]
        slicer = VectorSlicer(inputCol="_all", outputCol="features", indices=places)
        rows, held, asked = (slicer.transform(df.withColumnRenamed("features", "_all")).drop("_all") for df in frames)
        boosted = fit_trees(rows, held, y, w, rounds=rounds)
        part = scores(_written(served(boosted.model, asked, [y, w]), "found"), y, "prediction", w, name)
        return part.withColumn("rounds", F.lit(boosted.rounds)).withColumn("stopped", F.lit(boosted.stopped))

    out = _side_by_side([lambda n=n, x=x: fit(n, x) for n, x in {"all": (), **without}.items()])
    full = out.where("variant = 'all'").select(F.col("mae_weighted").alias("_mae"), F.col("ece").alias("_ece"))
    return out.crossJoin(full).select(*out.columns, (F.col("mae_weighted") - F.col("_mae")).alias("delta_mae"), (F.col("ece") - F.col("_ece")).alias("delta_ece"))  # one row


def learning_curve(
    train: DataFrame, validation: DataFrame, test: DataFrame, numeric, categories, y: str, w: str, session: str, key: Sequence[str],
    steps=(0.1, 0.25, 0.5, 1.0), rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """Scores on the test set of fits to a share of each session's rows, each stopped on the validation set."""
    features = Features.fit(train, numeric, categories)
    strata = placed_strata(features.written(train, list(dict.fromkeys([y, w, session, *key]))), session, key)  # once for all steps
    held, asked = (features.written(df, [y, w]) for df in (validation, test))

    def fit(step: float) -> DataFrame:
        boosted = fit_trees(share_of(strata, step), held, y, w, rounds=rounds)
        part = scores(_written(served(boosted.model, asked, [y, w]), "found"), y, "prediction", w, f"{step:g}")
        return part.withColumn("rounds", F.lit(boosted.rounds)).withColumn("stopped", F.lit(boosted.stopped))

    return _side_by_side([lambda x=x: fit(x) for x in steps])


def rmse(df: DataFrame, y: str, p: str) -> float:
    return RegressionEvaluator(labelCol=y, predictionCol=p, metricName="rmse").evaluate(df)
