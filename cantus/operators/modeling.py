"""MLlib pipelines: mood classifiers, score regressors, grid search, importances, learning curve."""

from __future__ import annotations

from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import MOODS, PROFILE, RECOMMENDER_FEATURES
from . import evaluate as E
from . import forests as W
from . import logistic as LR
from . import networks as N
from . import ranking as K
from .columns import attach

SEED = 42
MODEL_INPUTS = (*RECOMMENDER_FEATURES, *[f"proba_{m}" for m in MOODS], *[f"user_mood_{m}" for m in MOODS], *PROFILE)


class MacroF1(Evaluator, HasLabelCol, HasPredictionCol):
    """Unweighted mean F1 over the labels (the built-in ``f1`` weighs by support)."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label", predictionCol: str = "prediction", labels: list | None = None):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction")
        self.labels = labels or list(range(len(MOODS)))
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        rows = dataset.select(F.col(self.getLabelCol()).cast("int").alias("y"), F.col(self.getPredictionCol()).cast("int").alias("p"))
        return float(E.summary_report(rows, "y", "p", self.labels).first()["macro_f1"])

    def isLargerBetter(self) -> bool:
        return True


def modelling_split(train: DataFrame, test: DataFrame, features: list[str], label: str, classes: list,
                    strategy: str = "deduplicated", share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``prepared`` keeps the split; ``deduplicated`` unites, drops exact copies and splits again."""
    if strategy == "prepared":
        return train, test
    full = train.unionByName(test, allowMissingColumns=True).dropDuplicates([*features, label])
    marked = K.stratified_split(full, label, classes, [*features, label], share)
    return marked.filter("is_train").drop("is_train"), marked.filter("not is_train").drop("is_train")


def unlisted_classes(df: DataFrame, label: str, classes: list) -> DataFrame:
    """``label, rows``: rows that a split or fit leaves out because their class is not listed (null included)."""
    listed = F.coalesce(F.col(label).isin(classes), F.lit(False))
    return df.filter(~listed).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("rows"))


def balanced_weights(df: DataFrame, label: str, classes: list, to: str = "weight") -> DataFrame:
    """n / (classes * n_class) per row, by scalar subquery."""
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(label) == F.lit(c)).alias(f"c{i}") for i, c in enumerate(classes)])
    present = sum((F.when(F.col(f"_n.c{i}") > 0, 1).otherwise(0) for i in range(len(classes))), F.lit(0))
    own = F.coalesce(*[F.when(F.col(label) == F.lit(c), F.col(f"_n.c{i}")) for i, c in enumerate(classes)])
    return attach(df, counts, "_n").withColumn(to, F.col("_n.n") / (present * own)).drop("_n")


def _inputs(features: list[str], impute: bool = True):
    names = [f"{f}_imputed" for f in features] if impute else features
    stages = [Imputer(strategy="median", inputCols=features, outputCols=names)] if impute else []
    return [*stages, VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")]


def classifier_pipeline(kind: str, features: list[str], label: str, weight: str | None = "weight", total_weight: float = 1.0, **params) -> Pipeline:
    """``logistic_regression`` (C, fit_intercept) or ``random_forest`` (trees, depth, leaf)."""
    weigh = {"weightCol": weight} if weight else {}
    if kind == "logistic_regression":
        model = LogisticRegression(
            labelCol=label, maxIter=params.get("max_iter", 200), elasticNetParam=0.0, standardization=False, family="multinomial",
            regParam=1.0 / (params.get("C", 1.0) * max(total_weight, 1.0)), fitIntercept=params.get("fit_intercept", True), **weigh,
        )
    else:
        depth = params.get("max_depth")
        if depth is not None and depth > 30:
            raise ValueError("trees are at most 30 deep")
        model = RandomForestClassifier(
            labelCol=label, numTrees=params.get("n_trees", 200), maxDepth=30 if depth is None else depth,
            minInstancesPerNode=params.get("min_leaf", 1), seed=SEED, **weigh,
        )
    return Pipeline(stages=[*_inputs(features), model])


class NetworkModel(Model):
    """A trained network as the last stage of a pipeline."""

    def __init__(self, network: N.Network):
        super().__init__()
        self.network = network

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.network.transform(dataset)


class NetworkRegressor(Estimator):
    """One candidate of ``networks`` as a stage: it scales its inputs itself and stops early on held-out rows, told by their inputs."""

    def __init__(self, features: list[str], label: str, spec: N.Spec, **options):
        super().__init__()
        self.features, self.label, self.spec, self.options = features, label, spec, options

    def _fit(self, dataset: DataFrame) -> NetworkModel:
        return NetworkModel(N.fit_networks(dataset, self.features, self.label, [self.spec], self.features, **self.options)[0])


def regressor_pipeline(kind: str, features: list[str], label: str = "target_score", **params) -> Pipeline:
    """``random_forest``, ``gbt`` or ``mlp`` (hidden, alpha, rate; further options go to ``networks.fit_networks``)."""
    if kind == "mlp":
        spec = N.Spec(**{c: params.pop(c) for c in ("hidden", "alpha", "rate") if c in params})
        return Pipeline(stages=[NetworkRegressor(features, label, spec, **params)])
    common = {"labelCol": label, "maxDepth": params.get("max_depth", 5), "minInstancesPerNode": params.get("min_leaf", 1), "seed": SEED}
    if kind == "random_forest":
        model = RandomForestRegressor(numTrees=params.get("n_trees", 200), **common)
    else:
        model = GBTRegressor(maxIter=params.get("max_iter", 20), stepSize=params.get("step", 0.1), **common)
    return Pipeline(stages=[*_inputs(features, impute=False), model])


class ForestModel(Model):
    """A forest of ``forests`` as the last stage of a pipeline."""

    def __init__(self, forest: W.Forest):
        super().__init__()
        self.forest = forest

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.forest.importances())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        n = len(self.forest.classes)
        told = self.forest.transform(dataset, "_share")
        shares = array_to_vector(F.array(*[F.col(f"_share{i}") for i in range(n)]))
        return told.withColumns({"probability": shares, "prediction": F.col("prediction").cast("double")}).drop(*[f"_share{i}" for i in range(n)])


class ForestClassifier(Estimator):
    """One point of the forest grid: ``balanced`` classes weigh alike over all bags, ``balanced_subsample`` inside every bag."""

    def __init__(self, features: list[str], label: str, classes: list, key: list[str], n_trees: int = 200, max_depth: int | None = None,
                 min_leaf: int = 1, class_weight: str = "balanced"):
        super().__init__()
        if max_depth is not None and max_depth > 30:
            raise ValueError("trees are at most 30 deep")
        if class_weight not in ("balanced", "balanced_subsample"):
            raise ValueError(f"unknown class weight {class_weight}")
        self.data = (features, label, classes, key)
        self.n_trees, self.depth, self.min_leaf, self.class_weight = n_trees, 30 if max_depth is None else max_depth, min_leaf, class_weight

    def _fit(self, dataset: DataFrame) -> ForestModel:
        per_bag = self.class_weight == "balanced_subsample"
        return ForestModel(W.fit_forest(dataset, *self.data, n_trees=self.n_trees, max_depth=self.depth, min_leaf=self.min_leaf, per_bag=per_bag))


def _forest_points(models: list[ForestClassifier], train: DataFrame, held: DataFrame) -> DataFrame:
    """All points' predictions of the held-out rows, ``_p0``, ``_p1`` and on.

    Points that differ in trees and depth only are parts of the largest forest among them, which is fitted once.
    """
    groups: dict[tuple, list[int]] = {}
    for i, m in enumerate(models):
        groups.setdefault((m.min_leaf, m.class_weight), []).append(i)
    for (leaf, weight), own in groups.items():
        points = [(models[i].n_trees, models[i].depth) for i in own]
        largest = ForestClassifier(*models[own[0]].data, max(n for n, _ in points), max(d for _, d in points), leaf, weight)
        told = largest.fit(train).forest.predictions(held, points)
        held = told.withColumnsRenamed({f"_p{j}": f"_point{i}" for j, i in enumerate(own)})
    return held.withColumnsRenamed({f"_point{i}": f"_p{i}" for i in range(len(models))})


def param_sets(options: dict[str, list]) -> list[dict]:
    return [dict(zip(options, values)) for values in product(*options.values())]


CLASSIFIER_GRID = {
    "logistic_regression": {"C": [0.1, 1.0, 10.0], "fit_intercept": [True, False]},
    "random_forest": {"n_trees": [200, 400], "max_depth": [None, 10, 20], "min_leaf": [1, 3], "class_weight": ["balanced", "balanced_subsample"]},
}
REGRESSOR_GRID = {
    "random_forest": {"n_trees": [200, 400], "max_depth": [12, 30], "min_leaf": [1, 3]},
    "gbt": {"max_depth": [5, 8], "max_iter": [20, 50]},
    "mlp": N.NETWORK_GRID,
}


def _prepared(pipelines: list, train: DataFrame, held: DataFrame):
    """(what is left to fit of each pipeline, training rows, held-out rows) once the stages they share are fitted."""
    if not all(isinstance(p, Pipeline) for p in pipelines):
        return pipelines, train, held
    fixed = lambda p: [(type(s), {q.name: v for q, v in s.extractParamMap().items() if s.isSet(q)}) for s in p.getStages()[:-1]]
    if any(fixed(p) != fixed(pipelines[0]) for p in pipelines):
        return pipelines, train, held
    shared = Pipeline(stages=pipelines[0].getStages()[:-1]).fit(train)
    return [p.getStages()[-1] for p in pipelines], shared.transform(train), shared.transform(held)


def _read_by(models: list, df: DataFrame) -> DataFrame:
    """The columns that fits of the models read; all, when a model does not tell."""
    if not all(hasattr(m, "getFeaturesCol") and hasattr(m, "getLabelCol") for m in models):
        return df
    weights = [m.getWeightCol() for m in models if m.hasParam("weightCol") and m.isDefined("weightCol") and m.getWeightCol()]
    names = dict.fromkeys([*(m.getFeaturesCol() for m in models), *(m.getLabelCol() for m in models), *weights])
    return df.select(*[F.col(f"`{c}`") for c in names])


def grid_search(df: DataFrame, make, options: dict[str, list], evaluator: Evaluator, fold: str = "fold", k: int = 3,
                parallelism: int = 2, weigh=None):
    """Cross-validate every parameter set on a fixed fold column and refit the best on all rows.

    ``weigh`` adds the weight column from the rows it is given: those of a fold's training side, so that
    no fit sees the classes of its held-out rows.  Stages before the model that are alike for all
    parameter sets (medians, assembly) are fitted once per fold, and their rows kept; logistic
    parameter sets then share the passes of their fits (``logistic``), forests of ``forests`` their trees.
    Returns (best model, rows of (params, mean metric)).
    """
    keep = weigh is not None or not df.is_cached
    weigh = weigh or (lambda rows: rows)
    sets = param_sets(options)
    pool, metrics = ThreadPool(parallelism), [0.0] * len(sets)
    try:
        for i in range(k):
            train, held = weigh(df.filter(F.col(fold) != i)), df.filter(F.col(fold) == i)
            models, ready, rest = _prepared([make(**p) for p in sets], train, held)
            ready = _read_by(models, ready) if ready is not train else ready
            points = LR.fit_points(ready, models) if LR.sharable(models) else None
            trees = all(isinstance(m, ForestClassifier) for m in models)
            kept = ready if keep else None
            if points or trees:  # the rows that they were fitted on are gone
                told = LR.scored(rest, points) if points else _forest_points(models, ready, rest)
                kept = told.select(*held.columns, *[f"_p{j}" for j in range(len(sets))])
            if kept is not None:
                kept.persist()
            try:
                if points or trees:
                    one = lambda at: evaluator.evaluate(kept.withColumnRenamed(f"_p{at}", evaluator.getPredictionCol()))  # noqa: B023, E731
                else:
                    one = lambda at: evaluator.evaluate(models[at].fit(ready).transform(rest))  # noqa: B023, E731
                metrics = [m + found / k for m, found in zip(metrics, pool.map(inheritable_thread_target(df.sparkSession)(one), range(len(sets))))]
            finally:
                if kept is not None:
                    kept.unpersist()
    finally:
        pool.close()
    best = max(range(len(sets)), key=lambda i: metrics[i] if evaluator.isLargerBetter() else -metrics[i])
    return fit(make(**sets[best]), weigh(df)), [(str(p), float(m)) for p, m in zip(sets, metrics)]


def cv_table(spark, model: str, results: list[tuple[str, float]], metric: str) -> DataFrame:
    return spark.createDataFrame([(model, p, v) for p, v in results], f"model string, params string, {metric} double")


def fit(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """Fit on a persisted copy, as every iteration reads it again; the caller's own stays kept."""
    if df.is_cached:
        return pipeline.fit(df)
    kept = df.persist()
    try:
        return pipeline.fit(kept)
    finally:
        kept.unpersist()


def search_classifiers(df: DataFrame, features: list[str], label: str, classes: list, key: list[str], grids: dict = CLASSIFIER_GRID, k: int = 3):
    """Stratified k-fold macro-F1 search over all classifier kinds: {kind: (model, results)}."""
    # what no fit reads is not kept
    own_key = F.xxhash64(*[F.col(f"`{c}`") for c in key]).alias("_key")  # bags draw by it
    folds = K.fold_column(df, key, k, label, classes).select(*features, label, "fold", *([own_key] if "random_forest" in grids else [])).persist()
    total = float(folds.count()) * (k - 1) / k  # balanced weights sum to the rows, of which a fit sees k - 1 folds
    evaluator = MacroF1(labelCol=label, labels=classes)

    def make(kind: str):
        if kind == "random_forest":
            return lambda **p: Pipeline(stages=[ForestClassifier(features, label, classes, ["_key"], **p)])
        return lambda **p: classifier_pipeline(kind, features, label, total_weight=total, **p)

    try:
        weigh = lambda rows: balanced_weights(rows, label, classes)
        return {kind: grid_search(folds, make(kind), options, evaluator, k=k, weigh=weigh) for kind, options in grids.items()}
    finally:
        folds.unpersist()


def search_regressors(df: DataFrame, key: list[str], features: tuple[str, ...] = MODEL_INPUTS, label: str = "target_score",
                      grids: dict = REGRESSOR_GRID, k: int = 3):
    # what no fit reads is not kept; one fit at a time has the memory for its own copy of the rows
    folds = K.fold_column(df, key, k).select(*features, label, "fold").persist()
    evaluator = RegressionEvaluator(labelCol=label, metricName="rmse")
    make = lambda kind: lambda **p: regressor_pipeline(kind, list(features), label, **p)
    try:
        return {kind: grid_search(folds, make(kind), options, evaluator, k=k, parallelism=1) for kind, options in grids.items()}
    finally:
        folds.unpersist()


def score_classifier(model: PipelineModel, df: DataFrame, n_classes: int, prefix: str = "p") -> DataFrame:
    """Prediction as int plus one probability column per class."""
    values = vector_to_array(F.col("probability"))
    scored = model.transform(df)
    extra = [c for c in scored.columns if c.endswith("_imputed")]
    out = scored.withColumns({f"{prefix}{i}": F.get(values, F.lit(i)) for i in range(n_classes)})
    return out.withColumn("prediction", F.col("prediction").cast("int")).drop("features", "rawPrediction", "probability", *extra)


def score_facts(scored: DataFrame, label: str, classes: list, prefix: str = "p") -> DataFrame:
    """``(label, rows, sums_to_one, takes_largest)`` of ``score_classifier``'s rows: what holds for any fitted model."""
    shares = [F.col(f"{prefix}{i}") for i in range(len(classes))]
    chosen = F.get(F.array(*shares), F.col("prediction"))
    return scored.groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("rows"), F.bool_and(F.abs(sum(shares[1:], shares[0]) - 1) < 1e-9).alias("sums_to_one"),
        F.bool_and(chosen >= F.greatest(*shares)).alias("takes_largest"),
    )


def as_score_model(model: PipelineModel):
    """A regressor as the ``model`` argument of the recommender."""
    return lambda df: model.transform(df).withColumn("model_prediction", F.col("prediction")).drop("features", "prediction")


def importances(model: PipelineModel, features: list[str], spark) -> DataFrame:
    """Tree importances, or mean absolute coefficients over the classes."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = [float(x) for x in last.featureImportances.toArray()]
    else:
        matrix = abs(last.coefficientMatrix.toArray())
        values = [float(x) for x in matrix.mean(axis=0)]
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def learning_curve(df: DataFrame, make, evaluator: Evaluator, key: list[str], label: str, classes: list, k: int = 3,
                   shares: tuple[float, ...] = (0.2, 0.4, 0.6, 0.8, 1.0), weigh=None) -> list[tuple[float, int, float, float]]:
    """(share, fold, train metric, validation metric): fits on growing hash prefixes of each fold's rest.

    ``weigh`` adds the weight column from the rows of each fit alone.
    """
    weigh = weigh or (lambda rows: rows)
    folds = K.fold_column(df, key, k, label, classes).persist()
    out = []
    for fold in range(k):
        rest, held = folds.filter(F.col("fold") != fold), folds.filter(F.col("fold") == fold)
        for share in shares:
            part = weigh(rest if share >= 1.0 else K.sample_share(rest, key, share, "curve"))
            model = make().fit(part)
            out.append((share, fold, evaluator.evaluate(model.transform(part)), evaluator.evaluate(model.transform(held))))
    folds.unpersist()
    return out
