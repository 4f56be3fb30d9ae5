"""Model steps on MLlib: scoring, importances, model-based imputation, cross-validation and tuning."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import decide, numeric_columns, percent_score
from riskloom.operators.encode import class_weights
from riskloom.operators.metrics import confusion, evaluate_at_threshold, ranking_metrics, with_threshold_metrics
from riskloom.operators.sampling import stratified_folds, train_validation_split
from riskloom.session import checkpointed, dealt

FEATURES = "__features"
CONCURRENT = 4  # fits at a time
# rows of a task of a fit: every task sends the statistics of all nodes, so there are fewer and larger ones
FEW_FITTED, MANY_FITTED = 25_000, 100_000


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")


# what a tree sees for a missing value: below every true one, so that a split can part them
MISSING = -1e30


def as_features(df: DataFrame, features: Sequence[str], missing: float = MISSING) -> DataFrame:
    """Feature columns as doubles; missing values become a value of their own, never a true 0."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(missing)) for c in features})


HOLD = "__hold"


def kept_vectors(df: DataFrame, features: Sequence[str], keep: Sequence[str], label: str | None = None) -> DataFrame:
    """The kept columns and all features as one vector, assembled once and checkpointed.

    Every fit reads this table: however many features there are, its plan has a handful of columns. With a
    ``label``, rows without one are left out, the label becomes a double and a tenth of the rows, chosen by a
    hash of their values, is marked as held out.
    """
    values = "array(" + ", ".join(f"coalesce(cast(`{c}` as double), {MISSING!r}D)" for c in features) + ")"
    rows = df if label is None else df.filter(F.col(label).isNotNull())
    kept = [f"cast(`{c}` as double) AS `{c}`" if c == label else f"`{c}`" for c in keep]
    rows = rows.selectExpr(*kept, f"{values} AS __values")
    marks = [] if label is None else [(F.pmod(F.xxhash64("__values", label), F.lit(10)) == 0).alias(HOLD)]
    return checkpointed(rows.select(*keep, *marks, array_to_vector("__values").alias(FEATURES)))


def balanced(df: DataFrame, label: str, weight: str = "__weight") -> DataFrame:
    """Balanced class weights as a column: two literals, no join."""
    table = {r[label]: r["weight"] for r in class_weights(df, label).collect()}  # one row per class
    out = None
    for k, w in table.items():
        out = F.when(F.col(label) == k, F.lit(w)) if out is None else out.when(F.col(label) == k, F.lit(w))
    return df.withColumn(weight, out if out is not None else F.lit(1.0))


def scaled_vectors(vectors: DataFrame, fitted: Sequence[tuple[float, float]]) -> DataFrame:
    """Vectors centred and scaled by a (mean, deviation) per feature, with 0 where a value is missing."""
    means, devs = (F.array(*[F.lit(float(v)) for v in values]) for values in zip(*fitted, strict=True))
    values = vector_to_array(FEATURES)
    centred = F.zip_with(values, means, lambda x, m: F.when(x != F.lit(MISSING), x - m).otherwise(F.lit(0.0)))
    scaled = F.zip_with(centred, devs, lambda x, d: x / d)
    return checkpointed(vectors.withColumn(FEATURES, array_to_vector(scaled)))


def fit_vectors(rows: DataFrame, features: Sequence[str], estimator: Estimator) -> PipelineModel:
    """Fit on rows of ``kept_vectors``. Boosting ends where the held-out tenth stops gaining; a table so small
    that the tenth is empty is boosted for all rounds. The result takes plain feature columns."""
    if isinstance(estimator, (GBTClassifier, GBTRegressor)) and estimator.isDefined(estimator.validationIndicatorCol):
        seen = rows.agg(F.count_if(HOLD).alias("held"), F.count_if(~F.col(HOLD)).alias("rest")).first()
        if not seen["held"] or not seen["rest"]:
            estimator = estimator.copy()
            estimator.clear(estimator.validationIndicatorCol)
    return PipelineModel(stages=[assembler(features), estimator.fit(rows)])


def fit(rows: DataFrame, features: Sequence[str], label: str, estimator: Estimator) -> PipelineModel:
    return fit_vectors(kept_vectors(rows, features, [label], label), features, estimator)


def fit_classifier(df: DataFrame, features: Sequence[str], label: str, estimator: Estimator) -> PipelineModel:
    """Fit on the feature columns; the column ``__weight`` (see ``balanced``) weighs the rows."""
    return fit_vectors(kept_vectors(df, features, [label, "__weight"], label), features, estimator)


def boosted_classifier(label: str, rounds: int = 10_000, depth: int = 5, rate: float = 0.1, seed: int = 0) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol="__weight", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed,
        validationIndicatorCol=HOLD, validationTol=0.01,
    )


def forest_classifier(label: str, trees: int = 100, depth: int = 5, seed: int = 0) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol="__weight", numTrees=trees, maxDepth=depth, seed=seed
    )


def boosted_regressor(label: str, rounds: int, depth: int, rate: float, seed: int = 0) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=FEATURES, labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed,
        validationIndicatorCol=HOLD, validationTol=0.01,
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Keep a fitted pipeline in a folder all executors share."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def probability(df: DataFrame, model: Model, features: Sequence[str], name: str = "probability") -> DataFrame:
    """Class-1 probability of every row; a narrow step that also runs on a stream."""
    scored = model.transform(as_features(df.select(*df.columns, *[F.col(c).alias(f"__in_{c}") for c in features]), features))
    keep = [F.col(f"__in_{c}").alias(c) if c in set(features) else F.col(c) for c in df.columns]
    return scored.select(*keep, vector_to_array("probability")[1].alias(name))


def score(df: DataFrame, model: Model, features: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Probability, percent score and decision per client."""
    return probability(df, model, features, "proba").withColumns(
        {"credit_score": percent_score("proba"), "prediction": decide("proba", threshold)}
    )


# -- importances ---------------------------------------------------------------------------------


def importance(
    df: DataFrame, key: str, features: Sequence[str], label: str, estimator: Estimator, runs: int = 1, seed: int = 0
) -> DataFrame:
    """Importance per feature, averaged over ``runs`` seeded 75 % training splits with balanced classes.

    MLlib reports impurity gain for both model kinds (no split counts).
    """
    return vector_importance(kept_vectors(df, features, [key, label], label), key, features, label, estimator, runs, seed)


def vector_importance(
    vectors: DataFrame, key: str, features: Sequence[str], label: str, estimator: Estimator, runs: int = 1, seed: int = 0
) -> DataFrame:
    """The same on rows of ``kept_vectors``, which several models may share."""
    total = [0.0] * len(features)
    for i in range(runs):
        train, _ = train_validation_split(vectors, key, 0.25, seed + i)
        model = fit_vectors(balanced(train, label), features, estimator)
        values = model.stages[-1].featureImportances.toArray()
        total = [t + float(v) / runs for t, v in zip(total, values, strict=True)]
    return df_of(vectors, features, total)


def df_of(like: DataFrame, features: Sequence[str], values: Sequence[float]) -> DataFrame:
    return like.sparkSession.createDataFrame(list(zip(features, values, strict=True)), "feature string, importance double")


def importance_boosted(df, key, features, label, runs: int = 1, seed: int = 0, **params) -> DataFrame:
    return importance(df, key, features, label, boosted_classifier(label, seed=seed, **params), runs, seed)


def importance_forest(df, key, features, label, runs: int = 1, seed: int = 0, **params) -> DataFrame:
    return importance(df, key, features, label, forest_classifier(label, seed=seed, **params), runs, seed)


# -- model-based values --------------------------------------------------------------------------


def chained_model_impute(
    train: DataFrame,
    others: Sequence[DataFrame],
    targets: Sequence[str],
    exclude: Sequence[str] = (),
    rounds: int = 1000,
    depth: int = 3,
    rate: float = 0.1,
) -> list[DataFrame]:
    """Predict missing values of each target column from the numeric columns all tables share.

    Targets are given from the fewest missing values to the most; each filled column becomes a
    feature of the next model.
    """
    tables = [train, *others]
    shared = set.intersection(*[set(numeric_columns(t)) for t in tables])
    features = [c for c in numeric_columns(train, exclude) if c in shared and c not in set(targets)]
    for target in targets:
        known = train if target == targets[0] else tables[0]
        model = fit(known.withColumn("__y", F.col(target).cast("double")), features, "__y", boosted_regressor("__y", rounds, depth, rate))
        tables = [_fill_predicted(t, model, features, target) for t in tables]
        features = [*features, target]
    return tables


def _fill_predicted(df: DataFrame, model: PipelineModel, features: Sequence[str], target: str) -> DataFrame:
    predicted = model.transform(as_features(df.select(*df.columns, *[F.col(c).alias(f"__in_{c}") for c in features]), features))
    keep = []
    for c in df.columns:
        if c == target:
            keep.append(F.coalesce(F.col(c).cast("double"), F.col("prediction")).alias(c))
        else:
            keep.append(F.col(f"__in_{c}").alias(c) if c in set(features) else F.col(c))
    return predicted.select(*keep)


def expected_terms(
    previous: DataFrame,
    applications: Sequence[DataFrame],
    name: str = "EXPECTED_CNT_PAYMENT",
    rounds: int = 5000,
    depth: int = 9,
    rate: float = 0.3,
) -> list[DataFrame]:
    """Learn the number of payments from credit, annuity and their ratio; predict it for applications."""
    features = ["__credit", "__annuity", "__ratio"]

    def inputs(df: DataFrame, fill: bool) -> DataFrame:
        credit, annuity = F.col("AMT_CREDIT").cast("double"), F.col("AMT_ANNUITY").cast("double")
        if fill:
            credit, annuity = F.coalesce(credit, F.lit(0.0)), F.coalesce(annuity, F.lit(0.0))
        return df.withColumns({"__credit": credit, "__annuity": annuity}).withColumn(
            "__ratio", F.try_divide(F.col("__credit"), F.col("__annuity") + F.lit(1.0))
        )

    known = inputs(previous.select("AMT_CREDIT", "AMT_ANNUITY", "CNT_PAYMENT").dropna(), fill=False)
    # a few bytes of a loan on disk become a vector that every round reads, so loans are dealt by their number
    rows = dealt(known.withColumn("__y", F.col("CNT_PAYMENT").cast("double")), None, FEW_FITTED, MANY_FITTED)
    model = fit(rows, features, "__y", boosted_regressor("__y", rounds, depth, rate, seed=125))
    return [
        model.transform(as_features(inputs(df, fill=True), features)).select(*df.columns, F.col("prediction").alias(name))
        for df in applications
    ]


# -- validation ----------------------------------------------------------------------------------


def concurrently(like: DataFrame, steps: Sequence[Callable[[], object]], workers: int = CONCURRENT) -> list:
    """Results of driver steps that each submit Spark jobs, run a few at a time and given in their order.

    Each worker has a scheduler pool, so that with fair scheduling the fits share the cluster and one
    that waits for its driver leaves its cores to the others.
    """
    context = like.sparkSession.sparkContext

    def in_pool(number: int, step: Callable[[], object]):
        def run():
            context.setLocalProperty("spark.scheduler.pool", f"fit-{number % workers}")
            return step()

        return inheritable_thread_target(run)

    with ThreadPoolExecutor(workers) as pool:
        return [f.result() for f in [pool.submit(in_pool(i, step)) for i, step in enumerate(steps)]]


def with_folds(df: DataFrame, key: str, features: Sequence[str], label: str, folds: int, seed: int) -> DataFrame:
    """Rows with their fold and the features as one vector, kept once for all fits and scores.

    Folds are made by class and range; the rows are then dealt evenly, since every fit reads them many times.
    """
    known = df.select(key, label, *features).filter(F.col(label).isNotNull())
    spread = dealt(stratified_folds(known, label, key, folds, seed), known.count(), FEW_FITTED, MANY_FITTED)
    return kept_vectors(spread, features, [key, label, "fold"], label)


def fold_weights(spread: DataFrame, label: str, folds: int) -> list[dict[float, float]]:
    """Balanced class weights of every fold's training rows, from one count (classes x folds rows)."""
    counts = {(r["fold"], r[label]): r["count"] for r in spread.groupBy("fold", label).count().collect()}
    out = []
    for fold in range(folds):
        per_class: dict[float, int] = {}
        for (other, y), n in counts.items():
            if other != fold:
                per_class[y] = per_class.get(y, 0) + n
        total = sum(per_class.values())
        out.append({y: total / (len(per_class) * n) for y, n in per_class.items()})
    return out


def fold_measures(
    spread: DataFrame, features: Sequence[str], label: str, makers: Mapping[str, Callable[[], Estimator]], folds: int, threshold: float
) -> DataFrame:
    """AUC, recall and precision of the train and test rows of every named estimator and fold.

    All fits run on the one kept table, several at a time; then one job scores every row with every model
    and measures all of them, so nothing but the models passes the driver.
    """
    weights = fold_weights(spread, label, folds)
    context = [(name, make, fold) for name, make in makers.items() for fold in range(folds)]

    def step(make: Callable[[], Estimator], fold: int):
        weight = F.coalesce(*[F.when(F.col(label) == y, F.lit(w)) for y, w in weights[fold].items()], F.lit(1.0))
        return lambda: fit_vectors(spread.filter(F.col("fold") != fold).withColumn("__weight", weight), features, make()).stages[-1]

    models = concurrently(spread, [step(make, fold) for _, make, fold in context])
    scored = None
    for (name, _, fold), model in zip(context, models, strict=True):
        part = F.when(F.col("fold") == fold, "test").otherwise("train")
        rows = model.transform(spread).select(
            F.lit(name).alias("model"), F.lit(fold).alias("round"), part.alias("part"), label, vector_to_array("probability")[1].alias("__proba")
        )
        scored = rows if scored is None else scored.unionByName(rows)
    scored = checkpointed(scored)
    guess = F.when(F.col("__proba") > threshold, 1).otherwise(0)
    by = ["model", "round", "part"]
    counts = scored.groupBy(*by).agg(
        *[F.count_if((F.col(label) == y) & (guess == g)).alias(n) for n, y, g in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))]
    )
    rows = with_threshold_metrics(counts).join(ranking_metrics(scored, label, "__proba", by), by)
    return rows.select(*by, "roc_auc", "recall", "precision")


def cross_validate(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    estimator: Callable[[], Estimator],
    folds: int = 10,
    threshold: float = 0.5,
    seed: int = 0,
) -> DataFrame:
    """Stratified cross-validation: mean and population deviation of AUC, recall and precision of the train
    and test rows."""
    spread = with_folds(df, key, features, label, folds, seed)
    measures = fold_measures(spread, features, label, {"": estimator}, folds, threshold)
    aggs = [e for m in ("roc_auc", "recall", "precision") for e in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))]
    return measures.groupBy("part").agg(*aggs)


def grid_search(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    make: Callable[..., Estimator],
    grid: Mapping[str, Sequence],
    folds: int = 10,
    seed: int = 0,
) -> DataFrame:
    """Cross-validated test AUC of every parameter combination, best first."""
    spread = with_folds(df, key, features, label, folds, seed)
    combinations = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    makers = {str(p): (lambda p=p: make(label, **p)) for p in combinations}
    measures = fold_measures(spread, features, label, makers, folds, 0.5).filter("part = 'test'")
    table = measures.groupBy(F.col("model").alias("params")).agg(F.avg("roc_auc").alias("roc_auc"))
    return table.orderBy(F.desc("roc_auc"), "params")


def threshold_report(df: DataFrame, label: str, score_col: str, threshold: float) -> DataFrame:
    return with_threshold_metrics(confusion(df, label, score_col, threshold))


def evaluate_experiment(
    train: DataFrame,
    valid: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    estimator: Callable[[], Estimator],
    threshold: float,
    title: str,
    folds: int = 10,
    seed: int = 0,
) -> DataFrame:
    """One result row: threshold and ranking measures on the validation rows, cross-validation on the
    training rows (``train_*_mean``, ``test_*_std``, ...). Ready to be appended to a results table."""
    model = fit_classifier(balanced(train, label), features, label, estimator())
    row = evaluate_at_threshold(probability(valid, model, features, "__proba"), label, "__proba", threshold, title)
    folded = cross_validate(train, key, features, label, estimator, folds, threshold, seed)
    measures = [f"{m}_{s}" for m in ("roc_auc", "recall", "precision") for s in ("mean", "std")]
    wide = folded.agg(
        *[F.max(F.when(F.col("part") == part, F.col(m))).alias(f"{part}_{m}") for part in ("train", "test") for m in measures]
    )
    return row.crossJoin(F.broadcast(wide))  # one row each
