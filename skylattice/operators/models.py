"""Models on tables: MLlib estimators and the tests around them."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import keyed_number
from ..ordered import OrderedRows, exact_quantiles
from ..session import materialise
from . import gram, trees
from .gram import student_t
from .sampling import draw_counts, hash_unit, with_fold
from .verification import r2_mse


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A model's parameters or scores as a table."""
    return spark.createDataFrame(rows, schema)


def with_vector(df: DataFrame, features: Sequence[str] | str, out: str = "features") -> DataFrame:
    """Feature vector from numeric columns or from one array column."""
    if isinstance(features, str):
        return df.withColumn(out, array_to_vector(F.col(features).cast("array<double>")))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


# --- linear models -------------------------------------------------------


def linear_regression(df: DataFrame, features: Sequence[str], label: str, ridge: float = 0.0):
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"),
        LinearRegression(featuresCol="features", labelCol=label, regParam=ridge, standardization=False),
    ]
    return Pipeline(stages=stages).fit(df)


def coefficients(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    fit = model.stages[-1] if hasattr(model, "stages") else model
    rows = [("intercept", float(fit.intercept))] + [(f, float(c)) for f, c in zip(features, fit.coefficients)]
    return small_table(spark, rows, "term string, estimate double")


def linear_fit_summary(df: DataFrame, x: str, y: str) -> DataFrame:
    """One-row table of a straight-line fit: coefficients with standard
    errors, residual spread and the sums needed for intervals."""
    sums = df.agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
        F.regr_avgx(y, x).alias("mean_x"),
    )
    s2 = F.try_divide(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")), F.col("n") - 2)
    return sums.select(
        "n",
        "slope",
        "intercept",
        "mean_x",
        "sxx",
        F.sqrt(s2).alias("residual_std"),
        F.sqrt(F.try_divide(s2, F.col("sxx"))).alias("slope_se"),
        F.sqrt(s2 * (F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide(F.col("mean_x") ** 2, F.col("sxx")))).alias("intercept_se"),
    )


def linear_intervals(df: DataFrame, x: str, y: str, level: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """Coefficient table with intervals, and the rows with fit, residual,
    confidence and prediction interval."""
    fit = linear_fit_summary(df, x, y).first()  # one row of sums
    t = student_t(0.5 + level / 2, int(fit["n"]) - 2)
    terms = [
        (name, fit[name], fit[f"{name}_se"], fit[name] - t * fit[f"{name}_se"], fit[name] + t * fit[f"{name}_se"])
        for name in ("intercept", "slope")
    ]
    table = small_table(df.sparkSession, terms, "term string, estimate double, se double, lower double, upper double")
    xc, at = F.col(x), F.lit(fit["intercept"]) + F.lit(fit["slope"]) * F.col(x)
    lever = 1 / fit["n"] + (xc - fit["mean_x"]) ** 2 / fit["sxx"]
    conf = t * fit["residual_std"] * F.sqrt(lever)
    pred = t * fit["residual_std"] * F.sqrt(1 + lever)
    rows = (
        df.withColumn("fit", at)
        .withColumn("residual", F.col(y) - at)
        .withColumn("conf_lower", at - conf)
        .withColumn("conf_upper", at + conf)
        .withColumn("pred_lower", at - pred)
        .withColumn("pred_upper", at + pred)
    )
    return table, rows


def linear_terms(df: DataFrame, terms: dict[str, Column], y: str, level: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """Least squares on any number of terms: the coefficient table with
    intervals, and the rows with fit, residual, leverage, standardised residual,
    confidence and prediction interval."""
    fit = gram.gram_sums(df, terms, F.col(y))[None].fit()
    table = small_table(df.sparkSession, gram.term_table(fit, level), "term string, estimate double, se double, lower double, upper double")
    return table, gram.with_intervals(df, fit, terms, F.col(y), level)


# --- classifiers and regressors -----------------------------------------

CLASSIFIERS: dict[str, Callable[..., Estimator]] = {
    "logistic": lambda **p: LogisticRegression(**p),
    "svc": lambda **p: OneVsRest(classifier=LinearSVC(maxIter=p.pop("maxIter", 20), regParam=p.pop("regParam", 0.01)), **p),
    "tree": lambda **p: DecisionTreeClassifier(**{"seed": 7, **p}),
    "forest": lambda **p: RandomForestClassifier(**{"seed": 7, **p}),
    "gbt": lambda **p: GBTClassifier(**{"seed": 7, **p}),
    "mlp": lambda **p: MultilayerPerceptronClassifier(**{"seed": 7, **p}),
}
REGRESSORS: dict[str, Callable[..., Estimator]] = {
    "linear": lambda **p: LinearRegression(**p),
    "tree": lambda **p: DecisionTreeRegressor(**{"seed": 7, **p}),
    "forest": lambda **p: RandomForestRegressor(**{"seed": 7, **p}),
    "gbt": lambda **p: GBTRegressor(**{"seed": 7, **p}),
}


def classifier(kind: str, label: str, weight: str | None = None, **params) -> Estimator:
    extra = {"weightCol": weight} if weight else {}
    return CLASSIFIERS[kind](labelCol=label, featuresCol="features", **extra, **params)


def regressor(kind: str, label: str, weight: str | None = None, **params) -> Estimator:
    extra = {"weightCol": weight} if weight else {}
    return REGRESSORS[kind](labelCol=label, featuresCol="features", **extra, **params)


def scaled_model(features: Sequence[str], estimator: Estimator) -> Pipeline:
    """Assemble, scale and fit as one chain."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw", handleInvalid="error"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            estimator,
        ]
    )


def positive_probability(scored: DataFrame, out: str = "score") -> DataFrame:
    return scored.withColumn(out, vector_to_array("probability")[1])


# --- ensembles -----------------------------------------------------------


def bootstrap_weight(ids: Sequence[str], seed: int) -> Column:
    """How often a row is drawn in a bootstrap replica: Poisson(1) by hash."""
    u = hash_unit(ids, seed)
    steps, p, total = [], math.exp(-1.0), 0.0
    # more than 18 draws are less likely than a double can tell
    for i in range(18):
        total += p
        steps.append(total)
        p = p / (i + 1)
    count: Column = F.lit(0)
    for s in steps:
        count = count + (u >= s).cast("int")
    return count.cast("double")


def bagged(df: DataFrame, make: Callable[[str], Estimator], ids: Sequence[str], replicas: int, seed: int) -> list[Model]:
    """Members fitted on bootstrap replicas of exactly the table's size, drawn
    as row weights so that rows are not copied."""
    n, models = df.count(), []
    # Arrow has arrays, but no vectors
    plain = df.withColumn("features", vector_to_array("features")).select(*_read_by(make("__w"), df.columns, ids))
    plain = materialise(plain)
    for i in range(replicas):
        drawn = draw_counts(plain, ids, n, seed + i, "__w")
        weighted = drawn.withColumns({"features": array_to_vector("features"), "__w": F.col("__w").cast("double")})
        models.append(make("__w").fit(materialise(weighted)))
    return models


def _read_by(model: Estimator, columns: Sequence[str], ids: Sequence[str]) -> list[str]:
    """The columns that a fit reads, and the ids; all for a chain, whose stages may read any."""
    if isinstance(model, (Pipeline, OneVsRest)):
        return list(columns)
    named = {model.getOrDefault(p) for p in model.params if p.name.endswith("Col") and model.isDefined(p)}
    return [c for c in columns if c in named or c in ids or c == "features"]


def average_prediction(df: DataFrame, models: Sequence[Model], out: str = "prediction") -> DataFrame:
    scored = df
    names = []
    for i, m in enumerate(models):
        keep = scored.columns
        name = f"__p{i}"
        scored = m.transform(scored).select(*keep, F.col("prediction").alias(name))
        names.append(name)
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return scored.withColumn(out, total / len(names)).drop(*names)


def stacked(
    df: DataFrame, members: dict[str, Callable[[], Estimator]], label: str, ids: Sequence[str], folds: int, seed: int
):
    """Meta-model on member predictions for rows the members did not see.

    Returns (members fitted on all rows, meta model, out-of-fold table).
    """
    rows = materialise(with_fold(df, ids, folds, seed, "__fold"))
    held_out = None
    for f in range(folds):
        train, test = rows.where(F.col("__fold") != f), rows.where(F.col("__fold") == f)
        for name, make in members.items():
            keep = test.columns
            test = make().fit(train).transform(test).select(*keep, F.col("prediction").alias(f"m_{name}"))
        held_out = test if held_out is None else held_out.unionByName(test)
    held_out = materialise(held_out)
    held_out = held_out.drop("features")
    meta = linear_regression(held_out, [f"m_{n}" for n in members], label)
    fitted = {name: make().fit(rows) for name, make in members.items()}
    return fitted, meta, held_out


# --- clusters and components --------------------------------------------


def k_means(df: DataFrame, k: int, seed: int):
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(df)


def gaussian_mixture(df: DataFrame, k: int, seed: int):
    return GaussianMixture(k=k, seed=seed, featuresCol="features", predictionCol="component").fit(df)


def principal_components(df: DataFrame, k: int, whiten: bool = False, out: str = "components"):
    """Centred PCA as a chain of centring and projection; whitening divides by
    the standard deviation of each component."""
    centre = StandardScaler(inputCol="features", outputCol="__centred", withMean=True, withStd=False)
    model = Pipeline(stages=[centre, PCA(k=k, inputCol="__centred", outputCol="__projected")]).fit(df)

    def project(rows: DataFrame) -> DataFrame:
        got = model.transform(rows).withColumn(out, vector_to_array("__projected"))
        if whiten:
            spread = df_component_std(got, k, out)
            got = got.withColumn(
                out, F.zip_with(out, F.array(*[F.lit(s) for s in spread]), lambda v, s: F.when(s > 0, v / s).otherwise(v))
            )
        return got.drop("__centred", "__projected")

    return model, project


def df_component_std(df: DataFrame, k: int, column: str) -> list[float]:
    row = df.agg(*[F.stddev_samp(F.get(column, F.lit(i))).alias(f"s{i}") for i in range(k)]).first()
    return [float(v) for v in row]


def explained_variance(spark: SparkSession, model: Model) -> DataFrame:
    shares = [float(v) for v in model.stages[-1].explainedVariance]
    rows, total = [], 0.0
    for i, s in enumerate(shares):
        total += s
        rows.append((i, s, total))
    return small_table(spark, rows, "component int, share double, cumulative double")


def reconstruction_errors(df: DataFrame, features: str, k: int, out: str = "error") -> DataFrame:
    """1 minus the mean of the 2x2 correlation matrix of each row and its
    reconstruction from ``k`` components. Rows are scored in Arrow batches."""
    centre = StandardScaler(inputCol="features", outputCol="__centred", withMean=True, withStd=False)
    fit = Pipeline(stages=[centre, PCA(k=k, inputCol="__centred", outputCol="__projected")])
    model = fit.fit(with_vector(df, features, "features"))
    axes = model.stages[-1].pc.toArray()  # features x k
    mean = model.stages[0].mean.toArray()

    @F.pandas_udf("double")
    def error(rows: pd.Series) -> pd.Series:
        x = np.stack([np.asarray(v, dtype="float64") for v in rows])
        back = (x - mean) @ axes @ axes.T + mean
        xc = x - x.mean(axis=1, keepdims=True)
        bc = back - back.mean(axis=1, keepdims=True)
        bottom = np.sqrt((xc * xc).sum(axis=1) * (bc * bc).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = (xc * bc).sum(axis=1) / bottom
        # the matrix is [[1, r], [r, 1]]
        return pd.Series(np.where(bottom > 0, 1 - (2 + 2 * r) / 4, None), dtype="float64")

    return df.withColumn(out, error(F.col(features).cast("array<double>")))


def anomalies(scored: DataFrame, error: str, prob: float = 0.95) -> DataFrame:
    """Flag errors at or above the exact quantile; share of flagged rows."""
    cut = exact_quantiles(scored, [], error, [prob]).select("quantile").scalar()
    return scored.withColumn("threshold", cut).withColumn("anomalous", F.col(error) >= F.col("threshold"))


# --- model selection -----------------------------------------------------


def search(
    df: DataFrame, estimator: Estimator, grid: list[dict], evaluator, ids: Sequence[str], folds: int, seed: int, parallelism: int = 4
) -> DataFrame:
    """Mean cross-validated score of every parameter map, best first."""
    rows = materialise(with_fold(df, ids, folds, seed, "__fold"))
    maps = [{estimator.getParam(k): v for k, v in point.items()} for point in grid]
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, foldCol="__fold", parallelism=parallelism
    )
    model = cv.fit(rows)
    order = sorted(zip(model.avgMetrics, grid), key=lambda p: p[0], reverse=evaluator.isLargerBetter())
    table = [(i + 1, ", ".join(f"{k}={v}" for k, v in sorted(g.items())), float(s)) for i, (s, g) in enumerate(order)]
    return small_table(df.sparkSession, table, "place int, params string, score double")


def grid_points(space: dict[str, Sequence]) -> list[dict]:
    points: list[dict] = [{}]
    for name, values in space.items():
        points = [{**p, name: v} for p in points for v in values]
    return points


def random_points(space: dict[str, Sequence], n: int, seed: int) -> list[dict]:
    """``n`` different points of the grid in a seeded random order."""
    points = grid_points(space)
    order = np.random.default_rng(seed).permutation(len(points))[:n]
    return [points[i] for i in order]


def cross_validate(
    df: DataFrame,
    feature_sets: dict[str, Sequence[str]],
    models: dict[str, Callable[[], Estimator]],
    label: str,
    ids: Sequence[str],
    folds: int,
    seed: int,
) -> DataFrame:
    """r2 of every feature set, model and fold.

    Plain linear models have their training sums by subtraction: all sets and
    folds of them take one pass. Regression trees of all sets and folds grow
    together, a pass per level. Other models are fitted fold by fold.
    """
    columns = list(dict.fromkeys(c for cs in feature_sets.values() for c in cs))
    made = {n: make() for n, make in models.items()}
    plain = [n for n, model in made.items() if _least_squares(model)]
    grown = [n for n, model in made.items() if trees.grown_alike(model, df, columns, label)]
    others = [n for n in models if n not in plain and n not in grown]
    rows = with_fold(df, ids, folds, seed, "__fold")
    rows = materialise(rows if others else rows.select(*dict.fromkeys([*columns, label, "__fold"])))
    evaluate = RegressionEvaluator(labelCol=label, metricName="r2")
    table = []
    if plain:
        grams = gram.gram_sums(rows, {c: F.col(c) for c in columns}, F.col(label), "__fold")
        table += [(s, n, f, r2) for n in plain for s, f, r2 in gram.fold_scores(grams, feature_sets)]
    if grown:
        wanted = {(s, n): (cs, made[n]) for s, cs in feature_sets.items() for n in grown}
        table += [(s, n, f, r2) for (s, n), f, r2 in trees.fold_scores(rows, label, "__fold", folds, wanted)]
    for set_name, columns in feature_sets.items():
        vec = materialise(with_vector(rows, columns)) if others else rows
        for model_name in others:
            for f in range(folds):
                fitted = models[model_name]().fit(vec.where(F.col("__fold") != f))
                score = evaluate.evaluate(fitted.transform(vec.where(F.col("__fold") == f)))
                table.append((set_name, model_name, f, float(score)))
    return small_table(df.sparkSession, table, "features string, model string, fold int, r2 double")


def _least_squares(model: Estimator) -> bool:
    """Whether a model is a linear regression without penalty or weights."""
    return isinstance(model, LinearRegression) and not model.getRegParam() and model.getFitIntercept() and not model.isSet("weightCol") and model.getLoss() == "squaredError"


def permutation_importance(
    df: DataFrame, model: Model, features: Sequence[str], label: str, ids: Sequence[str], seed: int
) -> DataFrame:
    """Loss of r2 when one column is shuffled among the rows.

    Rows are numbered along their id and along a hash of it, and the column is
    joined from one numbering to the other. All columns share the numbering.
    """
    spark = df.sparkSession
    plain = OrderedRows(df, [], ids).row_number("__row").finish()
    hashed = df.select(*features, *ids).withColumn("__h", keyed_number(*ids, seed=seed))
    mixed = OrderedRows(hashed, [], ["__h", *ids]).row_number("__row").finish()
    other = mixed.select("__row", *[F.col(f).alias(f"__x_{f}") for f in features])
    both = materialise(plain.join(other, "__row"))

    def score(rows: DataFrame) -> float:
        return r2_mse(model.transform(rows), F.col(label), F.col("prediction")).first()["r2"]

    base = score(both)
    table = []
    for f in features:
        table.append((f, float(base - score(both.withColumn(f, F.col(f"__x_{f}"))))))
    return small_table(spark, sorted(table, key=lambda r: -r[1]), "feature string, importance double")


def tree_importances(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    rows = sorted(((f, float(v)) for f, v in zip(features, model.featureImportances.toArray())), key=lambda r: -r[1])
    return small_table(spark, rows, "feature string, importance double")


# --- groups, scoring -----------------------------------------------------


def partial_pool(df: DataFrame, group: str, value: str) -> DataFrame:
    """Group means drawn towards the overall mean by their own uncertainty.

    Empirical Bayes: each group has its own spread; the spread of the true
    means is what the group means show beyond their standard errors.
    """
    # one row per group
    groups = materialise(
        df.groupBy(group)
        .agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance"))
        .where((F.col("n") > 1) & (F.col("variance") > 0))
    )
    totals = groups.agg(
        F.avg("mean").alias("m"), F.var_samp("mean").alias("v"), F.avg(F.col("variance") / F.col("n")).alias("e")
    )
    centre, between = totals.select("m").scalar(), totals.select(F.greatest(F.col("v") - F.col("e"), F.lit(0.0)).alias("t")).scalar()
    rows = groups.withColumn("__m", centre).withColumn("__t", F.coalesce(between, F.lit(0.0)))
    keep = F.col("__t") / (F.col("__t") + F.col("variance") / F.col("n"))
    return rows.select(
        group,
        "n",
        "mean",
        F.sqrt("variance").alias("sigma"),
        ((F.col("mean") - F.col("__m")) * keep).alias("offset"),
        (F.col("__m") + (F.col("mean") - F.col("__m")) * keep).alias("pooled"),
    )


def score_batches(
    df: DataFrame, features: str, weights: np.ndarray, bias: np.ndarray, keep: Sequence[str], labels: Sequence[int]
) -> DataFrame:
    """Class of the greatest linear score, batch by batch in Arrow.

    ``labels`` are the classes in the order of the columns of ``weights``.
    """
    classes = np.asarray(labels, dtype="int64")
    sent = df.sparkSession.sparkContext.broadcast((weights, bias))
    source = df.select(*keep, F.col(features).cast("array<double>").alias("__f"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__f")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, b = sent.value
        for pdf in batches:
            if len(pdf):
                x = np.stack([np.asarray(v, dtype="float64") for v in pdf["__f"]])
                yield pdf.drop(columns="__f").assign(prediction=classes[np.argmax(x @ w + b, axis=1)])

    return source.mapInPandas(run, fields + ", prediction long")
