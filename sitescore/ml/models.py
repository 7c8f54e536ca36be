"""Training, comparing and applying regression models on feature rows."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescore.functions import measures
from sitescore.operators.columns import NullPolicy, numeric_columns
from sitescore.operators.sampling import SEED
from sitescore.session import cut_lineage

# Chosen forest and the searched grid.
FINAL_PARAMS = {"n_estimators": 51, "max_depth": 3}
GRID = {
    "n_estimators": list(range(10, 50)),
    "criterion": ["mse", "mae"],
    "bootstrap": [True],
    "max_samples": [(i + 1) * 0.1 for i in range(9)],
}

#: Trees of a forest that names no number, as in Spark.
DEFAULT_TREES = 20

_FOREST_PARAMS = {"n_estimators": "numTrees", "bootstrap": "bootstrap", "max_samples": "subsamplingRate", "max_depth": "maxDepth"}


@dataclass(frozen=True)
class FeatureList:
    """The ordered features and NULL rule fixed in training, reused for scoring."""

    columns: tuple[str, ...]
    nulls: NullPolicy
    label: str = "stars"
    key: str = "site_id"

    @classmethod
    def fit(cls, df: DataFrame, nulls: NullPolicy = NullPolicy(), label: str = "stars", key: str = "site_id", ignore: Sequence[str] = ("review_count",)) -> FeatureList:
        skip = {label, key, *ignore}
        fitted = nulls.fit(df.drop(*skip))
        return cls(tuple(c for c in numeric_columns(fitted.apply(df)) if c not in skip), fitted, label, key)

    def assemble(self, df: DataFrame) -> DataFrame:
        """(key, label if there is one, features)."""
        has_label = [self.label] if self.label in df.columns else []
        filled = self.nulls.apply(df.select(self.key, *has_label, *self.columns), keys=[self.key])
        vectors = VectorAssembler(inputCols=list(self.columns), outputCol="features").transform(filled)
        return vectors.select(self.key, *[F.col(c).cast("double") for c in has_label], "features")


#: Tasks of a fit. Part of the seed: another number draws other samples.
FIT_PARTITIONS = 16


def steady(df: DataFrame, key: str = "site_id", partitions: int = FIT_PARTITIONS) -> DataFrame:
    """Written rows in an order that depends on the keys and ``partitions`` only.

    Bagging draws by partition and row, so a fixed seed repeats itself only on a
    fixed layout; the number of rows does not change it. Give more partitions
    for many rows. Also saves the fits from computing the features again.
    """
    return cut_lineage(df.repartition(partitions, key).sortWithinPartitions(key))


def scale(train: DataFrame, *others: DataFrame) -> list[DataFrame]:
    """Standardise ``features`` by mean and deviation of the training rows only."""
    model = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(train)
    return [model.transform(df).drop("features").withColumnRenamed("scaled", "features") for df in (train, *others)]


def scale_columns(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Plain columns standardised with the population deviation of ``train``."""
    moments = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("avg", F.avg), ("sd", F.stddev_pop))]
    fitted = train.agg(F.struct(*moments).alias("moments")).scalar()
    scaled = {c: F.try_divide(F.col(c) - F.col(f"__m.avg_{c}"), F.col(f"__m.sd_{c}")) for c in columns}
    return df.withColumn("__m", fitted).withColumns(scaled).drop("__m")


def estimator(kind: str, label: str = "stars", params: Mapping[str, object] | None = None, seed: int = SEED) -> Estimator:
    """``dt``, ``rf`` or ``gbt`` with defaults, changed by forest-style parameter names."""
    classes = {"dt": DecisionTreeRegressor, "rf": RandomForestRegressor, "gbt": GBTRegressor}
    chosen = {_FOREST_PARAMS.get(name, name): value for name, value in (params or {}).items()}
    return classes[kind](labelCol=label, featuresCol="features", seed=seed, **chosen)


def fit(kind: str, train: DataFrame, label: str = "stars", params: Mapping[str, object] | None = None, seed: int = SEED) -> Model:
    return estimator(kind, label, params, seed).fit(train)


def score(model: Model, rows: DataFrame, key: str = "site_id") -> DataFrame:
    """(key, prediction); the key stays on its row."""
    return model.transform(rows).select(key, "prediction")


def metrics(predictions: DataFrame, label: str = "stars", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAPE and MAE in one pass."""
    y, p = F.col(label), F.col(prediction)
    return predictions.groupBy(*by).agg(
        measures.rmse(y, p).alias("rmse"), measures.mape(y, p).alias("mape"), measures.mae(y, p).alias("mae")
    )


def compare(models: Mapping[str, Model], test: DataFrame, label: str = "stars") -> DataFrame:
    """One row (model, rmse, mape, mae) per fitted model."""
    scored = [m.transform(test).select(F.lit(name).alias("model"), label, "prediction") for name, m in models.items()]
    return metrics(reduce(DataFrame.unionByName, scored), label, by=["model"])


def param_grid(spark: SparkSession, **lists: Sequence[object]) -> DataFrame:
    """All combinations of the value lists, one row each."""
    grid = spark.createDataFrame([tuple(lists.values())], list(lists))
    for name in lists:
        grid = grid.withColumn(name, F.explode(name))
    return grid


def forest_grid(spark: SparkSession) -> DataFrame:
    return param_grid(spark, **GRID)


def with_sample_rows(grid: DataFrame, train: DataFrame) -> DataFrame:
    """Add the rows each tree draws from ``train`` at its ``max_samples``."""
    n = train.agg(F.count(F.lit(1))).scalar()
    return grid.withColumn("sample_rows", F.floor(F.col("max_samples") * n + 0.5))


def grid_rows(**lists: Sequence[object]) -> list[dict[str, object]]:
    """The grid as parameter dicts for the driver that starts the fits."""
    return [dict(zip(lists, values)) for values in product(*lists.values())]


def grid_search(
    train: DataFrame,
    test: DataFrame,
    grid: Sequence[Mapping[str, object]],
    label: str = "stars",
    parallelism: int = 4,
    seed: int = SEED,
    scaling: str = "none",
) -> DataFrame:
    """Measure a forest for each parameter row and return the run log.

    Rows that differ in ``n_estimators`` only share one fit of the largest
    number: its first k trees are a forest of k, as trees are drawn
    independently, and all k are measured in one pass over the test rows. Each
    fit is a Spark job over the distributed rows; ``parallelism`` of them run at
    a time. Spark trees know the variance criterion only: rows that ask for
    another one come back as ``unsupported`` with NULL metrics. ``search_id``
    tells searches apart in one log.
    """
    spark = train.sparkSession
    search_id = uuid.uuid4().hex
    wanted = [dict(p) for p in grid]
    shared: dict[tuple, list[tuple[int, int]]] = {}
    for run_id, params in enumerate(wanted):
        if params.get("criterion", "mse") == "mse":
            known = {k: v for k, v in params.items() if k in _FOREST_PARAMS}
            trees = known.pop("n_estimators", DEFAULT_TREES)
            # a single tree splits on all features, the trees of a forest on a third of them
            shared.setdefault((trees == 1, *sorted(known.items())), []).append((run_id, trees))

    def run(group: tuple[tuple, list[tuple[int, int]]]) -> list[tuple[int, dict[str, float]]]:
        (_, *known), runs = group
        model = fit("rf", train, label, {**dict(known), "n_estimators": max(k for _, k in runs)}, seed)
        found = {r["trees"]: r for r in first_trees_metrics(model, test, sorted({k for _, k in runs}), label).collect()}
        return [(run_id, {m: found[k][m] for m in ("rmse", "mape", "mae")} if k in found else {}) for run_id, k in runs]

    measured: dict[int, dict[str, float]] = {}
    if shared:
        with ThreadPool(max(1, min(parallelism, len(shared)))) as pool:
            for part in pool.map(inheritable_thread_target(spark)(run), list(shared.items()), chunksize=1):
                measured.update(part)
    rows = []
    for run_id, params in enumerate(wanted):
        tags = {k: str(v) for k, v in {**params, "model type": "randomForestRegressor", "scaling": scaling}.items()}
        rows.append((search_id, run_id, "finished" if run_id in measured else "unsupported", tags, measured.get(run_id, {})))
    return spark.createDataFrame(rows, "search_id string, run_id int, status string, params map<string,string>, metrics map<string,double>")


def first_trees_metrics(model: Model, rows: DataFrame, counts: Sequence[int], label: str = "stars") -> DataFrame:
    """(trees, rmse, mape, mae) of the forests made of the first k trees of ``model``, in one pass over ``rows``."""
    names = [f"__tree{n}" for n in range(model.getNumTrees)]
    for name, tree in zip(names, model.trees):
        rows = tree.setPredictionCol(name).transform(rows)
    rows = rows.select(F.col(label).alias("y"), F.array(*names).alias("each")).withColumn("trees", F.explode(F.lit(list(counts))))
    total = F.aggregate(F.slice("each", 1, F.col("trees")), F.lit(0.0), lambda x, y: x + y)
    return metrics(rows.select("trees", "y", (total / F.col("trees")).alias("p")), "y", "p", by=["trees"])


def log_runs(runs: DataFrame, path: str) -> None:
    """Append runs to the log; (search_id, run_id) is the key."""
    runs.select("search_id", "run_id", "status", "params", "metrics").write.mode("append").parquet(path)


def best_run(runs: DataFrame, metric: str = "mape") -> DataFrame:
    """The run with the smallest metric, ties by run id; NULL metrics lose.

    Reads measured runs with a column for each metric as well as the run log.
    """
    value = F.col(metric) if metric in runs.columns else F.col("metrics")[metric]
    ties = [c for c in ("run_id", "search_id") if c in runs.columns]
    return runs.orderBy(value.asc_nulls_last(), *ties).limit(1)


def train_final(train: DataFrame, test: DataFrame, params: Mapping[str, object] | None = None, label: str = "stars", seed: int = SEED) -> tuple[Model, DataFrame]:
    """(model with the chosen parameters, its hold-out metrics)."""
    model = fit("rf", train, label, FINAL_PARAMS if params is None else params, seed)
    return model, metrics(model.transform(test), label)
