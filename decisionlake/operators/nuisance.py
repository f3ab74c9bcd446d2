"""Nuisance models on Spark ML: the logging policy b(a|s) and the reward m(s, a).

The only module that fits. Every fit takes training rows; predictions are columns
appended to the row (``b_0..``, ``ridge_0..``), so nothing is aligned by position.
"""

from __future__ import annotations

import uuid
import json
import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionlake.functions.reward import require_finite_reward, with_reward
from decisionlake.functions.vectors import action_index, as_columns, pick, valid_probabilities
from decisionlake.operators.features import FeatureStats, fit_features_with, vectorize
from decisionlake.operators.folds import with_folds
from decisionlake.operators.leaf_values import PenalisedTrees, penalised
from decisionlake.operators.metrics import behavior_report, model_deltas, reward_report, union_long
from decisionlake.operators.scale import is_small
from decisionlake.operators.shared_fits import SharedFits
from decisionlake.operators.shared_trees import SharedTrees
from decisionlake.operators.validate import assert_probabilities, assert_training, require_columns
from decisionlake.sources.storage import table_path
from decisionlake.spec import DEFAULT, TrajectorySpec

MIN_PROPENSITY = 0.02
#: Fits of small tables that run at the same time.
PARALLEL_FITS = 8


def in_parallel(tasks: Sequence[Callable[[], object]], row_bound: int | None = None) -> list:
    """Run driver-side tasks that each launch Spark jobs.

    Small fits overlap to fill the cores. A large fit fills the cluster by itself, and
    only one may hold cached features at a time, so those run one after another.
    """
    if not is_small(row_bound):
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(PARALLEL_FITS, max(1, len(tasks)))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


# ------------------------------------------------------------------------- behaviour


class BehaviorPolicyModel:
    """Multinomial logistic regression with an L2 penalty and no class weights."""

    def __init__(self, *, regularization_c: float = 1.0, max_iter: int = 2_000,
                 tol: float = 1e-8, spec: TrajectorySpec = DEFAULT):
        if regularization_c <= 0 or max_iter <= 0:
            raise ValueError("regularization_c and max_iter must be positive.")
        self.regularization_c, self.max_iter, self.tol, self.spec = regularization_c, max_iter, tol, spec
        self.stats: FeatureStats | None = None
        self.model: LogisticRegressionModel | None = None

    def fit(self, df: DataFrame, *, row_bound: int | None = None, checked: bool = False) -> BehaviorPolicyModel:
        if not checked:
            assert_training(df, all_actions=True, spec=self.spec)
        self.stats, size = fit_features_with(
            df, {"rows": F.count("*")}, row_bound=row_bound, spec=self.spec)
        rows = vectorize(df, self.stats).select(
            action_index(self.spec.action, self.spec.actions).cast("double").alias("label"), "features"
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # The penalty is per row here and per sum in 1/C.
            self.model = LogisticRegression(
                family="multinomial", elasticNetParam=0.0, standardization=False,
                regParam=1.0 / (self.regularization_c * size["rows"]),
                maxIter=self.max_iter, tol=self.tol,
            ).fit(rows)
        finally:
            rows.unpersist()
        return self

    def predict(self, df: DataFrame, stem: str = "b") -> DataFrame:
        """Add ``<stem>_i`` in canonical action order."""
        if self.model is None:
            raise RuntimeError("Fit the behavior model before predicting.")
        require_columns(df, self.spec.observations)
        scored = self.model.transform(vectorize(df, self.stats, name=self.model.getFeaturesCol()))
        p = vector_to_array("probability")
        return scored.select(
            *df.columns, *[p[i].alias(c) for i, c in enumerate(self.spec.indexed(stem))]
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        _save_stats(spark, path, self.stats)

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: TrajectorySpec = DEFAULT) -> BehaviorPolicyModel:
        out = cls(spec=spec)
        out.model = LogisticRegressionModel.load(f"{path}/model")
        out.stats = _load_stats(spark, path)
        return out


# ---------------------------------------------------------------------------- reward


@dataclass(frozen=True)
class RewardModelConfig:
    """``ridge`` or ``hist_gradient_boosting`` (level-wise trees on Spark)."""

    model_type: str = "ridge"
    alpha: float = 1.0
    learning_rate: float = 0.05
    max_iter: int = 200
    max_leaf_nodes: int = 15
    min_samples_leaf: int = 20
    l2_regularization: float = 1.0
    random_seed: int = 42

    def __post_init__(self):
        if self.model_type not in ("ridge", "hist_gradient_boosting"):
            raise ValueError(f"Unknown model_type: {self.model_type!r}")
        if self.alpha < 0 or self.learning_rate <= 0 or self.max_iter <= 0:
            raise ValueError("alpha must be non-negative; learning_rate and max_iter positive.")
        if self.max_leaf_nodes < 2 or self.min_samples_leaf < 1:
            raise ValueError("max_leaf_nodes must be at least two and min_samples_leaf positive.")
        if self.l2_regularization < 0:
            raise ValueError("l2_regularization must be non-negative.")

    @property
    def scaled(self) -> bool:
        return self.model_type == "ridge"


RIDGE = RewardModelConfig()
BOOSTED = RewardModelConfig("hist_gradient_boosting")


class ActionRewardModel:
    """One regression per logged action. Values of other actions are model estimates."""

    def __init__(self, config: RewardModelConfig = RIDGE, *, spec: TrajectorySpec = DEFAULT):
        self.config, self.spec = config, spec
        self.parts: list[tuple[FeatureStats, object]] | None = None

    def fit(self, df: DataFrame, *, row_bound: int | None = None, checked: bool = False,
            stats: Sequence[FeatureStats] | None = None) -> ActionRewardModel:
        """``stats`` are the features of each action's rows, where they are known; only trees take them."""
        if not checked:
            assert_training(df, all_actions=True, spec=self.spec)
        df = with_reward(df, name="_target", spec=self.spec)
        if not checked:
            require_finite_reward(df, "_target")
        self.parts = in_parallel([
            lambda a=a, own=own: self._fit_one(df.filter(F.col(self.spec.action) == a), row_bound, own)
            for a, own in zip(self.spec.actions, stats or [None] * len(self.spec.actions))
        ], row_bound)
        return self

    def _fit_one(self, df: DataFrame, row_bound: int | None, stats: FeatureStats | None = None):
        size = {"rows": None, "deviation": None}
        if stats is None or self.config.scaled:
            stats, size = fit_features_with(
                df, {"rows": F.count("*"), "deviation": F.stddev_pop("_target")},
                row_bound=row_bound, spec=self.spec,
            )
        rows = vectorize(df, stats, scaled=self.config.scaled).select(
            F.col("_target").alias("label"), "features"
        )
        estimator = self._estimator(size["rows"], size["deviation"] or 0.0)
        if self.config.model_type == "ridge":
            # One pass over the rows: nothing to keep.
            return stats, estimator.fit(rows)
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return stats, penalised(estimator.fit(rows), rows, self.config.l2_regularization)
        finally:
            rows.unpersist()

    def _estimator(self, n: int, deviation: float):
        c = self.config
        if c.model_type == "ridge":
            # This solver divides the loss by n and the label by its population deviation.
            return LinearRegression(
                elasticNetParam=0.0, standardization=False, solver="normal",
                regParam=c.alpha / n * deviation,
            )
        # the gradient that trees are grown on is twice the residual
        return GBTRegressor(
            stepSize=c.learning_rate / 2, maxIter=c.max_iter, seed=c.random_seed,
            maxDepth=math.ceil(math.log2(c.max_leaf_nodes)), minInstancesPerNode=c.min_samples_leaf,
        )

    def predict_values(self, df: DataFrame, stem: str = "value") -> DataFrame:
        """Add ``<stem>_i``: the modelled reward of every action."""
        if self.parts is None:
            raise RuntimeError("Fit the reward model before predicting.")
        require_columns(df, self.spec.observations)
        columns = df.columns
        for name, (stats, model) in zip(self.spec.indexed(stem), self.parts):
            columns = [*columns, name]
            inputs = vectorize(df, stats, scaled=self.config.scaled)
            df = model.transform(inputs).withColumnRenamed("prediction", name).select(*columns)
        return df

    def predict_logged_values(self, df: DataFrame, name: str = "predicted") -> DataFrame:
        values = self.spec.indexed("_v")
        return self.predict_values(df, "_v").withColumn(
            name, pick(values, action_index(self.spec.action, self.spec.actions))
        ).drop(*values)

    def predict_supported_values(
        self, df: DataFrame, behavior: Sequence[str], *, minimum_propensity: float = MIN_PROPENSITY,
        stem: str = "value",
    ) -> DataFrame:
        assert_probabilities(df, behavior, 1e-6, self.spec)
        return supported_values(
            self.predict_values(df, stem), self.spec.indexed(stem), behavior, minimum_propensity
        )

    def save(self, spark: SparkSession, path: str) -> None:
        for i, (stats, model) in enumerate(self.parts):
            if isinstance(model, PenalisedTrees):
                _save_json(spark, f"{path}/action={i}/leaves", {"base": model.base, "values": model.values})
                model = model.model
            model.write().overwrite().save(f"{path}/action={i}/model")
            _save_stats(spark, f"{path}/action={i}", stats)
        _save_json(spark, f"{path}/config", asdict(self.config))

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: TrajectorySpec = DEFAULT) -> ActionRewardModel:
        out = cls(RewardModelConfig(**_load_json(spark, f"{path}/config")), spec=spec)

        def part(folder: str) -> tuple[FeatureStats, object]:
            if out.config.model_type == "ridge":
                return _load_stats(spark, folder), LinearRegressionModel.load(f"{folder}/model")
            leaves = _load_json(spark, f"{folder}/leaves")
            model = GBTRegressionModel.load(f"{folder}/model")
            return _load_stats(spark, folder), PenalisedTrees(model, leaves["base"], tuple(map(tuple, leaves["values"])))

        out.parts = [part(f"{path}/action={i}") for i in range(len(spec.actions))]
        return out


def _save_json(spark: SparkSession, path: str, value: object) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _load_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path).first()["value"])


def _save_stats(spark: SparkSession, path: str, stats: FeatureStats) -> None:
    _save_json(spark, f"{path}/features", asdict(stats))


def _load_stats(spark: SparkSession, path: str) -> FeatureStats:
    raw = _load_json(spark, f"{path}/features")
    return FeatureStats(
        tuple(tuple(x) for x in raw["numeric"]),
        tuple((n, mode, tuple(levels)) for n, mode, levels in raw["categorical"]),
    )


def support_mask(behavior: Sequence[str], minimum_propensity: float = MIN_PROPENSITY) -> list[Column]:
    """``b >= minimum`` per action; the limit itself is supported."""
    if not 0.0 <= minimum_propensity <= 1.0:
        raise ValueError("minimum_propensity must be between zero and one.")
    return [b >= F.lit(minimum_propensity) for b in as_columns(behavior)]


def supported_values(
    df: DataFrame, values: Sequence[str], behavior: Sequence[str],
    minimum_propensity: float = MIN_PROPENSITY,
) -> DataFrame:
    """Values of unsupported actions become NULL."""
    mask = support_mask(behavior, minimum_propensity)
    return df.withColumns({v: F.when(m, F.col(v)) for v, m in zip(values, mask)})


# ------------------------------------------------------------------------- cross-fit


@dataclass(frozen=True)
class CrossFitConfig:
    n_splits: int = 5
    seed: int = 42
    strategy: str = "stratified"
    behavior: dict | None = field(default_factory=dict)
    rewards: dict[str, RewardModelConfig] = field(
        default_factory=lambda: {"ridge": RIDGE, "nonlinear": BOOSTED}
    )


def cross_fit(
    df: DataFrame, config: CrossFitConfig = CrossFitConfig(), *, row_bound: int | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Training rows with ``fold`` and out-of-fold ``b_i`` / ``<model>_i`` columns.

    The folded rows are written once, partitioned by fold and action. Logistic and ridge models of all folds
    come from shared passes and predict in one projection (``shared_fits``); beside a ridge model, boosted trees of all folds and
    actions grow in shared passes too (``shared_trees``), else per fold and action from the files of those alone. The result is written too, since
    every downstream operator reads it. Coverage is checked on the written rows.
    """
    assert_training(df, all_actions=True, spec=spec)
    spark = df.sparkSession
    folded = with_folds(
        with_reward(df, name=spec.reward, spec=spec), config.n_splits, config.seed,
        strategy=config.strategy, spec=spec,
    )
    source = table_path(spark, "folds", uuid.uuid4())
    folded.write.mode("overwrite").partitionBy("fold", spec.action).parquet(source)
    rows = require_finite_reward(spark.read.schema(folded.schema).parquet(source), spec.reward)
    if row_bound is None:
        row_bound = rows.count()

    ridges = {name: c.alpha for name, c in config.rewards.items() if c.model_type == "ridge"}
    folds = range(1, config.n_splits + 1)
    shared = None
    if ridges or config.behavior is not None:
        shared = SharedFits.fit(
            rows, folds, behavior=config.behavior, ridge=ridges, row_bound=row_bound, spec=spec)
    scored = shared.predict(rows) if shared else rows
    if shared and ridges:  # these have found the features of every fold and action
        for name, c in config.rewards.items():
            if name not in ridges:
                scored = SharedTrees.fit(rows, folds, shared, c, row_bound=row_bound, spec=spec).predict(scored, name)
    apart = {} if shared and ridges else {name: c for name, c in config.rewards.items() if not shared or name not in ridges}

    def held_out(fold: int) -> DataFrame:
        train, out = rows.filter(F.col("fold") != fold), scored.filter(F.col("fold") == fold)
        tasks = []
        if config.behavior is not None and not shared:
            tasks.append(lambda: BehaviorPolicyModel(**config.behavior, spec=spec).fit(
                train, row_bound=row_bound, checked=True))
        tasks += [
            lambda c=c: ActionRewardModel(c, spec=spec).fit(train, row_bound=row_bound, checked=True)
            for c in apart.values()
        ]
        models = in_parallel(tasks, row_bound)
        if config.behavior is not None and not shared:
            out = models.pop(0).predict(out)
        for name, model in zip(apart, models):
            out = model.predict_values(out, name)
        return out

    if apart or not shared:
        parts = in_parallel([lambda f=f: held_out(f) for f in folds], row_bound)
        scored = parts[0]
        for part in parts[1:]:
            scored = scored.unionByName(part)
    estimated = [c for name in (["b"] if config.behavior is not None else []) + list(config.rewards) for c in spec.indexed(name)]
    result = scored.select(*rows.columns, *estimated)
    target = table_path(spark, "estimates", uuid.uuid4())
    result.write.mode("overwrite").parquet(target)
    estimates = spark.read.schema(result.schema).parquet(target)
    _require_coverage(rows, estimates, config, spec)
    return estimates


def _require_coverage(rows, estimates, config, spec):
    """Every row exactly once, with finite predictions."""
    bad = F.lit(False)
    if config.behavior is not None:
        bad = bad | ~valid_probabilities(spec.indexed("b"), 1e-6)
    for model in config.rewards:
        for v in spec.indexed(model):
            bad = bad | F.col(v).isNull() | F.isnan(v)
    seen = estimates.agg(F.count("*").alias("n"), F.count_if(bad).alias("bad")).first()
    if seen["n"] != rows.count() or seen["bad"]:
        raise RuntimeError("Every row must receive one finite out-of-fold prediction.")


def cross_fit_behavior(df: DataFrame, n_splits: int = 5, seed: int = 42, *,
                       behavior: dict | None = None, row_bound: int | None = None,
                       spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Out-of-fold behaviour probabilities only."""
    config = CrossFitConfig(n_splits, seed, behavior=behavior or {}, rewards={})
    return cross_fit(df, config, row_bound=row_bound, spec=spec)


def cross_validate_behavior(df: DataFrame, n_splits: int = 5, seed: int = 42, *,
                            behavior: dict | None = None, row_bound: int | None = None,
                            spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Long report of the out-of-fold behaviour model."""
    rows = cross_fit_behavior(df, n_splits, seed, behavior=behavior, row_bound=row_bound, spec=spec)
    return behavior_report(rows, spec.indexed("b"), row_bound=row_bound, spec=spec)


def cross_validate_rewards(
    df: DataFrame, models: dict[str, RewardModelConfig], n_splits: int = 5, seed: int = 42, *,
    row_bound: int | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Long reports of one or more reward models under the same folds."""
    config = CrossFitConfig(n_splits, seed, behavior=None, rewards=models)
    rows = cross_fit(df, config, row_bound=row_bound, spec=spec)
    a = action_index(spec.action, spec.actions)
    return union_long([
        reward_report(rows.withColumn("predicted", pick(spec.indexed(m), a)), "predicted",
                      model=m, reward=spec.reward, spec=spec)
        for m in models
    ])


def compare_reward_models(
    df: DataFrame, models: dict[str, RewardModelConfig], *, baseline: str = "ridge",
    n_splits: int = 5, seed: int = 42, row_bound: int | None = None, spec: TrajectorySpec = DEFAULT,
) -> tuple[DataFrame, DataFrame]:
    """The long reports and the candidate-minus-baseline deltas."""
    if baseline not in models:
        raise ValueError("The baseline must be one of the models.")
    if len(models) < 2:
        raise ValueError("At least two models are required.")
    reports = cross_validate_rewards(df, models, n_splits, seed, row_bound=row_bound, spec=spec)
    return reports, model_deltas(reports, baseline)
