"""Inputs of the registered queries, derived by Spark from the driver's tables.

The trajectory table and the response cache are written once per application to the
shared folder and read by every query: a query then scans a pruned, split-partitioned
table instead of repeating the windows over ``events``.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionlake.functions.prompts import ZERO_SHOT_VERSION, zero_shot_messages
from decisionlake.functions.reward import with_reward
from decisionlake.operators.folds import hash_fold, with_folds
from decisionlake.sources.events_view import trajectories_from_events
from decisionlake.sources.response_cache import CACHE_FORMAT_VERSION, RESPONSE_SCHEMA_VERSION, Client, with_cache_key
from decisionlake.sources.storage import table_path
from decisionlake.spec import DEFAULT

CLIENT = Client("fixture-model", ZERO_SHOT_VERSION)
B = DEFAULT.indexed("b")
RIDGE = DEFAULT.indexed("ridge")
NONLINEAR = DEFAULT.indexed("nonlinear")
PI = DEFAULT.indexed("pi")
RHO = DEFAULT.indexed("rho")

_written: dict[tuple[str, str, str], DataFrame] = {}
_rows: dict[tuple[str, str], int] = {}
_lock = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, name: str, build, partition: str | None = None) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _written:
            df = build()
            path = table_path(spark, name, sf_dir)
            writer = df.write.mode("overwrite")
            (writer.partitionBy(partition) if partition else writer).parquet(path)
            _written[key] = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        return _written[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_bound(spark: SparkSession, sf_dir: str) -> int:
    """Rows of ``events``, from the file footers: a bound for everything derived row by row."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _rows:
        _rows[key] = table(spark, sf_dir, "events").count()
    return _rows[key]


def build_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories_from_events(table(spark, sf_dir, "events"), row_bound(spark, sf_dir))


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "trajectories", lambda: build_trajectories(spark, sf_dir), "split")


def k() -> Column:
    """The event's own number, recovered from the heart rate it became."""
    return (F.col("heart_rate") - 60).cast("int")


def uid() -> Column:
    return F.substring("patient_id", 2, 20).cast("bigint")


def _normalised(names, weights):
    total = weights[0] + weights[1] + weights[2]
    return {n: w / total for n, w in zip(names, weights)}


def with_estimates(df: DataFrame) -> DataFrame:
    """Reward, fold, behaviour probabilities and two models' values, given by formulas.

    They stand in for fitted models wherever an operator is checked exactly.
    """
    pressure = F.col("map_mm_hg")
    weights = [
        (k() % 3 + 6).cast("double"),
        (k() % 2 + 2).cast("double"),
        F.when(k() % 9 == 0, F.lit(0.1)).otherwise((uid() % 2 + 1).cast("double")),
    ]
    ridge = [(pressure - 70.0) / 53.0, (k() % 50) / F.lit(47.0) - 0.3, (F.lit(75.0) - pressure) / 41.0]
    df = with_reward(df).withColumns(
        {"fold": hash_fold(), **_normalised(B, weights), **dict(zip(RIDGE, ridge))}
    )
    return df.withColumns({
        "nonlinear_0": F.col("ridge_0") + ((k() % 7) - 3) / F.lit(20.0),
        "nonlinear_1": F.col("ridge_1") * 0.9,
        "nonlinear_2": F.col("ridge_2") + ((uid() % 5) - 2) / F.lit(10.0),
    })


def policy_columns(pressure: Column, names=PI) -> dict[str, Column]:
    """A target policy that treats low pressure, as a formula of the state."""
    return _normalised(names, [
        (k() % 4 + 3).cast("double"),
        F.when(pressure < 65.0, F.lit(4.0)).otherwise(F.lit(1.0)),
        F.when(pressure < 60.0, F.lit(3.0)).otherwise(F.lit(1.0)),
    ])


def other_policy_columns(names=RHO) -> dict[str, Column]:
    return _normalised(names, [
        (k() % 5 + 2).cast("double"),
        (k() % 3 + 1).cast("double"),
        F.when(F.col("lactate_mmol_l") > 3.0, F.lit(5.0)).otherwise(F.lit(1.0)),
    ])


def estimates(spark: SparkSession, sf_dir: str, split: str | None = None) -> DataFrame:
    """The written estimates table, as a cross-fit would leave it; ``split`` prunes files."""
    df = _once(
        spark, sf_dir, "estimates", lambda: with_estimates(trajectories(spark, sf_dir)), "split"
    )
    return df.filter(F.col("split") == split) if split else df


def folded(spark: SparkSession, sf_dir: str, n_splits: int) -> DataFrame:
    """Training rows with reward and patient-disjoint fold, written once."""
    def build() -> DataFrame:
        rows = with_reward(trajectories(spark, sf_dir).filter(F.col("split") == "train"))
        return with_folds(rows, n_splits)

    return _once(spark, sf_dir, f"folded-{n_splits}", build, "fold")


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimates(spark, sf_dir, "train")


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation rows with two target policies."""
    df = estimates(spark, sf_dir, "validation")
    return df.withColumns({**policy_columns(F.col("map_mm_hg")), **other_policy_columns()})


def defective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trajectory table with defects put in by formula, for the validation gates."""
    df = trajectories(spark, sf_dir)
    broken = df.withColumns({
        "patient_id": F.when(k() != 97, F.col("patient_id")),
        "observed_clinician_action": F.when(k() == 89, F.lit("discharge"))
        .when(k() != 83, F.col("observed_clinician_action")),
        "split": F.when(k() != 79, F.col("split")),
        "terminal": F.when(k() == 53, 1 - F.col("terminal")).otherwise(F.col("terminal")),
    })
    return broken.unionByName(broken.filter(k() == 71))


def responses() -> Column:
    """A raw response as a formula of the state: valid, malformed and out-of-range ones."""
    def text(a, b, c, rest='"rationale":"formula"'):
        return F.lit(
            f'{{"prob_maintain":{a},"prob_iv_fluids":{b},"prob_escalate_vasopressor":{c},{rest}}}'
        )

    kind = k() % 12
    return (
        F.when(kind == 0, F.lit("not json"))
        .when(kind == 1, text("-0.1", "0.6", "0.5"))
        .when(kind == 2, text("0", "0", "0"))
        .when(kind == 3, text("0.2", "0.3", "0.5", '"rationale":"extra","more":1'))
        .when(kind == 5, text("1.5", "0.1", "0.1"))
        .when(kind == 6, text("0.5", "0.5", "0.5"))
        .when(kind == 7, text("0.2", "0.3", "0.5", '"rationale":"   "'))
        .otherwise(F.concat(
            F.lit('{"prob_maintain":0.'), (k() % 40 + 50).cast("string"),
            F.lit(',"prob_iv_fluids":0.'), (k() % 30 + 10).cast("string"),
            F.lit(',"prob_escalate_vasopressor":0.05,"rationale":"  pressure '),
            F.col("map_mm_hg").cast("int").cast("string"), F.lit(' observed "}'),
        ))
    )


def requests(df: DataFrame) -> DataFrame:
    keyed = df.select("patient_id", "time_step", *DEFAULT.observations)
    return zero_shot_messages(keyed, keep=["patient_id", "time_step"])


def response_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache records for part of the states; some belong to another prompt version."""
    def build() -> DataFrame:
        rows = trajectories(spark, sf_dir).filter(k() % 4 != 0).select(
            responses().alias("raw_response"), (k() % 17).alias("_m"), *DEFAULT.observations
        )
        rows = with_cache_key(zero_shot_messages(rows, keep=["raw_response", "_m"]), CLIENT)
        return rows.select(
            F.lit(CACHE_FORMAT_VERSION).alias("cache_format_version"),
            "cache_key",
            F.lit(CLIENT.model_id).alias("model_id"),
            F.when(F.col("_m") == 1, "zero_shot_v0").otherwise(CLIENT.prompt_version).alias("prompt_version"),
            "raw_response",
            F.lit(RESPONSE_SCHEMA_VERSION).alias("response_schema_version"),
            F.lit(CLIENT.temperature).alias("temperature"),
        ).dropDuplicates(["cache_key"])

    return _once(spark, sf_dir, "response-cache", build)


def response_cache_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the records are, for those who read the cache as a table of files."""
    response_cache(spark, sf_dir)
    return table_path(spark, "response-cache", sf_dir)
