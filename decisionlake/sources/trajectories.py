"""Load trajectories from a frame or a file, with one missing value: NULL."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.spec import DEFAULT, TrajectorySpec, trajectory_schema

# Texts that a CSV reader takes for missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing value from here on: floating NaN becomes NULL."""
    floating = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns(
        {c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in floating}
    ) if floating else df


def load_trajectories(
    spark: SparkSession,
    source: DataFrame | str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A frame passes through; ``.parquet`` keeps its schema; anything else reads as CSV."""
    if isinstance(source, DataFrame):
        return nan_to_null(source)
    if source.rstrip("/").endswith(".parquet"):
        return nan_to_null(spark.read.parquet(source))
    return nan_to_null(_read_csv(spark, source, schema))


def _read_csv(spark, path, schema):
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f.dataType for f in (schema or trajectory_schema(("handoff_note", "reward"))).fields}
    texts = spark.read.schema(
        T.StructType([T.StructField(c, T.StringType()) for c in header])
    ).csv(path, header=True)
    # Typed by name; try_cast so that a text in a numeric field is missing, not an error.
    return texts.select(*[
        F.when(~F.col(c).isin(*MISSING_TEXTS), F.col(c))
        .try_cast(known.get(c, T.StringType()))
        .alias(c)
        for c in header
    ])


def load_observation_columns(source: Sequence[str] | str) -> tuple[str, ...]:
    """A list of names, or the path of a JSON list of names."""
    if isinstance(source, str):
        with open(source, encoding="utf-8") as file:
            source = json.load(file)
        if not isinstance(source, list):
            raise ValueError("Observation columns must be a JSON list of strings.")
    names = tuple(source)
    if not all(isinstance(n, str) for n in names):
        raise ValueError("Observation columns must be strings.")
    return names


def observations(df: DataFrame, spec: TrajectorySpec = DEFAULT, key: bool = False) -> DataFrame:
    """Exactly the allowed pre-action columns, in canonical order."""
    return df.select(*(spec.key if key else ()), *spec.observations)
