"""Patient-disjoint, action-balanced folds as a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionlake.functions.vectors import rate
from decisionlake.operators.scale import number_in_blocks
from decisionlake.spec import DEFAULT, TrajectorySpec


def seeded_hash(seed: int, patient: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(patient).cast("string")))


def hash_fold(n_splits: int = 5, seed: int = 42, spec: TrajectorySpec = DEFAULT) -> Column:
    """Fold 1..n from the patient alone: no shuffle."""
    return (
        F.conv(F.substring(seeded_hash(seed, spec.patient), 1, 8), 16, 10).cast("bigint")
        % n_splits + 1
    ).cast("int")


def patient_folds(
    df: DataFrame,
    n_splits: int = 5,
    seed: int = 42,
    *,
    width: float = 0.05,
    strata: int = 10,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """``patient, fold``: patients of similar action mix are dealt round-robin.

    Patients are grouped into strata by their share of each action but the first, put in
    seeded-hash order inside a stratum, and dealt to the folds continuing where the
    previous stratum stopped. The hash prefix splits even the largest stratum into blocks.
    """
    if n_splits < 2:
        raise ValueError("n_splits must be at least two.")
    stratum = F.lit(0)
    for action in spec.actions[1:]:
        share = rate(F.col(spec.action) == action)
        stratum = stratum * strata + F.least(F.floor(share / width), F.lit(strata - 1))
    patients = df.groupBy(spec.patient).agg(stratum.cast("int").alias("stratum"))
    numbered = number_in_blocks(
        patients.withColumn("_hash", seeded_hash(seed, spec.patient)),
        ["stratum"],
        F.substring("_hash", 1, 3),
        ["_hash", spec.patient],
        "_place",
    )
    # At most strata ** (actions - 1) rows: one task is enough.
    sizes = patients.groupBy("stratum").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("stratum").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("stratum", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    return numbered.join(F.broadcast(shift), "stratum").select(
        spec.patient, ((F.col("_place") + F.col("_shift")) % n_splits + 1).cast("int").alias("fold")
    )


def with_folds(
    df: DataFrame,
    n_splits: int = 5,
    seed: int = 42,
    *,
    strategy: str = "stratified",
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Add ``fold``. Raises when there are fewer patients than folds."""
    if n_splits < 2:
        raise ValueError("n_splits must be at least two.")
    if df.select(spec.patient).distinct().limit(n_splits).count() < n_splits:
        raise ValueError("Number of patients must be at least n_splits.")
    if strategy == "hash":
        return df.withColumn("fold", hash_fold(n_splits, seed, spec))
    if strategy != "stratified":
        raise ValueError(f"Unknown fold strategy: {strategy!r}")
    return df.join(patient_folds(df, n_splits, seed, spec=spec), spec.patient)
