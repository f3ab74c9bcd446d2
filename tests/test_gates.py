"""What builders, retrieval and storage refuse."""

import pytest
from pyspark.sql import functions as F

from decisionlake.operators import bias, contrastive, factual, nuisance, retrieval, validate
from decisionlake.sources import storage
from tests.fixtures import injected, training

BUILDERS = {
    "contrastive": contrastive.build_contrastive_examples,
    "contrastive report": contrastive.contrastive_report,
    "factual": factual.factual_library,
    "bias": bias.bias_report,
}


def defects():
    return {
        "split": {"split": F.when(F.col("time_step") == 1, "validation").otherwise("train")},
        "unknown action": {"observed_clinician_action": F.when(F.col("time_step") == 1, "discharge").otherwise(F.col("observed_clinician_action"))},
        "missing action": {"observed_clinician_action": F.when(F.col("time_step") != 1, F.col("observed_clinician_action"))},
        "reward": {"reward": F.when(F.col("time_step") == 1, float("nan")).otherwise(F.col("reward"))},
        "no reward": {"reward": F.when(F.col("time_step") != 1, F.col("reward"))},
        "probabilities": {"b_0": F.when(F.col("time_step") == 1, 0.9).otherwise(F.col("b_0"))},
        "fold": {"fold": F.when(F.col("time_step") != 1, F.col("fold"))},
    }


@pytest.mark.parametrize("builder", sorted(BUILDERS))
def test_builders_refuse_defective_sources(spark, builder):
    good = injected(training(spark)).cache()
    BUILDERS[builder](good)
    for name, columns in defects().items():
        with pytest.raises(ValueError):
            BUILDERS[builder](good.withColumns(columns))
            raise AssertionError(name)


def library(spark, patients):
    rows = injected(training(spark, patients, reward=lambda p, i: float(p)))
    return factual.factual_library(rows, factual.FactualRules(max_examples_per_cell=5))


def test_retrieval_refuses_a_short_cell(spark):
    full = library(spark, 30).cache()
    states = training(spark, 4)
    found = retrieval.retrieve_examples(states, full, exclude="patient_id")
    assert found.count() == states.count() * 6
    assert found.filter(F.col("source_patient_id") == F.col("patient_id")).isEmpty()
    short = full.filter("action <> 'iv_fluids' OR outcome_label <> 'favorable' OR library_rank % 100 = 0")
    with pytest.raises(ValueError, match="fewer than 2"):
        retrieval.retrieve_examples(states, short, examples_per_cell=2)
    one = full.groupBy("action", "outcome_label").agg(F.min("library_rank").alias("library_rank"))
    single = full.join(one.select("library_rank"), "library_rank")
    owner = single.first().source_patient_id
    with pytest.raises(ValueError, match="after exclusions"):
        retrieval.retrieve_examples(states.filter("patient_id = 'p000'").withColumn("patient_id", F.lit(owner)), single, exclude="patient_id")


def test_leakage_is_found_in_one_scan(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "validation"), ("b", "train"), ("c", "validation"), (None, "train"), (None, "validation"), ("d", "test")],
                               "patient_id string, split string")
    out = validate.split_leakage(df)
    assert sorted(map(str, (r[0] for r in out.collect()))) == ["None", "a"]


def test_cross_fit_results_do_not_replace_each_other(spark):
    config = nuisance.CrossFitConfig(n_splits=2, rewards={"ridge": nuisance.RIDGE})
    df = training(spark)
    first = nuisance.cross_fit(df, config)
    second = nuisance.cross_fit(df, config)
    assert first.count() == second.count() == df.count()


def test_a_cluster_must_name_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master, applicationId = "spark://host:7077", "app"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session())
