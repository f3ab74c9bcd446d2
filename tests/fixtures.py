"""Small frames: one row per decision, every state column filled unless overridden."""

from pyspark.sql import functions as F

from decisionlake.spec import ACTIONS, OBSERVATIONS, OUTCOMES


def state(**overrides):
    row = {c: 0.0 for c in OBSERVATIONS}
    row |= {"age": 60, "sex": "F", "map_mm_hg": 70.0, "lactate_mmol_l": 1.5, "previous_action": "maintain"}
    return row | overrides


def outcomes(**overrides):
    row = dict.fromkeys(OUTCOMES, 0)
    row |= {"next_6h_map_delta": 0.0, "next_6h_lactate_delta": 0.0}
    return row | overrides


def frame(spark, rows):
    """Types by name, so that None and mixed numbers are fine."""
    text = {"sex", "previous_action", "patient_id", "split", "observed_clinician_action", "handoff_note"}
    whole = {"time_step", "terminal", "age", "diabetes", "ckd", "copd", "vasopressor_active_pre_action",
             "antibiotics_active", "fold"} | set(OUTCOMES[2:])
    names = list(dict.fromkeys(n for r in rows for n in r))
    kinds = [f"{n} {'string' if n in text else 'int' if n in whole else 'double'}" for n in names]

    def value(name, v):
        if v is None or name in text:
            return v
        return int(v) if name in whole else float(v)

    return spark.createDataFrame([tuple(value(n, r.get(n)) for n in names) for r in rows], ", ".join(kinds))


def training(spark, patients=12, reward=lambda p, i: 0.1 * p + i):
    return frame(spark, [
        {"patient_id": f"p{p:03d}", "time_step": i, "split": "train", "observed_clinician_action": a,
         **state(map_mm_hg=60.0 + p, lactate_mmol_l=3.0 - i, heart_rate=80.0 + (p * 7 + i * 3) % 11,
                 spo2=90.0 + (p * 5 + i) % 7),
         "reward": reward(p, i)}
        for p in range(patients) for i, a in enumerate(ACTIONS)
    ])


def injected(df, b=(0.6, 0.25, 0.15), ridge=(0.0, 0.2, 0.6), nonlinear=(0.0, 0.3, 0.7)):
    columns = {"fold": F.lit(1)}
    for stem, values in (("b", b), ("ridge", ridge), ("nonlinear", nonlinear)):
        columns |= {f"{stem}_{i}": F.lit(float(v)) for i, v in enumerate(values)}
    return df.withColumns(columns)
