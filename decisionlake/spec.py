"""What a trajectory table looks like: names of columns, roles and the action order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The canonical action order and the allowed pre-action fields, in order.
ACTIONS = ("maintain", "iv_fluids", "escalate_vasopressor")
OBSERVATIONS = (
    "age",
    "sex",
    "diabetes",
    "ckd",
    "copd",
    "map_mm_hg",
    "systolic_bp",
    "heart_rate",
    "respiratory_rate",
    "spo2",
    "temperature_c",
    "creatinine_mg_dl",
    "lactate_mmol_l",
    "wbc_k_ul",
    "urine_output_6h_ml",
    "vasopressor_active_pre_action",
    "antibiotics_active",
    "iv_fluids_previous_6h_ml",
    "previous_action",
)
CATEGORICAL = ("sex", "previous_action")
OUTCOMES = (
    "next_6h_map_delta",
    "next_6h_lactate_delta",
    "next_6h_deterioration",
    "adverse_hypotension_next_6h",
    "adverse_fluid_overload_next_6h",
    "adverse_tachyarrhythmia_next_6h",
)


@dataclass(frozen=True)
class TrajectorySpec:
    """Column roles. The clinical names are only the default."""

    patient: str = "patient_id"
    step: str = "time_step"
    split: str = "split"
    action: str = "observed_clinician_action"
    terminal: str = "terminal"
    reward: str = "reward"
    note: str = "handoff_note"
    pressure: str = "map_mm_hg"
    lactate: str = "lactate_mmol_l"
    vasopressor: str = "vasopressor_active_pre_action"
    fluids: str = "iv_fluids_previous_6h_ml"
    low_pressure: float = 65.0
    actions: tuple[str, ...] = ACTIONS
    observations: tuple[str, ...] = OBSERVATIONS
    categorical: tuple[str, ...] = CATEGORICAL
    outcomes: tuple[str, ...] = OUTCOMES

    def __post_init__(self):
        if len(set(self.observations)) != len(self.observations):
            raise ValueError("Observation columns must be unique.")
        if len(self.actions) < 2 or len(set(self.actions)) != len(self.actions):
            raise ValueError("At least two distinct actions are required.")

    @property
    def numeric(self) -> tuple[str, ...]:
        return tuple(c for c in self.observations if c not in self.categorical)

    @property
    def key(self) -> tuple[str, str]:
        return (self.patient, self.step)

    def indexed(self, stem: str) -> list[str]:
        """Flat column names of one value per action, in canonical action order."""
        return [f"{stem}_{i}" for i in range(len(self.actions))]


DEFAULT = TrajectorySpec()

_INT = ("time_step", "hours_since_admission", "age", "diabetes", "ckd", "copd",
        "vasopressor_active_pre_action", "antibiotics_active", "terminal") + OUTCOMES[2:]
_TEXT = ("patient_id", "split", "sex", "hospital_id", "provider_id", "previous_action",
         "observed_clinician_action")

#: Column order of a trajectory file.
FILE_COLUMNS = (
    ("patient_id", "time_step", "hours_since_admission", "split", "age", "sex",
     "hospital_id", "provider_id", "diabetes", "ckd", "copd")
    + OBSERVATIONS[5:]
    + ("observed_clinician_action",)
    + OUTCOMES
    + ("terminal",)
)


def trajectory_schema(extra: tuple[str, ...] = ()) -> T.StructType:
    """Explicit schema of a trajectory file, so that a read never infers types."""
    fields = []
    for name in FILE_COLUMNS + tuple(extra):
        if name in _INT:
            kind = T.IntegerType()
        elif name in _TEXT or name == "handoff_note":
            kind = T.StringType()
        else:
            kind = T.DoubleType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)
