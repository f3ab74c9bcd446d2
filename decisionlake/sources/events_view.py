"""Trajectories derived from an ``events`` table: one user is one patient, one event one decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.operators.scale import TASK_ROWS, neighbours

FIELDS = ("map_mm_hg", "k", "value")


def micros(events: DataFrame, ts: str) -> Column:
    """Microseconds in time order, whatever the session's time zone."""
    if not isinstance(events.schema[ts].dataType, T.TimestampNTZType):
        return F.unix_micros(ts)
    # A wall-clock time has no zone: a cast would bend it at daylight-saving changes.
    return F.expr(
        f"unix_date(CAST({ts} AS DATE)) * 86400000000L + (hour({ts}) * 3600L + minute({ts}) * 60L) * 1000000L"
        f" + CAST(extract(SECOND FROM {ts}) * 1000000 AS BIGINT)"
    )


def trajectories_from_events(
    events: DataFrame, row_bound: int | None = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    def coded(cond, yes, no):
        return F.when(cond, F.lit(yes)).otherwise(F.lit(no))

    uid, k, value, pressure = F.col("uid"), F.col("k"), F.col("value"), F.col("map_mm_hg")
    base = events.select(
        F.col("user_id").cast("bigint").alias("uid"),
        "event_id",
        micros(events, "ts").alias("at"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.when(F.col("event_type").isin("view", "click", "signup"), "maintain")
        .when(F.col("event_type") == "error", "iv_fluids")
        .otherwise("escalate_vasopressor")
        .alias("action"),
        (F.lit(50.0) + F.least("value", F.lit(100.0)) * 0.5).alias("map_mm_hg"),
    )
    steps = neighbours(
        base,
        "uid",
        "at",
        tie=("event_id",),
        number="time_step",
        behind=("before", ("action",)),
        ahead=("after", FIELDS),
        row_bound=row_bound,
        task_rows=task_rows,
    )
    hashed = F.conv(F.substring(F.md5(F.concat(F.lit("42:"), uid.cast("string"))), 1, 8), 16, 10).cast("bigint")
    steps = steps.withColumns(
        {"h": hashed % 10, "prev": F.coalesce(F.col("before.action"), F.lit("maintain"))}
    )
    prev, action, after = F.col("prev"), F.col("action"), F.col("after")

    def lab(modulus, expr):
        return F.when(k % modulus != 0, expr.cast("double"))

    return steps.select(
        F.concat(F.lit("p"), F.when(uid.cast("string").rlike("^.{6}"), uid.cast("string")).otherwise(F.lpad(uid.cast("string"), 6, "0"))).alias("patient_id"),
        "time_step",
        (F.col("time_step") * 6).alias("hours_since_admission"),
        F.when(F.col("h") < 6, "train").when(F.col("h") < 8, "validation").otherwise("test").alias("split"),
        (uid % 60 + 30).alias("age"),
        coded(uid % 2 == 0, "F", "M").alias("sex"),
        coded(uid % 3 == 0, 1, 0).alias("diabetes"),
        coded(uid % 5 == 0, 1, 0).alias("ckd"),
        coded(uid % 7 == 0, 1, 0).alias("copd"),
        "map_mm_hg",
        (pressure * 1.4 + 10.0).alias("systolic_bp"),
        (k + 60).cast("double").alias("heart_rate"),
        (k % 15 + 12).cast("double").alias("respiratory_rate"),
        (k % 10 + 90).cast("double").alias("spo2"),
        ((k % 30) / F.lit(10.0) + 36).alias("temperature_c"),
        lab(11, (k % 40) / F.lit(10.0) + 0.5).alias("creatinine_mg_dl"),
        lab(7, (k % 50) / F.lit(10.0) + 0.5).alias("lactate_mmol_l"),
        lab(13, k % 12 + 4).alias("wbc_k_ul"),
        lab(17, k * 5 + 100).alias("urine_output_6h_ml"),
        coded(prev == "escalate_vasopressor", 1, 0).alias("vasopressor_active_pre_action"),
        (k % 2).alias("antibiotics_active"),
        coded(prev == "iv_fluids", 500.0, 0.0).alias("iv_fluids_previous_6h_ml"),
        prev.alias("previous_action"),
        action.alias("observed_clinician_action"),
        F.coalesce(after["map_mm_hg"] - pressure, F.lit(0.0)).alias("next_6h_map_delta"),
        ((F.coalesce(after["k"], k) - k) / F.lit(100.0)).alias("next_6h_lactate_delta"),
        coded(F.coalesce(after["value"], F.lit(0.0)) > 150.0, 1, 0).alias("next_6h_deterioration"),
        coded(value < 1.0, 1, 0).alias("adverse_hypotension_next_6h"),
        coded((action == "iv_fluids") & (k % 13 == 0), 1, 0).alias("adverse_fluid_overload_next_6h"),
        coded((action == "escalate_vasopressor") & (k % 12 == 0), 1, 0).alias("adverse_tachyarrhythmia_next_6h"),
        coded(after.isNull() | after["value"].isNull(), 1, 0).alias("terminal"),
    )
