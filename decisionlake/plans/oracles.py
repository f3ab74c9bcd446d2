"""The registered queries as SQL over the same tables, for the driver's comparison."""

from __future__ import annotations

from decisionlake.functions import prompts
from decisionlake.operators.evaluate import poisson_steps
from decisionlake.operators.metrics import EDGES
from decisionlake.spec import ACTIONS, CATEGORICAL, DEFAULT, OBSERVATIONS, OUTCOMES

OBS = ", ".join(OBSERVATIONS)
NUMERIC = DEFAULT.numeric
ACT = "observed_clinician_action"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TRAJ = """
e AS (
  SELECT CAST(user_id AS BIGINT) AS uid, event_id, ts, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CAST(('0x' || substr(md5('42:' || CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) AS h,
         CASE WHEN event_type IN ('view','click','signup') THEN 'maintain'
              WHEN event_type = 'error' THEN 'iv_fluids'
              ELSE 'escalate_vasopressor' END AS action,
         50e0 + least(value, 100e0) * 0.5e0 AS map
  FROM events
), t AS (
  SELECT *,
    CAST(row_number() OVER w - 1 AS BIGINT) AS time_step,
    lag(action, 1, 'maintain') OVER w AS prev,
    lead(map) OVER w AS next_map, lead(k) OVER w AS next_k, lead(value) OVER w AS next_value
  FROM e WINDOW w AS (PARTITION BY uid ORDER BY ts, event_id)
), traj AS (
SELECT
  concat('p', lpad(CAST(uid AS VARCHAR), CAST(greatest(6, length(CAST(uid AS VARCHAR))) AS INT), '0')) AS patient_id,
  time_step,
  time_step * 6 AS hours_since_admission,
  CASE WHEN h % 10 < 6 THEN 'train' WHEN h % 10 < 8 THEN 'validation' ELSE 'test' END AS split,
  30 + uid % 60 AS age,
  CASE WHEN uid % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
  CASE WHEN uid % 3 = 0 THEN 1 ELSE 0 END AS diabetes,
  CASE WHEN uid % 5 = 0 THEN 1 ELSE 0 END AS ckd,
  CASE WHEN uid % 7 = 0 THEN 1 ELSE 0 END AS copd,
  CAST(map AS DOUBLE) AS map_mm_hg,
  CAST(map * 1.4e0 + 10e0 AS DOUBLE) AS systolic_bp,
  CAST(60 + k AS DOUBLE) AS heart_rate,
  CAST(12 + k % 15 AS DOUBLE) AS respiratory_rate,
  CAST(90 + k % 10 AS DOUBLE) AS spo2,
  CAST(36 + (k % 30) / 10e0 AS DOUBLE) AS temperature_c,
  CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(0.5e0 + (k % 40) / 10e0 AS DOUBLE) END AS creatinine_mg_dl,
  CASE WHEN k % 7  = 0 THEN NULL ELSE CAST(0.5e0 + (k % 50) / 10e0 AS DOUBLE) END AS lactate_mmol_l,
  CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(4 + k % 12 AS DOUBLE) END AS wbc_k_ul,
  CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(100 + k * 5 AS DOUBLE) END AS urine_output_6h_ml,
  CASE WHEN prev = 'escalate_vasopressor' THEN 1 ELSE 0 END AS vasopressor_active_pre_action,
  k % 2 AS antibiotics_active,
  CAST(CASE WHEN prev = 'iv_fluids' THEN 500 ELSE 0 END AS DOUBLE) AS iv_fluids_previous_6h_ml,
  prev AS previous_action,
  action AS observed_clinician_action,
  CAST(coalesce(next_map - map, 0e0) AS DOUBLE) AS next_6h_map_delta,
  CAST((coalesce(next_k, k) - k) / 100e0 AS DOUBLE) AS next_6h_lactate_delta,
  CASE WHEN coalesce(next_value, 0e0) > 150e0 THEN 1 ELSE 0 END AS next_6h_deterioration,
  CASE WHEN value < 1e0 THEN 1 ELSE 0 END AS adverse_hypotension_next_6h,
  CASE WHEN action = 'iv_fluids' AND k % 13 = 0 THEN 1 ELSE 0 END AS adverse_fluid_overload_next_6h,
  CASE WHEN action = 'escalate_vasopressor' AND k % 12 = 0 THEN 1 ELSE 0 END AS adverse_tachyarrhythmia_next_6h,
  CASE WHEN next_value IS NULL THEN 1 ELSE 0 END AS terminal
FROM t
)"""


def reward_sql(pressure=0.4, lactate=0.4, deterioration=2.0, adverse=1.5) -> str:
    return f"""({pressure}e0 * least(2e0, greatest(-2e0, next_6h_map_delta / 5e0))
      - {lactate}e0 * least(2e0, greatest(-2e0, next_6h_lactate_delta / 0.5e0))
      - {deterioration}e0 * next_6h_deterioration - {adverse}e0 * adverse_hypotension_next_6h
      - {adverse}e0 * adverse_fluid_overload_next_6h - {adverse}e0 * adverse_tachyarrhythmia_next_6h)"""


SAFETY_SQL = reward_sql(0.2, 0.2, 3.0, 2.5)

EST = f"""
scored AS (
  SELECT *, {reward_sql()} AS reward, CAST(heart_rate - 60 AS INT) AS k,
         CAST(substr(patient_id, 2) AS BIGINT) AS uid,
         CAST(('0x' || substr(md5('42:' || patient_id), 1, 8)) AS BIGINT) % 5 + 1 AS fold
  FROM traj
), weighted AS (
  SELECT *, CAST(6 + k % 3 AS DOUBLE) AS w0, CAST(2 + k % 2 AS DOUBLE) AS w1,
         CASE WHEN k % 9 = 0 THEN 0.1e0 ELSE CAST(1 + uid % 2 AS DOUBLE) END AS w2
  FROM scored
), valued AS (
  SELECT * EXCLUDE (w0, w1, w2), w0 / (w0 + w1 + w2) AS b_0, w1 / (w0 + w1 + w2) AS b_1,
         w2 / (w0 + w1 + w2) AS b_2,
         (map_mm_hg - 70e0) / 53e0 AS ridge_0, (k % 50) / 47e0 - 0.3e0 AS ridge_1,
         (75e0 - map_mm_hg) / 41e0 AS ridge_2
  FROM weighted
), est AS (
  SELECT *, ridge_0 + ((k % 7) - 3) / 20e0 AS nonlinear_0, ridge_1 * 0.9e0 AS nonlinear_1,
         ridge_2 + ((uid % 5) - 2) / 10e0 AS nonlinear_2,
         CASE {ACT} WHEN 'maintain' THEN 0 WHEN 'iv_fluids' THEN 1 WHEN 'escalate_vasopressor' THEN 2 END AS a
  FROM valued
), train AS (
  SELECT *, CASE a WHEN 0 THEN b_0 WHEN 1 THEN b_1 ELSE b_2 END AS p,
         CASE a WHEN 0 THEN ridge_0 WHEN 1 THEN ridge_1 ELSE ridge_2 END AS predicted
  FROM est WHERE split = 'train'
), piw AS (
  SELECT *, CAST(3 + k % 4 AS DOUBLE) AS v0, CASE WHEN map_mm_hg < 65 THEN 4e0 ELSE 1e0 END AS v1,
         CASE WHEN map_mm_hg < 60 THEN 3e0 ELSE 1e0 END AS v2,
         CAST(2 + k % 5 AS DOUBLE) AS u0, CAST(1 + k % 3 AS DOUBLE) AS u1,
         CASE WHEN lactate_mmol_l > 3 THEN 5e0 ELSE 1e0 END AS u2
  FROM est WHERE split = 'validation'
), valid AS (
  SELECT *, v0/(v0+v1+v2) AS pi_0, v1/(v0+v1+v2) AS pi_1, v2/(v0+v1+v2) AS pi_2,
         u0/(u0+u1+u2) AS rho_0, u1/(u0+u1+u2) AS rho_1, u2/(u0+u1+u2) AS rho_2
  FROM piw
)"""

DEFECTIVE = f"""
broken AS (
  SELECT * REPLACE (
    CASE WHEN k <> 97 THEN patient_id END AS patient_id,
    CASE WHEN k = 89 THEN 'discharge' WHEN k <> 83 THEN {ACT} END AS {ACT},
    CASE WHEN k <> 79 THEN split END AS split,
    CASE WHEN k = 53 THEN 1 - terminal ELSE terminal END AS terminal)
  FROM (SELECT *, CAST(heart_rate - 60 AS INT) AS k FROM traj)
), defective AS (SELECT * FROM broken UNION ALL SELECT * FROM broken WHERE k = 71)"""


def argmax(stem: str) -> str:
    x, y, z = (f"{stem}_{i}" for i in range(3))
    return f"(CASE WHEN {x} >= {y} AND {x} >= {z} THEN 0 WHEN {y} >= {z} THEN 1 ELSE 2 END)"


def pick(stem: str, index: str) -> str:
    return f"(CASE {index} WHEN 0 THEN {stem}_0 WHEN 1 THEN {stem}_1 WHEN 2 THEN {stem}_2 END)"


def name_of(index: str) -> str:
    return f"(CASE {index} WHEN 0 THEN 'maintain' WHEN 1 THEN 'iv_fluids' WHEN 2 THEN 'escalate_vasopressor' END)"


def share(condition: str) -> str:
    return f"avg(CASE WHEN {condition} THEN 1e0 ELSE 0e0 END)"


def final(body: str, doubles: str = "", ints: str = "", ctes: tuple[str, ...] = (TRAJ, EST)) -> str:
    shown = [f"round(CAST({c} AS DOUBLE), 6) + 0e0 AS {c}" for c in doubles.split()]
    shown += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
    replace = f" REPLACE ({', '.join(shown)})" if shown else ""
    return f"WITH {', '.join(ctes)} SELECT *{replace} FROM ({body}) AS answer"


def union(parts) -> str:
    return " UNION ALL ".join(parts)


STATE_DOUBLES = " ".join(OBSERVATIONS[5:15]) + " iv_fluids_previous_6h_ml"
STATE_INTS = "age diabetes ckd copd vasopressor_active_pre_action antibiotics_active"
OUTCOME_INTS = " ".join(OUTCOMES[2:])
KEY = "patient_id, time_step"
SQL: dict[str, str] = {}


# ------------------------------------------------------------- sources and projections

_ALL = final("SELECT * FROM traj", STATE_DOUBLES + " next_6h_map_delta next_6h_lactate_delta",
             f"{STATE_INTS} time_step hours_since_admission {OUTCOME_INTS} terminal", (TRAJ,))
SQL["load_trajectories_table"] = SQL["trajectories_from_events"] = _ALL
SQL["observation_rows"] = final(f"SELECT {KEY}, {OBS} FROM traj", STATE_DOUBLES, STATE_INTS + " time_step", (TRAJ,))

SQL["duplicate_transitions"] = final(
    f"SELECT {KEY}, count(*) AS copies FROM defective GROUP BY ALL HAVING count(*) > 1", "", "time_step", (TRAJ, DEFECTIVE))
SQL["unknown_actions"] = final(
    f"SELECT {ACT} AS action, count(*) AS bad_rows FROM defective WHERE {ACT} NOT IN {ACTIONS} GROUP BY ALL",
    ctes=(TRAJ, DEFECTIVE))
_TERMINAL = """SELECT patient_id, sum(terminal) AS terminal_rows,
  max(CASE WHEN time_step = last_step THEN terminal END) AS terminal_at_last_step
  FROM (SELECT *, max(time_step) OVER (PARTITION BY patient_id) AS last_step FROM defective WHERE patient_id IS NOT NULL)
  GROUP BY patient_id"""
SQL["terminal_violations"] = final(
    f"SELECT * FROM ({_TERMINAL}) WHERE terminal_rows <> 1 OR terminal_at_last_step <> 1",
    "", "terminal_rows terminal_at_last_step", (TRAJ, DEFECTIVE))
SQL["split_violations"] = final(
    "SELECT split, count(*) AS bad_rows FROM defective WHERE split IS DISTINCT FROM 'train' GROUP BY split",
    ctes=(TRAJ, DEFECTIVE))
_RULES = {
    "missing_patient": "count(*) FILTER (patient_id IS NULL)",
    "missing_action": f"count(*) FILTER ({ACT} IS NULL)",
    "missing_split": "count(*) FILTER (split IS NULL)",
    "unknown_action": f"count(*) FILTER ({ACT} NOT IN {ACTIONS})",
    "not_train": "count(*) FILTER (split <> 'train')",
    "empty_table": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
    **{f"absent_action_{a}": f"CASE WHEN count(*) FILTER ({ACT} = '{a}') = 0 THEN 1 ELSE 0 END" for a in ACTIONS},
}
SQL["validation_report"] = final(union(
    [f"SELECT '{r}' AS rule, {c} AS violations FROM defective" for r, c in _RULES.items()]
    + [f"SELECT 'duplicate_key', count(*) FROM (SELECT {KEY} FROM defective GROUP BY ALL HAVING count(*) > 1)",
       f"SELECT 'terminal_rule', count(*) FROM ({_TERMINAL}) WHERE terminal_rows <> 1 OR terminal_at_last_step <> 1"]
), "", "violations", (TRAJ, DEFECTIVE))
SQL["probability_violations"] = final(
    f"""SELECT * FROM (SELECT {KEY}, CASE WHEN k = 13 THEN b_0 + 1e-3 WHEN k = 14 THEN -b_0 ELSE b_0 END AS b_0, b_1, b_2 FROM est)
    WHERE NOT (b_0 >= 0 AND b_1 >= 0 AND b_2 >= 0 AND abs(b_0 + b_1 + b_2 - 1) <= 1e-9)""", "b_0 b_1 b_2")
SQL["split_leakage"] = final(
    """SELECT DISTINCT patient_id FROM t2 WHERE split = 'train'
       INTERSECT SELECT patient_id FROM t2 WHERE split = 'validation'""",
    ctes=(TRAJ, "t2 AS (SELECT patient_id, CASE WHEN heart_rate = 65 THEN 'validation' ELSE split END AS split FROM traj)"))

# --------------------------------------------------------------- rewards and episodes

SQL["reward"] = final(f"SELECT {KEY}, {reward_sql()} AS reward FROM traj", "reward", ctes=(TRAJ,))
SQL["reward_alt"] = final(f"SELECT {KEY}, {SAFETY_SQL} AS reward FROM traj", "reward", ctes=(TRAJ,))
SQL["episode_metadata"] = final(
    """SELECT patient_id, count(*) AS episode_length, min(time_step) AS first_time_step,
       false AS handoff_note_available FROM traj GROUP BY patient_id""", ctes=(TRAJ,))
SQL["episode_first_observation"] = final(
    f"""SELECT {KEY}, {OBS} FROM traj QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY time_step) = 1""",
    STATE_DOUBLES, STATE_INTS, (TRAJ,))
SQL["episode_sample"] = final(
    """SELECT patient_id FROM (SELECT DISTINCT patient_id FROM traj)
       ORDER BY md5('42:' || patient_id), patient_id LIMIT 20""", ctes=(TRAJ,))
SQL["logged_transitions"] = final(
    f"""SELECT {KEY}, {ACT} AS action, {reward_sql()} AS reward,
    CASE WHEN terminal <> 1 THEN lead(time_step) OVER w END AS next_time_step,
    terminal = 1 AS done, true AS logged_transition, map_mm_hg, lactate_mmol_l, previous_action,
    CASE WHEN terminal <> 1 THEN lead(map_mm_hg) OVER w END AS next_map_mm_hg,
    CASE WHEN terminal <> 1 THEN lead(lactate_mmol_l) OVER w END AS next_lactate_mmol_l,
    CASE WHEN terminal <> 1 THEN lead(previous_action) OVER w END AS next_previous_action
    FROM traj WINDOW w AS (PARTITION BY patient_id ORDER BY time_step)""",
    "reward map_mm_hg lactate_mmol_l next_map_mm_hg next_lactate_mmol_l", "next_time_step", (TRAJ,))
SQL["reward_and_outcomes_by_action"] = final(
    f"""SELECT action, done, count(*) AS transitions, avg(reward) AS mean_reward, avg(next_map - map_mm_hg) AS mean_pressure_change
    FROM (SELECT {ACT} AS action, terminal = 1 AS done, {reward_sql()} AS reward, map_mm_hg,
      CASE WHEN terminal <> 1 THEN lead(map_mm_hg) OVER (PARTITION BY patient_id ORDER BY time_step) END AS next_map FROM traj)
    GROUP BY action, done""", "mean_reward mean_pressure_change", ctes=(TRAJ,))
SQL["hash_folds"] = final(f"SELECT {KEY}, fold FROM scored", "", "fold")
_FOLDS = f"""SELECT patient_id, (row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || patient_id), patient_id) - 1 + before) % 5 + 1 AS fold
    FROM strata JOIN (SELECT stratum, coalesce(sum(n) OVER (ORDER BY stratum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT stratum, count(*) AS n FROM strata GROUP BY stratum)) USING (stratum)"""
_STRATA = f"""strata AS (SELECT patient_id,
      CAST(least(floor({share(f"{ACT} = 'iv_fluids'")} / 0.05e0), 9) * 10
         + least(floor({share(f"{ACT} = 'escalate_vasopressor'")} / 0.05e0), 9) AS INT) AS stratum
      FROM traj WHERE split = 'train' GROUP BY patient_id)"""
SQL["group_folds"] = final(_FOLDS, "", "fold", (TRAJ, _STRATA))
SQL["cross_fit_facts"] = final(
    f"""SELECT {KEY}, {ACT} AS observed_clinician_action, fold, true AS is_distribution, true AS has_finite_values
    FROM traj JOIN ({_FOLDS}) AS f USING (patient_id) WHERE split = 'train'""", "", "fold", (TRAJ, _STRATA))


def facts(stage: str, *pairs: tuple[str, str], source: str, action: str = "NULL") -> str:
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, CAST({action} AS VARCHAR) AS action, '{m}' AS metric, CAST({v} AS DOUBLE) AS value FROM {source}"
        for m, v in pairs)


_OBSERVED = f"(SELECT {ACT} AS a, count(*) AS n, avg({reward_sql()}) AS m FROM traj WHERE split = 'train' GROUP BY 1)"
_COUNTED = "(SELECT count(*) AS states, count(*) FILTER (WHERE split = 'train') AS n FROM traj)"
SQL["end_to_end_facts"] = final(" UNION ALL ".join([
    facts("observed_reward", ("rows", "n"), ("mean", "m"), source=_OBSERVED, action="a"),
    facts("funnel", ("source_rows", "n"), ("rising_stages", "0"), source=_COUNTED),
    facts("contrastive", ("unsound", "0"), source=_COUNTED),
    facts("library", ("unfaithful", "0"), ("repeated_patients", "0"), source=_COUNTED),
    facts("retrieval", ("examples", "6 * states"), ("own_patient", "0"), source=_COUNTED),
    facts("evaluation", ("rows", "n"), ("gap", "0"), source=_COUNTED),
]), "value", ctes=(TRAJ,))
# --------------------------------------------------------------------------- features


def feature_ctes(source: str) -> str:
    """``stats``: one row with median, mean and scale of every numeric column and the modes."""
    med = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_md" for c in NUMERIC)
    moments = ", ".join(
        f"avg(coalesce({c}, {c}_md)) AS {c}_mn, stddev_pop(coalesce({c}, {c}_md)) AS {c}_s" for c in NUMERIC)
    keep = ", ".join(f"any_value({c}_md) AS {c}_md" for c in NUMERIC)
    modes = ", ".join(
        f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}_mode"
        for c in CATEGORICAL)
    scales = ", ".join(f"CASE WHEN {c}_s <= 1e-12 * abs({c}_mn) THEN 1e0 ELSE {c}_s END AS {c}_sc" for c in NUMERIC)
    return f"""medians AS (SELECT {med} FROM {source}),
    moments AS (SELECT {keep}, {moments} FROM {source}, medians),
    stats AS (SELECT *, {scales}, {modes} FROM moments)"""


SEXES = ("F", "M")
PREVIOUS = tuple(sorted(ACTIONS))


def feature_exprs(table: str = "q") -> list[tuple[str, str]]:
    out = [(c, f"(coalesce({table}.{c}, {c}_md) - {c}_mn) / {c}_sc") for c in NUMERIC]
    for c, levels in (("sex", SEXES), ("previous_action", PREVIOUS)):
        out += [(f"{c}={v}", f"CASE WHEN coalesce({table}.{c}, {c}_mode) = '{v}' THEN 1e0 ELSE 0e0 END") for v in levels]
    return out


SQL["feature_stats"] = final(
    union([f"SELECT '{c}' AS feature, {c}_md AS median, {c}_mn AS mean, {c}_sc AS scale, CAST(NULL AS VARCHAR) AS mode FROM stats" for c in NUMERIC]
          + [f"SELECT '{c}', NULL, NULL, NULL, {c}_mode FROM stats" for c in CATEGORICAL]),
    "median mean scale", ctes=(TRAJ, EST, feature_ctes("train")))
SQL["standardized_features"] = (
    f"WITH {TRAJ}, {EST}, {feature_ctes('train')} SELECT {KEY}, "
    + ", ".join(f'round({x}, 6) + 0e0 AS "{n}"' for n, x in feature_exprs())
    + " FROM traj AS q, stats")

# ----------------------------------------------------------------- estimates and models


def side_stats(name: str, keys: str) -> str:
    """Medians, moments and modes of the training rows of each held-out fold."""
    med = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_md" for c in NUMERIC)
    moments = ", ".join(
        f"any_value({c}_md) AS {c}_md, avg(coalesce({c}, {c}_md)) AS {c}_mn, stddev_pop(coalesce({c}, {c}_md)) AS {c}_s" for c in NUMERIC)
    scales = ", ".join(f"CASE WHEN {c}_s <= 1e-12 * abs({c}_mn) THEN 1e0 ELSE {c}_s END AS {c}_sc" for c in NUMERIC)
    modes = ", ".join(
        f"{name}_{c} AS (SELECT {keys}, first({c} ORDER BY n DESC, {c}) AS {c}_mode FROM (SELECT {keys}, {c}, count(*) AS n "
        f"FROM sided WHERE {c} IS NOT NULL GROUP BY ALL) GROUP BY ALL)" for c in CATEGORICAL)
    joins = " ".join(f"JOIN {name}_{c} USING ({keys})" for c in CATEGORICAL)
    return f"""{name}_md AS (SELECT {keys}, {med} FROM sided GROUP BY {keys}),
    {name}_mm AS (SELECT {keys}, {moments} FROM sided JOIN {name}_md USING ({keys}) GROUP BY {keys}),
    {modes}, {name} AS (SELECT *, {scales} FROM {name}_mm {joins})"""


def side_moments(model: str, action: str, target: str, source: str) -> str:
    features = [("1", "1e0"), *feature_exprs()]
    names = ", ".join(quote(n) for n, _ in features)
    means = ", ".join(f"avg({x} * {target})" for _, x in features)
    return f"""SELECT '{model}' AS model, side, action, unnest([{names}]) AS feature, unnest(means) AS moment
    FROM (SELECT side, {action} AS action, [{means}] AS means FROM {source} GROUP BY side, {action})"""


_SIDED = f"""sided AS (
  SELECT traj.*, {reward_sql()} AS reward, side FROM traj JOIN ({_FOLDS}) AS f USING (patient_id),
  (VALUES (0), (1), (2), (3), (4), (5)) AS held(side) WHERE split = 'train' AND fold <> side)"""
#: At a fit's optimum the model's means of feature times class, or times reward, are those in the data.
SQL["cross_fit_certificates"] = final(union([
    side_moments("behavior", "of_class", "CAST(observed_clinician_action = of_class AS INT)",
                 f"sided AS q JOIN of_side USING (side), (VALUES {', '.join(f'({quote(a)})' for a in ACTIONS)}) AS classes(of_class)"),
    side_moments("ridge", ACT, "reward", f"sided AS q JOIN of_action USING (side, {ACT})"),
]), "moment", "side", (TRAJ, _STRATA, _SIDED, side_stats("of_side", "side"), side_stats("of_action", f"side, {ACT}")))

SQL["support_mask"] = final(
    f"SELECT {KEY}, b_0 >= 0.02e0 AS supported_0, b_1 >= 0.02e0 AS supported_1, b_2 >= 0.02e0 AS supported_2 FROM est")
SQL["supported_values"] = final(
    f"SELECT {KEY}, " + ", ".join(f"CASE WHEN b_{i} >= 0.02e0 THEN ridge_{i} END AS ridge_{i}" for i in range(3)) + " FROM est",
    "ridge_0 ridge_1 ridge_2")
SQL["logged_values"] = final(f"SELECT {KEY}, {pick('ridge', 'a')} AS logged_value FROM est", "logged_value")
SQL["top_action"] = final(f"SELECT {KEY}, {name_of(argmax('ridge'))} AS top_action FROM est")

# ----------------------------------------------------------------------------- metrics


def by_fold(measures: str, doubles: str, ints: str = "fold", source: str = "train") -> str:
    return final(f"SELECT fold, {measures} FROM {source} GROUP BY GROUPING SETS ((fold), ())", doubles, ints)


_TOP = argmax("b")
SQL["behavior_log_loss"] = by_fold(
    "count(*) AS rows, avg(-ln(greatest(least(p, 1e0), 2.220446049250313e-16))) AS log_loss", "log_loss")
SQL["behavior_brier"] = by_fold(
    "avg(" + " + ".join(f"power(b_{i} - CASE WHEN a = {i} THEN 1e0 ELSE 0e0 END, 2)" for i in range(3)) + ") AS multiclass_brier",
    "multiclass_brier")
SQL["behavior_accuracy"] = by_fold(f"{share(f'{_TOP} = a')} AS accuracy", "accuracy")
SQL["behavior_macro_f1"] = by_fold(
    "(" + " + ".join(
        f"coalesce(2e0 * count(*) FILTER ({_TOP} = {i} AND a = {i}) / nullif(count(*) FILTER ({_TOP} = {i}) + count(*) FILTER (a = {i}), 0), 0e0)"
        for i in range(3)) + ") / 3 AS macro_f1", "macro_f1")


def bin_sql(p: str) -> str:
    return "(CASE " + " ".join(f"WHEN {p} < {EDGES[i + 1]!r}e0 THEN {i}" for i in range(9)) + " ELSE 9 END)"


SQL["top_label_ece"] = final(
    f"""WITH c AS (SELECT fold, greatest(b_0, b_1, b_2) AS c, CASE WHEN {_TOP} = a THEN 1e0 ELSE 0e0 END AS hit FROM train),
    bins AS (SELECT fold, {bin_sql('c')} AS bin, count(*) AS n, sum(hit) AS hits, sum(c) AS conf FROM c GROUP BY GROUPING SETS ((fold, bin), (bin)))
    SELECT fold, sum(abs(hits - conf)) / sum(n) AS top_label_ece FROM bins GROUP BY fold""", "top_label_ece", "fold")
_LONG = "SELECT * FROM (" + union(
    f"SELECT '{x}' AS action, b_{i} AS q, CASE WHEN a = {i} THEN 1e0 ELSE 0e0 END AS hit FROM train"
    for i, x in enumerate(ACTIONS)) + ")"
SQL["one_vs_rest_ece"] = final(
    f"""SELECT action, sum(abs(hits - conf)) / sum(n) AS one_vs_rest_ece FROM
    (SELECT action, {bin_sql('q')} AS bin, count(*) AS n, sum(hit) AS hits, sum(q) AS conf FROM ({_LONG}) GROUP BY ALL) GROUP BY action""",
    "one_vs_rest_ece")
SQL["binary_brier"] = final(f"SELECT action, avg((q - hit) * (q - hit)) AS binary_brier FROM ({_LONG}) GROUP BY action", "binary_brier")
SQL["logged_propensity_by_action"] = final(
    f"SELECT {ACT} AS action, count(*) AS logged_count, avg(p) AS mean, quantile_cont(p, 0.05) AS p05, quantile_cont(p, 0.5) AS median FROM train GROUP BY 1",
    "mean p05 median")
SQL["logged_propensity"] = final(
    "SELECT count(*) AS logged_count, avg(p) AS mean, min(p) AS min, quantile_cont(p, 0.01) AS p01, quantile_cont(p, 0.05) AS p05, quantile_cont(p, 0.5) AS median FROM train",
    "mean min p01 p05 median")
SQL["action_rates"] = final(union(
    f"SELECT '{x}' AS action, {share(f'a = {i}')} AS observed_rate, avg(b_{i}) AS mean_probability, {share(f'{_TOP} = {i}')} AS argmax_rate FROM train"
    for i, x in enumerate(ACTIONS)), "observed_rate mean_probability argmax_rate")
SQL["state_slice_behavior"] = final(
    "SELECT coalesce(map_mm_hg < 65, false) AS in_slice, count(*) AS rows, "
    + ", ".join(f"{share(f'a = {i}')} AS observed_{i}" for i in range(3)) + ", "
    + ", ".join(f"avg(b_{i}) AS predicted_{i}" for i in range(3)) + " FROM train GROUP BY 1",
    "observed_0 observed_1 observed_2 predicted_0 predicted_1 predicted_2")


def fit_sql(y: str = "reward", p: str = "predicted") -> str:
    return f"""count(*) AS rows, sqrt(avg(({y}-{p})*({y}-{p}))) AS rmse, avg(abs({y}-{p})) AS mae,
    CASE WHEN var_pop({y}) = 0 THEN CASE WHEN sum(({y}-{p})*({y}-{p})) = 0 THEN 1e0 ELSE 0e0 END
         ELSE 1 - sum(({y}-{p})*({y}-{p})) / (var_pop({y}) * count(*)) END AS r2,
    avg({y}) AS actual_mean, avg({p}) AS predicted_mean"""


_FIT = "rmse mae r2 actual_mean predicted_mean"
SQL["reward_fit_metrics"] = by_fold(fit_sql(), _FIT)
SQL["reward_fit_by_action"] = final(f"SELECT {ACT} AS action, {fit_sql()} FROM train GROUP BY 1", _FIT)
SQL["fold_metrics"] = final(
    """SELECT fold, count(*) AS validation_rows, count(DISTINCT patient_id) AS validation_patients,
    (SELECT count(DISTINCT patient_id) FROM train) - count(DISTINCT patient_id) AS train_patients FROM train GROUP BY fold""",
    "", "fold")
_SCOPES = (("overall", "'all'", "true"), ("per_action", ACT, "true"), ("low_pressure", "'all'", "map_mm_hg < 65"))
_DELTAS = union(
    f"SELECT '{m}' AS model, '{section}' AS section, {action} AS action, {fit_sql('reward', pick(m, 'a'))} FROM train WHERE {where} GROUP BY 3"
    for m in ("ridge", "nonlinear") for section, action, where in _SCOPES)
SQL["model_deltas"] = final(
    union(f"""SELECT c.model, section, action, '{metric}' AS metric, c.{metric} - r.{metric} AS delta
      FROM cells c JOIN cells r USING (section, action) WHERE c.model = 'nonlinear' AND r.model = 'ridge'""" for metric in ("rmse", "mae", "r2")),
    "delta", ctes=(TRAJ, EST, f"cells AS ({_DELTAS})"))


def quartiles(c: str, prefix: str = "") -> str:
    return (f"min({c}) AS {prefix}min, quantile_cont({c}, 0.25) AS {prefix}p25, quantile_cont({c}, 0.5) AS {prefix}median, "
            f"quantile_cont({c}, 0.75) AS {prefix}p75, max({c}) AS {prefix}max")


_Q5 = "min p25 median p75 max"
SQL["quantile_summary"] = final(union(
    f"SELECT {ACT}, '{c}' AS variable, {quartiles(c)} FROM train GROUP BY 1" for c in ("reward", "lactate_mmol_l", "b_2")), _Q5)
_REWARDS = f"count(*) AS rows, avg(reward) AS mean, {share('reward >= 0')} AS favorable_rate, quantile_cont(reward, 0.1) AS p10, quantile_cont(reward, 0.5) AS median, quantile_cont(reward, 0.9) AS p90"
SQL["reward_summary"] = final(f"SELECT {ACT}, {_REWARDS} FROM train GROUP BY 1", "mean favorable_rate p10 median p90")
SQL["bias_observed"] = final(f"SELECT {ACT} AS action, {_REWARDS} FROM train GROUP BY 1", "mean favorable_rate p10 median p90")

# -------------------------------------------------------------------------- contrastive

_MASKED = ", ".join(f"CASE WHEN b_{i} >= 0.02e0 AND top <> {i} THEN (ridge_{i} + nonlinear_{i}) / 2 ELSE -1e300 END AS m_{i}" for i in range(3))
STAGED = f"""
c1 AS (SELECT *, {argmax('ridge')} AS top, {argmax('nonlinear')} AS other,
  CAST(b_0 >= 0.02e0 AS INT) + CAST(b_1 >= 0.02e0 AS INT) + CAST(b_2 >= 0.02e0 AS INT) AS n_sup FROM train),
c2 AS (SELECT *, {_MASKED} FROM c1),
c3 AS (SELECT *, {argmax('m')} AS neg FROM c2),
c4 AS (SELECT *, {pick('b', 'top')} AS preferred_propensity, {pick('b', 'neg')} AS near_negative_propensity,
  {pick('ridge', 'top')} AS ridge_preferred_value, {pick('ridge', 'neg')} AS ridge_near_negative_value,
  {pick('nonlinear', 'top')} AS nonlinear_preferred_value, {pick('nonlinear', 'neg')} AS nonlinear_near_negative_value FROM c3),
c5 AS (SELECT *, ridge_preferred_value - ridge_near_negative_value AS ridge_advantage,
  nonlinear_preferred_value - nonlinear_near_negative_value AS nonlinear_advantage,
  greatest(abs(ridge_preferred_value - nonlinear_preferred_value), abs(ridge_near_negative_value - nonlinear_near_negative_value)) AS value_disagreement FROM c4),
c6 AS (SELECT *, least(ridge_advantage, nonlinear_advantage) AS robust_advantage, top = a AS preferred_matches_logged FROM c5),
staged AS (SELECT *, n_sup >= 2 AS s1, n_sup >= 2 AND top = other AS s2,
  n_sup >= 2 AND top = other AND preferred_propensity >= 0.02e0 AS s3 FROM c6),
staged2 AS (SELECT *, s3 AND value_disagreement <= 0.5e0 AS s4, s3 AND value_disagreement <= 0.5e0 AND robust_advantage >= 0.1e0 AS s5 FROM staged),
staged3 AS (SELECT *, s5 AND preferred_matches_logged AS s6, s5 AND preferred_matches_logged AND reward >= 0e0 AS s7 FROM staged2),
cand AS (SELECT patient_id AS source_patient_id, time_step AS source_time_step, fold AS cross_fit_fold, {OBS},
  {name_of('top')} AS preferred_action, {name_of('neg')} AS near_negative_action, {ACT} AS logged_action, preferred_matches_logged,
  preferred_propensity, near_negative_propensity, ridge_preferred_value, ridge_near_negative_value, nonlinear_preferred_value,
  nonlinear_near_negative_value, ridge_advantage, nonlinear_advantage, robust_advantage, value_disagreement FROM staged3 WHERE s7),
chosen AS (SELECT *, row_number() OVER (PARTITION BY preferred_action ORDER BY robust_advantage DESC, preferred_propensity DESC, source_patient_id, source_time_step) AS example_rank
  FROM cand QUALIFY example_rank <= 100)"""
_CAND_DOUBLES = STATE_DOUBLES + """ preferred_propensity near_negative_propensity ridge_preferred_value ridge_near_negative_value
 nonlinear_preferred_value nonlinear_near_negative_value ridge_advantage nonlinear_advantage robust_advantage value_disagreement"""
_CAND_INTS = STATE_INTS + " source_time_step cross_fit_fold"
_STAGES = ("at_least_two_supported_actions", "models_agree_on_preferred_action", "agreed_preferred_action_is_supported",
           "value_disagreement_within_limit", "both_advantages_clear_margin", "preferred_matches_logged_action", "logged_reward_clears_threshold")
C = (TRAJ, EST, STAGED)
SQL["contrastive_funnel"] = final(
    "SELECT count(*) AS source_rows, " + ", ".join(f"count(*) FILTER (s{i + 1}) AS {n}" for i, n in enumerate(_STAGES)) + " FROM staged3", ctes=C)
SQL["contrastive_candidates"] = final("SELECT * FROM cand", _CAND_DOUBLES, _CAND_INTS, C)
SQL["contrastive_examples"] = final("SELECT * FROM chosen", _CAND_DOUBLES, _CAND_INTS + " example_rank", C)
SQL["contrastive_readiness"] = final(union(
    f"""SELECT '{x}' AS action, (SELECT count(*) FROM cand WHERE preferred_action = '{x}') AS candidates_before_balance,
    (SELECT count(*) FROM chosen WHERE preferred_action = '{x}') AS selected_examples,
    (SELECT count(*) FROM chosen WHERE preferred_action = '{x}') < 10 AS underrepresented""" for x in ACTIONS), ctes=C)

# --------------------------------------------------------------------------------- bias

RANKED = "ranked AS (" + union(
    f"""SELECT '{m}' AS model, {argmax(m)} AS top, {pick('b', argmax(m))} AS tp, greatest({m}_1, {m}_2) - {m}_0 AS margin,
    {m}_0 AS v_0, {m}_1 AS v_1, {m}_2 AS v_2, * FROM train""" for m in ("ridge", "nonlinear")) + ")"
R = (TRAJ, EST, RANKED)
_TOPS = ", ".join(f"{share(f'top = {i}')} AS top_rate_{i}" for i in range(3))
_TOP_NAMES = "top_rate_0 top_rate_1 top_rate_2"
SQL["bias_global"] = final(union(
    f"SELECT model, '{x}' AS action, {share(f'top = {i}')} AS top_action_rate, avg(v_{i}) AS mean_modeled_value FROM ranked GROUP BY model"
    for i, x in enumerate(ACTIONS)), "top_action_rate mean_modeled_value", ctes=R)
SQL["bias_propensity"] = final(
    f"SELECT model, {quartiles('tp')}, {share('tp < 0.02e0')} AS below_support_rate FROM ranked GROUP BY model", _Q5 + " below_support_rate", ctes=R)
_AGREE = f"{argmax('ridge')} = {argmax('nonlinear')}"
SQL["bias_agreement"] = final(
    f"SELECT count(*) AS rows, {share(_AGREE)} AS top_action_agreement_rate, "
    + ", ".join(f"coalesce(count(*) FILTER ({_AGREE} AND {argmax('ridge')} = {i}) / nullif(CAST(count(*) FILTER ({_AGREE}) AS DOUBLE), 0), 0) AS agreed_top_rate_{i}" for i in range(3))
    + " FROM train", "top_action_agreement_rate agreed_top_rate_0 agreed_top_rate_1 agreed_top_rate_2")
SQL["bias_matrix"] = final(f"SELECT model, {ACT} AS logged_action, count(*) AS rows, {_TOPS} FROM ranked GROUP BY 1, 2", _TOP_NAMES, ctes=R)
_MQ = " ".join(f"margin_{n}" for n in _Q5.split())
SQL["bias_maintain"] = final(
    f"SELECT model, count(*) AS rows, {_TOPS}, {share('tp < 0.02e0')} AS below_support_rate, {quartiles('margin', 'margin_')}, {quartiles('tp', 'propensity_')} FROM ranked WHERE a = 0 GROUP BY model",
    _TOP_NAMES + " below_support_rate " + _MQ + " " + " ".join(f"propensity_{n}" for n in _Q5.split()), ctes=R)
_SLICES = {
    "map_below_65": "map_mm_hg < 65", "map_65_to_75": "map_mm_hg >= 65 AND map_mm_hg < 75", "map_at_least_75": "map_mm_hg >= 75",
    "lactate_at_most_2": "lactate_mmol_l <= 2", "lactate_above_2": "lactate_mmol_l > 2", "lactate_missing": "lactate_mmol_l IS NULL",
    "vasopressor_inactive": "vasopressor_active_pre_action = 0", "vasopressor_active": "vasopressor_active_pre_action = 1",
}
SQL["bias_slices"] = final(union(
    f"""SELECT '{n}' AS slice, model, count(*) AS rows, avg(reward) AS reward_mean, {share('reward >= 0')} AS favorable_rate, {_TOPS},
    {quartiles('margin', 'margin_')}, quantile_cont(reward, 0.1) AS p10, quantile_cont(reward, 0.5) AS reward_median, quantile_cont(reward, 0.9) AS p90
    FROM ranked WHERE a = 0 AND ({c}) GROUP BY model""" for n, c in _SLICES.items()),
    f"reward_mean favorable_rate p10 reward_median p90 {_TOP_NAMES} {_MQ}", ctes=R)

# ---------------------------------------------------------------- library and retrieval

LIBRARY = f"""
cuts AS (SELECT {ACT} AS action, quantile_cont(reward, 0.25) AS lower, quantile_cont(reward, 0.75) AS upper, count(*) AS logged_rows FROM train GROUP BY 1),
labelled AS (SELECT tr.*, action, 'favorable' AS outcome_label, -reward AS signed FROM train tr JOIN cuts ON {ACT} = action WHERE reward >= upper
  UNION ALL SELECT tr.*, action, 'unfavorable', reward FROM train tr JOIN cuts ON {ACT} = action WHERE reward <= lower),
supported AS (SELECT * FROM labelled WHERE p >= 0.02e0),
deduped AS (SELECT * FROM supported QUALIFY row_number() OVER (PARTITION BY action, outcome_label, patient_id ORDER BY signed, p DESC, time_step) = 1),
capped AS (SELECT *, row_number() OVER (PARTITION BY action, outcome_label ORDER BY signed, p DESC, patient_id, time_step) AS place FROM deduped QUALIFY place <= 100),
library AS (SELECT patient_id AS source_patient_id, time_step AS source_time_step, fold AS cross_fit_fold, {OBS}, action, outcome_label,
  p AS logged_action_propensity,
  (CASE action WHEN 'maintain' THEN 0 WHEN 'iv_fluids' THEN 2 ELSE 4 END + CASE outcome_label WHEN 'favorable' THEN 0 ELSE 1 END) * 100 + place - 1 AS library_rank
  FROM capped)"""
L = (TRAJ, EST, LIBRARY)
SQL["reward_thresholds"] = final("SELECT * FROM cuts", "lower upper", ctes=L)
SQL["outcome_labels"] = final(f"SELECT {KEY}, action, outcome_label, reward FROM labelled", "reward", ctes=L)
SQL["factual_library"] = final("SELECT * FROM library", STATE_DOUBLES + " logged_action_propensity",
                               STATE_INTS + " source_time_step cross_fit_fold library_rank", L)
SQL["factual_readiness"] = final(union(
    f"""SELECT '{x}' AS action, '{o}' AS outcome_label, count(*) AS candidates_after_support, count(DISTINCT patient_id) AS candidates_after_patient_deduplication,
    (SELECT count(*) FROM library WHERE action = '{x}' AND outcome_label = '{o}') AS selected_examples,
    (SELECT count(*) FROM library WHERE action = '{x}' AND outcome_label = '{o}') < 20 AS insufficient
    FROM supported WHERE action = '{x}' AND outcome_label = '{o}'""" for x in ACTIONS for o in ("favorable", "unfavorable")), ctes=L)
_RECORD = f"SELECT {OBS}, action AS logged_action, outcome_label AS observed_outcome_label FROM library"
SQL["prompt_safe_records"] = final(_RECORD, STATE_DOUBLES, STATE_INTS, L)

_QX = ", ".join(f"{x} AS x{i}" for i, (_, x) in enumerate(feature_exprs("q")))
_N = len(feature_exprs())
NEAREST = f"""{feature_ctes('library')},
lx AS (SELECT library_rank, source_patient_id, source_time_step, action, outcome_label, {_QX} FROM library q, stats),
qx AS (SELECT {KEY}, {_QX} FROM asked q, stats),
dist AS (SELECT qx.patient_id, qx.time_step, lx.action, lx.outcome_label, lx.library_rank, lx.source_patient_id, lx.source_time_step,
  sqrt({' + '.join(f'(qx.x{i} - lx.x{i}) * (qx.x{i} - lx.x{i})' for i in range(_N))}) AS retrieval_distance
  FROM qx JOIN lx ON qx.patient_id <> lx.source_patient_id),
near AS (SELECT * FROM dist QUALIFY row_number() OVER (PARTITION BY patient_id, time_step, action, outcome_label ORDER BY retrieval_distance, library_rank) = 1)"""
SQL["retrieve_examples"] = final(
    f"SELECT {KEY}, action, outcome_label, library_rank, retrieval_distance, source_patient_id, source_time_step FROM near",
    "retrieval_distance", "library_rank source_time_step",
    (TRAJ, EST, LIBRARY, "asked AS (SELECT * FROM traj)", NEAREST))

# -------------------------------------------------------------- prompts and decisions


def state_sql(indent: str = "  ", missing: str = f'"{prompts.MISSING_VALUE}"', prefix: str = "") -> str:
    fields = []
    for c in OBSERVATIONS:
        text = f"CAST(to_json({prefix}{c}) AS VARCHAR)" if c in CATEGORICAL else f"CAST({prefix}{c} AS VARCHAR)"
        fields.append(f"'{indent}\"{c}\": ' || coalesce({text}, {quote(missing)})")
    return "'{' || chr(10) || " + " || ',' || chr(10) || ".join(fields) + f" || chr(10) || '{indent[2:]}}}'"


def lines(text: str) -> str:
    return " || chr(10) || ".join(quote(part) for part in text.split("\n"))


def note_sql(note: str) -> str:
    return (f"replace(replace(CAST(to_json(CASE WHEN {note} IS NULL OR regexp_full_match({note}, '\\s*') THEN {quote(prompts.MISSING_NOTE)} "
            f"ELSE {note} END) AS VARCHAR), '<', '\\u003c'), '>', '\\u003e')")


def user_sql(state: str, note: str) -> str:
    return f"{lines(prompts.USER_OPENING)} || {state} || {lines(prompts.USER_MIDDLE)} || {note} || {lines(prompts.USER_CLOSING)}"


SQL["state_json"] = final(f"SELECT {KEY}, {state_sql()} AS state_json FROM traj", ctes=(TRAJ,))
SQL["handoff_note_json"] = f"SELECT CAST(doc_id AS BIGINT) AS doc_id, {note_sql('text')} AS note_json FROM documents"
SQL["zero_shot_messages_rows"] = final(
    f"""SELECT {KEY}, 'system' AS first_role, sha256({lines(prompts.SYSTEM_PROMPT)}) AS system_sha256,
    {user_sql(state_sql(prefix='q.'), note_sql('c.text'))} AS user_content
    FROM traj q LEFT JOIN (SELECT * FROM conversations WHERE turn = 0) c ON CAST(substr(q.patient_id, 2) AS BIGINT) = c.conv_id""",
    ctes=(TRAJ,))
_NO_NOTE = quote(f'"{prompts.MISSING_NOTE}"')
_RAW = """CASE k % 12
  WHEN 0 THEN 'not json'
  WHEN 1 THEN '{"prob_maintain":-0.1,"prob_iv_fluids":0.6,"prob_escalate_vasopressor":0.5,"rationale":"formula"}'
  WHEN 2 THEN '{"prob_maintain":0,"prob_iv_fluids":0,"prob_escalate_vasopressor":0,"rationale":"formula"}'
  WHEN 3 THEN '{"prob_maintain":0.2,"prob_iv_fluids":0.3,"prob_escalate_vasopressor":0.5,"rationale":"extra","more":1}'
  WHEN 5 THEN '{"prob_maintain":1.5,"prob_iv_fluids":0.1,"prob_escalate_vasopressor":0.1,"rationale":"formula"}'
  WHEN 6 THEN '{"prob_maintain":0.5,"prob_iv_fluids":0.5,"prob_escalate_vasopressor":0.5,"rationale":"formula"}'
  WHEN 7 THEN '{"prob_maintain":0.2,"prob_iv_fluids":0.3,"prob_escalate_vasopressor":0.5,"rationale":"   "}'
  ELSE concat('{"prob_maintain":0.', k % 40 + 50, ',"prob_iv_fluids":0.', k % 30 + 10,
    ',"prob_escalate_vasopressor":0.05,"rationale":"  pressure ', CAST(trunc(map_mm_hg) AS INT), ' observed "}') END"""
KEYED = f"""
content AS (SELECT *, CAST(heart_rate - 60 AS INT) AS k, {user_sql(state_sql(), _NO_NOTE)} AS user_content FROM traj),
keyed AS (SELECT *, {_RAW} AS raw, sha256('{{"cache_format_version":1,"messages":[{{"content":' || CAST(to_json({lines(prompts.SYSTEM_PROMPT)}) AS VARCHAR)
  || ',"role":"system"}},{{"content":' || CAST(to_json(user_content) AS VARCHAR)
  || ',"role":"user"}}],"model_id":"fixture-model","prompt_version":"zero_shot_v1","response_schema_version":1,"temperature":0.0}}') AS cache_key FROM content),
cache AS (SELECT cache_key, any_value(raw) AS raw_response, bool_or(k % 17 = 1) AS old FROM keyed WHERE k % 4 <> 0 GROUP BY cache_key),
looked AS (SELECT q.*, CASE WHEN NOT c.old THEN c.raw_response END AS raw_response, coalesce(NOT c.old, false) AS cache_hit,
  coalesce(c.old, false) AS cache_error FROM keyed q LEFT JOIN cache c USING (cache_key))"""
K = (TRAJ, KEYED)
SQL["cache_key"] = final(f"SELECT {KEY}, cache_key FROM keyed", ctes=K)
SQL["response_cache_scan"] = final(
    """SELECT CAST(1 AS BIGINT) AS cache_format_version, cache_key, 'fixture-model' AS model_id, CASE WHEN old THEN 'zero_shot_v0' ELSE 'zero_shot_v1' END AS prompt_version,
    raw_response, CAST(1 AS BIGINT) AS response_schema_version, 0e0 AS temperature FROM cache""", ctes=K)
SQL["response_cache_new_records"] = final(
    "SELECT DISTINCT cache_key FROM keyed WHERE cache_key NOT IN (SELECT cache_key FROM cache)", ctes=K)
SQL["cache_lookup"] = final(f"SELECT {KEY}, cache_key, cache_hit, cache_error, raw_response FROM looked", ctes=K)


def decided(source: str, raw: str) -> str:
    """Parsed decisions for the plain valid and invalid texts of the fixture."""
    good = f"{raw} IS NOT NULL AND k % 12 NOT IN (0, 1, 2, 3, 5, 7)"
    probs = [f"CAST(json_extract({raw}, '$.prob_{x}') AS DOUBLE)" for x in ACTIONS]
    total = " + ".join(probs)
    return (f"SELECT *, {good} AS ok, " + ", ".join(
        f"CASE WHEN {good} THEN {p} / ({total}) END AS prob_{x}" for p, x in zip(probs, ACTIONS))
        + f", CASE WHEN {good} THEN trim(json_extract_string({raw}, '$.rationale')) END AS said FROM {source}")


_PROBS = " ".join(f"prob_{x}" for x in ACTIONS)
_FALL = ", ".join(f"coalesce(prob_{x}, {1 if i == 0 else 0}e0) AS prob_{x}" for i, x in enumerate(ACTIONS))
_SAID = "coalesce(said, 'Deterministic fallback to the supplied maintain baseline.') AS rationale"
_REASON = """CASE WHEN ok THEN NULL WHEN raw_response IS NOT NULL THEN 'structured_output_error'
  WHEN cache_error THEN 'cache_error' ELSE 'cache_miss' END"""
SQL["parsed_decisions"] = final(
    f"SELECT {KEY}, ok AS decision_valid, {', '.join(_PROBS.split())}, said AS rationale FROM ({decided('keyed', 'raw')})", _PROBS, ctes=K)
SQL["decision_fallback"] = final(
    f"SELECT {KEY}, {_FALL}, {_SAID}, NOT ok AS fallback_used FROM ({decided('keyed', 'raw')})", _PROBS, ctes=K)
_ZERO = f"SELECT {KEY}, split, cache_key, {_FALL}, {_SAID}, cache_hit, cache_error, NOT ok AS fallback_used, {_REASON} AS failure_reason FROM ({decided('looked', 'raw_response')})"
Z = (TRAJ, KEYED, f"decided AS ({_ZERO})")
SQL["policy_always_maintain"] = final(
    f"SELECT {KEY}, 1e0 AS prob_maintain, 0e0 AS prob_iv_fluids, 0e0 AS prob_escalate_vasopressor FROM traj", ctes=(TRAJ,))
SQL["policy_zero_shot"] = final("SELECT * EXCLUDE (split) FROM decided", _PROBS, ctes=Z)
_REASONS = ("backend_error", "cache_error", "cache_miss", "structured_output_error")
SQL["policy_diagnostics"] = final(
    f"""SELECT count(*) AS num_calls, count(*) FILTER (cache_hit) AS cache_hits, {share('cache_hit')} AS cache_hit_rate,
    count(*) FILTER (failure_reason = 'structured_output_error') AS structured_output_failures,
    {share("failure_reason = 'structured_output_error'")} AS structured_output_failure_rate,
    count(*) FILTER (fallback_used) AS fallbacks, {share('fallback_used')} AS fallback_rate, """
    + ", ".join(f"count(*) FILTER (failure_reason = '{r}') AS reason_{r}" for r in _REASONS) + " FROM decided",
    "cache_hit_rate structured_output_failure_rate fallback_rate", ctes=Z)
_CHOSEN = ("CASE WHEN prob_maintain >= prob_iv_fluids AND prob_maintain >= prob_escalate_vasopressor THEN 'maintain' "
           "WHEN prob_iv_fluids >= prob_escalate_vasopressor THEN 'iv_fluids' ELSE 'escalate_vasopressor' END")
SQL["chosen_action"] = final(f"SELECT {KEY}, {_CHOSEN} AS chosen_action FROM decided", ctes=Z)
SQL["policy_actions_test"] = final(
    f"SELECT {KEY}, {_CHOSEN} AS chosen_action, {', '.join(_PROBS.split())}, 'fixture-model' AS model_id, 'zero_shot_v1' AS prompt_version FROM decided WHERE split = 'test'",
    _PROBS, ctes=Z)
_BRANCHES = (
    ("lowest_map", "map_mm_hg IS NOT NULL", "map_mm_hg"),
    ("map_near_65", "map_mm_hg IS NOT NULL", "abs(map_mm_hg - 65)"),
    ("highest_lactate", "lactate_mmol_l IS NOT NULL", "lactate_mmol_l DESC"),
    ("missing_lactate", "lactate_mmol_l IS NULL", "1"),
    ("vasopressor_active", "vasopressor_active_pre_action = 1", "1"),
    ("recent_iv_fluids", "iv_fluids_previous_6h_ml > 0", "iv_fluids_previous_6h_ml DESC"),
    ("deterministic_fill", "true", "1"),
)
DIVERSE = "branches AS (" + union(
    f"""SELECT {KEY}, {OBS}, '{n}' AS selection_reason, {i} AS priority,
    row_number() OVER (ORDER BY {o}, patient_id, time_step) AS rank FROM traj WHERE {c} QUALIFY rank <= {36 if i == 6 else 2}"""
    for i, (n, c, o) in enumerate(_BRANCHES)).replace("ORDER BY 1,", "ORDER BY") + """),
picked AS (SELECT * FROM branches QUALIFY row_number() OVER (PARTITION BY patient_id, time_step ORDER BY priority, rank) = 1),
diverse AS (SELECT * EXCLUDE (priority, rank), row_number() OVER (ORDER BY priority, rank) AS selection_order FROM picked QUALIFY selection_order <= 24)"""
SQL["diverse_rows"] = final("SELECT * FROM diverse", STATE_DOUBLES, STATE_INTS + " time_step selection_order", (TRAJ, DIVERSE))
_SIX = ", ".join(f"'\"{x}\":' || CAST(round(prob_{x}, 6) + 0e0 AS VARCHAR)" for x in ACTIONS)
SQL["case_report"] = final(
    f"""SELECT {KEY}, '{{"selection_reason":"' || selection_reason || '","chosen_action":"' || {_CHOSEN} || '","probabilities":{{' || concat_ws(',', {_SIX})
    || '}},"rationale":' || CAST(to_json(rationale) AS VARCHAR) || ',"cache_hit":' || cache_hit || ',"fallback_used":' || fallback_used
    || ',"failure_reason":' || coalesce('"' || failure_reason || '"', 'null') || '}}' AS case_json
    FROM decided JOIN (SELECT {KEY}, selection_reason FROM diverse) USING ({KEY})""", ctes=Z + (DIVERSE,))

# -------------------------------------------------------------------------- exploration

SQL["outcome_describe"] = final(union(
    f"""SELECT '{c}' AS variable, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
    quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM traj""" for c in OUTCOMES),
    "mean std " + _Q5, ctes=(TRAJ,))
SQL["outcome_rates"] = final(union(
    f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS level, count(*) AS rows, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM traj) AS share FROM traj GROUP BY 2"
    for c in OUTCOMES[2:]), "share", ctes=(TRAJ,))
_VITALS = ("map_mm_hg", "lactate_mmol_l", "heart_rate", "urine_output_6h_ml", "vasopressor_active_pre_action")
SQL["means_by_action"] = final(
    f"SELECT {ACT} AS action, " + ", ".join(
        f"round(avg({c}), {d}) + 0e0 AS mean_{c}" for c, d in [(c, 3) for c in OUTCOMES] + [(c, 2) for c in _VITALS])
    + " FROM traj GROUP BY 1", ctes=(TRAJ,))
SQL["means_by_low_map_action"] = final(
    f"SELECT coalesce(map_mm_hg < 65, false) AS low_map, {ACT} AS action, "
    + ", ".join(f"round(avg({c}), 3) + 0e0 AS mean_{c}" for c in OUTCOMES) + " FROM traj GROUP BY 1, 2", ctes=(TRAJ,))
SQL["outcome_correlation"] = final(union(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 2) + 0e0 AS r FROM traj"
    for i, x in enumerate(OUTCOMES) for y in OUTCOMES[i + 1:]), ctes=(TRAJ,))
SQL["null_rates_by_action"] = final(
    f"SELECT {ACT} AS action, " + ", ".join(f"{share(f'{c} IS NULL')} AS null_{c}" for c in ("lactate_mmol_l", "urine_output_6h_ml", "creatinine_mg_dl"))
    + " FROM traj GROUP BY 1", "null_lactate_mmol_l null_urine_output_6h_ml null_creatinine_mg_dl", ctes=(TRAJ,))

# --------------------------------------------------------------------------- evaluation


def dm(stem: str) -> str:
    return f"({stem}_0 * ridge_0 + {stem}_1 * ridge_1 + {stem}_2 * ridge_2)"


def ratio(stem: str) -> str:
    return f"({pick(stem, 'a')} / {pick('b', 'a')})"


SCORED = f"s AS (SELECT *, {dm('pi')} AS dm, {ratio('pi')} AS ratio, reward - {pick('ridge', 'a')} AS residual FROM valid)"
V = (TRAJ, EST, SCORED)
CLIPPED = "c AS (" + union(f"SELECT *, {x}e0 AS clip, least(ratio, {x}e0) AS w FROM s" for x in (10, 20)) + ")"
SQL["dm_value"] = final("SELECT count(*) AS rows, avg(dm) AS dm_value FROM s", "dm_value", ctes=V)
SQL["clipped_ips"] = final(
    "SELECT clip, avg(w * reward) AS ips_value, sum(w * reward) / sum(w) AS snips_value FROM c GROUP BY clip", "ips_value snips_value", ctes=V + (CLIPPED,))
SQL["dr_value"] = final("SELECT clip, avg(dm + w * residual) AS dr_value FROM c GROUP BY clip", "dr_value", ctes=V + (CLIPPED,))
SQL["weight_diagnostics"] = final(
    f"""SELECT clip, coalesce({ACT}, 'all') AS action, count(*) AS rows, sum(w) * sum(w) / sum(w * w) AS ess, max(ratio) AS max_ratio,
    {share('ratio > clip')} AS clipped_share FROM c GROUP BY GROUPING SETS ((clip, {ACT}), (clip))""", "ess max_ratio clipped_share", ctes=V + (CLIPPED,))


def dr(stem: str) -> str:
    return f"({dm(stem)} + least({ratio(stem)}, 10e0) * (reward - {pick('ridge', 'a')}))"


_POISSON = " + ".join(f"CASE WHEN u >= {x!r}e0 THEN 1 ELSE 0 END" for x in poisson_steps())
SQL["bootstrap_ci"] = final(
    """SELECT score, avg(value) AS bootstrap_mean, quantile_cont(value, 0.025) AS lower, quantile_cont(value, 0.975) AS upper FROM ("""
    + union(f"SELECT '{n}' AS score, sum(w * {n}) / sum(w * n) AS value FROM runs GROUP BY b" for n in ("first", "second", "difference"))
    + ") GROUP BY score", "bootstrap_mean lower upper",
    ctes=(TRAJ, EST, f"""sums AS (SELECT patient_id, count(*) AS n, sum({dr('pi')}) AS first, sum({dr('rho')}) AS second, sum({dr('pi')} - {dr('rho')}) AS difference FROM valid GROUP BY patient_id),
    drawn AS (SELECT *, CAST(('0x' || substr(md5('7:' || b || ':' || patient_id), 1, 8)) AS BIGINT) / 4294967296e0 AS u FROM sums, range(1, 201) r(b)),
    runs AS (SELECT *, {_POISSON} AS w FROM drawn)"""))
_PI_TOP = argmax("pi")
_MEAN_PI = ", ".join(f"avg(pi_{i}) AS mean_probability_{i}" for i in range(3))
_CHOSE_PI = ", ".join(f"{share(f'{_PI_TOP} = {i}')} AS chosen_rate_{i}" for i in range(3))
_PI_NAMES = " ".join(f"mean_probability_{i} chosen_rate_{i}" for i in range(3))
SQL["policy_entropy"] = final(
    "SELECT count(*) AS rows, avg(" + " + ".join(f"CASE WHEN pi_{i} > 0 THEN -pi_{i} * ln(pi_{i}) ELSE 0 END" for i in range(3))
    + f") AS mean_entropy, {_MEAN_PI}, {_CHOSE_PI} FROM valid", "mean_entropy " + _PI_NAMES)
SQL["policy_support"] = final(
    "SELECT count(*) AS rows, avg(" + " + ".join(f"CASE WHEN b_{i} < 0.02e0 THEN pi_{i} ELSE 0 END" for i in range(3))
    + f") AS mean_weak_mass, {share(pick('b', _PI_TOP) + ' < 0.02e0')} AS weak_choice_share FROM valid", "mean_weak_mass weak_choice_share")
SQL["policy_state_slice"] = final(
    f"SELECT coalesce(map_mm_hg < 65, false) AS in_slice, count(*) AS rows, {_MEAN_PI}, {_CHOSE_PI} FROM valid GROUP BY 1", _PI_NAMES)
SQL["policy_agreement"] = final(union(
    f"""SELECT '{x}' AS left_action, '{y}' AS right_action, count(*) FILTER ({_PI_TOP} = {i} AND {argmax('rho')} = {j}) AS rows,
    {share(f"{_PI_TOP} = {argmax('rho')}")} AS agreement_rate FROM valid"""
    for i, x in enumerate(ACTIONS) for j, y in enumerate(ACTIONS)), "agreement_rate")
PERTURBED = f"""
shifted AS (SELECT *, CASE WHEN map_mm_hg - 3e0 < 65 THEN 4e0 ELSE 1e0 END AS y1, CASE WHEN map_mm_hg - 3e0 < 60 THEN 3e0 ELSE 1e0 END AS y2,
  CASE WHEN k % 3 = 0 THEN 0.5e0 ELSE 0e0 END AS told FROM valid),
perturbed AS (
  SELECT *, 'paraphrase' AS kind, pi_0 AS n_0, pi_1 AS n_1, pi_2 AS n_2 FROM shifted
  UNION ALL SELECT *, 'pressure_conflict', v0/(v0+y1+y2), y1/(v0+y1+y2), y2/(v0+y1+y2) FROM shifted
  UNION ALL SELECT *, 'instruction', pi_0 * (1e0 - told) + told, pi_1 * (1e0 - told), pi_2 * (1e0 - told) FROM shifted)"""
SQL["flip_rate"] = final(
    f"""SELECT kind, count(*) AS rows, {share(f"{argmax('n')} <> {_PI_TOP}")} AS flip_rate,
    avg((abs(n_0 - pi_0) + abs(n_1 - pi_1) + abs(n_2 - pi_2)) / 2) AS mean_total_variation,
    avg({dm('n')} - {dm('pi')}) AS mean_value_change FROM perturbed GROUP BY kind""",
    "flip_rate mean_total_variation mean_value_change", ctes=(TRAJ, EST, PERTURBED))
_CELLS = union(
    f"SELECT '{r}' AS reward_name, '{p}' AS policy, sum(least({ratio(stem)}, 10e0) * {expr}) / sum(least({ratio(stem)}, 10e0)) AS snips_value FROM valid"
    for r, expr in (("default", reward_sql()), ("safety_first", SAFETY_SQL)) for p, stem in (("first", "pi"), ("second", "rho")))
SQL["reward_sensitivity"] = final(
    f"SELECT *, row_number() OVER (PARTITION BY reward_name ORDER BY snips_value DESC, policy) AS value_rank FROM ({_CELLS})", "snips_value")

# ------------------------------------------------------------------------ few-shot text

_EXAMPLE = f"""'{{' || chr(10) || '  "state": ' || {state_sql('    ', 'null', 'l.')} || ',' || chr(10) || '  "logged_action": ' || CAST(to_json(l.action) AS VARCHAR)
  || ',' || chr(10) || '  "observed_outcome_label": ' || CAST(to_json(l.outcome_label) AS VARCHAR) || chr(10) || '}}'"""
SQL["few_shot_messages"] = final(
    f"""SELECT {KEY}, {user_sql(state_sql(prefix='q.'), _NO_NOTE)} || {lines(prompts.EXAMPLES_OPENING)} || examples || {lines(prompts.EXAMPLES_CLOSING)} AS user_content
    FROM asked q JOIN (SELECT n.patient_id, n.time_step, '[' || string_agg({_EXAMPLE}, ',' || chr(10) ORDER BY library_rank) || ']' AS examples
      FROM near n JOIN library l USING (library_rank) GROUP BY n.patient_id, n.time_step) USING (patient_id, time_step)""",
    ctes=(TRAJ, EST, LIBRARY, "asked AS (SELECT * FROM traj)", NEAREST))

# ------------------------------------------------------------- backend and long reports

_VALID_RULE = ((0.2, 0.8), (0.3, 0.1), (0.5, 0.1))
_BY_RULE = ", ".join(
    f"CASE WHEN answered THEN CASE WHEN map_mm_hg < 65 THEN {low}e0 ELSE {high}e0 END ELSE coalesce(prob_{x}, {1 if i == 0 else 0}e0) END AS prob_{x}"
    for i, (x, (low, high)) in enumerate(zip(ACTIONS, _VALID_RULE)))
SQL["policy_with_backend"] = final(
    f"""SELECT {KEY}, cache_key, {_BY_RULE},
    CASE WHEN answered THEN 'pressure rule' ELSE {_SAID.removesuffix(' AS rationale')} END AS rationale,
    cache_hit OR (answered AND NOT first) AS cache_hit, cache_error AND (first OR NOT answered) AS cache_error,
    NOT (ok OR answered) AS fallback_used,
    CASE WHEN ok OR answered THEN NULL WHEN raw_response IS NOT NULL THEN 'structured_output_error' ELSE 'backend_error' END AS failure_reason
    FROM (SELECT *, NOT cache_hit AND spo2 <> 95 AS answered,
      row_number() OVER (PARTITION BY cache_key ORDER BY patient_id, time_step) = 1 AS first
      FROM ({decided('looked', 'raw_response')}))""", _PROBS, ctes=K)


def long_part(sql: str, section: str, names: str, **dims: str) -> str:
    """Melt one metric query into ``section, model, slice, action, fold, metric, value``."""
    shown = ", ".join(f"CAST({dims.get(d, 'NULL')} AS VARCHAR) AS {d}" for d in ("model", "slice", "action", "fold"))
    cells = ", ".join(f"{{'metric': '{n}', 'value': CAST(\"{n}\" AS DOUBLE)}}" for n in names.split())
    return f"""SELECT '{section}' AS section, {shown}, m.metric AS metric, m.value AS value
      FROM (SELECT *, unnest([{cells}]) AS m FROM ({sql}))"""


def long_report(parts) -> str:
    return f"SELECT * REPLACE (round(value, 6) + 0e0 AS value) FROM ({union(parts)})"


_RATES = "top_rate_0 top_rate_1 top_rate_2"
SQL["bias_report"] = long_report([
    long_part(SQL["bias_observed"], "observed_reward", "rows mean favorable_rate p10 median p90", action="action"),
    long_part(SQL["bias_global"], "global_rankings", "top_action_rate mean_modeled_value", model="model", action="action"),
    long_part(SQL["bias_propensity"], "top_action_propensity", _Q5 + " below_support_rate", model="model"),
    long_part(SQL["bias_agreement"], "model_agreement",
              "rows top_action_agreement_rate agreed_top_rate_0 agreed_top_rate_1 agreed_top_rate_2"),
    long_part(SQL["bias_matrix"], "logged_by_top", "rows " + _RATES, model="model", action="logged_action"),
    long_part(SQL["bias_maintain"], "logged_first_action",
              f"rows {_RATES} below_support_rate {_MQ} " + " ".join(f"propensity_{n}" for n in _Q5.split()), model="model"),
    long_part(SQL["bias_slices"], "state_slices",
              f"rows reward_mean favorable_rate {_RATES} {_MQ} p10 reward_median p90", model="model", slice="slice"),
])
_LOW = "coalesce(map_mm_hg < 65, false)"
_SOURCE = final(f"SELECT {share(_LOW)} AS low_pressure_rate FROM train")
_READY = f"SELECT *, CAST(underrepresented AS INT) AS under FROM ({SQL['contrastive_readiness']})"
_THRESHOLDS = """SELECT 0.02e0 AS minimum_propensity, 0.1e0 AS minimum_advantage, 0.5e0 AS maximum_value_disagreement,
  100 AS max_examples_per_action, 1 AS require_preferred_matches_logged, 10 AS minimum_examples_per_action, 0e0 AS minimum_logged_reward"""
SQL["contrastive_report"] = long_report([
    long_part(_THRESHOLDS, "thresholds", """minimum_propensity minimum_advantage maximum_value_disagreement
      max_examples_per_action require_preferred_matches_logged minimum_examples_per_action minimum_logged_reward"""),
    long_part(SQL["contrastive_funnel"], "selection_stages", "source_rows " + " ".join(_STAGES)),
    long_part(_READY, "readiness", "candidates_before_balance selected_examples under", action="action"),
    long_part(f"SELECT CAST(max(under) = 0 AS INT) AS approved FROM ({_READY})", "readiness", "approved"),
    long_part(final(f"""SELECT {share('preferred_matches_logged')} AS preferred_matches_logged_rate,
      count(*) FILTER ({_LOW}) AS low_pressure_rows, coalesce({share(_LOW)}, 0) AS low_pressure_rate FROM chosen""", ctes=C),
              "selected", "preferred_matches_logged_rate low_pressure_rows low_pressure_rate"),
    long_part(_SOURCE, "source", "low_pressure_rate"),
] + [
    long_part(final(f"SELECT {quartiles(v)} FROM chosen", ctes=C), "quantiles", _Q5, slice=f"'{v}'")
    for v in ("robust_advantage", "preferred_propensity", "near_negative_propensity", "value_disagreement")
])
_CELLS_READY = f"SELECT *, CAST(insufficient AS INT) AS under FROM ({SQL['factual_readiness']})"
SQL["factual_report"] = long_report([
    long_part(SQL["reward_thresholds"], "thresholds", "lower upper logged_rows", action="action"),
    long_part(_CELLS_READY, "cells",
              "candidates_after_support candidates_after_patient_deduplication selected_examples under",
              action="action", slice="outcome_label"),
    long_part(f"SELECT CAST(max(under) = 0 AS INT) AS approved FROM ({_CELLS_READY})", "readiness", "approved"),
    long_part(final(f"""SELECT count(*) AS selected_rows, count(DISTINCT source_patient_id) AS unique_source_patients,
      {share(_LOW)} AS low_pressure_rate FROM library""", ctes=L), "library",
              "selected_rows unique_source_patients low_pressure_rate"),
    long_part(_SOURCE, "source", "low_pressure_rate"),
    long_part(final(f"SELECT {quartiles('logged_action_propensity')} FROM library", ctes=L), "logged_action_propensity", _Q5),
])
