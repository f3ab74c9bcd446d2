"""Parse and validate decision texts as columns; anything unacceptable becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.spec import DEFAULT, TrajectorySpec

# Limits, fallback and failure reasons of a decision.
RATIONALE_CHARACTERS = 500
RATIONALE_WORDS = 40
FALLBACK_RATIONALE = "Deterministic fallback to the supplied maintain baseline."
FAILURES = ("backend_error", "cache_error", "cache_miss", "structured_output_error")

_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def probability_names(spec: TrajectorySpec = DEFAULT) -> list[str]:
    return [f"prob_{a}" for a in spec.actions]


def _probability(document: Column, name: str) -> Column:
    """A number, a numeric text or a boolean as double; anything else NULL."""
    path = f"$.x.{name}"
    kind = F.schema_of_variant(F.try_variant_get(document, path, "variant"))
    text = F.trim(F.try_variant_get(document, path, "string"))
    return (
        F.when(kind == "BOOLEAN", F.try_variant_get(document, path, "boolean").cast("double"))
        .when(kind == "STRING", F.when(F.rlike(text, F.lit(_NUMBER)), text.try_cast("double")))
        .when(
            kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"),
            F.try_variant_get(document, path, "double"),
        )
    )


def parse_decisions(
    df: DataFrame, raw: str = "raw_response", spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Add normalised ``prob_*``, ``rationale`` and ``decision_valid``.

    The text must be one JSON object with exactly the expected keys (the last of a
    repeated key counts). Spark's parser ignores text after a document, so the text is
    parsed inside an array and inside an object: whatever closes one breaks the other.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    names = probability_names(spec)
    text = F.col(raw)
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    wrapped = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    df = df.withColumns({"_list": listed, "_doc": wrapped})
    doc = F.col("_doc")
    keys = F.array_sort(F.array_distinct(F.json_object_keys(text)))
    expected = F.array(*[F.lit(k) for k in sorted([*names, "rationale"])])
    single = (
        F.col("_list").isNotNull()
        & doc.isNotNull()
        & F.try_variant_get("_list", "$[1]", "variant").isNull()
        & F.schema_of_variant(F.try_variant_get(doc, "$.x", "variant")).startswith("OBJECT")
        & (keys == expected)
    )
    written = F.when(
        F.schema_of_variant(F.try_variant_get(doc, "$.x.rationale", "variant")) == "STRING",
        F.try_variant_get(doc, "$.x.rationale", "string"),
    )
    df = df.withColumns({
        "_single": F.coalesce(single, F.lit(False)),
        **{f"_{n}": _probability(doc, n) for n in names},
        "_written": written,
    })
    trimmed = F.regexp_replace("_written", r"(?U)^\s+|\s+$", "")
    probs = [F.col(f"_{n}") for n in names]
    total = probs[0]
    for p in probs[1:]:
        total = total + p
    valid = F.col("_single") & (total > 0)
    for p in probs:
        valid = valid & p.between(0.0, 1.0)
    valid = (
        valid
        & F.length("_written").between(1, RATIONALE_CHARACTERS)
        & (F.length(trimmed) > 0)
        & (F.size(F.split(trimmed, r"(?U)\s+")) <= RATIONALE_WORDS)
    )
    df = df.withColumn("decision_valid", F.coalesce(valid, F.lit(False)))
    ok = F.col("decision_valid")
    return df.withColumns({
        **{n: F.when(ok, p / total) for n, p in zip(names, probs)},
        "rationale": F.when(ok, trimmed),
    }).drop("_list", "_doc", "_single", "_written", *[f"_{n}" for n in names])


def with_fallback(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Replace missing decisions by the first action with certainty; flag them."""
    names = probability_names(spec)
    ok = F.coalesce(F.col("decision_valid"), F.lit(False))
    return df.withColumns({
        **{n: F.when(ok, F.col(n)).otherwise(F.lit(1.0 if i == 0 else 0.0)) for i, n in enumerate(names)},
        "rationale": F.when(ok, F.col("rationale")).otherwise(F.lit(FALLBACK_RATIONALE)),
        "fallback_used": ~ok,
    }).drop("decision_valid")
