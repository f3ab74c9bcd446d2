"""Policies add one probability column per action to a frame of observations."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.decisions import FAILURES, probability_names
from decisionlake.functions.prompts import ZERO_SHOT_VERSION, few_shot_messages, few_shot_prompts, zero_shot_messages
from decisionlake.functions.vectors import action_name, argmax, count_if, valid_probabilities
from decisionlake.operators.factual import LABELS
from decisionlake.operators.retrieval import BLOCK_ROWS, ranked_examples, retrieve_examples
from decisionlake.operators.validate import require_columns
from decisionlake.sources.response_cache import (
    Client, Completion, Render, cached_decisions, decisions_with_backend, keyed_rows,
)
from decisionlake.spec import DEFAULT, TrajectorySpec


class Policy(ABC):
    """``predict`` keeps the key columns and adds the probability columns."""

    model_id: str
    prompt_version: str
    spec: TrajectorySpec = DEFAULT

    @abstractmethod
    def predict(self, observations: DataFrame) -> DataFrame: ...

    @property
    def probabilities(self) -> list[str]:
        return probability_names(self.spec)


def policy_input(df: DataFrame, keep: Sequence[str], spec: TrajectorySpec = DEFAULT) -> str | None:
    """Check the input schema once; returns the note column if there is one."""
    allowed = {*keep, *spec.observations, spec.note}
    unexpected = sorted(set(df.columns) - allowed)
    if unexpected:
        raise ValueError(f"Policy observations contain unexpected fields: {unexpected}")
    require_columns(df, [*keep, *spec.observations])
    if spec.note not in df.columns:
        return None
    if df.schema[spec.note].dataType.simpleString() != "string":
        raise TypeError("The note must be text.")
    return spec.note


class AlwaysFirst(Policy):
    """All probability on the first action (``maintain``)."""

    # The identity of the supplied baseline.
    model_id = "supplied-always-maintain"
    prompt_version = "not-applicable"

    def __init__(self, spec: TrajectorySpec = DEFAULT):
        self.spec = spec

    def predict(self, observations: DataFrame) -> DataFrame:
        return observations.select(
            *[c for c in self.spec.key if c in observations.columns],
            *[F.lit(1.0 if i == 0 else 0.0).alias(n) for i, n in enumerate(self.probabilities)],
        )


class PromptedPolicy(Policy):
    """Zero-shot prompt, cached responses, optional backend for the misses."""

    version = ZERO_SHOT_VERSION

    def __init__(
        self, client: Client, cache: DataFrame, *, backend: Completion | None = None,
        cache_path: str | None = None, key: Sequence[str] | None = None,
        spec: TrajectorySpec = DEFAULT,
    ):
        if client.prompt_version != self.version:
            raise ValueError(
                f"This policy needs prompt_version {self.version!r}, got {client.prompt_version!r}."
            )
        if backend is not None and cache_path is None:
            raise ValueError("A backend needs a cache_path to write to.")
        self.client, self.cache, self.spec = client, cache, spec
        self.backend, self.cache_path = backend, cache_path
        self.key = list(key or spec.key)
        self.model_id, self.prompt_version = client.model_id, client.prompt_version

    def messages(self, observations: DataFrame) -> DataFrame:
        note = policy_input(observations, self.key, self.spec)
        return zero_shot_messages(observations, keep=self.key, note=note, spec=self.spec)

    def render(self, observations: DataFrame) -> Render | None:
        """Messages made from a row alone, so that rows can be moved in their place."""
        note = policy_input(observations, self.key, self.spec)
        names = observations.columns

        def rendered(rows: DataFrame) -> DataFrame:
            extra = [c for c in rows.columns if c not in names]
            built = zero_shot_messages(
                rows, keep=[*dict.fromkeys([*names, *extra])], note=note, spec=self.spec)
            return built.drop("state_json", "note_json")

        return rendered

    def predict(self, observations: DataFrame) -> DataFrame:
        render = self.render(observations) if self.backend is not None else None
        if render is not None:
            requests = keyed_rows(observations, render, self.client)
        else:
            requests = self.messages(observations).select(*self.key, "messages")
        if self.backend is None:
            decided = cached_decisions(requests, self.cache, self.client, self.spec)
        else:
            decided = decisions_with_backend(
                requests, self.cache, self.client, self.backend, self.cache_path,
                order=self.key, render=render, spec=self.spec,
            )
        if render is not None:
            decided = decided.drop(*[c for c in observations.columns if c not in self.key])
        return decided.drop("messages")


class FewShotPolicy(PromptedPolicy):
    """The prompt with retrieved factual examples, never those of the same patient."""

    def __init__(self, client: Client, cache: DataFrame, library: DataFrame, *,
                 version: str, examples_per_cell: int = 1, **options):
        self.version = version
        super().__init__(client, cache, **options)
        self.library, self.examples_per_cell = library, examples_per_cell

    def render(self, observations: DataFrame) -> Render | None:
        return None  # a search per row

    def messages(self, observations: DataFrame) -> DataFrame:
        note = policy_input(observations, self.key, self.spec)
        return few_shot_requests(
            observations, self.library, key=self.key, note=note, examples_per_cell=self.examples_per_cell,
            exclude=self.spec.patient if self.spec.patient in self.key else None, spec=self.spec,
        )


def few_shot_requests(
    observations: DataFrame, library: DataFrame, *, key: Sequence[str] | None = None, note: str | None = None,
    examples_per_cell: int = 1, exclude: str | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Prompts with the nearest examples of the library for every state.

    States pass the search once and look texts up in place; a library too large to ship whole is walked in
    blocks, whose winners are joined back by key.
    """
    key = list(key or spec.key)
    chosen = dict(examples_per_cell=examples_per_cell, exclude=exclude, spec=spec)
    if library.limit(BLOCK_ROWS + 1).count() <= BLOCK_ROWS:
        ranked = ranked_examples(observations, library, **chosen)
        n = examples_per_cell * len(spec.actions) * len(LABELS)
        return few_shot_prompts(ranked, library, key=key, examples=n, note=note, spec=spec)
    found = retrieve_examples(observations, library, key=key, **chosen)
    return few_shot_messages(observations, found, key=key, note=note, spec=spec)


def chosen_action(probabilities: Sequence[str], spec: TrajectorySpec = DEFAULT):
    return action_name(argmax(probabilities), spec.actions)


def policy_diagnostics(decided: DataFrame) -> DataFrame:
    """Calls, cache hits, structured failures, fallbacks and reasons; rates of nothing are zero."""
    n = F.count("*")

    def share(count):
        return F.when(n == 0, 0.0).otherwise(count / F.when(n != 0, n))

    hits = count_if(F.col("cache_hit"))
    structured = count_if(F.col("failure_reason") == "structured_output_error")
    fallbacks = count_if(F.col("fallback_used"))
    return decided.agg(
        n.alias("num_calls"),
        hits.alias("cache_hits"),
        share(hits).alias("cache_hit_rate"),
        structured.alias("structured_output_failures"),
        share(structured).alias("structured_output_failure_rate"),
        fallbacks.alias("fallbacks"),
        share(fallbacks).alias("fallback_rate"),
        *[count_if(F.col("failure_reason") == r).alias(f"reason_{r}") for r in FAILURES],
    )


def blinded_predictions(
    predicted: DataFrame, observations: DataFrame, policy: Policy, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Exactly eight columns, one row per observation; no rationale and no note."""
    names = policy.probabilities
    return observations.select(*spec.key).join(predicted.select(*spec.key, *names), list(spec.key), "left").select(
        *spec.key,
        chosen_action(names, spec).alias("chosen_action"),
        *names,
        F.lit(policy.model_id).alias("model_id"),
        F.lit(policy.prompt_version).alias("prompt_version"),
    )


def assert_blinded(predictions: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """One valid distribution per key."""
    names = probability_names(spec)
    if not predictions.groupBy(*spec.key).count().filter("count > 1").isEmpty():
        raise ValueError("There must be exactly one row per observation.")
    if not predictions.filter(~valid_probabilities(names, 1e-9)).isEmpty():
        raise ValueError("Every observation needs probabilities that sum to one.")
    return predictions
