"""The response cache: one record per request key, joined in batches."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.functions.decisions import parse_decisions, with_fallback
from decisionlake.functions.prompts import json_sql, lowered_escapes, number_sql, sql_text, valid_messages
from decisionlake.sources.storage import cut
from decisionlake.spec import DEFAULT, TrajectorySpec

# Versions and field order of a cache record.
CACHE_FORMAT_VERSION = 1
RESPONSE_SCHEMA_VERSION = 1
RECORD_SCHEMA = T.StructType([
    T.StructField("cache_format_version", T.IntegerType()),
    T.StructField("cache_key", T.StringType()),
    T.StructField("model_id", T.StringType()),
    T.StructField("prompt_version", T.StringType()),
    T.StructField("raw_response", T.StringType()),
    T.StructField("response_schema_version", T.IntegerType()),
    T.StructField("temperature", T.DoubleType()),
])

#: ``complete(messages, model_id, temperature) -> text``; messages are role/content dicts.
Completion = Callable[[list[dict[str, str]], str, float], str]
#: Rows with ``messages`` added; every column of the rows is kept.
Render = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Client:
    """Everything besides the messages that a response depends on."""

    model_id: str
    prompt_version: str
    temperature: float = 0.0

    def __post_init__(self):
        if not self.model_id.strip():
            raise ValueError("A client needs a model_id.")
        if not self.prompt_version.strip():
            raise ValueError("A client needs a prompt_version.")
        if not math.isfinite(self.temperature) or self.temperature < 0.0:
            raise ValueError("The temperature is a finite number from zero on.")


def read_cache(spark: SparkSession, path: str, *, format: str = "json") -> DataFrame:
    """Cache records: a directory of one-object JSON files, or a table written by us.

    A file named after a key is the record of that key. If it is not one JSON object, or holds
    another key, it is a record without a response: an error for its own key and nothing for the
    other. A response that is not a text is missing.
    """
    if format in ("parquet", "orc"):
        # batches lie in folders of their own
        return spark.read.schema(RECORD_SCHEMA).format(format).option("recursiveFileLookup", "true").load(path)
    if format != "json":
        return spark.read.schema(RECORD_SCHEMA).format(format).load(path)
    files = spark.read.text(path, wholetext=True).select(
        F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))).alias("_v"),
        F.regexp_extract(F.input_file_name(), r"([0-9a-f]{64})\.json$", 1).alias("_name"),
    )
    whole = F.try_variant_get("_v", "$[1]", "variant").isNull()
    written = F.schema_of_variant(F.try_variant_get("_v", "$[0].raw_response", "variant")) == "STRING"

    own = F.when(whole, F.try_variant_get("_v", "$[0].cache_key", "string"))
    name = F.nullif(F.col("_name"), F.lit(""))
    agrees = F.coalesce(own == name, F.lit(True))

    def field(f: T.StructField) -> Column:
        value = F.try_variant_get("_v", f"$[0].{f.name}", f.dataType.simpleString())
        keep = whole & written & agrees if f.name == "raw_response" else whole
        return F.when(keep, value).alias(f.name)

    return files.select(*[
        F.coalesce(name, own).alias(f.name) if f.name == "cache_key" else field(f)
        for f in RECORD_SCHEMA.fields
    ])


def cache_key(messages: str, client: Client) -> Column:
    """SHA-256 over the compact JSON of the request, its keys in sorted order."""
    # The sorted order of the keys is the order written here. One call renders all messages of a row.
    listed = (
        f"to_json(transform(filter({messages}, m -> m.content IS NOT NULL AND m.role IS NOT NULL), "
        "m -> named_struct('content', m.content, 'role', m.role)))"
    )
    payload = ", ".join([
        sql_text(f'{{"cache_format_version":{CACHE_FORMAT_VERSION},"messages":'), lowered_escapes(listed),
        sql_text(',"model_id":'), json_sql(sql_text(client.model_id)),
        sql_text(',"prompt_version":'), json_sql(sql_text(client.prompt_version)),
        sql_text(f',"response_schema_version":{RESPONSE_SCHEMA_VERSION},"temperature":'),
        number_sql(f"{float(client.temperature)!r}D"), sql_text("}"),
    ])
    return F.expr(f"sha2(concat({payload}), 256)")


def with_cache_key(df: DataFrame, client: Client, messages: str = "messages") -> DataFrame:
    return df.withColumn("cache_key", cache_key(messages, client))


def assert_messages(df: DataFrame, messages: str = "messages") -> DataFrame:
    if not df.filter(~valid_messages(F.col(messages))).isEmpty():
        raise ValueError("Messages need a known role and non-empty content.")
    return df


def lookup(requests: DataFrame, cache: DataFrame, client: Client) -> DataFrame:
    """Add ``raw_response``, ``cache_hit`` and ``cache_error`` to keyed requests.

    A record that belongs to another version, model or prompt is an error, not a hit. A
    plain equi-join: AQE broadcasts a small cache and splits skewed keys of a large one.
    """
    intact = (
        F.col("cache_format_version").eqNullSafe(CACHE_FORMAT_VERSION)
        & F.col("response_schema_version").eqNullSafe(RESPONSE_SCHEMA_VERSION)
        & F.col("model_id").eqNullSafe(client.model_id)
        & F.col("prompt_version").eqNullSafe(client.prompt_version)
        & F.col("raw_response").isNotNull()
    )
    # One record per key; an intact one wins, so a rewritten record replaces a bad one.
    records = cache.filter(F.col("cache_key").isNotNull()).groupBy("cache_key").agg(
        F.max(F.when(intact, F.col("raw_response"))).alias("raw_response"), F.lit(True).alias("_found")
    )
    return (
        requests.join(records, "cache_key", "left")
        .withColumns({
            "cache_hit": F.col("raw_response").isNotNull(),
            "cache_error": F.coalesce(F.col("_found"), F.lit(False)) & F.col("raw_response").isNull(),
        })
        .drop("_found")
    )


def decide(looked_up: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Parse, fall back and name the reason. Precedence: hit, then backend, then fallback."""
    parsed = parse_decisions(looked_up, spec=spec)
    backend = F.col("backend_error") if "backend_error" in looked_up.columns else F.lit(False)
    reason = (
        F.when(F.col("decision_valid"), F.lit(None).cast("string"))
        .when(F.col("raw_response").isNotNull(), "structured_output_error")
        .when(backend, "backend_error")
        .when(F.col("cache_error"), "cache_error")
        .otherwise("cache_miss")
    )
    return with_fallback(parsed.withColumn("failure_reason", reason), spec).drop("backend_error")


def cached_decisions(requests: DataFrame, cache: DataFrame, client: Client,
                     spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Decisions from the cache alone; everything else falls back."""
    return decide(lookup(with_cache_key(requests, client), cache, client), spec)


def keyed_rows(rows: DataFrame, render: Render, client: Client) -> DataFrame:
    """Rows with the key of their request but without its messages, written once.

    What follows moves these rows, which are a small part of a prompt's size, and renders again only what it sends.
    """
    # the output of a generator is not inlined, so that messages are made once for the key and the check
    once = render(rows).select(*rows.columns, F.inline(F.array(F.struct("messages"))))
    written = cut(with_cache_key(once, client).select(*rows.columns, "cache_key", valid_messages(F.col("messages")).alias("_valid")), "keyed-rows")
    if not written.filter(~F.col("_valid")).isEmpty():
        raise ValueError("Messages need a known role and non-empty content.")
    return written.drop("_valid")


def complete_misses(
    requests: DataFrame, cache: DataFrame, client: Client, complete: Completion, path: str,
    *, render: Render | None = None,
) -> DataFrame:
    """Call the backend once per distinct missing request and append to the cache at ``path``.

    Results are written before they are used, so a lost executor repeats at most its own
    unfinished calls. Malformed responses are kept, so that such a failure
    reproduces; failed calls are not. Returns the cache table at ``path``. With ``render`` the requests
    are ``keyed_rows``, whose messages it makes after the duplicates are gone.
    """
    spark = requests.sparkSession
    if render is None:
        requests = with_cache_key(assert_messages(requests), client).select("cache_key", "messages")
    missing = lookup(requests, cache, client).filter(~F.col("cache_hit")).dropDuplicates(["cache_key"])
    missing = missing.drop("raw_response", "cache_hit", "cache_error")
    if render is not None:
        missing = render(missing)
    model_id, temperature = client.model_id, client.temperature

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for messages in batch.column("messages").to_pylist():
                listed = [{"role": m["role"], "content": m["content"]} for m in messages]
                try:
                    text = complete(listed, model_id, temperature)
                    texts.append(text if isinstance(text, str) else None)
                except Exception:  # noqa: BLE001  providers raise their own classes
                    texts.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("cache_key"), pa.array(texts, pa.string())], ["cache_key", "raw_response"])

    called = missing.select("cache_key", "messages").mapInArrow(call, "cache_key string, raw_response string").select(
        F.lit(CACHE_FORMAT_VERSION).alias("cache_format_version"),
        "cache_key",
        F.lit(model_id).alias("model_id"),
        F.lit(client.prompt_version).alias("prompt_version"),
        "raw_response",
        F.lit(RESPONSE_SCHEMA_VERSION).alias("response_schema_version"),
        F.lit(float(temperature)).alias("temperature"),
    )
    called.filter(F.col("raw_response").isNotNull()).write.parquet(_batch(path, uuid.uuid4().hex))
    return read_cache(spark, path, format="parquet")


def decisions_with_backend(
    requests: DataFrame, cache: DataFrame, client: Client, complete: Completion, path: str,
    *, order: list[str] | None = None, render: Render | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Cache first, then the backend, then the fallback.

    Of several identical requests of one run only the first in ``order`` counts as a
    call; the others are cache hits, as they would be one after another. With ``render`` the requests are
    ``keyed_rows``.
    """
    order = order or list(spec.key)
    fresh = complete_misses(requests, cache, client, complete, path, render=render).groupBy("cache_key").agg(
        F.max("raw_response").alias("_fresh")
    )
    keyed = requests if render is not None else with_cache_key(requests, client)
    looked = lookup(keyed, cache, client).join(fresh, "cache_key", "left")
    # The first request of a key: an aggregate, so that a key asked billions of times
    # is reduced before the shuffle.
    firsts = keyed.groupBy("cache_key").agg(F.min(F.struct(*order)).alias("_first"))
    looked = looked.join(firsts, "cache_key")
    first = F.col("_first") == F.struct(*order)
    hit = F.col("cache_hit")
    answered = F.col("_fresh").isNotNull()
    merged = looked.withColumns({
        "raw_response": F.coalesce("raw_response", "_fresh"),
        "backend_error": ~hit & ~answered,
        "cache_hit": hit | (answered & ~first),
        "cache_error": F.col("cache_error") & (first | ~answered),
    }).drop("_fresh", "_first")
    return decide(merged, spec)


def new_records(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """Records whose key the cache does not hold yet, one per key."""
    return requests.join(existing.select("cache_key"), "cache_key", "left_anti").dropDuplicates(["cache_key"])


def _batch(path: str, name: str) -> str:
    if not re.fullmatch(r"[0-9A-Za-z-]+", name):
        raise ValueError("A batch is named by letters, digits and hyphens.")
    return f"{path.rstrip('/')}/batch-{name}"


def _records_at(spark: SparkSession, path: str) -> DataFrame:
    """What a cache folder holds; nothing where there is none yet."""
    try:
        return read_cache(spark, path, format="parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD_SCHEMA)


def append_cache(records: DataFrame, existing: DataFrame, path: str, *, batch: str | None = None) -> None:
    """Add the records whose key neither ``existing`` nor the cache at ``path`` holds, one per key.

    Every append has a folder of its own, so that writers at work together never commit into one another's
    output. Records are staged in the shared folder first. A writer that may be started again names its
    ``batch``: what an attempt left behind is taken over and written anew, whole, so any number of attempts
    ends with the same records. Two writers that race may both add a key; ``one_per_key`` settles it.
    Rows without a key are left out.
    """
    spark = records.sparkSession
    target = _batch(path, batch or uuid.uuid4().hex)
    names = RECORD_SCHEMA.fieldNames()
    unseen = new_records(new_records(records.filter("cache_key IS NOT NULL"), existing), _records_at(spark, path))
    left = _records_at(spark, target) if batch else spark.createDataFrame([], RECORD_SCHEMA)
    staged = cut(one_per_key(unseen.select(*names).unionByName(left)), "cache-batch")
    staged.write.mode("overwrite").parquet(target)


def one_per_key(cache: DataFrame) -> DataFrame:
    """One record per key, whatever wrote them: one with a response if there is any, else the least."""
    names = RECORD_SCHEMA.fieldNames()
    best = F.min(F.struct(F.col("raw_response").isNull().alias("empty"), *names)).alias("r")
    return cache.filter("cache_key IS NOT NULL").groupBy(F.col("cache_key").alias("_k")).agg(best).select("r.*").select(*names)


def compact_cache(spark: SparkSession, path: str, into: str, *, files: int = 1) -> None:
    """The cache at ``path`` as one batch of ``files`` files at another path, one record per key.

    The old folder stays as it is for those who read it; whoever wants it gone removes it afterwards.
    """
    if files <= 0:
        raise ValueError("files must be positive")
    if into.rstrip("/") == path.rstrip("/"):
        raise ValueError("A cache is compacted into another folder.")
    kept = one_per_key(read_cache(spark, path, format="parquet"))
    kept.repartition(files, "cache_key").write.mode("overwrite").parquet(_batch(into, "compacted"))
