"""Where derived tables go."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) a temporary one is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"On {master} name a folder that all executors share in spark.checkpoint.dir.")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="decisionlake-")
    return _local[app]


def table_path(spark: SparkSession, name: str, *identity: object) -> str:
    """A path of this application for a derived table."""
    digest = hashlib.md5("|".join(map(str, identity)).encode()).hexdigest()[:12]
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{digest}"


def cut(df: DataFrame, name: str, rows_at_once: int | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back, which ends its lineage.

    Unlike a cached block the written table outlives any executor. Rows of many MB need ``rows_at_once``: a task that
    writes or reads the table holds so many rows, where it else holds a hundred and up to 4,096, whatever their size.
    """
    path = table_path(df.sparkSession, name, uuid.uuid4())
    options = {"parquet.block.row.count.limit": str(rows_at_once)} if rows_at_once else {}
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
