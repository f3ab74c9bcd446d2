"""Small tables with the cases every operator must take: nulls, ties, repeats, long texts, clashing columns."""

from __future__ import annotations

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACED = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return SPACED.findall((text or "").translate(LOWER))


def prose(seed: int, n: int, kinds: int = 400) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["th", "er", "on", "an", "re", "é", "ß", "ti"]) for _ in range(1 + (k % 4))) for k in (r.randrange(kinds) for _ in range(n)))


def documents(spark, rows):
    """From (doc_id, text[, source]) tuples."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def with_clashes(docs, *names):
    """Extra columns named like those that operators use inside."""
    from pyspark.sql import functions as F

    for name in names or ("digest", "key", "node", "h", "score", "size", "found", "start", "_k", "rank", "block", "toxic"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs
