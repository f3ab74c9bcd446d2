import os

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from decisionlake.llm.queries import QUERIES
from decisionlake.llm.sql import SQL
from tests.llm import test_minhash_tensor, test_winnowing
from tests.llm.helpers import documents, prose

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SMALL}/{file}'")
    expected = con.execute(SQL[name]).df()
    found = QUERIES[name](spark, SMALL).toPandas()
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    key = next(c for c in ("doc_id", "page_id", "conv_id") if c in columns)
    a, b = (x[columns].sort_values(key).reset_index(drop=True) for x in (expected, found))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_pipeline_keeps_what_each_stage_must(spark, tmp_path):
    clean = [(i, prose(i, 60 + i % 30, 4000), "ab"[i % 2]) for i in range(200)]
    toxic = [(1000 + i, prose(600 + i, 40, 4000) + " vile scumbag moronic " * 2, "a") for i in range(60)]
    copies = [(2000 + i, clean[i][1], "b") for i in range(20)] + [(2100, clean[3][1] + " end", "a"), (7, clean[7][1], clean[7][2])]
    leaked = [(3000 + i, prose(900 + i, 20, 4000) + " " + prose(5000, 25, 4000), "a") for i in range(5)]
    rows = clean + toxic + copies + leaked + [(4000, None, "a"), (4001, "", None), (None, prose(42, 33, 4000), "b")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i, *_ in clean] + [(i, 0, 1) for i, *_ in toxic[:50]]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, prose(5000, 25, 4000))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    bad = {i for i, *_ in toxic}
    assert sorted(kept["toxicity"], key=str) == sorted(((i, t) for i, t, _ in rows if i not in bad), key=str)
    groups = {}
    for (i, t), named in zip(kept["toxicity"], [None] * len(rows)):
        groups.setdefault(i, t)
    expected = sorted({r[0] for r in test_minhash_tensor.brute(kept["toxicity"]) if r[3]}, key=str)
    assert sorted((i for i, _ in kept["near-duplicates"] if i is not None), key=str) == expected
    hit = {r[0] for r in test_winnowing.brute(kept["near-duplicates"], items) if r[5]}
    assert sorted(kept["decontamination"], key=str) == sorted((r for r in kept["near-duplicates"] if r[0] not in hit), key=str)
    assert hit == {3000 + i for i in range(5)} and 4000 in dict(kept["decontamination"])
    assert set(kept["mixing"]) <= set(kept["decontamination"]) and max(kept["mixing"].count(r) for r in set(kept["mixing"])) <= 2
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in last), key=str) == sorted((i for i, _ in kept["mixing"]), key=str)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, last), key=str)
