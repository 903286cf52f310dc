"""The vector search, and the pipeline's stages on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quotelake.llm import adaptive_scan, components

SF = "/root/testdata/sf0.001"


def brute(ids, x, k=5, every=50):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = u @ u[i]
        s[i] = -9
        out[int(ids[i])] = [int(ids[j]) for j in np.lexsort((ids, -np.round(s, 12)))[:k]]
    return out


def test_adaptive_scan_recall_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    n, d = 1500, 24
    x = (rng.normal(size=(n, d)) + 2 * rng.normal(size=(12, d))[rng.integers(0, 12, n)]).astype(np.float32)
    x[200:700] = x[200]  # a third of all rows with one vector
    ids = np.arange(n)
    rows = [(int(i), [float(v) for v in r], 1, 2) for i, r in zip(ids, x)]
    odd = [(None, rows[0][1], 1, 2), (5000, None, 1, 2), (5050, [0.0] * d, 1, 2), (5100, [float("nan")] * d, 1, 2),
           (5150, [None] + [1.0] * (d - 1), 1, 2), (5200, [1.0], 1, 2), rows[300]]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, part int, list int")
    got = {}
    for r in adaptive_scan.neighbours(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]])
    want = brute(ids, x.astype(float))
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9
    assert got[250] == [200, 201, 202, 203, 204]
    few = adaptive_scan.neighbours(spark.createDataFrame(rows[:3], df.schema)).collect()
    assert len(few) == 2
    assert adaptive_scan.neighbours(spark.createDataFrame([], df.schema)).count() == 0


def recall(spark, df):
    got = {}
    for r in adaptive_scan.neighbours(df).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = df.select("vec_id", "embedding").collect()
    want = brute(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float))
    assert set(got) == set(want)
    return np.mean([len(got[q] & set(want[q])) / 5 for q in want])


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_adaptive_scan_recall_on_given_embeddings(spark, size):
    assert recall(spark, spark.read.parquet(f"/root/testdata/{size}/embeddings.parquet")) >= 0.97


def test_adaptive_scan_recall_without_clusters(spark):
    x = np.random.default_rng(3).normal(size=(4000, 64))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    assert recall(spark, df) >= 0.97


def test_connected(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (60, 55), (55, 58)]
    got = {r[0]: r[1] for r in components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 55: 55, 58: 55, 60: 55}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "tokenize"]
    was = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.materialize(stage(spark, was, SF), name)
        assert now.columns == docs.columns + (["position", "copy"] if name == "mix" else [])
        if name != "mix":
            assert now.count() <= was.count()
            assert now.select("doc_id").exceptAll(was.select("doc_id")).isEmpty()
        was = now
    quality = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0")
    assert was.join(quality, "doc_id").select("doc_id").distinct().count() <= 1
    out = corpus_pipeline.STAGES[-1][1](spark, was, SF)
    assert out.count() == was.count()
    assert out.where("n_tokens <> size(token_ids)").isEmpty()
    # the training order survives the files between the stages
    assert out.where("position is null or position < 0 or position > 1").isEmpty()
    key = lambda df: [tuple(r) for r in df.orderBy("position", "doc_id", "copy").select("doc_id", "copy", "position").collect()]
    assert key(out) == key(was) and len(set(key(out))) == out.count()
    each = out.groupBy("source").agg({"position": "max"}).collect()
    assert all(r[1] > 0.5 for r in each)


def test_pipeline_with_nulls_repeats_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    docs = docs.withColumn("position", F.lit("mine")).withColumn("size", F.lit(1)).withColumn("component_id", F.lit(2))
    odd = spark.createDataFrame([(9_000_001, None, None, None, None), (9_000_002, "", "en", "a", 0), (None, "no id " * 50, "en", None, 300)],
                                "doc_id bigint, text string, lang string, source string, n_chars bigint")
    some = docs.limit(3)
    was = docs.unionByName(some).unionByName(some.withColumn("source", F.lit(None).cast("string"))) \
        .unionByName(odd, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.materialize(stage(spark, was, SF), name)
        assert now.count() > 50
        was = now
    assert {"doc_id", "n_tokens", "token_ids", "position", "copy"} <= set(was.columns)


def test_intermediate_tables_are_deleted(spark):
    import os

    from quotelake.llm import bbit_minhash, fuzzy_lines
    from quotelake.session import ensure_checkpoint_dir, local_path
    scratch = os.path.join(local_path(ensure_checkpoint_dir(spark)), "quotelake-scratch")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    fuzzy_lines.line_decisions(docs).count()
    bbit_minhash.near_duplicates(docs).count()
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(scratch)) - before}
    assert left <= {"lines", "minhash", "sets", "components"}   # what the lazy results read


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = spark.createDataFrame([], docs.schema)
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, SF).count() == 0
