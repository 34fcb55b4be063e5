"""Registered queries against their SQL, and the pipeline against brute force."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martforge.llm import mixing, quality_rules
from martforge.llm.queries import ORACLE, QUERIES
from tests.llm import brute
from tests.oracle_compare import compare, duck, type_diff


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    con, df = duck(sf_dir), QUERIES[name](spark, sf_dir)
    assert type_diff(df, ORACLE[name], con) == {}
    r = compare(df, ORACLE[name], sf_dir, con)
    assert r["match"], r


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "pipeline" and int(n[2:].split("_")[0]) <= 10))
def test_queries_cover_their_table(spark, sf_dir, name):
    table = "pages" if name.startswith("op8") else "conversations" if name.startswith("op4") else "documents"
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    want = df.select("conv_id").distinct().count() + 1 if table == "conversations" else df.count()
    assert QUERIES[name](spark, sf_dir).count() == want


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "mixture", "shards"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        got = spark.read.parquet(path)
        if name == "quality_rules":
            kept = {r.doc_id for r in quality_rules.quality_report(docs).filter("kept").collect()}
            assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _ in given if i in kept)
        elif name == "near_duplicates":
            comp = brute.components([(i, brute.fingerprint(t)) for i, t in given])
            assert sorted(r.doc_id for r in got.collect()) == sorted(set(comp.values()))
        elif name == "decontamination":
            clean = Counter(i for i, t in given if not brute.contamination(t, bench)[1])
            assert Counter(r.doc_id for r in got.collect()) == clean
        elif name == "mixture":
            taken = {r.doc_id: r.copies for r in mixing.mix_report(docs).collect()}
            assert Counter(r.doc_id for r in got.collect()) == +Counter(taken)
        else:
            assert Counter((r.doc_id, r.text_crc32) for r in got.collect()) == Counter(
                (i, zlib.crc32(t.encode())) for i, t in given)
        if name != "shards":
            assert got.columns == docs.columns
        docs = got
    whole = corpus_pipeline.run(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert Counter({r.doc_id: r.n for r in whole}) == Counter(r.doc_id for r in docs.collect())
