"""The pipeline's stages and their decisions."""

import os

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

SF = f"{os.environ.get('TESTDATA', '/root/testdata')}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        at[name] = spark.read.parquet(str(tmp_path / name))
        docs = at[name]
        if name != cp.STAGES[-1][0]:
            assert docs.columns == list(cp.COLUMNS)
    texts = {name: {r["doc_id"]: r["text"] for r in df.collect()} for name, df in at.items() if "text" in df.columns}
    assert not any(brute.statistics(t)[-1] for t in texts["quality_rules"].values())
    near = brute.near(list(texts["quality_rules"].items()), 5, 8, 10)
    assert set(texts["near_duplicates"]) == {c for _, c in near.values()}
    items = [brute.tokens(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, t in texts["near_duplicates"].items() if any(" ".join(b) in " ".join(brute.tokens(t)) for b in items)}
    assert leaked == set(texts["near_duplicates"]) - set(texts["decontamination"])
    assert set(texts["secret_scan"]) == set(texts["decontamination"])
    changed = {i for i, t in texts["secret_scan"].items() if t != texts["decontamination"][i]}
    assert changed == {i for i, t in texts["secret_scan"].items() if "[SECRET]" in t}
    assert cp.secrets.scan(at["secret_scan"]).where(F.size("findings") > 0).count() == 0
    mixed = at["source_mixing"].collect()
    assert {r["doc_id"]: r["size"] for r in mixed} == {i: len(brute.words(t)) for i, t in texts["secret_scan"].items()}
    whole = {(r["doc_id"], r["taken"]) for r in cp.run(spark, SF).collect()}
    assert whole == {(r["doc_id"], r["taken"]) for r in mixed}


@pytest.mark.parametrize("stage", range(len(cp.STAGES)))
def test_stages_take_odd_tables(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0)], docs.schema)
    assert cp.STAGES[stage][1](spark, docs, SF).count() == 0
    extra = odd.withColumn("kept", F.lit("x")).withColumn("findings", F.lit(1)).withColumn("text_md5", F.lit(2))
    assert cp.STAGES[stage][1](spark, extra, SF).count() in (0, 2, 3)
