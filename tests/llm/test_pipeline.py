"""The corpus pipeline on the smallest tables, stage by stage."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from cinelens.llm import jaccard, linededup, packing, toxicity
from cinelens.llm.common import fold

from .fixtures import docs
from .test_near_copies import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = out[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == columns
        if name == "toxicity":
            model = toxicity.fit(before.filter(fold("doc_id", 5) != 0), spark.read.parquet(f"{SF}/labels.parquet"))
            good = {r["doc_id"] for r in toxicity.score(before, model).filter("score < 0.5").collect()}
            assert {r["doc_id"] for r in docs.collect()} == good and len(good) < before.count()
        if name == "line_dedup":
            lines = [b for r in docs.collect() for _, b in linededup.normalized(r["text"])]
            assert len(lines) == len(set(lines)) and docs.filter(F.length("text") != F.col("n_chars")).count() == 0
        if name == "ngram_jaccard":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            heads = set(brute(rows, jaccard.Params(words=5, num=80)).values())
            assert {r["doc_id"] for r in docs.collect()} == heads
        if name == "source_mix":
            size = lambda df: {r["doc_id"]: r["n"] for r in df.groupBy("doc_id").agg(F.sum(F.size(F.split(F.trim("text"), "\\s+"))).alias("n")).collect()}
            whole, mixed = size(before), size(docs)
            assert all(mixed[k] <= 3 * whole[k] for k in mixed) and abs(sum(mixed.values()) / sum(whole.values()) - 1) < 0.01
        if name == "packing":
            full = docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).toPandas()["n"]
            assert full.max() <= packing.Params().capacity and np.sum(full) > 0.95 * 4096 * len(full)


def test_run_and_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 0
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_no_shuffle_files_of_a_stage_beside_the_next(spark, tmp_path, monkeypatch):
    docs(spark, [(i, f"line {i}") for i in range(20)]).write.parquet(f"{tmp_path}/documents.parquet")
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if f.startswith("shuffle_")}
    before, seen = files(), []

    def dealt(spark, table, sf_dir):
        seen.append(files() - before)
        return table.repartition("doc_id")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(k), dealt) for k in range(3)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 20
    assert seen == [set()] * 3
