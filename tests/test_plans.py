"""Physical plans: no Python in the core, pruned scans, no single-task windows; streams equal batches."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from commentscope.catalog.model_queries import rate_scorer
from commentscope.functions import features as X
from commentscope.operators import lookups as J
from commentscope.streaming import scoring as G

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["clean_both_texts", "tokenize_words", "feature_table", "ngram_tfidf_2", "tag_word_frequency",
                                  "length_stats_by_label", "doc_embedding_mean", "mutual_information", "roc_auc"])
def test_no_python_in_the_core(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "EvalPython" not in text and "MapInPandas" not in text and "FlatMapGroups" not in text


@pytest.mark.parametrize("name", ["feature_table", "feature_table_serving", "clean_both_texts", "tokenize_words"])
def test_text_queries_are_projections_over_a_pruned_scan(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "Exchange" not in text and "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_one_word_in_every_document_leaves_bounded_partitions(spark):
    """Adaptive execution splits the partition of a frequent term, so no task gets most of the rows."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60_000, numPartitions=8).select("id", F.when(F.col("id") % 3 > 0, F.lit("the")).otherwise(F.concat(F.lit("w"), F.col("id"))).alias("word"))
        table = rows.select("word").distinct().withColumn("v", F.length("word"))
        joined = J.lookup_join(rows, table, "word")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 60_000 and max(sizes) < 20_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_unused_features_are_not_computed(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text").alias("comment_text"))
    text = plan(X.add_features(df, ["num_exclamation_marks"]))
    assert "INSET" not in text and "regexp_extract_all(clean" not in text


@pytest.mark.parametrize("name", ["kfold_contiguous", "tail_validation_split", "roc_auc", "mutual_information"])
def test_row_windows_run_per_block(spark, name):
    """The only window without the block in its partition sums the totals of the blocks."""
    for line in plan(entry.queries()[name](spark, SF)).splitlines():
        if " Window [" in line and "__inside_" in line:
            assert "__block" in line


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 2


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["a!", "", "??", "b c?", "!!x"] * 4)], "id long, t string")
    src, out, err, ck = (str(tmp_path / n) for n in ("src", "out", "err", "ck"))
    rows.repartition(3).write.parquet(src)
    start = lambda: G.score_stream(spark, src, "id long, t string", "id", "t", rate_scorer, 2, out, err, ck).awaitTermination()
    start()
    start()  # nothing new: nothing is written twice
    batch = G.score_comments(rows, "id", "t", rate_scorer, 2)
    got = {r["id"]: r["scores"] for r in spark.read.parquet(out).collect()}
    assert got == {r["id"]: r["scores"] for r in batch.collect()} and spark.read.parquet(out).count() == 20
    errors = {r["id"] for r in spark.read.parquet(err).collect()}
    assert errors == {r["id"] for r in G.errors_of(batch, "id").collect()} and len(errors) == 8
