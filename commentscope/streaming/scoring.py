"""Scoring with an error table, as a batch and as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Scorer = Callable[[Column], Column]


def score_comments(df: DataFrame, key: str, text: str, scorer: Scorer, width: int) -> DataFrame:
    """(key, scores, error): ``scorer`` gives a struct(scores, error); an error means zeros."""
    out = df.select(key, scorer(F.col(text)).alias("__r"))
    zeros = F.array_repeat(F.lit(0.0), width)
    return out.select(key, F.when(F.col("__r.error").isNull(), F.col("__r.scores")).otherwise(zeros).alias("scores"),
                      F.col("__r.error").alias("error"))


def errors_of(scored: DataFrame, key: str) -> DataFrame:
    return scored.where("error is not null").select(key, "error")


def score_stream(spark: SparkSession, source: str, schema: str, key: str, text: str, scorer: Scorer,
                 width: int, scores_path: str, errors_path: str, checkpoint: str,
                 files_per_batch: int = 1000):
    """Score the files that a path or pattern names in batches until none is left, then stop.

    A batch is paced by its number of files; null texts are empty.
    The checkpoint makes a restart go on where it stopped; each batch replaces its own
    folder, so a batch that runs twice is stored once.
    """
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source))

    def store(batch: DataFrame, batch_id: int) -> None:
        scored = batch.persist()
        try:
            scored.select(key, "scores").write.mode("overwrite").parquet(f"{scores_path}/batch={batch_id}")
            errors_of(scored, key).write.mode("overwrite").parquet(f"{errors_path}/batch={batch_id}")
        finally:
            scored.unpersist()

    rows = rows.withColumn(text, F.coalesce(text, F.lit("")))
    return (score_comments(rows, key, text, scorer, width).writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
