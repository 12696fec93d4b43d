"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before has kept, and its decisions take effect: rejected documents go, one
document of each class of near copies stays, personal data is masked, documents are dropped or repeated
as the mix asks, and the last stage returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentscope.llm import mixing, packing, pii, quality, simhash
from commentscope.llm.common import one_per_name, quoted, written

TOKENIZER = "byte_bpe_50k.json"


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*map(quoted, docs.columns))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees."""
    trees = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns(quality.judge(docs, trees, docs.columns, prefix="__judged_").where("__judged_kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id."""
    return _columns(one_per_name(docs, simhash.representatives(simhash.near_duplicates(docs)), "doc_id", "text"), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; the length follows, a null text stays null."""
    found = pii.find_pii(docs, pii.train(docs), docs.columns, prefix="__found_")
    masked = F.when(F.col("text").isNotNull(), F.col("__found_masked"))
    out = found.withColumn("text", masked)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return _columns(out, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    oid = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    copies = mixing.mix(docs).groupBy(oid.alias("oid"), "tag").agg(F.sum("copies").alias("copies")).where("copies > 0")
    rows = one_per_name(docs, copies, "doc_id", "text")
    return _columns(rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n_copies").cast("int")))), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), end_id=0, capacity=1024)


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fitted models, fingerprints and packing have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
