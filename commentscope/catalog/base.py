"""Registry of named queries, each with the SQL it is checked against where there is one."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentscope.catalog.golden import GOLDEN
from commentscope.operators import labels as L
from commentscope.session import INPUT_PARTITIONS

TEXT_LABELS = ["toxic", "low_quality"]
VECTOR_LABELS = ["low", "even", "third"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The driver tables in the shape of a comment study."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def comments(self) -> DataFrame:
        """(doc_id, comment_text) of the whole document table."""
        rows = self.read("documents").select("doc_id", F.coalesce("text", F.lit("")).alias("comment_text"))
        asked = self.spark.conf.get(INPUT_PARTITIONS, None)
        return rows.repartition(int(asked), "doc_id") if asked else rows

    @property
    def comments_and_golden(self) -> DataFrame:
        """All documents and the hand-made comments."""
        extra = self.spark.createDataFrame(GOLDEN, "doc_id long, comment_text string")
        return self.comments.unionByName(extra)

    @property
    def labels(self) -> DataFrame:
        return self.read("labels").select("doc_id", "toxic", (1 - F.col("quality")).alias("low_quality"))

    @property
    def labelled(self) -> DataFrame:
        """Comments with their labels, unscored ones left out."""
        return self.comments.join(self.labels, "doc_id")

    @property
    def with_unscored(self) -> DataFrame:
        return L.with_labels(self.comments, self.labels, "doc_id", TEXT_LABELS)

    @property
    def embedded(self) -> DataFrame:
        """Vectors with three 0/1 labels made from their class."""
        c = F.col("label")
        return self.read("embeddings").select(
            "vec_id", "embedding", (c < 5).cast("int").alias("low"), (c % 2 == 0).cast("int").alias("even"),
            (c % 3 == 0).cast("int").alias("third"))


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and fractions rounded to six places, as in the checks."""
    def one(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return (F.round(c.cast("double"), 6) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("long").alias(f.name)
        return c

    return df.select(*[one(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# ---- text of the checks -------------------------------------------------------------------

def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def sql_values(rows) -> str:
    one = lambda v: "NULL" if v is None else q(v) if isinstance(v, str) else repr(v)
    return "(VALUES " + ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows) + ")"


def chain(*steps: str) -> str:
    """WITH clause from 'name AS (...)' texts, empty ones left out."""
    return "WITH " + ",\n".join(s for s in steps if s) + "\n"


def nest(x: str, steps) -> str:
    return reduce(lambda inner, step: step(inner), steps, x)


DOCS = "d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents)"
DOCS_AND_GOLDEN = ("d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents UNION ALL "
                   f"SELECT * FROM {sql_values(GOLDEN)})")
LABELS_SQL = "l AS (SELECT doc_id, toxic, 1 - quality AS low_quality FROM labels)"
EMBEDDED_SQL = ("e AS (SELECT vec_id, embedding, (label < 5)::INT AS low, (label % 2 = 0)::INT AS even, "
                "(label % 3 = 0)::INT AS third FROM embeddings)")
