"""Reading and writing the tables of a comment study. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentscope.operators.reports import METRICS

LABELS = ["toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate"]

TEXT_SCHEMA = "id string, comment_text string"
LABEL_SCHEMA = "id string, " + ", ".join(f"{l} int" for l in LABELS)
TRAIN_SCHEMA = TEXT_SCHEMA + ", " + ", ".join(f"{l} int" for l in LABELS)
#: Stands for null in CSV files, so that an empty text stays an empty text.
NULL_MARK = "\\N"
#: Blanks at the ends of a text are part of it.
CSV_TEXT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": NULL_MARK}

SCORE_SCHEMA = "model string, " + ", ".join(f"{m} double" for m in METRICS)


def read_table(spark: SparkSession, path: str, schema: str, index_column: bool = False) -> DataFrame:
    """Headed CSV whose quoted fields may hold line ends and doubled quotes.

    A leading index column is named in the schema and dropped.
    """
    full = f"__index string, {schema}" if index_column else schema
    df = spark.read.schema(full).options(header=True, multiLine=True, emptyValue="", **CSV_TEXT).csv(path)
    return df.drop("__index") if index_column else df


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Headerless one-column file as distinct words: a line is a word, whatever signs it holds.

    A line in double quotes is taken without them, doubled quotes inside as one.
    """
    line = F.regexp_replace("value", "\r$", "")
    quoted = (F.length(line) >= 2) & line.startswith('"') & line.endswith('"')
    bare = F.replace(F.substring(line, F.lit(2), F.length(line) - 2), F.lit('""'), F.lit('"'))
    return spark.read.text(path).select(F.when(quoted, bare).otherwise(line).alias("word")).where("word <> ''").distinct()


def read_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All score tables of a folder in one job, with the file each row came from."""
    df = spark.read.schema(SCORE_SCHEMA).option("header", True).csv(folder)
    return df.withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def read_word_vectors(spark: SparkSession, path: str, k: int | None = None) -> DataFrame:
    """(word, vec) from text lines ``word v1 ... vk``; a header line of two fields is left out.

    With ``k``, the last k fields are the vector and all before them the word, which may hold blanks.
    Lines that are no vector are given by ``rejected_word_vectors``. Limit a large vocabulary by
    joining it with the words of the corpus, not by file order.
    """
    return _vector_lines(spark, path, k).where("vec IS NOT NULL").select("word", "vec")


def rejected_word_vectors(spark: SparkSession, path: str, k: int | None = None) -> DataFrame:
    """The lines that ``read_word_vectors`` leaves out, but for a header line."""
    return _vector_lines(spark, path, k).where("vec IS NULL AND size(p) > 2").select("value")


def _vector_lines(spark: SparkSession, path: str, k: int | None) -> DataFrame:
    rows = spark.read.text(path).withColumn("p", F.split(F.rtrim("value"), " "))
    cut = F.lit(1) if k is None else F.size("p") - k
    numbers = F.transform(F.slice("p", cut + 1, F.greatest(F.size("p") - cut, F.lit(0))), lambda x: x.try_cast("float"))
    whole = (F.size("p") > 2) & (cut >= 1)
    rows = rows.withColumn("vec", F.when(whole, numbers)).withColumn("word", F.when(whole, F.array_join(F.slice("p", F.lit(1), cut), " ")))
    return rows.withColumn("vec", F.when(~F.exists("vec", lambda x: x.isNull()), F.col("vec")))


def write_word_vectors(vectors: DataFrame, path: str) -> None:
    """Headless text form; the reader accepts files with and without a header line."""
    numbers = F.array_join(F.transform("vec", lambda x: x.cast("string")), " ")
    vectors.select(F.concat_ws(" ", "word", numbers)).write.mode("overwrite").text(path)


def parse_word_list(c: Column) -> Column:
    """Text form of a list of words, ['a', 'b'], to an array."""
    return F.from_json(c, T.ArrayType(T.StringType()), {"allowSingleQuotes": "true"})


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table; CSV gets a header and keeps quotes readable by ``read_table``."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(header=True, emptyValue='""', **CSV_TEXT).csv(path)
    else:
        w.format(fmt).save(path)


def write_predictions(df: DataFrame, key: str, labels: list[str], path: str, prob: str = "p_{}") -> None:
    """One probability column per label."""
    df.select(key, *[F.col(prob.format(l)).alias(l) for l in labels]).write.mode("overwrite").parquet(path)
