"""Queries over comment texts: sources, predicates, cleaning, tokens, features."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from commentscope.catalog import text_sql as S
from commentscope.catalog.base import (DOCS, DOCS_AND_GOLDEN, LABELS_SQL, TEXT_LABELS, Tables, chain, q, query,
                                       sql_values)
from commentscope.catalog.golden import EDGES
from commentscope.functions import features as X
from commentscope.functions import predicates as P
from commentscope.functions import text as T
from commentscope.functions import tokens as K
from commentscope.functions.lexicons import LEMMA_EXCEPTIONS
from commentscope.operators import labels as L
from commentscope.operators import lookups as J
from commentscope.session import ensure_checkpoint_dir
from commentscope.sources import tables as IO

LABELLED_SQL = "dl AS (SELECT * FROM d JOIN l USING (doc_id))"
UNSCORED_SQL = ("u AS (SELECT doc_id, x, coalesce(toxic, -1) AS toxic, coalesce(low_quality, -1) AS low_quality "
                "FROM d LEFT JOIN l USING (doc_id))")


def scratch(t: Tables, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    ensure_checkpoint_dir(t.spark)
    return os.path.join(t.spark.sparkContext.getCheckpointDir(), f"{name}-{uuid.uuid4().hex}")


# ---- sources and sinks ----------------------------------------------------------------------

def edges(t: Tables):
    """(doc_id, text, lang) of all documents and of texts that a file format may change."""
    extra = t.spark.createDataFrame([(i, x, None) for i, x in EDGES], "doc_id long, text string, lang string")
    return t.read("documents").select("doc_id", "text", "lang").unionByName(extra)


EDGES_SQL = f"(SELECT doc_id, text, lang FROM documents UNION ALL SELECT *, NULL FROM {sql_values(EDGES)})"


@query("scan_table", f"SELECT doc_id::VARCHAR AS id, column1 AS comment_text, lang FROM {EDGES_SQL} t(doc_id, column1, lang)")
def _(t):
    path = scratch(t, "comments-csv")
    IO.write_table(edges(t).select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("comment_text"), "lang"), path, "csv")
    return IO.read_table(t.spark, path, IO.TEXT_SCHEMA + ", lang string")


@query("scan_pruned", "SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang")
def _(t):
    return (IO.read_parquet(t.spark, f"{t.dir}/documents.parquet", ["lang", "n_chars"])
            .groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")))


@query("scan_nested", chain(DOCS) + f"SELECT doc_id, len({S.vector_words('x')}) AS n_words, "
       f"array_to_string({S.vector_words('x')}, ' ') AS words FROM d")
def _(t):
    path = scratch(t, "nested-csv")
    listed = F.concat(F.lit("['"), F.array_join(K.vector_words(F.col("comment_text")), "', '"), F.lit("']"))
    some = F.when(F.size(K.vector_words(F.col("comment_text"))) > 0, listed).otherwise(F.lit("[]"))
    IO.write_table(t.comments.select("doc_id", some.alias("words")), path, "csv")
    back = IO.read_table(t.spark, path, "doc_id long, words string")
    return (back.withColumn("a", IO.parse_word_list(F.col("words")))
                .select("doc_id", F.size("a").alias("n_words"), F.array_join("a", " ").alias("words")))


@query("scan_headerless_words",
       chain(DOCS) + f"SELECT DISTINCT w AS word FROM (SELECT unnest({S.vector_words('x')}) AS w FROM d) "
       """UNION SELECT * FROM (VALUES ('x,y'), ('say "so"'), (' led'))""")
def _(t):
    path = scratch(t, "words")
    words = t.comments.select(F.explode(K.vector_words(F.col("comment_text"))).alias("word"))
    odd = t.spark.createDataFrame([("x,y",), ('"say ""so"""',), (" led",), ("",)], "word string")
    words.unionByName(odd).write.text(path)
    return IO.read_words(t.spark, path)


@query("scan_directory_union",
       "SELECT source AS model, lang AS part, count(*) AS n FROM documents GROUP BY source, lang")
def _(t):
    path = scratch(t, "folder")
    d = t.read("documents").select(F.col("source").alias("model"), F.col("lang").alias("part"))
    counts = d.groupBy("model", "part").agg(F.count(F.lit(1)).alias("n"))
    # one file or more per part
    counts.repartition("part").write.option("header", True).csv(path)
    return t.spark.read.schema("model string, part string, n long").option("header", True).csv(path)


@query("sink_table", f"SELECT 'parquet' AS format, * FROM {EDGES_SQL} UNION ALL SELECT 'csv', * FROM {EDGES_SQL}")
def _(t):
    parquet, csv = scratch(t, "sink"), scratch(t, "sink-csv")
    IO.write_table(edges(t), parquet)
    IO.write_table(edges(t), csv, "csv")
    back = t.spark.read.parquet(parquet).select(F.lit("parquet").alias("format"), "*")
    return back.unionByName(IO.read_table(t.spark, csv, "doc_id long, text string, lang string").select(F.lit("csv").alias("format"), "*"))


@query("scan_index_column", "SELECT doc_id, n_chars FROM documents")
def _(t):
    path = scratch(t, "indexed")
    IO.write_table(t.read("documents").select(F.lit("7").alias("index"), "doc_id", "n_chars"), path, "csv")
    return IO.read_table(t.spark, path, "doc_id long, n_chars long", index_column=True)


# ---- projections and filters ----------------------------------------------------------------

@query("project_drop_reorder", "SELECT n_chars, lang AS language, doc_id FROM documents")
def _(t):
    return t.read("documents").drop("text", "source").withColumnRenamed("lang", "language").select(
        "n_chars", "language", "doc_id")


@query("attach_columns", chain(DOCS, LABELS_SQL) + "SELECT doc_id, length(x) AS text_length, toxic::BIGINT AS toxic, "
       "low_quality::BIGINT AS low_quality FROM d JOIN l USING (doc_id)")
def _(t):
    lengths = t.comments.select("doc_id", F.length("comment_text").alias("text_length"))
    return L.attach_columns(lengths, t.labels, "doc_id")


@query("attach_columns_check", chain(DOCS, LABELS_SQL) + "SELECT count(*) FILTER (l.doc_id IS NULL) AS only_left, "
       "count(*) FILTER (d.doc_id IS NULL) AS only_right FROM d FULL JOIN l ON d.doc_id = l.doc_id")
def _(t):
    return L.unmatched_keys(t.comments, t.labels, "doc_id")


@query("filter_unscored", chain(DOCS, LABELS_SQL, UNSCORED_SQL) + "SELECT doc_id, toxic::BIGINT AS toxic, "
       "low_quality::BIGINT AS low_quality FROM u WHERE toxic <> -1 AND low_quality <> -1")
def _(t):
    return L.drop_unscored(t.with_unscored, TEXT_LABELS).select("doc_id", *TEXT_LABELS)


@query("filter_any_label", chain(DOCS, LABELS_SQL, LABELLED_SQL) + "SELECT doc_id, length(x) AS n FROM dl "
       "WHERE toxic = 1 OR low_quality = 1")
def _(t):
    return t.labelled.where(P.any_label(TEXT_LABELS)).select("doc_id", F.length("comment_text").alias("n"))


@query("filter_no_label", chain(DOCS, LABELS_SQL, LABELLED_SQL) + "SELECT doc_id, length(x) AS n FROM dl "
       "WHERE toxic = 0 AND low_quality = 0")
def _(t):
    return t.labelled.where(P.no_label(TEXT_LABELS)).select("doc_id", F.length("comment_text").alias("n"))


@query("filter_one_label", chain(DOCS, LABELS_SQL, LABELLED_SQL) + "SELECT doc_id, 'toxic' AS label FROM dl WHERE "
       "toxic = 1 UNION ALL SELECT doc_id, 'low_quality' FROM dl WHERE low_quality = 1")
def _(t):
    from commentscope.plans.long_form import label_rows
    return label_rows(t.labelled, ["doc_id"], TEXT_LABELS).where("y = 1").select("doc_id", "label")


@query("derive_none_label", chain(LABELS_SQL) + "SELECT doc_id, (1 - greatest(toxic, low_quality))::BIGINT AS none FROM l")
def _(t):
    return L.with_none_label(t.labels, TEXT_LABELS).select("doc_id", "none")


@query("guarded_ratio", chain(DOCS_AND_GOLDEN) + "SELECT doc_id, round(CASE WHEN length(x) > 0 THEN "
       "(length(x) - length(replace(x, '.', '')))::DOUBLE / length(x) ELSE 0 END, 6) AS ratio FROM d")
def _(t):
    c = F.col("comment_text")
    dots = F.length(c) - F.length(F.translate(c, ".", ""))
    return t.comments_and_golden.select("doc_id", P.guarded_ratio(dots, F.length(c)).alias("ratio"))


@query("threshold_labels", "SELECT doc_id, (n_chars % 101 >= 50)::BIGINT AS pred FROM documents")
def _(t):
    return t.read("documents").select("doc_id", P.threshold((F.col("n_chars") % 101) / 100.0).alias("pred"))


@query("exclude_zero_score_rows", chain(DOCS) + "SELECT doc_id FROM d WHERE regexp_matches(x, '[!?]')")
def _(t):
    c = F.col("comment_text")
    scores = F.array(X.count_char(c, "!").cast("double"), X.count_char(c, "?").cast("double"))
    return L.drop_zero_scores(t.comments.select("doc_id", scores.alias("scores")), "scores").select("doc_id")


def features_query(names, docs=DOCS_AND_GOLDEN):
    return S.feature_sql(docs, names)


@query("flag_negative_sentiment", "SELECT doc_id, (sentiment < -0.05)::BIGINT AS negative FROM ("
       + features_query(["sentiment"]) + ")")
def _(t):
    f = X.add_features(t.comments_and_golden, ["sentiment"])
    return f.select("doc_id", P.is_negative(F.round("sentiment", 6)).alias("negative"))


@query("regex_filter_tokens", "WITH " + ", ".join([DOCS, *S.PREP]) +
       f" SELECT doc_id, array_to_string([t.word FOR t IN flat IF {S.is_content('t')}], ' ') AS words FROM p")
def _(t):
    return X.prepare(t.comments).select(
        "doc_id", F.array_join(K.content_words(F.col("POS_tagging_flat")), " ").alias("words"))


# ---- cleaning ---------------------------------------------------------------------------------

def text_query(name, sql_fn, spark_fn, docs=DOCS_AND_GOLDEN):
    sql = chain(docs) + f"SELECT doc_id, {sql_fn('x')} AS text FROM d"

    @query(name, sql)
    def _(t):
        rows = t.comments_and_golden if docs is DOCS_AND_GOLDEN else t.comments
        return rows.select("doc_id", spark_fn(F.col("comment_text")).alias("text"))


text_query("clean_non_ascii", S.non_ascii, T.blank_non_ascii)
text_query("expand_contractions", S.contractions, T.expand_contractions)
text_query("strip_symbols", S.symbols, T.blank_symbols)
text_query("collapse_spaces", S.spaces, T.collapse_spaces)
text_query("lower_text", lambda x: f"lower({x})", F.lower)
text_query("dedupe_punctuation", S.dedupe, T.dedupe_punctuation)
text_query("strip_punctuation", S.strip_punct, T.strip_punctuation)


@query("strip_urls", f"SELECT page_id, {S.urls('html')} AS text FROM pages")
def _(t):
    return t.read("pages").select("page_id", T.blank_urls(F.col("html")).alias("text"))


@query("clean_both_texts", chain(DOCS_AND_GOLDEN, f"n AS (SELECT doc_id, {S.noise('x')} AS noise FROM d)") +
       f"SELECT doc_id, noise AS noise_removed_text, {S.clean('noise')} AS clean_text FROM n")
def _(t):
    return T.clean_comments(t.comments_and_golden).select("doc_id", "noise_removed_text", "clean_text")


# ---- tokens -----------------------------------------------------------------------------------

PREP_SQL = "WITH " + ",\n".join([DOCS_AND_GOLDEN, *S.PREP]) + "\n"


def joined(name, sql_array, column, separator=" "):
    """An array column as joined text with its size."""
    @query(name, PREP_SQL + f"SELECT doc_id, len({sql_array}) AS n, array_to_string({sql_array}, {q(separator)}) "
           "AS items FROM p")
    def _(t):
        rows = X.prepare(t.comments_and_golden).select("doc_id", column().alias("a"))
        return rows.select("doc_id", F.size("a").alias("n"), F.array_join("a", separator).alias("items"))


joined("tokenize_words", "tok", lambda: F.col("text_tokenized"))
joined("tokenize_nopunct", "nopunct", lambda: F.col("text_tokenized_nopunc"))
joined("split_sentences", S.sentences("clean"), lambda: K.sentences(F.col("clean_text")), " | ")
joined("tokens_per_sentence", "[array_to_string(s, ' ') FOR s IN sents]",
       lambda: F.transform(K.sentence_words(F.col("clean_text")), lambda s: F.array_join(s, " ")), " | ")
joined("tag_tokens", "[array_to_string([t.word || '/' || t.tag FOR t IN s], ' ') FOR s IN tagged]",
       lambda: F.transform("POS_tagging", lambda s: F.array_join(
           F.transform(s, lambda t: F.concat(t["word"], F.lit("/"), t["tag"])), " ")), " | ")
joined("flatten_tags", "[t.word || '/' || t.tag FOR t IN flat]",
       lambda: F.transform("POS_tagging_flat", lambda t: F.concat(t["word"], F.lit("/"), t["tag"])))
joined("lemmatize_content_words", "lemmas", lambda: F.col("lemmatization"))
joined("remove_stop_words", f"[w FOR w IN nopunct IF w NOT IN ({', '.join(q(w) for w in S.STOP_WORDS)})]",
       lambda: K.remove_stop_words(F.col("text_tokenized_nopunc")))
joined("word_tokens_2plus", S.vector_words("x"), lambda: K.vector_words(F.col("comment_text")))

def ngram_query(n):
    sql = chain(DOCS_AND_GOLDEN, f"t AS MATERIALIZED (SELECT doc_id, {S.vector_words('x')} AS a FROM d)",
                f"g AS MATERIALIZED (SELECT doc_id, {S.ngrams('a', n)} AS g FROM t)")

    @query(f"ngrams_{n}", sql + "SELECT doc_id, len(g) AS n, array_to_string(g, '|') AS items FROM g")
    def _(t):
        rows = t.comments_and_golden.select(
            "doc_id", K.ngrams(K.vector_words(F.col("comment_text")), n).alias("a"))
        return rows.select("doc_id", F.size("a").alias("n"), F.array_join("a", "|").alias("items"))


ngram_query(2)
ngram_query(3)


@query("join_tokens", PREP_SQL + "SELECT doc_id, array_to_string(nopunct, ' ') AS text FROM p")
def _(t):
    return X.prepare(t.comments_and_golden).select("doc_id", F.array_join("text_tokenized_nopunc", " ").alias("text"))




@query("lemmatize_corpus_vocabulary", chain(
    DOCS, f"tk AS (SELECT doc_id, {S.vector_words('x')} AS a FROM d)",
    "w AS (SELECT DISTINCT unnest(a) AS word FROM tk)",
    "cand AS (" + " UNION ALL ".join(
        f"SELECT word, {i} AS rank, left(word, length(word) - {len(e)}) || {q(new)} AS c FROM w WHERE suffix(word, {q(e)})"
        for i, (e, new) in enumerate(K.NOUN_ENDINGS.items())) + ")",
    "best AS (SELECT word, arg_min(c, rank) AS lemma FROM cand WHERE c IN (SELECT word FROM w) GROUP BY word)",
    "ex AS (SELECT * FROM (VALUES " + ", ".join(f"({q(a)}, {q(b)})" for a, b in LEMMA_EXCEPTIONS.items()) + ") v(word, lemma))",
    "pos AS (SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS word FROM tk)",
    "m AS (SELECT doc_id, i, coalesce(ex.lemma, best.lemma, pos.word) AS lemma FROM pos "
    "LEFT JOIN ex USING (word) LEFT JOIN best USING (word))") +
    "SELECT d.doc_id, coalesce(string_agg(m.lemma, ' ' ORDER BY m.i), '') AS lemmas FROM d LEFT JOIN m USING (doc_id) "
    "GROUP BY d.doc_id")
def _(t):
    rows = t.comments.select("doc_id", K.vector_words(F.col("comment_text")).alias("words"))
    exceptions = t.spark.createDataFrame(list(LEMMA_EXCEPTIONS.items()), "word string, lemma string")
    out = J.lemmatize_corpus(rows, "words", exceptions)
    return out.select("doc_id", F.array_join("words", " ").alias("lemmas"))


# ---- features -----------------------------------------------------------------------------------

def feature_query(name, columns, golden=True):
    @query(name, S.feature_sql(DOCS_AND_GOLDEN if golden else DOCS, columns))
    def _(t):
        return X.add_features(t.comments_and_golden if golden else t.comments, columns)


def with_ratios(*stems):
    return [c for s in stems for c in (f"num_{s}", f"{s}_vs_length", f"{s}_vs_words")]


feature_query("feat_length", ["text_length"])
feature_query("feat_sentences", ["num_sentences", "average_length", "max_length", "min_length", "std_length"])
feature_query("feat_words", ["num_words", "num_words_vs_length", "length_vs_num_words"])
feature_query("feat_stop_words", with_ratios("stop_words"))
feature_query("feat_exclamation", with_ratios("exclamation_marks"))
feature_query("feat_question", with_ratios("question_marks"))
feature_query("feat_punctuation", with_ratios("punctuations"))
feature_query("feat_unique_repeated", with_ratios("unique_words", "repeated_words"))
feature_query("feat_tag_counts", with_ratios("nouns", "adjectives", "verbs"))
feature_query("feat_uppercase", with_ratios("uppercase", "uppercase_words"))
feature_query("feat_datetime_counts", ["num_timestamp", "num_date_long", "num_date_short"])
feature_query("feat_special_sequences", ["num_ip", "num_http", "num_mail"])
feature_query("feat_readability", ["readability"])
feature_query("feat_sentiment", ["sentiment"])
feature_query("feat_bad_words", with_ratios(*[f"bad_{c}" for c in X.CATEGORIES]))
feature_query("feature_table", X.feature_names())
feature_query("feature_table_serving", X.SERVING_FEATURES, golden=False)


@query("feat_links_pages", f"SELECT page_id, {S.count('url', X.HTTP_LINK)} AS url_links, "
       f"{S.count('html', X.HTTP_LINK)} AS body_links FROM pages")
def _(t):
    return t.read("pages").select("page_id", X.count_matches(F.col("url"), X.HTTP_LINK, "://").alias("url_links"),
                                  X.count_matches(F.col("html"), X.HTTP_LINK, "://").alias("body_links"))


COMPONENTS_SQL = [
    f"n AS (SELECT doc_id, {S.noise('x')} AS noise FROM d)",
    f"c AS (SELECT doc_id, {S.clean('noise')} AS clean FROM n)",
    f"v AS (SELECT doc_id, [{S.valence('lower(w)')} FOR w IN {S.words('clean')}] AS v FROM c)",
    "z AS (SELECT doc_id, coalesce(list_sum([y + 1 FOR y IN v IF y > 0]), 0) AS pos, "
    "coalesce(list_sum([1 - y FOR y IN v IF y < 0]), 0) AS neg, len([y FOR y IN v IF y = 0])::DOUBLE AS neu, "
    "coalesce(list_sum(v), 0) AS s FROM v)",
    "sc AS (SELECT doc_id, CASE WHEN pos + neg + neu > 0 THEN pos / (pos + neg + neu) ELSE 0 END AS positive, "
    "CASE WHEN pos + neg + neu > 0 THEN neg / (pos + neg + neu) ELSE 0 END AS negative, "
    "CASE WHEN pos + neg + neu > 0 THEN neu / (pos + neg + neu) ELSE 0 END AS neutral, "
    "s / sqrt(s * s + 15) AS compound FROM z)",
]


def components(df, *kept):
    """(doc_id, kept columns, four components of the sentiment)."""
    cleaned = T.clean_comments(df).select("doc_id", *kept, X.word_valences(K.words(F.col("clean_text"))).alias("v"))
    return cleaned.select("doc_id", *kept, X.sentiment_components(F.col("v")).alias("s")).select("doc_id", *kept, "s.*")


@query("sentiment_components", chain(DOCS_AND_GOLDEN, *COMPONENTS_SQL) +
       "SELECT doc_id, round(positive, 6) AS positive, round(negative, 6) AS negative, round(neutral, 6) AS neutral, "
       "round(compound, 6) + 0.0 AS compound FROM sc")
def _(t):
    return components(t.comments_and_golden)
