"""Queries over the corpus: label counts, frequencies, tf-idf, distributions, flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentscope.catalog import text_sql as S
from commentscope.catalog.base import DOCS, LABELS_SQL, TEXT_LABELS, chain, q, query, sql_values
from commentscope.catalog.text_queries import COMPONENTS_SQL, LABELLED_SQL, UNSCORED_SQL, components
from commentscope.functions import features as X
from commentscope.functions import predicates as P
from commentscope.functions import text as T
from commentscope.functions import tokens as K
from commentscope.functions.lexicons import BAD_WORDS, LEMMA_EXCEPTIONS, LEMMA_VOCABULARY, STOP_WORDS, VALENCE
from commentscope.operators import corpus as C
from commentscope.operators import labels as L
from commentscope.operators.table_features import add_features_from_tables
from commentscope.operators.tfidf import term_frequencies, term_tfidf
from commentscope.plans.long_form import exploded, label_rows, unpivot_columns
from commentscope.plans.ordering import pinned

LABELLED_DOCS = "d AS (SELECT doc_id, coalesce(text, '') AS x, toxic, 1 - quality AS low_quality FROM documents JOIN labels USING (doc_id))"
DOC_LABELS = chain(DOCS, LABELS_SQL, LABELLED_SQL)


def word_table(t, words):
    return t.spark.createDataFrame([(w,) for w in words], "word string")


# ---- label counts -----------------------------------------------------------------------------

@query("label_totals", chain(LABELS_SQL) + "SELECT 'toxic' AS label, sum(toxic)::BIGINT AS positives FROM l UNION ALL "
       "SELECT 'low_quality', sum(low_quality)::BIGINT FROM l")
def _(t):
    return L.label_totals(t.labels, TEXT_LABELS)


@query("label_class_counts", chain(LABELS_SQL) + "SELECT label, y::BIGINT AS y, count(*) AS n FROM (SELECT 'toxic' AS label, "
       "toxic AS y FROM l UNION ALL SELECT 'low_quality', low_quality FROM l) GROUP BY ALL")
def _(t):
    return L.label_class_counts(t.labels, TEXT_LABELS)


@query("label_combinations", chain(DOCS, LABELS_SQL, UNSCORED_SQL) + "SELECT toxic::BIGINT AS toxic, low_quality::BIGINT AS "
       "low_quality, count(*) AS n FROM u GROUP BY toxic, low_quality")
def _(t):
    return L.label_combinations(t.with_unscored, TEXT_LABELS)


@query("toxic_vs_clean_share", chain(LABELS_SQL) + "SELECT count(*) FILTER (toxic + low_quality > 0) AS any_label, "
       "count(*) FILTER (toxic + low_quality = 0) AS no_label, count(*) AS total, "
       "round(count(*) FILTER (toxic + low_quality = 0) * 100.0 / count(*), 3)::DOUBLE AS pct_none FROM l")
def _(t):
    return L.clean_share(t.labels, TEXT_LABELS)


# ---- lengths, densities, summaries ---------------------------------------------------------------

LENGTHS_SQL = [
    LABELLED_DOCS,
    f"n AS (SELECT *, {S.noise('x')} AS noise FROM d)",
    f"tk AS (SELECT doc_id, toxic, low_quality, {S.words(S.strip_punct(S.clean('noise')))} AS a FROM n)",
    "ln AS (SELECT doc_id, toxic, low_quality, len(a)::DOUBLE AS words, coalesce(list_sum([length(w) FOR w IN a]), 0)::DOUBLE AS chars FROM tk)",
    "lb AS (SELECT 'toxic' AS label, * FROM ln WHERE toxic = 1 UNION ALL SELECT 'low_quality', * FROM ln WHERE low_quality = 1 "
    "UNION ALL SELECT 'none', * FROM ln WHERE toxic = 0 AND low_quality = 0)",
    "lg AS (SELECT label || ':words' AS feature, words AS value FROM lb UNION ALL SELECT label || ':chars', chars FROM lb "
    "UNION ALL SELECT label || ':avg_word_len', CASE WHEN words > 0 THEN chars / words END FROM lb)",
]
SUMMARY_SQL = ("SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, "
               "round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, "
               "round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max FROM {} GROUP BY feature")


def lengths_by_label(t):
    """(feature, value): words, characters and mean word length for each label and for none."""
    rows = T.clean_comments(t.labelled).select(
        *TEXT_LABELS, P.none_label(TEXT_LABELS).alias("none"),
        K.words_no_punctuation(F.col("clean_text")).alias("a"))
    measured = rows.select(
        *TEXT_LABELS, "none", F.size("a").cast("double").alias("words"),
        F.aggregate("a", F.lit(0), lambda s, w: s + F.length(w)).cast("double").alias("chars"))
    measured = measured.withColumn("avg_word_len", F.try_divide("chars", "words"))
    names = ["words", "chars", "avg_word_len"]
    long = label_rows(measured, names, [*TEXT_LABELS, "none"]).where("y = 1")
    return (long.unpivot(["label"], names, "measure", "value")
                .select(F.concat_ws(":", "label", "measure").alias("feature"), "value"))


@query("length_stats_by_label", chain(*LENGTHS_SQL) + SUMMARY_SQL.format("lg"))
def _(t):
    return C.summary(lengths_by_label(t))


def density_sql(steps, source, points):
    return chain(*steps,
        f"st AS (SELECT feature, count(*) AS n, stddev_samp(value) AS s, min(value) AS lo, max(value) AS hi FROM {source} GROUP BY feature)",
        "hh AS (SELECT *, s * pow(n, -0.2) AS h FROM st)",
        f"gr AS (SELECT hh.*, g.point, lo - 3 * h + (hi - lo + 6 * h) / {points - 1} * g.point AS gx FROM hh, range({points}) g(point))",
        f"dn AS (SELECT gr.feature, gr.point, any_value(gx) AS x, sum(exp(greatest(-0.5 * pow((gx - value) / h, 2), -745))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS y FROM gr JOIN {source} v ON v.feature = gr.feature WHERE v.value IS NOT NULL GROUP BY gr.feature, gr.point)"
    ) + "SELECT feature, point::BIGINT AS point, round(x, 4) AS x, round(y, 6) AS density FROM dn"


@query("density_by_label", density_sql(LENGTHS_SQL, "lg", 50))
def _(t):
    out = C.density(lengths_by_label(t), "feature", "value", 50)
    return out.select("feature", "point", F.round("x", 4).alias("x"), "density")


def binned_density_sql(steps, source, points, tolerance=1e-4):
    """The binned estimate, and whether it is within its bound of the exact one."""
    return chain(density_sql(steps, source, points).rsplit("SELECT feature, point::BIGINT", 1)[0].removeprefix("WITH ").rstrip(),
        f"wd AS (SELECT *, h * sqrt(8 * {tolerance}::DOUBLE) AS width FROM hh WHERE n > 1 AND s > 0)",
        f"ps AS (SELECT wd.feature, (value - lo) / width AS pos FROM wd JOIN {source} v ON v.feature = wd.feature WHERE value IS NOT NULL)",
        "cl AS (SELECT feature, floor(pos) AS cell, sum(1 - (pos - floor(pos))) AS near, sum(pos - floor(pos)) AS far FROM ps GROUP BY ALL)",
        "kr AS (SELECT gr.feature, gr.point, any_value(gx) AS x, any_value(gr.h) AS h, sum(near * exp(greatest(-0.5 * pow((gx - lo - cell * (gr.h * sqrt(8 * "
        f"{tolerance}::DOUBLE))) / gr.h, 2), -745)) + far * exp(greatest(-0.5 * pow((gx - lo - (cell + 1) * (gr.h * sqrt(8 * {tolerance}::DOUBLE))) / gr.h, 2), -745))) "
        "/ (any_value(gr.n) * any_value(gr.h) * sqrt(2 * pi())) AS y FROM gr JOIN cl ON cl.feature = gr.feature GROUP BY gr.feature, gr.point)"
    ) + ("SELECT kr.feature, kr.point::BIGINT AS point, round(kr.x, 4) AS x, round(kr.y, 6) AS density, "
         f"abs(kr.y - dn.y) <= {tolerance}::DOUBLE / (h * sqrt(2 * pi())) AS within_bound FROM kr JOIN dn USING (feature, point)")


@query("density_by_label_binned", binned_density_sql(LENGTHS_SQL, "lg", 50))
def _(t):
    values = pinned(lengths_by_label(t))
    exact = C.density(values, "feature", "value", 50).select("feature", "point", F.col("density").alias("exact"))
    out = C.binned_density(values, "feature", "value", 50).join(exact, ["feature", "point"])
    spread = values.groupBy("feature").agg((F.stddev_samp("value") * F.pow(F.count("value").cast("double"), F.lit(-0.2))).alias("h"))
    bound = 1e-4 / (F.col("h") * C.ROOT_2_PI)
    return out.join(spread, "feature").select(
        "feature", "point", F.round("x", 4).alias("x"), "density", (F.abs(F.col("density") - F.col("exact")) <= bound).alias("within_bound"))


DESCRIBED = X.feature_names(None)


@query("describe_features", S.feature_sql(DOCS, DESCRIBED).replace("\nSELECT doc_id,", ",\nf0 AS (SELECT doc_id,", 1) + "),\n"
       "lg AS (" + " UNION ALL ".join(f"SELECT {q(c)} AS feature, {c}::DOUBLE AS value FROM f0" for c in DESCRIBED) + ")\n"
       + SUMMARY_SQL.format("lg"))
def _(t):
    feats = X.add_features(t.comments, DESCRIBED)
    rounded = feats.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in DESCRIBED])
    return C.summary(unpivot_columns(rounded, [], DESCRIBED))


def histogram_sql(lo, hi, bins=10):
    return (f"WITH v AS (SELECT n_chars::DOUBLE AS x FROM documents), r AS (SELECT {lo}::DOUBLE AS lo, {hi}::DOUBLE AS hi FROM v), "
            f"c AS (SELECT least(floor((x - lo) / ((hi - lo) / {bins}))::INT, {bins - 1}) AS bin, count(*) AS n FROM v, r "
            "WHERE x >= lo AND x <= hi GROUP BY 1) "
            f"SELECT b.bin::BIGINT AS bin, round(lo + (hi - lo) / {bins} * b.bin, 6) AS lo, round(lo + (hi - lo) / {bins} * (b.bin + 1), 6) AS hi, "
            f"coalesce(n, 0)::BIGINT AS n FROM range({bins}) b(bin) CROSS JOIN r LEFT JOIN c ON c.bin = b.bin")


@query("histogram", histogram_sql("min(x)", "max(x)"))
def _(t):
    return C.histogram(t.read("documents"), "n_chars", 10)


@query("histogram_range", histogram_sql("0", "5000").replace("AS hi FROM v)", "AS hi)"))
def _(t):
    return C.histogram(t.read("documents"), "n_chars", 10, 0.0, 5000.0)


# ---- word and tag frequencies --------------------------------------------------------------------

LABELLED_PREP = "WITH " + ",\n".join([LABELLED_DOCS, *S.PREP, "pl AS (SELECT p.*, toxic, low_quality FROM p JOIN d USING (doc_id))"]) + ",\n"
SUBSETS = {"all": "true", "any_label": "toxic + low_quality > 0", "no_label": "toxic + low_quality = 0"}
SUBSET_ROWS = " UNION ALL ".join(f"SELECT {q(n)} AS subset, * FROM {{src}} WHERE {w}" for n, w in SUBSETS.items())


def with_subsets(df):
    """Each comment once per subset it is in: all, any_label or no_label."""
    part = F.when(P.any_label(TEXT_LABELS), "any_label").otherwise("no_label")
    return df.withColumn("subset", F.explode(F.array(F.lit("all"), part)))


def prepared(t):
    return X.prepare(t.labelled)


def tag_counts(t):
    """(subset, word, tag, n): one pass counts every subset side by side."""
    rows = exploded(prepared(t), TEXT_LABELS, F.col("POS_tagging_flat"), "i")
    labelled = P.any_label(TEXT_LABELS)
    wide = rows.groupBy("i.word", "i.tag").agg(
        F.count(F.lit(1)).alias("all"), F.count_if(labelled).alias("any_label"), F.count_if(~labelled).alias("no_label"))
    return wide.unpivot(["word", "tag"], ["all", "any_label", "no_label"], "subset", "n").where("n > 0")


TAG_COUNTS_SQL = (LABELLED_PREP + "sb AS (" + SUBSET_ROWS.format(src="pl") + "),\n"
                  "tc AS (SELECT subset, i.word AS word, i.tag AS tag, count(*) AS n FROM (SELECT subset, unnest(flat) AS i FROM sb) GROUP BY ALL)\n")


@query("tag_word_frequency", TAG_COUNTS_SQL + "SELECT subset, word, tag, n FROM tc")
def _(t):
    return tag_counts(t)


@query("tag_word_frequency_content", TAG_COUNTS_SQL + "SELECT word, tag, n FROM tc WHERE subset = 'all' AND word NOT IN ("
       + ", ".join(q(w) for w in STOP_WORDS) + ") AND word NOT IN (" + ", ".join(q(m) for m in T.PUNCTUATION) +
       ") ORDER BY n DESC, word, tag LIMIT 20")
def _(t):
    freq = C.frequencies(prepared(t), F.col("POS_tagging_flat"), ["word", "tag"])
    return C.top_k(C.content_frequencies(freq, word_table(t, STOP_WORDS), word_table(t, T.PUNCTUATION)),
                   "n", ["word", "tag"], 20)


NOSTOP_SQL = "[w FOR w IN lemmas IF w NOT IN (" + ", ".join(q(w) for w in STOP_WORDS) + ")]"


def lemmas_without_stops(t):
    return prepared(t).withColumn("a", K.remove_stop_words(F.col("lemmatization")))


@query("top_words", LABELLED_PREP + f"w AS (SELECT unnest({NOSTOP_SQL}) AS word FROM pl WHERE toxic + low_quality > 0) "
       "SELECT word, count(*) AS n FROM w GROUP BY word ORDER BY n DESC, word LIMIT 50")
def _(t):
    some = lemmas_without_stops(t).where(P.any_label(TEXT_LABELS))
    return C.top_k(C.frequencies(some, F.col("a"), ["word"]), "n", ["word"], 50)


TOP_PER_LABEL_SQL = (LABELLED_PREP + f"w AS (SELECT 'toxic' AS label, unnest({NOSTOP_SQL}) AS word FROM pl WHERE toxic = 1 "
                     f"UNION ALL SELECT 'low_quality', unnest({NOSTOP_SQL}) FROM pl WHERE low_quality = 1), "
                     "k AS (SELECT label, word, count(*) AS n FROM w GROUP BY ALL), "
                     "tp AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, word) AS rank FROM k) ")


@query("top_words_per_label", TOP_PER_LABEL_SQL + "SELECT label, word, n, rank FROM tp WHERE rank <= 50")
def _(t):
    return C.top_words_per_label(lemmas_without_stops(t), F.col("a"), TEXT_LABELS, 50)


@query("category_lexicon", TOP_PER_LABEL_SQL + "SELECT word, label AS category FROM tp WHERE rank <= 50 AND word IN ("
       + ", ".join(q(w) for w in BAD_WORDS) + ")")
def _(t):
    top = C.top_words_per_label(lemmas_without_stops(t), F.col("a"), TEXT_LABELS, 50)
    return C.category_lexicon(top, word_table(t, BAD_WORDS))


LEXICON_LABELS_SQL = TOP_PER_LABEL_SQL.replace("FROM documents JOIN labels", "FROM documents LEFT JOIN labels")
LEXICON_BASE = ["text_length", "num_words", "num_stop_words", "stop_words_vs_length", "stop_words_vs_words", "sentiment"]
LEXICON_FEATURES = [*LEXICON_BASE, *[n for l in TEXT_LABELS for n in (f"num_bad_{l}", f"bad_{l}_vs_length", f"bad_{l}_vs_words")]]


@query("features_from_lexicon", LEXICON_LABELS_SQL.rstrip() + ",\n" + ",\n".join(S.ONCE) + ",\n"
       "lx AS (SELECT word, label FROM tp WHERE rank <= 50 AND word IN (" + ", ".join(q(w) for w in BAD_WORDS) + ")), "
       "hb AS (SELECT doc_id, " + ", ".join(f"count(*) FILTER (label = {q(l)}) AS {l}" for l in TEXT_LABELS) +
       " FROM (SELECT doc_id, unnest(lemmas) AS word FROM p) JOIN lx USING (word) GROUP BY doc_id), "
       "fb AS (" + S.feature_select(LEXICON_BASE) + ") SELECT fb.*, " + ", ".join(
           f"coalesce({l}, 0) AS num_bad_{l}, " + ", ".join(f"round({S.ratio(f'coalesce({l}, 0)', by)}, 6) + 0.0 AS bad_{l}_vs_{end}"
                                                             for by, end in (("text_length", "length"), ("num_words", "words"))) for l in TEXT_LABELS)
       + " FROM fb LEFT JOIN hb USING (doc_id)")
def _(t):
    """Features of all comments with word tables as DataFrames; the bad words are the lexicon mined from the labels."""
    top = C.top_words_per_label(lemmas_without_stops(t), F.col("a"), TEXT_LABELS, 50)
    lexicon = pinned(C.category_lexicon(top, word_table(t, BAD_WORDS)))
    valences = t.spark.createDataFrame(list(VALENCE.items()), "word string, value double")
    exceptions = t.spark.createDataFrame(list(LEMMA_EXCEPTIONS.items()), "word string, lemma string")
    return add_features_from_tables(t.comments, LEXICON_FEATURES, TEXT_LABELS, word_table(t, STOP_WORDS), lexicon, valences,
                                    exceptions=exceptions, vocabulary=word_table(t, LEMMA_VOCABULARY))


# ---- n-grams --------------------------------------------------------------------------------------

def term_steps(n, docs=DOCS):
    """Terms as the vectorizer sees them: tokens joined by a space and cut again."""
    return [docs, f"n AS MATERIALIZED (SELECT *, {S.noise('x')} AS noise FROM d)",
            f"c AS MATERIALIZED (SELECT *, {S.clean('noise')} AS clean FROM n)",
            f"j AS MATERIALIZED (SELECT *, array_to_string({S.words('clean')}, ' ') AS j FROM c)",
            f"v AS MATERIALIZED (SELECT *, {S.vector_words('j')} AS a FROM j)",
            "u AS (SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS w FROM v)",
            "s AS (SELECT doc_id, " + " || ' ' || ".join(
                f"lead(w, {k}) OVER (PARTITION BY doc_id ORDER BY i)" for k in range(n)) + " AS term FROM u)",
            "g AS MATERIALIZED (SELECT doc_id, term FROM s WHERE term IS NOT NULL)"]


def vectorizer_words():
    return K.vector_words(F.array_join(K.words(F.col("clean_text"), ascii_only=True), " "))


def tfidf_sql(n, docs=DOCS):
    return chain(*term_steps(n, docs),
                 "tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL)",
                 "df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)",
                 "nn AS (SELECT count(*) AS n FROM d)",
                 "w AS (SELECT doc_id, term, tf * (ln((1 + n)::DOUBLE / (1 + df)) + 1) AS w FROM tf JOIN df USING (term), nn)",
                 "nm AS (SELECT doc_id, sqrt(sum(w * w)) AS m FROM w GROUP BY doc_id)",
                 "sc AS (SELECT term, sum(w / m) AS score FROM w JOIN nm USING (doc_id) GROUP BY term)") + \
        "SELECT term, round(score, 6) AS score FROM sc ORDER BY score DESC, term LIMIT 50"


for size in (2, 3):
    @query(f"ngram_frequency_{size}", chain(*term_steps(size)) +
           "SELECT term, count(*) AS n FROM g GROUP BY term ORDER BY n DESC, term LIMIT 50")
    def _(t, n=size):
        return C.top_k(term_frequencies(T.clean_comments(t.comments), vectorizer_words(), n), "n", ["term"], 50)

    @query(f"ngram_tfidf_{size}", tfidf_sql(size))
    def _(t, n=size):
        scores = term_tfidf(T.clean_comments(t.comments), vectorizer_words(), size=n)
        return C.top_k(scores.select("term", F.round("score", 6).alias("score")), "score", ["term"], 50)

    @query(f"ngram_tfidf_{size}_any_label", tfidf_sql(size, LABELLED_DOCS.replace(
        "USING (doc_id))", "USING (doc_id) WHERE toxic + (1 - quality) > 0)")))
    def _(t, n=size):
        some = t.labelled.where(P.any_label(TEXT_LABELS))
        scores = term_tfidf(T.clean_comments(some), vectorizer_words(), size=n)
        return C.top_k(scores.select("term", F.round("score", 6).alias("score")), "score", ["term"], 50)


# ---- sentiment --------------------------------------------------------------------------------------

LABELLED_SENTIMENT = chain(LABELLED_DOCS, *COMPONENTS_SQL, "sl AS (SELECT sc.*, toxic, low_quality FROM sc JOIN d USING (doc_id))",
                           "sb AS (" + SUBSET_ROWS.format(src="sl") + ")")


def labelled_compound(t):
    return components(t.labelled, *TEXT_LABELS).withColumn("compound", F.round("compound", 9))


@query("sentiment_buckets", LABELLED_SENTIMENT +
       "SELECT subset, count(*) FILTER (c < -0.05) AS negative, count(*) FILTER (c > 0.05) AS positive, "
       "count(*) FILTER (c > -0.05 AND c < 0.05) AS neutral, count(*) AS total, "
       "count(*) FILTER (c = 0.05 OR c = -0.05) AS remainder, "
       "round(count(*) FILTER (c < -0.05)::DOUBLE / count(*), 6) AS negative_share, "
       "round(count(*) FILTER (c > 0.05)::DOUBLE / count(*), 6) AS positive_share, "
       "round(count(*) FILTER (c > -0.05 AND c < 0.05)::DOUBLE / count(*), 6) AS neutral_share "
       "FROM (SELECT subset, round(compound, 9) AS c FROM sb) GROUP BY subset")
def _(t):
    return C.sentiment_buckets(with_subsets(labelled_compound(t)), "compound", ["subset"])


@query("crosstab", LABELLED_SENTIMENT + "SELECT toxic::BIGINT AS toxic, count(*) FILTER (round(compound, 9) >= -0.05) AS negative_0, "
       "count(*) FILTER (round(compound, 9) < -0.05) AS negative_1 FROM sl GROUP BY toxic")
def _(t):
    flagged = labelled_compound(t).withColumn("negative", P.is_negative(F.col("compound")))
    return C.crosstab(flagged, "toxic", "negative")


@query("sort_top_k", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def _(t):
    return C.top_k(t.read("documents").select("doc_id", "n_chars"), "n_chars", ["doc_id"], 20)


# ---- flagship ---------------------------------------------------------------------------------------

FLAGSHIP = ["text_length", "num_words", "num_words_vs_length", "exclamation_marks_vs_length",
            "punctuations_vs_length", "uppercase_vs_length"]


@query("features_by_class", S.feature_sql(DOCS, FLAGSHIP).replace("\nSELECT doc_id,", ",\nf0 AS (SELECT doc_id,", 1) + ")\n"
       "SELECT toxic::BIGINT AS toxic, count(*) AS n, " + ", ".join(f"round(avg({c}), 4) AS {c}" for c in FLAGSHIP) +
       " FROM f0 JOIN labels USING (doc_id) GROUP BY toxic")
def _(t):
    feats = X.add_features(t.comments.join(t.labels, "doc_id"), FLAGSHIP)
    rounded = [F.round(F.avg(F.round(c, 6)), 4).alias(c) for c in FLAGSHIP]
    return feats.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), *rounded)
