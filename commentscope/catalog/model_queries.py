"""Queries over vectors, selection, sampling, training and evaluation."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from commentscope.catalog import text_sql as S
from commentscope.catalog.base import (DOCS, EMBEDDED_SQL, LABELS_SQL, TEXT_LABELS, VECTOR_LABELS, chain, q, query,
                                       sql_values)
from commentscope.catalog.golden import LABELLED_EDGES
from commentscope.catalog.corpus_queries import LABELLED_DOCS, density_sql
from commentscope.catalog.text_queries import scratch
from commentscope.functions import features as X
from commentscope.functions import predicates as P
from commentscope.functions import tokens as K
from commentscope.operators import corpus as C
from commentscope.operators import labels as L
from commentscope.operators import learners as B
from commentscope.operators import lookups as J
from commentscope.operators import metrics as M
from commentscope.operators import multilabel as ML
from commentscope.operators import reports as R
from commentscope.operators import sampling as A
from commentscope.operators import selection as Z
from commentscope.operators import sequences as Q
from commentscope.operators import vectors as V
from commentscope.plans.long_form import exploded, label_rows, unpivot_columns, unpivot_vector
from commentscope.plans.ordering import pinned, row_numbers
from commentscope.sources import tables as IO
from commentscope.streaming import scoring as G

# ---- word and document vectors -----------------------------------------------------------------

DIMS = 8


def words_of(t):
    return t.comments.select("doc_id", K.vector_words(F.col("comment_text")).alias("a"))


def word_vectors(t):
    """Vectors for the words that occur at least twice, drawn from a hash of the word."""
    vocab = J.corpus_vocabulary(words_of(t), "a", 2)
    part = lambda i: F.conv(F.substring(F.md5(F.concat(F.col("word"), F.lit(f":{i}"))), 1, 8), 16, 10).cast("double")
    return vocab.select("word", F.array(*[part(i) / F.lit(4294967296.0) for i in range(DIMS)]).alias("vec"))


VECTORS_SQL = [
    DOCS, f"tk AS MATERIALIZED (SELECT doc_id, unnest({S.vector_words('x')}) AS word FROM d)",
    "vc AS (SELECT word, count(*) AS n FROM tk GROUP BY word HAVING count(*) >= 2)",
    "wv AS MATERIALIZED (SELECT word, i AS dim, ('0x' || md5(word || ':' || i)[1:8])::BIGINT / 4294967296.0::DOUBLE AS x "
    f"FROM vc, range({DIMS}) r(i))",
]


@query("lookup_left_join", chain(*VECTORS_SQL, "u AS (SELECT word, count(*) AS n FROM tk GROUP BY word)") +
       "SELECT u.word, n, round(coalesce(sum(x), 0.0), 6) AS total FROM u LEFT JOIN wv USING (word) GROUP BY u.word, n")
def _(t):
    rows = J.corpus_vocabulary(words_of(t), "a")
    seen = V.lookup_vectors(rows, word_vectors(t), DIMS)
    return seen.select("word", "n", F.aggregate("vec", F.lit(0.0), lambda s, x: s + x).alias("total"))


@query("doc_embedding_mean", chain(*VECTORS_SQL, "c AS (SELECT doc_id, word, count(*) AS n FROM tk GROUP BY ALL)",
       "s AS (SELECT doc_id, sum(n) AS n FROM c GROUP BY doc_id)",
       "z AS (SELECT doc_id, dim, sum(x * n) AS x FROM c JOIN wv USING (word) GROUP BY ALL)") +
       f"SELECT d.doc_id, 'd' || r.i AS dim, round(coalesce(z.x, 0.0) / coalesce(s.n, 1), 6) AS x FROM d CROSS JOIN range({DIMS}) r(i) "
       "LEFT JOIN s USING (doc_id) LEFT JOIN z ON z.doc_id = d.doc_id AND z.dim = r.i")
def _(t):
    vecs = V.document_vectors(words_of(t), "doc_id", "a", word_vectors(t), DIMS)
    return unpivot_vector(vecs, ["doc_id"], "vec", "dim", "x")


DRAWN_SQL = "(('0x' || md5(word || ':' || i || ':{}')[1:8])::BIGINT / 4294967296.0::DOUBLE)"
FILLED_SQL = [*VECTORS_SQL, f"fw AS (SELECT DISTINCT word, i AS dim, {DRAWN_SQL.format(7)} AS x FROM (SELECT DISTINCT word FROM tk), range({DIMS}) r(i) "
              "WHERE word NOT IN (SELECT word FROM vc) UNION ALL SELECT word, dim, x FROM wv)"]


@query("doc_embedding_mean_filled", chain(*FILLED_SQL, "c AS (SELECT doc_id, word, count(*) AS n FROM tk GROUP BY ALL)",
       "s AS (SELECT doc_id, sum(n) AS n FROM c GROUP BY doc_id)",
       "z AS (SELECT doc_id, dim, sum(x * n) AS x FROM c JOIN fw USING (word) GROUP BY ALL)") +
       f"SELECT d.doc_id, 'd' || r.i AS dim, round(coalesce(z.x, 0.0) / coalesce(s.n, 1), 6) AS x FROM d CROSS JOIN range({DIMS}) r(i) "
       "LEFT JOIN s USING (doc_id) LEFT JOIN z ON z.doc_id = d.doc_id AND z.dim = r.i")
def _(t):
    vecs = V.document_vectors(words_of(t), "doc_id", "a", word_vectors(t), DIMS, fill_missing=True, seed=7)
    return unpivot_vector(vecs, ["doc_id"], "vec", "dim", "x")


@query("scan_word_vectors", chain(*VECTORS_SQL) + "SELECT word, count(*) AS dims, round(sum(round(x, 3)), 3) AS total FROM wv GROUP BY word")
def _(t):
    path = scratch(t, "vectors-text")
    short = word_vectors(t).select("word", F.transform("vec", lambda x: F.round(x, 3)).alias("vec"))
    IO.write_word_vectors(short, path)
    back = IO.read_word_vectors(t.spark, path, DIMS)
    total = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return back.select("word", F.size("vec").alias("dims"), F.round(total, 3).alias("total"))


VOCAB_N = 500
VOCAB_SQL = [*VECTORS_SQL[:2], f"k AS (SELECT word, count(*) AS n FROM tk GROUP BY word ORDER BY n DESC, word LIMIT {VOCAB_N - 1})",
             "vi AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS idx FROM k)",
             f"ps AS (SELECT doc_id, {S.vector_words('x')} AS a FROM d)",
             "pw AS (SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS word FROM ps)",
             "sq AS (SELECT d.doc_id, coalesce(list(idx ORDER BY i) FILTER (idx IS NOT NULL), []) AS seq FROM d LEFT JOIN pw USING (doc_id) "
             "LEFT JOIN vi USING (word) GROUP BY d.doc_id)"]


@query("vocab_index", chain(*VOCAB_SQL[:4]) + "SELECT word, n, idx FROM vi")
def _(t):
    return Q.vocab_index(words_of(t), "a", VOCAB_N)


def sequences(t):
    return Q.texts_to_sequences(words_of(t), "doc_id", "a", Q.vocab_index(words_of(t), "a", VOCAB_N))


def numbers_text(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), " ")


@query("texts_to_sequences", chain(*VOCAB_SQL) + "SELECT doc_id, len(seq) AS n, array_to_string(seq, ' ') AS seq FROM sq")
def _(t):
    return sequences(t).select("doc_id", F.size("seq").alias("n"), numbers_text("seq").alias("seq"))


@query("pad_sequences", chain(*VOCAB_SQL) + "SELECT doc_id, array_to_string(list_resize([]::BIGINT[], greatest(100 - len(seq), 0), 0) || "
       "seq[greatest(len(seq) - 99, 1):], ' ') AS seq FROM sq")
def _(t):
    return sequences(t).select("doc_id", numbers_text(Q.pad_front(F.col("seq"), 100)).alias("seq"))


# every word has a row; words seen once have no vector
MATRIX_SQL = [*VECTORS_SQL, "al AS (SELECT word, count(*) AS n FROM tk GROUP BY word)",
              "ix AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) AS idx FROM al)",
              "st2 AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM wv)"]

@query("embedding_matrix", chain(
       *MATRIX_SQL, "mi AS MATERIALIZED (SELECT ix.word, ix.idx FROM ix ANTI JOIN vc USING (word))",
       f"dr AS MATERIALIZED (SELECT word, idx, i, {DRAWN_SQL.format('0:1')} AS u1, {DRAWN_SQL.format('0:2')} AS u2 FROM mi, range({DIMS}) r(i))") +
       "SELECT word, idx, 'd' || dim AS dim, round(x, 6) AS x FROM wv JOIN ix USING (word) UNION ALL SELECT word, idx, 'd' || i, round(m + s * sqrt(-2.0 * ln(u1 + 0.5 / 4294967296.0::DOUBLE)) "
       "* cos(6.283185307179586::DOUBLE * (u2 + 0.5 / 4294967296.0::DOUBLE)), 6) FROM dr, st2")
def _(t):
    vocab = J.corpus_vocabulary(words_of(t), "a")
    ranked = row_numbers(vocab.withColumn("below", -F.col("n")), ["below", "word"], "idx")
    matrix = V.embedding_matrix(ranked, word_vectors(t), DIMS)
    return unpivot_vector(matrix, ["word", "idx"], "vec", "dim", "x")


POSITIONS = 16


@query("block_inference", chain(DOCS, f"tk AS (SELECT doc_id, unnest({S.vector_words('x')}) AS word FROM d)",
       f"ct AS (SELECT doc_id, ('0x' || md5(word)[1:8])::BIGINT % {POSITIONS} AS at, count(*)::DOUBLE AS n FROM tk GROUP BY ALL)", "nm AS (SELECT doc_id, sqrt(sum(n * n)) AS m FROM ct GROUP BY doc_id)") +
       f"SELECT d.doc_id, 'd' || r.i AS dim, round(coalesce(n / m, 0.0), 6) AS x FROM d CROSS JOIN range({POSITIONS}) r(i) LEFT JOIN nm USING (doc_id) LEFT JOIN ct ON ct.doc_id = d.doc_id AND ct.at = r.i")
def _(t):
    ids = V.hashed_positions(K.vector_words(F.col("comment_text")), POSITIONS)
    vecs = V.encode_batches(t.comments.select("doc_id", ids.alias("ids")), "doc_id", "ids", V.bag_of_positions(POSITIONS))
    return unpivot_vector(vecs, ["doc_id"], "vec", "dim", "x")


# ---- selection -----------------------------------------------------------------------------------

LONG_SQL = [EMBEDDED_SQL, "lg AS MATERIALIZED (SELECT vec_id, 'd' || (i - 1) AS feature, embedding[i]::DOUBLE AS value, low, even, third "
            "FROM e, range(1, 65) r(i))"]
CORR_SQL = [*LONG_SQL, "cr AS (" + " UNION ALL ".join(
    f"SELECT feature, {q(l)} AS label, CASE WHEN min(value) < max(value) THEN corr(value, {l}) END AS r FROM lg GROUP BY feature"
    for l in VECTOR_LABELS) + ")"]
CUT = 0.08


def vector_long(t):
    return unpivot_vector(t.embedded, VECTOR_LABELS, "embedding")


VECTOR_NAMES = [f"d{i}" for i in range(64)]


def correlations(t):
    return Z.vector_label_correlation(t.embedded, "embedding", VECTOR_NAMES, VECTOR_LABELS)


GAPS = "CASE WHEN vec_id % 7 = 0 THEN NULL ELSE value END"


@query("feature_label_correlation", chain(*CORR_SQL, f"gp AS (SELECT feature || '_gaps' AS feature, {GAPS} AS value, low, even, third FROM lg)") +
       "SELECT feature, label, round(r, 6) AS r FROM cr UNION ALL " + " UNION ALL ".join(
    f"SELECT feature, {q(l)}, round(CASE WHEN min(value) < max(value) THEN corr(value, {l}) END, 6) FROM gp GROUP BY feature" for l in VECTOR_LABELS))
def _(t):
    gaps = F.transform("embedding", lambda x: F.when(F.col("vec_id") % 7 != 0, x))
    names = VECTOR_NAMES + [f"{n}_gaps" for n in VECTOR_NAMES]
    return Z.vector_label_correlation(t.embedded, F.concat("embedding", gaps), names, VECTOR_LABELS)


@query("feature_label_correlation_text", S.feature_sql(LABELLED_DOCS, X.SERVING_FEATURES).replace(
    "\nSELECT doc_id,", ",\nf0 AS (SELECT doc_id,", 1) + "),\nlt AS (" + " UNION ALL ".join(
        f"SELECT {q(c)} AS feature, {c}::DOUBLE AS value, toxic, 1 - quality AS low_quality FROM f0 JOIN labels USING (doc_id)"
        for c in X.SERVING_FEATURES) + ")\n" + " UNION ALL ".join(
    f"SELECT feature, {q(l)} AS label, round(CASE WHEN min(value) < max(value) THEN corr(value, {e}) END, 5) AS r FROM lt GROUP BY feature"
    for l, e in (("toxic", "toxic"), ("low_quality", "low_quality"), ("none", "1 - greatest(toxic, low_quality)"))))
def _(t):
    feats = X.add_features(L.with_none_label(t.labelled, TEXT_LABELS), X.SERVING_FEATURES)
    vector = F.array(*[F.round(F.col(c).cast("double"), 6) for c in X.SERVING_FEATURES])
    out = Z.vector_label_correlation(feats, vector, X.SERVING_FEATURES, [*TEXT_LABELS, "none"])
    return out.withColumn("r", F.round("r", 5))


@query("correlation_filter", chain(*CORR_SQL) + f"SELECT feature, round(max(abs(r)), 6) AS max_abs_r FROM cr GROUP BY feature HAVING max(abs(r)) > {CUT}")
def _(t):
    return Z.correlation_filter(correlations(t), CUT)


@query("embedding_useful_ratio", chain(*CORR_SQL, "b AS (SELECT max(abs(r)) AS m FROM cr GROUP BY feature)") +
       f"SELECT count(*) FILTER (m > {CUT}) AS kept, count(*) AS total, round(count(*) FILTER (m > {CUT})::DOUBLE / count(*), 6) AS ratio FROM b")
def _(t):
    return Z.useful_ratio(correlations(t), CUT)


WIDE = [f"d{i}" for i in range(64)]


def vector_wide(t, names=WIDE):
    return t.embedded.select("vec_id", *VECTOR_LABELS, *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(names)])


WIDE_SQL = [EMBEDDED_SQL, "w AS (SELECT vec_id, low, even, third, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS {c}" for i, c in enumerate(WIDE)) + " FROM e)"]


@query("correlation_matrix", chain(*LONG_SQL) + "SELECT a.feature AS a, b.feature AS b, round(corr(a.value, b.value), 6) AS r "
       "FROM lg a JOIN lg b USING (vec_id) GROUP BY a.feature, b.feature")
def _(t):
    return Z.correlation_matrix(vector_wide(t), WIDE)


COLLINEAR_CUT = 0.1


@query("drop_collinear", "WITH RECURSIVE " + chain(*CORR_SQL, "pr AS (SELECT a.feature AS a, b.feature AS b, corr(a.value, b.value) AS r FROM lg a JOIN lg b USING (vec_id) GROUP BY 1, 2)",
       f"cl AS (SELECT a, list(b) AS clash FROM pr WHERE a <> b AND abs(r) > {COLLINEAR_CUT} GROUP BY a)", "sg AS (SELECT feature, max(abs(r)) AS m FROM cr GROUP BY feature)",
       "rk AS (SELECT feature, m, coalesce(clash, []) AS clash, row_number() OVER (ORDER BY m DESC NULLS LAST, feature) AS i FROM sg LEFT JOIN cl ON a = feature)",
       "g(i, kept, feature, m, ok) AS (SELECT 0::BIGINT, []::VARCHAR[], NULL::VARCHAR, NULL::DOUBLE, NULL::BOOLEAN UNION ALL "
       "SELECT rk.i, CASE WHEN len(list_intersect(g.kept, rk.clash)) = 0 THEN list_append(g.kept, rk.feature) ELSE g.kept END, rk.feature, rk.m, "
       "len(list_intersect(g.kept, rk.clash)) = 0 FROM g JOIN rk ON rk.i = g.i + 1)").removeprefix("WITH ") +
       "SELECT feature, round(m, 6) AS max_abs_r, ok AS kept FROM g WHERE i > 0")
def _(t):
    strength = correlations(t).groupBy("feature").agg(F.max(F.abs("r")).alias("max_abs_r"))
    return Z.drop_collinear(Z.correlation_matrix(vector_wide(t), WIDE), strength, COLLINEAR_CUT)


SCALED_SQL = ", ".join(f"round((w.{c} - lo.{c}) / CASE WHEN hi.{c} > lo.{c} THEN hi.{c} - lo.{c} ELSE 1 END, 6) + 0.0 AS {c}_scaled" for c in WIDE)


def limits_sql(where):
    return [f"lo AS (SELECT " + ", ".join(f"min({c}) AS {c}" for c in WIDE) + f" FROM w WHERE {where})",
            f"hi AS (SELECT " + ", ".join(f"max({c}) AS {c}" for c in WIDE) + f" FROM w WHERE {where})"]


@query("minmax_scale_fit_transform", chain(*WIDE_SQL, *limits_sql("true")) + f"SELECT w.vec_id, {SCALED_SQL} FROM w, lo, hi")
def _(t):
    wide = vector_wide(t).select("vec_id", *WIDE)
    return Z.apply_minmax(wide, Z.fit_minmax(wide, WIDE), WIDE).drop(*WIDE)


@query("minmax_scale_apply", chain(*WIDE_SQL, *limits_sql("low = 1")) + f"SELECT w.vec_id, {SCALED_SQL} FROM w, lo, hi WHERE low = 0")
def _(t):
    wide = vector_wide(t)
    limits = Z.fit_minmax(wide.where("low = 1"), WIDE)
    return Z.apply_minmax(wide.where("low = 0").select("vec_id", *WIDE), limits, WIDE).drop(*WIDE)


MI_SQL = [*LONG_SQL, "ed AS (SELECT feature, [" + ", ".join(f"quantile_cont(value, {i / 10})" for i in range(1, 10)) + "] AS edges FROM lg GROUP BY feature)",
          "bn AS (SELECT feature, len([x FOR x IN edges IF x < value]) AS bin, low, even, third FROM lg JOIN ed USING (feature))",
          "jt AS (" + " UNION ALL ".join(f"SELECT feature, {q(l)} AS label, bin, {l} AS y FROM bn" for l in VECTOR_LABELS) + ")",
          "jc AS (SELECT feature, label, bin, y, count(*) AS c FROM jt GROUP BY ALL)",
          "jx AS (SELECT *, sum(c) OVER (PARTITION BY feature, label) AS n, sum(c) OVER (PARTITION BY feature, label, bin) AS cx, "
          "sum(c) OVER (PARTITION BY feature, label, y) AS cy FROM jc)",
          "mi AS (SELECT feature, label, sum(c::DOUBLE / n * ln(c::DOUBLE * n / (cx::DOUBLE * cy))) AS mi FROM jx GROUP BY ALL)",
          "mr AS (SELECT feature, label, round(mi, 6) AS mi, row_number() OVER (PARTITION BY label ORDER BY round(mi, 6) DESC, feature) AS rank FROM mi)",
          "tp AS (SELECT * FROM mr WHERE rank <= 20)"]


def information(t):
    return Z.mutual_information(vector_long(t), VECTOR_LABELS).withColumn("mi", F.round("mi", 6))


def best_features(t, k=20):
    return Z.top_per_label(information(t), "mi", k)


@query("mutual_information", chain(*MI_SQL) + "SELECT feature, label, round(mi, 6) AS mi FROM mi")
def _(t):
    return information(t)


@query("top_features_per_label", chain(*MI_SQL) + "SELECT feature, label, mi, rank FROM tp")
def _(t):
    return best_features(t)


@query("feature_vote_count", chain(*MI_SQL) + "SELECT feature, count(*) AS votes FROM tp GROUP BY feature")
def _(t):
    return Z.vote_counts(best_features(t))


SEL_SQL = CORR_SQL[-1]
SELECTED_SQL = f"sl AS (SELECT feature FROM cr GROUP BY feature HAVING max(abs(r)) > {CUT})"


@query("intersect_features", chain(*MI_SQL, SEL_SQL, SELECTED_SQL) + "SELECT label, count(*) AS shared FROM tp WHERE feature IN (SELECT feature FROM sl) GROUP BY label")
def _(t):
    return Z.intersect_features(best_features(t), Z.correlation_filter(correlations(t), CUT))


@query("feature_status", chain(*MI_SQL, SEL_SQL, SELECTED_SQL) + "SELECT DISTINCT feature, CASE WHEN feature IN (SELECT feature FROM sl) THEN 'selected' "
       "WHEN feature IN (SELECT feature FROM tp WHERE label = 'third') THEN 'minority' ELSE 'other' END AS status FROM lg")
def _(t):
    return Z.feature_status(vector_long(t), Z.correlation_filter(correlations(t), CUT), best_features(t), ["third"])


MODEL_COLS = X.MODEL_FEATURES
MODEL_SQL = (S.feature_sql(LABELLED_DOCS, MODEL_COLS).replace("\nSELECT doc_id,", ",\nf0 AS (SELECT doc_id,", 1) + "),\n"
             "mm AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in X.SCALED_FEATURES) + " FROM f0),\n"
             "md AS (SELECT doc_id, toxic, 1 - quality AS low_quality, " + ", ".join(
                 f"round(({c} - lo_{c})::DOUBLE / greatest(hi_{c} - lo_{c}, 1), 6) AS {c}_scaled" if c in X.SCALED_FEATURES else c for c in MODEL_COLS)
             + " FROM f0 JOIN labels USING (doc_id), mm)\n")
MODEL_NAMES = [f"{c}_scaled" if c in X.SCALED_FEATURES else c for c in MODEL_COLS]


def model_table(t):
    """Labels, none, and the model features in one named order, three of them scaled."""
    # numbers only: written once, read by the fit and by the scaling
    feats = pinned(X.add_features(L.with_none_label(t.labelled, TEXT_LABELS), MODEL_COLS))
    scaled = Z.apply_minmax(feats, Z.fit_minmax(feats, X.SCALED_FEATURES), X.SCALED_FEATURES)
    return scaled.select("doc_id", *TEXT_LABELS, "none", *MODEL_NAMES)


@query("select_model_columns", MODEL_SQL + "SELECT doc_id, toxic::BIGINT AS toxic, low_quality::BIGINT AS low_quality, "
       "(1 - greatest(toxic, low_quality))::BIGINT AS none, " + ", ".join(MODEL_NAMES) + " FROM md")
def _(t):
    return model_table(t)


UNLABELLED_SQL = (S.feature_sql(DOCS, MODEL_COLS).replace("\nSELECT doc_id,", ",\nf0 AS (SELECT doc_id,", 1) + "),\n"
                  "mm AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in X.SCALED_FEATURES) + " FROM f0 JOIN labels USING (doc_id))\n"
                  "SELECT doc_id, " + ", ".join(
                      f"round(({c} - lo_{c})::DOUBLE / greatest(hi_{c} - lo_{c}, 1), 6) AS {c}_scaled" if c in X.SCALED_FEATURES else c for c in MODEL_COLS)
                  + " FROM f0, mm WHERE doc_id NOT IN (SELECT doc_id FROM labels)")


@query("select_model_columns_unlabelled", UNLABELLED_SQL)
def _(t):
    """The same columns in the same order for the rows to be predicted, scaled by the limits of the labelled ones."""
    feats = pinned(X.add_features(t.comments, MODEL_COLS))
    limits = Z.fit_minmax(feats.join(t.labels, "doc_id", "left_semi"), X.SCALED_FEATURES)
    rows = feats.join(t.labels, "doc_id", "left_anti")
    return Z.apply_minmax(rows, limits, X.SCALED_FEATURES).select("doc_id", *MODEL_NAMES)


KEPT_SQL = [*VECTORS_SQL, "c AS (SELECT doc_id, word, count(*) AS n FROM tk GROUP BY ALL)", "s AS (SELECT doc_id, sum(n) AS n FROM c GROUP BY doc_id)",
            "z AS (SELECT doc_id, dim, sum(x * n) AS x FROM c JOIN wv USING (word) GROUP BY ALL)",
            f"m AS MATERIALIZED (SELECT d.doc_id, 'd' || r.i AS dim, round(coalesce(z.x, 0.0) / coalesce(s.n, 1), 6) AS x FROM d CROSS JOIN range({DIMS}) r(i) "
            "LEFT JOIN s USING (doc_id) LEFT JOIN z ON z.doc_id = d.doc_id AND z.dim = r.i)",
            "k AS (SELECT dim FROM m JOIN labels USING (doc_id) GROUP BY dim HAVING greatest(abs(corr(x, toxic)), abs(corr(x, 1 - quality))) > 0.05)"]


@query("select_model_vectors", chain(*KEPT_SQL) + "SELECT doc_id, dim, x FROM m JOIN k USING (dim)")
def _(t):
    """Document vectors of all rows, in the dimensions that follow a label of the labelled ones."""
    vecs = V.document_vectors(words_of(t), "doc_id", "a", word_vectors(t), DIMS)
    long = pinned(unpivot_vector(vecs, ["doc_id"], "vec", "dim", "x").withColumn("x", F.round("x", 6)))
    known = long.join(t.labels, "doc_id").select(F.col("dim").alias("feature"), F.col("x").alias("value"), *TEXT_LABELS)
    kept = Z.correlation_filter(Z.label_correlation(known, TEXT_LABELS), 0.05)
    return long.join(kept.select(F.col("feature").alias("dim")), "dim", "left_semi")


FULL_VECTOR_SQL = ", ".join(f"max(x) FILTER (dim = 'd{i}' AND dim IN (SELECT dim FROM k)) AS d{i}" for i in range(DIMS))
FULL_SQL = (S.feature_sql(DOCS, MODEL_COLS).replace("\nSELECT doc_id,", ",\nf0 AS (SELECT doc_id,", 1) + "),\n"
            "mm AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in X.SCALED_FEATURES) + " FROM f0 JOIN labels USING (doc_id)),\n"
            + ",\n".join(re.sub(r"\btk\b", "vtk", re.sub(r"\bc\b", "wc", step)) for step in KEPT_SQL[1:]) + f",\nvw AS (SELECT doc_id, {FULL_VECTOR_SQL} FROM m GROUP BY doc_id)\n"
            "SELECT f0.doc_id, (l.doc_id IS NOT NULL)::BIGINT AS labelled, l.toxic::BIGINT AS toxic, (1 - l.quality)::BIGINT AS low_quality, (1 - greatest(l.toxic, 1 - l.quality))::BIGINT AS none, "
            + ", ".join(f"round(({c} - lo_{c})::DOUBLE / greatest(hi_{c} - lo_{c}, 1), 6) AS {c}_scaled" if c in X.SCALED_FEATURES else c for c in MODEL_COLS)
            + ", " + ", ".join(f"d{i}" for i in range(DIMS)) + " FROM f0 CROSS JOIN mm JOIN vw USING (doc_id) LEFT JOIN labels l ON l.doc_id = f0.doc_id")


@query("model_table", FULL_SQL)
def _(t):
    """One table for the rows to learn from and those to be predicted: labels, scaled features and the kept vector
    dimensions in one order. A dimension that is not kept is an empty column here, so that the check's columns are fixed."""
    feats = X.add_features(t.comments, MODEL_COLS)
    rows = feats.join(V.document_vectors(words_of(t), "doc_id", "a", word_vectors(t), DIMS), "doc_id")
    table, kept = Z.model_table(rows, t.labels.withColumn("none", 1 - F.greatest("toxic", "low_quality")), "doc_id", TEXT_LABELS, MODEL_COLS, X.SCALED_FEATURES, "vec", DIMS, 0.05)
    dims = [F.col(f"d{i}") if f"d{i}" in kept else F.lit(None).cast("double").alias(f"d{i}") for i in range(DIMS)]
    return table.select("doc_id", "labelled", *TEXT_LABELS, "none", *MODEL_NAMES, *dims)


@query("density_by_dimension", density_sql([*LONG_SQL, "lv AS (SELECT feature || ':' || low AS feature, value FROM lg)"], "lv", 30))
def _(t):
    long = vector_long(t)
    out = C.density(long.select(F.concat_ws(":", "feature", "low").alias("feature"), "value"), "feature", "value", 30)
    return out.select("feature", "point", F.round("x", 4).alias("x"), "density")


# ---- sampling ------------------------------------------------------------------------------------

@query("kfold_contiguous", "SELECT doc_id, (ntile(5) OVER (ORDER BY doc_id) - 1)::BIGINT AS fold FROM documents")
def _(t):
    return A.kfold_contiguous(t.read("documents"), "doc_id", 5)


@query("kfold_shuffled", "SELECT doc_id, ('0x' || md5(doc_id || ':11')[1:8])::BIGINT % 5 AS fold FROM documents")
def _(t):
    return A.kfold_shuffled(t.read("documents").select("doc_id"), "doc_id", 5, 11)


@query("tail_validation_split", "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) > floor(count(*) OVER () * (1.0 - 0.2)::DOUBLE))::BIGINT AS is_validation FROM documents")
def _(t):
    return A.tail_split(t.read("documents"), "doc_id", 0.2)


OVERSAMPLE_SQL = chain(
    LABELS_SQL, "ct AS (SELECT sum(toxic)::BIGINT AS m, (count(*) - sum(toxic))::BIGINT AS big FROM l)",
    "nd AS (SELECT *, floor(0.5 * big)::BIGINT - m AS need FROM ct)",
    "mn AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM l WHERE toxic = 1)",
    "cp AS (SELECT doc_id, need // m + CASE WHEN rn <= need % m THEN 1 ELSE 0 END AS extra FROM mn, nd)",
    "ov AS (SELECT l.doc_id, toxic, low_quality, coalesce(extra, 0) AS extra FROM l LEFT JOIN cp USING (doc_id))",
    "ox AS (SELECT doc_id, toxic, low_quality, unnest(range(0, extra + 1)) AS copy FROM ov)")


@query("random_oversample", OVERSAMPLE_SQL + "SELECT doc_id, toxic::BIGINT AS toxic, low_quality::BIGINT AS low_quality, copy FROM ox")
def _(t):
    return A.random_oversample(t.labels, "doc_id", "toxic", 0.5)


@query("class_balance_report", OVERSAMPLE_SQL + "SELECT toxic::BIGINT AS y, count(*) AS n FROM ox GROUP BY toxic")
def _(t):
    return A.class_counts(A.random_oversample(t.labels, "doc_id", "toxic", 0.5), "toxic")


IN_TURN_SQL = chain(
    LABELS_SQL, "ct AS (SELECT sum(toxic)::BIGINT AS m, (count(*) - sum(toxic))::BIGINT AS big FROM l)",
    "ml AS (SELECT CASE WHEN m <= big THEN 1 ELSE 0 END AS minor, least(m, big) AS m, floor(0.5 * greatest(m, big))::BIGINT - least(m, big) AS need FROM ct)",
    "nm AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM l, ml WHERE toxic = minor)",
    "o1 AS (SELECT l.doc_id, toxic, low_quality, unnest(range(0, 1 + CASE WHEN need > 0 AND rn IS NOT NULL THEN need // m + CASE WHEN rn <= need % m THEN 1 ELSE 0 END ELSE 0 END)) AS copy "
    "FROM l CROSS JOIN ml LEFT JOIN nm USING (doc_id))",
    "c2 AS (SELECT sum(low_quality)::BIGINT AS m, (count(*) - sum(low_quality))::BIGINT AS big, max(copy) + 1 AS stride FROM o1)",
    "m2 AS (SELECT CASE WHEN m <= big THEN 1 ELSE 0 END AS minor, least(m, big) AS m, floor(0.5 * greatest(m, big))::BIGINT - least(m, big) AS need, stride FROM c2)",
    "n2 AS (SELECT doc_id, copy, row_number() OVER (ORDER BY doc_id, copy) AS rn FROM o1, m2 WHERE low_quality = minor)",
    "o2 AS (SELECT o1.*, stride, unnest(range(0, 1 + CASE WHEN need > 0 AND rn IS NOT NULL THEN need // m + CASE WHEN rn <= need % m THEN 1 ELSE 0 END ELSE 0 END)) AS i "
    "FROM o1 CROSS JOIN m2 LEFT JOIN n2 USING (doc_id, copy))")


@query("random_oversample_in_turn", IN_TURN_SQL + "SELECT doc_id, toxic::BIGINT AS toxic, low_quality::BIGINT AS low_quality, (copy + i * stride)::BIGINT AS copy FROM o2")
def _(t):
    out = t.labels
    for label in TEXT_LABELS:
        out = A.random_oversample(out, "doc_id", label, 0.5)
    return out


@query("class_weights", chain(LABELS_SQL, "u AS (SELECT 'toxic' AS label, toxic AS y FROM l UNION ALL SELECT 'low_quality', low_quality FROM l)",
       "c AS (SELECT label, sum(y)::DOUBLE AS p, (count(*) - sum(y))::DOUBLE AS n FROM u GROUP BY label)") +
       "SELECT label, round((p + n) / (2 * n), 6) AS weight_0, round((p + n) / (2 * p), 6) AS weight_1, round(n / p, 6) AS scale_pos_weight, "
       "round(sqrt(n / p), 6) AS sqrt_scale_pos_weight FROM c")
def _(t):
    return A.class_weights(label_rows(t.labels, [], TEXT_LABELS))


@query("leak_free_oversample_folds", chain(LABELS_SQL, "b AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM l)",
       "f AS (SELECT toxic, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1) ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) END AS fold FROM b)",
       "c AS (SELECT k AS held_out, CASE WHEN fold = k THEN 'test' ELSE 'train' END AS part, toxic, count(*) AS n FROM f, range(5) r(k) GROUP BY ALL)") +
       "SELECT a.held_out, a.part, a.toxic::BIGINT AS toxic, CASE WHEN a.part = 'train' AND a.toxic = 1 THEN greatest(a.n, floor(0.5 * b.n)::BIGINT) ELSE a.n END AS n "
       "FROM c a LEFT JOIN c b ON a.held_out = b.held_out AND a.part = b.part AND b.toxic = 1 - a.toxic")
def _(t):
    folds = A.kfold_contiguous(t.labels, "doc_id", 5)
    parts = []
    for k in range(5):
        train, test = A.leak_free_fold(t.labels, "doc_id", "toxic", folds, k)
        parts += [p.select("doc_id", "toxic", F.lit(k).alias("held_out"), F.lit(name).alias("part"))
                  for p, name in ((train, "train"), (test, "test"))]
    return R.union_tables(parts).groupBy("held_out", "part", "toxic").agg(F.count(F.lit(1)).alias("n"))


# ---- evaluation on text-derived scores --------------------------------------------------------------

# Three scorers, each a share of characters; the second label gets the complement.
SCORERS = {"upper": "20 * (length(x) - length(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))",
           "space": "3 * (length(x) - length(translate(x, ' ', '')))",
           "vowel": "1.5 * (length(x) - length(translate(x, 'aeiou', '')))"}
SCORES_SQL = [
    "d AS (SELECT doc_id, source, coalesce(text, '') AS x, toxic, 1 - quality AS low_quality FROM (SELECT doc_id, source, text, toxic, quality "
    f"FROM documents JOIN labels USING (doc_id) UNION ALL SELECT * FROM {sql_values(LABELLED_EDGES)}))",
    "sh AS (SELECT doc_id, source, toxic, low_quality, " + ", ".join(
        f"round(least(1.0::DOUBLE, coalesce(({e})::DOUBLE / nullif(length(x), 0), 0)), 3) AS {n}" for n, e in SCORERS.items()) + " FROM d)",
    "s0 AS (" + " UNION ALL ".join(
        f"SELECT doc_id, source, {q(n)} AS model, 'toxic' AS label, toxic AS y, {n} AS prob FROM sh UNION ALL "
        f"SELECT doc_id, source, {q(n)}, 'low_quality', low_quality, round(1 - {n}, 3) FROM sh" for n in SCORERS) + ")",
    "s AS MATERIALIZED (SELECT *, (prob >= 0.5)::INT AS pred FROM s0)",
]


def scored_texts(t):
    """(doc_id, source, x, labels) of all labelled comments, and of some without characters or words."""
    texts = t.read("documents").select("doc_id", "source", "text").join(t.labels, "doc_id")
    extra = t.spark.createDataFrame(LABELLED_EDGES, "doc_id long, source string, text string, toxic int, quality int")
    extra = extra.select("doc_id", "source", "text", "toxic", (1 - F.col("quality")).alias("low_quality"))
    return texts.unionByName(extra).withColumn("x", F.coalesce("text", F.lit(""))).drop("text")


def share_of(top):
    return F.round(F.least(F.lit(1.0), P.guarded_ratio(F.expr(top).cast("double"), F.length("x"))), 3)


def scores(t):
    """(doc_id, source, model, label, y, pred, prob) of all labelled comments and scorers."""
    wide = scored_texts(t).select("doc_id", "source", *TEXT_LABELS, *[share_of(e).alias(n) for n, e in SCORERS.items()])
    items = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(l).alias("label"), F.col(l).alias("y"),
                               (F.col(n) if l == "toxic" else F.round(1.0 - F.col(n), 3)).alias("prob"))
                      for n in SCORERS for l in TEXT_LABELS])
    rows = exploded(wide, ["doc_id", "source"], items, "i").select("doc_id", "source", "i.*")
    return rows.withColumn("pred", (F.col("prob") >= 0.5).cast("int"))


def metrics_sql(by):
    """CTEs: cf, pr, sa, ll, lb, au, ev per group."""
    g = ", ".join(by)
    on = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in by)
    return [
        *SCORES_SQL,
        f"cf AS (SELECT {g}, label, count(*) FILTER (y = 0 AND pred = 0) AS tn, count(*) FILTER (y = 0 AND pred = 1) AS fp, "
        f"count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 1 AND pred = 1) AS tp FROM s GROUP BY {g}, label)",
        "pr AS (SELECT *, tp + fn AS support, (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS accuracy, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS precision, "
        "CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM cf)",
        f"pw AS (SELECT {g}, coalesce(sum(precision * support) / nullif(sum(support), 0), 0) AS precision_weighted, coalesce(sum(recall * support) / nullif(sum(support), 0), 0) AS recall_weighted, "
        f"coalesce(sum(f1 * support) / nullif(sum(support), 0), 0) AS f1_weighted FROM pr GROUP BY {g})",
        f"sa AS (SELECT {g}, avg(ok) AS accuracy FROM (SELECT {g}, doc_id, min((y = pred)::INT) AS ok FROM s GROUP BY {g}, doc_id) GROUP BY {g})",
        "cl AS (SELECT *, least(greatest(prob, 1e-15::DOUBLE), 1 - 1e-15::DOUBLE) AS p FROM s)",
        f"rw AS (SELECT *, p / sum(p) OVER (PARTITION BY {g}, doc_id) AS np FROM cl)",
        f"ll AS (SELECT {g}, avg(r) AS log_loss FROM (SELECT {g}, doc_id, -sum(y * ln(np)) AS r FROM rw GROUP BY {g}, doc_id) GROUP BY {g})",
        f"lb AS (SELECT {g}, label, avg(CASE WHEN y = 1 THEN -ln(p) ELSE -ln(1 - p) END) AS log_loss FROM cl GROUP BY {g}, label)",
        f"au AS (SELECT c.*, a.auc, c.tp + c.fn AS pos, c.tn + c.fp AS neg FROM cf c LEFT JOIN (SELECT {', '.join('a.' + c for c in by)}, a.label, avg(CASE WHEN a.prob > b.prob THEN 1.0::DOUBLE WHEN a.prob = b.prob THEN 0.5::DOUBLE ELSE 0 END) AS auc "
        f"FROM s a JOIN s b ON {on('a', 'b')} AND a.label = b.label WHERE a.y = 1 AND b.y = 0 GROUP BY ALL) a ON {on('a', 'c')} AND a.label = c.label)",
        f"aw AS (SELECT {g}, sum(pos * auc) / nullif(sum(pos) FILTER (auc IS NOT NULL), 0) AS roc_auc_weighted, avg(auc) AS roc_auc_macro, count(*) FILTER (auc IS NULL) AS labels_without_auc FROM au GROUP BY {g})",
        f"ev AS (SELECT * FROM sa JOIN pw USING ({g}) JOIN ll USING ({g}) JOIN aw USING ({g}))",
    ]


SIX = "round(accuracy, 6) AS accuracy, round(precision_weighted, 6) AS precision_weighted, round(recall_weighted, 6) AS recall_weighted, round(f1_weighted, 6) AS f1_weighted, round(log_loss, 6) AS log_loss, round(roc_auc_weighted, 6) AS roc_auc_weighted"
BY_MODEL = metrics_sql(["model"])
BY_SOURCE = metrics_sql(["source", "model"])
SCORE_TABLE_SQL = "st AS (SELECT model || '/' || source AS model, " + SIX + " FROM ev)"


@query("subset_accuracy", chain(*BY_MODEL) + "SELECT model, round(accuracy, 6) AS accuracy FROM sa")
def _(t):
    return M.subset_accuracy(scores(t), "doc_id", ["model"])


@query("confusion_matrix", chain(*BY_MODEL) + "SELECT model, label, tn, fp, fn, tp FROM cf")
def _(t):
    return M.confusion(scores(t), ["model"])


@query("precision_recall_f1_binary", chain(*BY_MODEL) + "SELECT model, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pr")
def _(t):
    return M.precision_recall_f1(M.confusion(scores(t), ["model"])).select("model", "label", "precision", "recall", "f1")


@query("precision_recall_f1_weighted", chain(*BY_MODEL) + "SELECT model, round(precision_weighted, 6) AS precision_weighted, round(recall_weighted, 6) AS recall_weighted, round(f1_weighted, 6) AS f1_weighted FROM pw")
def _(t):
    return M.weighted_scores(M.precision_recall_f1(M.confusion(scores(t), ["model"])), ["model"])


@query("log_loss_multilabel", chain(*BY_MODEL) + "SELECT model, round(log_loss, 6) AS log_loss FROM ll")
def _(t):
    return M.log_loss_multilabel(scores(t), "doc_id", ["model"])


@query("log_loss_binary", chain(*BY_MODEL) + "SELECT model, label, round(log_loss, 6) AS log_loss FROM lb")
def _(t):
    return M.log_loss_binary(scores(t), ["model"])


@query("roc_auc", chain(*BY_MODEL) + "SELECT model, label, pos, neg, round(auc, 6) AS auc FROM au")
def _(t):
    return M.roc_auc(scores(t), ["model"])


BINNED_AUC_SQL = ["ab AS (SELECT model, label, least(floor(prob * 200), 199)::BIGINT AS b, count(*) FILTER (y = 1)::DOUBLE AS p, count(*) FILTER (y = 0)::DOUBLE AS q FROM s GROUP BY ALL)",
                  "ac AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY model, label ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ab)",
                  "ad AS (SELECT model, label, sum(p * (below + q / 2)) / nullif(sum(p) * sum(q), 0) AS area, sum(p * q) / 2 / nullif(sum(p) * sum(q), 0) AS bound FROM ac GROUP BY model, label)"]


@query("roc_auc_binned", chain(*BY_MODEL, *BINNED_AUC_SQL) + "SELECT model, label, pos, neg, round(area, 6) AS auc, round(bound, 6) AS error_bound, abs(area - auc) <= bound + 1e-12 AS within_bound "
       "FROM ad JOIN au USING (model, label)")
def _(t):
    rows = pinned(scores(t))
    exact = M.roc_auc(rows, ["model"]).select("model", "label", F.col("auc").alias("exact"))
    binned = M.binned_roc_auc(rows, ["model"], 200).join(exact, ["model", "label"])
    return binned.select("model", "label", "pos", "neg", "auc", "error_bound", (F.abs(F.col("auc") - F.col("exact")) <= F.col("error_bound") + 1e-12).alias("within_bound"))


@query("roc_auc_weighted", chain(*BY_MODEL) + "SELECT model, round(roc_auc_weighted, 6) AS roc_auc_weighted, round(roc_auc_macro, 6) AS roc_auc_macro, labels_without_auc FROM aw")
def _(t):
    return M.roc_auc_weighted(M.roc_auc(scores(t), ["model"]), ["model"])


@query("per_label_reports", chain(*BY_MODEL) + "SELECT model, label, tn, fp, fn, tp, support, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, "
       "round(f1, 6) AS f1, round(log_loss, 6) AS log_loss, round(auc, 6) AS auc FROM pr JOIN lb USING (model, label) JOIN (SELECT model, label, auc FROM au) USING (model, label)")
def _(t):
    return M.label_report(scores(t), ["model"])


# "marks" stands for the outside scorer: it gives zeros for a text without ! and ?
MARKS = {"toxic": "200 * (length(x) - length(replace(x, '!', '')))",
         "low_quality": "200 * (length(x) - length(replace(x, '?', '')))"}
COMPARED_SQL = metrics_sql(["model", "rows"])
COMPARED_SQL = [SCORES_SQL[0], SCORES_SQL[1],
    "s1 AS (" + " UNION ALL ".join(
        f"SELECT doc_id, 'marks' AS model, {q(l)} AS label, {l} AS y, round(least(1.0::DOUBLE, coalesce(({e})::DOUBLE / nullif(length(x), 0), 0)), 3) AS prob FROM d" for l, e in MARKS.items())
    + " UNION ALL SELECT doc_id, 'vowel', 'toxic', toxic, vowel FROM sh UNION ALL SELECT doc_id, 'vowel', 'low_quality', low_quality, round(1 - vowel, 3) FROM sh)",
    "bad AS (SELECT DISTINCT doc_id FROM s1 GROUP BY doc_id, model HAVING max(prob) = 0)",
    "s AS MATERIALIZED (SELECT *, (prob >= 0.5)::INT AS pred FROM (SELECT *, 'all' AS rows FROM s1 UNION ALL SELECT *, 'scored' FROM s1 WHERE doc_id NOT IN (SELECT doc_id FROM bad)))",
    *COMPARED_SQL[len(SCORES_SQL):]]


@query("baseline_comparison", chain(*COMPARED_SQL) + f"SELECT model, rows, {SIX}, round(roc_auc_macro, 6) AS roc_auc_macro, labels_without_auc FROM ev")
def _(t):
    items = F.array(*[F.struct(F.lit("marks").alias("model"), F.lit(l).alias("label"), F.col(l).alias("y"),
                               share_of(e).alias("prob")) for l, e in MARKS.items()])
    marks = exploded(scored_texts(t), ["doc_id"], items, "i").select("doc_id", "i.*").withColumn("pred", (F.col("prob") >= 0.5).cast("int"))
    vowel = scores(t).where("model = 'vowel'").select(*marks.columns)
    return R.compare_scorers(marks.unionByName(vowel), "doc_id")


def score_table(t):
    """(model, six scores) with one model per scorer and source."""
    ev = M.evaluate(scores(t), "doc_id", ["source", "model"])
    return pinned(ev.select(F.concat_ws("/", "model", "source").alias("model"),
                            *[F.round(m, 6).alias(m) for m in R.METRICS]))


@query("model_scores", chain(*BY_SOURCE, SCORE_TABLE_SQL) + "SELECT * FROM st")
def _(t):
    return score_table(t)


@query("mean_fold_scores", chain(*BY_SOURCE, SCORE_TABLE_SQL) + "SELECT split_part(model, '/', 1) AS model, " + ", ".join(f"round(avg({m}), 5) AS {m}" for m in R.METRICS) + " FROM st GROUP BY 1")
def _(t):
    folds = score_table(t).withColumn("model", F.split_part("model", F.lit("/"), F.lit(1)))
    return R.mean_fold_scores(folds).select("model", *[F.round(m, 5).alias(m) for m in R.METRICS])


@query("best_and_second_best", chain(*BY_SOURCE, SCORE_TABLE_SQL, "u AS (" + " UNION ALL ".join(
    f"SELECT {q(m)} AS metric, model, {m} AS value, {'-' if m == 'log_loss' else ''}{m} AS better FROM st" for m in R.METRICS) + ")",
    "rk AS (SELECT metric, model, value, dense_rank() OVER (PARTITION BY metric ORDER BY better DESC) AS place FROM u WHERE value IS NOT NULL)") +
    "SELECT metric, place, model, value FROM rk WHERE place <= 2")
def _(t):
    return R.best_and_second(score_table(t))


@query("intersect_ranked_sets", chain(*BY_SOURCE, SCORE_TABLE_SQL, "a AS (SELECT model FROM st ORDER BY f1_weighted DESC, model LIMIT 13)",
       "b AS (SELECT model FROM st ORDER BY log_loss, model LIMIT 13)") + "SELECT * FROM st WHERE model IN (SELECT model FROM a INTERSECT SELECT model FROM b)")
def _(t):
    return R.common_top(score_table(t), 13)


@query("union_tables", chain(*BY_SOURCE, SCORE_TABLE_SQL) + "SELECT model, accuracy FROM st WHERE model LIKE 'upper/%' UNION ALL SELECT model, accuracy FROM st WHERE model LIKE '%src1' "
       "UNION ALL SELECT 'by hand', 0.5::DOUBLE")
def _(t):
    st = score_table(t).select("model", "accuracy")
    hand = t.spark.createDataFrame([("by hand", 0.5)], "model string, accuracy double")
    return R.union_tables([st.where("model like 'upper/%'"), st.where("model like '%src1'"), hand])


@query("side_by_side", chain(*BY_SOURCE, SCORE_TABLE_SQL) + "SELECT a.model AS model_a, b.model AS model_b, a.accuracy AS accuracy_a, b.accuracy AS accuracy_b, a.f1_weighted AS f1_weighted_a, "
       "b.f1_weighted AS f1_weighted_b FROM st a JOIN st b ON split_part(a.model, '/', 2) = split_part(b.model, '/', 2) WHERE a.model LIKE 'upper/%' AND b.model LIKE 'vowel/%'")
def _(t):
    st = score_table(t).select("model", "accuracy", "f1_weighted")
    a = st.where("model like 'upper/%'")
    mapping = a.select("model", F.concat(F.lit("vowel/"), F.split_part("model", F.lit("/"), F.lit(2))))
    return R.side_by_side(a, st, mapping)


ENSEMBLE = {"upper": 3 / 8, "space": 3 / 8, "vowel": 1 / 4}


@query("weighted_ensemble", chain(*SCORES_SQL, "p AS (SELECT doc_id, label, max(y) AS y, " + " + ".join(
    f"max(CASE WHEN model = {q(m)} THEN prob END) * {w}::DOUBLE" for m, w in ENSEMBLE.items()) + " AS prob FROM s GROUP BY doc_id, label)") +
    "SELECT doc_id, label, y::BIGINT AS y, round(prob, 6) AS prob, (prob >= 0.5)::BIGINT AS pred FROM p")
def _(t):
    return R.weighted_ensemble(scores(t), "doc_id", ENSEMBLE)


# ---- scoring with an error table --------------------------------------------------------------------

def rate_scorer(c):
    """Marks per character; a text without an ASCII letter cannot be scored."""
    rate = P.guarded_ratio(F.length(c) - F.length(F.translate(c, "!?", "")), F.length(c))
    bad = ~c.rlike("[A-Za-z]")
    error = F.when(bad, F.lit("no text to score"))
    return F.struct(F.array(F.when(bad, 0.0).otherwise(rate), F.when(bad, 0.0).otherwise(1.0 - rate)).alias("scores"),
                    error.alias("error"))


RATE_SQL = "coalesce((length(x) - length(translate(x, '!?', '')))::DOUBLE / nullif(length(x), 0), 0)"
RATED_SQL = "SELECT conv_id, turn, text AS x, regexp_matches(text, '[A-Za-z]') AS ok FROM conversations"


@query("score_with_error_table", f"SELECT doc_id, CASE WHEN ok THEN round({RATE_SQL}, 6) ELSE 0 END AS s0, CASE WHEN ok THEN round(1.0 - {RATE_SQL}, 6) ELSE 0 END AS s1, "
       "CASE WHEN NOT ok THEN 'no text to score' END AS error FROM (SELECT doc_id, x, regexp_matches(x, '[A-Za-z]') AS ok FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents))")
def _(t):
    out = G.score_comments(t.comments, "doc_id", "comment_text", rate_scorer, 2)
    return out.select("doc_id", F.col("scores")[0].alias("s0"), F.col("scores")[1].alias("s1"), "error")


@query("score_stream", f"SELECT doc_id, CASE WHEN ok THEN round({RATE_SQL}, 6) ELSE 0 END AS s0, CASE WHEN NOT ok THEN 'no text to score' END AS error "
       "FROM (SELECT doc_id, x, regexp_matches(x, '[A-Za-z]') AS ok FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents))")
def _(t):
    out, err, ckpt = (scratch(t, n) for n in ("stream-out", "stream-err", "stream-ckpt"))
    run = G.score_stream(t.spark, f"{t.dir}/documents.parquet*", "doc_id long, text string", "doc_id", "text", rate_scorer, 2, out, err, ckpt)
    run.awaitTermination()
    scored = t.spark.read.parquet(out).select("doc_id", F.col("scores")[0].alias("s0"))
    return scored.join(t.spark.read.parquet(err).select("doc_id", "error"), "doc_id", "left")


# ---- training -----------------------------------------------------------------------------------------

NB_SQL = [*LONG_SQL, "nb AS (" + " UNION ALL ".join(
    f"SELECT feature, {q(l)} AS label, {l} AS y, count(*) AS n, avg(value) AS mean, var_pop(value) AS variance FROM lg GROUP BY feature, {l}" for l in VECTOR_LABELS) + ")"]


@query("gaussian_nb_moments", chain(*NB_SQL) + "SELECT feature, label, y::BIGINT AS y, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY feature, label), 6) AS prior, round(mean, 6) + 0.0 AS mean, round(variance, 6) AS variance FROM nb")
def _(t):
    return B.class_moments(vector_long(t), VECTOR_LABELS)


def bayes_sql(fit, score):
    """CTEs up to pb (vec_id, labels, label, y, p1): Gaussian classes fitted where ``fit`` holds, scored where ``score`` holds.
    Every variance is raised by 1e-9 of the largest variance of a feature."""
    per = lambda l: (f"SELECT {q(l)} AS label, feature, {l} AS y, count(*) AS n, avg(value) AS mu, var_pop(value) AS v FROM fl WHERE {fit} GROUP BY feature, {l}")
    return [*LONG_SQL, "fl AS MATERIALIZED (SELECT *, ('0x' || md5(vec_id || ':3')[1:8])::BIGINT % 5 AS fold FROM lg)",
            f"ep AS (SELECT 1e-9 * max(v) AS e FROM (SELECT var_pop(value) AS v FROM fl WHERE {fit} GROUP BY feature))",
            "cm AS (" + " UNION ALL ".join(per(l) for l in VECTOR_LABELS) + ")",
            "lk AS (SELECT vec_id, label, y, any_value(ln(n)) + sum(-0.5 * ln(2 * pi() * (v + e)) - (value - mu) ** 2 / (2 * (v + e))) AS s "
            f"FROM fl JOIN cm USING (feature), ep WHERE {score} GROUP BY vec_id, label, y)",
            "pb AS (SELECT a.vec_id, a.label, 1 / (1 + exp(b.s - a.s)) AS p1 FROM lk a JOIN lk b ON a.vec_id = b.vec_id AND a.label = b.label AND a.y = 1 AND b.y = 0)"]


BAYES_SQL = chain(*bayes_sql("fold <> 0", "fold = 0"))
BAYES_COLUMNS = ", ".join(f"round(max(p1) FILTER (label = {q(l)}), 6) AS {{}}{l}" for l in VECTOR_LABELS)


FOLDED = "('0x' || md5(vec_id || ':3')[1:8])::BIGINT % 5"
CONTIGUOUS = "(SELECT vec_id, ntile(5) OVER (ORDER BY vec_id) - 1 AS fold FROM embeddings)"


def folded_sql(folds, contiguous=False):
    """fk: every row once per fold k, held out where it is in that fold."""
    rows = f"fl AS MATERIALIZED (SELECT lg.*, fold FROM lg JOIN {CONTIGUOUS} USING (vec_id))" if contiguous else f"fl AS MATERIALIZED (SELECT *, {FOLDED} AS fold FROM lg)"
    return [*LONG_SQL, rows, f"fk AS MATERIALIZED (SELECT k, fold = k AS held, vec_id, feature, value, low, even, third FROM fl, range({folds}) r(k))"]


def class_shares_sql(name, source):
    """{name}_p (k, vec_id, cls, p): Gaussian classes ``cls`` fitted on the rows of ``source`` not held out, shares of those that are."""
    return [f"{name}_x AS MATERIALIZED ({source})",
            f"{name}_e AS (SELECT k, 1e-9 * max(v) AS e FROM (SELECT k, feature, var_pop(value) AS v FROM {name}_x WHERE NOT held GROUP BY k, feature) GROUP BY k)",
            f"{name}_m AS (SELECT k, cls, feature, count(*) AS n, avg(value) AS mu, var_pop(value) AS v FROM {name}_x WHERE NOT held GROUP BY ALL)",
            f"{name}_s AS (SELECT x.k, vec_id, m.cls, any_value(ln(n)) + sum(-0.5 * ln(2 * pi() * (v + e)) - (value - mu) ** 2 / (2 * (v + e))) AS s "
            f"FROM {name}_x x JOIN {name}_m m ON x.k = m.k AND x.feature = m.feature JOIN {name}_e e ON e.k = x.k WHERE held GROUP BY x.k, vec_id, m.cls)",
            f"{name}_p AS MATERIALIZED (SELECT k, vec_id, cls, w / sum(w) OVER (PARTITION BY k, vec_id) AS p FROM "
            f"(SELECT *, exp(s - max(s) OVER (PARTITION BY k, vec_id)) AS w FROM {name}_s))"]


def relevance_sql():
    steps = [x for l in VECTOR_LABELS for x in class_shares_sql(f"br_{l}", f"SELECT k, held, vec_id, feature, value, {l} AS cls FROM fk")]
    return [*steps, "br AS (" + " UNION ALL ".join(f"SELECT k, vec_id, {q(l)} AS label, p FROM br_{l}_p WHERE cls = 1" for l in VECTOR_LABELS) + ")"]


def chain_sql():
    """Each label also sees the ones before it: the true ones where it is fitted, the predicted ones where it is asked."""
    steps = []
    for j, l in enumerate(VECTOR_LABELS):
        before = "".join(f" UNION ALL SELECT f.k, held, f.vec_id, 'y{i}', CASE WHEN held THEN (p >= 0.5)::INT ELSE {b} END, {l} FROM fk f "
                         f"LEFT JOIN cc_{b}_p c ON c.k = f.k AND c.vec_id = f.vec_id AND c.cls = 1 WHERE feature = 'd0'" for i, b in enumerate(VECTOR_LABELS[:j]))
        steps += class_shares_sql(f"cc_{l}", f"SELECT k, held, vec_id, feature, value, {l} AS cls FROM fk" + before)
    return [*steps, "cc AS (" + " UNION ALL ".join(f"SELECT k, vec_id, {q(l)} AS label, p FROM cc_{l}_p WHERE cls = 1" for l in VECTOR_LABELS) + ")"]


def powerset_sql():
    combo = " || ".join(f"{l}::VARCHAR" for l in VECTOR_LABELS)
    return [*class_shares_sql("ps", f"SELECT k, held, vec_id, feature, value, {combo} AS cls FROM fk"),
            "lp AS (" + " UNION ALL ".join(f"SELECT k, vec_id, {q(l)} AS label, coalesce(sum(p) FILTER (cls[{i + 1}] = '1'), 0) AS p FROM ps_p GROUP BY k, vec_id"
                                           for i, l in enumerate(VECTOR_LABELS)) + ")"]


def held_out_sql(steps, name):
    return chain(*folded_sql(1), *steps) + ("SELECT vec_id, " + ", ".join(f"any_value({l})::BIGINT AS {l}" for l in VECTOR_LABELS) + ", " + ", ".join(
        f"round(max(p) FILTER (label = {q(l)}), 6) AS p_{l}" for l in VECTOR_LABELS) + f" FROM {name} JOIN e USING (vec_id) GROUP BY vec_id")


def fold_scores_sql(by, *parts):
    """ev: the six scores per group, from tables (k, vec_id, label, p) with their names."""
    scored = " UNION ALL ".join(f"SELECT vec_id AS doc_id, {q(point)} AS point, k AS fold, label, CASE label " + " ".join(f"WHEN {q(l)} THEN {l}" for l in VECTOR_LABELS)
                                + f" END AS y, p AS prob FROM {name} JOIN e USING (vec_id)" for point, name in parts)
    return [f"s AS MATERIALIZED (SELECT *, (prob >= 0.5)::INT AS pred FROM ({scored}))", *metrics_sql(by)[len(SCORES_SQL):]]


def training(t):
    """Vectors with labels and shuffled folds, written once for the many fits."""
    rows = ML.vector_from_array(t.embedded, "embedding").select("vec_id", *VECTOR_LABELS, "features")
    return pinned(A.kfold_shuffled(rows, "vec_id", 5, 3))


def predictions(predict, rows):
    return predict(rows).select("vec_id", *VECTOR_LABELS, *[f"p_{l}" for l in VECTOR_LABELS])


def held_out(t, fit):
    rows = training(t)
    return predictions(fit(rows.where("fold <> 0")), rows.where("fold = 0"))


@query("binary_relevance", held_out_sql(relevance_sql(), "br"))
def _(t):
    return held_out(t, lambda df: ML.fit_binary_relevance(df, VECTOR_LABELS, B.gaussian_naive_bayes()))


@query("classifier_chain", held_out_sql(chain_sql(), "cc"))
def _(t):
    return held_out(t, lambda df: ML.fit_classifier_chain(df, VECTOR_LABELS, B.gaussian_naive_bayes()))


@query("label_powerset", held_out_sql(powerset_sql(), "lp"))
def _(t):
    return held_out(t, lambda df: ML.fit_label_powerset(df, VECTOR_LABELS, B.gaussian_naive_bayes()))


@query("transforms_logistic")
def _(t):
    """The three transforms over a logistic regression, side by side."""
    rows = training(t)
    train, test = rows.where("fold <> 0"), rows.where("fold = 0")
    n = train.count()
    parts = [predictions(fit(train, VECTOR_LABELS, B.logistic_regression(n)), test).withColumn("transform", F.lit(name)) for name, fit in ML.TRANSFORMS.items()]
    return R.union_tables(parts)


@query("one_vs_rest_loop")
def _(t):
    rows = training(t)
    own = {"low": B.logistic_regression(rows.where("fold <> 0").count()), "even": B.random_forest(20, 5), "third": B.gaussian_naive_bayes()}
    predict = ML.fit_binary_relevance(rows.where("fold <> 0"), VECTOR_LABELS, own)
    parts = [M.score_rows(predict(part), ["vec_id"], VECTOR_LABELS).withColumn("part", F.lit(name))
             for name, part in (("train", rows.where("fold <> 0")), ("test", rows.where("fold = 0")))]
    return M.label_report(R.union_tables(parts), ["part"])


def text_training(t):
    rows = ML.assemble(model_table(t), MODEL_NAMES)
    return pinned(A.kfold_shuffled(rows.select("doc_id", *TEXT_LABELS, "features"), "doc_id", 5, 3))


@query("logistic_regression")
def _(t):
    rows = text_training(t)
    train, test = rows.where("fold <> 0"), rows.where("fold = 0")
    n = train.count()
    for label in TEXT_LABELS:
        # weights and penalty come from the rows trained on
        weighted = A.with_balanced_weight(train, label)
        test = ML.fit_binary_relevance(weighted, [label], B.logistic_regression(n, "weight"))(test)
    return test.select("doc_id", *TEXT_LABELS, *[f"p_{l}" for l in TEXT_LABELS])


@query("logistic_regression_cv")
def _(t):
    grid = [{"regParam": v} for v in (0.001, 0.01, 0.1)]
    return ML.grid_search(training(t), "low", B.logistic_regression(1), grid, "fold", "accuracy")[1]


@query("random_forest")
def _(t):
    return held_out(t, lambda df: ML.fit_binary_relevance(df, VECTOR_LABELS, B.random_forest(20, 6)))


@query("gaussian_naive_bayes", BAYES_SQL + "SELECT vec_id, " + ", ".join(f"any_value({l})::BIGINT AS {l}" for l in VECTOR_LABELS) + ", " +
       BAYES_COLUMNS.replace("{}", "p_") + " FROM pb JOIN e USING (vec_id) GROUP BY vec_id")
def _(t):
    return held_out(t, lambda df: ML.fit_binary_relevance(df, VECTOR_LABELS, B.gaussian_naive_bayes()))


@query("adaboost")
def _(t):
    return held_out(t, lambda df: ML.fit_binary_relevance(df, VECTOR_LABELS, B.AdaBoost(rounds=10)))


@query("gradient_boosting")
def _(t):
    return held_out(t, lambda df: ML.fit_binary_relevance(df, VECTOR_LABELS, B.gradient_boosting(10, 3)))


@query("grid_search")
def _(t):
    grid = [{"maxDepth": d, "numTrees": n} for d in (3, 5) for n in (5, 10)]
    return ML.grid_search(training(t), "even", B.random_forest(), grid, "fold", "f1", folds=5)[1]


@query("kfold_evaluate", chain(*folded_sql(5), *relevance_sql(), *fold_scores_sql(["fold"], ("br", "br"))) + f"SELECT fold::BIGINT AS fold, {SIX} FROM ev")
def _(t):
    fit = lambda df: ML.fit_binary_relevance(df, VECTOR_LABELS, B.gaussian_naive_bayes())
    return ML.kfold_evaluate(training(t), "vec_id", VECTOR_LABELS, fit)


def contiguous_training(t):
    rows = ML.vector_from_array(t.embedded, "embedding").select("vec_id", *VECTOR_LABELS, "features")
    return pinned(rows.join(A.kfold_contiguous(rows, "vec_id", 5), "vec_id"))


@query("kfold_score", chain(*folded_sql(5, True), *relevance_sql(), *fold_scores_sql(["fold"], ("br", "br"))) +
       "SELECT 'f1_weighted' AS score, round(avg(f1_weighted), 6) AS mean, round(stddev_pop(f1_weighted), 6) AS std FROM ev")
def _(t):
    """One named score over contiguous folds."""
    fit = lambda df: ML.fit_binary_relevance(df, VECTOR_LABELS, B.gaussian_naive_bayes())
    return ML.kfold_score(contiguous_training(t), "vec_id", VECTOR_LABELS, fit, "f1_weighted")


GRID_POINTS = [("binary_relevance", "br"), ("classifier_chain", "cc"), ("label_powerset", "lp")]


@query("grid_search_transform", chain(*folded_sql(5, True), *relevance_sql(), *chain_sql(), *powerset_sql(), *fold_scores_sql(["point", "fold"], *GRID_POINTS)) +
       "SELECT 'transform=' || point AS point, round(avg(f1_weighted), 6) AS mean, round(stddev_pop(f1_weighted), 6) AS std FROM ev GROUP BY point")
def _(t):
    """A grid over the problem transform by the f1 of all labels, over contiguous folds."""
    grid = [{"transform": name} for name, _ in GRID_POINTS]
    return ML.grid_search_transform(contiguous_training(t), "vec_id", VECTOR_LABELS, ML.fit_binary_relevance, B.gaussian_naive_bayes(), grid)[1]


@query("model_save_load", chain(*bayes_sql("true", "true")) + "SELECT vec_id, any_value(low)::BIGINT AS low, round(max(p1) FILTER (label = 'low'), 6) AS p_low "
       "FROM pb JOIN e USING (vec_id) GROUP BY vec_id")
def _(t):
    rows = training(t)
    model = ML.fit_one(B.gaussian_naive_bayes(), rows, "low")
    path = scratch(t, "model")
    ML.save_model([model], path)
    return ML.add_probability(ML.load_model(path), rows, "low").select("vec_id", "low", "p_low")


@query("sink_predictions", BAYES_SQL + "SELECT vec_id, " + BAYES_COLUMNS.replace("{}", "") + " FROM pb GROUP BY vec_id")
def _(t):
    out = held_out(t, lambda df: ML.fit_binary_relevance(df, VECTOR_LABELS, B.gaussian_naive_bayes()))
    path = scratch(t, "predictions")
    IO.write_predictions(out, "vec_id", VECTOR_LABELS, path)
    return t.spark.read.parquet(path)
