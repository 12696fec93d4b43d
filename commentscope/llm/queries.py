"""The registered queries of the training-data operators, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentscope.llm import certified_packing, mixing, neighbours, packing, parse_dedup, periodic_runs, pii, quality, secrets, simhash, \
    substring_trees, token_files, whitening

TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = r"[x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"


@query("op2_secrets")
def _(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = {k: F.col(k) for k in secrets.BASE}

    def weak_of(kind: str) -> Column:
        return F.transform(F.filter("weak", lambda w: w["kind"] == kind), lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end")))

    weak = {kind: weak_of(kind) for kind in secrets.WEAK}
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias("n_" + k) for k in secrets.BASE],
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(base | weak).alias("spans"))


@query("op4_token_files")
def _(spark, sf_dir):
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=2)


@query("op6_simhash_segments")
def _(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op8_cost_packing")
def _(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=0, capacity=1024)


def mended_sql(k: int) -> str:
    """CTEs that move one document per source by one copy where that narrows the source's gap."""
    return f"""
g{k} AS (SELECT source, any_value(target) - sum(size * copies) AS gap FROM c{k} GROUP BY source),
b{k} AS (SELECT * FROM (SELECT c.source, c.size, c.draw, sign(gap) AS way,
    row_number() OVER (PARTITION BY c.source ORDER BY abs(abs(gap) - c.size), c.size, c.draw) AS r
    FROM c{k} c JOIN g{k} g ON c.source IS NOT DISTINCT FROM g.source
    WHERE CASE WHEN gap > 0 THEN copies < 3 ELSE copies > 0 END AND abs(abs(gap) - c.size) < abs(gap)) WHERE r = 1),
c{k + 1} AS (SELECT c.* REPLACE (greatest(0, least(3, c.copies + coalesce(b.way, 0)))::BIGINT AS copies) FROM c{k} c LEFT JOIN b{k} b
    ON c.source IS NOT DISTINCT FROM b.source AND c.size = b.size AND c.draw = b.draw)"""


MIX_SQL = f"""
WITH sz AS (SELECT doc_id, source, len({WORDS_SQL})::BIGINT AS size, md5(doc_id::VARCHAR) AS draw FROM documents),
ps AS (SELECT source, sum(size)::BIGINT AS source_size FROM sz GROUP BY source),
pw AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, (3 * source_size)::DOUBLE AS whole FROM ps),
lv AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(whole) OVER (ORDER BY whole / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY whole / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM pw),
lc AS (SELECT max(level) FILTER (level * weight <= whole) AS c FROM lv),
tg AS (SELECT source, source_size, CASE WHEN level * weight <= whole THEN least(c * weight, whole) ELSE whole END AS target FROM lv, lc),
un AS (SELECT sz.*, source_size, target, CASE WHEN target > 0 THEN round(least(3, target / source_size) * {mixing.UNIT})::BIGINT ELSE 0 END AS units
    FROM sz JOIN tg ON sz.source IS NOT DISTINCT FROM tg.source),
cu AS (SELECT *, units % {mixing.UNIT} AS part, sum(units % {mixing.UNIT}) OVER (PARTITION BY source ORDER BY size, draw, doc_id ROWS UNBOUNDED PRECEDING) + {mixing.UNIT // 2} AS upto FROM un),
c0 AS (SELECT doc_id, source, size, draw, source_size, target,
    least(units // {mixing.UNIT} + upto // {mixing.UNIT} - (upto - part) // {mixing.UNIT}, 3)::BIGINT AS copies FROM cu),{",".join(map(mended_sql, range(mixing.MENDS)))}
SELECT doc_id, size, source_size, target, size * copies AS taken FROM c{mixing.MENDS}"""


@query("op9_entropy_mixing", MIX_SQL)
def _(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_boosted_quality")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, trees, ["doc_id"]).select("doc_id", *quality.STATS, "base_failed", "kept", "score")


@query("op1_bilstm_crf_pii")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.train(docs), ["doc_id"])
    return found.select("doc_id", *["n_" + k for k in pii.KINDS], "base_sha256", "spans")


REPEATS_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM d, unnest(range(1, len(w) - 18)) r(i)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, range(20) t(j)),
left_ AS (SELECT p.doc_id, string_agg(p.x, ' ' ORDER BY p.i) AS kept, count(*) AS n FROM (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM d) p
    ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_ USING (doc_id)"""


@query("op3_suffix_trees", REPEATS_SQL)
def _(spark, sf_dir):
    return substring_trees.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op5_prefix_free_parsing")
def _(spark, sf_dir):
    return parse_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op7_multiprobe_lsh")
def _(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


WORD_TOKENIZER = "word_bpe_49k.json"


@query("op13_certified_packing")
def _(spark, sf_dir):
    return certified_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), end_id=1, capacity=4096)


@query("op11_block_convolution_runs")
def _(spark, sf_dir):
    return periodic_runs.digest(periodic_runs.collapse_runs(table(spark, sf_dir, "documents"), plant=True))


@query("op12_spectrum_whitening")
def _(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), leading=32)
