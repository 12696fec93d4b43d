"""SQL forms of the cleaning, token and feature rules, written for the checks."""

from __future__ import annotations

from commentscope.catalog.base import nest, q, sql_list
from commentscope.functions import features as X
from commentscope.functions import text as T
from commentscope.functions import tokens as K
from commentscope.functions.lexicons import (CATEGORY_WORDS, CONTRACTIONS, LEMMA_EXCEPTIONS, LEMMA_VOCABULARY, STOP_WORDS,
                                             TAG_LEXICON, VALENCE)


def replace_all(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def non_ascii(x: str) -> str:
    return replace_all(x, T.NON_ASCII, " ")


def contractions(x: str) -> str:
    return nest(x, [lambda s, a=a, b=b: replace_all(s, rf"(?i)\b{a}\b", b) for a, b in CONTRACTIONS.items()])


def urls(x: str) -> str:
    return replace_all(x, T.URL, " ")


def symbols(x: str) -> str:
    return replace_all(x, T.SYMBOL_RUN, " ")


def spaces(x: str) -> str:
    return nest(x, [lambda s, p=p: replace_all(s, p, " ") for p in (r"\r\n", r"\n", " +")])


def dedupe(x: str) -> str:
    return replace_all(x, T.REPEATED_MARKS, r"\1")


def strip_punct(x: str) -> str:
    return f"translate({x}, {q(T.PUNCTUATION)}, '')"


def noise(x: str) -> str:
    return nest(x, [non_ascii, contractions, urls, spaces])


def clean(x: str) -> str:
    return dedupe(f"lower({x})")


def words(x: str) -> str:
    return f"regexp_extract_all({x}, {q(K.TOKEN)})"


def vector_words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {q(K.VECTOR_WORD)})"


def sentences(x: str) -> str:
    marked = rf"regexp_replace({x}, '([.!?])\s+', '\1' || chr(1), 'g')"
    return f"[s FOR s IN string_split({marked}, chr(1)) IF s <> '']"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {q(pattern)}))"


def is_punct(w: str) -> str:
    return f"(instr({q(T.PUNCTUATION)}, {w}) > 0)"


def tag(w: str, lexicon=None) -> str:
    lexicon = TAG_LEXICON if lexicon is None else lexicon
    arms = [f"WHEN {w} IN ({', '.join(q(x) for x in ws)}) THEN {q(t)}" for t, ws in lexicon.items()]
    arms.append(rf"WHEN NOT regexp_matches({w}, '[\p{{L}}\p{{N}}]') THEN '.'")
    arms.append(f"WHEN regexp_matches({w}, '^[0-9]') THEN 'CD'")
    arms += [f"WHEN suffix({w}, {q(s)}) THEN {q(t)}" for s, t in K.SUFFIX_TAGS.items()]
    return "CASE " + " ".join(arms) + " ELSE 'NN' END"


def lemma(w: str) -> str:
    arms = [f"WHEN {w} = {q(a)} THEN {q(b)}" for a, b in LEMMA_EXCEPTIONS.items()]
    listed = ", ".join(q(n) for n in LEMMA_VOCABULARY)
    for end, new in K.NOUN_ENDINGS.items():
        cand = f"(left({w}, length({w}) - {len(end)}) || {q(new)})"
        arms.append(f"WHEN suffix({w}, {q(end)}) AND {cand} IN ({listed}) THEN {cand}")
    return "CASE " + " ".join(arms) + f" ELSE {w} END"


def is_content(t: str) -> str:
    return f"regexp_matches({t}.tag, {q(K.CONTENT_TAG)}) AND NOT {is_punct(t + '.word')}"


def ngrams(tokens: str, n: int) -> str:
    return (f"[array_to_string(({tokens})[i:i + {n - 1}], ' ') FOR i IN "
            f"range(1, greatest(len({tokens}) - {n - 2}, 1)::BIGINT)]")


def valence(w: str) -> str:
    return "CASE " + " ".join(f"WHEN {w} = {q(a)} THEN {b}::DOUBLE" for a, b in VALENCE.items()) + " ELSE 0.0::DOUBLE END"


def compound(s: str) -> str:
    return f"({s} / sqrt({s} * {s} + 15))"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0.0 END"


# the prepared table, step by step; starts from d(doc_id, x)
PREP = [
    f"n AS MATERIALIZED (SELECT doc_id, x, {noise('x')} AS noise FROM d)",
    f"c AS MATERIALIZED (SELECT *, {clean('noise')} AS clean FROM n)",
    f"tk AS MATERIALIZED (SELECT *, {words('clean')} AS tok, {words(strip_punct('clean'))} AS nopunct, "
    f"[{words('s')} FOR s IN {sentences('clean')}] AS sents FROM c)",
    f"tg AS MATERIALIZED (SELECT *, [[{{'word': w, 'tag': {tag('w')}}} FOR w IN s] FOR s IN sents] AS tagged FROM tk)",
    "fl AS MATERIALIZED (SELECT *, flatten(tagged) AS flat FROM tg)",
    f"p AS MATERIALIZED (SELECT *, [{lemma('t.word')} FOR t IN flat IF {is_content('t')}] AS lemmas FROM fl)",
]

_where_tag = lambda tags: f"len([t FOR t IN flat IF t.tag IN ({', '.join(q(t) for t in tags)})])"
_where_word = lambda arr, ws: f"len([w FOR w IN {arr} IF w IN ({', '.join(q(x) for x in ws)})])"
_lens = f"[len([t FOR t IN s IF NOT {is_punct('t.word')}]) FOR s IN tagged]"
_plain = "replace(noise, '_', ' ')"
_reading = f"regexp_extract_all({_plain}, {q(X.READING_WORD)})"
_syllables = f"coalesce(list_sum([greatest({count('w', X.VOWEL_GROUP)}, 1) FOR w IN {_reading}]), 0)"
FLESCH = (f"CASE WHEN len({_reading}) > 0 THEN 206.835::DOUBLE - 1.015::DOUBLE * len({_reading}) / "
          f"greatest({count(_plain, X.SENTENCE_END)}, 1) - 84.6::DOUBLE * {_syllables} / len({_reading}) "
          "ELSE 0.0 END")
_senti = f"coalesce(list_sum([{valence('lower(w)')} FOR w IN {words('noise')}]), 0.0)"

COUNT_SQL: dict[str, str] = {
    "text_length": "length(x)",
    "num_sentences": "len(tagged)",
    "average_length": f"coalesce(list_avg({_lens}), 0.0)",
    "max_length": f"coalesce(list_max({_lens}), 0)",
    "min_length": f"coalesce(list_min({_lens}), 0)",
    "std_length": f"coalesce(list_aggregate({_lens}, 'stddev_pop'), 0.0)",
    "num_words": "len(nopunct)",
    "num_stop_words": _where_word("nopunct", STOP_WORDS),
    "num_exclamation_marks": "length(noise) - length(replace(noise, '!', ''))",
    "num_question_marks": "length(noise) - length(replace(noise, '?', ''))",
    "num_punctuations": f"length(noise) - length({strip_punct('noise')})",
    "num_nouns": _where_tag(X.NOUN_TAGS),
    "num_adjectives": _where_tag(X.ADJECTIVE_TAGS),
    "num_verbs": _where_tag(X.VERB_TAGS),
    "num_uppercase": count("noise", "[A-Z]"),
    "num_uppercase_words": f"len([w FOR w IN {words('noise')} IF regexp_matches(w, '[A-Z]') "
                           "AND NOT regexp_matches(w, '[a-z]')])",
    "num_timestamp": count("x", X.TIMESTAMP),
    "num_date_long": count("x", X.DATE_LONG),
    "num_date_short": count("x", X.DATE_SHORT),
    "num_ip": count("x", X.IP_ADDRESS),
    "num_http": count("x", X.HTTP_LINK),
    "num_mail": count("x", X.MAIL_ADDRESS),
    "readability": FLESCH,
    "sentiment": compound(_senti),
    **{f"num_bad_{c}": _where_word("lemmas", ws) for c, ws in CATEGORY_WORDS.items()},
}

# words once and repeated, by grouping exploded words
NO_SPACES = "replace(x, ' ', '')"
ONCE = [
    f"w0 AS (SELECT doc_id, {vector_words('x')} AS a, {vector_words(NO_SPACES)} AS z FROM d)",
    "w1 AS (SELECT doc_id, unnest(CASE WHEN len(a) > 0 THEN a ELSE z END) AS w FROM w0)",
    "w2 AS (SELECT doc_id, w, count(*) AS c FROM w1 GROUP BY doc_id, w)",
    "w3 AS (SELECT doc_id, count(*) FILTER (c = 1) AS o, count(*) FILTER (c > 1) AS r FROM w2 GROUP BY doc_id)",
    "once AS (SELECT d.doc_id, coalesce(o, 0) AS num_unique_words, coalesce(r, 0) AS num_repeated_words "
    "FROM d LEFT JOIN w3 USING (doc_id))",
]

DOUBLES = {"average_length", "std_length", "readability", "sentiment"}


def feature_select(names: list[str], key: str = "doc_id") -> str:
    """SELECT over p and once giving the named features, rounded."""
    base = {**COUNT_SQL}
    needed = sorted({n for n in base} )
    inner = ", ".join(f"{base[n]} AS {n}" for n in needed)
    cols = []
    for n in names:
        if n == "num_words_vs_length":
            e = ratio("num_words", "text_length")
        elif n == "length_vs_num_words":
            e = ratio("text_length", "num_words")
        elif n.endswith("_vs_length"):
            e = ratio("num_" + n[: -len("_vs_length")], "text_length")
        elif n.endswith("_vs_words"):
            e = ratio("num_" + n[: -len("_vs_words")], "num_words")
        elif n in DOUBLES:
            e = n
        else:
            cols.append(f"{n}::BIGINT AS {n}")
            continue
        cols.append(f"round({e}, 6) + 0.0 AS {n}")
    return (f"SELECT {key}, {', '.join(cols)} FROM "
            f"(SELECT p.{key}, {inner} FROM p) f JOIN once USING ({key})")


def feature_sql(docs: str, names: list[str]) -> str:
    """Only the steps the named features need."""
    return "WITH " + ",\n".join([docs, *PREP, *ONCE]) + "\n" + feature_select(names)
