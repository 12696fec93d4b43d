"""Tokens, sentences, word classes, lemmas and n-grams as array expressions.

Everything stays inside the row: no explode and no shuffle, so a comment table of any
size is tokenised in the scan stage. Word lists enter as literal hash sets;
``operators.lookups`` has the join forms, for word tables of any size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from commentscope.functions.binding import bind
from commentscope.functions.lexicons import LEMMA_EXCEPTIONS, LEMMA_VOCABULARY, STOP_WORDS, TAG_LEXICON
from commentscope.functions.predicates import is_punctuation, starts_with_letter
from commentscope.functions.text import NON_SPACE, URL, strip_punctuation

# The alternatives of a token, tried in this order. No look-around.
MAIL_TOKEN = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
ALTERNATIVES = [
    URL,
    MAIL_TOKEN,
    r"[@#][A-Za-z0-9_]+",
    r"[<>]?[:;=][-o*']?[)\](\[dDpP/:}{@|\\]",
    r"<3",
    r"[+-]?[0-9]+(?:[.,:/-][0-9]+)+",
    r"\p{L}[\p{L}'_-]+\p{L}",
    r"[\p{L}\p{N}_]+",
    r"\.{2,}",
    NON_SPACE,
]
TOKEN = "|".join(ALTERNATIVES)


# the characters outside NON_SPACE that are ASCII, as ranges: a class with ``\s`` inside is several times slower to test
ASCII_NON_SPACE = r"[^\x09-\x0D\x1C-\x20]"
# what the alternatives give where a token starts with a letter and is no address
LETTER_FIRST = [r"\p{L}++(?![\p{L}\p{N}_'-])", r"\p{L}[\p{L}'_-]+\p{L}", r"\p{L}[\p{L}\p{N}_]*+"]


def ascii_form(pattern: str) -> str:
    """The same pattern for text known to be ASCII, where plain ranges are faster to test."""
    pattern = pattern.replace(NON_SPACE, ASCII_NON_SPACE)
    return pattern.replace(r"\p{L}\p{N}", r"\p{Alnum}").replace(r"\p{L}", r"\p{Alpha}")


def scanned(alternatives: list[str]) -> str:
    """One pattern that finds what the alternatives find, of which none starts with a space: spaces are passed at
    once, and a letter is not tried as a mark or a number."""
    addresses = [a for a in alternatives if a in (URL, MAIL_TOKEN)]
    rest = [a for a in alternatives if a not in addresses]
    return "(?=[^ ])(?:" + "|".join(addresses + LETTER_FIRST + rest) + ")"


# what is left of the alternatives once the punctuation is gone
PLAIN_TOKEN = rf"(?=[^ ])(?:\p{{Alpha}}{{3,}}+|\p{{Alnum}}++|{ASCII_NON_SPACE})"
VECTOR_WORD = r"[\p{L}\p{N}_]{2,}"
CONTENT_TAG = "^(JJ|NN|RB|VB)"
CONTENT_CLASSES = ["JJ", "NN", "RB", "VB"]  # the same as first two letters
SUFFIX_TAGS = {"ly": "RB", "ing": "VBG", "ed": "VBD", "s": "NNS"}
NOUN_ENDINGS = {"ies": "y", "ches": "ch", "shes": "sh", "ses": "s", "xes": "x", "zes": "z",
                "ves": "f", "men": "man", "s": ""}


def inline_set(words) -> list[str]:
    """Words as a literal set. A list is for small tables; one that is too large for a plan is a
    DataFrame, and goes to the join forms in ``operators.lookups``."""
    return sorted(set(words))


def words(c: Column, ascii_only: bool = False) -> Column:
    """Tokens of a text; the mail pattern scans every word twice, so it is tried only where
    the text holds its mark."""
    form = ascii_form if ascii_only else (lambda p: p)
    full, short = (form(scanned(a)) for a in (ALTERNATIVES, [a for a in ALTERNATIVES if a != MAIL_TOKEN]))
    return F.when(F.contains(c, F.lit("@")), F.regexp_extract_all(c, F.lit(full), F.lit(0))).otherwise(
        F.regexp_extract_all(c, F.lit(short), F.lit(0)))


def words_no_punctuation(cleaned: Column) -> Column:
    """Tokens of a cleaned (ASCII) text after its punctuation is deleted."""
    return F.regexp_extract_all(strip_punctuation(cleaned), F.lit(PLAIN_TOKEN), F.lit(0))


def sentences(c: Column) -> Column:
    cut = F.split(F.regexp_replace(c, r"([.!?])\s+", "$1\u0001"), "\u0001")
    return F.filter(cut, lambda s: s != "")


def sentence_words(cleaned: Column) -> Column:
    return F.transform(sentences(cleaned), lambda s: words(s, ascii_only=True))


def tag_word(w: Column, lexicon: dict[str, list[str]] | None = None) -> Column:
    """Word class by table, then by character class, then by suffix, else NN."""
    lexicon = TAG_LEXICON if lexicon is None else lexicon

    def case(arms) -> Column:
        (cond, tag), *rest = arms
        out = F.when(cond, F.lit(tag))
        for cond, tag in rest:
            out = out.when(cond, F.lit(tag))
        return out

    listed = case([(w.isin(inline_set(ws)), tag) for tag, ws in lexicon.items()])
    suffixed = case([(F.endswith(w, F.lit(s)), t) for s, t in SUFFIX_TAGS.items()]).otherwise("NN")
    classed = case([(~w.rlike(r"[\p{L}\p{N}]"), "."), (w.rlike("^[0-9]"), "CD")]).otherwise(suffixed)
    guessed = F.when(starts_with_letter(w), suffixed).otherwise(classed)  # most words need no pattern
    # one hash probe decides between the table and the rules
    return F.when(w.isin(inline_set(x for ws in lexicon.values() for x in ws)), listed).otherwise(guessed)


def tag_sentences(nested: Column, lexicon=None) -> Column:
    """Sentences of words to sentences of (word, tag)."""
    pair = lambda w: F.struct(w.alias("word"), tag_word(w, lexicon).alias("tag"))
    return F.transform(nested, lambda s: F.transform(s, pair))


def lemma_candidates(w: Column) -> list[Column]:
    """One singular form per noun ending, null where the word lacks the ending."""
    return [F.when(F.endswith(w, F.lit(end)),
                   F.concat(F.substring(w, F.lit(1), F.length(w) - len(end)), F.lit(new)))
            for end, new in NOUN_ENDINGS.items()]


def lemma(w: Column, exceptions: dict[str, str] | None = None, vocabulary=None) -> Column:
    """Noun lemma: exception table, else the first singular form found in the vocabulary."""
    exceptions = LEMMA_EXCEPTIONS if exceptions is None else exceptions
    vocabulary = inline_set(LEMMA_VOCABULARY if vocabulary is None else vocabulary)
    irregular = F.create_map(*[F.lit(x) for pair in exceptions.items() for x in pair])
    known = [F.when(c.isin(vocabulary), c) for c in lemma_candidates(w)]
    last = [F.endswith(w, F.lit(mark)) for mark in sorted({end[-1] for end in NOUN_ENDINGS})]
    return (F.when(w.isin(inline_set(exceptions)), F.element_at(irregular, w))
             .when(reduce(lambda a, b: a | b, last), F.coalesce(*known, w)).otherwise(w))


def is_content(tagged: Column) -> Column:
    return F.substring(tagged["tag"], 1, 2).isin(CONTENT_CLASSES) & ~is_punctuation(tagged["word"])


def content_words(tagged: Column) -> Column:
    return F.transform(F.filter(tagged, is_content), lambda t: t["word"])


def content_lemmas(tagged: Column, exceptions=None, vocabulary=None) -> Column:
    return F.transform(F.filter(tagged, is_content),
                       lambda t: lemma(t["word"], exceptions, vocabulary))


def remove_stop_words(tokens: Column, stop_words=None) -> Column:
    """Duplicates stay, unlike with ``array_except``."""
    stop = inline_set(STOP_WORDS if stop_words is None else stop_words)
    return F.filter(tokens, lambda w: ~w.isin(stop))


def vector_words(c: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(VECTOR_WORD), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    def grams(t: Column) -> Column:
        return F.when(F.size(t) >= n, F.transform(
            F.sequence(F.lit(1), F.size(t) - (n - 1)),
            lambda i: F.array_join(F.slice(t, i, F.lit(n)), " ")))

    return F.coalesce(bind(tokens, grams), F.array().cast("array<string>"))


def term_counts(tokens: Column) -> Column:
    """Distinct words of one row with their counts: array of (term, tf), found by sorting."""
    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(s)),
                          lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)))
        return bind(starts, lambda b: F.zip_with(
            b, F.concat(F.slice(b, F.lit(2), F.size(b)), F.array(F.size(s) + 1)),
            lambda lo, hi: F.struct(F.get(s, lo - 1).alias("term"),
                                    (hi - lo).cast("long").alias("tf"))))

    some = bind(F.sort_array(tokens), lambda s: F.when(F.size(s) > 0, runs(s)))
    return F.coalesce(some, F.array().cast("array<struct<term:string,tf:bigint>>"))
