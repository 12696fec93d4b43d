"""Comment cleaning as ``Column -> Column`` functions (no UDF, one codegen stage)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentscope.functions.binding import bind
from commentscope.functions.lexicons import CONTRACTIONS

# Character classes and patterns that decide the results.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
NON_ASCII = r"[^\x00-\x7f]"
NON_SPACE = r"[^\s\x0B\x1C-\x1F\x85\p{Z}]"
URL = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"
SYMBOL_RUN = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2702}-\x{27B0}\x{24C2}-\x{1F251}\x{FE0F}]+"
)
# A kept mark (no double quote) followed by marks to drop (double quote included);
# the backslash is in neither class.
REPEATED_MARKS = (
    r"([!#$%&'()*+,./:;<=>?@\[\]^_`{|}~-])"
    r"""[!"#$%&'()*+,./:;<=>?@\[\]^_`{|}~-]+"""
)
APOSTROPHE_WORD = r"[A-Za-z]+(?:'[A-Za-z]+)+"


def text_or_empty(column: str) -> Column:
    """Null comments are kept and read as empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def blank_non_ascii(c: Column) -> Column:
    return F.regexp_replace(c, NON_ASCII, " ")


def expand_contractions(c: Column, table: dict[str, str] | None = None) -> Column:
    """Replace each contraction by its lower-case expansion, ignoring case.

    The text is cut once into the apostrophe words and the pieces between them, so the
    cost does not grow with the dictionary; a text without an apostrophe is not cut at all.
    """
    table = CONTRACTIONS if table is None else table
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])

    def expanded(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(APOSTROPHE_WORD), F.lit(0))
        full = F.transform(found, lambda w: F.coalesce(F.element_at(lookup, F.lower(w)), w))
        pieces = F.zip_with(F.split(text, APOSTROPHE_WORD), full,
                            lambda p, w: F.concat(p, F.coalesce(w, F.lit(""))))
        return F.when(F.contains(text, F.lit("'")), F.array_join(pieces, "")).otherwise(text)

    return bind(c, expanded)


def blank_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL, " ")


def blank_symbols(c: Column) -> Column:
    """Runs of emoji, pictographs and dingbats (and CJK, which the range covers) to a space."""
    return F.regexp_replace(c, SYMBOL_RUN, " ")


def collapse_spaces(c: Column) -> Column:
    """Line ends to spaces, then runs of spaces to one; tabs stay, nothing is trimmed."""
    one_line = F.replace(F.replace(c, F.lit("\r\n"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    return F.regexp_replace(one_line, " {2,}", " ")


def dedupe_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, REPEATED_MARKS, "$1")


def strip_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{Punct}+", "")  # the ASCII marks, those of PUNCTUATION


def remove_noise(c: Column) -> Column:
    """All cleaning that keeps the case of the text.

    ``blank_symbols`` would stand before the last step, but the first step leaves it
    nothing to replace.
    """
    for step in (blank_non_ascii, expand_contractions, blank_urls, collapse_spaces):
        c = step(c)
    return c


def normalise(noise_removed: Column) -> Column:
    return dedupe_punctuation(F.lower(noise_removed))


def clean_comments(df: DataFrame, column: str = "comment_text") -> DataFrame:
    """Add ``noise_removed_text`` and ``clean_text``."""
    return (df.withColumn("noise_removed_text", remove_noise(text_or_empty(column)))
              .withColumn("clean_text", normalise(F.col("noise_removed_text"))))
