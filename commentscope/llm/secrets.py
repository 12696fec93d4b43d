"""Secrets in texts, with DataFrame operations alone.

Strong patterns (assigned secrets, access identifiers, long hex strings) are reported as they are.
Weak candidates, which mean nothing alone, are parts of a credential: an identifier, a secret-like
string, an endpoint. Parts are linked when they lie in the same scope (between blank lines of one
text) and at most ``REACH`` code points lie between them; a weak candidate is reported when a
complementary part is linked to it: an identifier or endpoint needs a secret, a secret needs an
identifier or endpoint. Strong hits take part as parts too.

The link is an interval join on a grid: a part stands in every cell (text, scope, ``REACH`` code points)
that it touches, and of each kind a cell keeps the smallest start and the largest end. A candidate meets
the cells that it touches and their neighbours. Within reach are all parts of its own cells, and of a
neighbour those that begin (to the right) or end (to the left) near enough: no pairs inside a cell are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentscope.functions.binding import bind
from commentscope.llm.common import quoted, text_or_empty, written

#: Fixed patterns of the three base kinds, with the shortest length of the whole match (of group 2 for assign).
BASE = {
    "assign": ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
               r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{24,}",
}
ASSIGN_MIN, ACCESS_MIN, SECRET_MIN = 6, 20, 20

#: Weak parts: (role, pattern). Every pattern starts and ends on a character class, so matches are maximal.
#: A secret is group 1: a run without all three classes is matched outside the group, as no later start in it
#: can succeed, and so is read once.
WEAK = {
    "weak_id": ("id", r"\b(?:[A-Z]{2,5}[0-9][A-Z0-9]{10,30}|(?:client|account|access|user)_?(?:id|key)\x20*[:=]\x20*[A-Za-z0-9_-]{4,64})"),
    "weak_secret": ("secret", r"\b(?:((?=[A-Za-z+/_-]*+[0-9])(?=[A-Z0-9+/_-]*+[a-z])(?=[a-z0-9+/_-]*+[A-Z])[A-Za-z0-9+/_-]{20,}+)|[A-Za-z0-9+/_-]{20,}+)"),
    "weak_endpoint": ("endpoint", r"\b(?:https?|s3|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9.:_-]+"),
}
ROLE = {"assign": "secret", "access": "id", "hex": "secret"} | {k: role for k, (role, _) in WEAK.items()}
KINDS = [*BASE, *WEAK]
REACH = 160
BREAK = r"\n[\x20\t\r]*\n"

_SPANS = "ARRAY<STRUCT<start: BIGINT, end: BIGINT>>"
_NONE = f"CAST(array() AS {_SPANS})"
#: Matches whose offsets are summed in one go. An array that grows is copied at every step, so sums run over
#: groups of matches first and over the groups then.
GROUP = 128


def _summed(pieces: Column) -> Column:
    """(start, end) of matches from an array of (gap before it, length), by sums over groups of ``GROUP``."""
    at, none = F.lit(0).cast("long"), F.expr(_NONE)

    def one(group: Column) -> Column:
        return F.aggregate(group, F.struct(at.alias("at"), none.alias("spans")), lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["n"]).alias("at"),
            F.concat(s["spans"], F.array(F.struct((s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + x["n"]).alias("end")))).alias("spans")))

    def moved(groups: Column) -> Column:
        bases = F.aggregate(groups, F.struct(at.alias("at"), F.expr("CAST(array() AS ARRAY<BIGINT>)").alias("bases")), lambda s, g: F.struct(
            (s["at"] + g["at"]).alias("at"), F.concat(s["bases"], F.array(s["at"])).alias("bases")))["bases"]
        return F.flatten(F.zip_with(groups, bases, lambda g, base: F.transform(
            g["spans"], lambda x: F.struct((x["start"] + base).alias("start"), (x["end"] + base).alias("end")))))

    def grouped(p: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(p), F.lit(GROUP))
        return F.when(F.size(p) > 0, bind(F.transform(firsts, lambda i: one(F.slice(p, i, F.lit(GROUP)))), moved)).otherwise(none)

    return bind(pieces, grouped)


def _hits(pattern: str, possible: Column) -> Column:
    """(start, end) of all matches in code points: matches and the pieces between them alternate.

    ``possible`` is a cheap test that is true whenever there is a match; the pattern runs only then.
    """
    found, gaps = F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.split("text", pattern, -1)
    pieces = F.filter(F.zip_with(found, gaps, lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("n"))), lambda x: x["n"].isNotNull())
    return F.when(possible, _summed(pieces)).otherwise(F.expr(_NONE))


def _kept(pattern: str, possible: Column, group: int, least: int) -> Column:
    """As ``_hits``, without matches whose group is shorter than ``least``: no part of them is tried again."""
    groups = F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    paired = F.zip_with(_hits(pattern, possible), groups, lambda s, g: F.struct(s.alias("s"), F.length(g).alias("n")))
    return F.when(possible, F.transform(F.filter(paired, lambda x: x["n"] >= least), lambda x: x["s"])).otherwise(F.expr(_NONE))


def spans_in(texts: DataFrame) -> DataFrame:
    """Adds one array of (start, end) per kind, and ``breaks`` for the blank lines, to a table with a text."""
    low = F.lower("text")
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    wide = F.col("text").rlike(r"[A-Za-z0-9+/_-]{20}")
    columns = {
        "assign": _kept(BASE["assign"], named, 2, ASSIGN_MIN),
        "access": _kept(BASE["access"], F.col("text").contains("AKIA"), 0, ACCESS_MIN),
        "hex": _hits(BASE["hex"], F.col("wide")),
        "weak_id": _hits(WEAK["weak_id"][1], F.col("text").rlike(r"[A-Z][0-9]|_?(?:id|key)\x20*[:=]")),
        "weak_secret": _kept(WEAK["weak_secret"][1], F.col("wide"), 1, SECRET_MIN),
        "weak_endpoint": _hits(WEAK["weak_endpoint"][1], F.col("text").contains("://")),
    }
    found = texts.withColumn("wide", wide).withColumns(columns)
    weak = F.lit(0)
    for k in KINDS:
        weak = weak + F.size(k)
    return found.withColumn("breaks", F.when(weak > 1, _hits(BREAK, F.col("text").contains("\n"))).otherwise(F.expr(_NONE)))


def linked(found: DataFrame, keys: list[str], reach: int = REACH) -> DataFrame:
    """Weak spans clear of base spans and with a linked complementary part: keys, kind, start, end. What a text
    holds is ordered once to each side; no part is compared with all others of its text."""
    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(
            F.lit(kind).alias("kind"), F.lit(ROLE[kind]).alias("role"), s["start"].alias("start"), s["end"].alias("end")))

    breaks = F.transform("breaks", lambda s: F.struct(
        F.lit("break").alias("kind"), F.lit("").alias("role"), s["start"].alias("start"), s["end"].alias("end")))
    rows = found.select(*keys, F.explode(F.flatten(F.array(*map(named, KINDS), breaks))).alias("p")).select(*keys, "p.*")
    # in order of start, base spans before weak ones: the scope is the number of breaks so far, and a base span
    # overlaps if one that began before ends later, or one that begins after begins before the end
    weak_kind, base_kind = F.col("kind").isin(list(WEAK)), F.col("kind").isin(list(BASE))
    upto = Window.partitionBy(*keys).orderBy("start", weak_kind.cast("int")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*keys).orderBy(F.desc("start"), weak_kind.cast("int").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select("*", F.count_if(F.col("kind") == "break").over(upto).alias("scope"), F.max(F.when(base_kind, F.col("end"))).over(upto).alias("__before"),
                         F.min(F.when(base_kind, F.col("start"))).over(after).alias("__after"))
    hidden = F.coalesce(F.col("__before") > F.col("start"), F.lit(False)) | F.coalesce(F.col("__after") < F.col("end"), F.lit(False))
    parts = (placed.where("kind <> 'break'").withColumn("hidden", hidden).drop("__before", "__after")
             .withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / reach), F.floor(F.col("end") / reach)))))
    # of each role, the smallest start and the largest end per cell say all that its neighbours need
    cells = parts.groupBy(*keys, "scope", "cell", "role").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    offered = cells.select(
        *[F.col(k).alias("o_" + k) for k in keys], F.col("scope").alias("o_scope"), F.col("role").alias("o_role"), F.col("cell").alias("o_cell"),
        "first", "last", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("at"))
    on = (F.col("scope") == F.col("o_scope")) & (F.col("cell") == F.col("at"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col("o_" + k))
    needs = F.when(F.col("role") == "secret", F.col("o_role") != "secret").otherwise(F.col("o_role") == "secret")
    near = (F.when(F.col("o_cell") == F.col("cell"), F.lit(True))
            .when(F.col("o_cell") < F.col("cell"), F.col("start") - F.col("last") <= reach)
            .otherwise(F.col("first") - F.col("end") <= reach))
    weak = parts.where(weak_kind & ~F.col("hidden"))
    return weak.join(offered, on & needs & near, "left_semi").select(*keys, "kind", "start", "end").distinct()


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document: doc_id, the base kinds as arrays of (start, end), and ``weak`` (kind, start, end).

    Null texts are empty. Offsets are code points, ends exclusive. A weak candidate that overlaps a
    base span of its text is dropped: the base span stands for it. Null ids and rows with the same id
    are documents of their own; equal rows get equal results. Other columns are ignored.
    """
    texts = docs.select(F.col(quoted(id_col)).alias("doc_id"), text_or_empty(text_col).alias("text"))
    found = written(spans_in(texts.withColumn("text_key", F.md5(F.col("text").cast("binary")))).drop("text", "wide"), "secret-spans")
    keys = ["doc_id", "text_key"]
    some = sum((F.size(k) for k in KINDS), F.lit(0)) > 1
    # equal rows have equal spans: their parts are linked once
    weak = linked(found.where(some).dropDuplicates(keys), keys, reach)
    weak = weak.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("weak"))
    weak = weak.select(F.col("doc_id").alias("w_doc_id"), F.col("text_key").alias("w_text_key"), "weak")
    on = (F.col("text_key") == F.col("w_text_key")) & F.col("doc_id").eqNullSafe(F.col("w_doc_id"))
    none = F.expr("CAST(array() AS ARRAY<STRUCT<kind: STRING, start: BIGINT, end: BIGINT>>)")
    return (found.join(weak, on, "left")
            .select("doc_id", *BASE, F.coalesce("weak", none).alias("weak")))


def joined(kinds: dict[str, Column]) -> Column:
    """``kind:start:end`` by start, then kind in the order given, then end, joined by commas."""
    def ranked(i: int, kind: str) -> Column:
        return F.transform(kinds[kind], lambda s: F.struct(
            s["start"].alias("start"), F.lit(i).alias("i"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    rows = F.flatten(F.array(*[ranked(i, kind) for i, kind in enumerate(kinds)]))
    return F.array_join(F.transform(F.array_sort(rows), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
