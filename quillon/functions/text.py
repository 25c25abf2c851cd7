"""Text rules of legal documents as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Quote characters alone and in pairs.
QUOTES = ("‧", "'", '"')
QUOTE_PAIRS = (("‘", "’"), ("“", "”"), ("„", "“"))
#: Label patterns in order of hierarchy, the characters stripped from them, and languages that have them.
NBSP = "\u00a0"
ROMAN = r"(?=[ivxl])(?:xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
LABELS = {
    "nump": {"en": r"^[1-9][0-9]{0,3}\." + NBSP + "{0,3}", "es": r"^[1-9][0-9]{0,3}\." + NBSP + "{0,3}", "de": r"^\([0-9]{1,3}\)"},
    "numpt": {"en": r"^[0-9]{1,3}\.?(?!([0-9/();]| of))", "es": r"^[0-9]{1,3}\.?(?!([0-9/();]| de))"},
    "numbr": {"en": r"^\([0-9]{1,3}\)", "es": r"^\([0-9]{1,3}\)"},
    "alpha": dict.fromkeys(("en", "es", "de"), r"^\([a-z]\)"),
    "roman": dict.fromkeys(("en", "es", "de"), rf"^\({ROMAN}\)"),
    "dash": dict.fromkeys(("en", "es", "de"), "^(&mdash;|—)"),
}
LANGUAGES = ("en", "de", "es")


def blanks(c: Column) -> Column:
    """Runs of white space as one blank."""
    return F.regexp_replace(c, r"\s+", " ")


def negligible(c: Column) -> Column:
    """Null, empty or blank, no-break spaces included."""
    return F.coalesce(F.regexp_replace(c, rf"[\s{NBSP}]+", ""), F.lit("")) == ""


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "<[^>]*>", ""))


def spanish_ordinal(c: Column) -> Column:
    """n.o and no before a number become the numero sign."""
    return F.regexp_replace(c, r"\b[nN]\.?[ºo](?= ?[0-9])", "№")


def standard_label(c: Column) -> Column:
    """'a)' at the start becomes '(a)', '12.' with three no-break spaces '(12)'."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s*([0-9a-z]{1,4})\)", "($1)"), rf"^\s*([0-9]+)\.{NBSP}{{3}}", "($1)")


def standard_quotes(c: Column) -> Column:
    """Quoted passages of up to 200 characters as >>..<<, whatever their marks."""
    for q in QUOTES:
        c = F.regexp_replace(c, rf"(?i)(?<![a-z0-9]){q}([^{q}]{{0,200}}){q}(?=[\s),.])", ">>$1<<")
    for a, b in QUOTE_PAIRS:
        c = F.regexp_replace(c, rf"(?<![a-z0-9]){a}([^{b}]{{0,200}}){b}(?=[\s),.])", ">>$1<<")
    return c


def quotations(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r">>(.{0,200}?)<<"), F.lit(1))


def valid_term(c: Column) -> Column:
    """A definition's term: letters, digits and some marks, at most 200, not a number, not one small letter."""
    return c.rlike(r"^[\p{L}0-9 ,'()/&-]{1,200}$") & ~c.rlike(r"^[0-9]+$") & ~c.rlike(r"^[a-z]$")


def heading_score(c: Column) -> Column:
    """How much a paragraph looks like a title: 1 / words, fourfold in capitals, 0 with closing marks or a label."""
    t = F.trim(c)
    words = F.size(F.split(t, r"\s+"))
    score = F.lit(1.0) / words * F.when(F.upper(t) == t, 4.0).otherwise(1.0)
    return F.when((t == "") | t.rlike(r"[.,:;]$") | t.rlike(r"^\([0-9a-z]{1,3}\)"), 0.0).otherwise(score)


def ascii_id(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\t-~]", "_z_")


def label_candidates(c: Column, language: str) -> Column:
    """Tags whose pattern a label has, in order of hierarchy; null for languages without patterns."""
    if language not in LANGUAGES:
        return F.lit(None).cast("array<string>")
    return F.array_compact(F.array(*[F.when(c.rlike(p[language]), tag) for tag, p in LABELS.items() if language in p]))


def label_inner(c: Column) -> Column:
    """What a label says, without its decoration."""
    return F.btrim(F.regexp_extract(c, rf"^(\(?[0-9a-z]{{1,4}}[.)]?)", 1), F.lit("(). " + NBSP))
