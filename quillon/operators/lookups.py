"""Dimension lookups and small rules over records: languages, labels, treaties, anchors, pages of hits, versions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

#: Language codes of three letters by those of two.
LANGUAGE_CODES = {
    "BG": "BUL", "CS": "CES", "DA": "DAN", "DE": "DEU", "EL": "ELL", "EN": "ENG", "ES": "SPA", "ET": "EST", "FI": "FIN", "FR": "FRA", "GA": "GLE", "HR": "HRV",
    "HU": "HUN", "IT": "ITA", "LT": "LIT", "LV": "LAV", "MT": "MLT", "NL": "NLD", "PL": "POL", "PT": "POR", "RO": "RON", "SK": "SLK", "SL": "SLV", "SV": "SWE",
}
#: Latin suffixes of numbers, from 2 on.
LATIN = ("bis", "ter", "quater", "quinquies", "sexies", "septies", "octies", "novies", "decies")
#: What a document's state is after an error of each kind.
STATES = {"redirect": "failed", "not_found": "impossible", "repealer": "repealer", "standardisation": "failed", "inconsistent": "failed", "format_missing": "impossible"}


def _case(c: Column, values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[c]


def language_of_three(two: Column) -> Column:
    return _case(F.upper(two), LANGUAGE_CODES)


def language_of_two(three: Column) -> Column:
    return _case(F.upper(three), {v: k for k, v in LANGUAGE_CODES.items()})


def both_ways(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """(side, key, value): a lookup table of pairs in both directions; a later pair would replace an earlier, so keys are unique."""
    one = pairs.select(F.lit(left).alias("side"), F.col(left).cast("string").alias("key"), F.col(right).cast("string").alias("value"))
    two = pairs.select(F.lit(right).alias("side"), F.col(right).cast("string").alias("key"), F.col(left).cast("string").alias("value"))
    return one.unionByName(two).groupBy("side", "key").agg(F.max("value").alias("value"))


def known(c: Column) -> Column:
    """A number that isn't NaN, else null."""
    return F.when(~F.isnan(c), c)


def iri_labels(rows: DataFrame, iri: str, prefix: str, labels: DataFrame) -> DataFrame:
    """Add label: that of what follows the prefix in labels (key, label); null for other namespaces and unknown keys."""
    key = F.when(F.col(iri).startswith(prefix), F.substr(F.col(iri), F.lit(len(prefix) + 1)))
    return rows.withColumn("__key", key).join(labels.select(F.col("key").alias("__key"), "label"), "__key", "left").drop("__key")


def acronyms(wanted: DataFrame, treaties: DataFrame) -> DataFrame:
    """Add abbrev of (treaty, language); the query fails where a treaty has none."""
    found = wanted.join(treaties.select("treaty", "language", F.col("abbrev").alias("__abbrev")), ["treaty", "language"], "left")
    missing = F.raise_error(F.concat(F.lit("no acronym: "), F.col("treaty"), F.lit(" "), F.col("language"))).cast("string")
    return found.withColumn("abbrev", F.when(F.col("__abbrev").isNull(), missing).otherwise(F.col("__abbrev"))).drop("__abbrev")


def popular_titles(records: DataFrame, titles: DataFrame) -> DataFrame:
    """pop_title and pop_acronym from the dimension (id_local, language) where it has the act, else as they were."""
    new = titles.select("id_local", "language", F.col("pop_title").alias("__t"), F.col("pop_acronym").alias("__a"), F.lit(True).alias("__has"))
    out = records.join(new, ["id_local", "language"], "left")
    pick = lambda c, n: F.when(F.col("__has"), F.col(n)).otherwise(F.col(c)).alias(c)
    return out.select(*[pick(c, {"pop_title": "__t", "pop_acronym": "__a"}[c]) if c in ("pop_title", "pop_acronym") else F.col(c) for c in records.columns])


def anchor(href: Column, text: Column, title: Column) -> Column:
    return F.struct(href.alias("href"), text.alias("text"), title.alias("title"))


def treaty_anchor(hosted: list[str], id_local: Column, source: Column, acronym: Column, title: Column) -> Column:
    """An anchor to a treaty: to our page if we host it, else to its source."""
    return anchor(F.when(id_local.isin(hosted), F.concat(F.lit("/eu/"), id_local, F.lit("/"))).otherwise(source), acronym, title)


def anchors_of(referrers: DataFrame, anchors: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(referrers with their anchor, referrers dropped for want of one)."""
    return referrers.join(anchors, key), referrers.join(anchors.select(key), key, "left_anti")


def internal(hrefs: Column) -> Column:
    """The references of an array that stay on this site."""
    return F.filter(hrefs, lambda h: h.startswith("/eu/"))


def of_types(hits: DataFrame, types: list[str], celex: str = "celex") -> DataFrame:
    """Hits whose act is of one of the types (R, L, ..); all where no type is asked for. Ids that don't parse go."""
    inter = F.regexp_extract(celex, r"^[0-9]{5}([A-Z]+)[0-9]{4}", 1)
    return hits.where(inter.isin(types) if types else inter != "")


def pages(hits: Column, size: int) -> Column:
    return F.ceil(hits / size).cast("long")


def merge_pages(rows: DataFrame, key: str, page: str) -> DataFrame:
    """One row a key, of its last page; total is the number of keys."""
    last = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), page).alias("__r")).select(key, "__r.*")
    return last.crossJoin(F.broadcast(last.agg(F.count("*").alias("total"))))


def human_id(name: Column, celex: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit("CELEX:"), celex))


def seconds_to_tomorrow(now: Column) -> Column:
    return (F.unix_timestamp(F.date_trunc("day", now + F.expr("interval 1 day"))) - F.unix_timestamp(now)).cast("long")


def coalesce_records(old: DataFrame, new: DataFrame, key: str, sets: list[str]) -> DataFrame:
    """old with what new adds: sets are united, other values are filled where they are missing."""
    fresh = new.select(key, *[F.col(c).alias(f"__{c}") for c in old.columns if c != key])
    empty = lambda c: F.coalesce(c, F.array().cast(old.schema[c.removeprefix("__")].dataType))
    join = lambda c: F.array_sort(F.array_union(empty(c), empty(f"__{c}"))) if c in sets else F.coalesce(c, f"__{c}")
    return old.join(fresh, key, "left").select(key, *[join(c).alias(c) for c in old.columns if c != key])


def filled(record: DataFrame, key: str) -> DataFrame:
    """(key, name, value) of a record's columns that have a value and aren't hidden by a leading underscore."""
    names = [c for c in record.columns if c != key and not c.startswith("_")]
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in names])
    return record.select(key, F.inline(pairs)).where("value is not null and value not in ('', '[]')")


def guessed_url(celex: Column, day: Column, language: Column, form: str) -> Column:
    """Where a representation should be, by the site's system; the day 1900-01-01 is the act itself."""
    consolidated = F.concat(F.lit("0"), F.substring(celex, 2, 99), F.lit("-"), F.date_format(day, "yyyyMMdd"))
    name = F.when(day == F.lit("1900-01-01").cast("date"), celex).otherwise(consolidated)
    return F.concat(F.lit("https://eur-lex.europa.eu/legal-content/"), language, F.lit(f"/TXT/{form}/?uri=CELEX:"), name)


def previous_preamble(versions: DataFrame) -> DataFrame:
    """Add preamble_date: the earliest version of the act and language, before this one, that has recitals; null if there is none."""
    before = Window.partitionBy("celex", "language").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return versions.withColumn("preamble_date", F.min(F.when(F.col("recitals"), F.col("date"))).over(before))


def accessors(representation: DataFrame, acts: DataFrame) -> DataFrame:
    """Representations with in_force of their act, loaded (null where the state is) and the id of the dated text."""
    dated = F.concat(F.lit("0"), F.substring("celex", 2, 99), F.lit("-"), F.date_format("date", "yyyyMMdd"))
    out = representation.join(acts.select("celex", "in_force"), "celex", "left")
    return out.select("celex", "language", "date", "in_force", F.col("transformation").startswith("success").alias("loaded"), dated.alias("compound_celex"))


def state_after(error: Column) -> Column:
    """The state that an error's kind leads to; no error is success, an unknown kind is a failure."""
    return F.when(error.isNull(), "success").otherwise(F.coalesce(_case(error, STATES), F.lit("failed")))


def sub_id(title: Column) -> Column:
    """What follows an element's id for a label: without brackets, a Latin suffix as its number, other suffixes dropped."""
    bare = F.btrim(title, F.lit("().  "))
    base, suffix = F.split(bare, r"[\s ]", 2)[0], F.get(F.split(bare, r"[\s ]", 2), 1)
    number = _case(F.lower(suffix), {w: str(k) for k, w in enumerate(LATIN, 2)})
    return F.concat(base, F.coalesce(number, F.lit("")))


def delimited(term: Column) -> Column:
    """A pattern for a defined term: exact for one letter or capitals, else with up to two more letters."""
    end = F.when((F.length(term) == 1) | (term == F.upper(term)), r"\b").otherwise(r"[a-z]{0,2}\b")
    return F.concat(F.lit(r"\b"), term, end)


def textify(markup: Column) -> Column:
    """Text of markup: tags are dropped, blanks collapse, ends are trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(markup, "<[^>]*>", ""), r"\s+", " "))


def hosted_path(celex: Column) -> Column:
    """The path of an act we host; ids with a year of two digits are put right; others have none."""
    typo = r"^3([0-9]{2})([RLFD][0-9]{4})$"
    year, rest = F.regexp_extract(celex, typo, 1), F.regexp_extract(celex, typo, 2)
    whole = F.when(celex.rlike(r"^3(19|20)[0-9]{2}[RLFD][0-9]{4}$"), celex).when(celex.rlike(typo), F.concat(F.when(year < "45", "320").otherwise("319"), year, rest))
    return F.concat(F.lit("/eu/"), whole, F.lit("/"))


def corrigendum_number(celex: Column) -> Column:
    """(nn) of a corrigendum's id, null for other ids."""
    got = F.regexp_extract(celex, r"^[0-9]{5}[RLFD][0-9]{4}R(\([0-9]{1,2}\))$", 1)
    return F.when(got != "", got)


def expanded(iri: Column, prefixes: dict[str, str]) -> Column:
    """A prefixed name as its full address; others stay."""
    out = iri
    for prefix, space in prefixes.items():
        out = F.when(iri.startswith(f"{prefix}:"), F.regexp_replace(iri, f"^{re.escape(prefix)}:", space)).otherwise(out)
    return out
