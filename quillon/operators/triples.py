"""Triple patterns as joins: triples(s, p, o, datatype, lang) and the metadata queries over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

#: Predicates by the short names used here.
P = {
    "celex": "cdm:resource_legal_id_celex", "in_force": "cdm:resource_legal_in-force", "created": "cdm:work_date_creation_legacy", "of_work": "cdm:expression_belongs_to_work",
    "language": "cdm:expression_uses_language", "title": "cdm:expression_title", "based_on": "cdm:act_consolidated_based_on_resource_legal", "consolidated": "cdm:act_consolidated_date",
    "corrects": "cdm:resource_legal_corrects_resource_legal", "number": "cdm:resource_legal_number_corrigendum", "dated": "cdm:work_date_document", "year": "cdm:resource_legal_year",
    "cites": "cdm:work_cites_work", "about": "cdm:work_is_about_concept_eurovoc", "label": "skos:prefLabel", "type": "cdm:resource_legal_type", "kind": "cdm:work_has_resource-type",
    "treaty": "cdm:resource_legal_based_on_concept_treaty", "local": "eli:id_local",
}
#: Ids of acts in the four kinds that the registry follows.
ACT = "^3[0-9]{4}[RLDF][0-9]{4}$"


def pattern(triples: DataFrame, s: str, p: str, o: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Solutions of one pattern with a fixed predicate: the subject as column s, the object as column o."""
    more = [F.col(c).alias(n) for c, n in (extra or {}).items()]
    return triples.where(F.col("p") == P.get(p, p)).select(F.col("s").alias(s), F.col("o").alias(o), *more)


def bgp(triples: DataFrame, *patterns: tuple[str, str, str]) -> DataFrame:
    """Join patterns on the variables that they share; the first must name one that each later one knows."""
    parts = [pattern(triples, *p) for p in patterns]
    return reduce(lambda a, b: a.join(b, [c for c in a.columns if c in b.columns]), parts)


def optional(solutions: DataFrame, part: DataFrame) -> DataFrame:
    return solutions.join(part, [c for c in solutions.columns if c in part.columns], "left")


def first_nonempty(*branches: DataFrame) -> DataFrame:
    """All rows of the first branch that has any: a typed match first, then a plain one."""
    tagged = reduce(DataFrame.union, [b.withColumn("__n", F.lit(i)) for i, b in enumerate(branches)])
    best = tagged.agg(F.min("__n").alias("__m"))
    return tagged.join(F.broadcast(best), F.col("__n") == F.col("__m"), "left_semi").drop("__n")


def _expressions(t: DataFrame, work: str) -> DataFrame:
    return bgp(t, ("e", "of_work", work), ("e", "language", "lang"))


def acts_of_month(t: DataFrame, year: int, month: int, act_type: str) -> DataFrame:
    """Q1."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    dated = bgp(t, ("w", "celex", "celex"), ("w", "created", "date")).where(F.col("celex").rlike(f"^3{year}{act_type}[0-9]{{4}}$") & F.col("date").try_cast("date").between(first, F.last_day(first)))
    return optional(dated.join(_expressions(t, "w"), "w"), pattern(t, "w", "in_force", "in_force")).select("celex", "in_force", "date", "lang")


def consolidations_of(t: DataFrame, celex: str) -> DataFrame:
    """Q2."""
    base = pattern(t, "base", "celex", "b").where(F.col("b") == celex).select("base")
    found = base.join(pattern(t, "w", "based_on", "base"), "base").join(bgp(t, ("w", "celex", "c_celex"), ("w", "consolidated", "date")), "w").join(_expressions(t, "w"), "w")
    return found.select("c_celex", "date", "lang").distinct()


def in_force_of(t: DataFrame, celex: str) -> DataFrame:
    """Q3."""
    return pattern(t, "w", "celex", "celex").where(F.col("celex") == celex).join(pattern(t, "w", "in_force", "value"), "w").select("value")


def celexes_of(t: DataFrame, year: int, inter: str) -> DataFrame:
    """Q4."""
    return pattern(t, "w", "celex", "celex").where(F.col("celex").rlike(f"^3{year}{inter}[0-9]{{4}}$")).select("celex").orderBy("celex")


def changes_of_year(t: DataFrame, change: str, year: int) -> DataFrame:
    """Q5."""
    years = pattern(t, "s", "year", "y").where(F.col("y") == str(year)).select("s")
    edges = pattern(t, "s", f"cdm:resource_legal_{change}_resource_legal", "o").join(years, "s")
    named = edges.join(pattern(t, "s", "celex", "s_celex"), "s").join(pattern(t, "o", "celex", "o_celex").where(F.col("o_celex").rlike(ACT)), "o")
    return named.select("s_celex", "o_celex").distinct()


def consolidation_languages(t: DataFrame, celex: str) -> DataFrame:
    """Q6."""
    own = pattern(t, "w", "celex", "c").where(F.col("c") == celex).select("w")
    return own.join(pattern(t, "w", "consolidated", "date"), "w").join(_expressions(t, "w"), "w").select("date", "lang").distinct()


def consolidations_of_month(t: DataFrame, year: int, month: int) -> DataFrame:
    """Q7."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    found = bgp(t, ("w", "consolidated", "date"), ("w", "celex", "celex")).where(F.col("date").try_cast("date").between(first, F.last_day(first)))
    return found.join(_expressions(t, "w"), "w").select("celex", "date", "lang")


def corrigenda_of(t: DataFrame, celex: str) -> DataFrame:
    """Q8: by the correction of the act, or by an own id that extends the act's."""
    numbered = bgp(t, ("w", "number", "c_num"), ("w", "dated", "date")).join(_expressions(t, "w"), "w")
    base = pattern(t, "base", "celex", "b").where(F.col("b") == celex).select("base")
    by_link = pattern(t, "w", "corrects", "base").join(base, "base").select("w")
    by_id = pattern(t, "w", "celex", "c").where(F.col("c").rlike(f"^{celex}R\\([0-9]{{2}}\\)$")).select("w")
    return numbered.join(by_link.union(by_id).distinct(), "w", "left_semi").select("c_num", "date", "lang").distinct()


def corrigendum_ids(t: DataFrame, year: int, inter: str) -> DataFrame:
    """Q9."""
    return pattern(t, "w", "celex", "celex").where(F.col("celex").rlike(f"^3{year}{inter}[0-9]{{4}}R\\([0-9]{{2}}\\)$")).select("celex")


def statuses(t: DataFrame, year: int, law_type: str, most: int = 5000) -> DataFrame:
    """Q11."""
    acts = pattern(t, "s", "celex", "celex").where(F.col("celex").rlike(f"^3{year}{law_type}[0-9]{{4}}$"))
    return optional(acts, pattern(t, "s", "in_force", "value")).select("celex", "value").orderBy("celex", "value").limit(most)


def consolidation_ids(t: DataFrame, year: int) -> DataFrame:
    """Q12."""
    named = bgp(t, ("w", "celex", "celex"), ("w", "consolidated", "date"))
    return named.where(F.col("celex").rlike(f"^0[0-9]{{4}}[RLDF][0-9]{{4}}-{year}[0-9]{{4}}$")).select("celex").orderBy("celex")


def recent_corrigenda(t: DataFrame, since: str) -> DataFrame:
    """Q13."""
    fixes = bgp(t, ("w", "corrects", "base"), ("base", "celex", "celex")).join(bgp(t, ("w", "number", "number"), ("w", "dated", "date")).where(F.col("date") > since), "w")
    return fixes.join(_expressions(t, "w"), "w").select("celex", "number", "lang").distinct()


def cited_titles(t: DataFrame, celex: str, language: str, inverse: bool = False, most: int = 1000) -> DataFrame:
    """Q14, or Q15 with inverse: acts that the act cites, or that cite it, with their titles."""
    own = pattern(t, "s" if not inverse else "o", "celex", "__c").where(F.col("__c") == celex).drop("__c")
    other = "o" if not inverse else "s"
    named = pattern(t, other, "celex", "celex").where(F.col("celex").rlike(ACT))
    titled = bgp(t, ("e", "of_work", other), ("e", "title", "title")).join(pattern(t, "e", "language", "l").where(F.col("l") == language), "e")
    found = pattern(t, "s", "cites", "o").join(own, own.columns).join(named, other).join(titled, other)
    return found.select("celex", "title").orderBy("celex", "title").limit(most)


def subjects(t: DataFrame, celex: str, language: str) -> DataFrame:
    """Q16."""
    own = pattern(t, "w", "celex", "c").where(F.col("c") == celex).select("w")
    labels = pattern(t, "k", "label", "value", {"lang": "lang"}).where(F.col("lang") == language)
    return own.join(pattern(t, "w", "about", "k"), "w").join(labels, "k").select("value")


def properties(t: DataFrame, celex: str) -> DataFrame:
    """Q17: all predicates and objects of an act but its citations."""
    own = pattern(t, "s", "celex", "c").where(F.col("c") == celex).select("s")
    return t.where(F.col("p") != P["cites"]).join(own, "s", "left_semi").select("p", "o").distinct()


def referrers(t: DataFrame, celex: str, language: str) -> DataFrame:
    """Q18: what points to the act; corrections only in the wanted language. Predicates get the suffix of inverses."""
    own = pattern(t, "w", "celex", "c").where(F.col("c") == celex).select(F.col("w").alias("o"))
    found = t.where(F.col("p") != P["cites"]).join(own, "o", "left_semi").select(F.col("s").alias("value"), "p")
    spoken = found.join(_expressions(t, "value").select("value", "lang"), "value", "left")
    return spoken.where((F.col("p") != P["corrects"]) | (F.col("lang") == language)).select(F.concat("p", F.lit("_by")).alias("p"), "value").distinct()


def titles(t: DataFrame, celex: str, language: str) -> DataFrame:
    """Q19."""
    return titles_for(t, [celex], language).where(F.col("title").isNotNull()).select("title").distinct()


def labels(t: DataFrame, prefix: str, language: str) -> DataFrame:
    """Q20: labels of an authority's concepts."""
    return pattern(t, "resource", "label", "value", {"lang": "lang"}).where(F.col("resource").startswith(prefix) & (F.col("lang") == language)).select("resource", "value")


def titles_for(t: DataFrame, celexes: list[str], language: str) -> DataFrame:
    """Q21."""
    own = pattern(t, "work", "celex", "id_local").where(F.col("id_local").isin(celexes))
    titled = bgp(t, ("e", "of_work", "work"), ("e", "title", "title")).join(pattern(t, "e", "language", "l").where(F.col("l") == language), "e").select("work", "title")
    return optional(own, titled).select("work", "id_local", "title")


def treaty(t: DataFrame, iri: str, language: str, excluded: tuple[str, ...] = (P["treaty"], "owl:annotatedTarget", "cdm:event_legal_based_on_resource_legal"), most: int = 500) -> DataFrame:
    """Q22: outgoing statements in the language or none, and incoming ones but the excluded."""
    out = t.where((F.col("s") == iri) & (F.coalesce("lang", F.lit("")).isin(language, ""))).select("s", "p", "o")
    back = t.where((F.col("o") == iri) & ~F.col("p").isin(*excluded)).select("s", "p", "o")
    return out.union(back).distinct().orderBy("s", "p", "o").limit(most)


def ids_by_suffix(t: DataFrame, suffix: str) -> DataFrame:
    """Q23."""
    return pattern(t, "s", "celex", "celex").where(F.col("celex").rlike(f"^3[0-9]{{4}}[RLDF][0-9]{suffix}$")).select("celex")


def bulk_values(t: DataFrame) -> DataFrame:
    """S6: in-force resources as booleans."""
    value = F.when(F.col("o").endswith("InForce-inForce"), "true").when(F.col("o").endswith("InForce-notInForce"), "false").otherwise(F.col("o"))
    return t.withColumn("o", value)
