"""Metadata records of acts: pivot of statements, joins, cleansing and RDFa rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Attributes by predicate, and which of them hold many values.
ATTRIBUTES = {
    "cdm:resource_legal_id_celex": ("id_local", False), "cdm:resource_legal_in-force": ("in_force", False), "cdm:work_date_creation_legacy": ("date_publication", False), "cdm:work_date_document": ("date_document", False),
    "cdm:work_is_about_concept_eurovoc": ("is_about", True), "cdm:work_cites_work": ("cites", True), "cdm:resource_legal_amends_resource_legal": ("amends", True), "cdm:resource_legal_corrects_resource_legal": ("corrects", True),
    "cdm:resource_legal_based_on_concept_treaty": ("based_on", False),
}
RELATIONS = ("amends", "amended_by", "cites", "cited_by", "completes", "completed_by", "corrects", "corrected_by", "repeals", "repealed_by")


def records(triples: DataFrame) -> DataFrame:
    """One row per subject: the last value of single attributes by order of value, the distinct values of multiple ones."""
    named = triples.where(F.col("p").isin(*ATTRIBUTES))
    columns = []
    for p, (name, many) in ATTRIBUTES.items():
        value = F.when(F.col("p") == p, F.col("o"))
        columns.append((F.array_sort(F.collect_set(value)) if many else F.max(value)).alias(name))
    return named.groupBy("s").agg(*columns)


def join_records(a: DataFrame, b: DataFrame, key: str, single: list[str], many: list[str]) -> DataFrame:
    """Two records of a key as one: sets are united, a missing value is filled, contradictions are listed in conflicts."""
    right = b.select(key, *[F.col(c).alias(f"__{c}") for c in (*single, *many)])
    both = a.select(key, *single, *many).join(right, key, "full")
    clash = F.array_compact(F.array(*[F.when(F.col(c) != F.col(f"__{c}"), c) for c in single]))
    union = lambda c: F.array_sort(F.array_union(F.coalesce(c, F.array().cast("array<string>")), F.coalesce(f"__{c}", F.array().cast("array<string>"))))
    return both.select(key, *[F.coalesce(c, f"__{c}").alias(c) for c in single], *[union(c).alias(c) for c in many], clash.alias("conflicts"))


def without(values: Column, *others: Column) -> Column:
    """values less all that the others hold."""
    for o in others:
        values = F.array_except(values, F.coalesce(o, F.array().cast("array<string>")))
    return values


def cleanse(acts: DataFrame, key: str, relations: tuple[str, ...]) -> DataFrame:
    """No relation to the act itself; citations only of acts in no other relation; repealed acts aren't in force."""
    own = F.array(F.concat(F.lit("/eu/"), F.col(key), F.lit("/")))
    out = acts.withColumns({r: without(F.col(r), own) for r in relations})
    others = [F.col(r) for r in relations if r not in ("cites", "cited_by")]
    out = out.withColumns({r: without(F.col(r), *others) for r in ("cites", "cited_by") if r in relations})
    if "repealed_by" in relations and "in_force" in acts.columns:
        out = out.withColumn("in_force", F.when(F.size("repealed_by") > 0, F.lit(False)).otherwise(F.col("in_force")))
    return out


def first_entry(dates: Column) -> Column:
    """The first date of entry into force, without the placeholders of 1945 and before."""
    return F.array_min(F.filter(dates, lambda d: d > F.lit("1945-01-01").cast("date")))


def plausible(d: Column) -> Column:
    return F.when(F.year(d) >= 1950, d)


def end_of_validity(d: Column, in_force: Column, today: Column) -> tuple[Column, Column]:
    """No date for 9999-12-31; acts whose date has passed aren't in force."""
    end = F.when(d != F.lit("9999-12-31").cast("date"), d)
    return end, F.when(end < today, F.lit(False)).otherwise(in_force)


def _described(values: Column, name: str, datatype: str | None) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(name).alias("property"), v.alias("value"), F.lit(datatype).cast("string").alias("datatype")))


def rdfa(acts: DataFrame, key: str, prefix: str, columns: list[str]) -> DataFrame:
    """(key, property, content, resource, datatype), distinct: one row for each value; addresses are resources."""
    kinds = dict(acts.dtypes)
    each = []
    for c in columns:
        kind = kinds[c].removeprefix("array<").removesuffix(">")
        datatype = {"date": "xsd:date", "int": "xsd:integer", "bigint": "xsd:integer", "boolean": "xsd:boolean"}.get(kind)
        values = F.transform(F.col(c), lambda v: v.cast("string")) if kinds[c].startswith("array") else F.array(F.col(c).cast("string"))
        each.append(_described(values, f"{prefix}:{c}", datatype))
    rows = acts.select(key, F.explode(F.flatten(F.array(*each))).alias("m")).select(key, "m.*").where(F.col("value").isNotNull())
    link = F.col("value").rlike("^(https?://|/eu/)") & F.col("datatype").isNull()
    return rows.select(key, "property", F.when(~link, F.col("value")).alias("content"), F.when(link, F.col("value")).alias("resource"), "datatype").distinct()


def from_rdfa(metas: DataFrame, key: str, single: list[str], many: list[str], prefix: str) -> DataFrame:
    """The records that rdfa() came from, as strings."""
    value = F.coalesce("content", "resource")
    of = lambda c: F.when(F.col("property") == f"{prefix}:{c}", value)
    return metas.groupBy(key).agg(*[F.max(of(c)).alias(c) for c in single], *[F.array_sort(F.collect_set(of(c))).alias(c) for c in many])
