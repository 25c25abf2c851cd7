"""The relational registry of acts: upserts, worklists, latest versions, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: States of a representation; null means untouched.
FINAL_FAILURES = ("failed", "repealer", "impossible")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], overwrite: list[str]) -> DataFrame:
    """Merge rows by keys: non-null new values of the overwrite columns win, other columns are set only where missing.

    Several new rows of a key count as one, with the greatest non-null value of each column; where their
    order matters, reduce them first (newest_hits).
    """
    names = [c for c in old.columns if c not in keys]
    new = new.groupBy(*keys).agg(*[F.max(c).alias(c) for c in new.columns if c not in keys])
    fresh = new.select(*keys, *[F.col(c).alias(f"__{c}") if c in new.columns else F.lit(None).cast(dict(old.dtypes)[c]).alias(f"__{c}") for c in names])
    pick = lambda c: F.coalesce(f"__{c}", c) if c in overwrite else F.coalesce(c, f"__{c}")
    return old.join(fresh, keys, "full").select(*keys, *[pick(c).alias(c) for c in names])


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti").dropDuplicates(keys), allowMissingColumns=True)


def merge_hits(hits: DataFrame, key: str = "celex", order: str = "ord", languages: str = "language") -> DataFrame:
    """One row per key: the first hit's values, the languages of all."""
    rest = [c for c in hits.columns if c not in (key, order, languages)]
    return hits.groupBy(key).agg(*[F.min_by(F.struct(c), order)[c].alias(c) for c in rest], F.array_sort(F.collect_set(languages)).alias("languages"))


def newest_hits(hits: DataFrame, key: str = "celex", order: str = "ord", languages: str = "language") -> DataFrame:
    """One row per key: of each column the last value that isn't null, the languages of all."""
    rest = [c for c in hits.columns if c not in (key, order, languages)]
    return hits.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest], F.array_sort(F.collect_set(languages)).alias("languages"))


def register(hits: DataFrame) -> dict[str, DataFrame]:
    """The rows that search hits make: act, version, representation, corrigendum, correpresentation.

    A hit has celex, language, date, in_force, title and url. The id of a consolidated text (0...-date) is a version
    of the act it consolidates, that of a corrigendum (...R(nn)) a corrigendum of the act it corrects; both make a
    bare row of that act where no hit names it. Rows are distinct by their keys.
    """
    correction = r"R\([0-9]{1,2}\)$"
    act = F.when(F.col("celex").startswith("0"), F.concat(F.lit("3"), F.substring("celex", 2, 9))).otherwise(F.regexp_replace("celex", correction, ""))
    kind = F.when(F.col("celex").rlike(r"^0.*-[0-9]{8}$"), "version").when(F.col("celex").rlike(correction), "corrigendum").otherwise("act")
    rows = hits.withColumns({"act": act, "kind": kind})
    named = newest_hits(rows.where("kind = 'act'").select(F.col("act").alias("celex"), "ord", "language", "in_force", "title", "date")).drop("languages").withColumnRenamed("date", "publication_date")
    bare = rows.where("kind <> 'act'").select(F.col("act").alias("celex")).distinct().join(named.select("celex"), "celex", "left_anti")
    acts = named.unionByName(bare, allowMissingColumns=True)
    dated = F.coalesce(F.to_date(F.regexp_extract("celex", r"-([0-9]{8})$", 1), "yyyyMMdd"), F.col("date"))
    versions = rows.where("kind <> 'corrigendum'").select(F.col("act").alias("celex"), F.when(F.col("kind") == "version", dated).otherwise(F.col("date")).alias("date"), "language", "url", "ord")
    corrections = rows.where("kind = 'corrigendum'").select(F.col("celex").alias("corrigendum"), F.col("act").alias("celex"), "date", "language", "url", "ord")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c)
    return {
        "act": acts, "version": versions.select("celex", "date").distinct(), "representation": versions.groupBy("celex", "date", "language").agg(last("url")),
        "corrigendum": corrections.groupBy("corrigendum", "celex").agg(last("date")), "correpresentation": corrections.groupBy("corrigendum", "language").agg(last("url")),
    }


def worklist(representation: DataFrame, acts: DataFrame, language: str, upload: bool, only_enforced: bool = False, day=None, wanted: list[str] | None = None) -> DataFrame:
    """Distinct (celex, date) to process.

    Without upload the untouched ones; with upload those not uploaded whose state is null or not final.
    """
    todo = representation.where(F.col("language") == language)
    if day is not None:
        todo = todo.where(F.col("date") == F.lit(day).cast("date"))
    if wanted is not None:
        todo = todo.where(F.col("celex").isin(wanted))
    if upload:
        todo = todo.where(~F.coalesce("uploaded", F.lit(False)) & (F.col("transformation").isNull() | ~F.col("transformation").isin(*FINAL_FAILURES)))
    else:
        todo = todo.where(F.col("transformation").isNull())
    if only_enforced:
        todo = todo.join(acts.where("in_force").select("celex"), "celex", "left_semi")
    return todo.select("celex", "date").distinct()


def latest_version(representation: DataFrame) -> DataFrame:
    """Per act and language the last date that is no repealer and has an address; unknown values pass."""
    ok = ~F.col("transformation").eqNullSafe("repealer") & ~F.col("url_html").eqNullSafe("")
    return representation.where(ok).groupBy("celex", "language").agg(F.max("date").alias("latest"))


def latest_available(representation: DataFrame) -> DataFrame:
    """Per act and language the last date that was transformed, null where none was."""
    done = F.col("transformation").startswith("success") | (F.col("transformation") == "stubbed")
    return representation.groupBy("celex", "language").agg(F.max(F.when(done, F.col("date"))).alias("latest"))


def all_failed(representation: DataFrame) -> DataFrame:
    return representation.groupBy("celex").agg(F.bool_and(F.col("transformation").eqNullSafe("failed")).alias("all_failed"))


def previous_version(representation: DataFrame) -> DataFrame:
    """For each version of an act the date of the one before it."""
    from pyspark.sql.window import Window

    versions = representation.select("celex", "date").distinct()
    return versions.withColumn("previous", F.lag("date").over(Window.partitionBy("celex").orderBy("date")))


def formex_may_exist(flag: Column, version: Column, published: Column) -> Column:
    """The known flag; else whether the version, or the act, is of 2004 or later."""
    return F.coalesce(flag, (F.year(version) >= 2004) | (F.year(published) >= 2004), F.lit(False))


def formex_default(version: Column) -> Column:
    return F.when((F.year(version) < 2004) & (F.year(version) != 1900), F.lit(False))


def reconcile_in_force(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Remote and local states side by side, with where each act is found and what to write (only remote truths)."""
    both = remote.select("celex", F.col("in_force").alias("remote")).withColumn("__r", F.lit(True)).join(local.select("celex", F.col("in_force").alias("local")).withColumn("__l", F.lit(True)), "celex", "full")
    where = F.when(F.col("__l").isNull(), "remote_only").when(F.col("__r").isNull(), "local_only").otherwise("both")
    return both.select("celex", "remote", "local", where.alias("found"), F.coalesce(F.when(F.col("remote"), F.lit(True)), F.col("local")).alias("in_force"))


def missing_and_superfluous(remote: DataFrame, local: DataFrame, keys: list[str]) -> DataFrame:
    missing = remote.select(*keys).distinct().join(local, keys, "left_anti").withColumn("state", F.lit("missing"))
    return missing.unionByName(local.select(*keys).distinct().join(remote, keys, "left_anti").withColumn("state", F.lit("superfluous")))


def deforce_repealed(acts: DataFrame, changes: DataFrame) -> DataFrame:
    """in_force becomes false for acts that another one repeals."""
    gone = changes.where("change = 'repeals'").select(F.col("changee").alias("celex")).distinct().withColumn("__gone", F.lit(True))
    return acts.join(gone, "celex", "left").withColumn("in_force", F.when(F.col("__gone"), F.lit(False)).otherwise(F.col("in_force"))).drop("__gone")


def remove_transformed(representation: DataFrame, wanted: DataFrame) -> DataFrame:
    """State and upload mark of the wanted (celex, date, language) are reset."""
    keys = ["celex", "date", "language"]
    marked = representation.join(wanted.select(*keys).distinct().withColumn("__w", F.lit(True)), keys, "left")
    reset = lambda c, v: F.when(F.col("__w"), v).otherwise(F.col(c)).alias(c)
    return marked.select(*[reset(c, F.lit(None)) if c == "transformation" else reset(c, F.lit(False)) if c == "uploaded" else F.col(c) for c in representation.columns])


def set_nonexistent(representation: DataFrame, wanted: DataFrame, fmt: str) -> DataFrame:
    """A format that was looked up and is absent: '' as address, or false for formex."""
    column, value = ("formex_available", F.lit(False)) if fmt == "fmx" else (f"url_{fmt}", F.lit(""))
    keys = ["celex", "date", "language"]
    marked = representation.join(wanted.select(*keys).distinct().withColumn("__w", F.lit(True)), keys, "left")
    return marked.withColumn(column, F.when(F.col("__w"), value).otherwise(F.col(column))).drop("__w")


def lookup(facts: DataFrame, dim: DataFrame, key: str, language: Column, value: str, fallback: str = "EN") -> DataFrame:
    """The dimension's value in a language, else in the fallback language."""
    side = lambda n: dim.select(F.col(key), F.col("language").alias(f"__l{n}"), F.col(value).alias(f"__v{n}"))
    own = facts.withColumn("__lang", language)
    own = own.join(side(1).withColumnsRenamed({key: "__k1"}), (F.col(key) == F.col("__k1")) & (F.col("__lang") == F.col("__l1")), "left")
    own = own.join(side(2).where(F.col("__l2") == fallback).withColumnsRenamed({key: "__k2"}), F.col(key) == F.col("__k2"), "left")
    return own.select(*facts.columns, F.coalesce("__v1", "__v2").alias(value))


def skeleton_missing(references: DataFrame, skeleton: DataFrame) -> DataFrame:
    """References whose target (celex, id) isn't in the skeleton."""
    return references.join(skeleton.select("celex", "id"), ["celex", "id"], "left_anti")


def new_skeleton_ids(ids: DataFrame, skeleton: DataFrame, longest: int = 50) -> DataFrame:
    """Ids to insert: up to the longest length, and '' for each document."""
    whole = ids.select("celex").distinct().withColumn("id", F.lit(""))
    found = ids.where(F.length("id") <= longest).select("celex", "id").union(whole).distinct()
    return found.join(skeleton.select("celex", "id"), ["celex", "id"], "left_anti")
