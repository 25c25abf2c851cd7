"""The registered queries of the registry, the triples and the text functions, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.functions import ids, text, titles
from quillon.operators import documents as D, formulas as X, lookups as L, metadata as M, registry as R, sequences as S, triples as T
from quillon.plans.views import sql_of, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **views: str):
    """Register a function of the named views; {view} in the SQL stands for their text."""

    def put(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(**{k: view(spark, sf_dir, v) for k, v in views.items()}) if views else f(spark, sf_dir)
        if sql is not None:
            full = sql
            for v in {w for w in ["ids", "acts", "representation", "changes", "remote", "local", "hits", "triples", "dims", "labels", "lines"] if "{" + w + "}" in sql}:
                full = full.replace("{" + v + "}", f"({sql_of(v)})")
            ORACLES[name] = full
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# identifiers and dates


@query("celex_parse", "SELECT k, celex, cast(substr(celex, 1, 1) AS int) AS pre, cast(substr(celex, 2, 4) AS int) AS year, substr(celex, 6, 1) AS inter, cast(substr(celex, 7) AS int) AS number, 'REG' = CASE substr(celex, 6, 1) WHEN 'R' THEN 'REG' ELSE 'x' END AS regulation FROM {ids} i", i="ids")
def _(i):
    b = ids.celex_base(F.col("celex"))
    return i.select("k", "celex", b["pre"].alias("pre"), b["year"].alias("year"), b["inter"].alias("inter"), b["number"].alias("number"), F.coalesce(ids.type_code(F.col("celex")) == "REG", F.lit(False)).alias("regulation"))


_COMPOUND = "CASE k % 4 WHEN 0 THEN celex || 'R(0' || cast(k % 9 + 1 AS string) || ')' WHEN 1 THEN '0' || substr(celex, 2) || '-' || replace(cast(day AS string), '-', '') WHEN 2 THEN celex || '/TXT' ELSE celex END"


@query(
    "celex_compound",
    f"""SELECT k, CASE WHEN k % 4 = 2 THEN NULL ELSE celex END AS base, CASE k % 4 WHEN 0 THEN 'corrigendum' WHEN 1 THEN 'consolidated' WHEN 3 THEN 'act' END AS kind,
    CASE WHEN k % 4 = 1 THEN day END AS version, CASE WHEN k % 4 = 0 THEN cast(k % 9 + 1 AS int) END AS corrigendum, CASE WHEN k % 4 <> 2 THEN {_COMPOUND} END AS rendered FROM {{ids}} i""",
    i="ids",
)
def _(i):
    c = ids.celex_compound(F.expr(_COMPOUND))
    rendered = ids.render_compound(c["base"], c["version"], c["corrigendum"])
    return i.select("k", c["base"].alias("base"), c["kind"].alias("kind"), c["version"].alias("version"), c["corrigendum"].alias("corrigendum"), rendered.alias("rendered"))


@query("celex_path", "SELECT k, '3/' || substr(celex, 2, 4) || '/' || substr(celex, 6, 1) || '/' || substr(celex, 7) || '/' AS path FROM {ids} i", i="ids")
def _(i):
    return i.select("k", ids.celex_path(F.col("celex")).alias("path"))


@query("celex_wildcard", "SELECT k, CASE k % 3 WHEN 0 THEN '3*' || substr(celex, 6) WHEN 1 THEN substr(celex, 1, 6) || '*' ELSE '3' || substr(celex, 2, 4) || '*' END AS pattern FROM {ids} i", i="ids")
def _(i):
    b, kind = ids.celex_base(F.col("celex")), F.col("k") % 3
    return i.select("k", ids.celex_wildcard(b["pre"], F.when(kind != 0, b["year"]), F.when(kind != 2, b["inter"]), F.when(kind == 0, b["number"])).alias("pattern"))


@query("version_create", "SELECT k, CASE k % 3 WHEN 0 THEN DATE '1900-01-01' WHEN 1 THEN day END AS version, CASE k % 3 WHEN 0 THEN 'initial' WHEN 1 THEN replace(cast(day AS string), '-', '') END AS name FROM {ids} i", i="ids")
def _(i):
    v = ids.version_date(F.expr("CASE k % 3 WHEN 0 THEN 'initial' WHEN 1 THEN replace(cast(day AS string), '-', '') ELSE 'latest' END"))
    return i.select("k", v.alias("version"), ids.version_name(v).alias("name"))


@query("month_bounds", "SELECT k, cast(date_trunc('month', day) AS date) AS first, last_day(day) AS ultimo, cast(date_trunc('month', day) - INTERVAL 1 MONTH AS date) AS previous, cast(date_trunc('month', day) + INTERVAL 1 MONTH AS date) AS next FROM {ids} i", i="ids")
def _(i):
    return i.select("k", ids.month_bounds(F.col("day")).alias("m")).select("k", "m.*")


@query("url_from_celex", "SELECT k, 'https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:' || celex AS url, celex AS back, '/eu/' || celex || '/ART_' || cast(k % 9 AS string) || '/' || CASE k % 2 WHEN 1 THEN '#2-a' ELSE '' END AS path FROM {ids} i", i="ids")
def _(i):
    url = ids.url_from_celex(F.col("celex"), F.lit("EN"))
    node = F.expr("'ART_' || cast(k % 9 AS string) || CASE k % 2 WHEN 1 THEN '-2-a' ELSE '' END")
    return i.select("k", url.alias("url"), ids.href_to_celex(url).alias("back"), ids.id_to_path(F.col("celex"), node).alias("path"))


# registry


@query("worklist", "SELECT DISTINCT celex, date FROM {representation} r WHERE language = 'EN' AND transformation IS NULL", r="representation")
def _(r):
    return R.worklist(r, None, "EN", upload=False)


@query("worklist_upload", "SELECT DISTINCT celex, date FROM {representation} r WHERE language = 'DE' AND NOT coalesce(uploaded, false) AND (transformation IS NULL OR transformation NOT IN ('failed', 'repealer', 'impossible')) AND celex IN (SELECT celex FROM {acts} a WHERE in_force)", r="representation", a="acts")
def _(r, a):
    return R.worklist(r, a, "DE", upload=True, only_enforced=True)


@query("only_enforced_join", "SELECT r.celex, r.date, r.language, a.publication_date FROM {representation} r JOIN {acts} a ON a.celex = r.celex WHERE a.in_force", r="representation", a="acts")
def _(r, a):
    return r.join(a.where("in_force"), "celex").select("celex", "date", "language", "publication_date")


@query("latest_version", "SELECT celex, language, max(date) AS latest FROM {representation} r WHERE transformation IS DISTINCT FROM 'repealer' AND url_html IS DISTINCT FROM '' GROUP BY 1, 2", r="representation")
def _(r):
    return R.latest_version(r)


@query("latest_available", "SELECT celex, language, max(date) FILTER (transformation LIKE 'success%' OR transformation = 'stubbed') AS latest FROM {representation} r GROUP BY 1, 2", r="representation")
def _(r):
    return R.latest_available(r)


@query("all_failed", "SELECT celex, bool_and(transformation IS NOT DISTINCT FROM 'failed') AS all_failed FROM {representation} r GROUP BY 1", r="representation")
def _(r):
    return R.all_failed(r)


@query("previous_version", "SELECT celex, date, lag(date) OVER (PARTITION BY celex ORDER BY date) AS previous FROM (SELECT DISTINCT celex, date FROM {representation} r) v", r="representation")
def _(r):
    return R.previous_version(r)


@query("formex_may_exist", "SELECT k, coalesce(in_force, year(day) >= 1996 OR year(day) >= 2004) AS may, CASE WHEN year(day) < 2004 AND year(day) <> 1900 THEN false END AS standard FROM {ids} i", i="ids")
def _(i):
    return i.select("k", R.formex_may_exist(F.col("in_force"), F.add_months("day", 12 * 8), F.col("day")).alias("may"), R.formex_default(F.col("day")).alias("standard"))


@query("upsert_registry", "SELECT coalesce(l.celex, r.celex) AS celex, coalesce(r.in_force, l.in_force) AS in_force, l.publication_date FROM (SELECT * FROM {acts} a WHERE substr(celex, 9, 1) <> '7') l FULL JOIN {remote} r ON l.celex = r.celex", a="acts", remote="remote")
def _(a, remote):
    return R.upsert(a.where("substr(celex, 9, 1) <> '7'"), remote, ["celex"], ["in_force"])


@query("insert_missing", "SELECT celex, in_force FROM {local} l UNION ALL SELECT celex, in_force FROM {remote} r WHERE celex NOT IN (SELECT celex FROM {local} m)", a="local", remote="remote")
def _(a, remote):
    return R.insert_missing(a, remote, ["celex"])


@query("merge_hits", "SELECT celex, min_by(seen, ord) AS seen, array_to_string(list_sort(list(DISTINCT language)), ',') AS languages FROM {hits} h GROUP BY celex", h="hits")
def _(h):
    return R.merge_hits(h).withColumn("languages", F.array_join("languages", ","))


@query("in_force_reconcile", "SELECT coalesce(r.celex, l.celex) AS celex, r.in_force AS remote, l.in_force AS local, CASE WHEN l.celex IS NULL THEN 'remote_only' WHEN r.celex IS NULL THEN 'local_only' ELSE 'both' END AS found, CASE WHEN r.in_force THEN true ELSE l.in_force END AS in_force FROM {remote} r FULL JOIN {local} l ON r.celex = l.celex", remote="remote", local="local")
def _(remote, local):
    return R.reconcile_in_force(remote, local)


@query("missing_superfluous", "SELECT celex, 'missing' AS state FROM {remote} r WHERE celex NOT IN (SELECT celex FROM {local} l) UNION ALL SELECT celex, 'superfluous' FROM {local} l WHERE celex NOT IN (SELECT celex FROM {remote} r)", remote="remote", local="local")
def _(remote, local):
    return R.missing_and_superfluous(remote, local, ["celex"])


@query("deforce_repealed", "SELECT celex, publication_date, CASE WHEN celex IN (SELECT changee FROM {changes} c WHERE change = 'repeals') THEN false ELSE in_force END AS in_force FROM {acts} a", acts="acts", changes="changes")
def _(acts, changes):
    return R.deforce_repealed(acts, changes)


@query("cross_year_type", "SELECT '3' || cast(y.year AS string) || t.inter || n.number AS celex FROM (SELECT DISTINCT year(day) AS year FROM {ids} i) y CROSS JOIN (SELECT unnest(['R', 'L', 'D', 'F']) AS inter) t CROSS JOIN (SELECT lpad(cast(unnest(range(1, 21)) AS string), 4, '0') AS number) n", i="ids")
def _(i):
    spark = i.sparkSession
    return ids.expand(i.select(F.year("day").alias("year")).distinct(), spark.createDataFrame([(x,) for x in "RLDF"], "inter string"), spark.range(1, 21).select(F.col("id").cast("int").alias("number")))


@query("dim_lookup", "SELECT i.k, coalesce(d.label, e.label) AS label FROM (SELECT k, cast(custkey % 25 AS string) AS code, CASE k % 2 WHEN 0 THEN 'DE' ELSE 'ES' END AS l FROM {ids} j) i LEFT JOIN {dims} d ON d.code = i.code AND d.language = i.l LEFT JOIN {dims} e ON e.code = i.code AND e.language = 'EN'", i="ids", d="dims")
def _(i, d):
    facts = i.select("k", F.expr("cast(custkey % 25 AS string)").alias("code"))
    return R.lookup(facts, d, "code", F.expr("CASE k % 2 WHEN 0 THEN 'DE' ELSE 'ES' END"), "label").select("k", "label")


@query("remove_transformed", "SELECT celex, date, language, CASE WHEN language = 'EN' THEN NULL ELSE transformation END AS transformation, CASE WHEN language = 'EN' THEN false ELSE uploaded END AS uploaded, url_html FROM {representation} r", r="representation")
def _(r):
    return R.remove_transformed(r, r.where("language = 'EN'"))


@query("set_nonexistent", "SELECT celex, date, language, CASE WHEN transformation = 'failed' THEN '' ELSE url_html END AS url_html FROM {representation} r", r="representation")
def _(r):
    return R.set_nonexistent(r, r.where("transformation = 'failed'"), "html").select("celex", "date", "language", "url_html")


@query("like_filter", "SELECT celex FROM {acts} a WHERE celex LIKE '3____R____'", a="acts")
def _(a):
    return a.where(F.col("celex").like("3____R____")).select("celex")


# triples

_E = "JOIN {triples} be ON be.p = 'cdm:expression_belongs_to_work' AND be.o = w.s JOIN {triples} la ON la.p = 'cdm:expression_uses_language' AND la.s = be.s"
_W = "{triples} w"


@query("bgp_optional", f"SELECT w.o AS celex, f.o AS in_force, d.o AS date, la.o AS lang FROM {_W} JOIN {{triples}} d ON d.s = w.s AND d.p = 'cdm:work_date_creation_legacy' {_E} LEFT JOIN {{triples}} f ON f.s = w.s AND f.p = 'cdm:resource_legal_in-force' WHERE w.p = 'cdm:resource_legal_id_celex' AND regexp_matches(w.o, '^31995R[0-9]{{4}}$') AND d.o BETWEEN '1995-03-01' AND '1995-03-31'", t="triples")
def _(t):
    return T.acts_of_month(t, 1995, 3, "R")


@query("bgp_union_distinct", f"SELECT DISTINCT w.o AS c_num, d.o AS date, la.o AS lang FROM {_W} JOIN {{triples}} d ON d.s = w.s AND d.p = 'cdm:work_date_document' {_E} WHERE w.p = 'cdm:resource_legal_number_corrigendum' AND (w.s IN (SELECT s FROM {{triples}} x WHERE p = 'cdm:resource_legal_corrects_resource_legal' AND o IN (SELECT s FROM {{triples}} y WHERE p = 'cdm:resource_legal_id_celex' AND o = (SELECT celex FROM {{ids}} i WHERE k = 160))) OR w.s IN (SELECT s FROM {{triples}} z WHERE p = 'cdm:resource_legal_id_celex' AND o = (SELECT celex FROM {{ids}} i WHERE k = 160) || 'R(01)'))", t="triples", i="ids")
def _(t, i):
    return T.corrigenda_of(t, i.where("k = 160").select("celex").first()[0])


@query("consolidations_of", f"SELECT DISTINCT w.o AS c_celex, d.o AS date, la.o AS lang FROM {_W} JOIN {{triples}} d ON d.s = w.s AND d.p = 'cdm:act_consolidated_date' {_E} JOIN {{triples}} b ON b.s = w.s AND b.p = 'cdm:act_consolidated_based_on_resource_legal' JOIN {{triples}} c ON c.s = b.o AND c.p = 'cdm:resource_legal_id_celex' WHERE w.p = 'cdm:resource_legal_id_celex' AND c.o = (SELECT celex FROM {{ids}} i WHERE k = 7)", t="triples", i="ids")
def _(t, i):
    return T.consolidations_of(t, i.where("k = 7").select("celex").first()[0])


@query("consolidations_of_month", f"SELECT w.o AS celex, d.o AS date, la.o AS lang FROM {_W} JOIN {{triples}} d ON d.s = w.s AND d.p = 'cdm:act_consolidated_date' {_E} WHERE w.p = 'cdm:resource_legal_id_celex' AND d.o BETWEEN '1996-05-01' AND '1996-05-31'", t="triples")
def _(t):
    return T.consolidations_of_month(t, 1996, 5)


@query("consolidation_languages", f"SELECT DISTINCT d.o AS date, la.o AS lang FROM {_W} JOIN {{triples}} d ON d.s = w.s AND d.p = 'cdm:act_consolidated_date' {_E} WHERE w.p = 'cdm:resource_legal_id_celex' AND w.o = (SELECT '0' || substr(celex, 2) || '-' || replace(cast(day AS string), '-', '') FROM {{ids}} i WHERE k = 70)", t="triples", i="ids")
def _(t, i):
    return T.consolidation_languages(t, i.where("k = 70").select(F.expr("'0' || substr(celex, 2) || '-' || replace(cast(day AS string), '-', '')")).first()[0])


@query("consolidation_ids", "SELECT o AS celex FROM {triples} w WHERE p = 'cdm:resource_legal_id_celex' AND regexp_matches(o, '^0[0-9]{4}[RLDF][0-9]{4}-1995[0-9]{4}$')", t="triples")
def _(t):
    return T.consolidation_ids(t, 1995)


@query("in_force_of", "SELECT f.o AS value FROM {triples} w JOIN {triples} f ON f.s = w.s AND f.p = 'cdm:resource_legal_in-force' WHERE w.p = 'cdm:resource_legal_id_celex' AND w.o = (SELECT celex FROM {ids} i WHERE k = 7)", t="triples", i="ids")
def _(t, i):
    return T.in_force_of(t, i.where("k = 7").select("celex").first()[0])


@query("celexes_of_year", "SELECT o AS celex FROM {triples} w WHERE p = 'cdm:resource_legal_id_celex' AND regexp_matches(o, '^31996L[0-9]{4}$')", t="triples")
def _(t):
    return T.celexes_of(t, 1996, "L")


@query("statuses", "SELECT w.o AS celex, f.o AS value FROM {triples} w LEFT JOIN {triples} f ON f.s = w.s AND f.p = 'cdm:resource_legal_in-force' WHERE w.p = 'cdm:resource_legal_id_celex' AND regexp_matches(w.o, '^31996R[0-9]{4}$') ORDER BY 1, 2 NULLS FIRST LIMIT 5000", t="triples")
def _(t):
    return T.statuses(t, 1996, "R")


@query("changes_of_year", "SELECT DISTINCT a.o AS s_celex, b.o AS o_celex FROM {triples} c JOIN {triples} y ON y.s = c.s AND y.p = 'cdm:resource_legal_year' AND y.o = '1997' JOIN {triples} a ON a.s = c.s AND a.p = 'cdm:resource_legal_id_celex' JOIN {triples} b ON b.s = c.o AND b.p = 'cdm:resource_legal_id_celex' WHERE c.p = 'cdm:resource_legal_amends_resource_legal' AND regexp_matches(b.o, '^3[0-9]{4}[RLDF][0-9]{4}$')", t="triples")
def _(t):
    return T.changes_of_year(t, "amends", 1997)


@query("corrigendum_ids", "SELECT o AS celex FROM {triples} w WHERE p = 'cdm:resource_legal_id_celex' AND regexp_matches(o, '^31995R[0-9]{4}R\\([0-9]{2}\\)$')", t="triples")
def _(t):
    return T.corrigendum_ids(t, 1995, "R")


@query("recent_corrigenda", f"SELECT DISTINCT c.o AS celex, n.o AS number, la.o AS lang FROM {_W} JOIN {{triples}} c ON c.s = w.o AND c.p = 'cdm:resource_legal_id_celex' JOIN {{triples}} n ON n.s = w.s AND n.p = 'cdm:resource_legal_number_corrigendum' JOIN {{triples}} d ON d.s = w.s AND d.p = 'cdm:work_date_document' {_E} WHERE w.p = 'cdm:resource_legal_corrects_resource_legal' AND d.o > '1998-01-01'", t="triples")
def _(t):
    return T.recent_corrigenda(t, "1998-01-01")


_CITED = "SELECT n.o AS celex, ti.o AS title FROM {triples} c JOIN {triples} x ON x.s = c.%s AND x.p = 'cdm:resource_legal_id_celex' JOIN {triples} n ON n.s = c.%s AND n.p = 'cdm:resource_legal_id_celex' JOIN {triples} be ON be.p = 'cdm:expression_belongs_to_work' AND be.o = c.%s JOIN {triples} la ON la.s = be.s AND la.p = 'cdm:expression_uses_language' AND la.o = 'EN' JOIN {triples} ti ON ti.s = be.s AND ti.p = 'cdm:expression_title' WHERE c.p = 'cdm:work_cites_work' AND x.o = (SELECT celex FROM {ids} i WHERE k = %d) AND regexp_matches(n.o, '^3[0-9]{4}[RLDF][0-9]{4}$') ORDER BY 1, 2 LIMIT 1000"


@query("cited_titles", _CITED % ("s", "o", "o", 32), t="triples", i="ids")
def _(t, i):
    return T.cited_titles(t, i.where("k = 32").select("celex").first()[0], "EN")


@query("citing_titles", _CITED % ("o", "s", "s", 100), t="triples", i="ids")
def _(t, i):
    return T.cited_titles(t, i.where("k = 100").select("celex").first()[0], "EN", inverse=True)


@query("subjects", "SELECT v.o AS value FROM {triples} c JOIN {triples} a ON a.s = c.s AND a.p = 'cdm:work_is_about_concept_eurovoc' JOIN {triples} v ON v.s = a.o AND v.p = 'skos:prefLabel' AND v.lang = 'en' WHERE c.p = 'cdm:resource_legal_id_celex' AND c.o = (SELECT celex FROM {ids} i WHERE k = 100)", t="triples", i="ids")
def _(t, i):
    return T.subjects(t, i.where("k = 100").select("celex").first()[0], "en")


@query("predicate_object", "SELECT DISTINCT p, o FROM {triples} t WHERE p <> 'cdm:work_cites_work' AND s IN (SELECT s FROM {triples} u WHERE p = 'cdm:resource_legal_id_celex' AND o = (SELECT celex FROM {ids} i WHERE k = 100))", t="triples", i="ids")
def _(t, i):
    return T.properties(t, i.where("k = 100").select("celex").first()[0])


@query("subject_predicate_lang", "SELECT DISTINCT t.p || '_by' AS p, t.s AS value FROM {triples} t LEFT JOIN {triples} be ON be.p = 'cdm:expression_belongs_to_work' AND be.o = t.s LEFT JOIN {triples} la ON la.s = be.s AND la.p = 'cdm:expression_uses_language' WHERE t.p <> 'cdm:work_cites_work' AND t.o IN (SELECT s FROM {triples} u WHERE p = 'cdm:resource_legal_id_celex' AND o = (SELECT celex FROM {ids} i WHERE k = 100)) AND (t.p <> 'cdm:resource_legal_corrects_resource_legal' OR la.o = 'EN')", t="triples", i="ids")
def _(t, i):
    return T.referrers(t, i.where("k = 100").select("celex").first()[0], "EN")


@query("title_of", "SELECT DISTINCT 'Title ' || celex || ' EN' AS title FROM {ids} i WHERE celex = (SELECT celex FROM {ids} j WHERE k = 100) AND k % 3 <> 0", t="triples", i="ids")
def _(t, i):
    return T.titles(t, i.where("k = 100").select("celex").first()[0], "EN")


@query("titles_for", "SELECT 'w' || cast(k AS string) AS work, celex AS id_local, CASE WHEN k % 3 <> 0 THEN 'Title ' || celex || ' EN' END AS title FROM {ids} i WHERE celex IN (SELECT celex FROM {ids} j WHERE k IN (7, 32, 33, 34, 100))", t="triples", i="ids")
def _(t, i):
    return T.titles_for(t, [r[0] for r in i.where("k IN (7, 32, 33, 34, 100)").select("celex").collect()], "EN")


@query("authority_labels", "SELECT s AS resource, o AS value FROM {triples} t WHERE p = 'skos:prefLabel' AND s LIKE 'concept/%' AND lang = 'de'", t="triples")
def _(t):
    return T.labels(t, "concept/", "de")


@query("treaty_union_limit", "SELECT * FROM (SELECT s, p, o FROM {triples} t WHERE s = 'treaty/1' AND (lang = 'en' OR lang IS NULL) UNION SELECT s, p, o FROM {triples} t WHERE o = 'treaty/1' AND p NOT IN ('cdm:resource_legal_based_on_concept_treaty', 'owl:annotatedTarget', 'cdm:event_legal_based_on_resource_legal')) ORDER BY s, p, o LIMIT 500", t="triples")
def _(t):
    return T.treaty(t, "treaty/1", "en")


@query("ids_by_suffix", "SELECT o AS celex FROM {triples} t WHERE p = 'cdm:resource_legal_id_celex' AND regexp_matches(o, '^3[0-9]{4}[RLDF][0-9]042$')", t="triples")
def _(t):
    return T.ids_by_suffix(t, "042")


@query("fallback_first_nonempty", "SELECT s, o FROM {triples} t WHERE p = 'skos:prefLabel' AND lang = 'de'", t="triples")
def _(t):
    wanted = t.where("p = 'skos:prefLabel'").select("s", "o", "lang")
    return T.first_nonempty(wanted.where("lang = 'fr'"), wanted.where("lang = 'de'"), wanted.where("lang = 'en'")).select("s", "o")


# text


@query("blank_collapse", r"SELECT doc_id, sha256(regexp_replace(text, '\s+', ' ', 'g')) AS folded, coalesce(trim(text), '') = '' AS negligible FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.blanks(F.col("text")), 256).alias("folded"), text.negligible(F.col("text")).alias("negligible"))


@query("strip_tags", "SELECT page_id, sha256(trim(regexp_replace(html, '<[^>]*>', '', 'g'))) AS stripped FROM pages")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(text.strip_tags(F.col("html")), 256).alias("stripped"))


@query("ordinal_fix", "SELECT doc_id, chr(8470) || ' ' || cast(doc_id AS string) AS fixed FROM documents")
def _(spark, sf_dir):
    made = F.concat(F.lit("n.º "), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", text.spanish_ordinal(made).alias("fixed"))


@query("quotation_count", r"""SELECT doc_id, doc_id % 4 AS quotes FROM documents""")
def _(spark, sf_dir):
    one = F.array(F.lit(' "alpha beta" '), F.lit(" ‘gamma’, "), F.lit(" „delta“. "))
    made = F.array_join(F.slice(one, F.lit(1), (F.col("doc_id") % 4).cast("int")), "x")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(text.quotations(text.standard_quotes(made))).cast("long").alias("quotes"))


@query("term_validity", r"""SELECT doc_id, regexp_matches(split_part(text, chr(10), 1), '^[\p{L}0-9 ,''()/&-]{1,200}$') AND NOT regexp_matches(split_part(text, chr(10), 1), '^[0-9]+$') AND NOT regexp_matches(split_part(text, chr(10), 1), '^[a-z]$') AS valid FROM documents""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.valid_term(F.split_part(F.col("text"), F.lit("\n"), F.lit(1))).alias("valid"))


@query("heading_score", r"""SELECT doc_id, CASE WHEN t = '' OR regexp_matches(t, '[.,:;]$') OR regexp_matches(t, '^\([0-9a-z]{1,3}\)') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / len(regexp_split_to_array(t, '\s+')) * CASE WHEN upper(t) = t THEN 4 ELSE 1 END END AS score FROM (SELECT doc_id, trim(substr(split_part(text, chr(10), 1), 1, 40)) AS t FROM documents)""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.heading_score(F.substr(F.split_part(F.col("text"), F.lit("\n"), F.lit(1)), F.lit(1), F.lit(40))).alias("score"))


@query("heading_score_lines", r"""SELECT doc_id, cast(pos - 1 AS int) AS pos, CASE WHEN t = '' OR regexp_matches(t, '[.,:;]$') OR regexp_matches(t, '^\([0-9a-z]{1,3}\)') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / len(regexp_split_to_array(t, '\s+')) * CASE WHEN upper(t) = t THEN 4 ELSE 1 END END AS score FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, trim(unnest(string_split(text, chr(10)))) AS t FROM documents)""")
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", "pos", text.heading_score(F.col("line")).alias("score"))


@query("label_candidates", r"""SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(label, '^[1-9][0-9]{0,3}\.') THEN 'nump' END,
    CASE WHEN regexp_matches(label, '^[0-9]{1,3}\.?($|[^0-9/();. ])') OR regexp_matches(label, '^[0-9]{1,3}\.? ($|[^o])') OR regexp_matches(label, '^[0-9]{1,3}\.? o($|[^f])') THEN 'numpt' END,
    CASE WHEN regexp_matches(label, '^\([0-9]{1,3}\)') THEN 'numbr' END, CASE WHEN regexp_matches(label, '^\([a-z]\)') THEN 'alpha' END,
    CASE WHEN regexp_matches(label, '^\([ivxl]+\)') THEN 'roman' END, CASE WHEN starts_with(label, chr(8212)) THEN 'dash' END) AS tags FROM {labels} l""", labels="labels")
def _(labels):
    return labels.select("doc_id", F.array_join(text.label_candidates(F.col("label"), "en"), ",").alias("tags"))


@query("json_roundtrip", "SELECT event_id, cast(json_extract(props, '$.k') AS int) AS k, '{\"k\":' || cast(json_extract(props, '$.k') AS string) || '}' AS json FROM events")
def _(spark, sf_dir):
    parsed = F.from_json("props", "k int")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"), F.to_json(parsed).alias("json"))


@query("data_uri", "SELECT page_id, 'data:image/png;base64, ' || base64(encode(url)) AS uri FROM pages")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", ids.data_uri(F.col("url").cast("binary"), "png").alias("uri"))


# documents

_H = r"regexp_replace(html, '(?s)<(script|style)>.*?</(script|style)>', '', 'g')"


@query("page_anchors", f"SELECT page_id, m[2] AS text, m[1] AS href, url AS page, count(*) AS n FROM (SELECT page_id, url, unnest(list_transform(regexp_extract_all({_H}, '<a href=\"[^\"]*\">[^<]*</a>'), lambda x: [regexp_extract(x, 'href=\"([^\"]*)\"', 1), regexp_extract(x, '>([^<]*)<', 1)])) AS m FROM pages) GROUP BY 1, 2, 3, 4")
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = D.anchors(D.html_nodes(pages, "page_id"), "page_id").join(pages.select("page_id", F.col("url").alias("page")), "page_id")
    return found.groupBy("page_id", F.coalesce("text", F.lit("")).alias("text"), "href", "page").agg(F.count("*").alias("n"))


@query("page_title", f"SELECT page_id, replace(regexp_extract({_H}, '<title>([^<]*)</title>', 1), '&amp;', '&') AS title, replace(regexp_extract({_H}, '<h1>([^<]*)</h1>', 1), '&amp;', '&') AS heading FROM pages")
def _(spark, sf_dir):
    n = D.html_nodes(table(spark, sf_dir, "pages"), "page_id")
    first = lambda tag: F.coalesce(F.min_by(F.when(F.col("tag") == tag, F.coalesce("text", F.lit(""))), F.when(F.col("tag") == tag, F.col("node_id"))), F.lit(""))
    return n.groupBy("page_id").agg(first("title").alias("title"), first("h1").alias("heading"))


@query("abs_urls", "SELECT page_id, regexp_extract(url, '^([a-z]+://[^/]+)', 1) || h AS link FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href=\"(/[^\"]*)\">', 1)) AS h FROM pages)")
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    links = D.anchors(D.html_nodes(pages, "page_id"), "page_id").join(pages.select("page_id", "url"), "page_id").where(F.col("href").startswith("/"))
    return D.absolute(links, "url", "href", "link").select("page_id", "link")


@query("tag_frequency", f"SELECT tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[^>]*>', 1)) AS tag FROM (SELECT regexp_replace(html, '(?s)(<script>|<style>).*?(</script>|</style>)', '\\1', 'g') AS html FROM pages)) GROUP BY tag")
def _(spark, sf_dir):
    return D.tag_frequency(D.html_nodes(table(spark, sf_dir, "pages"), "page_id"))


@query("top_classes", "SELECT page_id, c AS class, count(*) AS n, row_number() OVER (PARTITION BY page_id ORDER BY count(*) DESC, c) AS rank FROM (SELECT page_id, unnest(regexp_extract_all(html, 'class=\"([^\"]*)\"', 1)) AS c FROM pages) GROUP BY 1, 2")
def _(spark, sf_dir):
    return D.top_classes(D.html_nodes(table(spark, sf_dir, "pages"), "page_id"), "page_id")


@query("dialect_dispatch", "SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'old_original' WHEN 1 THEN 'modern_original' WHEN 2 THEN 'old_consolidated' WHEN 3 THEN 'proposal' ELSE 'unsupported' END AS dialect FROM pages")
def _(spark, sf_dir):
    marked = F.expr("""CASE page_id % 5 WHEN 0 THEN '<div id="txt_te"><p>a</p></div>' WHEN 1 THEN '<p class="ti-art">a</p>' WHEN 2 THEN '<p style="x">a</p>' WHEN 3 THEN '<p class="Normal">a</p><p class="num">b</p>' ELSE '<p>a</p>' END""")
    return D.dialect(D.html_nodes(table(spark, sf_dir, "pages").select("page_id", marked.alias("html")), "page_id"), "page_id")


@query("id_dedupe", "SELECT k, celex || CASE WHEN n > 1 THEN '--' || cast(n - 1 AS string) ELSE '' END AS node FROM (SELECT k, 'ART_' || cast(k % 50 AS string) AS celex, row_number() OVER (PARTITION BY custkey, k % 50 ORDER BY k) AS n FROM {ids} i)", i="ids")
def _(i):
    rows = i.select("k", "custkey", F.expr("'ART_' || cast(k % 50 AS string)").alias("node"))
    return D.unique_ids(rows, "custkey", "node", "k").select("k", "node")


@query("skeleton_missing", "SELECT changer, changee AS celex FROM {changes} c WHERE changee NOT IN (SELECT celex FROM {acts} a)", c="changes", a="acts")
def _(c, a):
    refs = c.select("changer", F.col("changee").alias("celex"), F.lit("").alias("id"))
    return R.skeleton_missing(refs, a.select("celex", F.lit("").alias("id"))).select("changer", "celex")


@query("fragment_missing", "SELECT page_id, count(*) AS dangling FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"/([^\"]*)\">', 1)) AS t FROM pages) WHERE t NOT IN ('The', 'and') GROUP BY page_id")
def _(spark, sf_dir):
    links = D.anchors(D.html_nodes(table(spark, sf_dir, "pages"), "page_id"), "page_id").where(F.col("href").startswith("/")).select("page_id", F.substr("href", F.lit(2)).alias("target"))
    ids_ = links.select("page_id").distinct().crossJoin(spark.createDataFrame([("The",), ("and",)], "node string"))
    return D.dangling(links, ids_, "page_id", "target", "node").groupBy("page_id").agg(F.count("*").alias("dangling"))


# metadata


@query("metadata_pivot", """SELECT s, max(o) FILTER (p = 'cdm:resource_legal_id_celex') AS id_local, max(o) FILTER (p = 'cdm:resource_legal_in-force') AS in_force, max(o) FILTER (p = 'cdm:work_date_creation_legacy') AS date_publication,
    coalesce(string_agg(DISTINCT o, ',' ORDER BY o) FILTER (p = 'cdm:work_cites_work'), '') AS cites, coalesce(string_agg(DISTINCT o, ',' ORDER BY o) FILTER (p = 'cdm:resource_legal_amends_resource_legal'), '') AS amends
    FROM {triples} t WHERE s IN (SELECT s FROM {triples} u WHERE p = 'cdm:resource_legal_id_celex') GROUP BY s""", t="triples")
def _(t):
    r = M.records(t).where(F.col("id_local").isNotNull())
    return r.select("s", "id_local", "in_force", "date_publication", F.array_join("cites", ",").alias("cites"), F.array_join("amends", ",").alias("amends"))


@query("metadata_join", """SELECT coalesce(a.custkey, b.custkey) AS custkey, coalesce(a.day, b.day) AS day, array_to_string(list_sort(list_distinct(list_concat(coalesce(a.c, []), coalesce(b.c, [])))), ',') AS c, a.day IS NOT NULL AND b.day IS NOT NULL AND a.day <> b.day AS clash
    FROM (SELECT custkey, cast(min(day) AS string) AS day, list(DISTINCT celex) AS c FROM {ids} i WHERE k % 2 = 0 GROUP BY 1) a FULL JOIN (SELECT custkey, cast(min(day) AS string) AS day, list(DISTINCT celex) AS c FROM {ids} i WHERE k % 3 = 0 GROUP BY 1) b ON a.custkey = b.custkey""", i="ids")
def _(i):
    side = lambda w: i.where(w).groupBy("custkey").agg(F.min("day").cast("string").alias("day"), F.collect_set("celex").alias("c"))
    j = M.join_records(side("k % 2 = 0"), side("k % 3 = 0"), "custkey", ["day"], ["c"])
    return j.select("custkey", "day", F.array_join("c", ",").alias("c"), (F.size("conflicts") > 0).alias("clash"))


@query("cleanse_citations", """SELECT c.celex, array_to_string(list_sort(list_filter(c.x, lambda h: h <> '/eu/' || c.celex || '/' AND NOT list_contains(c.a, h))), ',') AS cites, CASE WHEN len(list_filter(c.a, lambda h: h <> '/eu/' || c.celex || '/')) > 0 THEN false ELSE c.in_force END AS in_force
    FROM (SELECT celex, bool_or(in_force) AS in_force, list(DISTINCT '/eu/' || CASE WHEN n % 2 = 0 THEN celex ELSE 'P' || cast(part % 50 AS string) END || '/') AS x, coalesce(list(DISTINCT '/eu/P' || cast(part % 50 AS string) || '/') FILTER (n % 3 = 0), []) AS a FROM {lines} l GROUP BY celex) c""", l="lines")
def _(l):  # noqa: E741
    acts = l.groupBy("celex").agg(F.bool_or("in_force").alias("in_force"), F.collect_set(F.expr("'/eu/' || CASE WHEN n % 2 = 0 THEN celex ELSE 'P' || cast(part % 50 AS string) END || '/'")).alias("cites"), F.collect_set(F.expr("CASE WHEN n % 3 = 0 THEN '/eu/P' || cast(part % 50 AS string) || '/' END")).alias("repealed_by"))
    return M.cleanse(acts, "celex", ("cites", "repealed_by")).select("celex", F.array_join(F.array_sort("cites"), ",").alias("cites"), "in_force")


@query("rdfa_metas", "SELECT celex, 'eli:publication_date' AS property, cast(publication_date AS string) AS content, NULL AS resource, 'xsd:date' AS datatype FROM {acts} a UNION ALL SELECT celex, 'eli:in_force', cast(in_force AS string), NULL, 'xsd:boolean' FROM {acts} a WHERE in_force IS NOT NULL UNION ALL SELECT celex, 'eli:source', NULL, '/eu/' || celex || '/', NULL FROM {acts} a", a="acts")
def _(a):
    return M.rdfa(a.withColumn("source", F.expr("'/eu/' || celex || '/'")), "celex", "eli", ["publication_date", "in_force", "source"])


# lookups


@query("language_codes", "SELECT lang AS language, count(*) AS n, CASE lang WHEN 'en' THEN 'ENG' WHEN 'de' THEN 'DEU' WHEN 'es' THEN 'SPA' WHEN 'fr' THEN 'FRA' END AS three FROM documents d GROUP BY lang")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("language")).agg(F.count("*").alias("n")).withColumn("three", L.language_of_three(F.col("language")))


@query("representation_state", "SELECT r.celex, r.language, r.date, a.in_force, r.transformation LIKE 'success%' AS loaded, '0' || substr(r.celex, 2) || '-' || replace(cast(r.date AS string), '-', '') AS compound_celex FROM {representation} r LEFT JOIN {acts} a ON a.celex = r.celex", r="representation", a="acts")
def _(r, a):
    return L.accessors(r, a)


@query("guessed_urls", "SELECT celex, language, date, coalesce(nullif(url_html, ''), 'https://eur-lex.europa.eu/legal-content/' || language || '/TXT/HTML/?uri=CELEX:0' || substr(celex, 2) || '-' || replace(cast(date AS string), '-', '')) AS url FROM {representation} r", r="representation")
def _(r):
    return r.select("celex", "language", "date", F.coalesce(F.nullif("url_html", F.lit("")), L.guessed_url(F.col("celex"), F.col("date"), F.col("language"), "HTML")).alias("url"))


@query("previous_preamble", "SELECT celex, language, date, transformation LIKE 'success%' AS recitals, min(CASE WHEN transformation LIKE 'success%' THEN date END) OVER (PARTITION BY celex, language ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS preamble_date FROM {representation} r", r="representation")
def _(r):
    return L.previous_preamble(r.select("celex", "language", "date", F.col("transformation").startswith("success").alias("recitals")))


@query("consolidation_hits_of_types", "SELECT o AS celex FROM {triples} t WHERE p = 'cdm:resource_legal_id_celex' AND o LIKE '0%' AND substr(o, 6, 1) IN ('R', 'D')", t="triples")
def _(t):
    return L.of_types(t.where("p = 'cdm:resource_legal_id_celex' AND o LIKE '0%'").select(F.col("o").alias("celex")), ["R", "D"])


@query("hosted_paths", "SELECT DISTINCT '3' || substr(celex, 4) AS written, '/eu/3' || CASE WHEN substr(celex, 4, 2) < '45' THEN '20' ELSE '19' END || substr(celex, 4) || '/' AS path FROM {ids} i", i="ids")
def _(i):
    written = F.concat(F.lit("3"), F.substring("celex", 4, 99))
    return i.select(written.alias("written"), L.hosted_path(written).alias("path")).distinct()


@query("newest_hits", "SELECT celex, max_by(seen, ord) AS seen, list_sort(list(DISTINCT language))[1] AS first_language, len(list(DISTINCT language)) AS n_languages FROM {hits} h GROUP BY celex", h="hits")
def _(h):
    return R.newest_hits(h).select("celex", "seen", F.col("languages")[0].alias("first_language"), F.size("languages").cast("long").alias("n_languages"))


@query("merge_pages", "SELECT celex, max_by(language, ord) AS language, max(ord) AS ord, (SELECT count(DISTINCT celex) FROM {hits} g) AS total, cast(ceil((SELECT count(*) FROM {hits} k) / 100.0) AS bigint) AS pages FROM {hits} h GROUP BY celex", h="hits")
def _(h):
    n = h.agg(L.pages(F.count("*"), 100).alias("pages"))
    return L.merge_pages(h.select("celex", "language", "ord"), "celex", "ord").crossJoin(F.broadcast(n))


@query("popular_titles", "SELECT celex AS id_local, 'EN' AS language, CASE WHEN k % 4 = 0 THEN 'Popular ' || celex ELSE priority END AS pop_title, CASE WHEN k % 8 = 0 THEN 'P' || cast(k AS string) WHEN k % 4 = 0 THEN NULL ELSE 'old' END AS pop_acronym, k FROM {ids} i", i="ids")
def _(i):
    titles = i.where("k % 4 = 0").select(F.concat_ws("-", "celex", "k").alias("id_local"), F.lit("EN").alias("language"), F.concat(F.lit("Popular "), "celex").alias("pop_title"), F.expr("CASE WHEN k % 8 = 0 THEN 'P' || k END").alias("pop_acronym"))
    records = i.select(F.concat_ws("-", "celex", "k").alias("id_local"), F.lit("EN").alias("language"), F.col("priority").alias("pop_title"), F.lit("old").alias("pop_acronym"), "k")
    return L.popular_titles(records, titles).withColumn("id_local", F.split_part("id_local", F.lit("-"), F.lit(1)))


@query("text_of_markup", "SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '[\\s]+', ' ', 'g')) AS body FROM pages p")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", L.textify(F.col("html")).alias("body"))


# titles and formulas


_KIND = "CASE substr({0}, 6, 1) WHEN 'R' THEN 'Regulation' WHEN 'L' THEN 'Directive' WHEN 'D' THEN 'Decision' ELSE 'Framework Decision' END"
_NUMBER = "CASE WHEN substr({0}, 6, 1) = 'R' THEN '(EU) No ' || cast(cast(substr({0}, 7) AS int) AS string) || '/' || substr({0}, 2, 4) ELSE substr({0}, 2, 4) || '/' || cast(cast(substr({0}, 7) AS int) AS string) || '/EC' END"
_NAME = _KIND + " || ' ' || " + _NUMBER
_CHANGES = "SELECT changer, min(CASE WHEN change = 'amends' THEN changee END) AS a, max(CASE WHEN change = 'completes' THEN changee END) AS b, min(CASE WHEN change = 'repeals' THEN changee END) AS r FROM {changes} c GROUP BY changer"
_TITLES = f"""SELECT changer AS celex, {_NAME.format("changer")} AS name, a, b, r, {_NAME.format("changer")} || ' of the Council of 26 June ' || substr(changer, 2, 4) || ' on the matter ' || substr(changer, 7)
    || coalesce(', amending ' || {_NAME.format("a")} || coalesce(' and ' || {_NAME.format("b")}, ''), '') || coalesce(' and repealing Annex II to ' || {_NAME.format("r")}, '') AS title FROM ({_CHANGES}) x"""


@query(
    "title_parse",
    f"""SELECT celex, title, make_date(cast(substr(celex, 2, 4) AS int), 6, 26) AS date_document, 'On the matter ' || substr(celex, 7) AS title_essence,
    upper(substr(name, 1, 1)) || CASE WHEN substr(celex, 6, 1) = 'F' THEN 'ramework Decision' || substr(name, 19) ELSE substr(name, 2) END AS id_human,
    CASE WHEN a IS NULL THEN '' ELSE concat_ws(',', a, b) END AS amends, coalesce(r, '') AS repeals FROM ({_TITLES}) t""",
    c="changes",
)
def _(c):
    t = c.sparkSession.sql(_TITLES, changes=c)
    p = titles.parse(F.col("title"), "EN")
    out = t.select("celex", "title", p.alias("p"))
    return out.select("celex", "title", "p.date_document", "p.title_essence", "p.id_human", F.array_join("p.amends", ",").alias("amends"), F.array_join("p.repeals", ",").alias("repeals"))


@query("title_marked", f"""SELECT celex, replace(title, 'on the matter ' || substr(celex, 7) || CASE WHEN a IS NULL THEN '' ELSE ',' END, '<p class="lxp-title_essence">On the matter ' || substr(celex, 7) || CASE WHEN a IS NULL THEN '</p>' ELSE ',</p>' END) AS title FROM ({_TITLES}) t""", c="changes")
def _(c):
    t = c.sparkSession.sql(_TITLES, changes=c)
    return t.select("celex", titles.title_data(F.col("title"), F.lit(None).cast("string"), F.col("celex"), "EN")["title"].alias("title"))


_FORMULA = """SELECT k, CASE WHEN k % 16 = 0 THEN '<FORMULA><EXPR>' || celex || '</EXPR><OVER/></FORMULA>' WHEN k % 16 = 1 THEN NULL ELSE '<FORMULA.S><HT TYPE="ITALIC">RW</HT> = <EXPR>' || cast(custkey AS string)
    || '</EXPR><OVER/><EXPR>' || substr(celex, 6, 1) || '<IND LOC="SUB">' || cast(k AS string) || '</IND></EXPR></FORMULA.S>' END AS markup, celex, custkey FROM {ids} i"""


@query(
    "formula_latex",
    r"""SELECT k, latex, CASE WHEN latex IS NOT NULL THEN '<div class="lxp-math">$$' || latex || '$$</div>' END AS html, CASE k % 16 WHEN 0 THEN 'malformed' WHEN 1 THEN 'empty' ELSE 'ok' END AS status
    FROM (SELECT k, CASE WHEN k % 16 > 1 THEN '\mathrm{RW} = \frac{' || cast(custkey AS string) || '}{' || substr(celex, 6, 1) || ' _{' || cast(k AS string) || '}}' END AS latex FROM {ids} i) f""",
    i="ids",
)
def _(i):
    return X.render(i.sparkSession.sql(_FORMULA, ids=i), "k", "markup")


# sequences


@query("label_resolve")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    made = F.expr("CASE WHEN pos < 9 THEN '(' || substr('abcdefghij', pos + 1, 1) || ')' WHEN pos = 9 THEN '(i)' WHEN pos = 10 THEN '(ii)' ELSE '(j)' END")
    items = docs.select(F.col("doc_id").alias("list_id"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("pos")).withColumn("label", made)
    return S.label_tags(items, "en")


@query("toc_nest")
def _(spark, sf_dir):
    flat = [*"CHP_I SEC_1 ART_1 ART_2 SEC_2 ART_3 CHP_II ART_4 ANX_I CHP_I ANX_II".split()]
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.array(*map(F.lit, flat))).alias("pos", "ordinate"))
    return S.toc(docs)
