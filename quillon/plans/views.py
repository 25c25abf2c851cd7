"""Registry, triples and documents derived from the driver's tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_CELEX = "'3' || cast(year(o_orderdate) AS string) || substr('RLDF', cast(o_custkey % 4 + 1 AS int), 1) || lpad(cast(o_orderkey % 10000 AS string), 4, '0')"

#: The text of each view; names in braces are tables or earlier views.
VIEWS = {
    "ids": f"SELECT o_orderkey AS k, o_custkey AS custkey, {_CELEX} AS celex, cast(o_orderdate AS date) AS day, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS in_force, o_orderpriority AS priority FROM {{orders}}",
    "acts": "SELECT celex, min(day) AS publication_date, bool_or(in_force) AS in_force FROM {ids} GROUP BY celex",
    "lines": "SELECT celex, day, in_force, cast(l_shipdate AS date) AS date, l_linenumber AS n, l_partkey AS part, l_suppkey AS supp, l_returnflag AS flag, l_linestatus AS status FROM {lineitem} JOIN {ids} ON l_orderkey = k",
    "representation": """SELECT celex, date, language, min(transformation) AS transformation, bool_or(uploaded) AS uploaded, max(url_html) AS url_html FROM (
        SELECT celex, date, CASE n % 3 WHEN 0 THEN 'EN' WHEN 1 THEN 'DE' ELSE 'ES' END AS language,
          CASE WHEN flag = 'R' THEN 'failed' WHEN flag = 'A' THEN 'success_fmx' WHEN part % 5 = 0 THEN 'stubbed' WHEN part % 5 = 1 THEN 'repealer' END AS transformation,
          CASE WHEN status = 'F' THEN true WHEN part % 2 = 0 THEN false END AS uploaded,
          CASE supp % 3 WHEN 0 THEN '' WHEN 1 THEN 'http://host/' || cast(part AS string) END AS url_html FROM {lines}) t GROUP BY celex, date, language""",
    "changes": """SELECT DISTINCT celex AS changer, CASE n % 3 WHEN 0 THEN 'amends' WHEN 1 THEN 'completes' ELSE 'repeals' END AS change,
        '3' || cast(1992 + part % 7 AS string) || substr('RLDF', cast(supp % 4 + 1 AS int), 1) || lpad(cast(part % 10000 AS string), 4, '0') AS changee FROM {lines}""",
    "remote": "SELECT celex, bool_or(CASE WHEN k % 3 = 0 THEN true WHEN k % 3 = 1 THEN in_force END) AS in_force FROM {ids} WHERE k % 5 <> 0 GROUP BY celex",
    "local": "SELECT celex, in_force FROM {acts} WHERE substr(celex, 9, 1) <> '7'",
    "hits": "SELECT celex, k AS ord, cast(day AS string) AS seen, CASE custkey % 3 WHEN 0 THEN 'EN' WHEN 1 THEN 'DE' ELSE 'ES' END AS language FROM {ids}",
    "spoken": "SELECT k, 'w' || cast(k AS string) AS w, 'e' || cast(k AS string) || l AS e, l, celex, day, custkey, in_force, priority FROM {ids} CROSS JOIN (SELECT 'EN' AS l UNION ALL SELECT 'DE' AS l) ls WHERE k % 4 <> 3 OR l = 'EN'",
    "triples": """
        SELECT 'w' || cast(k AS string) AS s, 'cdm:resource_legal_id_celex' AS p, celex AS o, cast(NULL AS string) AS lang FROM {ids}
        UNION ALL SELECT 'w' || cast(k AS string), 'cdm:resource_legal_in-force', CASE WHEN in_force THEN 'true' ELSE 'false' END, NULL FROM {ids} WHERE in_force IS NOT NULL
        UNION ALL SELECT 'w' || cast(k AS string), 'cdm:work_date_creation_legacy', cast(day AS string), NULL FROM {ids}
        UNION ALL SELECT 'w' || cast(k AS string), 'cdm:resource_legal_year', cast(year(day) AS string), NULL FROM {ids}
        UNION ALL SELECT e, 'cdm:expression_belongs_to_work', w, NULL FROM {spoken}
        UNION ALL SELECT e, 'cdm:expression_uses_language', l, NULL FROM {spoken}
        UNION ALL SELECT e, 'cdm:expression_title', 'Title ' || celex || ' ' || l, NULL FROM {spoken} WHERE k % 3 <> 0
        UNION ALL SELECT 'c' || cast(k AS string), 'cdm:act_consolidated_based_on_resource_legal', 'w' || cast(k AS string), NULL FROM {ids} WHERE k % 7 = 0
        UNION ALL SELECT 'c' || cast(k AS string), 'cdm:resource_legal_id_celex', '0' || substr(celex, 2) || '-' || replace(cast(day AS string), '-', ''), NULL FROM {ids} WHERE k % 7 = 0
        UNION ALL SELECT 'c' || cast(k AS string), 'cdm:act_consolidated_date', cast(day AS string), NULL FROM {ids} WHERE k % 7 = 0
        UNION ALL SELECT 'x' || e, 'cdm:expression_belongs_to_work', 'c' || cast(k AS string), NULL FROM {spoken} WHERE k % 7 = 0
        UNION ALL SELECT 'x' || e, 'cdm:expression_uses_language', l, NULL FROM {spoken} WHERE k % 7 = 0
        UNION ALL SELECT 'r' || cast(k AS string), 'cdm:resource_legal_corrects_resource_legal', 'w' || cast(k AS string), NULL FROM {ids} WHERE k % 5 = 0
        UNION ALL SELECT 'r' || cast(k AS string), 'cdm:resource_legal_id_celex', celex || 'R(01)', NULL FROM {ids} WHERE k % 10 = 0
        UNION ALL SELECT 'r' || cast(k AS string), 'cdm:resource_legal_number_corrigendum', '1', NULL FROM {ids} WHERE k % 5 = 0
        UNION ALL SELECT 'r' || cast(k AS string), 'cdm:work_date_document', cast(day AS string), NULL FROM {ids} WHERE k % 5 = 0
        UNION ALL SELECT 'y' || e, 'cdm:expression_belongs_to_work', 'r' || cast(k AS string), NULL FROM {spoken} WHERE k % 5 = 0
        UNION ALL SELECT 'y' || e, 'cdm:expression_uses_language', l, NULL FROM {spoken} WHERE k % 5 = 0
        UNION ALL SELECT 'w' || cast(k AS string), 'cdm:work_cites_work', 'w' || cast(custkey AS string), NULL FROM {ids}
        UNION ALL SELECT 'w' || cast(k AS string), 'cdm:resource_legal_amends_resource_legal', 'w' || cast(custkey * 4 AS string), NULL FROM {ids} WHERE k % 2 = 0
        UNION ALL SELECT 'w' || cast(k AS string), 'cdm:resource_legal_based_on_concept_treaty', 'treaty/' || substr(priority, 1, 1), NULL FROM {ids} WHERE k % 6 = 0
        UNION ALL SELECT 'w' || cast(k AS string), 'cdm:work_is_about_concept_eurovoc', 'concept/' || cast(custkey % 25 AS string), NULL FROM {ids}
        UNION ALL SELECT 'concept/' || cast(n_nationkey AS string), 'skos:prefLabel', n_name, 'en' FROM {nation}
        UNION ALL SELECT 'concept/' || cast(n_nationkey AS string), 'skos:prefLabel', lower(n_name), 'de' FROM {nation}
        UNION ALL SELECT 'treaty/' || cast(r_regionkey AS string), 'cdm:title', r_name, 'en' FROM {region}
        UNION ALL SELECT 'treaty/' || cast(r_regionkey AS string), 'cdm:code', cast(r_regionkey AS string), NULL FROM {region}
        UNION ALL SELECT 'event/' || cast(n_nationkey AS string), 'cdm:refers_to', 'treaty/' || cast(n_regionkey AS string), NULL FROM {nation}""",
    "dims": """SELECT cast(n_nationkey AS string) AS code, 'EN' AS language, n_name AS label FROM {nation}
        UNION ALL SELECT cast(n_nationkey AS string), 'DE', lower(n_name) FROM {nation} WHERE n_nationkey % 2 = 0""",
    "labels": """SELECT doc_id, lang, CASE doc_id % 8 WHEN 0 THEN '(' || cast(doc_id % 40 AS string) || ') x' WHEN 1 THEN '(' || substr('abcdefghiv', cast(doc_id % 10 + 1 AS int), 1) || ') x' WHEN 2 THEN cast(doc_id % 90 AS string) || '. x'
        WHEN 3 THEN '(ii) x' WHEN 4 THEN chr(8212) || ' x' WHEN 5 THEN cast(doc_id % 90 AS string) || ' x' WHEN 6 THEN 'none' ELSE '(iv)' END AS label FROM {documents}""",
}


def sql_of(name: str) -> str:
    """The view as one SQL text over the driver's tables."""
    text = VIEWS[name]
    for other in VIEWS:
        if "{" + other + "}" in text:
            text = text.replace("{" + other + "}", f"({sql_of(other)}) {other}_v")
    return text.replace("{", "").replace("}", "")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame; tables are read by name from sf_dir."""
    text, inputs = VIEWS[name].replace("chr(8212)", "'—'"), {}
    for table in ("orders", "lineitem", "nation", "region", "documents", *VIEWS):
        if "{" + table + "}" in text:
            inputs[table] = view(spark, sf_dir, table) if table in VIEWS else spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(text, **inputs)
