"""Identifiers, versions, months and addresses of legal acts, as column expressions. What doesn't parse is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

INITIAL = "1900-01-01"
_BASE = r"^([0-9])([0-9]{4})([A-Z]{1,2})([0-9]+)?(\([0-9]+\))?"
#: Kinds of documents by the letter of their id.
TYPE_CODES = {"R": "REG", "D": "DEC", "L": "DIR"}


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(c, pattern, group)


def celex_base(c: Column) -> Column:
    """STRUCT<pre, year, inter, number, ext, rendered> of a base id that is written in its normal form, else null."""
    pattern = _BASE + "$"
    number = _part(c, pattern, 4)
    rendered = F.concat(_part(c, pattern, 1), _part(c, pattern, 2), _part(c, pattern, 3), F.when(number == "", F.lit("")).otherwise(F.format_string("%04d", number.try_cast("int"))), _part(c, pattern, 5))
    built = F.struct(
        _part(c, pattern, 1).try_cast("int").alias("pre"), _part(c, pattern, 2).try_cast("int").alias("year"), _part(c, pattern, 3).alias("inter"),
        number.try_cast("int").alias("number"), _part(c, pattern, 5).alias("ext"), rendered.alias("rendered"),
    )
    return F.when(c.rlike(pattern) & (rendered == c), built)


def celex_compound(c: Column) -> Column:
    """STRUCT<base, kind, version, corrigendum> of an id with an annex: none, -YYYYMMDD (consolidated) or R(nn)."""
    whole = r"^(.*?)(?:-([0-9]{8})|R\(([0-9]+)\))?$"
    head, day, fix = (_part(c, whole, i) for i in (1, 2, 3))
    base = F.when(day != "", F.when(head.startswith("0"), F.concat(F.lit("3"), F.substr(head, F.lit(2))))).otherwise(head)
    version = F.try_to_date(F.nullif(day, F.lit("")), "yyyyMMdd")
    kind = F.when(day != "", "consolidated").when(fix != "", "corrigendum").otherwise("act")
    ok = celex_base(base).isNotNull() & ((day == "") | version.isNotNull())
    return F.when(ok, F.struct(base.alias("base"), kind.alias("kind"), version.alias("version"), fix.try_cast("int").alias("corrigendum")))


def render_compound(base: Column, version: Column, corrigendum: Column) -> Column:
    return (
        F.when(version.isNotNull(), F.concat(F.lit("0"), F.substr(base, F.lit(2)), F.lit("-"), F.date_format(version, "yyyyMMdd")))
        .when(corrigendum.isNotNull(), F.concat(base, F.format_string("R(%02d)", corrigendum)))
        .otherwise(base)
    )


def celex_path(c: Column) -> Column:
    """pre/year/inter/number/ext, with the number of four digits; an empty extension leaves the last separator."""
    b = celex_base(c)
    return F.concat_ws("/", b["pre"].cast("string"), b["year"].cast("string"), b["inter"], F.when(b["number"].isNotNull(), F.format_string("%04d", b["number"])).when(b.isNotNull(), ""), b["ext"])


def celex_wildcard(pre: Column, year: Column, inter: Column, number: Column) -> Column:
    """Parts in order, * for missing ones, runs of * as one."""
    parts = [F.coalesce(x.cast("string"), F.lit("*")) for x in (pre, year, inter)]
    return F.regexp_replace(F.concat(*parts, F.when(number.isNotNull(), F.format_string("%04d", number)).otherwise("*")), r"\*+", "*")


def expand(years: DataFrame, types: DataFrame, numbers: DataFrame) -> DataFrame:
    """All ids of given years, types and numbers; the lists are the arguments of a call, so they are short."""
    return years.crossJoin(F.broadcast(types)).crossJoin(F.broadcast(numbers)).select(F.concat(F.lit("3"), F.col("year").cast("string"), "inter", F.format_string("%04d", "number")).alias("celex"))


def version_date(v: Column) -> Column:
    """'initial' or YYYYMMDD as a date, else null."""
    return F.when(v == "initial", F.lit(INITIAL).cast("date")).otherwise(F.try_to_date(F.when(v.rlike("^[0-9]{8}$"), v), "yyyyMMdd"))


def version_name(d: Column) -> Column:
    return F.when(d == F.lit(INITIAL).cast("date"), "initial").otherwise(F.date_format(d, "yyyyMMdd"))


def month_bounds(d: Column) -> Column:
    """STRUCT<first, ultimo, previous, next> of a date's month, the last two as first days."""
    first = F.trunc(d, "month").cast("date")
    return F.struct(first.alias("first"), F.last_day(d).alias("ultimo"), F.add_months(first, -1).alias("previous"), F.add_months(first, 1).alias("next"))


def law_type(c: Column) -> Column:
    return F.substr(c, F.lit(6), F.lit(1))


def type_code(c: Column) -> Column:
    """REG, DEC or DIR by the id's letter, else null."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in TYPE_CODES.items() for x in kv]), law_type(c))


def url_from_celex(c: Column, language: Column) -> Column:
    return F.concat(F.lit("https://eur-lex.europa.eu/legal-content/"), language, F.lit("/TXT/?uri=CELEX:"), F.url_encode(c))


def href_to_celex(href: Column) -> Column:
    """The id in an address's uri parameter, without its celex: prefix in any case."""
    return F.regexp_replace(F.try_parse_url(href, F.lit("QUERY"), F.lit("uri")), "(?i)^celex:", "")


def id_to_path(celex: Column, node: Column) -> Column:
    """Where an id of the document is shown: the document for '', a fragment for toc-, else the leaf and its part."""
    leaf = F.substring_index(node, "-", 1)
    sub = F.when(F.instr(node, "-") > 0, F.concat(F.lit("#"), F.substr(node, F.instr(node, "-") + 1))).otherwise(F.lit(""))
    start = F.concat(F.lit("/eu/"), celex, F.lit("/"))
    return F.when(node == "", start).when(node.startswith("toc-"), F.concat(start, F.lit("#"), node)).otherwise(F.concat(start, leaf, F.lit("/"), sub))


def last_segment(iri: Column) -> Column:
    return F.substring_index(iri, "/", -1)


def data_uri(data: Column, suffix: str) -> Column:
    return F.concat(F.lit(f"data:image/{suffix};base64, "), F.base64(data))
