"""Operators whose rows depend on the rows before them: list labels, headings, tables of contents."""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quillon.functions.text import LABELS, LANGUAGES, NBSP

#: What is stripped from a label to get its value.
_STRIP = "(). " + NBSP
#: What a reading of a label costs: it goes on where its kind of list stopped, begins a list, or does neither; a kind
#: further out in the hierarchy costs a trifle more.
_GOES_ON, _BEGINS, _LEAPS, _OUTER = 0.0, 1.0, 6.0, 0.001
#: Readings of the list so far that are kept, the cheapest first.
_KEPT = 64


def _letters(value: str) -> int:
    n = 0
    for c in value:
        n = n * 26 + ord(c) - ord("a") + 1
    return n


def _roman(value: str) -> int:
    digits = [{"i": 1, "v": 5, "x": 10, "l": 50}[c] for c in value]
    return sum(-d if any(e > d for e in digits[k + 1 : k + 2]) else d for k, d in enumerate(digits))


#: The number of a value within its kind of list; dashes have none.
_NUMBER = {"nump": int, "numpt": int, "numbr": int, "alpha": _letters, "roman": _roman}


def readings(label: str, language: str) -> dict[str, int | None]:
    """Kinds of list that a label may belong to, in order of hierarchy, with its number there."""
    out = {}
    for kind, by_language in LABELS.items():
        if language in by_language and (m := re.match(by_language[language].replace("^", "", 1), label)):
            out[kind] = _NUMBER[kind](m.group(0).strip(_STRIP)) if kind in _NUMBER else None
    return out


def resolve_labels(labels: list[str], language: str) -> list[str | None]:
    """One kind for each label of a list, None for labels without any.

    Of all ways to read the labels the cheapest is taken: a label should be the next number of a list of
    its kind that is open, or the first of a new one. A list within another ends when an outer one
    goes on. Where two ways cost the same, the inner kind of the hierarchy is taken.
    """
    if language not in LANGUAGES:
        raise ValueError(f"unsupported language: {language}")
    rank = {kind: k for k, kind in enumerate(LABELS)}
    # by the open lists, outermost first, as (kind, last number): cost and kinds so far
    ways: dict[tuple, tuple[float, tuple]] = {(): (0.0, ())}
    for label in labels:
        after: dict[tuple, tuple[float, tuple]] = {}
        kinds = readings(label, language)
        for lists, (cost, chosen) in ways.items():
            if not kinds:
                after[lists] = min(after.get(lists, (math.inf, ())), (cost, (*chosen, None)), key=lambda w: w[0])
            for kind, number in kinds.items():
                depth = next((d for d, (k, _) in enumerate(lists) if k == kind), None)
                follows = depth is not None and (number is None or lists[depth][1] + 1 == number)
                step = _GOES_ON if follows else _BEGINS if number in (None, 1) else _LEAPS
                kept = lists if depth is None else lists[:depth]
                way = cost + step + _OUTER * (len(rank) - rank[kind]), (*chosen, kind)
                key = (*kept, (kind, number))
                if key not in after or way[0] < after[key][0]:
                    after[key] = way
        ways = dict(sorted(after.items(), key=lambda x: x[1][0])[:_KEPT])
    return list(min(ways.values(), key=lambda w: w[0])[1])


def label_tags(items: DataFrame, language: str, key: str = "list_id", order: str = "pos", label: str = "label") -> DataFrame:
    """(key, order, label, tag) with labels resolved within each list. A list is one element's items, so it fits a task."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by(order)
        return group.append_column("tag", pa.array(resolve_labels(group[label].to_pylist(), language), pa.string()))

    cols = items.select(key, order, label)
    return cols.groupBy(key).applyInArrow(run, StructType([*cols.schema.fields, StructField("tag", StringType())]))


#: Words that begin headings, by language and coordinate.
HEADS = {
    "en": {"CHP": "chapter", "SEC": "section", "SUB": "subsection", "TIT": "title", "PRT": "part", "ANX": "annex", "ART": "article", "APP": "appendix"},
    "de": {"CHP": "kapitel", "SEC": "abschnitt", "SUB": "unterabschnitt", "TIT": "titel", "PRT": "teil", "ANX": "anhang", "ART": "artikel", "APP": "anlage"},
    "es": {"CHP": "capítulo", "SEC": "sección", "SUB": "subsección", "TIT": "título", "PRT": "parte", "ANX": "anexo", "ART": "artículo", "APP": "apéndice"},
}
_VALUE = re.compile(r"(?:[0-9]+[a-z]?|[IVXLC]+[a-z]?|[A-Z])$")
_LATIN = re.compile(r"(?:bis|ter|quater|quinquies|sexies|septies|octies|novies|decies)$")


def heading(text: str, language: str) -> tuple[str, str, str | None] | None:
    """(coordinate, ordinate, title) of a heading, or None if the text is none."""
    words = (text or "").split()
    if not words or text.startswith("("):
        return None
    axis = next((a for a, w in HEADS.get(language, {}).items() if words[0].lower() == w), None)
    if axis is None:
        return None
    if len(words) == 1:
        return axis, words[0], None
    value, rest, shown = words[1], words[2:], 2
    if not _VALUE.match(value):
        return None if value.endswith(".") and _VALUE.match(value[:-1]) else (axis, words[0], " ".join(words[1:]))
    if rest and _LATIN.match(rest[0]):
        value, rest, shown = f"{value} {rest[0]}", rest[1:], 3
    if len(rest) == 1 and len(rest[0]) == 1:
        return f"{axis}_{value}_{rest[0]}", " ".join(words[: shown + 1]), None
    return f"{axis}_{value}".replace(" ", "_"), " ".join(words[:shown]), " ".join(rest) or None


#: Axes that are articles; all others hold others. Annexes are articles that gather in a container of their own.
LEAVES, ANNEX = ("ART", "ANX", "PRE", "FIN"), "ANX"


def toc(headings: DataFrame, doc: str = "doc_id", order: str = "pos", ordinate: str = "ordinate") -> DataFrame:
    """(doc, pos, parent, ordinate, type, id) of each document's headings, given in order as AXIS or AXIS_value.

    pos counts from 0; the root is -1, and the container of several annexes has the number of headings.
    Headings are folded over the path of open ones: a heading closes the outermost open one of its axis, with
    all within, and stands in its place; if there is none it goes into the innermost open one, or beside it if
    that is an article. An annex closes all but the annexes' container, and a container after it goes into
    the annex. A container's id is its parent's and its ordinate, an article's is its ordinate.
    """
    entry = "struct<axis:string,pos:int,id:string,leaf:boolean>"
    row = "struct<pos:int,parent:int,ordinate:string,type:string,id:string>"
    lists = headings.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), F.col(ordinate).alias("o")))).alias("h"))
    n = F.size("h")
    several = F.size(F.filter("h", lambda x: F.split_part(x["o"], F.lit("_"), F.lit(1)) == ANNEX)) > 1

    def made(cast: str, *values):
        return F.struct(*values).cast(cast)

    def fold(state, x):
        axis, path = F.split_part(x["o"], F.lit("_"), F.lit(1)), state["path"]
        leaf, annex = axis.isin(*LEAVES), axis == ANNEX
        container = made(entry, F.lit("CNT"), n, F.lit("toc-ANX"), F.lit(False))
        base = F.when(several, F.array(container)).otherwise(F.array().cast(f"array<{entry}>"))
        opened = F.exists(path, lambda e: e["axis"] == ANNEX)
        within = F.when(opened & ~leaf, F.size(base)).otherwise(0)
        same = F.array_position(F.transform(path, lambda e, i: (e["axis"] == axis) & (i >= within)), True)
        beside = F.when(F.element_at(path, -1)["leaf"] & (within == 0) & ~(opened & ~leaf), 1).otherwise(0)
        depth = F.when(same > 0, same - 1).when(F.size(path) == 0, 0).otherwise(F.size(path) - beside).cast("int")
        above = F.when(annex, base).otherwise(F.slice(path, F.lit(1), depth))
        parent = F.when(F.size(above) > 0, F.element_at(above, -1)["pos"]).otherwise(-1)
        prefix = F.when(F.size(above) > 0, F.element_at(above, -1)["id"]).otherwise("toc")
        name = F.when(leaf, x["o"]).otherwise(F.concat_ws("-", prefix, x["o"]))
        kind = F.when(leaf, "article").when(F.exists(above, lambda e: e["leaf"]), "sub-container").otherwise("container")
        rows = F.concat(
            state["rows"], F.when(annex & several & ~opened & (F.size(F.filter(state["rows"], lambda r: r["id"] == "toc-ANX")) == 0), F.array(made(row, n, F.lit(-1), F.lit(ANNEX), F.lit("container"), F.lit("toc-ANX")))).otherwise(F.array().cast(f"array<{row}>")),
            F.array(made(row, x["at"], parent, x["o"], kind, name)),
        )
        return F.struct(F.concat(above, F.array(made(entry, axis, x["at"], name, leaf))).alias("path"), rows.alias("rows"))

    numbered = F.transform("h", lambda x, i: F.struct(x["o"].alias("o"), i.cast("int").alias("at")))
    start = F.struct(F.array().cast(f"array<{entry}>").alias("path"), F.array().cast(f"array<{row}>").alias("rows"))
    return lists.select(doc, F.inline(F.aggregate(numbered, start, fold)["rows"]))
