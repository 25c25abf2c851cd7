r"""Formulas in markup as LaTeX.

A formula is read into a flat list of terms a level; operators that stand between terms (a fraction bar, a
root) are folded there, then each level is joined with blanks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame

#: Brackets by the type of an expression.
BRACKETS = {"BRACKET": ("(", ")"), "BRACE": (r"\{", r"\}"), "SQBRACKET": ("[", "]"), "BAR": ("|", "|")}
#: Elements that put a command before their content; of those with a type or place, by that too.
COMMANDS = {
    ("HT", "BOLD"): r"\mathbf", ("HT", "ITALIC"): r"\mathrm", ("OVERLINE", ""): r"\overline", ("ROOT", ""): r"\sqrt",
    ("IND", "SUP"): "^", ("IND", "OVER"): "^", ("EXPONENT", ""): "^", ("OVER", ""): "^",
    ("IND", "UNDER"): "_", ("IND", "SUB"): "_", ("IND", ""): "_", ("UNDER", ""): "_",
}
#: Elements that are one symbol.
SYMBOLS = {
    ("OP.MATH", "CARTPROD"): r"\times", ("OP.MATH", "DIV"): "/", ("OP.MATH", "MINUS"): "-", ("OP.MATH", "MULT"): r"\cdot", ("OP.MATH", "PLUS"): "+", ("OP.MATH", "PLUSMINUS"): r"\pm",
    ("OP.CMP", "EQ"): "=", ("OP.CMP", "LT"): "<", ("OP.CMP", "GT"): ">", ("OP.CMP", "NE"): r"\ne", ("OP.CMP", "LE"): r"\le", ("OP.CMP", "GE"): r"\ge", ("OP.CMP", "AP"): r"\approx",
    ("OP.CMP", "EQV"): r"\equiv", ("SUM", ""): r"\sum",
}
#: Functions, Greek letters by name in order of their code points, and other characters.
FUNCTIONS = {name: "\\" + name for name in ("ln", "min", "max", "sin", "cos", "exp")}
GREEK = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
CHARACTERS = {"\u0387": r"\cdot", "–": "-", "—": "-", "∂": r"\partial", "%": r"\%", "×": r"\times", "∑": r"\sum", "≤": r"\le", "≥": r"\ge"}
#: The type of a display formula, and what surrounds formulas in a block and in a line.
WRAP = {True: ("div", "$$", "$$"), False: ("span", r"\(", r"\)")}


def _greek() -> dict[str, str]:
    """The final sigma, code point 17 of each alphabet, has no command; small phi is drawn in its curly form."""
    out = {}
    for i, name in enumerate(GREEK):
        at = i + (i > 16)
        out[chr(913 + at)] = "\\" + name.capitalize()
        out[chr(945 + at)] = "\\" + name
    return out | {"φ": r"\varphi"}


CHARACTERS = _greek() | CHARACTERS
_SPLIT = re.compile("([" + re.escape(";:*/+-" + "".join(CHARACTERS)) + "])")
_WORDS = re.compile("[A-Za-z ]+")


class FormulaError(ValueError):
    """An operator between terms lacks one of them."""


@dataclass
class Term:
    tag: str = ""
    kind: str = ""
    text: str = ""
    parts: list[Term] = field(default_factory=list)

    @property
    def command(self) -> str | None:
        return COMMANDS.get((self.tag, self.kind)) if self.tag else None


def _words(text: str | None) -> list[Term]:
    """Words with blanks are one term; else operators and special characters are terms of their own."""
    text = (text or "").strip()
    pieces = [text] if _WORDS.fullmatch(text) else _SPLIT.split(text)
    return [Term(text=p.replace("\n", "").strip()) for p in pieces if p.strip()]


def _read(element: ElementTree.Element) -> Term:
    """An element with exactly one attribute, TYPE or LOC, is of that kind; other attributes make it unknown."""
    known = set(element.keys()) in ({"TYPE"}, {"LOC"})
    kind = next(iter(element.attrib.values())) if known else "?" if element.attrib else ""
    parts = _words(element.text)
    for child in element:
        parts += [_read(child), *_words(child.tail)]
    return Term(element.tag, kind, parts=_fold(parts))


def _fold(parts: list[Term]) -> list[Term]:
    """An empty root takes the next term, an empty bar the terms at its sides (several bars from the left)."""
    rooted: list[Term] = []
    for p in parts:
        if rooted and rooted[-1].tag == "ROOT" and not rooted[-1].parts:
            rooted[-1].parts.append(p)
        else:
            rooted.append(p)
    if rooted and rooted[-1].tag == "ROOT" and not rooted[-1].parts:
        raise FormulaError("a root of nothing")
    out: list[Term] = []
    rest = iter(rooted)
    for p in rest:
        if p.tag == "OVER" and not p.kind and not p.parts and out:
            below = next(rest, None)
            if below is None:
                raise FormulaError("a fraction without a denominator")
            out.append(Term("FRACTION", parts=[out.pop(), below]))
        else:
            out.append(p)
    return out


def _leaf(text: str) -> str:
    if text in FUNCTIONS or text in CHARACTERS:
        return FUNCTIONS.get(text) or CHARACTERS[text]
    if _WORDS.fullmatch(text) and len(text) >= 3 or re.fullmatch("[A-Z]{2,}", text):
        return (r"\text" if " " in text else r"\mathrm") + "{" + text + "}"
    return text


def _sums(parts: list[Term], i: int) -> bool:
    """A Sigma with a lower bound, perhaps after an upper one, is a sum."""
    bounds = [p.command for p in parts[i + 1 : i + 3]]
    return bounds[:1] == ["_"] or bounds == ["^", "_"]


def _level(parts: list[Term]) -> str:
    return " ".join(r"\sum" if p.text == "Σ" and _sums(parts, i) else _write(p) for i, p in enumerate(parts))


def _braced(term: Term) -> str:
    text = _write(term)
    return text if (term.tag, term.kind) in (("EXPR", ""), ("DIVIDEND", ""), ("DIVISOR", "")) else "{" + text + "}"


def _write(term: Term) -> str:
    if not term.tag:
        return _leaf(term.text)
    if (term.tag, term.kind) in SYMBOLS:
        return SYMBOLS[term.tag, term.kind]
    if term.tag == "FRACTION" and not term.kind:
        if len(term.parts) != 2:
            raise FormulaError("a fraction of other than two terms")
        return r"\frac" + "".join(map(_braced, term.parts))
    inner = _level(term.parts)
    if term.tag in ("EXPR", "DIVIDEND", "DIVISOR") and not term.kind:
        return "{" + inner + "}"
    if term.tag == "EXPR" and term.kind in BRACKETS:
        left, right = BRACKETS[term.kind]
        tall = re.search(r"\\(frac|sum)\b", inner)
        return rf"\left {left}{inner}\right {right}" if tall else left + inner + right
    command = term.command
    if command is None or command == r"\mathrm" and inner.startswith((r"\mathrm", r"\text")):
        return inner
    return command + "{" + inner + "}"


def latex(markup: str) -> tuple[str, bool]:
    """The LaTeX of a formula element and whether it is a display formula."""
    element = ElementTree.fromstring(markup)
    display = element.tag == "FORMULA.S" or element.tag == "FORMULA" and element.get("TYPE") == "OUTLINE"
    return _level(_read(element).parts), display


def render(rows: DataFrame, key: str, markup: str) -> DataFrame:
    """(key, latex, html, status): html is a div or span of class lxp-math around the LaTeX.

    status is 'ok', 'empty' (null or blank), 'not_xml' or 'malformed' (a fraction or root lacks a term); all but
    ok have a null latex and html. One Arrow function a batch, no shuffle; other columns aren't kept.
    """

    def one(text: str | None) -> tuple[str | None, str | None, str]:
        if not (text or "").strip():
            return None, None, "empty"
        try:
            body, display = latex(text)
        except ElementTree.ParseError:
            return None, None, "not_xml"
        except (FormulaError, RecursionError):
            return None, None, "malformed"
        tag, left, right = WRAP[display]
        safe = body.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
        return body, f'<{tag} class="lxp-math">{left}{safe}{right}</{tag}>', "ok"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [one(t) for t in b.column(1).to_pylist()]
            columns = [pa.array([m[i] for m in made], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=[key, "latex", "html", "status"])

    return rows.select(key, markup).mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, latex string, html string, status string")
